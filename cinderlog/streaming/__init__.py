"""Streaming jobs over the same operators that tables use."""
