"""Where events go: the log index, bulk requests and topics."""
