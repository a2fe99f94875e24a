"""Where lines and records come from: the landing folder and the raw topic."""
