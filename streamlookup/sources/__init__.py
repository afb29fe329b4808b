"""Messages in and out, and lookup tables."""
