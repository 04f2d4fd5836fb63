"""Message and table sources."""
