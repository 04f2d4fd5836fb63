"""Building blocks composed of DataFrame operations."""
