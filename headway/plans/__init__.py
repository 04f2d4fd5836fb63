"""User-level queries composed of the operators."""
