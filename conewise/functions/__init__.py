"""Column builders and fixed rule tables."""
