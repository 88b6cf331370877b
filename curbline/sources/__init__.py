"""Readers and checks for landed files, and the frames derived from the given tables."""
