"""Generic operators over observation tables."""
