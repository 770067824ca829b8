"""Spark plans that work on lines, tokens and citations."""
