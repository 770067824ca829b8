"""Readers and writers of the edition formats."""
