"""Readers and writers of the files that jobs exchange."""
