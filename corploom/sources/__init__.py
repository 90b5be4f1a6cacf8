"""Readers and writers of text, tables and translation memories."""
