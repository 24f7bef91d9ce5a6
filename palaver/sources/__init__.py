"""Readers and writers of tables, corpora, vectors and message streams."""
