"""Operators: ``DataFrame -> DataFrame`` functions over comments, results, keywords and corpora."""
