"""Comment moderation analytics on Spark: clean, score, merge, report."""
