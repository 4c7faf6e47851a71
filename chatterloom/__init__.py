"""Spark operators, streams and jobs for social-event analytics."""
