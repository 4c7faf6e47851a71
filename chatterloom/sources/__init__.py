"""Readers for logs, listing pages and the event lake."""
