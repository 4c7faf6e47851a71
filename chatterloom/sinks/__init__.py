"""Writers for logs, the event lake and result tables."""
