"""Complete batch jobs, from the lake to the result tables."""
