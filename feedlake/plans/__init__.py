"""Layer jobs and the query catalogue."""
