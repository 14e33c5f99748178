"""Plan helpers (size-checked broadcast, hot-key joins) and the query catalogue."""
