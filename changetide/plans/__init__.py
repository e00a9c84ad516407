"""Reports on replicated tables, and the change feeds derived from the given tables."""
