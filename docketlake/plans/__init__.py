"""Named queries: operators applied to tables."""
