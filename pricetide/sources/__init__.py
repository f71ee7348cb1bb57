"""Pages, raw observations and date-partitioned tables."""
