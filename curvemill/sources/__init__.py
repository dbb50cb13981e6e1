"""Reading snapshots and feeds, writing tables."""
