"""Event streams: exact daily activity, published snapshots and activity-cliff alerts."""
