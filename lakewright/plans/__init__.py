"""Plan frames: what a lifecycle job would do, found out before it writes."""
