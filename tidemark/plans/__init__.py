"""End-to-end plans: operators put together over the given tables."""
