"""tidemark: retail, risk-panel and survey analytics as plain Spark jobs."""

__version__ = "0.1.0"
