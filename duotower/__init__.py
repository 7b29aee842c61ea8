"""duotower: dual-encoder (two-tower) recommendation as Spark DataFrame jobs."""

__version__ = "0.1.0"
