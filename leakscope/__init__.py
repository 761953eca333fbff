"""Revenue-leakage analytics and hybrid retrieval as Spark jobs."""

__version__ = "0.1.0"
