"""millrace: a DataFrame-first engine for preparing, measuring and evaluating training corpora on Spark."""

__version__ = "0.1.0"
