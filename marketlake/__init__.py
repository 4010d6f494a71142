"""marketlake: market-data lake jobs and queries as Spark DataFrame plans."""

__version__ = "0.1.0"
