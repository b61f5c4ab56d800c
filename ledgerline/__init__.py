"""ledgerline: order-stream ingest, daily metrics and revenue forecasts as Spark DataFrame plans."""

__version__ = "0.1.0"
