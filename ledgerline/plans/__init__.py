"""The jobs: ingest, daily metrics, export, forecast, verification and the daily chain."""
