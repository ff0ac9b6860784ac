"""Lending analytics on Spark: validated ingest, star schema, KPIs and alerts."""
