"""kassa — retail sales analytics as Spark DataFrame jobs.

Layers:
  sources/    file discovery, CSV/parquet loading, test-table mapping, sampling
  functions/  Column -> Column helpers (cleaning, pseudonymisation, rounding, p-values)
  operators/  DataFrame -> DataFrame jobs (joins, masking, KPIs, cohorts, RFM, stats, quality)
  plans/      composed pipelines (curated table, facade)
  streaming/  incremental ingestion of monthly sales files with Structured Streaming
"""

from kassa.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
