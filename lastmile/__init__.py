"""lastmile — order-fulfilment analytics as Spark DataFrame jobs.

Layers follow the medallion layout the analytics are defined on:

* ``sources``   – typed readers (CSV, JSON lines, Parquet), load metadata, and the
  mapping of the provided TPC-H-style tables onto the fulfilment entities.
* ``functions`` – Column expressions (durations, buckets, slots, flags, ratios).
* ``operators`` – generic DataFrame operators (dedupe, first-per-type pivot, sized
  lookup join, anti join, quality assertions).
* ``plans``     – the silver models, intermediate models, marts, profiling reports and
  the documented (``doc_*``) variants, each a function ``DataFrame -> DataFrame``.
* ``sinks``     – Parquet / CSV / table writers.
* ``streaming`` – the event dedupe as a Structured Streaming job.
"""

from lastmile.session import get_session

__all__ = ["get_session"]
