"""renewlens — membership-retention marts as Spark DataFrame plans.

Layout:
  sources/    scans, adapters over the driver tables, sinks, schemas, profiling
  functions/  Column expressions (geo, dates, bands, scores) — no UDFs
  operators/  DataFrame -> DataFrame building blocks (top-1, top-k, ordered
              next, semi/anti flags, calendar, location, weekly, quality, scoring)
  plans/      composed jobs (period mart, member profile, location metrics)
              and the query catalogue used by ``__spark_entry__``
  streaming/  micro-batch refresh of batch marts via foreachBatch
"""

__version__ = "0.1.0"
