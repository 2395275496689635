"""logtide — mobile-app log analytics as Spark DataFrame / SQL / Structured Streaming jobs.

Layout:
  schemas              fixed record schemas of the three app-log kinds
  session              local session builder and the shared scratch folder
  sources/             log lines from tables, files and Kafka-shaped message envelopes
  functions/           Column and SQL functions: date buckets, time formats, log parsing
  operators/           routing/validation, click counters, unique users, offsets, archive
  plans/               the registered queries and their DuckDB oracle SQL
  streaming/           per-batch delta tables and the three streaming jobs
"""

__version__ = "0.1.0"
