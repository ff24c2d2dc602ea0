"""martspark: retail data-mart loaders and marts expressed as Spark DataFrame jobs.

Subpackages:
  sources    readers/writers (parquet, CSV, JDBC), table schemas, stand-in tables
  functions  column expressions (exact decimal division, char(n), name hygiene, dates)
  operators  loaders, upsert/merge, partition replacement, quality checks, run log,
             dictionary lookups, sharded export
  plans      the marts and published queries built from the operators
  streaming  incremental (file-arrival) driving of the batch loaders
"""

__all__ = ["session", "functions", "sources", "operators", "plans", "streaming"]
