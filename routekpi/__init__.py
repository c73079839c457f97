"""routekpi: route KPI analytics on Spark.

Layers: `functions` (Column expressions), `operators` (DataFrame operators),
`sources` (raw CSV, seed and driver-table adapters), `plans` (staging, marts,
reports, pipeline), `streaming` (incremental file ingest).
"""

__version__ = "0.1.0"
