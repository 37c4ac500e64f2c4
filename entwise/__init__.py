"""entwise — business-entity data-quality pipelines as composable Spark DataFrame functions.

Layout:
  functions/   Column expressions (trims, code maps, lenient numbers, address rules)
  sources/     table / CSV / snapshot readers and the driver-table adapters
  sinks/       overwrite, append-by-name, replace, CSV export
  operators/   DataFrame -> DataFrame operators (incremental loads, change log,
               supplements, cleaning, address classification, dashboard metrics)
  plans/       query catalogue, DuckDB oracle texts, end-to-end jobs
  streaming/   the incremental change-log load as an available-now file stream
"""

__version__ = "0.1.0"
