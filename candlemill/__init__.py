"""Set-based market-data jobs on Spark: lake, warehouse, reports, streams."""
