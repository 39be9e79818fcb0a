"""Daily API-metrics lakehouse on Spark: typed rows, exact daily aggregates, reconciliation."""
