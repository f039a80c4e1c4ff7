"""Analytics over hourly flight snapshots, written as Spark DataFrame plans."""
