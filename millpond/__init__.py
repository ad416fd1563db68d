"""millpond: retail lakehouse analytics expressed as Spark DataFrame jobs."""
