"""saleswh: a sales data warehouse written as Spark DataFrame jobs."""
