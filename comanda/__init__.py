"""Restaurant and retail operations analytics as Spark jobs."""
