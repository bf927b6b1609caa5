"""Analytics jobs expressed as Spark DataFrame, SQL, MLlib and streaming code."""
