"""Road-traffic count analytics on PySpark."""
