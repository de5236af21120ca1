"""Ad-traffic analytics as PySpark DataFrame and Structured Streaming operators."""
