"""Message capture, transaction resolution and delivery as Spark DataFrame operators."""
