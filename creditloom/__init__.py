"""Credit-risk data work as Spark DataFrame operators."""
