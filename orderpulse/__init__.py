"""Order-level customer-satisfaction analytics as Spark DataFrame operators."""
