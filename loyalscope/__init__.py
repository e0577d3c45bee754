"""Customer-churn analytics as lazy Spark DataFrame plans."""
