"""Plan, compose and account for large batch-scoring campaigns on Spark."""
