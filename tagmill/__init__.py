"""Tag distillation and relation analytics on Spark."""
