"""Manufacturing effectiveness, capability and alert analytics on Spark."""
