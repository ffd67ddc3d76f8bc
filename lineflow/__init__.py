"""lineflow: line-telemetry analytics as Spark DataFrame transforms."""
