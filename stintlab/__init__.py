"""Per-lap race telemetry analytics as composable Spark DataFrame operators."""
