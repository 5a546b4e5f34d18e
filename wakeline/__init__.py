"""wakeline: fleet telemetry and mission reporting as Spark DataFrame operators."""
