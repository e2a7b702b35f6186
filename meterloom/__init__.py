"""Energy-metering analytics as Spark DataFrame operators."""
