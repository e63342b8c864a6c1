"""PySpark-native analytics for avionics bus telemetry."""
