"""sensorlake package."""
