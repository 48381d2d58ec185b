"""sensorlake: a Spark-native library for environmental sensor readings.

Layers: ``sources`` (archive CSV, message bus, API JSON), ``operators`` (reshape, dedup, joins,
upsert), ``plans`` (bronze/silver/gold/dashboard products), ``streaming`` (stream starters and
live queries), ``functions`` (column expressions), ``tables`` (writes).
"""

__version__ = "0.1.0"
