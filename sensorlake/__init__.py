"""sensorlake: a Spark-native lakehouse for industrial sensor readings.

Operators are plain functions ``DataFrame -> DataFrame`` built from Spark's
own DataFrame / SQL / Structured Streaming operators.  Sources and sinks
sit at the edge (``sensorlake.sources``, ``sensorlake.sinks``); batch and
streaming jobs compose them (``sensorlake.plans``, ``sensorlake.streaming``).
"""

__version__ = "0.1.0"
