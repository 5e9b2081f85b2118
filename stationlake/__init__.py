"""stationlake: station-availability analytics on Spark (batch and Structured Streaming).

Modules: ``functions`` (column expressions), ``operators`` (DataFrame -> DataFrame
operators), ``sources`` (feeds, topic, day store, sinks), ``plans`` (join and job
planning), ``streaming`` (continuous ingest). See README.md and OPERATORS.md.
"""

__version__ = "0.1.0"
