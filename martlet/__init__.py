"""martlet: governed commerce analytics as PySpark DataFrame programs.

Layers: ``sources`` (schemas, driver-table adapter, ingest/sinks),
``operators`` (staging, marts, consumers, features, quality, contracts,
skew-safe ordered operators), ``plans`` (model graph, metric layer,
questions, builds, registered queries), ``streaming`` (medallion streams),
``functions`` (shared column helpers).
"""

__version__ = "0.1.0"
