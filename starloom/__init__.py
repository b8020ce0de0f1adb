"""starloom: a Spark-native order warehouse and order-stream analytics library.

Layers: ``sources`` (test tables, landing, stream readers and sinks),
``functions`` (Column helpers), ``operators`` (SCD2, as-of join, incremental
loads, skew handling, quality checks), ``plans`` (the model graph and the
registered queries) and ``streaming`` (the windowed order-metrics job).
"""

__version__ = "0.1.0"
