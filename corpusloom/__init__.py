"""corpusloom: a Spark-native engine that builds and audits conversational training corpora.

Everything is a lazy DataFrame plan. Sub-packages: ``sources`` (scans and sinks),
``functions`` (column expressions), ``operators`` (relational and order-sensitive
operators), ``plans`` (gate and render pipelines), ``streaming`` (Structured
Streaming variants) and the optional ``llm`` (training-text operators).
"""

__version__ = "0.1.0"
