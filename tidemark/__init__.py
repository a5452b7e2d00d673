"""tidemark: issue-backlog analytics as Spark plans.

Layers: ``sources`` (readers, landing, storage), ``functions`` (column
expressions), ``operators`` (generic DataFrame operators), ``plans`` (silver
merge, gold marts, quality checks, metric queries, pipeline) and ``streaming``
(incremental variants on Structured Streaming).
"""

__version__ = "0.1.0"
