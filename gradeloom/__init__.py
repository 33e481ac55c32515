"""gradeloom: a Spark-native engine for rubric-graded text corpora.

Everything is a ``DataFrame -> DataFrame`` function.  Sub-packages:

* ``sources``    readers and writers (JSON, JSONL, Parquet, versioned tables)
* ``functions``  column expressions shared by the operators
* ``operators``  validation, linking, splitting, quotas, metrics, nesting
* ``plans``      registered queries with their SQL twins
* ``streaming``  Structured Streaming variants (an extension)
* ``llm``        optional operators for training data; nothing imports it
"""

__version__ = "0.1.0"
