"""kestrel: connection-log analytics as Spark DataFrame operators.

Every operator is a plain ``DataFrame -> DataFrame`` function built on the
public PySpark API (DataFrame, SQL, ML, Structured Streaming).  Labels, keys,
limits and seeds are arguments; nothing is hard-wired to one dataset.
"""

__version__ = "0.1.0"
