"""linewise: application-log lines, exchanges, trails, batches and redaction on Spark.

Everything is expressed over DataFrames; the sub-packages are

``functions``  column expressions (timestamps, references, JSON text, calls, redaction)
``operators``  DataFrame -> DataFrame steps (recover, compose, resolve, pair, trail, pack)
``sources``    readers and writers for line files, export records and push batches
``plans``      whole pipelines built from the operators
``streaming``  the same steps over Structured Streaming
"""

__version__ = "0.1.0"
