"""Commerce event analytics written as Spark DataFrame transforms.

Every job, KPI and report is a plain function from DataFrames to a DataFrame, so the
same code runs in a batch, in Structured Streaming and in a test.
"""

__version__ = "0.1.0"
