"""corpusmill: teachable document search, typed-table learning and text tagging on Spark.

Every operator takes and returns DataFrames; models are small dataclasses that
hold DataFrames.  Nothing is collected to the driver except bounded scalars
(row counts, corpus size, average length).
"""

__all__ = ["session"]
