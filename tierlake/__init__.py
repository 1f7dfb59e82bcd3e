"""tierlake: raw -> clean -> business-ready event tables on Spark.

Every operator is a function from DataFrames to DataFrames; the table jobs
around them (staged overwrite, compaction, layout, delete by key, change
feed, load history) are ordinary Spark jobs in ``tierlake.plans``.
"""

__version__ = "0.1.0"
