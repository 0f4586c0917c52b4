"""helixspark: genomics and biology table jobs on Spark DataFrames.

Sub packages:
  sources    readers that turn text formats (VCF, FASTA, GTF, sheets, ...) into DataFrames
  functions  Column -> Column helpers (built-in Spark expressions only)
  operators  DataFrame -> DataFrame jobs (joins, grouping, windows)
  plans      fixture views over the driver tables and the query registry
  streaming  Structured Streaming jobs
"""

__version__ = "0.1.0"
