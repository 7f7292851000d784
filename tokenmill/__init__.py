"""tokenmill: corpus-to-training-data jobs on Spark DataFrames.

Cleaning and splitting text, word and pair statistics, byte-level BPE
training as iterative Spark rounds, corpus encode/decode, next-token
windows and embedding-table jobs. Public API is plain functions of
DataFrames and Columns.
"""

__version__ = "0.1.0"
