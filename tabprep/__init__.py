"""tabprep: Spark-native cleaning, data-quality, feature and model jobs for
dirty all-string census-style tables.

Subpackages
-----------
functions  Column -> Column expressions (cleaners, feature expressions)
operators  DataFrame -> DataFrame operators (schema, quality, dedup, prep, evaluate)
sources    readers, writers, catalog helpers and the SQL test fixtures
plans      composed jobs: curate (clean + DQ + publish), train, score
streaming  micro-batch scoring with Structured Streaming
"""

__version__ = "0.1.0"
