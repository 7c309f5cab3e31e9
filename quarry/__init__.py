"""quarry: batch analytics operators on the PySpark DataFrame API.

Subpackages
-----------
sources    readers and writers (text lines, quote-aware split, CSV samples,
           keyed/sorted text, confusion-matrix CSV)
functions  column expressions (date keys, strict integer parse, growth,
           formatting, squared distance)
operators  DataFrame -> DataFrame operators (observation analytics, exact
           KNN, MLlib classifiers and folds, evaluation)
plans      driver-table fixtures and the registered queries with their SQL
           equivalents
"""

__version__ = "0.1.0"
