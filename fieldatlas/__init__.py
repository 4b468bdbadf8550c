"""fieldatlas: nested and geographic document analytics on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns) and is built
from Spark SQL expressions, joins and aggregations, so Catalyst plans it and
the work is distributed by Spark.
"""

__version__ = "0.1.0"
