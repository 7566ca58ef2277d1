"""Word-embedding analytics on Spark: corpus to vectors, alignment, bias tests, metric tables.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or Column).
"""

import sys

from pyspark import cloudpickle

# Arrow task functions live in this package; ship them by value so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
