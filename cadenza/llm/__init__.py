"""Training-data operators: deduplication, classifiers, scans, tokens, shards.

Each module holds one operator with a general interface; ``queries`` holds the
thin registered queries and their SQL.  Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# functions for tasks travel by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
