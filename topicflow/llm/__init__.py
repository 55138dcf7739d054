"""Training-data operators (LM scoring, quality, sharding, packing, near
duplicates, ...) on Spark.

Every operator is a function of DataFrames; ``queries.py`` holds the thin
registered queries.  Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it.

Functions that run inside tasks are pickled by value, so executors need
numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
