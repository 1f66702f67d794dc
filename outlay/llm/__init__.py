"""Training-data pipeline operators (quality, chat format, dedup, mixing, scoring, sharding, packing, WARC).

Nothing outside this subpackage imports it; ``queries`` registers one query
per operator and ``corpus_pipeline.py`` chains five of them.
"""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions by value, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
