"""Operators on text corpora: scoring, cleaning, near duplicates, archives, search, packing."""

import sys

from pyspark import cloudpickle

# What runs inside tasks travels with the job: executors need pyarrow and numpy, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
