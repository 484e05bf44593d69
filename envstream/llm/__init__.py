"""Operations of a training-data pipeline: filtering, near-duplicates, tokens, search, packing, shards, pages."""

import sys

from pyspark import cloudpickle

# Functions for Python workers carry their code along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
