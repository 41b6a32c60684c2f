"""Training-data pipeline operators (mixing, PII, similarity joins, dedup,
packing, quality, secrets, fingerprints). Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so nothing has
# to be installed there beyond the public libraries.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
