"""Operators that prepare training text: mixing, decontamination, deduplication, scoring, filtering, archives."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
