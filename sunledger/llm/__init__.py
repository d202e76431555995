"""Training-data operators: filtering, deduplication, mixing, packing, search."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
