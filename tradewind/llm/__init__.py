"""Operators for training-data pipelines.

The functions that run inside tasks travel to the executors with the query (pickled by value), so a
cluster needs the libraries they call, not this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
