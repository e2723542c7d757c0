"""Operators of a training-data pipeline. Nothing else in the package imports this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, which need no copy of it then.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
