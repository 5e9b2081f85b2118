"""Operators of a training-data pipeline (license scans, quality, dedup, scoring, output).

Nothing else in the library imports this package. Its functions are shipped inside the
tasks (pickled by value), so Python workers need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
