"""Operators for preparing training data.

Nothing else in the library imports this package.  Functions that run in tasks
are pickled by value, so executors need no installed copy of it.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
