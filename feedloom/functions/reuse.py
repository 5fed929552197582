"""Building large expressions once.

A stream plans every micro-batch anew.  Building the parser's expressions takes
thousands of calls into the JVM, so each is built once per Spark context and
used again; expressions are immutable.
"""

from __future__ import annotations

import functools
import weakref
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column

_built: weakref.WeakKeyDictionary[SparkContext, dict] = weakref.WeakKeyDictionary()


def reused(build: Callable[..., Column]) -> Callable[..., Column]:
    """For builders whose arguments are column names."""

    @functools.wraps(build)
    def get(*names: str) -> Column:
        context = SparkContext.getOrCreate()
        known = _built.setdefault(context, {})
        key = (build.__module__, build.__name__, names)
        if key not in known:
            known[key] = build(*names)
        return known[key]

    return get
