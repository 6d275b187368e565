"""Keep finished column expressions.

The redaction of a turn is a column of some thousand nodes, and building one from
Python takes seconds of calls into the JVM. Columns are immutable, so the finished
one is kept and used again by later queries of the same application.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, wraps

from pyspark.sql import Column, SparkSession


def per_application(build: Callable[..., Column]) -> Callable[..., Column]:
    """Memoize a function from hashable arguments to a column."""

    @lru_cache(maxsize=256)
    def kept(application: str, *args) -> Column:
        return build(*args)

    @wraps(build)
    def call(*args) -> Column:
        return kept(SparkSession.active().sparkContext.applicationId, *args)

    return call
