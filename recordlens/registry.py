"""Registry of named queries: key -> callable(spark, sf_dir) -> DataFrame.

Every registered query reads the driver's test tables through the fixture
views, so its work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordlens.sources.fixture_views import FixtureViews, fixture_views

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(key: str):
    """Register ``fn(views: FixtureViews) -> DataFrame`` under ``key``."""
    def deco(fn: Callable[[FixtureViews], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(fixture_views(spark, sf_dir))
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return fn
    return deco


def load_all() -> dict[str, QueryFn]:
    # Importing the modules registers their queries.
    from recordlens import queries  # noqa: F401
    return dict(QUERIES)
