"""Registry of named queries over the shared test tables, each with its DuckDB oracle SQL.

A query builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame. ``sql=None`` marks an
operator that plain SQL cannot express (models, per-series solves); those get unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tally.session import ship_package
from tally.sources.io import Tables

Builder = Callable[[Tables], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn: Builder):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # dates in this library are calendar dates; fix the session zone so LTZ casts agree
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so their registrations run."""
    from tally.plans import (  # noqa: F401
        q_clean,
        q_segments,
        q_profile,
        q_dims,
        q_promo,
        q_ts,
        q_long,
        q_forecast,
        q_ml,
        q_ward,
        q_regress,
        q_trend,
        q_ranges,
        q_training,
        q_io,
        q_wide,
        q_planted,
    )
