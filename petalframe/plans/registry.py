"""Registry of named queries over the test tables, each with its oracle SQL."""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; ``sql`` is the DuckDB oracle."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark, sf_dir):
            # the queries rely on the UTC session zone and AQE, whoever built the session
            from petalframe.session import prepare

            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap
