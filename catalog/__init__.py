"""Registered queries: every entry runs an operator over whole test tables.

Each module has a ``QUERIES`` dictionary of name -> (function of (spark, sf_dir), SQL or None);
the SQL computes the same result in DuckDB over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, tuple[Query, str | None]]:
    from catalog import evaluation, features, ingest, learning, plans, profile, quality, reports, sampling

    merged: dict[str, tuple[Query, str | None]] = {}
    for module in (ingest, quality, features, reports, profile, sampling, evaluation, learning, plans):
        clash = merged.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"query names registered twice: {sorted(clash)}")
        merged.update(module.QUERIES)
    return merged
