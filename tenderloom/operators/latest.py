"""One row per key: redelivered rows and older versions removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the row of each ``key`` that is last by ``order``.

    The rows are combined map-side (``max`` over one struct), so a key that
    holds a third of all rows costs one row per task in the shuffle. Null keys
    are dropped; a null in ``order`` sorts first; rows tied on ``order`` are
    told apart by the kept values themselves, so the result does not depend on
    the order of rows. An empty input gives an empty result.
    """
    rest = [c for c in keep if c != key]
    best = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"_k{i}") for i, c in enumerate(rest)]))
    rows = df.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_best"))
    return rows.select(key, *[F.col(f"_best._k{i}").alias(c) for i, c in enumerate(rest)]).select(*keep)


def latest_requirements(requirements: DataFrame, keep: list[str]) -> DataFrame:
    """The valid row of each requirement ``id``: the one with the latest ``updated_at``."""
    return latest(requirements, "id", ["updated_at"], keep)
