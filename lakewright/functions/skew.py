"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def sorted_join(many: DataFrame, few: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """Equi-join by sorting both sides, never by broadcasting ``few``.

    Spark guesses the size of computed or repeated rows from the compressed file they
    come from, and would gather millions of them in the driver. A hot key's partition is
    split by adaptive execution.
    """
    return many.join(few.hint("merge"), on, how)


def salted_join(
    many: DataFrame,
    few: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: list[str] | None = None,
    salts: int = 16,
) -> DataFrame:
    """Equi-join ``many`` with ``few`` (unique per key) on ``on`` plus a salt.

    The rows of one hot key of ``many`` land in up to ``salts`` tasks; ``few``
    is repeated ``salts`` times, so it must be the side with one row per key.
    Neither side is broadcast: see :func:`sorted_join`.
    ``spread_by`` names the columns of ``many`` whose hash picks the salt.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how!r}")
    spread = spread_by or [c for c in many.columns if c not in on] or on
    salted = many.withColumn(_SALT, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = few.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return sorted_join(salted, repeated, [*on, _SALT], how).drop(_SALT)
