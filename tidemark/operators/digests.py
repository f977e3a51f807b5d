"""Differences between two large states, found from digests of buckets.

A state's rows fall into buckets by a hash of their key. A bucket's digest is its number of rows and
two sums of row hashes, whatever the order of the rows. Buckets of equal digests hold equal rows (but
for a collision of 128 bits), so only rows of buckets that differ are joined. Digests have two
levels: fine buckets are compared only where the coarse ones that hold them differ. A digest table
is small and can be kept beside its state, so that a state that did not change is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.changes import state_difference
from tidemark.operators.settle import settle
from tidemark.operators.sizing import broadcast_if_small

COARSE = 1_024
FINE = 1_024  # of each coarse bucket


def _values(columns: Sequence[str]) -> list[Column]:
    """Columns with their null flags, as hashes pass over NULLs."""
    return [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]


def with_buckets(state: DataFrame, keys: Sequence[str], coarse: int = COARSE, fine: int = FINE) -> DataFrame:
    """Rows with the numbers of their buckets, ``_coarse`` and ``_fine``."""
    place = F.pmod(F.xxhash64(*_values(keys)), F.lit(coarse * fine))
    return state.withColumns({"_coarse": (place % coarse).cast("int"), "_fine": F.floor(place / F.lit(coarse)).cast("int")})


def digests(
    state: DataFrame, keys: Sequence[str], columns: Sequence[str], coarse: int = COARSE, fine: int = FINE
) -> DataFrame:
    """``_coarse``, ``_fine``, ``rows``, ``low``, ``high`` of every fine bucket that has rows."""
    values = _values([*keys, *columns])

    def total(salt: int) -> Column:
        return F.sum(F.xxhash64(F.lit(salt), *values).cast("decimal(20,0)"))

    return with_buckets(state, keys, coarse, fine).groupBy("_coarse", "_fine").agg(
        F.count(F.lit(1)).alias("rows"), total(1).cast("decimal(38,0)").alias("low"), total(2).cast("decimal(38,0)").alias("high")
    )


def _differing(before: DataFrame, after: DataFrame, buckets: Sequence[str]) -> DataFrame:
    """Buckets whose digests are not equal, those that only one side has included."""
    digest = F.struct("rows", "low", "high")
    old, new = (side.select(*buckets, digest.alias(name)) for side, name in ((before, "old"), (after, "new")))
    both = old.join(new, list(buckets), "full")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(*buckets)


def differing_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Fine buckets of two digest tables that differ; fine digests are joined only where coarse ones differ."""

    def coarse(side: DataFrame) -> DataFrame:
        return side.groupBy("_coarse").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("rows", "low", "high")])

    top = broadcast_if_small(settle(_differing(coarse(before), coarse(after), ["_coarse"]), "coarse-buckets", above=0))
    return _differing(*(side.join(top, "_coarse", "left_semi") for side in (before, after)), ["_coarse", "_fine"])


def rows_to_compare(
    state: DataFrame, buckets: DataFrame, keys: Sequence[str], coarse: int = COARSE, fine: int = FINE
) -> DataFrame:
    """Rows of a state that lie in the given buckets."""
    rows = with_buckets(state, keys, coarse, fine).join(broadcast_if_small(buckets), ["_coarse", "_fine"], "left_semi")
    return rows.drop("_coarse", "_fine")


def difference_by_digests(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    old_digests: DataFrame | None = None,
    new_digests: DataFrame | None = None,
    coarse: int = COARSE,
    fine: int = FINE,
) -> DataFrame:
    """:func:`~tidemark.operators.changes.state_difference`, joining rows of differing buckets only.

    Kept digests of either state are used if they are given.
    """
    old = digests(before, keys, columns, coarse, fine) if old_digests is None else old_digests
    new = digests(after, keys, columns, coarse, fine) if new_digests is None else new_digests
    old, new = settle(old, "old-digests", above=0), settle(new, "new-digests", above=0)
    buckets = settle(differing_buckets(old, new), "buckets", above=0)
    some = [rows_to_compare(side, buckets, keys, coarse, fine) for side in (before, after)]
    return state_difference(*some, keys, columns)
