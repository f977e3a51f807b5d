"""Ordered computations per key that survive hot keys and hot instants.

Previous row, next row, last known value and running sum all need the rows of a key in
order. A plain window gives one key to one task, which fails when one key holds a large
share of the table. A :class:`Timeline` looks at the key sizes first:

* no key above ``rows_per_task``: plain windows, one shuffle, one sort;
* otherwise all rows are range-partitioned by keys and the *full* order into slices of about that
  size, wherever a key or an instant ends, and written once with their slice number. Windows run
  per (key, slice); each slice that shares a key with its neighbours is summed up in one row, an
  exclusive scan over these rows tells what comes before (or after) it, and that is joined back.
  No row is dropped or approximated: where the ranges are cut decides nothing but their sizes.

Keys that lie in one slice whole need no carry; they have slice number ``WHOLE``. Only the first and
last key of a slice can be in another one, so there are at most two summary rows per slice, and the
number of slices is bounded (``MAX_SLICES``). What slices hand on is written and broadcast only where
its size allows. Only rows that are equal in keys and order cannot be parted; orders here are total.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.settle import settle
from tidemark.operators.sizing import ONE_TASK_BYTES, broadcast_if_small, input_bytes

ROWS_PER_TASK = 4_000_000
MAX_SLICES = 10_000

SLICE = "_slice"
WHOLE = -1


def _null_safe_match(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _wrap(value: Column) -> Column:
    return F.struct(value.alias("v"))


@dataclass(frozen=True)
class Timeline:
    """Rows of each key (``keys``) in the total order of ``order`` (ascending, NULLs first)."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: int | None = None  # number of slices, where they are in use

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        rows_per_task: int | None = None,
    ) -> "Timeline":
        """Choose plain windows or slices by the size of the largest key.

        Input that fits one task needs no look at its keys. ``rows_per_task`` forces the look.
        """
        keys, order = tuple(keys), tuple(order)
        kind = df.schema[order[0]].dataType  # refused at every size
        if isinstance(kind, (T.ArrayType, T.MapType, T.VariantType)):
            raise TypeError(f"cannot slice along a column of type {kind.simpleString()}")
        if rows_per_task is None and input_bytes(df) <= ONE_TASK_BYTES:
            return cls(keys, order)
        limit = rows_per_task or ROWS_PER_TASK
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        total, largest = sizes.agg(F.sum("_rows"), F.max("_rows")).first()
        if total is None or largest <= limit:
            return cls(keys, order)
        return cls(keys, order, min(MAX_SLICES, -(-total // limit)))

    @property
    def partition_columns(self) -> tuple[str, ...]:
        return self.keys + ((SLICE,) if self.cuts is not None else ())

    def _order(self) -> list[Column]:
        return [F.col(c).asc_nulls_first() for c in self.order]

    def window(self):
        return Window.partitionBy(*self.partition_columns).orderBy(*self._order())

    def attach(self, df: DataFrame) -> DataFrame:
        """Rows with their slice, written once so that every later pass sees the same slices."""
        if self.cuts is None or SLICE in df.columns:
            return df
        along = [F.col(c).asc_nulls_first() for c in (*self.keys, *self.order)]
        ranged = df.repartitionByRange(self.cuts, *along).withColumn(SLICE, F.spark_partition_id().cast("bigint"))
        ranged = settle(ranged, "slices", above=0)
        # keys that go on from one slice to the next: the last of one is the first of the next
        key = F.struct(*self.keys)
        ends = ranged.groupBy(SLICE).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
        ends = ends.withColumn("_before", F.lag("_last").over(Window.orderBy(SLICE)))  # one row a slice
        shared = ends.filter(F.col("_first").eqNullSafe(F.col("_before"))).select("_first.*").distinct()
        shared = settle(shared.select(*[F.col(k).alias("_of_" + k) for k in self.keys]), "shared-keys", above=0)
        marked = ranged.join(
            broadcast_if_small(shared.withColumn("_goes_on", F.lit(True))), _null_safe_match(self.keys, "_of_"), "left"
        )
        return marked.withColumn(SLICE, F.when(F.col("_goes_on"), F.col(SLICE)).otherwise(F.lit(WHOLE).cast("bigint"))).drop(
            "_goes_on", *["_of_" + k for k in self.keys]
        )

    def detach(self, df: DataFrame) -> DataFrame:
        return df.drop(SLICE)

    def extend(
        self,
        df: DataFrame,
        *,
        previous: Mapping[str, Column] | None = None,
        following: Mapping[str, Column] | None = None,
        known: Mapping[str, tuple[Column, Column]] | None = None,
        running: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Add columns computed along the timeline.

        ``previous`` / ``following``: the value at the row before / after, NULL at the ends.
        ``known``: (value, present) - the value at the latest row, this one included, where
        ``present`` holds; the value itself may be NULL.
        ``running``: sum of the value up to and including this row.

        With slices ``df`` is read twice, so write it first where it is costly.
        """
        previous, following = dict(previous or {}), dict(following or {})
        known, running = dict(known or {}), dict(running or {})
        window = self.window()
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if self.cuts is None:
            return df.withColumns(
                {
                    **{n: F.lag(v).over(window) for n, v in previous.items()},
                    **{n: F.lead(v).over(window) for n, v in following.items()},
                    **{
                        n: F.last(F.when(p, _wrap(v)), ignorenulls=True).over(so_far)["v"]
                        for n, (v, p) in known.items()
                    },
                    **{n: F.sum(v).over(so_far) for n, v in running.items()},
                }
            )

        df = self.attach(df)
        local = df.withColumns(
            {
                **{n: F.lag(_wrap(v)).over(window) for n, v in previous.items()},
                **{n: F.lead(_wrap(v)).over(window) for n, v in following.items()},
                **{
                    n: F.last(F.when(p, _wrap(v)), ignorenulls=True).over(so_far)
                    for n, (v, p) in known.items()
                },
                **{n: F.sum(v).over(so_far) for n, v in running.items()},
            }
        )
        handed = self._handed_over(df, previous, following, known, running)
        joined = local.join(
            broadcast_if_small(settle(handed, "handed-over", above=0)), _null_safe_match(self.partition_columns, "_from_"), "left"
        )
        merged: dict[str, Column] = {}
        for name in [*previous, *following, *known]:
            merged[name] = F.coalesce(F.col(name), F.col("_carry_" + name))["v"]
        for name in running:
            here, before = F.col(name), F.col("_carry_" + name)
            total = F.when(here.isNull(), before).when(before.isNull(), here).otherwise(here + before)
            merged[name] = total.cast(local.schema[name].dataType)
        carried = [c for c in handed.columns]
        return joined.withColumns(merged).drop(*carried)

    def _handed_over(self, df, previous, following, known, running) -> DataFrame:
        """One row per key and slice of a key in several slices: what comes to it from the others."""
        place = F.struct(*[F.col(c) for c in self.order])
        aggregates = [F.max_by(_wrap(v), place).alias("_tail_" + n) for n, v in previous.items()]
        aggregates += [F.min_by(_wrap(v), place).alias("_head_" + n) for n, v in following.items()]
        aggregates += [
            F.max_by(F.when(p, _wrap(v)), F.when(p, place)).alias("_known_" + n) for n, (v, p) in known.items()
        ]
        aggregates += [F.sum(v).alias("_sum_" + n) for n, v in running.items()]
        slices = df.filter(F.col(SLICE) > WHOLE).groupBy(*self.partition_columns).agg(*aggregates)
        along = Window.partitionBy(*self.keys).orderBy(SLICE)
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        carries = [F.lag("_tail_" + n).over(along).alias("_carry_" + n) for n in previous]
        carries += [F.lead("_head_" + n).over(along).alias("_carry_" + n) for n in following]
        carries += [F.last("_known_" + n, ignorenulls=True).over(before).alias("_carry_" + n) for n in known]
        carries += [F.sum("_sum_" + n).over(before).alias("_carry_" + n) for n in running]
        return slices.select(*[F.col(c).alias("_from_" + c) for c in self.partition_columns], *carries)


def settled(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], timeline: Timeline | None = None
) -> tuple[DataFrame, Timeline]:
    """Rows and their timeline. Without a timeline given, large rows are written first, as key
    sizes, cut points and the windows read them in passes of their own."""
    if timeline is not None:
        return df, timeline
    df = settle(df, "timeline")
    return df, Timeline.of(df, keys, order)
