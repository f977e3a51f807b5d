"""Type-2 history: versions of a key with half-open validity ranges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.settle import settle
from tidemark.operators.timeline import Timeline, settled

# Fixed value: end of a version that is still valid.
OPEN_END = "2999-12-31 23:59:59"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def detect_changes(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    timeline: Timeline | None = None,
) -> DataFrame:
    """Rows whose state differs from the row before (NULL-safe), plus each key's first row."""
    changes, timeline = settled(changes, keys, order, timeline)
    seen = timeline.extend(
        timeline.attach(changes),
        previous={"_before": F.struct(*[F.col(c) for c in state])},
    )
    # a struct of state columns is never NULL itself, so NULL means "no row before"
    different = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col("_before")[c]) for c in state]
    )
    return seen.filter(F.col("_before").isNull() | different).drop("_before")


def build_history(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    deleted: str | None = None,
    timeline: Timeline | None = None,
) -> DataFrame:
    """Versions per key from a change feed.

    ``order`` starts with the change time and is total per key. Of several changes at one
    instant the last counts. ``deleted`` names a boolean column: such a row ends the running
    version and starts none. Other columns are those of the change that opened the version.
    Adds ``valid_from``, ``valid_to`` (``OPEN_END`` while valid) and ``is_current``.
    """
    at = order[0]
    changes, timeline = settled(changes, keys, order, timeline)
    sliced = timeline.cuts is not None  # every step then reads its rows twice
    changes = timeline.attach(changes)
    rows = timeline.extend(settle(changes, "changes", above=0) if sliced else changes, following={"_next": F.col(at)})
    last_of_instant = rows.filter(~F.col("_next").eqNullSafe(F.col(at))).drop("_next")
    if sliced:
        last_of_instant = settle(last_of_instant, "instants", above=0)
    compared = [*state, deleted] if deleted else list(state)
    versions = detect_changes(last_of_instant, keys, order, compared, timeline)
    if sliced:
        versions = settle(versions, "versions", above=0)
    ended = timeline.extend(versions, following={"_end": F.col(at)})
    if deleted:
        ended = ended.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
    return timeline.detach(
        ended.withColumns(
            {
                "valid_from": F.col(at),
                "valid_to": F.coalesce(F.col("_end"), open_end()),
                "is_current": F.col("_end").isNull(),
            }
        ).drop("_end")
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def range_faults(history: DataFrame, keys: Sequence[str], timeline: Timeline | None = None) -> DataFrame:
    """Versions that overlap the next one, leave a gap before it, or have no length."""
    history, timeline = settled(history, keys, ["valid_from", "valid_to"], timeline)
    ordered = timeline.extend(timeline.attach(history), following={"next_from": F.col("valid_from")})
    fault = (
        F.when(F.col("valid_to") <= F.col("valid_from"), F.lit("empty"))
        .when(F.col("next_from") < F.col("valid_to"), F.lit("overlap"))
        .when(F.col("next_from") > F.col("valid_to"), F.lit("gap"))
    )
    return timeline.detach(ordered.withColumn("fault", fault).filter("fault is not null"))
