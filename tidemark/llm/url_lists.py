"""URL filters by a temporal list join.

Filter lists change: a pattern is added on one day and removed on another. ``validity`` turns dated
entries into intervals of one pattern and list; ``evaluate`` looks up every capture among the
entries that were active when it was fetched, not among those of today.

A pattern is a host with or without its first path segments (``b.example.org/en``); it covers the
host, the hosts below it, and the paths below it. A capture has one key for every pair of label and
segment counts that some pattern has and that its host and path reach, so every pattern can match.
Intervals are cut at months, and captures meet them on (key, month): all intervals of a pattern in
a month are one row, so a host with a third of all captures meets one row each time, in a join that
adaptive execution can split, and never all versions of its pattern.

Of several active entries the longest pattern decides, then the latest listing, then the smallest
list name. Everything is DataFrame functions; no Python runs in a task.

Defined results: captures with NULL or unreadable URL or NULL time match nothing (verdict ``none``);
an addition of what is listed already starts a new interval with its own verdict; a removal of what
is not listed does nothing; several entries of one pattern, list and time count as the last by
(action, verdict), so an addition does not survive a removal of the same time; repeated captures
are each evaluated; entries with NULL in pattern, list, action or time are ignored; without entries
every verdict is ``none``; extra columns of captures are kept unless their names are those of the
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.tables import stage, unused

ADD, REMOVE = "add", "remove"
RESULT = ("verdict", "list_name", "pattern", "listed_at")


def plain_host(url: Column) -> Column:
    """Lower-case host without credentials, port or final dot; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def plain_pattern(pattern: Column) -> Column:
    """Pattern with a lower-case host; paths keep their case."""
    return F.concat(F.lower(F.regexp_extract(pattern, "^[^/]*", 0)), F.regexp_extract(pattern, r"(?s)^[^/]*(/.*)?$", 1))


def depths_of(patterns: DataFrame) -> list[tuple[int, int]]:
    """The pairs of host labels and path segments that patterns have; as many as there are shapes of patterns."""
    parts = F.split("pattern", "/")
    shapes = patterns.select(F.size(F.split(parts[0], r"\.")).alias("labels"), (F.size(parts) - 1).alias("segments"))
    return sorted((r["labels"], r["segments"]) for r in shapes.distinct().collect())


def keys_of(url: Column, depths: list[tuple[int, int]]) -> Column:
    """All patterns of these depths that would cover a URL: last labels of its host with first segments of its path."""
    labels = F.split(plain_host(url), r"\.")
    path = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    segments = F.array_remove(F.split(path, "/"), "")
    none = F.array().cast("array<string>")
    if not depths:
        return none

    def keys(labels: Column, segments: Column) -> Column:
        pairs = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("segments")) for n, m in depths])
        fit = F.filter(pairs, lambda d: (d["labels"] <= F.size(labels)) & (d["segments"] <= F.size(segments)))
        host = lambda d: F.array_join(F.slice(labels, F.size(labels) - d["labels"] + 1, d["labels"]), ".")
        tail = lambda d: F.array_join(F.slice(segments, F.lit(1), d["segments"]), "/")
        return F.transform(fit, lambda d: F.concat(host(d), F.when(d["segments"] > 0, "/").otherwise(""), tail(d)))

    # split once, not once a key
    split = F.array(F.struct(labels.alias("labels"), segments.alias("segments")))
    found = F.transform(split, lambda x: keys(x["labels"], x["segments"]))[0]
    return F.when(plain_host(url) != "", found).otherwise(none)


def validity(entries: DataFrame) -> DataFrame:
    """Intervals ``[listed_at, until)`` from ``list_name``, ``pattern``, ``action``, ``verdict``, ``listed_at``."""
    known = entries.select("list_name", plain_pattern(F.col("pattern")).alias("pattern"), "action", "verdict", "listed_at").dropna(
        subset=["list_name", "pattern", "action", "listed_at"]
    )
    at_once = (
        known.groupBy("list_name", "pattern", "listed_at")
        .agg(F.max(F.struct("action", "verdict")).alias("_last"))
        .select("list_name", "pattern", "listed_at", "_last.action", "_last.verdict")
    )
    order = Window.partitionBy("list_name", "pattern").orderBy("listed_at")
    return at_once.withColumn("until", F.lead("listed_at").over(order)).filter(F.col("action") == ADD).drop("action")


def by_month(intervals: DataFrame, last: Column) -> DataFrame:
    """One row per pattern and month with all its intervals there. Open intervals end at ``last``."""
    end = F.coalesce("until", F.date_add(last, 1).cast("timestamp"))
    months = F.sequence(F.trunc("listed_at", "MM"), F.trunc(F.greatest(end, F.col("listed_at")), "MM"), F.expr("interval 1 month"))
    return (
        intervals.select("*", F.explode(months).alias("month"))
        .groupBy("pattern", "month")
        .agg(F.collect_list(F.struct("listed_at", "until", "list_name", "verdict")).alias("active"))
    )


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """Adds ``verdict`` (``none`` if nothing was active), ``list_name``, ``pattern`` and ``listed_at``."""
    kept = [F.col(f"`{c}`") for c in captures.columns if c not in RESULT]
    time = unused(captures, "_time")
    rows = captures.select(*kept).withColumn(time, F.col(f"`{fetched}`").cast("timestamp"))
    # open intervals need no month beyond the last capture
    last = rows.agg(F.max(time).cast("date").alias("last")).first()["last"]
    # written once, so that both sides of the joins come from plain exchanges that can be split
    listed = stage(by_month(validity(entries), F.lit(last).cast("date")), "listed")
    depths = depths_of(listed)
    asked = (
        rows.select(F.col(f"`{url}`").alias("_url"), F.col(time).alias("_at"))
        .filter("_at is not null")
        .distinct()
        .select("_url", "_at", F.explode(keys_of(F.col("_url"), depths)).alias("pattern"), F.trunc("_at", "MM").alias("month"))
    )
    found = asked.join(listed, ["pattern", "month"]).select(
        "_url",
        "_at",
        "pattern",
        F.filter(
            "active", lambda e: (e["listed_at"] <= F.col("_at")) & (e["until"].isNull() | (F.col("_at") < e["until"]))
        ).alias("active"),
    )
    # of equals the smallest list name: its rank counts backwards
    best = F.max_by(
        F.struct("_e.verdict", "_e.list_name", "pattern", "_e.listed_at"),
        F.struct(F.length("pattern"), F.col("_e.listed_at"), -F.col("_rank"), F.coalesce("_e.verdict", F.lit(""))),
    )
    ranks = Window.partitionBy("_url", "_at", "pattern").orderBy("_e.list_name")
    active = found.select("_url", "_at", "pattern", F.explode("active").alias("_e"))
    decided = active.withColumn("_rank", F.dense_rank().over(ranks)).groupBy("_url", "_at").agg(best.alias("_best"))
    decided = stage(decided, "decided")
    asked_url, asked_at, entry = unused(rows, "_url"), unused(rows, "_at"), unused(rows, "_best")
    decided = decided.withColumnsRenamed({"_url": asked_url, "_at": asked_at, "_best": entry})
    joined = rows.join(decided, (F.col(f"`{time}`") == F.col(asked_at)) & (F.col(f"`{url}`") == F.col(asked_url)), "left")
    found_entry = F.col(entry)
    return joined.select(
        *kept,
        F.coalesce(found_entry["verdict"], F.lit("none")).alias("verdict"),
        found_entry["list_name"].alias("list_name"),
        found_entry["pattern"].alias("pattern"),
        found_entry["listed_at"].alias("listed_at"),
    )
