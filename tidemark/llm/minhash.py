"""MinHash fingerprints, likeness to neighbours, and near-duplicate links.

A text's shingles (runs of ``SHINGLE_WORDS`` words) go through ``PERMUTATIONS`` multiply-shift
hashes; the least value under each, cut to 16 bits, is the fingerprint. The share of equal places
of two fingerprints estimates the Jaccard similarity of their shingle sets.

``near_links`` joins signature bands in Spark and verifies the exact Jaccard similarity. Texts with
equal shingle sets are one class. Within a band bucket every class is verified against the bucket's
first class; two classes near the first are connected through it and need no pair. Jaccard
distance is a metric, so a class further than twice the allowed distance from the first cannot be
near one that is near it. What remains is joined and verified.

Defined results: NULL text is empty; texts without words have one common fingerprint, alike only to
each other; fewer words than a shingle make one shingle; rows are ordered by id, NULL ids last,
rows of equal id by text; a lone document is its own successor; repeated rows are each their own
row; very long texts are hashed whole, in blocks; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.hashing import shingles, word_hashes
from tidemark.llm.tables import spread, stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
PERMUTATIONS = 128
# 21 bands of 6: a pair of similarity 0.8 shares a band with probability 0.998.
BANDS, BAND_ROWS = 21, 6
SEED = 2_024
_CHUNK = 16_384

_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def text_shingles(text: bytes | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    return shingles(word_hashes(text or b""), words)


def minima(hashes: np.ndarray) -> np.ndarray:
    """Least value under each permutation; all ones for no shingle."""
    least = np.full(PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint64)
    for start in range(0, len(hashes), _CHUNK):
        part = hashes[start : start + _CHUNK]
        for i in range(PERMUTATIONS):
            value = ((part * _FACTORS[i] + _OFFSETS[i]) >> np.uint64(32)).min()
            if value < least[i]:
                least[i] = value
    return least


def many_minima(texts: list[np.ndarray]) -> np.ndarray:
    """Minima of several shingle arrays, short ones together."""
    result = np.full((len(texts), PERMUTATIONS), 0xFFFFFFFF, dtype=np.uint64)
    pending: list[int] = []

    def flush() -> None:
        if pending:
            joined = np.concatenate([texts[i] for i in pending])
            at = np.cumsum([0] + [len(texts[i]) for i in pending[:-1]])
            for k in range(PERMUTATIONS):
                result[pending, k] = np.minimum.reduceat((joined * _FACTORS[k] + _OFFSETS[k]) >> np.uint64(32), at)
            pending.clear()

    waiting = 0
    for i, hashes in enumerate(texts):
        if len(hashes) > _CHUNK:
            result[i] = minima(hashes)
        elif len(hashes):
            pending.append(i)
            waiting += len(hashes)
            if waiting > _CHUNK:
                flush()
                waiting = 0
    flush()
    return result


def as_fingerprint(least: np.ndarray) -> np.ndarray:
    return (least & np.uint64(0xFFFF)).astype(">u2")


# ---------------------------------------------------------------- neighbours in id order


def _dealt(docs: DataFrame) -> DataFrame:
    """Rows with the id range they belong to; a range's first rows are guests of the range before.

    Cut points and first ids are as many as there are ranges, four to a shuffle partition.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0] or []
    # NULL ids share one last range beyond all cuts
    bounds = np.unique(np.array(cuts, dtype=np.int64))
    last = len(bounds) + 1

    @pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        values = ids.where(known, 0).astype("int64")
        return pd.Series(np.where(known, np.searchsorted(bounds, values, side="right"), last).astype("int32"))

    placed = docs.withColumn("_range", range_of("doc_id"))
    firsts = sorted(placed.groupBy("_range").agg(F.min("doc_id").alias("first")).collect(), key=lambda r: r["_range"])
    hosts: dict[int | None, int] = {
        row["first"]: firsts[i - 1]["_range"] for i, row in enumerate(firsts)  # the first of all goes to the last
    }

    @pandas_udf("array<int>")
    def homes(ids: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series(
            [[r, hosts[k]] if k in hosts else [r] for k, r in zip((None if pd.isna(i) else int(i) for i in ids), own)]
        )

    homed = placed.withColumn("_homes", homes("doc_id", "_range"))
    return homed.select("doc_id", "text", F.posexplode("_homes").alias("_guest", "_home"))


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and likeness to it and to the next text.

    Texts cross the network once, by id range.
    """
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = _dealt(whole).repartition("_home").sortWithinPartitions(
        "_home", "_guest", F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    )

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before: tuple | None = None  # (home, guest, doc_id, text)
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            found = list(zip(batch["_home"].tolist(), batch["_guest"].tolist(), ids, batch["text"]))
            if before is not None:
                found.insert(0, before)
            for start in range(0, len(found) - 1, 500):
                yield _described(found[start : start + 501])
            before = found[-1] if found else before

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return rows.select("_home", "_guest", "doc_id", "text").mapInPandas(compute, schema)


def _described(rows: list[tuple]) -> pd.DataFrame:
    """Results for all rows but the last that belong to their range."""
    own = [i for i in range(len(rows) - 1) if rows[i][1] == 0]
    edited = []
    for i in own:
        text, following = rows[i][3], rows[i + 1][3]
        cut = len(text) // 4
        edited.append((text[: len(text) - cut] + following[:cut]).encode("utf-8", "surrogatepass"))
    plain = as_fingerprint(many_minima([text_shingles(r[3].encode("utf-8", "surrogatepass")) for r in rows]))
    changed = as_fingerprint(many_minima([text_shingles(t) for t in edited])) if own else plain[:0]
    return pd.DataFrame(
        {
            "doc_id": pd.array([rows[i][2] for i in own], dtype="Int64"),
            "n_chars": np.array([len(rows[i][3]) for i in own], dtype=np.int64),
            "edited_sha256": [hashlib.sha256(t).hexdigest() for t in edited],
            "fingerprint": [plain[i].tobytes().hex() for i in own],
            "edited_fingerprint": [c.tobytes().hex() for c in changed],
            "near_edited": (plain[own] == changed).mean(axis=1) if own else np.empty(0),
            "near_next": (plain[own] == plain[[i + 1 for i in own]]).mean(axis=1) if own else np.empty(0),
        }
    )


# ---------------------------------------------------------------- near-duplicate links


def _classes(docs: DataFrame, words: int) -> DataFrame:
    """Per row: id, class (hash of the shingle set), the set and the bands."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start : start + 500]
                sets = [np.unique(text_shingles(t, words)) for t in part["text"]]
                prints = as_fingerprint(many_minima(sets))[:, : BANDS * BAND_ROWS].reshape(len(sets), BANDS, -1)
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "class": [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets],
                        "shingles": [s.view(np.int64) for s in sets],
                        "bands": [[b.tobytes().hex() for b in p] for p in prints],
                    }
                )

    whole = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = "doc_id long, class string, shingles array<bigint>, bands array<string>"
    return spread(whole).mapInPandas(compute, schema)


def near_links(docs: DataFrame, similarity: float = SIMILARITY, words: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(membership ``doc_id``, ``class``; links ``a``, ``b`` between classes) at the similarity or more.

    Links connect every pair of classes that share a band and are similar enough, through the
    first class of the bucket where both are near it. Texts without words have no link.
    """
    rows = stage(_classes(docs, words), "classes")
    members = rows.select("doc_id", "class")
    sets = rows.filter(F.size("shingles") > 0).dropDuplicates(["class"])
    sets = stage(sets.select("class", "shingles", "bands"), "class-sets")
    buckets = sets.select("class", F.posexplode("bands").alias("band", "value"))
    shared = buckets.groupBy("band", "value").agg(F.min("class").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # buckets with the same first class need its distances once
    pairs = buckets.join(shared, ["band", "value"]).filter("class <> first").select("class", "first").distinct()
    content = sets.select("class", "shingles")

    def alike(a, b):
        both = F.size(F.array_intersect(a, b))
        return both / (F.size(a) + F.size(b) - both)

    rated = pairs.join(content, "class").join(
        content.select(F.col("class").alias("first"), F.col("shingles").alias("_first")), "first"
    ).select("class", "first", alike(F.col("shingles"), F.col("_first")).alias("alike"))
    rated = stage(rated, "to-first")
    stars = rated.filter(F.col("alike") >= similarity).select(F.col("first").alias("a"), F.col("class").alias("b"))

    # the others: within reach of something near the first, or near each other
    placed = buckets.join(shared, ["band", "value"]).join(rated, ["class", "first"])
    reach = 1 - 2 * (1 - similarity)
    x, y = placed.alias("x"), placed.filter(F.col("alike") < similarity).alias("y")
    other = x.join(
        y,
        (F.col("x.band") == F.col("y.band"))
        & (F.col("x.value") == F.col("y.value"))
        & (F.col("x.class") != F.col("y.class"))
        & ((F.col("x.alike") < similarity) | (F.col("y.alike") >= reach))
        & ((F.col("x.alike") >= similarity) | (F.col("x.class") < F.col("y.class")))
        & (F.abs(F.col("x.alike") - F.col("y.alike")) <= 1 - similarity),
    ).select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
    checked = (
        other.join(content.select(F.col("class").alias("a"), F.col("shingles").alias("_a")), "a")
        .join(content.select(F.col("class").alias("b"), F.col("shingles").alias("_b")), "b")
        .filter(alike(F.col("_a"), F.col("_b")) >= similarity)
        .select("a", "b")
    )
    return members, stars.union(checked)
