"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it.
Documents whose fingerprints differ in at most ``TOLERANCE`` bits are linked, and linked documents
form components. Links are found exactly:

* Equal fingerprints are one node; a text copied a million times costs one row from there on.
* **Grouping.** Pair counts of all bits over all fingerprints (2,080 numbers) tell which bits are
  correlated. Those go into the same part, so that other parts stay selective.
* **Thresholds.** If the parts' thresholds sum to ``TOLERANCE - parts + 1``, two fingerprints within
  the tolerance agree within the threshold in some part. A dynamic program allocates unequal
  thresholds (-1 leaves a part out) from estimated numbers of probes and candidates, for two to
  five parts; the cheapest layout wins. More fingerprints make it choose longer keys.
* **Probe and verify.** Every fingerprint is indexed under its parts, probes all keys within the
  thresholds, and candidates are verified inside the join.
* **Hot keys.** (components) A key of more than ``HOT_KEY`` fingerprints is not joined, as that is quadratic.
  Two fingerprints within 4 bits share a point within 2 bits of both, and any two that share such
  a point are within 4 bits: rows at hot keys emit those points (2,081 each) and are linked to the
  smallest fingerprint at each point. Exact, linear, and no pairs.

:func:`keep_one` verifies a similarity before a document goes. Texts at Jaccard 0.8 of five-word
shingles differ in some ten of 64 bits of a five-word fingerprint and in six of a two-word one, which
still tells unrelated texts apart. So fingerprints of ``NEAR_WORDS`` words choose the texts that have a
neighbour within ``NEAR_TOLERANCE`` bits (a semi join: no pairs are made, and what stands at a hot key
goes on unseen). Among those the exact Jaccard of ``VERIFIED_WORDS``-word sets, ``VERIFIED_PERCENT`` or
more, decides which are one group.

Defined results: NULL or empty text and text without words have fingerprint zero and are linked
with each other and with fingerprints near zero; fewer words than a shingle make one shingle;
repeated rows get the same component; rows without id are fingerprinted, but name no component
(:func:`keep_one` keeps them and takes all texts without words as one group, near no other);
very long texts are hashed whole, in blocks; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm import jaccard_fragments
from tidemark.llm.components import connected
from tidemark.llm.tables import spread, stage, unused

SHINGLE_WORDS = 4
TOLERANCE = 4
BITS = 64
SEED = 42

# Near-duplicate removal: words and bits of the candidates, words and percent of the decision.
NEAR_WORDS = 2
NEAR_TOLERANCE = 10
VERIFIED_WORDS = 5
VERIFIED_PERCENT = 80

# An index key with more fingerprints is linked through shared points.
HOT_KEY = 4_096

# Probes that one task makes. Fingerprints are few bytes but hundreds of probes each, so files tell nothing of the work.
TASK_PROBES = 2_000_000

# Relative costs of shuffling a probe and of verifying a candidate.
ROW_COST = 20.0
CANDIDATE_COST = 1.0

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SHINGLES_AT_ONCE = 65_536


def fingerprint_of(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of UTF-8 text."""
    found = WORDS.findall((text or b"").translate(TO_LOWER))
    if not found:
        return 0
    shingles = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, shingles, SHINGLES_AT_ONCE):
        part = range(start, min(shingles, start + SHINGLES_AT_ONCE))
        hashes = np.array([digest(b" ".join(found[i : i + words]), SEED) for i in part], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > shingles).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, hashed: bool = False) -> DataFrame:
    """``doc_id``, ``fp``: the fingerprint as a signed long, of every row; ``t1``, ``t2`` if asked for."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([fingerprint_of(t, words) for t in batch["text"]], dtype=np.uint64)
            yield batch.drop(columns="text").assign(fp=values.view(np.int64))

    more = text_keys() if hashed else []
    whole = docs.select(F.col("doc_id").cast("long"), *more, F.col("text").cast("string").cast("binary").alias("text"))
    return spread(whole).mapInPandas(compute, "doc_id long, " + "t1 long, t2 long, " * hashed + "fp long")


def text_keys(names: tuple[str, str] = ("t1", "t2")) -> list[Column]:
    """128 bits that name a text; all texts without words have one name."""
    text = F.col("text").cast("string")
    worded = F.coalesce(F.rlike(text, F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    values = (F.xxhash64(text), F.xxhash64(text, F.lit(1)))
    return [F.when(worded, v).otherwise(F.lit(0).cast("bigint")).alias(n) for v, n in zip(values, names)]


# ---------------------------------------------------------------- layout


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have each pair of bits set; bounded at 2,081 rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy()).astype(np.float32)
            total += bits.T @ bits
            rows += len(bits)
        a, b = np.triu_indices(BITS)
        a, b, n = np.append(a, -1), np.append(b, -1), np.append(total[np.triu_indices(BITS)], rows)
        yield pd.DataFrame({"a": a, "b": b, "n": n.astype(np.int64)})

    pairs = np.zeros((BITS, BITS))
    rows = 0
    sums = prints.select("fp").mapInPandas(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    for a, b, n in sums.collect():
        if a < 0:
            rows = n
        else:
            pairs[a, b] = pairs[b, a] = n
    return rows, pairs


def _bits(values: np.ndarray) -> np.ndarray:
    """Rows of bits, least significant first."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlations(rows: int, pairs: np.ndarray) -> np.ndarray:
    share = pairs / max(rows, 1)
    single = np.diag(share)
    spread_ = np.sqrt(np.maximum(single * (1 - single), 1e-12))
    found = np.abs(share - np.outer(single, single)) / np.outer(spread_, spread_)
    np.fill_diagonal(found, 0)
    return found


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width that hold correlated bits together."""
    free = set(range(BITS))
    groups = []
    for i in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - i)
        left = sorted(free)
        seed = max(left, key=lambda b: (correlation[b, left].max() if len(left) > 1 else 0, -b))
        group = [seed]
        while len(group) < width:
            rest = sorted(free - set(group))
            group.append(max(rest, key=lambda b: (correlation[b, group].sum(), -b)))
        free -= set(group)
        groups.append(sorted(group))
    return groups


def agreement(rows: int, pairs: np.ndarray, group: list[int]) -> list[float]:
    """Chance that two fingerprints differ in no, at most one, at most two bits of the group.

    Bits are chained along their strongest correlations, each conditioned on an earlier one.
    """
    share = pairs / max(rows, 1)
    strength = correlations(rows, pairs)
    same: list[float] = []
    for k, bit in enumerate(group):
        p = share[bit, bit]
        alone = p * p + (1 - p) * (1 - p)
        if k:
            other = group[int(np.argmax(strength[bit, group[:k]]))]
            q, both = share[other, other], share[bit, other]
            joint = both**2 + (p - both) ** 2 + (q - both) ** 2 + (1 - p - q + both) ** 2
            alone = joint / (q * q + (1 - q) * (1 - q))
        same.append(min(max(alone, 1e-6), 1.0))
    chance = [float(np.prod(same)), 0.0, 0.0]
    odds = np.array([(1 - s) / s for s in same])
    chance[1] = chance[0] * (1 + odds.sum())
    chance[2] = chance[1] + chance[0] * (odds.sum() ** 2 - (odds**2).sum()) / 2
    return [min(c, 1.0) for c in chance]


def allocate(rows: int, pairs: np.ndarray, tolerance: int = TOLERANCE) -> list[tuple[list[int], int]]:
    """Bit groups with their thresholds, of least estimated cost over all numbers of parts."""
    correlation = correlations(rows, pairs)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    # thresholds go up to two: fewer parts cannot hold the tolerance
    for parts in range(max(2, -(-(tolerance + 1) // 3)), tolerance + 2):
        groups = group_bits(correlation, parts)
        # program[s]: cheapest thresholds so far that sum to s
        program: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            chances = agreement(rows, pairs, group)
            following: dict[int, tuple[float, list[int]]] = {}
            for total, (cost, chosen) in program.items():
                for threshold in (-1, 0, 1, 2):
                    step = 0.0
                    if threshold >= 0:
                        probes = len(error_masks(group, threshold))
                        step = ROW_COST * rows * (1 + probes) + CANDIDATE_COST * rows * rows / 2 * chances[threshold]
                    option = (cost + step, chosen + [threshold])
                    if total + threshold not in following or option[0] < following[total + threshold][0]:
                        following[total + threshold] = option
            program = following
        target = tolerance - parts + 1
        if target in program and (best is None or program[target][0] < best[0]):
            best = (program[target][0], list(zip(groups, program[target][1])))
    return best[1]


def error_masks(bits: list[int] | range, errors: int) -> list[int]:
    """Signed 64-bit masks that flip up to so many of the bits."""
    found = [sum(1 << b for b in some) for n in range(errors + 1) for some in combinations(bits, n)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


# ---------------------------------------------------------------- links


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _index(prints: DataFrame, layout: list[tuple[list[int], int]]) -> DataFrame:
    """One row per fingerprint and part in use. A key keeps its part's bits in place."""
    keys = [
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group)))).alias("key"))
        for i, (group, threshold) in enumerate(layout)
        if threshold >= 0
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("_k")).select("fp", "_k.part", "_k.key")


def _probes(index: DataFrame, layout: list[tuple[list[int], int]]) -> DataFrame:
    """All keys within the threshold of each fingerprint's own."""
    masks = F.lit(None).cast("array<bigint>")
    for i, (group, threshold) in enumerate(layout):
        if threshold >= 0:
            values = F.array(*[F.lit(m).cast("bigint") for m in error_masks(group, threshold)])
            masks = F.when(F.col("part") == i, values).otherwise(masks)
    return index.select(
        F.col("fp").alias("asks"), "part", "key", F.explode(masks).alias("_mask")
    ).select("asks", "part", F.col("key").bitwiseXOR(F.col("_mask")).alias("key"))


def _dealt(prints: DataFrame, rows: int, layout: list[tuple[list[int], int]]) -> DataFrame:
    """Fingerprints dealt out by the probes they will make; one small file would be one task otherwise."""
    probes = rows * sum(len(error_masks(group, threshold)) for group, threshold in layout if threshold >= 0)
    tasks = max(prints.sparkSession.sparkContext.defaultParallelism, -(-probes // TASK_PROBES))
    return prints.repartition(tasks, "fp")


def _sides(prints: DataFrame, tolerance: int, hot_key: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Index and probes without hot keys, and the distinct fingerprints that probe hot keys, if any."""
    rows, pairs = bit_counts(prints)
    layout = allocate(rows, pairs, tolerance)
    prints = _dealt(prints, rows, layout)
    index = _index(prints, layout)
    probes = _probes(index, layout)
    hot = stage(
        index.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_key).select("part", "key"),
        "hot-keys",
    )
    if not hot.limit(1).collect():
        return index, probes, None
    crowded = probes.join(hot, ["part", "key"], "left_semi").select(F.col("asks").alias("fp")).distinct()
    index, probes = (side.join(hot, ["part", "key"], "left_anti") for side in (index, probes))
    return index, probes, crowded


def _meeting(differ: Column, tolerance: int) -> Column:
    """Condition of a probe ``p`` and an index row ``i`` that are within the tolerance."""
    near = differ & (F.bit_count(F.col("p.asks").bitwiseXOR(F.col("i.fp"))) <= tolerance)
    return (F.col("p.part") == F.col("i.part")) & (F.col("p.key") == F.col("i.key")) & near


def links(prints: DataFrame, tolerance: int = TOLERANCE, hot_key: int = HOT_KEY) -> DataFrame:
    """``a``, ``b``: links between distinct fingerprints (staged table with column ``fp``) that
    connect all that are within the tolerance. Away from hot keys every link is listed."""
    index, probes, crowded = _sides(prints, tolerance, hot_key)
    meeting = _meeting(F.col("p.asks") < F.col("i.fp"), tolerance)
    found = probes.alias("p").join(index.alias("i"), meeting).select(F.col("asks").alias("a"), F.col("fp").alias("b"))
    return found if crowded is None else found.union(_through_points(crowded, tolerance))


def with_neighbour(prints: DataFrame, tolerance: int, hot_key: int = HOT_KEY) -> DataFrame:
    """``fp`` of the distinct fingerprints (staged table) within the tolerance of another one.

    Makes no pairs. Fingerprints that probe a hot key are returned unseen.
    """
    index, probes, crowded = _sides(prints, tolerance, hot_key)
    meeting = _meeting(F.col("p.asks") != F.col("i.fp"), tolerance)
    found = probes.alias("p").join(index.alias("i"), meeting, "left_semi").select(F.col("asks").alias("fp"))
    return (found if crowded is None else found.union(crowded)).distinct()


def _through_points(prints: DataFrame, tolerance: int) -> DataFrame:
    """Links between fingerprints that share a point within half the tolerance of both."""
    if tolerance % 2:
        raise ValueError("shared points need an even tolerance")
    masks = F.array(*[F.lit(m).cast("bigint") for m in _point_masks(tolerance // 2)])
    points = prints.select("fp", F.explode(masks).alias("_m")).select("fp", F.col("fp").bitwiseXOR(F.col("_m")).alias("point"))
    # a point has at most as many fingerprints as masks
    least = F.min("fp").over(Window.partitionBy("point"))
    return points.select(least.alias("a"), F.col("fp").alias("b")).filter("a < b").distinct()


@cache
def _point_masks(errors: int) -> tuple[int, ...]:
    return tuple(error_masks(range(BITS), errors))


def group_documents(docs: DataFrame, words: int = SHINGLE_WORDS, tolerance: int = TOLERANCE, hot_key: int = HOT_KEY) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` of every row."""
    prints = stage(fingerprints(docs, words), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("_first")), "nodes")
    stars = connected(links(nodes, tolerance, hot_key), "a", "b")
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select("fp", "_first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    named = rooted.drop("_first").join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


# ---------------------------------------------------------------- near-duplicate removal


def near_groups(docs: DataFrame, prints: DataFrame, tolerance: int = NEAR_TOLERANCE, hot_key: int = HOT_KEY) -> DataFrame:
    """One row per group of near-duplicates: ``doc_id``, ``t1``, ``t2`` of its first row.

    ``prints`` are the staged fingerprints of the rows with an id, with text keys.
    """
    first = F.min(F.struct("doc_id", "t1", "t2")).alias("first")
    texts = prints.groupBy("t1", "t2", "fp").agg(first).select("fp", "first", F.monotonically_increasing_id().alias("tid"))
    texts = stage(texts, "texts")
    nodes = stage(texts.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "nodes")
    near = with_neighbour(nodes.select("fp"), tolerance, hot_key).union(nodes.filter("n > 1").select("fp"))
    near = stage(near.distinct(), "near")
    chosen = stage(texts.join(near, "fp", "left_semi").select("tid", "first"), "chosen")
    wanted = chosen.select("tid", "first.*")
    if wanted.count() <= jaccard_fragments.SENT_ROWS:
        wanted = F.broadcast(wanted)
    whole = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), *text_keys())
    content = whole.join(wanted, ["doc_id", "t1", "t2"]).select(F.col("tid").alias("doc_id"), "text")
    # a row that is repeated with its id
    content = stage(content.dropDuplicates(["doc_id"]), "near-texts")
    roots = jaccard_fragments.group_documents(content, VERIFIED_WORDS, VERIFIED_PERCENT)
    roots = roots.select(F.col("doc_id").alias("tid"), F.col("component_id").alias("root"))
    least = chosen.join(roots, "tid").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    return stage(texts.join(near, "fp", "left_anti").select("first.*").union(least), "group-firsts")


def keep_one(docs: DataFrame, tolerance: int = NEAR_TOLERANCE, hot_key: int = HOT_KEY) -> DataFrame:
    """One row of every group of near-duplicates: of its smallest id, and there of the smallest text key.

    Rows of one id with different texts are told apart. Rows without an id are kept and belong to no
    group: no id can name them. Of a row that is repeated with its id one stays.
    """
    with_id = docs.filter("doc_id is not null")
    prints = stage(fingerprints(with_id, NEAR_WORDS, hashed=True), "fingerprints")
    firsts = near_groups(with_id, prints, tolerance, hot_key)
    one, two = unused(docs, "_t1"), unused(docs, "_t2")
    marked = docs.select("*", *text_keys((one, two)))
    same = (marked["doc_id"] == firsts["doc_id"]) & (marked[one] == firsts["t1"]) & (marked[two] == firsts["t2"])
    kept = marked.join(firsts, same, "left_semi")
    if prints.groupBy("doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect():
        kept = kept.dropDuplicates(["doc_id", one, two])
    return kept.union(marked.filter("doc_id is null")).drop(one, two)
