"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

**Words.** Runs of letters are lower-cased (A-Z only) and counted per task before the counts meet
in Spark; a run whose ``<doc_id>:<run>`` hashes to a multiple of ``DELETE_EVERY`` loses one code
point first. Words have ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences at least.

**Lists.** The vocabulary is cut into sorted lists that tasks can hold. Of two words one edit apart
let the shorter have L code points. The edit stands in one half of it, so they agree on the other
half, and of the half with the edit they agree on one quarter: they share one of four keys, each a
prefix and a suffix of fixed lengths. A word is listed under its keys for L = its length and its
length - 1. A list above ``LONG_LIST`` words is dealt to the two keys that halve its free part, and
so on; with one free code point left, the alphabet bounds it.

**Scan.** Within a sorted list a word is compared with the words after it by the edit matrix in a
band of three cells. Rows belong to prefixes, so the next word takes over the rows of the prefix it
shares with the one before (their longest common prefix), and where a row exceeds one edit, all
words with that prefix are skipped in one step. All words of many lists advance together as numpy
arrays. A pair is given out under the first key that it shares only.

**Forms.** A word's form is its most frequent near word (ties: the smallest in code-point order) if
that has ``DOMINANCE`` times its occurrences. Counts grow along forms, so chains end; successors
are doubled until nothing changes.

Defined results: NULL and empty texts have no runs; a NULL id is hashed as the text ``null``;
repeated rows count once each; very long texts are read whole, very long runs get keys of their
own length; an empty table or one without words gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import spread, stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
DELETE_EVERY = 31
DOMINANCE = 10
# A list with more words is dealt to finer keys.
LONG_LIST = 4_096
# Words whose counts a task keeps before it gives them out.
COUNTED_AT_ONCE = 400_000
# Words of lists that are scanned together, and cells of their rows.
SCANNED_AT_ONCE = 30_000
CELLS_AT_ONCE = 4_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- words


def document_words(doc_id: int | None, text: str, pattern: re.Pattern) -> dict[str, int]:
    """Words of one text with their occurrences."""
    lowered = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    name = b"null:" if doc_id is None else b"%d:" % doc_id
    found: dict[str, int] = {}
    for run, times in Counter(pattern.findall(lowered)).items():
        value = zlib.crc32(name + run.encode())
        if value % DELETE_EVERY == 0:
            at = value % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        found[run] = found.get(run, 0) + times
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if text:
                    counts.update(document_words(None if pd.isna(doc_id) else int(doc_id), text, pattern))
                if len(counts) > COUNTED_AT_ONCE:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        yield pd.DataFrame({"word": pd.Series(list(counts), dtype=object), "n": pd.Series(list(counts.values()), dtype="int64")})

    rows = spread(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).mapInPandas(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# ---------------------------------------------------------------- lists


def _keyed(words: DataFrame) -> DataFrame:
    """Words under the four keys of L = length and L = length - 1; ``head`` and ``tail`` are the
    lengths of a key's prefix and suffix, ``free`` what remains of the shorter word."""
    size = F.length("word")
    lengths = F.filter(F.array(size, size - 1), lambda length: length >= LEAST_LENGTH)
    rows = words.select("word", "n", F.explode(lengths).alias("short"))
    half = F.expr("short div 2")
    parts = rows.select("word", "n", "short", F.explode(F.array(
        F.struct(half.alias("head"), F.lit(0).cast("bigint").alias("tail")),
        F.struct(F.lit(0).cast("bigint").alias("head"), (F.col("short") - half).alias("tail")),
    )).alias("part")).select("word", "n", "short", "part.*")
    return _named(_halved(parts))


def _halved(rows: DataFrame) -> DataFrame:
    """Each key as the two that halve its free part."""
    rows = rows.withColumn("_free", F.col("short") - F.col("head") - F.col("tail"))
    step = F.expr("_free div 2")
    finer = F.array(
        F.struct((F.col("head") + step).alias("head"), F.col("tail").alias("tail")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + F.col("_free") - step).alias("tail")),
    )
    return rows.select("word", "n", "short", F.explode(finer).alias("part")).select("word", "n", "short", "part.*")


def _named(rows: DataFrame) -> DataFrame:
    key = F.concat_ws(
        "|", "short", "head", F.expr("substring(word, 1, cast(head as int))"),
        F.expr("substring(word, cast(length(word) - tail + 1 as int), cast(tail as int))"),
    )
    return rows.withColumn("key", key)


def lists(words: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """Rows of lists: ``key``, ``word``, ``n``, ``short``, ``head``, ``tail``; no list is above the
    bound unless one code point is free in it."""
    waiting = _keyed(words)
    done = []
    while True:
        long = waiting.filter(F.col("short") - F.col("head") - F.col("tail") > 1).groupBy("key").count()
        long = stage(long.filter(F.col("count") > long_list).select("key"), "long-lists")
        if not long.limit(1).collect():
            return _union([*done, waiting])
        done.append(waiting.join(long, "key", "left_anti"))
        waiting = stage(_named(_halved(waiting.join(long, "key", "left_semi").drop("key"))), "finer-lists")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# ---------------------------------------------------------------- scan


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, zero behind a word's end, and lengths."""
    lengths = np.array([len(w) for w in words], dtype=np.int32)
    letters = np.zeros((len(words), int(lengths.max()) + 1), dtype=np.uint32)
    joined = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters[np.arange(letters.shape[1]) < lengths[:, None]] = joined
    return letters, lengths


def common_prefixes(letters: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefix of the words of two index arrays."""
    differ = letters[a] != letters[b]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), letters.shape[1])
    return np.minimum(first, np.minimum(lengths[a], lengths[b])).astype(np.int32)


def scan(groups: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a before b) of one edit within each group of equal number; groups stand one
    after another, their words are distinct and in code-point order."""
    count = len(words)
    letters, lengths = _letters(words)
    width = letters.shape[1]
    index = np.arange(count)
    ends = np.searchsorted(groups, groups, side="right")
    shared = np.zeros(count + 1, dtype=np.int32)
    shared[1:count] = common_prefixes(letters, lengths, index[1:], index[:-1])
    # after[d][j]: the first word behind j that shares fewer than d code points with its forerunner
    after = np.empty((width + 1, count), dtype=np.int32)
    for depth in range(width + 1):
        stops = np.append(np.flatnonzero(shared[:count] < depth), count)
        after[depth] = stops[np.searchsorted(stops, index, side="right")]
    # row[i, d, k]: edits between the first d code points of the word at hand and the first
    # d - 1 + k of word i, no more than two counted
    rows = np.full((count, width + 1, 3), 2, dtype=np.uint8)
    rows[:, 0] = (2, 0, 1)
    at = index + 1  # the word each is compared with
    known = np.zeros(count, dtype=np.int32)  # rows that hold for it
    found_a, found_b = [], []
    active = index[at < ends]
    while len(active):
        other = at[active]
        depth = np.minimum(known[active], shared[other])
        dead = np.zeros(len(active), dtype=np.int32)  # depth at which a row exceeds one edit
        todo = np.flatnonzero(depth < lengths[other])
        while len(todo):
            i, j, d = active[todo], other[todo], depth[todo]
            above = rows[i, d]
            letter = letters[j, d]
            line = np.empty((len(todo), 3), dtype=np.uint8)
            size = lengths[i]
            left = np.full(len(todo), 2, dtype=np.uint8)
            for k in range(3):
                column = d + k  # place in word i of the row below
                inside = (column >= 0) & (column <= size)
                own = letters[i, np.clip(column - 1, 0, width - 1)]
                replaced = above[:, k] + ((own != letter) | (column < 1)).astype(np.uint8)
                cell = np.minimum(replaced, left + np.uint8(1))
                if k < 2:
                    cell = np.minimum(cell, above[:, k + 1] + np.uint8(1))
                cell = np.minimum(cell, 2)
                cell[column < 1] = (d[column < 1] + 1).clip(max=2)
                cell[~inside] = 2
                line[:, k] = left = cell
            depth[todo] = d + 1
            rows[i, d + 1] = line
            over = line.min(axis=1) > 1
            dead[todo[over]] = d[over] + 1
            todo = todo[~over & (d + 1 < lengths[j])]
        known[active] = depth
        alive = dead == 0
        i, j = active[alive], other[alive]
        place = lengths[i] - lengths[j] + 1  # the cell of the whole word i
        fits = (place >= 0) & (place <= 2)
        i, j, place = i[fits], j[fits], place[fits]
        one = rows[i, lengths[j], place] == 1
        found_a.append(i[one])
        found_b.append(j[one])
        at[active] = np.where(alive, other + 1, after[dead, other])
        active = active[at[active] < ends[active]]
    if not found_a:
        return index[:0], index[:0]
    return np.concatenate(found_a), np.concatenate(found_b)


def earlier_keys(short: int, head: int, tail: int) -> list[tuple[int, int]]:
    """Keys (prefix, suffix length) before this one in the order in which pairs are given out: at
    each halving, the first key takes the pair if the pair shares it."""
    before = []
    low = (0, 0)
    while low != (head, tail):
        free = short - low[0] - low[1]
        step = free // 2
        first, second = (low[0] + step, low[1]), (low[0], low[1] + free - step)
        if first[0] <= head:
            low = first
        else:
            before.append(first)
            low = second
    return before


def _near(chunk: pd.DataFrame) -> pd.DataFrame:
    """Both directions of every pair of the chunk's lists that belongs to its list."""
    words = chunk["word"].tolist()
    groups = (chunk["key"] != chunk["key"].shift()).cumsum().to_numpy()
    a, b = scan(groups, words)
    letters, lengths = _letters(words)
    turned, _ = _letters([w[::-1] for w in words])
    short = chunk["short"].to_numpy()
    fits = np.minimum(lengths[a], lengths[b]) == short[a]
    a, b = a[fits], b[fits]
    heads = common_prefixes(letters, lengths, a, b)
    tails = common_prefixes(turned, lengths, a, b)
    kinds = chunk[["short", "head", "tail"]].drop_duplicates().itertuples(index=False)
    keep = np.ones(len(a), dtype=bool)
    place = chunk[["short", "head", "tail"]].to_numpy()[a]
    for short_, head, tail in kinds:
        of = (place == (short_, head, tail)).all(axis=1)
        for first, last in earlier_keys(short_, head, tail):
            keep &= ~(of & (heads >= first) & (tails >= last))
    a, b = a[keep], b[keep]
    x, y = np.concatenate([a, b]), np.concatenate([b, a])
    word, n = chunk["word"].to_numpy(dtype=object), chunk["n"].to_numpy()
    return pd.DataFrame({"word": word[x], "n": n[x], "near": word[y], "near_n": n[y]})


def near_words(words: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: every pair of one edit, once in each direction."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            longest = int(rows["word"].str.len().max()) + 2 if len(rows) else 1
            if len(rows) < min(SCANNED_AT_ONCE, CELLS_AT_ONCE // longest):
                rest = rows
                continue
            whole = rows["key"].ne(rows["key"].iloc[-1]).to_numpy()  # the last list may go on
            rest = rows[~whole]
            if whole.any():
                yield _near(rows[whole].reset_index(drop=True))
        if rest is not None and len(rest):
            yield _near(rest.reset_index(drop=True))

    dealt = lists(words, long_list).repartition("key").sortWithinPartitions("key", "word")
    return dealt.select("key", "word", "n", "short", "head", "tail").mapInPandas(
        compare, "word string, n long, near string, near_n long"
    )


# ---------------------------------------------------------------- forms


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last form of each chain, by doubling."""
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        doubled = roots.join(onward, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        )
        doubled = stage(doubled, "roots")
        roots = doubled.select("word", "root")
        if not doubled.filter("_moved").limit(1).collect():
            return roots


def variants(docs: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word."""
    words = stage(vocabulary(docs), "vocabulary")
    near = near_words(words, long_list)
    none = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("m"), "near")))
    counted = near.unionByName(none).groupBy("word", "n").agg(F.count("near").alias("n_near"), best.alias("b"))
    formed = -F.col("b.m") >= DOMINANCE * F.col("n")
    counted = stage(
        counted.select(
            "word", "n", "n_near", F.when(formed, F.col("b.near")).alias("form"), F.when(formed, -F.col("b.m")).alias("form_n")
        ),
        "forms",
    )
    roots = _roots(counted.filter("form is not null"))
    return counted.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
