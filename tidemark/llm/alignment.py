"""Alignment of the tokens of two tokenizers by pointer jumping.

Both tokenizers encode the same bytes (a space and the text). Token ranges that overlap form a
graph along the text, and its components are the groups. Every token points to the token that
overlaps it and reaches farthest to the right (at equal ends, to the second tokenizer's). Doubling
the successors of all tokens of a batch at once, as one numpy array, leads each to the last token
of its component, which labels the group.

**Units.** Neither tokenizer merges across a single space or line feed that stands between two
other characters, so a text is the sequence of its units (the separator and what follows it), and
every unit's end is a group's end. Units that recur are aligned once per task and looked up after
that; the rest of a unit (runs of white space, marks) is encoded as it stands in the text.

**Counts.** A pair of ids is linked in a document if one of its groups holds both. Documents per
pair are summed in tasks before they meet in Spark. The pairs of most documents (``KNOWN_PAIRS``, a
fixed bound) and their counts go to the tasks that sum over each document's links; the links of
all other pairs meet their counts in a join, so nothing is cut off.

Defined results: NULL and empty texts, and texts whose tokens do not spell the text again, have no
tokens: all numbers are zero and ``groups_sha256`` is ''. Names of special tokens are plain text.
Repeated rows and NULL ids are documents like others. Very long texts are read whole, unit by unit;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import spread, stage

# Pairs whose counts every task gets: 12 MB.
KNOWN_PAIRS = 500_000
CACHED_UNITS = 800_000
# Pairs that a task counts before it gives them out.
COUNTED_AT_ONCE = 1_000_000
# Bits of an id within a pair.
_SHIFT = 20

# A single space or line feed between characters that are no white space.
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n][^\s\x1c-\x1f\x85])")
_PLAIN = re.compile(r"[ \n][^\s\x1c-\x1f\x85▁]+")
_FIRST = " a"
# Texts that a task describes together.
TEXTS_AT_ONCE = 250


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers, ascending from 0, of the tokens of both sides. Tokens are given by their byte
    ends, ascending; both sides start at byte 0 and end at the same byte, none is empty."""
    n, m = len(ends_a), len(ends_b)
    if n == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    # the token of the other side that holds a token's last byte is the farthest that overlaps it
    of_a = np.searchsorted(ends_b, ends_a)
    of_b = np.searchsorted(ends_a, ends_b)
    own = np.arange(n + m)
    successor = np.concatenate([of_a + n, np.where(ends_a[of_b] > ends_b, of_b, own[n:] )])
    while True:
        onward = successor[successor]
        if np.array_equal(onward, successor):
            break
        successor = onward
    last, labels = np.unique(successor, return_inverse=True)
    return labels[:n], labels[n:]


def _byte_letters() -> dict[str, int]:
    """Fixed table of byte-level vocabularies: visible Latin-1 characters stand for themselves, the
    other bytes for the characters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairAligner:
    """Aligned units of two tokenizer files, with a cache."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        entries = self._a.get_vocab()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            known = all(c in letters for c in entry)
            self.bytes_a[i] = bytes(letters[c] for c in entry) if known else entry.encode()
        byte = re.compile(r"<0x([0-9A-Fa-f]{2})>")
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.bytes_b = [
            bytes([int(byte.fullmatch(p)[1], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self._sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _SHIFT:
            raise ValueError("a vocabulary has more ids than a pair can hold")
        self._lead = self._b.encode("\n")[:-1]  # what stands before a line feed that opens a text
        self._clear()

    def _clear(self) -> None:
        self.units: dict[str, int] = {}
        self.lines: list[str | None] = []  # groups as text; None where bytes differ
        self.sizes = np.empty((0, 4), dtype=np.int64)  # tokens of each side, groups, links
        self.pairs = np.empty(0, dtype=np.int64)  # of all units, one after another

    def whole_ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of whole texts on both sides."""
        a = [e.ids for e in self._a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return a, self._b.encode(texts, num_threads=1)

    def _unit_ids(self, unit: str) -> tuple[list[int], list[int]]:
        """Ids of a unit as it stands in a text."""
        a = self._a.encode(unit, add_special_tokens=False).ids
        if unit[0] == " ":
            return a, self._b.encode(unit[1:], num_threads=1)
        b = self._b.encode(unit, num_threads=1)
        return a, b[len(self._lead) :] if b[: len(self._lead)] == self._lead else []

    def align(self, units: list[str]) -> list[tuple[str | None, tuple[int, int, int, int], np.ndarray]]:
        """Groups as text, sizes and pairs of units; None for the groups where bytes differ.

        Units without other white space are encoded one after another as one text.
        """
        if len(units) > 1:
            plain = [i for i, u in enumerate(units) if _PLAIN.fullmatch(u)]
            done = dict(zip(plain, self._aligned([_FIRST, *(units[i] for i in plain)], whole=True)[1:]))
            return [done[i] if i in done else self.align([u])[0] for i, u in enumerate(units)]
        return self._aligned(units, whole=False)

    def _aligned(self, units: list[str], whole: bool) -> list:
        spelt = [u.encode("utf-8", "surrogatepass") for u in units]
        if whole:
            (a,), (b,) = self.whole_ids(["".join(units)[1:]])
        else:
            a, b = self._unit_ids(units[0])
        unit_ends = np.cumsum([len(x) for x in spelt])
        same = all(b"".join(map(side.__getitem__, ids)) == b"".join(spelt) for side, ids in ((self.bytes_a, a), (self.bytes_b, b)))
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self._sizes_a[a]), np.cumsum(self._sizes_b[b])
        if not same or not (np.isin(unit_ends, ends_a).all() and np.isin(unit_ends, ends_b).all()):
            if whole:  # tell the units apart that differ
                return [self._aligned([u], whole=False)[0] for u in units]
            return [(None, (0, 0, 0, 0), np.empty(0, dtype=np.int64))]
        label_a, label_b = groups_of(ends_a, ends_b)
        n, m = np.bincount(label_a), np.bincount(label_b)
        at_a, at_b = np.cumsum(n) - n, np.cumsum(m) - m
        group = np.repeat(np.arange(len(n)), n * m)
        place = np.arange(len(group)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
        pairs = (a[at_a[group] + place // m[group]] << _SHIFT) | b[at_b[group] + place % m[group]]
        # units end at ends of groups
        per_unit = np.diff(np.searchsorted(ends_a[at_a + n - 1], unit_ends, side="right"), prepend=0)
        of_groups = [np.add.reduceat(x, np.cumsum(per_unit) - per_unit).tolist() for x in (n, m, n * m)]
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        found, x, y, g, p = [], 0, 0, 0, 0
        n, m = n.tolist(), m.tolist()
        for groups, tokens_a, tokens_b, links in zip(per_unit.tolist(), *of_groups):
            parts = []
            for k in range(g, g + groups):
                parts.append(",".join(text_a[x : x + n[k]]) + "|" + ",".join(text_b[y : y + m[k]]))
                x, y = x + n[k], y + m[k]
            found.append((";".join(parts), (tokens_a, tokens_b, groups, links), pairs[p : p + links]))
            g, p = g + groups, p + links
        return found

    def _learn(self, units: list[str]) -> None:
        found = [x for start in range(0, len(units), 2_000) for x in self.align(units[start : start + 2_000])]
        if found:
            self.units.update(zip(units, range(len(self.lines), len(self.lines) + len(found))))
            self.lines += [line for line, _, _ in found]
            self.sizes = np.concatenate([self.sizes, [sizes for _, sizes, _ in found]])
            self.pairs = np.concatenate([self.pairs, *(pairs for _, _, pairs in found)])

    def describe(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Sizes and digest of each text; texts (by place), pairs and occurrences of distinct links.
        Empty texts have none."""
        if len(self.units) > CACHED_UNITS:
            self._clear()
        cut = [_CUT.split(" " + t) if t else [] for t in texts]
        self._learn([u for u in dict.fromkeys(u for units in cut for u in units) if u not in self.units])
        starts = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]
        sizes, digests, kept, kept_of = np.zeros((len(texts), 4), dtype=np.int64), [], [], []
        for i, units in enumerate(cut):
            ids = list(map(self.units.__getitem__, units))
            lines = list(map(self.lines.__getitem__, ids))
            if not ids or None in lines:
                digests.append("")
                continue
            digests.append(hashlib.sha256(";".join(lines).encode()).hexdigest())
            kept += ids
            kept_of += [i] * len(ids)
        kept, kept_of = np.array(kept, dtype=np.int64), np.array(kept_of, dtype=np.int64)
        np.add.at(sizes, kept_of, self.sizes[kept])
        counts = self.sizes[kept, 3]
        place = np.arange(counts.sum()) + np.repeat(starts[kept] - (np.cumsum(counts) - counts), counts)
        links = (np.repeat(kept_of, counts) << 2 * _SHIFT) | self.pairs[place]
        links, times = np.unique(links, return_counts=True)
        return sizes, digests, links >> 2 * _SHIFT, links & ((1 << 2 * _SHIFT) - 1), times


@cache
def aligner(path_a: str, path_b: str) -> PairAligner:
    """One per Python worker; a reused worker keeps its cache."""
    return PairAligner(path_a, path_b)


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, and its
    distinct linked pairs with their occurrences, as arrays of integers in bytes."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = aligner(path_a, path_b)
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[start : start + TEXTS_AT_ONCE]
                sizes, digests, texts, pairs, times = tool.describe([t or "" for t in part["text"]])
                cuts = np.searchsorted(texts, np.arange(1, len(part)))
                found = pd.DataFrame(sizes, columns=["n_a", "n_b", "n_groups", "n_links"])
                found["doc_id"] = pd.array([None if pd.isna(i) else int(i) for i in part["doc_id"]], dtype="Int64")
                found["groups_sha256"] = digests
                found["pairs"] = [x.tobytes() for x in np.split(pairs, cuts)]
                found["times"] = [x.tobytes() for x in np.split(times.astype("<u4"), cuts)]
                yield found

    whole = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "n_a long, n_b long, n_groups long, n_links long, doc_id long, groups_sha256 string, pairs binary, times binary"
    return spread(whole).mapInPandas(compute, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair``, ``n``: documents that hold the pair linked."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for batch in batches:
            for start in range(0, len(batch), 500):
                some = [np.frombuffer(p, dtype=np.int64) for p in batch["pairs"].iloc[start : start + 500]]
                fresh = np.unique(np.concatenate(some), return_counts=True)
                pairs, place = np.unique(np.concatenate([kept[0], fresh[0]]), return_inverse=True)
                sums = np.zeros(len(pairs), dtype=np.int64)
                np.add.at(sums, place, np.concatenate([kept[1], fresh[1]]))
                kept = pairs, sums
            if len(kept[0]) > COUNTED_AT_ONCE:
                yield pd.DataFrame({"pair": kept[0], "n": kept[1]})
                kept = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        yield pd.DataFrame({"pair": kept[0], "n": kept[1]})

    return rows.select("pairs").mapInPandas(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _sums(rows: DataFrame, counts: DataFrame, known_pairs: int) -> DataFrame:
    """``row``, ``n_best``, ``count_sum``. Counts have ``pair``, ``n`` and ``best``."""
    known = counts.orderBy(F.col("n").desc(), "pair").limit(known_pairs).toPandas().sort_values("pair")
    context = rows.sparkSession.sparkContext
    sent = context.broadcast((known["pair"].to_numpy(), known["n"].to_numpy(), known["best"].to_numpy()))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, numbers, best = sent.value
        for batch in batches:
            for start in range(0, len(batch), 250):
                part = batch.iloc[start : start + 250]
                own = [np.frombuffer(p, dtype=np.int64) for p in part["pairs"]]
                row = np.repeat(part["row"].to_numpy(), [len(p) for p in own])
                own = np.concatenate(own)
                times = np.frombuffer(b"".join(part["times"]), dtype="<u4").astype(np.int64)
                place = np.searchsorted(pairs, own)
                place[place == len(pairs)] = 0
                hit = pairs[place] == own if len(pairs) else np.zeros(len(own), dtype=bool)
                at, place, times_hit = row[hit], place[hit], times[hit]
                rows_, index = np.unique(at, return_inverse=True)
                n_best, sums = np.zeros(len(rows_), dtype=np.int64), np.zeros(len(rows_), dtype=np.int64)
                np.add.at(n_best, index, times_hit * best[place])
                np.add.at(sums, index, times_hit * numbers[place])
                none = np.zeros(len(rows_), dtype=np.int64)
                yield pd.DataFrame({"row": rows_, "n_best": n_best, "count_sum": sums, "pair": none - 1, "times": none})
                miss = ~hit
                none = np.zeros(int(miss.sum()), dtype=np.int64)
                yield pd.DataFrame({"row": row[miss], "n_best": none, "count_sum": none, "pair": own[miss], "times": times[miss]})

    schema = "row long, n_best long, count_sum long, pair long, times long"
    parts = stage(rows.select("row", "pairs", "times").mapInPandas(add, schema), "link-sums")
    rest = parts.filter("pair >= 0").select("row", "pair", "times").join(counts, "pair").select(
        "row", (F.col("times") * F.col("best")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")
    )
    return (
        parts.filter("pair < 0").select("row", "n_best", "count_sum").unionByName(rest)
        .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, known_pairs: int = KNOWN_PAIRS) -> DataFrame:
    """Token, group and link numbers of every document, one row each."""
    if path_a is None or path_b is None:
        default_a, default_b = default_vocabularies()
        path_a, path_b = path_a or default_a, path_b or default_b
    rows = aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    rows = stage(rows, "aligned")
    pairs = stage(pair_counts(rows), "pair-counts")
    side = F.shiftright("pair", _SHIFT)
    top = pairs.groupBy(side.alias("a")).agg(F.max("n").alias("top"))
    counts = pairs.withColumn("a", side).join(top, "a")
    counts = stage(counts.select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "pair-best")
    sums = _sums(rows, counts, known_pairs)
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
