"""Best-fit packing: a configuration linear program over the length histogram.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens; pieces are packed
whole into sequences. Which *lengths* share a sequence depends only on how many pieces have each
length, so the driver sees the histogram (``capacity`` counts at most) and never a piece:

1. **Program.** Over configurations p (multisets of lengths that fit) minimise the sum of x_p so
   that every length is covered. It is solved by multiplicative weights: each length carries a
   weight that falls as it is covered, weights are prices, and the next configuration is the one
   of highest price, found by a knapsack dynamic program over the capacity.
2. **Rounding.** Configurations are used a whole number of times, the fullest first, never beyond
   what is left of a length. The rest is completed largest piece first by the best fit of one, two
   or three pieces. Repetitions are counted, so work depends on the number of lengths.
3. **Places.** Pieces get a rank within their length (per bucket in parallel, with bucket
   offsets); rank and configuration give sequence and offset by arithmetic.

Defined results: NULL text is empty; an empty document is one piece with the end token; only
documents longer than the capacity are cut; repeated rows are packed each; an empty table gives
no rows; extra columns are ignored; very long documents become many pieces of one row each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.tables import spread, stage
from tidemark.llm.tokenize import default_vocabulary, tokenizer_at

CAPACITY = 2048
END = np.zeros(1, dtype="<u4").tobytes()

# Multiplicative weights: a step covers no length by more than this share; how fast weights fall.
STEP = 0.5
DECAY = 4.0
MOST_STEPS = 400

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenized documents cut into pieces: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    path = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_at(path)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"].tolist(), tokenizer.encode(batch["text"])):
                ids += END
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return spread(whole).mapInPandas(cut, PIECES)


@dataclass(frozen=True)
class Plan:
    """Slots of every length: slot intervals in rank order, with sequence and offset of the first.

    Interval i serves ranks ``first[i]`` up to the next interval of its length. ``per`` pieces of
    the length lie side by side in each of the interval's sequences.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    per: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the rank-th piece (from 0) of a length."""
        begin = np.searchsorted(self.length, length, side="left")
        found = np.empty(len(length), dtype=np.int64)
        for value in np.unique(length):
            at = np.flatnonzero(length == value)
            low = begin[at[0]]
            high = np.searchsorted(self.length, value, side="right")
            found[at] = low + np.searchsorted(self.first[low:high], rank[at], side="right") - 1
        step = rank - self.first[found]
        per = self.per[found]
        return self.sequence[found] + step // per, self.offset[found] + step % per * length


def _best_configuration(prices: np.ndarray, capacity: int) -> dict[int, int]:
    """Knapsack: lengths of highest total price that fit the capacity. ``prices[L-1]`` is for length L."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        gains = prices[:room] + best[room - 1 :: -1][:room]
        take = int(gains.argmax())
        if gains[take] > best[room - 1]:
            best[room], last[room] = gains[take], take + 1
        else:
            best[room] = best[room - 1]
    chosen: dict[int, int] = {}
    room = capacity
    while room > 0:
        if last[room]:
            chosen[int(last[room])] = chosen.get(int(last[room]), 0) + 1
            room -= int(last[room])
        else:
            room -= 1
    return chosen


def solve_program(demand: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often to use each, covering ``demand[L-1]`` pieces of every length."""
    lengths = np.flatnonzero(demand) + 1
    if len(lengths) == 0:
        return []
    wanted = demand.astype(float)
    covered = np.zeros(capacity)
    used: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(MOST_STEPS):
        ratio = covered[lengths - 1] / wanted[lengths - 1]
        if ratio.min() >= 1:
            break
        prices = np.zeros(capacity)
        prices[lengths - 1] = np.where(ratio < 1, np.exp(-DECAY * ratio), 1e-12) / wanted[lengths - 1]
        # a length's price per token is no less than this share of the average: full sequences
        # are worth more than part-filled ones of the same weight
        prices[lengths - 1] += 1e-3 * prices.sum() / len(lengths) * lengths / capacity
        configuration = _best_configuration(prices, capacity)
        configuration = {n: min(k, int(demand[n - 1])) for n, k in configuration.items()}
        times = min(STEP * wanted[n - 1] / k for n, k in configuration.items())
        for n, k in configuration.items():
            covered[n - 1] += times * k
        key = tuple(sorted(configuration.items()))
        used[key] = used.get(key, 0.0) + times
    return [(dict(key), times) for key, times in used.items()]


def _complete(left: np.ndarray, capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """Largest piece first, the room behind it filled by the best one, two or three pieces."""
    while True:
        present = np.flatnonzero(left) + 1
        if len(present) == 0:
            return
        chosen = {int(present[-1]): 1}
        room = capacity - int(present[-1])

        def usable(n: np.ndarray) -> np.ndarray:
            """Pieces of each length that are not in the configuration yet."""
            spare = left[n - 1].copy()
            for length, k in chosen.items():
                spare[n == length] -= k
            return spare

        while room > 0:
            fit = present[present <= room]
            fit = fit[usable(fit) > 0]
            if len(fit) == 0:
                break
            picked = [int(fit[-1])]
            if picked[0] != room:
                free = np.zeros(room + 1, dtype=np.int64)
                free[fit] = usable(fit)
                pair = _exact_pair(free, fit, room)
                if pair is None:
                    for n in fit[::-1][:64]:
                        free[n] -= 1
                        pair = _exact_pair(free, fit[fit <= room - n], room - int(n))
                        free[n] += 1
                        if pair is not None:
                            pair = [int(n), *pair]
                            break
                picked = pair or picked
            for n in picked:
                chosen[n] = chosen.get(n, 0) + 1
                room -= n
        times = int(min(left[n - 1] // k for n, k in chosen.items()))
        for n, k in chosen.items():
            left[n - 1] -= times * k
        yield chosen, times


def _exact_pair(free: np.ndarray, fit: np.ndarray, room: int) -> list[int] | None:
    """Two free lengths that sum to the room."""
    if room <= 0 or len(fit) == 0:
        return None
    other = room - fit
    good = (other > 0) & (free[fit] > 0) & (free[np.maximum(other, 0)] > 0)
    good &= (other != fit) | (free[fit] > 1)
    at = np.flatnonzero(good)
    return [int(fit[at[-1]]), int(other[at[-1]])] if len(at) else None


def round_program(demand: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Whole numbers of configurations that use every piece exactly once."""
    left = demand.astype(np.int64).copy()
    result: list[tuple[dict[int, int], int]] = []
    whole = int(left[capacity - 1])
    if whole:
        result.append(({capacity: 1}, whole))
        left[capacity - 1] = 0
    program = solve_program(left, capacity)
    filled = lambda c: sum(n * k for n, k in c.items())
    for configuration, times in sorted(program, key=lambda x: -filled(x[0])):
        if filled(configuration) < capacity:
            break
        can = min(int(left[n - 1]) // k for n, k in configuration.items())
        often = min(int(times), can)
        if often > 0:
            for n, k in configuration.items():
                left[n - 1] -= often * k
            result.append((configuration, often))
    result.extend(_complete(left, capacity))
    return result


def make_plan(demand: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The rounded program as slot intervals."""
    rows: list[tuple[int, int, int, int, int]] = []
    served = np.zeros(capacity + 1, dtype=np.int64)
    sequences = 0
    for configuration, times in round_program(demand, capacity):
        offset = 0
        for n, k in sorted(configuration.items(), reverse=True):
            rows.append((n, int(served[n]), sequences, offset, k))
            served[n] += times * k
            offset += n * k
        sequences += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return Plan(*[table[:, i].copy() for i in range(5)], sequences)


def histogram(pieces: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """Number of pieces of each length; ``capacity`` rows at most reach the driver."""
    demand = np.zeros(capacity, dtype=np.int64)
    for length, n in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        demand[length - 1] = n
    return demand


def _ranked(pieces: DataFrame) -> DataFrame:
    """Rank of each piece within its length, from 0. A hot length is spread over many buckets."""
    spark = pieces.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("_bucket", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most ``buckets`` rows a length
    starts = sizes.select("_bucket", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("_within", F.row_number().over(within) - 1)
    return numbered.join(starts, ["_bucket", "length"]).withColumn("_rank", F.col("_start") + F.col("_within"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to staged pieces. The plan is bounded by the number of lengths."""
    plan = pieces.sparkSession.sparkContext.broadcast(make_plan(histogram(pieces, capacity), capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = plan.value.place(batch["length"].to_numpy(), batch.pop("_rank").to_numpy())
            yield batch.assign(sequence_id=sequence, offset=offset)

    names = [f.split()[0] for f in PIECES.split(", ")]
    return _ranked(pieces).select(*names, "_rank").mapInPandas(place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack documents; one row per piece."""
    return pack(stage(pieces_of(docs, vocabulary, capacity), "pieces"), capacity)
