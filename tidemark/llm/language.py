"""Language identification with language-bitmask n-gram filters.

Training gathers character n-grams per language and keeps, for each, the set of languages in which
it is about as frequent as anywhere: a bitmask. All masks go into one bit-sliced Bloom filter: a
row of bits per position, one bit per language, so that two look-ups and an AND return *all*
languages that contain an n-gram. A text's languages get the popcounts of its n-grams' masks,
corrected for the false positives that the filling of each language's slice makes likely; the
largest decides.

Learning reads at most ``SAMPLE_DOCS`` documents of each language, those of smallest id hash, and
keeps at most ``MOST_GRAMS`` n-grams; both bound what reaches the driver. Prediction reads every
text whole, in blocks of ``BLOCK`` characters.

Defined results: NULL text, and text without a letter, is ``und`` with score 0; a text none of
whose n-grams is known gets the most frequent language with score 0; ties go to the more frequent
language, then to the smaller name; documents without language teach nothing; without any training
row everything is ``und``; repeated rows and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.tables import hash_place, hash_share, spread, unused

UNDETERMINED = "und"

# The pipeline keeps documents whose language has this share of their known n-grams.
MAJORITY = 0.5
SIZES = (3, 4, 5)
SAMPLE_DOCS = 3_000
MOST_GRAMS = 400_000
# An n-gram belongs to a language if seen this often there and at this share of its highest rate.
LEAST_COUNT = 3
LEAST_SHARE = 0.25
POSITION_BITS = 22
BLOCK = 1_000_000

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


@cache
def _letters() -> np.ndarray:
    """Whether a code point of the basic plane is a letter; those beyond count as letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x10000)), dtype=bool, count=0x10000)


def _codes(text: str) -> np.ndarray:
    """Lower-case letters with one space (0) around each run of other characters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)
    codes = np.where(letter, codes, 0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.concatenate(([0], codes[keep], [0])).astype(np.uint64)


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams inside words and their borders, block by block."""
    for start in range(0, max(len(text), 1), BLOCK):
        codes = _codes(text[start : start + BLOCK])
        space = codes == 0
        for n in SIZES:
            if len(codes) < n:
                continue
            count = len(codes) - n + 1
            value = np.full(count, n, dtype=np.uint64)
            inner = np.zeros(count, dtype=bool)
            for i in range(n):
                value ^= codes[i : i + count] * _FACTORS[i]
                value *= np.uint64(0x9FB21C651E98DF25)
                if 0 < i < n - 1:
                    inner |= space[i : i + count]
            yield _mixed(value[~inner])


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(32))
    value = value * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(29))


@dataclass(frozen=True)
class Filters:
    """Bit-sliced Bloom filter over languages; languages are ordered by frequency, then name."""

    languages: tuple[str, ...]
    rows: np.ndarray  # positions x words of bits
    false_positive: np.ndarray

    @classmethod
    def build(cls, languages: Sequence[str], hashes: np.ndarray, members: np.ndarray, bits: int = POSITION_BITS) -> "Filters":
        """``members``: n-grams x languages, boolean."""
        width = max(1, -(-len(languages) // 8))
        packed = np.packbits(members, axis=1, bitorder="little") if len(languages) else np.zeros((len(hashes), 1), np.uint8)
        rows = np.zeros((1 << bits, width), dtype=np.uint8)
        for at in _positions(hashes, bits):
            np.bitwise_or.at(rows, at, packed)
        filling = np.array([((rows[:, i >> 3] >> (i & 7)) & 1).mean() for i in range(len(languages))])
        return cls(tuple(languages), rows, filling**2)

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        """Bit rows: all languages whose filter contains each n-gram."""
        first, second = _positions(hashes, self.rows.shape[0].bit_length() - 1)
        return self.rows[first] & self.rows[second]

    def counts(self, text: str) -> np.ndarray:
        """N-grams of the text per language, corrected for false positives."""
        hits = np.zeros(len(self.languages))
        total = 0
        for hashes in grams(text):
            found = self.languages_of(hashes)
            total += len(hashes)
            hits += [np.count_nonzero(found[:, i >> 3] & np.uint8(1 << (i & 7))) for i in range(len(self.languages))]
        return np.maximum(hits - total * self.false_positive, 0) / (1 - self.false_positive)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        counts = self.counts(text)
        best = int(counts.argmax())
        return self.languages[best], float(counts[best] / counts.sum()) if counts[best] > 0 else 0.0


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _sample(docs: DataFrame, frequency: dict[str, int], per_language: int) -> DataFrame:
    """At most so many documents of each language, by hash of their id.

    About twice as many pass a cut of the hash before they are ranked, so that ranking one
    language stays small in its task.
    """
    shares = F.create_map(*[F.lit(x) for name, n in frequency.items() for x in (name, min(1.0, 2.0 * per_language / n))])
    near = docs.select("doc_id", "lang").filter(hash_share("doc_id", shares[F.col("lang")]))
    order = Window.partitionBy("lang").orderBy(hash_place("doc_id"), "doc_id")
    ids = near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language)
    ids = ids.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    # bounded by the sample size; a hint, as the optimizer cannot know the bound
    return docs.join(F.broadcast(ids), (docs["doc_id"] == ids["_id"]) & (docs["lang"] == ids["_lang"]), "left_semi")


def learn(training: DataFrame, per_language: int = SAMPLE_DOCS) -> Filters:
    """Filters from ``doc_id``, ``text`` and ``lang`` of training rows."""
    rows = training.select("doc_id", F.col("text").cast("string").alias("text"), "lang").filter(
        "text is not null and lang is not null and doc_id is not null"
    )
    frequency = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not frequency:
        return Filters.build((), np.empty(0, np.uint64), np.empty((0, 0), bool))
    languages = sorted(frequency, key=lambda name: (-frequency[name], name))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found = [h for text in texts for h in grams(text)]
                if found:
                    values, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": values.view(np.int64), "n": n})

    seen = (
        _sample(rows, frequency, per_language)
        .select("lang", "text")
        .repartition(rows.sparkSession.sparkContext.defaultParallelism)
        .mapInPandas(gather, "lang string, gram long, n long")
        .groupBy("gram", "lang")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
        .groupBy("gram")
        .agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("total"))
        .orderBy(F.desc("total"), "gram")
        .limit(MOST_GRAMS)
    )
    columns = [F.coalesce(F.col("by")[name], F.lit(0)).alias(f"n{i}") for i, name in enumerate(languages)]
    found = seen.select("gram", *columns).toPandas()
    counts = found[[f"n{i}" for i in range(len(languages))]].to_numpy(dtype=float)
    rates = counts / np.maximum(counts.sum(axis=0), 1)
    members = (counts > 0) & (rates >= LEAST_SHARE * rates.max(axis=1, keepdims=True)) if len(found) else counts > 0
    return Filters.build(languages, found["gram"].to_numpy(dtype=np.int64).view(np.uint64), members)


def _predictor(spark: SparkSession, filters: Filters):
    """Language and score of a text column. The filter's size is fixed."""
    shared = spark.sparkContext.broadcast(filters)

    @pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"], index=texts.index)

    return predict(F.col("text").cast("string"))


def identify(docs: DataFrame, filters: Filters, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and its score to every row."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (lang, score)]
    found = unused(docs, "_found")
    rows = spread(docs).select(*others, _predictor(docs.sparkSession, filters).alias(found))
    return rows.select(*others, F.col(found)["lang"].alias(lang), F.col(found)["score"].alias(score))


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents in one language that the training rows know, with their own columns.

    A document goes if no language has ``MAJORITY`` of its known n-grams (mixtures, short texts of license lines,
    keys and numbers), or none is known; without letters the score is 0.
    """
    filters = learn(docs)
    return spread(docs).filter(_predictor(docs.sparkSession, filters)["score"] >= MAJORITY)
