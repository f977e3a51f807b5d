import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, packing, quality_rules
from tidemark.llm.tables import hash_place, least_by_hash
from tidemark.llm.tokenize import CachedTokenizer, default_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_of(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_rules_measure_like_a_loop(odd_docs):
    for row in quality_rules.measure(odd_docs).collect():
        n, *_, repeats = expected = counts_of(row["text"])
        assert tuple(row[m] for m in quality_rules.MEASURES) == expected
        assert row["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (row["kept"] and row["base_failed"])


def test_rules_keep_columns_and_run_without_python(odd_docs, no_docs):
    kept = quality_rules.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert quality_rules.measure(no_docs).count() == 0 and quality_rules.keep_good(no_docs).count() == 0
    assert "Python" not in quality_rules.measure(odd_docs)._jdf.queryExecution().toString()


def test_repeats_with_many_equal_windows(spark):
    texts = ["a b c a b c a b c", "a a a a", "a b", "x y z " * 3_000, "p q r s p q r t p q"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.measure(rows).collect()}
    assert got == {i: counts_of(t)[4] for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def tokenizer():
    return CachedTokenizer(default_vocabulary())


def test_cached_tokenizer_gives_the_tokenizers_ids(tokenizer, odd_rows, small_docs):
    texts = [t or "" for _, t, _ in odd_rows] + [r["text"] for r in small_docs.select("text").collect()]
    texts += ["don't CAN'T'll", "ΑΣ ΣΑΣ", "é É", "İx ﬁ", "x<|startoftext|>y", "a b　c", "1a2b3", "_-_ ,.,"]
    whole = [np.asarray(e.ids, "<u4").tobytes() for e in tokenizer._tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(tokenizer.encode(texts)) == whole
    assert list(tokenizer.encode(texts)) == whole  # now from the cache


def check_packing(rows, texts, tokenizer, capacity):
    ids = {}
    for key, text in texts:
        ids.setdefault(key, []).append(next(iter(tokenizer.encode([text or ""]))) + packing.END)
    left = Counter()
    for key, found in ids.items():
        for tokens in found:
            for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                own = tokens[at : at + 4 * capacity]
                left[(key, piece, at // 4, len(own) // 4, zlib.crc32(own))] += 1
    assert left == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packing_places_every_token_once(odd_docs, odd_rows, tokenizer, no_docs):
    rows = packing.pack_documents(odd_docs, capacity=256).collect()
    used = check_packing(rows, [(i, t) for i, t, _ in odd_rows], tokenizer, 256)
    assert used <= -(-sum(r.length for r in rows) // 256) + 1
    assert packing.pack_documents(no_docs).count() == 0


def test_packing_of_documents(small_docs, tokenizer):
    rows = packing.pack_documents(small_docs).collect()
    texts = [(r.doc_id, r.text) for r in small_docs.collect()]
    used = check_packing(rows, texts, tokenizer, packing.CAPACITY)
    assert used <= 1.01 * -(-sum(r.length for r in rows) // packing.CAPACITY) + 1


@pytest.mark.parametrize("seed", range(3))
def test_plan_uses_every_piece_and_is_near_the_bound(seed):
    r = np.random.default_rng(seed)
    lengths = np.clip(r.lognormal(3.2, 0.9, 5_000).astype(int), 1, 128)
    demand = np.bincount(lengths, minlength=129)[1:]
    used = np.zeros(128, dtype=int)
    sequences = 0
    for configuration, times in packing.round_program(demand, 128):
        assert sum(n * k for n, k in configuration.items()) <= 128
        sequences += times
        for n, k in configuration.items():
            used[n - 1] += k * times
    assert (used == demand).all()
    assert sequences <= 1.01 * -(-lengths.sum() // 128)


def test_program_covers_its_demand():
    demand = np.zeros(100, dtype=int)
    demand[[59, 39, 19]] = 30, 30, 60
    covered = np.zeros(100)
    for configuration, times in packing.solve_program(demand, 100):
        for n, k in configuration.items():
            covered[n - 1] += k * times
    assert (covered[[59, 39, 19]] >= np.array([30, 30, 60]) - 1e-9).all()


def brute_language(text, sets, totals):
    hits = [sum(int(h in s) for part in language.grams(text) for h in part.tolist()) for s in sets]
    return hits


def test_filters_find_all_languages_of_a_gram():
    r = np.random.default_rng(5)
    hashes = r.integers(0, 1 << 63, 3_000, dtype=np.uint64)
    members = r.random((3_000, 11)) < 0.3
    filters = language.Filters.build([str(i) for i in range(11)], hashes, members, bits=18)
    found = np.unpackbits(filters.languages_of(hashes), axis=1, bitorder="little")[:, :11].astype(bool)
    assert (found | ~members).all()  # no false negative
    others = r.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    wrong = np.unpackbits(filters.languages_of(others), axis=1, bitorder="little")[:, :11].mean(axis=0)
    assert np.abs(wrong - filters.false_positive).max() < 0.01


def test_language_is_learned(small_docs):
    held = small_docs.filter("doc_id % 3 = 1")
    filters = language.learn(small_docs.filter("doc_id % 3 <> 1"))
    rows = language.identify(held, filters).collect()
    assert len(rows) == held.count()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd_docs, no_docs):
    filters = language.learn(odd_docs)
    rows = language.identify(odd_docs, filters).collect()
    for r in rows:
        letters = r.text is not None and any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == (not letters)
    kept = language.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in odd_docs.collect() if r.text is not None and any(map(str.isalpha, r.text))
    )
    assert language.keep_identified(no_docs).count() == 0
    unlearned = language.learn(no_docs)
    assert {r.lang_pred for r in language.identify(odd_docs, unlearned).collect()} == {"und"}


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = "der hund und die katze " * 50
    whole = sum(len(h) for h in language.grams(text))
    monkeypatch.setattr(language, "BLOCK", 100)
    assert sum(len(h) for h in language.grams(text)) >= 0.8 * whole


def test_least_by_hash_is_bounded(spark):
    rows = spark.range(10_000).select(F.col("id").alias("doc_id"))
    got = least_by_hash(rows, "doc_id", 100)
    expected = rows.orderBy(hash_place("doc_id")).limit(100)
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in expected.collect()}
