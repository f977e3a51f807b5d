import hashlib
import random
import time
import zlib
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import gru_lm, minhash, quality_trees, segmentation, simhash, url_lists
from tidemark.llm.components import connected
from tidemark.llm.hashing import shingles, word_hashes


# ---------------------------------------------------------------- simhash


def brute_components(prints, ids, tolerance=4):
    unique = np.unique(prints)
    root = list(range(len(unique)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(unique)):
        for j in np.flatnonzero(np.bitwise_count(unique[i + 1 :] ^ unique[i]) <= tolerance) + i + 1:
            root[find(i)] = find(j)
    of = {int(u): find(i) for i, u in enumerate(unique)}
    least = {}
    for p, i in zip(prints, ids):
        if i is not None:
            least[of[int(p)]] = min(i, least.get(of[int(p)], i))
    return [least.get(of[int(p)]) for p in prints]


@pytest.mark.parametrize("hot_key", [simhash.HOT_KEY, 1])
def test_components_equal_brute_force(small_docs, hot_key):
    rows = simhash.group_documents(small_docs, hot_key=hot_key).collect()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    ids = [r.doc_id for r in rows]
    prints = np.array([simhash.fingerprint_of(texts[i].encode()) for i in ids], dtype=np.uint64)
    assert [r.fp & (1 << 64) - 1 for r in rows] == prints.tolist()
    assert [r.component_id for r in rows] == brute_components(prints, ids)


def near_prints(seed, n):
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(n // 20)]
    found = {r.getrandbits(64) for _ in range(n // 4)} | {0}
    while len(found) < n:
        p = r.choice(centres)
        for _ in range(r.randint(0, 5)):
            p ^= 1 << r.randrange(64)
        found.add(p)
    return sorted(p - (1 << 64) if p >> 63 else p for p in found)


@pytest.mark.parametrize("layout", [None, [(21, 1), (21, 0), (22, 1)], [(32, 1), (32, 2)]])
@pytest.mark.parametrize("hot_key", [simhash.HOT_KEY, 2])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, layout, hot_key):
    prints = near_prints(3, 600)
    if layout:
        bits = iter(random.Random(1).sample(range(64), 64))
        chosen = [(sorted(next(bits) for _ in range(width)), t) for width, t in layout]
        monkeypatch.setattr(simhash, "allocate", lambda *a: chosen)
    rows = spark.createDataFrame([(p,) for p in prints], "fp long")
    stars = {r.node: r.root for r in connected(simhash.links(rows, hot_key=hot_key), "a", "b").collect()}
    unsigned = np.array(prints, dtype=np.int64).view(np.uint64)
    expected = brute_components(unsigned, prints)
    assert [stars.get(p, p) for p in prints] == expected


def test_allocation_is_complete_and_follows_size():
    pairs = np.full((64, 64), 0.25)
    np.fill_diagonal(pairs, 0.5)
    for rows in (1e3, 1e6, 1e8, 1e10):
        chosen = simhash.allocate(rows, pairs * rows)
        assert sorted(b for g, _ in chosen for b in g) == list(range(64))
        assert sum(t for _, t in chosen) == simhash.TOLERANCE - len(chosen) + 1
    assert len(simhash.allocate(1e3, pairs * 1e3)) > len(simhash.allocate(1e10, pairs * 1e10))


def test_correlated_bits_share_a_part():
    r = np.random.default_rng(0)
    bits = (r.random((4_000, 64)) < 0.5).astype(float)
    bits[:, 40:48] = bits[:, :1]  # copies of bit 0
    pairs = bits.T @ bits
    group = next(g for g in simhash.group_bits(simhash.correlations(4_000, pairs), 5) if 0 in g)
    assert set(range(40, 48)) <= set(group)


def test_near_dedup_of_odd_rows(odd_docs, odd_rows, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(6) == 1 and 7 not in ids
    assert 2 in ids and not {3, 4} & set(ids)  # all without words: fingerprint zero
    assert simhash.keep_one(no_docs).count() == 0
    assert simhash.group_documents(no_docs).count() == 0


def test_every_group_keeps_one_row_of_repeated_ids(spark):
    x, y, z = (" ".join(f"{c}{k * k % 97}" for k in range(80)) for c in "xyz")
    rows = [(5, x), (9, x), (5, y), (2, y), (7, z), (7, x + " tail"), (7, z), (3, z + " ")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups = sorted((r.text[0], r.doc_id) for r in kept)
    assert groups == [("x", 5), ("y", 2), ("z", 3)]


@pytest.mark.parametrize("hot_key", [simhash.HOT_KEY, 1])
def test_near_dedup_equals_brute_force(spark, hot_key):
    """Edited copies from slight to strong: what five-word Jaccard links goes, where a text has a neighbour at all."""
    r = random.Random(11)
    rows = []
    for group in range(12):
        base = [r.choice("abcdefgh") + str(r.randrange(400)) for _ in range(150)]
        for edits in (0, 0, 1, 2, 3, 6, 20):
            text = list(base)
            for at in r.sample(range(150), edits):
                text[at] = f"new{r.randrange(9_999)}"
            rows.append((len(rows) * 5 % 84, " ".join(text)))
    sets = {i: word_sets(t) for i, t in rows}
    prints = {i: simhash.fingerprint_of(t.encode(), simhash.NEAR_WORDS) for i, t in rows}
    has = {i for i in prints for j in prints if i != j and (prints[i] ^ prints[j]).bit_count() <= simhash.NEAR_TOLERANCE}
    if hot_key == 1:
        has = set(prints)  # keys of several fingerprints go on unseen
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in range(i):
            if {i, j} <= has and jaccard(sets[i], sets[j]) >= 0.8 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), hot_key=hot_key).collect()
    assert len({k.doc_id for k in kept}) == len(kept) and 12 < len(kept) < 60
    assert {k.doc_id for k in kept} == set(root.values())


def test_candidates_have_a_neighbour(spark):
    r = random.Random(5)
    prints = [r.getrandbits(64) for _ in range(300)]
    for p in prints[:60]:
        for bit in r.sample(range(64), r.choice([6, 10, 11])):
            p ^= 1 << bit
        prints.append(p)
    prints = np.array(prints, dtype=np.uint64)
    near = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 10).sum(1) > 1
    rows = spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "fp long")
    found = [x.fp for x in simhash.with_neighbour(rows, 10).collect()]
    assert sorted(found) == sorted(prints.view(np.int64)[near].tolist())


def test_probes_of_one_small_file_are_made_by_many_tasks(spark, tmp_path):
    rows = [(random.Random(i).getrandbits(63),) for i in range(200)]
    spark.createDataFrame(rows, "fp long").coalesce(1).write.parquet(str(tmp_path / "prints"))
    prints = spark.read.parquet(str(tmp_path / "prints"))
    assert prints.rdd.getNumPartitions() == 1
    index, probes, crowded = simhash._sides(prints, 10, simhash.HOT_KEY)
    assert probes.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and crowded is None


def test_long_text_fingerprint_in_blocks(monkeypatch):
    text = b" ".join(b"w%d" % (i * i % 977) for i in range(5_000))
    whole = simhash.fingerprint_of(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 100)
    assert simhash.fingerprint_of(text) == whole


def test_chain_and_star_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1_000, i) for i in range(1_001, 1_200)] + [(7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 1_000 for i in range(1_001, 1_200)}}


# ---------------------------------------------------------------- minhash


def word_sets(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_word_hashes_follow_words():
    text = b"The  cat\tthe\ncat THE "
    a = word_hashes(text)
    assert len(a) == 5 and a[0] == a[2] == a[4] and a[1] == a[3] and a[0] != a[1]
    assert (word_hashes(b"cat the cat")[1:] == a[[0, 1]]).all()
    assert len(shingles(a, 5)) == 1 and len(shingles(a[:0], 5)) == 0 and len(shingles(a[:2], 5)) == 1


def test_blocks_do_not_cut_words(monkeypatch):
    import tidemark.llm.hashing as hashing

    text = b" ".join(b"word%d" % i for i in range(3_000))
    whole = word_hashes(text)
    monkeypatch.setattr(hashing, "BLOCK_BYTES", 64)
    assert (word_hashes(text) == whole).all()


def test_neighbours_and_edited_texts(small_docs):
    rows = sorted(minhash.with_next(small_docs).collect(), key=lambda r: r.doc_id)
    docs = sorted(small_docs.collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    errors = []
    for i, r in enumerate(rows):
        text, following = docs[i].text, docs[(i + 1) % len(docs)].text
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(r.near_edited - jaccard(word_sets(text), word_sets(edited)))
        errors.append(r.near_next - jaccard(word_sets(text), word_sets(following)))
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.2
    by_text = {}
    for d, r in zip(docs, rows):
        by_text.setdefault(d.text, set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in by_text.values())


def test_neighbours_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = minhash.with_next(odd_docs).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(i) for i, *_ in odd_rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert minhash.with_next(no_docs).count() == 0
    alone = minhash.with_next(spark.createDataFrame([(5, "only one text here")], "doc_id long, text string")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_near_links_connect_similar_texts(spark):
    r = random.Random(2)
    rows = []
    for group in range(6):
        base = [f"g{group}w{r.randrange(5_000)}" for _ in range(300)]
        for _ in range(12):
            text = list(base)
            for _ in range(r.randint(0, 12)):
                text[r.randrange(300)] = f"x{r.randrange(99_999)}"
            rows.append(" ".join(text))
    rows += [rows[0], "", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    members, links = minhash.near_links(docs)
    of = {m["doc_id"]: m["class"] for m in members.collect()}
    roots = {x.node: x.root for x in connected(links, "a", "b").collect()}
    sets = [word_sets(t) for t in rows]
    for i in range(len(rows)):
        for j in range(i):
            alike = jaccard(sets[i], sets[j]) if sets[i] and sets[j] else 0
            same = roots.get(of[i], of[i]) == roots.get(of[j], of[j])
            if alike >= 0.8:
                assert same, (i, j, alike)
            if sets[i] and sets[j] and rows[i].split("w")[0] != rows[j].split("w")[0] and alike == 0:
                assert not same


# ---------------------------------------------------------------- segmentation


@pytest.fixture(scope="module")
def segmenter():
    return segmentation.Segmenter(segmentation.default_pieces(), best=5)


def all_scores(s, text, best):
    marked, found = s.marked(text), []

    def walk(at, score):
        if at == len(marked):
            found.append(score)
            return
        for end in range(at + 1, min(len(marked), at + 16) + 1):
            if marked[at:end] in s.pieces:
                walk(end, score + s.pieces[marked[at:end]][1])
        if marked[at] not in s.pieces:
            walk(at + 1, score + s.byte_score * len(segmentation._raw(marked[at])))

    walk(0, 0.0)
    return sorted(found, reverse=True)[:best]


@pytest.mark.parametrize("text", ["hello", "cats, dogs", "a  b ", " lead", "é\nx", "日本 ▁", "Attion!!", "x", "12 34"])
def test_best_segmentations_equal_all_paths(segmenter, text):
    found = segmenter.segment(text)
    assert np.allclose([s for s, _ in found], all_scores(segmenter, text, 5))
    assert len({ids for _, ids in found}) == len(found)
    assert all(segmenter.decode(ids) == text for _, ids in found)
    described = segmenter.describe([text])[0]
    assert np.allclose(described[2], [s for s, _ in found]) and described[0] == len(found[0][1]) and described[3]


def test_words_searched_side_by_side_equal_one_by_one(segmenter):
    words = ["hello", "x" * 63, "x" * 64, "x" * 65, "é日本", "aaaaaaaaaaaa", "don't", "\ud7ff", "▁▁", "ab" * 20, "\n\n"]
    marked = [segmenter.marked(w) for w in words]
    for part, found in zip(marked, segmenter.search_all(marked)):
        alone = segmenter.search(part)
        assert [s for s, _ in found] == [s for s, _ in alone]
        assert len({ids for _, ids in found}) == len(found)
    for word in ("hello", "aaaaaaaaaaaa", "é日本"):
        assert np.allclose([s for s, _ in segmenter.find([segmenter.marked(word)])[0]], all_scores(segmenter, word, 5))


def test_every_sequence_of_a_text_has_its_score_and_decodes(segmenter):
    value = {i: score for i, score, _ in segmenter.pieces.values()}
    value |= dict.fromkeys(segmenter.bytes, segmenter.byte_score)
    texts = [f"{a} the cats, dogs {b} don't Attion!! {a}" for a, b in zip("abcdeé", "12345▁")]
    for text, found in zip(texts, segmenter.best_of(texts)):
        ids = [np.frombuffer(x, dtype="<u4").tolist() for _, x in found]
        assert [sum(value[i] for i in own) for own in ids] == [s for s, _ in found]
        assert [segmenter.decode(own) for own in ids] == [text] * 5 and len(set(map(tuple, ids))) == 5
        assert np.allclose([s for s, _ in segmenter.segment(text)], [s for s, _ in found])


def test_words_forgotten_and_kept_change_nothing(monkeypatch):
    r = random.Random(5)
    common = ["the", "cats", "don't", "é日", "Attion!!"]
    batches = [[" ".join(r.choices([*common, "w" + str(r.randint(0, 999))], k=30)) for _ in range(20)] for _ in range(6)]
    whole = segmentation.Segmenter(segmentation.default_pieces())
    expected = [whole.describe(b) for b in batches]
    monkeypatch.setattr(segmentation, "CACHED_WORDS", 12)
    small = segmentation.Segmenter(segmentation.default_pieces())
    for batch, rows in zip(batches, expected):
        assert small.describe(batch) == rows
        assert 0 < len(small._index) <= 12 and list(small._index.values()) == list(range(len(small._ids)))


@pytest.mark.parametrize("run", ["a", ".", " ", "日", "=-"])
def test_long_runs_take_linear_time(segmenter, run):
    segmenter.describe(["warm up"])
    began = time.process_time()
    assert segmenter.describe([run * 100_000])[0][3]
    assert time.process_time() - began < 4


def test_digests_of_the_query_are_those_of_the_encoded_ids(odd_docs):
    rows = odd_docs.filter("doc_id in (1, 2, 5, 9, 14)")
    encoded = {r.doc_id: r.segmentations for r in segmentation.encode(rows).collect()}
    for r in segmentation.segment_documents(rows).collect():
        ids = [np.array(s.ids, dtype="<u4").tobytes() for s in encoded[r.doc_id]]
        assert [zlib.crc32(x) for x in ids] == list(r.nbest_crc32) and r.nbest_crc32[0] == r.ids_crc32
        assert [s.score for s in encoded[r.doc_id]] == list(r.scores) and len(ids[0]) // 4 == r.n_pieces


def test_round_trip_of_odd_rows(odd_docs, odd_rows, no_docs):
    rows = segmentation.segment_documents(odd_docs).collect()
    assert len(rows) == len(odd_rows) and all(r.round_trip for r in rows)
    assert segmentation.segment_documents(no_docs).count() == 0
    some = odd_docs.filter("doc_id < 8 or doc_id in (9, 14)").dropDuplicates(["doc_id"])
    encoded = segmentation.encode(some)
    back = segmentation.decode(encoded.select("doc_id", F.expr("segmentations[0].ids").alias("ids"))).collect()
    texts = {r.doc_id: r.text or "" for r in some.collect()}
    assert {r.doc_id: r.text for r in back} == texts


# ---------------------------------------------------------------- quality trees


def test_trees_learn_an_interaction():
    r = np.random.default_rng(1)
    x = r.random((4_000, 5))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.4)).astype(float)
    trees = quality_trees.grow(x[:3_000], y[:3_000])
    assert ((trees.score(x[3_000:]) > 0.5) == (y[3_000:] > 0.5)).mean() > 0.97


def test_flat_traversal_equals_a_walk():
    r = np.random.default_rng(2)
    x, y = r.random((500, 4)), (r.random(500) < 0.4).astype(float)
    trees = quality_trees.grow(x, y, trees=7, depth=3)
    for row in x[:40]:
        margin = trees.start
        for t in range(7):
            at = 0
            while at < 7:
                at = 2 * at + 1 + int(row[trees.feature[t, at]] > trees.cut[t, at])
            margin += trees.value[t, at - 7]
        assert np.isclose(margin, trees.margin(row[None, :])[0])


def test_quality_of_documents_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_trees.described(docs)
    trees = quality_trees.learn(rows, labels.filter("doc_id % 5 <> 0"))
    held = quality_trees.classify(rows, trees).join(labels.filter("doc_id % 5 = 0"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    odd = quality_trees.classify(quality_trees.described(odd_docs), trees).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    nothing = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    flat = quality_trees.classify(rows, quality_trees.learn(rows, nothing)).collect()
    assert {r.score for r in flat} == {0.5}
    assert quality_trees.classify(quality_trees.described(no_docs), trees).count() == 0


# ---------------------------------------------------------------- language model


def test_gradients_equal_differences():
    v = gru_lm.Vocabulary({b"a": 0, b"b": 1}, np.array([5, 3]), 2, 10, 4, 2, {b"ing": 0}, np.array([0.0, 0.0]))
    model = gru_lm.Model.fresh(v)
    for name in model.__dataclass_fields__:
        setattr(model, name, getattr(model, name).astype(np.float64))
    token = np.array([[4, 0, 1, 2], [4, 3, 0, 1]])
    wanted, slot = np.array([[1, 1, 2, 0], [3, 1, 1, 0]]), np.array([[0, 1, -1, -1], [-1, 0, 1, -1]])
    fresh = np.zeros((2, 4), dtype=bool)
    fresh[:, 0] = True

    def loss():
        h, total = np.zeros((2, gru_lm.STATE)), 0.0
        for t in range(4):
            h = model.step(h, token[:, t])[0]
            total -= model.log_likelihood(h, wanted[:, t], slot[:, t]).sum()
        return total / token.size

    grads, _ = gru_lm._window(model, np.zeros((2, gru_lm.STATE)), token, wanted, slot, fresh)
    r = np.random.default_rng(0)
    for part, grad in zip(model.parts(), grads):
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in part.shape)
            old = part[at]
            part[at] = old + 1e-5
            up = loss()
            part[at] = old - 1e-5
            down = loss()
            part[at] = old
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-5


def test_side_by_side_likelihoods_equal_one_by_one():
    v = gru_lm.Vocabulary({b"a": 0}, np.array([5]), 2, 10, 4, 1, {b"ing": 0}, np.array([0.0, 0.0]))
    model = gru_lm.Model.fresh(v)
    r = np.random.default_rng(0)
    docs = [gru_lm.targets(v, r.integers(-1, 1, n), r.integers(0, 2, n)) for n in (0, 1, 7, 300, 3)]
    together = gru_lm.likelihoods(model, docs)
    assert np.allclose(together, [gru_lm.likelihoods(model, [d])[0] for d in docs], rtol=1e-4)


def test_probabilities_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "ENDINGS", 3)
    words = "the the the cat sat sitting running ing on mat mat dog".split()
    counts = spark.createDataFrame([(w.encode(), words.count(w)) for w in set(words)], "word binary, n long")
    v = gru_lm.learn_vocabulary(counts, 2, known=6, head=2)
    known = {w.encode(): words.count(w) for w in set(words)}
    for tail in range(len(v.endings) + 1):
        inside = [n for w, n in known.items() if v.tail(w) == tail and not 0 <= v.place.get(w, -1) < v.head]
        total = sum(n + gru_lm.ADDED for n in inside) + gru_lm.ADDED  # and one unseen word
        assert np.isclose(np.log10(total), v.class_log[tail])
    model = gru_lm.Model.fresh(v)
    h = np.random.default_rng(0).standard_normal((1, gru_lm.STATE)).astype(np.float32)
    classes = [model.log_likelihood(h, np.array([c]), np.array([-1]))[0] for c in range(v.classes)]
    assert np.isclose(np.exp(classes).sum(), 1, atol=1e-5)


def test_language_model_of_odd_rows(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    monkeypatch.setattr(gru_lm, "KNOWN_WORDS", 50)  # most words meet their counts in the join
    training = odd_docs.filter("doc_id <> 8 or doc_id is null")
    counts_of = {}
    documents = 0
    for i, t, _ in odd_rows:
        if i != 8:
            documents += 1
            for w in gru_lm.words_of((t or "").encode()):
                counts_of[w] = counts_of.get(w, 0) + 1
    v, model, counts = gru_lm.learn(training)
    v = gru_lm.learn_vocabulary(counts, documents, known=50, head=10)
    model = gru_lm.Model.fresh(v)
    rows = gru_lm.score(odd_docs, v, model, counts).collect()
    tokens, types = sum(counts_of.values()) + documents, len(counts_of) + 1
    expected = []
    for _, t, _ in odd_rows:
        words = gru_lm.words_of((t or "").encode())
        each = [np.log10((counts_of.get(w, 0) + 0.1) / (tokens + 0.1 * (types + 1))) for w in words]
        base = sum(each) + np.log10((documents + 0.1) / (tokens + 0.1 * (types + 1)))
        expected.append((len(words) + 1, sum(w in counts_of for w in words) + 1, round(float(base), 4)))
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == sorted(expected)
    assert {r.train_tokens for r in rows} == {tokens}
    assert all(r.score < 0 for r in rows)
    empty_v, empty_model, empty_counts = gru_lm.learn(no_docs)
    assert gru_lm.score(odd_docs, empty_v, empty_model, empty_counts).count() == len(odd_rows)
    assert gru_lm.score(no_docs, v, model, counts).count() == 0


def test_words_of_a_batch_equal_words_of_each_text():
    texts = [b" The cat,\tthe\x0bCAT\x0c", None, b"", b" \r\n", "\u00c4B\u00a0c \u2003d\x85e".encode(), b"\xff(A \xc3 a\x1cb\x00 ...", b"the running;"]
    v = gru_lm.Vocabulary({b"the": 0, b"cat,": 1}, np.array([5, 3]), 2, 10, 4, 1, {b"ing": 0, b"": 1, b"cat": 2}, np.zeros(4))
    for array in (pa.array(texts, pa.binary()), pa.array([b"x", *texts], pa.binary())[1:]):
        counts, places, words = gru_lm.batch_words(array)
        each = [gru_lm.words_of(t) for t in texts]
        flat = [w for found in each for w in found]
        assert counts.tolist() == [len(found) for found in each] and [words[i].as_py() for i in places.tolist()] == flat
        at, tails = v.lookup()(words)
        assert at[places].tolist() == v.places(flat).tolist() and tails[places].tolist() == [v.tail(w) for w in flat]
        documents = list(gru_lm.batch_targets(v, at[places], tails[places], counts))
        for found, document in zip(each, documents, strict=True):
            alone = gru_lm.targets(v, v.places(found), np.array([v.tail(w) for w in found], dtype=np.int64))
            assert all(np.array_equal(a, b) for a, b in zip(alone, document))


def test_gradients_of_windows_add_up_over_their_live_tokens():
    v = gru_lm.Vocabulary({b"a": 0, b"b": 1}, np.array([5, 3]), 2, 10, 4, 2, {b"ing": 0}, np.zeros(2))
    model = gru_lm.Model.fresh(v)
    model.class_bias[1] = 200  # its exponential is not finite in single precision
    r = np.random.default_rng(0)
    documents = [gru_lm.targets(v, r.integers(-1, 2, n), r.integers(0, 2, n)) for n in (3, 40, 0, 17)]
    sums = gru_lm.Model(*(np.zeros_like(p) for p in model.parts()))
    expected = [np.zeros_like(p) for p in model.parts()]
    for busy, *window in gru_lm.windows(iter(documents), 3):
        h = np.zeros((len(busy), gru_lm.STATE), dtype=np.float32)
        mean, after = gru_lm._window(model, h, *window)
        assert np.array_equal(after, gru_lm._window(model, h, *window, sums)[1])
        expected = [e + g * window[-1].sum() for e, g in zip(expected, mean)]
    assert all(np.isfinite(g).all() and np.allclose(g, e, atol=1e-4) for g, e in zip(sums.parts(), expected))


def test_windows_hold_whole_documents_with_one_end_each():
    lengths = (1, 40, 3, 700, 16, 2)
    docs = [tuple(np.arange(n) + 1_000 * i + k for k in range(3)) for i, n in enumerate(lengths)]
    seen = {}
    for busy, token, wanted, slot, fresh, live in gru_lm.windows(iter(docs), 2):
        assert np.array_equal(wanted[live], token[live] + 1) and np.array_equal(slot[live], token[live] + 2)
        for k, i in enumerate(busy):
            seen.setdefault(i, []).extend(zip(token[k, live[k]].tolist(), fresh[k, live[k]].tolist()))
    found = [x for rows in seen.values() for x in rows]
    assert sorted(t for t, _ in found) == sorted(int(t) for d in docs for t in d[0])
    for rows in seen.values():  # in order, and fresh only where a document begins
        assert all(new == (t % 1_000 == 0) and (new or rows[k - 1][0] == t - 1) for k, (t, new) in enumerate(rows))


def test_all_training_tokens_are_trained_on(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "TRAINER_TOKENS", 3_000)  # several rounds and several tasks
    monkeypatch.setattr(gru_lm, "PASS_TOKENS", 1)
    rows = [(i, " ".join(f"w{(i + k) % 7}" for k in range(20 + i % 30))) for i in range(2_000)] + [(None, "b a " * 4_000), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    v = gru_lm.learn_vocabulary(gru_lm.count_words(docs).cache(), docs.count())
    model, trained = gru_lm.learn_model(docs, v)
    assert trained == v.tokens == sum(len((t or "").split()) + 1 for _, t in rows)
    seven = gru_lm.targets(v, v.places([b"w%d" % (k % 7) for k in range(30)]), np.zeros(30, dtype=np.int64))
    fresh = gru_lm.Model.fresh(v)
    assert gru_lm.likelihoods(model, [seven])[0] > gru_lm.likelihoods(fresh, [seven])[0] + 20


# ---------------------------------------------------------------- URL lists


def brute_verdict(url, time, entries):
    best = None
    if url is None or time is None:
        return "none"
    host, _, path = url.split("://", 1)[1].partition("/")
    full = host + "/" + path.split("?")[0].split("#")[0].strip("/") + "/"
    for name, pattern in {(e[0], e[1]) for e in entries}:
        own = sorted(e for e in entries if (e[0], e[1]) == (name, pattern) and e[4] <= time)
        own.sort(key=lambda e: e[4])
        if own and own[-1][2] == "add" and (full.startswith(pattern + "/") or f".{pattern}/" in full.partition("/")[0] + "/" + full.partition("/")[2] and full.partition("/")[0].endswith("." + pattern.partition("/")[0])):
            rank = (len(pattern), own[-1][4], [-ord(c) for c in name])
            if best is None or rank > best[0]:
                best = (rank, own[-1][3])
    return best[1] if best else "none"


def test_captures_meet_entries_of_their_time(spark):
    day = lambda d, m=1, y=2024: datetime(y, m, d)
    entries = [
        ("a", "x.example.org", "add", "block", day(5)),
        ("a", "x.example.org", "remove", "block", day(10)),
        ("a", "x.example.org", "add", "block", day(3, 4)),
        ("b", "example.org", "add", "block", day(7)),
        ("b", "example.org", "remove", "block", day(20, 6, 2025)),
        ("c", "x.example.org/en", "add", "allow", day(6)),
        ("d", "x.example.org/en", "add", "block", day(6)),
        ("d", "gone.example.net", "remove", "block", day(1)),
        ("e", "late.example.net", "add", "block", day(1, 1, 2030)),
    ]
    urls = ["http://x.example.org/en/1?q#f", "https://x.example.org", "http://y.example.org/en", "http://late.example.net/a", "http://gone.example.net/", "http://example.com/x.example.org/", None, "not a url"]
    times = [day(1), day(5), day(6), day(9), day(10), day(11), day(3, 4), day(1, 12), day(20, 6, 2025), None]
    captures = [(i, u, t, "mine", 1) for i, (u, t) in enumerate((u, t) for u in urls for t in times)]
    captures.append(captures[3])
    rows = spark.createDataFrame(captures, "id long, url string, fetched_at timestamp, _time string, verdict int")
    listed = spark.createDataFrame(entries + [(None, "z", "add", "block", day(1))], "list_name string, pattern string, action string, verdict string, listed_at timestamp")
    got = url_lists.evaluate(rows, listed)
    assert got.columns == ["id", "url", "fetched_at", "_time", *url_lists.RESULT]
    found = got.collect()
    assert len(found) == len(captures) and {r["_time"] for r in found} == {"mine"}
    for r in found:
        usable = r.url is not None and "://" in r.url
        assert r.verdict == (brute_verdict(r.url, r.fetched_at, entries) if usable else "none"), r
    none = url_lists.evaluate(rows, listed.limit(0)).collect()
    assert {r.verdict for r in none} == {"none"} and len(none) == len(captures)
    assert url_lists.evaluate(rows.limit(0), listed).count() == 0
    assert "Python" not in got._jdf.queryExecution().toString()


def test_patterns_of_any_depth_match(spark):
    at = datetime(2024, 1, 1)
    deep = "a.b.c.d.e.f.g.h.example.org"  # ten labels
    patterns = ["x.example.org/a/b/c", "p.x.example.org/A/b/c/d/e", deep, "b.c.d.e.f.g.h.example.org/one", "a.b.c.d.e.f.g.h", "h.example.org"]
    entries = spark.createDataFrame([("l", p, "add", p, at) for p in patterns], "list_name string, pattern string, action string, verdict string, listed_at timestamp")
    expected = {
        "http://x.example.org/a/b/c/d": "x.example.org/a/b/c",
        "http://p.x.example.org/A//b/c/d/e?q": "p.x.example.org/A/b/c/d/e",
        "http://p.x.example.org/a/b/": "none",
        f"http://{deep}/two": deep,
        f"http://z.{deep}/": deep,
        "http://z.b.c.d.e.f.g.h.example.org/one/two": "b.c.d.e.f.g.h.example.org/one",
        "http://z.b.c.d.e.f.g.h.example.org/": "h.example.org",
    }
    rows = spark.createDataFrame([(u, at) for u in expected], "url string, fetched_at timestamp")
    assert {r.url: r.verdict for r in url_lists.evaluate(rows, entries).collect()} == expected
