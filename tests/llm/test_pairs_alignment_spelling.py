"""Operators 11 to 13 against brute force, and over the rows that every operator has to stand."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import words as some_words
from tidemark.llm import alignment, jaccard_fragments, spelling

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# ---------------------------------------------------------------- Jaccard join


def shingle_set(text, size=4):
    found = SPLIT.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def brute_groups(rows):
    """(doc_id, set size, smallest id reachable) of every row; rows of equal sets are one node."""
    sets = [shingle_set(t) for _, t in rows]
    distinct = list({s: None for s in sets if s})
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(distinct)), 2):
        a, b = distinct[i], distinct[j]
        if 100 * len(a & b) >= 85 * len(a | b):
            root[find(i)] = find(j)
    place = {s: find(i) for i, s in enumerate(distinct)}
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            least[place[s]] = min(doc_id, least.get(place[s], doc_id))
    return [(d, len(s), least.get(place[s]) if s else d) for (d, _), s in zip(rows, sets)]


def plain(rows):
    return sorted(map(tuple, rows), key=str)


def edited(text, seed, edits):
    r = random.Random(seed)
    parts = text.split(" ")
    for at in r.sample(range(len(parts)), edits):
        parts[at] = f"edit{seed}x{at}"
    return " ".join(parts)


@pytest.fixture(scope="module")
def crowd():
    """A base text with many near copies (some beyond the similarity), a second one, and passages
    that many texts share."""
    base, other, passage = some_words(1, 90), some_words(2, 60), some_words(3, 40)
    rows = [(i, edited(base, i, i % 4)) for i in range(60)]
    rows += [(100 + i, edited(other, i, i % 3)) for i in range(30)]
    rows += [(200 + i, some_words(200 + i, 50) + " " + passage + " " + some_words(300 + i, 40)) for i in range(30)]
    rows += [(300 + i, " ".join(some_words(7, 9).split(" ")[: 1 + i % 9])) for i in range(12)]
    return rows


@pytest.mark.parametrize("crowded", [jaccard_fragments.CROWDED, 3])
def test_groups_equal_brute_force(spark, odd_docs, crowd, crowded):
    docs = spark.createDataFrame(crowd, "doc_id long, text string").repartition(5)
    got = jaccard_fragments.group_documents(docs, crowded=crowded).collect()
    assert plain(got) == plain(brute_groups(crowd))


def test_groups_of_generated_documents(spark, small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert plain(jaccard_fragments.group_documents(small_docs).collect()) == plain(brute_groups(rows))


def test_links_within_a_chain_reach_its_ends(spark, odd_docs):
    """Each text is near its neighbours only; the chain is one component."""
    text = some_words(5, 120).split(" ")
    rows = [(50 - i, " ".join(text[2 * i : 2 * i + 60])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard_fragments.group_documents(docs, crowded=2).collect()} == {31}


def test_groups_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = jaccard_fragments.group_documents(odd_docs).collect()
    assert plain(got) == plain(brute_groups([(i, t) for i, t, _ in odd_rows]))
    assert jaccard_fragments.group_documents(no_docs).collect() == []


# ---------------------------------------------------------------- alignment


def brute_alignment(texts):
    tool = alignment.PairAligner(*alignment.default_vocabularies())
    found, documents = [], Counter()
    for text in texts:
        row = None
        if text:
            (a,), (b,) = tool.whole_ids([text])
            spelt = (" " + text).encode()
            if b"".join(tool.bytes_a[i] for i in a) == spelt == b"".join(tool.bytes_b[i] for i in b):
                ends = [np.cumsum([len(of[i]) for i in ids]).tolist() for of, ids in ((tool.bytes_a, a), (tool.bytes_b, b))]
                groups, x, y = [], 0, 0
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    p, q = ends[0].index(cut) + 1, ends[1].index(cut) + 1
                    groups.append((a[x:p], b[y:q]))
                    x, y = p, q
                links = [(s, t) for g, h in groups for s in g for t in h]
                documents.update(set(links))
                row = a, b, groups, links
        found.append(row)
    top = defaultdict(int)
    for (s, _), n in documents.items():
        top[s] = max(top[s], n)
    result = []
    for row in found:
        if row is None:
            result.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = row
        line = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        best = sum(documents[x] == top[x[0]] for x in links)
        digest = hashlib.sha256(line.encode()).hexdigest()
        result.append((len(a), len(b), len(groups), len(links), best, sum(documents[x] for x in links), digest))
    return result


ODD_TEXTS = [
    "", None, " ", "\n", "a", "a  b", "\n\na\nb", "x▁y", "<|endoftext|> hi <s> </s>", "a\xa0b c", "<0x41> b", "日本語 テスト\nです",
    " lead", "trail ", "a \n b", "\ta\tb", "\r\nx\r\ny", "é a", "don't 'll we're\n's", "a\x1cb c\x85d", "x\x00y z", "aaaa " * 50,
]


@pytest.mark.parametrize("known", [alignment.KNOWN_PAIRS, 20])
def test_alignment_equals_brute_force(spark, small_docs, known):
    r = random.Random(4)
    alphabet = ["a", "b", " ", "  ", "\n", "\n\n", "é", "▁", "日", ".", ",", "the", "\t", "\xa0", "1", "<", "'s"]
    texts = ODD_TEXTS + ["".join(r.choices(alphabet, k=r.randint(1, 30))) for _ in range(400)]
    texts += [row.text for row in small_docs.collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {row.doc_id: tuple(row)[1:] for row in alignment.align(docs, known_pairs=known).collect()}
    assert [got[i] for i in range(len(texts))] == brute_alignment(texts)


def test_pointers_meet_at_the_last_token():
    r = random.Random(5)
    for _ in range(50):
        size = r.randint(1, 60)
        ends = [np.array(sorted({*r.sample(range(1, size + 1), r.randint(1, size)), size})) for _ in range(2)]
        a, b = alignment.groups_of(*ends)
        cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        assert a.tolist() == np.searchsorted(cuts, ends[0]).tolist()
        assert b.tolist() == np.searchsorted(cuts, ends[1]).tolist()


def test_alignment_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = sorted(map(str, (tuple(r)[1:] for r in alignment.align(odd_docs).collect())))
    assert got == sorted(map(str, brute_alignment([t for _, t, _ in odd_rows])))
    assert alignment.align(no_docs).collect() == []


# ---------------------------------------------------------------- spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_spelling(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            value = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if value % 31 == 0:
                run = run[: value % len(run)] + run[value % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    result, form, near = [], {}, {}
    for w in counts:
        near[w] = [x for x in counts if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        result.append((w, form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None))
    return result


@pytest.fixture(scope="module")
def misspelt():
    r = random.Random(6)
    bases = ["".join(r.choices("abcdeéÿ", k=r.randint(7, 16))) for _ in range(25)]
    words = []
    for base in bases:
        words += [base] * r.choice([2, 30, 400])
        for _ in range(12):
            at, letter = r.randrange(len(base)), r.choice("abcdeéÿ")
            other = r.choice([base[:at] + base[at + 1 :], base[:at] + letter + base[at:], base[:at] + letter + base[at + 1 :]])
            words += [other] * r.choice([1, 2, 3, 40])
    r.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    return rows + [(None, " ".join(words[:50])), (3, "abcdefgh" * 200 + " " + "abcdefgh" * 200), (3, "ABCDEFGH abcdefgh")]


@pytest.mark.parametrize("long_list", [spelling.LONG_LIST, 1])
def test_variants_equal_brute_force(spark, odd_docs, misspelt, long_list):
    docs = spark.createDataFrame(misspelt, "doc_id long, text string").repartition(4)
    got = spelling.variants(docs, long_list).collect()
    expected = brute_spelling(misspelt)
    assert plain(got) == plain(expected)
    assert any(r.root != r.form for r in got if r.form)  # a chain of forms


@pytest.mark.parametrize("letters", ["ab", "abé日"])
def test_scan_finds_every_pair_of_its_lists(letters):
    r = random.Random(7)
    for size in (1, 2, 9, 120):
        words = sorted({"".join(r.choices(letters, k=r.randint(1, 7))) for _ in range(size)})
        groups = np.sort([r.randrange(2) for _ in words])
        a, b = spelling.scan(groups, words)
        pairs = itertools.combinations(range(len(words)), 2)
        assert sorted(zip(a.tolist(), b.tolist())) == [
            (i, j) for i, j in pairs if groups[i] == groups[j] and one_edit(words[i], words[j])
        ]


def test_keys_before_a_key():
    """A pair goes to the first key that it shares, at every halving."""
    assert spelling.earlier_keys(8, 6, 0) == []
    assert spelling.earlier_keys(8, 4, 2) == [(6, 0)]
    assert spelling.earlier_keys(8, 2, 4) == [(4, 0)]
    assert spelling.earlier_keys(8, 0, 6) == [(4, 0), (2, 4)]


def test_variants_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = spelling.variants(odd_docs).collect()
    assert plain(got) == plain(brute_spelling([(i, t) for i, t, _ in odd_rows]))
    assert spelling.variants(no_docs).collect() == []
