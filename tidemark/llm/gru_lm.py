"""A gated recurrent language model in numpy that scores whole documents.

**Counts.** Words of all training documents are counted in Spark. They give the unigram base, and
inside rare classes the probability of a word.

**Model.** One GRU layer over token inputs and a class-factored output: P(word | history) =
P(class | state) * P(word | class, state). The most frequent ``HEAD_WORDS`` words stand in classes
of ``CLASS_WORDS`` with a learned softmax inside the class; every other word belongs to the class
of its ending, in which its count plus 0.1 decides (one unseen word included); the end of the text
is a class of its own. So all probabilities sum to one, whatever the vocabulary's size.

**Training.** Truncated back-propagation through time over all training documents, in Spark. Every
task trains on its documents, whole and side by side, a window at a time; a state is carried from
window to window and begins anew at a document, and the end stands only at a document's end. The
documents are dealt by hash to rounds (``ROUNDS``), each larger than those before; after a round the
tasks' weights are averaged by their tokens and start the next. Small tables are passed over again,
up to ``MOST_PASSES`` times. The driver gets one averaged model a round and no text.

**Scoring.** Documents advance side by side, a window of states at a time; the state is carried
over all windows of a document, so that the likelihood is that of the complete text. Counts of the
``KNOWN_WORDS`` most frequent words are sent to all tasks; other words meet their counts in a join.

Defined results: NULL text is empty and has the end token only; A-Z are lower-cased; a word is a run
of bytes other than ASCII white space; documents without id are trained on and scored like others;
repeated rows are each trained on and scored; weights depend on how rows lie in tasks; without training documents the model is uniform over classes; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import HASH_STEPS, hash_place, spread, stage

KNOWN_WORDS = 100_000
HEAD_WORDS = 1_000
CLASS_WORDS = 50
ENDINGS = 160
STATE = 24
ADDED = 0.1

STREAMS = 128
WINDOW = 16
# A round ends at this share of the documents; weights are averaged after each.
ROUNDS = (1 / 64, 1 / 16, 1 / 4, 1)
# Tokens a task trains on at least before its weights are averaged with others'.
TRAINER_TOKENS = 500_000
# Tables of fewer tokens are passed over more than once.
PASS_TOKENS, MOST_PASSES = 1_500_000, 8
RATE = 0.01
# Weights sent in one row.
BLOCK = 8_192
SEED = 7

COUNTED_AT_ONCE = 500_000
# Bytes of text whose documents advance side by side in scoring, and states whose outputs are made at once.
SCORED_AT_ONCE = 8 << 20
STATES_AT_ONCE = 2_048
# Logits within this of zero have exponentials that neither overflow nor vanish in single precision.
SAFE = 60

TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MARKS = b".,;:!?|()\"'*#$%&"


def words_of(text: bytes | None) -> list[bytes]:
    """``bytes.split`` cuts at the six ASCII white-space characters."""
    return (text or b"").translate(TO_LOWER).split()


def ending_of(word: bytes) -> bytes:
    return word.rstrip(_MARKS)[-3:]


def endings_of(words: pa.Array) -> pa.Array:
    """``ending_of`` of binary words."""
    stems = pc.ascii_rtrim(words.view(pa.string()), characters=_MARKS.decode())
    return pc.binary_slice(stems.view(pa.binary()), -3)


def _one_thread() -> None:
    """Products of small matrices in the task's own thread; others would only wait beside it."""
    for path in (Path(np.__file__).parents[1] / "numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def _texts(docs: DataFrame, *others: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"), *others
    )


def batch_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a batch of texts: how many each has, and each word's place among the distinct ones returned.

    The words are those of ``words_of``; Arrow's kernels used here work on bytes.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"").view(pa.large_string())
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, offsets = cut.flatten(), cut.offsets.to_numpy()
    whole = pc.greater(pc.binary_length(words), 0)  # borders of a text that begins or ends with white space
    counts = np.diff(np.append(0, np.cumsum(whole.to_numpy(zero_copy_only=False)))[offsets - offsets[0]])
    coded = words.filter(whole).dictionary_encode()
    return counts, coded.indices.to_numpy(), coded.dictionary.view(pa.large_binary()).cast(pa.binary())


def count_words(training: DataFrame) -> DataFrame:
    """``word``, ``n`` over all given documents; words are counted per task before the shuffle."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return found.rename_columns({"n_sum": "n"}).select(["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            _, places, words = batch_words(batch["text"])
            parts.append(pa.table({"word": words, "n": np.bincount(places, minlength=len(words))}))
            rows += len(words)
            if rows > COUNTED_AT_ONCE:
                parts = [summed(parts)]
                rows = len(parts[0])
                if 2 * rows > COUNTED_AT_ONCE:
                    yield from parts[0].to_batches()
                    parts, rows = [], 0
        if parts:
            yield from summed(parts).to_batches()

    counted = spread(_texts(training)).select("text").mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Counts and classes. Classes: 0 the end, then head classes, then one per ending, then the rest.

    Inputs: head words by rank, then endings, the rest, and the start of a text.
    """

    place: dict[bytes, int]  # of the most frequent words, by rank
    count: np.ndarray
    documents: int
    tokens: int
    types: int
    head: int
    endings: dict[bytes, int]
    class_log: np.ndarray  # log10 of what counts in an ending's class are divided by

    @property
    def head_classes(self) -> int:
        return -(-self.head // CLASS_WORDS)

    @property
    def classes(self) -> int:
        return 1 + self.head_classes + len(self.endings) + 1

    @property
    def inputs(self) -> int:
        return self.head + len(self.endings) + 2

    def tail(self, word: bytes) -> int:
        return self.endings.get(ending_of(word), len(self.endings))

    def places(self, words: list[bytes]) -> np.ndarray:
        find = self.place.get
        return np.array([find(w, -1) for w in words], dtype=np.int64)

    def lookup(self) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
        """What gives the rank (-1: rare) and the ending class of each word of a binary array."""
        known, ends = pa.array(list(self.place), pa.binary()), pa.array(list(self.endings), pa.binary())

        def place(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            at, tail = pc.index_in(words, value_set=known), pc.index_in(endings_of(words), value_set=ends)
            return at.fill_null(-1).to_numpy(), tail.fill_null(len(ends)).to_numpy()

        return place

    @property
    def base_log(self) -> float:
        return float(np.log10(self.tokens + ADDED * (self.types + 1)))


def learn_vocabulary(counts: DataFrame, documents: int, known: int = KNOWN_WORDS, head: int = HEAD_WORDS) -> Vocabulary:
    """``counts``: staged word counts. What reaches the driver is bounded by ``known`` and ``ENDINGS``."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("types")).first()
    # words of about the wanted frequency and more, so that no task sorts many times as many
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("size")).agg(F.count(F.lit(1)).alias("types")).collect()
    least, found = 0, 0
    for size, types in sorted(sizes, reverse=True):
        least, found = size, found + types
        if found >= known:
            break
    top = counts.filter(F.col("n") >= 1 << least).orderBy(F.desc("n"), "word").limit(known).toPandas()
    words = [bytes(w) for w in top["word"]]
    n = top["n"].to_numpy(dtype=np.int64)
    head = min(head, len(words))

    def endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"ending": endings_of(batch["word"].cast(pa.binary())), "n": batch["n"]})

    ended = counts.select("word", "n").mapInArrow(endings, "ending binary, n long")
    by_ending = ended.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"))
    chosen = {bytes(r["ending"]): (r["n"], r["types"]) for r in by_ending.orderBy(F.desc("n"), "ending").limit(ENDINGS).collect()}
    index = {e: i for i, e in enumerate(chosen)}
    mass = np.array([v[0] for v in chosen.values()] + [total["n"] - sum(v[0] for v in chosen.values())], dtype=float)
    types = np.array([v[1] for v in chosen.values()] + [total["types"] - sum(v[1] for v in chosen.values())], dtype=float)
    for word, k in zip(words[:head], n[:head]):  # head words have classes of their own
        at = index.get(ending_of(word), len(index))
        mass[at] -= k
        types[at] -= 1
    return Vocabulary(
        place={w: i for i, w in enumerate(words)},
        count=n,
        documents=documents,
        tokens=total["n"] + documents,
        types=total["types"] + (documents > 0),
        head=head,
        endings=index,
        class_log=np.log10(mass + ADDED * (types + 1)),
    )


# ---------------------------------------------------------------- model


@dataclass
class Model:
    """Parameters. ``inputs`` holds each input's contribution to the three gates."""

    inputs: np.ndarray
    recur: np.ndarray
    candidate: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    inside: np.ndarray
    inside_bias: np.ndarray

    @classmethod
    def fresh(cls, v: Vocabulary, seed: int = SEED) -> "Model":
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) * 0.1).astype(np.float32)
        slots = np.full((v.head_classes, CLASS_WORDS), -30.0, dtype=np.float32)
        slots.reshape(-1)[: v.head] = np.log(v.count[: v.head] + 1.0) if v.head else 0
        return cls(
            draw(v.inputs, 3 * STATE), draw(STATE, 2 * STATE), draw(STATE, STATE), draw(STATE, v.classes),
            np.zeros(v.classes, np.float32), draw(v.head_classes, CLASS_WORDS, STATE), slots,
        )

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.recur, self.candidate, self.classes, self.class_bias, self.inside, self.inside_bias]

    def step(self, h: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Next state, update gate, reset gate, candidate."""
        return self.advance(h, self.inputs.take(token, axis=0))

    def advance(self, h: np.ndarray, x: np.ndarray, gates=None, new=None, following=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The step with the tokens' rows of ``inputs`` at hand; the others are arrays for what it makes."""
        gates = np.matmul(h, self.recur, out=gates)
        gates += x[:, : 2 * STATE]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        update, reset = gates[:, :STATE], gates[:, STATE:]
        new = np.matmul(reset * h, self.candidate, out=new)
        new += x[:, 2 * STATE :]
        np.tanh(new, out=new)
        following = np.subtract(new, h, out=following)
        following *= update
        following += h
        return following, update, reset, new

    def outputs(self) -> "Outputs":
        return Outputs(
            np.vstack((self.classes, self.class_bias)), np.concatenate((self.inside, self.inside_bias[:, :, None]), axis=2),
            # states lie between -1 and 1
            float((np.abs(self.classes).sum(axis=0) + np.abs(self.class_bias)).max(initial=0)) < SAFE,
        )

    def log_likelihood(self, h: np.ndarray, wanted: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Natural log of class and head-word probabilities. ``slot``: place in a head class or -1."""
        outputs, states = self.outputs(), _with_one(h)
        logits = outputs.class_logits(states)
        found = logits[np.arange(len(logits)), wanted]
        found -= np.log(_exponentials(logits))
        rows, cuts = by_class(wanted, slot)
        if len(rows):
            logits = outputs.inner_logits(states.take(rows, axis=0), cuts)
            found[rows] += logits[np.arange(len(rows)), slot[rows]] - np.log(_exponentials(logits))
        return found


@dataclass
class Outputs:
    """Output weights with their biases as the last row, for states with a one behind them.

    The logits given are steady: their exponentials are finite and do not all vanish.
    """

    classes: np.ndarray
    inside: np.ndarray
    steady: bool

    def class_logits(self, states: np.ndarray) -> np.ndarray:
        logits = states @ self.classes
        return logits if self.steady else _steady(logits)

    def inner_logits(self, states: np.ndarray, cuts: list[tuple[int, int, int]]) -> np.ndarray:
        """Logits of the words of each row's head class; rows stand by class, as ``by_class`` orders them."""
        logits = np.empty((len(states), CLASS_WORDS), dtype=np.result_type(states, self.inside))
        for c, begin, end in cuts:
            np.matmul(states[begin:end], self.inside[c].T, out=logits[begin:end])
        return _steady(logits)


def _with_one(states: np.ndarray) -> np.ndarray:
    found = np.empty((len(states), STATE + 1), dtype=states.dtype)
    found[:, :STATE] = states
    found[:, STATE] = 1
    return found


def _sorting(values: np.ndarray) -> np.ndarray:
    """A stable order; small numbers are sorted by digits."""
    narrow = len(values) and values.max() < 1 << 16
    return np.argsort(values.astype(np.uint16) if narrow else values, kind="stable")


def by_class(wanted: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Rows of head words ordered by class, and (head class, begin, end) of each class among them."""
    rows = np.flatnonzero(slot >= 0)
    found = wanted[rows]
    order = _sorting(found)
    rows, found = rows[order], found[order]
    ends = np.append(np.flatnonzero(np.diff(found)) + 1, len(found)).tolist()
    return rows, [(int(found[begin]) - 1, begin, end) for begin, end in zip([0, *ends], ends) if end > begin]


def _steady(logits: np.ndarray) -> np.ndarray:
    """In place, rows of logits shifted where their exponentials might not be finite."""
    if not (logits.min() > -SAFE and logits.max() < SAFE):
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _exponentials(logits: np.ndarray) -> np.ndarray:
    """In place; returns the sums of the rows."""
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], dtype=logits.dtype)


def targets(v: Vocabulary, places: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input, class and slot of each token from its rank (-1: rare) and ending class; the end follows."""
    return next(iter(batch_targets(v, places, tails, np.array([len(places)]))))


def batch_targets(
    v: Vocabulary, places: np.ndarray, tails: np.ndarray, counts: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``targets`` of documents whose words stand one behind the other, ``counts`` words each."""
    head = (places >= 0) & (places < v.head)
    at = np.arange(len(places)) + np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts + 1) - 1
    begins = ends - counts
    token, wanted, slot = (np.empty(len(places) + len(counts), dtype=np.int32) for _ in range(3))
    token[at + 1] = np.where(head, places, v.head + tails)
    token[begins] = v.inputs - 1
    wanted[at] = np.where(head, 1 + places // CLASS_WORDS, 1 + v.head_classes + tails)
    wanted[ends] = 0
    slot[at] = np.where(head, places % CLASS_WORDS, -1)
    slot[ends] = -1
    for begin, end in zip(begins.tolist(), (ends + 1).tolist()):
        yield token[begin:end], wanted[begin:end], slot[begin:end]


@dataclass
class Progress:
    """Weights and the running moments of their gradients, flat, with what they have seen."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: float = 0.0
    tokens: int = 0

    @classmethod
    def fresh(cls, v: Vocabulary, seed: int = SEED) -> "Progress":
        weights = _flat(Model.fresh(v, seed).parts())
        return cls(weights, np.zeros_like(weights), np.zeros_like(weights))

    def model(self, v: Vocabulary) -> Model:
        """Views of the weights."""
        return _views(self.weights, v)


def _views(values: np.ndarray, v: Vocabulary) -> Model:
    """Parameters, or what belongs to each, as parts of one flat array."""
    shapes = [p.shape for p in Model.fresh(v).parts()]
    cuts = np.cumsum([int(np.prod(shape)) for shape in shapes])[:-1]
    return Model(*(part.reshape(shape) for part, shape in zip(np.split(values, cuts), shapes)))


def _flat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parts])


def windows(documents: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], streams: int) -> Iterator[tuple]:
    """Windows (streams with tokens, token, wanted, slot, fresh, live) over whole documents.

    A document stands in one stream from its start to its end; a stream whose document ends takes
    the next one.
    """
    held = [np.empty((4, 0), dtype=np.int32)] * streams
    places = [0] * streams
    more = True
    while True:
        for i, rows in enumerate(held):
            n = rows.shape[1] - places[i]
            if n >= WINDOW or not more:
                continue
            found = [rows[:, places[i] :]]
            while n < WINDOW and (document := next(documents, None)) is not None:
                rows = np.zeros((4, len(document[0])), dtype=np.int32)
                rows[0], rows[1], rows[2] = document
                rows[3, 0] = 1
                found.append(rows)
                n += rows.shape[1]
            more = n >= WINDOW
            held[i], places[i] = np.concatenate(found, axis=1), 0
        busy = [i for i, rows in enumerate(held) if rows.shape[1] > places[i]]
        if not busy:
            return
        block = np.zeros((4, len(busy), WINDOW), dtype=np.int32)
        live = np.ones((len(busy), WINDOW), dtype=bool)
        for k, i in enumerate(busy):
            cut = held[i][:, places[i] : places[i] + WINDOW]
            places[i] += WINDOW
            if cut.shape[1] == WINDOW:
                block[:, k] = cut
            else:
                block[:, k, : cut.shape[1]] = cut
                live[k, cut.shape[1] :] = False
        yield busy, block[0], block[1], block[2], block[3] == 1, live


def train(v: Vocabulary, documents: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], start: Progress, streams: int = STREAMS) -> Progress:
    """Truncated back-propagation with Adam over all tokens of the documents.

    Where few streams have tokens left, gradients of several windows make one step.
    """
    at = Progress(start.weights.copy(), start.first.copy(), start.second.copy(), start.steps)
    model = at.model(v)
    h = np.zeros((streams, STATE), dtype=np.float32)
    enough = streams * WINDOW // 2
    gathered, waiting = np.zeros_like(at.weights), 0
    sums, change = _views(gathered, v), np.empty_like(at.weights)

    def step() -> None:
        gathered[:] /= np.float32(waiting)
        np.clip(gathered, -0.1, 0.1, out=gathered)
        at.steps += 1
        rate = RATE / (1 + at.steps / 2_000) * np.sqrt(1 - 0.999**at.steps) / (1 - 0.9**at.steps) * min(1, waiting / enough)
        np.subtract(gathered, at.first, out=change)
        change[:] *= 0.1
        at.first += change
        np.multiply(gathered, gathered, out=change)
        change[:] -= at.second
        change[:] *= 0.001
        at.second += change
        np.sqrt(at.second, out=change)
        change[:] += 1e-6
        np.divide(at.first, change, out=change)
        change[:] *= np.float32(rate)
        at.weights -= change

    for busy, token, wanted, slot, fresh, live in windows(documents, streams):
        _, h[busy] = _window(model, h[busy], token, wanted, slot, fresh, live, sums)
        n = int(live.sum())
        waiting += n
        at.tokens += n
        if waiting >= enough:
            step()
            gathered[:], waiting = 0, 0
    if waiting:
        step()
    return at


def _window(model: Model, h: np.ndarray, token, wanted, slot, fresh, live=None, sums: Model | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Mean gradients over the live tokens of one window, and the state behind it.

    Where ``sums`` is given, the tokens' gradients are added to it instead.
    """
    streams, length = token.shape
    ids = token.T.ravel()
    x = model.inputs.take(ids, axis=0).reshape(length, streams, -1)
    begins = fresh.any(axis=0).tolist()
    kind = np.result_type(h, x)
    before, new, after = (np.empty((length, streams, STATE), dtype=kind) for _ in range(3))
    gates = np.empty((length, streams, 2 * STATE), dtype=kind)
    for t in range(length):
        before[t] = h
        if begins[t]:
            before[t][fresh[:, t]] = 0
        h = model.advance(before[t], x[t], gates[t], new[t], after[t])[0]
    update, reset = gates[:, :, :STATE], gates[:, :, STATE:]
    # all outputs at once, by time and then stream
    states, want, place = after.reshape(-1, STATE), wanted.T.ravel(), slot.T.ravel()
    rows = None if live is None or live.all() else np.flatnonzero(live.T.ravel())
    if rows is not None:
        states, want, place = states.take(rows, axis=0), want[rows], place[rows]
    share = states.dtype.type(1 if sums is not None else 1 / len(states))
    if sums is None:
        sums = Model(*(np.zeros_like(p) for p in model.parts()))
    outputs, states = model.outputs(), _with_one(states)
    logits = outputs.class_logits(states)
    scale = _less_wanted(logits, want, share)
    grads = np.ascontiguousarray((states * scale[:, None]).T) @ logits
    sums.classes += grads[:STATE]
    sums.class_bias += grads[STATE]
    back = logits @ model.classes.T
    back *= scale[:, None]
    inner, cuts = by_class(want, place)
    if len(inner):
        picked = states.take(inner, axis=0)
        logits = outputs.inner_logits(picked, cuts)
        scale = _less_wanted(logits, place[inner], share)
        picked *= scale[:, None]
        behind = np.empty((len(inner), STATE), dtype=back.dtype)
        for c, begin, end in cuts:
            part = logits[begin:end]
            grads = part.T @ picked[begin:end]
            sums.inside[c] += grads[:, :STATE]
            sums.inside_bias[c] += grads[:, STATE]
            np.matmul(part, model.inside[c], out=behind[begin:end])
        behind *= scale[:, None]
        back[inner] += behind
    if rows is not None:
        back, some = np.zeros((length * streams, STATE), dtype=back.dtype), back
        back[rows] = some
    back = back.reshape(length, streams, STATE)
    d_inputs = np.empty_like(x)
    # what a state's gradient is multiplied with on its way to candidate, update and reset gate
    to_new = update * (1 - new * new)
    to_update = (new - before) * update * (1 - update)
    gated = reset * before
    to_reset = gated * (1 - reset)
    kept = 1 - update
    behind = np.zeros_like(h)
    for t in reversed(range(length)):
        own = back[t]
        own += behind
        d = d_inputs[t]
        np.multiply(own, to_new[t], out=d[:, 2 * STATE :])
        d_gated = d[:, 2 * STATE :] @ model.candidate.T
        np.multiply(own, to_update[t], out=d[:, :STATE])
        np.multiply(d_gated, to_reset[t], out=d[:, STATE : 2 * STATE])
        behind = d[:, : 2 * STATE] @ model.recur.T
        own *= kept[t]
        behind += own
        d_gated *= reset[t]
        behind += d_gated
        if begins[t]:
            behind[fresh[:, t]] = 0
    d_inputs = d_inputs.reshape(len(ids), -1)
    sums.recur += before.reshape(-1, STATE).T @ d_inputs[:, : 2 * STATE]
    sums.candidate += gated.reshape(-1, STATE).T @ d_inputs[:, 2 * STATE :]
    order = _sorting(ids)
    ids = ids[order]
    starts = np.append(0, np.flatnonzero(np.diff(ids)) + 1)
    sums.inputs[ids[starts]] += np.add.reduceat(d_inputs.take(order, axis=0), starts, axis=0)
    return sums.parts(), h


def _less_wanted(logits: np.ndarray, wanted: np.ndarray, share: float) -> np.ndarray:
    """Turns logits into the gradients behind them, up to a factor of each row, which is returned."""
    whole = _exponentials(logits)
    logits[np.arange(len(logits)), wanted] -= whole
    return share / whole


def likelihoods(model: Model, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Natural log-likelihood (classes and head words) of complete documents, side by side."""
    lengths = np.array([len(d[0]) for d in docs], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    # documents that go on at each step, the longest first; all tokens by step and then document
    going = len(docs) - np.searchsorted(sizes[::-1], np.arange(sizes[0] if len(sizes) else 0), side="right")
    owners = np.arange(sizes.sum()) - np.repeat(np.cumsum(going) - going, going)
    at = (np.cumsum(sizes) - sizes)[owners] + np.repeat(np.arange(len(going)), going)
    token, wanted, slot = (np.concatenate([docs[i][k] for i in order])[at] if docs else at for k in range(3))
    result = np.zeros(len(docs))
    h = np.zeros((len(docs), STATE), dtype=np.float32)
    states, begin, end = [], 0, 0
    for active in going.tolist():
        h = model.step(h[:active], token[end : end + active])[0]
        states.append(h)
        end += active
        if end - begin >= STATES_AT_ONCE or end == len(token):
            found = model.log_likelihood(np.concatenate(states), wanted[begin:end], slot[begin:end])
            result += np.bincount(owners[begin:end], weights=found, minlength=len(docs))
            states, begin = [], end
    back = np.empty(len(docs))
    back[order] = result
    return back


# ---------------------------------------------------------------- Spark


def learn_model(training: DataFrame, v: Vocabulary) -> tuple[Model, int]:
    """The model of all documents given, and on how many tokens (with ends) it was trained."""
    progress, trained = Progress.fresh(v), 0
    if not v.documents:
        return progress.model(v), trained
    texts = _texts(training)
    context = training.sparkSession.sparkContext
    vocabulary = context.broadcast(v)
    ends = [share for share in ROUNDS if share == 1 or share * v.tokens >= TRAINER_TOKENS]
    for _ in range(min(MOST_PASSES, -(-PASS_TOKENS // v.tokens))):
        for begin, end in zip([0, *ends], ends):
            tokens = (end - begin) * v.tokens
            place = hash_place("doc_id")
            rows = spread(texts.filter((place >= int(begin * HASH_STEPS)) & (place < int(end * HASH_STEPS))).select("text"))
            trainers = max(1, int(tokens / TRAINER_TOKENS))
            streams = max(8, min(STREAMS, int(tokens) // (64 * WINDOW)))
            progress = _round(rows.coalesce(trainers), vocabulary, progress, streams)
            trained += progress.tokens
    return progress.model(v), trained


def _round(rows: DataFrame, vocabulary: Broadcast, before: Progress, streams: int) -> Progress:
    """Every task trains on its rows; the mean of what they come to, by tokens."""
    shared = rows.sparkSession.sparkContext.broadcast(before)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _one_thread()
        v = vocabulary.value
        placed = v.lookup()

        def documents() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for batch in batches:
                counts, places, words = batch_words(batch["text"])
                at, tails = placed(words)
                yield from batch_targets(v, at[places], tails[places], counts)

        after = train(v, documents(), shared.value, streams)
        if after.tokens:
            values = _flat([after.weights, after.first, after.second])
            blocks = [values[i : i + BLOCK].tobytes() for i in range(0, len(values), BLOCK)]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(range(len(blocks)), pa.int32()), "tokens": [after.tokens] * len(blocks),
                "steps": [float(after.steps)] * len(blocks), "values": blocks,
            })

    def average(found: pd.DataFrame) -> pd.DataFrame:
        weights = found["tokens"].to_numpy(dtype=np.float64)
        values = np.average([np.frombuffer(b, dtype=np.float32) for b in found["values"]], axis=0, weights=weights)
        return pd.DataFrame({
            "block": found["block"].iloc[:1], "tokens": int(weights.sum()), "steps": np.average(found["steps"], weights=weights),
            "values": [values.astype(np.float32).tobytes()],
        })

    schema = "block int, tokens long, steps double, values binary"
    # as many rows as a model has blocks
    blocks = sorted(rows.mapInArrow(work, schema).groupBy("block").applyInPandas(average, schema).collect(), key=lambda r: r["block"])
    shared.unpersist()
    if not blocks:
        return Progress(before.weights, before.first, before.second, before.steps)
    values = np.concatenate([np.frombuffer(r["values"], dtype=np.float32) for r in blocks])
    return Progress(*(part.copy() for part in np.split(values, 3)), blocks[0]["steps"], blocks[0]["tokens"])


def learn(training: DataFrame) -> tuple[Vocabulary, Model, DataFrame]:
    """Vocabulary and model from ``doc_id``, ``text`` rows, and the staged word counts."""
    counts = stage(count_words(training), "word-counts")
    vocabulary = learn_vocabulary(counts, training.count())
    return vocabulary, learn_model(training, vocabulary)[0], counts


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Several batches as one, so that a long document has more others beside it."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SCORED_AT_ONCE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def score(docs: DataFrame, vocabulary: Vocabulary, model: Model, counts: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, model))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _one_thread()
        v, m = shared.value
        placed = v.lookup()
        known_log = np.log10(v.count + ADDED) if len(v.count) else np.zeros(1)
        end_log = float(np.log10(v.documents + ADDED))
        number = TaskContext.get().partitionId() << 40
        for batch in _merged(batches):
            counts, places, words = batch_words(batch["text"])
            word_at, word_tails = placed(words)
            at, tails = word_at[places], word_tails[places]
            n = len(counts)
            owner = np.repeat(np.arange(n), counts)
            base = np.where(at >= 0, known_log[at], 0)
            # what is settled here of a tail word's probability; rare words' counts come later
            settled = np.where(at >= v.head, base, 0) - np.where((at < 0) | (at >= v.head), v.class_log[tails], 0)
            settled = np.bincount(owner, weights=settled, minlength=n)
            settled = settled + likelihoods(m, list(batch_targets(v, at, tails, counts))) / np.log(10)
            # rare words of each document, and how often they stand there
            rare, times = np.unique(owner[at < 0] * len(words) + places[at < 0], return_counts=True)
            found = pa.StructArray.from_arrays(
                [words.take(pa.array(rare % max(1, len(words)))), pa.array(times, pa.int64())], ["word", "times"]
            )
            offsets = np.searchsorted(rare, np.arange(n + 1) * max(1, len(words)))
            yield pa.RecordBatch.from_pydict({
                "_row": np.arange(number, number + n), "doc_id": batch["doc_id"], "n_tokens": counts + 1,
                "_known": np.bincount(owner[at >= 0], minlength=n) + (v.documents > 0),
                "_base": np.bincount(owner, weights=base, minlength=n) + end_log, "_settled": settled,
                "_rare": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found),
            })
            number += n

    schema = (
        "_row long, doc_id long, n_tokens long, _known long, _base double, _settled double, "
        "_rare array<struct<word: binary, times: long>>"
    )
    rows = stage(spread(_texts(docs)).mapInArrow(describe, schema), "described")
    rare = rows.select("_row", F.explode("_rare").alias("_r")).select("_row", "_r.word", "_r.times")
    added = (
        rare.join(counts, "word", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADDED))).alias("_more"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("_found"),
        )
    )
    more = F.coalesce("_more", F.lit(0.0))
    return rows.drop("_rare").join(added, "_row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("_known") + F.coalesce("_found", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + more - F.col("n_tokens") * F.lit(vocabulary.base_log)).alias("base_score"),
        (F.col("_settled") + more).alias("score"),
    )
