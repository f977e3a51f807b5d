"""N-best segmentation with a public piece vocabulary, and decoding.

A text's pieces form a lattice. Forward Viterbi gives the best score from the start to every
position; these are exact heuristics for a backward A-star search from the end, which therefore
takes complete segmentations in order of score and none it does not need.

The lattice of a text falls apart at spaces that stand alone, and wherever no piece of the vocabulary
holds the two characters on either side. The words of a batch that a worker has not met yet are searched
side by side: the vocabulary's trie is walked from all characters at once, scores go forward position by
position, and each step of the search takes the best open path of every word. The best sequences of
a whole text come from an exact merge of its words' lists: only the words whose second choice costs
least can differ from their first. The ids of every sequence are decoded and compared with the text.

Spaces are written as U+2581 with one before the text; characters that no piece covers, and U+2581
itself, become byte pieces. Decoding gives back every text exactly. Scores are held in steps of
2**-20, so that sums are exact and equal sums tie.

Defined results: NULL text is empty and has no pieces, one empty segmentation and score 0; of
equal scores the path found last is followed first, which is the same in every run and keeps runs of
one character linear; a text with fewer segmentations than asked has a shorter list; repeated rows
are each segmented; very long texts are segmented whole; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import spread

SPACE = "▁"
BEST = 4
CACHED_WORDS = 600_000
# Words searched side by side, and the longest of them; longer ones are searched part by part.
BLOCK_WORDS = 1024
BLOCK_LENGTH = 64
# Steps of a score.
STEPS = 1 << 20
# Below every piece, so that bytes stand only for what no piece covers.
BYTE_MARGIN = 10.0
UNRANKED = -1e8


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


Segmentation = tuple[float, tuple[int, ...]]

# The same with the ids as little-endian 32-bit numbers.
Found = tuple[float, bytes]

# Stands for a literal U+2581. A lone surrogate is in no valid text.
ESCAPE = "\udfff"


def _raw(character: str) -> bytes:
    return SPACE.encode() if character == ESCAPE else character.encode("utf-8", "surrogatepass")


class Segmenter:
    def __init__(self, path: str, best: int = BEST) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.best = best
        self.pieces: dict[str, tuple[int, float, tuple[int]]] = {}
        self.names: list[bytes] = []
        self.bytes: list[int] = [0] * 256
        pairs: set[str] = set()
        prefixes: set[str] = set()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.names.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.names.append(b"")
            else:
                self.names.append(piece.replace(SPACE, " ").encode())
                self.pieces[piece] = (i, round(model.get_score(i) * STEPS) / STEPS, (i,))
                prefixes.update(piece[:k] for k in range(1, len(piece)))
                pairs.update(piece[k : k + 2] for k in range(len(piece) - 1))
        self.pairs = frozenset(pairs)
        lowest = min((s for _, s, _ in self.pieces.values() if s > UNRANKED), default=0.0)
        # pieces without a rank of their own (runs of spaces) count as the rarest
        self.pieces.update({p: (i, lowest, ids) for p, (i, s, ids) in self.pieces.items() if s <= UNRANKED})
        self.byte_score = lowest - BYTE_MARGIN
        # what a piece can start with: the piece, or an empty tuple where longer ones only go on
        self.starts: dict[str, tuple] = {**dict.fromkeys(prefixes, ()), **self.pieces}
        self.name_lengths = np.array([len(name) for name in self.names], dtype=np.int64)
        self.name_starts = np.cumsum(self.name_lengths) - self.name_lengths
        self.name_bytes = np.frombuffer(b"".join(self.names), dtype=np.uint8)
        self._grow_trie()
        self._clear()

    def _grow_trie(self) -> None:
        """The starts as arrays: (node, letter) pairs in order, and the node each leads to."""
        letters = sorted({c for start in self.starts for c in start})
        self.letters = np.zeros(0x110000, dtype=np.int64)
        self.letters[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        number = {"": 0} | {start: i for i, start in enumerate(self.starts, 1)}
        steps = np.array([number[p[:-1]] * self.width + self.letters[ord(p[-1])] for p in self.starts], dtype=np.int64)
        order = np.argsort(steps)
        self.steps, self.leads_to = np.append(steps[order], -1), np.append(order + 1, 0)
        self.node_piece = np.array([-1, *(found[0] if found else -1 for found in self.starts.values())])
        self.node_score = np.array([0.0, *(found[1] if found else 0.0 for found in self.starts.values())])

    # ------------------------------------------------------------ lattice of one part

    def search(self, text: str) -> list[Found]:
        """The best segmentations of a part, highest score first."""
        size = len(text)
        # arcs into each position: (start, score, ids); ``forward`` is the best score up to it
        arcs: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        forward = [0.0] + [-np.inf] * size
        look = self.starts.get
        for start in range(size):
            here = forward[start]
            for end in range(start + 1, size + 1):
                piece = look(text[start:end])
                if not piece and end == start + 1:
                    ids = tuple(self.bytes[b] for b in _raw(text[start]))
                    score = self.byte_score * len(ids)
                    arcs[end].append((start, score, ids))
                    forward[end] = max(forward[end], here + score)
                if piece is None:
                    break
                if piece:
                    _, score, ids = piece
                    arcs[end].append((start, score, ids))
                    if here + score > forward[end]:
                        forward[end] = here + score
        found: list[Found] = []
        # (negated score of the best completion, newest first, position, score so far, ids so far as a chain), in
        # order. Every open path has a completion of just that score, so no more are kept than are wanted.
        queue: list[tuple] = [(-forward[size], 0, size, 0.0, None)]
        order = 0
        while queue and len(found) < self.best:
            _, _, at, behind, chain = queue.pop(0)
            if at == 0:
                ids = []
                while chain is not None:
                    ids += chain[0]
                    chain = chain[1]
                found.append((behind, np.array(ids, dtype="<u4").tobytes()))
                continue
            room = self.best - len(found)
            for start, score, own in arcs[at]:
                order -= 1
                total = behind + score
                cost = -forward[start] - total
                if len(queue) < room or cost <= queue[-1][0]:
                    bisect.insort(queue, (cost, order, start, total, (own, chain)))
                    del queue[room:]
        return found

    # ------------------------------------------------------------ lattices of many words

    def search_all(self, parts: list[str], ranks: int | None = None) -> list[list[Found]]:
        """The best segmentations of each part; ids of the first ``ranks`` only, empty beyond."""
        out: list[list[Found]] = [[]] * len(parts)
        by_length = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        short = [i for i in by_length if len(parts[i]) <= BLOCK_LENGTH]
        for first in range(0, len(short), BLOCK_WORDS):
            block = short[first : first + BLOCK_WORDS]
            scores, ids = self._search_block([parts[i] for i in block], ranks or self.best)
            ids = iter(ids)
            for i, values in zip(block, scores.tolist()):
                values = values[: values.index(-np.inf)] if values[-1] == -np.inf else values
                out[i] = [(v, next(ids) if k < (ranks or self.best) else b"") for k, v in enumerate(values)]
        for i in by_length[len(short) :]:
            out[i] = self.search(parts[i])
        return out

    def _arcs(self, parts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """All pieces at all places: first position, last position, place in the part, score, piece.

        Parts lie one after the other, with one position more than characters each. A character
        that is no piece is written as -1 less its code.
        """
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(parts)), sizes)
        local = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = sizes[owner] - local
        letter = self.letters[codes]
        at, node, depth = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64), 0
        arcs: list[tuple[np.ndarray, ...]] = []
        while len(at):
            step = node * self.width + letter[at + depth]
            slot = np.searchsorted(self.steps[:-1], step)
            node = np.where(self.steps[slot] == step, self.leads_to[slot], 0)
            depth += 1
            piece, score = self.node_piece[node], self.node_score[node]
            if depth == 1:
                raw = piece < 0
                piece = np.where(raw, -1 - codes, piece)
                lengths = 1 + np.searchsorted([0x80, 0x800, 0x10000], codes, side="right")
                score = np.where(raw, self.byte_score * lengths, score)
                here = slice(None)
            else:
                here = piece >= 0
            begin = at[here]
            arcs.append((begin + owner[begin], begin + owner[begin] + depth, local[begin] + depth, score[here], piece[here]))
            on = (node > 0) & (left[at] > depth)
            at, node = at[on], node[on]
        return tuple(np.concatenate(column) for column in zip(*arcs))

    def _search_block(self, parts: list[str], ranks: int) -> tuple[np.ndarray, list[bytes]]:
        """Scores of each part, -inf after the last, and the ids of the first ``ranks`` of each in turn."""
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        arcs = self._arcs(parts, sizes)
        order = np.lexsort((arcs[1], arcs[2]))
        begin, end, place, score, piece = (column[order] for column in arcs)
        source = np.cumsum(sizes + 1) - sizes - 1
        # forward: all arcs that end at one place of their part are taken together
        forward = np.full(int(sizes.sum()) + len(parts), -np.inf)
        forward[source] = 0.0
        heads = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
        first_arc, n_arcs = np.zeros(len(forward), dtype=np.int64), np.zeros(len(forward), dtype=np.int64)
        first_arc[end[heads]], n_arcs[end[heads]] = heads, np.diff(np.append(heads, len(end)))
        cuts = np.flatnonzero(np.append(True, place[1:] != place[:-1])).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(end)]):
            own = heads[np.searchsorted(heads, a) : np.searchsorted(heads, b)]
            forward[end[own]] = np.maximum.reduceat(forward[begin[a:b]] + score[a:b], own - a)
        owner, total, chain, parents, taken_arcs = self._search_back(
            source, source + sizes, forward, first_arc, n_arcs, begin, score
        )
        # ids of the found paths: a path's last arc is the text's first piece
        by_part = np.argsort(owner, kind="stable")
        owner, total, chain = owner[by_part], total[by_part], chain[by_part]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        scores = np.full((len(parts), self.best), -np.inf)
        scores[owner, rank] = total
        paths, columns = chain[rank < ranks], []
        while (paths >= 0).any():
            columns.append(np.where(paths >= 0, piece[taken_arcs[paths]], np.iinfo(np.int64).min))
            paths = np.where(paths >= 0, parents[paths], -1)
        table = np.stack(columns, axis=1)
        used = table > np.iinfo(np.int64).min
        blob = table[used].astype("<u4").tobytes()
        ends = (4 * np.cumsum(used.sum(axis=1))).tolist()
        ids = [blob[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.flatnonzero((used & (table < 0)).any(axis=1)).tolist():
            ids[i] = self._with_bytes(table[i][used[i]])
        return scores, ids

    def _with_bytes(self, pieces: np.ndarray) -> bytes:
        ids: list[int] = []
        for x in pieces.tolist():
            ids += [x] if x >= 0 else [self.bytes[b] for b in _raw(chr(-1 - x))]
        return np.array(ids, dtype="<u4").tobytes()

    def _search_back(self, source, sink, forward, first_arc, n_arcs, begin, score) -> tuple[np.ndarray, ...]:
        """A-star from the ends of all parts; each step takes the best open path of every part.

        Returns part, score and path of every segmentation in order of score within its part,
        and the paths: the path before and the arc each adds.
        """
        rows, taken = np.arange(len(source)), np.zeros(len(source), dtype=np.int64)
        cost = np.full((len(rows), 32), np.inf)
        cost[:, 0] = -forward[sink]
        at, behind, link = (np.zeros(cost.shape, dtype=t) for t in (np.int64, np.float64, np.int64))
        at[:, 0], link[:, 0] = sink, -1
        fill = np.ones(len(rows), dtype=np.int64)
        made, parents, arcs, found = 0, [], [], []
        while len(rows):
            each, last = np.arange(len(rows)), int(fill.max()) - 1
            pick = last - np.argmin(cost[:, last::-1], axis=1)
            going = np.isfinite(cost[each, pick])
            cost[each, pick] = np.inf
            here, total, chain = at[each, pick], behind[each, pick], link[each, pick]
            done = going & (here == source[rows])
            found.append((rows[done], total[done], chain[done]))
            taken[rows[done]] += 1
            grow = np.flatnonzero(going & ~done)
            k = n_arcs[here[grow]]
            row, nth = np.repeat(grow, k), np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
            arc, slot = first_arc[here[row]] + nth, fill[row] + nth
            fill[grow] += k
            if (more := int(fill.max()) - cost.shape[1]) > 0:
                more = max(more, cost.shape[1])
                cost = np.pad(cost, ((0, 0), (0, more)), constant_values=np.inf)
                at, behind, link = (np.pad(x, ((0, 0), (0, more))) for x in (at, behind, link))
            onward = total[row] + score[arc]
            cost[row, slot], at[row, slot] = -forward[begin[arc]] - onward, begin[arc]
            behind[row, slot], link[row, slot] = onward, made + np.arange(len(arc))
            parents.append(chain[row])
            arcs.append(arc)
            made += len(arc)
            on = going & (taken[rows] < self.best)
            cost[~on] = np.inf
            if 4 * np.count_nonzero(on) < 3 * len(rows):
                rows, fill, cost, at, behind, link = (x[on] for x in (rows, fill, cost, at, behind, link))
        return (*(np.concatenate(x) for x in zip(*found)), np.concatenate(parents), np.concatenate(arcs))

    def choose(self, losses: Iterable[tuple[float, ...]]) -> list[tuple[float, dict[int, int]]]:
        """What the best sequences of several lists lose, and which take another than their first choice.

        ``losses`` holds what the choices after the first lose, per list. Only the lists with the
        cheapest second choice vary.
        """
        varied = heapq.nsmallest(self.best - 1, ((x[0], i, x) for i, x in enumerate(losses) if x))
        choices: list[tuple[float, dict[int, int]]] = [(0.0, {})]
        for _, i, further in sorted(varied, key=lambda x: x[1]):
            options = choices + [(a + b, {**taken, i: k}) for a, taken in choices for k, b in enumerate(further, 1)]
            choices = heapq.nsmallest(self.best, options, key=lambda x: x[0])
        return choices

    def merge(self, parts: list[list[Found]]) -> list[Found]:
        """Best sequences of several parts."""
        first = sum(p[0][0] for p in parts)
        return [
            (first - loss, b"".join([p[taken.get(i, 0)][1] for i, p in enumerate(parts)]))
            for loss, taken in self.choose(_losses(p) for p in parts)
        ]

    # ------------------------------------------------------------ texts

    @staticmethod
    def marked(text: str) -> str:
        """Spaces as U+2581, one before the text; a literal U+2581 becomes bytes."""
        return SPACE + text.replace(SPACE, ESCAPE).replace(" ", SPACE)

    def parts_of(self, marked: str) -> list[str]:
        pairs = self.pairs
        cuts = [i for i in range(1, len(marked)) if marked[i - 1 : i + 1] not in pairs]
        return [marked[a:b] for a, b in zip([0, *cuts], [*cuts, len(marked)])]

    def find(self, marked: list[str], ranks: int | None = None) -> list[list[Found]]:
        """Best segmentations of marked texts; long ones are put together from their parts."""
        long = {m: self.parts_of(m) for m in marked if len(m) > BLOCK_LENGTH}
        parts = list(dict.fromkeys([*(m for m in marked if m not in long), *(p for ps in long.values() for p in ps)]))
        # parts of long texts need all their ids, as a merge may take any
        all_ranks = self.best if long else ranks
        of = dict(zip(parts, self.search_all(parts, all_ranks)))
        return [self.merge([of[p] for p in long[m]]) if m in long else of[m] for m in marked]

    def segment(self, text: str | None) -> list[Segmentation]:
        """Best segmentations of a whole text."""
        if not text:
            return [(0.0, ())]
        return [(score, _numbers(ids)) for score, ids in self.find([self.marked(text)])[0]]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation."""
        ids = np.asarray(ids, dtype=np.int64)
        lengths = self.name_lengths[ids]
        shift = self.name_starts[ids] - (np.cumsum(lengths) - lengths)
        raw = self.name_bytes[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)].tobytes()
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "surrogatepass")

    # ------------------------------------------------------------ many texts

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._ids: list[bytes] = []
        # per word: the best score, and what further segmentations lose (infinite where there are none)
        self._scores = np.zeros(0)
        self._further = np.zeros((0, self.best - 1))

    def _keep(self, met: np.ndarray) -> None:
        """Keep the words that were met more than once; if they are many, half a cache of the most met."""
        kept = np.flatnonzero(met > 1)
        if len(kept) > CACHED_WORDS // 2:
            kept = np.sort(kept[np.argsort(-met[kept], kind="stable")[: CACHED_WORDS // 2]])
        # the index is in the order of its numbers
        words = list(self._index)
        self._index = {words[n]: i for i, n in enumerate(kept.tolist())}
        self._ids = [self._ids[n] for n in kept.tolist()]
        self._scores, self._further = self._scores[kept], self._further[kept]

    def _learn(self, words: list[str]) -> None:
        """Best segmentation of words and what further ones lose, in the order of their numbers."""
        marked = [self.marked(w) for w in words]
        scores, ids = np.full((len(words), self.best), -np.inf), [b""] * len(words)
        by_length = sorted((i for i, m in enumerate(marked) if len(m) <= BLOCK_LENGTH), key=lambda i: len(marked[i]))
        for first in range(0, len(by_length), BLOCK_WORDS):
            block = by_length[first : first + BLOCK_WORDS]
            scores[block], own = self._search_block([marked[i] for i in block], 1)
            for i, x in zip(block, own):
                ids[i] = x
        long = [i for i, m in enumerate(marked) if len(m) > BLOCK_LENGTH]
        for i, found in zip(long, self.find([marked[i] for i in long], 1)):
            scores[i, : len(found)], ids[i] = [s for s, _ in found], found[0][1]
        self._ids += ids
        self._scores = np.concatenate([self._scores, scores[:, 0]])
        self._further = np.concatenate([self._further, scores[:, :1] - scores[:, 1:]])

    def best_of(self, texts: list[str]) -> list[list[Found]]:
        """Best segmentations of every text."""
        index, known, numbered, whole, new = self._index, len(self._ids), {}, {}, []
        for i, text in enumerate(texts):
            # doubled spaces may share a piece across words
            if not text or "  " in text or text[0] == " " or text[-1] == " ":
                whole[i] = [(0.0, b"")]
                continue
            words = text.split(" ")
            numbers = list(map(index.get, words))
            if None in numbers:
                for k, number in enumerate(numbers):
                    if number is None:
                        numbers[k] = index.setdefault(words[k], len(index))
                        if numbers[k] == len(self._ids) + len(new):
                            new.append(words[k])
            numbered[i] = np.array(numbers, dtype=np.int64)
        self._learn(new)
        spaced = [i for i in whole if texts[i]]
        whole |= zip(spaced, self.find([self.marked(texts[i]) for i in spaced]))
        gaps = self._further.min(axis=1, initial=np.inf)
        chosen, varied = {}, {}
        for i, at in numbered.items():
            near = gaps[at]
            cheap = np.argpartition(near, self.best - 2)[: self.best - 1] if len(at) > self.best else np.arange(len(at))
            cheap = np.sort(cheap).tolist()
            chosen[i] = [
                (loss, {cheap[k]: nth for k, nth in taken.items()})
                for loss, taken in self.choose(tuple(x[np.isfinite(x)].tolist()) for x in self._further[at[cheap]])
            ]
            words = texts[i].split(" ")
            varied |= {int(at[k]): words[k] for _, taken in chosen[i] for k in taken}
        others = dict(zip(varied, self.find([self.marked(w) for w in varied.values()])))
        for i, at in numbered.items():
            own = [self._ids[n] for n in at.tolist()]
            ends = np.cumsum(np.fromiter(map(len, own), dtype=np.int64, count=len(own)))
            best, ids = float(self._scores[at].sum()), b"".join(own)
            whole[i] = []
            for loss, taken in chosen[i]:
                runs, done = [], 0
                for k, nth in sorted(taken.items()):
                    runs += [ids[done : int(ends[k]) - len(own[k])], others[int(at[k])][nth][1]]
                    done = int(ends[k])
                whole[i].append((best - loss, b"".join([*runs, ids[done:]])))
        if len(index) > CACHED_WORDS:
            met = np.bincount(np.concatenate(list(numbered.values())), minlength=len(index))
            met[:known] += 1
            self._keep(met)
        return [whole[i] for i in range(len(texts))]

    def describe(self, texts: list[str]) -> list[tuple[int, int, list[float], bool, list[int]]]:
        """Per text: pieces, crc32 of the best ids, all scores, whether all decode to the text, crc32 of all."""
        out = []
        for text, found in zip(texts, self.best_of(texts)):
            crcs = [zlib.crc32(ids) for _, ids in found]
            exact = all(self.decode(np.frombuffer(ids, dtype="<u4")) == text for _, ids in found)
            out.append((len(found[0][1]) // 4, crcs[0], [s for s, _ in found], exact, crcs))
        return out


def _losses(found: list[Found]) -> tuple[float, ...]:
    return tuple([found[0][0] - s for s, _ in found[1:]])


def _numbers(ids: bytes) -> tuple[int, ...]:
    return tuple(np.frombuffer(ids, dtype="<u4").tolist())


@cache
def segmenter_at(path: str, best: int = BEST) -> Segmenter:
    """One per Python worker; a reused worker keeps its cache."""
    return Segmenter(path, best)


def segment_documents(docs: DataFrame, pieces: str | None = None, best: int = BEST) -> DataFrame:
    """``doc_id``, ``n_chars``, ``n_pieces``, ``ids_crc32``, ``scores``, ``nbest_crc32``, ``round_trip`` of every row."""
    path = pieces or default_pieces()

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = segmenter_at(path, best)
        for batch in batches:
            texts = batch["text"].tolist()
            names = ["n_pieces", "ids_crc32", "scores", "round_trip", "nbest_crc32"]
            found = pd.DataFrame(segmenter.describe(texts), columns=names)
            yield found.assign(doc_id=batch["doc_id"].to_numpy(), n_chars=list(map(len, texts)))

    schema = (
        "doc_id long, n_chars long, n_pieces long, ids_crc32 long, scores array<double>, "
        "nbest_crc32 array<long>, round_trip boolean"
    )
    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return spread(whole).mapInPandas(describe, schema)


def encode(docs: DataFrame, pieces: str | None = None, best: int = BEST) -> DataFrame:
    """``doc_id``, ``segmentations``: the best id lists of every row with their scores."""
    path = pieces or default_pieces()

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = segmenter_at(path, best)
        for batch in batches:
            lists = segmenter.best_of([t or "" for t in batch["text"]])
            found = [[{"score": s, "ids": list(_numbers(ids))} for s, ids in best] for best in lists]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "segmentations": found})

    whole = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return spread(whole).mapInPandas(segment, "doc_id long, segmentations array<struct<score: double, ids: array<int>>>")


def decode(encoded: DataFrame, pieces: str | None = None) -> DataFrame:
    """``doc_id``, ``text`` from ``doc_id``, ``ids``; NULL ids give NULL."""
    path = pieces or default_pieces()

    def text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = segmenter_at(path)
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "text": [None if i is None else segmenter.decode(i) for i in batch["ids"]]}
            )

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInPandas(text, "doc_id long, text string")
