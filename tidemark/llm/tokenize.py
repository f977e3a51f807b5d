"""Token ids of whole texts through a public tokenizer file, with a cache of words.

Byte-pair merges never cross white space in the word vocabulary used here, so the ids of a text are those of
its white-space runs in order. Web text repeats its words, and most are found in the cache.
Texts in which that does not hold (special tokens spelt out, separators on which Python and the
tokenizer disagree) go through the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import cache
from unicodedata import is_normalized

import numpy as np

CACHED_WORDS = 700_000
WORDS_AT_ONCE = 20_000

# White space other than ASCII's common ones, and the start of special tokens. Each is looked for on its own:
# a search for one character costs a small part of what a regular expression does per character.
_ASCII_UNUSUAL = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
_OTHER_UNUSUAL = tuple("\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200E))) + "\u2028\u2029\u202f\u205f\u2060\u3000\ufeff")


def _is_unusual(text: str) -> bool:
    for part in _ASCII_UNUSUAL:
        if part in text:
            return True
    if not text.isascii():
        for part in _OTHER_UNUSUAL:
            if part in text:
                return True
    return False


# A run of letters and a run of marks after it: two units of the vocabulary's own splitting.
_WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([.,;:!?|()]*)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class CachedTokenizer:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    Two caches: white-space runs as they stand in texts, and lower-case letter runs, from which
    new runs with a capital or with marks behind them are put together.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._runs: dict[str, bytes] = {}
        self._units: dict[str, bytes] = {"": b""}
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(f.ids, dtype="<u4").tobytes() for f in found]

    def _learn_letters(self, words: list[str]) -> None:
        """Letter runs are one unit each, so they can be encoded as one text and cut at word ends."""
        for start in range(0, len(words), 1_000):
            some = words[start : start + 1_000]
            ids = np.frombuffer(self._whole([" ".join(some)])[0], dtype="<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(some):  # a letter the vocabulary splits off
                self._units.update(zip(some, self._whole(some)))
                continue
            at = 0
            for word, end in zip(some, ends.tolist()):
                self._units[word] = ids[at:end].tobytes()
                at = end

    def _learn(self, runs: set[str]) -> None:
        parts: dict[str, tuple[str, str]] = {}
        letters: set[str] = set()
        others: set[str] = set()
        units = self._units
        for run in runs:
            found = _WORD_AND_MARKS.fullmatch(run)
            if found and "\u03a3" not in run and is_normalized("NFC", run):
                word, marks = found[1].lower(), found[2]
                parts[run] = (word, marks)
                if word not in units:
                    letters.add(word)
                if marks not in units:
                    others.add(marks)
            else:
                parts[run] = (run, "")
                others.add(run)
        for word in [w for w in letters if not w.isalpha()]:  # lower case can add combining marks
            letters.discard(word)
            others.add(word)
        listed = list(others)
        units.update(zip(listed, self._whole(listed)))
        self._learn_letters(list(letters))
        for run, (word, marks) in parts.items():
            self._runs[run] = units[word] + units[marks]

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """In order; new words are encoded together for many texts at once."""
        waiting: list[tuple[str, list[str] | None, bytes | None]] = []
        new: set[str] = set()
        known = self._runs.__getitem__
        for text in texts:
            words, ids = None if _is_unusual(text) else text.split(), None
            if words is not None:
                try:
                    ids, words = b"".join(map(known, words)), None
                except KeyError:
                    new |= set(words).difference(self._runs)
            if ids is not None and not waiting:
                yield ids
                continue
            waiting.append((text, words, ids))
            if len(new) > WORDS_AT_ONCE:
                yield from self._flush(waiting, new)
                waiting, new = [], set()
        yield from self._flush(waiting, new)

    def _flush(self, waiting: list[tuple[str, list[str] | None, bytes | None]], new: set[str]) -> Iterator[bytes]:
        self._learn(new)
        known = self._runs.__getitem__
        for text, words, ids in waiting:
            if ids is None:
                ids = self._whole([text])[0] if words is None else b"".join(map(known, words))
            yield ids
        if len(self._runs) > CACHED_WORDS:
            self._runs.clear()
        if len(self._units) > CACHED_WORDS:
            self._units = {"": b""}


@cache
def tokenizer_at(path: str) -> CachedTokenizer:
    """One per Python worker; a reused worker keeps its cache."""
    return CachedTokenizer(path)
