"""Token ids of whole texts inside Spark's Python tasks.

Texts are cut where no token can reach across, and each different piece is encoded once per worker as long as it stays in a table
of bounded size. Cutting and looking up are numpy's work on all pieces at once."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import public_tokenizers

from ledgerloom.llm.words import span_hashes, word_spans

#: ids are handed on as little-endian unsigned 32-bit integers
WIDTH = 4
_KEPT: dict[tuple, object] = {}


def kept(make: Callable, *key):
    """``make(*key)``, built once in each Python worker."""
    if (make, *key) not in _KEPT:
        _KEPT[(make, *key)] = make(*key)
    return _KEPT[(make, *key)]


class PieceTable:
    """Pieces of text and their ids, in flat arrays, their hashes in ascending order. All pieces of some texts are looked up at once, by 64-bit hash and each different one
    once; ``encode`` gets those that are not there yet. A table of ``most`` pieces starts anew with the next texts, so
    its size is bounded and ids do not depend on what was seen before."""

    def __init__(self, encode: Callable[[list[bytes]], Iterable[bytes]], most: int = 400_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.flat, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def find(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each piece of ``data``."""
        if len(self.slots) > self.most:
            self._clear()
        hashes, first, which = np.unique(span_hashes(np.frombuffer(data, np.uint8), starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        new = np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes) if len(self.hashes) else np.arange(len(hashes))
        if len(new):
            made = list(self.encode([data[starts[first[i]]:ends[first[i]]] for i in new]))
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(made), "<u4")])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) // WIDTH for x in made])])
            free = len(self.slots)
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.slots = np.insert(self.slots, at[new], np.arange(free, free + len(new)))
            at = np.searchsorted(self.hashes, hashes)
        return self.slots[at][which]

    def counts(self, slots: np.ndarray) -> np.ndarray:
        return self.starts[slots + 1] - self.starts[slots]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        """The ids of the pieces one after another."""
        n = self.counts(slots)
        at = np.repeat(self.starts[slots] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(slots) else np.empty(0, np.int64)
        return self.flat[at]


def sums_of(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values`` of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def portions_of(texts: list, most: int = 1 << 20) -> Iterable[list]:
    """Runs of texts of about ``most`` bytes; a longer text comes alone."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > most:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself where it is printable, else the next one above 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    above = {b: 256 + i for i, b in enumerate(others)}
    return [chr(above.get(b, b)) for b in range(256)]


class WordTokens:
    """A tokenizer of the tokenizers library that lower-cases and drops white space: the library encodes words, each once.

    ASCII blanks end every match of its splitting pattern, its normaliser changes characters inside words only, and its
    special strings hold no blank, so a text's ids are those of its words in turn. For the same reason a full stop or comma
    at a word's end after an ASCII letter, where a match ends too, stands apart, and A-Z are lower-cased beforehand, which leaves fewer
    different words; a text in which a special string might stand is left as it is."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs a task per core already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.table = PieceTable(self._encode)
        self.end = next(t for t in self.tokenizer.get_added_tokens_decoder().items() if t[1].special)
        self.model = self.tokenizer.model
        self.letters = {b: x for b, x in enumerate(byte_letters())}
        probe = [b"a", b"the", b"stra\xc3\x9fe", b"\xc3\xa9t\xc3\xa9", b"unbelievably", b"\xc3\xbf\xc3\xb6"]
        self.direct = all(self._letters_only(w) == self._through([w])[0] for w in probe)

    #: Words of lower-case letters that no normaliser changes and no pattern parts: a to z, and U+00DF to U+00FF but for the division sign.
    LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

    def _letters_only(self, word: bytes) -> bytes:
        """Such a word goes to the library's model as it is, its bytes as the letters that stand for them."""
        return array("I", [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.letters))]).tobytes()

    def _encode(self, words: list[bytes]) -> Iterable[bytes]:
        plain = self.LETTERS.fullmatch if self.direct else (lambda w: None)
        others = iter(self._through([w for w in words if not plain(w)]))
        return [self._letters_only(w) if plain(w) else next(others) for w in words]

    def _through(self, words: list[bytes], group: int = 500) -> list[bytes]:
        """Words go through the library in groups with a special string between them, whose id then parts the ids of the words."""
        mark, text = self.end[0], self.end[1].content
        plain = [w.decode() for w in words if b"<|" not in w]
        groups = [text.join(plain[i:i + group]) for i in range(0, len(plain), group)]
        ids = [x for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False) for x in (*e.ids, mark)]
        flat = np.asarray(ids, "<u4")
        ends = np.flatnonzero(flat == mark).tolist()
        raw = flat.tobytes()
        parts = iter([raw[WIDTH * x:WIDTH * y] for x, y in zip([0, *(e + 1 for e in ends)], ends)])
        # a word that may itself hold a special string is encoded alone
        return [next(parts) if b"<|" not in w else np.asarray(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes() for w in words]

    def _slots(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the pieces of all texts, and how many each text has."""
        data = b"".join([t if b"<|" in t else t.lower() for t in texts])
        raw = np.frombuffer(data, np.uint8)
        starts, ends, n = word_spans(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
        last, before = raw[ends - 1], raw[np.maximum(ends - 2, 0)]
        apart = (ends - starts > 1) & ((last == ord(".")) | (last == ord(","))) & (before >= ord("a")) & (before <= ord("z"))
        if any(b"<|" in t for t in texts):
            apart &= np.repeat([b"<|" not in t for t in texts], n)
        word = np.repeat(np.arange(len(starts)), 1 + apart)
        mark = np.concatenate([[False], word[1:] == word[:-1]]) if len(word) else np.empty(0, bool)
        starts, ends = np.where(mark, ends[word] - 1, starts[word]), np.where(mark | ~apart[word], ends[word], ends[word] - 1)
        return self.table.find(data, starts, ends), sums_of(1 + apart, n)

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for part in portions_of(texts):
            slots, n = self._slots(part)
            raw = self.table.ids(slots).tobytes()
            ends = (WIDTH * np.cumsum(sums_of(self.table.counts(slots), n))).tolist()
            out += [raw[x:y] for x, y in zip([0, *ends], ends)]
        return out

    def count_all(self, texts: list[bytes]) -> list[int]:
        return [x for part in portions_of(texts) for slots, n in [self._slots(part)] for x in sums_of(self.table.counts(slots), n).tolist()]


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file on the machine that asks."""
    return public_tokenizers.path(name)
