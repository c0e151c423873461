"""Byte-level BPE, encoding by a segment tree over the ranks of adjacent pairs, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.token_files import small_batches
from ledgerloom.llm.tokens import WIDTH, PieceTable, byte_letters, kept, portions_of, sums_of, tokenizer_path
from ledgerloom.llm.words import word_spans

# Fixed value: the pattern by which byte-level vocabularies of this kind cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 62
_PLACE = 32   # bits for the place of a pair; the rank stands above them
_BLANK = " \t-\r"
_RUNS = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
_CONTROLS = re.compile("[\x1c-\x1f]")
_OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


class Merges:
    """Ranks of pairs as sorted keys, and what each merge makes."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int], base: int):
        keys = np.array([a * base + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.order, self.made, self.base = np.append(keys[order], _NONE), np.append(order, 0), np.array(made, np.int64), base

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Tree leaves for pairs of symbols: (rank, place) in one number, ``_NONE`` for pairs that never merge. -1 is no symbol."""
        key = left * self.base + right
        at = np.searchsorted(self.keys, key)
        known = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.order[at] << _PLACE | place, _NONE)


def merge(symbols: np.ndarray, lengths: np.ndarray, merges: Merges) -> np.ndarray:
    """Merges the pairs of many pieces at once, each piece with a segment tree of its own. ``symbols`` has a piece a row, padded
    with -1; the merged symbols come back in it, and the result says which of its cells still count.

    Leaf i of a tree holds (rank, i) of the pair that starts at symbol i, each inner node the least of the two below. So the
    root is the lowest rank, the leftmost pair among equals. A step takes every unfinished piece's root, merges that
    pair and renews three leaves - the pair that is gone, the pair it became part of, the pair before - and the
    nodes above them, a path of log2(width) nodes each. A piece is done when its root is empty."""
    n, width = symbols.shape
    size = 1 << max(0, (width - 2).bit_length())
    grid = np.full((n, size + 2), -1, np.int64)
    grid[:, :width] = symbols
    place = np.arange(size)
    tree = np.full((n, 2 * size), _NONE, np.int64)
    tree[:, size:] = merges.leaves(grid[:, :size], grid[:, 1:size + 1], place)
    k = size // 2
    while k:
        tree[:, k:2 * k] = np.minimum(tree[:, 2 * k:4 * k:2], tree[:, 2 * k + 1:4 * k:2])
        k //= 2
    after = np.tile(np.arange(1, size + 3), (n, 1))
    before = np.tile(np.arange(-1, size + 1), (n, 1))
    alive = np.arange(size + 2) < lengths[:, None]
    row = np.flatnonzero(tree[:, 1] != _NONE)
    while len(row):
        root = tree[row, 1]
        i = root & (1 << _PLACE) - 1
        new = merges.made[root >> _PLACE]
        gone = after[row, i]
        end = after[row, gone]
        grid[row, i], alive[row, gone] = new, False
        after[row, i], before[row, end] = end, i
        first = before[row, i]
        some = np.flatnonzero(first >= 0)
        tree[row, size + np.where(gone < size, gone, i)] = _NONE
        inside = np.flatnonzero(i < size)
        tree[row[inside], size + i[inside]] = merges.leaves(new[inside], grid[row[inside], end[inside]], i[inside])
        tree[row[some], size + first[some]] = merges.leaves(grid[row[some], first[some]], new[some], first[some])
        for at in (np.where(gone < size, gone, i), i, np.where(first >= 0, first, i)):
            node = size + at
            for _ in range(size.bit_length() - 1):
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        row = row[tree[row, 1] != _NONE]
    symbols[:] = grid[:, :width]
    return alive[:, :width]


def merge_one(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same for one long piece, in plain Python: a step touches three leaves and the nodes above them, and stops where nothing
    changes. ``pairs`` has the rank of a pair and what it makes."""
    n = len(symbols)
    size = 1 << max(0, (n - 2).bit_length())
    tree = [_NONE] * (2 * size)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    for i in range(n - 1):
        known = pairs.get((symbols[i], symbols[i + 1]))
        if known:
            tree[size + i] = known[0] << _PLACE | i
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def renew(i: int) -> None:
        j = after[i]
        known = pairs.get((symbols[i], symbols[j])) if j >= 0 else None
        put(i, known[0] << _PLACE | i if known else _NONE)

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        while k > 1:
            k >>= 1
            least = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == least:
                break
            tree[k] = least
    while tree[1] != _NONE:
        i = tree[1] & (1 << _PLACE) - 1
        gone = after[i]
        symbols[i] = pairs[symbols[i], symbols[gone]][1]
        after[i] = after[gone]
        if after[gone] >= 0:
            before[after[gone]] = i
        if gone < n - 1:
            put(gone, _NONE)
        if i < n - 1:
            renew(i)
        if before[i] >= 0:
            renew(before[i])
    out, i = [], 0
    while i >= 0:
        out.append(symbols[i])
        i = after[i]
    return out


class ByteBpe:
    """Encoder and decoder for a vocabulary file of the tokenizers library with byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        vocab, letters = told["model"]["vocab"], byte_letters()
        base = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in told["model"]["merges"]]
        ids, made = [(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs]
        self.merges = Merges(ids, made, base)
        self._ranked = lambda: {pair: (rank, new) for rank, (pair, new) in reversed(list(enumerate(zip(ids, made, strict=True))))}
        self.first = np.array([vocab[x] for x in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        places = {x: b for b, x in enumerate(letters)}
        self.bytes_of = [b""] * (1 + max([base - 1, *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(places[c] for c in token) if all(c in places for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.cut = regex.compile(PATTERN)
        longest_first = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(longest_first) + ")") if longest_first else None
        self.table, self.pairs = PieceTable(lambda pieces: self._encode([x.decode() for x in pieces])), None

    def _encode(self, pieces: list[str]) -> Iterable[bytes]:
        parts = [self.cut.findall(p) for p in pieces]
        distinct = list({x for cut in parts for x in cut})
        known = dict(zip(distinct, self._merged([x.encode() for x in distinct]), strict=True))
        return (known[cut[0]] if len(cut) == 1 else b"".join([known[x] for x in cut]) for cut in parts)

    def _merged(self, parts: list[bytes], cells: int = 1 << 18, alone: int = 2000) -> list[bytes]:
        """ids of parts that no merge crosses. Parts of like lengths share a step; at most ``cells`` symbols stand in memory beside a single part.
        Parts of more than ``alone`` bytes go one by one."""
        out: list[bytes] = [b""] * len(parts)
        for i in (i for i, x in enumerate(parts) if len(x) > alone):
            self.pairs = self.pairs or self._ranked()
            out[i] = np.asarray(merge_one(self.first[np.frombuffer(parts[i], np.uint8)].tolist(), self.pairs), "<u4").tobytes()
        by_length = sorted((i for i in range(len(parts)) if len(parts[i]) <= alone), key=lambda i: len(parts[i]))
        at = 0
        while at < len(by_length):
            width = 1 << (len(parts[by_length[at]]) - 1).bit_length() | 1
            rows = [i for i in by_length[at:at + max(1, cells // width)] if len(parts[i]) <= width]
            at += len(rows)
            lengths = np.array([len(parts[i]) for i in rows])
            symbols = np.full((len(rows), max(2, int(lengths[-1]))), -1, np.int64)
            symbols[np.arange(symbols.shape[1]) < lengths[:, None]] = self.first[np.frombuffer(b"".join(parts[i] for i in rows), np.uint8)]
            alive = merge(symbols, lengths, self.merges)
            raw = symbols[alive].astype("<u4").tobytes()
            ends = (WIDTH * np.cumsum(alive.sum(axis=1))).tolist()
            for i, x, y in zip(rows, [0, *ends], ends):
                out[i] = raw[x:y]
        return out

    def _cut(self, text: str) -> list[str]:
        # A run of blanks with the word after it is cut like the whole text, unless blanks other than the ASCII ones stand beside it.
        odd = _OTHER_BLANKS.search(text) if not text.isascii() else _CONTROLS.search(text)
        return self.cut.findall(text) if odd else _RUNS.findall(text)

    def _odd(self, text: str) -> bool:
        return any(x in text for x in self.special) or bool(_OTHER_BLANKS.search(text) if not text.isascii() else _CONTROLS.search(text))

    def _encode_odd(self, text: str) -> bytes:
        """A text with special strings, which become their ids, or with blanks other than the ASCII ones."""
        parts = self.specials.split(text) if self.specials else [text]
        marks = [np.asarray([self.special[x]], "<u4").tobytes() for x in parts[1::2]]
        cut = [self._cut(x) for x in parts[::2]]
        names = list({p for pieces in cut for p in pieces})
        known = dict(zip(names, self._encode(names), strict=True))
        return b"".join(x for mark, pieces in zip((*marks, b""), cut, strict=True) for x in (*map(known.__getitem__, pieces), mark))

    def _slots(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the pieces of all texts - a word with the blanks ahead of it, or blanks at a text's end - and how many each has."""
        data, cuts = b"".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        starts, ends, n = word_spans(np.frombuffer(data, np.uint8), cuts)
        first = (np.cumsum(n) - n)[n > 0]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else starts
        starts[first] = cuts[:-1][n > 0]
        done = cuts[:-1].copy()
        done[n > 0] = ends[(np.cumsum(n) - 1)[n > 0]]
        rest = np.flatnonzero(done < cuts[1:])
        at = np.cumsum(n)[rest]
        starts, ends = np.insert(starts, at, done[rest]), np.insert(ends, at, cuts[1:][rest])
        return self.table.find(data, starts, ends), n + (done < cuts[1:])

    def _each(self, texts: list[str], plain: Callable, odd: Callable) -> list:
        """``odd`` of the texts that need care, ``plain`` of runs of the others."""
        is_odd = [self._odd(t) for t in texts]
        ready = iter([x for part in portions_of([t.encode() for t, o in zip(texts, is_odd, strict=True) if not o]) for x in plain(part)])
        return [odd(t) if o else next(ready) for t, o in zip(texts, is_odd, strict=True)]

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        slots, n = self._slots(texts)
        raw = self.table.ids(slots).tobytes()
        ends = (WIDTH * np.cumsum(sums_of(self.table.counts(slots), n))).tolist()
        return [raw[x:y] for x, y in zip([0, *ends], ends)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """ids as little-endian unsigned 32-bit integers; special strings in a text become their ids."""
        return self._each(texts, self._ids, self._encode_odd)

    def count_all(self, texts: list[str]) -> list[int]:
        def counts(part: list[bytes]) -> list[int]:
            slots, n = self._slots(part)
            return sums_of(self.table.counts(slots), n).tolist()
        return self._each(texts, counts, lambda t: len(self._encode_odd(t)) // WIDTH)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encoded(bpe: ByteBpe, texts: pa.Array, rows: int = 256) -> Iterator[bytes]:
    """ids of a batch of texts, few texts at a time; a null text counts as empty."""
    for i in range(0, len(texts), rows):
        yield from bpe.encode_all([t or "" for t in texts.slice(i, rows).to_pylist()])


def _roundtrip(name: str):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = kept(ByteBpe, tokenizer_path(name))
        for batch in texts:
            n, ids_sha, text_sha = [], [], []
            for ids in encoded(bpe, batch):
                n.append(len(ids) // WIDTH)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             names=["n_tokens", "ids_sha256", "decoded_sha256"])
    return F.arrow_udf(run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _ids(name: str):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = kept(ByteBpe, tokenizer_path(name))
        for batch in texts:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in encoded(bpe, batch)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            yield pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*ids, np.empty(0, np.int32)]), pa.int32()))
    return F.arrow_udf(run, "array<int>")


def _texts(name: str):
    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = kept(ByteBpe, tokenizer_path(name))
        for batch in lists:
            yield pa.array([None if x is None else bpe.decode(np.asarray(x, "<u4").tobytes()) for x in batch.to_pylist()], pa.string())
    return F.arrow_udf(run, "string")


def _checked(name: str):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = kept(ByteBpe, tokenizer_path(name))
        for batch in texts:
            ids, shas = [], []
            for x in encoded(bpe, batch):
                ids.append(np.frombuffer(x, "<u4").astype(np.int32))
                shas.append(hashlib.sha256(bpe.decode(x).encode()).hexdigest())
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*ids, np.empty(0, np.int32)]), pa.int32()))
            yield pa.StructArray.from_arrays([lists, pa.array(shas, pa.string())], names=["ids", "decoded_sha256"])
    return F.arrow_udf(run, "ids array<int>, decoded_sha256 string").asNondeterministic()


def encode_checked(docs: DataFrame, text: str = "text", tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """``docs`` with n_tokens, ids and decoded_sha256, the digest of the text decoded from the ids, in one pass by one Python worker.
    A null text counts as empty. Columns of these names and one named ``_bpe`` are replaced."""
    small_batches(docs.sparkSession)
    done = docs.withColumn("_bpe", _checked(tokenizer)(F.col(f"`{text}`")))
    return done.withColumns({"n_tokens": F.size("_bpe.ids").cast("bigint"), "ids": F.col("_bpe.ids"), "decoded_sha256": F.col("_bpe.decoded_sha256")}).drop("_bpe")


def encode_bpe(docs: DataFrame, text: str = "text", out: str = "ids", tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """``docs`` with the ids of a text column. A null text counts as empty and gives an empty list; other columns stay as they are."""
    small_batches(docs.sparkSession)
    return docs.withColumn(out, _ids(tokenizer)(F.col(f"`{text}`")))


def decode_bpe(docs: DataFrame, ids: str = "ids", out: str = "decoded", tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """``docs`` with the text of a column of ids; null stays null, bytes that are no UTF-8 become U+FFFD."""
    small_batches(docs.sparkSession)
    return docs.withColumn(out, _texts(tokenizer)(F.col(f"`{ids}`")))


def roundtrip(docs: DataFrame, text: Column | None = None, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256: digests of the ids and of the text decoded from them.

    Encodes and decodes in one pass, so ids stay inside the task. A null text counts as empty."""
    small_batches(docs.sparkSession)
    done = docs.withColumn("_bpe", _roundtrip(tokenizer)(F.col("text") if text is None else text))
    return done.withColumns({c: F.col(f"_bpe.{c}") for c in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop("_bpe")
