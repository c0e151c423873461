"""Language identification: averaged embeddings of hashed subwords and a linear softmax, trained here by stochastic gradient
descent in numpy, with a score below which a text is rejected."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.token_files import small_batches
from ledgerloom.llm.words import span_hashes, word_spans

UNKNOWN = "und"
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    per_language: int = 400        # bound of the training sample: different whole texts for each language
    most_languages: int = 1000     # and of the languages that are learnt, the most frequent ones
    buckets: int = 1 << 15         # of hashed subwords
    dimensions: int = 16
    shortest: int = 2              # letters of a subword, word ends included
    longest: int = 5
    epochs: int = 6
    rate: float = 0.5
    calibration: float = 0.2       # share of the sample held back to set temperature and rejection
    precision: float = 0.995       # of the accepted calibration texts, so many must be right
    seed: int = 11


def subwords(word: str, s: Settings) -> list[int]:
    """Buckets of a word's letter runs, with marks at both ends, and of the whole word."""
    w = f"<{word}>"
    raw = [w[i:i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(x.encode()) % s.buckets for x in [*raw, w]]


@dataclass
class LanguageModel:
    """``table`` holds what each bucket adds to the scores of the languages: embedding times softmax weights. Its size is fixed
    by the settings."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float
    settings: Settings

    def scores(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        logits = (sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)   # the reflected polynomial of zlib's checksum
    return t


_CRC = _crc_table()
_LETTERS = bytes(b if b > 127 or bytes([b]).isalpha() else 32 for b in range(256))


def letter_runs(text: str | None) -> bytes:
    """The words of ``words_in`` in UTF-8 with blanks between them."""
    low = (text or "").lower()
    if not low.isascii():
        other = [c for c in set(low) if c > "\x7f" and not c.isalpha()]
        if any(c.isalnum() and not c.isdecimal() for c in other) or len(other) > 60:
            return " ".join(words_in(text)).encode()
        for c in other:
            low = low.replace(c, " ")
    return low.encode("utf-8", "replace").translate(_LETTERS)


def subword_sums(words: list[bytes], model: LanguageModel) -> np.ndarray:
    """For each word the sum of its subwords' rows of the model's table, and last their number. All subwords of all words are hashed
    side by side, letter by letter, as ``subwords`` does one by one."""
    s, out = model.settings, np.zeros((len(words), len(model.languages) + 1))
    marked = [b"<%b>" % w for w in words]

    def add(at: np.ndarray, crc: np.ndarray) -> None:
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        out[at[first], :-1] += np.add.reduceat(model.table[crc % np.uint32(s.buckets)], first, axis=0)
        out[at[first], -1] += np.diff(np.append(first, len(at)))
    if not words:
        return out
    add(np.arange(len(words)), np.fromiter(map(zlib.crc32, marked), np.uint32, len(words)))
    raw = np.frombuffer(b"".join(marked), np.uint8)
    letter = np.flatnonzero((raw & 0xC0) != 0x80)     # first bytes of letters
    wide = np.diff(np.append(letter, len(raw)))
    word = np.searchsorted(np.cumsum([len(w) for w in marked]), letter, "right")
    start, state = np.arange(len(letter)), np.full(len(letter), 0xFFFFFFFF, np.uint32)
    for n in range(1, s.longest + 1):
        inside = start + n <= len(letter)
        inside[inside] = word[start[inside]] == word[start[inside] + n - 1]
        start, state = start[inside], state[inside]
        last = start + n - 1
        for k in range(4):
            has = slice(None) if k == 0 else np.flatnonzero(wide[last] > k)
            state[has] = _CRC[(state[has] ^ raw[letter[last[has]] + k]) & np.uint32(255)] ^ (state[has] >> np.uint32(8))
            if k == 0 and (wide[last] == 1).all():
                break
        if n >= s.shortest and len(start):
            add(word[start], ~state)
    return out


def text_sums(texts: list[bytes], model: LanguageModel) -> np.ndarray:
    """Sums over the words of each text. Each different word of the texts is looked at once; nothing is kept for later ones."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, n = word_spans(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    out = np.zeros((len(texts), len(model.languages) + 1))
    if len(starts):
        _, first, which = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        data = raw.tobytes()
        rows = subword_sums([data[starts[i]:ends[i]] for i in first.tolist()], model)
        some = np.flatnonzero(n)
        out[some] = np.add.reduceat(rows[which], (np.cumsum(n) - n)[some], axis=0)
    return out


def words_in(text: str | None) -> list[str]:
    """Lower-case runs of letters; none where the text has no letter."""
    return [w for w in _WORDS.findall(text.lower()) if w[0].isalpha() or any(map(str.isalpha, w))] if text else []


def train(samples: list[tuple[str, str]], s: Settings = Settings()) -> LanguageModel:
    """Fits on (text, language) pairs, in an order set by the seed. Each text is seen whole and as short runs of words, so that
    short texts are told apart too. A part of the texts is held back: on it the temperature is set to the likelihood's
    best, and the rejection score to the lowest one above which ``precision`` of the texts and runs are right, 0.5 at least."""
    rng = np.random.default_rng(s.seed)
    languages = sorted({lang for _, lang in samples})
    number = {lang: i for i, lang in enumerate(languages)}
    bags: list[list[tuple[np.ndarray, np.ndarray, int]]] = [[], []]
    for text, lang in samples:
        words, part = words_in(text), int(rng.random() < s.calibration)
        if not words:
            continue
        runs = [words]
        for length in (3, 8, 30):
            if len(words) > length:
                at = int(rng.integers(len(words) - length + 1))
                runs.append(words[at:at + length])
        for run in runs:
            ids, counts = np.unique([b for w in run for b in subwords(w, s)], return_counts=True)
            bags[part].append((ids, counts / counts.sum(), number[lang]))
    rng = np.random.default_rng(s.seed + 1)
    emb = rng.normal(0, 1 / s.dimensions, (s.buckets, s.dimensions))
    out, bias = np.zeros((s.dimensions, len(languages))), np.zeros(len(languages))
    steps, done = s.epochs * max(1, len(bags[0])), 0
    for _ in range(s.epochs):
        for k in rng.permutation(len(bags[0])):
            ids, share, y = bags[0][k]
            lr = s.rate * (1 - done / steps)
            hidden = share @ emb[ids]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * p
            emb[ids] -= lr * len(ids) * share[:, None] * back   # a step as long for texts of many subwords as for short ones
            done += 1
    model = LanguageModel(languages, emb @ out, bias, 1.0, 0.0, s)
    _calibrate(model, bags[1] or bags[0])
    return model


def _calibrate(model: LanguageModel, bags: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    if not bags:
        return
    logits = np.array([share @ model.table[ids] + model.bias for ids, share, _ in bags])
    truth = np.array([y for _, _, y in bags])

    def probabilities(t: float) -> np.ndarray:
        e = np.exp((logits - logits.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)
    grid = np.geomspace(0.5, 20, 61)   # not below 0.5: what was never seen must stay undecided
    model.temperature = float(min(grid, key=lambda t: -np.log(probabilities(t)[np.arange(len(truth)), truth] + 1e-12).mean()))
    p = probabilities(model.temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-best)
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= model.settings.precision
    # the lowest score down to which precision holds, and never one at which the other languages together are likelier
    lowest = 1.0 if not precise.any() else 0.0 if precise[-1] else float(best[order][np.flatnonzero(precise)[-1]])
    model.reject_below = max(0.5, lowest)


def training_rows(docs: DataFrame, s: Settings = Settings()) -> list[tuple[str, str]]:
    """At most ``per_language`` different whole texts for each of the ``most_languages`` most frequent non-null values of ``lang``, picked by
    a hash of the text among the different texts, so that copies neither fill the sample nor reach the driver. No more rows than
    that are ever collected, and the model's size does not depend on them. These two bounds are the operator's only ones."""
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.xxhash64("text", F.lit(s.seed)).alias("draw"))
    known = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.most_languages).select("lang").collect()
    if not known:
        return []
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = labelled.select("lang", "draw").distinct().withColumn("place", place).where(F.col("place") <= s.per_language).drop("place")
    drawn = stored(drawn.where(F.col("lang").isin([r["lang"] for r in known])), "language-sample")
    rows = labelled.join(drawn, ["lang", "draw"]).groupBy("lang", "draw").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["draw"]))]


def fit(docs: DataFrame, s: Settings = Settings()) -> LanguageModel:
    """The model learnt from the rows of ``docs`` with text and ``lang``; no other column is read. Without such rows every text
    is ``und``."""
    return train(training_rows(docs, s), s)


def _portions(texts: list[str | None], most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The letter runs of texts, about ``most`` bytes at once; a longer text comes alone."""
    part, held = [], 0
    for t in texts:
        runs = letter_runs(t)
        if part and held + len(runs) > most:
            yield part
            part, held = [], 0
        part.append(runs)
        held += len(runs)
    if part:
        yield part


def _predictor(model: LanguageModel):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in texts:
            langs, scores = [], []
            for part in _portions(batch.to_pylist()):
                sums = text_sums(part, model)
                some = (sums[:, -1] > 0) & bool(model.languages)
                p = model.scores(sums[:, :-1], sums[:, -1]) if model.languages else np.zeros((len(part), 1))
                langs += np.where(some, names[p.argmax(axis=1)], UNKNOWN).tolist()
                scores += np.where(some, p.max(axis=1), 0.0).tolist()
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array([x < model.reject_below for x in scores], pa.bool_())], names=["lang_pred", "score", "rejected"])
    # marked so that a filter on its result is not pushed below it, which would run it twice
    return F.arrow_udf(run, "lang_pred string, score double, rejected boolean").asNondeterministic()


def predict(docs: DataFrame, model: LanguageModel, text: Column | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and rejected, from the whole text alone. A null text or one without a letter is ``und`` with
    score 0 and rejected. A column of one of these names is replaced."""
    small_batches(docs.sparkSession)
    done = docs.withColumn("_lang", _predictor(model)(F.col("text") if text is None else text))
    return done.withColumns({c: F.col(f"_lang.{c}") for c in ("lang_pred", "score", "rejected")}).drop("_lang")


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of doc_id as text is divisible by ``folds``; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0
