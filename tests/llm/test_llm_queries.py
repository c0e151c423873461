"""The registered queries against SQL, the tokenizers library, brute force or held-out labels."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerloom.llm import queries as llm
from ledgerloom.llm.bpe import ByteBpe
from ledgerloom.llm.components import forest
from ledgerloom.llm.suffix_dedup import repeated_passages
from ledgerloom.llm.tokens import WordTokens, tokenizer_path
from oracle import connect, difference

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{ROOT}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


def test_all_are_registered():
    assert set(llm.queries()) <= set(entry.queries())
    assert [k for k in llm.queries() if k == "pipeline" or k.startswith("op")] == list(llm.queries()) and len(llm.queries()) == 14


@pytest.mark.parametrize("key", sorted(llm.oracle_sql()))
def test_sql(spark, key):
    assert difference(llm.queries()[key](spark, ROOT), connect(ROOT), llm.oracle_sql()[key]) is None


def test_op3(spark, texts):
    library, start = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in llm.queries()["op3_token_files"](spark, ROOT).collect()}
    for doc_id, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert got.pop(doc_id) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_op8(spark, texts):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    sha = lambda x: hashlib.sha256(x).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in llm.queries()["op8_bpe"](spark, ROOT).collect()}
    for doc_id, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got.pop(doc_id) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode()))
    assert not got


def test_encoders_agree_with_the_library_on_odd_texts():
    rng = np.random.default_rng(1)
    letters = [*"abcABC.,., \n\t\r\x0b\x0c  'sdtre0123éßñ漢字αΣ😀!?#<|>", "\xa0", " ", "\x85", "\x1c", "​", "　", "é", "<|endoftext|>", "<|startoftext|>", " the", "'ll", "İ", "²", "﻿", "aaaaaaaaa", "\x00"]
    for name, own in (("byte_bpe_50k.json", ByteBpe), ("word_bpe_49k.json", WordTokens)):
        library, mine = Tokenizer.from_file(tokenizer_path(name)), own(tokenizer_path(name))
        drawn = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(3000)] + ["x" * 5000, "ab" * 3000]
        for text, ids in zip(drawn, mine.encode_all([t.encode() if own is WordTokens else t for t in drawn]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_op5(spark, texts):
    fp = {}
    for doc_id, text in texts.items():
        w = text.encode().lower().split()
        shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        fp[doc_id] = sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
    ids, values = np.array(list(fp)), np.array(list(fp.values()), np.uint64)
    i, j = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    least = dict(zip(*(x.tolist() for x in forest(ids[i], ids[j]))))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in llm.queries()["op5_simhash"](spark, ROOT).collect()}
    assert got == {d: (f"{x:016x}", least.get(d, d)) for d, x in fp.items()}


def test_op9(spark):
    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    u = np.array([r[1] for r in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    ids = np.array([r[0] for r in rows])
    i, j = np.nonzero(near)
    least = dict(zip(*(x.tolist() for x in forest(ids[i], ids[j]))))
    got = {r.vec_id: r for r in llm.queries()["op9_embedding_dedup"](spark, "/root/testdata/sf0.1").collect()}
    found = sum(r.n_links for r in got.values())
    assert found >= 0.9 * near.sum() and all(got[x].n_links <= n for x, n in zip(ids.tolist(), near.sum(axis=1), strict=True))
    assert sum(got[x].component_id == least.get(x, x) for x in ids.tolist()) >= 0.9 * len(ids)


def test_op10(spark):
    got = {r.doc_id: r for r in llm.queries()["op10_language_id"](spark, ROOT).collect()}
    rows = duckdb.sql(f"SELECT doc_id, lang FROM '{ROOT}/documents.parquet'").fetchall()
    held = [(d, lang) for d, lang in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, r in got.items() if r.held_out} == {d for d, _ in held}
    assert sum(got[d].lang_pred == lang for d, lang in held) >= 0.95 * len(held)


def brute_passages(rows: dict[int, list[str]], n: int = 50) -> set:
    first, times = {}, collections.Counter()
    for d in sorted(rows):
        for p in range(len(rows[d]) - n + 1):
            k = tuple(rows[d][p:p + n])
            times[k] += 1
            first.setdefault(k, (d, p))

    def runs(places: set[int]) -> list[tuple[int, int]]:
        starts = sorted(x for x in places if x - 1 not in places)
        ends = sorted(x for x in places if x + 1 not in places)
        return [(a, b - a + 1) for a, b in zip(starts, ends, strict=True)]
    out = set()
    for d, w in rows.items():
        again, later = set(), set()
        for p in range(len(w) - n + 1):
            k = tuple(w[p:p + n])
            if times[k] > 1:
                again |= set(range(p, p + n))
                later |= set(range(p, p + n)) if first[k] < (d, p) else set()
        gone = runs(later)
        out |= {(d, a, m, tuple(x for x in gone if a <= x[0] < a + m)) for a, m in runs(again)}
    return out


def test_op1_on_texts_made_of_shared_passages(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    pick = lambda n: [words[i] for i in rng.integers(0, len(words), n)]
    shared = [pick(int(rng.integers(45, 120))) for _ in range(6)]
    rows = {}
    for d in range(120):
        rows[d] = []
        for _ in range(int(rng.integers(1, 5))):
            p = shared[int(rng.integers(6))]
            rows[d] += pick(int(rng.integers(0, 60))) + p[int(rng.integers(20)):len(p) - int(rng.integers(20))] + ["x", "y"] * int(rng.integers(0, 40) * (rng.random() < 0.1))
    rows |= {d: rows[d - 100] for d in range(120, 130)}
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in rows.items()], "doc_id bigint, text string")
    got = {(r.doc_id, r.start, r.n_words, tuple(map(tuple, r.removed))) for r in repeated_passages(frame).collect()}
    assert got == brute_passages(rows)


def test_op1(spark, texts):
    got = {(r.doc_id, r.start, r.n_words, tuple(map(tuple, r.removed))) for r in llm.queries()["op1_repeated_passages"](spark, ROOT).collect()}
    assert got == brute_passages({d: t.split() for d, t in texts.items()})


def test_op7(spark, texts):
    rows = duckdb.sql(f"SELECT doc_id, source, lang, text FROM '{ROOT}/documents.parquet' ORDER BY doc_id").fetchall()
    word, byte = (Tokenizer.from_file(tokenizer_path(x)) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    want, seen = collections.Counter(), set()
    for _, source, lang, text in rows:
        if text not in seen:
            seen.add(text)
            lean = "\n".join(dict.fromkeys(text.split("\n")))
            for name, n in (("word_bpe_49k", len(word.encode(lean, add_special_tokens=False).ids)), ("byte_bpe_50k", len(byte.encode(text, add_special_tokens=False).ids))):
                want[source, lang, name, "docs"] += 1
                want[source, lang, name, "tokens"] += n
    got = collections.Counter()
    for r in llm.queries()["op7_token_counts"](spark, ROOT).collect():
        got[r.source, r.lang, r.tokenizer, "docs"], got[r.source, r.lang, r.tokenizer, "tokens"] = r.n_docs, r.n_tokens
    assert got == want


def test_pipeline(spark, texts):
    rows = llm.queries()["pipeline"](spark, ROOT).collect()
    bpe = ByteBpe(tokenizer_path("byte_bpe_50k.json"))
    assert rows and {r.doc_id for r in rows} <= set(texts)
    for r in rows:
        assert len(r.ids) == r.n_tokens and hashlib.sha256(bpe.decode(np.array(r.ids, "<u4").tobytes()).encode()).hexdigest() == r.decoded_sha256
