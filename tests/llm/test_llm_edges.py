"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import bpe, embeddings, language, line_dedup, mixing, quality_rules, simhash, suffix_dedup, token_counts, token_files
from ledgerloom.llm.common import word_count
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
CLASH = "size bigint, ids array<int>, n_tokens string, score string, key string, words int, target string, kept string, clean_text string, n int, a int, fp int, gram int"
ROWS = [(1, "One two three.\nFour five six.", "en", "s1"), (1, "One two three.\nFour five six.", "en", "s1"), (2, None, "en", None), (3, "", None, "s1"),
        (None, "No id here at all, but words.", "en", "s2"), (4, LONG, "en", "s2"), (5, PASSAGE + " tail one.", "de", "s1"), (6, "other head " + PASSAGE, "de", "s2"),
        (7, " \n\t ", "en", "s1"), (8, "One two three.\nFour five six.", "en", "s3"), (9, "é" * 5, "fr", "s3")]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in ROWS], SCHEMA + ", n_chars bigint")
    for column in CLASH.split(", "):
        name, kind = column.split(" ")
        plain = plain.withColumn(name, F.lit(None).cast(kind))
    return plain.cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_passages(docs, empty):
    got = {(r.doc_id, r.start, r.n_words): [tuple(x) for x in r.removed] for r in suffix_dedup.repeated_passages(docs).collect()}
    assert got[(5, 0, 60)] == [] and got[(6, 2, 60)] == [(2, 60)]
    assert {k[0] for k in got} <= {4, 5, 6}   # the long text repeats its own 977 words
    clean = {r.doc_id: r.clean_text for r in suffix_dedup.without_repeats(docs.where("doc_id <> 4")).collect()}
    assert clean[6] == "other head " and clean[5] == ROWS[6][1] and clean[2] is None and clean[3] == "" and clean[7] == " \n\t "
    assert suffix_dedup.repeated_passages(empty).count() == 0


def test_lines(docs, empty):
    got = [(r.doc_id, r.n_lines, r.n_lines_removed, r.clean_text) for r in line_dedup.dedup_lines(docs).collect()]
    assert len(got) == len(ROWS)
    assert got.count((1, 2, 0, ROWS[0][1])) == 2 and (8, 2, 2, "") in got and (2, 0, 0, None) in got and (3, 1, 0, "") in got
    assert line_dedup.dedup_lines(empty).count() == 0


def test_runs_of_any_length(spark):
    lines = [f"line {i}" for i in range(9)]
    rows = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["x", *lines[2:7], "y"])), (3, "\n".join([*lines[2:5], "z"]))], "doc_id bigint, text string")
    for m, gone in ((2, {2: 5, 3: 3}), (3, {2: 5, 3: 3}), (4, {2: 5}), (5, {2: 5}), (6, {})):
        got = {r.doc_id: r.n_lines_removed for r in line_dedup.dedup_lines(rows, min_lines=m).collect() if r.n_lines_removed}
        assert got == gone, m


def test_token_files(spark, docs, empty, tmp_path):
    token_files.write_token_files(docs, str(tmp_path / "t"))
    rows = token_files.read_token_files(spark, str(tmp_path / "t")).collect()
    assert sorted(r.n_tokens for r in rows)[:3] == [1, 1, 1] and len(rows) == len(ROWS)
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert all(r.ids[-1] == 1 and len(r.ids) == r.n_tokens for r in rows)
    one = token_files.read_token_files(spark, str(tmp_path / "t"), F.col("doc_id") == 6).collect()
    assert [r.start for r in one] == [r.start for r in ordered if r.doc_id == 6]
    token_files.write_token_files(empty, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_mix(docs, empty):
    size = word_count(F.col("text"))
    rows = mixing.mix(docs, size, block_words=4, shard_words=50).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert {r.source for r in rows if r["size"] == 0} == {None, "s1"}
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs, size, block_words=4, shard_words=50).collect()), key=str)
    assert mixing.mix(empty, size).count() == 0 and mixing.mixed(empty, size).count() == 0
    assert mixing.mixed(docs, size).columns == docs.columns


def test_simhash(docs, empty):
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got[2] == got[3] == got[7] == (0, 2) and got[8][1] == 1 and got[4][1] == 4
    assert got[None][1] is None
    kept = [r.doc_id for r in simhash.first_of_groups(docs).collect()]
    assert kept.count(1) == 1 and 8 not in kept and None in kept and 3 not in kept and kept.count(2) == 1
    assert simhash.first_of_groups(docs).columns == docs.columns and simhash.first_of_groups(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_quality(docs, empty):
    got = {r.doc_id: r for r in quality_rules.quality(docs).collect()}
    assert got[2].n_words == 0 and got[2].base_failed and not got[2].kept and got[2].clean_text is None
    assert got[3].clean_text == "" and got[4].n_words == 60_000 and got[4].n_repeat_words == 60_000
    assert got[1].clean_text == ROWS[0][1]
    assert quality_rules.quality(empty).count() == 0


def test_bpe(docs, empty):
    done = bpe.decode_bpe(bpe.encode_bpe(docs))
    assert all(r.decoded == (r.text or "") for r in done.collect())
    digests = {r.doc_id: r for r in bpe.roundtrip(docs).collect()}
    assert digests[2].n_tokens == 0 and digests[2].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.roundtrip(empty).count() == 0 and bpe.encode_bpe(empty).count() == 0


def test_language(docs, empty):
    model = language.fit(docs)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (2, 3, 7))
    assert language.predict(empty, model).count() == 0
    nothing = language.fit(empty)
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_token_counts(spark, empty, tmp_path):
    rollup = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    feed = lambda *rows: spark.createDataFrame(rows, token_counts.FEED)
    first = feed((1, "a", "en", "v1", "insert", 10, 1), (2, "a", None, "v1", "insert", 5, 1), (3, None, "en", "v1", "insert", None, 1), (3, None, "en", "v1", "insert", None, 1), (None, "a", "en", "v1", "insert", 7, 1))
    assert rollup.apply("1", first) and not rollup.apply("1", first)
    assert rollup.apply("2", feed((1, "b", "en", "v1", "revise", 11, 2), (1, "b", "en", "v1", "revise", 12, 3), (9, "a", "en", "v1", "delete", None, 2), (None, "a", "en", "v1", "delete", None, 2)))
    got = {(r.source, r.lang, r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert got == {("b", "en", 1, 12), ("a", None, 1, 5), (None, "en", 1, 0)}
    rollup.apply("3", feed())
    assert rollup.totals().count() == 3
    with pytest.raises(Exception, match="unknown op"):
        rollup.apply("4", feed((1, "a", "en", "v1", "upsert", 1, 1)))
    assert rollup.totals().count() == 3 and rollup.apply("4", feed((1, "a", "en", "v1", "delete", None, 9)))   # done again over its leftovers
    assert rollup.totals().count() == 2


def test_vectors(spark):
    v = lambda *x: [float(y) for y in x]
    rows = [(1, v(1, 0, 0, 0)), (2, v(2, 0, 0, 0)), (3, v(1, 0, 0, 0)), (4, None), (5, v(0, 0, 0, 0)), (6, [float("nan"), 1.0, 0.0, 0.0]), (7, [None, 1.0, 0.0, 0.0]), (8, v(0, 1, 0, 0)),
            (9, v(1, 0)), (10, v(-1, 0, 0, 0)), (11, []), (12, [float("inf"), 0.0, 0.0, 0.0]), (None, v(0, 1, 0, 0.01)), (1, v(1, 0, 0, 0))]
    got = {}
    for r in embeddings.linked_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] * 2 and got[2] == got[3] == [(3, 1, False)] and got[8] == [(1, 8, True)] and got[None] == [(1, 8, False)]
    assert all(got[i] == [(0, i, True)] for i in (4, 5, 6, 7, 9, 10, 11, 12))
    assert embeddings.linked_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_hot_cells_are_compared_in_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, (base + 0.02 * rng.normal(size=16)).tolist()) for i in range(300)] + [(i, rng.normal(size=16).tolist()) for i in range(300, 340)]
    table = spark.createDataFrame(rows, "v bigint, embedding array<float>").withColumn("size", F.lit(1).cast("bigint")).withColumn("root", F.lit(0).cast("bigint"))
    found = {r.v: r.n for r in embeddings.link_counts(table, 0.95, block=64).collect()}
    u = np.array([r[1] for r in rows], np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert found == dict(enumerate(((u @ u.T >= 0.95).sum(axis=1) - 1).tolist()))
    from ledgerloom.llm.components import components
    roots = {r.v: r.root for r in components(embeddings.candidate_links(table, 0.95, embeddings.Lattice(), block=64)).collect()}
    assert roots == {i: 0 for i in range(300)}


def test_hot_fingerprints_are_compared_in_blocks(spark):
    rng = np.random.default_rng(4)
    fps = {int(x) for x in (rng.integers(0, 2, (400, 6)) @ (1 << rng.choice(62, 6)))}   # every mix of six bits
    from ledgerloom.llm.components import components
    links = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp bigint"), block=8)
    assert {r.root for r in components(links).collect()} == {min(fps)}


def test_stages(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "")
        assert name == "BPE" or got.columns == docs.columns
        got.collect()
        assert stage(spark, empty, "").count() == 0
