"""Merkle manifest, vector codes and span removal against plain Python, with odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import debruijn, merkle, vector_codes, words

H = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def row_leaf(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def plain_tree(leaves):
    """All levels of nodes, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_steps(levels, i):
    for level in levels[:-1]:
        run = range(i - i % 3, min(i - i % 3 + 3, len(level)))
        yield [level[j] for j in run if j < i], [level[j] for j in run if j > i]
        i //= 3


def plain_manifest(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, row_leaf(r)))
        trees[s] = mine, plain_tree([row_leaf(r) for r in mine])
    top = plain_tree([trees[s][1][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        mine, levels = trees[s]
        for i, r in enumerate(mine):
            changed = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            cur, seen = row_leaf((*r[:4], r[4].replace("\n", "") if changed else r[4])), []
            for left, right in [*plain_steps(levels, i), *plain_steps(top, k)]:
                seen += left + right
                cur = H([*left, cur, *right])
            out.append((r[0], row_leaf(r), levels[-1][0], top[-1][0], H(seen), cur, cur == top[-1][0]))
    return out


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest(spark, height):
    rng = np.random.default_rng(height)
    rows = [(i, [None, "", "a", "é", "z"][int(min(4, rng.geometric(0.4) - 1))], [None, "en"][i % 2], [None, i][i % 3 > 0], [None, "", "x\ny", f"text {i}\n", "z" * 50_000][int(rng.integers(5))]) for i in range(170)]
    rows += [(None, "a", None, None, None), (None, None, "en", 1, "a\nb"), (7, "a", "en", 1, "same"), (7, "a", "en", 1, "same"), (7, "a", "en", 2, "other\n"), (900, "alone", "en", 1, "one\nline")]
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS grp", "2 AS pos", "'x' AS digest", "3 AS n", "4 AS _tie").repartition(5)
    made = merkle.manifest(frame, merkle.without_line_ends(F.col("text")), height)
    got = sorted(map(tuple, made.proofs().collect()), key=str)
    assert got == sorted(plain_manifest(rows), key=str)
    for b in made.blocks().collect():   # siblings are where the address arithmetic says
        assert merkle.folded(merkle.siblings(b.nodes, b.height, b.members, 0)[0][1:65], []) if b.members > 1 else b.height == 0 or b.members == 1


def test_manifest_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], DOCS)
    assert merkle.manifest(none).proofs().count() == 0 and merkle.manifest(none).root is None
    row = (5, None, None, None, None)
    got = merkle.manifest(spark.createDataFrame([row], DOCS)).proofs().collect()
    assert [tuple(r) for r in got] == [(5, row_leaf(row), row_leaf(row), row_leaf(row), H([]), row_leaf(row), True)]


@pytest.mark.parametrize("height", range(7))
def test_addresses_are_a_permutation_with_small_subtrees(height):
    places = [x for level in merkle._layout(height) for x in level]
    assert sorted(places) == list(range(merkle.nodes_in(height + 1)))
    top = (height + 1) // 2
    if top:
        lower = merkle.nodes_in(height + 1 - top)
        for i in range(3 ** top):   # each lower subtree is one run
            span = [int(x) for d in range(top, height + 1) for x in merkle.address(height, d, np.arange(3 ** (d - top)) + i * 3 ** (d - top))]
            assert max(span) - min(span) + 1 == lower == len(span)


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(v, lab, np.floor(np.array(x, float) * 256).astype(int)) for v, lab, x in rows]
    x = np.array([k[2] for k in kept]).reshape(len(kept), parts, -1)
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2].tolist()))[:entries]
    books = x[first].transpose(1, 0, 2)
    for r in range(rounds + 1):
        d = ((x[:, :, None] - books[None]) ** 2).sum(3)
        code = d.argmin(2)
        if r < rounds:
            books = np.array([[x[code[:, p] == e, p].sum(0) // max(1, (code[:, p] == e).sum()) if (code[:, p] == e).any() else books[p, e] for e in range(books.shape[1])] for p in range(parts)])
    error, by_label = d.min(2).sum(1), {}
    for (_, lab, _), e in zip(kept, error, strict=True):
        by_label[lab] = by_label.get(lab, 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    return sorted([(v, bytes(c.tolist()).hex(), int(e), by_label[lab], digest) for (v, lab, _), c, e in zip(kept, code, error, strict=True)], key=str)


@pytest.mark.parametrize("n,spread", [(3000, 0.3), (900, 0.004), (40, 1.0), (700, 0.0)])
def test_codes(spark, n, spread):
    rng = np.random.default_rng(n)
    centres = rng.normal(0, 0.3, (20, 32))
    rows = [(int(i), [None, 1, 2][int(rng.integers(3))], (centres[rng.integers(20)] + rng.normal(0, spread, 32)).round(4).tolist()) for i in rng.permutation(n)]
    rows += [(None, 1, rows[0][2]), (rows[1][0], 2, rows[2][2]), (rows[1][0], 2, rows[2][2])]
    odd = [(-5, 1, None), (-4, 1, [0.5, None] * 16), (-3, 1, [float("nan")] * 32), (-2, 2, [float("inf")] + [0.0] * 31)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, label int, embedding array<double>").selectExpr("*", "1 AS error", "2 AS x", "'a' AS _label").repartition(3)
    assert sorted(map(tuple, vector_codes.vector_codes(frame).collect()), key=str) == plain_codes(rows)


def test_codes_of_odd_tables(spark):
    schema = "vec_id bigint, label int, embedding array<float>"
    assert vector_codes.vector_codes(spark.createDataFrame([], schema)).count() == 0
    got = vector_codes.vector_codes(spark.createDataFrame([(1, 1, [1.0] * 16), (2, 1, [1.0] * 15), (3, None, [3e38] * 16), (4, 7, [])], schema)).collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == {1: ("00" * 16, 0, 0), 2: (None, None, 0), 3: ("01" * 16, 0, 0), 4: (None, None, None)}


def test_trees_hold_every_point_once_and_settle_whole_subtrees():
    rng = np.random.default_rng(3)
    points = (rng.normal(0, 400, (12, 4))[rng.integers(12, size=6000)] + rng.normal(0, 20, (6000, 4))).round().astype(np.int64)
    order, nodes = vector_codes.cover_tree(points)
    assert sorted(order.tolist()) == list(range(6000))
    p = points[order]
    for lo, hi, first, last, radius in nodes:
        assert ((p[lo:hi] - p[lo]) ** 2).sum(1).max() == radius
        assert first == last or (nodes[first:last, 0].tolist() == [lo, *nodes[first:last - 1, 1].tolist()] and nodes[last - 1, 1] == hi)
    at, _, single, _ = vector_codes.settled(p, nodes, rng.normal(0, 400, (8, 4)).round().astype(np.int64))
    assert len(single) < 3000 and len(single) + (nodes[at, 1] - nodes[at, 0]).sum() == 6000


def plain_spans(rows, n=13):
    least = {}
    for d, t in rows:
        w = (t or "").split()
        for p in range(len(w) - n + 1):
            k = tuple(w[p:p + n])
            least[k] = min(least.get(k, (True, float("inf"))), (d is not None, d or 0))
    out = []
    for d, t in rows:
        w = (t or "").split()
        gone = set()
        for p in range(len(w) - n + 1):
            if least[tuple(w[p:p + n])] < (d is not None, d or 0):
                gone |= set(range(p, p + n))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def test_spans_where_paths_branch_and_circle(spark):
    rng = np.random.default_rng(11)
    vocab = [f"w{i}" for i in range(3000)]
    pick = lambda n: [vocab[i] for i in rng.integers(0, len(vocab), n)]
    shared = [pick(int(rng.integers(10, 90))) for _ in range(7)]
    rows = []
    for d in range(150):
        w = []
        for _ in range(int(rng.integers(0, 5))):
            s = shared[int(rng.integers(7))]
            w += pick(int(rng.integers(0, 9))) + s[int(rng.integers(5)):len(s) - int(rng.integers(5))] + ["a", "b", "c"] * int(rng.integers(0, 30) * (rng.random() < 0.2))
        rows.append((d, " ".join(w)))
    rows += [(d + 100, t) for d, t in rows[:60]] + [(None, rows[3][1]), (500, "\n".join(["x" * 300, "é ü"] * 20)), (501, " \t".join(["x" * 300, "é ü"] * 20)), (502, None), (503, ""), (504, " \n "),
                                                    (505, " ".join(pick(70_000))), (506, " ".join(vocab[:12]))] + [(3, rows[3][1])]
    rows += [(507, rows[-4][1] + " tail")]
    rows += [(508, "x " * 15), (509, "x " * 40), (510, "x y " * 9), (511, "x y " * 30 + "x"), (512, "x " * 14)]   # equal first and last nodes, other lengths
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS gram", "2 AS _key", "3 AS u", "'x' AS kept").repartition(4)
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in debruijn.without_repeats(frame).collect()], key=str)
    assert got == plain_spans(rows)


def test_paths_of_a_graph(spark):
    """Sources of one path lie in several documents; paths end where texts part."""
    w = [f"v{i}" for i in range(200)]
    texts = {1: w[:60], 2: ["p", *w[30:120]], 3: ["q", *w[90:160], "r"], 4: w[0:160], 5: [*w[100:110], "fork", *w[111:160]], 6: [*w[100:110], "fork", *w[111:160], "end"]}
    graph = debruijn.Graph(spark.createDataFrame([(d, " ".join(t)) for d, t in texts.items()], "doc_id bigint, text string"))
    windows = {}
    for d, t in texts.items():
        for p in range(len(t) - 12):
            windows.setdefault(tuple(t[p:p + 13]), set()).add((d, p))
    edges = [k for k, at in windows.items() if len({d for d, _ in at}) > 1]
    ins, outs = {}, {}
    for e in edges:
        outs.setdefault(e[:-1], []).append(e)
        ins.setdefault(e[1:], []).append(e)
    root = {}
    for e in edges:
        at, n = e, 0
        while len(ins.get(at[:-1], ())) == 1 and len(outs[at[:-1]]) == 1:
            at, n = ins[at[:-1]][0], n + 1
        root[min(windows[e])] = (min(windows[at]), n)
    placed = graph.placed.join(graph.paths, ["f_doc", "f_key", "head"]).collect()
    assert {(r.f_doc, r.f_pos): ((r.path.d, r.path.p), r.skipped + r.f_pos - r.head) for r in placed} == root
    assert len({v[0] for v in root.values()}) < len({(r.f_doc, r.head) for r in placed})   # some paths are of several pieces


def test_spans_of_nothing(spark):
    assert debruijn.without_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_hashes_do_not_depend_on_how_texts_are_cut():
    text = b" ".join(bytes([97 + i % 26]) * (i % 200) for i in range(30_000))
    whole, n = words.word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert n.tolist() == [len(text.split())] and len(set(whole.tolist())) == len(set(text.split()))
    import pyarrow as pa
    parts = [w for _, w, _ in words.hashed_portions(pa.array([b"x", text, b"", b"a b"], pa.binary()))]
    assert np.concatenate(parts)[1:-2].tolist() == whole.tolist()
