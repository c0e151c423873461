"""The pipeline's near-duplicate stage against brute force on planted near copies."""

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import near_text
from ledgerloom.llm.components import components, forest


def brute(texts: dict[int, str]) -> dict[int, int]:
    """The least id of each group of texts that 5-word Jaccard similarities of 4/5 or more reach."""
    sets = {}
    for d, t in texts.items():
        w = t.lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    ids = sorted(sets)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    v, root = forest(np.array([a for a, _ in near]), np.array([b for _, b in near]))
    return {d: d for d in ids} | dict(zip(v.tolist(), root.tolist()))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    pick = lambda n: [f"w{i}" for i in rng.integers(0, 3000, n)]
    passage, out = pick(40), {}
    for d in range(0, 400, 4):   # a text and three copies with more and more words changed: similarities from 0.5 to 1
        base = pick(int(rng.integers(3, 300))) + passage * int(d % 3 == 0)
        for k in range(4):
            w = list(base)
            for at in rng.integers(0, len(w), int(k * len(w) * 0.012 + (k > 0))):
                w[at] = f"x{rng.integers(3000)}"
            out[d + k] = " ".join(w)
    hot = pick(120)   # one large group of near copies
    for d in range(400, 480):
        w = list(hot)
        w[int(rng.integers(120))] = f"y{d}"
        out[d] = " ".join(w)
    return out


@pytest.mark.parametrize("settings", [{}, {"sample": 0, "hot": 8, "block": 8}])
def test_links_against_brute_force(spark, texts, settings):
    frame = spark.createDataFrame(list({t: d for d, t in reversed(texts.items())}.items()), "text string, c bigint")
    want = {d: r for d, r in brute({r.c: r.text for r in frame.collect()}).items()}
    got = {r.v: r.root for r in components(near_text.links(frame, **settings)).collect()}
    assert {d: got.get(d, d) for d in want} == want
    assert sum(d != r for d, r in want.items()) > 150


def test_stage_against_brute_force(spark, texts):
    rows = [(d, t, d) for d, t in texts.items()] + [(0, texts[0], 1000), (0, "another text of the same id", 1001), (None, texts[8], 1002), (None, "no id at all", 1003), (2000, " \n", 1004), (2001, None, 1005)]
    got = sorted(r.n for r in corpus_pipeline.dedup_near(spark, spark.createDataFrame(rows, "doc_id bigint, text string, n bigint"), "").collect())
    firsts = {d for d, r in brute(texts).items() if d == r}
    assert [n for n in got if 0 < n < 1000] == sorted(firsts - {0})
    assert len([n for n in got if n in (0, 1000)]) == 1 and [n for n in got if n > 1000] == [1001, 1003, 1004]
