"""The pipeline's line stage on texts with blank lines, and its runs against brute force."""

import numpy as np

import corpus_pipeline
from ledgerloom.llm import line_dedup


def brute(texts: dict[int, str], lines: int, words: int, run_words: int) -> dict[int, set[int]]:
    """Lines of all runs that have enough lines and words and that an earlier place holds, each run tried."""
    bare = {d: [(i, x) for i, x in enumerate(t.split("\n")) if x.split()] for d, t in texts.items()}
    first, gone = {}, {d: set() for d in texts}
    for d in sorted(bare):
        for i in range(len(bare[d])):
            for j in range(i + 1, len(bare[d]) + 1):
                part = tuple(x for _, x in bare[d][i:j])
                n = sum(len(x.split()) for x in part)
                if (len(part) >= lines and n >= run_words or len(part) == 1 and n >= words) and first.setdefault(part, (d, i)) != (d, i):
                    gone[d] |= set(range(bare[d][i][0], bare[d][j - 1][0] + 1))
    return gone


def test_blank_lines_between_paragraphs(spark):
    long = "this paragraph of ten words is in both documents here"
    rows = [(1, f"Yes.\n\n{long}\n\nThe end\n\nA first text."), (2, f"Yes.\n\nAnother text.\n\n{long}\n\nThe end\n\nOk\nYes."), (3, "Ok\nYes."), (4, "\n\nYes.\n\n")]
    frame = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id bigint, text string, n_chars bigint")
    got = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, frame, "").collect()}
    assert got == {1: rows[0][1], 2: "Yes.\n\nAnother text.\n\n\nOk\nYes.", 3: rows[2][1], 4: rows[3][1]}


def test_runs_against_brute_force(spark):
    rng = np.random.default_rng(6)
    pool = ["", " ", *(" ".join(f"l{k}w{i}" for i in range(n)) for k, n in enumerate([1, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]))]
    texts = {d: "\n".join(pool[i] for i in rng.integers(0, len(pool), int(rng.integers(1, 25)))) for d in range(60)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for lines, words, run_words in ((2, 8, 8), (3, 9, 6), (2, 5, 1)):
        want = brute(texts, lines, words, run_words)
        for r in line_dedup.dedup_lines(frame, lines, words, run_words).collect():
            assert r.clean_text == "\n".join(x for i, x in enumerate(texts[r.doc_id].split("\n")) if i not in want[r.doc_id]), r.doc_id
            assert r.n_lines_removed == len(want[r.doc_id])
