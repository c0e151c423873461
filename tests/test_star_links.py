"""Links that are stars already cost one round."""

from ledgerloom.operators import graph


def test_stars_settle_in_one_round(spark, monkeypatch):
    written, build = [], graph.build_table
    monkeypatch.setattr(graph, "build_table", lambda df, name: written.append(name) or build(df, name))
    out = graph.components(spark.createDataFrame([(2, 1), (3, 1), (9, 7), (7, 9), (None, 1), (4, 4)], "a long, b long"))
    assert sorted((r.v, r.root) for r in out.collect()) == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)]
    assert len(written) == 2   # the links and one round
