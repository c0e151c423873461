"""Identity resolution against plain Python, and components of long and wide graphs."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.graph import components
from ledgerloom.operators.identity import merged_entities, resolve_identities

SYSTEMS = ["crm", "portal", "billing"]
SCHEMA = "system string, record_id bigint, crm_id bigint, mail string, name string, nation int"


def entity_of(rows, systems=SYSTEMS):
    node = lambda r: (systems.index(r[0]) if r[0] in systems else 99, r[0], r[1])
    ent = {node(r): node(r) for r in rows}

    def merge(groups):
        changed = True
        while changed:
            changed = False
            for g in groups:
                least = min(ent[n] for n in g)
                for n in g:
                    if ent[n] != least:
                        changed, ent[n] = True, least
    by = {}
    for r in rows:
        for k, v in (("c", r[2]), ("m", r[3])):
            if v is not None and str(v).strip():
                by.setdefault((k, v), set()).add(node(r))
    merge(list(by.values()))
    systems_of, names = {}, {}
    for r in rows:
        systems_of.setdefault(ent[node(r)], set()).add(r[0])
        if r[4] and r[4].strip():
            names.setdefault(r[4], set()).add(ent[node(r)])
    bad_names = {n for n, es in names.items() if any(sum(s in systems_of[e] for e in es) > 1 for s in {x for e in es for x in systems_of[e]})}
    parent = {e: e for e in systems_of}
    while True:
        before = dict(parent)
        for n, es in names.items():
            if n not in bad_names:
                least = min(parent[e] for e in es)
                for e in es:
                    parent[e] = least
        if parent == before:
            break
    members = {}
    for e, p in parent.items():
        members.setdefault(p, []).append(e)
    for p, es in members.items():
        seen = [s for e in es for s in systems_of[e]]
        if len(seen) != len(set(seen)):
            for e in es:
                parent[e] = e
    return {(r[0], r[1]): (parent[ent[node(r)]][1:], bool(r[4] and r[4].strip() and r[4] in bad_names)) for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_python(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([*SYSTEMS, "other"]), i, rng.choice([None, None, rng.randrange(60)]), rng.choice([None, "", " ", f"m{rng.randrange(80)}"]),
             rng.choice([None, "", "everywhere", f"n{rng.randrange(150)}", f"n{rng.randrange(150)}"]), rng.randrange(5)) for i in range(160)]
    frame = spark.createDataFrame(rows + rows[:3], SCHEMA).selectExpr("*", "1 AS _node", "'x' AS _entity").repartition(3)
    got = resolve_identities(frame, SYSTEMS, ["crm_id", "mail"], ["name"])
    want = entity_of(rows)
    assert {(r.system, r.record_id): ((r.entity_system, r.entity_id), r.ambiguous) for r in got.collect()} == want
    assert got.count() == len(rows) + 3
    assert any(k != v[0] for k, v in want.items()) and any(v[1] for v in want.values())


def test_links_are_transitive_over_kinds_of_keys(spark):
    rows = [("crm", 1, 10, None, "a", None), ("portal", 2, 10, "x@y", "b", 7), ("billing", 3, None, "x@y", "c", 8), ("billing", 4, None, None, "A B", 9)]
    out = resolve_identities(spark.createDataFrame(rows, SCHEMA), SYSTEMS, ["crm_id", "mail"], ["name"])
    one = {r.entity_id: r for r in merged_entities(out, SYSTEMS, ["name", "nation"]).collect()}
    assert (one[1].name, one[1].nation, one[1].crm_id, one[1].portal_id, one[1].billing_id, one[1].n_records, one[1].in_billing) == ("a", 7, 1, 2, 3, 3, True)
    assert (one[4].in_crm, one[4].n_records) == (False, 1)


def test_names_do_not_join_two_entities_of_a_system(spark):
    """1 and 2 are different companies of the CRM: neither a shared name nor a chain of two names may join them."""
    rows = [("crm", 1, None, None, "acme", 1), ("crm", 2, None, None, "beta", 1), ("portal", 3, None, "m", "acme", 1), ("portal", 4, None, "m", "beta", 1),
            ("crm", 5, None, None, "solo", 1), ("billing", 6, None, None, "solo", 1)]
    got = {(r.system, r.record_id): r.entity_id for r in resolve_identities(spark.createDataFrame(rows, SCHEMA), SYSTEMS, ["crm_id", "mail"], ["name"]).collect()}
    assert got == {("crm", 1): 1, ("crm", 2): 2, ("portal", 3): 3, ("portal", 4): 3, ("crm", 5): 5, ("billing", 6): 5}


def test_nothing_to_resolve(spark):
    assert resolve_identities(spark.createDataFrame([], SCHEMA), SYSTEMS, ["crm_id"], ["name"]).count() == 0
    alone = resolve_identities(spark.createDataFrame([("crm", 1, None, None, None, 1)], SCHEMA), SYSTEMS, [], [])
    assert [(r.entity_system, r.entity_id, r.ambiguous) for r in alone.collect()] == [("crm", 1, False)]


def test_components_of_a_chain_a_star_and_a_circle(spark):
    n = 400
    chain = [(i, i + 1) for i in range(n)]
    star = [(1000, 1001 + i) for i in range(n)]
    circle = [(3000 + i, 3000 + (i + 1) % n) for i in range(n)]
    links = chain + star + circle + [(5, 5), (None, 3), (4, None)]
    random.Random(1).shuffle(links)
    got = components(spark.createDataFrame(links, "a bigint, b bigint").repartition(4)).groupBy("root").agg(F.count("*").alias("n"), F.min("v").alias("low")).collect()
    assert {(r.root, r.n, r.low) for r in got} == {(0, n + 1, 0), (1000, n + 1, 1000), (3000, n, 3000)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
