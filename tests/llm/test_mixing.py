import random

import pytest

from scorewell.llm import mixing
from scorewell.llm.mixing import MixPlan, PLAN, mix, mix_sql, mix_table, quotas
from tests.oracle_util import canonical


def fill(budget, caps, weights):
    """Water-filling by rounds: what a full child can't take goes to the others by their weights."""
    out, left, open_ = {}, budget, set(caps)
    while open_:
        w = sum(weights[k] for k in open_)
        full = {k for k in open_ if caps[k] * w <= weights[k] * left}
        if not full:
            return out | {k: weights[k] * left // w for k in open_}
        for k in full:
            out[k] = caps[k]
            left -= caps[k]
        open_ -= full
    return out


def test_quotas_against_rounds_of_redistribution(spark):
    rnd = random.Random(3)
    plan = MixPlan(domains={"a": 3, "b": 1}, languages={"x": 2}, origins={"s1": 5}, budget=(3, 4), max_epochs=2)
    leaves = {(d, l, o): rnd.randrange(0, 500) for d in "abc" for l in "xy" for o in ("s1", "s2", "s3")}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, language string, origin string, tokens bigint")
    got = {(r.domain, r.language, r.origin): r.quota for r in quotas(df, plan).collect()}
    cap = lambda *p: sum(2 * v for k, v in leaves.items() if k[: len(p)] == p)
    top = fill(sum(leaves.values()) * 3 // 4, {d: cap(d) for d in "abc"}, {"a": 3, "b": 1, "c": 1})
    want = {}
    for d in "abc":
        langs = fill(top[d], {l: cap(d, l) for l in "xy"}, {"x": 2, "y": 1})
        for l in "xy":
            own = fill(langs[l], {o: cap(d, l, o) for o in ("s1", "s2", "s3")}, {"s1": 5, "s2": 1, "s3": 1})
            want |= {(d, l, o): q for o, q in own.items()}
    assert got == want


def test_shortage_goes_to_siblings_before_ancestors(spark):
    plan = MixPlan(max_epochs=1, budget=(1, 2))
    rows = [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("b", "x", "s1", 1000)]
    df = spark.createDataFrame(rows, "domain string, language string, origin string, tokens bigint")
    got = {(r.domain, r.origin): r.quota for r in quotas(df, plan).collect()}
    assert got == {("a", "s1"): 10, ("a", "s2"): 492, ("b", "s1"): 502}  # b isn't touched


def docs_of(n, seed=1):
    rnd = random.Random(seed)
    return [(i, " ".join("w" * (1 + i % 3) for _ in range(rnd.randrange(0, 30))), rnd.choice(["en", "de", None]),
             rnd.choice(["src0", "src0", "src1", "src2", "src7", None, "other"])) for i in range(n)]


def test_table_equals_duckdb_on_all_sorts_of_rows(spark, make):
    import duckdb

    rows = docs_of(400) + [(None, "a b"), (5, "again and again"), (5, "again and again"), (900, None), (901, "")]
    docs = make(rows, clash=True)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toArrow())
    for plan in (PLAN, MixPlan(budget=(1, 3), max_epochs=1), MixPlan(domains={"d0": 0, "d1": 7}, max_epochs=5)):
        got = mix_table(docs, plan)
        want = con.execute(f"WITH {mix_sql(plan)} SELECT doc_id, domain, language AS lang, origin AS source, "
                           "CAST(n_tokens AS BIGINT) AS n_tokens, CAST(quota AS BIGINT) AS quota, copies FROM mixed WHERE copies > 0")
        cols = [d[0] for d in want.description]
        assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(cols, want.fetchall())


def test_documents_come_as_often_as_the_table_says(make):
    docs = make(docs_of(200), clash=True)
    table = {r.doc_id: r.copies for r in mix_table(docs, PLAN).collect()}
    out = mix(docs, PLAN)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == table and max(got.values()) <= PLAN.max_epochs


def test_prefix_has_the_quota_up_to_one_document(make):
    docs = make([(i, "w " * 10, "en", "src0") for i in range(500)] + [(1000, "w " * 100, "en", "src1")])
    plan = MixPlan(budget=(1, 2), max_epochs=1)
    taken = [r for r in mix_table(docs, plan).collect() if r.source == "src0"]
    assert 0 <= sum(r.n_tokens for r in taken) - taken[0].quota < 10


def test_empty_table(make, spark):
    docs = make([(1, "a")]).where("false")
    assert mix_table(docs, PLAN).count() == 0 and mix(docs, PLAN).count() == 0


def test_no_python_in_the_plan(make):
    plan = mix_table(make(docs_of(20)), PLAN)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_leaves_beyond_the_bound_meet_by_salt_with_the_same_rows(make, monkeypatch):
    """One leaf has a third of the rows; the plan is chosen by the measured number of leaves."""
    rows = [(k, f"word{k} " * (k % 7), ["en", "de"][k % 2], "wiki_1" if k % 3 == 0 else f"web_{k % 40}") for k in range(600)]
    plan_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    docs = make(rows + [(None, "no id", "en", None), (5000, None, None, "x")], clash=True)
    few = mixing.mix_table(docs, mixing.PLAN)
    want = sorted(map(str, few.collect()))
    assert "strategy=broadcast" in plan_of(few) and len(want) > 100
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 0)
    many = mixing.mix_table(docs, mixing.PLAN)
    assert "strategy=broadcast" not in plan_of(many) and "mix_salt" in plan_of(many)
    assert sorted(map(str, many.collect())) == want
