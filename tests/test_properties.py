"""Properties of the merge over random key multisets (with duplicates)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scorewell.functions.models import LinearModel
from scorewell.operators.checks import check_ensemble, check_join
from scorewell.operators.merge import merge_scores, unmatched
from scorewell.operators.score import score_frame

M1 = LinearModel.of("model_1", {"x": 0.5})
M2 = LinearModel.of("model_2", {"x": -0.75}, link="logistic")
NOW = "2026-01-01 12:00:00"

keys = st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f"]), max_size=12)
values = st.floats(min_value=-50, max_value=50, allow_nan=False)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(k1=keys, k2=keys, v=values)
def test_merge_properties(spark, k1, k2, v):
    f1 = spark.createDataFrame([(k, v + i) for i, k in enumerate(k1)], "id string, x double")
    f2 = spark.createDataFrame([(k, v - i) for i, k in enumerate(k2)], "id string, x double")
    s1, s2 = score_frame(f1, M1, now=NOW), score_frame(f2, M2, now=NOW)
    merged = merge_scores(s1, s2, now=NOW)
    c1, c2 = Counter(k1), Counter(k2)

    # rows = sum over keys of n1 * n2
    assert merged.count() == sum(c1[k] * c2[k] for k in c1)

    jc = check_join(s1, s2).first()
    matched = {k for k in c1 if k in c2}
    assert jc["matched"] == len(matched)
    assert len(c1) == jc["matched"] + jc["only_1"]
    assert len(c2) == jc["matched"] + jc["only_2"]
    assert jc["dup_ids"] == len({k for k in set(c1) | set(c2) if c1[k] > 1 or c2[k] > 1})
    assert jc["expected_rows"] == merged.count()

    # mean ensemble lies between the two scores and follows the rule
    ens = check_ensemble(merged).first()
    assert ens["null_mismatch"] == 0 and ens["rule_mismatch"] == 0 and ens["out_of_range"] == 0

    # unmatched keys: every key that is absent on the other side, with its rows
    um = Counter({(r["id"], r["missing_from"]): r["copies"] for r in unmatched(s1, s2).collect()})
    want = Counter({(k, "model_2"): n for k, n in c1.items() if k not in c2})
    want.update({(k, "model_1"): n for k, n in c2.items() if k not in c1})
    assert um == want
