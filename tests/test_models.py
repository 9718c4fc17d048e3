"""Model paths: the pandas-UDF path and the native expression agree at the
edges of the double range."""

from scorewell.functions.models import LinearModel
from scorewell.operators.score import score


def test_logistic_saturates_without_error_on_both_paths(spark):
    """exp overflows a double for large inputs: the UDF path returns the same
    saturated probabilities as the native expression, and no task fails."""
    m = LinearModel.of("model_2", {"x": 1.0}, link="logistic")
    df = spark.createDataFrame([(str(i), float(x)) for i, x in
                                enumerate([-1000.0, -710.0, -1.0, 0.0, 1.0, 710.0, 1000.0])],
                               "id string, x double")
    native = {r["id"]: r["model_2_prediction"] for r in score(df, m).collect()}
    udf = {r["id"]: r["model_2_prediction"] for r in score(df, m.as_python()).collect()}
    assert native == udf
    assert udf["0"] == 0.0 and udf["1"] == 0.0 and udf["5"] == 1.0 and udf["6"] == 1.0
    assert udf["3"] == 0.5
