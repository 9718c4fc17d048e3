import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names an operator may use itself.
CLASH = ("token", "node", "score", "label", "epochs", "cut", "domain", "region", "key", "tx", "n", "copies", "mix_cut", "langid_score", "jaccard_key")


@pytest.fixture()
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with clashing extra columns if asked for."""

    def build(rows, clash=False, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASH]) if clash else df

    return build
