"""DuckDB oracle SQL for the registered queries (same tables, same aliases).

The CTEs mirror the fixtures: ``f`` the features, ``a`` model 1 scores,
``b`` model 2 scores (its segment), ``m`` the merge of the two.
"""

from __future__ import annotations

from scorewell.plans import fixtures as fx

NOW = f"TIMESTAMP '{fx.NOW}'"
RUN = f"'{fx.RUN}'"
RUN_B = f"'{fx.RUN_B}'"

F_CTE = """f AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS "timestamp",
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
         CASE WHEN o_totalprice < 10000.0 THEN NULL ELSE o_totalprice END AS f_price,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS f_priority,
         CAST(month(o_orderdate) AS DOUBLE) AS f_month
  FROM orders)"""
A_CTE = """a AS (
  SELECT id, f_price*0.0009765625 + f_priority*0.5 + f_month*0.25 AS model_1_prediction FROM f)"""
F2_CTE = """f2 AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, min(l_shipdate) AS "timestamp",
         CASE WHEN max(l_extendedprice) < 10000.0 THEN NULL ELSE max(l_extendedprice) END AS f_price,
         CAST(count(*) AS DOUBLE) AS f_priority, CAST(month(min(l_shipdate)) AS DOUBLE) AS f_month
  FROM lineitem GROUP BY l_orderkey)"""
A2_CTE = """a2 AS (
  SELECT id, f_price*0.001953125 + f_priority*0.25 + f_month*0.5 AS model_1_prediction FROM f)"""
B_CTE = """b AS (
  SELECT id, 1.0/(1.0+exp(-(f_price*0.00000762939453125 - f_priority*0.25 + f_month*0.125)))
         AS model_2_prediction FROM f2)"""
M_CTE = """m AS (
  SELECT a.id AS id, model_1_prediction AS model_1_score, model_2_prediction AS model_2_score,
         (model_1_prediction + model_2_prediction) / 2.0 AS ensemble_score
  FROM a JOIN b ON a.id = b.id)"""
XY_CTE = """x AS (SELECT id, count(*) AS n1 FROM a GROUP BY id),
y AS (SELECT id, count(*) AS n2 FROM b GROUP BY id),
jc AS (
  SELECT CAST(coalesce(sum(n1), 0) AS BIGINT) AS n1, CAST(coalesce(sum(n2), 0) AS BIGINT) AS n2,
         count(*) FILTER (WHERE n1 IS NOT NULL AND n2 IS NOT NULL) AS matched,
         count(*) FILTER (WHERE n2 IS NULL) AS only_1,
         count(*) FILTER (WHERE n1 IS NULL) AS only_2,
         count(*) FILTER (WHERE id IS NOT NULL AND (n1 > 1 OR n2 > 1)) AS dup_ids,
         CAST(coalesce(sum(n1 * n2) FILTER (WHERE n1 IS NOT NULL AND n2 IS NOT NULL), 0)
              AS BIGINT) AS expected_rows
  FROM x FULL JOIN y USING (id))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = _with(F_CTE, A_CTE, F2_CTE, B_CTE)
MERGED = _with(F_CTE, A_CTE, F2_CTE, B_CTE, M_CTE)
JOINED = _with(F_CTE, A_CTE, F2_CTE, B_CTE, M_CTE, XY_CTE)


def _check(scope: str, check: str, metric: str, value: str, threshold: str, passed: str,
           source: str) -> str:
    return (
        f"SELECT {RUN} AS run_id, '{scope}' AS scope, '{check}' AS \"check\", "
        f"'{metric}' AS metric, CAST({value} AS DOUBLE) AS value, "
        f"CAST({threshold} AS DOUBLE) AS threshold, {passed} AS passed FROM {source}"
    )


def _score_check_cte(name: str, scores: str, pred: str, inputs: str) -> str:
    return f"""{name} AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE {pred} IS NULL) AS nulls,
         (SELECT count(*) FROM (SELECT id FROM {scores} WHERE id IS NOT NULL
                                GROUP BY id HAVING count(*) > 1)) AS dups,
         count(*) FILTER (WHERE id IS NULL) AS null_ids,
         (SELECT count(*) FROM {inputs}) AS n_in
  FROM {scores})"""


def _score_check_rows(scope: str, src: str, most: str = "0.05") -> list[str]:
    frac = f"CASE WHEN n > 0 THEN CAST(nulls AS DOUBLE) / n ELSE 0.0 END"
    return [
        _check(scope, "row_count", "rows", "n", "n_in", "n = n_in", src),
        _check(scope, "null_predictions", "null_rows", "nulls", "NULL", "true", src),
        _check(scope, "null_predictions", "null_fraction", frac, most, f"{frac} <= {most}", src),
        _check(scope, "duplicate_ids", "ids", "dups", "0", "dups = 0", src),
        _check(scope, "null_ids", "rows", "null_ids", "0", "null_ids = 0", src),
    ]


SCORE_CHECK_CTES = [
    _score_check_cte("c1", "a", "model_1_prediction", "f"),
    _score_check_cte("c2", "b", "model_2_prediction", "f2"),
]
SCORE_CHECK_ROWS = _score_check_rows("model_1", "c1") + _score_check_rows("model_2", "c2")

EM_CTE = """em AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE (ensemble_score IS NULL)
                                <> (model_1_score IS NULL OR model_2_score IS NULL)) AS null_mismatch,
         count(*) FILTER (WHERE ensemble_score IS NOT NULL
                            AND NOT (model_1_score IS NULL OR model_2_score IS NULL)
                            AND abs(ensemble_score - (model_1_score + model_2_score) / 2.0) > 1e-9)
           AS rule_mismatch,
         count(*) FILTER (WHERE ensemble_score IS NOT NULL
                            AND NOT (model_1_score IS NULL OR model_2_score IS NULL)
                            AND (ensemble_score < least(model_1_score, model_2_score) - 1e-9
                                 OR ensemble_score > greatest(model_1_score, model_2_score) + 1e-9))
           AS out_of_range
  FROM m)"""

MERGED_CHECK_ROWS = [
    _check("merged", "join_completeness", "matched", "matched", "1", "matched >= 1", "jc"),
    _check("merged", "join_completeness", "only_model_1", "only_1", "NULL", "true", "jc"),
    _check("merged", "join_completeness", "only_model_2", "only_2", "NULL", "true", "jc"),
    _check("merged", "join_completeness", "duplicate_ids", "dup_ids", "0", "dup_ids = 0", "jc"),
    _check("merged", "ensemble", "null_mismatch", "null_mismatch", "0", "null_mismatch = 0", "em"),
    _check("merged", "ensemble", "rule_mismatch", "rule_mismatch", "0", "rule_mismatch = 0", "em"),
    _check("merged", "ensemble", "out_of_range", "out_of_range", "0", "out_of_range = 0", "em"),
    _check("merged", "join_completeness", "merged_rows", "em.n", "jc.expected_rows",
           "em.n = jc.expected_rows", "em, jc"),
]

QUALITY_COLUMNS = ("model_1_score", "model_2_score", "ensemble_score")


def _quality_rows(as_checks: bool) -> list[str]:
    out = []
    for c in QUALITY_COLUMNS:
        metrics = [
            ("rows", "CAST(count(*) AS DOUBLE)"),
            ("nulls", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"),
            ("min", f"min({c})"),
            ("max", f"max({c})"),
            ("mean", f"avg({c})"),
            ("stddev", f"stddev_samp({c})"),
        ]
        for metric, expr in metrics:
            value = f"round({expr}, 6)"
            if as_checks:
                out.append(_check("merged", "quality", f"{c}.{metric}", value, "NULL", "true", "m"))
            else:
                out.append(f"SELECT '{c}' AS \"column\", '{metric}' AS metric, "
                           f"{value} AS value FROM m")
    return out


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


MERGED_JOB = (
    MERGED
    + f"SELECT id, model_1_score, model_2_score, ensemble_score, {RUN} AS run_id FROM m"
)

SCHEMA_SQL = """WITH e AS (SELECT regexp_extract(props, '([0-9]+)', 1) || '0' AS level FROM events),
c AS (SELECT count(*) FILTER (WHERE level IS NOT NULL AND TRY_CAST(level AS TINYINT) IS NULL) AS bad FROM e)
SELECT 'id' AS "column", 'string' AS expected, 'string' AS actual, 'ok' AS status,
       CAST(0 AS BIGINT) AS bad_values, true AS passed
UNION ALL SELECT 'level', 'tinyint', 'string', CASE WHEN bad = 0 THEN 'cast' ELSE 'bad_values' END, bad, bad = 0 FROM c
UNION ALL SELECT 'seen', 'bigint', NULL, 'missing', NULL, false
UNION ALL SELECT 'extra', NULL, 'int', 'unexpected', NULL, false"""


def _stored_schema_rows() -> list[str]:
    """Schema rows of the stored score sets: all columns as the contract has them."""
    out = []
    for m in ("model_1", "model_2"):
        for c in ("id", f"{m}_prediction", "scoring_timestamp", "model_name", "run_id"):
            out.append(f"SELECT {RUN} AS run_id, '{m}' AS scope, 'schema' AS \"check\", '{c}:ok' AS metric, "
                       "CAST(0 AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS threshold, true AS passed")
    return out


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _ledger_rows() -> str:
    """(after, step, status, rows, version, events): the refused run, then the repaired one."""
    a, b, m = (f"(SELECT count(*) FROM {t})" for t in "abm")
    none = "NULL"
    rows = [
        ("refused", "run", "refused", none, none, 2), ("refused", "score model_1", "done", a, "'7'", 1),
        ("refused", "check model_1", "done", none, "'7'", 1), ("refused", "score model_2", "done", b, "'1'", 1),
        ("refused", "check model_2", "refused", none, "'1'", 1),
        ("repaired", "run", "done", m, none, 4), ("repaired", "score model_1", "done", a, "'7'", 1),
        ("repaired", "check model_1", "done", none, "'7'", 2), ("repaired", "score model_2", "done", b, "'2'", 2),
        ("repaired", "check model_2", "done", none, "'2'", 2), ("repaired", "merge", "done", m, none, 1),
        ("repaired", "check merged", "done", none, none, 1),
    ]
    return _union([
        f"SELECT '{after}' AS \"after\", {RUN} AS run_id, '{step}' AS step, '{status}' AS status, CAST({n} AS BIGINT) AS \"rows\", "
        f"{version} AS version, CAST({events} AS BIGINT) AS events" for after, step, status, n, version, events in rows
    ])


def _refused_inputs() -> str:
    n = "(SELECT count(*) FROM orders)"
    none = "(SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_quantity > 50)"
    cases = [
        ("empty side", f"CASE WHEN {none} = 0 THEN {_literal(f'model_2_scores, run {fx.RUN}, has no rows')} END"),
        ("no key on side 2", _literal("the second score set has no key column 'id'")),
        ("no key on side 1", _literal("the first score set has no key column 'id'")),
    ]
    return _union([f"SELECT '{what}' AS what, {error} AS error, {n} AS rows_1, {none} AS rows_2, CAST(0 AS BIGINT) AS merged_rows"
                   for what, error in cases])


def _drift_sql() -> str:
    """Counts of every bin of every yearly run, empty ones included, and the index between runs."""
    year = """strftime(date_trunc('year', "timestamp"), '%Y%m%d_%H%M%S')"""
    bins, sizes = [], []
    for g, source in zip(fx.DRIFT_GRIDS, ("a JOIN f USING (id)", "b JOIN f2 USING (id)")):
        place = f"({g.column} - {g.low}) / {g.width}"
        bins.append(
            f"SELECT {year} AS run_id, '{g.column}' AS col, CASE WHEN {g.column} IS NULL THEN -2 WHEN {place} < 0 THEN -1 "
            f"WHEN {place} >= {g.bins} THEN {g.bins} ELSE CAST(floor({place}) AS INTEGER) END AS bin FROM {source}"
        )
        sizes.append(f"SELECT '{g.column}' AS col, {g.bins} AS bins")
    return _with(
        F_CTE, A_CTE, F2_CTE, B_CTE,
        f"h AS (SELECT run_id, col, bin, count(*) AS n FROM ({_union(bins)}) GROUP BY ALL)",
        f"g AS ({_union(sizes)})",
        """r AS (SELECT run_id, col, CAST(sum(n) AS BIGINT) AS n, bins, lag(run_id) OVER (PARTITION BY col ORDER BY run_id) AS p
  FROM h JOIN g USING (col) GROUP BY run_id, col, bins)""",
        "e AS (SELECT *, unnest(range(-2, bins + 1)) AS bin FROM r)",
        """s AS (SELECT e.run_id, e.col, e.bin, e.p, (coalesce(h.n, 0) + 0.5::DOUBLE) / (e.n + 0.5::DOUBLE * (e.bins + 3)) AS share
  FROM e LEFT JOIN h ON h.run_id = e.run_id AND h.col = e.col AND h.bin = e.bin)""",
        """x AS (SELECT s.run_id, s.col, round(sum((s.share - q.share) * ln(s.share / q.share)), 6) AS psi
  FROM s JOIN s q ON q.run_id = s.p AND q.col = s.col AND q.bin = s.bin GROUP BY ALL)""",
    ) + f"""SELECT r.run_id, r.p AS previous_run, r.col AS "column", r.n AS "rows", psi, coalesce(psi <= {fx.DRIFT_MOST}, true) AS passed
FROM r LEFT JOIN x ON x.run_id = r.run_id AND x.col = r.col"""


def _nested_rows() -> str:
    """Paths of the nested contract; bad values are counted over single line items and orders."""
    def bad(path, expected, n, source):
        return (f"SELECT '{path}' AS path, '{expected}' AS expected, 'string' AS actual, CASE WHEN n > 0 THEN 'bad_values' ELSE 'cast' END AS status, "
                f"n AS bad_values, n = 0 AS passed FROM (SELECT count(*) FILTER (WHERE {n}) AS n FROM {source})")

    def fixed(path, expected, actual, status):
        text = [f"'{x}'" if x else "CAST(NULL AS VARCHAR)" for x in (expected, actual)]
        return (f"SELECT '{path}' AS path, {text[0]} AS expected, {text[1]} AS actual, '{status}' AS status, "
                f"CAST({0 if status == 'ok' else 'NULL'} AS BIGINT) AS bad_values, {str(status == 'ok').lower()} AS passed")

    lines = "lineitem JOIN orders ON l_orderkey = o_orderkey"
    code = "substr(o_orderpriority, 1, 3)"
    return _union([
        fixed("id", "string", "string", "ok"), fixed("customer.key", "bigint", "bigint", "ok"),
        bad("customer.code", "tinyint", f"{code} IS NOT NULL AND TRY_CAST({code} AS TINYINT) IS NULL", "orders"),
        fixed("items.element.line", "int", "int", "ok"),
        bad("items.element.tenths", "tinyint", "TRY_CAST(CAST(CAST(l_quantity * 10 AS BIGINT) AS VARCHAR) AS TINYINT) IS NULL AND l_quantity IS NOT NULL", lines),
        fixed("items.element.discount", "double", None, "missing"), fixed("items.element.tax", None, "double", "unexpected"),
        fixed("flags.key", "string", "string", "ok"),
        bad("flags.value", "smallint", "x IS NOT NULL AND TRY_CAST(x AS SMALLINT) IS NULL",
            "(SELECT o_orderstatus AS x FROM orders UNION ALL SELECT CAST(o_custkey AS VARCHAR) FROM orders)"),
    ])


ORACLES: dict[str, str] = {
    "validate_nested_schema": _nested_rows(),
    "score_model_stored": BASE + "SELECT id, model_2_prediction FROM b",
    "feature_scan_evolved": f"""SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS o_totalprice, o_orderdate,
  'clerk_' || o_custkey AS o_clerk, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderdate < DATE '{fx.OLDER}'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL, o_orderpriority FROM orders
WHERE NOT coalesce(o_orderdate < DATE '{fx.OLDER}', false)""",
    "score_drift": _drift_sql(),
    "version_as_of": """WITH e AS (SELECT *, 'user_' || user_id AS name FROM events),
v AS (SELECT name, ts, max(event_id) AS version FROM e WHERE event_type = 'signup' GROUP BY 1, 2)
SELECT e.event_id AS run, e.name, e.ts AS "at", CAST(v.version AS VARCHAR) AS version, 'models:/' || e.name || '/' || v.version AS model_uri
FROM (SELECT * FROM e WHERE event_type <> 'signup') e ASOF LEFT JOIN v ON e.name = v.name AND e.ts >= v.ts""",
    "run_gaps": """WITH d AS (SELECT DISTINCT 'user_' || user_id AS "table", date_trunc('day', ts) AS day FROM events),
c AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM d),
m AS (SELECT t."table", c.day FROM (SELECT DISTINCT "table" FROM d) t, c ANTI JOIN d ON d."table" = t."table" AND d.day = c.day),
i AS (SELECT *, day - to_days(CAST(row_number() OVER (PARTITION BY "table" ORDER BY day) AS INTEGER)) AS island FROM m)
SELECT "table", min(day) AS "first", max(day) AS "last", count(*) AS runs FROM i GROUP BY "table", island""",
    "feature_scan": _with(F_CTE) + "SELECT * FROM f",
    "feature_select": _with(F_CTE) + "SELECT f_price, f_priority, f_month FROM f",
    "score_model_1": BASE + "SELECT id, model_1_prediction FROM a",
    "score_model_2": BASE + "SELECT id, model_2_prediction FROM b",
    "score_stamped": BASE
    + f"SELECT id, model_1_prediction, {NOW} AS scoring_timestamp, 'model_1' AS model_name, "
    f"{RUN} AS run_id FROM a",
    "run_ids": "SELECT strftime(date_trunc('day', ts), '%Y%m%d_%H%M%S') AS run_id, "
    "count(*) AS cnt FROM events GROUP BY 1",
    "score_model_mixed": "SELECT o_orderkey AS id, o_totalprice*0.0009765625 + "
    "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)*0.5 AS model_mixed_prediction FROM orders",
    "merge_join": _with(F_CTE, A_CTE)
    + "SELECT a.id AS id, model_1_prediction AS model_1_score, m2 AS model_2_score, "
    "(model_1_prediction + m2) / 2.0 AS ensemble_score FROM a JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS id, "
    "1.0/(1.0+exp(-(l_extendedprice*0.00000762939453125 - l_quantity*0.25 + CAST(month(l_shipdate) AS DOUBLE)*0.125))) "
    "AS m2 FROM lineitem) l ON a.id = l.id",
    "run_rows": "SELECT 'stored' AS what, count(*) AS \"rows\" FROM orders UNION ALL "
    "SELECT 'other run', 0 UNION ALL SELECT 'no table', 0",
    "latest_model_version": "SELECT p_brand AS name, p_type AS stage, CAST(max(p_size) AS VARCHAR) AS version, "
    "'models:/' || p_brand || '/' || CAST(max(p_size) AS VARCHAR) AS model_uri "
    "FROM part GROUP BY 1, 2",
    "merge_scores": MERGED
    + f"SELECT id, model_1_score, model_2_score, ensemble_score, {NOW} AS model_1_timestamp, "
    f"{NOW} AS model_2_timestamp, {NOW} AS merge_timestamp, {RUN} AS run_id FROM m",
    "ensemble_mean": MERGED + "SELECT id, ensemble_score FROM m",
    "ensemble_weighted": BASE
    + "SELECT a.id AS id, round(model_1_prediction*0.75 + model_2_prediction*0.25, 6) "
    "AS ensemble_score FROM a JOIN b ON a.id = b.id",
    "unmatched_ids": BASE
    + "SELECT id, 'model_2' AS missing_from, count(*) AS copies FROM a ANTI JOIN b USING (id) GROUP BY id UNION ALL "
    "SELECT id, 'model_1' AS missing_from, count(*) AS copies FROM b ANTI JOIN a USING (id) GROUP BY id",
    "join_completeness": JOINED + "SELECT * FROM jc",
    "duplicate_keys": "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) "
    "AS id, count(*) AS copies FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "quality_metrics": MERGED + _union(_quality_rows(False)),
    "write_run_first": BASE
    + f"SELECT id, model_1_prediction, {NOW} AS scoring_timestamp, 'model_1' AS model_name, "
    f"{RUN} AS run_id FROM a",
    "write_run_idempotent": _with(F_CTE, A_CTE, A2_CTE)
    + f"SELECT {RUN} AS run_id, count(*) AS \"rows\", "
    "count(*) FILTER (WHERE model_1_prediction IS NULL) AS null_predictions, max(model_1_prediction) AS largest, "
    "count(*) AS rows_of_the_write FROM a\n"
    f"UNION ALL SELECT {RUN_B}, count(*), count(*) FILTER (WHERE model_1_prediction IS NULL), "
    "max(model_1_prediction), count(*) FROM a2",
    "read_run": _with(F_CTE, A2_CTE)
    + f"SELECT id, model_1_prediction, {RUN_B} AS run_id FROM a2",
    "run_status": _with(
        F_CTE,
        F2_CTE,
        """r1 AS (SELECT strftime(date_trunc('year', "timestamp"), '%Y%m%d_%H%M%S') AS run_id,
                 count(*) AS n FROM f GROUP BY 1)""",
        """r2 AS (SELECT strftime(date_trunc('year', "timestamp"), '%Y%m%d_%H%M%S') AS run_id,
                 count(*) AS n FROM f2 GROUP BY 1)""",
    )
    + "SELECT coalesce(r1.run_id, r2.run_id) AS run_id, r1.n AS model_1_scores, r2.n AS model_2_scores "
    "FROM r1 FULL JOIN r2 ON r1.run_id = r2.run_id",
    "merge_input_counts": BASE
    + "SELECT (SELECT count(*) FROM a) AS n1, (SELECT count(*) FROM b) AS n2",
    "score_job": BASE
    + f"SELECT id, model_1_prediction, 'model_1' AS model_name, {RUN} AS run_id FROM a",
    "skip_existing_run": BASE
    + f"SELECT {RUN} AS run_id, count(*) AS \"rows\", max(model_1_prediction) AS largest, "
    "true AS second_call_skipped FROM a",
    "merge_job": MERGED_JOB,
    "merge_bucketed": _with(F_CTE, A_CTE, A2_CTE, F2_CTE, B_CTE)
    + f"SELECT a.id, model_1_prediction AS model_1_score, model_2_prediction AS model_2_score, "
    "(model_1_prediction + model_2_prediction) / 2.0 AS ensemble_score, run_id, "
    "(SELECT count(*) FROM a ANTI JOIN b USING (id)) AS only_model_1 "
    f"FROM (SELECT *, {RUN} AS run_id FROM a UNION ALL SELECT *, {RUN_B} FROM a2) a JOIN b ON a.id = b.id",
    "daily_run": MERGED_JOB,
    "validate_scores": _with(F_CTE, A_CTE, F2_CTE, B_CTE, *SCORE_CHECK_CTES)
    + _union(SCORE_CHECK_ROWS),
    "validate_schema": SCHEMA_SQL,
    "stored_report": _with(F_CTE, A_CTE, F2_CTE, B_CTE, M_CTE, XY_CTE, EM_CTE, *SCORE_CHECK_CTES)
    + _union([r for r in SCORE_CHECK_ROWS if "'duplicate_ids' AS" not in r] + _stored_schema_rows()
             + MERGED_CHECK_ROWS + _quality_rows(True)),
    "refused_report": "SELECT *, NOT passed AS refused, false AS merged FROM ("
    + _with(F_CTE, A_CTE, F2_CTE, B_CTE, *SCORE_CHECK_CTES)
    + _union([r for k in (1, 2) for r in _score_check_rows(f"model_{k}", f"c{k}", "0.0") if "'duplicate_ids' AS" not in r]
             + _stored_schema_rows())
    + ")",
    "run_ledger": MERGED + _ledger_rows(),
    "refused_inputs": _refused_inputs(),
    "validate_merged": _with(F_CTE, A_CTE, F2_CTE, B_CTE, M_CTE, XY_CTE, EM_CTE)
    + _union(MERGED_CHECK_ROWS),
    "validation_report": _with(F_CTE, A_CTE, F2_CTE, B_CTE, M_CTE, XY_CTE, EM_CTE,
                               *SCORE_CHECK_CTES)
    + _union(SCORE_CHECK_ROWS + MERGED_CHECK_ROWS + _quality_rows(True)),
}
