"""Summarise the physical plans of the registered queries into PLANS.md.

Usage: python tools/plan_report.py [SF_DIR] > PLANS.md

Per query: shuffles (Exchange), broadcasts, Python nodes, partial
aggregations, and for every Parquet scan the columns read and the filters
pushed.  Plans are taken after AQE's final re-plan (the query is run), so
runtime decisions (broadcast conversion, coalescing) show up.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from scorewell.session import get_session  # noqa: E402


def final_plan(df) -> str:
    """The plan that ran: ``collect`` executes the frame's own plan, and of an
    adaptive one, and of each subquery in it, only the final part is kept."""
    df.collect()
    return without_initial(df._jdf.queryExecution().executedPlan().toString())


def without_initial(plan: str) -> str:
    """The plan's lines without those that stand under an initial plan, at any depth."""
    kept, under = [], None
    for line in plan.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if under is not None and at >= under:
            continue
        under = at if "== Initial Plan ==" in line else None
        if under is None:
            kept.append(line)
    return "\n".join(kept)


def summary(plan: str) -> dict:
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" in line or "Scan parquet" in line:
            table = re.search(r"Location: [^\[]*\[([^\]]+)\]", line)
            cols = re.search(r"ReadSchema: struct<([^>]*)>", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            parts = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
            named = re.search(r"FileScan parquet ([\w.]+)\[", line)
            if named:
                name = named.group(1).split(".")[-1]
            else:
                name = os.path.basename(table.group(1)) if table else "?"
            scans.append({
                "file": name,
                "columns": [c.split(":")[0] for c in cols.group(1).split(",")] if cols else [],
                "pushed": pushed.group(1) if pushed else "",
                "partition": parts.group(1) if parts else "",
            })
    return {
        "exchanges": len(re.findall(r"\bExchange (?:hash|Round|Single|range|SinglePartition)",
                                    plan)) + plan.count("ShuffleExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "python": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
        "partial_agg": plan.count("partial_"),
        "scans": scans,
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.sql.maxMetadataStringLength": "4000"})
    from scorewell.operators.merge import MergeMetrics, merge_unique
    from scorewell.operators.score import score_frame
    from scorewell.plans import fixtures as fx
    from scorewell.plans.queries import QUERIES

    rows = []
    for name, fn in QUERIES.items():
        rows.append((name, summary(final_plan(fn(spark, sf)))))

    print("# Physical plans\n")
    print(f"Generated by `tools/plan_report.py` at `{sf}` (local[8], AQE on, static broadcast off).")
    print("Plans are the final adaptive plans after running the query; writes that a query")
    print("performs before returning its frame are not included here (see the two frames below).\n")
    print("| query | shuffles | broadcasts | Python nodes | partial aggs | scans: file (columns read) |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, s in rows:
        scans = "; ".join(
            f"{x['file']} ({', '.join(x['columns'])})"
            + (f" pruned to [{re.sub(r'#[0-9]+', '', x['partition'])}]" if x["partition"] else "")
            for x in s["scans"])
        print(f"| {name} | {s['exchanges']} | {s['broadcasts']} | {s['python']} | "
              f"{s['partial_agg']} | {scans} |")

    f = fx.features(spark, sf)
    s1 = score_frame(f, fx.MODEL_1, now=fx.NOW)
    s2 = score_frame(fx.model_2_features(spark, sf), fx.MODEL_2, now=fx.NOW)
    print("\n## What the score job writes (model 2, pandas UDF path)\n")
    print("```")
    print(final_plan(s2).strip())
    print("```")
    print("\n## What the strict merge writes (one shuffle, no join)\n")
    print("```")
    merged = merge_unique(s1, s2, now=fx.NOW, metrics=MergeMetrics())
    print(final_plan(merged).strip())
    print("```")
    print("\n## What the merge of runs in buckets by key writes (no shuffle)\n")
    print("```")
    from scorewell.plans.jobs import score_job
    from scorewell.plans.queries import _scratch_db
    from scorewell.sources.catalog import read_run_by_key

    db = _scratch_db(spark, "plans")
    for model, side in ((fx.MODEL_1, f), (fx.MODEL_2, fx.model_2_features(spark, sf))):
        score_job(spark, model, side, db, f"{model.name}_scores", fx.RUN, now=fx.NOW, buckets=8)
    sides = [read_run_by_key(spark, f"{db}.{m}_scores", fx.RUN).where("id IS NOT NULL") for m in ("model_1", "model_2")]
    print(final_plan(merge_unique(*sides, now=fx.NOW, clustered=True)).strip())
    print("```")
    spark.stop()


if __name__ == "__main__":
    main()
