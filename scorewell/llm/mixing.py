"""Mixing sources to target weights by hierarchical token budgets.

Documents hang on a tree (domain, language, source).  A token budget flows
down from the root: the children of a node share its budget by their weights,
but none gets more than it can supply (the tokens of its leaves times
``max_epochs``).  What a short child can't take goes to its siblings by their
weights; a node passes less than its share upwards only if all of its children
are short, so shortages move among siblings before they reach an ancestor's.

A leaf with quota q and T tokens gives q div T whole epochs and a prefix of
one more: that epoch's order is a seeded hash of the document, and a document
belongs to the prefix if the tokens before it are fewer than q mod T.  The end
of the prefix is found by radix descent over the hash (256 sums a leaf and
level), so that no leaf is ever sorted as a whole, however large it is.

DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import blank_text, free_prefix, written

WORD = r"[^\x20\x09-\x0D]+"
LEAF = ["domain", "language", "origin"]
#: Hex digits of the hash that one level of the descent looks at, and levels.
DIGITS, LEVELS = 2, 3
#: Leaves (some 100 bytes each) that are sent to every executor, at most.
BROADCAST_LEAVES = 200_000
SALTS = 64


@dataclass(frozen=True)
class MixPlan:
    """Weights by level (whole numbers; other names get ``default``; 0 leaves a
    branch out), the budget as a share of all tokens, how often a document may be
    repeated at most, and the seed of the epochs' orders."""

    domains: Mapping[str, int] = field(default_factory=dict)
    languages: Mapping[str, int] = field(default_factory=dict)
    origins: Mapping[str, int] = field(default_factory=dict)
    default: int = 1
    budget: tuple[int, int] = (1, 1)
    max_epochs: int = 2
    seed: int = 17


def domain_of(source: Column) -> Column:
    """The query's domain: trailing number of the source modulo 4, as d0 to d3; else other."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(number == "", "other").otherwise(
        F.concat(F.lit("d"), F.pmod(number.cast("bigint"), F.lit(4)).cast("string"))
    )


def _weight(name: Column, given: Mapping[str, int], default: int) -> Column:
    out = F.lit(default)
    for k, v in given.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return out.cast("bigint")


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def share(children: DataFrame, parent: list[str]) -> DataFrame:
    """Divide each parent's ``budget`` among its children (``cap``, ``w``): adds ``quota``.

    Sorted by cap / w, the children that are short come first; a child is
    short if the level that the rest would reach isn't below its own.  Whole
    numbers throughout; quotas round down.
    """
    group = Window.partitionBy(*parent)
    order = group.orderBy(F.col("cap") / F.col("w"), *[c for c in LEAF if c in children.columns])
    low = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    short = (_wide(F.col("cap")) * rest.cast("decimal(12,0)")) <= (
        F.col("w").cast("decimal(12,0)") * _wide(F.col("budget") - low)
    )
    return (
        children.withColumn("short", short)
        .withColumn("taken", F.coalesce(F.sum(F.when(F.col("short"), F.col("cap"))).over(group), F.lit(0)))
        .withColumn("open_w", F.sum(F.when(~F.col("short"), F.col("w"))).over(group))
        .withColumn(
            "quota",
            F.expr(
                "CASE WHEN short THEN cap ELSE CAST(w AS DECIMAL(12,0)) * "
                "CAST(budget - taken AS DECIMAL(19,0)) DIV CAST(open_w AS DECIMAL(12,0)) END"
            ).cast("bigint"),
        )
        .drop("short", "taken", "open_w", "budget")
    )


def quotas(leaves: DataFrame, plan: MixPlan) -> DataFrame:
    """Leaves (domain, language, origin, tokens) with their ``quota`` in tokens."""
    up, down = plan.budget
    leaves = (
        leaves.withColumn("cap", F.col("tokens") * plan.max_epochs)
        .withColumn("w1", _weight(F.col("domain"), plan.domains, plan.default))
        .withColumn("w2", _weight(F.col("language"), plan.languages, plan.default))
        .withColumn("w3", _weight(F.col("origin"), plan.origins, plan.default))
    )
    total = leaves.agg(F.expr(f"sum(tokens) * {int(up)} DIV {int(down)}").cast("bigint")).first()[0] or 0
    leaves = leaves.where("w1 > 0 AND w2 > 0 AND w3 > 0")
    level = (
        leaves.groupBy("domain").agg(F.sum("cap").alias("cap"), F.max("w1").alias("w"))
        .withColumn("budget", F.lit(total).cast("bigint"))
        .withColumn("root", F.lit(0))
    )
    level = share(level, ["root"])
    for depth in (2, 3):
        keys, parent = LEAF[:depth], LEAF[: depth - 1]
        rows = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.max(f"w{depth}").alias("w"))
        above = level.select(*parent, F.col("quota").alias("budget"))
        level = share(rows.join(above, parent), parent)
    return leaves.select(*LEAF, "tokens").join(level.select(*LEAF, "quota"), LEAF)


def met(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Each row with its leaf's columns.

    Stored ``leaves`` are counted: ``BROADCAST_LEAVES`` of them or fewer go to all
    tasks, and the rows stay where they are; more meet the rows by leaf and salt, so
    that a leaf with a third of the rows spreads over ``SALTS`` tasks.
    """
    if leaves.count() <= BROADCAST_LEAVES:
        return rows.join(F.broadcast(leaves), LEAF)
    salted = leaves.withColumn("mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc", "n_tokens"), F.lit(SALTS)).cast("int")
    return rows.withColumn("mix_salt", salt).join(salted, [*LEAF, "mix_salt"]).drop("mix_salt")


def order_of(plan: MixPlan, epoch: Column, doc: Column) -> Column:
    """Where a document stands in an epoch."""
    return F.md5(F.concat_ws("|", F.lit(str(plan.seed)), epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit(""))))


def _order(plan: MixPlan) -> Column:
    return order_of(plan, F.col("epochs"), F.col("doc"))


def cuts(slim: DataFrame, plan: MixPlan) -> DataFrame:
    """For each leaf: quota, whole ``epochs``, and ``cut``, the last hash of the prefix ('' if none).

    ``slim`` has the leaf, ``doc`` and ``n_tokens``.
    """
    leaves = slim.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    state = written(
        quotas(leaves, plan)
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("quota DIV tokens")).otherwise(0).cast("bigint"))
        .withColumn("need", F.col("quota") - F.col("epochs") * F.col("tokens"))
        .withColumn("prefix", F.lit("")),
        "mix-quotas",
    )
    start = state
    for level in range(1, LEVELS + 1):
        n = DIGITS * level
        rows = (
            met(slim, state.where("need > 0"))
            .withColumn("h", F.substring(_order(plan), 1, n))
            .where(F.col("h").startswith(F.col("prefix")))
        )
        sums = rows.groupBy(*LEAF, "epochs", "need", "h").agg(F.sum("n_tokens").alias("t"))
        w = Window.partitionBy(*LEAF).orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
        state = written(
            sums.withColumn("before", F.coalesce(F.sum("t").over(w), F.lit(0)))
            .where("before < need AND need <= before + t")
            .select(*LEAF, "epochs", (F.col("need") - F.col("before")).alias("need"), F.col("h").alias("prefix")),
            f"mix-level{level}",
        )
    last = (
        met(slim, state)
        .withColumn("h", _order(plan))
        .where(F.col("h").startswith(F.col("prefix")))
        .groupBy(*LEAF, "need", "h").agg(F.sum("n_tokens").alias("t"))
    )
    w = Window.partitionBy(*LEAF).orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        last.withColumn("before", F.coalesce(F.sum("t").over(w), F.lit(0)))
        .where("before < need").groupBy(*LEAF).agg(F.max("h").alias("cut"))
    )
    return written(
        start.select(*LEAF, "tokens", "quota", "epochs").join(cut, LEAF, "left")
        .withColumn("cut", F.coalesce("cut", F.lit(""))),
        "mix-cuts",
    )


def leaf_columns(docs: DataFrame, domain: Column) -> DataFrame:
    """Adds the leaf, ``doc`` and ``n_tokens``; a null language or source is the empty name."""
    return docs.select(
        F.coalesce(domain, F.lit("")).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("origin"),
        F.col("doc_id").alias("doc"),
        F.regexp_count(blank_text(F.col("text")), F.lit(WORD)).cast("bigint").alias("n_tokens"),
    )


def copies(plan: MixPlan, epochs: Column, doc: Column, cut: Column) -> Column:
    """How often a document of a leaf with these whole epochs and this cut is taken."""
    return (epochs + F.when(order_of(plan, epochs, doc) <= cut, 1).otherwise(0)).cast("int")


def mix_table(docs: DataFrame, plan: MixPlan, domain: Column | None = None) -> DataFrame:
    """One row per document taken: doc_id, its leaf, n_tokens, the leaf's quota, copies.

    ``docs`` needs doc_id, text, lang and source; other columns play no part.
    Null texts have no tokens; a document without tokens comes along if its
    hash lies in the prefix.  Rows with equal doc_id in a leaf stand at one place of
    the order and are taken together.  A null doc_id stands where an empty text would.
    Texts are counted whole, however long.  An empty table gives no rows.
    """
    domain = domain_of(F.col("source")) if domain is None else domain
    slim = written(leaf_columns(docs, domain), "mix-slim")
    return (
        met(slim, cuts(slim, plan))
        .withColumn("copies", copies(plan, F.col("epochs"), F.col("doc"), F.col("cut")))
        .where("copies > 0")
        .select(F.col("doc").alias("doc_id"), "domain", F.col("language").alias("lang"),
                F.col("origin").alias("source"), "n_tokens", "quota", "copies")
    )


def mix(docs: DataFrame, plan: MixPlan, domain: Column | None = None) -> DataFrame:
    """The documents taken, each as often as the mix repeats it, with the columns of ``docs``.

    Each row is held against its leaf's cut; unless there are more than
    ``BROADCAST_LEAVES`` leaves, texts aren't shuffled for that.
    """
    domain = domain_of(F.col("source")) if domain is None else domain
    slim = written(leaf_columns(docs, domain), "mix-slim")
    p = free_prefix(docs, "mix_")
    leaves = cuts(slim, plan)
    if leaves.count() <= BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    found = leaves.select(*[F.col(c).alias(f"{p}{c}") for c in [*LEAF, "epochs", "cut"]])
    keys = {
        f"{p}domain": F.coalesce(domain, F.lit("")),
        f"{p}language": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        f"{p}origin": F.coalesce(F.col("source").cast("string"), F.lit("")),
    }
    taken = copies(plan, F.col(f"{p}epochs"), F.col("doc_id"), F.col(f"{p}cut"))
    return (
        docs.withColumns(keys).join(found, list(keys))
        .withColumn(f"{p}copies", taken).where(F.col(f"{p}copies") > 0)
        .withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1), F.col(f"{p}copies"))))
        .select(*docs.columns)
    )


#: The production mix: domain weights 4 to 1, English over the other languages, the hot
#: source held down, as many tokens as the corpus has, two epochs at most.
PLAN = MixPlan(
    domains={"d0": 4, "d1": 3, "d2": 2},
    languages={"en": 4, "de": 2, "fr": 2},
    origins={"src0": 1},
    default=1,
    budget=(1, 1),
    max_epochs=2,
    seed=17,
)


def mix_sql(plan: MixPlan, documents: str = "documents") -> str:
    """CTEs of DuckDB ending in ``mixed`` (doc_id, domain, language, origin, n_tokens, quota, copies)."""

    def weight(col: str, given: Mapping[str, int]) -> str:
        cases = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in given.items())
        return f"CAST(CASE {cases} ELSE {plan.default} END AS HUGEINT)" if cases else f"CAST({plan.default} AS HUGEINT)"

    def level(name: str, rows: str, parent: str, order: str) -> str:
        return f"""
{name}_a AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {order}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low, sum(w) OVER (PARTITION BY {parent}
    ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM ({rows})),
{name}_b AS (SELECT *, cap * rest <= w * (budget - low) AS short FROM {name}_a),
{name}_c AS (SELECT *, coalesce(sum(cap) FILTER (short) OVER (PARTITION BY {parent}), 0) AS taken,
    sum(w) FILTER (NOT short) OVER (PARTITION BY {parent}) AS open_w FROM {name}_b),
{name} AS (SELECT * EXCLUDE (budget), CAST(CASE WHEN short THEN cap ELSE (w * (budget - taken)) // open_w END AS HUGEINT) AS quota FROM {name}_c)"""

    up, down = plan.budget
    return f"""
slim AS (SELECT doc_id AS doc, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
    ELSE 'd' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % 4 AS VARCHAR) END AS domain,
    coalesce(lang, '') AS language, coalesce(source, '') AS origin,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS HUGEINT) AS n_tokens FROM {documents}),
leaves AS (SELECT domain, language, origin, sum(n_tokens) AS tokens, sum(n_tokens) * {plan.max_epochs} AS cap,
    {weight('domain', plan.domains)} AS w1, {weight('language', plan.languages)} AS w2, {weight('origin', plan.origins)} AS w3
    FROM slim GROUP BY domain, language, origin),
open AS (SELECT * FROM leaves WHERE w1 > 0 AND w2 > 0 AND w3 > 0),
{level('l1', f"SELECT 0 AS root, domain, sum(cap) AS cap, max(w1) AS w, (SELECT sum(tokens) * {up} // {down} FROM leaves) AS budget FROM open GROUP BY domain", 'root', 'domain')},
{level('l2', "SELECT o.domain, language, sum(o.cap) AS cap, max(w2) AS w, max(quota) AS budget FROM open o JOIN l1 USING (domain) GROUP BY o.domain, language", 'domain', 'domain, language')},
{level('l3', "SELECT o.domain, o.language, origin, sum(o.cap) AS cap, max(w3) AS w, max(tokens) AS tokens, max(quota) AS budget FROM open o JOIN l2 USING (domain, language) GROUP BY o.domain, o.language, origin", 'domain, language', 'domain, language, origin')},
part AS (SELECT domain, language, origin, quota, CASE WHEN tokens > 0 THEN quota // tokens ELSE 0 END AS epochs,
    CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS need FROM l3),
hashed AS (SELECT slim.*, quota, epochs, need, md5('{plan.seed}|' || CAST(epochs AS VARCHAR) || '|' || coalesce(CAST(doc AS VARCHAR), '')) AS h
    FROM slim JOIN part USING (domain, language, origin)),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - sum(n_tokens) OVER (PARTITION BY domain, language, origin, h) AS before FROM hashed),
mixed AS (SELECT doc AS doc_id, domain, language, origin, n_tokens, quota,
    CAST(epochs + CASE WHEN before < need THEN 1 ELSE 0 END AS INTEGER) AS copies FROM placed)"""
