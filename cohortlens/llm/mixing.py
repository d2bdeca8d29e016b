"""Mixing sources to target weights by hierarchical budgeting over domain, language and source.

SQL functions only. The token budget runs down the tree: siblings share their parent's budget by weight,
none gets more than its subtree holds in ``max_epochs`` passes, and what one cannot use goes to its
siblings; only what no sibling can hold is left to the siblings of the parent, and so on up. Every leaf
then takes whole seeded epochs of its documents and, of the last one, the prefix that fills its budget to
the token: documents in the order of md5(seed:epoch:doc_id), the last one cut.

The prefix needs no sort of a leaf: tokens are summed by (leaf, leading hash digits), the sums give the
one bucket that holds the leaf's edge, and so on within that bucket, some digits more each time, until it holds
at most ``EDGE_ROWS`` documents (rows of one id cannot be told apart by hash). Only these are ordered. A hot
leaf is spread over all tasks; tables of leaves are broadcast only below ``SMALL`` rows. The nodes of a level
are summed in one task for each parent: the tree is taken to be small.

Defined results: NULL or blank language and source count as ``unknown``; a NULL or empty text holds no
token; a document without tokens comes with every whole epoch; rows with equal ids are taken one by
one; NULL ids are ordered like an empty id; nodes of weight zero get nothing; an empty table gives an
empty table; further columns are ignored by ``mix`` and kept by ``select``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize

TOKEN = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
DIGITS = 2          # hash digits by which a leaf's edge is closed in on: 256 buckets at a time
EDGE_ROWS = 2000    # documents of a leaf's edge bucket that are ordered
SMALL = 100_000     # leaves up to which their table is broadcast


@dataclass(frozen=True)
class Target:
    """Weights by level and name (others: ``other``), the budget as a share of all tokens, the seed."""

    weights: dict = field(default_factory=lambda: {
        "domain": {"src": 3, "src1": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}, "source": {}})
    other: int = 1
    share: float = 0.6
    max_epochs: int = 2
    seed: int = 7


def _name(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("unknown"))


def leaf_columns(lang: Column, source: Column) -> dict[str, Column]:
    """The place of a document in the tree; a source's domain is its name without the last digit."""
    s = _name(source)
    return {"domain": F.regexp_replace(s, "[0-9]$", ""), "lang": _name(lang), "source": s}


def _weight(level: str, target: Target) -> Column:
    out = F.lit(target.other)
    for name, w in target.weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _fill(nodes: DataFrame, level: str, parents: list[str]) -> DataFrame:
    """Adds ``alloc``: each node's part of its parent's ``budget``, by weight ``w`` and at most ``cap``.

    In the order of cap / w the full nodes come first: node i is full if, of what the ones before it
    leave, its share among itself and all after it is at least its capacity.
    """
    part = Window.partitionBy(*parents) if parents else Window.partitionBy()
    by = part.orderBy(F.col("cap") / F.col("w"), level)
    before = F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing))
    d = lambda c: c.cast("double")
    n = nodes.withColumn("full_node", d(F.col("budget") - before) * d(F.col("w")) >= d(F.col("cap")) * d(rest))
    used = F.coalesce(F.sum(F.when(F.col("full_node"), F.col("cap"))).over(part), F.lit(0))
    open_w = F.sum(F.when(~F.col("full_node"), F.col("w"))).over(part)
    share = F.floor(d(F.col("budget") - used) * d(F.col("w")) / d(open_w))
    return n.withColumn("alloc", F.when(F.col("full_node"), F.col("cap")).otherwise(share)) \
        .drop("full_node", "budget", "cap", "w")


def budgets(supply: DataFrame, target: Target) -> DataFrame:
    """(domain, lang, source, supply, alloc) of every leaf, from its tokens ``supply``."""
    total = supply.agg(F.floor(F.sum("supply").cast("double") * target.share)).first()[0] or 0
    usable = supply
    for level in LEVELS:
        usable = usable.filter(_weight(level, target) > 0)
    caps = usable.withColumn("cap", F.col("supply") * target.max_epochs)
    alloc = None
    for depth, level in enumerate(LEVELS):
        parents, keys = list(LEVELS[:depth]), list(LEVELS[:depth + 1])
        nodes = caps.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(level, target))
        if alloc is None:
            nodes = nodes.withColumn("budget", F.lit(total))
        else:
            nodes = nodes.join(alloc.select(*parents, F.col("alloc").alias("budget")), parents)
        alloc = _fill(nodes, level, parents)
    return supply.join(alloc, list(LEVELS), "left").fillna(0, ["alloc"])


def _key(epoch: Column, doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _with(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    n = leaves.count()
    return rows.join(F.broadcast(leaves) if n <= SMALL else leaves, list(LEVELS))


def plan(slim: DataFrame, target: Target) -> DataFrame:
    """One row per leaf that gets tokens: its whole epochs, the tokens of the last one, its edge bucket."""
    supply = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply"))
    leaves = materialize(budgets(supply, target).filter("alloc > 0").select(
        *LEVELS, "supply", "alloc", F.expr("alloc div supply").alias("whole"),
        F.expr("alloc % supply").alias("rest")), "leaves")
    edge = leaves.filter("rest > 0").select(*LEVELS, "whole", "rest", F.lit("").alias("edge"), F.lit(0).cast("long").alias("before"))
    digits = 0
    while True:  # down to the bucket that holds the leaf's edge, some digits at a time
        digits += DIGITS
        rows = _with(slim, edge).withColumn("key", _key(F.col("whole"), F.col("doc_id"), target.seed)) \
            .filter(F.startswith("key", "edge"))
        sums = rows.groupBy(*LEVELS, "whole", "rest", "before", F.left("key", F.lit(digits)).alias("edge")).agg(
            F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("rows"))
        w = Window.partitionBy(*LEVELS).orderBy("edge").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = F.col("before") + F.sum("n").over(w)  # of at most 16 ** DIGITS rows a leaf
        sums = sums.withColumn("upto", upto).filter("upto - n < rest and upto >= rest")
        edge = materialize(sums.select(*LEVELS, "whole", "rest", "edge", (F.col("upto") - F.col("n")).alias("before"), "rows"), "edges")
        if digits >= 32 or (edge.agg(F.max("rows")).first()[0] or 0) <= EDGE_ROWS:
            break
    return materialize(leaves.join(edge.select(*LEVELS, "edge", "before"), list(LEVELS), "left"), "leaf-plan")


def _slim(docs: DataFrame) -> DataFrame:
    tokens = F.coalesce(F.regexp_count("text", F.lit(TOKEN)), F.lit(0)).cast("long")
    return materialize(docs.select("doc_id", *[c.alias(k) for k, c in leaf_columns(
        F.col("lang"), F.col("source")).items()], tokens.alias("tokens")), "tokens")


def mix(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """(doc_id, domain, lang, source, epoch, tokens, taken): the documents of the mix, once an epoch."""
    slim = _slim(docs)
    rows = _with(slim, plan(slim, target)).withColumn("key", _key(F.col("whole"), F.col("doc_id"), target.seed))
    bucket = F.left("key", F.length("edge"))
    whole = rows.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))) \
        .withColumn("taken", F.col("tokens"))
    inside = rows.filter(bucket < F.col("edge")).withColumns({"epoch": F.col("whole"), "taken": F.col("tokens")})
    w = Window.partitionBy(*LEVELS).orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before") + F.coalesce(F.sum("tokens").over(w), F.lit(0))
    edge = rows.filter(bucket == F.col("edge")).withColumn("at", before).filter("at < rest").withColumns(
        {"epoch": F.col("whole"), "taken": F.least("tokens", F.col("rest") - F.col("at"))})
    cols = ["doc_id", *LEVELS, "epoch", "tokens", "taken"]
    return whole.select(cols).unionByName(inside.select(cols)).unionByName(edge.select(cols))


def select(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """The rows of ``docs`` in the mix, whole and once an epoch, with all their columns.

    A document that ``mix`` cuts comes whole, so a leaf exceeds its budget by less than one document.
    """
    slim = _slim(docs)
    leaves = plan(slim, target)
    rows = _with(slim, leaves.filter(F.col("edge").isNotNull())).withColumn(
        "key", _key(F.col("whole"), F.col("doc_id"), target.seed)).filter(F.startswith("key", "edge"))
    w = Window.partitionBy(*LEVELS).orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.withColumn("at", F.col("before") + F.coalesce(F.sum("tokens").over(w), F.lit(0))) \
        .filter("at < rest").groupBy(*LEVELS).agg(F.max("key").alias("last_key"))
    leaves = materialize(leaves.join(last, list(LEVELS), "left"), "leaf-edges")
    tmp = fresh(docs, "mix_leaf")
    leaf = leaves.select(F.struct(*LEVELS).alias(tmp + "_on"), F.struct("whole", "last_key").alias(tmp))
    on = F.struct(*[c.alias(k) for k, c in leaf_columns(F.col("lang"), F.col("source")).items()])
    n = leaf.count()
    joined = docs.withColumn(tmp + "_at", on).join(
        F.broadcast(leaf) if n <= SMALL else leaf, F.col(tmp + "_at") == F.col(tmp + "_on"))
    plan_of = F.col(tmp)
    part = F.coalesce(_key(plan_of.whole, F.col("doc_id"), target.seed) <= plan_of.last_key, F.lit(False))
    times = plan_of.whole + part.cast("long")
    return joined.withColumn(tmp + "_n", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(times, F.lit(1))))) \
        .filter(times > 0).select(docs.columns)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(nullif(trim(lang), ''), 'unknown') AS lang,
         coalesce(nullif(trim(source), ''), 'unknown') AS source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens
  FROM documents),
d AS (SELECT doc_id, regexp_replace(source, '[0-9]$', '') AS domain, lang, source, tokens FROM t),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS supply, 2 * sum(tokens)::BIGINT AS cap FROM d GROUP BY ALL),
n1 AS (SELECT domain, sum(cap)::BIGINT AS cap, CASE domain WHEN 'src' THEN 3 WHEN 'src1' THEN 2 ELSE 1 END AS w,
       (SELECT floor(sum(supply)::DOUBLE * 0.6)::BIGINT FROM leaf) AS budget FROM leaf GROUP BY domain),
f1 AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE * w
         >= cap::DOUBLE * sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sat FROM n1),
a1 AS (SELECT domain, CASE WHEN sat THEN cap ELSE floor((budget - coalesce(sum(cap) FILTER (WHERE sat) OVER (), 0))::DOUBLE * w
         / sum(w) FILTER (WHERE NOT sat) OVER ())::BIGINT END AS budget FROM f1),
n2 AS (SELECT domain, lang, sum(cap)::BIGINT AS cap, CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w,
       any_value(a1.budget) AS budget FROM leaf JOIN a1 USING (domain) GROUP BY domain, lang),
f2 AS (SELECT *, (budget - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE * w
         >= cap::DOUBLE * sum(w) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sat FROM n2),
a2 AS (SELECT domain, lang, CASE WHEN sat THEN cap ELSE floor((budget - coalesce(sum(cap) FILTER (WHERE sat) OVER (PARTITION BY domain), 0))::DOUBLE * w
         / sum(w) FILTER (WHERE NOT sat) OVER (PARTITION BY domain))::BIGINT END AS budget FROM f2),
n3 AS (SELECT domain, lang, source, supply, cap, 1 AS w, a2.budget FROM leaf JOIN a2 USING (domain, lang)),
f3 AS (SELECT *, (budget - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE * w
         >= cap::DOUBLE * sum(w) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sat FROM n3),
a3 AS (SELECT domain, lang, source, supply, CASE WHEN sat THEN cap ELSE floor((budget - coalesce(sum(cap) FILTER (WHERE sat) OVER (PARTITION BY domain, lang), 0))::DOUBLE * w
         / sum(w) FILTER (WHERE NOT sat) OVER (PARTITION BY domain, lang))::BIGINT END AS alloc FROM f3),
r AS (SELECT d.*, alloc // supply AS whole, alloc % supply AS rest, unnest(range(2)) AS epoch
      FROM d JOIN a3 USING (domain, lang, source) WHERE alloc > 0),
k AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY md5('7:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')), tokens
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM r)
SELECT doc_id, domain, lang, source, epoch::BIGINT AS epoch, tokens,
       (CASE WHEN epoch < whole THEN tokens ELSE least(tokens, rest - seen) END)::BIGINT AS taken
FROM k WHERE epoch < whole OR (epoch = whole AND seen < rest)
"""
