"""Mixing sources to target weights by hierarchical budgets; DataFrame operations only.

Documents are leaves' contents in a tree of domain, language and source. A token budget flows
down from the root: the children of a node share its budget by their weights, but none gets
more than all its documents ``epochs`` times over. What a child cannot use goes to its siblings
by their weights, again and again until it is used up or all are full (solved in one pass over
the children in order of capacity per weight). As a node's capacity is the sum of its
children's, a shortage leaves a node only when all its children are full: siblings come first,
ancestors after. Each division rounds down; the remainder stays unspent.

A leaf spends its budget on the beginning of a sequence of epochs. Every epoch is all documents
of the leaf in an order seeded by its number; whole documents are taken while they fit. The
running sum of a leaf of n documents is taken in two steps, over some sqrt(n) ranges of the
order and then inside the one range where the budget ends, so that no task sorts a large leaf.

Defined cases: null texts have no tokens; null languages and sources are children like others,
null or numberless sources belong to the domain ``other``; rows that repeat an id are placed and
taken together; documents without tokens are taken whenever their place is reached; an empty
table gives no rows. Weights that are not named take the default of their level.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.llm.shared import WORD, stage, table


@dataclass(frozen=True)
class Recipe:
    """Whole-number weights, and the budget as a share of all tokens in thousandths."""

    domains: Mapping[str, int] = field(default_factory=lambda: {"web": 60, "reference": 30, "forum": 10})
    languages: Mapping[str, int] = field(default_factory=lambda: {"en": 50, "de": 20, "fr": 20, "es": 10})
    sources: Mapping[str, int] = field(default_factory=dict)
    default: tuple[int, int, int] = (5, 5, 10)
    budget: int = 800
    epochs: int = 2
    seed: int = 7


def domain(source: str = "source") -> Column:
    """The domain of a source, by the number at its end."""
    number = F.regexp_extract(F.col(source), "([0-9]+)$", 1)
    names = F.array(F.lit("web"), F.lit("reference"), F.lit("forum"))
    known = F.element_at(names, (F.right(number, F.lit(1)).cast("int") % 3 + 1).cast("int"))
    return F.when(F.length(number) > 0, known).otherwise(F.lit("other"))


LEAF = ["domain", "lang", "source"]


def _weight(column: str, weights: Mapping[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(F.col(column) == name, weight).otherwise(out)
    return out.cast("decimal(38,0)")


def shared_out(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """children (.., weight, cap, budget of their parent) with ``share``, capped and redistributed."""
    ratio = F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight").cast("double")).otherwise(F.lit(1e300))
    group = Window.partitionBy(*parent)
    order = group.orderBy(ratio, child)
    rows = children.withColumn("_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("_weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    full = F.col("cap") * F.col("_weights") <= F.col("weight") * (F.col("budget") - F.col("_before"))
    rows = rows.withColumn("_full", full)
    rows = rows.withColumn("_left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(group), F.lit(0)))
    rows = rows.withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("weight"))).over(group))
    portion = F.expr("case when _full then cast(cap as bigint) else (weight * _left) div _open end")
    return rows.withColumn("share", portion).drop("_before", "_weights", "_full", "_left", "_open")


def budgets(leaves: DataFrame, recipe: Recipe) -> DataFrame:
    """leaves (domain, lang, source, tokens, docs) with the tokens each gets as ``share``."""
    number = "decimal(38,0)"
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    leaves = leaves.withColumn("cap", (F.col("tokens") * recipe.epochs).cast(number))
    top = leaves.groupBy("domain").agg(F.sum("cap").cast(number).alias("cap"))
    top = top.withColumn("weight", _weight("domain", recipe.domains, recipe.default[0]))
    top = top.withColumn("budget", F.lit(total * recipe.budget // 1000).cast(number)).withColumn("root", F.lit(0))
    top = shared_out(top, ["root"], "domain").select("domain", F.col("share").cast(number).alias("budget"))
    middle = leaves.groupBy("domain", "lang").agg(F.sum("cap").cast(number).alias("cap")).join(top, "domain")
    middle = middle.withColumn("weight", _weight("lang", recipe.languages, recipe.default[1]))
    middle = shared_out(middle, ["domain"], "lang").select(
        F.col("domain").alias("_d"), F.col("lang").alias("_l"), F.col("share").cast(number).alias("budget")
    )
    bottom = leaves.join(middle, F.col("domain").eqNullSafe(F.col("_d")) & F.col("lang").eqNullSafe(F.col("_l"))).drop("_d", "_l")
    bottom = bottom.withColumn("weight", _weight("source", recipe.sources, recipe.default[2]))
    return shared_out(bottom, ["domain", "lang"], "source").select(*LEAF, "tokens", "docs", "share")


def _place(seed: int) -> Column:
    """Place of a document in the epoch that its leaf takes in part."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _with(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows joined with what is planned for their leaf."""
    plan = plan.select(*(F.col(k).alias(f"_{k}") for k in LEAF), *(c for c in plan.columns if c not in LEAF))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in LEAF]
    return rows.join(plan, same[0] & same[1] & same[2]).drop(*(f"_{k}" for k in LEAF))


def plan_leaves(rows: DataFrame, recipe: Recipe) -> DataFrame:
    """(leaf, full, digits, last_range, last_place): how much of its sequence each leaf takes.

    rows: (doc_id, domain, lang, source, tokens). A leaf takes ``full`` epochs, and of the next
    one the ranges before ``last_range`` and in that range the places up to ``last_place``.
    """
    leaves = stage(rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    plan = budgets(leaves, recipe)
    plan = plan.withColumn("full", F.expr("case when tokens > 0 then share div tokens else 0L end"))
    plan = plan.withColumn("rest", F.expr("share - full * tokens"))
    plan = plan.withColumn("digits", F.expr("length(hex(docs)) div 2").cast("int"))
    plan = stage(plan.select(*LEAF, "full", "rest", "digits").where(F.col("full") < recipe.epochs), "plan")
    placed = _with(rows, plan).withColumn("place", _place(recipe.seed))
    placed = placed.withColumn("part", F.expr("left(place, digits)"))
    upto = Window.partitionBy(*LEAF).orderBy("part")
    parts = placed.groupBy(*LEAF, "part", "rest").agg(F.sum("tokens").alias("tokens"))
    parts = parts.withColumn("upto", F.sum("tokens").over(upto)).where("upto > rest")
    last = parts.groupBy(*LEAF).agg(F.min(F.struct("part", F.expr("upto - tokens").alias("before"))).alias("l"))
    last = stage(last.select(*LEAF, F.col("l.part").alias("last_range"), F.col("l.before").alias("before")), "last")
    inside = _with(placed, last).where("part = last_range")
    inside = inside.withColumn("upto", F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("place")) + F.col("before"))
    ends = inside.where("upto <= rest").groupBy(*LEAF).agg(F.max("place").alias("last_place"))
    ends = last.select(*LEAF, "last_range").join(
        ends.select(*(F.col(k).alias(f"_{k}") for k in LEAF), "last_place"),
        F.col("domain").eqNullSafe(F.col("_domain")) & F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    ).drop("_domain", "_lang", "_source")
    ends = ends.select(*(F.col(k).alias(f"_{k}") for k in LEAF), "last_range", "last_place")
    every = budgets_full(leaves, recipe, plan)
    out = every.join(
        ends,
        F.col("domain").eqNullSafe(F.col("_domain")) & F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    )
    return stage(out.select(*LEAF, "full", "digits", "last_range", "last_place"), "ends")


def budgets_full(leaves: DataFrame, recipe: Recipe, plan: DataFrame) -> DataFrame:
    """Every leaf with its number of full epochs; those without a part of one take all epochs."""
    side = plan.select(*(F.col(k).alias(f"_{k}") for k in LEAF), F.col("full").alias("_full"), F.col("digits").alias("_digits"))
    same = F.col("domain").eqNullSafe(F.col("_domain")) & F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return leaves.join(side, same, "left").select(
        *LEAF, F.coalesce("_full", F.lit(recipe.epochs).cast("bigint")).alias("full"), F.col("_digits").alias("digits")
    )


def _copies(recipe: Recipe) -> Column:
    part = F.expr("left(place, digits)")
    inside = F.col("last_range").isNull() | (part < F.col("last_range"))
    inside = inside | ((part == F.col("last_range")) & (F.col("place") <= F.col("last_place")))
    taken = (F.col("full") < recipe.epochs) & F.coalesce(inside, F.lit(False))
    return F.col("full") + taken.cast("bigint")


def described(docs: DataFrame) -> DataFrame:
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("bigint"), F.lit(0))
    return docs.select("doc_id", domain().alias("domain"), "lang", "source", tokens.alias("tokens"))


def mix(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, copies) for each row: how often the mix holds it."""
    rows = stage(described(docs), "rows")
    chosen = _with(rows, plan_leaves(rows, recipe)).withColumn("place", _place(recipe.seed))
    return chosen.select("doc_id", *LEAF, F.col("tokens").alias("n_tokens"), _copies(recipe).alias("copies"))


def select_documents(docs: DataFrame, recipe: Recipe) -> DataFrame:
    """The rows of docs that the mix holds, each as often as it does, with their columns."""
    ends = plan_leaves(stage(described(docs), "rows"), recipe)
    kept = docs.columns
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), "doc_id", "lang", "source", domain().alias("domain"))
    chosen = _with(inner, ends).withColumn("place", _place(recipe.seed)).withColumn("_n", _copies(recipe)).where("_n > 0")
    if recipe.epochs > 1:
        chosen = chosen.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return chosen.select("_row.*")


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


def _sql(recipe: Recipe = Recipe()) -> str:
    def weight(column, weights, default):
        return "CASE " + column + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {default} END" if weights else str(default)

    def level(source, parent, child):
        part = f"PARTITION BY {parent}" if parent else ""
        order = f"{part} ORDER BY CASE WHEN weight > 0 THEN cap::DOUBLE / weight ELSE 1e300 END, {child} NULLS FIRST"
        return f"""
  SELECT *, CASE WHEN is_full THEN cap ELSE weight * (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({part}), 0))
                                  // sum(CASE WHEN NOT is_full THEN weight END) OVER ({part}) END AS share
  FROM (SELECT *, cap * rest_weight <= weight * (budget - before) AS is_full
        FROM (SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                     sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight
              FROM ({source})))"""

    top = f"SELECT domain, sum(cap) AS cap, {weight('domain', recipe.domains, recipe.default[0])}::HUGEINT AS weight, any_value(total) * {recipe.budget} // 1000 AS budget FROM leaves GROUP BY domain"
    middle = f"SELECT l.domain, l.lang, sum(l.cap) AS cap, {weight('l.lang', recipe.languages, recipe.default[1])}::HUGEINT AS weight, any_value(t.share) AS budget FROM leaves l JOIN top t ON l.domain = t.domain GROUP BY l.domain, l.lang"
    bottom = f"SELECT l.domain, l.lang, l.source, l.tokens, l.cap, {weight('l.source', recipe.sources, recipe.default[2])}::HUGEINT AS weight, m.share AS budget FROM leaves l JOIN middle m ON l.domain = m.domain AND l.lang IS NOT DISTINCT FROM m.lang"
    return rf"""
WITH rows AS (
  SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
         CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> '' THEN ['web', 'reference', 'forum'][right(source, 1)::INT % 3 + 1] ELSE 'other' END AS domain
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {recipe.epochs} AS cap,
         sum(sum(tokens)::HUGEINT) OVER () AS total
  FROM rows GROUP BY domain, lang, source
), top AS ({level(top, '', 'domain')}
), middle AS ({level(middle, 'domain', 'lang')}
), bottom AS ({level(bottom, 'domain, lang', 'source')}
), plan AS (
  SELECT *, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS whole FROM bottom
), placed AS (
  SELECT r.*, p.whole, p.share - p.whole * p.tokens AS rest,
         md5('{recipe.seed}:' || p.whole::BIGINT || ':' || coalesce(r.doc_id::VARCHAR, '')) AS place
  FROM rows r JOIN plan p ON r.domain = p.domain AND r.lang IS NOT DISTINCT FROM p.lang AND r.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, domain, lang, source, tokens AS n_tokens,
       (whole + (whole < {recipe.epochs} AND sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) <= rest)::INT)::BIGINT AS copies
FROM placed
"""


SQL = _sql()
