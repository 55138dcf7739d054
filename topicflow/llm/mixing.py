"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens flows down the tree domain - language - source by
integer weights.  A node gets no more than its subtree holds (tokens times
the largest number of epochs); what it cannot use goes to its siblings in
proportion to their weights, and leaves the parent only if the whole parent
is full.  Each leaf takes whole epochs, then the longest prefix of the next
one whose tokens fit; an epoch is the order of a seeded hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, staged

LEVELS = ["domain", "lang", "source"]
NONE = "(none)"  # label of a null language or source


def tokens(text: Column) -> Column:
    """Words of the text plus one end token."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)) + 1).cast("long")


def domain_of(source: Column, domains: int = 4) -> Column:
    """The domain of a source where no other rule is given: by hash."""
    number = F.conv(F.substring(F.md5(source.cast("binary")), 1, 4), 16, 10).cast("int")
    return F.concat(F.lit("domain"), (number % domains).cast("string"))


def weight(column: str, weights: dict[str, int]) -> Column:
    """Integer weight of a node by its label; 1 where none is given."""
    return reduce(lambda w, item: w.when(F.col(column) == item[0], F.lit(item[1])), weights.items(),
                  F.when(F.lit(False), F.lit(1))).otherwise(F.lit(1)).cast("long")


def share_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Split the parent's ``budget`` among its children by ``weight`` up to
    their ``capacity``: adds ``share``.

    In the order of capacity per weight, a child is full if what is left
    would give it at least its capacity; the full ones are the first ones,
    and the others split the rest by weight (rounded down)."""
    siblings = Window.partitionBy(*parent).orderBy(F.try_divide("capacity", "weight"), "name")
    before = siblings.rowsBetween(Window.unboundedPreceding, -1)
    family = Window.partitionBy(*parent)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weights = F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    held = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(family)
    open_weight = F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(family)
    return (nodes.withColumn("full", F.col("capacity") * weights <= left * F.col("weight"))
            .withColumn("rest", F.col("budget") - held).withColumn("open_weight", open_weight)
            .withColumn("share", F.when(F.col("full"), F.col("capacity"))
                        .otherwise(F.expr("rest * weight div open_weight")))
            .drop("full", "rest", "open_weight"))


def leaf_budgets(leaves: DataFrame, fraction: tuple[int, int], max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) plus ``budget``: the tokens
    to take from each; together ``fraction`` (numerator, denominator) of all
    tokens, or less if ``max_epochs`` of everything hold less.  Nothing is
    taken from below a weight of 0; its share goes to the others."""
    barred = reduce(Column.__or__, [weight(level, weights.get(level, {})) == 0 for level in LEVELS])
    nodes = leaves.withColumn("capacity", F.when(barred, F.lit(0)).otherwise(F.col("tokens") * max_epochs))
    total = nodes.agg(F.sum("tokens").alias("all_tokens"), F.sum("capacity").alias("all_capacity"))
    budgets = total.select(F.lit(0).alias("root"), F.least("all_capacity", F.expr(f"all_tokens * {fraction[0]} div {fraction[1]}")).alias("budget"))
    parent = ["root"]
    for level in LEVELS:
        keys = [*parent, level]
        children = (nodes.withColumn("root", F.lit(0)).groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
                    .withColumn("weight", weight(level, weights.get(level, {}))).withColumn("name", F.col(level))
                    .join(budgets, parent))
        budgets = share_out(children, parent).select(*keys, F.col("share").alias("budget"))
        parent = keys
    return leaves.join(budgets.drop("root"), LEVELS)


def mix(spark: SparkSession, docs: DataFrame, fraction: tuple[int, int], max_epochs: int,
        weights: dict[str, dict[str, int]], seed: str, domain: Column | None = None, buckets: int = 2) -> DataFrame:
    """The documents chosen, one row per document and epoch: (row, doc_id,
    domain, lang, source, n_tokens, epoch), where ``row`` is a struct of all
    columns of ``docs``.

    The epoch cut is found in two steps, so that no leaf meets in one task:
    token sums of each leaf by the first ``buckets`` hex digits of the hash
    name the bucket that holds the cut, and only that bucket is put in order.
    Null languages and sources form leaves of their own; a null or empty text
    has one token; repeated rows count one by one (equal rows are
    interchangeable); an empty table gives no rows."""
    source = F.coalesce(F.col("source"), F.lit(NONE))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (domain_of(source) if domain is None else domain).alias("domain"),
        F.coalesce(F.col("lang"), F.lit(NONE)).alias("lang"), source.alias("source"), tokens(F.col("text")).alias("n_tokens"))

    def ordered(epoch):
        return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))

    leaves = staged(spark, rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    budget = leaf_budgets(leaves, fraction, max_epochs, weights)
    plan = staged(spark, budget.select(
        *LEVELS, F.expr(f"least(budget div tokens, {max_epochs})").cast("int").alias("whole"),
        F.expr(f"budget - tokens * least(budget div tokens, {max_epochs})").alias("rest")), "budgets")
    hashed = rows.join(plan, LEVELS).withColumn("order", ordered(F.col("whole"))).withColumn("bucket", F.substring("order", 1, buckets))
    sums = hashed.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("n_tokens").alias("tokens"))
    upto = Window.partitionBy(*LEVELS).orderBy("bucket")
    cuts = (sums.withColumn("upto", F.sum("tokens").over(upto)).where("upto > rest and upto - tokens <= rest")
            .select(*LEVELS, F.col("bucket").alias("cut"), (F.col("upto") - F.col("tokens")).alias("before")))
    plan = staged(spark, plan.join(cuts, LEVELS, "left"), "cuts")
    chosen = rows.join(plan, LEVELS).withColumn("order", ordered(F.col("whole"))).withColumn("bucket", F.substring("order", 1, buckets))
    out = ["row", "doc_id", *LEVELS, "n_tokens", "epoch"]
    # whole epochs, and the part of the next one that lies before the cut's bucket
    sure = chosen.select("*", F.explode(F.expr("""
        sequence(0, whole - if(whole > 0 and (cut is null or bucket >= cut), 1, 0))""")).alias("epoch")).where(
        "epoch < whole or (cut is not null and bucket < cut)")
    running = Window.partitionBy(*LEVELS).orderBy("order", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    partly = (chosen.where("bucket = cut").withColumn("upto", F.col("before") + F.sum("n_tokens").over(running))
              .where("upto <= rest").withColumn("epoch", F.col("whole")))
    return sure.select(*out).unionByName(partly.select(*out))
