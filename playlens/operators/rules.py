"""Genre association rules with Spark ML FP-Growth.

Baskets are distinct, non-empty genre arrays (``genre_array`` maps an empty
genre string to a null basket, which FP-Growth leaves out of the record
count and which predicts nothing).  Item order inside itemsets is not
defined by FP-Growth, so outputs sort every set.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens import params
from playlens.operators.barrier import materialize
from playlens.operators.textjoin import broadcast_if_small


def fit_rules(baskets: DataFrame, items_col: str = "basket",
              min_support: float = params.FP_MIN_SUPPORT,
              min_confidence: float = params.FP_MIN_CONFIDENCE,
              num_partitions: int | None = None) -> FPGrowthModel:
    """Mine frequent genre sets and rules (parallel FP-growth over the baskets)."""
    fp = FPGrowth(itemsCol=items_col, predictionCol="prediction",
                  minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    return fp.fit(baskets.select(F.array_distinct(F.col(items_col)).alias(items_col)))


def freq_itemsets(model: FPGrowthModel) -> DataFrame:
    """``items`` (sorted array), ``freq``."""
    return model.freqItemsets.select(F.sort_array("items").alias("items"), F.col("freq").cast("bigint"))


def association_rules(model: FPGrowthModel) -> DataFrame:
    """``antecedent`` (sorted array), ``consequent`` (one genre), confidence, lift, support."""
    return model.associationRules.select(
        F.sort_array("antecedent").alias("antecedent"),
        F.col("consequent")[0].alias("consequent"),
        "confidence", "lift", "support",
    )


def rule_table(model: FPGrowthModel) -> DataFrame:
    """The rules as a table for :func:`apply_rules`: ``antecedent``, ``consequent``, ``anchor``.

    ``anchor`` is the antecedent's rarest item, the join key that meets the fewest baskets.
    """
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("anchor"), "freq")
    rules = association_rules(model).select("antecedent", "consequent")
    return with_anchor(rules, single)


def with_anchor(rules: DataFrame, item_freq: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Adds the rarest item of each antecedent; ``item_freq`` holds ``anchor, freq`` (per ``keys``)."""
    keys = keys or []
    parts = rules.select(*keys, "antecedent", "consequent", F.explode("antecedent").alias("anchor")).join(item_freq, [*keys, "anchor"])
    return parts.groupBy(*keys, "antecedent", "consequent").agg(F.min_by("anchor", F.struct("freq", "anchor")).alias("anchor"))


def apply_rules(baskets: DataFrame, rules: DataFrame, items_col: str = "basket", keys: list[str] | None = None) -> DataFrame:
    """Add ``prediction``: sorted consequents of the rules whose antecedent the basket holds.

    Items already in the basket are never predicted; a null basket predicts an
    empty array.  Every distinct basket meets the rules once: its items join
    the rules' anchors (an antecedent inside the basket has its anchor there),
    and ``array_except`` confirms the rest.  The rules are a table and stay
    one; they are broadcast only after a count.  ``keys`` restricts rules to
    baskets of the same group.
    """
    keys = keys or []
    empty = F.array().cast("array<string>")
    named = baskets.filter(F.col(items_col).isNotNull()).withColumn("_set", F.array_sort(F.array_distinct(F.col(items_col))))
    sets = named.select(*keys, "_set").distinct()
    met = (sets.withColumn("anchor", F.explode("_set")).join(broadcast_if_small(materialize(rules)), [*keys, "anchor"])
           .filter((F.size(F.array_except("antecedent", "_set")) == 0) & ~F.array_contains("_set", F.col("consequent"))))
    found = materialize(met.groupBy(*keys, "_set").agg(F.sort_array(F.collect_set("consequent")).alias("prediction")))
    out = named.join(broadcast_if_small(found), [*keys, "_set"], "left").withColumn("prediction", F.coalesce("prediction", empty))
    none = baskets.filter(F.col(items_col).isNull()).withColumn("prediction", empty)
    return out.select(*baskets.columns, "prediction").unionByName(none)


def predict(model: FPGrowthModel, baskets: DataFrame) -> DataFrame:
    """:func:`apply_rules` with the rules of a mined model."""
    return apply_rules(baskets, rule_table(model))


# ---- rules of many groups at once ----------------------------------------------------------------

def group_itemsets(baskets: DataFrame, group: str, items_col: str = "basket",
                   min_support: float = params.FP_MIN_SUPPORT) -> DataFrame:
    """Frequent sets of every group's own baskets: ``group, items`` (sorted), ``freq``.

    The same sets as one FP-Growth run per group (E1): a set counts where its
    support within the group reaches ``min_support``; null baskets do not count.
    Equal baskets of a group are one row with a weight, and items below the
    support are cut off first.  Sets then grow level by level by items that
    follow in sort order, so every candidate is a frequent set plus one item,
    and the number of levels is the length of the longest frequent set.
    """
    whole = materialize(baskets.filter(F.col(items_col).isNotNull())
                        .select(group, F.array_sort(F.array_distinct(F.col(items_col))).alias("_set"))
                        .groupBy(group, "_set").agg(F.count(F.lit(1)).alias("_n")))
    least = whole.groupBy(group).agg(F.ceil(F.sum("_n") * F.lit(min_support)).alias("_least"))
    items = whole.select(group, F.explode("_set").alias("_item"), "_n").groupBy(group, "_item").agg(F.sum("_n").alias("_f"))
    common = (items.join(least, group).filter("_f >= _least")
              .groupBy(group).agg(F.collect_set("_item").alias("_common"), F.first("_least").alias("_least")))
    level = (whole.join(common, group).withColumn("_set", F.array_intersect("_set", "_common")).filter(F.size("_set") > 0)
             .groupBy(group, "_set").agg(F.sum("_n").alias("_n"), F.first("_least").alias("_least"))
             .select("*", F.array().cast("array<string>").alias("items"), F.lit(0).alias("_at")))
    level = materialize(level)
    found = None
    while True:
        grown = level.select(group, "_set", "_n", "_least", "items", "_at", F.posexplode(F.slice("_set", F.col("_at") + 1, F.size("_set")))
                             .alias("_step", "_item"))
        grown = grown.select(group, "_set", "_n", "_least", F.concat("items", F.array("_item")).alias("items"),
                             (F.col("_at") + F.col("_step") + 1).alias("_at"))
        sets = materialize(grown.groupBy(group, "items").agg(F.sum("_n").alias("freq"), F.first("_least").alias("_least"))
                           .filter("freq >= _least").select(group, "items", "freq"))
        found = sets if found is None else found.unionByName(sets)
        if sets.isEmpty():
            return found
        level = materialize(grown.filter(F.col("_at") < F.size("_set")).join(sets.select(group, "items"), [group, "items"], "left_semi"))


def group_rules(itemsets: DataFrame, group: str, min_confidence: float = params.FP_MIN_CONFIDENCE) -> DataFrame:
    """Rules of every group (E2): ``group, antecedent, consequent, anchor``."""
    sets = itemsets.filter(F.size("items") > 1).withColumn("consequent", F.explode("items")).withColumn(
        "antecedent", F.array_remove("items", F.col("consequent")))
    base = itemsets.select(group, F.col("items").alias("antecedent"), F.col("freq").alias("_base"))
    rules = sets.join(base, [group, "antecedent"]).filter(
        F.col("freq").cast("double") / F.col("_base").cast("double") >= min_confidence).select(group, "antecedent", "consequent")
    single = itemsets.filter(F.size("items") == 1).select(group, F.col("items")[0].alias("anchor"), "freq")
    return with_anchor(rules, single, [group])


def predicted_genres(predicted: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per predicted genre of every basket with a non-empty prediction."""
    cols = keep or []
    return predicted.filter(F.size("prediction") > 0).select(
        *cols, F.explode("prediction").alias("genre"))
