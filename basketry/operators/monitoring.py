"""Checks on scores, features and recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TYPE = "pdm_prod_type_id"


def score_distribution(scores: DataFrame, bins: int = 10) -> DataFrame:
    """Rows, mean and range of the scores per type and equal-width bin."""
    bin_no = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("bigint")
    return scores.groupBy(TYPE, bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("p").alias("mean_p"),
        F.min("p").alias("min_p"),
        F.max("p").alias("max_p"),
    )


def score_sketches(scores: DataFrame, by: Sequence[str] = (TYPE,), size: int = 200) -> DataFrame:
    """A quantile sketch of the scores per group, say type and day, to be kept and merged later.

    A sketch of `size` holds groups of up to that many rows exactly; beyond it the rank of a quantile is off by
    about 1.33 % of the rows at 200, in proportion less for larger sizes. Rows without a score are left out.
    """
    known = scores.filter(F.col("p").isNotNull() & ~F.isnan("p"))
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col("p").cast("double"), F.lit(size)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (TYPE,)) -> DataFrame:
    """One sketch per group of finer ones, say a type's over its days."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, shares: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """(the groups, n, share, p): the score that a share of the rows does not exceed."""
    by = [c for c in sketches.columns if c != "sketch"]
    rows = [
        F.struct(F.lit(float(x)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(x))).alias("p"))
        for x in shares
    ]
    return sketches.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(F.array(*rows)))


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("CENTROID_ID").agg(F.count(F.lit(1)).alias("n"))


def feature_drift(
    before: DataFrame, after: DataFrame, features: Sequence[str], edges: Sequence[float]
) -> DataFrame:
    """Population stability index per feature over bins cut at the given edges.

    Empty bins count as half a row, so the index stays finite.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features
        ]))).filter(F.col("v").isNotNull())
        bin_no = sum((F.when(F.col("v") >= edge, 1).otherwise(0) for edge in edges), F.lit(0))
        return long.groupBy("feature", bin_no.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias(name))

    both = counts(before, "a").join(counts(after, "b"), ["feature", "bin"], "full").select(
        "feature",
        F.greatest(F.coalesce("a", F.lit(0)).cast("double"), F.lit(0.5)).alias("a"),
        F.greatest(F.coalesce("b", F.lit(0)).cast("double"), F.lit(0.5)).alias("b"),
    )
    # At most one row per feature and bin is left here.
    totals = both.groupBy("feature").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    pa, pb = F.col("a") / F.col("ta"), F.col("b") / F.col("tb")
    return both.join(totals, "feature").groupBy("feature").agg(
        F.sum((pb - pa) * F.log(pb / pa)).alias("psi")
    )


def coverage(recs: DataFrame, catalog_types: DataFrame) -> DataFrame:
    """Share of the catalog's types that are recommended at least once, per region."""
    types = catalog_types.agg(F.countDistinct(TYPE).alias("n_types")).scalar()
    shown = recs.groupBy("region").agg(
        F.countDistinct("recomm_pdm_prod_type_id").alias("n_recommended")
    )
    return shown.withColumn("n_types", types).withColumn(
        "coverage", F.col("n_recommended") / F.col("n_types")
    )


def pair_hits(recs: DataFrame, later_counts: DataFrame, customer_region: DataFrame) -> DataFrame:
    """Share per region of recommended pairs that customers bought together later.

    A pair is a hit when a customer of the region bought both types in the later window.
    """
    bought = later_counts.join(customer_region, "customer_id").select("region", "customer_id", TYPE)
    wanted = recs.select("region", "focus_pdm_prod_type_id", "recomm_pdm_prod_type_id").distinct()
    focus = bought.join(
        wanted.withColumnRenamed("focus_pdm_prod_type_id", TYPE), ["region", TYPE]
    ).select(
        "region", "customer_id", F.col(TYPE).alias("focus_pdm_prod_type_id"),
        F.col("recomm_pdm_prod_type_id").alias(TYPE),
    )
    hits = focus.join(bought, ["region", "customer_id", TYPE], "left_semi").select(
        "region", "focus_pdm_prod_type_id", F.col(TYPE).alias("recomm_pdm_prod_type_id")
    ).distinct()
    hit_counts = hits.groupBy("region").agg(F.count(F.lit(1)).alias("n_hits"))
    return wanted.groupBy("region").agg(F.count(F.lit(1)).alias("n_pairs")).join(
        hit_counts, "region", "left"
    ).select(
        "region",
        "n_pairs",
        F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
        (F.coalesce("n_hits", F.lit(0)) / F.col("n_pairs")).alias("precision"),
    )


def later_hits(recs: DataFrame, later_counts: DataFrame, customer_region: DataFrame) -> DataFrame:
    """Precision and recall per region of recommended pairs against the pairs bought together in a later window.

    A customer adds at most types-squared pairs, which are made distinct before they leave a task. Precision or
    recall is null where nothing was recommended or bought together.
    """
    pair = ["region", "focus_pdm_prod_type_id", "recomm_pdm_prod_type_id"]
    bought = later_counts.join(customer_region, "customer_id").select(
        "region", "customer_id", F.col(TYPE).alias("focus_pdm_prod_type_id")
    ).distinct()
    other = bought.withColumnRenamed("focus_pdm_prod_type_id", "recomm_pdm_prod_type_id")
    together = bought.join(other, ["region", "customer_id"]).filter(
        F.col("focus_pdm_prod_type_id") != F.col("recomm_pdm_prod_type_id")
    ).select(*pair).distinct()
    judged = recs.select(*pair).distinct().withColumn("_shown", F.lit(1)).join(
        together.withColumn("_bought", F.lit(1)), pair, "full"
    )
    counted = judged.groupBy("region").agg(
        F.count("_shown").alias("n_pairs"), F.count("_bought").alias("n_bought"),
        F.count(F.col("_shown") + F.col("_bought")).alias("n_hits"),
    )
    share = lambda total: F.when(F.col(total) > 0, F.col("n_hits") / F.col(total))
    return counted.withColumn("precision", share("n_pairs")).withColumn("recall", share("n_bought"))


def compare_groups(outcomes: DataFrame, group: str, outcome: str) -> DataFrame:
    """Rows, mean and standard error of an outcome per treatment group."""
    value = F.col(outcome).cast("double")
    return outcomes.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean"),
        (F.stddev_samp(value) / F.sqrt(F.count(F.lit(1)))).alias("std_error"),
    )


# The distribution function of the Poisson law with mean 1 at 0, 1, 2, ...
POISSON = (
    0.367879441171, 0.735758882343, 0.919698602929, 0.981011843124, 0.996340153173, 0.999405815182, 0.999916758851,
    0.999989750803, 0.999998874797,
)


def bootstrap_difference(
    outcomes: DataFrame, group: str, outcome: str, arms: tuple, key: str = "customer_id", replicates: int = 200,
    level: float = 0.95, seed: int = 42,
) -> DataFrame:
    """One row: difference of the second arm's mean outcome from the first one's, its bootstrap interval (low, high)
    and whether that leaves out 0.

    Every replicate gives a customer, not a row, a weight of the Poisson law with mean 1 from a hash of seed,
    replicate and customer, so a customer's rows stay together and any partitioning gives the same weights. Rows are
    summed per customer first; what is shuffled after that is a row per arm, replicate and task. Rows without a
    customer or an outcome are left out, as are replicates in which an arm has no weight.
    """
    value = F.col(outcome).cast("double")
    sums = (
        outcomes.filter(F.col(key).isNotNull() & value.isNotNull() & F.col(group).isin(*arms))
        .groupBy(key, F.col(group).alias("_arm")).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    )
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "_b", F.col(key).cast("string"))), 1, 8), 16, 10)
    drawn = place.cast("double") / float(1 << 32)
    weight = sum((F.when(drawn >= x, 1).otherwise(0) for x in POISSON), F.lit(0))
    # Replicate 0 is the data themselves.
    weighted = sums.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(replicates)))).withColumn(
        "_w", F.when(F.col("_b") == 0, 1).otherwise(weight)
    )
    means = weighted.groupBy("_b").agg(*[
        (F.sum(F.when(F.col("_arm") == arm, F.col("_w") * F.col("_s")))
         / F.nullif(F.sum(F.when(F.col("_arm") == arm, F.col("_w") * F.col("_n"))), F.lit(0))).alias(name)
        for arm, name in zip(arms, ("_first", "_second"), strict=True)
    ])
    difference = F.col("_second") - F.col("_first")
    found = means.agg(
        F.max(F.when(F.col("_b") == 0, difference)).alias("difference"),
        F.sort_array(F.collect_list(F.when(F.col("_b") > 0, difference))).alias("_d"),  # `replicates` numbers
    )

    def rank(share: float):
        return F.get("_d", F.greatest(F.ceil(F.lit(share) * F.size("_d")).cast("int"), F.lit(1)) - 1)

    return found.select("difference", rank((1 - level) / 2).alias("low"), rank((1 + level) / 2).alias("high")).withColumn(
        "differs", (F.col("low") > 0) | (F.col("high") < 0)
    )
