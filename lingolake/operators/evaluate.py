"""Scores of a detector against gold labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def judged(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """gold (id, category, is_vpe, ellipsis_site) and predicted (id, form) to a row per example with ``fired`` and ``site``; no prediction counts as none."""
    forms = predicted.groupBy("id").agg(F.collect_set(F.lower(F.trim("form"))).alias("forms"))
    sites = F.filter(F.transform(F.split(F.coalesce("ellipsis_site", F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return gold.join(forms, "id", "left").select("id", "category", "is_vpe", F.col("forms").isNotNull().alias("fired"), F.coalesce(F.arrays_overlap("forms", sites), F.lit(False)).alias("site"))


def report(rows: DataFrame) -> DataFrame:
    """One row: counts, precision, recall, f1, accuracy, recall by site; 0 where there is nothing to divide by."""
    yes, fired = F.col("is_vpe"), F.col("fired")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in (("tp", yes & fired), ("fp", ~yes & fired), ("fn", yes & ~fired), ("tn", ~yes & ~fired), ("site_hits", yes & F.col("site")), ("n_positives", yes))])
    share = lambda a, b: F.round(F.coalesce(F.try_divide(F.expr(a), F.expr(b)), F.lit(0.0)), 3)
    return counts.select("n", "tp", "fp", "fn", "tn", "site_hits", "n_positives", share("tp", "tp + fp").alias("precision"), share("tp", "tp + fn").alias("recall"), share("2 * tp", "2 * tp + fp + fn").alias("f1"), share("tp + tn", "n").alias("accuracy"), share("site_hits", "n_positives").alias("site_recall"))


def by_category(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("category").isin("VPE_RESOLVABLE", "VPE_UNRESOLVABLE", "NO_VPE")).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if("fired").alias("fired"), F.round(F.avg(F.col("fired").cast("double")), 3).alias("rate"))
