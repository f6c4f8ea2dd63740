"""The order in which annotators run, and the views that each one runs on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Name, command of ``lingolake.run``, view that it normalises (none: all views), language option, phenomenon; parses first, coreference last.
ANNOTATORS = [
    ("parses", "parse", None, "--language", ""),
    ("real-word errors", "real-word-errors", "rwse_normalized", "--language", ""),
    ("spelling errors", "spelling", "spelling_normalized", "--language", ""),
    ("nominal ellipsis", "detect", "nominal_ellipsis_resolved", "--lang", "nominal_ellipsis"),
    ("verbal ellipsis", "detect", "vpe_resolved", "--lang", "verbal_ellipsis"),
    ("shared subjects", "detect", "coord_subjects_explicated", "--lang", "subject_sharing"),
    ("gapped coordination", "detect", "gapped_coordination_resolved", "--lang", "gapped_coordination"),
    ("bare questions", "detect", "bare_questions_resolved", "--lang", "bare_questions"),
    ("sluicing", "detect", "sluicing_resolved", "--lang", "sluicing"),
    ("passive", "detect", None, "--lang", "passive"),
    ("clefts", "detect", None, "--lang", "clefts"),
    ("right node raising", "detect", "right_node_raising_normalized", "--lang", "right_node_raising"),
    ("discourse units", "discourse-units", None, None, ""),
    ("coreference", "coreference", "coref_normalized", "--language", ""),
]


def annotators(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i + 1, *a) for i, a in enumerate(ANNOTATORS)], "pos int, name string, command string, normalized_view string, lang_flag string, phenomenon string")


def plan(steps: DataFrame, views: DataFrame) -> DataFrame:
    """(pos, name, views): each annotator with the views (view, pos) up to the one that it normalises, or with all."""
    v = views.select("view", F.col("pos").alias("view_pos"))
    target = v.withColumnsRenamed({"view": "normalized_view", "view_pos": "upto"})
    rows = steps.join(target, "normalized_view", "left").join(v, F.col("view_pos") <= F.coalesce("upto", F.lit(1 << 30)))
    return rows.groupBy("pos", "name", "command", "lang_flag", "phenomenon").agg(F.transform(F.array_sort(F.collect_list(F.struct("view_pos", "view"))), lambda x: x["view"]).alias("views"))


def commands(steps: DataFrame, views: DataFrame, runner: str = "python -m lingolake.run") -> DataFrame:
    """(pos, command): one line of a shell script for each annotator."""
    parts = [F.lit(runner), F.col("command"), F.when(F.col("phenomenon") != "", F.concat(F.lit("--phenomenon "), F.col("phenomenon"))), F.when(F.col("lang_flag").isNotNull(), F.concat(F.col("lang_flag"), F.lit(' "$LANG_CODE"'))), F.lit("--view"), F.array_join("views", " "), F.lit('-- "$INPUT"')]
    return plan(steps, views).select("pos", F.concat_ws(" ", *parts).alias("command"))


def read_views(spark: SparkSession, path: str) -> DataFrame:
    """(view, pos) of a views file (``view_order:`` with a list of ``- id: name``); a file without any is an error."""
    import re

    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    names = re.findall(r"^\s*-\s*(?:\{\s*)?id:\s*[\"']?([^\"'\s},]+)", text.partition("view_order:")[2], re.M)
    if not names:
        raise ValueError(f"{path}: no 'view_order' entries with an 'id'")
    return spark.createDataFrame([(v, i) for i, v in enumerate(names)], "view string, pos int")
