"""Queries of functions and files that the catalogue doesn't meet elsewhere, with SQL of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import lexicon as L
from ..operators import annotate, layers, models, text as texts
from ..shared import new_dir
from ..sources import files
from ..sources.forest import FOREST_SQL
from . import annotators
from .catalog import _nodes, _sentences, table
from .detector_sql import _q


def emphasis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms in capitals, shouted or not; the evidence goes by their place."""
    rows = _nodes(_sentences(spark, sf_dir, "form")).filter(F.expr("n.form RLIKE '^[A-Z]{2,}$'"))
    place = F.col("n.ord")
    return rows.groupBy("lang", F.col("n.form").alias("form"), texts.is_emphasis(F.col("lang"), F.col("n.form"), place % 2 == 0, place % 5 == 0, place % 3 == 0).alias("emphasis")).agg(F.count(F.lit(1)).alias("n"))


EMPHASIS_SQL = f"""SELECT lang, form, CASE WHEN coalesce({' OR '.join(f"(lang = '{k}' AND lower(form) IN {_q(v)})" for k, v in L.FUNCTION_WORDS.items())}, false) THEN o % 5 <> 0 WHEN o % 2 = 0 OR o % 5 = 0 THEN false WHEN coalesce(lang, '') <> 'en' THEN false ELSE o % 3 = 0 END AS emphasis, count(*) AS n
    FROM tok WHERE regexp_full_match(form, '[A-Z]{{2,}}') GROUP BY ALL"""


def long_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands before a gloss separator, put into the benchmark's texts, and whether it can stand for a short form."""
    text = F.expr("concat(' ', substring(text, 1, cast(10 + item_id % 40 AS int)), if(item_id % 3 = 0, '||', ''), substring(text, 60, 9))")
    return table(spark, sf_dir, "benchmark").select("item_id", texts.substitutable_part(text).alias("part"), texts.is_substitutable(text).alias("fits"))


LONG_FORMS_SQL = f"""SELECT item_id, part, part <> '' AND NOT starts_with(part, '(') AND NOT regexp_matches(part, '(?i){L.GLOSS.replace("'", "''")}') AND len(string_split_regex(part, '[\\s\\p{{Z}}]+')) <= 6 AS fits FROM (
    SELECT item_id, CASE WHEN trim(split_part(trim(t), '||', 1)) = '' THEN trim(t) ELSE trim(split_part(trim(t), '||', 1)) END AS part
    FROM (SELECT item_id, ' ' || text[1 : 10 + item_id % 40] || CASE WHEN item_id % 3 = 0 THEN '||' ELSE '' END || text[60 : 68] AS t FROM benchmark))"""


def next_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring words that are fixed together; German verb particles that words begin with; capitals taken over."""
    pairs = _sentences(spark, sf_dir, "form", "lemma").select("lang", "nodes", F.explode("nodes").alias("n")).select("lang", F.expr("named_struct('a', n.form, 'b', coalesce(get(nodes, n.ord).form, ''), 'lemma', n.lemma)").alias("x"))
    known = texts.lexicalised_prep_article(F.col("x.a"), F.col("x.b"))
    rows = pairs.select("lang", known.alias("fixed"), F.size(texts.particle_lengths("x.a")).alias("particles"), F.length(texts.match_case(F.col("x.lemma"), F.col("x.a"))).alias("chars"), (texts.match_case(F.col("x.lemma"), F.col("x.a")) == F.col("x.lemma")).alias("same"))
    return rows.groupBy("lang", "fixed", "particles", "same").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


_CASED = "CASE WHEN form[1] = upper(form[1]) AND form[1] <> lower(form[1]) THEN upper(lemma[1]) || lemma[2:] ELSE lemma END"
NEXT_WORDS_SQL = f"""SELECT lang, {' OR '.join(f"(lower(form) = '{a}' AND lower(b2) = '{b}')" for a, b in L.LEXICALISED_PREP_ARTICLES)} AS fixed, CAST(len([p FOR p IN [{', '.join(f"'{p}'" for p in L.VERB_PARTICLES_DE)}] IF starts_with(lower(form), p) AND length(p) < length(form)]) AS INTEGER) AS particles,
    {_CASED} = lemma AS same, count(*) AS n, CAST(sum(length({_CASED})) AS BIGINT) AS chars FROM (SELECT *, coalesce(lead(form) OVER (PARTITION BY d, s ORDER BY o), '') AS b2 FROM tok) GROUP BY ALL"""


def cluster_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("if(item_id % 3 = 0, cast(item_id AS string), concat('Q', item_id))")
    return table(spark, sf_dir, "benchmark").groupBy(texts.is_cluster_id(value).alias("is_id")).agg(F.count(F.lit(1)).alias("n"))


CLUSTER_IDS_SQL = "SELECT item_id % 3 = 0 AS is_id, count(*) AS n FROM benchmark GROUP BY 1"


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coreference clusters by arithmetic over a document's first sentence, as phrases; some lie out of range."""
    first = _sentences(spark, sf_dir, "t_start", "t_end").filter("sent_id = 0")
    clusters = first.select("doc_id", F.expr("array(array(array(cast(doc_id % 5 AS int), cast(doc_id % 5 + 2 AS int)), array(1, 1)), array(array(0, cast(doc_id % 15 AS int))))").alias("clusters"))
    tokens = first.select("doc_id", F.explode("nodes").alias("n")).select("doc_id", (F.col("n.ord") - 1).alias("place"), F.col("n.t_start").alias("begin"), F.col("n.t_end").alias("end"))
    return models.mentions(clusters, tokens)


MENTIONS_SQL = """, m AS (SELECT DISTINCT d, '1' AS label, d % 5 AS a, d % 5 + 2 AS z, 1 AS k FROM tok UNION ALL SELECT DISTINCT d, '1', 1, 1, 2 FROM tok UNION ALL SELECT DISTINCT d, '2', 0, d % 15, 3 FROM tok)
    SELECT m.d AS doc_id, label, CAST(x.b AS INTEGER) AS "begin", CAST(y.e AS INTEGER) AS "end" FROM m JOIN tok x ON x.d = m.d AND x.s = 0 AND x.o = m.a + 1 JOIN tok y ON y.d = m.d AND y.s = 0 AND y.o = m.z + 1"""

VIEWS = ["_InitialView", "spelling_normalized", "rwse_normalized", "vpe_resolved", "sluicing_resolved", "coref_normalized"]


def plan_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = spark.createDataFrame([(v, i) for i, v in enumerate(VIEWS)], "view string, pos int")
    return annotators.commands(annotators.annotators(spark), views)


_STEPS = ", ".join(f"({i + 1}, '{c}', {repr(v) if v else 'NULL'}, {repr(f) if f else 'NULL'}, '{p}')" for i, (_, c, v, f, p) in enumerate(annotators.ANNOTATORS))
PLAN_COMMANDS_SQL = f"""WITH steps(pos, command, target, flag, phenomenon) AS (VALUES {_STEPS}), views(view, i) AS (VALUES {', '.join(f"('{v}', {i})" for i, v in enumerate(VIEWS))})
    SELECT CAST(s.pos AS INTEGER) AS pos, concat_ws(' ', 'python -m lingolake.run', s.command, CASE WHEN phenomenon <> '' THEN '--phenomenon ' || phenomenon END, flag || ' "$LANG_CODE"', '--view', string_agg(v.view, ' ' ORDER BY v.i), '-- "$INPUT"') AS command
    FROM steps s LEFT JOIN views t ON t.view = s.target JOIN views v ON v.i <= coalesce(t.i, 999) GROUP BY s.pos, s.command, phenomenon, flag"""


def annotate_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that does its own annotations anew and leaves those of others."""
    sentences = _sentences(spark, sf_dir, "form", "lemma", "upos", "xpos", "deprel", "head", "t_start", "t_end")
    existing = annotate.detect(sentences, "verbal_ellipsis").unionByName(annotate.detect(sentences.filter("doc_id % 2 = 0"), "bare_questions"))
    again = annotate.run_again(existing, sentences, "bare_questions", replace=True)
    return again.groupBy("doc_id", "phenomenon", "kind", "category").agg(F.count(F.lit(1)).alias("n"))


def conllu_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CoNLL-U blocks themselves, by their hashes."""
    return layers.to_conllu(_sentences(spark, sf_dir, text=True, mwts=True)).select("doc_id", "sent_id", F.md5("block").alias("block_md5"))


_FEATS = "CASE feats WHEN '' THEN '_' WHEN 'Gender=Masc|Case=Acc' THEN 'Case=Acc|Gender=Masc' WHEN 'Gender=Fem|Case=Dat' THEN 'Case=Dat|Gender=Fem' WHEN 'Gender=Neut|Case=Nom|Number=Sing' THEN 'Case=Nom|Gender=Neut|Number=Sing' ELSE feats END"
CONLLU_TEXT_SQL = f""", lined AS (SELECT *, CASE WHEN (o + d + s) % 2 = 0 AND nf IS NOT NULL THEN concat(o, '-', o + 1, chr(9), lower(form || nf), repeat(chr(9) || '_', 8), chr(10)) ELSE '' END
        || concat_ws(chr(9), o, form, coalesce(nullif(lemma, ''), '_'), coalesce(nullif(upos, ''), '_'), coalesce(nullif(xpos, ''), '_'), {_FEATS}, head, deprel, '_', CASE WHEN nb = e THEN 'SpaceAfter=No|' ELSE '' END || 't_start=' || b || '|t_end=' || e) AS line
        FROM (SELECT *, lead(form) OVER w AS nf, lead(b) OVER w AS nb FROM tok WINDOW w AS (PARTITION BY d, s ORDER BY o)))
    SELECT d AS doc_id, CAST(s AS INTEGER) AS sent_id, md5('# sent_id = ' || s || chr(10) || '# text = ' || string_agg(CASE WHEN o > 1 AND NOT glue THEN ' ' ELSE '' END || form, '' ORDER BY o) || coalesce(chr(10) || '# lang = ' || any_value(lang), '') || chr(10) || string_agg(line, chr(10) ORDER BY o) || chr(10)) AS block_md5 FROM lined GROUP BY d, s"""


def xmi_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations written as XMI files and read back."""
    items = table(spark, sf_dir, "benchmark")
    sofas = items.select(F.col("item_id").alias("doc_id"), F.lit("_InitialView").alias("view"), "text")
    none = F.lit(None).cast("string")
    number = F.lit(None).cast("double")
    anomalies = sofas.select("doc_id", "view", F.lit("GrammarAnomaly").alias("kind"), F.lit(0).alias("begin"), F.length("text").alias("end"), F.lit("Ellipsis").alias("description"), F.expr("concat('kind_', doc_id % 4)").alias("category"), none.alias("label"), F.substring("text", 1, 12).alias("suggestion"), F.lit(0.5).alias("certainty"))
    phrases = sofas.select("doc_id", "view", F.lit("LexicalPhrase").alias("kind"), F.lit(1).alias("begin"), F.lit(4).alias("end"), none.alias("description"), none.alias("category"), F.substring("text", 2, 3).alias("label"), none.alias("suggestion"), number.alias("certainty"))
    notes = anomalies.unionByName(phrases)
    folder = new_dir(spark, "xmi")
    files.write_xmi(sofas, notes, folder)
    back = files.read_xmi(spark, folder).filter("prefix = 'custom'")
    feature = lambda k: F.col("features").getItem(k)
    return back.select(F.regexp_extract("file", r"(-?\d+)\.xmi$", 1).cast("long").alias("item_id"), "type", "begin", "end", feature("category").alias("category"), F.coalesce(feature("text"), feature("replacement")).alias("told"))


XMI_ROUND_TRIP_SQL = """SELECT item_id, 'GrammarAnomaly' AS type, 0 AS "begin", CAST(length(text) AS INTEGER) AS "end", 'kind_' || (item_id % 4) AS category, NULL AS told FROM benchmark
    UNION ALL SELECT item_id, 'LexicalPhrase', 1, 4, NULL, text[2:4] FROM benchmark UNION ALL SELECT item_id, 'SuggestedAction', NULL, NULL, NULL, text[1:12] FROM benchmark"""


def gold_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold examples written as one JSON object and read back."""
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text", F.expr("if(item_id % 2 = 0, 'NO_VPE', 'VPE_RESOLVABLE')").alias("category"), F.expr("item_id % 2 = 1").alias("is_vpe"), F.expr("substring(text, 1, 3)").alias("ellipsis_site"))
    folder = new_dir(spark, "gold")
    # the benchmark is a small table; this is what such a file is made of
    rows.agg(F.to_json(F.struct(F.collect_list(F.struct(*rows.columns)).alias("examples"))).alias("value")).write.text(folder)
    return files.read_gold(spark, folder)


GOLD_ROUND_TRIP_SQL = "SELECT CAST(item_id AS VARCHAR) AS id, text, CASE WHEN item_id % 2 = 0 THEN 'NO_VPE' ELSE 'VPE_RESOLVABLE' END AS category, item_id % 2 = 1 AS is_vpe, text[1:3] AS ellipsis_site FROM benchmark"


def _forest(body: str) -> str:
    return f"WITH RECURSIVE {FOREST_SQL} {body}"


QUERIES = {"emphasis": emphasis, "long_forms": long_forms, "next_words": next_words, "cluster_ids": cluster_ids, "mentions": mentions, "plan_commands": plan_commands, "annotate_replace": annotate_replace, "conllu_text": conllu_text, "xmi_round_trip": xmi_round_trip, "gold_round_trip": gold_round_trip}


def oracles(detectors: dict[str, str]) -> dict[str, str]:
    """SQL for the queries, given that of the detectors."""
    counted = " UNION ALL ".join(f"SELECT doc_id, '{p}' AS phenomenon, 'GrammarAnomaly' AS kind, '{c}' AS category, count(*) AS n FROM ({detectors[f'det_{p}']}) GROUP BY doc_id" for p, c in (("verbal_ellipsis", "auxiliary"), ("bare_questions", "bare_wh")))
    return {
        "emphasis": _forest(EMPHASIS_SQL), "long_forms": LONG_FORMS_SQL, "next_words": _forest(NEXT_WORDS_SQL), "cluster_ids": CLUSTER_IDS_SQL, "mentions": _forest(MENTIONS_SQL), "plan_commands": PLAN_COMMANDS_SQL,
        "annotate_replace": counted, "conllu_text": _forest(CONLLU_TEXT_SQL), "xmi_round_trip": XMI_ROUND_TRIP_SQL, "gold_round_trip": GOLD_ROUND_TRIP_SQL,
    }
