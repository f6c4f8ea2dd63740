"""Text functions, layers, model decisions, plans and evaluation on small inputs; the catalogue against SQL."""

import re

import pytest
from pyspark.sql import functions as F

from lingolake.functions import lexicon as L
from lingolake.operators import evaluate, layers, models, text as T
from lingolake.plans import annotators, queries as catalog

SF = "/root/testdata/sf0.001"


def values(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_text_functions(spark):
    assert values(spark, "t string", [("a\nb \t c  d ",), (None,), ("",)], T.clean(F.col("t"))) == [("ab c d",), (None,), ("",)]
    assert values(spark, "t string", [("NNP",), ("MD",), (None,)], T.penn_to_universal(F.col("t")), T.penn_to_wordnet(F.coalesce("t", F.lit("")))) == [("NOUN", "n"), ("X", "n"), ("X", "n")]
    row = [("en", None, None), ("de", "lg", None), ("xx", None, "own")]
    assert values(spark, "l string, s string, c string", row, T.model_name(F.col("l"), F.col("s"), F.col("c"))) == [("en_core_web_md",), ("de_core_news_lg",), ("own",)]
    for bad in (("xx", None), ("en", "xl")):
        with pytest.raises(Exception, match="not"):
            values(spark, "l string, s string", [bad], T.model_name(F.col("l"), F.col("s"), F.lit(None).cast("string")))
    found = values(spark, "tokens array<string>, t string", [(["ab", "zz", "b"], "ab  b")], T.token_offsets("tokens", "t"))
    assert [tuple(x) for x in found[0][0]] == [(0, 2), (2, 2), (4, 5)]
    assert values(spark, "t string", [("One. Two!  Three?",)], T.split_sentences(F.col("t"))) == [("One.\nTwo!\nThree?",)]
    assert values(spark, "a string, b string", [("word", "Old"), ("word", "old")], T.match_case(F.col("a"), F.col("b"))) == [("Word",), ("word",)]
    assert values(spark, "a string", [("12",), ("x",), (None,)], T.is_cluster_id(F.col("a"))) == [(True,), (False,), (False,)]


def test_abbreviation_functions(spark):
    forms = [("bareback||without",), ("Abkürzung für x",), ("(x)",), ("a b c d e f g",), ("fine form",), (None,)]
    assert values(spark, "f string", forms, T.substitutable_part(F.col("f")), T.is_substitutable(F.col("f"))) == [("bareback", True), ("Abkürzung für x", False), ("(x)", False), ("a b c d e f g", False), ("fine form", True), ("", False)]
    assert values(spark, "t string", [("I.e. this vs. that w/o advs e.g.",)], T.lexicalised(F.col("t"))) == [(["I.e.", "vs.", "w/o", "e.g."],)]
    assert values(spark, "t string", [("I.e.",), ("vs",)], T.lexicalised_expansion(F.col("t"))) == [("That is",), ("versus",)]
    emphasis = [("de", "VOR", True, False, False), ("en", "CAT", True, False, True), ("en", "ALWAYS", False, False, True), ("en", "OOP", False, False, False), ("en", "IT", True, True, True), (None, "X", False, False, True)]
    got = values(spark, "l string, f string, e boolean, s boolean, w boolean", emphasis, T.is_emphasis(*map(F.col, "lfesw")))
    assert [x[0] for x in got] == [True, False, True, False, False, False]
    assert values(spark, "a string, b string", [("Zum", "Beispiel"), ("im", "Haus"), ("im", None)], T.lexicalised_prep_article(F.col("a"), F.col("b"))) == [(True,), (False,), (False,)]
    assert values(spark, "w string", [("hinunterlaufen",)], T.particle_lengths("w")) == [([8, 3],)]


def test_derivable(spark):
    """Against a plain recursive version."""
    known = {"debug", "use", "active", "happy", "class", "object", "program"}
    words = "reusability debuggable debugger happiness subclassable activity programming objectoriented oop xyzzy unhappiness uses Debug".split()

    def peel(w):
        for suffix, ends in L.SUFFIXES:
            if w.endswith(suffix) and len(w) - len(suffix) >= 3:
                for end in ends:
                    base = w[: -len(suffix)] + end
                    yield base
                    if not end:
                        if len(base) > 1 and base[-1] == base[-2]:
                            yield base[:-1]
                        if base.endswith("i"):
                            yield base[:-1] + "y"
                        if base.endswith("ck"):
                            yield base[:-1]
        for p in L.PREFIXES:
            if w.startswith(p) and len(w) - len(p) >= 3:
                yield w[len(p) :]

    def ok(w, depth=0):
        return w in known or (depth < 3 and any(ok(x, depth + 1) for x in peel(w) if len(x) >= 3))

    got = T.derivable(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(w,) for w in known], "word string"))
    assert {r[0] for r in got.collect()} == {w for w in words if ok(w.lower())} >= {"reusability", "debuggable", "happiness"}


def test_pairing_and_missing_dependency(spark):
    token = [(1, "v", 0, 3, i, f) for i, f in ((1, "a"), (2, "b"), (3, "c"))] + [(1, "v", 4, 5, 4, "d")]
    tokens = spark.createDataFrame(token, "doc_id long, view string, begin int, end int, id long, form string")
    tags = spark.createDataFrame([(1, "v", 0, 3, 10, "X"), (1, "v", 0, 3, 11, "Y")], "doc_id long, view string, begin int, end int, id long, upos string")
    assert sorted((r["form"], r["upos"]) for r in layers.paired(tokens, tags, "upos").collect()) == [("a", "X"), ("b", "Y"), ("c", "X"), ("d", None)]
    none = tags.limit(0)
    span = spark.createDataFrame([(1, "v", 0, 9, 1, "t")], "doc_id long, view string, begin int, end int, id long, text string")
    links = spark.createDataFrame([(1, "v", 1, 1, 1, "dep")], "doc_id long, view string, dependent long, governor long, id long, deprel string")
    with pytest.raises(Exception, match="no dependency"):
        layers.assembled(span, tokens, none.withColumn("xpos", F.lit("")), none.withColumn("lemma", F.lit("")), none.withColumn("feats", F.lit("")), links).collect()
    views = spark.createDataFrame([(1, "v"), (2, "v")], "doc_id long, view string")
    assert [r["doc_id"] for r in layers.without_layer(views, tokens).collect()] == [2]


def test_models(spark):
    scored = [(1, "Their", "their", 0.01, 0), (1, "Their", "there", 0.5, 1), (1, "Their", "they're", 0.5, 2), (2, "to", "to", 0.4, 0), (2, "to", "too", 0.5, 1), (3, "it", "its", 0.2, 0)]
    got = models.decide_swap(spark.createDataFrame(scored, "k int, surface string, candidate string, score double, rank int"), keys=["k"])
    assert sorted((r["k"], r["suggestion"], round(r["certainty"], 3)) for r in got.collect()) == [(1, "There", 1.699), (3, "its", 10.0)]
    units = values(spark, "sentence string, labels array<int>", [(" We left  because it rained", [0, 0, 1]), ("", []), ("  ", None)], F.expr(models.discourse_units(shift="100")))
    assert [[tuple(u) for u in r[0]] for r in units] == [[(101, 108), (110, 127)], [], []]
    clusters = spark.createDataFrame([(1, [[[0, 0], [2, 3]], [[1, 9]]])], "doc_id long, clusters array<array<array<int>>>")
    tokens = spark.createDataFrame([(1, i, i * 4, i * 4 + 3) for i in range(4)], "doc_id long, place int, begin int, end int")
    assert sorted(tuple(r) for r in models.mentions(clusters, tokens).collect()) == [(1, "1", 0, 3), (1, "1", 8, 15)]
    with pytest.raises(Exception, match="no clusters"):
        models.mentions(clusters.withColumn("clusters", F.expr("cast(array() AS array<array<array<int>>>)")), tokens).collect()
    words, known = [("teh",), ("the",), ("cart",)], [("the", 50), ("ten", 9), ("cat", 7), ("car", 7), ("a", 1)]
    got = models.spelling_candidates(spark.createDataFrame(words, "word string"), spark.createDataFrame(known, "word string, n int"))
    assert sorted((r["word"], r["candidate"], r["rank"]) for r in got.collect()) == [("cart", "car", 1), ("cart", "cat", 2), ("teh", "ten", 1)]


def test_plans(spark, tmp_path):
    path = tmp_path / "views.yaml"
    path.write_text("view_order:\n  - id: _InitialView\n  - id: spelling_normalized\n    note: x\n  - id: vpe_resolved\n")
    views = annotators.read_views(spark, str(path))
    plan = {r["name"]: r["views"] for r in annotators.plan(annotators.annotators(spark), views).collect()}
    ids = ["_InitialView", "spelling_normalized", "vpe_resolved"]
    assert plan["spelling errors"] == ids[:2] and plan["passive"] == plan["sluicing"] == ids and len(plan) == 14
    lines = [r["command"] for r in annotators.commands(annotators.annotators(spark), views).orderBy("pos").collect()]
    assert lines[4] == 'python -m lingolake.run detect --phenomenon verbal_ellipsis --lang "$LANG_CODE" --view _InitialView spelling_normalized vpe_resolved -- "$INPUT"'
    assert lines[12] == 'python -m lingolake.run discourse-units --view _InitialView spelling_normalized vpe_resolved -- "$INPUT"'
    path.write_text("view_order: []\n")
    with pytest.raises(ValueError):
        annotators.read_views(spark, str(path))


def test_evaluation(spark):
    gold = [("1", "VPE_RESOLVABLE", True, "do, Will"), ("2", "VPE_RESOLVABLE", True, "has"), ("3", "NO_VPE", False, ""), ("4", "NO_VPE", False, None)]
    rows = evaluate.judged(spark.createDataFrame(gold, "id string, category string, is_vpe boolean, ellipsis_site string"), spark.createDataFrame([("1", " will "), ("3", "x")], "id string, form string"))
    r = evaluate.report(rows).first()
    assert (r["n"], r["tp"], r["fp"], r["fn"], r["tn"], r["precision"], r["recall"], r["f1"], r["accuracy"], r["site_recall"]) == (4, 1, 1, 1, 1, 0.5, 0.5, 0.5, 0.5, 0.5)
    assert {x["category"]: x["rate"] for x in evaluate.by_category(rows).collect()} == {"VPE_RESOLVABLE": 0.5, "NO_VPE": 0.5}
    assert evaluate.report(rows.limit(0)).first()["precision"] == 0.0


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_catalogue_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*cols).collect())
    expected = con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert got == sorted(map(repr, expected)) and got


def test_entry_point():
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(catalog.QUERIES) <= set(queries) and set(oracles) <= set(queries)
    assert not [n for n in queries if not re.fullmatch(r"\w+", n)]
