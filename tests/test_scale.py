"""What queries may take on large tables: no stored forest, no needless shuffles, each input grown once."""

import random
import re
from pathlib import Path

from pyspark.sql import functions as F

from lingolake.operators import annotate, layers, models, trees
from lingolake.operators.trees import plain
from lingolake.plans import queries as catalog
from lingolake.sources.forest import forest

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_forest_is_not_stored_and_has_only_what_is_asked_for(spark):
    docs = spark.createDataFrame([(7, "en", "It was so. " * 20), (8, None, "x"), (9, "de", "")], "doc_id long, lang string, text string")
    whole, part = forest(docs), forest(docs, "head", "form", text=False, mwts=False)
    told = lambda rows: sorted(map(str, rows.select("doc_id", "sent_id", F.expr("transform(nodes, n -> struct(n.ord, n.form, n.head))").alias("n")).collect()))
    assert told(whole) == told(part) and part.schema["nodes"].dataType.elementType.fieldNames() == ["ord", "form", "head"]
    assert plain(whole) is whole
    before = set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).glob("forest-*"))
    assert catalog.QUERIES["det_passive"](spark, SF).count() > 0
    assert set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).glob("forest-*")) == before


def test_conllu_blocks_are_made_once_and_parsed_whole(spark):
    assert plan(catalog.QUERIES["conllu_round_trip"](spark, SF)).count("t_end=") <= 1
    block = "# sent_id = 4\n# text = a b\n# lang = en\n1-2\tab\t_\t_\t_\t_\t_\t_\t_\t_\n1\ta\t_\tX\t_\tB=1|A\t0\troot\t_\tt_start=0|t_end=99999999999\n1.1\te\t_\t_\t_\t_\t_\t_\t_\t_\n2\tb\tb\t_\tY\t_\t1\t_\t_\tx|t_start=0002\n"
    rows = layers.from_conllu(spark.createDataFrame([(1, "v", block, 5), (2, "v", None, 6), (3, "v", "", 7)], "doc_id long, view string, block string, kept int"), "kept").orderBy("doc_id").collect()
    first = rows[0]
    assert (first["sent_id"], first["lang"], first["text"], first["kept"], [tuple(m) for m in first["mwts"]]) == (4, "en", "a b", 5, [("ab", 1, 2)])
    assert [tuple(n) for n in first["nodes"]] == [(1, "a", "", "X", "", {"B": "1", "A": None}, 0, "root", 0, None), (2, "b", "b", "", "Y", {}, 1, "", 2, None)]
    assert rows[1]["nodes"] is None and rows[2]["nodes"] == []


def test_masked_words_shuffle_no_sentences(spark):
    told = plan(catalog.QUERIES["masked_words"](spark, SF))
    assert "BroadcastHashJoin" in told and "SortMergeJoin" not in told


def test_layers_are_shuffled_once(spark):
    assert plan(catalog.QUERIES["layer_assembly"](spark, SF)).count("hashpartitioning(doc_id") <= 7  # one of blocks; a table in one file is dealt out for each of the six layers
    t = "doc_id long, view string, begin int, end int, id long, "
    make = lambda columns, *rows: spark.createDataFrame(list(rows), columns)
    spans = make(t + "text string", (1, "v", 0, 9, 70, "a b c"), (1, "w", 0, 9, 70, "d"), (None, "v", 0, 9, 70, ""))
    tokens = make(t + "form string", (1, "v", 4, 5, 3, "b"), (1, "v", 0, 1, 2, "a"), (1, "v", 0, 1, 1, "A"), (1, "v", 8, 12, 4, "out"), (1, "v", 6, 7, 5, " "), (1, "w", 0, 1, 1, "d"), (None, "v", 0, 1, 1, "x"))
    pos = make(t + "upos string, xpos string", (1, "v", 0, 1, 9, "Y", "y"), (1, "v", 0, 1, 8, "X", None))
    lemmas = make(t + "lemma string", (1, "v", 0, 1, 1, "l"), (1, "w", 0, 2, 1, "no"))
    links = make("doc_id long, view string, dependent long, governor long, id long, deprel string", (1, "v", 1, 3, 1, "old"), (1, "v", 1, 1, 2, "x"), (1, "v", 2, 1, 1, ""), (1, "v", 3, 99, 1, "far"), (1, "w", 1, 1, 1, "x"))
    got = layers.assembled(spans, tokens, pos, lemmas, make(t + "feats string"), links)
    assert sorted(tuple(r)[1:11] for r in got.collect()) == [
        ("v", 70, 1, "A", "l", "X", "_", "_", 0, "root"), ("v", 70, 2, "a", "l", "Y", "y", "_", 1, "dep"), ("v", 70, 3, "b", "_", "FM", "_", "_", 0, "far"), ("w", 70, 1, "d", "_", "FM", "_", "_", 0, "root"),
    ]


def test_annotations_work_findings_out_once(spark):
    docs = spark.createDataFrame([(7, "en", "It was so. " * 20)], "doc_id long, lang string, text string")
    for phenomenon in ("subject_sharing", "verbal_ellipsis", "passive", "contraction"):
        made = annotate.detect(forest(docs), phenomenon)
        assert made.columns == annotate.ANNOTATION
        assert plan(made).count("MapInArrow") == (4 if phenomenon == "contraction" else 1)
    again = annotate.run_again(spark.createDataFrame([], made.schema), forest(docs), "subject_sharing")
    assert "nodes" not in "".join(re.findall(r"Exchange hashpartitioning.*|SortMergeJoin.*", plan(again)))


def test_discourse_units_cut_a_sentence_twice_only(spark):
    assert models.discourse_units().count("regexp_extract_all") == 2
    rows = spark.createDataFrame([(" a  b c d ", [0, 0, 1, None]), ("x", None), (None, [1])], "sentence string, labels array<int>")
    assert [r[0] and [tuple(u) for u in r[0]] for r in rows.select(F.expr(models.discourse_units())).collect()] == [[(1, 5), (6, 9)], [(0, 1)], None]


def test_next_words_is_compiled(spark):
    assert "lambda" not in plan(catalog.QUERIES["next_words"](spark, SF))


def test_subtree_spans_of_any_heads(spark):
    """Against the expressions of ``trees``: random heads, with circles and heads out of range, nulls among places."""
    rng = random.Random(5)
    rows = [(i, "v", 0, "en", "", [(o, "f", "", "", "", {}, rng.choice([None, -1, *range(n + 2)]), "", rng.choice([None, rng.randrange(99)]), rng.randrange(99)) for o in range(1, n + 1)], []) for i, n in enumerate(rng.choice([0, 1, 2, 5, 9, 17]) for _ in range(120))]
    sentences = spark.createDataFrame([*rows, (999, "v", 0, "en", "", None, [])], trees.SENTENCES)
    spans = f"transform(nodes, n -> named_struct('ord', n.ord, 'begin', {trees.begin(trees.subtree('n'))}, 'end', {trees.end(trees.subtree('n'))}, 'size', size({trees.subtree('n')}), 'depth', size(filter(n.anc, a -> a > 0))))"
    expected = trees.with_ancestors(plain(sentences)).select("doc_id", F.explode(F.expr(spans)).alias("x")).select("doc_id", "x.*")
    got = trees.subtree_spans(sentences).select(*expected.columns)
    assert "lambda" not in plan(got) and sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_coreference_tokens_shuffle_numbers_only(spark):
    told = plan(catalog.QUERIES["coreference_tokens"](spark, SF))
    assert "form" not in told.replace("transform", "") and "struct<begin" not in told
    docs = spark.createDataFrame([(7, "en", "It was so. " * 20)], "doc_id long, lang string, text string")
    rows = models.coreference_tokens(forest(docs)).first()
    assert [tuple(t) for t in rows["tokens"]] == [tuple(t) for t in models.coreference_tokens(forest(docs), payload=False).first()["tokens"]] and rows["payload"].count(",") == 79


def test_words_of_multiword_tokens_are_packed(spark):
    told = plan(catalog.QUERIES["multiword_forms"](spark, SF))
    assert "collect_list" not in told and "block" in told
    rows = [(1, "v", 0, 1, 1, "b"), (1, "v", 0, 1, 0, "a"), (1, "v", 5, 6, 0, "c"), (2, None, 0, 1, 0, None), (None, "v", 0, 1, 1, "y"), (None, "v", 0, 1, None, "x")]
    got = layers.mwt_forms(spark.createDataFrame(rows, "doc_id long, view string, begin int, end int, idx int, form string").repartition(3))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [(1, "v", 0, 1, ["a", "b"]), (1, "v", 5, 6, ["c"]), (2, None, 0, 1, [None]), (None, "v", 0, 1, ["x", "y"])]))


def test_conllu_lines_of_odd_sentences(spark):
    node = lambda o, form, a, b, feats={}, head=0: (o, form, None, "X", "", feats, head, "dep", a, b)
    rows = [
        (1, "v", 3, "de", "a\u00e4\U0001f600 b\nc", [node(1, "a\u00e4", 10, 12, {"b": "1", "A": "2", "c": None}), node(2, "\U0001f600", 12, 13), node(3, "b", 14, 15), node(4, "x", 15, 15, {"Z": "1"}), node(5, "c", 16, 17)], [("B", 2, 3), ("A", 1, 2), ("C", 2, 4), (None, 3, 4), ("D", 9, 10)]),
        (2, "v", 0, None, "", [], []),
        (3, "v", 1, "en", "zz", [node(1, "q", 5, 6), node(2, "r", 6, 7), node(3, "s", None, 9, None, None)], []),
        (4, "v", 1, "en", None, [node(1, "q", 0, 1)], []),
        (5, "v", 1, "en", "q", None, []),
        (6, "v", 1, "en", "q", [node(1, "q", 0, 1)], None),
    ]
    got = [r["block"] for r in layers.to_conllu(spark.createDataFrame(rows, trees.SENTENCES).coalesce(1)).orderBy("doc_id").collect()]
    line = lambda o, form, feats, misc, head="0": "\t".join([str(o), form, "_", "X", "_", feats, head, "dep", "_", misc])
    word = lambda span, form: "\t".join([span, form, *["_"] * 8])
    assert got[0].split("\n") == [
        "# sent_id = 3", "# text = a\u00e4\U0001f600 b c", "# lang = de", word("1-2", "A"), line(1, "a\u00e4", "A=2|b=1", "SpaceAfter=No|t_start=10|t_end=12"), word("2-3", "B"), word("2-4", "C"), line(2, "\U0001f600", "_", "t_start=12|t_end=13"),
        line(3, "b", "_", "t_start=14|t_end=15"), line(4, "x", "Z=1", "t_start=15|t_end=15"), line(5, "c", "_", "t_start=16|t_end=17"), "",
    ]
    assert got[1] == "# sent_id = 0\n# text = \n\n"
    assert got[2].split("\n")[3:] == [line(1, "q", "_", "SpaceAfter=No|t_start=5|t_end=6"), line(2, "r", "_", "t_start=6|t_end=7"), line(3, "s", "_", "_", "_"), ""]
    assert got[3:] == [None, None, None] and "lambda" not in plan(layers.to_conllu(spark.createDataFrame(rows, trees.SENTENCES)))
