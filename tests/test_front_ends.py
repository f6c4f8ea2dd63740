"""Parser adapters over fakes, readers and writers, checks and policies, and what detectors tell beside their findings."""

from types import SimpleNamespace as N

import pytest
from pyspark.sql import functions as F

from lingolake.functions import lexicon as L
from lingolake.operators import annotate, detectors, front_ends, layers, models, text as T
from lingolake.operators.trees import SENTENCES
from lingolake.sources import files
from tests.test_detectors import found, sentence

DOCS = "doc_id long, view string, lang string, text string"


def spans(text):
    at, out = 0, []
    for w in text.split():
        at = text.index(w, at)
        out.append((w, at, at + len(w)))
        at += len(w)
    return out


def fake_tagged(lang):
    """A pipeline with one sentence a text, all tokens hanging on the first."""

    def run(text):
        tokens = [N(text=w, lemma_=w.lower(), tag_="X" + (lang or "?"), dep_="dep", idx=b, i=i) for i, (w, b, _) in enumerate(spans(text))]
        for t in tokens:
            t.head = tokens[0]
        return N(sents=[tokens])

    return run


def fake_universal(lang):
    def run(text):
        words = spans(text)
        tokens = [N(text=w, start_char=b, end_char=e, words=[N(text=x, lemma=x, upos="NOUN", xpos="NN", feats="Case=Nom|Number=Sing", head=0 if i == 0 and k == 0 else 1, deprel="dep") for k, x in enumerate(["von", "dem"] if w == "vom" else [w])]) for i, (w, b, e) in enumerate(words)]
        return N(sentences=[N(tokens=tokens)], ents=[N(start_char=b, end_char=e, type="PER") for w, b, e in words if w == "Ann"])

    return run


def fake_english(lang):
    return front_ends.starred(lambda t: [[(b, e) for _, b, e in spans(t)]], lambda words: ["VBD" if w.endswith("ed") else "NN" for w in words], lambda w, kind: w.removesuffix("ed") if kind == "v" else w)


def test_front_ends(spark):
    docs = spark.createDataFrame([(1, "v", "en", "Ann  sang vom"), (2, "w", "de", " "), (3, "v", None, None)], DOCS)
    (r,) = front_ends.parsed(docs, fake_tagged, front_ends.tagged).collect()
    assert [(n["form"], n["upos"], n["xpos"], n["head"], n["deprel"], n["t_start"], n["t_end"]) for n in r["nodes"]] == [("Ann", "", "Xen", 0, "root", 0, 3), ("sang", "", "Xen", 1, "dep", 5, 9), ("vom", "", "Xen", 1, "dep", 10, 13)]
    assert (r["doc_id"], r["view"], r["sent_id"], r["lang"], r["text"]) == (1, "v", 0, "en", "Ann  sang vom")
    (r,) = front_ends.parsed(docs, fake_universal, front_ends.universal).collect()
    assert [(n["form"], n["t_start"], n["t_end"]) for n in r["nodes"]][2:] == [("von", 10, 13), ("dem", 10, 13)] and [tuple(m) for m in r["mwts"]] == [("vom", 3, 4)]
    assert r["nodes"][0]["feats"] == {"Case": "Nom", "Number": "Sing"}
    assert [tuple(e) for e in front_ends.entities(docs, fake_universal, front_ends.universal_entities).collect()] == [(1, "v", 0, 3, "PER")]
    (r,) = front_ends.parsed(docs.withColumn("text", F.lit("Bo walked Home")), fake_english, lambda x: x).filter("doc_id = 1").collect()
    assert [(n["lemma"], n["xpos"], n["head"], n["deprel"]) for n in r["nodes"]] == [("bo", "NOUN", 0, "ROOT"), ("walk", "VERB", 1, "dep"), ("home", "NOUN", 1, "dep")]
    parse, look = front_ends.missing(docs, docs.filter("doc_id = 1"), None)
    assert sorted(x["doc_id"] for x in parse.collect()) == [2, 3] and look.count() == 3
    assert front_ends.parsed(docs.limit(0), fake_tagged, front_ends.tagged).count() == 0


def test_loaded_once():
    calls = []

    def loader(lang):
        calls.append(lang)
        return lambda text: text

    assert front_ends.loaded(loader, "en") is front_ends.loaded(loader, "en") and front_ends.loaded(loader, "de")("x") == "x" and calls == ["en", "de"]


def test_passive_phrases(spark):
    s = sentence(1, "en", ["The the DET DT det 2", "roof roof NOUN NN nsubj:pass 4", "was be AUX VBD aux:pass 4", "mended mend VERB VBN root 0", "by by ADP IN case 7", "old old ADJ JJ amod 7", "Ann Ann PROPN NNP obl:agent 4"])
    ((*_, roles),) = found(spark, lambda x: detectors.passive(x, phrases=True), s)
    assert roles[-2:] == (("Passive_subject_phrase", 0, 8, "The roof"), ("Passive_agent_phrase", 20, 30, "by old Ann"))


def test_suggestions(spark):
    vom = sentence(5, "de", ["von von ADP APPR case 3", "dem der DET ART det 3", "Haus Haus NOUN NN root 0"], mwts=[("vom", 1, 2)])
    frame = spark.createDataFrame([vom], SENTENCES)
    assert detectors.prep_articles(frame).first()["more"] == {"following": "Haus"}
    kg = spark.createDataFrame([sentence(1, "de", ["Die der DET ART det 2", "KG KG NOUN NN nsubj 3", "zahlt zahlen VERB VVFIN root 0"]), sentence(2, "en", ["KG KG NOUN NN root 0"])], SENTENCES)
    long = spark.createDataFrame([("de", "KG", "Kommanditgesellschaft"), ("de", "KG", "Kammergericht"), ("de", "KG", None)], "lang string, form string, expansion string")
    assert {r["doc_id"]: r["suggestion"] for r in detectors.abbreviation(kg, expansions=long).collect()} == {1: "Kammergericht|Kommanditgesellschaft", 2: None}


def test_completed_stubs(spark):
    a = sentence(1, "de", ["Sonn- Sonn- NOUN TRUNC conj 3", "und und CCONJ KON cc 3", "Feiertage Feiertag NOUN NN root 0"])
    b = sentence(2, "de", ["Energieerzeugung E NOUN NN root 0", "und und CCONJ KON cc 3", "-verteilung v NOUN NN conj 1"])
    c = sentence(3, "de", ["Xyz- X NOUN TRUNC conj 3", "und und CCONJ KON cc 3", "Häuser Haus NOUN NN root 0"])
    frame = spark.createDataFrame([a, b, c], SENTENCES)
    words = spark.createDataFrame([("Sonntage",), ("Energieverteilung",), ("Energverteilung",)], "word string")
    resolved = detectors.completed_stubs(detectors.suspended_composition(frame), words)
    rows = {r["doc_id"]: r for r in annotate.detect(frame, "suspended_composition", resolved=resolved).filter("kind = 'GrammarAnomaly'").collect()}
    assert (rows[1]["category"], rows[1]["suggestion"], rows[1]["certainty"]) == ("suspended_composition", "Sonntage", 1.0)
    assert (rows[2]["suggestion"], rows[2]["certainty"]) == ("Energieverteilung", 0.7)
    assert (rows[3]["category"], rows[3]["suggestion"], rows[3]["certainty"]) == ("suspended_composition_unresolved", None, None)
    donors = annotate.detect(frame, "suspended_composition", resolved=resolved).filter("label = 'Suspension_donor'").collect()
    assert sorted((r["doc_id"], r["begin"], r["end"]) for r in donors) == [(1, 10, 19), (2, 0, 16)]


def test_long_sentences(spark):
    """A chain of 200 nodes, each hanging on the one before, and a circle, which is no error."""
    chain = sentence(1, "en", [f"w{i} w{i} NOUN NN {'root' if i == 0 else 'conj'} {i}" for i in range(200)])
    star = sentence(2, "en", [f"w{i} w{i} NOUN NN {'root' if i == 0 else 'conj'} {min(i, 1)}" for i in range(200)])
    circle = sentence(3, "en", ["a a NOUN NN conj 2", "b b NOUN NN conj 1", "c c VERB VB conj 1"])
    frame = spark.createDataFrame([chain, star, circle], SENTENCES)
    from lingolake.operators.trees import plain, with_ancestors

    rows = {r["doc_id"]: r["nodes"] for r in with_ancestors(plain(frame)).collect()}
    assert [n["anc"] for n in rows[1]] == [list(range(i, -1, -1)) for i in range(1, 201)]
    assert all(n["anc"] == ([1, 0] if n["ord"] == 1 else [n["ord"], 1, 0]) for n in rows[2])
    assert set(rows[3][2]["anc"]) == {1, 2, 3}
    for name in annotate.REGISTRY:
        annotate.detect(frame, name).collect()


def test_checked(spark):
    frame = spark.createDataFrame([sentence(1, "en", ["I I PRON PRP nsubj 2", "know know VERB VBP root 0", "why why ADV WRB ccomp 2"])], SENTENCES)
    assert annotate.checked(frame, "sluicing", "en").count() == 2
    for phenomenon, lang, rows in (("sluicing", "fr", frame), ("clefts", "de", frame), ("contraction", "en", frame), ("nothing", "en", frame), ("sluicing", "en", frame.drop("mwts")), ("sluicing", "en", frame.withColumn("sent_id", F.lit("x")))):
        with pytest.raises(annotate.Unsupported):
            annotate.checked(rows, phenomenon, lang)
    assert L.words_for(L.WH_WORDS, "en")[0] == "who"
    with pytest.raises(L.UnsupportedLanguage):
        L.words_for(L.WH_WORDS, "xx")


def test_save(spark, tmp_path):
    one, two = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(1,), (2,)], "x int")
    path = iter(str(tmp_path / f"{i}") for i in range(9))
    assert annotate.save(one, one, next(path)) and annotate.save(one, two, next(path), policy=annotate.IF_CHANGED)
    assert not annotate.save(one, one, next(path), policy=annotate.IF_CHANGED) and annotate.save(one, one, next(path), policy=annotate.IF_CHANGED, elsewhere=True)
    assert not annotate.save(one, two, next(path), policy=annotate.IF_VIEWS, views=one.limit(0)) and annotate.save(one, two, next(path), policy=annotate.IF_VIEWS, views=one)
    with pytest.raises(ValueError):
        annotate.save(one, two, next(path), policy="never")


def test_conllu_identity(spark, tmp_path):
    node = "1\tA\ta\tX\t_\t_\t0\troot\t_\t_"
    (tmp_path / "a.conllu").write_text(f"# sent_id = s1\n{node}\n\n# sent_id = s2\n{node}\n \n# view = other\n# sent_id = s1\r\n{node}\n")
    (tmp_path / "b.conllu").write_text(f"# sent_id = 7\n{node}\n\n# sent_id = 9\n{node}\n\n")
    (tmp_path / "c.conllu").write_text("\n\n")
    rows = layers.read_conllu(spark, str(tmp_path)).collect()
    assert len({r["doc_id"] for r in rows}) == 2 and len({(r["doc_id"], r["view"], r["sent_id"]) for r in rows}) == 5
    assert sorted((r["sent_name"], r["sent_id"], r["view"]) for r in rows) == [("7", 7, "_InitialView"), ("9", 9, "_InitialView"), ("s1", 0, "_InitialView"), ("s1", 2, "other"), ("s2", 1, "_InitialView")]


def test_space_after(spark):
    s = (1, "v", 0, "en", "Well,I (know)", [(1, "Well", "", "", "", {}, 0, "root", 20, 24), (2, ",", "", "", "", {}, 1, "x", 24, 25), (3, "I", "", "", "", {}, 1, "x", 25, 26), (4, "know", "", "", "", {}, 1, "x", 28, 32)], [])
    block = layers.to_conllu(spark.createDataFrame([s], SENTENCES)).first()["block"]
    assert [("SpaceAfter=No" in line) for line in block.split("\n") if line[:1].isdigit()] == [True, True, False, True]


def test_mwt_forms(spark):
    parts = spark.createDataFrame([(1, "v", 0, 3, 1, "dem"), (1, "v", 0, 3, 0, "von"), (1, "v", 5, 7, 0, "x")], "doc_id long, view string, begin int, end int, idx int, form string")
    assert sorted((r["begin"], r["forms"]) for r in layers.mwt_forms(parts).collect()) == [(0, ["von", "dem"]), (5, ["x"])]


def test_text_functions(spark):
    row = lambda schema, values, *columns: tuple(spark.createDataFrame([values], schema).select(*columns).first())
    (got,) = row("s array<string>, t string", (["One.", "gone", "", "Two."], "One. x Two."), T.sentence_offsets("s", "t"))
    assert [tuple(x) for x in got] == [(0, 4), (7, 11)]
    cut = lambda t, lang: row("t string, l string", (t, lang), T.split_sentences(F.col("t"), F.col("l")))[0].split("\n")
    assert cut("Dr. Who left. He ran, e.g. home.", "en") == ["Dr. Who left.", "He ran, e.g. home."]
    assert cut("Er kam z.B. heute. Nr. 5 ging.", "de") == ["Er kam z.B. heute.", "Nr. 5 ging."] and cut("A. B.", None) == ["A.", "B."]
    texts = ["The cat and the dog of this house", "Der Hund und das Haus sind nicht auf dem Berg", "le chat et les chiens dans une maison", "los perros y las casas del pueblo", "the der", "", None, "12 ?"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(T.detect_language(F.col("t"))).collect()]
    assert got == ["en", "de", "fr", "es", None, None, None, None]
    words = spark.createDataFrame([("re-useable",), ("use-xyzzy",), ("Use",), ("reuse-friendly",)], "word string")
    known = spark.createDataFrame([("use",), ("friend",)], "word string")
    assert sorted(r[0] for r in T.derivable(words, known).collect()) == ["Use", "re-useable", "reuse-friendly"]
    assert [r[0] for r in T.knows(words, known).collect()] == ["Use"]


def test_models(spark):
    sentences = spark.createDataFrame([sentence(1, "en", ["Their their PRON X x 0", "to to PART X x 1"]), (1, "v", 1, "en", "to", [(1, "to", "", "", "", {}, 0, "root", 9, 11)], [])], SENTENCES)
    r = models.coreference_tokens(sentences).first()
    assert r["payload"] == '{"tokens":[["Their","to"],["to"]]}' and [tuple(x) for x in r["tokens"]] == [(0, 5), (6, 8), (9, 11)]
    assert models.coreference_text(spark.createDataFrame([(1, "v", 'a "b"'), (2, "v", None)], "doc_id long, view string, text string")).orderBy("doc_id").first()["payload"] == '{"tokens":"a \\"b\\""}'
    got = spark.createDataFrame([(["ab", "zz", "b"], "ab  b zz")], "t array<string>, s string").select(F.expr(models.found_tokens("t", "s"))).first()[0]
    assert [tuple(x) for x in got] == [(0, 2), (6, 8), (8, 9)]
    confusion = spark.createDataFrame([("to", ["to", "too"]), ("their", ["there", "their"])], "word string, candidates array<string>")
    got = models.masked(sentences, confusion).collect()
    assert sorted((r["sent_id"], r["ord"], r["surface"], r["masked"], r["candidates"][0]) for r in got) == [(0, 1, "Their", "[MASK] to", "there"), (0, 2, "to", "Their [MASK]", "to"), (1, 1, "to", "[MASK]", "to")]
    fits = spark.createDataFrame([([1, 0, 1, 0], [3, 4, 2, 1])], "l array<int>, k array<int>").select(F.expr(models.truncated("l", "k", 9)), F.expr(models.truncated("l", "k", 12)), F.expr(models.truncated("l", "k"))).first()
    assert tuple(fits) == ([1, 0], [1, 0, 1, 0], [1, 0, 1, 0])
    views = spark.createDataFrame([(1, "v"), (2, "v")], "doc_id long, view string")
    units = spark.createDataFrame([(1, "v", 10, "We left because", [0, 0, 1]), (1, "v", 30, "  ", None)], "doc_id long, view string, begin int, sentence string, labels array<int>")
    assert [tuple(r) for r in models.discourse_layer(views.filter("doc_id = 1"), units).collect()] == [(1, "v", 10, 17), (1, "v", 18, 25)]
    with pytest.raises(Exception, match="no sentences"):
        models.discourse_layer(views, units).collect()


def test_xmi_suggestions(spark, tmp_path):
    sofas = spark.createDataFrame([(1, "v", "x")], "doc_id long, view string, text string")
    note = (1, "v", "GrammarAnomaly", 0, 1, "Contraction", "contraction", None, "do \"not\"", 0.7)
    notes = spark.createDataFrame([note, note], "doc_id long, view string, kind string, begin int, end int, description string, category string, label string, suggestion string, certainty double")
    assert files.write_xmi(sofas, notes, str(tmp_path / "out")).count() == 1
    back = files.read_xmi(spark, str(tmp_path / "out")).filter("prefix = 'custom'").collect()
    assert len({r["id"] for r in back}) == 4  # equal annotations stay apart
    actions = {r["id"]: r["features"] for r in back if r["type"] == "SuggestedAction"}
    assert all(actions[int(r["features"]["suggestions"])]["replacement"] == 'do "not"' for r in back if r["type"] == "GrammarAnomaly")
    with pytest.raises(FileNotFoundError):
        files.read_xmi(spark, str(tmp_path))
