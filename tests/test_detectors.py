"""Detectors on small forests: hand-made sentences, and folds against plain Python versions over the synthetic forest."""

import re

import pytest

from lingolake.functions import lexicon as L
from lingolake.operators import annotate, detectors, layers
from lingolake.operators.trees import SENTENCES
from lingolake.sources.forest import forest


def sentence(i, lang, nodes, text=None, mwts=(), glue=()):
    """nodes: 'form lemma UPOS XPOS deprel head [feats]'; ``glue``: ords without a space before."""
    out, at, whole = [], 0, ""
    for o, line in enumerate(nodes, 1):
        form, lemma, upos, xpos, deprel, head, *feats = line.split(" ")
        if o > 1 and o not in glue:
            at, whole = at + 1, whole + " "
        out.append((o, form, lemma, upos, xpos, dict(f.split("=") for f in feats[0].split("|")) if feats else {}, int(head), deprel, at, at + len(form)))
        at, whole = at + len(form), whole + form
    return (i, "v", 0, lang, text or whole, out, list(mwts))


def found(spark, detect, *sentences):
    rows = detect(spark.createDataFrame(list(sentences), SENTENCES)).collect()
    return sorted((r["doc_id"], r["subtype"], r["begin"], r["end"], r["suggestion"], tuple((x["label"], x["begin"], x["end"], x["text"]) for x in r["roles"])) for r in rows)


def test_passive(spark):
    long = sentence(1, "en", ["The the DET DT det 2", "roof roof NOUN NN nsubj:pass 4", "was be AUX VBD aux:pass 4", "mended mend VERB VBN root 0", "by by ADP IN case 6", "Ann Ann PROPN NNP obl:agent 4"])
    short = sentence(2, "en", ["A a DET DT det 2", "song song NOUN NN root 0", "sung sing VERB VBN acl 2", "by by ADP IN case 5", "Bo Bo PROPN NNP obl 3"])
    unknown = sentence(3, None, [x for x in ["The the DET DT det 2", "roof roof NOUN NN nsubj:pass 4", "was be AUX VBD aux:pass 4", "mended mend VERB VBN root 0"]])
    active = sentence(4, "en", ["Ann Ann PROPN NNP nsubj 2", "sings sing VERB VBZ root 0"])
    assert found(spark, detectors.passive, long, short, unknown, active) == [
        (1, "canonical", 13, 19, None, (("Passive_verb", 13, 19, "mended"), ("Passive_aux", 9, 12, "was"), ("Passive_subject", 4, 8, "roof"), ("Passive_agent", 23, 26, "Ann"), ("Passive_agent_marker", 20, 22, "by"))),
        (2, "short", 7, 11, None, (("Passive_verb", 7, 11, "sung"), ("Passive_agent", 15, 17, "Bo"), ("Passive_agent_marker", 12, 14, "by"))),
        (3, "canonical", 13, 19, None, (("Passive_verb", 13, 19, "mended"), ("Passive_aux", 9, 12, "was"), ("Passive_subject", 4, 8, "roof"))),
    ]


def test_sluicing_and_ellipsis(spark):
    sluice = sentence(1, "en", ["I I PRON PRP nsubj 2", "know know VERB VBP root 0", "why why ADV WRB ccomp 2"])
    clause = sentence(2, "en", ["I I PRON PRP nsubj 2", "know know VERB VBP root 0", "why why ADV WRB advmod 5", "Bo Bo PROPN NNP nsubj 5", "left leave VERB VBD ccomp 2"])
    assert found(spark, detectors.sluicing, sluice, clause) == [(1, "", 7, 10, None, (("QEmbedder", 2, 6, "know"),))]
    bare = sentence(3, "de", ["Er er PRON PPER nsubj 2", "will wollen VERB VMFIN root 0", "nicht nicht PART PTKNEG advmod 2"])
    assert [x[0] for x in found(spark, detectors.verbal_ellipsis, bare, sluice)] == [3]
    ask = sentence(5, "de", ["Warum warum ADV PWAV root 0", "? ? PUNCT $. punct 1"])
    assert found(spark, detectors.bare_questions, ask, sluice) == [(5, "warum", 0, 5, None, ())]
    shared = sentence(6, "en", ["Ann Ann PROPN NNP nsubj 2", "sings sing VERB VBZ root 0", "and and CCONJ CC cc 4", "reads read VERB VBZ conj 2"])
    assert found(spark, detectors.subject_sharing, shared) == [(6, "", 14, 19, None, (("Shared_subject", 0, 3, "Ann"),))]


def test_contractions(spark):
    cant = sentence(1, "en", ["Ca can AUX MD aux 3", "n't not PART RB advmod 3", "swim swim VERB VB root 0"], glue=(2,))
    perfect = sentence(2, "en", ["He he PRON PRP nsubj 3", "'s be AUX VBZ aux 4", "not not PART RB advmod 4", "been be VERB VBN root 0"], glue=(2,))
    owner = sentence(3, "en", ["Ann Ann PROPN NNP nmod 3", "'s 's PART POS case 1", "hat hat NOUN NN root 0"], glue=(2,))
    aint = sentence(4, "en", ["They they PRON PRP nsubj 4", "ai be AUX VBP aux 4", "n't not PART RB advmod 4", "here here ADV RB root 0"], glue=(3,))
    assert [(x[0], x[4]) for x in found(spark, detectors.clitics, cant, perfect, owner, aint)] == [(1, "Cannot"), (2, "He has"), (4, "are not")]
    vom = sentence(5, "de", ["von von ADP APPR case 3", "dem der DET ART det 3", "Haus Haus NOUN NN root 0"], mwts=[("vom", 1, 2)])
    assert [(x[1], x[4]) for x in found(spark, detectors.prep_articles, vom)] == [("prep_article", "von dem")]
    nen = sentence(6, "de", ["Nen nen DET ART det 2", "Hund Hund NOUN NN root 0 Gender=Masc|Case=Acc", "ne ne PART X discourse 2", "? ? PUNCT $. punct 2"])
    n = sentence(7, "de", ["n n DET ART det 2", "Hund Hund NOUN NN root 0 Gender=Masc|Case=Acc"])
    assert [(x[0], x[4]) for x in found(spark, detectors.clipped_articles, nen, n)] == [(6, "Einen"), (7, "einen")]
    gonna = sentence(8, "en", ["I I PRON PRP nsubj 2", "gon go VERB VBG root 0", "na to PART TO mark 2", "keep keep VERB VB xcomp 2", "talkin' talk VERB VBG xcomp 4", "'em they PRON PRP obj 5"], glue=(3, 6))
    assert [(x[2], x[4]) for x in found(spark, detectors.clipped_forms, gonna)] == [(2, "going to"), (13, "talking"), (20, " them")]


def test_abbreviations(spark):
    plain = sentence(1, "de", ["Die der DET ART det 2", "KG KG NOUN NN nsubj 3", "zahlt zahlen VERB VVFIN root 0", "NICHT nicht PART PTKNEG advmod 3"])
    runs = sentence(2, "en", ["ADE ADE X FW root 0", "- - PUNCT : punct 1", "BEC BEC X FW dep 1", "- - PUNCT : punct 1", "CBA CBA X FW dep 1"])
    gloss = sentence(3, "en", ["Condition condition NOUN NN root 0", "( ( PUNCT ( punct 1", "CS CS NOUN NN appos 1", ") ) PUNCT ) punct 1"], glue=(3, 4))
    loud = sentence(4, "en", [f"{w} {w} X FW dep 1" for w in "WE SAW A BIG RED BUS AND THEN RAN HOME".split()])
    assert [(x[0], x[1], x[2]) for x in found(spark, detectors.abbreviation, plain, runs, gloss, loud)] == [(1, "abbreviation", 4), (3, "abbreviation_defined", 11)]


def test_suspension(spark):
    a = sentence(1, "de", ["Sonn- Sonn- NOUN TRUNC conj 3", "und und CCONJ KON cc 3", "Feiertage Feiertag NOUN NN root 0"])
    b = sentence(2, "de", ["Garten Garten NOUN NN root 0", "und und CCONJ KON cc 4", "- - PUNCT X punct 4", "krippe Krippe NOUN NN conj 1"], glue=(4,))
    c = sentence(3, "en", ["Sachsen-Anhalt S PROPN NNP root 0", "- - PUNCT : punct 1", "yes yes INTJ UH dep 1"])
    assert [(x[0], x[1], x[2], x[3]) for x in found(spark, detectors.suspended_composition, a, b, c)] == [(1, "shared_head", 0, 5), (2, "shared_modifier", 11, 18)]


def gapped(nodes):
    """Plain Python version of gapped coordination; nodes are dicts by ord."""
    kids = lambda o: [x for x in nodes if x["head"] == o]
    verbal = lambda x: x["upos"] in ("VERB", "AUX")
    by = {x["ord"]: x for x in nodes}

    def below(o):
        return [o, *(y for k in kids(o) for y in below(k["ord"]))]

    seen, out = set(), []
    for n in nodes:
        if n["deprel"] != "conj" or verbal(n) or not n["head"] or n["ord"] in seen:
            continue
        host = by[n["head"]]
        others = [c for c in kids(host["ord"]) if c["deprel"] == "conj" and not verbal(c)]
        gap = any(c["deprel"] in L.GAPPED_ARGUMENTS for c in kids(n["ord"]))
        signal = ("C" if gap else None) if verbal(host) else "A" if len(others) >= 2 else "B" if gap else None
        if not signal:
            continue
        cluster = [y for c in (others if signal == "A" else [n]) for y in below(c["ord"])]
        seen |= set(cluster)
        told = [by[o] for o in cluster if by[o]["upos"] != "PUNCT"]
        verbs, at = [], host
        while at:
            if verbal(at):
                verbs.append(at)
            else:
                verbs += [c for c in kids(at["ord"]) if c["deprel"] == "cop" and verbal(c)][:1]
            at = by.get(at["head"])
        if told and verbs:
            out.append((n["ord"], signal, min(x["t_start"] for x in told), max(x["t_end"] for x in told), verbs[-1]["ord"]))
    return out


def clipped(nodes):
    out, i = [], 0
    while i < len(nodes):
        for width in (2, 1):
            span = nodes[i : i + width]
            if len(span) < width or any(a["t_end"] != b["t_start"] for a, b in zip(span, span[1:])):
                continue
            s = "".join(x["form"] for x in span)
            full = L.CLIPPED_FORMS.get(s.lower())
            if full is None and (width == 1 or (span[1]["form"] == "'" and span[0]["upos"] in ("VERB", "AUX"))) and len(s) > 3 and s.lower().endswith("in'") and s[-4].isalpha():
                full = s[:-3] + ("ING" if s[-3:-1].isupper() else "ing")
            if full:
                first = next((c for c in s if c.isalpha()), "")
                full = full[:1].upper() + full[1:] if first.isupper() or i == 0 else full
                out.append((span[0]["ord"], (" " if i and nodes[i - 1]["t_end"] == span[0]["t_start"] else "") + full))
                i += width
                break
        else:
            i += 1
    return out


@pytest.fixture(scope="module")
def trees(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return forest(docs).cache()


def test_folds_against_plain_python(spark, trees):
    expected_gaps, expected_clips, expected_stubs = set(), set(), set()
    for r in trees.collect():
        nodes = [n.asDict() for n in r["nodes"]]
        expected_gaps |= {(r["doc_id"], r["sent_id"], *x[:4]) for x in gapped(nodes)}
        if r["lang"] == "en":
            expected_clips |= {(r["doc_id"], r["sent_id"], *x) for x in clipped(nodes)}
        if r["lang"] in ("de", "en"):
            spans, at = [], 0
            for n in nodes:
                k = r["text"].find(n["form"], at)
                if k >= 0:
                    at = k + len(n["form"])
                    spans.append((k, at, n["t_start"], n["t_end"]))
            for way, pattern in (("shared_head", L.STUB), ("shared_modifier", L.LEAD_STUB)):
                for m in re.finditer(pattern, r["text"]):
                    hit = [s for s in spans if s[0] < m.end() and s[1] > m.start()]
                    if hit:
                        expected_stubs.add((r["doc_id"], r["sent_id"], way, hit[0][2], hit[-1][3]))
    got = {(r["doc_id"], r["sent_id"], r["ord"], r["subtype"], r["begin"], r["end"]) for r in detectors.gapped_coordination(trees).collect()}
    assert got == expected_gaps and got
    assert {(r["doc_id"], r["sent_id"], r["ord"], r["suggestion"]) for r in detectors.clipped_forms(trees).collect()} == expected_clips and expected_clips
    assert {(r["doc_id"], r["sent_id"], r["subtype"], r["begin"], r["end"]) for r in detectors.suspended_composition(trees).collect()} == expected_stubs and expected_stubs


def test_abbreviations_against_plain_python(spark, trees):
    shape, expected = re.compile(r"\b[A-ZÄÖÜ]{2,6}\b"), set()
    for r in trees.collect():
        alpha = [n["form"] for n in r["nodes"] if n["form"].isalpha()]
        if len(alpha) >= 10 and sum(w.isupper() and len(w) > 1 for w in alpha) / len(alpha) > 0.3:
            continue
        every = list(shape.finditer(r["text"]))
        run, runs = [], set()
        for m in [*every, None]:
            if m and run and re.match(L.ENUM_SEPARATOR, r["text"][run[-1].end() : m.start()]):
                run.append(m)
                continue
            if len(run) >= 3:
                runs |= {x.start() for x in run}
            run = [m] if m else []
        glossed = {m.start(1) for m in re.finditer(L.GLOSS_CONTEXT, r["text"])}
        used = {}
        for n in r["nodes"]:
            f = n["form"]
            if not shape.fullmatch(f) or f.lower() in L.FUNCTION_WORDS.get(r["lang"], ()):
                continue
            i = used[f] = used.get(f, -1) + 1
            places = [m.start() for m in every if m.group() == f]
            at = places[i] if i < len(places) else None
            if at not in runs:
                expected.add((r["doc_id"], r["sent_id"], n["ord"], "abbreviation_defined" if at in glossed else "abbreviation"))
    assert {(r["doc_id"], r["sent_id"], r["ord"], r["subtype"]) for r in detectors.abbreviation(trees).collect()} == expected and expected


def test_registry(spark, trees):
    few = trees.filter("doc_id < 20")
    for name, spec in annotate.REGISTRY.items():
        told = annotate.detect(few, name)
        assert told.columns == annotate.ANNOTATION
        assert told.filter(~annotate.from_earlier_run(name)).count() == 0, name
    first = annotate.detect(few, "sluicing").unionByName(annotate.detect(few, "passive")).cache()
    n = first.count()
    assert annotate.run_again(first, few, "sluicing").count() >= n
    assert sorted(map(repr, annotate.run_again(first, few, "sluicing", replace=True).collect())) == sorted(map(repr, first.collect()))
    with pytest.raises(ValueError):
        annotate.detect(few, "nothing")


def test_conllu_files(spark, trees, tmp_path):
    few = trees.filter("doc_id < 5").coalesce(1)
    layers.to_conllu(few).select("block").coalesce(1).write.option("lineSep", "\n").text(str(tmp_path / "out"))
    back = layers.read_conllu(spark, str(tmp_path / "out"))
    key = lambda r: (r["text"], [(n["ord"], n["form"], n["head"], n["t_start"], n["t_end"]) for n in r["nodes"]], [tuple(m) for m in r["mwts"]])
    assert sorted(map(key, back.collect())) == sorted(map(key, few.collect()))


def test_command_line(spark, trees, tmp_path):
    from lingolake import run

    few = trees.filter("doc_id < 5").coalesce(1)
    layers.to_conllu(few).select("block").write.option("lineSep", "\n").text(str(tmp_path / "in"))
    run.main(["detect", "--phenomenon", "passive", "--mixed", "--view", "_InitialView", "--", str(tmp_path / "in"), str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == annotate.detect(few, "passive", mixed=True).count() > 0
    with pytest.raises(SystemExit):
        run.main(["parse", "--", "a", "b"])


def test_empty_and_null(spark):
    docs = spark.createDataFrame([(1, None, "en"), (None, "a b", "en"), (2, "", "de"), (3, "  ", None)], "doc_id long, text string, lang string")
    assert forest(docs).count() == 0
    hollow = spark.createDataFrame([(1, "v", 0, None, None, [], []), (2, "v", 0, "en", "x", [(1, "x", None, None, None, None, 0, None, 0, 1)], [])], SENTENCES)
    for name in annotate.REGISTRY:
        assert annotate.detect(hollow, name).count() == 0


def test_stream(spark, trees, tmp_path):
    from lingolake.streaming.detect import detect_stream

    few = trees.filter("doc_id < 10")
    few.write.parquet(str(tmp_path / "in"))
    query = detect_stream(spark.readStream.schema(few.schema).parquet(str(tmp_path / "in")), "passive").writeStream.format("memory").queryName("told").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("told").count() == annotate.detect(few, "passive").count() > 0
