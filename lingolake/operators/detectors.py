"""The structural detectors: each takes sentences (see ``trees``) and returns a row per finding.

    doc_id, view, sent_id, lang, ord (the node it hangs on), subtype, begin, end, text, suggestion,
    roles array<struct<label, begin, end, text>>, more map<string, string> (what only some detectors tell)

Detection is a filter over a sentence's nodes first, cheap conditions before others; sentences without a hit go, ancestors are
worked out for the rest only, and what a finding says for the hits.  Detectors don't shuffle and keep no state, so they run
on a stream as they do on a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import lexicon as L
from .trees import begin, children, end, feat, first_child, fixed, has_child, last_child, one_of, parent, plain, role, role_of, subtree, universal, with_ancestors, words

KEYS = ["doc_id", "view", "sent_id", "lang"]
ROLES = "array<struct<label:string,begin:int,end:int,text:string>>"


def _hits(sentences: DataFrame, where: str, *, ancestors: bool = False) -> DataFrame:
    """A row (keys, nodes, n) for each node n that the condition holds for; with ``ancestors``, those of nodes are there too."""
    rows, at = plain(sentences), F.expr(f"transform(filter(nodes, n -> coalesce({where}, false)), n -> n.ord)")
    if ancestors:
        rows, at = with_ancestors(fixed(rows.select(*KEYS, "nodes", at.alias("hits"))).filter("size(hits) > 0")), F.col("hits")
    return rows.select(*KEYS, "nodes", F.explode(at).alias("at")).select(*KEYS, "nodes", F.expr("nodes[at - 1]").alias("n"))


def _kinds(sentences: DataFrame, wheres: dict[str, str], *, ancestors: bool = False) -> DataFrame:
    """A row (keys, nodes, n, kind) for each kind's condition that a node meets, in one pass."""
    each = ", ".join(f"transform(filter(nodes, n -> coalesce({where}, false)), n -> named_struct('at', n.ord, 'kind', '{kind}'))" for kind, where in wheres.items())
    hits = fixed(plain(sentences).select(*KEYS, "nodes", F.expr(f"concat({each})").alias("hits"))).filter("size(hits) > 0")
    hits = (with_ancestors(hits) if ancestors else hits).select(*KEYS, "nodes", F.explode("hits").alias("x"))
    return fixed(hits.select(*KEYS, "nodes", F.expr("nodes[x.at - 1]").alias("n"), F.expr("x.kind").alias("kind")))


def _findings(hits: DataFrame, *, subtype: str = "''", first: str = "n.t_start", last: str = "n.t_end", text: str = "n.form", suggestion: str = "cast(null AS string)", roles: list[str] = (), whole_roles: str | None = None, more: dict[str, str] | None = None) -> DataFrame:
    listed = whole_roles or f"filter(array({', '.join(roles)}), r -> r IS NOT NULL)" if roles or whole_roles else "array()"
    told = "cast(map() AS map<string,string>)"
    if more:
        told = f"map_filter(map({', '.join(f'{k!r}, cast({v} AS string)' for k, v in more.items())}), (k, v) -> v IS NOT NULL)"
    return hits.select(*KEYS, F.expr("n.ord").alias("ord"), F.expr(subtype).alias("subtype"), F.expr(first).alias("begin"), F.expr(last).alias("end"), F.expr(text).alias("text"), F.expr(suggestion).alias("suggestion"), F.expr(listed).cast(ROLES).alias("roles"), F.expr(told).alias("more"))


def sluicing(sentences: DataFrame) -> DataFrame:
    wh, known = L.by_language(L.WH_WORDS), L.by_language({k: v + L.EMBEDDING_NOUNS[k] for k, v in L.EMBEDDING_PREDICATES.items()})
    nouns = L.by_language(L.EMBEDDING_NOUNS)

    def embedding(g: str, of: str) -> str:
        return f"(array_contains({of}, lower({g}.lemma)) OR array_contains({of}, lower({g}.form))) AND NOT {one_of(f'{g}.deprel', L.EMBEDDED_VERBS)}"

    up = f"if(n.deprel = 'conj', {parent(parent('n'))}, {parent('n')})"
    direct = "(n.deprel = 'ccomp' OR (n.deprel = 'advmod' AND n.ord > n.head))"
    broad = one_of("n.deprel", L.SLUICE_RELATIONS)
    governor = f"CASE WHEN {direct} THEN {parent('n')} WHEN {broad} THEN {up} ELSE {parent('n')} END"
    remnant = f"(array_contains({wh}, lower(n.form)) OR {has_child('n', f'array_contains({wh}, lower(c.form))')})"
    bare = f"NOT {has_child('n', one_of('c.deprel', L.SUBJECTS) + ' OR c.upos = ' + repr('VERB'))}"
    noun = f"(array_contains({nouns}, lower({parent('n')}.lemma)) OR array_contains({nouns}, lower({parent('n')}.form)))"
    licensed = f"CASE WHEN {direct} THEN true WHEN {broad} THEN {embedding(up, known)} WHEN {one_of('n.deprel', ['acl', 'nmod'])} THEN {noun} ELSE false END"
    hits = _hits(sentences.filter(one_of("lang", list(L.WH_WORDS))), f"n.head > 0 AND {remnant} AND {bare} AND {licensed}")
    span = "filter(nodes, s -> s.ord = n.ord OR (s.head = n.ord AND s.upos <> 'PUNCT'))"
    return _findings(fixed(hits.withColumn("g", F.expr(governor))), first=begin(span), last=end(span), text=words(span), roles=[role_of("QEmbedder", "g")])


def subject_sharing(sentences: DataFrame) -> DataFrame:
    subject = one_of("c.deprel", L.SUBJECTS)
    hits = _hits(sentences, f"n.deprel = 'conj' AND n.head > 0 AND NOT {has_child('n', subject)} AND {has_child(parent('n'), subject)}", ancestors=True)
    shared = f"transform({children(parent('n'), subject)}, x -> {role('Shared_subject', subtree('x'))})"
    return _findings(hits, whole_roles=shared)


def verbal_ellipsis(sentences: DataFrame) -> DataFrame:
    free = f"NOT {one_of('n.deprel', L.AUXILIARY_RELATIONS)}"
    verbs, objects = one_of("c.upos", ["VERB", "AUX"]), one_of("c.deprel", ["obj", "obja"])
    stranded = f"{one_of('lower(n.lemma)', L.STRANDED_LEMMAS)} AND {one_of('n.upos', ['VERB', 'AUX'])} AND NOT {has_child('n', f'{verbs} OR {objects}')}"
    return _findings(_hits(sentences, f"{free} AND (n.upos = 'AUX' OR n.xpos = 'AUX' OR ({stranded}))"), subtype="n.deprel")


def passive(sentences: DataFrame, *, phrases: bool = False) -> DataFrame:
    """Subtypes canonical (hangs on the auxiliary) and short (on the participle).

    With ``phrases``, the whole phrases of subject and agent are roles too (Passive_subject_phrase, Passive_agent_phrase).
    """
    preps, tags = L.by_language(L.AGENT_PREPOSITIONS), L.by_language(L.PARTICIPLE_XPOS)
    marks = f"k.deprel = 'case' AND (array_contains({preps}, lower(k.lemma)) OR array_contains({preps}, lower(k.form)))"
    agent = one_of("c.deprel", ["obl", "obl:agent"]) + f" AND {has_child('c', marks, 'k')}"
    participle = f"(array_contains({tags}, n.xpos) OR {feat('n', 'VerbForm')} = 'Part')"
    bare = "NOT " + has_child("n", universal("c") + " = 'aux'")
    known = one_of("lang", list(L.AGENT_PREPOSITIONS))
    hits = _kinds(sentences, {"canonical": "n.deprel = 'aux:pass' AND n.head > 0", "short": f"{known} AND {participle} AND {bare} AND {has_child('n', agent)}"}, ancestors=phrases)
    hits = fixed(hits.withColumn("v", F.expr(f"if(kind = 'canonical', {parent('n')}, n)")))
    hits = fixed(hits.withColumn("g", F.expr(first_child("v", agent))))
    hits = hits.withColumn("m", F.expr(first_child("g", marks, "k"))).withColumn("u", F.expr(f"if(kind = 'canonical', {first_child('v', one_of('c.deprel', ['nsubj:pass', 'csubj:pass']))}, null)"))
    hits = fixed(hits.withColumn("aux", F.expr("if(kind = 'canonical', n, null)")))
    roles = [role_of("Passive_verb", "v"), role_of("Passive_aux", "aux"), role_of("Passive_subject", "u"), role_of("Passive_agent", "g"), role_of("Passive_agent_marker", "m")]
    if phrases:
        hits = fixed(hits)
        roles += [f"if({x} IS NULL, null, {role(label, subtree(x))})" for label, x in (("Passive_subject_phrase", "u"), ("Passive_agent_phrase", "g"))]
    return _findings(hits, subtype="kind", first="v.t_start", last="v.t_end", text="v.form", roles=roles)


def nominal_ellipsis_en(sentences: DataFrame) -> DataFrame:
    core, form = one_of("n.deprel", L.NOMINAL_RELATIONS), "lower(n.form)"
    only = lambda *r: "NOT " + has_child("n", f"NOT {one_of('c.deprel', list(r))}")
    det = lambda w: has_child("n", f"c.deprel = 'det' AND lower(c.form) = '{w}'")
    kind = f"""CASE WHEN {form} = 'none' AND NOT {has_child('n', 'true')} THEN 'none'
        WHEN {form} = 'one' AND {det('every')} THEN 'every_one'
        WHEN {form} = 'elder' AND {det('the')} THEN 'elder'
        WHEN n.upos = 'ADJ' AND {one_of(form, L.QUANTIFIERS)} AND {only('det')} THEN 'quantifier'
        WHEN n.upos = 'NUM' AND {only('det', 'amod')} THEN 'numeral'
        WHEN {one_of('n.xpos', ['JJR', 'JJS'])} AND {det('the')} THEN 'comparative'
        WHEN n.upos = 'ADJ' AND n.xpos = 'JJ' AND {only('det')} AND {parent('n')}.upos = 'VERB' THEN 'adjective' END"""
    return _findings(_hits(sentences.filter("lang = 'en'"), f"{core} AND ({kind}) IS NOT NULL"), subtype=kind)


def nominal_ellipsis_de(sentences: DataFrame) -> DataFrame:
    head = f"NOT {one_of('n.deprel', L.MODIFIER_RELATIONS)}"
    following = "get(nodes, n.ord)"
    endings = " OR ".join(f"endswith(lower(n.form), '{x}')" for x in L.SUPERLATIVE_ENDINGS_DE)
    kind = f"""CASE WHEN n.xpos = 'ART' AND {one_of('lower(n.form)', L.DEFINITE_ARTICLES_DE)} AND n.deprel <> 'det' AND {following}.upos = 'ADP' AND {following}.deprel = 'case' THEN 'demonstrative_pronoun'
        WHEN NOT ({head}) THEN null
        WHEN n.xpos = 'PPOSS' THEN 'possessive_pronoun'
        WHEN n.xpos = 'PIS' AND NOT {one_of('lower(n.form)', L.INHERENT_PRONOUNS_DE)} THEN 'quantifier'
        WHEN n.upos = 'NUM' AND {feat('n', 'NumType')} <> 'Ord' AND NOT {has_child('n', "c.deprel = 'cop'")} THEN 'cardinal'
        WHEN n.xpos = 'ADJA' AND {feat('n', 'NumType')} = 'Ord' THEN 'ordinal'
        WHEN n.xpos = 'ADJA' AND {feat('n', 'Degree')} = 'Cmp' THEN 'comparative'
        WHEN n.xpos = 'ADJA' AND ({feat('n', 'Degree')} = 'Sup' OR ({feat('n', 'Degree')} = '' AND ({endings}))) THEN 'superlative'
        WHEN n.xpos = 'ADJA' THEN 'adjective' END"""
    return _findings(_hits(sentences.filter("lang = 'de'"), f"({kind}) IS NOT NULL"), subtype=kind)


def nominal_ellipsis(sentences: DataFrame) -> DataFrame:
    return nominal_ellipsis_en(sentences).unionByName(nominal_ellipsis_de(sentences))


def clefts(sentences: DataFrame) -> DataFrame:
    """Subtypes it_cleft and wh_cleft (English); a node that gives an it-cleft isn't tried as the other."""
    nominal = f"{one_of('n.upos', ['NOUN', 'PRON', 'PROPN'])} AND {one_of('n.deprel', ['root', 'ccomp'])}"
    what = f"lower(n.lemma) = 'what' AND {one_of('n.deprel', ['nsubj', 'nsubj:outer'])}"
    rows = sentences.filter("lang = 'en' AND exists(nodes, n -> n.deprel = 'acl:relcl')")
    hits = _hits(rows, f"(({nominal}) OR ({what})) AND {has_child('n', repr('acl:relcl') + ' = c.deprel')}", ancestors=True)
    for name, value in (
        ("relative", first_child("n", "c.deprel = 'acl:relcl'")),
        ("cop", first_child("n", "c.deprel = 'cop' AND lower(c.lemma) = 'be'")),
        ("it", first_child("n", one_of("c.deprel", ["nsubj", "expl"]) + " AND lower(c.lemma) = 'it'")),
        ("up", parent("n")),
    ):
        hits = hits.withColumn(name, F.expr(value))
    hits = fixed(hits).withColumn("clause", F.expr(subtree("relative")))
    inside = subtree("n", "m.ord > greatest(cop.ord, it.ord) AND m.ord < clause[0].ord")
    hits = fixed(fixed(hits).withColumn("focus", F.expr(f"if(({nominal}) AND cop IS NOT NULL AND it IS NOT NULL, {inside}, null)")))
    is_wh = f"({what}) AND (up.upos = 'NOUN' OR (up.upos = 'VERB' AND up.form = up.lemma))"
    hits = fixed(hits.withColumn("kind", F.expr(f"CASE WHEN size(focus) > 0 THEN 'it_cleft' WHEN {is_wh} THEN 'wh_cleft' END"))).filter("kind IS NOT NULL")
    told = f"if(kind = 'it_cleft', {role('Cleft_focus', 'focus', 'n.form')}, {role_of('Cleft_focus', 'up')})"
    token = f"if(kind = 'it_cleft', {role_of('Cleft_it', 'it')}, {role_of('Cleft_wh', 'n')})"
    return _findings(hits, subtype="kind", roles=[told, role("Cleft_presupposition", "clause", "relative.form"), token])


def bare_questions(sentences: DataFrame) -> DataFrame:
    wh = L.by_language(L.WH_WORDS)
    question = "exists(nodes, q -> q.form = '?')"
    clause = f"exists(nodes, q -> {one_of('q.upos', ['VERB', 'AUX'])} OR {one_of('q.deprel', L.SUBJECTS)})"
    inner = first_child("n", one_of("c.deprel", ["det", "advmod", "amod", "case"]) + f" AND array_contains({wh}, lower(c.form))")
    is_wh = f"(array_contains({wh}, lower(n.form)) OR {inner} IS NOT NULL)"
    root = "n.ord = get(filter(nodes, q -> q.head = 0), 0).ord"
    hits = _hits(sentences.filter(one_of("lang", list(L.WH_WORDS))), f"{root} AND {question} AND NOT {clause} AND {is_wh}")
    span = "filter(nodes, s -> s.upos <> 'PUNCT')"
    return _findings(hits.filter(f"size({span}) > 0"), subtype=f"lower(if(array_contains({wh}, lower(n.form)), n.form, {inner}.form))", first=begin(span), last=end(span), text=words(span))


def gapped_coordination(sentences: DataFrame) -> DataFrame:
    """Signals A, B and C.  In word order, a candidate inside an earlier cluster is passed over; whether a cluster has an antecedent doesn't matter for that."""
    verbal = lambda x: one_of(f"{x}.upos", ["VERB", "AUX"])
    gap = has_child("n", one_of("c.deprel", L.GAPPED_ARGUMENTS))
    siblings = children(parent("n"), f"s.deprel = 'conj' AND NOT {verbal('s')}", "s")
    signal = f"CASE WHEN n.deprel <> 'conj' OR n.head = 0 OR {verbal('n')} THEN null WHEN {verbal(parent('n'))} THEN if({gap}, 'C', null) WHEN size({siblings}) >= 2 THEN 'A' WHEN {gap} THEN 'B' END"
    rows = plain(sentences.filter("lang IS NOT NULL"))
    rows = rows.withColumn("cands", F.expr(f"filter(transform(nodes, n -> named_struct('n', n, 'signal', {signal}, 'heads', if(({signal}) = 'A', transform({siblings}, h -> h.ord), array(n.ord)))), x -> x.signal IS NOT NULL)"))
    rows = with_ancestors(fixed(rows).filter("size(cands) > 0"))
    covered = "transform(filter(nodes, m -> arrays_overlap(m.anc, x.heads)), m -> m.ord)"
    fold = f"""aggregate(cands, named_struct('seen', cast(array() AS array<int>), 'kept', cast(array() AS array<int>)),
        (acc, x) -> if(array_contains(acc.seen, x.n.ord), acc, named_struct('seen', array_union(acc.seen, {covered}), 'kept', array_append(acc.kept, x.n.ord)))).kept"""
    hits = fixed(rows.withColumn("kept", F.expr(fold))).select(*KEYS, "nodes", F.explode(F.expr("filter(cands, x -> array_contains(kept, x.n.ord))")).alias("x")).select(*KEYS, "nodes", F.expr("x.n").alias("n"), F.expr("x.signal").alias("signal"), F.expr("x.heads").alias("heads"))
    span = "filter(nodes, m -> arrays_overlap(m.anc, heads) AND m.upos <> 'PUNCT')"
    # the host and its ancestors, outermost first; a step that isn't a verb lends its first verbal copula
    path = f"transform(reverse(filter({parent('n')}.anc, a -> a > 0)), a -> nodes[a - 1])"
    verb = f"get(filter(transform({path}, p -> if({verbal('p')}, p, {first_child('p', 'k.deprel = ' + repr('cop') + ' AND ' + verbal('k'), 'k')})), v -> v IS NOT NULL), 0)"
    hits = fixed(hits.withColumn("span", F.expr(span)).withColumn("v", F.expr(verb))).filter("size(span) > 0 AND v IS NOT NULL")
    return _findings(hits, subtype="signal", first=begin("span"), last=end("span"), text=words("span"), roles=[role_of("GappedAntecedent", "v")])


def right_node_raising(sentences: DataFrame) -> DataFrame:
    tags = lambda x: one_of(f"{x}.upos", L.PREDICATE_TAGS)
    hits = _hits(sentences, f"n.deprel = 'conj' AND n.head > 0 AND {tags('n')} AND {tags(parent('n'))}", ancestors=True)
    hits = hits.withColumn("l", F.expr(f"if(n.head < n.ord, {parent('n')}, n)")).withColumn("f", F.expr(f"if(n.head < n.ord, n, {parent('n')})"))
    edge = "array_max(transform(filter(nodes, e -> e.upos <> 'PUNCT'), e -> e.t_end))"
    shared = last_child("f", f"{one_of(universal('c'), L.CORE_ARGUMENTS)} AND {end(subtree('c'))} >= {edge}")
    hits = fixed(fixed(hits).withColumn("shared", F.expr(shared))).filter("shared IS NOT NULL")
    filled = has_child("l", f"c.upos <> 'ADP' AND {universal('c')} = {universal('shared')} AND c.ord <> shared.ord")
    subject = lambda x: has_child(x, one_of(universal("c"), ["nsubj", "csubj"]))
    distinct = f"({subject('l')} AND {subject('f')})"
    prep = has_child("l", f"{one_of(universal('c'), ['obl', 'obj'])} AND c.upos = 'ADP' AND NOT {has_child('c', one_of(universal('k'), ['obj', 'obl', 'nmod', 'nsubj']), 'k')}")
    hits = hits.filter(f"NOT {filled} AND ({distinct} OR {prep})")
    return _findings(hits, subtype=f"if({distinct}, 'distinct_subjects', 'stranded_prep')", first="l.t_start", last=end(subtree("shared")), text=words(subtree("shared")), roles=[role_of("RNR_left_predicate", "l"), role_of("RNR_right_predicate", "f"), role("RNR_shared_arg", subtree("shared"))])


def clitics(sentences: DataFrame) -> DataFrame:
    """Contractions of a host and a clitic that is written to it; what can't be expanded (a possessive) is none."""
    forms = L.by_language(L.CLITICS)
    before, following = "get(nodes, n.ord - 2)", f"get(filter(nodes, x -> x.ord > n.ord AND NOT {one_of('x.upos', ['ADV', 'PART'])}), 0)"
    table = L.sql({f"{lang} {form} {lemma}": v for lang, t in L.CLITIC_EXPANSIONS.items() for (form, lemma), v in t.items()})
    participle = f"lang = 'en' AND {following}.xpos = 'VBN'"
    plain = f"try_element_at({table}, concat_ws(' ', lang, lower(n.form), lower(n.lemma)))"
    full = f"""CASE WHEN {participle} AND lower(n.form) = "'d" THEN 'had' WHEN {participle} AND lower(n.form) = "'s" AND lower({following}.lemma) = 'be' THEN 'has' ELSE {plain} END"""
    hits = _hits(sentences.filter(one_of("lang", list(L.CLITICS))), f"array_contains({forms}, lower(n.form)) AND {before}.t_end = n.t_start AND ({full}) IS NOT NULL")
    hits = fixed(hits.withColumn("h", F.expr(before)).withColumn("full", F.expr(full)))
    # the first subject of the host's clause; what hangs on the technical root has it among the roots
    s = f"get(filter(nodes, x -> x.head = h.head AND {one_of(universal('x'), ['nsubj', 'expl'])}), 0)"
    agree = f"CASE WHEN lower({s}.lemma) = 'i' THEN 'am' WHEN {one_of(f'lower({s}.lemma)', ['you', 'we', 'they'])} OR {feat(s, 'Number')} = 'Plur' THEN 'are' ELSE 'is' END"
    host = f"CASE WHEN lang = 'en' AND lower(h.form) = 'ai' THEN {agree} WHEN lang = 'en' THEN coalesce(try_element_at({L.sql(L.HOSTS)}, lower(h.form)), h.form) ELSE h.form END"
    cannot = "lang = 'en' AND lower(h.form) = 'ca' AND lower(n.form) = \"n't\""
    solid = "if(substring(h.form, 1, 1) <> lower(substring(h.form, 1, 1)), 'Cannot', 'cannot')"
    return _findings(hits, subtype="'clitic'", first="h.t_start", text="concat(h.form, n.form)", suggestion=f"if({cannot}, {solid}, concat({host}, ' ', full))", roles=[role_of("Contraction_host", "h"), role_of("Contraction_clitic", "n")])


def prep_articles(sentences: DataFrame) -> DataFrame:
    """Multiword tokens of an adposition and a determiner, any language; ``more`` has the word that follows."""
    rows = plain(sentences.filter("size(mwts) > 0")).select(*KEYS, "nodes", F.explode("mwts").alias("w"))
    rows = rows.filter("w.last_ord = w.first_ord + 1").withColumn("n", F.expr("get(nodes, w.first_ord - 1)")).withColumn("d", F.expr("get(nodes, w.last_ord - 1)"))
    rows = rows.filter("n.upos = 'ADP' AND d.upos = 'DET'")
    return _findings(rows, subtype="'prep_article'", text="w.form", suggestion="concat(n.form, ' ', d.form)", more={"following": "get(nodes, w.last_ord).form"})


def _capital(text: str, source: str, also: str = "false") -> str:
    """Takes over a capital first letter of the source."""
    letter = f"regexp_extract({source}, '(\\\\p{{L}})', 1)"
    return f"if(({also}) OR ({letter} <> '' AND {letter} <> lower({letter})), concat(upper(substring({text}, 1, 1)), substring({text}, 2)), {text})"


def clipped_articles(sentences: DataFrame) -> DataFrame:
    """German nen, nem, ner; ne before a noun phrase; n by the gender and case of its noun."""
    bare = "lower(ltrim(\"'\", n.form))"
    next_head = f"get(filter(nodes, x -> x.ord > n.ord AND NOT {one_of('x.upos', ['ADJ', 'ADV', 'DET', 'NUM', 'PRON'])}), 0)"
    noun = one_of(f"{next_head}.upos", ["NOUN", "PROPN"])
    table = L.sql({f"{g} {c}": v for (g, c), v in L.INDEFINITE_ARTICLE.items()})
    inferred = f"if({noun} AND {feat(next_head, 'Number')} <> 'Plur', try_element_at({table}, concat({feat(next_head, 'Gender')}, ' ', {feat(next_head, 'Case')})), null)"
    full = f"CASE WHEN {bare} = 'ne' AND NOT coalesce({noun}, false) THEN null WHEN {bare} = 'n' THEN {inferred} ELSE try_element_at({L.sql(L.CLIPPED_ARTICLES)}, {bare}) END"
    hits = fixed(_hits(sentences.filter("lang = 'de'"), f"({full}) IS NOT NULL").withColumn("full", F.expr(full)))
    return _findings(hits, subtype=f"if({bare} = 'n', 'clipped_article_inferred', 'clipped_article')", suggestion=_capital("full", "n.form"), more={"inferred": f"{bare} = 'n'"})


def clipped_forms(sentences: DataFrame) -> DataFrame:
    """English words written short (gonna, talkin'), as one token or two; the longest match from the left, tokens used once."""
    table = L.sql(L.CLIPPED_FORMS)
    rows = plain(sentences.filter("lang = 'en'"))

    def dropped(s: str) -> str:
        """A participle without its g."""
        return f"if(length({s}) > 3 AND lower({s}) LIKE \"%in'\" AND rlike(substring({s}, length({s}) - 3, 1), '\\\\p{{L}}'), concat(substring({s}, 1, length({s}) - 3), if(substring({s}, length({s}) - 2, 2) = upper(substring({s}, length({s}) - 2, 2)), 'ING', 'ing')), null)"

    two = "concat(n.form, get(nodes, n.ord).form)"
    joined = "get(nodes, n.ord).t_start = n.t_end"
    wide = f"if({joined}, coalesce(try_element_at({table}, lower({two})), if(get(nodes, n.ord).form = \"'\" AND {one_of('n.upos', ['VERB', 'AUX'])}, {dropped(two)}, null)), null)"
    single = f"coalesce(try_element_at({table}, lower(n.form)), {dropped('n.form')})"
    rows = rows.withColumn("cands", F.expr(f"filter(transform(nodes, n -> named_struct('n', n, 'wide', {wide}, 'single', {single}, 'two', {two})), x -> x.wide IS NOT NULL OR x.single IS NOT NULL)"))
    rows = fixed(rows).filter("size(cands) > 0")
    fold = """aggregate(cands, named_struct('upto', 0, 'kept', cast(array() AS array<int>)),
        (acc, x) -> if(x.n.ord <= acc.upto, acc, named_struct('upto', x.n.ord + if(x.wide IS NOT NULL, 1, 0), 'kept', array_append(acc.kept, x.n.ord)))).kept"""
    hits = fixed(rows.withColumn("kept", F.expr(fold))).select(*KEYS, "nodes", F.explode(F.expr("filter(cands, x -> array_contains(kept, x.n.ord))")).alias("x"))
    hits = hits.select(*KEYS, "nodes", F.expr("x.n").alias("n"), F.expr("coalesce(x.wide, x.single)").alias("full"), F.expr("if(x.wide IS NOT NULL, x.two, x.n.form)").alias("surface"), F.expr("if(x.wide IS NOT NULL, get(nodes, x.n.ord).t_end, x.n.t_end)").alias("upto"))
    glued = "if(coalesce(get(nodes, n.ord - 2).t_end = n.t_start, false), ' ', '')"
    return _findings(hits, subtype="'clipped_form'", last="upto", text="surface", suggestion=f"concat({glued}, {_capital('full', 'surface', 'n.ord = 1')})")


def contraction(sentences: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [prep_articles(sentences), clipped_articles(sentences), clipped_forms(sentences), clitics(sentences)])


def matches(text: str, pattern: str) -> str:
    """SQL for the matches of a pattern in a text: an array of (begin, end, text), offsets in code points.

    Gaps and matches are extracted in turn, so that offsets are sums of lengths; ``|\\z`` ends the scan.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    whole, gap, hit = (f"regexp_extract_all({text}, '(?Us)(.*?)((?:{quoted})|\\\\z)', {i})" for i in (0, 1, 2))
    fold = f"""aggregate(arrays_zip({gap} AS g, {hit} AS h), named_struct('at', 0, 'out', cast(array() AS array<struct<begin:int,end:int,text:string>>)),
        (acc, x) -> named_struct('at', acc.at + length(x.g) + length(x.h), 'out', if(x.h = '', acc.out, array_append(acc.out, named_struct('begin', acc.at + length(x.g), 'end', acc.at + length(x.g) + length(x.h), 'text', x.h))))).out"""
    return fold.replace(f"arrays_zip({gap} AS g, {hit} AS h)", f"zip_with({gap}, {hit}, (g, h) -> named_struct('g', g, 'h', h))")


def enumeration_runs(found: str) -> str:
    """SQL: of matches in ``found`` (each with ``gap``: the text before it), the begins of those in runs of three or more."""
    runs = f"""aggregate({found}, cast(array() AS array<array<int>>),
        (acc, x) -> if(size(acc) > 0 AND rlike(x.gap, '{L.ENUM_SEPARATOR.replace(chr(92), chr(92) * 2)}'), array_append(slice(acc, 1, size(acc) - 1), array_append(element_at(acc, -1), x.begin)), array_append(acc, array(x.begin))))"""
    return f"flatten(filter({runs}, r -> size(r) >= 3))"


def abbreviation(sentences: DataFrame, *, expansions: DataFrame | None = None) -> DataFrame:
    """All-caps forms of 2 to 6 letters that aren't shouted, function words or members of an enumeration.

    Subtype abbreviation_defined: it stands in brackets behind its own gloss.  ``expansions`` (lang, form, expansion) gives
    suggestions: the long forms, in alphabetical order, parted by ``|``; the optimizer broadcasts it where it is small.
    """
    # a form is in capitals within the text, or it isn't a candidate: most sentences end here
    rows = plain(sentences.filter(F.expr(f"exists(nodes, n -> rlike(n.form, '^{L.CANDIDATE}$'))")))
    stop = L.by_language(L.FUNCTION_WORDS)
    letters = "filter(nodes, w -> rlike(w.form, '^\\\\p{L}+$'))"
    caps = f"size(filter({letters}, w -> length(w.form) > 1 AND w.form = upper(w.form) AND w.form <> lower(w.form)))"
    rows = fixed(rows.withColumn("alpha", F.expr(f"size({letters})")).withColumn("caps", F.expr(caps))).filter("NOT (alpha >= 10 AND caps / alpha > 0.3D)")
    shape = f"rlike(n.form, '^{L.CANDIDATE}$')"
    rows = rows.withColumn("cands", F.expr(f"filter(nodes, n -> {shape} AND NOT array_contains({stop}, lower(n.form)))"))
    rows = fixed(rows).filter("size(cands) > 0")
    rows = fixed(rows.withColumn("found", F.expr(matches("text", rf"\b{L.CANDIDATE}\b"))))
    rows = rows.withColumn("gaps", F.expr("transform(found, (m, i) -> named_struct('begin', m.begin, 'gap', if(i = 0, 'x', substring(text, found[i - 1].end + 1, m.begin - found[i - 1].end))))"))
    rows = rows.withColumn("runs", F.expr(enumeration_runs("gaps")))
    rows = rows.withColumn("glossed", F.expr(f"transform({matches('text', L.GLOSS_CONTEXT.replace('(' + '[A-ZÄÖÜ]{2,6})', '(?:[A-ZÄÖÜ]{2,6})'))}, m -> m.begin + length(regexp_extract(m.text, '(?Us)^(.*)\\\\(', 1)) + 1 + length(regexp_extract(m.text, '(?Us)\\\\((\\\\s*)[A-ZÄÖÜ]{{2,6}}\\\\s*\\\\)$', 1)))"))
    hits = fixed(rows).select(*KEYS, "nodes", "found", "runs", "glossed", "cands", F.explode("cands").alias("n"))
    # the node's n-th occurrence among candidates of its form is the form's n-th occurrence in the text
    place = "get(filter(found, m -> m.text = n.form), size(filter(cands, c -> c.form = n.form AND c.ord < n.ord))).begin"
    hits = fixed(hits.withColumn("place", F.expr(place))).filter("place IS NULL OR NOT array_contains(runs, place)")
    out = _findings(hits, subtype="if(coalesce(array_contains(glossed, place), false), 'abbreviation_defined', 'abbreviation')")
    if expansions is None:
        return out
    known = expansions.filter("expansion IS NOT NULL").groupBy("lang", F.col("form").alias("text")).agg(F.array_join(F.array_sort(F.collect_set("expansion")), "|").alias("__long"))
    return out.join(known, ["lang", "text"], "left").withColumn("suggestion", F.col("__long")).select(*out.columns)


def suspended_composition(sentences: DataFrame, *, resolved: DataFrame | None = None) -> DataFrame:
    """Stubs with a closing hyphen (shared_head) and with an opening one (shared_modifier), on the sentence's text.

    Token spans are found in the text one after the other; a stub's span is from the first to the last token it overlaps.
    ``more`` has the word that the missing part may come from: behind a shared_head stub, before a shared_modifier one
    (near, near_begin, near_end).  ``resolved`` (doc_id, view, sent_id, begin, end, donor_begin, donor_end, donor, completed, basis), such as
    ``completed_stubs`` gives, adds the completed form as suggestion, the donor as role and in ``more`` the basis.
    """
    # no hyphen, no stub
    rows = plain(sentences.filter(one_of("lang", list(L.COORDINATORS))).filter("contains(text, '-')"))
    spans = """aggregate(nodes, named_struct('at', 1, 'out', cast(array() AS array<struct<a:int,b:int,s:int,e:int,ord:int>>)),
        (acc, n) -> if(n.form = '' OR locate(n.form, text, acc.at) = 0, acc, named_struct('at', locate(n.form, text, acc.at) + length(n.form),
            'out', array_append(acc.out, named_struct('a', locate(n.form, text, acc.at) - 1, 'b', locate(n.form, text, acc.at) - 1 + length(n.form), 's', n.t_start, 'e', n.t_end, 'ord', n.ord))))).out"""
    both = f"""concat(transform({matches('text', L.STUB)}, m -> named_struct('m', m, 'way', 'shared_head')), transform({matches('text', L.LEAD_STUB)}, m -> named_struct('m', m, 'way', 'shared_modifier')))"""
    rows = fixed(rows.withColumn("spans", F.expr(spans))).withColumn("stub", F.explode(F.expr(both)))
    rows = rows.withColumn("hit", F.expr("filter(spans, s -> s.a < stub.m.end AND s.b > stub.m.begin)"))
    rows = fixed(rows).filter("size(hit) > 0")
    rows = rows.withColumn("n", F.expr("nodes[hit[0].ord - 1]"))
    word = f"rlike(x.form, '^[\\\\p{{L}}-]{{3,}}$') AND NOT {one_of('lower(x.form)', L.COORDINATORS['de'] + L.COORDINATORS['en'])}"
    behind, before = f"get(filter(nodes, x -> x.ord > element_at(hit, -1).ord AND {word}), 0)", f"try_element_at(filter(nodes, x -> x.ord < hit[0].ord AND {word}), -1)"
    rows = fixed(rows.withColumn("near", F.expr(f"if(stub.way = 'shared_head', {behind}, {before})")))
    out = _findings(rows, subtype="stub.way", first="hit[0].s", last="element_at(hit, -1).e", text="stub.m.text", more={"near": "near.form", "near_begin": "near.t_start", "near_end": "near.t_end"})
    if resolved is None:
        return out
    keys = ["doc_id", "view", "sent_id", "begin", "end"]
    donor = f"cast(if(donor_begin IS NULL, array(), array(named_struct('label', 'Suspension_donor', 'begin', cast(donor_begin AS int), 'end', cast(donor_end AS int), 'text', donor))) AS {ROLES})"
    told = out.join(resolved.select(*keys, "donor_begin", "donor_end", "donor", "completed", "basis"), keys, "left").withColumns({"suggestion": F.col("completed"), "roles": F.expr(donor), "more": F.expr("if(completed IS NULL, more, map_concat(more, map('basis', basis, 'certainty', if(basis = 'unique', '1.0', '0.7'))))")})
    return told.select(*out.columns)


def completed_stubs(findings: DataFrame, wordlist: DataFrame) -> DataFrame:
    """What completes stubs, by a list of words (word): for ``resolved``.

    The neighbouring word is cut at each place; a part of it that makes a known word with the stub is its completion.  Basis
    ``unique`` if there is one, else ``attested``, and the longest known word is taken.  One equi-join with the list.
    """
    stub, way, near = "replace(text, '-', '')", "subtype = 'shared_head'", "more['near']"
    parts = f"transform(sequence(1, greatest(length({near}) - 2, 1)), i -> if({way}, concat({stub}, lower(substring({near}, i + 1))), concat(substring({near}, 1, i + 1), {stub})))"
    keys = ["doc_id", "view", "sent_id", "begin", "end"]
    tried = findings.filter(f"length({near}) >= 4").select(*keys, F.expr("try_cast(more['near_begin'] AS int)").alias("donor_begin"), F.expr("try_cast(more['near_end'] AS int)").alias("donor_end"), F.expr(near).alias("donor"), F.explode(F.array_distinct(F.expr(parts))).alias("completed"))
    known = tried.withColumn("__word", F.lower("completed")).join(wordlist.select(F.lower("word").alias("__word")).distinct(), "__word", "left_semi")
    found = known.groupBy(*keys, "donor_begin", "donor_end", "donor").agg(F.max_by("completed", F.struct(F.length("completed"), "completed")).alias("completed"), F.count(F.lit(1)).alias("n"))
    return found.select(*keys, "donor_begin", "donor_end", "donor", "completed", F.when(F.col("n") == 1, "unique").otherwise("attested").alias("basis"))
