"""The detectors' findings in standard SQL, over the synthetic forest's node table; written apart from the engine's expressions."""

from __future__ import annotations

from ..functions import lexicon as L
from ..sources.forest import FOREST_SQL


def _q(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _in(table: dict[str, list[str]], x: str, lang: str = "n.lang") -> str:
    return "(" + " OR ".join(f"({lang} = '{k}' AND {x} IN {_q(v)})" for k, v in table.items()) + ")"


def _same(a: str, b: str = "n") -> str:
    return f"{a}.d = {b}.d AND {a}.s = {b}.s"


def _kids(cond: str, of: str = "n", name: str = "c") -> str:
    return f"EXISTS (SELECT 1 FROM tok {name} WHERE {_same(name, of)} AND {name}.head = {of}.o AND ({cond}))"


def _first(cond: str, of: str = "n", name: str = "c", pick: str = "min") -> str:
    return f"(SELECT {pick}({name}.o) FROM tok {name} WHERE {_same(name, of)} AND {name}.head = {of}.o AND ({cond}))"


def _edge(which: str, of: str, cond: str = "true") -> str:
    """min(b) or max(e) over a node's subtree."""
    return f"(SELECT {which}(m.{'b' if which == 'min' else 'e'}) FROM anc a JOIN tok m ON {_same('m', 'a')} AND m.o = a.o WHERE {_same('a', of)} AND a.a = {of}.o AND ({cond}))"


def _role(label: str, b: str, e: str) -> str:
    return f"CASE WHEN {b} IS NOT NULL THEN '{label}:' || {b} || ':' || {e} END"


def _row(subtype: str, b: str, e: str, roles: list[str] = (), suggestion: str = "NULL", n: str = "n") -> str:
    joined = f"concat_ws('|', {', '.join(roles)})" if roles else "''"
    return f"SELECT {n}.d AS doc_id, CAST({n}.s AS INTEGER) AS sent_id, CAST({n}.o AS INTEGER) AS ord, {subtype} AS subtype, CAST({b} AS INTEGER) AS \"begin\", CAST({e} AS INTEGER) AS \"end\", CAST({suggestion} AS VARCHAR) AS suggestion, {joined} AS roles"


def _whole(body: str) -> str:
    return f"WITH RECURSIVE {FOREST_SQL} {body}"


def _u(x: str) -> str:
    return f"split_part({x}.deprel, ':', 1)"


SUBJ = _q(L.SUBJECTS)
KNOWN = {k: v + L.EMBEDDING_NOUNS[k] for k, v in L.EMBEDDING_PREDICATES.items()}


def _embeds(g: str, table) -> str:
    return f"({_in(table, f'lower({g}.lemma)')} OR {_in(table, f'lower({g}.form)')})"


_direct = "(n.deprel = 'ccomp' OR (n.deprel = 'advmod' AND n.o > n.head))"
_span = "(SELECT {0} FROM tok x WHERE x.d = n.d AND x.s = n.s AND (x.o = n.o OR (x.head = n.o AND x.upos <> 'PUNCT')))"
_up = "CASE WHEN n.deprel = 'conj' THEN {0} ELSE {1} END"
SLUICING = _whole(f""", gov AS (SELECT n.*, CASE WHEN n.deprel = 'conj' AND NOT {_direct} THEN p.head ELSE n.head END AS g
    FROM tok n JOIN tok p ON {_same('p')} AND p.o = n.head WHERE ({_in(L.WH_WORDS, 'lower(n.form)')} OR {_kids(_in(L.WH_WORDS, 'lower(c.form)'))}) AND NOT {_kids(f"c.deprel IN {SUBJ} OR c.upos = 'VERB'")})
    {_row("''", _span.format('min(b)'), _span.format('max(e)'), [_role('QEmbedder', 'g.b', 'g.e')])} FROM gov n JOIN tok g ON {_same('g')} AND g.o = n.g
    WHERE {_direct} OR (NOT {_direct} AND n.deprel IN {_q(L.SLUICE_RELATIONS)} AND {_embeds('g', KNOWN)} AND g.deprel NOT IN {_q(L.EMBEDDED_VERBS)}) OR (n.deprel IN ('acl', 'nmod') AND {_embeds('g', L.EMBEDDING_NOUNS)})""".replace("SELECT n.d AS doc_id", "SELECT n.d AS doc_id", 1))

_shared = f"(SELECT string_agg('Shared_subject:' || {_edge('min', 'c')} || ':' || {_edge('max', 'c')}, '|' ORDER BY c.o) FROM tok c WHERE {_same('c')} AND c.head = n.head AND c.deprel IN {SUBJ})"
SUBJECT_SHARING = _whole(f""", subs AS (SELECT c.d, c.s, c.head, string_agg('Shared_subject:' || x.b || ':' || x.e, '|' ORDER BY c.o) AS roles FROM tok c
        JOIN (SELECT a.d, a.s, a.a, min(m.b) AS b, max(m.e) AS e FROM anc a JOIN tok m ON {_same('m', 'a')} AND m.o = a.o GROUP BY ALL) x ON {_same('x', 'c')} AND x.a = c.o WHERE c.deprel IN {SUBJ} GROUP BY ALL)
    {_row("''", 'n.b', 'n.e', ['u.roles'])} FROM tok n JOIN subs u ON {_same('u')} AND u.head = n.head WHERE n.deprel = 'conj' AND n.head > 0 AND NOT {_kids(f'c.deprel IN {SUBJ}')}""")

VERBAL_ELLIPSIS = _whole(f"""{_row('n.deprel', 'n.b', 'n.e')} FROM tok n WHERE n.deprel NOT IN {_q(L.AUXILIARY_RELATIONS)} AND (n.upos = 'AUX' OR n.xpos = 'AUX'
    OR (lower(n.lemma) IN {_q(L.STRANDED_LEMMAS)} AND n.upos IN ('VERB', 'AUX') AND NOT {_kids("c.upos IN ('VERB', 'AUX') OR c.deprel IN ('obj', 'obja')")}))""")

_SUB = f", sub AS (SELECT a.d, a.s, a.a, min(m.b) AS b, max(m.e) AS e FROM anc a JOIN tok m ON {_same('m', 'a')} AND m.o = a.o GROUP BY ALL), agents AS"
_marks = lambda of: f"k.deprel = 'case' AND ({_in(L.AGENT_PREPOSITIONS, 'lower(k.lemma)', of)} OR {_in(L.AGENT_PREPOSITIONS, 'lower(k.form)', of)})"
_passive = lambda more, joins: _whole(f""", sub AS (SELECT a.d, a.s, a.a, min(m.b) AS b, max(m.e) AS e FROM anc a JOIN tok m ON {_same('m', 'a')} AND m.o = a.o GROUP BY ALL), agents AS (SELECT c.d, c.s, c.head, c.o, min(k.o) AS k FROM tok c JOIN tok k ON {_same('k', 'c')} AND k.head = c.o AND {_marks('c.lang')} WHERE c.deprel IN ('obl', 'obl:agent') GROUP BY ALL),
    agent AS (SELECT d, s, head, min(o) AS o, arg_min(k, o) AS k FROM agents GROUP BY d, s, head),
    verbs AS (SELECT n.d, n.s, n.o, 'canonical' AS kind, v.o AS v, n.o AS x, {_first("c.deprel IN ('nsubj:pass', 'csubj:pass')", 'v')} AS u FROM tok n JOIN tok v ON {_same('v')} AND v.o = n.head WHERE n.deprel = 'aux:pass'
      UNION ALL SELECT n.d, n.s, n.o, 'short', n.o, NULL, NULL FROM tok n WHERE ({_in(L.PARTICIPLE_XPOS, 'n.xpos')} OR n.feats LIKE '%VerbForm=Part%') AND NOT {_kids(_u('c') + " = 'aux'")} AND n.lang IN {_q(L.AGENT_PREPOSITIONS)}
        AND EXISTS (SELECT 1 FROM agent g WHERE {_same('g')} AND g.head = n.o))
    {_row('n.kind', 'v.b', 'v.e', [_role('Passive_verb', 'v.b', 'v.e'), _role('Passive_aux', 'x.b', 'x.e'), _role('Passive_subject', 'u.b', 'u.e'), _role('Passive_agent', 'g.b', 'g.e'), _role('Passive_agent_marker', 'k.b', 'k.e'), *more])}
    FROM verbs n JOIN tok v ON {_same('v')} AND v.o = n.v LEFT JOIN tok x ON {_same('x')} AND x.o = n.x LEFT JOIN tok u ON {_same('u')} AND u.o = n.u
    LEFT JOIN agent ag ON {_same('ag')} AND ag.head = n.v LEFT JOIN tok g ON {_same('g')} AND g.o = ag.o LEFT JOIN tok k ON {_same('k')} AND k.o = ag.k {joins}""")  # noqa: E731
PASSIVE = _passive([], "").replace(_SUB, ", agents AS")
PASSIVE_PHRASES = _passive([_role("Passive_subject_phrase", "up.b", "up.e"), _role("Passive_agent_phrase", "gp.b", "gp.e")], f"LEFT JOIN sub up ON {_same('up')} AND up.a = n.u LEFT JOIN sub gp ON {_same('gp')} AND gp.a = ag.o")

_det = lambda w: _kids(f"c.deprel = 'det' AND lower(c.form) = '{w}'")
NOMINAL_EN = _whole(f"""SELECT * FROM ({_row(f'''CASE WHEN lower(n.form) = 'none' AND NOT {_kids('true')} THEN 'none' WHEN lower(n.form) = 'one' AND {_det('every')} THEN 'every_one' WHEN lower(n.form) = 'elder' AND {_det('the')} THEN 'elder'
    WHEN n.upos = 'ADJ' AND lower(n.form) IN {_q(L.QUANTIFIERS)} AND NOT {_kids("c.deprel <> 'det'")} THEN 'quantifier' WHEN n.upos = 'NUM' AND NOT {_kids("c.deprel NOT IN ('det', 'amod')")} THEN 'numeral'
    WHEN n.xpos IN ('JJR', 'JJS') AND {_det('the')} THEN 'comparative'
    WHEN n.upos = 'ADJ' AND n.xpos = 'JJ' AND NOT {_kids("c.deprel <> 'det'")} AND EXISTS (SELECT 1 FROM tok p WHERE {_same('p')} AND p.o = n.head AND p.upos = 'VERB') THEN 'adjective' END''', 'n.b', 'n.e')}
    FROM tok n WHERE n.lang = 'en' AND n.deprel IN {_q(L.NOMINAL_RELATIONS)}) WHERE subtype IS NOT NULL""")

_mod = f"n.deprel NOT IN {_q(L.MODIFIER_RELATIONS)}"
_ends = " OR ".join(f"lower(n.form) LIKE '%{x}'" for x in L.SUPERLATIVE_ENDINGS_DE)
NOMINAL_DE = _whole(f"""SELECT * FROM ({_row(f'''CASE WHEN n.xpos = 'ART' AND lower(n.form) IN {_q(L.DEFINITE_ARTICLES_DE)} AND n.deprel <> 'det' AND EXISTS (SELECT 1 FROM tok f WHERE {_same('f')} AND f.o = n.o + 1 AND f.upos = 'ADP' AND f.deprel = 'case') THEN 'demonstrative_pronoun'
    WHEN NOT ({_mod}) THEN NULL WHEN n.xpos = 'PPOSS' THEN 'possessive_pronoun' WHEN n.xpos = 'PIS' AND lower(n.form) NOT IN {_q(L.INHERENT_PRONOUNS_DE)} THEN 'quantifier'
    WHEN n.upos = 'NUM' AND n.feats NOT LIKE '%NumType=Ord%' AND NOT {_kids("c.deprel = 'cop'")} THEN 'cardinal' WHEN n.xpos <> 'ADJA' THEN NULL WHEN n.feats LIKE '%NumType=Ord%' THEN 'ordinal' WHEN n.feats LIKE '%Degree=Cmp%' THEN 'comparative'
    WHEN n.feats LIKE '%Degree=Sup%' OR (n.feats NOT LIKE '%Degree=%' AND ({_ends})) THEN 'superlative' ELSE 'adjective' END''', 'n.b', 'n.e')} FROM tok n WHERE n.lang = 'de') WHERE subtype IS NOT NULL""")

CLEFTS = _whole(f""", sub AS (SELECT a.d, a.s, a.a, min(a.o) AS first, min(m.b) AS b, max(m.e) AS e FROM anc a JOIN tok m ON {_same('m', 'a')} AND m.o = a.o GROUP BY ALL),
    rel AS (SELECT d, s, head, min(o) AS o FROM tok WHERE deprel = 'acl:relcl' GROUP BY ALL),
    cop AS (SELECT d, s, head, min(o) AS o FROM tok WHERE deprel = 'cop' AND lower(lemma) = 'be' GROUP BY ALL),
    it AS (SELECT d, s, head, min(o) AS o FROM tok WHERE deprel IN ('nsubj', 'expl') AND lower(lemma) = 'it' GROUP BY ALL),
    its AS (SELECT n.d, n.s, n.o, i.o AS i, r.b AS rb, r.e AS re, min(f.b) AS fb, max(f.e) AS fe FROM tok n JOIN cop ON {_same('cop')} AND cop.head = n.o JOIN it i ON {_same('i')} AND i.head = n.o JOIN rel ON {_same('rel')} AND rel.head = n.o
      JOIN sub r ON {_same('r')} AND r.a = rel.o JOIN anc a ON {_same('a')} AND a.a = n.o AND a.o > greatest(cop.o, i.o) AND a.o < r.first JOIN tok f ON {_same('f')} AND f.o = a.o
      WHERE n.lang = 'en' AND n.upos IN ('NOUN', 'PRON', 'PROPN') AND n.deprel IN ('root', 'ccomp') GROUP BY ALL)
    {_row("'it_cleft'", 't.b', 't.e', [_role('Cleft_focus', 'n.fb', 'n.fe'), _role('Cleft_presupposition', 'n.rb', 'n.re'), _role('Cleft_it', 'i.b', 'i.e')])} FROM its n JOIN tok t ON {_same('t')} AND t.o = n.o JOIN tok i ON {_same('i')} AND i.o = n.i
    UNION ALL {_row("'wh_cleft'", 'n.b', 'n.e', [_role('Cleft_focus', 'p.b', 'p.e'), _role('Cleft_presupposition', 'r.b', 'r.e'), _role('Cleft_wh', 'n.b', 'n.e')])} FROM tok n JOIN rel ON {_same('rel')} AND rel.head = n.o JOIN sub r ON {_same('r')} AND r.a = rel.o JOIN tok p ON {_same('p')} AND p.o = n.head
    WHERE n.lang = 'en' AND lower(n.lemma) = 'what' AND n.deprel IN ('nsubj', 'nsubj:outer') AND (p.upos = 'NOUN' OR (p.upos = 'VERB' AND p.form = p.lemma)) AND NOT EXISTS (SELECT 1 FROM its x WHERE {_same('x')} AND x.o = n.o)""")

BARE_QUESTIONS = _whole(f""", sents AS (SELECT d, s, min(CASE WHEN head = 0 THEN o END) AS root, bool_or(form = '?') AS asks, bool_or(upos IN ('VERB', 'AUX') OR deprel IN {SUBJ}) AS clause, min(CASE WHEN upos <> 'PUNCT' THEN b END) AS b0, max(CASE WHEN upos <> 'PUNCT' THEN e END) AS e0 FROM tok GROUP BY ALL),
    roots AS (SELECT n.*, z.b0, z.e0, {_first(f"c.deprel IN ('det', 'advmod', 'amod', 'case') AND {_in(L.WH_WORDS, 'lower(c.form)', 'c.lang')}")} AS inner_o FROM tok n JOIN sents z ON {_same('z')} AND z.root = n.o WHERE z.asks AND NOT z.clause AND z.b0 IS NOT NULL)
    {_row(f"CASE WHEN {_in(L.WH_WORDS, 'lower(n.form)')} THEN lower(n.form) ELSE lower(w.form) END", 'n.b0', 'n.e0')} FROM roots n LEFT JOIN tok w ON {_same('w')} AND w.o = n.inner_o WHERE {_in(L.WH_WORDS, 'lower(n.form)')} OR (w.o IS NOT NULL AND n.lang IN {_q(L.WH_WORDS)})""")

_pred = _q(L.PREDICATE_TAGS)
RIGHT_NODE = _whole(f""", sub AS (SELECT a.d, a.s, a.a, min(m.b) AS b, max(m.e) AS e FROM anc a JOIN tok m ON {_same('m', 'a')} AND m.o = a.o GROUP BY ALL), edge AS (SELECT d, s, max(e) AS e FROM tok WHERE upos <> 'PUNCT' GROUP BY ALL),
    pairs AS (SELECT n.d, n.s, n.o, least(n.o, n.head) AS l, greatest(n.o, n.head) AS f FROM tok n JOIN tok p ON {_same('p')} AND p.o = n.head WHERE n.deprel = 'conj' AND n.upos IN {_pred} AND p.upos IN {_pred}),
    args AS (SELECT n.d, n.s, n.o, n.l, n.f, max(c.o) AS c FROM pairs n JOIN tok c ON {_same('c')} AND c.head = n.f AND {_u('c')} IN {_q(L.CORE_ARGUMENTS)} JOIN sub ON {_same('sub', 'c')} AND sub.a = c.o JOIN edge ON {_same('edge', 'c')} WHERE sub.e >= edge.e GROUP BY ALL),
    judged AS (SELECT n.*, (EXISTS (SELECT 1 FROM tok x WHERE {_same('x')} AND x.head = n.l AND {_u('x')} IN ('nsubj', 'csubj')) AND EXISTS (SELECT 1 FROM tok x WHERE {_same('x')} AND x.head = n.f AND {_u('x')} IN ('nsubj', 'csubj'))) AS two,
      EXISTS (SELECT 1 FROM tok x WHERE {_same('x')} AND x.head = n.l AND {_u('x')} IN ('obl', 'obj') AND x.upos = 'ADP' AND NOT EXISTS (SELECT 1 FROM tok y WHERE {_same('y', 'x')} AND y.head = x.o AND {_u('y')} IN ('obj', 'obl', 'nmod', 'nsubj'))) AS prep
      FROM args n JOIN tok c ON {_same('c')} AND c.o = n.c WHERE NOT EXISTS (SELECT 1 FROM tok x WHERE {_same('x')} AND x.head = n.l AND x.upos <> 'ADP' AND {_u('x')} = {_u('c')} AND x.o <> n.c))
    {_row("CASE WHEN n.two THEN 'distinct_subjects' ELSE 'stranded_prep' END", 'l.b', 'z.e', [_role('RNR_left_predicate', 'l.b', 'l.e'), _role('RNR_right_predicate', 'f.b', 'f.e'), _role('RNR_shared_arg', 'z.b', 'z.e')])}
    FROM judged n JOIN tok l ON {_same('l')} AND l.o = n.l JOIN tok f ON {_same('f')} AND f.o = n.f JOIN sub z ON {_same('z')} AND z.a = n.c WHERE n.two OR n.prep""")

_fol = lambda skip: f"(SELECT min(x.o) FROM tok x WHERE {_same('x')} AND x.o > n.o AND x.upos NOT IN {_q(skip)})"
_table = "CASE " + " ".join(f"WHEN n.lang = '{lang}' AND lower(n.form) = '{f.replace(chr(39), chr(39) * 2)}' AND lower(n.lemma) = '{lem}' THEN '{x}'" for lang, t in L.CLITIC_EXPANSIONS.items() for (f, lem), x in t.items()) + " END"
CLITICS = _whole(f""", near AS (SELECT n.*, h.o AS h, {_fol(['ADV', 'PART'])} AS nxt FROM tok n JOIN tok h ON {_same('h')} AND h.o = n.o - 1 AND h.e = n.b WHERE {_in(L.CLITICS, 'lower(n.form)')}),
    full_ AS (SELECT n.*, CASE WHEN n.lang = 'en' AND f.xpos = 'VBN' AND lower(n.form) = '''d' THEN 'had' WHEN n.lang = 'en' AND f.xpos = 'VBN' AND lower(n.form) = '''s' AND lower(f.lemma) = 'be' THEN 'has' ELSE {_table} END AS x FROM near n LEFT JOIN tok f ON {_same('f')} AND f.o = n.nxt),
    subj AS (SELECT n.d, n.s, n.o, min(u.o) AS u FROM full_ n JOIN tok h ON {_same('h')} AND h.o = n.h JOIN tok u ON {_same('u')} AND u.head = h.head AND {_u('u')} IN ('nsubj', 'expl') GROUP BY ALL)
    {_row("'clitic'", 'h.b', 'n.e', [_role('Contraction_host', 'h.b', 'h.e'), _role('Contraction_clitic', 'n.b', 'n.e')], '''CASE WHEN n.lang = 'en' AND lower(h.form) = 'ca' AND lower(n.form) = 'n''t' THEN CASE WHEN h.form[1] <> lower(h.form[1]) THEN 'Cannot' ELSE 'cannot' END
      WHEN n.lang = 'en' AND lower(h.form) = 'ai' THEN CASE WHEN lower(u.lemma) = 'i' THEN 'am' WHEN lower(u.lemma) IN ('you', 'we', 'they') OR u.feats LIKE '%Number=Plur%' THEN 'are' ELSE 'is' END || ' ' || n.x
      WHEN n.lang = 'en' THEN CASE lower(h.form) WHEN 'ca' THEN 'can' WHEN 'wo' THEN 'will' WHEN 'sha' THEN 'shall' ELSE h.form END || ' ' || n.x ELSE h.form || ' ' || n.x END''')}
    FROM full_ n JOIN tok h ON {_same('h')} AND h.o = n.h LEFT JOIN subj z ON {_same('z')} AND z.o = n.o LEFT JOIN tok u ON {_same('u')} AND u.o = z.u WHERE n.x IS NOT NULL""")

PREP_ARTICLES = _whole(f"""{_row("'prep_article'", 'n.b', 'n.e', (), "n.form || ' ' || x.form")} FROM tok n JOIN tok x ON {_same('x')} AND x.o = n.o + 1 WHERE n.upos = 'ADP' AND x.upos = 'DET' AND (n.o + n.d + n.s) % 2 = 0""")

_bare = "lower(ltrim(n.form, ''''))"
_ein = "CASE " + " ".join(f"WHEN f.feats LIKE '%Gender={g}%' AND f.feats LIKE '%Case={c}%' THEN '{x}'" for (g, c), x in L.INDEFINITE_ARTICLE.items()) + " END"
_raw = f"CASE {_bare} WHEN 'nen' THEN 'einen' WHEN 'nem' THEN 'einem' WHEN 'ner' THEN 'einer' WHEN 'ne' THEN CASE WHEN f.upos IN ('NOUN', 'PROPN') THEN 'eine' END WHEN 'n' THEN CASE WHEN f.upos IN ('NOUN', 'PROPN') AND f.feats NOT LIKE '%Number=Plur%' THEN {_ein} END END"
CLIPPED_ARTICLES = _whole(f""", near AS (SELECT n.*, {_fol(['ADJ', 'ADV', 'DET', 'NUM', 'PRON'])} AS nxt FROM tok n WHERE n.lang = 'de' AND {_bare} IN ('nen', 'nem', 'ner', 'ne', 'n')), full_ AS (SELECT n.*, {_raw} AS x FROM near n LEFT JOIN tok f ON {_same('f')} AND f.o = n.nxt)
    {_row(f"CASE WHEN {_bare} = 'n' THEN 'clipped_article_inferred' ELSE 'clipped_article' END", 'n.b', 'n.e', (), "CASE WHEN ltrim(n.form, '''')[1] <> lower(ltrim(n.form, '''')[1]) THEN upper(n.x[1]) || n.x[2:] ELSE n.x END")} FROM full_ n WHERE n.x IS NOT NULL""")

# Folds over candidates are recursive here; look-around is spelled out over pieces of the text.


def _dropped(x: str) -> str:
    at = f"length({x})"
    return f"CASE WHEN {at} > 3 AND lower({x}) LIKE '%in''' AND regexp_full_match({x}[{at} - 3 : {at} - 3], '\\p{{L}}') THEN {x}[1 : {at} - 3] || CASE WHEN {x}[{at} - 2 : {at} - 1] = upper({x}[{at} - 2 : {at} - 1]) THEN 'ING' ELSE 'ing' END END"


_letter = "regexp_extract(n.surface, '\\p{L}')"
_clips = ", ".join("('" + k.replace("'", "''") + "', '" + v + "')" for k, v in L.CLIPPED_FORMS.items())
CLIPPED_FORMS = _whole(f""", clip(short, full_) AS (VALUES {_clips}),
    pairs AS (SELECT n.*, x.form AS nf, x.e AS ne, x.b = n.e AS near, n.form || x.form AS two, p.e AS pe FROM tok n LEFT JOIN tok x ON {_same('x')} AND x.o = n.o + 1 LEFT JOIN tok p ON {_same('p')} AND p.o = n.o - 1 WHERE n.lang = 'en'),
    known AS (SELECT n.*, c1.full_ AS k1, c2.full_ AS k2 FROM pairs n LEFT JOIN clip c1 ON c1.short = lower(n.form) LEFT JOIN clip c2 ON c2.short = lower(n.two)),
    cand AS (SELECT * FROM (SELECT *, CASE WHEN near THEN coalesce(k2, CASE WHEN nf = '''' AND upos IN ('VERB', 'AUX') THEN {_dropped('two')} END) END AS wide, coalesce(k1, {_dropped('form')}) AS single FROM known) WHERE wide IS NOT NULL OR single IS NOT NULL),
    walk AS (SELECT d, s, o, wide IS NOT NULL AS w, true AS kept FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand x WHERE {_same('x', 'c')} AND x.o = c.o - 1 AND x.wide IS NOT NULL)
      UNION ALL SELECT c.d, c.s, c.o, c.wide IS NOT NULL, NOT k.kept FROM walk k JOIN cand c ON {_same('c', 'k')} AND c.o = k.o + 1 WHERE k.w),
    told AS (SELECT c.*, coalesce(wide, single) AS x, CASE WHEN wide IS NOT NULL THEN two ELSE form END AS surface, CASE WHEN wide IS NOT NULL THEN ne ELSE e END AS upto FROM cand c JOIN walk k ON {_same('k', 'c')} AND k.o = c.o AND k.kept)
    {_row("'clipped_form'", 'n.b', 'n.upto', (), f"CASE WHEN n.pe = n.b THEN ' ' ELSE '' END || CASE WHEN n.o = 1 OR ({_letter} <> '' AND {_letter} <> lower({_letter})) THEN upper(n.x[1]) || n.x[2:] ELSE n.x END")} FROM told n""")

_verbal = lambda x: f"{x}.upos IN ('VERB', 'AUX')"
GAPPED = _whole(f""", deep AS (SELECT d, s, o, count(*) AS depth FROM anc GROUP BY ALL),
    conj AS (SELECT n.*, p.upos AS host FROM tok n JOIN tok p ON {_same('p')} AND p.o = n.head WHERE n.deprel = 'conj' AND NOT {_verbal('n')} AND n.lang IS NOT NULL),
    gaps AS (SELECT DISTINCT d, s, head AS o FROM tok WHERE deprel IN {_q(L.GAPPED_ARGUMENTS)}), many AS (SELECT d, s, head, count(*) AS k FROM conj GROUP BY ALL),
    cand AS (SELECT * FROM (SELECT n.*, CASE WHEN n.host IN ('VERB', 'AUX') THEN CASE WHEN g.o IS NOT NULL THEN 'C' END WHEN m.k >= 2 THEN 'A' WHEN g.o IS NOT NULL THEN 'B' END AS signal
      FROM conj n JOIN many m ON {_same('m')} AND m.head = n.head LEFT JOIN gaps g ON {_same('g')} AND g.o = n.o) WHERE signal IS NOT NULL),
    cover AS (SELECT c.d, c.s, c.o, c.signal, c.head, list(DISTINCT a.o) AS held FROM cand c JOIN conj h ON {_same('h', 'c')} AND h.head = c.head AND (c.signal = 'A' OR h.o = c.o) JOIN anc a ON {_same('a', 'c')} AND a.a = h.o GROUP BY ALL),
    nth AS (SELECT *, row_number() OVER (PARTITION BY d, s ORDER BY o) AS i FROM cover),
    fold AS (SELECT d, s, o, i, true AS kept, held AS seen FROM nth WHERE i = 1 UNION ALL SELECT n.d, n.s, n.o, n.i, NOT list_contains(f.seen, n.o), CASE WHEN list_contains(f.seen, n.o) THEN f.seen ELSE list_concat(f.seen, n.held) END FROM fold f JOIN nth n ON {_same('n', 'f')} AND n.i = f.i + 1),
    span AS (SELECT n.d, n.s, n.o, n.signal, n.head, min(t.b) AS b, max(t.e) AS e FROM nth n JOIN fold f ON {_same('f')} AND f.o = n.o AND f.kept JOIN tok t ON {_same('t')} AND list_contains(n.held, t.o) AND t.upos <> 'PUNCT' GROUP BY ALL),
    cops AS (SELECT d, s, head, min(o) AS o FROM tok k WHERE deprel = 'cop' AND {_verbal('k')} GROUP BY ALL),
    steps AS (SELECT n.d, n.s, n.o, CASE WHEN {_verbal('p')} THEN p.o ELSE c.o END AS v, z.depth FROM span n JOIN anc a ON {_same('a')} AND a.o = n.head JOIN tok p ON {_same('p')} AND p.o = a.a JOIN deep z ON {_same('z')} AND z.o = p.o LEFT JOIN cops c ON {_same('c')} AND c.head = p.o),
    verb AS (SELECT d, s, o, arg_min(v, depth) AS v FROM steps WHERE v IS NOT NULL GROUP BY ALL)
    {_row('n.signal', 'n.b', 'n.e', [_role('GappedAntecedent', 'v.b', 'v.e')])} FROM span n JOIN verb w ON {_same('w')} AND w.o = n.o JOIN tok v ON {_same('v')} AND v.o = w.v""")

_texts = "texts AS (SELECT d, s, any_value(lang) AS lang, string_agg(CASE WHEN o > 1 AND NOT glue THEN ' ' ELSE '' END || form, '' ORDER BY o) AS t FROM tok GROUP BY d, s)"
_word = r"\p{L}\p{M}\p{Nd}\p{Pc}"


def _pieces(where: str, pattern: str, source: str = "texts") -> str:
    """A sentence's text cut into runs of some characters and what is between them, with places and neighbours."""
    return f"""SELECT d, s, lang, i, p, sum(length(p)) OVER w - length(p) AS pos, lag(p) OVER w AS before, lead(p) OVER w AS behind, lead(p, 2) OVER w AS then_
        FROM (SELECT d, s, lang, unnest(x) AS p, generate_subscripts(x, 1) AS i FROM (SELECT d, s, lang, regexp_extract_all(t, '{pattern}') AS x FROM {source} WHERE {where})) WINDOW w AS (PARTITION BY d, s ORDER BY i)"""


_stub = f"regexp_full_match(p, '[{_word}.]+') AND regexp_matches(p, '[{_word}]') AND (before IS NULL OR before <> '-' OR p[1] = '.') AND behind = '-' AND (then_ IS NULL OR regexp_matches(then_, '^[\\s\\p{{Z}},;]'))"
SUSPENDED = _whole(f""", {_texts}, piece AS ({_pieces("t LIKE '%-%' AND lang IN " + _q(L.COORDINATORS), f"[{_word}.]+|[^{_word}.]")}),
    stub AS (SELECT d, s, 'shared_head' AS way, pos + length(p) - length(ltrim(p, '.')) AS b, pos + length(p) + 1 AS e FROM piece WHERE {_stub}
      UNION ALL SELECT d, s, 'shared_modifier', pos, pos + 1 + length(behind) FROM piece WHERE p = '-' AND (before IS NULL OR (before <> '-' AND NOT regexp_matches(before, '[{_word}]$'))) AND regexp_matches(behind, '^[{_word}]')),
    hit AS (SELECT x.d, x.s, x.way, x.b AS pos, min(t.o) AS o, min(t.b) AS b, max(t.e) AS e FROM stub x JOIN tok t ON {_same('t', 'x')} AND t.b < x.e AND t.e > x.b GROUP BY ALL)
    {_row('n.way', 'n.b', 'n.e')} FROM hit n""")

_caps = "[A-ZÄÖÜ]{2,6}"
_gloss = rf"\p{{L}}{{3,}}[^()]{{0,40}}?[\s\p{{Z}}]*\([\s\p{{Z}}]*{_caps}[\s\p{{Z}}]*\)"
ABBREVIATION = _whole(f""", {_texts}, loud AS (SELECT d, s FROM (SELECT d, s, count_if(w) AS alpha, count_if(w AND length(form) > 1 AND form = upper(form) AND form <> lower(form)) AS caps FROM (SELECT *, regexp_full_match(form, '\\p{{L}}+') AS w FROM tok) GROUP BY ALL) WHERE alpha >= 10 AND caps / alpha > 0.3),
    quiet AS (SELECT * FROM texts x WHERE regexp_matches(t, '[A-ZÄÖÜ][A-ZÄÖÜ]') AND NOT EXISTS (SELECT 1 FROM loud WHERE {_same('loud', 'x')})),
    piece AS ({_pieces("true", f"[{_word}]+|[^{_word}]+", "quiet")}),
    caps AS (SELECT d, s, p, pos, coalesce(lag(pos + length(p)) OVER (PARTITION BY d, s ORDER BY pos), -1) AS upto, row_number() OVER (PARTITION BY d, s, p ORDER BY pos) AS nth FROM piece WHERE regexp_full_match(p, '{_caps}')),
    runs AS (SELECT c.*, sum(CASE WHEN upto < 0 OR NOT regexp_full_match(substr(x.t, CAST(upto + 1 AS BIGINT), CAST(pos - upto AS BIGINT)), '[\\s\\-–—,;:/·.()\\[\\]]*') THEN 1 ELSE 0 END) OVER (PARTITION BY c.d, c.s ORDER BY pos) AS run FROM caps c JOIN texts x ON {_same('x', 'c')}),
    listed AS (SELECT *, count(*) OVER (PARTITION BY d, s, run) >= 3 AS many FROM runs),
    spans AS (SELECT d, s, unnest(hits) AS m, unnest(string_split_regex(t, '{_gloss}')[:len(hits)]) AS g, generate_subscripts(hits, 1) AS i FROM (SELECT *, regexp_extract_all(t, '{_gloss}') AS hits FROM quiet) WHERE len(hits) > 0),
    glossed AS (SELECT d, s, sum(length(g) + length(m)) OVER (PARTITION BY d, s ORDER BY i) - length(regexp_extract(m, '{_caps}[\\s\\p{{Z}}]*\\)$')) AS pos FROM spans),
    cand AS (SELECT n.*, row_number() OVER (PARTITION BY n.d, n.s, n.form ORDER BY n.o) AS nth FROM tok n JOIN quiet x ON {_same('x')} WHERE regexp_full_match(n.form, '{_caps}') AND NOT coalesce({_in(L.FUNCTION_WORDS, 'lower(n.form)')}, false))
    {_row("CASE WHEN g.pos IS NOT NULL THEN 'abbreviation_defined' ELSE 'abbreviation' END", 'n.b', 'n.e')} FROM cand n LEFT JOIN listed f ON {_same('f')} AND f.p = n.form AND f.nth = n.nth LEFT JOIN (SELECT DISTINCT d, s, pos FROM glossed) g ON {_same('g')} AND g.pos = f.pos WHERE NOT coalesce(f.many, false)""")

DETECTOR_SQL = {
    "det_gapped_coordination": GAPPED,
    "det_abbreviation": ABBREVIATION,
    "det_suspended_composition": SUSPENDED,
    "contraction_clipped_form": CLIPPED_FORMS,
    "det_sluicing": SLUICING,
    "det_subject_sharing": SUBJECT_SHARING,
    "det_verbal_ellipsis": VERBAL_ELLIPSIS,
    "det_passive": PASSIVE,
    "det_passive_phrases": PASSIVE_PHRASES,
    "det_nominal_ellipsis_en": NOMINAL_EN,
    "det_nominal_ellipsis_de": NOMINAL_DE,
    "det_clefts": CLEFTS,
    "det_bare_questions": BARE_QUESTIONS,
    "det_right_node_raising": RIGHT_NODE,
    "contraction_clitic": CLITICS,
    "contraction_prep_article": PREP_ARTICLES,
    "contraction_clipped_article": CLIPPED_ARTICLES,
}
