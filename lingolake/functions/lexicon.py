"""Word lists, tag sets and patterns of the detectors, by language."""

from __future__ import annotations

# What the detectors are defined by.

WH_WORDS = {
    "en": "who what why when how whose where".split(),
    "de": """wer wen wem wessen was wann warum wieso weshalb wie wo woher wohin welcher welche welches welchem welchen
        wozu wodurch womit wofür woran worauf worüber wovon wonach worin wobei worum wovor wogegen woraus""".split(),
    "fr": "qui que quoi pourquoi quand comment où quel quelle quels quelles".split(),
    "es": "quién quiénes qué cuándo cómo dónde cuál cuáles cuyo cuya cuyos cuyas".split(),
}
EMBEDDING_PREDICATES = {
    "de": """abfragen abklären ablesen abstimmen abwägen ahnen auslosen befragen bestimmen entscheiden erfahren erinnern
        erklären erörtern festlegen fragen herausfinden klären melden mitteilen nachvollziehen raten sagen vergessen
        verraten verstehen weiss wissen witttern zeigen überlegen""".split(),
    "en": "decide tell weigh settle determine remember explain deliberate ask report understand disclose know show".split(),
}
EMBEDDING_NOUNS = {
    "de": "ahnung frage grund erklärung entscheidung idee".split(),
    "en": "clue guess idea question reason explanation".split(),
}
AGENT_PREPOSITIONS = {"en": ["by"], "de": ["von", "durch", "vom"], "fr": ["par"], "es": ["por"]}
PARTICIPLE_XPOS = {"en": ["VBN"], "de": ["VVPP"]}
SUBJECTS = ["nsubj", "csubj", "nsubj:pass"]
SLUICE_RELATIONS = ["obj", "iobj", "obl", "conj", "advmod", "mark", "appos"]
EMBEDDED_VERBS = ["ccomp", "xcomp", "acl", "acl:relcl", "csubj"]
AUXILIARY_RELATIONS = ["aux", "aux:pass", "cop"]
STRANDED_LEMMAS = ["wollen", "können", "dürfen", "müssen", "sollen", "mögen", "do", "have"]
NOMINAL_RELATIONS = ["nsubj", "nsubj:pass", "obj", "iobj", "nmod"]
QUANTIFIERS = ["many", "several", "few"]
MODIFIER_RELATIONS = "det amod nummod case advmod compound flat fixed cc mark punct aux cop expl".split()
DEFINITE_ARTICLES_DE = "der die das dem den des".split()
INHERENT_PRONOUNS_DE = """nichts etwas alles man jemand niemand wer was irgendwer irgendwas irgendetwas irgendjemand
    niemanden wen irgendjemanden irgendjemandem""".split()
SUPERLATIVE_ENDINGS_DE = ["ste", "sten", "stes", "stem", "ster"]
GAPPED_ARGUMENTS = ["nsubj", "csubj", "nsubj:pass", "appos", "nmod", "flat"]
PREDICATE_TAGS = ["VERB", "AUX", "ADJ"]
CORE_ARGUMENTS = ["obj", "iobj", "obl", "xcomp", "ccomp"]

CLITICS = {"en": ["n't", "'m", "'re", "'ve", "'ll", "'s", "'d"], "de": ["'s"]}
CLITIC_EXPANSIONS = {
    "en": {("n't", "not"): "not", ("'m", "be"): "am", ("'re", "be"): "are", ("'ve", "have"): "have", ("'ll", "will"): "will", ("'s", "be"): "is", ("'s", "have"): "has", ("'s", "we"): "us", ("'s", "us"): "us", ("'d", "would"): "would", ("'d", "have"): "had"},
    "de": {("'s", "es"): "es"},
}
HOSTS = {"ca": "can", "wo": "will", "sha": "shall"}
CLIPPED_ARTICLES = {"nen": "einen", "nem": "einem", "ner": "einer", "ne": "eine"}
INDEFINITE_ARTICLE = {
    ("Masc", "Nom"): "ein", ("Masc", "Acc"): "einen", ("Masc", "Dat"): "einem", ("Masc", "Gen"): "eines",
    ("Neut", "Nom"): "ein", ("Neut", "Acc"): "ein", ("Neut", "Dat"): "einem", ("Neut", "Gen"): "eines",
    ("Fem", "Nom"): "eine", ("Fem", "Acc"): "eine", ("Fem", "Dat"): "einer", ("Fem", "Gen"): "einer",
}
CLIPPED_FORMS = {
    "kinda": "kind of", "sorta": "sort of", "typa": "type of", "lotsa": "lots of", "outta": "out of", "hella": "hell of",
    "gonna": "going to", "wanna": "want to", "gotta": "have got to", "hafta": "have to", "tryna": "trying to",
    "shoulda": "should have", "coulda": "could have", "woulda": "would have", "musta": "must have", "lemme": "let me",
    "gimme": "give me", "dunno": "do not know", "iunno": "I do not know", "wassup": "what is up", "innit": "is it not",
    "init": "is it not", "twas": "it was", "'twas": "it was", "ima": "I am", "y'all": "you all", "ma'am": "madam",
    "'em": "them", "ol'": "old", "a'ight": "alright", "cuz": "because", "'cause": "because", "coz": "because",
    "shouldnay": "should not", "couldnay": "could not", "cannae": "cannot", "dinnae": "do not",
}
LEXICALISED_PREP_ARTICLES = [("zum", "beispiel"), ("zum", "glück"), ("zum", "teil"), ("im", "allgemeinen"), ("im", "grunde"), ("im", "falle"), ("am", "besten"), ("am", "ehesten"), ("am", "meisten")]

FUNCTION_WORDS = {
    "de": """ab aber all alle als also am an auch auf aus bei beim bis da damit dann das dass dem den denn der des die dies
        diese doch dort du durch ein eine er es etwa für gegen hat hier ich ihr im in ist ja je kein man mehr mit nach
        nicht noch nun nur ob oder ohne schon sehr sein sie so sind über um und uns unter vom von vor war was weil wenn
        wer wie wir wo zu zum zur""".split(),
    "en": """a all an and are as at be but by for from he her his if in into is it its no not of on or our out she so than
        that the their then there they this to up us was we were what when which who with you your""".split(),
}
LEXICALISED = {"e.g.": "for example", "i.e.": "that is", "vs.": "versus", "vs": "versus", "cf.": "compare", "w/o": "without", "w/": "with"}
# Patterns.
CANDIDATE = "[A-ZÄÖÜ]{2,6}"
GLOSS = "Abkürzung für|steht für|Kurzwort für|kurz für|Kurzform|bezeichnet|Netzjargon|Unterscheidungszeichen|Kfz-Kennzeichen|Kraftfahrzeugkennzeichen|offizielle Abkürzung|ohne Plural|abbreviation of|initialism of|short for|:"
GLOSS_CONTEXT = r"[^\W\d_]{3,}[^()]{0,40}?\s*\(\s*([A-ZÄÖÜ]{2,6})\s*\)"
ENUM_SEPARATOR = r"^[\s\-–—,;:/·.()\[\]]*$"
STUB = r"(?<![\w-])([\w][\w.]*?)-(?=\s|$|[,;])"
LEAD_STUB = r"(?<![\w-])-([\w][\w.]*)"
COORDINATORS = {"de": ["und", "oder", "bzw.", "beziehungsweise", "sowie", "wie", "als", "aber", "&", "/"], "en": ["and", "or", "&", "/"]}
VERB_PARTICLES_DE = """gegenüber zusammen zurecht zurück hinunter herunter hinüber herüber hervor herein heraus herbei herab
    heran herauf hinein hinaus hinauf hinab entgegen voraus vorbei vorüber voran weiter wieder nieder empor durch hinter
    unter über gegen auf aus ein fort mit nach vor weg zu los her hin ab an bei da dar um miss wider zer ent ver be er
    ge emp""".split()

# Affixes, and what may stand in their place.
SUFFIXES = [
    ("ability", ["able", ""]), ("ibility", ["ible", ""]), ("ization", ["ize", ""]), ("isation", ["ise", ""]), ("ational", ["ate", ""]),
    ("fulness", ["ful", ""]), ("lessness", ["less", ""]), ("ousness", ["ous", ""]), ("iveness", ["ive", ""]), ("ation", ["ate", "e", ""]),
    ("ition", ["ite", "e", ""]), ("ement", ["e", ""]), ("ment", ["e", ""]), ("ness", ["", "y"]), ("less", [""]), ("able", ["e", ""]),
    ("ible", ["e", ""]), ("tion", ["te", "t", ""]), ("sion", ["de", "d", ""]), ("ance", ["e", ""]), ("ence", ["e", ""]), ("ancy", ["ant", ""]),
    ("ency", ["ent", ""]), ("ship", [""]), ("hood", [""]), ("wise", [""]), ("ward", [""]), ("ised", ["ise", ""]), ("ized", ["ize", ""]),
    ("ings", ["e", ""]), ("ful", [""]), ("ist", ["e", ""]), ("ism", ["e", ""]), ("ion", ["e", ""]), ("ity", ["e", ""]), ("ive", ["e", ""]),
    ("ous", ["e", ""]), ("ise", ["", "y"]), ("ize", ["", "y"]), ("ify", ["", "y"]), ("ing", ["e", ""]), ("est", ["e", ""]), ("ers", ["e", ""]),
    ("ory", ["e", ""]), ("ary", ["e", ""]), ("ial", ["", "y"]), ("al", ["e", ""]), ("ly", ["", "le"]), ("er", ["e", ""]), ("or", ["e", ""]),
    ("ed", ["e", ""]), ("es", ["e", ""]), ("s", [""]), ("y", ["e", ""]),
]
PREFIXES = "pseudo counter inter intra super trans under multi over semi anti auto micro macro post pre sub non mis dis out up un re de in im co".split()

PENN_TO_UPOS = {
    "NN": "NOUN", "NNS": "NOUN", "NNP": "NOUN", "NNPS": "NOUN", "VB": "VERB", "VBD": "VERB", "VBG": "VERB", "VBN": "VERB",
    "VBP": "VERB", "VBZ": "VERB", "JJ": "ADJ", "JJR": "ADJ", "JJS": "ADJ", "RB": "ADV", "RBR": "ADV", "RBS": "ADV",
    "DT": "DET", "PDT": "DET", "WDT": "DET", "PRP": "PRON", "PRP$": "PRON", "WP": "PRON", "WP$": "PRON", "IN": "ADP",
    "CC": "CONJ", "CD": "NUM", "RP": "PRT", "UH": "INTJ", "SYM": "SYM", "FW": "X", ".": "PUNCT", ",": "PUNCT", ":": "PUNCT",
    "-LRB-": "PUNCT", "-RRB-": "PUNCT", "''": "PUNCT", "``": "PUNCT", "-": "PUNCT",
}
WEB_MODELS = "en zh".split()
NEWS_MODELS = "ca da de el es fi fr hr it ja ko lt mk nb nl pl pt ro ru sl sv uk".split()
MODEL_SIZES = "sm md lg".split()


class UnsupportedLanguage(ValueError):
    """A language that a list doesn't cover."""


def words_for(table: dict, lang: str) -> list[str]:
    """A list for a language; one that the table lacks is an error."""
    if lang not in table:
        raise UnsupportedLanguage(f"no words for {lang!r}; there are some for {', '.join(sorted(table))}")
    return table[lang]


def sql(values) -> str:
    """A list of strings, or a map of strings, as a SQL literal."""
    quote = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(values, dict):
        return "map(" + ", ".join(f"{quote(k)}, {quote(v)}" for k, v in values.items()) + ")"
    return "array(" + ", ".join(map(quote, values)) + ")"


def by_language(table: dict[str, list[str]], column: str = "lang") -> str:
    """SQL for the list of the row's language (empty for others)."""
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {sql(v)}" for k, v in table.items()) + " ELSE cast(array() AS array<string>) END"
