"""Text functions of the front ends: cleaning, tag maps, model names, token offsets, sentence cuts, lexicon rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lexicon as L


def clean(text: Column) -> Column:
    """Control characters go first (so words on both sides of a line break fuse), then white space runs become one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\p{Cc}", ""), r"(?U)\s+", " "))


def penn_to_universal(tag: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in L.PENN_TO_UPOS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, tag), F.lit("X"))


def penn_to_wordnet(tag: Column) -> Column:
    return F.when(tag.startswith("V"), "v").when(tag.startswith("J"), "a").when(tag.startswith("RB"), "r").otherwise("n")


def model_name(language: Column, size: Column, custom: Column) -> Column:
    """A parser model's name; raises for a language or size that isn't known (unless the name is given)."""
    base = F.when(language.isin(L.WEB_MODELS), F.concat(language, F.lit("_core_web"))).when(language.isin(L.NEWS_MODELS), F.concat(language, F.lit("_core_news")))
    chosen = F.coalesce(size, F.lit("md"))
    built = F.when(base.isNull(), F.raise_error(F.concat(F.lit("language not supported: "), F.coalesce(language, F.lit("null"))))).when(~chosen.isin(L.MODEL_SIZES), F.raise_error(F.concat(F.lit("size not valid: "), chosen))).otherwise(F.concat(base, F.lit("_"), chosen))
    return F.coalesce(custom, built)


def token_offsets(tokens: str, text: str) -> Column:
    """Begin and end of each token, found from left to right; one that isn't there stands empty at the cursor."""
    return F.expr(f"""aggregate({tokens}, named_struct('at', 0, 'out', cast(array() AS array<struct<begin:int,end:int>>)),
        (acc, tok_) -> if(locate(tok_, {text}, acc.at + 1) = 0 AND tok_ <> '', named_struct('at', acc.at, 'out', array_append(acc.out, named_struct('begin', acc.at, 'end', acc.at))),
            named_struct('at', greatest(locate(tok_, {text}, acc.at + 1) - 1, acc.at) + length(tok_), 'out', array_append(acc.out, named_struct('begin', greatest(locate(tok_, {text}, acc.at + 1) - 1, acc.at), 'end', greatest(locate(tok_, {text}, acc.at + 1) - 1, acc.at) + length(tok_)))))).out""")


def sentence_offsets(sentences: str, text: str) -> Column:
    """Begin and end of each sentence, found from left to right; one that isn't there is left out."""
    at = f"locate(sent_, {text}, acc.at + 1)"
    return F.expr(f"""aggregate({sentences}, named_struct('at', 0, 'out', cast(array() AS array<struct<begin:int,end:int>>)),
        (acc, sent_) -> if(sent_ = '' OR {at} = 0, acc, named_struct('at', {at} - 1 + length(sent_), 'out', array_append(acc.out, named_struct('begin', {at} - 1, 'end', {at} - 1 + length(sent_)))))).out""")


#: Abbreviations, by language, that end in a mark without ending a sentence.
ABBREVIATED = {
    "en": ["Mr", "Mrs", "Ms", "Dr", "Prof", "St", "vs", "etc", "e.g", "i.e", "cf", "No", "Fig", "approx"],
    "de": ["Dr", "Prof", "Hr", "Fr", "bzw", "usw", "ca", "z.B", "d.h", "u.a", "Nr", "Abb", "vgl", "evtl"],
    "fr": ["M", "Mme", "Mlle", "Dr", "etc", "p.ex", "cf", "env", "n°", "fig"],
    "es": ["Sr", "Sra", "Srta", "Dr", "Dra", "etc", "p.ej", "Ud", "Uds", "núm", "fig"],
}


def split_sentences(text: Column, lang: Column | None = None) -> Column:
    """Sentences of a text, one a line: cut behind closing marks that white space follows, but not behind an abbreviation of the language or
    a number at a line's begin."""
    plain = r"(?U)(?<=[.!?])\s+(?=\S)"
    if lang is None:
        return F.regexp_replace(text, plain, "\n")
    out = None
    for language, short in ABBREVIATED.items():
        held = "|".join(x.replace(".", r"\.") for x in short)
        cut = F.regexp_replace(text, rf"(?U)(?<=[.!?])(?<!(?<![\w.])(?:{held})\.)(?<!^\d{{1,3}}\.)\s+(?=\S)", "\n")
        out = F.when(lang == language, cut) if out is None else out.when(lang == language, cut)
    return out.otherwise(F.regexp_replace(text, plain, "\n"))


#: Frequent words, by language, that the others don't have.
TELLING = {
    "en": "the and of to that is was for with this are not have you which been they would their".split(),
    "de": "der und das nicht ist ein mit sich auf dem eine auch wird von zu für werden haben oder".split(),
    "fr": "le les et des est une dans qui pour pas que sur avec sont ce cette mais nous vous".split(),
    "es": "el los y las del es una por con para como más pero sus este esta fue ser han".split(),
}


def language_of(text: Column) -> Column:
    """struct(language, confidence): the language whose telling words a text has most of, and their share among all telling words; null without any."""
    words = F.split(F.lower(text), r"(?U)[^\p{L}]+")

    def telling(own: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(own)))

    counts = {k: telling(v) for k, v in sorted(TELLING.items())}
    best, total = F.array_max(F.array(*[F.struct(n.alias("n"), F.lit(k).alias("language")) for k, n in counts.items()])), sum(counts.values(), F.lit(0))
    return F.when(total > 0, F.struct(best["language"].alias("language"), (best["n"] / total).alias("confidence")))


def detect_language(text: Column, least: float = 0.7) -> Column:
    """The language of a text where it is sure enough; null for blank ones."""
    found = language_of(text)
    return F.when(found["confidence"] >= least, found["language"])


def match_case(suggestion: Column, original: Column) -> Column:
    """Takes over a leading capital."""
    first = F.substring(original, 1, 1)
    return F.when((first == F.upper(first)) & (first != F.lower(first)), F.concat(F.upper(F.substring(suggestion, 1, 1)), F.substring(suggestion, 2, 1 << 30))).otherwise(suggestion)


def is_cluster_id(value: Column) -> Column:
    """Whether a value reads as a number."""
    return value.try_cast("int").isNotNull()


def substitutable_part(long_form: Column) -> Column:
    """What stands before a gloss separator."""
    text = F.trim(F.coalesce(long_form, F.lit("")))
    head = F.trim(F.split_part(text, F.lit("||"), F.lit(1)))
    return F.when(head == "", text).otherwise(head)


def is_substitutable(long_form: Column) -> Column:
    part = substitutable_part(long_form)
    return (part != "") & ~part.startswith("(") & ~part.rlike("(?i)" + L.GLOSS) & (F.size(F.split(part, r"(?U)\s+")) <= 6)


def lexicalised(text: Column) -> Column:
    """English abbreviations of the closed list in a text, in order."""
    forms = "|".join(sorted((x.replace(".", r"\.") for x in L.LEXICALISED), key=len, reverse=True))
    return F.regexp_extract_all(text, F.lit(rf"(?iU)(?<![\w.])({forms})"), F.lit(1))


def lexicalised_expansion(form: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in L.LEXICALISED.items() for x in pair])
    return match_case(F.try_element_at(table, F.lower(form)), form)


def is_function_word(lang: Column, lower: Column) -> Column:
    known = F.lit(False)
    for language, words in L.FUNCTION_WORDS.items():
        known = known | ((lang == language) & lower.isin(words))
    return F.coalesce(known, F.lit(False))


def is_emphasis(lang: Column, form: Column, evidence: Column, strong: Column, wordlike: Column) -> Column:
    """Whether an all-caps form is shouted rather than an abbreviation; ``wordlike``: an ordinary English word (see ``derivable``)."""
    return F.when(is_function_word(lang, F.lower(form)), ~strong).when(evidence | strong, False).when(F.coalesce(lang, F.lit("")) != "en", False).otherwise(wordlike)


def caps_suppressed(words: Column) -> Column:
    """Whether capitals mean nothing: of ten words or more, over 30 % are in capitals."""
    alpha = F.filter(words, lambda w: w.rlike(r"^\p{L}+$"))
    caps = F.filter(alpha, lambda w: (F.length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w)))
    return (F.size(alpha) >= 10) & (F.size(caps) / F.size(alpha) > 0.3)


def lexicalised_prep_article(surface: Column, following: Column) -> Column:
    known = F.lit(False)
    for a, b in L.LEXICALISED_PREP_ARTICLES:
        known = known | ((F.lower(surface) == a) & (F.lower(following) == b))
    return F.coalesce(known, F.lit(False))


def particle_lengths(word: str) -> Column:
    """Lengths of the German verb particles that a word begins with, in the list's order."""
    # spelled out without a lambda, so that it is compiled and the word put into lower case once
    each = ", ".join(f"if(startswith(lower({word}), '{p}') AND {len(p)} < length({word}), {len(p)}, 0)" for p in L.VERB_PARTICLES_DE)
    return F.expr(f"array_remove(array({each}), 0)")


def stems(word: str) -> str:
    """SQL for all that a word may reduce to by one affix, with spelling undone where a suffix leaves nothing in its place."""
    out = []
    for suffix, ends in L.SUFFIXES:
        base = f"substring({word}, 1, length({word}) - {len(suffix)})"
        found = []
        for end in ends:
            if end:
                found.append(f"concat({base}, '{end}')")
            else:
                found += [base, f"if(length({base}) >= 2 AND substring({base}, -1, 1) = substring({base}, -2, 1), substring({base}, 1, length({base}) - 1), null)", f"if(endswith({base}, 'i'), concat(substring({base}, 1, length({base}) - 1), 'y'), null)", f"if(endswith({base}, 'ck'), substring({base}, 1, length({base}) - 1), null)"]
        out.append(f"if(endswith({word}, '{suffix}') AND length({word}) - {len(suffix)} >= 3, array({', '.join(found)}), array())")
    out += [f"if(startswith({word}, '{p}') AND length({word}) - {len(p)} >= 3, array(substring({word}, {len(p) + 1})), array())" for p in L.PREFIXES]
    return f"filter(array_distinct(concat({', '.join(out)})), x -> x IS NOT NULL AND length(x) >= 3)"


def knows(words: DataFrame, wordlist: DataFrame) -> DataFrame:
    """Of (word), those that the list (word) has, in any case."""
    return words.select("word").distinct().withColumn("__w", F.lower("word")).join(wordlist.select(F.lower("word").alias("__w")).distinct(), "__w", "left_semi").select("word")


def derivable(words: DataFrame, wordlist: DataFrame, *, depth: int = 3, _parts: bool = False) -> DataFrame:
    """Of (word), those that the list (word) has, or that reduce to one of it by at most ``depth`` affixes.

    Affixes are peeled off distinct words level by level and semi-joined with the list; so each word is worked on once
    whatever the corpus repeats.  A word with hyphens counts if each of its parts does, or is a prefix.
    """
    if not _parts:
        parts = words.select("word", F.explode(F.filter(F.split(F.lower("word"), "-"), lambda p: p != "")).alias("part")).filter("word LIKE '%-%'")
        good = derivable(parts.select(F.col("part").alias("word")).distinct(), wordlist, depth=depth, _parts=True).select(F.col("word").alias("part"), F.lit(True).alias("ok"))
        joined = parts.join(good, "part", "left").groupBy("word").agg(F.every(F.coalesce("ok", F.col("part").isin(L.PREFIXES))).alias("all")).filter("all").select("word")
        return derivable(words, wordlist, depth=depth, _parts=True).unionByName(joined).distinct()
    known = wordlist.select(F.lower("word").alias("stem")).distinct()
    level = words.select(F.col("word"), F.lower("word").alias("stem")).filter("stem <> ''").distinct()
    found = None
    for i in range(depth + 1):
        hit = level.join(known, "stem", "left_semi").select("word")
        found = hit if found is None else found.unionByName(hit)
        if i < depth:
            level = level.select("word", F.explode(F.expr(stems("stem"))).alias("stem")).distinct()
    return found.distinct()
