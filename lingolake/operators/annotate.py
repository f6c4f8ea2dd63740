"""The registry of detectors, their annotations, language routing, and what a second run does."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import _parse_datatype_string

from . import detectors
from .trees import SENTENCES


@dataclass(frozen=True)
class Detector:
    """``category``: SQL for the anomaly's category (null: none is written); the rest tells the annotations of an earlier run."""

    detect: Callable[[DataFrame], DataFrame]
    category: str | None
    description: str = "'Ellipsis'"
    categories: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    languages: tuple[str, ...] = ()


REGISTRY: dict[str, Detector] = {
    "sluicing": Detector(detectors.sluicing, "'sluicing'", categories=("sluicing",), labels=("QEmbedder",), languages=("en", "de")),
    "subject_sharing": Detector(detectors.subject_sharing, "'right_conj_subject'", categories=("right_conj_subject",), labels=("Shared_subject",), languages=("en", "de")),
    "verbal_ellipsis": Detector(detectors.verbal_ellipsis, "'auxiliary'", categories=("auxiliary",), languages=("en", "de")),
    "passive": Detector(detectors.passive, None, labels=("Passive_verb", "Passive_aux", "Passive_subject", "Passive_agent", "Passive_agent_marker"), languages=("en", "de")),
    "nominal_ellipsis": Detector(detectors.nominal_ellipsis, "concat('nominal_head_', subtype)", prefixes=("nominal_head_",), languages=("en", "de")),
    "clefts": Detector(detectors.clefts, None, labels=("Cleft_focus", "Cleft_presupposition", "Cleft_it", "Cleft_wh"), languages=("en",)),
    "bare_questions": Detector(detectors.bare_questions, "'bare_wh'", categories=("bare_wh",), languages=("en", "de")),
    "gapped_coordination": Detector(detectors.gapped_coordination, "'gapped_coordination'", categories=("gapped_coordination",), labels=("GappedAntecedent",), languages=("en", "de")),
    "right_node_raising": Detector(detectors.right_node_raising, "'right_node_raising'", categories=("right_node_raising",), labels=("RNR_left_predicate", "RNR_right_predicate", "RNR_shared_arg"), languages=("en",)),
    "abbreviation": Detector(detectors.abbreviation, "subtype", "'Abbreviation'", categories=("abbreviation", "abbreviation_defined"), languages=("en", "de")),
    "contraction": Detector(detectors.contraction, "'contraction'", "'Contraction'", categories=("contraction",), labels=("Contraction_host", "Contraction_clitic")),
    "suspended_composition": Detector(detectors.suspended_composition, "if(suggestion IS NULL, 'suspended_composition_unresolved', 'suspended_composition')", "concat('Suspended composition (', replace(subtype, '_', ' '), ')')", categories=("suspended_composition", "suspended_composition_unresolved"), labels=("Suspension_donor",), languages=("de",)),
}
ANNOTATION = ["doc_id", "view", "sent_id", "phenomenon", "kind", "begin", "end", "description", "category", "label", "suggestion", "certainty"]


def annotations(findings: DataFrame, phenomenon: str) -> DataFrame:
    """Findings as stand-off annotations: a GrammarAnomaly for each (if the detector writes one), a LexicalPhrase for each role."""
    spec = REGISTRY[phenomenon]
    base = ["doc_id", "view", "sent_id", F.lit(phenomenon).alias("phenomenon")]
    if not spec.labels:
        return _anomalies(findings, spec, base)
    if spec.category is None:
        return findings.select(*base, F.explode(F.expr(f"transform(roles, r -> {_PHRASE})")).alias("a")).select("doc_id", "view", "sent_id", "phenomenon", "a.*")
    # both kinds of one finding from one row: findings are worked out once
    anomaly = ", ".join(f"'{c}', {c}" for c in ANNOTATION[4:])
    rows = _anomalies(findings, spec, base, "roles")
    return rows.select("doc_id", "view", "sent_id", "phenomenon", F.explode(F.expr(f"concat(array(named_struct({anomaly})), transform(roles, r -> {_PHRASE}))")).alias("a")).select("doc_id", "view", "sent_id", "phenomenon", "a.*")


_PHRASE = """named_struct('kind', 'LexicalPhrase', 'begin', r.begin, 'end', r.end, 'description', cast(null AS string), 'category', cast(null AS string), 'label', r.label, 'suggestion', cast(null AS string), 'certainty', cast(null AS double))"""


def _anomalies(findings: DataFrame, spec: Detector, base: list, *more: str) -> DataFrame:
    certainty = F.when(F.col("suggestion").isNotNull(), F.coalesce(F.expr("try_cast(more['certainty'] AS double)"), F.lit(1.0)))
    return findings.select(*base, F.lit("GrammarAnomaly").alias("kind"), "begin", "end", F.expr(spec.description).alias("description"), F.expr(spec.category).alias("category"), F.lit(None).cast("string").alias("label"), "suggestion", certainty.alias("certainty"), *more)


def routed(sentences: DataFrame, *, lang: str | None = None, mixed: bool = False, detected: Column | None = None, document: Column | None = None) -> DataFrame:
    """Sentences with the language that detectors are to take.

    A given language holds for all, unless the view is mixed: then each sentence's own (``detected``) counts, and only those
    of the given language stay.  Without one, a mixed view takes each sentence's own, any other the document's.
    """
    detected = F.col("lang") if detected is None else detected
    document = F.col("lang") if document is None else document
    if lang is None:
        return sentences.withColumn("lang", detected if mixed else document)
    return sentences.withColumn("lang", detected).filter(F.col("lang") == lang) if mixed else sentences.withColumn("lang", F.lit(lang))


def confident(language: Column, confidence: Column, least: float = 0.7) -> Column:
    """A classifier's language where it is sure enough."""
    return F.when(confidence >= least, language)


def detect(sentences: DataFrame, phenomenon: str, *, lang: str | None = None, mixed: bool = False, **options) -> DataFrame:
    """Annotations of a detector; ``options`` are its own (``expansions``, ``resolved``, ``phrases``)."""
    if phenomenon not in REGISTRY:
        raise ValueError(f"unknown phenomenon {phenomenon!r}; known: {', '.join(sorted(REGISTRY))}")
    return annotations(REGISTRY[phenomenon].detect(routed(sentences, lang=lang, mixed=mixed), **options), phenomenon)


class Unsupported(ValueError):
    """A language or a schema that an annotator can't work on."""


def checked(sentences: DataFrame, phenomenon: str, lang: str, **options) -> DataFrame:
    """As ``detect`` with a given language, after checks: the annotator must know the language and the columns must be those of
    sentences.  Contractions have no such entry: they are for any language."""
    if phenomenon not in REGISTRY or not REGISTRY[phenomenon].languages:
        raise Unsupported(f"no checked annotator for {phenomenon!r}")
    if lang not in REGISTRY[phenomenon].languages:
        raise Unsupported(f"{phenomenon} is for {', '.join(REGISTRY[phenomenon].languages)}, not {lang!r}")
    wanted = _parse_datatype_string(SENTENCES)
    missing = [f.name for f in wanted if f.name not in sentences.columns or sentences.schema[f.name].dataType.simpleString() != f.dataType.simpleString()]
    if missing:
        raise Unsupported(f"sentences lack columns or have other types: {', '.join(missing)}")
    return detect(sentences, phenomenon, lang=lang, **options)


#: When an annotator writes: always, only if it had views to work on, or only if something changed or it goes elsewhere.
ALWAYS, IF_VIEWS, IF_CHANGED = "always", "if_views", "if_changed"


def save(before: DataFrame, after: DataFrame, path: str, *, policy: str = ALWAYS, views: DataFrame | None = None, elsewhere: bool = False) -> bool:
    """Writes the annotations ``after`` a run to a new path, unless the policy says that there is nothing to write; tells whether it did.

    ``views`` are those that were worked on (for ``IF_VIEWS``); a run changes something if a row is there that wasn't, or
    the other way round.
    """
    if policy not in (ALWAYS, IF_VIEWS, IF_CHANGED):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == IF_VIEWS and (views is None or not views.limit(1).count()):
        return False
    if policy == IF_CHANGED and not elsewhere and not after.exceptAll(before).limit(1).count() and not before.exceptAll(after).limit(1).count():
        return False
    after.write.parquet(path)
    return True


def from_earlier_run(phenomenon: str) -> Column:
    """Whether an annotation is one that this detector would have made."""
    spec = REGISTRY[phenomenon]
    anomaly = F.col("category").isin(*spec.categories) if spec.categories else F.lit(False)
    for p in spec.prefixes:
        anomaly = anomaly | F.col("category").startswith(p)
    phrase = F.col("label").isin(*spec.labels) if spec.labels else F.lit(False)
    return F.coalesce(((F.col("kind") == "GrammarAnomaly") & anomaly) | ((F.col("kind") == "LexicalPhrase") & phrase), F.lit(False))


def run_again(existing: DataFrame, sentences: DataFrame, phenomenon: str, *, replace: bool = False, **how) -> DataFrame:
    """All annotations after a run: views that the detector has annotated are passed over, or with ``replace`` done anew.

    A detector sees one sentence at a time, so it is the few findings in such views that are taken out, and no sentences are shuffled.
    """
    mine = from_earlier_run(phenomenon)
    if replace:
        return existing.filter(~mine).unionByName(detect(sentences, phenomenon, **how))
    done = existing.filter(mine).select("doc_id", "view").distinct()
    return existing.unionByName(detect(sentences, phenomenon, **how).join(done, ["doc_id", "view"], "left_anti"))
