"""Detectors on a stream of sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.annotate import detect


def detect_stream(sentences: DataFrame, phenomenon: str, *, event_time: str | None = None, delay: str = "1 hour", **how) -> DataFrame:
    """Annotations of a streaming DataFrame of sentences; detection is stateless.

    With ``event_time`` a sentence that comes again (same doc_id, view and sent_id) within the delay is passed over, by
    a deduplication whose state the watermark bounds.
    """
    if event_time:
        sentences = sentences.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["doc_id", "view", "sent_id"])
    return detect(sentences, phenomenon, **how)
