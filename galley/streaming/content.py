"""Stateless operators on streams, and resolution of names batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galley.operators import articles, bylines
from galley.session import cut_lineage


def sanitised(stream: DataFrame) -> DataFrame:
    """Repaired text, fixes and excerpts of a stream of (id, text, categories)."""
    return articles.sanitise_content(stream)


def odd_character_counts(stream: DataFrame, time: str, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Control and zero-width characters by kind in windows of event time; later rows than `late` are dropped."""
    log = stream.withWatermark(time, late).select(time, F.inline(_odd()))
    return log.groupBy(F.window(time, window), "kind").agg(F.count("*").alias("n"))


def _odd():
    from galley.functions.content import odd_characters

    return odd_characters(F.col("text"))


def match_batches(stream: DataFrame, authors: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Match the bylines of every micro-batch of (id, names) with a fixed table of authors."""
    known = cut_lineage(authors)

    def each(batch: DataFrame, number: int) -> None:
        found = bylines.match_bylines(batch, known)
        sink(bylines.apply_matches(batch, found["matches"]), number)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
