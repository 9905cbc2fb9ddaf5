import corpus_pipeline
from pyspark.sql import functions as F

from galley.llm import chunk_dedup, mixing, neardup, quality, spm
from tests.helpers import SMALL


def test_stages_apply_their_operators(spark, docs):
    """Each stage on what the one before kept, against the operator on the same rows."""
    own = docs.select(*corpus_pipeline.COLUMNS)
    key = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.select("doc_id", "text").collect())
    (_, first), (_, second), (_, third), (_, fourth), (_, last) = corpus_pipeline.STAGES

    a = first(spark, docs, SMALL).persist()
    assert a.columns == list(corpus_pipeline.COLUMNS)
    assert key(a) == key(own.where(quality.cascade(F.col("text"), list((*quality.BASE, *quality.METHOD))).isNull()))

    b = second(spark, a, SMALL).persist()
    kept = {r.doc_id for r in neardup.near_duplicates(a).where("kept").collect()}
    rows = {(str(r.doc_id), str(r.text)) for r in a.collect() if r.doc_id in kept or r.doc_id is None}
    assert key(b) == sorted(rows) and b.columns == list(corpus_pipeline.COLUMNS)

    c = third(spark, b, SMALL).persist()
    assert key(c) == key(chunk_dedup.dedup_substrings(b))
    assert c.where("n_chars <> length(text)").count() == 0 and c.count() == b.count()

    d = fourth(spark, c, SMALL).persist()
    copies = {}
    for r in mixing.mix(c, F.array("source")).collect():
        copies[str(r.doc_id), r.text] = copies.get((str(r.doc_id), r.text), 0) + r.copies
    assert sorted(k for k, n in copies.items() for _ in range(n)) == key(d)

    e = last(spark, d, SMALL).collect()
    want = {(r.doc_id, tuple(r.ids)) for r in spm.encode(d).collect()}
    assert len(e) == d.count() and {(r.doc_id, tuple(r.ids)) for r in e} == want


def test_the_last_stage_decodes_what_it_encoded(spark, docs):
    own = docs.where("text IS NOT NULL").select(*corpus_pipeline.COLUMNS)
    name, stage = corpus_pipeline.STAGES[-1]
    got = stage(spark, own, SMALL).collect()
    assert name == "SentencePiece encoding and decoding" and len(got) == own.count() and all(r.round_trip for r in got)


def test_stages_of_nothing(spark, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, nothing, SMALL)
        assert out.columns == list(corpus_pipeline.COLUMNS) and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, SMALL).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and out.where("n_tokens <> size(ids)").count() == 0
