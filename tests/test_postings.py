"""Postings by parts: as over the term counts, whatever the parts and batches."""

import pyarrow as pa
import pytest

from trolley.operators import documents, postings


@pytest.fixture(scope="module")
def docs(spark):
    words = ["red", "wine", "größe", "дом", "a1", "green tea", "one_two", "x"]
    rows = [(k % 37, " ".join(words[(k * j + j) % 8] for j in range(k % 9))) for k in range(90)] + [(None, "red wine red"), (None, "tea"), (500, None), (501, "")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("characters, batch", [(32_000_000, 1000), (100, 2), (10, 1)])
def test_same_weights_as_over_the_counts(spark, docs, characters, batch):
    want = {(r.doc_id, r.term): r.weight for r in documents.tfidf_weights(documents.term_counts(docs.where("doc_id is not null"), "doc_id", "text"),
                                                                         documents.corpus_size(docs)).collect()}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        # a document without an id changes how many have a term, so it is left out of both but counted
        known = docs.withColumn("text", documents.F.when(documents.F.col("doc_id").isNotNull(), documents.F.col("text")))
        rows = postings.tfidf_postings(known, "doc_id", "text", characters).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = {(r.doc_id, r.term): r.weight for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys() and all(got[p] == pytest.approx(w) for p, w in want.items())
    assert postings.tfidf_postings(docs.limit(0), "doc_id", "text").count() == 0


def test_documents_without_an_id_are_one(docs):
    rows = [r for r in postings.tfidf_postings(docs, "doc_id", "text").collect() if r.doc_id is None]
    assert sorted(r.term for r in rows) == ["red", "red wine", "tea", "wine", "wine red"]


def test_no_posting_is_moved(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    text = postings.tfidf_postings(spark.read.parquet(str(tmp_path / "docs")), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    # what stands over the weighting is final; below it move the texts, twice, and the terms of parts
    assert "Exchange" not in text[: text.index("MapInArrow")] and "Generate" not in text and text.count("Exchange") == 3


def test_batches_are_cut_at_documents_and_parts():
    rows = [(0, 1), (0, 1), (0, 2), (1, 2), (1, 2), (1, 2), (1, 3), (2, 3)]
    for n in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_pylist([{"part": p, "doc": d} for p, d in rows[k: k + n]]) for k in range(0, len(rows), n)]
        found = [[(r["part"], r["doc"]) for r in b.to_pylist()] for b in postings._whole(iter(batches))]
        assert sum(found, []) == rows and all(len({p for p, _ in b}) == 1 for b in found)
        assert sum(len(set(b)) for b in found) == len(set(rows))
