"""A small batch over blocks of documents: the rows of the row-by-row path, and
postings that move once however many queries ask for them."""

import pytest
from conftest import rows

from lexis.operators import batch, lsa, vector
from lexis.operators.batch import batch_matrix
from lexis.operators.index import build_index
from lexis.operators.lsa import gram_matrices, lsa_scores, query_entries, query_matrix
from lexis.operators.tokens import doc_words, parse_queries
from lexis.operators.vector import dense_vectors
from lexis.profile import LATIN

DOCS = [(i, " ".join(["all"] + ["even"] * (i % 2 == 0) + ["third third"] * (i % 3 == 0) + [f"only{'abcde'[i % 5]}"]))
        for i in range(60)] + [(60, "nothing else"), (61, "")]


def setup(spark, texts):
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    qwords = doc_words(queries, LATIN, ("text",), "query_id").select("query_id", "words")
    return build_index(spark.createDataFrame(DOCS, "doc_id long, text string"), LATIN), parse_queries(queries, LATIN), qwords


TEXTS = ["even third even", "third onlya unheard", "all", "unheard", "", "onlyb onlyc else all"]


def test_postings_do_not_grow_with_the_queries(spark):
    index, one, _ = setup(spark, ["even third all"])
    _, many, _ = setup(spark, ["even third all"] * 50)
    assert query_matrix(index, many).entries.count() == query_matrix(index, one).entries.count()


@pytest.mark.parametrize("block_rows,block_bytes", [(None, None), (7, 400)])
def test_vectors_and_scores_as_row_by_row(spark, monkeypatch, block_rows, block_bytes):
    index, q, qwords = setup(spark, TEXTS)
    if block_rows:
        monkeypatch.setattr(batch, "BLOCK_ROWS", block_rows)
        monkeypatch.setattr(lsa, "GRAM_BYTES", block_bytes)
        monkeypatch.setattr(vector, "VECTOR_BYTES", block_bytes)
    vectors, scores = rows(dense_vectors(index, qwords, q)), rows(lsa_scores(index, q, metric="cosine"))
    monkeypatch.setattr(vector, "is_small", lambda df: False)
    monkeypatch.setattr(lsa, "is_small", lambda df: False)
    assert vectors and vectors == rows(dense_vectors(index, qwords, q))
    want = rows(lsa_scores(index, q, metric="cosine"))
    assert [s[:2] for s in scores] == [s[:2] for s in want]
    assert [s[2] for s in scores] == pytest.approx([s[2] for s in want], abs=1e-9)


def test_gram_cells_as_row_by_row(spark):
    index, q, _ = setup(spark, TEXTS)
    got, want = (rows(gram_matrices(a)) for a in (batch_matrix(index, q), query_entries(index, q, False)))
    assert [g[:3] for g in got] == [g[:3] for g in want]
    assert [g[3] for g in got] == pytest.approx([g[3] for g in want], rel=1e-12)


def test_a_posting_that_comes_twice_has_no_vector(spark):
    _, q, qwords = setup(spark, ["even"])
    index = build_index(spark.createDataFrame([(1, "even odd"), (1, "even odd"), (2, "odd")], "doc_id long, text string"), LATIN)
    with pytest.raises(Exception, match="two postings"):
        dense_vectors(index, qwords, q).collect()
