"""lexis: full-text indexing and ranked search as Spark DataFrame plans.

Typical use::

    from lexis import LATIN, build_index, save_index, parse_queries, bm25_search
    index = save_index(build_index(docs_df, LATIN), "s3://bucket/index")
    top10 = bm25_search(index, parse_queries(queries_df, LATIN))
"""

from lexis.operators.bm25 import bm25_search
from lexis.operators.boolean import boolean_search, query_plan, term_lookup
from lexis.operators.index import Index, build_index, weighted_postings
from lexis.operators.store import load_index, save_index
from lexis.operators.lsa import lsa_search
from lexis.operators.normalize import lemmatize_postings, stem_vocabulary
from lexis.operators.tokens import doc_words, parse_queries, tokens
from lexis.operators.vector import cosine_search, dense_vectors
from lexis.profile import LATIN, RUSSIAN, LanguageProfile
from lexis.sources.pages import extract_articles, extract_links

__all__ = [
    "Index", "LATIN", "RUSSIAN", "LanguageProfile", "bm25_search", "boolean_search", "build_index",
    "cosine_search", "dense_vectors", "doc_words", "extract_articles", "extract_links",
    "lemmatize_postings", "load_index", "lsa_search", "parse_queries", "query_plan", "save_index",
    "stem_vocabulary", "term_lookup", "tokens", "weighted_postings",
]
