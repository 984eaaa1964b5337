"""Named queries over the driver's tables, each with its DuckDB twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over the whole input
tables; ``ORACLE_SQL[name]`` computes the same rows in DuckDB over views of
the same parquet files. Queries with no SQL twin (LSA needs an SVD) are
checked against numpy on small fixtures in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions.scoring import SCORE_DIGITS, report
from lexis.operators.batch import BatchMatrix
from lexis.operators.bm25 import bm25_idf_table, bm25_search
from lexis.operators.bitmaps import bitmap_and, posting_bitmaps
from lexis.operators.bounds import bounded_search, store_bounded
from lexis.operators.boolean import (boolean_search, intersect_keep_left, query_plan, rarest_first, term_lookup,
                                     unknown_terms)
from lexis.operators.index import (Index, build_index, join_term_table, materialize, posting_blocks,
                                   term_doc_rows, weighted_postings)
from lexis.operators.latent import PROBES, by_word, entries, latent_query, probe
from lexis.operators.store import load_index, postings_table_name, save_index
from lexis.operators.lsa import gram_matrices, gram_of_factors, lsa_search, query_matrix, triangular_factors
from lexis.operators.normalize import (MAX_ENDING, MIN_SUPPORT, PORTER_1A, analyse_vocabulary,
                                       lemma_dictionary, lemmatize_postings, stem_vocabulary)
from lexis.operators.tokens import doc_words, parse_queries, tokens
from lexis.operators.vector import (cosine_search, dense_vectors, query_weighted_postings,
                                    vector_idf_table)
from lexis.plans import oracle as O
from lexis.profile import LATIN, RUSSIAN
from lexis.sources.corpus import benchmark_queries, conversation_turns, documents, table
from lexis.session import scratch_path
from lexis.sources.stopwords import ENGLISH, file_words, stop_word_list
from lexis.sources.tables import append_new, collector, read_table, stamp, write_table
from lexis.sources.xml import export_xml, export_xml_document, read_xml
from lexis.streaming.ingest import start_ingest
from lexis.sources.pages import FIXTURE_ARTICLE, FIXTURE_LINKS, extract_articles, extract_links

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def doc_index(spark: SparkSession, sf_dir: str) -> Index:
    """A lazy index, for queries that read one of its tables."""
    return build_index(documents(spark, sf_dir), LATIN)


def once(index: Index) -> Index:
    """``index`` tokenized and written once, for queries that read several of
    its tables or one of them more than once."""
    return materialize(index, scratch_path(index.sparkSession, "query-index"))


def stored_index(spark: SparkSession, sf_dir: str) -> Index:
    return once(doc_index(spark, sf_dir))


def bench_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_queries(benchmark_queries(spark, sf_dir), LATIN)


IDX = O.index_ctes()
QRY = O.query_ctes()


# --- tokens --------------------------------------------------------------

@register("tokens_by_doc", O.with_ctes(
    "dw AS (SELECT doc_id, " + O.words_sql("text") + " AS ws FROM documents)")
    + "\nSELECT doc_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS term FROM dw")
def q_tokens_by_doc(spark, sf_dir):
    """Every kept token with its position."""
    return tokens(documents(spark, sf_dir), LATIN)


# --- index ---------------------------------------------------------------

@register("term_frequency", O.with_ctes(IDX) + "\nSELECT doc_id, term, tf FROM postings")
def q_term_frequency(spark, sf_dir):
    """A1: occurrences per (document, term)."""
    return doc_index(spark, sf_dir).postings.select("doc_id", "term", "tf")


@register("postings_distinct", O.with_ctes(IDX) + "\nSELECT term, doc_id FROM postings")
def q_postings_distinct(spark, sf_dir):
    """One posting per (term, document), duplicates folded."""
    return doc_index(spark, sf_dir).postings.select("term", "doc_id")


@register("doc_length", O.with_ctes(IDX) + "\nSELECT doc_id, n_tokens FROM d")
def q_doc_length(spark, sf_dir):
    """A2: kept tokens per document (documents with at least one)."""
    return doc_index(spark, sf_dir).docs.where("n_tokens > 0").select("doc_id", "n_tokens")


@register("doc_unique_terms", O.with_ctes(IDX) + "\nSELECT doc_id, n_unique FROM d")
def q_doc_unique_terms(spark, sf_dir):
    """Distinct terms per document (the BM25 length)."""
    return doc_index(spark, sf_dir).docs.where("n_tokens > 0").select("doc_id", "n_unique")


@register("doc_frequency", O.with_ctes(IDX) + "\nSELECT term, df FROM terms")
def q_doc_frequency(spark, sf_dir):
    """A4: documents per term."""
    return doc_index(spark, sf_dir).terms.select("term", "df")


@register("term_dictionary", O.with_ctes(IDX) + "\nSELECT term_id, term, df FROM terms")
def q_term_dictionary(spark, sf_dir):
    """The dictionary with stable md5 term ids."""
    return doc_index(spark, sf_dir).terms.select("term_id", "term", "df")


@register("corpus_stats", O.with_ctes(IDX) + f"""
SELECT n_docs, n_tokens, n_postings, round(avg_unique, {SCORE_DIGITS}) AS avg_unique,
       round(avg_tokens, {SCORE_DIGITS}) AS avg_tokens,
       (SELECT count(*) FROM terms) AS n_terms FROM corpus""")
def q_corpus_stats(spark, sf_dir):
    """N (documents with a token), sizes and average lengths."""
    idx = stored_index(spark, sf_dir)
    n_terms = idx.terms.agg(F.count(F.lit(1)).alias("n_terms"))
    return (idx.corpus.crossJoin(n_terms)
               .select("n_docs", "n_tokens", "n_postings",
                       report(F.col("avg_unique")).alias("avg_unique"),
                       report(F.col("avg_tokens")).alias("avg_tokens"), "n_terms"))


@register("tf_idf", O.with_ctes(IDX) + f"""
SELECT p.doc_id, p.term,
       round((p.tf::DOUBLE / p.n_tokens) * ln(c.n_docs::DOUBLE / t.df), {SCORE_DIGITS}) AS tf_idf
FROM postings p JOIN terms t USING (term) CROSS JOIN corpus c""")
def q_tf_idf(spark, sf_dir):
    """Tf-idf weight of every posting."""
    wp = weighted_postings(stored_index(spark, sf_dir))
    return wp.select("doc_id", "term", report(F.col("tf_idf")).alias("tf_idf"))


# --- BM25 ----------------------------------------------------------------

@register("query_idf_bm25", O.with_ctes(IDX, QRY) + f"""
SELECT qt.query_id, qt.term, qt.qtf, t.df,
       round({O.bm25_idf_sql('t.df', 'c.n_docs')}, {SCORE_DIGITS}) AS idf
FROM qt JOIN terms t USING (term) CROSS JOIN corpus c""")
def q_query_idf_bm25(spark, sf_dir):
    """A10: BM25 idf of every known query word, floored at 0."""
    t = bm25_idf_table(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))
    return t.select("query_id", "term", "qtf", "df", report(F.col("idf")).alias("idf"))


BM25_SCORES = f"""
bm25 AS (SELECT qt.query_id, p.doc_id,
                sum(qt.qtf * {O.bm25_term_sql(O.bm25_idf_sql('t.df', 'c.n_docs'),
                                              '(1.0::DOUBLE / p.n_unique)',
                                              'p.n_unique::DOUBLE', 'c.avg_unique')}) AS score
         FROM qt JOIN terms t USING (term) CROSS JOIN corpus c
              JOIN postings p ON p.term = qt.term
         GROUP BY qt.query_id, p.doc_id)"""


@register("bm25_batch", O.with_ctes(IDX, QRY, BM25_SCORES) + O.top_k_sql("bm25"))
def q_bm25_batch(spark, sf_dir):
    """BM25 top 10 for every benchmark passage."""
    return bm25_search(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))


@register("bm25_bounded", O.with_ctes(IDX, QRY, BM25_SCORES) + O.top_k_sql("bm25"))
def q_bm25_bounded(spark, sf_dir):
    """The same ranking, from the blocks whose score bounds reach it."""
    idx = stored_index(spark, sf_dir)
    return bounded_search(idx, store_bounded(idx, scratch_path(spark, "bounded")), bench_terms(spark, sf_dir))


# --- vector space ----------------------------------------------------------

VEC = f"""
qv AS (SELECT qt.query_id, qt.term, qt.qtf, qt.first_pos, t.df, c.n_docs,
              {O.vector_idf_sql('t.df', 'c.n_docs')} AS idf
       FROM qt JOIN terms t USING (term) CROSS JOIN corpus c),
qn AS (SELECT query_id, sum(qtf * idf * idf) AS q2 FROM qv GROUP BY query_id),
hw AS (SELECT qv.query_id, qv.term, p.doc_id, qv.qtf, qv.idf,
              (p.tf::DOUBLE / p.n_tokens) * ln(qv.n_docs::DOUBLE / qv.df) AS w
       FROM qv JOIN postings p USING (term)),
cs AS (SELECT query_id, doc_id, sum(qtf * idf * w) AS dot, sum(qtf * w * w) AS d2
       FROM hw GROUP BY query_id, doc_id)"""


def cosine_sql(metric: str) -> str:
    return (O.with_ctes(IDX, QRY, VEC, f"""
cos AS (SELECT cs.query_id, cs.doc_id, {O.cosine_sql('cs.dot', 'qn.q2', 'cs.d2', metric)} AS score
        FROM cs JOIN qn USING (query_id))""") + O.top_k_sql("cos"))


@register("query_idf_vector", O.with_ctes(IDX, QRY, VEC) + f"""
SELECT query_id, term, qtf, df, round(idf, {SCORE_DIGITS}) AS idf FROM qv""")
def q_query_idf_vector(spark, sf_dir):
    """ln(N / df) of every known query word."""
    t = vector_idf_table(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))
    return t.select("query_id", "term", "qtf", "df", report(F.col("idf")).alias("idf"))


@register("postings_for_terms", O.with_ctes(IDX, QRY, VEC) + f"""
SELECT query_id, term, doc_id, round(w, {SCORE_DIGITS}) AS tf_idf FROM hw""")
def q_postings_for_terms(spark, sf_dir):
    """Weighted postings of all words of each query (OR lookup)."""
    h = query_weighted_postings(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))
    return h.select("query_id", "term", "doc_id", report(F.col("w")).alias("tf_idf"))


@register("cosine_topk", cosine_sql("cosine"))
def q_cosine_topk(spark, sf_dir):
    """True cosine top 10 per benchmark passage."""
    return cosine_search(stored_index(spark, sf_dir), bench_terms(spark, sf_dir), metric="cosine")


@register("cosine_reference_topk", cosine_sql("reference"))
def q_cosine_reference_topk(spark, sf_dir):
    """The dot / |q| * |d| form, top 10 per passage."""
    return cosine_search(stored_index(spark, sf_dir), bench_terms(spark, sf_dir), metric="reference")


@register("dense_vectors", O.with_ctes(IDX, QRY, VEC, """
qpos AS (SELECT query_id, unnest(ws) AS term, generate_subscripts(ws, 1) AS pos FROM qw),
cand AS (SELECT DISTINCT query_id, doc_id FROM hw),
grid AS (SELECT c.query_id, c.doc_id, q.pos, coalesce(h.w, 0.0) AS v
         FROM cand c JOIN qpos q USING (query_id)
         LEFT JOIN hw h ON h.query_id = c.query_id AND h.doc_id = c.doc_id AND h.term = q.term)""")
    + f"""
SELECT query_id, doc_id, list(round(v, {SCORE_DIGITS}) ORDER BY pos) AS vector
FROM grid GROUP BY query_id, doc_id""")
def q_dense_vectors(spark, sf_dir):
    """Zero-filled tf-idf vector of every candidate over its query's words."""
    qwords = doc_words(benchmark_queries(spark, sf_dir), LATIN, ("text",), "query_id").select(
        "query_id", "words")
    return dense_vectors(stored_index(spark, sf_dir), qwords, bench_terms(spark, sf_dir))


# --- Boolean ---------------------------------------------------------------

BOOLEAN_SQL = O.with_ctes(IDX, QRY) + """
SELECT qt.query_id, p.doc_id FROM qt JOIN postings p USING (term)
GROUP BY qt.query_id, p.doc_id, qt.n_terms HAVING count(*) = qt.n_terms"""


@register("boolean_and", BOOLEAN_SQL)
def q_boolean_and(spark, sf_dir):
    """Documents holding every word of a passage."""
    return boolean_search(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))


@register("boolean_rarest_first", BOOLEAN_SQL)
def q_boolean_rarest_first(spark, sf_dir):
    """The same from each passage's rarest word on, over a stored index."""
    path = scratch_path(spark, "boolean-index")
    index = save_index(doc_index(spark, sf_dir), path)
    return rarest_first(index, bench_terms(spark, sf_dir))


@register("boolean_bitmap", BOOLEAN_SQL)
def q_boolean_bitmap(spark, sf_dir):
    """The same by intersecting bitmaps of ids."""
    return bitmap_and(posting_bitmaps(doc_index(spark, sf_dir).postings), bench_terms(spark, sf_dir))


@register("posting_bitmaps", O.with_ctes(IDX) + """
SELECT term, CASE WHEN doc_id > 0 THEN 1 + (doc_id - 1) // 32768 ELSE 0 END AS range, count(*) AS n
FROM postings GROUP BY ALL""")
def q_posting_bitmaps(spark, sf_dir):
    """Every word's bitmaps, by range of ids, with their sizes."""
    return posting_bitmaps(doc_index(spark, sf_dir).postings).select("term", "range", "n")


@register("term_lookup", O.with_ctes(IDX, QRY) + """
SELECT qt.query_id, qt.term, p.doc_id FROM qt JOIN postings p USING (term)""")
def q_term_lookup(spark, sf_dir):
    """The posting list of every query word (before intersecting)."""
    return term_lookup(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))


@register("posting_intersect", O.with_ctes(
    "dw AS (SELECT doc_id, " + O.words_sql("text") + " AS ws FROM documents)", QRY) + """
SELECT doc_id, pos, term FROM (
  SELECT doc_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS term FROM dw)
WHERE term IN (SELECT term FROM qt)""")
def q_posting_intersect(spark, sf_dir):
    """Token occurrences whose word is in some passage; left repeats kept."""
    toks = tokens(documents(spark, sf_dir), LATIN)
    vocab = bench_terms(spark, sf_dir).select("term")
    return intersect_keep_left(toks, vocab, "term").select("doc_id", "pos", "term")


@register("query_plan", O.with_ctes(IDX, QRY) + """
SELECT query_id, term, df, row_number() OVER (PARTITION BY query_id ORDER BY df, term)::INTEGER AS plan_order
FROM (SELECT qt.query_id, qt.term, coalesce(t.df, 0) AS df FROM qt LEFT JOIN terms t USING (term))""")
def q_query_plan(spark, sf_dir):
    """T4: query words rarest first (the intersection order)."""
    return query_plan(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))


# --- pages -----------------------------------------------------------------

def _links_sql() -> str:
    links = O.html_links_sql(O.html_clean_sql("html"), FIXTURE_LINKS)
    return f"""
SELECT page_id, url, pos, a.href AS href, {O.html_text_sql('a.inner')} AS title FROM (
  SELECT page_id, url, unnest(l) AS a, (generate_subscripts(l, 1) - 1)::INTEGER AS pos
  FROM (SELECT page_id, url, {links} AS l FROM pages))"""


def _articles_cte() -> str:
    title, content, keywords = O.html_articles_sql("h", FIXTURE_ARTICLE)
    return f"""
art AS (SELECT page_id, url, {title} AS title, {content} AS content, {keywords} AS keywords
        FROM (SELECT page_id, url, {O.html_clean_sql('html')} AS h FROM pages))"""


@register("links_extract", _links_sql())
def q_links_extract(spark, sf_dir):
    """Links of each page (href prefix test), first 30."""
    return extract_links(table(spark, sf_dir, "pages"), FIXTURE_LINKS)


@register("articles_extract", O.with_ctes(_articles_cte()) + "\nSELECT * FROM art")
def q_articles_extract(spark, sf_dir):
    """Title, paragraph text and keywords of each page."""
    return extract_articles(table(spark, sf_dir, "pages"), FIXTURE_ARTICLE)


# --- normalizers -----------------------------------------------------------

_STOP = file_words(ENGLISH)


@register("tokens_no_stop", O.with_ctes(
    "dw AS (SELECT doc_id, " + O.words_sql("text", stop_words=_STOP) + " AS ws FROM documents)")
    + "\nSELECT doc_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS term FROM dw")
def q_tokens_no_stop(spark, sf_dir):
    """Tokens with the English stop list (read as a text source) removed."""
    profile = LATIN.with_stop_words(stop_word_list(spark, ENGLISH))
    return tokens(documents(spark, sf_dir), profile)


@register("tokens_multi_field", O.with_ctes(_articles_cte(), """
aw AS (SELECT page_id, list_concat(list_concat(""" + O.words_sql("content") + ", "
    + O.words_sql("keywords") + "), " + O.words_sql("title") + """) AS ws FROM art)""")
    + "\nSELECT page_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS term FROM aw")
def q_tokens_multi_field(spark, sf_dir):
    """Words of content, then keywords, then title of each extracted article."""
    art = extract_articles(table(spark, sf_dir, "pages"), FIXTURE_ARTICLE)
    return tokens(art, LATIN, ("content", "keywords", "title"), "page_id")


_PORTER_RE = "(" + "|".join(sorted(PORTER_1A, key=len, reverse=True)) + ")$"


def porter_sql(w: str) -> str:
    """Porter 1a on the SQL expression ``w``."""
    suf = f"regexp_extract({w}, {O.lit(_PORTER_RE)}, 1)"
    return "CASE " + " ".join(
        f"WHEN len({w}) > 2 AND {suf} = {O.lit(e)} THEN left({w}, len({w}) - {len(e)}) || {O.lit(r)}"
        for e, r in PORTER_1A.items()) + f" ELSE {w} END"


@register("stem_vocabulary", O.with_ctes(IDX) + f"""
SELECT term, {porter_sql('term')} AS stem FROM terms""")
def q_stem_vocabulary(spark, sf_dir):
    """The suffix stemmer over the corpus vocabulary (Porter 1a rule set
    on the Latin-script fixture; the Russian rule set is tested inline)."""
    return stem_vocabulary(doc_index(spark, sf_dir).terms, "porter1a")


@register("stemmed_doc_frequency", O.with_ctes(O.index_ctes(word_map=porter_sql("w")))
          + "\nSELECT term, df FROM terms")
def q_stemmed_doc_frequency(spark, sf_dir):
    """N1 in the tokenizer: document frequency of stems."""
    idx = build_index(documents(spark, sf_dir), LATIN.with_stemmer("porter1a"))
    return idx.terms.select("term", "df")


# Latin letters read as Cyrillic ones, so that the Russian word filter meets
# the whole corpus: an invented mapping, the same on both sides.
LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
CYRILLIC_LETTERS = "абцдефгхийклмнопярстувшьыжАБЦДЕФГХИЙКЛМНОПЯРСТУВШЬЫЖ"
RUSSIAN_WORDS = replace(RUSSIAN, stemmer=None)
_RU_DOCS = (f"(SELECT doc_id, translate(text, '{LATIN_LETTERS}', '{CYRILLIC_LETTERS}') AS text "
            "FROM documents)")
_RU_QUERIES = (f"(SELECT item_id, translate(text, '{LATIN_LETTERS}', '{CYRILLIC_LETTERS}') AS text "
               "FROM benchmark)")
_RU_IDX = O.index_ctes(_RU_DOCS, word_pattern=RUSSIAN.word_pattern)
_RU_QRY = O.query_ctes(_RU_QUERIES, word_pattern=RUSSIAN.word_pattern)


def cyrillic(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.translate("text", LATIN_LETTERS, CYRILLIC_LETTERS))


@register("russian_bm25", O.with_ctes(_RU_IDX, _RU_QRY, BM25_SCORES) + O.top_k_sql("bm25"))
def q_russian_bm25(spark, sf_dir):
    """The Russian word filter over the whole corpus in Cyrillic
    letters, indexed and searched with the passages."""
    idx = once(build_index(cyrillic(documents(spark, sf_dir)), RUSSIAN_WORDS))
    return bm25_search(idx, parse_queries(cyrillic(benchmark_queries(spark, sf_dir)), RUSSIAN_WORDS))


@register("russian_stem_vocabulary")
def q_russian_stem_vocabulary(spark, sf_dir):
    """The Snowball Russian stemmer over that vocabulary (checked against
    a separate implementation in tests)."""
    idx = build_index(cyrillic(documents(spark, sf_dir)), RUSSIAN_WORDS)
    return stem_vocabulary(idx.terms, "russian")


def plural_pairs(terms: DataFrame) -> DataFrame:
    """A lemma table derived from the corpus itself: (form, lemma) for every
    term ending in 's' whose form without the 's' is also a term."""
    a = terms.select(F.col("term").alias("form"))
    b = terms.select(F.col("term").alias("lemma"))
    return a.join(b, F.col("form") == F.concat(F.col("lemma"), F.lit("s")))


@register("lemmatize_dictionary", O.with_ctes(IDX, """
dict AS (SELECT a.term AS form, b.term AS lemma FROM terms a JOIN terms b ON a.term = b.term || 's'),
lp AS (SELECT coalesce(d.lemma, p.term) AS term, p.doc_id, p.tf
       FROM postings p LEFT JOIN dict d ON d.form = p.term)""")
    + "\nSELECT term, doc_id, sum(tf)::BIGINT AS tf FROM lp GROUP BY term, doc_id")
def q_lemmatize_dictionary(spark, sf_dir):
    """Postings rewritten through a (form, lemma) dictionary, counts merged."""
    idx = stored_index(spark, sf_dir)
    return lemmatize_postings(idx, lemma_dictionary(plural_pairs(idx.terms)))


@register("lemmatize_unknown", O.with_ctes(IDX, f"""
dict AS (SELECT a.term AS form, b.term AS lemma FROM terms a JOIN terms b ON a.term = b.term || 's'),
pairs AS (SELECT form, lemma FROM dict UNION ALL
          SELECT DISTINCT lemma, lemma FROM dict WHERE lemma NOT IN (SELECT form FROM dict)),
split AS (SELECT form, lemma, len(list_filter(range(1, least(length(form), length(lemma)) + 1),
                 lambda i: substr(form, 1, i) = substr(lemma, 1, i))) AS same FROM pairs),
votes AS (SELECT right(form, n) AS ending, cut, tail, count(*) AS support FROM (
            SELECT form, length(form) - same AS cut, substr(lemma, same + 1) AS tail,
                   unnest(range(greatest(length(form) - same, 1),
                                least({MAX_ENDING}, length(form) - 1) + 1)) AS n FROM split)
          GROUP BY ALL HAVING count(*) >= {MIN_SUPPORT}),
rules AS (SELECT * FROM votes
          QUALIFY row_number() OVER (PARTITION BY ending ORDER BY support DESC, cut, tail) = 1),
rest AS (SELECT term FROM terms WHERE term NOT IN (SELECT form FROM dict)),
hits AS (SELECT e.term, r.ending, r.cut, r.tail FROM (
           SELECT term, right(term, n) AS ending FROM (
             SELECT term, unnest(range(1, least({MAX_ENDING}, length(term) - 1) + 1)) AS n FROM rest)) e
         JOIN rules r ON r.ending = e.ending
         QUALIFY row_number() OVER (PARTITION BY e.term ORDER BY length(r.ending) DESC) = 1)""") + """
SELECT form AS term, lemma, NULL::VARCHAR AS ending, TRUE AS known FROM dict
UNION ALL
SELECT rest.term, coalesce(left(rest.term, length(rest.term) - cut) || tail, rest.term), ending, FALSE
FROM rest LEFT JOIN hits ON hits.term = rest.term""")
def q_lemmatize_unknown(spark, sf_dir):
    """Every word of the corpus analysed, those the dictionary lacks by
    suffix rules learned from it."""
    idx = stored_index(spark, sf_dir)
    return analyse_vocabulary(idx.terms, lemma_dictionary(plural_pairs(idx.terms)))


# --- matrix views and LSA ----------------------------------------------------

@register("posting_blocks", O.with_ctes(IDX) + """
SELECT term, doc_id >> 7 AS block, list_sort(list(doc_id)) AS doc_ids
FROM postings GROUP BY term, doc_id >> 7""")
def q_posting_blocks(spark, sf_dir):
    """Posting lists, in blocks of at most 128 document ids."""
    return posting_blocks(doc_index(spark, sf_dir).postings, 128)


@register("term_doc_matrix", O.with_ctes(IDX) + f"""
SELECT doc_id, list(term ORDER BY term) AS terms,
       list(round((p.tf::DOUBLE / p.n_tokens) * ln(c.n_docs::DOUBLE / t.df), {SCORE_DIGITS})
            ORDER BY term) AS weights
FROM postings p JOIN terms t USING (term) CROSS JOIN corpus c GROUP BY doc_id""")
def q_term_doc_matrix(spark, sf_dir):
    """The tf-idf matrix as one sparse row per document."""
    wp = weighted_postings(stored_index(spark, sf_dir)).withColumn("tf_idf", report(F.col("tf_idf")))
    return term_doc_rows(wp)


@register("lsa_gram", O.with_ctes(IDX, QRY, VEC, """
g AS (SELECT a.query_id, a.term AS term_i, b.term AS term_j, sum(a.w * b.w) AS g
      FROM hw a JOIN hw b ON a.query_id = b.query_id AND a.doc_id = b.doc_id AND a.term <= b.term
      GROUP BY ALL)""") + f"""
SELECT query_id, term_i, term_j, round(g, {SCORE_DIGITS}) AS g FROM g WHERE g <> 0""")
def q_lsa_gram(spark, sf_dir):
    """Cells of each query's word x word matrix A^T A, upper triangle."""
    a = query_matrix(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))
    return _cells(a, gram_matrices(a))


def _cells(a: DataFrame | BatchMatrix, gram: DataFrame) -> DataFrame:
    words = a.words if isinstance(a, BatchMatrix) else a.select("query_id", "ti", "term").distinct()
    wi = words.select("query_id", F.col("ti").alias("i"), F.col("term").alias("term_i"))
    wj = words.select("query_id", F.col("ti").alias("j"), F.col("term").alias("term_j"))
    g = gram.join(wi, ["query_id", "i"]).join(wj, ["query_id", "j"])
    return g.select("query_id", "term_i", "term_j", report(F.col("g")).alias("g"))


@register("lsa_tsqr", O.with_ctes(IDX, QRY, VEC, """
words AS (SELECT DISTINCT query_id, term FROM hw),
pairs AS (SELECT a.query_id, a.term AS term_i, b.term AS term_j
          FROM words a JOIN words b ON a.query_id = b.query_id AND a.term <= b.term),
g AS (SELECT a.query_id, a.term AS term_i, b.term AS term_j, sum(a.w * b.w) AS g
      FROM hw a JOIN hw b ON a.query_id = b.query_id AND a.doc_id = b.doc_id AND a.term <= b.term
      GROUP BY ALL)""") + f"""
SELECT query_id, term_i, term_j, round(coalesce(g, 0.0), {SCORE_DIGITS}) AS g
FROM pairs LEFT JOIN g USING (query_id, term_i, term_j)""")
def q_lsa_tsqr(spark, sf_dir):
    """The triangular factors that the SVD is taken of, as R^T R: all
    cells of A^T A, those of words that never meet included."""
    a = query_matrix(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))
    return _cells(a, gram_of_factors(triangular_factors(a)))


@register("lsa_topk")
def q_lsa_topk(spark, sf_dir):
    """Rank-5 LSA, true cosine, top 10 per passage (checked
    against numpy's SVD in tests)."""
    return lsa_search(stored_index(spark, sf_dir), bench_terms(spark, sf_dir), metric="cosine")


@register("lsa_reference_topk")
def q_lsa_reference_topk(spark, sf_dir):
    """Rank-5 LSA with the reference form of the measure."""
    return lsa_search(stored_index(spark, sf_dir), bench_terms(spark, sf_dir), metric="reference")


_ENTRIES = """
ent AS (SELECT p.doc_id, p.term, md5(p.term || ':0') AS h,
               (p.tf::DOUBLE / p.n_tokens) * ln(c.n_docs::DOUBLE / t.df) AS w
        FROM postings p JOIN terms t USING (term) CROSS JOIN corpus c),
y AS (SELECT doc_id, """ + ", ".join(
    f"sum(CASE WHEN substr(h, {c + 1}, 1) < '8' THEN w ELSE -w END) AS y{c}" for c in range(PROBES)) + """
      FROM ent GROUP BY doc_id)"""


def _reported(df: DataFrame, key: str) -> DataFrame:
    # + 0.0: a sum that cancels is 0.0, whatever its sign
    return df.select(key, *[(report(F.col(c)) + F.lit(0.0)).alias(c) for c in df.columns if c != key])


@register("latent_probe", O.with_ctes(IDX, _ENTRIES) + "\nSELECT doc_id, " + ", ".join(
    f"round(y{c}, {SCORE_DIGITS}) + 0.0::DOUBLE AS y{c}" for c in range(PROBES)) + " FROM y")
def q_latent_probe(spark, sf_dir):
    """The block that the corpus-wide factors start from, by document."""
    return _reported(probe(entries(stored_index(spark, sf_dir))), "doc_id")


@register("latent_power_step", O.with_ctes(IDX, _ENTRIES) + "\nSELECT term, " + ", ".join(
    f"round(sum(w * y{c}), {SCORE_DIGITS}) + 0.0::DOUBLE AS z{c}" for c in range(PROBES)) + """
FROM ent JOIN y USING (doc_id) GROUP BY term""")
def q_latent_power_step(spark, sf_dir):
    """That block sent through the documents x words matrix, by word."""
    a = entries(stored_index(spark, sf_dir))
    return _reported(by_word(a, probe(a)), "term")


@register("latent_topk")
def q_latent_topk(spark, sf_dir):
    """Top 10 per passage by rank-5 factors of the whole corpus
    (checked against numpy's SVD in tests)."""
    return latent_query(stored_index(spark, sf_dir), bench_terms(spark, sf_dir), metric="cosine")


# --- sinks, provenance, streaming ------------------------------------------

ARTICLE_SCHEMA = "page_id long, url string, title string, content string, keywords string"
# An invented collector, stamped on every extracted article.
COLLECTOR = ("Ivan", "Petrov", "group-7")
_CID_SQL = f"md5({O.lit('|'.join(COLLECTOR))})"


@register("xml_round_trip", O.with_ctes(_articles_cte()) + "\nSELECT * FROM art")
def q_xml_round_trip(spark, sf_dir):
    """Extracted articles written as XML and read back."""
    from pyspark.sql import types as T
    path = scratch_path(spark, "articles-xml")
    export_xml(extract_articles(table(spark, sf_dir, "pages")), path, root_tag="articles")
    schema = T._parse_datatype_string(ARTICLE_SCHEMA)
    return read_xml(spark, path, schema)


@register("xml_document", O.with_ctes(_articles_cte()) + "\nSELECT * FROM art")
def q_xml_document(spark, sf_dir):
    """The articles as one XML document from many tasks, read back."""
    path = scratch_path(spark, "articles") + ".xml"
    art = extract_articles(table(spark, sf_dir, "pages"))
    export_xml_document(art, path, root_tag="articles")
    return read_xml(spark, path, art.schema)


@register("collector_stamp", O.with_ctes(_articles_cte()) + f"""
SELECT page_id, url, title, {_CID_SQL} AS collector_id FROM art""")
def q_collector_stamp(spark, sf_dir):
    """Every article carries the id of the person who collected it."""
    who = collector(spark, *COLLECTOR)
    art = extract_articles(table(spark, sf_dir, "pages"))
    return stamp(art, who).select("page_id", "url", "title", "collector_id")


@register("table_round_trip", O.with_ctes(
    "dw AS (SELECT doc_id, " + O.words_sql("text") + " AS ws FROM documents)")
    + "\nSELECT doc_id, len(ws)::BIGINT AS n FROM dw WHERE len(ws) > 0")
def q_table_round_trip(spark, sf_dir):
    """Token rows written as a table, read back, counted per document."""
    path = scratch_path(spark, "tokens")
    write_table(tokens(documents(spark, sf_dir), LATIN), path)
    back = read_table(spark, path)
    return back.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@register("postings_append", O.with_ctes(IDX) + "\nSELECT term, doc_id, tf FROM postings")
def q_postings_append(spark, sf_dir):
    """Insert-or-ignore -- postings appended twice are stored once."""
    path = scratch_path(spark, "postings")
    p = doc_index(spark, sf_dir).postings.select("term", "doc_id", "tf")
    append_new(spark, p, path, ["term", "doc_id"], deal=["doc_id"])
    append_new(spark, p, path, ["term", "doc_id"], deal=["doc_id"])
    return read_table(spark, path)


@register("index_reopen_bm25", O.with_ctes(IDX, QRY, BM25_SCORES) + O.top_k_sql("bm25"))
def q_index_reopen_bm25(spark, sf_dir):
    """The index saved, its table dropped from the catalog as in a new
    session, reopened from its folder, searched."""
    path = scratch_path(spark, "index-reopen")
    save_index(doc_index(spark, sf_dir), path)
    spark.sql(f"DROP TABLE {postings_table_name(path)}")
    return bm25_search(load_index(spark, path), bench_terms(spark, sf_dir))


@register("index_append", O.with_ctes(IDX) + """
SELECT p.term, p.doc_id, p.tf, t.df, d.n_tokens, d.n_unique, c.n_docs, c.n_postings
FROM postings p JOIN terms t USING (term) JOIN d ON d.doc_id = p.doc_id CROSS JOIN corpus c""")
def q_index_append(spark, sf_dir):
    """Documents indexed in two halves, all four tables joined."""
    path = scratch_path(spark, "index-append")
    docs = documents(spark, sf_dir)
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    save_index(build_index(docs.where(half == 0), LATIN), path)
    i = save_index(build_index(docs.where(half == 1), LATIN), path, mode="append")
    p = i.postings.select("term", "doc_id", "tf")
    p = join_term_table(i, p, i.terms.select("term", "df"))
    return p.join(i.docs, "doc_id").crossJoin(F.broadcast(i.corpus)).select(
        "term", "doc_id", "tf", "df", i.docs.n_tokens, i.docs.n_unique, "n_docs", "n_postings")


@register("stream_ingest", O.with_ctes(IDX) + "\nSELECT term, doc_id, tf FROM postings")
def q_stream_ingest(spark, sf_dir):
    """S7, S8, S10 as a stream: documents ingested by Structured Streaming
    micro-batches into a stored index that holds a part of them, then read
    back. The rest arrives as files, three micro-batches at least."""
    base = scratch_path(spark, "stream-index")
    docs = documents(spark, sf_dir)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    save_index(build_index(docs.where(part == 0), LATIN), f"{base}/index")
    n = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    docs.where(part > 0).repartition(n, "doc_id").write.parquet(f"{base}/incoming")
    stream = (spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", max(1, n // 3))
                   .parquet(f"{base}/incoming"))
    start_ingest(stream, f"{base}/index", f"{base}/checkpoint", LATIN).awaitTermination()
    return load_index(spark, f"{base}/index").postings.select("term", "doc_id", "tf")


# --- whole workflows over the other text tables ------------------------------

@register("article_bm25", O.with_ctes(
    _articles_cte(), O.index_ctes("art", "page_id", fields=("content", "keywords", "title")),
    QRY, BM25_SCORES) + O.top_k_sql("bm25"))
def q_article_bm25(spark, sf_dir):
    """S3 -> P5/P6 -> index -> BM25: articles extracted from the pages, indexed
    over content, keywords and title, ranked for every benchmark passage."""
    art = extract_articles(table(spark, sf_dir, "pages"))
    idx = once(build_index(art, LATIN, ("content", "keywords", "title"), key="page_id"))
    return bm25_search(idx, bench_terms(spark, sf_dir))


@register("conversation_bm25", O.with_ctes(
    O.index_ctes("conversations", "conv_id * 4294967296 + turn"), QRY, BM25_SCORES)
    + O.top_k_sql("bm25"))
def q_conversation_bm25(spark, sf_dir):
    """BM25 over a second corpus: one document per conversation turn."""
    idx = once(build_index(conversation_turns(spark, sf_dir), LATIN))
    return bm25_search(idx, bench_terms(spark, sf_dir))


@register("conversation_index", O.with_ctes(O.index_ctes("conversations", "conv_id")) + """,
whole AS (SELECT term, doc_id, sum(tf)::BIGINT AS tf FROM postings GROUP BY term, doc_id)
SELECT term, doc_id, tf, (sum(tf) OVER (PARTITION BY doc_id))::BIGINT AS n_tokens,
       count(*) OVER (PARTITION BY doc_id) AS n_unique, count(*) OVER (PARTITION BY term) AS df
FROM whole""")
def q_conversation_index(spark, sf_dir):
    """Rows that share a key (the turns of a conversation) stored as
    one document with the words of all."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "text")
    i = save_index(build_index(turns, LATIN, key="conv_id"), scratch_path(spark, "conversations"), repeats="merge")
    return join_term_table(i, i.postings, i.terms.select("term", "df"))


@register("unknown_query_terms", O.with_ctes(IDX, QRY) + """
SELECT query_id, term FROM qt WHERE term NOT IN (SELECT term FROM terms)""")
def q_unknown_query_terms(spark, sf_dir):
    """Q17: the words of each passage that no document contains."""
    return unknown_terms(stored_index(spark, sf_dir), bench_terms(spark, sf_dir))
