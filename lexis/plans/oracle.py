"""DuckDB SQL that computes the same results as the Spark queries.

Used only to check the Spark results: the driver runs each string against
views over the same parquet tables. The fragments mirror the Spark column
expressions one for one (same split, same word test, same formula order).
"""

from __future__ import annotations

from lexis.functions.scoring import BM25_B, BM25_K1, RANK_DIGITS, SCORE_DIGITS, TOP_K
from lexis.profile import EN_DASH, LETTER_WORD, SPLIT_PATTERN

# Java's \s also matches U+000B, RE2's does not: add it so both split alike.
DUCK_SPLIT = SPLIT_PATTERN.replace(r"\s", r"\s\x0B")


def dbl(x: float) -> str:
    """A DOUBLE literal (a bare 0.75 would be DECIMAL in DuckDB)."""
    return f"{float(x)!r}::DOUBLE"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words_sql(text: str, word_pattern: str = LETTER_WORD, stop_words=(),
              word_map: str | None = None) -> str:
    """list<varchar> of kept lower-cased words of ``text`` (NULL -> []).

    ``word_map``: SQL over the variable ``w`` applied to each kept word
    (e.g. a stemmer)."""
    cond = f"w <> {lit(EN_DASH)} AND regexp_full_match(w, {lit(word_pattern)})"
    if stop_words:
        cond += " AND NOT list_contains([" + ", ".join(lit(s) for s in stop_words) + "], w)"
    out = (f"list_filter(list_transform(regexp_split_to_array(coalesce({text}, ''), "
           f"{lit(DUCK_SPLIT)}), lambda w: lower(w)), lambda w: {cond})")
    if word_map:
        out = f"list_transform({out}, lambda w: {word_map})"
    return out


def index_ctes(source: str = "documents", key: str = "doc_id", text: str = "text",
               stop_words=(), word_map: str | None = None, fields=None,
               word_pattern: str = LETTER_WORD) -> str:
    """CTEs dw, d, postings, terms, corpus over one text column (or several
    ``fields``, tokenized one after another)."""
    if fields:
        ws = words_sql(fields[0], stop_words=stop_words, word_map=word_map)
        for f in fields[1:]:
            ws = f"list_concat({ws}, {words_sql(f, stop_words=stop_words, word_map=word_map)})"
    else:
        ws = words_sql(text, word_pattern, stop_words=stop_words, word_map=word_map)
    return f"""
dw AS (SELECT {key} AS doc_id, {ws} AS ws
       FROM {source}),
d AS (SELECT doc_id, ws, len(ws)::BIGINT AS n_tokens, len(list_distinct(ws))::BIGINT AS n_unique
      FROM dw WHERE len(ws) > 0),
postings AS (SELECT term, doc_id, n_tokens, n_unique, count(*) AS tf
             FROM (SELECT doc_id, n_tokens, n_unique, unnest(ws) AS term FROM d)
             GROUP BY term, doc_id, n_tokens, n_unique),
terms AS (SELECT term, md5(term) AS term_id, count(*) AS df FROM postings GROUP BY term),
corpus AS (SELECT count(*) AS n_docs, sum(n_tokens)::BIGINT AS n_tokens, sum(n_unique)::BIGINT AS n_postings,
                  avg(n_unique)::DOUBLE AS avg_unique, avg(n_tokens)::DOUBLE AS avg_tokens FROM d)"""


def query_ctes(source: str = "benchmark", key: str = "item_id", text: str = "text",
               word_pattern: str = LETTER_WORD) -> str:
    """CTEs qw (words per query) and qt (query_id, term, qtf, first_pos, n_terms)."""
    return f"""
qw AS (SELECT {key} AS query_id, {words_sql(text, word_pattern)} AS ws FROM {source}),
qtok AS (SELECT query_id, unnest(ws) AS term, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos FROM qw),
qt0 AS (SELECT query_id, term, count(*) AS qtf, min(pos) AS first_pos FROM qtok GROUP BY query_id, term),
qt AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS n_terms FROM qt0)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


def top_k_sql(scores: str, k: int = TOP_K) -> str:
    """Rank rows of the relation ``scores`` (query_id, doc_id, score)."""
    return f"""
SELECT query_id, rank, doc_id, round(score, {SCORE_DIGITS}) AS score FROM (
  SELECT query_id, doc_id, score, row_number() OVER (
           PARTITION BY query_id ORDER BY {significant_sql('score')} DESC, doc_id)::INTEGER AS rank
  FROM {scores})
WHERE rank <= {k}"""


def significant_sql(x: str) -> str:
    """``x`` to RANK_DIGITS significant digits."""
    step = f"pow(10.0::DOUBLE, floor(log10(abs({x}))) - {RANK_DIGITS - 1})"
    return f"CASE WHEN abs({x}) < 1e-290::DOUBLE THEN 0.0::DOUBLE ELSE round({x} / {step}) * {step} END"


def bm25_term_sql(idf: str, tf: str, length: str, avg: str,
                  k1: float = BM25_K1, b: float = BM25_B) -> str:
    norm = (f"({dbl(1.0 - b)} + CASE WHEN {avg} = 0 THEN 0.0 "
            f"ELSE ({dbl(b)} * {length}) / {avg} END)")
    return f"({idf} * ({tf} * {dbl(k1 + 1.0)}) / ({tf} + {dbl(k1)} * {norm}))"


def bm25_idf_sql(df: str, n: str) -> str:
    return f"greatest(ln(({n}::DOUBLE - {df} + 0.5::DOUBLE) / ({df} + 0.5::DOUBLE)), 0.0::DOUBLE)"


def vector_idf_sql(df: str, n: str) -> str:
    return f"ln({n}::DOUBLE / {df})"


def safe_div_sql(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL THEN 0.0 ELSE ({num}) / ({den}) END)"


def cosine_sql(dot: str, q2: str, d2: str, metric: str = "cosine") -> str:
    if metric == "cosine":
        return safe_div_sql(dot, f"sqrt({q2}) * sqrt({d2})")
    return f"({safe_div_sql(dot, f'sqrt({q2})')} * sqrt({d2}))"


# --- HTML (same patterns as lexis.functions.html) ----------------------------

def html_clean_sql(html: str) -> str:
    from lexis.functions.html import DROP_BLOCKS
    return f"regexp_replace(coalesce({html}, ''), {lit(DROP_BLOCKS)}, '', 'g')"


def _decoded_sql(t: str) -> str:
    """Named references replaced one after the other, &amp; last."""
    from lexis.functions.html import ENTITIES
    for ent, ch in ENTITIES:
        t = f"replace({t}, {lit(ent)}, {lit(ch)})"
    return t


def html_text_sql(x: str) -> str:
    from lexis.functions.html import ANY_TAG, BR, TEXT_SPACE
    t = f"regexp_replace(regexp_replace({x}, {lit(BR)}, ' ', 'g'), {lit(ANY_TAG)}, '', 'g')"
    t = _decoded_sql(t)
    return f"trim(regexp_replace({t}, {lit(TEXT_SPACE)}, ' ', 'g'))"


def html_paragraphs_sql(c: str, tag: str = "p") -> str:
    from lexis.functions.html import paragraph_cut, paragraph_split
    pieces = f"string_split_regex({c}, {lit(paragraph_split(tag))})"
    cut = f"regexp_replace(s, {lit(paragraph_cut(tag))}, '')"
    texts = f"list_transform(list_slice({pieces}, 2, len({pieces})), lambda s: {html_text_sql(cut)})"
    return f"list_filter({texts}, lambda s: s <> '')"


# A captured href in its quotes, if any.
QUOTED_HREF = "trim(h, chr(34) || chr(39))"


def html_links_sql(html: str, spec) -> str:
    """list<struct(href, inner)> of the first ``spec.limit`` matching links."""
    pat = lit(spec.link.link())
    per = (f"list_transform(regexp_extract_all({html}, {lit(spec.container.element())}, 1), "
           f"lambda c: list_transform(regexp_extract_all(c, {pat}, 1), "
           f"lambda h, i: {{'href': {_decoded_sql(QUOTED_HREF)}, 'inner': regexp_extract_all(c, {pat}, 2)[i]}}))")
    return f"list_slice(flatten({per}), 1, {spec.limit})"


def html_articles_sql(html: str, spec) -> tuple[str, str, str]:
    """(title, content, keywords) SQL expressions over cleaned ``html``."""
    paras = (f"flatten(list_transform(regexp_extract_all({html}, {lit(spec.container.element())}, 1), "
             f"lambda c: {html_paragraphs_sql('c', spec.paragraph)}))")
    content = f"array_to_string({paras}, {lit(spec.paragraph_sep)})"
    if spec.keyword_container is not None:
        kw = (f"flatten(list_transform(regexp_extract_all({html}, "
              f"{lit(spec.keyword_container.element())}, 1), lambda c: list_transform("
              f"regexp_extract_all(c, {lit(spec.keyword_link.element())}, 1), "
              f"lambda x: {html_text_sql('x')})))")
        keywords = f"array_to_string(list_filter({kw}, lambda s: s <> ''), {lit(spec.keyword_sep)})"
    else:
        keywords = "''"
    title = (html_text_sql(f"regexp_extract({html}, {lit(spec.title.element())}, 1)")
             if spec.title is not None else "NULL::VARCHAR")
    return title, content, keywords
