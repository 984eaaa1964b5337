"""Queries of the training-data operators: ``opN_<name>`` and ``pipeline``.

Each query applies its operator with production parameters to the whole
intended table. ``ORACLE_SQL`` has DuckDB twins where SQL can say the same;
the others are tested against brute force, round trips or held-out labels in
``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.llm import decontaminate, knn, line_dedup, merkle, mixing, pieces, quality, simhash
from lexis.llm import substring_dedup, surrogates, token_ids, url_filter, whitening
from lexis.session import scratch_path
from lexis.sources.corpus import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
PIECE_MODEL = "piece_bpe_32k.model"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def tokenizer_json(name: str = TOKENIZER) -> str:
    """Text of a public tokenizer's file, read on the driver."""
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def token_digests(docs: DataFrame) -> DataFrame:
    """Write the token ids of ``docs`` as shards and read their digests back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    token_ids.write_token_ids(docs, path, tokenizer_json(), END_ID)
    return token_ids.read_token_ids(spark, path, digest=True)


@register("op1_token_ids")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, from the shard files."""
    return token_digests(table(spark, sf_dir, "documents"))


@register("op2_voronoi_knn", """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 10""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 10 best of every 100th vector."""
    return knn.knn_join(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


HOST_SQL = r"""translate(regexp_extract(
  CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END,
  '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


@register("op3_line_dedup", rf"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id, coalesce({HOST_SQL}, '') AS host,
         list_filter(list_transform(string_split_regex(
           regexp_replace(regexp_replace(coalesce(html, ''),
             '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', chr(10), 'g'),
             '(?i)</?(?:a|abbr|b|code|em|i|small|span|strong|sub|sup|u)(?:\s[^<>]*)?>', '', 'g'),
           '<[^<>]*>|\n'), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
  FROM pages),
h AS (SELECT host, count(*) AS n FROM p GROUP BY host),
l AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS same FROM (
  SELECT r, host, page_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM p)),
f AS (SELECT host, same, count(DISTINCT r) AS k FROM l GROUP BY ALL),
bad AS (SELECT f.host, f.same FROM f JOIN h USING (host) WHERE k > n * {line_dedup.MAX_RATIO}::DOUBLE),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM l
         WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.host = l.host AND bad.same = l.same) GROUP BY r)
SELECT page_id, host, len(lines) AS n_lines, len(lines) - coalesce(kept.n, 0) AS n_dropped,
       coalesce(kept.text, '') AS text
FROM p LEFT JOIN kept USING (r)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, n_lines, n_dropped, text: pages without boilerplate."""
    return line_dedup.clean_pages(table(spark, sf_dir, "pages"), url_filter.url_parts("url")[0],
                                  line_dedup.html_lines("html"))


@register("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, end, n_units, n_words, first_doc_ids: removed stretches."""
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("text_hash")


@register("op5_url_filter", f"""
WITH u AS (
  SELECT page_id, coalesce({HOST_SQL}, '') AS host,
         coalesce(regexp_extract(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                  ELSE '' END, '(?s)^[^/?#]*(/?[^?#]*)', 1), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT u.*, h || p AS rule, v FROM u LEFT JOIN rules
      ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@register("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id."""
    g = simhash.groups(table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    return quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))


@register("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality_model(spark, docs, sf_dir))


@register("op8_surrogates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_entities, text: texts with surrogates in place of entities."""
    return surrogates.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


WORDS_SQL = (r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")


@register("op9_decontaminate", f"""
WITH b AS (SELECT item_id::VARCHAR AS id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
bl AS (SELECT id, w, least({decontaminate.WINDOW}, len(w)) AS l FROM b WHERE len(w) > 0),
bi AS (SELECT id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM bl),
bw AS (SELECT DISTINCT id, l, w[i:i + l - 1] AS g FROM bi),
d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
di AS (SELECT r, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i
       FROM d JOIN (SELECT DISTINCT l FROM bw) ls ON len(w) >= l),
hits AS (SELECT r, i, bw.l, id FROM (SELECT r, i, l, w[i:i + l - 1] AS g FROM di) dw
         JOIN bw ON dw.l = bw.l AND dw.g = bw.g),
pos AS (SELECT r, count(*) AS n_hit FROM
        (SELECT DISTINCT r, unnest(generate_series(i, i + l - 1)) AS k FROM hits) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS s
        FROM (SELECT DISTINCT r, id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {decontaminate.MIN_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op10_mix")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, and source and copies."""
    return mixing.mix_table(table(spark, sf_dir, "documents"))


# DuckDB has no crc32: bits are shifted out one by one, a byte entering
# before each eight shifts (-1 marks a shift).
CRC_SQL = r"""xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, s: CASE WHEN s >= 0 THEN xor(a::BIGINT, s::BIGINT)
    ELSE xor(a::BIGINT >> 1, CASE WHEN a::BIGINT & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
        for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_KIDS_SQL = "substr(kids, 1, 64 * (i % 16)::INT)", "substr(kids, 64 * (i % 16)::INT + 65)"
_UP_SQL = """SELECT k + 1, g, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
  FROM {0} WHERE n > 1 GROUP BY k, g, i // 16, n"""


@register("op11_merkle_manifest", f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, source AS g, {_leaf_sql("text")} AS leaf,
         CASE WHEN {CRC_SQL} % 5 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY g) AS n FROM docs),
tree(k, g, i, n, digest) AS (SELECT 0, g, i, n, leaf FROM leaves UNION ALL {_UP_SQL.format("tree")}),
tree_kids AS (SELECT k, g, i // 16 AS p, string_agg(digest, '' ORDER BY i) AS kids FROM tree WHERE n > 1 GROUP BY ALL),
tops AS (SELECT g, digest, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
wood(k, g, i, n, digest) AS (SELECT 0, 0, i, n, digest FROM tops UNION ALL {_UP_SQL.format("wood")}),
wood_kids AS (SELECT k, g, i // 16 AS p, string_agg(digest, '' ORDER BY i) AS kids FROM wood WHERE n > 1 GROUP BY ALL),
a(r, lvl, g, i, n, own, sib) AS (
  SELECT r, 0, g, i, n, coalesce(changed, leaf), '' FROM leaves UNION ALL
  SELECT r, lvl + 1, a.g, i // 16, (n + 15) // 16, sha256({_KIDS_SQL[0]} || own || {_KIDS_SQL[1]}),
         sib || {_KIDS_SQL[0]} || {_KIDS_SQL[1]}
  FROM a JOIN tree_kids c ON c.k = lvl AND c.g IS NOT DISTINCT FROM a.g AND c.p = i // 16 WHERE n > 1),
b(r, lvl, i, n, own, sib) AS (
  SELECT r, 0, t.i, t.n, own, sib FROM a JOIN tops t ON t.g IS NOT DISTINCT FROM a.g WHERE a.n = 1 UNION ALL
  SELECT r, lvl + 1, i // 16, (n + 15) // 16, sha256({_KIDS_SQL[0]} || own || {_KIDS_SQL[1]}),
         sib || {_KIDS_SQL[0]} || {_KIDS_SQL[1]}
  FROM b JOIN wood_kids c ON c.k = lvl AND c.p = i // 16 WHERE n > 1)
SELECT doc_id, leaf, t.digest AS subroot, w.digest AS root, sha256(sib) AS proof_sha256, own AS folded_root,
       own = w.digest AS verified
FROM leaves l JOIN b ON b.r = l.r AND b.n = 1 JOIN tops t ON t.g IS NOT DISTINCT FROM l.g
JOIN wood w ON w.n = 1""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    m = merkle.manifest(table(spark, sf_dir, "documents"), carry={"changed": merkle.tampered_leaf()})
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("path"))
    m = m.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                 folded.alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))


@register("op12_sentencepiece")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    model = pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    ids = pieces.encode(table(spark, sf_dir, "documents"), model)
    ids = ids.withColumn("n_tokens", F.size("ids").cast("long")).withColumn(
        "ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256))
    kept = ["doc_id", "n_tokens", "ids_sha256"]
    return pieces.decode(ids, model, keep=kept).select(*kept, F.sha2("text", 256).alias("decoded_sha256"))


@register("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))
