"""The stored index: immutable batches and a version that names them.

Under an index's folder:

  versions/<n>.json        what version n consists of (below); the highest counts
  g-<id>/postings/batch=<b>/part=<p>/   bucketed by doc_id, sorted by term in a
                           bucket; a term's part is a hash of it
  g-<id>/docs/batch=<b>/   doc_id, n_tokens, n_unique [, extra columns]
  g-<id>/terms/<t>/        term, df of one batch, or of several merged

Files are never changed: a write makes a new batch (an overwrite a new
generation ``g-<id>``) beside what is there, checks it, and writes the next
version last, by renaming one small file. A writer that fails or is killed
leaves the index as it was; a reader sees the version it opened. What no kept
version names is removed by ``vacuum``.

The dictionary is kept as the batches' own document frequencies, added up when
they are read; an append computes those of its batch alone. ``MAX_DELTAS`` bounds
how many there are (``_compacted``). The corpus statistics are sums that the
version holds. A version has a row for each batch, so it stays small.

Documents that share a key: ``repeats="refuse"`` fails the write, ``"merge"``
makes them one document with the words of all. That holds for ``save_index``
and for ingest; keys that earlier batches hold fail an append, and are counted
and left out by ingest (insert or ignore).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexis.operators.index import Index, docs_from_postings, terms_from_postings

#: Bytes of documents a bucket is sized for, and those that a file of it (one
#: for each part) is.
BUCKET_BYTES = 4 << 30
FILE_BYTES = 64 << 20
MAX_BUCKETS = 100_000
#: Folders of document frequencies at most; one more, and they are merged.
MAX_DELTAS = 8
#: Versions that ``save_index`` keeps readable when it overwrites an index.
KEPT_VERSIONS = 2


# --- files -------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that are there, in order."""
    return [int(n[:-5]) for n in _names(spark, f"{path.rstrip('/')}/versions") if n.endswith(".json")]


def read_version(spark: SparkSession, path: str, number: int | None = None) -> dict[str, Any] | None:
    """A version (the highest by default); None where no index is stored."""
    path = path.rstrip("/")
    if number is None:
        there = versions(spark, path)
        if not there:
            return None
        number = there[-1]
    fs, p = _fs(spark, f"{path}/versions/{number:010d}.json")
    stream = fs.open(p)
    try:
        state = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return state | {"number": number}


def commit(spark: SparkSession, path: str, state: dict[str, Any], after: int) -> None:
    """Make ``state`` the version that follows ``after``. One file, renamed into
    place; a number that another writer has taken fails."""
    fs, place = _fs(spark, f"{path}/versions/{after + 1:010d}.json")
    _, draft = _fs(spark, f"{path}/versions/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(json.dumps({k: v for k, v in state.items() if k != "number"}).encode())
    finally:
        out.close()
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer has made version {after + 1} of {path}: try again")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove what none of the latest ``keep`` versions names: older versions,
    generations, batches, frequencies. Not while a writer is at work."""
    path = path.rstrip("/")
    there = versions(spark, path)
    kept = [read_version(spark, path, n) for n in there[-keep:]]
    gone = [f"{path}/versions/{n:010d}.json" for n in there[:-keep]]
    gone += [f"{path}/versions/{n}" for n in _names(spark, f"{path}/versions") if n.startswith(".draft-")]
    live = {s["generation"] for s in kept}
    for g in (n for n in _names(spark, path) if n.startswith("g-")):
        if g not in live:
            gone.append(f"{path}/{g}")
            continue
        of = [s for s in kept if s["generation"] == g]
        batches = {f"batch={b['folder']}" for s in of for b in s["batches"]}
        terms = {x for s in of for t in s["terms"] for x in (t["folder"], *t["of"])}
        for kind, wanted in (("postings", batches), ("docs", batches), ("terms", terms)):
            gone += [f"{path}/{g}/{kind}/{n}" for n in _names(spark, f"{path}/{g}/{kind}")
                     if n not in wanted and not n.startswith(("_", "."))]
    for name in gone:
        fs, p = _fs(spark, name)
        fs.delete(p, True)


# --- postings ------------------------------------------------------------------

def postings_table_name(path: str) -> str:
    """Session-catalog name of the postings table stored at ``path``."""
    return "lexis_postings_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()[:16]


def bucket_count(df: DataFrame) -> int:
    """Buckets for postings made from ``df``: as many as its bytes ask for
    (by the planner's statistics), and at least one for each shuffle task."""
    spark = df.sparkSession
    least = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(MAX_BUCKETS, max(least, -(-_plan_bytes(df) // BUCKET_BYTES)))


def part_count(df: DataFrame, buckets: int) -> int:
    """Parts by term, so that a file of a bucket keeps a useful size."""
    return max(1, _plan_bytes(df) // (buckets * FILE_BYTES))


def _plan_bytes(df: DataFrame) -> int:
    """Bytes of a plan by the planner's statistics (0 if not known)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def term_part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(int(parts))).cast("int")


def _table(spark: SparkSession, path: str, state: dict[str, Any]) -> str:
    """Name of the postings table of the state's generation, registered in
    this session's catalog, its batches listed."""
    name, g = postings_table_name(path), state["generation"]
    if spark.catalog.tableExists(name):
        known = spark.sql(f"SHOW TBLPROPERTIES {name} ('lexis.generation')").first()
        if known is None or known["value"] != g:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        where = f"{path}/{g}/postings".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({state['columns']}, batch STRING, part INT) USING parquet "
                  f"PARTITIONED BY (batch, part) CLUSTERED BY (doc_id) SORTED BY (term) INTO {state['buckets']} "
                  f"BUCKETS LOCATION '{where}' TBLPROPERTIES ('lexis.generation' = '{g}')")
    if path_exists(spark, f"{path}/{g}/postings"):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def new_generation(postings: DataFrame, buckets: int | None = None, term_parts: int | None = None) -> dict[str, Any]:
    """The state of an index that holds nothing yet, laid out for ``postings``."""
    buckets = buckets or bucket_count(postings)
    return {"generation": f"g-{uuid.uuid4().hex[:16]}", "buckets": int(buckets),
            "parts": int(term_parts or part_count(postings, buckets)),
            "columns": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in postings.schema),
            "batches": [], "terms": [], "number": 0}


def merge_postings(postings: DataFrame) -> DataFrame:
    """Postings in which documents that share a key are one document with the
    words of all. Rows of a document meet by doc_id, as the store deals them."""
    one = Window.partitionBy("doc_id")
    p = postings.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    p = p.withColumns({"n_tokens": F.sum("tf").over(one), "n_unique": F.count(F.lit(1)).over(one)})
    return p.select(postings.columns)


def write_batch(spark: SparkSession, path: str, state: dict[str, Any], postings: DataFrame, docs: DataFrame,
                batch: str | None = None, all_docs: bool = False) -> dict[str, Any]:
    """Write one batch beside what is stored and return its row of a version.
    ``docs`` brings further columns, and with ``all_docs`` the documents without
    words. Nothing names the batch until a version does.

    Postings cross one exchange, by doc_id; the document rows and frequencies
    are computed from what was written."""
    folder, g = uuid.uuid4().hex, f"{path}/{state['generation']}"
    name = _table(spark, path, state)
    # A static partition, written in the frame's own session (a micro-batch
    # has one of its own).
    session, view = postings.sparkSession, f"postings_{folder}"
    (postings.withColumn("part", term_part(F.col("term"), state["parts"])).repartition(state["buckets"], "doc_id")
             .createOrReplaceTempView(view))
    try:
        session.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (batch = '{folder}', part) SELECT * FROM {view}")
    finally:
        session.catalog.dropTempView(view)
    spark.catalog.refreshTable(name)
    stored = spark.table(name).where(F.col("batch") == folder).drop("batch", "part")
    found = docs_from_postings(stored, docs, counted=True)
    if all_docs:
        found = docs.select("doc_id").distinct().join(found, "doc_id", "left").na.fill(0, ["n_tokens", "n_unique", "n_rows"])
    found.write.parquet(f"{g}/docs/batch={folder}")
    rows = spark.read.parquet(f"{g}/docs/batch={folder}")
    has = F.col("n_tokens") > 0
    got = rows.agg(F.count(F.when(has, 1)).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"),
                   F.coalesce(F.sum("n_unique"), F.lit(0)).alias("n_postings"),
                   F.min("doc_id").cast("string").alias("least"), F.max("doc_id").cast("string").alias("most"),
                   F.min(F.when(F.col("n_rows") != F.col("n_unique"), F.col("doc_id"))).cast("string").alias("twice")).first()
    if got.twice is not None:
        raise ValueError(f"document key {got.twice} repeats: merge or drop it first")
    terms_from_postings(stored).drop("term_id").sortWithinPartitions("term").write.parquet(f"{g}/terms/{folder}")
    return {"batch": batch or folder, "folder": folder, "ignored": 0, "n_docs": got.n_docs, "n_tokens": got.n_tokens,
            "n_postings": got.n_postings, "least": got.least, "most": got.most}


def with_batch(spark: SparkSession, path: str, state: dict[str, Any], row: dict[str, Any]) -> dict[str, Any]:
    """The state with one more batch; one of the same name is replaced, and
    the frequencies are then those of the batches left."""
    others = [b for b in state["batches"] if b["batch"] != row["batch"]]
    terms = state["terms"]
    if len(others) < len(state["batches"]):
        gone = {b["folder"] for b in state["batches"]} - {b["folder"] for b in others}
        terms = [t for t in terms if not gone & set(t["of"])]
        left = [f for t in state["terms"] if gone & set(t["of"]) for f in t["of"] if f not in gone]
        terms += [{"folder": f, "of": [f]} for f in left]
    terms = [*terms, {"folder": row["folder"], "of": [row["folder"]]}]
    return _compacted(spark, path, state | {"batches": [*others, row], "terms": terms})


def _compacted(spark: SparkSession, path: str, state: dict[str, Any]) -> dict[str, Any]:
    """Frequencies merged when there are too many: the newest ones, and older
    ones as long as they stand for no more postings than what is merged."""
    if len(state["terms"]) <= MAX_DELTAS:
        return state
    size = {b["folder"]: b["n_postings"] for b in state["batches"]}
    weight = [sum(size[f] for f in t["of"]) for t in state["terms"]]
    at = len(weight) - 2
    while at > 0 and (weight[at - 1] <= sum(weight[at:]) or at >= MAX_DELTAS - 1):
        at -= 1
    old, new = state["terms"][:at], state["terms"][at:]
    folder = uuid.uuid4().hex
    base = f"{path}/{state['generation']}/terms"
    _summed(spark, [f"{base}/{t['folder']}" for t in new]).sortWithinPartitions("term").write.parquet(f"{base}/{folder}")
    return state | {"terms": [*old, {"folder": folder, "of": [f for t in new for f in t["of"]]}]}


def _summed(spark: SparkSession, folders: list[str]) -> DataFrame:
    deltas = spark.read.parquet(*folders)
    return deltas if len(folders) == 1 else deltas.groupBy("term").agg(F.sum("df").alias("df"))


def stored_docs(spark: SparkSession, path: str, state: dict[str, Any], batches: list[dict[str, Any]] | None = None,
                ) -> DataFrame:
    """Document rows of the state's batches, or of some of them."""
    base = f"{path}/{state['generation']}/docs"
    rows = state["batches"] if batches is None else batches
    return (spark.read.option("mergeSchema", "true").option("basePath", base)
                 .parquet(*[f"{base}/batch={b['folder']}" for b in rows]).drop("batch", "n_rows"))


def batches_near(docs: DataFrame, state: dict[str, Any], keys: tuple[str | None, str | None]) -> list[dict[str, Any]]:
    """The batches whose range of whole-number keys meets ``keys``: only they
    can hold one of them. Keys of another type: all batches."""
    if dict(docs.dtypes)["doc_id"] not in ("bigint", "int") or keys[0] is None:
        return [] if keys[0] is None else state["batches"]
    low, high = map(int, keys)
    return [b for b in state["batches"] if b["least"] is not None and int(b["least"]) <= high and int(b["most"]) >= low]


def save_index(index: Index, path: str, mode: str = "overwrite", buckets: int | None = None,
               term_parts: int | None = None, repeats: str = "refuse") -> Index:
    """Write the index under ``path`` and return it read back.

    Postings are stored document-partitioned: a table bucketed by doc_id, each
    bucket sorted by term. Every search aggregates per (query, document), and
    with this layout that aggregation -- and the top-k that follows -- runs
    inside each bucket's task with no exchange of candidate rows; the sort by
    term lets parquet row-group statistics skip most of a file for rare query
    terms, and a search reads only the parts its words hash to. The other tables
    are computed from the stored postings, so the corpus is tokenized once.

    ``mode``: "overwrite" replaces the index; "append" adds the documents as a
    new batch. Keys that are stored already are refused; for keys that repeat
    within ``index`` see ``repeats``. Either the whole write counts or nothing.
    """
    if mode not in ("overwrite", "append") or repeats not in ("refuse", "merge"):
        raise ValueError(f"mode {mode!r}, repeats {repeats!r}: not supported")
    spark, path = index.sparkSession, path.rstrip("/")
    postings = merge_postings(index.postings) if repeats == "merge" else index.postings
    before = read_version(spark, path)
    state = before if mode == "append" and before else new_generation(postings, buckets, term_parts)
    docs = index.docs.dropDuplicates(["doc_id"]) if repeats == "merge" else index.docs
    row = write_batch(spark, path, state, postings, docs)
    own = stored_docs(spark, path, state, [row])
    near = batches_near(own, state, (row["least"], row["most"]))
    if near:
        again = own.join(stored_docs(spark, path, state, near).select("doc_id"), "doc_id", "left_semi").limit(1).collect()
        if again:
            raise ValueError(f"document key {again[0]['doc_id']!r} is stored: drop it first")
    commit(spark, path, with_batch(spark, path, state, row), before["number"] if before else 0)
    if mode == "overwrite" and before:
        vacuum(spark, path, keep=KEPT_VERSIONS)
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str, number: int | None = None) -> Index:
    """Open a stored index, in whatever session or process: its latest version,
    or an earlier one that is still kept."""
    path = path.rstrip("/")
    state = read_version(spark, path, number)
    if state is None:
        raise ValueError(f"no index is stored at {path}")
    batches = state["batches"]
    parted = spark.table(_table(spark, path, state))
    parted = parted.where(F.col("batch").isin([b["folder"] for b in batches])).drop("batch")
    base = f"{path}/{state['generation']}/terms"
    terms = _summed(spark, [f"{base}/{t['folder']}" for t in state["terms"]])
    n_docs, n_tokens, n_postings = (sum(b[k] for b in batches) for k in ("n_docs", "n_tokens", "n_postings"))
    corpus = spark.createDataFrame(
        [(n_docs, n_tokens, n_postings, n_postings / max(n_docs, 1), n_tokens / max(n_docs, 1))],
        "n_docs long, n_tokens long, n_postings long, avg_unique double, avg_tokens double")
    docs = stored_docs(spark, path, state).where(F.col("n_tokens") > 0)
    return Index(postings=parted.drop("part"), terms=terms.select("term", F.md5("term").alias("term_id"), "df"),
                 docs=docs, corpus=corpus, parted=parted, term_parts=state["parts"])
