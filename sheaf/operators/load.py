"""Collection load (K4, X3): documents → chunks → vectors → collections kept as a base and deltas.

A store is append-only. Every load writes one *generation*: the documents that
changed (``documents/gen=G``, partitioned by collection, with text, content
hash and state) and the points made of them (``points/gen=G``). A state row,
written last and under a new number, names the generations that count, oldest
first; readers take the newest state, so a load that ends half-way leaves the
old state readable, and two loads at once can't both succeed on one state.

A document's newest generation wins on read: points of an older one are left
out by an anti join with the documents of the later generations (small beside
the base). A document whose new text is empty, or that a ``replace`` load
drops, leaves a row with its state there, so nothing disappears without a
trace. What a load writes follows the batch, not the collection;
:func:`compact` folds all generations into a new base.

One job serves all collections: chunking is pure expressions, embedding runs
per Arrow batch in the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import mean_file_size, remove_path
from .documents import CHUNK_SIZE, chunk_documents, content_for, content_hash
from .models import EMBEDDING_DIM, embed

#: States of a stored document: its chunks are live, its text holds no token, a replacing load left it out.
LIVE, EMPTY, DROPPED = "live", "empty", "dropped"

BROADCAST_KEYS = 2_000_000  # later documents whose keys are sent to all tasks (some 250 MB); beyond, both sides are shuffled
SMALL_FILE = 4_000_000      # bytes of a file below which a compaction deals rows out anew
TOKEN = r"[^ \t\n\r\f\x0B]"  # a text with such a character holds a token

DOCUMENTS = ("gen string, collection string, doc_id string, text string, metadata map<string,string>, "
             "excluded_embed_keys array<string>, content_hash string, state string, loaded_by string")
POINTS = ("gen string, collection string, doc_id string, chunk_no bigint, node_id string, n_tokens bigint, chunk_text string, "
          "content_hash string, embedding array<float>, loaded_by string")

CARRY = ["collection", "doc_id", "metadata", "excluded_embed_keys", "content_hash"]


def chunk_points(docs: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """Chunks with a stable ``node_id`` and the embedding input (visible
    metadata + chunk text). Rows: ``collection, doc_id, chunk_no, node_id,
    n_tokens, chunk_text, embed_input`` (and ``content_hash`` when the
    documents carry one)."""
    # Metadata rides along through the explode: no join back, no shuffle.
    carry = [c for c in CARRY if c in docs.columns]
    chunks = chunk_documents(docs, keys=carry, size=size)
    extra = ["content_hash"] if "content_hash" in carry else []
    return chunks.select(
        "collection", "doc_id", "chunk_no",
        F.sha2(F.concat_ws("\u0001", "collection", "doc_id", F.col("chunk_no").cast("string")), 256).alias("node_id"),
        "n_tokens", "chunk_text", *extra,
        content_for("metadata", "excluded_embed_keys", "chunk_text").alias("embed_input"))


def prepare_documents(docs: DataFrame, *more: Column) -> DataFrame:
    """Documents with defaults for missing metadata/exclusions and the
    ``content_hash`` of what a load stores (text and rendered metadata)."""
    empty_map = F.create_map().cast("map<string,string>")
    meta = F.coalesce(F.col("metadata"), empty_map) if "metadata" in docs.columns else empty_map
    excluded = (F.coalesce(F.col("excluded_embed_keys"), F.array().cast("array<string>"))
                if "excluded_embed_keys" in docs.columns else F.array().cast("array<string>"))
    return docs.select("collection", "doc_id", "text", meta.alias("metadata"),
                       excluded.alias("excluded_embed_keys"),
                       content_hash(F.col("text"), meta).alias("content_hash"), *more)


def generations(spark: SparkSession, store: str) -> tuple[int, list[str]]:
    """Number of the newest state, and the generations that it names, oldest first; ``(0, [])`` without a store."""
    try:
        states = spark.read.schema("generations array<string>, v int").json(f"{store.rstrip('/')}/state")
    except AnalysisException:
        return 0, []
    newest = states.orderBy(F.desc("v")).first()
    return (newest["v"], list(newest["generations"])) if newest else (0, [])


def _commit(spark: SparkSession, store: str, number: int, names: list[str]) -> None:
    """Write the state ``number``; fails if another load wrote it first."""
    row = spark.createDataFrame([(names,)], "generations array<string>")
    row.coalesce(1).write.mode("errorifexists").json(f"{store}/state/v={number}")


def _read(spark: SparkSession, store: str, kind: str, names: list[str], schema: str) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    root = f"{store.rstrip('/')}/{kind}"
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/gen={g}" for g in names])


def _without_superseded(rows: DataFrame, later: DataFrame) -> DataFrame:
    """``rows`` without those of documents that ``later`` (rows of later generations) holds in a newer one.

    The keys of up to BROADCAST_KEYS later documents go to the rows, so that texts and vectors stay where they are.
    """
    newest = (later.groupBy("collection", "doc_id").agg(F.max("gen").alias("_newest"))
              .select(F.col("collection").alias("_c"), F.col("doc_id").alias("_d"), "_newest"))
    if later.count() <= BROADCAST_KEYS:  # read from the files' footers
        newest = F.broadcast(newest)
    same = F.col("collection").eqNullSafe(F.col("_c")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("gen") < F.col("_newest"))
    return rows.join(newest, same, "left_anti")


def _live(spark: SparkSession, store: str, kind: str, schema: str, names: list[str]) -> DataFrame:
    rows = _read(spark, store, kind, names, schema)
    if len(names) < 2:
        return rows
    return _without_superseded(rows, _read(spark, store, "documents", names[1:], DOCUMENTS))


def _write(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy("collection").option("compression", "zstd").parquet(path)


def read_collection(spark: SparkSession, store: str) -> DataFrame:
    """The points of the newest state: ``collection, doc_id, chunk_no, node_id, n_tokens, chunk_text, content_hash, embedding, loaded_by``."""
    return _live(spark, store, "points", POINTS, generations(spark, store)[1]).drop("gen")


def read_documents(spark: SparkSession, store: str) -> DataFrame:
    """The newest row of every document ever loaded, with its ``state`` (live, empty or dropped)."""
    return _live(spark, store, "documents", DOCUMENTS, generations(spark, store)[1]).drop("gen")


def _changes(docs: DataFrame, stored: DataFrame, replace: bool, sequence: str | None = None) -> DataFrame:
    """The documents of ``docs`` that ``stored`` doesn't hold as they are, one for each (collection, doc_id): the last
    by ``sequence``, then by hash; with ``replace`` also the others of its collections, as dropped.

    Texts are shuffled once: documents and stored hashes are dealt out together by ranges of their keys, which settles
    a key's rows side by side and leaves the rows of a collection to few tasks, each of which writes its files.
    """
    held = stored.select("collection", "doc_id", F.col("content_hash").alias("_hash"), F.col("state").alias("_state"), F.lit(0).alias("_side"))
    if replace:
        held = held.join(docs.select("collection").distinct(), "collection", "left_semi")
    ready = prepare_documents(docs, (F.col(sequence) if sequence else F.lit(0)).alias("_order"), F.lit(1).alias("_side"))
    both = ready.unionByName(held, allowMissingColumns=True).repartitionByRange("collection", "doc_id")
    # A stored row comes first of its key, then the document that counts.
    key = Window.partitionBy("collection", "doc_id")
    placed = key.orderBy("_side", F.col("_order").desc(), F.col("content_hash").desc())
    both = (both.withColumn("_at", F.row_number().over(placed)).withColumn("_first", F.first("_side").over(placed))
            .withColumn("_was", F.first("_hash").over(placed)).withColumn("_was_state", F.first("_state").over(placed)))
    counts = (F.col("_side") == 1) & (F.col("_at") == 2 - F.col("_first"))
    changed = (F.col("_first") == 1) | ~F.col("_was").eqNullSafe(F.col("content_hash")) | (F.col("_was_state") == DROPPED)
    kept = counts & changed
    if replace:
        both = both.withColumn("_sides", F.max("_side").over(key))
        kept = kept | ((F.col("_sides") == 0) & (F.col("_state") != DROPPED))
    state = F.when(F.col("_side") == 0, F.lit(DROPPED)).when(F.col("text").rlike(TOKEN), F.lit(LIVE)).otherwise(F.lit(EMPTY))
    return both.filter(kept).select("collection", "doc_id", "text", "metadata", "excluded_embed_keys", "content_hash", state.alias("state"))


def load_documents(docs: DataFrame, store_path: str, size: int = CHUNK_SIZE,
                   embed_fn: Callable | None = None, dim: int = EMBEDDING_DIM, run: str | None = None,
                   metrics: dict | None = None, replace: bool = False, sequence: str | None = None,
                   compact_after: int | None = None) -> str:
    """K4 + X3: upsert ``docs`` (which carry ``collection``) into the store; returns its path.

    Documents whose content hash equals the stored one are skipped (neither
    chunked nor embedded again); the others are written as one generation. Of
    several documents with one (collection, doc_id) the one with the largest
    ``sequence`` is loaded (ties, or no sequence: the largest content hash).
    ``replace=True`` also drops what the batch's collections hold beside it.
    With ``compact_after`` a load that leaves more generations compacts them.

    A7: ``metrics`` receives ``chunks`` and ``embedded`` (both counts of what
    this run wrote; nothing is carried over), observed during the write itself.
    """
    from ..sources.staging import run_id
    spark, store = docs.sparkSession, store_path.rstrip("/")
    run = run or run_id()
    number, names = generations(spark, store)
    gen = f"{number + 1:010d}-{uuid.uuid4().hex[:12]}"
    stored = _live(spark, store, "documents", DOCUMENTS, names)
    _write(_changes(docs, stored, replace, sequence).withColumn("loaded_by", F.lit(run)), f"{store}/documents/gen={gen}")

    written = _read(spark, store, "documents", [gen], DOCUMENTS)
    live = written.filter(F.col("state") == LIVE)
    # A task reads files of few collections and writes its chunks to as many, so no chunk or vector is shuffled.
    points = embed(chunk_points(live, size), text="embed_input", fn=embed_fn, dim=dim).drop("embed_input").withColumn("loaded_by", F.lit(run))
    observation = Observation("load") if metrics is not None else None
    if observation is not None:
        points = points.observe(observation, F.count(F.lit(1)).alias("chunks"), F.count(F.lit(1)).alias("embedded"))
    _write(points, f"{store}/points/gen={gen}")
    if written.isEmpty():
        remove_path(spark, f"{store}/documents/gen={gen}")
        remove_path(spark, f"{store}/points/gen={gen}")
        if not names:
            _commit(spark, store, number + 1, [])
    else:
        _commit(spark, store, number + 1, [*names, gen])
        if compact_after is not None and len(names) + 1 > compact_after:
            compact(spark, store)
    if observation is not None:
        metrics.update(observation.get)
    return store_path


def compact(spark: SparkSession, store_path: str, keep_old: bool = False) -> str:
    """Fold all generations into a new base; returns the store's path.

    Rows are copied as they are (no chunking, no embedding); they are shuffled
    only to join small files (below SMALL_FILE on average). Old generations
    are removed after the new state is written unless ``keep_old`` (for readers
    that still hold the old state).
    """
    store = store_path.rstrip("/")
    number, names = generations(spark, store)
    if len(names) < 2:
        return store_path
    gen = f"{number + 1:010d}-{uuid.uuid4().hex[:12]}"
    for kind, schema in (("documents", DOCUMENTS), ("points", POINTS)):
        rows = _live(spark, store, kind, schema, names).drop("gen")
        small = mean_file_size(spark, [f"{store}/{kind}/gen={g}" for g in names]) < SMALL_FILE
        _write(rows.hint("rebalance", "collection") if small else rows, f"{store}/{kind}/gen={gen}")
    _commit(spark, store, number + 1, [gen])
    if not keep_old:
        for name in names:
            remove_path(spark, f"{store}/documents/gen={name}")
            remove_path(spark, f"{store}/points/gen={name}")
    return store_path
