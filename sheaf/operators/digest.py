"""Real-time digest over recent points (P17, F5, F8, W9, W14, L2, P19, A3,
A8, F4, F17).

The reference answers one request: points of one collection newer than a
threshold, at most 500, their texts (author-prefixed) joined with newlines,
then handed to a model. Here any number of requests is answered by one job:
the recent points are filtered once (``createdAt > threshold`` is pushed into
a stored ``points`` scan), limited per collection map-side
(``WindowGroupLimit``) and aggregated per collection. Requests may each have a
period of their own; points then go to the buckets between a collection's
sorted thresholds, and only what the limit leaves of a bucket is ever copied
to the periods that reach back to it (:func:`digest_requests`).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_seconds, period_threshold, period_threshold_col
from ..functions.names import digest_collection
from ..functions.payload import NO_RECENT_DATA, NO_TEXT_CONTENT, digest_line, lacks_metadata
from ..quality import REASON, first_reason
from ..session import scratch_path
from .summaries import limit_report, top_per_key

DIGEST_LIMIT = 500  # points per digest (the search limit of the reference)

# Fixed value: the instruction placed before the content (must equal the reference's).
PROMPT_PREFIX = ("Please provide a concise summary of the following content, "
                 "focusing on the key points and main themes. ")


def recent_points(points: DataFrame, threshold: float) -> DataFrame:
    """Strictly newer than ``threshold`` (epoch seconds), no upper bound."""
    return points.filter(F.col("createdAt") > F.lit(threshold)) \
        .select("collection", "point_id", "_node_content")


def digest_lines(recent: DataFrame, limit: int = DIGEST_LIMIT, keys: Sequence[str] = ("collection",)) -> DataFrame:
    """L2 + W14 + P19: the first ``limit`` points per key (by id) and
    their digest line (NULL for points without text)."""
    limited = top_per_key(recent, keys, "point_id", limit)
    return limited.withColumn("line", digest_line("_node_content"))


def aggregate_digest(lines: DataFrame, keys: Sequence[str] = ("collection",)) -> DataFrame:
    """A3 + A8 per key: counts and the joined text."""
    return lines.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_points"),
        F.count("line").cast("bigint").alias("n_texts"),
        F.expr("listagg(line, '\\n') WITHIN GROUP (ORDER BY point_id)").alias("combined"),
    )


def resolve_requests(requests: DataFrame) -> DataFrame:
    """P17 on a request table (``request_id, collection_name, community_id,
    platform_id``); unresolvable requests get reason ``no_collection``."""
    name = digest_collection("collection_name", "community_id", "platform_id")
    return (requests.withColumn("collection", name)
            .withColumn(REASON, first_reason([(name.isNull(), "no_collection")])))


def bucket_of(value: Column, bounds: Column) -> Column:
    """How many of the ascending ``bounds`` lie below ``value``, less one (binary search): -1 if none does."""
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + F.lit(1))).cast("int"))

    def step(found: Column, _: Column) -> Column:
        lo, hi = found["lo"], found["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        above = F.get(bounds, mid) < value
        return F.when(lo >= hi, found).otherwise(F.struct(F.when(above, mid + 1).otherwise(lo).alias("lo"),
                                                          F.when(above, hi).otherwise(mid).alias("hi")))

    return F.aggregate(steps, start, step)["lo"] - 1


def recent_by_request(points: DataFrame, req: DataFrame, limit: int) -> DataFrame:
    """J5 + W9 + L2: for each distinct (collection, threshold) of the valid requests its first ``limit`` newer points.

    A collection's thresholds, sorted, bound its buckets; each point goes to
    one bucket and tasks keep the ``limit`` least ids of every bucket. Buckets
    are merged in pairs, pairs of pairs and so on, keeping the limit at each
    step, and a threshold takes the few blocks that together hold all buckets
    from its own on. So a point that the limit leaves out is never copied,
    however many periods ask for it, and what is copied follows the buckets.
    """
    spark = points.sparkSession
    asked = req.filter(F.col(REASON).isNull()).select("collection", "threshold").distinct()
    bounds = asked.groupBy("collection").agg(F.array_sort(F.collect_list("threshold")).alias("bounds"))
    least = asked.agg(F.min("threshold")).first()[0]
    newer = points.filter(F.col("createdAt") > F.lit(least)) if least is not None else points.limit(0)
    own = (newer.select("collection", "point_id", "createdAt", "_node_content").join(bounds, "collection")
           .filter(F.col("createdAt") > F.get("bounds", F.lit(0)))
           .select("collection", bucket_of(F.col("createdAt"), F.col("bounds")).alias("bucket"), "point_id", "_node_content",
                   F.size("bounds").alias("n")))
    path = scratch_path(spark, "buckets")
    top_per_key(own, ["collection", "bucket"], "point_id", limit).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    kept = spark.read.parquet(path)

    top = F.ceil(F.log2(F.col("n").cast("double"))).cast("int")
    blocks = (kept.select("collection", "bucket", "point_id", "row", F.explode(F.sequence(F.lit(0), top)).alias("level"))
              .withColumn("block", F.expr("shiftright(bucket, level)")))
    blocks = top_per_key(blocks, ["collection", "level", "block"], ["point_id", "row"], limit)
    reach = bounds.select("collection", F.size("bounds").alias("n"), F.posexplode("bounds").alias("i", "threshold"))
    reach = (reach.withColumn("level", F.explode(F.sequence(F.lit(0), top)))
             .withColumn("block", F.expr("shiftright(i + shiftleft(1, level) - 1, level)"))
             # From ``i`` on, a level gives a block where the rounded position is odd; the top level all, for position 0.
             .filter(F.when(F.col("level") == top, F.col("block") == 0)
                     .otherwise((F.col("block") % 2 == 1) & (F.col("block") < F.expr("shiftleft(1, cast(ceil(log2(cast(n as double))) as int) - level)"))))
             .select("collection", "threshold", "level", "block"))
    found = blocks.join(reach, ["collection", "level", "block"]).select("collection", "threshold", "point_id", "row")
    found = top_per_key(found, ["collection", "threshold"], ["point_id", "row"], limit)
    return found.join(kept.select("row", "_node_content"), "row").drop("row")


def strict_nodes(recent: DataFrame) -> DataFrame:
    """F4, ``strict``: the points, or a job that fails at one whose text node has no ``metadata`` object."""
    node = F.col("_node_content")
    bad = lacks_metadata(node)
    message = F.concat(F.lit("a node without metadata: point "), F.col("point_id").cast("string"))
    return recent.withColumn("_node_content", F.when(bad, F.raise_error(message).cast("string")).otherwise(node))


def _answers(limited: DataFrame, req: DataFrame, strict: bool) -> DataFrame:
    """A digest for every resolved request out of the points of its (``collection, threshold``)."""
    keys = ["collection", "threshold"]
    if strict:
        limited = strict_nodes(limited)
    agg = aggregate_digest(limited.withColumn("line", digest_line("_node_content")), keys)
    n_points = F.coalesce(F.col("n_points"), F.lit(0)).cast("bigint")
    n_texts = F.coalesce(F.col("n_texts"), F.lit(0)).cast("bigint")
    digest = (F.when(F.col(REASON).isNotNull(), F.lit(None).cast("string"))
              .when(n_points == 0, F.lit(NO_RECENT_DATA))
              .when(n_texts == 0, F.lit(NO_TEXT_CONTENT))
              .otherwise(F.col("combined")))
    return (req.join(agg, keys, "left")
            .select("request_id", "collection",
                    F.coalesce(F.col(REASON), F.lit("ok")).alias("status"),
                    n_points.alias("n_points"), n_texts.alias("n_texts"),
                    digest.alias("digest")))


def digest_text(points: DataFrame, requests: DataFrame, threshold: float,
                limit: int = DIGEST_LIMIT, strict: bool = False) -> DataFrame:
    """Digest text for every request, all of one period (``threshold`` in epoch seconds,
    which also filters the scan of ``points``).

    Rows: ``request_id, collection, status, n_points, n_texts, digest``, where
    ``digest`` is the joined text, or one of the two fixed sentinels.
    """
    req = resolve_requests(requests).withColumn("threshold", F.lit(threshold).cast("double"))
    wanted = req.filter(F.col(REASON).isNull()).select("collection", "threshold").distinct()
    recent = recent_points(points, threshold).join(wanted, "collection")
    return _answers(top_per_key(recent, ["collection", "threshold"], "point_id", limit), req, strict)


def digest_requests(points: DataFrame, requests: DataFrame, as_of: datetime,
                    limit: int = DIGEST_LIMIT, strict: bool = False) -> DataFrame:
    """Digest text for every request, each with a ``period`` of its own (F5 as a column).

    A period that isn't one gives status ``bad_period`` and no digest. Rows as
    in :func:`digest_text`.
    """
    req = resolve_requests(requests).withColumn("threshold", period_threshold_col("period", as_of).cast("double"))
    req = req.withColumn(REASON, F.coalesce(F.col(REASON), F.when(F.col("threshold").isNull(), F.lit("bad_period"))))
    return _answers(recent_by_request(points, req, limit), req, strict)


def digest_dropped(points: DataFrame, threshold: float, limit: int = DIGEST_LIMIT) -> DataFrame:
    """L2 made visible: per collection the recent points and how many of them the limit leaves out.
    Rows: ``collection, n_total, n_dropped``."""
    return limit_report(recent_points(points, threshold), ["collection"], limit)


def digest_prompt(digests: DataFrame) -> DataFrame:
    """the model prompt for digests that have text (sentinels and
    rejected requests are answered without a model call)."""
    has_text = (F.col("status") == "ok") & (F.col("n_texts") > 0)
    return digests.filter(has_text).select(
        "request_id", "collection",
        F.concat(F.lit(PROMPT_PREFIX), F.lit("\n\nContent:\n"), F.col("digest")).alias("prompt"))


def fetch_recent(points: DataFrame, period: str | None = None, collection_name: str | None = None,
                 community_id: str | None = None, platform_id: str | None = None,
                 as_of: datetime | None = None, limit: int = DIGEST_LIMIT) -> DataFrame:
    """The reference's single digest request; argument errors raise as there."""
    if not collection_name and not (platform_id and community_id):
        raise ValueError("a digest request names its collection, or community and platform")
    threshold = epoch_seconds(period_threshold(period, as_of))
    spark = points.sparkSession
    req = spark.createDataFrame([(0, collection_name, community_id, platform_id)],
                                "request_id long, collection_name string, community_id string, platform_id string")
    return digest_text(points, req, threshold, limit)
