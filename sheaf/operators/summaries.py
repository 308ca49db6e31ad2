"""Stored-summary reads over a ``points`` table (S12, P14-P16, W8, W15, W16,
A1, A2, A4, A5, J2, J5, N1, L1, F1-F3, F6, F7).

``points`` columns: ``collection string, point_id bigint, date string
(YYYY-MM-DD), createdAt double, _node_content string``. At scale it is a
Parquet table partitioned by ``collection``, so a collection filter prunes
partitions and a date filter is pushed into the scan.

Every read runs as one Spark job for any number of requests: the per-request
and per-date loops of the reference become a key column. The per-key limit is
a ``row_number() <= n`` filter, which Spark plans as a ``WindowGroupLimit``:
each map task keeps at most ``n`` rows per key before the shuffle, so even a
(collection, date) holding a third of all points moves only ``n`` rows per
task across the network.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import check_range, day_spine, day_string, range_date_col
from ..functions.names import summary_collection
from ..functions.payload import is_json, parsed_content, summary_text
from ..quality import REASON, first_reason
from ..session import staged
from ..sources.points import latest_stored_dates, with_month

SUMMARY_LIMIT = 100  # summaries per date (the search limit of the reference)
POINT_COLUMNS = ["collection", "point_id", "date", "createdAt", "_node_content"]


def top_per_key(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], n: int) -> DataFrame:
    """At most ``n`` rows per key, the first by ``order`` (deterministic)."""
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n).drop("_rn"))


def limit_report(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """What a limit of ``n`` rows per key leaves out: ``keys, n_total, n_dropped`` (combined before the shuffle)."""
    total = F.count(F.lit(1)).cast("bigint")
    return df.groupBy(*keys).agg(total.alias("n_total"),
                                 F.greatest(total - n, F.lit(0)).cast("bigint").alias("n_dropped"))


def select_points(points: DataFrame, collection: str | None = None,
                  date: str | None = None, columns: Sequence[str] = POINT_COLUMNS) -> DataFrame:
    """S12 + W8: payload columns only (no vectors), optional equality filters
    that Catalyst pushes into the scan / partition pruning."""
    df = points
    if collection is not None:
        df = df.filter(F.col("collection") == F.lit(collection))
    if date is not None:
        df = df.filter(F.col("date") == F.lit(date))
    return df.select(*columns)


def parse_summaries(df: DataFrame) -> DataFrame:
    """add ``summary_text`` and a reject reason.

    Bad or missing JSON makes the reference's text join fail for the whole
    call; here such a point is quarantined (``bad_json`` / ``no_content``) and
    the others go on. A ``text`` that is JSON null is quarantined likewise.
    """
    node = F.col("_node_content")
    reason = first_reason([
        (node.isNull(), "no_content"),
        (~is_json(node), "bad_json"),
    ])
    text = summary_text(node)
    return (df.withColumn(REASON, F.coalesce(reason, F.when(text.isNull(), F.lit("null_text"))))
            .withColumn("summary_text", F.when(F.col(REASON).isNull(), text)))


def join_texts(df: DataFrame, keys: Sequence[str], text: str = "summary_text",
               order: str = "point_id", out: str = "summaries") -> DataFrame:
    """A2/A5: newline join per key in ``order``, ``""`` when nothing is left,
    with the number of joined texts and of quarantined points."""
    return df.groupBy(*keys).agg(
        F.count(F.col(text)).cast("bigint").alias("n_summaries"),
        F.coalesce(F.expr(f"listagg({text}, '\\n') WITHIN GROUP (ORDER BY {order})"),
                   F.lit("")).alias(out),
        F.count(F.col(REASON)).cast("bigint").alias("n_rejected"),
    )


def summaries_by_date(points: DataFrame, keys: Sequence[str] = ("collection", "date"),
                      limit: int = SUMMARY_LIMIT, strict: bool = False) -> DataFrame:
    """Text-only summaries for every (collection, date) of ``points`` (L1:
    at most ``limit`` per date).

    Rows: ``collection, date, n_summaries, summaries, n_rejected``.
    ``strict=True`` reproduces the reference: any quarantined point fails the call.
    """
    keys = list(keys)
    limited = top_per_key(points.select(*keys, "point_id", "_node_content"), keys, "point_id", limit)
    parsed = parse_summaries(limited)
    out = join_texts(parsed, keys)
    if strict and not out.filter(F.col("n_rejected") > 0).isEmpty():
        raise TypeError("summary payload without parsable JSON content")
    return out


def fetch_summaries_by_date(points: DataFrame, community_id: str, platform_id: str | None,
                            date: str | None = None, extract_text_only: bool = True,
                            limit: int = SUMMARY_LIMIT, strict: bool = False) -> DataFrame:
    """The reference's single request: one collection, one date (or its latest).

    Text-only: one row (``collection, date, n_summaries, summaries,
    n_rejected``); otherwise the payload rows of ``summaries_payload``.
    """
    if not platform_id:
        raise ValueError("a summary request names its platform")
    collection = f"{community_id}_{platform_id}_summary"
    scoped = select_points(points, collection=collection, date=date)
    if date is None:
        scoped = restrict_to_latest(scoped)
    if not extract_text_only:
        return summaries_payload(scoped, limit=limit)
    return summaries_by_date(scoped, limit=limit, strict=strict)


def latest_dates(points: DataFrame, keys: Sequence[str] = ("collection",)) -> DataFrame:
    """A1: the latest ``date`` per collection (partial aggregation, so a hot
    collection is pre-aggregated map-side); an empty collection has no row."""
    return points.groupBy(*keys).agg(F.max("date").alias("date"))


def restrict_to_latest(points: DataFrame, keys: Sequence[str] = ("collection",)) -> DataFrame:
    """Keep the points of each collection's latest date.

    The latest-date frame has one row per collection, so the planner normally
    broadcasts it and filters the points without a shuffle.
    """
    latest = latest_dates(points, keys)
    return points.join(latest, [*keys, "date"], "left_semi")


def summaries_latest(points: DataFrame, limit: int = SUMMARY_LIMIT) -> DataFrame:
    """Summaries of the latest date of every collection (A1 + A2 + F7)."""
    return summaries_by_date(restrict_to_latest(points.select(*POINT_COLUMNS)), limit=limit)


def summaries_payload(points: DataFrame, keys: Sequence[str] = ("collection", "date"),
                      limit: int = SUMMARY_LIMIT) -> DataFrame:
    """P14 / A4 in row form: every point kept by the limit, with all its
    columns and ``parsed_content`` (the JSON as a VARIANT), ``summary_text``
    and ``parsed`` (1 when ``_node_content`` parsed as JSON). Points whose
    content does not parse stay as they are, without the two."""
    limited = top_per_key(points, list(keys), "point_id", limit)
    node = F.col("_node_content")
    ok = node.isNotNull() & is_json(node)
    return limited.withColumns({
        "parsed_content": F.when(ok, parsed_content(node)),
        "summary_text": F.when(ok, summary_text(node)),
        "parsed": ok.cast("int"),
    })


def summaries_nested(payload: DataFrame, keys: Sequence[str] = ("collection", "date")) -> DataFrame:
    """A4 nested form: one row per key with the list of summary records.

    Bounded by the per-key limit applied in ``summaries_payload``.
    """
    return payload.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("point_id", "summary_text", "parsed"))).alias("summaries"))


def range_requests(requests: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """W15/W16/F6 on a request table: parse the dates and add a reject reason
    (``no_platform``, ``bad_date``, ``end_before_start``)."""
    s, e = range_date_col(start), range_date_col(end)
    reason = first_reason([
        (F.coalesce(F.col("platform_id"), F.lit("")) == "", "no_platform"),
        (s.isNull() | e.isNull(), "bad_date"),
        (e < s, "end_before_start"),
    ])
    return requests.withColumn("_start", s).withColumn("_end", e).withColumn(REASON, reason)


#: Columns that payload mode adds to a request's day.
PAYLOAD_COLUMNS = ["point_id", "createdAt", "_node_content", "parsed_content", "summary_text", "parsed"]


def payload_of_days(days: DataFrame, scoped: DataFrame, limit: int, *columns) -> DataFrame:
    """Payload mode: ``columns`` of every requested day with each of its stored points (see
    :func:`summaries_payload`); a day without points has one row, without a point."""
    payload = summaries_payload(scoped, limit=limit)
    return days.join(payload, ["collection", "date"], "left").select(*columns, *PAYLOAD_COLUMNS)


def summaries_range(points: DataFrame, requests: DataFrame, limit: int = SUMMARY_LIMIT,
                    extract_text_only: bool = True) -> DataFrame:
    """J2 + A5: for each valid request (``community_id, platform_id,
    start_date, end_date``) a row for every day of its range, empty days with
    ``""``. Rows: ``community_id, platform_id, date, n_summaries, summaries``;
    without ``extract_text_only`` a row per stored point with its payload.

    The spine is generated per request row (``explode(sequence)``), never by
    a cross join; the day aggregates are joined on (collection, date).
    """
    req = range_requests(requests).filter(F.col(REASON).isNull())
    spine = req.select(
        "community_id", "platform_id",
        summary_collection("community_id", "platform_id").alias("collection"),
        F.explode(day_spine(F.col("_start"), F.col("_end"))).alias("_day"),
    ).withColumn("date", day_string("_day")).drop("_day")
    wanted = spine.select("collection", "date").distinct()
    scoped = points.select(*POINT_COLUMNS).join(wanted, ["collection", "date"], "left_semi")
    if not extract_text_only:
        return payload_of_days(spine, scoped, limit, "community_id", "platform_id", "date")
    per_day = summaries_by_date(scoped, limit=limit)
    return (spine.join(per_day, ["collection", "date"], "left")
            .select("community_id", "platform_id", "date",
                    F.coalesce("n_summaries", F.lit(0)).cast("bigint").alias("n_summaries"),
                    F.coalesce("summaries", F.lit("")).alias("summaries")))


def fetch_summaries_by_range(points: DataFrame, community_id: str, platform_id: str,
                             start_date: str, end_date: str, limit: int = SUMMARY_LIMIT,
                             extract_text_only: bool = True) -> DataFrame:
    """The reference's single range request; argument errors raise as there."""
    if not platform_id:
        raise ValueError("a range request names its platform")
    check_range(start_date, end_date)
    spark = points.sparkSession
    req = spark.createDataFrame([(community_id, platform_id, start_date, end_date)],
                                "community_id string, platform_id string, start_date string, end_date string")
    return summaries_range(points, req, limit, extract_text_only)


def summaries_for_requests(points: DataFrame, requests: DataFrame,
                           limit: int = SUMMARY_LIMIT, extract_text_only: bool = True) -> DataFrame:
    """J5 + W15: a table of single-date requests (``request_id, community_id,
    platform_id, date``) answered in one job. Requests without a platform are
    answered with status ``no_platform`` and no summaries.
    Rows: ``request_id, collection, date, status, n_summaries, summaries``, or
    in payload mode ``request_id, collection, date, status`` with each point."""
    req = requests.withColumn(
        REASON, first_reason([(F.coalesce(F.col("platform_id"), F.lit("")) == "", "no_platform")])
    ).withColumn("collection", F.when(F.col(REASON).isNull(),
                                      summary_collection("community_id", "platform_id")))
    valid = req.filter(F.col(REASON).isNull())
    wanted = valid.select("collection", "date").distinct()
    scoped = points.select(*POINT_COLUMNS).join(wanted, ["collection", "date"], "left_semi")
    if not extract_text_only:
        return payload_of_days(req, scoped, limit, "request_id", "collection", "date",
                               F.coalesce(F.col(REASON), F.lit("ok")).alias("status"))
    per_day = summaries_by_date(scoped, limit=limit)
    return (req.join(per_day, ["collection", "date"], "left")
            .select("request_id", "collection", "date",
                    F.coalesce(F.col(REASON), F.lit("ok")).alias("status"),
                    F.when(F.col(REASON).isNull(), F.coalesce("n_summaries", F.lit(0)))
                    .cast("bigint").alias("n_summaries"),
                    F.when(F.col(REASON).isNull(), F.coalesce("summaries", F.lit("")))
                    .alias("summaries")))


def workflow_spine(points: DataFrame, requests: DataFrame, latest_of: Callable | None = None) -> DataFrame:
    """The workflow's dispatch as rows: requests (``request_id,
    community_id, platform_id, start_date, end_date``) without ``end_date``
    read one date — ``start_date`` as written, or the collection's latest
    date when that is missing too —, the others read every day of their
    range. Rows: ``request_id, kind, collection, date, _reject_reason``;
    a rejected request keeps one row without a date. ``latest_of(points, wanted)``
    may find the latest dates of the ``wanted`` collections in another way."""
    s, e = range_date_col("start_date"), range_date_col("end_date")
    kind = (F.when(F.col("end_date").isNotNull(), F.lit("range"))
            .when(F.col("start_date").isNotNull(), F.lit("date")).otherwise(F.lit("latest")))
    reason = first_reason([
        (F.coalesce(F.col("platform_id"), F.lit("")) == "", "no_platform"),
        ((kind == "range") & (s.isNull() | e.isNull()), "bad_date"),
        ((kind == "range") & (e < s), "end_before_start"),
    ])
    req = requests.select("request_id", kind.alias("kind"),
                          summary_collection("community_id", "platform_id").alias("collection"),
                          "start_date", s.alias("_s"), e.alias("_e"), reason.alias(REASON))
    ok = req.filter(F.col(REASON).isNull())
    one_day = ok.filter(F.col("kind") == "date").select(
        "request_id", "kind", "collection", F.col("start_date").alias("date"))
    days = ok.filter(F.col("kind") == "range").select(
        "request_id", "kind", "collection", F.explode(day_spine(F.col("_s"), F.col("_e"))).alias("_d")) \
        .select("request_id", "kind", "collection", day_string("_d").alias("date"))
    latest_req = ok.filter(F.col("kind") == "latest").select("request_id", "kind", "collection")
    wanted = latest_req.select("collection").distinct()
    latest = latest_of(points, wanted) if latest_of else latest_dates(
        points.select("collection", "date").join(wanted, "collection", "left_semi"))
    # A collection without points has no latest date: its request keeps one row without a date.
    latest_days = latest_req.join(latest, "collection", "left")
    rejected = req.filter(F.col(REASON).isNotNull()).select(
        "request_id", "kind", "collection", F.lit(None).cast("string").alias("date"), REASON)
    return (one_day.unionByName(days).unionByName(latest_days)
            .withColumn(REASON, F.lit(None).cast("string")).unionByName(rejected))


def summaries_workflow(points: DataFrame, requests: DataFrame, limit: int = SUMMARY_LIMIT,
                       extract_text_only: bool = True) -> DataFrame:
    """The stored-summaries workflow for a table of requests of all three
    kinds in one job. Rows: ``request_id, kind, status, date, n_summaries,
    summaries`` (a day without data has ``""``; a rejected request one row
    with its reason as status; the latest date of an empty collection is NULL).
    In payload mode each stored point is a row, with its columns in place of the joined text."""
    spine = workflow_spine(points, requests)
    wanted = spine.filter(F.col(REASON).isNull()).select("collection", "date").distinct()
    scoped = points.select(*POINT_COLUMNS).join(wanted, ["collection", "date"], "left_semi")
    return _workflow_answers(spine, scoped, limit, extract_text_only)


def stored_requests(store: DataFrame, requests: DataFrame, limit: int = SUMMARY_LIMIT,
                    extract_text_only: bool = True) -> DataFrame:
    """:func:`summaries_workflow` on the stored table (``sources.points.scan_points``).

    The requests' collections and months prune the store's folders at run
    time, before any file is opened; a latest date costs its month's folder.
    """
    spine = staged(workflow_spine(store, requests, latest_stored_dates), "spine")
    wanted = staged(with_month(spine.filter(F.col(REASON).isNull()).select("collection", "date")).distinct(), "wanted").filter(F.col("date") > "")
    scoped = store.join(wanted, ["collection", "month", "date"], "left_semi").select(*POINT_COLUMNS)
    return _workflow_answers(spine, scoped, limit, extract_text_only)


def _workflow_answers(spine: DataFrame, scoped: DataFrame, limit: int, extract_text_only: bool) -> DataFrame:
    if not extract_text_only:
        return payload_of_days(spine, scoped, limit, "request_id", "kind",
                               F.coalesce(F.col(REASON), F.lit("ok")).alias("status"), "date")
    per_day = summaries_by_date(scoped, limit=limit)
    ok = F.col(REASON).isNull()
    return (spine.join(per_day, ["collection", "date"], "left")
            .select("request_id", "kind", F.coalesce(F.col(REASON), F.lit("ok")).alias("status"), "date",
                    F.when(ok, F.coalesce("n_summaries", F.lit(0))).cast("bigint").alias("n_summaries"),
                    F.when(ok, F.coalesce("summaries", F.lit(""))).alias("summaries")))
