from __future__ import annotations

import os
import time

from sheaf.streaming import digest as st_digest
from sheaf.streaming import ingest as st_ingest
from tests.conftest import rows

SCHEMA = "collection string, point_id bigint, ts timestamp_ntz"


def _write(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(path)


def test_watermark_drops_late_points(spark, tmp_dir):
    from datetime import datetime
    src = os.path.join(tmp_dir, "src")
    files = [[("c", 1, datetime(2024, 1, 1, 10, 30))],
             [("c", 2, datetime(2024, 1, 1, 20, 0)), ("c", 3, datetime(2024, 1, 1, 10, 45))],
             [("c", 5, datetime(2024, 1, 1, 20, 10))],
             [("c", 4, datetime(2024, 1, 1, 10, 50)), ("c", 6, datetime(2024, 1, 1, 20, 20))]]
    for i, data in enumerate(files):
        _write(spark, os.path.join(src, str(i)), data)
        time.sleep(1.1)  # the file source orders new files by modification time
    sink, ck = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck")
    q = st_digest.start_digest_windows(spark, src + "/*", sink, ck, SCHEMA, window_size="1 hour", slide="1 hour",
                                       lateness="30 minutes", max_files_per_trigger=1)
    q.awaitTermination()
    got = rows(st_digest.latest_window_counts(spark, sink), "window_start", "n_points")
    # Spark judges lateness against the watermark of the previous batch: by
    # the last batch it is 19:30, so point 4 (10:50) is dropped.
    assert got == [("2024-01-01 10:00:00", 2), ("2024-01-01 20:00:00", 3)]


def test_ingest_stream_latest_version_wins(spark, tmp_dir):
    from sheaf import schemas
    src = os.path.join(tmp_dir, "req")
    row = lambda text: [("c", "p", text, {}, "d1", [], [], None)]
    spark.createDataFrame(row("first"), schemas.INGESTION_REQUEST).write.parquet(os.path.join(src, "1"))
    time.sleep(1.1)
    spark.createDataFrame(row("second"), schemas.INGESTION_REQUEST).write.parquet(os.path.join(src, "2"))
    sink, ck = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck")
    st_ingest.start_ingest(spark, src + "/*", sink, ck, max_files_per_trigger=1).awaitTermination()
    got = st_ingest.latest_documents(spark, sink).collect()
    assert [(r["collection"], r["doc_id"], r["text"]) for r in got] == [("c_p", "d1", "second")]


def test_ingest_stream_from_json_files(spark, tmp_dir):
    import json
    src = os.path.join(tmp_dir, "json")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"communityId": "c", "platformId": "p", "text": "t", "metadata": {"k": "v"},
                            "docId": "1", "collectionName": "x"}) + "\n")
    sink, ck = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck")
    st_ingest.start_ingest(spark, src, sink, ck, fmt="json").awaitTermination()
    got = st_ingest.latest_documents(spark, sink).collect()
    assert [(r["collection"], r["doc_id"], r["metadata"]) for r in got] == [("c_x", "1", {"k": "v"})]
