"""Streaming sinks survive a batch that is re-run after a failure."""

import os

from pyspark.sql import functions as F

from vaultline.streaming import stream as S


def _snapshots(spark):
    rows = []
    for v in (1, 2, 3):
        for k in range(6):
            if k == 5 and v == 3:
                continue                                  # deleted in version 3
            rows.append((f"K{k}", f"A{k}-{(k + v) // 2}", v))
    return spark.createDataFrame(rows, "key STRING, address STRING, version BIGINT")


def _rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_scd2_stream_replayed_batch_gives_same_history(spark, tmp_path):
    snaps = _snapshots(spark)
    work = str(tmp_path)
    for v in (1, 2, 3):
        snaps.filter(F.col("version") == v).coalesce(1).write.mode("append").parquet(f"{work}/in")
    src = S.read_stream(spark, f"{work}/in", snaps.schema, max_files=1)
    S.scd2_stream(spark, src, ["key"], "version", f"{work}/out", f"{work}/ckpt")
    first = _rows(S.final_history(spark, f"{work}/out"))

    # Crash after the last batch wrote its history but before it committed:
    # the restarted query re-runs that batch.
    commits = sorted(int(n) for n in os.listdir(f"{work}/ckpt/commits") if n.isdigit())
    for name in (str(commits[-1]), f".{commits[-1]}.crc"):     # the marker and its checksum sidecar
        if os.path.exists(f"{work}/ckpt/commits/{name}"):
            os.remove(f"{work}/ckpt/commits/{name}")
    src = S.read_stream(spark, f"{work}/in", snaps.schema, max_files=1)
    S.scd2_stream(spark, src, ["key"], "version", f"{work}/out", f"{work}/ckpt")
    assert _rows(S.final_history(spark, f"{work}/out")) == first
    assert len(first) == 6 + 5      # 6 keys opened; K0-K4 change address once; K5 is closed in version 3
