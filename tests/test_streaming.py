"""The streaming snapshot equals the batch SCD2 over the same extracts."""

import tempfile

from pyspark.sql import functions as F

from fixtures import frame
from marketlens.functions.dates import ts_ntz
from marketlens.operators.scd2 import scd2_apply
from marketlens.plans.jobs import ADDRESS_CHECK_COLS
from marketlens.streaming.snapshot_stream import (
    apply_snapshot_batch, current_history_path, extract_path, start_snapshot_stream,
)

AS_OF = ["2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="snapstream-")
    b1 = [dict(id=1), dict(id=2), dict(id=3)]
    b2 = [dict(id=1), dict(id=2, city="Patras"), dict(id=4)]
    b3 = [dict(id=1), dict(id=2, city="Patras"), dict(id=3), dict(id=4)]
    frames = [frame(spark, "addresses", b) for b in (b1, b2, b3)]
    for i, (f, a) in enumerate(zip(frames, AS_OF)):
        f.withColumn("extracted_at", ts_ntz(a)).write.parquet(extract_path(f"{root}/in", i))
    schema = frames[0].withColumn("extracted_at", ts_ntz(AS_OF[0])).schema
    q = start_snapshot_stream(spark, f"{root}/in", schema, f"{root}/hist", f"{root}/ckpt", "id", ADDRESS_CHECK_COLS)
    q.awaitTermination(300)
    got = spark.read.parquet(current_history_path(spark, f"{root}/hist"))
    want = None
    for f, a in zip(frames, AS_OF):
        want = scd2_apply(want, f, "id", ADDRESS_CHECK_COLS, ts_ntz(a))
    cols = ["id", "city", "valid_from", "valid_to", "version_id"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert got.filter(F.col("valid_to").isNull()).count() == 4


def test_repeated_extracts_change_nothing(spark):
    root = tempfile.mkdtemp(prefix="snapreplay-")
    extracts = [frame(spark, "addresses", b) for b in
                ([dict(id=1), dict(id=2)], [dict(id=1, city="Patras"), dict(id=2)], [dict(id=1, city="Patras"), dict(id=2)])]

    def run(k):
        apply_snapshot_batch(spark, extracts[k], root, "id", ADDRESS_CHECK_COLS, ts_ntz(AS_OF[k]))
        got = spark.read.parquet(current_history_path(spark, root)).select("id", "city", "valid_from", "valid_to")
        return sorted(map(str, got.collect()))

    assert current_history_path(spark, root) is None
    states = [run(k) for k in range(3)]
    assert len(states[0]) == 2 and len(states[1]) == 3 and states[1] == states[2]
    assert all(run(k) == states[2] for k in (0, 1, 2, 1))
