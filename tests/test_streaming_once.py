"""First deliveries that come late, over several micro-batches."""

import time

from pyspark.sql import functions as F

from tidemark.session import new_folder
from tidemark.sources import messages as intake
from tidemark.streaming import live

ROWS = "seq long, received_at timestamp"


def land(spark, folder, rows):
    df = spark.createDataFrame(rows, "seq long, at string").select("seq", F.col("at").cast("timestamp").alias("received_at"))
    df.coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def test_late_first_delivery_is_kept(spark):
    base = new_folder(spark, "once")
    day = "2024-05-0{} 12:00:00".format
    for rows in (
        [(1, day(5)), (2, day(6)), (2, day(6)), (None, day(6))],
        [(3, day(1)), (1, day(7)), (None, day(7))],  # 3 is days behind the watermark of the first batch
        [(4, day(8)), (3, day(1)), (2, day(2))],
    ):
        land(spark, f"{base}/landed", rows)
    for _ in range(2):  # the second run finds nothing new
        stream = intake.stream_files(spark, f"{base}/landed", spark.createDataFrame([], ROWS).schema, maxFilesPerTrigger="1")
        live.write_once(stream, f"{base}/table", f"{base}/checkpoint")
    table = spark.read.parquet(f"{base}/table")
    got = {(r.batch_id, r.seq) for r in table.collect()}
    assert got == {(0, 1), (0, 2), (0, None), (1, 3), (2, 4)} and table.count() == 5
