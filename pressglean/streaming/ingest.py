"""Links as a stream of files: each micro-batch is checked against the history, which it extends.

An extra beside the batch operators: the result over all files equals that of one batch run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressglean.operators import links as L

LINKS = "link_id BIGINT, batch_no INT, url STRING, loaded_at TIMESTAMP"


def link_stream(spark: SparkSession, folder: str, schema: str = LINKS) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def new_links(stream: DataFrame, out: str, checkpoint: str):
    """Runs over what is there: the first row of each URL that no earlier micro-batch brought goes to `out`/links.

    A micro-batch writes its own folder, so a repeated one replaces itself; the history is what the folders
    of the micro-batches before it hold.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = [f"{out}/links/epoch={e}" for e in range(epoch)]
        done = spark.read.parquet(*before).select("url") if before else spark.createDataFrame([], "url STRING")
        fresh = L.first_of_each(L.unseen(batch.where("url is not null"), done).select("link_id", "batch_no", "url"), "url", "batch_no", "link_id")
        fresh.write.mode("overwrite").parquet(f"{out}/links/epoch={epoch}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(stream: DataFrame, late: str = "2 hours", window: str = "1 hour") -> DataFrame:
    """Links per window of load time, late rows within `late` counted."""
    return stream.withWatermark("loaded_at", late).groupBy(F.window("loaded_at", window)).agg(F.count(F.lit(1)).alias("links")).select(F.col("window.start").alias("start"), "links")
