"""Continuous pickup of completed extractions."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.plans import incremental
from paperloom.plans.warehouse import Warehouse
from paperloom.sources import files
from paperloom.sources.files import plain_path


def watch(
    spark: SparkSession,
    root: str,
    raw_dir: str,
    checkpoint: str,
    interval: str | None = None,
    **options,
) -> StreamingQuery:
    """Run the incremental load whenever new sidecars appear.

    The sidecar is written last, so its arrival is the completion event. Without an
    interval the query handles what is there and ends. A micro-batch names its sidecars,
    and only their extractions are listed and looked into. Spark may hand a micro-batch
    over again after a failure; one whose id is in the ledger is left alone.
    """
    warehouse = Warehouse(spark, root)
    sidecars = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.metadata.json")
        .load(raw_dir)
        .select(plain_path("_metadata.file_path").alias("path"))
    )

    def load(batch, batch_id):
        mine = (F.col("checkpoint") == checkpoint) & (F.col("batch_id") == batch_id)
        if not warehouse.entries("stream_batches").filter(mine).isEmpty():
            return
        arrived = batch.distinct().collect()
        if arrived:
            paths = [files.data_of(row["path"]) for row in arrived]
            run_id = incremental.run(batch.sparkSession, root, raw_dir, extractions=paths, **options)
            warehouse.append("stream_batches", [(checkpoint, batch_id, run_id)])

    writer = sidecars.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
