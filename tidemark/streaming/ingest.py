"""Continuous landing of feed pages and of votes with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upsert import IDENTIFIERS, insert_if_absent
from tidemark.schemas import VOTES
from tidemark.sources.feeds import FEEDS, with_pdf


def stream_feed(spark: SparkSession, source: str, folder: str, files_per_trigger: int = 10) -> DataFrame:
    """Landing rows of a feed's page files as they arrive."""
    schema, mapper = FEEDS[source]
    pages = spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return with_pdf(mapper(pages))


def _exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, in whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def land_stream(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends the rows of each micro-batch whose identifiers the table at ``target`` doesn't hold yet.

    One batch is written at a time into its own folder, named by its id, so a repeated batch replaces itself and a
    reader sees whole batches. Stops when all files that are there are read.
    """

    def put(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        folder = f"{target}/batch={epoch}"
        known = spark.createDataFrame([], batch.schema)
        if _exists(spark, target):  # only the identifiers of other batches are read
            known = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])).parquet(target).filter(F.col("batch") != epoch).select(*IDENTIFIERS)
        order = F.struct(F.xxhash64("doi", "openalex_id", "semantic_scholar_id", "title").alias("h"), "title")
        insert_if_absent(known, batch.withColumn("__order", order), "__order").drop("__order").write.mode("overwrite").parquet(folder)

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Votes as they arrive in JSON files."""
    return spark.readStream.schema(VOTES).json(folder)


def live_judgements(votes: DataFrame) -> DataFrame:
    """(extraction_id, n_valid, n_invalid, judgement) that is updated with every vote."""
    valid = F.sum(F.when(F.col("vote"), 1).otherwise(0))
    invalid = F.sum(F.when(~F.col("vote"), 1).otherwise(0))
    counted = votes.filter("vote is not null").groupBy("extraction_id").agg(valid.alias("n_valid"), invalid.alias("n_invalid"))
    return counted.withColumn("judgement", F.when(F.col("n_valid") > F.col("n_invalid"), "valid").when(F.col("n_invalid") > F.col("n_valid"), "invalid"))


def votes_per_window(votes: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, n) of votes per window of event time, votes later than ``late`` dropped; an extension for monitoring."""
    return votes.withWatermark("created_at", late).groupBy(F.window("created_at", width).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")
