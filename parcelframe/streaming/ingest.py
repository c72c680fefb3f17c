"""Listings that arrive as files: cleaned, scored and counted by Structured Streaming."""

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelframe import schemas
from parcelframe.plans.cleaning import clean_listings_a
from parcelframe.plans.features import FeaturePreset
from parcelframe.plans.scoring import score_batch

#: The file in a published table's folder that names the present version; Spark's readers skip names that begin with "_".
POINTER = "current.txt"


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = schemas.LISTINGS_RAW,
    fmt: str = "parquet",
    name_filter: str | None = None,
    files_per_batch: int | None = None,
    many_lines: bool = False,
) -> DataFrame:
    """New files of a folder as a stream. A CSV file whose header differs from the schema fails."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(header="true", escape='"', multiLine=str(many_lines).lower(), enforceSchema="false")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def stream_clean(raw: DataFrame) -> DataFrame:
    """The batch cleaning, row by row and therefore stateless."""
    return clean_listings_a(raw)


def stream_clean_once(raw: DataFrame, keys: Sequence[str], time: str, late: str = "30 days") -> DataFrame:
    """The cleaning of each listing once, though its file is delivered again.

    Rows are one if their keys agree and they come within ``late`` of each other in event time, which also bounds the state that
    is kept. Rows without a time, and rows later than that, are left out; so ``late`` is how long a replay may take.
    """
    known = raw.withColumn("_time", F.col(time).cast("timestamp")).filter("_time is not null")
    return clean_listings_a(known.withWatermark("_time", late).dropDuplicatesWithinWatermark(list(keys)).drop("_time"))


def stream_score(clean: DataFrame, model: PipelineModel, preset: FeaturePreset, keep=()) -> DataFrame:
    return score_batch(clean, model, preset, keep)


def append_available(stream: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process everything that has arrived, write each row once, and stop."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def month_totals(stream: DataFrame, month: Column, value: str = "price_per_m2") -> DataFrame:
    """Running count and sum per month of the year; twelve rows of state, for complete output."""
    return (
        stream.withColumn("posting_month", month)
        .filter(F.col("posting_month").isNotNull())
        .groupBy("posting_month")
        .agg(F.count(value).alias("priced"), F.sum(F.col(value).cast("double")).alias("amount"))
    )


def day_totals(stream: DataFrame, time: str, value: str = "price_per_m2", late: str = "30 days") -> DataFrame:
    """Count and sum per day for append output: a day is final once the watermark has passed it."""
    return (
        stream.withColumn("_time", F.col(time).cast("timestamp"))
        .withWatermark("_time", late)
        .groupBy(F.window("_time", "1 day").alias("day"))
        .agg(F.count(value).alias("priced"), F.sum(F.col(value).cast("double")).alias("amount"))
        .select(F.col("day.start").alias("day"), "priced", "amount")
    )


def month_means(totals: DataFrame) -> DataFrame:
    """Mean price per month from monthly totals."""
    return totals.select("posting_month", (F.col("amount") / F.col("priced")).alias("avg_price"))


def month_means_of_days(days: DataFrame) -> DataFrame:
    """Mean price per month of the year from daily totals, in batch."""
    return month_means(
        days.groupBy(F.month("day").alias("posting_month")).agg(
            F.sum("priced").alias("priced"), F.sum("amount").alias("amount")
        )
    )


def publish(table: DataFrame, out: str, version: str) -> None:
    """Writes a version of a table beside the others and then points readers to it.

    The pointer is a small file that is renamed over the old one in one step, so a reader sees the old version or the new
    one, and a write that fails half-way changes nothing for readers. The version before the last one stays for plans that
    still read it; older ones are deleted.
    """
    spark = table.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    folder = f"{version}-{uuid.uuid4().hex}"
    table.write.parquet(f"{out}/{folder}")
    last = published_version(spark, out)
    files = hadoop.FileContext.getFileContext(hadoop.Path(out).toUri(), conf)
    fresh, pointer = hadoop.Path(f"{out}/_{folder}"), hadoop.Path(f"{out}/{POINTER}")
    spark.createDataFrame([(folder,)], "version string").coalesce(1).write.text(fresh.toString())
    system = pointer.getFileSystem(conf)
    written = next(s.getPath() for s in system.listStatus(fresh) if s.getPath().getName().startswith("part-"))
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(written, pointer, options)
    system.delete(fresh, True)
    for status in system.listStatus(hadoop.Path(out)):
        if status.isDirectory() and status.getPath().getName() not in (folder, last):
            system.delete(status.getPath(), True)


def published_version(spark: SparkSession, out: str) -> str | None:
    """The folder that readers are pointed to, or None before the first version."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/{POINTER}")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.text(f"{out}/{POINTER}").first()[0]


def read_published(spark: SparkSession, out: str) -> DataFrame:
    """The table's present version; a plan made from it goes on with that version whatever is published meanwhile."""
    return spark.read.parquet(f"{out}/{published_version(spark, out)}")


def publish_each_batch(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Complete output as a published table with a version for each batch."""
    return (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: publish(batch, out, f"batch-{number}"))
        .trigger(availableNow=True)
        .start()
    )


def latest_each_batch(stream: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, checkpoint: str) -> StreamingQuery:
    """The latest row of each key while rows arrive, as a published table.

    The table itself is what is remembered: each batch is joined to it by one aggregation that spills, so no executor holds the
    keys in memory, and a batch that is run again changes nothing. The columns of ``order`` are part of the table. Null keys are a
    key like any other.
    """
    rest = [c for c in stream.columns if c not in keys]

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if published_version(spark, out) is not None:
            batch = read_published(spark, out).unionByName(batch)
        latest = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("last")).select(*keys, "last.*")
        publish(latest, out, f"batch-{number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start()
