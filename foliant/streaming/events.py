"""Streams of attempts and failures: windows, sessions, late rows, latest per key, custom state."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foliant.session import checkpoint_root, ship

WATERMARK = "10 minutes"
#: Parts of a table kept by upserts; at most so many numbers reach the driver per batch.
PARTS = 64


def read_events(spark: SparkSession, folder: str, name: str = "events", files_per_batch: int | None = None) -> DataFrame:
    """The event files as a stream, ``ts`` being the event time; the schema is that of the files already there."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A single file is read through its folder, with a glob for its name.
    if spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(
        spark._jvm.org.apache.hadoop.fs.Path(path)
    ).isFile():
        stream = reader.option("pathGlobFilter", f"{name}.parquet").load(folder)
    else:
        stream = reader.load(path)
    # Event time must carry a zone; times without one are read in the session's.
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there into a table of the shared folder, and reads it back."""
    spark = stream.sparkSession
    base = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def batches(stream: DataFrame, mode: str) -> DataFrame:
    """What a stream gives out, each micro-batch written to the shared folder.

    In complete mode the last batch is the whole result; in update mode all changes are returned.
    """
    spark = stream.sparkSession
    base = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    done: list[str] = []

    def write(batch: DataFrame, number: int) -> None:
        out = f"{base}/b{number}"
        batch.write.mode("overwrite").parquet(out)
        done.append(out)

    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*(done[-1:] if mode == "complete" else done))


def upsert_latest(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The latest row of each key, kept by merging every micro-batch into the table so far.

    The table lies in PARTS parts by a hash of the key; a batch reads and writes anew only the parts
    that it touches, and a part that is written never changes.
    """
    spark = stream.sparkSession
    base = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")
    now: dict[int, str] = {}

    def merge(batch: DataFrame, number: int) -> None:
        touched = [r["p"] for r in batch.select(part.alias("p")).distinct().collect()]
        before = [now[p] for p in touched if p in now]
        both = batch.unionByName(spark.read.schema(batch.schema).parquet(*before)) if before else batch
        w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
        out = f"{base}/v{number}"
        latest = both.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
        latest.withColumn("__part", part).write.mode("overwrite").partitionBy("__part").parquet(out)
        now.update({p: f"{out}/__part={p}" for p in touched})

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(*now.values()) if now else spark.createDataFrame([], stream.schema)


def failure_windows(events: DataFrame, width: str = "90 minutes", slide: str | None = None) -> DataFrame:
    """Attempts, failures and the mean value in windows of event time; works on tables and streams."""
    at = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.groupBy(at.alias("w")).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("event_type") == "error").alias("failures"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("value_cents"),
    ).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "attempts", "failures", "value_cents")


def retry_sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    """Bursts of a user's events parted by pauses; works on tables and streams."""
    return events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("event_type") == "error").alias("failures")
    ).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "attempts", "failures")


def first_deliveries(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Each key once, however often it is delivered within the watermark."""
    return events.withWatermark("ts", WATERMARK).dropDuplicatesWithinWatermark([key])


def paced(events: DataFrame, key: str = "user_id", seconds: float = 3600.0) -> DataFrame:
    """(key, granted, delayed, next_slot): a rate limiter's state per key over a stream.

    Every event takes the next free slot of its key, slots being ``seconds`` apart; the state holds
    the next slot and two counts.
    """

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        slot, granted, delayed = state.get if state.exists else (0.0, 0, 0)
        times = sorted(t.timestamp() for p in parts for t in p["ts"] if pd.notna(t))
        for t in times:
            delayed += t < slot
            slot = max(t, slot) + seconds
            granted += 1
        state.update((slot, granted, delayed))
        yield pd.DataFrame({key: [k[0]], "granted": [granted], "delayed": [delayed], "next_slot": [slot]})

    ship(events.sparkSession)
    ready = events.select(key, "ts")
    return ready.groupBy(key).applyInPandasWithState(
        step, f"{key} long, granted long, delayed long, next_slot double", "slot double, granted long, delayed long",
        "update", GroupStateTimeout.NoTimeout,
    )
