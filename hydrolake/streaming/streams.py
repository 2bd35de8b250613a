"""Incremental ingest, overlap dedup, daily aggregates, upserts, live freshness.

State is bounded by watermarks; the archive on storage, not the stream state,
is the truth for revisions. Checkpoints live where the caller says, which on a
cluster is a folder all executors share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from hydrolake.operators.archive import child_names, delete_path, publish_merge
from hydrolake.operators.merge import collapse, path_exists
from hydrolake.operators.quality import freshness


def ingest_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """Each landed file once; at most ``max_files`` per micro-batch, the rest follow."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def dedup_stream(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop rows already seen by key in a re-fetched window of ``delay``."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def daily_stream(df: DataFrame, keys: list[str], ts: str, value: str, tz: str, delay: str,
                 step_seconds: int) -> DataFrame:
    """Readings of each local day: count, mean, first and last instant, completeness.

    The window runs on local wall-clock time. Completeness compares the count
    with the day's expected slots (repeats are dropped before, see T2).
    """
    local = F.from_utc_timestamp(F.col(ts), tz)
    shifted = df.withColumn("__local", local).withWatermark("__local", delay)
    days = shifted.groupBy(*keys, F.window("__local", "1 day").alias("__w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    date = F.to_date(F.col("__w.start"))
    start = F.to_utc_timestamp(date.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(date, 1).cast("timestamp"), tz)
    expected = F.floor((F.unix_seconds(end) - F.unix_seconds(start)) / step_seconds).cast("bigint")
    return days.select(*keys, date.alias("date"), "n", "mean_value", "first_ts", "last_ts",
                       expected.alias("expected"), (F.col("n") == expected).alias("is_complete"))


def upsert_stream(df: DataFrame, target: str, keys: list[str], partition: str, order: list[str],
                  checkpoint: str, volatile: list[str] | None = None, window_days: int | None = None,
                  late: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """T4: merge every micro-batch into the archive at ``target`` (see :mod:`hydrolake.operators.archive`).

    A batch is collapsed to its last row per key, then the partitions it touches are written anew
    and switched to as a whole; a writer that dies half-way leaves the archive as it was, and
    replaying a batch gives the same archive. Rows older than ``window_days`` before the newest
    day, held or brought, do not enter it; what they would have changed goes to ``late`` with the
    batch's number.
    """
    def write(batch: DataFrame, number: int) -> None:
        done = publish_merge(batch.sparkSession, target, collapse(batch, keys, order), keys, partition, volatile, window_days)
        if late is not None and done.late is not None:
            late(done.late, number)

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


class FreshnessMonitor:
    """T5: freshness of every registered source, driven by files that land and by time.

    ``seen`` is a folder for what the report needs: the newest ``n`` runs and the newest
    observation of each source, so its size follows the sources, not the events. A batch with
    rows merges them with the state before it and writes the next one; a replay reads the same
    predecessor and writes its own state again. Older states go once they cannot be a predecessor.

    ``runs_of`` and ``observations_of`` turn landed rows into the inputs of :func:`freshness`;
    ``now`` is a column, or a function that gives one for each report; ``publish`` takes each
    report and its number.
    """

    def __init__(self, registry: DataFrame, now: Column | Callable[[], Column], runs_of: Callable[[DataFrame], DataFrame],
                 observations_of: Callable[[DataFrame], DataFrame], publish: Callable[[DataFrame, int], None],
                 seen: str, n: int = 10, excused: dict[str, str] | None = None):
        self.registry, self.now, self.runs_of, self.observations_of = registry, now, runs_of, observations_of
        self.publish, self.seen, self.n, self.excused = publish, seen.rstrip("/"), n, excused

    def states(self, spark: SparkSession) -> list[int]:
        """Numbers of the complete states, ascending; there are two or three at any time."""
        return sorted(int(name.removeprefix("state-")) for name in child_names(spark, self.seen)
                      if name.startswith("state-") and path_exists(spark, f"{self.seen}/{name}/days/_SUCCESS"))

    def update(self, batch: DataFrame, number: int) -> None:
        """Merge landed rows into the state under the batch's number."""
        spark = batch.sparkSession
        before = [k for k in self.states(spark) if k < number]
        batch = batch.persist()  # read for its runs and for its observations
        runs, days = self.runs_of(batch), self.observations_of(batch)
        if before:
            last = f"{self.seen}/state-{before[-1]}"
            runs = runs.unionByName(spark.read.schema(runs.schema).parquet(f"{last}/runs"))
            days = days.unionByName(spark.read.schema(days.schema).parquet(f"{last}/days"))
        newest = Window.partitionBy("source_id").orderBy(F.col("run_file").desc())
        runs = runs.withColumn("__rn", F.row_number().over(newest)).where(F.col("__rn") <= self.n).drop("__rn")
        days = days.groupBy("source_id").agg(F.max("latest_observation").alias("latest_observation"))
        runs.write.mode("overwrite").parquet(f"{self.seen}/state-{number}/runs")
        days.write.mode("overwrite").parquet(f"{self.seen}/state-{number}/days")
        batch.unpersist()
        for k in before[:-1]:
            delete_path(spark, f"{self.seen}/state-{k}")

    def report(self, spark: SparkSession, number: int) -> None:
        """Publish the state of every source at this moment, whether anything landed or not."""
        known = [k for k in self.states(spark) if k <= number]
        if known:
            runs, days = (spark.read.parquet(f"{self.seen}/state-{known[-1]}/{kind}") for kind in ("runs", "days"))
        else:
            runs = spark.createDataFrame([], "source_id string, run_ts timestamp, run_file string, status string")
            days = spark.createDataFrame([], "source_id string, latest_observation string")
        now = self.now() if callable(self.now) else self.now
        self.publish(freshness(self.registry, runs, days, now, excused=self.excused, n=self.n), number)

    def drain(self, df: DataFrame, checkpoint: str) -> None:
        """Take what has landed and report once; also if nothing landed, for then sources may have
        fallen silent. For a scheduled job. The last report is numbered after the last state."""
        done = (df.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
        done.awaitTermination()
        self.report(df.sparkSession, max(self.states(df.sparkSession), default=0))

    def watch(self, df: DataFrame, checkpoint: str, every: str) -> StreamingQuery:
        """Run on, with a report at least ``every`` interval.

        A heartbeat (the rate source) runs beside the landed rows, so a batch fires at every
        trigger even if no file lands, and a source that falls silent turns stale by itself.
        """
        mark = next(m for m in (f"__landed{'_' * i}" for i in range(len(df.columns) + 1)) if m not in df.columns)
        beat = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
        beats = beat.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], F.lit(False).alias(mark))

        def step(batch: DataFrame, number: int) -> None:
            landed = batch.where(F.col(mark)).drop(mark)
            if not landed.isEmpty():
                self.update(landed, number)
            self.report(batch.sparkSession, number)

        return (df.withColumn(mark, F.lit(True)).unionByName(beats).writeStream.foreachBatch(step)
                .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def freshness_stream(df: DataFrame, registry: DataFrame, now: Column, runs_of: Callable[[DataFrame], DataFrame],
                     observations_of: Callable[[DataFrame], DataFrame],
                     publish: Callable[[DataFrame, int], None], seen: str,
                     checkpoint: str, n: int = 10) -> StreamingQuery:
    """T5 per micro-batch only: a report after each batch of landed files, none between them.

    To see sources fall silent use :class:`FreshnessMonitor` itself, by ``drain`` or ``watch``.
    """
    monitor = FreshnessMonitor(registry, now, runs_of, observations_of, publish, seen, n)

    def step(batch: DataFrame, number: int) -> None:
        monitor.update(batch, number)
        monitor.report(batch.sparkSession, number)

    return (df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def drain(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream to the end of what has landed and write it as parquet."""
    if mode == "append":
        (df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        return
    # whole results are replaced batch by batch
    (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
     .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(target))
     .trigger(availableNow=True).start().awaitTermination())
