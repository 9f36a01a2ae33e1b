"""Structured Streaming jobs of the speed layer.

* ``ingest_job``: payload stream (Kafka topic, or a file stream with a
  ``value`` column) → validate → parse → raw event table (Parquet, partitioned
  by validity and event year/month/day/hour; rejects keep their raw text).
* ``process_job``: raw event stream → watermark → speed filter → dedup
  within the watermark → current-customer enrichment → processed table.
* ``late_rows_job``: raw events that the watermark kept out of it → late table.
* ``hourly_counts_job``: raw event stream → watermark → tumbling hourly
  counts per status, appended once each window closes.
* ``demand_alerts_job``: the same counts, scored against the preceding hours
  as windows close (``foreachBatch``, idempotent per batch id).

Every job takes a checkpoint location; a restart resumes from the offsets
and state kept there. The file sinks' commit log makes their output
exactly-once; the ``foreachBatch`` job overwrites only its batch's
partitions, so a replayed batch replaces its own output. ``trigger`` defaults to ``availableNow`` (drain and stop, the
scheduled form); pass ``{"processingTime": "5 minutes"}`` for a long-running one.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources import contracts as C
from . import speed

# Event-time lateness allowed before a row is late, and the
# raw table's partition columns.
WATERMARK = "2 hours"
RAW_PARTITIONS = ["year", "month", "day", "hour"]


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Kafka payload stream (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", "false")
            .load()
            .select(F.col("value").cast("string").alias("value")))


def file_payload_source(spark: SparkSession, path: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream with a ``value`` column standing in for a topic."""
    r = spark.readStream.format(fmt).schema(T.StructType([T.StructField("value", T.StringType())]))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def event_file_source(spark: SparkSession, path: str, schema: T.StructType = C.EVENTS) -> DataFrame:
    """Raw event table as a stream (declared schema, new files only)."""
    return spark.readStream.format("parquet").schema(schema).load(path)


def _start(df: DataFrame, path: str, checkpoint: str, trigger: dict | None, partition_by=None,
           mode: str = "append") -> StreamingQuery:
    w = df.writeStream.format("parquet").outputMode(mode).option("path", path) \
        .option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.trigger(**(trigger or {"availableNow": True})).start()


RAW_FIELDS = [T.StructField("is_valid", T.BooleanType()), T.StructField("arrived_at", T.TimestampType())]
RAW_SCHEMA = T.StructType(C.EVENTS.fields + RAW_FIELDS)
# One event: an order's status change at a time. A repeat of all three is a duplicate delivery.
EVENT_KEY = ["order_id", "order_status", "event_timestamp"]


def ingest_job(payloads: DataFrame, raw_path: str, checkpoint: str, trigger: dict | None = None,
               files_per_hour: int | None = None, schema: T.StructType = C.EVENTS) -> StreamingQuery:
    """One read of the source, one exactly-once file sink.

    Every payload lands in the raw table, partitioned by ``is_valid`` and
    event hour: valid payloads as typed events, rejects (``is_valid=false``)
    with their raw text and a reason, so nothing vanishes and the source is
    consumed once. ``quarantine`` reads the reject partition.

    Each micro-batch is clustered by hour before the write, so a batch adds
    about ``files_per_hour`` files per hour folder instead of one per task;
    the salt (hash of the payload) keeps a hot hour spread over that many tasks.
    By default that is a quarter of the session's shuffle partitions (at least
    2): it grows with the cluster, as a batch may hold one hour only.
    """
    if files_per_hour is None:
        files_per_hour = max(2, int(payloads.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    required = [f.name for f in schema.fields]
    text = F.col("value").cast("string")
    flagged = payloads.select(text.alias("payload")).withColumn("is_valid", speed.has_required_keys("payload",
                                                                                                   required))
    parsed = flagged.select("payload", "is_valid",
                            F.from_json("payload", schema).alias("e"))
    events = parsed.select("is_valid", "e.*",
                           F.when(~F.col("is_valid"), F.col("payload")).alias("payload"),
                           F.when(~F.col("is_valid"), F.lit(speed.REJECT_REASON)).alias("reason"))
    salt = F.pmod(F.hash("order_id", "payload"), F.lit(files_per_hour))
    # arrival is stamped once, here: later drains of the raw table must not shift it
    events = events.withColumn("arrived_at", F.current_timestamp())
    raw = speed.hour_partition_cols(events).repartition(F.col("is_valid"), *[F.col(c) for c in RAW_PARTITIONS],
                                                        salt)
    return _start(raw, raw_path, checkpoint, trigger, ["is_valid", *RAW_PARTITIONS])


def quarantine(spark: SparkSession, raw_path: str) -> DataFrame:
    """Rejected payloads of the raw table (partition ``is_valid=false``).

    Partition discovery types the flag as a string, so it is cast; the filter
    still prunes to the reject folders."""
    # the sink's log still names files that retention has removed
    return spark.read.option("ignoreMissingFiles", "true").parquet(raw_path).filter(~F.col("is_valid").cast("boolean")).select("payload", "reason")


def valid_event_source(spark: SparkSession, raw_path: str, schema: T.StructType = C.EVENTS) -> DataFrame:
    """The raw table as a stream of valid events only; ``schema`` as in ``ingest_job``."""
    raw = T.StructType(schema.fields + RAW_FIELDS)
    return spark.readStream.format("parquet").schema(raw).option("ignoreMissingFiles", "true").load(raw_path).filter(F.col("is_valid"))


def folder_dimension(path: str) -> Callable[[SparkSession], tuple[DataFrame, str]]:
    """A published dimension, looked up anew whenever it is called: its rows as they are now, and the version they are.

    The version is the folder's modification time (UTC), which every publish by swap changes."""
    def current(spark: SparkSession) -> tuple[DataFrame, str]:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        millis = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()
        return spark.read.parquet(path), datetime.fromtimestamp(millis / 1000, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
    return current


def process_job(events: DataFrame, customers: DataFrame | Callable, processed_path: str, checkpoint: str,
                watermark: str = WATERMARK, trigger: dict | None = None,
                customers_unique: bool = False) -> StreamingQuery:
    """Speed layer: filter, dedup within the watermark, enrich, append.

    ``customers`` is a DataFrame, fixed for the life of the query (its files are
    listed once), or a function such as ``folder_dimension(path)``: then every
    micro-batch asks for the dimension as it is at that time, so a long-running
    query follows its publishes, and names the version in ``dim_version``. Such a
    query writes by (event_date, batch_id), overwriting only its own batch, so
    a retried batch replaces itself, and readers can prune by date.
    """
    arrival = ["arrived_at"] if "arrived_at" in events.columns else []
    ev = events.select(*[f.name for f in C.EVENTS.fields], *arrival).withWatermark("event_timestamp", watermark)
    ev = speed.dedup_events(speed.speed_filter(ev), EVENT_KEY)

    def enriched(rows: DataFrame, dim: DataFrame) -> DataFrame:
        return speed.with_lateness(speed.enrich_events(rows, dim, static_unique=customers_unique),
                                   F.col("arrived_at") if arrival else None, watermark)

    if not callable(customers):
        return _start(enriched(ev, customers), processed_path, checkpoint, trigger)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        dim, version = customers(batch.sparkSession)
        _write_batch(enriched(batch, dim).withColumn("dim_version", F.lit(version)), batch_id, processed_path)

    w = ev.writeStream.outputMode("append").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    tagged = rows.withColumns({"event_date": F.to_date("event_timestamp"), "batch_id": F.lit(batch_id)})
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(path)


def late_rows_job(events: DataFrame, customers: Callable, processed_path: str, late_path: str, checkpoint: str,
                  watermark: str = WATERMARK, trigger: dict | None = None) -> StreamingQuery:
    """The late lane (T7): events that the watermark kept out of the processed table, each once.

    To be run after ``process_job`` has drained the same raw table: what passes
    the speed filter is then in ``processed_path`` (also repeats of it, by
    ``EVENT_KEY``) or was dropped as late. Each micro-batch looks its events up
    there and in the late lane's earlier batches, reading only the dates that it
    holds, and writes the missing ones, enriched like the others. Gold reads both.
    """
    arrival = ["arrived_at"] if "arrived_at" in events.columns else []
    ev = speed.speed_filter(events.select(*[f.name for f in C.EVENTS.fields], *arrival))
    key_types = T.StructType([f for f in events.select(*EVENT_KEY).schema.fields])

    def known(spark: SparkSession, path: str, dates: list, before: int | None) -> DataFrame | None:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return None
        schema = T.StructType(key_types.fields + [T.StructField("event_date", T.DateType()), T.StructField("batch_id", T.LongType())])
        rows = spark.read.schema(schema).parquet(path).where(F.col("event_date").isin(dates))
        rows = rows if before is None else rows.where(F.col("batch_id") < before)
        return rows.select(*[F.col(c).alias(f"k_{c}") for c in EVENT_KEY])

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dates = [r[0] for r in batch.select(F.to_date("event_timestamp")).distinct().collect() if r[0] is not None]  # one per day
        rows = speed.dedup_events(batch, EVENT_KEY)
        for path, before in ((processed_path, None), (late_path, batch_id)):
            there = known(spark, path, dates, before)
            if there is not None:
                same = reduce(and_, [rows[c].eqNullSafe(there[f"k_{c}"]) for c in EVENT_KEY])
                rows = rows.join(there, same, "left_anti")
        dim, version = customers(spark)
        out = speed.with_lateness(speed.enrich_events(rows, dim), F.col("arrived_at") if arrival else None, watermark)
        _write_batch(out.withColumn("dim_version", F.lit(version)), batch_id, late_path)

    w = ev.writeStream.outputMode("append").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def hourly_counts_job(events: DataFrame, out_path: str, checkpoint: str, watermark: str = WATERMARK,
                      trigger: dict | None = None) -> StreamingQuery:
    ev = events.withWatermark("event_timestamp", watermark)
    return _start(speed.hourly_counts(ev), out_path, checkpoint, trigger)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped as late, over the run's recent progress reports."""
    return sum(int(s.get("numRowsDroppedByWatermark", 0))
               for p in (query.recentProgress or []) for s in p.get("stateOperators", []))


def demand_alerts_job(events: DataFrame, counts_path: str, alerts_path: str, checkpoint: str,
                      lookback_hours: int = 24, z: float = 3.0, watermark: str = WATERMARK,
                      trigger: dict | None = None) -> StreamingQuery:
    """Real-time demand anomalies (N4, streaming form), hours without events included.

    Hourly windows are counted with a watermark; as windows close, each
    micro-batch (``foreachBatch``):
    1. writes its closed windows to ``counts_path``, partitioned by
       (window date, batch_id) with dynamic overwrite, so a retried batch
       replaces its own output and nothing else;
    2. scores, for all statuses, the hours after the last one that earlier
       batches closed, up to the last one that this batch closed, and writes the
       scores to ``alerts_path`` the same way. A batch closes all windows up to a
       time at once, so these hours are final and each is scored once, in
       whichever batch: the result is the same as ``demand_anomalies`` over
       all counts, however the stream is cut. A status that falls silent is
       scored as soon as another one closes an hour.
    Read back are the hours that the scores can depend on (twice the look-back
    before the last scored hour); the ends of the history come from its partition
    dates. Work per batch does not grow with the history.
    """
    from ..operators.brief import demand_anomalies

    counts = speed.hourly_counts(events.withWatermark("event_timestamp", watermark))

    def edge(history: DataFrame, of):
        """The first or last hour of the counts: its date from the partitions, its hour from that date alone."""
        date = history.agg(of("window_date")).first()[0]
        return None if date is None else history.where(F.col("window_date") == F.lit(date)).agg(of("window_start")).first()[0]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the batch holds only the windows that closed in it (a few rows per
        # status and hour); it is used twice, and a stateful batch must not be
        # recomputed, so it is kept for the duration of this call
        batch = batch.persist()
        try:
            first, last = batch.agg(F.min("window_start"), F.max("window_start")).first()
            if first is None:
                return
            tag = {"window_date": F.to_date("window_start"), "batch_id": F.lit(batch_id)}
            batch.withColumns(tag).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("window_date", "batch_id").parquet(counts_path)
            closed = spark.read.parquet(counts_path).where(F.col("batch_id") <= batch_id)
            done = edge(closed.where(F.col("batch_id") < batch_id), F.max)
            origin = edge(closed, F.min)
            lo = (done or first) - timedelta(hours=2 * lookback_hours)
            recent = closed.where((F.col("window_date") >= F.lit(lo.date())) & (F.col("window_start") >= F.lit(lo)))
            out = demand_anomalies(recent.select("window_start", "order_status", "n_events"), k=lookback_hours, z=z,
                                   first=origin, last=last, after=done)
            out.withColumns(tag).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("window_date", "batch_id").parquet(alerts_path)
        finally:
            batch.unpersist()

    w = counts.writeStream.outputMode("append").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
