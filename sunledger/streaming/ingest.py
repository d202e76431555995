"""Reading stream -> bronze table, effectively once.

Layout of a sink folder: ``readings/`` (bronze), ``rejects/`` and
``counters/``, each with one sub-folder ``ingest_batch=<stream>-<batch>`` per
micro-batch.  A batch replaces its own sub-folder as a whole, so a batch that
is run again after a failure leaves nothing behind and adds nothing twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sunledger import constants as C
from sunledger.functions.clock import PARTITION_COLUMN
from sunledger.functions.semantics import join_null_safe
from sunledger.schemas import SOLAR_PANEL_READINGS
from sunledger.sources.tables import delete, make_folder
from sunledger.streaming.decode import decode_readings
from sunledger.streaming.ids import IdTable

BATCH_COLUMN = "ingest_batch"
_FIRST_SEEN = "first_seen"  # marks the rows that only name an id the state did not know
_PARTITIONS = "spark.sql.shuffle.partitions"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INGESTED = "ingestion_timestamp"
_STORED = [n for n in SOLAR_PANEL_READINGS.names if n not in ("id", INGESTED)]
READINGS_SCHEMA = T.StructType(
    [SOLAR_PANEL_READINGS[name] for name in _STORED]
    + [T.StructField(INGESTED, T.TimestampType())]
    + [T.StructField(BATCH_COLUMN, T.StringType()), T.StructField(PARTITION_COLUMN, T.DateType())]
)
REJECTS_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField(BATCH_COLUMN, T.StringType()),
    ]
)
COUNTERS_SCHEMA = T.StructType(
    [
        T.StructField("messages", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField(BATCH_COLUMN, T.StringType()),
    ]
)


def kafka_messages(spark: SparkSession, servers: str, topic: str = C.TOPIC) -> DataFrame:
    """The reading topic from its beginning (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
        .transform(of_topic)
    )


def of_topic(records: DataFrame) -> DataFrame:
    """What ingestion takes of a topic's records: the payload, and the place that orders its copies."""
    return records.select("value", "partition", "offset")


def file_messages(
    spark: SparkSession,
    folder: str,
    bytes_per_batch: int = 64 << 30,
    files_per_batch: int | None = None,
) -> DataFrame:
    """JSON lines dropped into a folder; a batch takes files up to a number of bytes (or files)."""
    reader = spark.readStream.schema("value STRING")
    if files_per_batch is None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def first_per_event(readings: DataFrame, order: Sequence[str], among: DataFrame | None = None) -> DataFrame:
    """The first row of each event id by ``order``, of the ids in ``among`` if given; rows without an id are all kept.

    A grouped ``min_by``, not a window: copies of one id are reduced before the
    shuffle, however many there are.
    """
    key = F.col("event_id")
    first = (
        readings.where(key.isNotNull())
        .groupBy("event_id")
        .agg(F.min_by(F.struct(*readings.columns), F.struct(*order)).alias("r"))
        .select("r.*")
    )
    if among is not None:
        first = first.join(among.select("event_id"), "event_id", "left_semi")
    return first.unionByName(readings.where(key.isNull()))


def unseen(readings: DataFrame, sink: DataFrame, same_day_only: bool = False) -> DataFrame:
    """Rows whose event id is not in ``sink``; a missing id is never a conflict.

    ``same_day_only`` reads only the sink's partitions of the days in
    ``readings``.  It is exact when a repeated event keeps its timestamp, as a
    redelivered one does.
    """
    known = sink.where(F.col("event_id").isNotNull())
    if same_day_only:
        days = readings.select(F.to_date("timestamp").alias(PARTITION_COLUMN)).distinct()
        known = join_null_safe(known, days, [PARTITION_COLUMN])
    # a NULL id matches nothing, so the anti join keeps it
    return readings.join(known.select("event_id"), "event_id", "left_anti")


def read_readings(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/readings", READINGS_SCHEMA)


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/rejects", REJECTS_SCHEMA)


def ingest_counters(spark: SparkSession, folder: str) -> DataFrame:
    """One row: messages taken, errors, success rate.

    Errors are not part of the messages, and the rate subtracts them
    nevertheless: (messages - errors) / messages.
    """
    counted = _read(spark, f"{folder}/counters", COUNTERS_SCHEMA).agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
    )
    rate = F.try_divide(F.col("messages") - F.col("errors"), F.col("messages")) * 100
    return counted.withColumn("success_rate", rate)


def batch_writer(
    folder: str,
    stream: Callable[[], str],
    *,
    against_sink: bool = True,
    same_day_only: bool = False,
    ids_table: IdTable | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function over decoded rows (see :func:`start_ingest`)."""

    def write(decoded: DataFrame, batch_id: int) -> None:
        spark = decoded.sparkSession
        name = f"{stream()}-{batch_id}"
        # read twice below: written once, beside the sink, so that a lost executor costs nothing,
        # and counted on the way
        staged = f"{folder}/staged/{BATCH_COLUMN}={name}"
        counted = Observation()
        decoded.observe(counted, *_counters(decoded)).write.mode("overwrite").parquet(staged)
        decoded = spark.read.schema(decoded.schema).parquet(staged)
        try:
            ids = None
            if _FIRST_SEEN in decoded.columns:
                named = F.col(_FIRST_SEEN)
                ids = decoded.where(named)
                decoded = decoded.where(~named).drop(_FIRST_SEEN)
            good = decoded.where(F.col("reject_reason").isNull())
            order = [c for c in ("partition", "offset") if c in decoded.columns] + ["value"]
            new = first_per_event(good, order, ids)
            if against_sink:
                earlier = read_readings(spark, folder).where(F.col(BATCH_COLUMN) != name)
                new = unseen(new, earlier, same_day_only)
            if ids_table is None:
                _write_readings(new, folder, name)
            else:
                # the ids enter last: until then a repeated batch finds the table as it was
                with ids_table.turn(stream()):
                    _write_readings(ids_table.unseen(new, name), folder, name)
                    kept = read_readings(spark, folder).where(F.col(BATCH_COLUMN) == name)
                    ids_table.add(kept, name)
            rejected = decoded.where(F.col("reject_reason").isNotNull())
            rejected.select(F.col("value").cast("string"), "reject_reason").write.mode(
                "overwrite"
            ).parquet(f"{folder}/rejects/{BATCH_COLUMN}={name}")
            spark.range(1).select(
                *(F.lit(counted.get[c]).cast("long").alias(c) for c in ("messages", "errors"))
            ).write.mode("overwrite").parquet(f"{folder}/counters/{BATCH_COLUMN}={name}")
        finally:
            delete(spark, staged)

    return write


def _counters(decoded: DataFrame) -> list[Column]:
    """Good messages and errors of a batch; where the state names new ids, one message for each of them."""
    rejected = F.col("reject_reason").isNotNull()
    good = ~rejected
    if _FIRST_SEEN in decoded.columns:
        good = F.col(_FIRST_SEEN) | (good & F.col("event_id").isNull())
    return [F.count_if(good).alias("messages"), F.count_if(rejected).alias("errors")]


def _write_readings(new: DataFrame, folder: str, name: str) -> None:
    (
        new.select(
            *_STORED,
            F.current_timestamp().alias(INGESTED),
            F.to_date("timestamp").alias(PARTITION_COLUMN),
        )
        .hint("rebalance", PARTITION_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION_COLUMN)
        .parquet(f"{folder}/readings/{BATCH_COLUMN}={name}")
    )


def start_ingest(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    dedup: str = "ids",
    same_day_only: bool = False,
    state_partitions: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the ingest query: decode, drop repeated event ids, write good rows and rejects.

    ``dedup``:

    * ``ids``: against a table of all ids beside the readings (``folder``/event_ids), bucketed by id: a
      batch is shuffled, the table is not, and the query keeps no state.  For any number of writers,
      which take turns.
    * ``state``: ids are kept in the query's RocksDB state, so a batch costs as
      much as its own rows whatever the size of the table.  For one writer.  The
      number of ``state_partitions`` (default: the session's shuffle partitions)
      stays for the life of the checkpoint.
    * ``sink``: each batch is checked against the ids in the table, also those
      written by other streams.  Reads the table's id column once per batch;
      with ``same_day_only`` only that of the batch's days.

    In all three the first copy stays: the earliest batch's, and within a batch the
    least by partition, offset (where the source has them) and value.  None
    forgets an id: a late, never-seen event is always kept.
    """
    if dedup not in ("ids", "sink", "state"):
        raise ValueError(f"dedup must be 'ids', 'sink' or 'state', not {dedup!r}")
    spark = messages.sparkSession
    decoded = decode_readings(messages)
    if dedup == "state":
        decoded = _with_new_ids(decoded)
    for table in ("readings", "rejects", "counters"):
        make_folder(spark, f"{folder}/{table}")  # so that the first batch has something to read
    writer = batch_writer(
        folder,
        _stream_name(spark, checkpoint),
        against_sink=dedup == "sink",
        same_day_only=same_day_only,
        ids_table=IdTable(spark, f"{folder}/event_ids") if dedup == "ids" else None,
    )
    query = (
        decoded.writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    wanted = {_STATE_STORE: _ROCKS_DB}
    if state_partitions is not None:
        wanted[_PARTITIONS] = str(state_partitions)
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        # a query takes its own copy of the settings when it starts
        return query.start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def compact(spark: SparkSession, folder: str, batches: Sequence[str], name: str) -> None:
    """Merge the readings of finished ``batches`` into the sub-folder ``name``, a file or so per day.

    To be run while no batch of them can be repeated, hence not on the stream's
    latest one.  The merged folder is complete before the old ones go.
    """
    if name in batches:
        raise ValueError("the merged folder needs a name of its own")
    merged = read_readings(spark, folder).where(F.col(BATCH_COLUMN).isin(list(batches)))
    (
        merged.drop(BATCH_COLUMN)
        .hint("rebalance", PARTITION_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION_COLUMN)
        .parquet(f"{folder}/readings/{BATCH_COLUMN}={name}")
    )
    for batch in batches:
        delete(spark, f"{folder}/readings/{BATCH_COLUMN}={batch}")


def _with_new_ids(decoded: DataFrame) -> DataFrame:
    """All rows, and one more for each event id that comes for the first time in the life of the query.

    The added rows hold the id alone and are marked as ``first_seen``: the state
    says which ids are new, the batch which copy is the first.  Ids are dropped
    per source task first: one that makes up a large part of a batch is spread
    over the tasks of the source, and only one row of each goes to the task that
    owns the id.
    """
    keyed = F.col("reject_reason").isNull() & F.col("event_id").isNotNull()
    ids = (
        decoded.withColumn("source_task", F.spark_partition_id())
        .where(keyed)
        .select("event_id", "source_task")
        .dropDuplicates(["event_id", "source_task"])
        .dropDuplicates(["event_id"])
        .select("event_id", F.lit(True).alias(_FIRST_SEEN))
    )
    return decoded.withColumn(_FIRST_SEEN, F.lit(False)).unionByName(ids, allowMissingColumns=True)


def _stream_name(spark: SparkSession, checkpoint: str) -> Callable[[], str]:
    """Id of the query as its checkpoint records it: the same after a restart."""

    def name() -> str:
        recorded = spark.read.text(f"{checkpoint}/metadata").first()[0]
        return json.loads(recorded)["id"]

    return name


def _read(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(location)
