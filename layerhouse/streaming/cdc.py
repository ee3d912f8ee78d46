"""Change data capture: Debezium envelopes from files to a current-state table.

State is kept as change files, one folder per micro-batch, plus a base that compaction folds them
into.  A batch costs its own changes rather than a rewrite of the table, and a retried batch
replaces its own folder, so results do not depend on retries or on the order of files.

Both are laid out in buckets of the key's hash.  Compaction reads and rewrites the buckets that have
changes and no others; a bucket's base is the newest complete version that holds it.  A version
counts once it is complete; then the folders it replaces are removed.  One that is left over, or comes
again with a retried batch, changes nothing: the last change per key is the same.  For that reason the
number of buckets may change as well: a key found in two buckets still has one last change.

``start`` puts an initial snapshot of the table in place, as of a position in the log.  Changes up to
that position are part of the snapshot already, so a row read in both appears once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from layerhouse.session import release

LATEST = ["ts_ms", "seq"]

#: Buckets of the key's hash in which state is laid out.
BUCKETS = 32


def envelope(row: str) -> T.StructType:
    """Schema of a change: row images before and after, operation, time and sequence."""
    return T.StructType.fromDDL(
        f"before struct<{row}>, after struct<{row}>, op string, ts_ms bigint, seq bigint"
    )


def read_changes(spark: SparkSession, folder: str, row: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of typed changes from JSON-lines files."""
    reader = spark.readStream.schema(envelope(row))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def keyed(changes: DataFrame, key: str) -> DataFrame:
    """Changes as (key, row, op, ts_ms, seq); a key change is a delete of the old key as well."""
    old, new = F.col(f"before.{key}"), F.col(f"after.{key}")
    upsert = F.struct(new.alias("key"), F.col("after").alias("row"), F.lit(False).alias("deleted"))
    delete = F.struct(
        old.alias("key"), F.lit(None).cast(changes.schema["after"].dataType).alias("row"),
        F.lit(True).alias("deleted"),
    )
    gone = (F.col("op") == "d") | (new.isNotNull() & old.isNotNull() & (old != new))
    images = F.filter(
        F.array(F.when(gone, delete), F.when(F.col("op") != "d", upsert)), lambda c: c.isNotNull()
    )
    return changes.select(F.explode(images).alias("c"), *LATEST).select("c.*", *LATEST)


def latest(changes: DataFrame) -> DataFrame:
    """The last change per key; an aggregate, so each task keeps one row per key."""
    newest = F.max_by(F.struct("row", "deleted", *LATEST), F.struct(*LATEST))
    return changes.groupBy("key").agg(newest.alias("c")).select("key", "c.*")


def _lay(rows: DataFrame, path: str, buckets: int) -> None:
    """Write last changes below ``path`` in buckets of the key's hash; a big bucket is split into files."""
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def start(
    snapshot: DataFrame, key: str, state: str, ts_ms: int, seq: int, buckets: int = BUCKETS
) -> None:
    """Begin a state with the table as it was at a position in the log.

    To be called before the first ``run``; called again, it starts over from the new snapshot.
    """
    spark = snapshot.sparkSession
    for part in ("base", "changes"):
        release(spark, f"{state}/{part}")
    spark.range(1).select(
        F.lit(ts_ms).cast("long").alias("ts_ms"), F.lit(seq).cast("long").alias("seq")
    ).write.mode("overwrite").parquet(f"{state}/position")
    rows = snapshot.select(
        F.col(key).alias("key"), F.struct(*snapshot.columns).alias("row"), F.lit(False).alias("deleted"),
        F.lit(ts_ms).cast("long").alias("ts_ms"), F.lit(seq).cast("long").alias("seq"),
    )
    _lay(rows, f"{state}/base/version=1", buckets)


def _position(spark: SparkSession, state: str) -> tuple[int, int] | None:
    """The position of the snapshot the state began with."""
    if not _folders(spark, state, "position", done=True):
        return None
    return tuple(spark.read.parquet(f"{state}/position").first())


def run(
    changes: DataFrame, key: str, state: str, checkpoint: str, buckets: int = BUCKETS, **trigger
) -> None:
    """Apply a stream of changes to the state folder; by default process what is there and stop."""
    if begun := _position(changes.sparkSession, state):
        if not _bases(changes.sparkSession, state)[2]:
            raise ValueError(f"{state}: its snapshot is not complete; start again")
        changes = changes.where(F.struct(*LATEST) > F.struct(*[F.lit(v).cast("long") for v in begun]))

    def apply(batch: DataFrame, batch_id: int) -> None:
        _lay(latest(keyed(batch, key)), f"{state}/changes/batch={batch_id}", buckets)

    query = (
        changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
    query.awaitTermination()


def _folders(spark: SparkSession, parent: str, name: str, done: bool = False) -> dict[int, str]:
    """Folders ``name=<number>`` (or ``name``, as 0) below ``parent``; with ``done`` those of finished writes only."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(parent).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path(parent)):
        return {}
    names = [str(status.getPath().getName()) for status in files.listStatus(path(parent))]
    found = {int(n.partition("=")[2] or 0): f"{parent}/{n}" for n in names if n.partition("=")[0] == name}
    return {k: f for k, f in found.items() if not done or files.exists(path(f"{f}/_SUCCESS"))}


def _bases(spark: SparkSession, state: str) -> tuple[dict[int, str], list[str], int]:
    """The folder each bucket's base is in, the folders that newer ones have replaced, the newest version (0: none)."""
    versions = _folders(spark, f"{state}/base", "version", done=True)
    held, replaced = {}, []
    for version in sorted(versions):
        parts = _folders(spark, versions[version], "bucket")
        replaced += [held[b] for b in parts if b in held]
        held |= parts
    return held, replaced, max(versions, default=0)


def _batches(spark: SparkSession, state: str) -> tuple[dict[int, list[str]], list[str]]:
    """The folders of changes per bucket, and the folders of the batches they are in."""
    batches = _folders(spark, f"{state}/changes", "batch", done=True)
    found: dict[int, list[str]] = {}
    for number in sorted(batches):
        for bucket, folder in _folders(spark, batches[number], "bucket").items():
            found.setdefault(bucket, []).append(folder)
    return found, [batches[n] for n in sorted(batches)]


def current(spark: SparkSession, state: str, row: str) -> DataFrame:
    """Rows of the table now: last change per key over base and change files, deletes dropped.

    ``row`` is the row's schema, which an empty state has as well.
    """
    held, *_ = _bases(spark, state)
    changed, _ = _batches(spark, state)
    paths = [*held.values(), *(f for folders in changed.values() for f in folders)]
    if not paths:
        return spark.createDataFrame([], T.StructType.fromDDL(row))
    return latest(spark.read.parquet(*paths)).where(~F.col("deleted")).select("row.*")


def compact(spark: SparkSession, state: str, buckets: int = BUCKETS) -> list[str]:
    """Fold the change files into the base of the buckets they are in; deletes stay, so late changes still lose.

    What was folded is removed once the new version is complete; not to be run beside ``run``.  Returns
    the folders that were read.
    """
    held, _, version = _bases(spark, state)
    changed, batches = _batches(spark, state)
    read = [f for b in sorted(changed) for f in [*([held[b]] if b in held else []), *changed[b]]]
    if read:
        _lay(latest(spark.read.parquet(*read)), f"{state}/base/version={version + 1}", buckets)
    # also what a compaction that was cut off has left
    for folder in [*_bases(spark, state)[1], *batches]:
        release(spark, folder)
    versions = _folders(spark, f"{state}/base", "version", done=True)
    for version in sorted(versions)[:-1]:
        if not _folders(spark, versions[version], "bucket"):
            release(spark, versions[version])
    return read
