"""Incremental ingestion of a landing folder with Structured Streaming.

The file source remembers what it has read in its checkpoint, which replaces a list of finished
units: a restarted run continues with the new files. `availableNow` processes what is there in
bounded batches and stops.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from .. import schemas
from ..keys import OBSERVATION, PACKAGE
from ..operators.ingest import observation_columns, package_columns, shaped
from ..operators.occupancy import drop_past
from ..session import exists, names_in, read_text, remove, scan_tasks, shared_dir, stage, staging_scope, stored_bytes, write_text
from ..sources.published import Published
from ..sources.writers import OBSERVATION_POLICY, PACKAGE_POLICY, dedupe_last, fold, replace_partition, upsert

FILES_PER_BATCH = 1000


def ingest_stream(
    spark: SparkSession, folder: str, schema: StructType = schemas.SLOT,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Streaming frame over landed JSON lines; malformed lines are skipped. Rows know when and in
    which file they landed."""
    rows = (
        spark.readStream.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )
    return rows.select(
        "*", F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("landed_in"),
    )


def current_partitions(
    spark: SparkSession, path: str, days: DataFrame, schema: StructType = schemas.OBSERVATION
) -> DataFrame | None:
    """The stored rows of the observation days in `days`, or None if there is no table yet."""
    try:
        table = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table.join(days, "observed_date", "left_semi").select(
        *[f.name for f in schema.fields]
    )


#: Kinds of kept rows.
TIMES, OFFERS = "observations", "packages"
_KINDS = {TIMES: (schemas.OBSERVATION, OBSERVATION, OBSERVATION_POLICY), OFFERS: (schemas.PACKAGE, PACKAGE, PACKAGE_POLICY)}
#: Kept rows of both kinds: the columns of both tables, the kind and the place in the order of landing.
_PLACE = schemas.table(is_package=schemas.FLAG, landed_at=schemas.TS, landed_in=schemas.TEXT, row=schemas.LONG)
_KEPT = StructType([*{f.name: f for f in (*schemas.OBSERVATION, *schemas.PACKAGE, *_PLACE)}.values()])
_ROWS = "rows"
#: Bytes of kept files that a task of the merge reads: more batches make more tasks, not larger sorts.
_TASK_BYTES = 4 << 20


def keep_batch(batch: DataFrame, batch_id: int, kept: str) -> None:
    """Write the rows of one micro-batch below the folder `kept`, both kinds as they come, each with its place in the
    order of landing: one pass over the landed files, nothing is shuffled or sorted. Which record of a key counts is
    found for all batches of a run at once. A batch that is played again replaces what it left before."""
    placed = batch.withColumn("row", F.monotonically_increasing_id())
    package = F.coalesce(F.col("kind") == "pkg", F.lit(False)).alias("is_package")
    rows, _ = drop_past(placed, "d", "observed")
    offer = F.struct(*package_columns())
    only = [offer[f].alias(f) for f in schemas.PACKAGE.fieldNames() if f not in schemas.OBSERVATION.fieldNames()]
    made = rows.select(*observation_columns(), *only, package, "landed_at", "landed_in", "row")
    shaped(made, _KEPT).write.mode("overwrite").parquet(f"{kept}/{_ROWS}/batch={batch_id}")


def _batches(spark: SparkSession, kept: str) -> list[int]:
    """Numbers of the kept batches; one that ended before it was written does not count."""
    found = [int(n.removeprefix("batch=")) for n in names_in(spark, f"{kept}/{_ROWS}") if n.startswith("batch=")]
    return sorted(n for n in found if exists(spark, f"{kept}/{_ROWS}/batch={n}/_SUCCESS"))


def _kept_rows(spark: SparkSession, kept: str, kind: str, batches: list[int]) -> DataFrame:
    """The rows of kept batches, unique by key, as if these had been merged one after the other: within a batch the
    record of a key that landed last counts.

    Only hashes of the keys are shuffled to find repeated ones; rows whose key comes once are taken as they are. For
    runs that write their result inside a staging scope."""
    schema, keys, policy = _KINDS[kind]
    base = f"{kept}/{_ROWS}"
    numbered = StructType([*_KEPT, StructField("batch", LongType())])
    rows = spark.read.schema(numbered).option("basePath", base).parquet(*[f"{base}/batch={n}" for n in batches])
    rows = rows.where(F.col("is_package") if kind == OFFERS else ~F.col("is_package"))
    mark = F.xxhash64(*keys).alias("mark")
    repeated = stage(rows.groupBy(mark).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark"), "repeated")
    if repeated.isEmpty():
        return rows.select(*schema.fieldNames())
    marked = rows.select("*", mark)
    once = marked.join(repeated, "mark", "left_anti")
    order = F.struct("landed_at", "landed_in", "row")
    again = marked.join(repeated, "mark", "left_semi").select(*schema.fieldNames(), "batch", order.alias("ordinal"))
    folded = fold(dedupe_last(again, [*keys, "batch"], "ordinal"), keys, policy, "batch")
    return once.select(*schema.fieldNames()).unionByName(folded.select(*schema.fieldNames()))


def _days(rows: DataFrame) -> list[str]:
    return [r[0].isoformat() for r in rows.select("observed_date").distinct().collect()]  # days of one run


@contextmanager
def _merging(spark: SparkSession, kept: str) -> Iterator[None]:
    """Tables staged in the block are removed at its end; its scans have tasks by the size of what was kept."""
    with staging_scope(spark), scan_tasks(spark, stored_bytes(spark, f"{kept}/{_ROWS}") // _TASK_BYTES):
        yield


def _merge_kind(spark: SparkSession, kept: str, kind: str, batches: list[int], at: str) -> None:
    """Merge the kept rows of one kind into its table.

    Days that are not stored yet are written at once. A note below `kept` says so before: if the driver dies while they
    are, what it left of them is replaced by the next run, not merged with. Else the merged days are written below
    `kept` first and stay there until they have replaced the stored ones: the next run takes them from there instead
    of merging with days of which some are already replaced or gone."""
    schema, keys, policy = _KINDS[kind]
    merged, fresh = f"{kept}/merged/{kind}", f"{kept}/fresh-{kind}"
    with _merging(spark, kept):
        if not exists(spark, f"{merged}/_SUCCESS"):
            new = _kept_rows(spark, kept, kind, batches)
            if not exists(spark, fresh) and {f"observed_date={d}" for d in _days(new)}.isdisjoint(names_in(spark, at)):
                write_text(spark, fresh, "")
            if exists(spark, fresh):
                replace_partition(new, at, sort=keys)
                return
            new = stage(new, "batch")
            old = current_partitions(spark, at, new.select("observed_date").distinct(), schema)
            upsert(old, new, keys, policy, unique=True).write.mode("overwrite").parquet(merged)
        replace_partition(spark.read.schema(schema).parquet(merged), at, sort=keys)


def merge_kept(spark: SparkSession, kept: str, path: str, package_path: str, last: str) -> None:
    """Merge the kept batches into the date-partitioned observation and package tables, all at once. Batches up to the
    number in the file `last` are in the tables."""
    batches = _batches(spark, kept)
    if batches:
        for kind, at in ((TIMES, path), (OFFERS, package_path)):
            _merge_kind(spark, kept, kind, batches, at)
        write_text(spark, last, str(batches[-1]))
    for name in (_ROWS, "merged", *[f"fresh-{kind}" for kind in _KINDS]):
        remove(spark, f"{kept}/{name}")


def run_ingest(
    spark: SparkSession, folder: str, path: str, checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH, package_path: str | None = None,
) -> StreamingQuery:
    """Ingest everything that has landed since the last run, then stop. Package rows go to
    `package_path`, beside the observations unless it is given.

    Batches are kept as they come and merged into the tables once, at the end of the run, so a run rewrites the stored
    days once, however many batches it has. What a run that died has kept is merged by the next one first."""
    package_path = package_path or f"{path.rstrip('/')}-packages"
    kept, last = f"{checkpoint.rstrip('/')}-merged", f"{checkpoint.rstrip('/')}/last-merged"

    def write(batch: DataFrame, batch_id: int) -> None:
        if not (exists(spark, last) and batch_id <= int(read_text(spark, last))):
            keep_batch(batch, batch_id, kept)

    merge_kept(spark, kept, path, package_path, last)
    query = _run(ingest_stream(spark, folder, files_per_batch=files_per_batch), write, checkpoint)
    merge_kept(spark, kept, path, package_path, last)
    return query


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _published_up_to(notes: dict[str, str], name: str) -> int:
    return int(notes.get(f"{name}.batch", -1))


def publish_kept(store: Published, kept: str, name: str, package_name: str) -> None:
    """Merge the kept batches into two published tables: all their days of both become visible together. The number of
    the last batch is published with them, so a batch that is played again after its publication changes nothing."""
    change, spark = store.begin(), store.spark
    done = _published_up_to(change.notes(), name)
    batches = [n for n in _batches(spark, kept) if n > done]
    if batches:
        for table, kind in ((name, TIMES), (package_name, OFFERS)):
            schema, keys, policy = _KINDS[kind]
            with _merging(spark, kept):
                new = _kept_rows(spark, kept, kind, batches)
                days = _days(new)
                if not set(days).isdisjoint(change.tables.get(table, {})):
                    old = change.read(table, schema, "observed_date", days)
                    new = upsert(old, stage(new, "batch"), keys, policy, unique=True).select(*schema.fieldNames())
                change.put(table, new, "observed_date", keys, days)
        change.note({f"{name}.batch": str(batches[-1])})
        change.publish()
    remove(spark, kept)


def publish_batch(batch: DataFrame, batch_id: int, store: Published, name: str, package_name: str) -> None:
    """Merge one micro-batch into two published tables, unless it has been published."""
    if batch_id > _published_up_to(store.begin().notes(), name):
        kept = f"{shared_dir(store.spark)}/kept-{uuid.uuid4().hex}"
        keep_batch(batch, batch_id, kept)
        publish_kept(store, kept, name, package_name)


def publish_ingest(
    store: Published, folder: str, checkpoint: str, name: str, package_name: str, files_per_batch: int = FILES_PER_BATCH
) -> StreamingQuery:
    """Ingest everything that has landed since the last run into published tables, then stop. The batches of a run are
    published together, at its end; what a run that died has kept is published by the next one first."""
    kept = f"{checkpoint.rstrip('/')}-kept"

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id > _published_up_to(store.begin().notes(), name):
            keep_batch(batch, batch_id, kept)

    publish_kept(store, kept, name, package_name)
    query = _run(ingest_stream(store.spark, folder, files_per_batch=files_per_batch), write, checkpoint)
    publish_kept(store, kept, name, package_name)
    store.sweep()
    return query
