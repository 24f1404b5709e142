"""Session defaults and durable staging of shared intermediate results."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_SCAN_TASKS = "spark.sql.files.minPartitionNum"


def build_session(app: str = "roomtide", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names in spark.checkpoint.dir.

    Only a local session that names none (tests, local runs) gets a temporary folder: on a cluster
    each executor would write to its own disk.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="roomtide-")
        spark.conf.set(CHECKPOINT_DIR, named)
    return named.rstrip("/")


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _located(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _located(spark, path)
    fs.delete(at, True)


def _files(spark: SparkSession, table: str) -> Iterator[tuple[str, int]]:
    """Data files below a folder, hidden ones left out: path inside the folder and length."""
    fs, at = _located(spark, table)
    if not fs.exists(at):
        return
    top = fs.resolvePath(at).toUri().getPath().rstrip("/") + "/"
    files = fs.listFiles(at, True)
    while files.hasNext():
        f = files.next()
        inner = fs.resolvePath(f.getPath()).toUri().getPath().removeprefix(top)
        if not re.search(r"(^|/)[._]", inner):
            yield inner, f.getLen()


def stored_bytes(spark: SparkSession, table: str) -> int:
    """Bytes of all data files below a folder."""
    return sum(size for _, size in _files(spark, table))


@contextmanager
def scan_tasks(spark: SparkSession, least: int) -> Iterator[None]:
    """Inside this block files are read by `least` tasks or more, if their size allows it: where every task sorts what it
    reads. The setting belongs to the session and is read when a scan runs."""
    before = spark.conf.get(_SCAN_TASKS, None)
    spark.conf.set(_SCAN_TASKS, str(max(least, int(before or spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SCAN_TASKS)
        else:
            spark.conf.set(_SCAN_TASKS, before)


def _digest(files: list[tuple[str, int]]) -> str:
    return hashlib.sha1("\n".join(f"{n}:{size}" for n, size in sorted(files)).encode()).hexdigest()


def fingerprint(spark: SparkSession, table: str) -> str:
    """Digest of the names and lengths of all files of a table. Files are written under new names each time."""
    return _digest(list(_files(spark, table)))


def fingerprints(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """The same per value of the partition column; empty for a table that is not partitioned by it."""
    found: dict[str, list[tuple[str, int]]] = {}
    for inner, size in _files(spark, table):
        folder, _, name = inner.partition("/")
        if name and folder.startswith(f"{column}="):
            found.setdefault(folder.removeprefix(f"{column}="), []).append((name, size))
    return {value: _digest(files) for value, files in found.items()}


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; an absent folder has none."""
    fs, at = _located(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _located(spark, path)
    source = fs.open(at)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = _located(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def rename_new(spark: SparkSession, fresh: str, target: str) -> bool:
    """Rename a file unless the target exists; the file system's own check, so of several writers one succeeds."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(fresh), hadoop.Path(target)
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(old.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(old, new, plain)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def put_in_place(spark: SparkSession, fresh: str, target: str) -> None:
    """Make the finished folder `fresh` the folder `target`.

    The old folder is set aside under a hidden name and removed last. Where a driver died between
    the two renames, `restore` puts it back.
    """
    restore(spark, target)
    fs, new = _located(spark, fresh)
    at, old = (_located(spark, p)[1] for p in (target, _aside(target)))
    fs.delete(old, True)
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"cannot set {target} aside")
    if not fs.rename(new, at):
        raise OSError(f"cannot move {fresh} to {target}")
    fs.delete(old, True)


def restore(spark: SparkSession, target: str) -> None:
    """Put a folder back that was set aside and never replaced."""
    fs, at = _located(spark, target)
    old = _located(spark, _aside(target))[1]
    if not fs.exists(at) and fs.exists(old):
        fs.rename(old, at)


def _aside(target: str) -> str:
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.old"


_scope: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends. For runs that write their result
    inside the block; frames that outlive it must not depend on staged tables."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            remove(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and return the written table.

    Cuts the lineage of a frame that several branches read. Unlike a cached frame the table
    survives the loss of executors, and unlike an RDD checkpoint it stays columnar, so each
    branch still reads only its own columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    staged = _scope.get()
    if staged is not None:
        staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that `build` makes, written to the shared folder, without the tables staged on the way: they
    are removed as soon as the result is written, or the run has failed."""
    outer = _scope.get()
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    with staging_scope(spark):
        made = build()
        made.write.parquet(path)
    if outer is not None:
        outer.append(path)
    return spark.read.schema(made.schema).parquet(path)
