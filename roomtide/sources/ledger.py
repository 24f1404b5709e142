"""Accounts of landed files: what was stored, what was read, and what a cut file has lost.

A gzip file that ends early yields the rows before the cut and no error where corrupt files are tolerated, so a
run sees fewer rows and nothing else. Each compressed member ends in a trailer with the length of what it holds; a file is
whole if its last member has one. The ledger has one row per file and sets beside each other what the reader
got and what the file holds; a landing manifest, where there is one, also tells how many rows are missing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "file string, stored_bytes long, n_members int, plain_bytes long, is_cut boolean"
BLOCK = 1 << 20


class TooMuchLost(RuntimeError):
    """More files or rows are missing than was allowed."""


def inspect(data: bytes) -> tuple[int, int, bool]:
    """(members, plain bytes before any cut, whether it is cut) of a gzip file."""
    members, plain, at, whole = 0, 0, 0, True
    while at < len(data):
        member = zlib.decompressobj(31)
        try:
            while at < len(data) and not member.eof:
                plain += len(member.decompress(data[at:at + BLOCK]))
                at += min(BLOCK, len(data) - at)
        except zlib.error:
            return members, plain, True
        whole = member.eof
        members += whole
        at -= len(member.unused_data)
    return members, plain, not whole or not members


def _inspected(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, size, data in zip(*(batch.column(c).to_pylist() for c in ("file", "length", "content")), strict=True):
            zipped = name.endswith(".gz")
            members, plain, cut = inspect(data) if zipped else (0, size, False)
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "stored_bytes": [size], "n_members": pa.array([members], pa.int32()), "plain_bytes": [plain], "is_cut": [cut]}
            )


def landing_ledger(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame:
    """One row per file of a landing folder: file, stored_bytes, n_members, plain_bytes, is_cut, n_rows and read_bytes
    (what a tolerant reader got, line ends included), and with a manifest (file, n_rows) also lost_rows.

    The reader's counts come from the same scan that loads rows. A file's bytes are inflated once more by one
    task, block by block; gzip can't be split, and the compressed bytes of one file are held at a time. Files of the
    manifest that are absent are listed with nulls and all their rows lost; files that it lacks have lost_rows null.
    """
    name = F.element_at(F.split(F.col("p"), "/"), -1).alias("file")
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("p"), "length", "content")
    stored = files.select(name, "length", "content").mapInArrow(_inspected, LEDGER)
    lines = spark.read.option("ignoreCorruptFiles", "true").text(path)
    got = lines.select(F.col("_metadata.file_path").alias("p"), F.octet_length("value").alias("size")).select(name, "size")
    read = got.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("size") + 1).alias("read_bytes"))
    out = stored.join(read, "file", "left").fillna(0, ["n_rows", "read_bytes"])
    if manifest is None:
        return out
    told = manifest.select("file", F.col("n_rows").cast("long").alias("told"))
    return out.join(told, "file", "full").withColumn("lost_rows", F.col("told") - F.coalesce("n_rows", F.lit(0))).drop("told")


def shortened(ledger: DataFrame) -> DataFrame:
    """Files that are cut or miss rows."""
    return ledger.where("is_cut OR lost_rows > 0" if "lost_rows" in ledger.columns else "is_cut")


def require_whole(ledger: DataFrame, max_share: float = 0.0) -> DataFrame:
    """The ledger, if at most `max_share` of its files are shortened; else `TooMuchLost` names the worst of them."""
    short = shortened(ledger)
    n, bad = ledger.count(), short.count()
    if bad > max_share * n:
        worst = ", ".join(r.file for r in short.orderBy("file").limit(5).collect())
        raise TooMuchLost(f"{bad} of {n} files are shortened: {worst}")
    return ledger
