"""Tables of several partitions, and several tables, that change all at once.

Rows are written to new version folders below their table. A manifest, a small numbered JSON file, says which
version of each partition counts; the one with the highest number is in force, and writing the next one is the only
step that readers can see. A run that ends before it leaves readers on the old state, a run that ends after it
on the new one; folders that no manifest names are swept later. Readers resolve one manifest and read
only what it names, so they see one state over all tables, even while another is published.

The manifest is put in place by a rename that fails if the number is taken: of two writers that started from the
same state one gets a `Conflict` and starts again. It lists one entry per partition, some bytes each, and partition
filters are applied to it before any folder is listed.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import names_in, read_text, remove, rename_new, write_text

MANIFESTS, NOTES, WHOLE = "_manifest", "_note", ""
KEEP = 2


class Conflict(RuntimeError):
    """Another writer has published since this change was begun."""


@dataclass(frozen=True)
class Manifest:
    """number, and per table the version of each partition value ("" for a table without partitions)."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)

    def names(self) -> set[tuple[str, str]]:
        return {(table, version) for table, parts in self.tables.items() if table != NOTES for version in parts.values()}


class Published:
    """Published tables below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # --- reading ----------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        found = names_in(self.spark, f"{self.root}/{MANIFESTS}")
        return sorted(int(n.removesuffix(".json")) for n in found if re.fullmatch(r"\d+\.json", n))

    def _path(self, number: int) -> str:
        return f"{self.root}/{MANIFESTS}/{number:012d}.json"

    def manifest(self, number: int | None = None) -> Manifest:
        """The manifest in force, or an older one that is still there."""
        if number is None:
            number = max(self._numbers(), default=0)
        if not number:
            return Manifest()
        return Manifest(number, json.loads(read_text(self.spark, self._path(number))))

    def holds(self, table: str) -> bool:
        return table in self.manifest().tables

    def read(
        self, table: str, schema: StructType | None = None, partition: str | None = None, values: list[str] | None = None, at: Manifest | None = None
    ) -> DataFrame:
        """Rows of a table, all or of some partition values; `at` keeps several reads on one state. Schema and
        partition column are those the table was written with, unless they are given."""
        at = at or self.manifest()
        notes = at.tables.get(NOTES, {})
        if schema is None:
            schema = StructType.fromJson(json.loads(notes[f"{table}.schema"]))
            partition = notes.get(f"{table}.partition")
        parts = at.tables.get(table, {})
        chosen = {v: version for v, version in parts.items() if values is None or v in values}
        base = f"{self.root}/{table}"
        paths = [f"{base}/{version}/{partition}={v}" if partition else f"{base}/{version}" for v, version in sorted(chosen.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*[f.name for f in schema.fields])

    def values(self, table: str, at: Manifest | None = None) -> list[str]:
        return sorted((at or self.manifest()).tables.get(table, {}))

    # --- writing ----------------------------------------------------------------------------

    def begin(self) -> Change:
        return Change(self, self.manifest())

    def sweep(self, keep: int = KEEP) -> None:
        """Remove all manifests but the newest `keep`, and the versions that only these named. Readers that still use an
        older manifest than these fail; versions of changes not yet published are left alone."""
        numbers = self._numbers()
        old, new = numbers[:-keep], numbers[-keep:]
        used = set().union(*(self.manifest(n).names() for n in new)) if new else set()
        for n in old:
            for table, version in self.manifest(n).names() - used:
                remove(self.spark, f"{self.root}/{table}/{version}")
            remove(self.spark, self._path(n))

    def sweep_lost(self) -> None:
        """Remove versions that no manifest names: left by runs that ended early. Only while no change is under way."""
        used = set().union(*(self.manifest(n).names() for n in self._numbers()))
        for table in names_in(self.spark, self.root):
            if table != MANIFESTS:
                for version in names_in(self.spark, f"{self.root}/{table}"):
                    if (table, version) not in used:
                        remove(self.spark, f"{self.root}/{table}/{version}")
        for name in names_in(self.spark, f"{self.root}/{MANIFESTS}"):
            if name.startswith("."):
                remove(self.spark, f"{self.root}/{MANIFESTS}/{name}")


class Change:
    """What will be published together. Nothing of it can be seen before `publish`."""

    def __init__(self, published: Published, base: Manifest) -> None:
        self.published, self.base = published, base
        self.tables = {t: dict(parts) for t, parts in base.tables.items()}

    def read(self, table: str, schema: StructType | None = None, partition: str | None = None, values: list[str] | None = None) -> DataFrame:
        """The rows as this change leaves them."""
        return self.published.read(table, schema, partition, values, Manifest(self.base.number, self.tables))

    def put(self, table: str, rows: DataFrame, partition: str | None = None, sort: list[str] | None = None, values: list[str] | None = None) -> None:
        """Replace the partitions that occur in `rows`, and those of `values`, also by nothing; without `partition` the whole table."""
        version = f"roomtide_version=x{uuid.uuid4().hex}"
        path = f"{self.published.root}/{table}/{version}"
        order = [*([partition] if partition else []), *[c for c in sort or [] if c != partition]]
        out = rows.sortWithinPartitions(*order) if sort else rows  # the write wants them by partition value, too
        writer = out.write.partitionBy(partition) if partition else out.write
        writer.parquet(path)
        parts = self.tables.setdefault(table, {})
        self.note({f"{table}.schema": rows.schema.json()} | ({f"{table}.partition": partition} if partition else {}))
        if not partition:
            self.tables[table] = {WHOLE: version}
            return
        for value in values or []:
            parts.pop(value, None)
        for name in names_in(self.published.spark, path):
            if name.startswith(f"{partition}="):
                parts[name.removeprefix(f"{partition}=")] = version

    def drop(self, table: str, values: list[str]) -> None:
        for value in values:
            self.tables.get(table, {}).pop(value, None)

    def note(self, notes: dict[str, str]) -> None:
        """Words that are published with the tables and stay until they are replaced."""
        self.tables[NOTES] = self.tables.get(NOTES, {}) | notes

    def notes(self) -> dict[str, str]:
        return self.tables.get(NOTES, {})

    def publish(self) -> Manifest:
        """Put the next manifest in force."""
        p, number = self.published, self.base.number + 1
        fresh = f"{p.root}/{MANIFESTS}/.{uuid.uuid4().hex}"
        write_text(p.spark, fresh, json.dumps(self.tables))
        if not rename_new(p.spark, fresh, p._path(number)):
            remove(p.spark, fresh)
            raise Conflict(f"manifest {number} of {p.root} is taken")
        return Manifest(number, self.tables)
