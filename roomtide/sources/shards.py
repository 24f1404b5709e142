"""Tables without a date, in shards by a hash of their key: a load rewrites the shards that hold its keys.

A shard is a partition of a published table, so all shards of a load, and all tables of it, change at once, and
the files of other shards are not touched. The number of shards is fixed when a table is first written, from its
size; `reshard` writes it anew with another number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .published import Change, Published
from .writers import upsert

SHARD = "shard"
ROWS_EACH = 2_000_000


def shard_of(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n))


class Sharded:
    """A keyed table in `n` shards by a hash of `route`, which is the key or a part of it."""

    def __init__(self, published: Published, name: str, schema: StructType, keys: list[str], route: list[str] | None = None, rows_each: int = ROWS_EACH) -> None:
        self.published, self.name, self.schema, self.keys = published, name, schema, keys
        self.route, self.rows_each = route or keys, rows_each
        self.stored = StructType([*schema.fields, StructField(SHARD, LongType())])

    def n_shards(self, change: Change) -> int | None:
        n = change.notes().get(f"{self.name}.shards")
        return int(n) if n else None

    def read(self) -> DataFrame:
        return self.published.read(self.name, self.stored, SHARD).drop(SHARD)

    def find(self, keys: DataFrame) -> DataFrame:
        """Rows of some keys: only their shards are read."""
        change = self.published.begin()
        n = self.n_shards(change)
        if not n:
            return self.read()
        near = [str(r[0]) for r in keys.select(shard_of(self.route, n)).distinct().collect()]  # at most the number of shards
        return self.published.read(self.name, self.stored, SHARD, near).drop(SHARD).join(keys, self.keys, "left_semi")

    def merge(self, change: Change, new: DataFrame, policy: dict[str, str] | str, ordinal: str | None = None) -> list[str]:
        """Upsert `new` within a change; returns the shards that were rewritten."""
        n = self.n_shards(change)
        if not n:
            n = max(1, math.ceil(new.count() / self.rows_each))
            change.note({f"{self.name}.shards": str(n)})
        routed = new.withColumn(SHARD, shard_of(self.route, n))
        touched = [str(r[0]) for r in routed.select(SHARD).distinct().collect()]  # at most the number of shards
        if not touched:
            return []
        old = change.read(self.name, self.stored, SHARD, touched).drop(SHARD)
        merged = upsert(old, new, self.keys, policy, ordinal).withColumn(SHARD, shard_of(self.route, n))
        self._put(change, merged, touched, n)
        return sorted(touched)

    def _put(self, change: Change, rows: DataFrame, touched: list[str], n: int) -> None:
        # one shuffle on the shard and a hash of the key: a shard of any size spreads over tasks
        pieces = F.pmod(F.xxhash64(*self.keys), F.lit(4))
        change.put(self.name, rows.repartition(SHARD, pieces).select(*[f.name for f in self.stored.fields]), SHARD, [SHARD, *self.keys], touched)

    def reshard(self, change: Change, n: int) -> None:
        rows = change.read(self.name, self.stored, SHARD).withColumn(SHARD, shard_of(self.route, n))
        change.note({f"{self.name}.shards": str(n)})
        old = list(change.tables.get(self.name, {}))
        self._put(change, rows, old, n)
