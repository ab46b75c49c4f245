"""State of traces over micro-batches, as a log of what each batch changed.

A batch reads the state of the traces it has rows of, and writes the state of
these traces alone. The newest entry of a trace counts; every entry says in
``traces`` which batch wrote it, and the other tables' rows of that batch belong to it.
When enough batches have been written, the newest entries of all traces become one
base, and what came before is deleted. So a batch costs what it touches, plus its
share of a base now and then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import children, delete_path, stage

# Written last, so a table set with it is whole.
_MAIN = "traces"

STATE_SCHEMAS = {
    "packets": "seq bigint, t int, delta bigint, arrived bigint, drained bigint, "
    "first struct<seq: bigint, t: int>",
    "slots": "slot int, seq bigint, waiting int, tx int",
    "repeats": "slot int, seq bigint",
    _MAIN: "t int, level bigint, arrived bigint, drained bigint, seq bigint",
}

# Folders by a hash of the trace: a batch opens only those of its traces.
SHARDS = 16

# Batches between two bases.
COMPACT_EVERY = 32


class TraceState:
    """The log below ``root``; ``keys`` are the string columns that name a trace."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str] = ("trace_id",),
        compact_every: int = COMPACT_EVERY,
    ):
        self._spark, self._root, self._keys = spark, root, list(keys)
        self._compact_every = compact_every

    def _shard(self):
        return F.pmod(F.xxhash64(*self._keys), F.lit(SHARDS)).cast("int")

    def _numbers(self, kind: str) -> list[int]:
        """Batches with a whole table set of that kind."""
        found = []
        for name in children(self._spark, f"{self._root}/{_MAIN}"):
            folder = f"{self._root}/{_MAIN}/{name}"
            if name.startswith(f"run={kind}-") and "_SUCCESS" in children(self._spark, folder):
                found.append(int(name.rsplit("-", 1)[1]))
        return sorted(found)

    def _runs(self, batch_id: int) -> list[str]:
        """The newest base before a batch and the changes since."""
        bases = [b for b in self._numbers("base") if b < batch_id]
        since = bases[-1] if bases else -1
        changes = [b for b in self._numbers("delta") if since < b < batch_id]
        return [f"base-{b}" for b in bases[-1:]] + [f"delta-{b}" for b in changes]

    def _table(self, name: str, runs: list[str]) -> DataFrame:
        schema = ", ".join(f"{k} string" for k in self._keys)
        schema += f", {STATE_SCHEMAS[name]}, version bigint, run string, shard int"
        folder = f"{self._root}/{name}"
        reader = self._spark.read.schema(schema).option("basePath", folder)
        return reader.parquet(*[f"{folder}/run={run}" for run in runs]).drop("run")

    def _newest(self, runs: list[str], limit) -> dict[str, DataFrame]:
        """The newest entry of each trace that ``limit`` lets through, with its shard.

        The main table's are stored: every other table is joined to them.
        """
        main = limit(self._table(_MAIN, runs))
        columns = [c for c in main.columns if c not in (*self._keys, "version", "shard")]
        newest = main.groupBy(*self._keys, "shard").agg(
            F.max_by(F.struct(*columns), "version").alias("last"), F.max("version").alias("version")
        )
        newest = stage(newest.select(*self._keys, "shard", "last.*", "version"), "newest")
        marks = newest.select(*self._keys, "shard", "version")
        state = {
            name: self._table(name, runs).join(marks, [*self._keys, "shard", "version"])
            for name in STATE_SCHEMAS
            if name != _MAIN
        }
        return {**state, _MAIN: newest}

    def read(self, batch_id: int, touched: DataFrame) -> dict[str, DataFrame] | None:
        """State before a batch, of the traces in ``touched`` (their keys, each once)."""
        runs = self._runs(batch_id)
        if not runs:
            return None
        named = touched.select(*self._keys, self._shard().alias("shard"))
        shards = [row.shard for row in named.select("shard").distinct().collect()]

        def limit(table: DataFrame) -> DataFrame:
            kept = table.filter(F.col("shard").isin(shards))
            return kept.join(named, [*self._keys, "shard"], "left_semi")

        return {n: t.drop("shard", "version") for n, t in self._newest(runs, limit).items()}

    def write(self, batch_id: int, tables: dict[str, DataFrame]) -> None:
        """State after a batch, of the traces it touched."""
        version = F.lit(batch_id).cast("bigint")
        stamped = {
            name: table.withColumns({"version": version, "shard": self._shard()})
            for name, table in tables.items()
        }
        self._write(f"delta-{batch_id}", stamped)

    def _write(self, run: str, tables: dict[str, DataFrame]) -> None:
        for name, schema in STATE_SCHEMAS.items():
            columns = [f.strip().split()[0] for f in schema.split("struct")[0].split(",") if f.strip()]
            rows = tables[name].select(*self._keys, *columns, "version", "shard")
            writer = rows.repartition("shard").write.mode("overwrite").partitionBy("shard")
            writer.parquet(f"{self._root}/{name}/run={run}")

    def compact(self, batch_id: int) -> None:
        """Before a batch: put the log into one base, if it has grown long.

        Runs before the base are deleted once it is whole; the batch itself, also
        when it is run again, reads from the base.
        """
        runs = self._runs(batch_id)
        changes = [int(r.split("-")[1]) for r in runs if r.startswith("delta-")]
        if len(changes) >= self._compact_every:
            self._write(f"base-{changes[-1]}", self._newest(runs, lambda table: table))
        self._drop_before(batch_id)

    def _drop_before(self, batch_id: int) -> None:
        bases = [b for b in self._numbers("base") if b < batch_id]
        if not bases:
            return
        for name in STATE_SCHEMAS:
            for run in children(self._spark, f"{self._root}/{name}"):
                kind, _, number = run.removeprefix("run=").partition("-")
                old = int(number) < bases[-1] or (kind == "delta" and int(number) == bases[-1])
                if old:
                    delete_path(self._spark, f"{self._root}/{name}/{run}")
