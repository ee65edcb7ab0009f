"""Tables that change atomically: versioned folders and one pointer switch.

A commit writes only the partitions it changes, each into a folder of the new
version, and then one small version file that lists, for every partition of the
table, the folder that holds it, with the table's schema. The file is the
pointer: before it exists a reader sees the old version whole, after it the new
one whole, whatever fails in between. Old folders stay until :meth:`vacuum`, so
running readers and the commit itself never lose the files they read, and no
result has to be checkpointed before the write.

The schema is stored, so partition types are not guessed ("01" stays a string).
The version file is renamed into place, never overwritten: of two writers that read
the same version one fails (``ConflictError``) and may retry. A commit may carry the id of a
stream's micro-batch; a replayed batch is then known and left out.

The list of partitions passes through the driver, as it does for any table with a
catalogue; rows never do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardpulse.operators.sinks import (_folder, _in_partitions, _touched, dedup_first, dedup_last, duplicate_keys,
                                       replace_where, upsert)


class ConflictError(RuntimeError):
    """Another writer committed the version that this one was about to."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ files
    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _version_file(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.path}/versions") if n.endswith(".json") and n[:-5].isdigit()]

    def _load(self, version: int) -> dict:
        fs, p = self._fs(self._version_file(version))
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self, version: int | None = None) -> dict | None:
        """The newest (or a given) version's contents, None if there is no table yet."""
        if version is None:
            version = max(self.versions(), default=None)
        return None if version is None else self._load(version)

    def exists(self) -> bool:
        return self.state() is not None

    # ------------------------------------------------------------ reading
    def read(self, version: int | None = None) -> DataFrame:
        state = self.state(version)
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._frame(state)

    def _frame(self, state: dict, folders: Mapping[str, str] | None = None) -> DataFrame:
        schema = StructType.fromJson(state["schema"])
        folders = state["folders"] if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/data"
        paths = sorted(f"{base}/_v={v}/{f}".rstrip("/") for f, v in folders.items())
        stored = StructType([*schema.fields]).add("_v", "string")
        rows = self.spark.read.schema(stored).option("basePath", base).parquet(*paths)
        return rows.select(*schema.names)

    # ------------------------------------------------------------ writing
    def _partitions(self, version: str, depth: int) -> list[str]:
        """The partition folders written for a version."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{n}" if f else n for f in found
                     for n in self._names(f"{self.path}/data/_v={version}/{f}") if "=" in n]
        return found

    def _stage(self, rows: DataFrame, partition_by: Sequence[str], version: int) -> dict[str, str]:
        """Write the rows of a commit; nobody sees them yet."""
        name = f"{version:012d}-{uuid.uuid4().hex[:8]}"
        writer = rows.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/data/_v={name}")
        return dict.fromkeys(self._partitions(name, len(partition_by)), name)

    def _switch(self, state: dict) -> None:
        """Give the version file its name: the one step that makes a commit visible.
        It is written under another name first, so it is never seen half written."""
        fs, p = self._fs(self._version_file(state["version"]))
        _, draft = self._fs(f"{self.path}/versions/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        if fs.exists(p) or not fs.rename(draft, p):
            fs.delete(draft, False)
            raise ConflictError(f"version {state['version']} of {self.path} is there already")

    def _commit(self, old: dict | None, rows: DataFrame, gone: Sequence[str], schema: StructType,
                partition_by: Sequence[str], batch: tuple[str, int] | None) -> int:
        """Write ``rows`` and switch; ``gone`` are the folders they replace."""
        version = (old["version"] if old else 0) + 1
        written = self._stage(rows.select(*schema.names), partition_by, version)
        folders = {f: v for f, v in (old["folders"] if old else {}).items() if f not in set(gone)}
        batches = dict(old["batches"]) if old else {}
        if batch:
            batches[batch[0]] = batch[1]
        self._switch({"version": version, "schema": json.loads(schema.json()), "partition_by": list(partition_by),
                      "folders": folders | written, "batches": batches})
        return version

    def _done(self, state: dict | None, batch: tuple[str, int] | None) -> bool:
        return bool(state and batch and state["batches"].get(batch[0], -1) >= batch[1])

    def _folders_of(self, touched: DataFrame, partition_by: Sequence[str]) -> list[str]:
        rows = touched.select(*[F.col(c).cast("string").alias(c) for c in partition_by]).collect()
        return ["/".join(_folder(c, r[c]) for c in partition_by) for r in rows]

    def _rewrite(self, state: dict, touched: DataFrame, make, batch: tuple[str, int] | None) -> int:
        """Commit ``make(old rows of the touched partitions)`` in their place."""
        by = state["partition_by"]
        schema = StructType.fromJson(state["schema"])
        gone = self._folders_of(touched, by)
        held = {f: v for f, v in state["folders"].items() if f in set(gone)}
        target = _in_partitions(self._frame(state, held), touched, by)
        return self._commit(state, make(target), gone, schema, by, batch)

    def rebuild(self, rows: DataFrame, partition_by: Sequence[str] = (), batch: tuple[str, int] | None = None) -> int:
        """SNK-5: the table holds these rows and nothing else."""
        old = self.state()
        if self._done(old, batch):
            return old["version"]
        return self._commit(old, rows, list(old["folders"]) if old else [], rows.schema, partition_by, batch)

    def upsert(self, rows: DataFrame, keys: Sequence[str], update: Sequence[str], partition_by: Sequence[str],
               order: Sequence[str] | None = None, set_exprs: Mapping[str, Column] | None = None,
               batch: tuple[str, int] | None = None) -> int:
        """SNK-2 / SNK-8, as :func:`wardpulse.operators.sinks.upsert`."""
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the upsert key")
        if not order and not duplicate_keys(rows, keys).isEmpty():
            raise ValueError("batch holds duplicate keys and no order column")
        old = self.state()
        if self._done(old, batch):
            return old["version"]
        if old is None:
            first = upsert(rows.limit(0), rows, keys, update, order, set_exprs)
            return self._commit(None, first, [], first.schema, partition_by, batch)
        rows = rows.select(*StructType.fromJson(old["schema"]).names)
        return self._rewrite(old, _touched(rows, old["partition_by"]),
                             lambda target: upsert(target, rows, keys, update, order, set_exprs), batch)

    def insert_ignore(self, rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
                      order: Sequence[str] | None = None, batch: tuple[str, int] | None = None) -> int:
        """SNK-3: rows whose key is there already are left out."""
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the key")
        old = self.state()
        if self._done(old, batch):
            return old["version"]
        if order:
            rows = dedup_first(rows, keys, order)
        if old is None:
            return self._commit(None, rows, [], rows.schema, partition_by, batch)
        rows = rows.select(*StructType.fromJson(old["schema"]).names)
        return self._rewrite(old, _touched(rows, old["partition_by"]), lambda target: target.unionByName(
            rows.join(target.select(*keys), list(keys), "left_anti")), batch)

    def replace_where(self, rows: DataFrame, predicate: Column, partition_by: Sequence[str],
                      batch: tuple[str, int] | None = None) -> int:
        """SNK-4: rows that meet the predicate go, the batch comes."""
        old = self.state()
        if self._done(old, batch):
            return old["version"]
        if old is None:
            return self._commit(None, rows, [], rows.schema, partition_by, batch)
        rows = rows.select(*StructType.fromJson(old["schema"]).names)
        by = old["partition_by"]
        hit = self._frame(old).where(F.coalesce(predicate, F.lit(False))).select(*by)
        return self._rewrite(old, _touched(hit.unionByName(rows.select(*by)), by),
                             lambda target: replace_where(target, rows, predicate), batch)

    def replace_keys(self, rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
                     batch: tuple[str, int] | None = None) -> int:
        """SNK-4 by value: rows that share the ``keys`` of any batch row go, the batch
        comes. An empty batch changes nothing. Partition columns are among the keys."""
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the replaced key")
        old = self.state()
        if self._done(old, batch) or rows.isEmpty():
            return old["version"] if old else 0
        if old is None:
            return self._commit(None, rows, [], rows.schema, partition_by, batch)
        rows = rows.select(*StructType.fromJson(old["schema"]).names)
        names = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()

        def make(target: DataFrame) -> DataFrame:
            same = [target[k].eqNullSafe(names[f"_k{i}"]) for i, k in enumerate(keys)]
            return target.join(names, same, "left_anti").unionByName(rows)

        return self._rewrite(old, _touched(rows, old["partition_by"]), make, batch)

    def append(self, rows: DataFrame, partition_by: Sequence[str] = (), batch: tuple[str, int] | None = None) -> int:
        """SNK-1: an empty batch is a no-op. The touched partitions take the new rows."""
        old = self.state()
        if self._done(old, batch) or rows.isEmpty():
            return old["version"] if old else 0
        if old is None:
            return self._commit(None, rows, [], rows.schema, partition_by, batch)
        rows = rows.select(*StructType.fromJson(old["schema"]).names)
        if not old["partition_by"]:
            return self._commit(old, self._frame(old).unionByName(rows), list(old["folders"]), rows.schema, [], batch)
        return self._rewrite(old, _touched(rows, old["partition_by"]), lambda target: target.unionByName(rows), batch)

    def upsert_newest(self, rows: DataFrame, keys: Sequence[str], update: Sequence[str], partition_by: Sequence[str],
                      order: Sequence[str], batch: tuple[str, int] | None = None) -> int:
        """Upsert after keeping the newest batch row of each key."""
        return self.upsert(dedup_last(rows, keys, order), keys, update, partition_by, order, None, batch)

    def vacuum(self, keep: int = 1) -> None:
        """Drop versions but the newest ``keep``, and the folders only they name,
        leftovers of failed commits included. Only safe while nobody writes."""
        versions = self.versions()
        alive = [self._load(n) for n in versions[-keep:]]
        named = {(v, f) for s in alive for f, v in s["folders"].items()}
        used = {v for v, _ in named}
        for n in versions[:-keep]:
            fs, p = self._fs(self._version_file(n))
            fs.delete(p, False)
        for name in self._names(f"{self.path}/data"):
            version = name.partition("=")[2]
            if version not in used:
                fs, p = self._fs(f"{self.path}/data/{name}")
                fs.delete(p, True)
                continue
            depth = len(alive[-1]["partition_by"])
            for folder in self._partitions(version, depth) if depth else []:
                if (version, folder) not in named:
                    fs, p = self._fs(f"{self.path}/data/{name}/{folder}")
                    fs.delete(p, True)
