"""Versioned parquet tables on a shared file system.

No table format with transactions is on the classpath, so a version is a small manifest that lists
the parquet directories belonging to it. Data directories are never changed once written: readers
of an older version are safe, a lost executor only repeats its tasks, and a failed load leaves
nothing visible. Committing is the creation of the manifest, which fails if it already exists; that
needs a file system with exclusive create. On an object store without it, let one writer at a time
change a table.

A merge rewrites only the partitions that hold a changed key, not the table. A table without a natural
partition is stored in buckets of its key, so that the buckets of the changed keys are known without a scan.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.functions.dates import moment_text
from storelake.sources.types import align_to_schema, synced_schema

_LOAD = "load_id"
_BUCKET = "key_bucket"
_CODEC = "zstd"  # Ids and amounts hardly repeat, so a codec with entropy coding saves a good part of what is written.
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``."""
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/storelake/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="storelake-")
    return _local_roots[app]


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row; rows with a NULL key have none. Counts keys only, by hash."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter("_n > 1").select(*keys)


def any_repeated(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether ``repeated_keys`` has a row.

    Text keys are counted by their 64-bit hash, which moves a fraction of their bytes. Equal keys have equal hashes, so
    without a repeated hash no key repeats; else the keys themselves decide.
    """
    if any(isinstance(df.schema[k].dataType, T.StringType) for k in keys) and all(
            isinstance(df.schema[k].dataType, (T.IntegralType, T.StringType)) for k in keys):
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        hashes = df.filter(known).select(F.xxhash64(*keys).alias("_hash"))
        if repeated_keys(hashes, ["_hash"]).isEmpty():
            return False
    return not repeated_keys(df, keys).isEmpty()


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: str | None, repeated: DataFrame | None = None) -> DataFrame:
    """One row per key, the newest, and every row with a NULL key.

    Whole rows are compared for the ``repeated`` keys alone, all others pass. The comparison combines
    map-side, so a much repeated key does not pile up.
    """
    repeated = repeated_keys(df, keys) if repeated is None else repeated
    row = F.struct(*df.columns)
    rank = F.struct(F.col(order_by), row) if order_by in df.columns else row
    several = df.join(repeated, list(keys), "left_semi").select(*df.columns)
    newest = several.groupBy(*keys).agg(F.max_by(row, rank).alias("row")).select("row.*")
    return df.join(repeated, list(keys), "left_anti").select(*df.columns).unionByName(newest)


def _bucket(spread: dict) -> Column:
    return F.pmod(F.xxhash64(*spread["keys"]), F.lit(spread["n"])).alias(_BUCKET)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._frames: dict[tuple[str, int | None], DataFrame] = {}
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- versions -----------------------------------------------------------------------------

    def versions(self, name: str) -> list[int]:
        return sorted(int(f.split(".")[0]) for f in self._names(f"{self._home(name)}/versions")
                      if f.endswith(".json"))

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def manifest(self, name: str, version: int | None = None) -> dict:
        known = self.versions(name)
        wanted = version if version is not None else (known[-1] if known else None)
        if wanted not in known:
            raise KeyError(f"no version {version} of table {name}")
        stream = self._fs.open(self._path(self._version_file(name, wanted)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def schema(self, name: str, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self.manifest(name, version)["schema"])

    def list_tables(self, layer: str = "") -> list[str]:
        base = f"{self.root}/{layer}".rstrip("/")
        found = []
        for child in self._names(base):
            name = f"{layer}/{child}".lstrip("/")
            found += [name] if self.exists(name) else self.list_tables(name) if not layer else []
        return sorted(found)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table as of a version, the newest by default. Versions never change, so each is listed once."""
        if version is None:
            known = self.versions(name)
            version = known[-1] if known else None
        if (name, version) not in self._frames:
            self._frames[name, version] = self._scan(name, self.manifest(name, version))
        return self._frames[name, version]

    # --- write modes --------------------------------------------------------------------------

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] = (),
               on_schema_change: str = "align") -> int:
        if not self.exists(name):
            return self.replace(df, name, partition_by)
        current = self.manifest(name)
        stored, rewritten = self._target(current, df, on_schema_change, ())
        fitted, dirs = align_to_schema(df, stored, "sync" if on_schema_change == "sync_all" else on_schema_change), current["dirs"]
        if rewritten:
            fitted, dirs = align_to_schema(self._scan(name, current), stored).unionByName(fitted), []
        return self._commit(fitted, name, current["partition_by"], dirs, [], current.get("buckets"))

    def replace(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (),
                order_by: str | None = None, buckets: int = 0) -> int:
        """The whole load becomes the table; the first load creates it.

        With ``keys`` the newest row per key stays. The rows are written as they come, then their keys are
        counted; only if a key repeats is the written load read again without its older rows. ``buckets``
        stores the table by that many buckets of its keys.
        """
        parts, spread = list(partition_by), {"keys": list(keys), "n": buckets} if keys and buckets else None
        dirs = self._write(df, name, parts, spread)
        if keys:
            held = self._scan(name, {"schema": df.schema.jsonValue(), "dirs": dirs})
            if any_repeated(held, keys):
                first, dirs = dirs, self._write(latest_by_key(held, keys, order_by), name, parts, spread)
                for folder in {d.split("/")[0] for d in first}:
                    self._fs.delete(self._path(f"{self._home(name)}/data/{folder}"), True)
        return self._publish(df, name, parts, dirs, [], spread)

    def skip(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> int | None:
        return None if self.exists(name) else self.replace(df, name, partition_by)

    def merge(self, df: DataFrame, name: str, keys: Sequence[str] = ("id",),
              order_by: str | None = "updatedAt", partition_by: Sequence[str] = (),
              on_schema_change: str = "align", buckets: int = 0) -> int:
        """Upsert: of a key's rows in the batch and the table the newest stays, of equally old ones the batch's.

        So batches may come in any order. A row without a time is older than any with one; without
        ``order_by`` the batch always wins. Rows with a NULL key match nothing and are appended, as is a batch
        without the key columns. ``partition_by`` and ``buckets`` say how a new table is stored.
        """
        keys = list(keys)
        if not keys or not set(keys) <= set(df.columns):
            return self.append(df, name, partition_by, on_schema_change)
        if not self.exists(name):
            return self.replace(df, name, partition_by, keys, order_by, buckets)

        current = self.manifest(name)
        stored, rewritten = self._target(current, df, on_schema_change, keys)
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        batch, path = self._written(
            align_to_schema(df, stored, "sync" if on_schema_change == "sync_all" else on_schema_change), name)
        paths = [path]
        if any_repeated(batch, keys):
            batch, path = self._written(latest_by_key(batch, keys, order_by), name)
            paths.append(path)
        if set(batch.columns) <= set(T.StructType.fromJson(current["schema"]).names) and not rewritten and batch.isEmpty():
            return self.versions(name)[-1]
        parts, dirs = current["partition_by"], current["dirs"]
        changed = batch.filter(known).select(*keys)
        touched = set(dirs) if rewritten else self._touched(name, current, changed, keys)
        if touched:
            scope = align_to_schema(self._scan(name, {**current, "dirs": [d for d in dirs if d in touched]}), stored)
            if order_by in stored.names and order_by in batch.columns:
                times = scope.join(changed, keys, "left_semi").groupBy(*keys).agg(F.max(order_by).alias("_stored"))
                newer = F.col("_stored").isNull() | F.coalesce(F.col(order_by) >= F.col("_stored"), F.lit(False))
                batch = batch.join(times, keys, "left").filter(newer).select(*batch.columns)
                changed = batch.filter(known).select(*keys)
            batch = scope.join(changed, keys, "left_anti").unionByName(batch, allowMissingColumns=True)
            batch = batch.select(*[c for c in stored.names], *[c for c in batch.columns if c not in stored.names])
        kept = [d for d in dirs if d not in touched]
        return self._commit(batch, name, parts, kept, paths, current.get("buckets"))

    def high_water(self, name: str, column: str) -> str | None:
        """Largest stored time of a column as text, None for an empty or missing table."""
        if not self.exists(name):
            return None
        stored = self.read(name)
        return stored.agg(moment_text(F.max(column), stored.schema[column].dataType)).first()[0]

    def drop(self, name: str) -> list[str]:
        """Delete what the manifests of a table list, and nothing else."""
        home, versions = self._home(name), self.versions(name)
        bodies = [self.manifest(name, v) for v in versions]
        listed = {f"data/{d}" for b in bodies for d in b["dirs"]} | {p for b in bodies for p in b["batches"]}
        gone = sorted(f"{home}/{p}" for p in listed) + [self._version_file(name, v) for v in versions]
        for version in versions:
            self._frames.pop((name, version), None)
        for path in gone:
            self._fs.delete(self._path(path), True)
        return gone

    def drop_layer(self, layer: str) -> list[str]:
        return [path for name in self.list_tables(layer) for path in self.drop(name)]

    # --- internals ----------------------------------------------------------------------------

    def _home(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _version_file(self, name: str, version: int) -> str:
        return f"{self._home(name)}/versions/{version:08d}.json"

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def _scan(self, name: str, manifest: dict) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        if not manifest["dirs"]:
            return self.spark.createDataFrame([], schema)
        base = f"{self._home(name)}/data"
        reader = self.spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{d}" for d in manifest["dirs"]]).select(*schema.names)

    def _touched(self, name: str, current: dict, changed: DataFrame, keys: list[str]) -> set[str]:
        """Stored directories that hold a changed key.

        Those of a bucketed table follow from the keys. Else only the key columns are read, and of those only
        the row groups within the range of the changed keys: the range is resolved first, so that it reaches
        the scan. Keys meet by their hash, which moves less than texts do; should two keys share one, a directory
        too many is written anew with the same rows. A table without partitions counts as one.
        """
        spread = current.get("buckets")
        if spread and spread["keys"] == keys:
            hit = {f"{_BUCKET}={r[0]}" for r in changed.select(_bucket(spread)).distinct().collect()}  # At most all buckets.
            return {d for d in current["dirs"] if d.split("/")[-1] in hit}
        if not spread and not current["partition_by"]:
            return set(current["dirs"])
        held = self._scan(name, current)
        ranged = [k for k in keys if isinstance(held.schema[k].dataType, (T.IntegralType, T.StringType))]
        if ranged:
            ends = changed.agg(*[f(k) for k in ranged for f in (F.min, F.max)]).first()
            if ends[0] is None:
                return set()
            for i, k in enumerate(ranged):
                held = held.filter(F.col(k).between(F.lit(ends[2 * i]), F.lit(ends[2 * i + 1])))
        folder = F.regexp_extract(F.input_file_name(), f"({_LOAD}=.*)/[^/]+$", 1)
        mark = F.xxhash64(*[F.col(k).cast(held.schema[k].dataType) for k in keys]).alias("_hash")
        hit = held.select(mark, folder.alias("dir")).join(changed.select(mark), "_hash", "left_semi")
        # One row per directory, and the manifest on the driver already lists them all.
        urls = hit.select("dir").distinct().collect()
        found = {self._jvm.java.net.URI.create(r["dir"].replace(" ", "%20")).getPath() for r in urls}
        return {d for d in current["dirs"] if d in found}

    def _written(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        """The batch as a written table, since the merge reads it several times."""
        folder = f"batches/{uuid.uuid4().hex}"
        df.write.parquet(f"{self._home(name)}/{folder}", compression=_CODEC)
        return self.spark.read.schema(df.schema).parquet(f"{self._home(name)}/{folder}"), folder

    def _target(self, current: dict, df: DataFrame, mode: str, keys: Sequence[str]) -> tuple[T.StructType, bool]:
        """The schema of a table after a batch, without what ``sync`` adds, and whether its rows are written anew."""
        stored = T.StructType.fromJson(current["schema"])
        if mode != "sync_all":
            return stored, False
        return synced_schema(stored, df.schema, [*keys, *current["partition_by"]])

    def _write(self, df: DataFrame, name: str, parts: list[str], spread: dict | None) -> list[str]:
        """A load as Parquet below the table, not yet part of it; returns its directories."""
        load = f"{_LOAD}=v{uuid.uuid4().hex}"
        target = f"{self._home(name)}/data/{load}"
        if spread:
            df, parts = df.withColumn(_BUCKET, _bucket(spread)), [_BUCKET, *parts]
        if not parts:
            df.write.parquet(target, compression=_CODEC)
            return [load]
        # Rebalancing gives each partition files of the advisory size and splits a hot partition.
        df.hint("rebalance", *parts).write.partitionBy(*parts).parquet(target, compression=_CODEC)
        return [f"{load}/{d}" for d in self._names(target) if "=" in d]

    def _publish(self, df: DataFrame, name: str, parts: list[str], dirs: list[str], batches: list[str],
                 spread: dict | None) -> int:
        known = self.versions(name)
        version = known[-1] + 1 if known else 1
        body = {"schema": df.schema.jsonValue(), "partition_by": parts, "dirs": dirs, "batches": batches, "buckets": spread}
        out = self._fs.create(self._path(self._version_file(name, version)), False)
        try:
            out.write(bytearray(json.dumps(body), "utf-8"))
        finally:
            out.close()
        return version

    def _commit(self, df: DataFrame, name: str, parts: list[str], keep: list[str], batches: list[str],
                spread: dict | None) -> int:
        return self._publish(df, name, parts, keep + self._write(df, name, parts, spread), batches, spread)
