"""A Parquet table that changes by whole commits.

Data folders are written by Spark under names of their own; the table is what
its newest manifest lists.  A commit writes the next manifest, a small JSON file
that must not exist before, so

* a run that dies before its commit leaves folders that nobody reads, and is
  simply repeated;
* a run (or stream batch) that was committed is known by name and number, and
  repeating it changes nothing;
* a reader sees one whole version, whatever is being written;
* of two writers one fails (``CommitConflict``) and may try again.

``append`` adds rows, ``append_unseen`` only rows whose key no earlier run has
brought, ``merge`` replaces rows by key.  The last two hold keys or rows in a
fixed number of hash buckets and read only those that a run touches.  Folders
that a run adds are merged in tiers, ``fan`` of one tier into one of the next,
so their number grows with the logarithm of the runs and every row is rewritten
as often at most.

The driver holds the manifest: a line per folder, i.e. buckets times tiers, and
the names of batch runs.  Files are listed, read and written through Hadoop's
file systems only, so the table may lie wherever Spark reads and writes.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("__k1", "__k2")
BUCKET = "__bucket"


class CommitConflict(RuntimeError):
    """Another writer made the next version first."""


def key_hashes(columns: Sequence[str]):
    """128 bits of the key columns; NULL is a value of its own, and neither the
    order of NULLs nor the session's zone plays a part."""
    cols = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return {k: F.xxhash64(F.lit(i), *cols) for i, k in enumerate(KEYS)}


class ManifestTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, fan: int = 8, keep: int = 2):
        """``buckets`` holds for a new table; an existing one keeps its own.
        Folders that a commit replaces stay for ``keep`` more commits, for
        readers of the version before."""
        self.spark, self.path, self.fan, self.keep = spark, path.rstrip("/"), fan, keep
        self.buckets = self._load()["buckets"] or buckets

    # ------------------------------------------------------------ manifests

    def _fs(self, name: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _names(self, folder: str) -> list[str]:
        fs, where = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._names("_manifest") if n.endswith(".json"))

    def _load(self) -> dict:
        for version in reversed(self._versions()):
            fs, where = self._fs(f"_manifest/{version:012d}.json")
            stream = fs.open(where)
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("}\n"):        # a writer that died left part of a file: the version before counts
                return json.loads(text)
        return {"version": 0, "buckets": None, "schemas": {}, "parts": [], "runs": {}, "gone": []}

    def _commit(self, old: dict, schemas: dict, add: list[dict], drop: list[dict], run: tuple[str, int] | None) -> None:
        versions = self._versions()
        version = max([old["version"], *versions]) + 1
        if any(v > old["version"] for v in versions) and self._load()["version"] > old["version"]:
            raise CommitConflict(f"{self.path}: version {version - 1} was made meanwhile")
        lost = {p["folder"] for p in drop}
        gone = old["gone"] + [{"folder": f, "at": version} for f in lost]
        new = {"version": version, "buckets": self.buckets, "schemas": old["schemas"] | schemas,
               "parts": [p for p in old["parts"] if p["folder"] not in lost] + add,
               "runs": old["runs"] | ({run[0]: run[1]} if run else {}),
               "gone": [g for g in gone if g["at"] > version - self.keep]}
        fs, where = self._fs(f"_manifest/{version:012d}.json")
        try:
            stream = fs.create(where, False)
        except Exception as e:
            raise CommitConflict(f"{self.path}: version {version} exists") from e
        stream.write(bytearray((json.dumps(new) + "\n").encode()))
        stream.close()
        for g in gone:
            if g["at"] <= version - self.keep:
                self._delete(g["folder"])
        for v in versions[:-self.keep - 1]:
            self._delete(f"_manifest/{v:012d}.json")

    def _delete(self, name: str) -> None:
        fs, where = self._fs(name)
        fs.delete(where, True)

    def _write(self, df: DataFrame, kind: str, by_bucket: bool, level: int = 0) -> list[dict]:
        folder = f"data/{uuid.uuid4().hex}"
        try:
            if not by_bucket:
                df.write.parquet(f"{self.path}/{folder}")
                return [{"kind": kind, "folder": folder, "bucket": None, "level": level}]
            df.write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        except Exception:
            self._delete(folder)
            raise
        names = [n for n in self._names(folder) if n.startswith(f"{BUCKET}=")]
        return [{"kind": kind, "folder": f"{folder}/{n}", "bucket": int(n.split("=")[1]), "level": level} for n in names]

    # -------------------------------------------------------------- reading

    def done(self, name: str, number: int = 0) -> bool:
        """Whether this run, or a later one of that name, is committed."""
        return self._load()["runs"].get(name, -1) >= number

    def folders(self, kind: str = "rows") -> int:
        return sum(p["kind"] == kind for p in self._load()["parts"])

    def _read(self, manifest: dict, kind: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
        if kind not in manifest["schemas"]:
            return None
        schema = T.StructType.fromJson(manifest["schemas"][kind])
        parts = [p for p in manifest["parts"] if p["kind"] == kind and (buckets is None or p["bucket"] in set(buckets))]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p['folder']}" for p in parts])

    def read(self, kind: str = "rows") -> DataFrame:
        """The rows of the newest version."""
        found = self._read(self._load(), kind)
        if found is None:
            raise FileNotFoundError(f"no committed rows under {self.path}")
        return found.drop(*KEYS)

    # -------------------------------------------------------------- writing

    def _schema(self, manifest: dict, kind: str, df: DataFrame) -> dict:
        """The kind's schema; rows must have the columns and types it began with."""
        plain = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name != BUCKET])
        known = manifest["schemas"].get(kind)
        if not known:
            return {kind: json.loads(plain.json())}
        have, got = (sorted((f.name, f.dataType.simpleString()) for f in s.fields) for s in (T.StructType.fromJson(known), plain))
        if have != got:     # by name: the order may differ
            raise ValueError(f"{self.path} holds {have}, not {got}")
        return {kind: known}

    def append(self, df: DataFrame, run: str | None = None, number: int = 0) -> bool:
        """Add ``df``'s rows; False (and no change) if the run is committed."""
        manifest = self._load()
        if run is not None and manifest["runs"].get(run, -1) >= number:
            return False
        schemas = self._schema(manifest, "rows", df)
        self._commit(manifest, schemas, self._write(df, "rows", False), [], (run, number) if run is not None else None)
        self._merge_tiers()
        return True

    def _touched(self, df: DataFrame) -> list[int]:
        return [r[0] for r in df.select(BUCKET).distinct().collect()]       # at most ``buckets`` rows

    def append_unseen(self, df: DataFrame, keys: Sequence[str], run: str | None = None, number: int = 0,
                      transform: Callable[[DataFrame], DataFrame] | None = None) -> bool:
        """Add the rows whose ``keys`` no committed run has added, one row a
        key.  ``transform`` (for example a model) sees only these; it must keep
        the working columns.  Rows that it drops count as unseen."""
        manifest = self._load()
        if run is not None and manifest["runs"].get(run, -1) >= number:
            return False
        named = df.withColumns(key_hashes(keys))
        bucket = F.pmod(F.col(KEYS[0]), F.lit(self.buckets)).cast("int")
        # copies of a key meet before the shuffle, and before they meet the index
        new = named.dropDuplicates(list(KEYS))
        seen = self._read(manifest, "keys", self._touched(named.select(bucket.alias(BUCKET))))
        if seen is not None:
            new = new.join(seen, list(KEYS), "left_anti")
        new = transform(new) if transform else new
        schemas = self._schema(manifest, "rows", new)
        rows = self._write(new, "rows", False)
        added = self.spark.read.schema(new.schema).parquet(f"{self.path}/{rows[0]['folder']}").select(*KEYS, bucket.alias(BUCKET))
        schemas |= self._schema(manifest, "keys", added)
        parts = rows + self._write(added.repartition(BUCKET), "keys", True)
        self._commit(manifest, schemas, parts, [], (run, number) if run is not None else None)
        self._merge_tiers()
        return True

    def merge(self, df: DataFrame, keys: Sequence[str], run: str | None = None, number: int = 0) -> bool:
        """Replace the rows that have a key of ``df`` by ``df``'s (one row a
        key), and add the others; only buckets with such keys are rewritten."""
        manifest = self._load()
        if run is not None and manifest["runs"].get(run, -1) >= number:
            return False
        df = df.withColumns(key_hashes(keys))
        schemas = self._schema(manifest, "rows", df)
        bucket = F.pmod(F.col(KEYS[0]), F.lit(self.buckets)).cast("int")
        changed = df.withColumn(BUCKET, bucket)
        # evaluated once: a stream's batch may be costly, and its rows must be the same in both uses
        fresh = self._write(changed, "rows", True)
        touched = [p["bucket"] for p in fresh]
        old = [p for p in manifest["parts"] if p["kind"] == "rows" and p["bucket"] in set(touched)]
        if old:
            plain = T.StructType.fromJson(schemas["rows"])
            now = self.spark.read.schema(plain).parquet(*[f"{self.path}/{p['folder']}" for p in fresh])
            rest = self._read(manifest, "rows", touched).join(now.select(*KEYS), list(KEYS), "left_anti")
            whole = now.unionByName(rest).withColumn(BUCKET, bucket)
            parts = self._write(whole.repartition(BUCKET), "rows", True)
            for p in fresh:
                self._delete(p["folder"])
            fresh = parts
        self._commit(manifest, schemas, fresh, old, (run, number) if run is not None else None)
        return True

    def _merge_tiers(self) -> None:
        """Merge ``fan`` folders of a tier (and bucket) into one of the next."""
        while True:
            manifest = self._load()
            tiers: dict[tuple, list[dict]] = {}
            for p in manifest["parts"]:
                tiers.setdefault((p["kind"], p["level"], p["bucket"]), []).append(p)
            full = [(k, v) for k, v in tiers.items() if len(v) >= self.fan]
            if not full:
                return
            kind, level, _ = min(k[:2] + (0,) for k, _ in full)
            old = [p for (k, lv, _), v in full if (k, lv) == (kind, level) for p in v]
            df = self.spark.read.schema(T.StructType.fromJson(manifest["schemas"][kind])).parquet(
                *[f"{self.path}/{p['folder']}" for p in old])
            if kind == "keys":
                df = df.withColumn(BUCKET, F.pmod(F.col(KEYS[0]), F.lit(self.buckets)).cast("int")).repartition(BUCKET)
            # rows need no shuffle: a scan task takes several small files and writes one
            self._commit(manifest, {}, self._write(df, kind, kind == "keys", level + 1), old, None)

    def vacuum(self, older_than_seconds: float = 86_400.0) -> int:
        """Delete folders that no kept manifest knows (of runs that died), if
        they are old enough not to belong to a running writer."""
        manifest = self._load()
        known = {p["folder"].split("/")[1] for p in manifest["parts"]} | {g["folder"].split("/")[1] for g in manifest["gone"]}
        fs, where = self._fs("data")
        gone = 0
        for s in fs.listStatus(where) if fs.exists(where) else []:
            name = s.getPath().getName()
            if name not in known and s.getModificationTime() / 1000 < time.time() - older_than_seconds:
                self._delete(f"data/{name}")
                gone += 1
        return gone
