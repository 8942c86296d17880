"""Parquet tables by partition, with versions.

A version is a manifest: a small JSON file that names, for every partition, the
folder that holds its files. A commit writes new folders for the partitions that it
touches, next to all others, and publishes the next manifest as its last step; what
is not touched keeps its files, and nothing that is being read is ever overwritten. A
commit that dies leaves folders that no manifest names and is simply done again;
``vacuum`` removes such folders and those of old versions.

The driver handles partitions, never rows: the number of partitions has to be kept
bounded by the choice of keys (namespace and hash bucket, run, source file).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

LISTED = 1 << 20                 # partitions of one commit at most: they are listed on the driver


class CommitConflict(RuntimeError):
    """Another commit has published the version that this one was going to publish."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, keys: Iterable[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self._known: dict[int, dict] = {}                     # manifests never change

    # --- the file system ------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path("_").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    # --- versions -------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("_manifest") if n.endswith(".json") and n[:-5].isdigit()]

    def version(self) -> int:
        """The newest version, 0 if nothing has been committed."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """``{"schema", "partitions": [{"keys", "path", "rows"}]}`` of a version (default: the newest)."""
        v = self.version() if version is None else version
        if not v:
            return {"schema": None, "partitions": []}
        if v not in self._known:
            self._known[v] = json.loads(self.spark.read.text(f"{self.root}/_manifest/{v:08d}.json", wholetext=True).first()[0])
        return self._known[v]

    def _publish(self, version: int, manifest: dict) -> None:
        fs, draft, final = self._fs(), self._path("_manifest", f".{uuid.uuid4().hex}"), self._path("_manifest", f"{version:08d}.json")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise CommitConflict(f"{self.root}: version {version} is there already")

    # --- reading --------------------------------------------------------------------

    def partitions(self, where: Callable[[dict], bool] | None = None, version: int | None = None) -> list[dict]:
        """The partitions of a version, of which ``where`` sees the key values by name."""
        found = self.manifest(version)["partitions"]
        return [p for p in found if where is None or where(dict(zip(self.keys, p["keys"], strict=True)))]

    def read(self, where: Callable[[dict], bool] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version; with ``where``, files of the other partitions are not even listed."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise FileNotFoundError(f"{self.root}: no version yet")
        schema = Ty.StructType.fromJson(found["schema"])
        paths = [f"{self.root}/{p['path']}" for p in found["partitions"] if where is None or where(dict(zip(self.keys, p["keys"], strict=True)))]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # --- writing --------------------------------------------------------------------

    def write(self, rows: DataFrame, order: Iterable[str] = ()) -> list[dict]:
        """The rows written as new folders, one for each partition, not yet part of any version; files sorted by ``order``."""
        commit = f"data/{uuid.uuid4().hex[:16]}"
        name = F.md5(F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in self.keys])))
        # files of a good size: small partitions come together in a task, large ones are split over several
        named = self.spark.sql("SELECT /*+ REBALANCE(_p) */ * FROM {rows}", rows=rows.withColumn("_p", name))
        named.sortWithinPartitions("_p", *order).write.partitionBy("_p").parquet(f"{self.root}/{commit}")
        back = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{commit}")
        counts = (back.groupBy(*self.keys, F.regexp_extract(F.col("_metadata.file_path"), "_p=([0-9a-f]{32})", 1).alias("_p"))
                  .count().limit(LISTED + 1).collect())
        if len(counts) > LISTED:
            raise ValueError(f"{self.root}: over {LISTED} partitions in a commit")
        return [{"keys": list(r[:-2]), "path": f"{commit}/_p={r[-2]}", "rows": r[-1]} for r in counts]

    def commit(self, new: list[dict], drop: Callable[[dict], bool], schema: Ty.StructType, base: int, notes: dict | None = None) -> int:
        """Version ``base + 1``: the partitions of ``base`` that ``drop`` does not name (nor ``new`` replaces), and the ``new`` ones.

        ``notes`` is a small dictionary that the manifests carry on (None: as in ``base``)."""
        replaced = {json.dumps(p["keys"]) for p in new}
        old = self.manifest(base) if base else {"partitions": []}
        kept = [p for p in old["partitions"] if json.dumps(p["keys"]) not in replaced and not drop(dict(zip(self.keys, p["keys"], strict=True)))]
        self._publish(base + 1, {"schema": schema.jsonValue(), "partitions": kept + new, "notes": old.get("notes", {}) if notes is None else notes})
        return base + 1

    def notes(self) -> dict:
        return self.manifest().get("notes", {})

    def replace(self, rows: DataFrame, drop: Callable[[dict], bool] = lambda k: False) -> int:
        """Commit ``rows`` as the new contents of their partitions (and drop others, if told so)."""
        base = self.version()
        return self.commit(self.write(rows), drop, rows.schema, base)

    def drop(self, where: Callable[[dict], bool]) -> int:
        """Commit a version without the partitions that ``where`` names; no file is read or written. Nothing to drop: no new version."""
        base = self.version()
        if not self.partitions(where, base):
            return base
        return self.commit([], where, Ty.StructType.fromJson(self.manifest(base)["schema"]), base)

    def vacuum(self, keep: int = 1) -> int:
        """Delete all but the newest ``keep`` manifests, then every folder that no kept manifest names; the number of folders.

        Not while a commit is being written. Ended half-way, it can be run again."""
        fs = self._fs()
        kept = self.versions()[-keep:]
        for v in self.versions()[:-keep]:
            fs.delete(self._path("_manifest", f"{v:08d}.json"), False)
        named = {p["path"] for v in kept for p in self.manifest(v)["partitions"]}
        gone = 0
        for commit in self._names("data"):
            folders = [n for n in self._names("data", commit) if n.startswith("_p=")]
            dead = [n for n in folders if f"data/{commit}/{n}" not in named]
            for n in dead:
                fs.delete(self._path("data", commit, n), True)
            gone += len(dead)
            if len(dead) == len(folders):
                fs.delete(self._path("data", commit), True)
        return gone

