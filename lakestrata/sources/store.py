"""Published table versions: plain parquet folders named by one small manifest.

A step writes its next states into new folders, then publishes them all with one
manifest.  Readers take the newest manifest, so they see all of a step or nothing.
One writer at a time is assumed.  The final rename is atomic on HDFS and local
disks; an object store without atomic rename needs a committer or a table format
with MERGE in its place.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLD = 64


class Store:
    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), dict(schemas)
        self.lock = RLock()

    # -- files ---------------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        conf = self.spark._jsc.hadoopConfiguration()
        return self._path(self.root).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self._fs().exists(self._path(path))

    def folders(self, path: str) -> list[str]:
        """Names of what lies in a folder."""
        return [s.getPath().getName() for s in self._fs().listStatus(self._path(path))]

    def new_path(self, table: str) -> str:
        """A fresh folder for a version, or part, of a table."""
        return f"{self.root}/tables/{table}/{uuid.uuid4().hex}"

    def write(self, table: str, df: DataFrame) -> str:
        path = self.new_path(table)
        df.write.mode("errorifexists").parquet(path)
        return path

    # -- manifests -----------------------------------------------------------------

    def manifest(self) -> dict:
        """The newest published state."""
        folder = f"{self.root}/_manifest"
        if self.exists(folder):
            done = sorted(n for n in self.folders(folder) if n.endswith(".json") and not n.startswith("."))
            if done:
                return self._load(f"{folder}/{done[-1]}")
        return {"seq": 0, "tables": {}, "versions": {}, "meta": {}}

    def _load(self, path: str) -> dict:
        stream = self._fs().open(self._path(path))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def publish(
        self,
        replace: Mapping[str, Sequence[str]] | None = None,
        append: Mapping[str, Sequence[str]] | None = None,
        meta: Mapping[str, object] | None = None,
    ) -> int:
        """Make new folders the contents of tables, all at once.

        ``replace`` and ``append`` name folders already written; those that do not
        exist (a kind of change with no rows) are left out.  Steps of one process may publish
        side by side, one after the other.
        """
        with self.lock:
            return self._publish(replace, append, meta)

    def _publish(self, replace, append, meta) -> int:
        state = self.manifest()
        seq = state["seq"] + 1
        for table, paths in (replace or {}).items():
            state["tables"][table] = [p for p in paths if self.exists(p)]
            state["versions"][table] = seq
        for table, paths in (append or {}).items():
            known = state["tables"].get(table, [])
            state["tables"][table] = known + [p for p in paths if self.exists(p)]
            state["versions"][table] = seq
        state["meta"].update(meta or {})
        state["seq"] = seq
        folder = f"{self.root}/_manifest"
        fs = self._fs()
        fs.mkdirs(self._path(folder))
        draft = f"{folder}/.{uuid.uuid4().hex}.tmp"
        out = fs.create(self._path(draft), True)
        try:
            out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        finally:
            out.close()
        final = f"{folder}/{seq:012d}.json"
        if self.exists(final) or not fs.rename(self._path(draft), self._path(final)):
            raise RuntimeError(f"another writer published {final}")
        return seq

    # -- reading -------------------------------------------------------------------

    def read(self, table: str, session: SparkSession | None = None) -> DataFrame:
        """The published rows of a table; empty before its first version."""
        spark, schema = session or self.spark, self.schemas[table]
        paths = self.manifest()["tables"].get(table, [])
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths)

    def version(self, table: str) -> int:
        return self.manifest()["versions"].get(table, 0)

    def meta(self, name: str, default=None):
        return self.manifest()["meta"].get(name, default)

    def compact(self, table: str) -> None:
        """Fold folders of an appended table, a level at a time.

        ``FOLD`` folders of one level become one of the next, so a row is rewritten
        once per level however long the history grows.
        """
        paths = self.manifest()["tables"].get(table, [])
        levels: dict[int, list[str]] = {}
        for path in paths:
            name = path.rsplit("/", 1)[-1]
            level = int(name[5 : name.index("-")]) if name.startswith("level") else 0
            levels.setdefault(level, []).append(path)
        for level, group in sorted(levels.items()):
            if len(group) >= FOLD:
                target = f"{self.root}/tables/{table}/level{level + 1}-{uuid.uuid4().hex}"
                rows = self.spark.read.schema(self.schemas[table]).parquet(*group)
                rows.write.mode("errorifexists").parquet(target)
                rest = [p for p in paths if p not in group]
                self.publish(replace={table: [*rest, target]})
                return

    def vacuum(self, older_than: timedelta = timedelta(days=7)) -> None:
        """Delete table folders that no state published in the last ``older_than`` names
        and that were made before that, and the older manifests.  A reader that began
        within that time keeps its files.  Not called by any cycle: when to run it is
        the operator's decision."""
        fs, folder = self._fs(), f"{self.root}/_manifest"
        if not self.exists(folder):
            return
        limit = (time.time() - older_than.total_seconds()) * 1000
        manifests = sorted(
            (s.getPath().getName(), s.getModificationTime())
            for s in fs.listStatus(self._path(folder))
            if s.getPath().getName().endswith(".json")
        )
        # A state holds until the next is published: the last one before the limit counts too.
        recent = [i for i, (_, made) in enumerate(manifests) if made >= limit]
        first = max(0, (recent[0] if recent else len(manifests)) - 1)
        home = f"{self.root}/tables/"
        used = set()
        for name, _ in manifests[first:]:
            for paths in self._load(f"{folder}/{name}")["tables"].values():
                for path in paths:
                    if not path.startswith(home):
                        raise ValueError(f"{path} is not below {home}; nothing is deleted")
                    used.add("/".join(path.removeprefix(home).split("/")[:2]))
        tables = self._path(home)
        for table in fs.listStatus(tables) if fs.exists(tables) else []:
            for part in fs.listStatus(table.getPath()):
                name = f"{table.getPath().getName()}/{part.getPath().getName()}"
                if name not in used and part.getModificationTime() < limit:
                    fs.delete(part.getPath(), True)
        for name, _ in manifests[:first]:
            fs.delete(self._path(f"{folder}/{name}"), False)

    def register_views(self) -> None:
        """A temporary view per published table."""
        for table in self.manifest()["tables"]:
            if table in self.schemas:
                self.read(table).createOrReplaceTempView(table)

    def refreshed(self, table: str) -> datetime | None:
        found = self.meta(f"refreshed:{table}")
        return datetime.fromisoformat(found) if found else None
