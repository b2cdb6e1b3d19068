"""State tables cut into buckets by key, so that a cycle rewrites only buckets it changes.

A bucketed table is a list of folders per bucket, ``pmod(xxhash64(key), n)``, kept in the store's
manifest beside the plain list of all folders that readers use.  Rows without a key match
nothing and have a bucket of their own, -1, that may have files by many tasks.

A change names the rows that leave, by their surrogate key, and brings the rows that come.  Buckets
that rows leave are rewritten without them; the rows that come are added as folders of their own; all
other folders stay as they are.  A bucket of ``FOLD`` folders is folded when it is next written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.keyed import null_salt
from lakestrata.sources.store import Store

BUCKET = "_bucket"
KEYLESS = -1
FOLD = 16


def bucket_of(key: str, n: int) -> Column:
    hashed = F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")
    return F.when(F.col(key).isNull(), F.lit(KEYLESS)).otherwise(hashed)


@dataclass(frozen=True)
class Buckets:
    """How a table is cut: by which key, into how many, and what names a row."""

    store: Store
    table: str
    key: str
    surrogate: str
    n: int

    @property
    def _meta(self) -> str:
        return f"buckets:{self.table}"

    def folders(self) -> dict[int, list[str]] | None:
        """The folders of each bucket; None if the table is not cut this way yet."""
        known = self.store.meta(self._meta)
        if not known or known["n"] != self.n or known["key"] != self.key:
            return None
        return {int(b): paths for b, paths in known["folders"].items()}

    def write(self, rows: DataFrame) -> dict[int, str]:
        """A folder per bucket that ``rows`` has any in; one task, so one file, per bucket."""
        path = self.store.new_path(self.table)
        cut = rows.withColumn(BUCKET, bucket_of(self.key, self.n))
        cut.repartition(F.col(BUCKET), null_salt(self.key)).write.mode(
            "errorifexists"
        ).partitionBy(BUCKET).parquet(path)
        names = self.store.folders(path)
        prefix = f"{BUCKET}="
        return {
            int(name.removeprefix(prefix)): f"{path}/{name}"
            for name in names
            if name.startswith(prefix)
        }

    def change(self, leaving: DataFrame | None, coming: DataFrame) -> dict:
        """What to publish: the folders of the next state.  ``leaving`` has key and surrogate."""
        held = self.folders()
        if held is None:
            rows = self.store.read(self.table)
            if leaving is not None:
                rows = rows.join(leaving.select(self.surrogate), self.surrogate, "left_anti")
            return self._publication({b: [p] for b, p in self.write(rows.unionByName(coming)).items()})
        touched: set[int] = set()
        if leaving is not None:
            found = leaving.select(bucket_of(self.key, self.n)).distinct().collect()
            touched = {r[0] for r in found}  # at most n + 1
        folded = {b for b, paths in held.items() if len(paths) >= FOLD}
        again = [p for b in touched | folded for p in held.get(b, [])]
        if again:
            schema = self.store.schemas[self.table]
            rows = self.store.spark.read.schema(schema).parquet(*again)
            if touched:
                rows = rows.join(leaving.select(self.surrogate), self.surrogate, "left_anti")
            rewritten = self.write(rows)
            for b in touched | folded:
                held[b] = [rewritten[b]] if b in rewritten else []
        for b, path in self.write(coming).items():
            held[b] = [*held.get(b, []), path]
        return self._publication(held)

    def _publication(self, folders: dict[int, list[str]]) -> dict:
        kept = {b: paths for b, paths in sorted(folders.items()) if paths}
        meta = {"n": self.n, "key": self.key, "folders": {str(b): p for b, p in kept.items()}}
        return {
            "replace": {self.table: [p for paths in kept.values() for p in paths]},
            "meta": {self._meta: meta},
        }
