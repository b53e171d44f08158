"""Keyed tables in buckets: a batch rewrites the buckets it touches, and a manifest makes it count.

Layout under `root`: `data/v<n>/bucket=<b>/` holds what version n wrote of bucket b, and
`manifest/<n>` says which version of every bucket counts as of version n.  A version is there
once its manifest is, and a manifest appears at once, by rename.  So a reader sees whole
versions only, and a batch that was cut off anywhere before that is simply done again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyedTable:
    """A table whose rows belong to one of `buckets` buckets by the hash of `keys`.

    `combine(old, new)` of `merge` must only bring together rows of equal keys.  The number of
    buckets is fixed with the table: choose it so that a bucket is rewritten in one task.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root, schema, keys, buckets

    # Files.

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The committed versions, in order."""
        where, fs = self._fs(f"{self.root}/manifest/*")
        return sorted(int(f.getPath().getName()) for f in (fs.globStatus(where) or []) if f.getPath().getName().isdigit())

    def manifest(self, n: int) -> dict[int, int]:
        """Bucket to the version that holds it, as of version `n`."""
        where, fs = self._fs(f"{self.root}/manifest/{n}")
        stream = fs.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(b): v for b, v in json.loads(text).items()}

    def _commit(self, n: int, manifest: dict[int, int]) -> None:
        draft, fs = self._fs(f"{self.root}/manifest/{n}.draft")
        final, _ = self._fs(f"{self.root}/manifest/{n}")
        out = fs.create(draft, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        if not fs.rename(draft, final):  # this version was committed before; what it holds now is the same
            fs.delete(final, False)
            fs.rename(draft, final)

    # Rows.

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, manifest: dict[int, int], only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/data/v{v}/bucket={b}" for b, v in manifest.items() if only is None or b in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _base(self, below: int) -> dict[int, int]:
        have = [n for n in self.versions() if n < below]
        return self.manifest(have[-1]) if have else {}

    def read(self, below: int = 1 << 62) -> DataFrame:
        """The newest committed version under `below`; no rows if there is none."""
        return self._rows(self._base(below))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the newest version whose keys are among `keys`; only their buckets are read."""
        wanted = {r[0] for r in keys.select(self.bucket()).distinct().collect()}
        return self._rows(self._base(1 << 62), wanted).join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    def merge(self, batch: DataFrame, n: int, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Commit version `n`: the version before it, with `batch` combined into the buckets that it touches.

        Doing a version again, for a batch that was cut off or not yet acknowledged, starts from
        the same version before it and so gives the same rows.
        """
        base = self._base(n)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = {r[0] for r in batch.select(self.bucket()).distinct().collect()}  # at most `buckets` numbers
            new = combine(self._rows(base, touched), batch).select(*self.schema.names)
            # One task a bucket, by its place; a range would have to sample, and so make all rows twice.
            place = F.array_position(F.array(*map(F.lit, sorted(touched))), F.col("bucket")).cast("int") - 1 if touched else F.lit(0)
            placed = new.withColumn("bucket", self.bucket()).repartitionById(max(len(touched), 1), place)
            placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/v{n}")
        finally:
            batch.unpersist()
        where, fs = self._fs(f"{self.root}/data/v{n}/bucket=*")
        written = {int(f.getPath().getName().split("=")[1]) for f in (fs.globStatus(where) or [])}
        kept = {b: v for b, v in base.items() if b not in touched}
        self._commit(n, kept | dict.fromkeys(sorted(written), n))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all but the newest `keep` versions and delete the buckets that no version is left to read; returns the folders."""
        have = self.versions()
        stay = have[-keep:]
        needed = {(v, b) for n in stay for b, v in self.manifest(n).items()}
        for n in have[: -len(stay) or None] if stay else []:
            where, fs = self._fs(f"{self.root}/manifest/{n}")
            fs.delete(where, False)
        gone = []
        where, fs = self._fs(f"{self.root}/data/v*/bucket=*")
        newest = stay[-1] if stay else -1
        for f in fs.globStatus(where) or []:
            b, v = int(f.getPath().getName().split("=")[1]), int(f.getPath().getParent().getName()[1:])
            if (v, b) not in needed and v <= newest:  # a later one may be at work
                fs.delete(f.getPath(), True)
                gone.append(f"v{v}/bucket={b}")
        return sorted(gone)
