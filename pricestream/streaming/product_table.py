"""Per-product tables kept by micro-batches: log-structured, in buckets (operators 7, 32, 33, 47; lookups of 4 and 44).

A table is ``buckets`` buckets by hash of the trimmed product id. A version writes only the changed rows, in
one file for each bucket that has any; a deleted row is a row marked so. Once a bucket has more than ``fan`` change
files over its base they are merged into a new base of that bucket. So the bytes that a version writes follow its
changes (and their share of merging), and the buckets that it does not touch keep their files.

A manifest for each version names the base and the change files of every bucket; it is written last and is what makes a
version exist. Readers of a few products open the files of their buckets only (``of``), sorted by id
with a bloom filter on it. The manifest of the version before stays, so a batch that is run
again starts from the same state; files that neither names are deleted.

    <root>/manifest/version=N     bucket, base, changes, buckets (as many rows as buckets)
    <root>/changes/version=N/bucket=B, <root>/base/version=N/bucket=B
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricestream.functions import exprs as X
from pricestream.session import child_names, delete_path

VERSION, DELETED = "__version", "__deleted"
#: No base yet.
NO_BASE = -2
#: The version that ``create`` writes.
FIRST = -1
_MANIFEST = "bucket int, base long, changes array<long>, buckets int"


class ProductTable:
    """``schema``: DDL of the rows, one per ``key``. ``buckets``: about the table's bytes / 128 MB; a table keeps
    the number that it was created with."""

    def __init__(self, spark: SparkSession, root: str, schema: str, buckets: int = 16, fan: int = 8,
                 key: str = "product_id", rows_per_base: int = 10_000):
        self.spark, self.root, self.buckets, self.fan, self.key = spark, root.rstrip("/"), buckets, fan, key
        self.columns = [f.name for f in T._parse_datatype_string(schema).fields]
        self.schema = f"{schema}, {VERSION} long, {DELETED} boolean"
        self.rows_per_base = rows_per_base

    # --- versions

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        names = [v for v in child_names(self.spark, f"{self.root}/manifest") if v.startswith("version=")]
        return sorted(int(v.split("=")[1]) for v in names
                      if "_SUCCESS" in child_names(self.spark, f"{self.root}/manifest/{v}"))

    def manifest(self, version: int) -> dict[int, tuple[int, list[int]]]:
        """bucket -> (version of its base, versions of its changes); at most one entry per bucket."""
        if version not in self.versions():
            raise RuntimeError(f"version {version} of {self.root} is missing or incomplete")
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/version={version}").collect()
        if any(r["buckets"] != self.buckets for r in rows):
            raise RuntimeError(f"{self.root} has {rows[0]['buckets']} buckets, not {self.buckets}")
        return {r["bucket"]: (r["base"], list(r["changes"])) for r in rows}

    def create(self, rows: DataFrame) -> None:
        """The table before the first batch."""
        if any(v > 0 for v in self.versions()):
            raise RuntimeError(f"{self.root} holds the state of another run; use its stream checkpoint or a new folder")
        self._write(rows.withColumn(VERSION, F.lit(FIRST).cast("long")).withColumn(DELETED, F.lit(False)), "base", FIRST)
        own = self._buckets_in(f"{self.root}/base/version={FIRST}")
        self._write_manifest(FIRST, {b: (FIRST, []) for b in own})

    def commit(self, version: int, changes: DataFrame, deleted: DataFrame | None = None) -> None:
        """Writes ``changes`` (whole rows, one per key) and removes the keys of ``deleted`` as ``version``; the version before
        must be there. Running it again replaces it."""
        entries = self.manifest(version - 1)
        rows = changes.select(*self.columns, F.lit(version).cast("long").alias(VERSION), F.lit(False).alias(DELETED))
        if deleted is not None:
            gone = deleted.select(self.key).distinct()
            fields = T._parse_datatype_string(self.schema).fields[:len(self.columns)]
            rows = rows.unionByName(gone.select(
                *[F.col(self.key) if f.name == self.key else F.lit(None).cast(f.dataType).alias(f.name) for f in fields],
                F.lit(version).cast("long").alias(VERSION), F.lit(True).alias(DELETED)))
        self._write(rows, "changes", version)
        for b in self._buckets_in(f"{self.root}/changes/version={version}"):
            base, own = entries.get(b, (NO_BASE, []))
            entries[b] = (base, [*own, version])
        full = [b for b, (_, own) in entries.items() if len(own) > self.fan]
        if full:
            self._write(self._rows({b: entries[b] for b in full}), "base", version)
            # a bucket whose rows are all deleted has no file
            kept = set(self._buckets_in(f"{self.root}/base/version={version}"))
            entries |= {b: (version if b in kept else NO_BASE, []) for b in full}
        self._write_manifest(version, entries)
        self._clean(version)

    # --- reading

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version (the newest if none is given), of some buckets only if ``buckets`` is given."""
        if version is None:
            done = self.versions()
            if not done:
                raise RuntimeError(f"no complete state under {self.root}")
            version = done[-1]
        entries = self.manifest(version)
        if buckets is not None:
            entries = {b: e for b, e in entries.items() if b in set(buckets)}
        return self._rows(entries).select(*self.columns)

    def of(self, ids: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of the ids in ``ids`` (column ``key``, compared trimmed): reads the files of their buckets."""
        touched = ids.select(X.trim_unicode(F.col(self.key)).alias("__id")).distinct()
        buckets = [r[0] for r in touched.select(self.bucket(F.col("__id"))).distinct().collect()]  # at most all buckets
        rows = self.read(version, buckets)
        return rows.join(touched, X.trim_unicode(rows[self.key]) == touched["__id"], "left_semi")

    def lookup(self, product_id: str, version: int | None = None) -> DataFrame:
        """The row of one id: a pushed filter on the files of one bucket."""
        bucket = self.spark.range(1).select(self.bucket(F.lit(product_id))).first()[0]
        return self.read(version, [bucket]).where(F.col(self.key) == product_id)

    def files(self, version: int, buckets: list[int] | None = None) -> list[str]:
        return [p for b, e in self.manifest(version).items() if buckets is None or b in buckets for p in self._paths(b, e)]

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(X.trim_unicode(key)), F.lit(self.buckets)).cast("int")

    # --- files

    def _paths(self, bucket: int, entry: tuple[int, list[int]]) -> list[str]:
        base, changes = entry
        own = [f"{self.root}/changes/version={v}/bucket={bucket}" for v in changes]
        return own if base == NO_BASE else [f"{self.root}/base/version={base}/bucket={bucket}", *own]

    def _rows(self, entries: dict) -> DataFrame:
        """The newest row of each key over some buckets' files."""
        paths = [p for b, e in entries.items() for p in self._paths(b, e)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        if all(not changes for _, changes in entries.values()):
            return rows.where(~F.col(DELETED))
        others = [c for c in [*self.columns, VERSION, DELETED] if c != self.key]
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*others), VERSION).alias("r"))
        return newest.where("NOT r.__deleted").select(*[F.col(c) if c == self.key else F.col(f"r.{c}").alias(c)
                                                        for c in [*self.columns, VERSION, DELETED]])

    def _write(self, rows: DataFrame, kind: str, version: int) -> None:
        bloom = {"parquet.bloom.filter.enabled#" + self.key: "true",
                 "parquet.bloom.filter.expected.ndv#" + self.key: str(self.rows_per_base)} if kind == "base" else {}
        (rows.withColumn("bucket", self.bucket(F.col(self.key))).repartition("bucket")
         .sortWithinPartitions("bucket", self.key).write.mode("overwrite").options(**bloom).partitionBy("bucket")
         .parquet(f"{self.root}/{kind}/version={version}"))

    def _buckets_in(self, path: str) -> list[int]:
        return [int(n.split("=")[1]) for n in child_names(self.spark, path) if n.startswith("bucket=")]

    def _write_manifest(self, version: int, entries: dict) -> None:
        rows = [(b, base, changes, self.buckets) for b, (base, changes) in sorted(entries.items())]
        (self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}"))

    def _clean(self, version: int) -> None:
        """Deletes what neither this version nor the one before it reads."""
        for v in self.versions():
            if v < version - 1:
                delete_path(self.spark, f"{self.root}/manifest/version={v}")
        used = {p for v in self.versions() for p in self.files(v)}
        for kind in ("base", "changes"):
            for v in child_names(self.spark, f"{self.root}/{kind}"):
                at = f"{self.root}/{kind}/{v}"
                own = [f"{at}/bucket={b}" for b in self._buckets_in(at)]
                if int(v.split("=")[1]) <= version and not used.intersection(own):
                    delete_path(self.spark, at)
                else:
                    for p in own:
                        if p not in used:
                            delete_path(self.spark, p)

