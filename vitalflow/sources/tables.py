"""Layer tables by name. The storage format and its options are settings, not code."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

CURRENT, VERSION = "_CURRENT", "version="
PATIENT = "PATIENT_ID"


@dataclass(frozen=True)
class Lake:
    """Tables at `root/layer/name` in a file format, or in the catalog as `layer.name`.

    With `catalog` true the layer is a database. For a JDBC or warehouse connector give
    its format and options: the name is then passed as `dbtable`, qualified by the layer.

    With `versioned` true, for files, an overwrite writes a new folder and then swaps a pointer to
    it in one rename. Readers see one version whole, a job that fails before the swap changes
    nothing, and a job may overwrite a table that it reads. `vacuum` removes old versions.

    `buckets`, for the catalog, stores every table that has PATIENT_ID in that many buckets of it,
    so that what is joined or added up per patient needs no shuffle and one patient's rows are read
    from one bucket. A hot patient's rows may lie in several files of the bucket.
    """

    spark: SparkSession
    root: str = ""
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    catalog: bool = False
    versioned: bool = False
    buckets: int = 0

    def __post_init__(self):
        if self.versioned and (self.catalog or not self._files):
            raise ValueError("versions are kept for files only")
        if self.buckets and not self.catalog:
            raise ValueError("buckets are kept for catalog tables only")

    @property
    def _files(self) -> bool:
        return self.format in ("parquet", "orc", "json", "csv", "avro", "delta")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer.lower()}/{name.lower()}"

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def current(self, layer: str, name: str) -> str | None:
        """The version that readers of a versioned table see; None before the first."""
        fs, pointer = self._at(f"{self.path(layer, name)}/{CURRENT}")
        if not fs.exists(pointer):
            return None
        stream = fs.open(pointer)
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def _swap(self, layer: str, name: str, version: str) -> None:
        """Point readers to a version that is written whole; the rename is the commit."""
        jvm, home = self.spark._jvm, self.path(layer, name)
        fs, draft = self._at(f"{home}/_{version}")
        stream = fs.create(draft, True)
        stream.writeUTF(version)
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        rename = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(draft), fs.makeQualified(self._at(f"{home}/{CURRENT}")[1]), rename)

    def versions(self, layer: str, name: str) -> list[str]:
        """Folders of a versioned table, also those of writes that never committed; oldest first."""
        fs, home = self._at(self.path(layer, name))
        found = [s for s in fs.listStatus(home) if s.getPath().getName().startswith(VERSION)] if fs.exists(home) else []
        found.sort(key=lambda s: (s.getModificationTime(), s.getPath().getName()))
        return [s.getPath().getName() for s in found]

    def vacuum(self, layer: str, name: str, keep: int = 1) -> list[str]:
        """Remove all but the current version and the `keep - 1` newest others; their names.

        Run it when no reader or writer of older versions is left.
        """
        current = self.current(layer, name)
        others = [v for v in self.versions(layer, name) if v != current]
        gone = others[: max(0, len(others) - (keep - 1))]
        for v in gone:
            fs, folder = self._at(f"{self.path(layer, name)}/{v}")
            fs.delete(folder, True)
        return gone

    def read(self, layer: str, name: str, version: str | None = None) -> DataFrame:
        """A table; of a versioned one the current or a given version."""
        if self.catalog:
            return self.spark.read.table(f"{layer}.{name}")
        reader = self.spark.read.format(self.format).options(**self.options)
        if self.versioned:
            version = version or self.current(layer, name)
            if version is None:
                raise FileNotFoundError(f"{layer}.{name} has no version")
            return reader.load(f"{self.path(layer, name)}/{version}")
        if self._files:
            return reader.load(self.path(layer, name))
        return reader.option("dbtable", f"{layer}.{name}").load()

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        bucket_by: tuple[int, str] | None = None,
    ) -> None:
        """Write a table. Unless it is versioned, do not overwrite a table that `df` reads.

        `bucket_by=(n, key)`, catalog tables only, stores rows by key so that later joins
        and aggregations on it need no shuffle.
        """
        if self.buckets and bucket_by is None and PATIENT in df.columns:
            bucket_by = self.buckets, PATIENT
            # rows of one bucket come from one task, or from several where a patient is hot
            df = df.hint("rebalance", self.buckets, PATIENT)
        if self.versioned:
            if mode != "overwrite":
                raise ValueError("a versioned table is replaced as a whole")
            version = f"{VERSION}{uuid.uuid4().hex}"
            writer = df.write.format(self.format).options(**self.options).mode("errorifexists")
            writer = writer.partitionBy(*partition_by) if partition_by else writer
            writer.save(f"{self.path(layer, name)}/{version}")
            return self._swap(layer, name, version)
        writer = df.write.format(self.format).options(**self.options).mode(mode)
        if mode == "overwrite" and self._files:
            # a whole-table overwrite must not keep partitions that are gone
            writer = writer.option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.catalog:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            if bucket_by:
                writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
            writer.saveAsTable(f"{layer}.{name}")
        elif self._files:
            writer.save(self.path(layer, name))
        else:
            writer.option("dbtable", f"{layer}.{name}").save()

    def exists(self, layer: str, name: str) -> bool:
        if self.catalog:
            return self.spark.catalog.tableExists(f"{layer}.{name}")
        if self.versioned:
            return self.current(layer, name) is not None
        fs, place = self._at(self.path(layer, name))
        return fs.exists(place)

    def names(self, layer: str) -> DataFrame:
        """Names present in a layer, as TABLE_NAME."""
        if self.catalog:
            found = [t.name for t in self.spark.catalog.listTables(layer)]
        else:
            fs, home = self._at(f"{self.root.rstrip('/')}/{layer.lower()}")
            found = [s.getPath().getName() for s in fs.listStatus(home)] if fs.exists(home) else []
        return self.spark.createDataFrame([(n.lower().split(".")[0],) for n in found], "TABLE_NAME string")
