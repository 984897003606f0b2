"""Layer storage: versioned Parquet folders, optionally registered as tables."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks import schemas
from tillworks.operators.merge import find_duplicate_keys, upsert

LAYERS = ["bronze", "silver", "gold", "ops"]


class LayerStore:
    """Tables named ``layer.table`` under ``root/layer/table/version=N``.

    Parquet cannot be replaced while it is read, so a full write goes to a new
    version, which counts once its success marker is there: readers see the old
    or the new rows, and a job that dies half-way leaves the old ones. Partition
    overwrites stay inside the current version; Spark stages them and moves only
    the partitions written, so a rerun replaces instead of adding.

    A replaced version stays for ``retain_hours``, so that frames read before and
    jobs under way still find their files. A registered catalog table follows the
    current version. ``count_unknown`` says for all marts of the store whether
    the unknown customer counts as one.
    """

    def __init__(
        self, spark: SparkSession, root: str, retain_hours: float = 24.0, count_unknown: bool = False
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.retain_hours = retain_hours
        self.count_unknown = count_unknown

    # --- versions ---

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hpath.getFileSystem(conf), hpath

    def _versions(self, name: str) -> tuple[list[int], int]:
        """Complete versions, oldest first, and the largest number in use."""
        folder = self._folder(name)
        fs, hpath = self._fs(folder)
        if not fs.exists(hpath):
            return [], 0
        found = []
        for status in fs.listStatus(hpath):
            match = re.fullmatch(r"version=(\d+)", status.getPath().getName())
            if match:
                found.append(int(match.group(1)))
        done = [v for v in sorted(found) if self._complete(name, v)]
        return done, max(found, default=0)

    def _complete(self, name: str, version: int) -> bool:
        fs, hpath = self._fs(f"{self._folder(name)}/version={version}/_SUCCESS")
        return fs.exists(hpath)

    def exists(self, name: str) -> bool:
        return bool(self._versions(name)[0])

    def location(self, name: str) -> str:
        """Folder of the current version."""
        done, _ = self._versions(name)
        if not done:
            raise FileNotFoundError(f"no complete version of {name} under {self.root}")
        return f"{self._folder(name)}/version={done[-1]}"

    def _next(self, name: str) -> str:
        return f"{self._folder(name)}/version={self._versions(name)[1] + 1}"

    def _drop_old(self, name: str) -> None:
        """Remove versions that were replaced longer than ``retain_hours`` ago."""
        done, _ = self._versions(name)
        limit = (time.time() - self.retain_hours * 3600) * 1000
        for version, follower in zip(done, done[1:]):
            fs, marker = self._fs(f"{self._folder(name)}/version={follower}/_SUCCESS")
            if fs.getFileStatus(marker).getModificationTime() < limit:
                fs.delete(self._fs(f"{self._folder(name)}/version={version}")[1], True)

    # --- reading and writing ---

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in schemas.TABLES:
            reader = reader.schema(schemas.TABLES[name])
        return reader.parquet(self.location(name))

    def empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], schemas.TABLES[name])

    def read_or_empty(self, name: str) -> DataFrame:
        return self.read(name) if self.exists(name) else self.empty(name)

    def _writer(self, df: DataFrame, name: str, partition_by: Sequence[str] | None):
        parts = schemas.PARTITIONED_BY.get(name, []) if partition_by is None else list(partition_by)
        if not parts:
            return df.write
        # AQE sizes the write: rows of a partition meet in few tasks, a partition
        # that outgrows the advisory size is split, so neither one hot month nor
        # a file per task and month results.
        return df.hint("rebalance", *parts).write.partitionBy(*parts)

    def replace(self, df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> None:
        """Full refresh: a new version takes over."""
        self._writer(df, name, partition_by).mode("errorifexists").parquet(self._next(name))
        self._follow(name)
        self._drop_old(name)

    def overwrite_partitions(
        self, df: DataFrame, name: str, partition_by: Sequence[str] | None = None
    ) -> None:
        """Replace the partitions that occur in df, leave the others."""
        if not self.exists(name):
            # a dynamic overwrite leaves no success marker behind
            return self.replace(df, name, partition_by)
        writer = self._writer(df, name, partition_by)
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
            self.location(name)
        )
        self._follow(name)

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> None:
        if not self.exists(name):
            return self.replace(df, name, partition_by)
        self._writer(df, name, partition_by).mode("append").parquet(self.location(name))
        self._follow(name)

    def _refuse_duplicates(self, updates: DataFrame, name: str, keys: Sequence[str]) -> None:
        twice = find_duplicate_keys(updates, keys).head()
        if twice is not None:
            raise ValueError(f"updates of {name} hold a key more than once: {twice}")

    def upsert(self, updates: DataFrame, name: str, keys: Sequence[str]) -> None:
        """Replace rows by key and add new ones, rewriting the whole table."""
        self._refuse_duplicates(updates, name, keys)
        if self.exists(name):
            updates = upsert(self.read(name), updates, keys)
        self.replace(updates, name)

    def upsert_partitions(
        self, updates: DataFrame, name: str, keys: Sequence[str], partition_by: Sequence[str]
    ) -> None:
        """Upsert that reads and rewrites only the partitions ``updates`` touches.

        Rows must not change partition between versions of the same key. The
        touched partitions are storage folders (months), so their list is short.
        """
        self._refuse_duplicates(updates, name, keys)
        merged = updates
        if self.exists(name):
            touched = updates.select(*partition_by).distinct().collect()
            merged = upsert(
                self.read(name).where(in_partitions(touched, partition_by)), updates, keys
            )
        self.overwrite_partitions(merged, name, partition_by)

    # --- catalog ---

    def ensure_layers(self) -> None:
        """Create the layer databases and every contract table that is missing."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for name in schemas.TABLES:
            if not self.exists(name):
                self.replace(self.empty(name), name)
            self.register(name)

    def register(self, name: str, partition_by: Sequence[str] | None = None) -> None:
        """A catalog table over the current version; later writes move it along."""
        layer = name.split(".")[0]
        parts = schemas.PARTITIONED_BY.get(name, []) if partition_by is None else list(partition_by)
        fields = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in self.read(name).schema.fields
        )
        folders = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: rows stay
        self.spark.sql(
            f"CREATE TABLE {name} ({fields}) USING parquet {folders} "
            f"LOCATION '{self.location(name)}'"
        )
        if parts:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def _registered_at(self, name: str) -> str | None:
        """Location of the catalog table if it is one of this store's."""
        if not self.spark.catalog.tableExists(name):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").head()
        place = rows["data_type"] if rows else ""
        folder = self._fs(self._folder(name))[1].toUri().getPath()
        return place if f"{folder}/version=" in place else None

    def _follow(self, name: str) -> None:
        """Bring a registered table to the current version and its partitions."""
        place = self._registered_at(name)
        if place is None:
            return
        now = self.location(name)
        parted = any(f.isPartition for f in self.spark.catalog.listColumns(name))
        moved = not place.rstrip("/").endswith(now.rsplit("/", 1)[1])
        if moved and parted:
            # partitions keep their own places: enter the table anew
            parts = [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]
            self.register(name, parts)
        elif moved:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{now}'")
        elif parted:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(name)


def in_partitions(rows, columns: Sequence[str]):
    """Predicate for a short list of partition values; prunes folders at planning."""
    out = F.lit(False)
    for row in rows:
        match = F.lit(True)
        for c in columns:
            match = match & F.col(c).eqNullSafe(F.lit(row[c]))
        out = out | match
    return out


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Materialise a model as a managed catalog table."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    df.write.mode(mode).format("parquet").saveAsTable(name)


def write_bronze(
    store: LayerStore, rows: DataFrame, mode: str = "append", name: str = "bronze.raw_transactions"
) -> None:
    """Write bronze rows (see ``bronze_rows``).

    ``append`` adds the rows' ingest batch; writing a batch again replaces it.
    ``overwrite`` is the full refresh.
    """
    if mode == "overwrite":
        store.replace(rows, name)
    elif mode == "append":
        store.overwrite_partitions(rows, name)
    else:
        raise ValueError(f"unknown mode: {mode}")
