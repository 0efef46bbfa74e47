"""Tables as versions: writers add folders, and a manifest that appears in one step tells readers which of them count.

A table is ``<location>/<table>/data/load=<id>/[<partition>/]*.parquet`` and ``_versions/<number>.json``. A version lists
the loads of each partition. Writing never touches what a version refers to, so a write that fails leaves the table as it
was, readers see the old rows or the new ones, and earlier versions stay readable. A manifest is renamed into place, which
fails where it exists: of two writers at a time one gets an error and may try again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bidscope.operators.merge import merge_rows
from bidscope.session import stage_table
from bidscope.sources.warehouse import MODES


class ConcurrentWrite(RuntimeError):
    """Another writer made this version first."""


@dataclass(frozen=True)
class Version:
    """What a version of a table consists of."""

    number: int
    schema: StructType
    partition_by: tuple[str, ...]
    #: The loads that hold a partition, by its path (``date=2024-01-01``; empty for a table without partitions).
    parts: Mapping[str, tuple[str, ...]]
    #: Rows written by this version.
    rows: int
    #: Free to the writer: committed with the rows.
    notes: Mapping[str, object] = field(default_factory=dict)

    def dump(self) -> str:
        return json.dumps(
            {
                "schema": self.schema.jsonValue(),
                "partition_by": self.partition_by,
                "parts": self.parts,
                "rows": self.rows,
                "notes": self.notes,
            }
        )

    @staticmethod
    def load(number: int, text: str) -> Version:
        told = json.loads(text)
        parts = {part: tuple(loads) for part, loads in told["parts"].items()}
        schema = StructType.fromJson(told["schema"])
        return Version(number, schema, tuple(told["partition_by"]), parts, told["rows"], told["notes"])


class VersionedStore:
    """Versioned tables below one folder that all executors share."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # Files ------------------------------------------------------------------------------------------------------------

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.location).getFileSystem(self._conf)

    def _listed(self, pattern: str) -> list:
        return list(self._fs().globStatus(self._path(pattern)) or [])

    def _data(self, table: str) -> str:
        return f"{self.location}/{table}/data"

    def _manifest(self, table: str, number: int) -> str:
        return f"{self.location}/{table}/_versions/{number:012d}.json"

    # Reading ----------------------------------------------------------------------------------------------------------

    def tables(self) -> list[str]:
        return sorted(s.getPath().getParent().getName() for s in self._listed(f"{self.location}/*/_versions"))

    def versions(self, table: str) -> list[int]:
        names = [s.getPath().getName() for s in self._listed(f"{self.location}/{table}/_versions/*.json")]
        return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())

    def version(self, table: str, as_of: int | None = None) -> Version | None:
        """The version of that number, the latest by default; None where the table has none."""
        numbers = self.versions(table)
        if as_of is not None and as_of not in numbers:
            raise ValueError(f"{table} has no version {as_of}; it has {numbers}.")
        if not numbers:
            return None
        number = numbers[-1] if as_of is None else as_of
        stream = self._fs().open(self._path(self._manifest(table, number)))
        try:
            return Version.load(number, bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def table(self, table: str, as_of: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its partitions; folders of other partitions are not even listed."""
        found = self.version(table, as_of)
        if found is None:
            raise ValueError(f"There is no table {table}.")
        return self._read(table, found, parts).select(found.schema.names)

    def _read(self, table: str, version: Version, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows, and the file metadata where it is asked for."""
        wanted = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
        folders = [f"{self._data(table)}/load={load}/{part}".rstrip("/") for part, loads in wanted.items() for load in loads]
        if not folders:
            return self.spark.createDataFrame([], version.schema).withColumn("_part", F.lit(""))
        reader = self.spark.read.schema(version.schema).option("basePath", self._data(table))
        inside = r"/load=[^/]*/(.*?)/?[^/]*$"
        # The metadata has the path as a URI, in which a plus is a plus.
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        part = F.regexp_extract(path, inside, 1)
        return reader.parquet(*folders).withColumn("_part", part)

    def history(self, table: str) -> DataFrame:
        """``version, rows_written, n_partitions, notes`` (as JSON), a row per version that is kept."""
        found = [self.version(table, number) for number in self.versions(table)]
        rows = [(v.number, v.rows, len(v.parts), json.dumps(v.notes)) for v in found]
        return self.spark.createDataFrame(rows, "version long, rows_written long, n_partitions long, notes string")

    # Writing ----------------------------------------------------------------------------------------------------------

    def _write(self, df: DataFrame, table: str, partition_by: Sequence[str]) -> tuple[str, list[str], int]:
        """Write rows into a load of their own: its id, the partitions it has, and its rows."""
        load, seen = uuid.uuid4().hex, Observation()
        balanced = df.hint("rebalance", *partition_by) if partition_by else df
        counted = balanced.observe(seen, F.count(F.lit(1)).alias("rows"))
        folder = f"{self._data(table)}/load={load}"
        counted.write.partitionBy(*partition_by).option("compression", "zstd").parquet(folder)
        rows = int(seen.get["rows"] or 0)
        if not partition_by:
            return load, [""], rows
        depth = "/".join(f"{column}=*" for column in partition_by)
        # A path as it is stored, escapes and all.
        found = [str(s.getPath().toString()) for s in self._listed(f"{folder}/{depth}")]
        return load, [path.split(f"/load={load}/", 1)[1] for path in found], rows

    def _commit(self, table: str, version: Version) -> Version:
        final = self._manifest(table, version.number)
        draft = f"{self.location}/{table}/_versions/.{uuid.uuid4().hex}"
        stream = self._fs().create(self._path(draft), False)
        try:
            stream.write(bytearray(version.dump().encode()))
        finally:
            stream.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        no_overwrite = self.spark.sparkContext._gateway.new_array(options, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self._conf)
        try:
            context.rename(self._path(draft), self._path(final), no_overwrite)
        except Exception as error:
            self._fs().delete(self._path(draft), False)
            if self._fs().exists(self._path(final)):
                raise ConcurrentWrite(f"Version {version.number} of {table} was made by another writer.") from error
            raise
        return version

    def load(
        self,
        df: DataFrame,
        table: str,
        if_exists: str = "replace",
        partition_by: Sequence[str] = (),
        notes: Mapping[str, object] | None = None,
    ) -> Version:
        """Replace a table's rows, add to them, or fail where it exists; an added frame keeps the table's layout."""
        if if_exists not in MODES:
            raise ValueError(f"Unknown mode: {if_exists}. Use one of {sorted(MODES)}.")
        now = self.version(table)
        if now is not None and if_exists == "fail":
            raise ValueError(f"There is a table {table}.")
        adds = now is not None and if_exists == "append"
        layout = now.partition_by if adds else tuple(partition_by)
        schema = now.schema if adds else df.schema
        load, parts, rows = self._write(df.select(schema.names), table, layout)
        new = {part: (load,) for part in parts}
        if adds:
            new = {**now.parts, **{part: (*now.parts.get(part, ()), load) for part in parts}}
        return self._commit(table, Version((now.number if now else 0) + 1, schema, layout, new, rows, dict(notes or {})))

    def replace_parts(
        self,
        df: DataFrame,
        table: str,
        parts: Iterable[str],
        partition_by: Sequence[str] = (),
        notes: Mapping[str, object] | None = None,
    ) -> Version:
        """Put ``df`` in the place of the listed partitions; those it has no rows of go, all others stay unread.

        A table that does not exist yet is made with the layout ``partition_by``. Rows outside the listed partitions are a
        ValueError, and the table stays as it was.
        """
        now = self.version(table)
        layout, schema = (now.partition_by, now.schema) if now else (tuple(partition_by), df.schema)
        load, written, rows = self._write(df.select(schema.names), table, layout)
        if outside := set(written) - set(parts):
            raise ValueError(f"Rows of partitions that are not to be replaced: {sorted(outside)[:5]}.")
        kept = {part: loads for part, loads in (now.parts if now else {}).items() if part not in set(parts)}
        new = {**kept, **{part: (load,) for part in written}}
        return self._commit(table, Version((now.number if now else 0) + 1, schema, layout, new, rows, dict(notes or {})))

    def merge(self, df: DataFrame, table: str, key: Sequence[str], notes: Mapping[str, object] | None = None) -> Version:
        """Replace the rows whose key ``df`` has and add those it has new.

        Only partitions that lose or get a row are read whole and written. Keys that ``df`` has more than once are a
        ValueError, and the table stays as it was. A null in a key matches nothing, so such rows are added.
        """
        now = self.version(table)
        if now is None:
            raise ValueError(f"There is no table {table}.")
        new = stage_table(df.select(now.schema.names), "merge-new")
        if not new.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
            raise ValueError(f"The new rows of {table} repeat a key of {', '.join(key)}.")
        held = self._read(table, now)
        touched = held.join(new.select(*key), list(key), "left_semi").select("_part")
        if now.partition_by:
            # Staged, so that its size is known and the rows held are not sent about to meet it.
            named = stage_table(new.select(*[F.col(c).alias(f"_at_{c}") for c in now.partition_by]).distinct(), "merge-parts")
            same = [held[c].eqNullSafe(named[f"_at_{c}"]) for c in now.partition_by]
            touched = touched.union(held.join(named, same, "left_semi").select("_part"))
        # As many rows as there are partitions.
        parts = {row["_part"] for row in touched.distinct().collect()} or ({""} if not now.partition_by else set())
        old = self._read(table, now, parts).select(now.schema.names)
        load, written, rows = self._write(merge_rows(old, new, key), table, now.partition_by)
        kept = {part: loads for part, loads in now.parts.items() if part not in parts}
        merged = {**kept, **{part: (load,) for part in written}}
        return self._commit(table, replace(now, number=now.number + 1, parts=merged, rows=rows, notes=dict(notes or {})))

    def expire(self, table: str, keep: int = 1) -> int:
        """Forget all but the last ``keep`` versions and delete the loads that no version refers to; returns how many.

        Not while a writer is at work: a load that is not committed yet is one that no version refers to.
        """
        numbers = self.versions(table)
        for number in numbers[: -max(keep, 1)]:
            self._fs().delete(self._path(self._manifest(table, number)), False)
        used = {
            load for number in numbers[-max(keep, 1) :] for loads in self.version(table, number).parts.values() for load in loads
        }
        folders = [s.getPath() for s in self._listed(f"{self._data(table)}/load=*")]
        unused = [path for path in folders if path.getName().removeprefix("load=") not in used]
        for path in unused:
            self._fs().delete(path, True)
        return len(unused)
