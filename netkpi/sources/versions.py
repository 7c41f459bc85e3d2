"""Tables of versions: every change writes new files and then one small manifest, which is the table from then on.

A manifest lists the folders of a version, its schema, row counts and properties (keys, time key). It appears whole under
the next number or not at all; of two writers who started from the same version one gets an error and has changed
nothing. A job lost before that leaves files that no manifest names (`vacuum` removes them). Old versions stay readable.

A folder may stand for one value of a partition number (say, a day); `merge` then rewrites only the partitions it
touches. What reaches the driver is the list of folders.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from netkpi.operators.quality import key_audit
from netkpi.sources import small_files

#: Name of the partition number in folders of `merge`.
PART = "_part"


class Conflict(RuntimeError):
    """Another writer has made the next version."""


@dataclass(frozen=True)
class Version:
    number: int
    operation: str
    schema: StructType
    folders: tuple[dict, ...]  # path below the table, part (or None), rows (None where they were not counted)
    properties: Mapping[str, object] = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # versions

    def numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in small_files.names(self.spark, f"{self.path}/manifest")]

    def version(self, number: int | None = None) -> Version:
        """A version, the newest by default; number 0 is the table before its first write."""
        number = max(self.numbers(), default=0) if number is None else number
        if number == 0:
            return Version(0, "none", StructType(), ())
        held = json.loads(small_files.read(self.spark, self._manifest(number)))
        return Version(number, held["operation"], StructType.fromJson(held["schema"]), tuple(held["folders"]), held["properties"])

    def _manifest(self, number: int) -> str:
        return f"{self.path}/manifest/v{number:09d}.json"

    def _commit(self, base: Version, operation: str, schema: StructType, folders: Sequence[dict], properties: Mapping) -> Version:
        made = Version(base.number + 1, operation, schema, tuple(folders), dict(properties))
        text = json.dumps({"operation": operation, "schema": schema.jsonValue(), "folders": list(folders), "properties": made.properties})
        if not small_files.put(self.spark, self._manifest(made.number), text):
            raise Conflict(f"{self.path}: version {made.number} has been written by another job")
        return made

    def history(self) -> DataFrame:
        rows = [(v.number, v.operation, self._count(v), len(v.folders), v.schema.fieldNames(), v.properties.get("keys"), v.properties.get("time_key"))
                for v in map(self.version, self.numbers())]
        return self.spark.createDataFrame(
            rows, "version long, operation string, n_rows long, n_folders long, columns array<string>, keys array<string>, time_key string")

    def _count(self, version: Version) -> int:
        open_ = [f for f in version.folders if f["rows"] is None]
        return sum(f["rows"] or 0 for f in version.folders) + (self._rows(version, open_).count() if open_ else 0)

    # reading

    def read(self, number: int | None = None) -> DataFrame:
        return self._rows(self.version(number))

    def _rows(self, version: Version, folders: Sequence[dict] | None = None) -> DataFrame:
        folders = version.folders if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*[f"{self.path}/{f['path']}" for f in folders])

    def publish(self, name: str, number: int | None = None) -> DataFrame:
        """Put a version under a catalog name; the name changes over at once, whatever the columns are."""
        version = self.version(number)
        parts = []
        for f in version.folders:
            where = f"parquet.`{self.path}/{f['path']}`"
            held = set(self.spark.table(where).columns)
            parts.append(f"SELECT {_casts(version.schema, held)} FROM {where}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + (" UNION ALL ".join(parts) or f"SELECT {_casts(version.schema, set())} WHERE FALSE"))
        return self.spark.table(name)

    # writing

    def _write(self, df: DataFrame, by_part: bool = False) -> list[dict]:
        folder = f"data/{uuid.uuid4().hex}"
        where = f"{self.path}/{folder}"
        if not by_part:
            df.write.parquet(where)
            return [{"path": folder, "part": None, "rows": self.spark.read.schema(df.schema).parquet(where).count()}]
        df.write.partitionBy(PART).parquet(where)  # counted when somebody asks: a merge is to be quick
        return [{"path": f"{folder}/{n}", "part": int(n.partition("=")[2]), "rows": None} for n in _parts(self.spark, where)]

    def replace(self, df: DataFrame, keys: Sequence[str] = (), time_key: str | None = None, **properties) -> Version:
        """New rows and new columns. keys: a null or repeated key is an error, found on what was written, and leaves the table as it was."""
        base, folders = self.version(), self._write(df)
        unsure = [*keys, time_key] if time_key else list(keys)
        if keys and not key_audit(self.spark.read.schema(df.schema).parquet(f"{self.path}/{folders[0]['path']}"), unsure).isEmpty():
            small_files.remove(self.spark, f"{self.path}/{folders[0]['path']}")
            raise ValueError(f"{self.path}: NULL or repeated key in {unsure}")
        held = properties | ({"keys": list(keys)} if keys else {}) | ({"time_key": time_key} if time_key else {})
        return self._commit(base, "replace", df.schema, folders, held)

    def append(self, df: DataFrame) -> Version:
        """More rows; columns that the table lacks are added, and read as NULL in older rows."""
        base = self.version()
        known = {f.name: f for f in base.schema.fields}
        for f in df.schema.fields:
            if f.name in known and known[f.name].dataType != f.dataType:
                raise ValueError(f"{self.path}: column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
        schema = StructType([*base.schema.fields, *(f for f in df.schema.fields if f.name not in known)])
        return self._commit(base, "append", schema, [*base.folders, *self._write(df)], base.properties)

    def delete(self, pred: Column) -> Version:
        """DELETE WHERE: rows for which pred is true go. Folders without such rows are kept as they are."""
        base, hit = self.version(), F.coalesce(pred, F.lit(False))
        if not base.folders:
            return base
        folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
        found = {r[0] for r in self._rows(base).filter(hit).select(folder).distinct().collect()}
        touched = [f for f in base.folders if any(where.endswith(f"/{f['path']}") for where in found)]
        kept = [f for f in base.folders if f not in touched]
        for f in touched:
            new = self._write(self._rows(base, [f]).filter(~hit))[0]
            kept += [new | {"part": f["part"]}] if new["rows"] else []
        return self._commit(base, "delete", base.schema, kept, base.properties)

    def merge(self, df: DataFrame, keys: Sequence[str], part: Column, **properties) -> Version:
        """Rows of df take the place of those with the same keys. part: a number that depends on the keys alone; only its
        values in df are rewritten. The keys of df are taken to be unique."""
        base = self.version()
        schema = base.schema if base.folders else df.schema
        folders = self._write(df.withColumn(PART, _number(part)).repartition(PART), True)
        if not folders and base.number:  # nothing to change
            return base
        touched = {f["part"] for f in folders}
        old = [f for f in base.folders if f["part"] in touched]
        if old:  # what stays of the parts that were touched is written with the new rows, once these are known
            new = self._rows(Version(0, "merge", schema, tuple(folders)))
            stay = self._rows(base, old).join(new.select(*keys), list(keys), "left_anti")
            whole = new.unionByName(stay.select(*new.columns)).withColumn(PART, _number(part))
            first = folders[0]["path"].rpartition("/")[0]
            folders = self._write(whole.repartition(PART), True)
            small_files.remove(self.spark, f"{self.path}/{first}")
        return self._commit(base, "merge", schema, [*(f for f in base.folders if f not in old), *folders], {**base.properties, **properties})

    def vacuum(self, keep: int = 1) -> int:
        """Remove the manifests before the newest `keep` and all folders that the kept ones do not name. Returns how many folders went.

        Not to be run beside a writer, whose folder no manifest names yet.
        """
        numbers = self.numbers()
        for n in numbers[:-keep]:
            small_files.remove(self.spark, self._manifest(n))
        named = {f["path"] for v in map(self.version, numbers[-keep:]) for f in v.folders}
        gone = 0
        for top in small_files.names(self.spark, f"{self.path}/data"):
            folder = f"data/{top}"
            if folder in named:
                continue
            inner = {p for p in named if p.startswith(f"{folder}/")}
            for path in [folder] if not inner else [f"{folder}/{n}" for n in _parts(self.spark, f"{self.path}/{folder}") if f"{folder}/{n}" not in inner]:
                small_files.remove(self.spark, f"{self.path}/{path}")
                gone += 1
        return gone


def _number(part: Column) -> Column:
    """Rows without a part share one of their own."""
    return F.coalesce(part.cast("long"), F.lit(-(1 << 62)))


def _casts(schema: StructType, held: set[str]) -> str:
    """The columns of a version from files that may lack some of them."""
    return ", ".join(f"CAST({f'`{f.name}`' if f.name in held else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)


def _parts(spark: SparkSession, folder: str) -> list[str]:
    fs, where = small_files._at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith(f"{PART}="))
