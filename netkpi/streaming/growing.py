"""Streams of JSON lines whose fields grow: the schema is found in the data, kept in versions, and no value is lost.

Lines come in as text. Each batch is first looked at as a whole (the merged schema of all its lines, from partial
aggregates); new fields, also inside objects, make a new version of the stored schema before the batch is written. What does
not fit a field's type, and fields not taken up, stay as text in `_rescued` (an object that a column holds only in part stays there
whole, besides), and a line that is no JSON stays there
whole under `_line`. Each batch is written under the version it was read with; `read` brings all versions to the newest
columns and fills columns that were taken up later from what had been rescued.

Widening: a number field that meets fractions becomes double; an object gains fields; a field seen only empty gets the
first type it shows. Other types never change. JSON has no times: they come as text and are cast by the reader.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from netkpi.sources import small_files

RESCUED, WHOLE = "_rescued", "_line"


def found_schema(lines: DataFrame, column: str = "value") -> T.StructType:
    """The merged schema of all JSON lines; lines that are no JSON object add nothing."""
    text = lines.agg(F.expr(f"schema_of_variant_agg(try_parse_json({column}))")).first()[0] or "VOID"
    # lines that are not objects would hide the objects' fields
    if not text.startswith("OBJECT<"):
        objects = lines.filter(F.expr(f"schema_of_variant(try_parse_json({column})) LIKE 'OBJECT<%'"))
        text = objects.agg(F.expr(f"schema_of_variant_agg(try_parse_json({column}))")).first()[0] or "VOID"
    return _plain(T.DataType.fromDDL(_as_ddl(text))) if text.startswith("OBJECT<") and text != "OBJECT<>" else T.StructType()


def _as_ddl(text: str) -> str:
    """OBJECT becomes STRUCT outside of quoted names."""
    parts = re.split("(`(?:[^`]|``)*`)", text)
    return "".join(p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p).replace("STRUCT<>", "MAP<STRING, STRING>") for p in parts)


def _plain(kind: T.DataType) -> T.DataType:
    """Types to store: whole numbers long, others double, what varies or was never filled text (VOID is kept inside the ledger)."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.LongType() if kind.scale == 0 and kind.precision <= 18 else T.DoubleType()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return kind if isinstance(kind, (T.BooleanType, T.NullType, T.MapType)) else T.StringType()


def widened(old: T.DataType, new: T.DataType) -> T.DataType:
    """The stored type after another was seen."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in old.fields}
        more = {f.name: f.dataType for f in new.fields}
        fields = [T.StructField(n, widened(t, more[n]) if n in more else t) for n, t in known.items()]
        return T.StructType([*fields, *(T.StructField(n, t) for n, t in more.items() if n not in known)])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType))
    if isinstance(old, T.NullType):
        return new
    return T.DoubleType() if isinstance(old, T.LongType) and isinstance(new, T.DoubleType) else old


def _filled(kind: T.DataType) -> T.DataType:
    """Types to read with: what was never filled is text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _filled(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_filled(kind.elementType))
    return T.StringType() if isinstance(kind, T.NullType) else kind


class SchemaLedger:
    """Versions of a schema as small files, each with the batch that made it necessary. One stream writes a ledger."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in small_files.names(self.spark, self.path)]

    def stored(self, number: int | None = None) -> tuple[int, T.StructType]:
        """A version as it was found, the newest by default; version 0 has no fields."""
        number = max(self.numbers(), default=0) if number is None else number
        if not number:
            return 0, T.StructType()
        return number, T.StructType.fromJson(json.loads(small_files.read(self.spark, f"{self.path}/v{number:06d}.json"))["schema"])

    def schema(self, number: int | None = None) -> T.StructType:
        return _filled(self.stored(number)[1])

    def declare(self, schema: T.StructType, batch: int = -1) -> int:
        """Store a version if it differs from the newest; returns the number that holds now."""
        number, old = self.stored()
        if schema == old:
            return number
        text = json.dumps({"schema": schema.jsonValue(), "batch": batch})
        if not small_files.put(self.spark, f"{self.path}/v{number + 1:06d}.json", text):
            raise RuntimeError(f"{self.path}: version {number + 1} has been written by another stream")
        return number + 1

    def grow(self, found: T.StructType, batch: int = -1) -> int:
        return self.declare(widened(self.stored()[1], found), batch)

    def history(self) -> DataFrame:
        rows = []
        for n in self.numbers():
            held, before = self.stored(n)[1], set(self.stored(n - 1)[1].fieldNames())
            rows += [(n, f.name, _filled(f.dataType).simpleString(), f.name not in before) for f in held.fields]
        return self.spark.createDataFrame(rows, "version int, field string, type string, is_new boolean")


def parsed(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """The fields of a schema and `_rescued` (null if everything fits)."""
    text = F.col(column)
    raw = F.from_json(text, "map<string,string>")
    if not schema.fields:
        return lines.select(_kept(raw, text, F.array().cast("array<string>")).alias(RESCUED))
    row = lines.select(text.alias("_text"), F.from_json(text, schema).alias("_row"), raw.alias("_raw"))
    fits = F.array_compact(F.array(*[F.when(_whole(F.col("_row")[f.name], F.col("_raw")[f.name], f.dataType), F.lit(f.name)) for f in schema.fields]))
    return row.select(*[F.col("_row")[f.name].alias(f.name) for f in schema.fields],
                      _kept(F.col("_raw"), F.col("_text"), fits).alias(RESCUED))


def _whole(value: Column, raw: Column, kind: T.DataType) -> Column:
    """Does the value hold all of the text? An object or list does if it gives the same JSON again."""
    if not isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return value.isNotNull()
    again, given = (F.to_json(F.try_parse_json(x)) for x in (F.to_json(value), raw))
    return value.isNotNull() & F.coalesce(again == given, F.lit(False))


def _kept(raw: Column, text: Column, fits: Column) -> Column:
    left = F.map_filter(raw, lambda k, v: v.isNotNull() & ~F.array_contains(fits, k))
    no_json = F.try_parse_json(text).isNull() & (F.trim(text) != "")
    return F.when(raw.isNull() | no_json, F.when(F.coalesce(F.trim(text), F.lit("")) != "", F.create_map(F.lit(WHOLE), text))).when(F.size(left) > 0, left)


def start(spark: SparkSession, source: str, ledger: SchemaLedger, out: str, checkpoint: str, grow: bool = True,
          max_files: int | None = None, name: str | None = None) -> StreamingQuery:
    """Read new files of JSON lines, write them under the schema version and batch. A batch that is repeated replaces its own folder.

    grow: take up new fields; otherwise they are rescued until somebody declares them.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def keep(lines: DataFrame, batch: int) -> None:
        lines.persist()
        try:
            number = ledger.grow(found_schema(lines), batch) if grow else ledger.stored()[0]
            parsed(lines, ledger.schema(number)).write.mode("overwrite").parquet(f"{out}/schema_version={number}/batch_id={batch}")
        finally:
            lines.unpersist()

    writer = reader.load(source).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).foreachBatch(keep).start()


def _recovered(text: Column, kind: T.DataType) -> Column:
    """A rescued value in the type that its field has got; NULL if it doesn't fit."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, kind)
    return text.try_cast(kind)


def _as(column: Column, old: T.DataType, new: T.DataType) -> Column:
    """A stored value in its newer type: objects gain empty fields."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        held = {f.name: f.dataType for f in old.fields}
        parts = [(_as(column[f.name], held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in new.fields]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(column, lambda x: _as(x, old.elementType, new.elementType))
    return column.cast(new)


def read(ledger: SchemaLedger, out: str) -> DataFrame:
    """All rows in the newest columns, and `_rescued` with what no column holds."""
    spark, newest = ledger.spark, ledger.schema()
    whole = None
    for folder in small_files.names(spark, out):
        held = ledger.schema(int(folder.partition("=")[2]))
        rows = spark.read.schema(T.StructType([*held.fields, T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType()))])).parquet(
            f"{out}/{folder}/*")
        columns, taken = _columns(held, newest)
        left = F.map_filter(F.col(RESCUED), lambda k, v: ~F.array_contains(_names(f for f, c in taken), k)) if taken else F.col(RESCUED)
        for name, back in taken:  # a rescued value that does not fit its column stays where it is
            left = F.when(F.col(RESCUED)[name].isNotNull() & back.isNull(),
                          F.map_concat(F.coalesce(left, F.expr("cast(map() as map<string,string>)")), F.create_map(F.lit(name), F.col(RESCUED)[name]))).otherwise(left)
        rows = rows.select(*columns, F.when(F.size(left) > 0, left).alias(RESCUED))
        whole = rows if whole is None else whole.unionByName(rows)
    return whole if whole is not None else spark.createDataFrame([], T.StructType([*newest.fields]))


def _names(found: Iterable[str]) -> Column:
    return F.array(*[F.lit(n) for n in found])


def _columns(held: T.StructType, newest: T.StructType) -> tuple[list[Column], list[tuple[str, Column]]]:
    """Columns of the newest schema from rows of an older one, and those that come out of what was rescued."""
    old = {f.name: f.dataType for f in held.fields}
    columns, taken = [], []
    for f in newest.fields:
        back = _recovered(F.col(RESCUED)[f.name], f.dataType)
        if f.name in old and old[f.name] == f.dataType:
            columns.append(F.col(f.name))
            continue
        taken.append((f.name, back))
        columns.append((F.coalesce(back, _as(F.col(f.name), old[f.name], f.dataType)) if f.name in old else back).alias(f.name))
    return columns, taken
