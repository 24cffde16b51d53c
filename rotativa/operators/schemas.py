"""One schema for Parquet files of many layouts (C7).

Tasks read the footers; only the distinct layouts, and the folders that have each,
come to the driver.  A column's type is the least one that holds all of its types.
Names are compared without case, and the first spelling by code point is taken:

* whole numbers: the wider; whole and broken numbers: double; decimals: wide enough for both;
* a date and a moment: the moment; a moment with and one without a zone: the one with;
* structs: fields merged by name, elements of arrays and values of maps likewise;
* any other two types that have a text form (date and text, number and text): text.

A struct, array, map or binary beside another kind has no common type and is refused.

Files that the reader itself can widen (missing columns and fields, ``int`` to
``bigint``, ``float`` to ``double``) are all read in one scan with the table's types,
so filters reach the files.  Only layouts with other types have a scan of their own
and casts.
"""

from __future__ import annotations

import json
from collections import defaultdict
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from rotativa.session import discard, stored

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_BROKEN = (T.FloatType, T.DoubleType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)
_MOMENTS = (T.TimestampType, T.TimestampNTZType)
# what the reader of Parquet files does by itself
_WIDENED = {("int", "bigint"), ("float", "double")}


class NoCommonType(ValueError):
    """Two files have a column in types that nothing holds together."""


def _opened(key: str, systems: dict):
    """A file by its key as Spark lists it, in which no character is escaped."""
    scheme, _, rest = key.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem().open_input_file("/" + (rest or scheme).lstrip("/"))
    authority, _, path = rest.removeprefix("//").partition("/")
    root = f"{scheme}://{authority}/"
    if root not in systems:
        systems[root] = fs.FileSystem.from_uri(root)
    system, base = systems[root]
    return system.open_input_file(f"{base.rstrip('/')}/{path}")


def file_layouts(files: DataFrame) -> DataFrame:
    """(folder, layout, key) of Parquet files ``key``: each footer read in a task, the layout as JSON of its schema."""

    def read(batches):
        systems: dict = {}
        for batch in batches:
            keys = batch.column("key").to_pylist()
            layouts = []
            for key in keys:
                with _opened(key, systems) as file:
                    schema = pq.read_schema(file)
                layouts.append(json.dumps(_plain(from_arrow_schema(schema).jsonValue()), sort_keys=True))
            folders = [key.rpartition("/")[0] for key in keys]
            yield pa.RecordBatch.from_pydict({"folder": folders, "layout": layouts, "key": keys})

    keys = files.select("key").repartition("key")
    return keys.mapInArrow(read, "folder STRING, layout STRING, key STRING")


def _plain(schema: dict) -> dict:
    """Without what does not change the type: metadata and required fields."""
    if not isinstance(schema, dict):
        return schema
    made = {k: _plain(v) for k, v in schema.items() if k != "metadata"}
    if "fields" in made:
        made["fields"] = [_plain(field) for field in made["fields"]]
    for name in ("nullable", "containsNull", "valueContainsNull"):
        if name in made:
            made[name] = True
    return made | ({"metadata": {}} if "name" in made else {})


def common_type(one: T.DataType, other: T.DataType, name: str = "") -> T.DataType:
    """The least type that holds both."""
    if one == other:
        return one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return merged_schema([one, other], name)
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(common_type(one.elementType, other.elementType, f"{name}.element"))
    if isinstance(one, T.MapType) and isinstance(other, T.MapType):
        key = common_type(one.keyType, other.keyType, f"{name}.key")
        return T.MapType(key, common_type(one.valueType, other.valueType, f"{name}.value"))
    kinds = (one, other)
    if any(isinstance(kind, (T.NullType,)) for kind in kinds):
        return other if isinstance(one, T.NullType) else one
    if any(isinstance(kind, (*_NESTED, T.BinaryType)) for kind in kinds):
        raise NoCommonType(f"{name}: {one.simpleString()} and {other.simpleString()}")
    if all(kind in _WHOLE for kind in kinds):
        return max(kinds, key=_WHOLE.index)
    if all(isinstance(kind, T.NumericType) for kind in kinds):
        if any(isinstance(kind, _BROKEN) for kind in kinds):
            return T.DoubleType()
        return _decimal(*kinds)
    if all(isinstance(kind, (T.DateType, *_MOMENTS)) for kind in kinds):
        zoned = any(isinstance(kind, T.TimestampType) for kind in kinds)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    return T.StringType()


def _decimal(one: T.DataType, other: T.DataType) -> T.DataType:
    """Digits enough before and behind the point; double where a decimal would lose some before it."""
    shapes = [(k.precision, k.scale) if isinstance(k, T.DecimalType) else (_DIGITS[k.simpleString()], 0) for k in (one, other)]
    scale = max(s for _, s in shapes)
    precision = max(p - s for p, s in shapes) + scale
    return T.DecimalType(precision, scale) if precision <= 38 else T.DoubleType()


def merged_schema(layouts: list[T.StructType], name: str = "") -> T.StructType:
    """All columns of all layouts, in the order in which they first come, each with its common type."""
    types: dict[str, T.DataType] = {}
    spelled: dict[str, set[str]] = defaultdict(set)
    for layout in layouts:
        for column in layout.fields:
            low = column.name.lower()
            spelled[low].add(column.name)
            inner = f"{name}.{column.name}" if name else column.name
            types[low] = common_type(types[low], column.dataType, inner) if low in types else column.dataType
    return T.StructType([T.StructField(min(spelled[low]), kind) for low, kind in types.items()])


def _readable(own: T.DataType | None, wanted: T.DataType) -> T.DataType:
    """The type to read a column of a layout with: the wanted one where the reader can give it, else its own."""
    if own is None or own == wanted or (own.simpleString(), wanted.simpleString()) in _WIDENED:
        return wanted
    if isinstance(own, T.StructType) and isinstance(wanted, T.StructType):
        return _read_with(own, wanted)
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return T.ArrayType(_readable(own.elementType, wanted.elementType))
    if isinstance(own, T.MapType) and isinstance(wanted, T.MapType):
        return T.MapType(_readable(own.keyType, wanted.keyType), _readable(own.valueType, wanted.valueType))
    return own


def _read_with(layout: T.StructType, wanted: T.StructType) -> T.StructType:
    held = {column.name.lower(): column.dataType for column in layout.fields}
    return T.StructType([T.StructField(c.name, _readable(held.get(c.name.lower()), c.dataType)) for c in wanted.fields])


def _cast(value: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """A value read with one type in the other; both have the same fields."""
    if own == wanted:
        return value
    if isinstance(wanted, T.StructType):
        fields = [_cast(value[a.name], a.dataType, b.dataType).alias(b.name) for a, b in zip(own.fields, wanted.fields)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _cast(x, own.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda x: F.struct(_cast(x["key"], own.keyType, wanted.keyType), _cast(x["value"], own.valueType, wanted.valueType)),
        )
        return F.map_from_entries(pairs)
    return value.cast(wanted)


def read_reconciled(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """All rows of the files ``key`` below ``root`` with the merged schema and the partition columns of their folders.

    A folder whose files have one layout is read as a folder; files are only named
    one by one where a folder has several.
    """
    found = stored(file_layouts(files), "layouts")
    folders = found.groupBy("folder").agg(F.min("layout").alias("layout"), F.max("layout").alias("last"))
    whole = folders.where("layout = last").select("layout", F.col("folder").alias("path"))
    mixed = folders.where("layout <> last").select("folder").join(found, "folder").select("layout", F.col("key").alias("path"))
    units = whole.unionByName(mixed)
    paths = defaultdict(list)
    for layout, path in units.collect():
        paths[layout].append(path)
    discard(found)
    if not paths:
        raise ValueError(f"{root} has no files to take a schema from")
    layouts = {text: T.StructType.fromJson(json.loads(text)) for text in sorted(paths)}
    wanted = merged_schema(list(layouts.values()))
    scans = defaultdict(list)
    for text, layout in layouts.items():
        scans[_read_with(layout, wanted).json()] += paths[text]
    parts = []
    for text, own in sorted(scans.items()):
        schema = T.StructType.fromJson(json.loads(text))
        rows = spark.read.schema(schema).option("basePath", root).parquet(*sorted(own))
        further = [c for c in rows.columns if c.lower() not in {f.name.lower() for f in wanted.fields}]
        parts.append(
            rows.select(
                *(_cast(F.col(f"`{a.name}`"), a.dataType, b.dataType).alias(b.name) for a, b in zip(schema.fields, wanted.fields)),
                *further,
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
