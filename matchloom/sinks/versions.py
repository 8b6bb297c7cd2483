"""Days that are replaced at one stroke, with the schema each was written with.

Every replace writes a new folder below ``data/ds=.../``; what a day's folder is stands in a small file,
``current/<day>.json``, that is put in place by one rename. A reader sees a day's old folder or its new one and
never a part of either, and one that has begun goes on with the files it listed: folders are only removed by
``clean``, some time later.

The file holds the day's schema too. Reading merges the schemas of the days it reads: fields that a day lacks
are null, numbers widen, and a field whose types have nothing in common becomes a variant.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom import workspace
from matchloom.sinks.tables import balanced

#: Whole numbers by width; a value of one is a value of the later ones.
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
REAL = (T.FloatType(), T.DoubleType())
DS = T.StructField("ds", T.DateType())


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that has the values of both; a variant where none but that has."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for kinds in (WHOLE, REAL):
        if a in kinds and b in kinds:
            return max(a, b, key=kinds.index)
    if (a in WHOLE and b in REAL) or (a in REAL and b in WHOLE):
        # A double has all whole numbers of up to 53 bits; a long is not widened to it.
        return T.DoubleType() if T.LongType() not in (a, b) else T.VariantType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    return T.VariantType()


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both by name, ignoring case, those of ``a`` first; all nullable."""
    known = {f.name.lower(): f for f in b.fields}
    fields = [
        T.StructField(f.name, widened(f.dataType, known[f.name.lower()].dataType) if f.name.lower() in known else f.dataType)
        for f in a.fields
    ]
    mine = {f.name.lower() for f in a.fields}
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in b.fields if f.name.lower() not in mine]])


def plain(kind: T.DataType) -> T.DataType:
    """The type with everything nullable, so that equal types compare equal."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(plain(kind.keyType), plain(kind.valueType))
    return kind


def as_type(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if plain(have) == plain(want):
        return value
    if isinstance(want, T.VariantType):
        nested = isinstance(have, (T.StructType, T.ArrayType, T.MapType))
        return F.to_variant_object(value) if nested else value.cast("variant")
    if isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = [
            as_type(value.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in own
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda v: as_type(v, have.elementType, want.elementType))
    return value.cast(want)


def aligned(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with the columns of a merged schema."""
    own = {f.name.lower(): f for f in rows.schema.fields}
    return rows.select(
        *[
            as_type(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in own
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_folders(rows: DataFrame, path: str) -> dict[str, str]:
    """Write rows to a new folder per day (``ds``) that nobody reads yet; the folder of each day."""
    version = f"v={time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex}"
    stage = f"{path}/data/{version}"
    balanced(rows, "ds").write.partitionBy("ds").parquet(stage)
    days = [p.rsplit("ds=", 1)[1] for p in workspace.listed(rows.sparkSession, stage, "ds=")]
    return {day: f"data/{version}/ds={day}" for day in days}


def put(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file and rename it into place, over an older one."""
    jvm = spark.sparkContext._jvm
    fs, target = workspace.file_system(spark, path)
    _, written = workspace.file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(written)
    out.write(bytearray(content.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(written), fs.makeQualified(target), options)


def point(spark: SparkSession, path: str, folders: dict[str, str], schema: T.StructType) -> None:
    """From now on readers take these folders, one day after the other."""
    fields = T.StructType([f for f in schema.fields if f.name != "ds"])
    for day, folder in sorted(folders.items()):
        put(spark, f"{path}/current/{day}.json", json.dumps({"ds": day, "folder": folder, "schema": plain(fields).jsonValue()}))


def replace_days(rows: DataFrame, path: str) -> None:
    """Replace the days that occur in ``rows`` (``ds`` is a date) and keep all others."""
    point(rows.sparkSession, path, write_folders(rows, path), rows.schema)


def entries(spark: SparkSession, path: str, days: Sequence | None = None) -> list[dict]:
    """What each day's file says, in the order of days."""
    if not workspace.listed(spark, f"{path}/current"):
        return []
    found = spark.read.option("pathGlobFilter", "*.json").text(f"{path}/current", wholetext=True).collect()
    listed = sorted((json.loads(r["value"]) for r in found), key=lambda e: e["ds"])
    wanted = None if days is None else {str(d) for d in days}
    return [e for e in listed if wanted is None or e["ds"] in wanted]


def read_days(spark: SparkSession, path: str, days: Sequence | None = None) -> DataFrame:
    """The rows of all days, or of some, with the merged schema and ``ds``.

    Days of one schema are one scan. A table without days has no rows and only ``ds``.
    """
    listed = entries(spark, path, days)
    by_schema: dict[str, list[dict]] = {}
    for e in listed:
        by_schema.setdefault(json.dumps(e["schema"], sort_keys=True), []).append(e)
    kinds = {text: T.StructType.fromJson(json.loads(text)) for text in by_schema}
    if not kinds:
        return spark.createDataFrame([], T.StructType([DS]))
    whole = T.StructType([*reduce(merged, kinds.values()).fields, DS])
    parts = []
    for text, of in by_schema.items():
        folders: dict[str, list[str]] = {}
        for e in of:
            version = e["folder"].rsplit("/", 1)[0]
            folders.setdefault(version, []).append(f"{path}/{e['folder']}")
        for version, names in folders.items():
            reader = spark.read.schema(T.StructType([*kinds[text].fields, DS])).option("basePath", f"{path}/{version}")
            parts.append(aligned(reader.parquet(*names), whole))
    return reduce(DataFrame.unionAll, parts)


def clean(spark: SparkSession, path: str, hours: float = 24) -> list[str]:
    """Remove folders that no day stands for any more and that are older than any reader can be."""
    current = {e["folder"] for e in entries(spark, path)}
    limit = time.strftime("%Y%m%dT%H%M%S", time.gmtime(time.time() - hours * 3600))
    gone = []
    for version in workspace.listed(spark, f"{path}/data", "v="):
        name = version.rsplit("/", 1)[1]
        if name[2:].split("-")[0] > limit:
            continue
        for folder in workspace.listed(spark, version, "ds="):
            if f"data/{name}/{folder.rsplit('/', 1)[1]}" not in current:
                workspace.removed(spark, folder)
                gone.append(folder)
    return gone
