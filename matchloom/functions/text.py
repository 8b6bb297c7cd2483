"""String, map and JSON columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchloom import domain


def partition_value(path: Column, key: str = "ds") -> Column:
    """Value of ``key=value`` in a file path."""
    after = F.split_part(path, F.lit(f"{key}="), F.lit(2))
    return F.split_part(after, F.lit("/"), F.lit(1))


def normalize_host(host: Column, endings: Sequence[str] = domain.HOST_ENDINGS) -> Column:
    """Trim, take off the URL scheme in any case, take out the given endings."""
    bare = F.regexp_replace(F.trim(host), "(?i)^https?://", "")
    return reduce(lambda text, ending: F.replace(text, F.lit(ending), F.lit("")), endings, bare)


def mask_secrets(pairs: Column, mark: str = domain.SECRET_MARK) -> Column:
    """Mask map values whose key holds the mark in any case."""
    return F.transform_values(
        pairs,
        lambda key, value: F.when(F.upper(key).contains(mark), domain.SECRET_MASK).otherwise(value),
    )


#: Field of a record that holds its text where a part of it could not be parsed.
BROKEN = "_broken_text"


def to_record(text: Column, schema: StructType) -> Column:
    """JSON text to a record; text that can't be parsed gives a record of nulls."""
    return F.from_json(text, schema)


def to_checked_record(text: Column, schema: StructType) -> Column:
    """The same with a field ``BROKEN``, which is null only if every field was parsed."""
    checked = StructType([*schema.fields, StructField(BROKEN, StringType())])
    return F.from_json(text, checked, {"columnNameOfCorruptRecord": BROKEN})


def to_text(record: Column) -> Column:
    """Record to JSON text with null fields written out."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def variant_field(text: Column, path: str, dtype: str) -> Column:
    """One field of semi-structured text; null where the text is no JSON."""
    return F.try_variant_get(F.try_parse_json(text), path, dtype)
