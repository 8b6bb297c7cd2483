"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Most rows of a batch that a Python task gets. Texts are long, and each task and the JVM beside it
#: hold a batch several times; the default of 10,000 rows would be some 100 MB each.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python tasks, for this session from here on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` does not have, ignoring case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Most rows of 64-bit ids that are broadcast; 8 bytes each and about 60 in a hash table.
BROADCAST_IDS = 1_000_000


def bounded(ids: DataFrame) -> DataFrame:
    """A one-column table of ids, with the broadcast hint if its counted rows are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def unit(value: Column) -> Column:
    """A number in [0, 1) that depends on the value alone, the same in every engine."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(
        float(2**32)
    )
