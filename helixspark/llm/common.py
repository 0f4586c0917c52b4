"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixspark.session import scratch_path

#: White space of the corpus contracts: space and U+0009..U+000D, as a Java class body.
SPACE = r" \t-\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "zstd", **options) -> DataFrame:
    """``df`` written once to a fresh table in the shared checkpoint folder and read
    back: later readers see the same rows whatever executors are lost. ``options`` are those
    of the writer."""
    path = f"{scratch_path(df.sparkSession, name)}-{uuid.uuid4().hex}"
    df.write.options(compression=compression, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[dict[str, pa.Array]], dict], schema: str | StructType) -> DataFrame:
    """``fn`` over Arrow batches: takes columns by name, returns columns (lists, numpy
    or Arrow arrays) of the same or another length for ``schema``."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            out = fn({n: b.column(i) for i, n in enumerate(b.schema.names)})
            yield to_batch(out, arrow)

    return df.mapInArrow(run, st)


def to_batch(out: dict, arrow: pa.Schema) -> pa.RecordBatch:
    cols = []
    for f in arrow:
        v = out[f.name]
        if isinstance(v, pa.ChunkedArray):
            v = v.combine_chunks()
        cols.append(v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, type=f.type))
    return pa.RecordBatch.from_arrays(cols, schema=arrow)


def texts_of(col: pa.Array) -> list[str]:
    """Python strings of an Arrow string column; null becomes the empty text."""
    return [x or "" for x in col.to_pylist()]


def crc_mod(col, mod: int):
    """``crc32`` of an id written as text, modulo ``mod``."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(mod))
