"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark.session import scratch_path

#: Words handled at a time by the vectorised steps: bounds a worker's memory for any batch.
WORDS_AT_ONCE = 400_000

#: Bytes of a batch that a worker handles at once.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark then removes an execution's shuffle files as soon as it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder of ``spark.checkpoint.dir`` and read back: a durable cut.

    Nothing reads the shuffles of the write again, so they are not left on the disks.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP)
    conf.set(CLEAN_UP, "true")
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        return df.sparkSession.read.parquet(path)
    finally:
        conf.set(CLEAN_UP, before)


def dropped(*tables: DataFrame) -> None:
    """Remove the files of ``stored`` tables that nothing will read again."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(folder))
            path.getFileSystem(conf).delete(path, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores before it while the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def per_row(
    df: DataFrame,
    inputs: list[Column],
    work: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: list[T.StructField],
    carry: list[Column] | None = None,
) -> DataFrame:
    """Append columns computed batch by batch in Arrow; all other columns pass through.

    The given row (or the columns ``carry`` of it) travels as one struct, so its names cannot
    clash with ``inputs``, which reach ``work`` as columns named 0, 1, ... ``fields`` must not be
    names of the table.
    """
    packed = df.select(
        F.struct(*([df[f"`{c}`"] for c in df.columns] if carry is None else carry)).alias("row"),
        *[c.alias(str(i)) for i, c in enumerate(inputs)],
    )
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            new = work(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[new[n] for n in names]], names=["row", *names]
            )

    schema = T.StructType([packed.schema["row"], *fields])
    return packed.mapInArrow(run, schema).select("row.*", *[F.col(f"`{n}`") for n in names])


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of about ``limit`` bytes, one row at least."""
    for batch in batches:
        rows = max(1, batch.num_rows * limit // max(batch.nbytes, limit))
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def texts_of(batch: pa.RecordBatch, at: str = "0") -> list[str]:
    """A text column as strings; null reads as empty."""
    return [t or "" for t in batch.column(at).to_pylist()]


def in_portions(sizes: list[int], limit: int = WORDS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items, each closed once its sizes reach the limit."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)
