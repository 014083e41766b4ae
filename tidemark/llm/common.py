"""What the operators of this subpackage share: reading tables, Arrow batches of texts, written intermediate tables."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.session import shared_dir

# Bytes of one Arrow batch sent to a Python worker, whatever the length of the texts.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows, so that long texts don't add up in a worker."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    current = spark.conf.get(setting, None)
    if current is None or not str(current).isdigit() or int(current) > BATCH_BYTES:
        spark.conf.set(setting, str(BATCH_BYTES))


_FOLDERS: dict[str, list[str]] = {}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; ``drop_work`` removes all of them."""
    owned = _FOLDERS.setdefault(spark.sparkContext.applicationId, [])
    if not owned:
        owned.append(f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}")
    return f"{owned[0]}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: a lost executor then costs no recomputation."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_work(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application. Frames that read them can't be used afterwards."""
    for folder in _FOLDERS.pop(spark.sparkContext.applicationId, []):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def let_go() -> None:
    """Give memory that is no longer used back to the system: an idle Python worker keeps what it has."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


# Bytes of texts that a function wrapped by ``thrifty`` gets at a time.
RUN_BYTES = 1 << 20


def runs(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch cut so that the texts in one of its columns have some RUN_BYTES, or there is one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))
    low = 0
    while low < batch.num_rows:
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + RUN_BYTES, "right")))
        yield batch.slice(low, high - low)
        low = high


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def thrifty(run: Work, text: int | None = None) -> Work:
    """A function for mapInArrow that gives memory back when a task ends; ``text`` is the column of texts to cut batches by."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches if text is None else (part for batch in batches for part in runs(batch, text)))
        let_go()

    return work


def per_text(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.Array], list]],
    outputs: str,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Map each text to the columns ``outputs`` (DDL), beside its key.

    ``make`` runs once per task and returns a function from an Arrow array of texts to one list or array per
    output column. Only ``key`` and ``text`` are read, so further columns of docs may have any name.
    """
    bound_batches(docs.sparkSession)
    out = fields(outputs)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *out])
    kinds = [to_arrow_type(x.dataType) for x in out]
    names = [x.name for x in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                columns = [pa.array(c, k) for c, k in zip(work(batch.column(1)), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)
        del work
        let_go()

    found = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    return found.withColumnRenamed("key", key)


def reference(key: str, text: str) -> F.Column:
    """A name for the rows of one key and text, by which the text can be found again."""
    whole = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    return F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("~"), whole)


# Bits of the filter below: 4 MB, whatever the number of values.
FILTER_BITS = 1 << 25


def may_be_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose value is among the wanted ones, and a few others: an exact join can follow on what is left.

    The hashes of the wanted values are marked in bitmaps of fixed total size, which are small enough to be sent to
    all executors; so long columns of other rows need not be shuffled for that join.
    """
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    marks = wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    maps = written(marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")), "filter")
    at = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("place", place).withColumn("bucket", F.bitmap_bucket_number("place"))
    found = found.join(F.broadcast(maps), "bucket").withColumn("byte", byte)
    return found.where(F.expr("(shiftright(byte, cast(bitmap_bit_position(place) % 8 as int)) & 1) = 1")).select(*rows.columns)


def word_table() -> bytes:
    """Byte table for words of digits, letters and bytes of other scripts: A-Z in lower case, the rest a space."""
    table = bytearray(range(256))
    for i in range(128):
        c = chr(i)
        table[i] = ord(c.lower()) if c.isdigit() or c.isalpha() else 32
    return bytes(table)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
