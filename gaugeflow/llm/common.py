"""What the text operators share: tables, files in the shared folder, batches of texts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import fresh_dir

#: Words are runs of anything but these bytes: space, tab, line feed, vertical tab, form feed,
#: carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"

#: Text bytes that a task looks at together.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, named doc_id (long) and text (null: empty).

    Whatever else the input carries, also under names used inside the operators, is left behind.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """The frame after a round through a table in the shared folder: cuts its lineage."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Column of `row_keys`.
ROW_KEY = "_row_key"


def row_keys(docs: DataFrame) -> DataFrame:
    """Adds a number of its own to every row, in the order of doc_id, with missing ones last.

    It is doc_id where that tells all rows apart. Else the rows are sorted and stored with it.
    """
    alike = docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1")
    if alike.isEmpty():
        return docs.withColumn(ROW_KEY, F.col("doc_id").cast("long"))
    # Stored before sorting, so that equal ids have an order too and many of them split.
    placed = stored(docs.withColumn(ROW_KEY, F.monotonically_increasing_id()), "rows")
    ordered = placed.orderBy(F.col("doc_id").asc_nulls_last(), ROW_KEY)
    return stored(ordered.withColumn(ROW_KEY, F.monotonically_increasing_id()), "row-keys")


def words(text: Column) -> Column:
    """The words of a text; none for null and for blank texts."""
    inner = F.regexp_replace(text, f"^{SPACE_RUN}|{SPACE_RUN}$", "")
    return F.when(F.length(inner) > 0, F.split(inner, SPACE_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in the shared folder (file:, hdfs:, s3: ...)."""
    return pafs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> tuple[str, pa.NativeFile]:
    """A new output file under a name that no other attempt of the task uses.

    An index written by Spark names the files that count, so what a lost or repeated attempt
    leaves behind is never read.
    """
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return name, system.open_output_stream(f"{path}/{name}", compression=None)


def cut_batches(
    batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about limit bytes of text, or of one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch[text_col]).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64)) // limit
        edges = np.flatnonzero(np.diff(group)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which may not have it installed.

    Also lets rows travel in small batches, as texts and blocks of texts are long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{2 * BATCH_BYTES}b")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in root.rglob("*.py"):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def arrow_map(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow with functions of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(work, schema)


def one_by_one(
    batches: Iterator[pa.RecordBatch], columns: list[str]
) -> Iterator[tuple[pa.RecordBatch, dict]]:
    """Each row as a batch and its columns as Python objects; the row before is given back first."""
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            yield one, one.select(columns).to_pylist()[0]
            give_back()


def give_back() -> None:
    """Returns freed memory to the system: workers live on, beside others in one executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


#: Where the C library has it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together and the offsets of each text (one more than texts)."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    every = np.frombuffer(data, np.uint8)
    return every[ends[0] : ends[-1]], ends - ends[0]


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))
