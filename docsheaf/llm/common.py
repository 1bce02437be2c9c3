"""What several operators share: words, byte strings, batches and staged tables."""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsheaf.session import materialize, small_batches, workspace

#: Between words lie the six ASCII white-space characters and nothing else.
BLANKS = "[\\x20\\x09-\\x0D]+"

#: Bytes of strings that a function is given at once, but for a row that has more.
BATCH_BYTES = 8 << 20
#: Bytes of a batch that Spark sends to Python.
ARROW_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark, ARROW_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: no later step computes it again."""
    small_batches(df.sparkSession, ARROW_BYTES)
    return materialize(df, workspace(df.sparkSession, name))


def as_written(df: DataFrame) -> DataFrame:
    """The rows of a written table in the order of its files' names and within them.

    Spark deals out files by size, so a table that was written in order is not read in
    order. A table that was not read from files has the order of its partitions already.
    """
    at = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    try:
        rows = df.select(F.struct("*").alias("row"), *at)
    except AnalysisException:
        return df
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # of the names, "part-" and a number, which outgrows its five digits
    number = F.coalesce(F.regexp_extract("_file", r"^part-([0-9]+)", 1).try_cast("bigint"), F.lit(-1))
    order = ["_part", "_file", "_at"]
    dealt = rows.withColumn("_part", number).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return dealt.select("row.*")


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts in order, and where each text's words begin.

    The second part has one more entry than there are texts.
    """
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0)
    # a text that begins or ends with blanks has empty words there
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return flat.filter(filled), before[offsets]


def string_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, end to end, and their offsets."""
    wide = pa.types.is_large_string(words.type)
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return raw, at - at[0]


def per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of ``values`` over each text, given where each text begins."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on and shares its executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def cuts(part: pa.RecordBatch, rows: int) -> Iterator[tuple[int, int]]:
    """Where a batch is cut: after ``rows`` rows, or before the strings in it pass ``BATCH_BYTES``."""
    size = np.zeros(part.num_rows, np.int64)
    for column in part.columns:
        for values in column.flatten() if pa.types.is_struct(column.type) else [column]:
            if pa.types.is_string(values.type) or pa.types.is_binary(values.type):
                size += pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(size), 0
    while at < part.num_rows:
        room = (ends[at - 1] if at else 0) + BATCH_BYTES
        end = min(at + rows, int(np.searchsorted(ends, room, side="right")))
        yield at, max(end, at + 1)
        at = max(end, at + 1)


def batches(function, columns: list[str], rows: int = 512):
    """For mapInArrow: apply ``function`` to every batch, some rows at a time, which bounds its memory."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, end in cuts(part, rows):
                yield from pa.table(function(part.slice(at, end - at)), names=columns).to_batches()
            give_back()

    return run
