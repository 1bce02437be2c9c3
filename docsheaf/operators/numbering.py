"""Dense numbering of chunks over the whole collection.

A window over all rows would pull them into one task. Instead the running sum
is built level by level: keys are cut into blocks of 2**21 consecutive values,
sums run within a block, and the block totals are numbered the same way.
``doc_seq`` is unique, so no block at any level can hold more than 2**21 rows,
whatever the data. Only (key, count) pairs move, never text.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsheaf.session import materialize, workspace

BLOCK_BITS = 21
KEY_BITS = 63


def running_offsets(counts: DataFrame, key: str, value: str, level: int = 1) -> DataFrame:
    """``(key, before)``: the sum of ``value`` over all smaller keys. Keys are unique."""
    last = level * BLOCK_BITS >= KEY_BITS
    block, total = f"_block{level}", f"_total{level}"
    # never null, so the joins below infer no filters and all levels can share
    # one shuffle of the counts
    zero = F.lit(0).cast("bigint")
    above = zero if last else F.shiftright(F.coalesce(key, zero), BLOCK_BITS)
    running = counts.select(
        key, F.col(value).cast("bigint").alias("_value"), above.alias(block)
    ).withColumn("_upto", F.sum("_value").over(Window.partitionBy(block).orderBy(key)))
    before = F.col("_upto") - F.col("_value")
    if last:
        return running.select(key, before.alias("before"))
    # the running sum left each block in one partition: no shuffle for its total
    totals = running.groupBy(block).agg(F.max("_upto").alias(total))
    blocks = running_offsets(totals, block, total, level + 1)
    return running.join(blocks, block).select(key, (before + F.col("before")).alias("before"))


def chunk_offsets(chunks: DataFrame) -> DataFrame:
    """``(doc_seq, before)``: how many chunks precede each document.

    Call it on a written chunk table: only two narrow columns of it are read.
    """
    per_doc = chunks.filter(F.col("chunk_index") == 0).select("doc_seq", "total_chunks")
    return running_offsets(per_doc, "doc_seq", "total_chunks")


def number_chunks(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add the 1-based ``chunk_id``. ``rows`` may be any subset of the chunks,
    so numbers of chunks that failed stay unused."""
    return rows.join(offsets, "doc_seq").withColumn(
        "chunk_id", F.col("before") + F.col("chunk_index") + 1
    ).drop("before")


def dense_numbers(df: DataFrame, order: list[str], into: str, partitions: int | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of ``order``; equal rows in any order.

    Rows are dealt by sampled ranges and sorted. Each partition counts its rows,
    and the counts of those before it give its first number: a row for each
    partition comes to the driver, never the data. The rows are written first,
    as another run of the sort could cut its ranges elsewhere.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # within a partition these ids count up from a multiple of 2**33
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    local = dealt.withColumns({"_part": F.spark_partition_id(), "_row": row})
    local = materialize(local, workspace(spark, "numbered"))
    before, rows = 0, []
    for part, n in sorted(map(tuple, local.groupBy("_part").count().collect())):
        rows.append((part, before))
        before += n
    offsets = spark.createDataFrame(rows, "_part int, _before bigint")
    joined = local.join(F.broadcast(offsets), "_part")
    return joined.select(*df.columns, (F.col("_before") + F.col("_row")).alias(into))
