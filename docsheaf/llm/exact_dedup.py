"""Exact duplicates by a content sort.

Texts are equal when they agree after deleting white space. Rows are dealt out
by sampled splitters over the beginning of the normalised bytes and their
digest, then length and identifier, and sorted within their partition, so equal
texts lie next to each other, the one to keep first. Neighbours are compared in
full. As length and identifier are part of the range key, a text that a third
of all rows share is cut over many partitions; a chain over the partitions'
first and last runs joins it again.

Null texts count as empty; empty texts are one group. A null identifier sorts
first. Repeated rows stay one row each, one of them kept. An empty table gives
an empty table. Other columns, whatever their names, are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsheaf.llm.common import staged

#: Bytes of a text that serve as range key: splitters are sampled to the driver,
#: so whole texts must not be part of them.
PREFIX_CHARS = 32

RUNS = (
    "doc_id bigint, text_sha256 string, part int, run bigint, head bigint, size bigint, "
    "leads boolean, edge boolean, edge_text string"
)
RUN_COLUMNS = [column.split()[0] for column in RUNS.split(", ")]


def normalised(text):
    """The text without white space."""
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


def _emit(part: int, run: int, sizes: np.ndarray, ids: pa.Array, digests: pa.Array, edge_text=None):
    """Rows of whole runs, numbered from ``run``; with ``edge_text``, the first is an edge."""
    starts = np.cumsum(sizes) - sizes
    n = len(ids)
    leads = np.zeros(n, bool)
    leads[starts] = True
    at_edge = np.arange(n) < (sizes[0] if edge_text is not None else 0)
    texts = [edge_text, *[None] * (n - 1)]
    columns = [
        ids, digests, np.full(n, part, np.int32), np.repeat(run + np.arange(len(sizes)), sizes),
        ids.take(pa.array(np.repeat(starts, sizes))), np.repeat(sizes, sizes), leads, at_edge,
        pa.array(texts, pa.string()),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], RUN_COLUMNS)


def _runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition.

    Only identifiers are held of the run that may go on in the next batch. The
    first and the last run of the partition may go on beyond it; one row of
    each carries the text.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    run, held, text, digest = 0, [], None, None

    def close(edge: bool):
        ids = pa.concat_arrays(held)
        digests = pa.array([digest] * len(ids), pa.string())
        return _emit(part, run, np.array([len(ids)]), ids, digests, text if edge else None)

    for batch in parts:
        if not batch.num_rows:
            continue
        # a copy, so that what is held does not keep the texts of its batch
        ids, norm, sha = pc.add(batch.column("doc_id"), 0), batch.column("norm"), batch.column("text_sha256")
        differs = pc.not_equal(norm.slice(1), norm.slice(0, len(norm) - 1))
        cuts = np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1
        bounds = np.concatenate([[0], cuts, [batch.num_rows]])
        if held and norm[0].as_py() == text:
            held.append(ids.slice(0, bounds[1]))
            if len(bounds) == 2:
                continue
            bounds = bounds[1:]
        if held:
            yield close(run == 0)
            run += 1
        lo, hi = int(bounds[0]), int(bounds[-2])
        if hi > lo:
            first = norm[lo].as_py() if run == 0 else None
            sizes = np.diff(bounds[:-1])
            yield _emit(part, run, sizes, ids.slice(lo, hi - lo), sha.slice(lo, hi - lo), first)
            run += len(sizes)
        held, text, digest = [ids.slice(hi)], norm[hi].as_py(), sha[hi].as_py()
    if held:
        yield close(True)


def exact_duplicates(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per document.

    Of equal texts the row with the most characters before normalising, then
    the smallest identifier, stays.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.char_length(text).alias("chars"),
        normalised(text).alias("norm"),
    ).select(
        "*", F.sha2("norm", 256).alias("text_sha256"), F.left("norm", F.lit(PREFIX_CHARS)).alias("prefix")
    )
    key = ["prefix", "text_sha256", F.desc("chars"), "doc_id"]
    ordered = rows.repartitionByRange(partitions, *key).sortWithinPartitions(*key)
    runs = staged(
        ordered.select("doc_id", "norm", "text_sha256").mapInArrow(_runs, RUNS), "runs"
    )

    # per partition: its last run, and whether its first run goes on the one before
    edges = runs.filter("edge_text is not null").select(
        "part", "run", "head", "size", F.col("edge_text").alias("body")
    )
    span = edges.groupBy("part").agg(F.max("run").alias("last"))
    # one narrow row per partition
    span = span.withColumn("previous", F.lag("part").over(Window.orderBy("part")))
    ends = edges.join(span, "part")
    first = ends.filter("run = 0").select("part", "previous", "body")
    final = ends.filter("run = last").select(F.col("part").alias("previous"), F.col("body").alias("other"))
    goes_on = first.join(final, "previous").filter("body = other").select("part", F.lit(True).alias("goes_on"))
    # the chain of a run that fills whole partitions begins at its first partition
    table = edges.drop("body").join(goes_on, "part", "left").withColumn(
        "starts", ~((F.col("run") == 0) & F.coalesce("goes_on", F.lit(False)))
    )
    by_order = Window.orderBy("part", "run")
    table = table.withColumn("chain", F.sum(F.col("starts").cast("int")).over(by_order))
    groups = table.groupBy("chain").agg(
        F.min_by("head", F.struct("part", "run")).alias("chain_head"), F.sum("size").alias("chain_size")
    )
    chained = table.join(groups, "chain").select("part", "run", "starts", "chain_head", "chain_size")

    # at most two rows per partition, so this side is small at any size of the input
    joined = runs.join(F.broadcast(chained), ["part", "run"], "left")
    edge = F.col("edge")
    return joined.select(
        "doc_id",
        F.when(edge, F.col("chain_head")).otherwise(F.col("head")).alias("keep_id"),
        F.when(edge, F.col("chain_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("leads") & (~edge | F.col("starts"))).alias("kept"),
        "text_sha256",
    )
