"""Repeated runs of lines: a suffix array over line numbers by prefix doubling.

A line goes if it lies in a run of consecutive lines of at least ``MIN_WORDS``
words whose lines appear in the same order at an earlier place; a place is
earlier by identifier, then by line. Lines without a word neither count nor
break a run, and stay.

Lines that occur once end every repeated run, so only the others are numbered,
in the order of their digests. Doubling then ranks the suffixes that start at
each line by their first 2, 4, 8, ... lines: a rank is the place of a pair of
earlier ranks among all sorted pairs. It ends as soon as every common prefix
that matters is long enough: a run of ``MIN_WORDS`` words has at most as many
lines. Two overlapping ranks give the suffixes that share a prefix of any
length, the intervals of a longest-common-prefix table; of each interval the
first suffix stays.

Intervals are looked up only for the shortest runs of enough words that start
or end at a line. Any line of a repeated run lies in one of them that is
repeated too, so nothing else needs to be known about longer runs.

Counts combine before every shuffle, and a pair that very many documents share
is split by Spark's skew join; no group is ever gathered. Null texts count as
empty. Rows equal in identifier and text are one document and are treated
alike. A null identifier comes first. An empty table gives an empty one.
Further columns pass through unread, whatever their names.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsheaf.llm.common import batches, split_words, staged
from docsheaf.operators.numbering import dense_numbers

MIN_WORDS = 50

KEY = ["doc", "digest"]
LINES = "doc bigint, digest bigint, i bigint, h1 bigint, h2 bigint, sizes array<bigint>"


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with the key of their document and the whole text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(text).alias("digest"),
        text.alias("body"),
    )


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All lines of a batch, where each text's begin, and the words of each line."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    _, at = split_words(lines)
    return lines, lists.offsets.to_numpy() - lists.offsets[0].as_py(), np.diff(at)


def shortest_runs(words: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``(line, lines)``: the runs of at least ``least`` words that are the shortest from
    their first or to their last line, within one text, by first line."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = np.diff(starts)
    own = np.arange(len(words))
    begin, end = np.repeat(starts[:-1], n), np.repeat(starts[1:], n)
    last = np.searchsorted(total, total[:-1] + least, side="left") - 1
    ahead = last < end
    first = np.searchsorted(total, total[1:] - least, side="right") - 1
    back = first >= begin
    line = np.concatenate([own[ahead], first[back]])
    size = np.concatenate([(last - own)[ahead], (own - first)[back]]) + 1
    code = np.unique(line * (least + 1) + size)
    return code // (least + 1), code % (least + 1)


def _lines(least: int, part: pa.RecordBatch):
    import xxhash

    lines, edges, words = split_lines(part.column("body"))
    filled = words > 0
    starts = np.concatenate([[0], np.cumsum(filled)])[edges]
    kept = lines.filter(pa.array(filled)).to_pylist()
    both = np.array([divmod(xxhash.xxh3_128_intdigest(line), 1 << 64) for line in kept], np.uint64)
    both = both.reshape(-1, 2).view(np.int64)
    line, size = shortest_runs(words[filled], starts, least)
    offsets = np.searchsorted(line, np.arange(len(kept) + 1)).astype(np.int32)
    n = np.diff(starts)
    text = pa.array(np.repeat(np.arange(len(n)), n))
    return [
        part.column("doc").take(text),
        part.column("digest").take(text),
        np.arange(len(kept)) - np.repeat(starts[:-1], n),
        both[:, 0],
        both[:, 1],
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(size)),
    ]


def _ranked(rows: DataFrame, pair: list[str], rank: str, partitions: int) -> DataFrame:
    """Add the 1-based rank of each repeated pair among all of them; null where it occurs once."""
    repeated = rows.filter(F.col(pair[0]).isNotNull() & F.col(pair[1]).isNotNull()).groupBy(*pair).count()
    order = dense_numbers(repeated.filter("count > 1").select(*pair), pair, rank, partitions)
    return rows.join(order.withColumn(rank, F.col(rank) + 1), pair, "left")


def repeated_runs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``(doc, digest, i, size)``: runs that are a later copy, by their first line and lines.

    Lines without a word are not counted.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [c.split()[0] for c in LINES.split(", ")]
    lines = staged(
        keyed(docs).select("doc", "digest", "body").mapInArrow(batches(partial(_lines, least), columns), LINES), "lines"
    )
    rows = _ranked(lines, ["h1", "h2"], "r1", partitions).filter("r1 is not null")
    rows = staged(rows.drop("h1", "h2").dropDuplicates([*KEY, "i"]), "line-ranks")
    longest = rows.agg(F.max(F.array_max("sizes"))).first()[0] or 0

    in_order, size = Window.partitionBy(*KEY).orderBy("i"), 1
    while 2 * size <= longest:
        after = F.lead(F.struct("i", f"r{size}"), size).over(in_order)
        # only where all lines up to there are repeated ones
        ahead = rows.withColumn("_after", after).withColumn(
            "_next", F.when(F.col("_after.i") == F.col("i") + size, F.col(f"_after.r{size}"))
        )
        ahead = ahead.drop("_after").withColumn("_own", F.col(f"r{size}"))
        rows = _ranked(ahead, ["_own", "_next"], f"r{2 * size}", partitions).drop("_own", "_next")
        rows = staged(rows, "suffix-ranks")
        size *= 2

    levels = [1 << k for k in range(size.bit_length())]
    ranks = F.array(*[F.col(f"r{level}") for level in levels])
    runs = rows.select(*KEY, "i", F.explode("sizes").alias("size"), ranks.alias("ranks"))
    level = F.floor(F.log2("size") + 1e-9).cast("int")
    runs = runs.withColumn("level", level).withColumn("a", F.get("ranks", F.col("level"))).filter("a is not null")
    runs = runs.withColumn("_at", F.col("i") + F.col("size") - F.expr("shiftleft(1, level)"))
    ends = rows.select(*KEY, F.col("i").alias("_at"), ranks.alias("_ranks"))
    named = staged(
        runs.join(ends, [*KEY, "_at"])
        .withColumn("b", F.get("_ranks", F.col("level")))
        .filter("b is not null")
        .select(*KEY, "i", "size", "a", "b"),
        "runs",
    )
    first = named.groupBy("size", "a", "b").agg(
        F.min(F.struct(*KEY, "i")).alias("first"), F.count("*").alias("n")
    )
    # written, so that the join below has plain shuffles on both sides and can be split
    first = staged(first.filter("n > 1"), "intervals")
    later = named.join(first, ["size", "a", "b"])
    return later.filter(F.struct(*KEY, "i") != F.col("first")).select(*KEY, "i", "size")


def _cut(part: pa.RecordBatch):
    lines, edges, words = split_lines(part.column("body"))
    runs = part.column("runs")
    texts, counts, gone = [], [], []
    for k in range(part.num_rows):
        own = lines.slice(edges[k], edges[k + 1] - edges[k])
        at = np.flatnonzero(words[edges[k] : edges[k + 1]])
        change = np.zeros(len(at) + 1, np.int64)
        for run in runs[k].as_py() or ():
            change[run["i"]] += 1
            change[run["i"] + run["size"]] -= 1
        dropped = at[np.cumsum(change)[:-1] > 0]
        keep = np.ones(len(own), bool)
        keep[dropped] = False
        texts.append("\n".join(own.filter(pa.array(keep)).to_pylist()))
        counts.append(len(at))
        gone.append(len(dropped))
    return [part.column("row"), pa.array(texts, pa.string()), np.array(counts), np.array(gone)]


def without_repeated_runs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``row`` with the columns of ``docs``, ``text`` without later copies, ``n_lines``
    (with a word) and ``n_removed``."""
    runs = staged(repeated_runs(docs, least), "later-runs")
    per_doc = runs.groupBy(*KEY).agg(F.collect_list(F.struct("i", "size")).alias("runs"))
    joined = keyed(docs).join(per_doc, KEY, "left")
    changed = T.StructType(
        [
            T.StructField("row", docs.schema), T.StructField("text", T.StringType()),
            T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType()),
        ]
    )
    return joined.select("row", "body", "runs").mapInArrow(
        batches(_cut, ["row", "text", "n_lines", "n_removed"]), changed
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("row.doc_id", "text", "n_lines", "n_removed")
