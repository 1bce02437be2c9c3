"""Interleaving sources to target weights by Pfair scheduling.

A source's documents, in an order made by a hash, are cut into blocks of
``BLOCK_WORDS`` words; a document belongs to the block in which it begins. A
source of weight w gets block i no sooner than slot floor((i-1)/w) and before
slot ceil(i/w), and of the blocks released the one with the earliest deadline
takes a slot. Weights that add up to one always meet all deadlines, so at any
slot every source is within one block of its share.

Every source is scheduled by its own weight, however many there are, with sources that
run out as part of the schedule. In virtual time a source of weight w has had w x v blocks
at v, up to all it has, and a slot is as much virtual time as gives the sources left one
block together. Virtual time is cut in frames of about ``RESOLUTION`` slots. A block is in
the frame in which a fixed point of it lies, so at the end of a frame every source has had
its weight times one common factor, rounded up or down. Within a frame the blocks of a
source are released and due as in virtual time: up to its end, or up to the source's,
if that is sooner, and at any slot of a frame every source is within one block of its
share of it, so within two blocks of its weight times a factor that all have in common. Frames are scheduled by themselves: no task sees all blocks, and nothing but
the sum of the weights comes to the driver. With ``whole=False`` the mixture ends when
the first source runs out; documents that begin later are not ``in_mix``.

A caller who gives the ``resolution`` has weights rounded to multiples of one slot in a
period of so many, which is made once, on the driver; it has at least a slot for each
source. That mixture ends at the first slot whose source has no block left, unless
``whole=True`` asks for new phases: in each the sources left go on at their weights.

A caller who asks for ``alike=True`` has sources put in classes by the magnitude of their
blocks and weights, ``GRAIN`` parts of an octave: weights of a class differ by less than a
fifth, and its members get equal shares, not their own. A class takes part in phases as one
source with the weights of its members together, which take its slots in turn, those with
more blocks first. A member that has run out leaves its turns to the others. Sizes
are kept in steps of at most a 64th: the last turns of a member of more than 128
blocks can stay empty. What comes to the driver is a row for each class and step of sizes.

Target weights are given by source, or follow from the sources' words to the
power ``SMOOTHING``, which gives small sources more than their share. A source
without words has one block.

A null source counts as the empty name, a null text as empty. Rows equal in
source, identifier and text are scheduled as one, with all their words. A
source without a target weight is left out. An empty table gives an empty one.
Further columns pass through unread, whatever their names.
"""

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsheaf.llm.common import BLANKS, staged
from docsheaf.operators.numbering import dense_numbers, running_offsets

BLOCK_WORDS = 500
RESOLUTION = 2000
SLOTS_EACH = 16
#: Parts of an octave by which blocks and weights of classes are told apart, where a caller asks for them.
GRAIN = (1, 4)
#: Classes of weights that follow from words: sources of up to 2**30 words have fewer.
CLASSES = 128
#: Sizes within an octave that are told apart.
STEPS = 64
#: Rows of a schedule or sources that are sent to every task.
SMALL = 200_000
SMOOTHING = 0.7
#: Points of sources' blocks that decide their frames are this part of a block apart, so that they lie evenly.
APART = 0.6180339887498949
#: Part of a slot by which release and deadline may miss a whole number.
NEARLY = 1e-6

FRAMED = "_c bigint, block bigint, blocks bigint, frame bigint, release bigint, deadline bigint, slot bigint"
KEY = ["_source", "_doc", "_digest"]


def shares(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Slots per period: at least one each, ``resolution`` in all, by largest remainder."""
    wanted = {s: w for s, w in weights.items() if w > 0}
    total = sum(wanted.values())
    if not wanted:
        return {}
    if len(wanted) > resolution:
        raise ValueError(f"{len(wanted)} sources need a resolution of at least as many slots")
    spare = resolution - len(wanted)
    exact = {s: max(0.0, w / total * resolution - 1) for s, w in wanted.items()}
    scale = spare / sum(exact.values()) if sum(exact.values()) else 0.0
    exact = {s: x * scale for s, x in exact.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    rest = resolution - sum(out.values())
    for s in sorted(exact, key=lambda s: (-(exact[s] % 1), s))[:rest]:
        out[s] += 1
    return out


def _placed(slots: dict):
    """The blocks of one period in the order of their slots."""
    length = sum(slots.values())
    waiting = sorted(
        ((j * length // k, -(-(j + 1) * length // k), s, j) for s, k in slots.items() for j in range(k)),
        reverse=True,
    )
    ready = []
    for slot in range(length):
        while waiting and waiting[-1][0] <= slot:
            release, deadline, source, j = waiting.pop()
            heapq.heappush(ready, (deadline, source, j, release))
        deadline, source, j, release = heapq.heappop(ready)
        yield source, j, release, deadline, slot


def period(slots: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """``(source, j, release, deadline, slot)`` of the j-th block of every source in one period."""
    return list(_placed(slots))


def _counted(sources: DataFrame, smoothing: float, weights: dict | None, block_words: int, whole: bool) -> DataFrame:
    """``(_source, weight, blocks)`` of the sources that take part, from ``(_source, words)``."""
    spark = sources.sparkSession
    if weights is None:
        weight = F.pow(F.greatest("words", F.lit(1)).cast("double"), F.lit(smoothing))
        known = sources.withColumn("weight", weight).filter((F.col("words") > 0) | F.lit(whole))
    else:
        given = spark.createDataFrame(list(weights.items()), "_source string, weight double")
        known = sources.join(given, "_source").filter("weight > 0")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("words") / block_words)).cast("bigint")
    return known.select("_source", "weight", blocks.alias("blocks"))


def _alike(sources: DataFrame) -> DataFrame:
    """The key of each source's class, ``_like``."""

    blocks, weights = (F.floor(F.log2(c) * grain) for c, grain in zip(("blocks", "weight"), GRAIN, strict=True))
    # a size is rounded up to a step
    step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2("blocks"))) / STEPS)
    size = (F.ceil(F.col("blocks") / step) * step).cast("bigint")
    return sources.withColumn("_like", F.struct(blocks.alias("b"), weights.alias("w"))).withColumn("_size", size)


def singles(sources: DataFrame, most: int) -> tuple[DataFrame, dict[int, float], dict[int, dict[int, int]]]:
    """As ``classes``, each source being one; ``most`` is how many the caller's period has room for."""
    few = sources.limit(most + 1).collect()
    if len(few) > most:
        raise ValueError(f"a resolution of {most} slots is too small for the sources")
    rows = sorted((r._source, r.weight, r.blocks) for r in few)
    members = [(s, c, 0, n) for c, (s, _, n) in enumerate(rows)]
    table = sources.sparkSession.createDataFrame(members, "_source string, _c int, _turn bigint, _blocks bigint")
    return table, {c: w for c, (_, w, _) in enumerate(rows)}, {c: {n: 1} for c, (_, _, n) in enumerate(rows)}


def classes(sources: DataFrame) -> tuple[DataFrame, dict[int, float], dict[int, dict[int, int]]]:
    """``(_source, _c, _turn, _blocks)`` of all sources, and of every class its weight, and its members by size."""
    spark = sources.sparkSession
    keyed = staged(_alike(sources), "sources")
    cells = keyed.groupBy("_like", "_size").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
    weights, sizes, number = defaultdict(float), defaultdict(dict), {}
    for r in sorted(cells.collect(), key=lambda r: (r._like, r._size)):
        c = number.setdefault(r._like, len(number))
        weights[c] += r.weight
        sizes[c][r._size] = r.n
    order = keyed.select("_source", "_like", "blocks", (-F.col("_size")).alias("_less"))
    order = dense_numbers(order, ["_like", "_less", "_source"], "_at")
    begin = [(like.b, like.w, c, sum(sum(sizes[k].values()) for k in range(c))) for like, c in number.items()]
    first = spark.createDataFrame(begin, "b bigint, w bigint, _c int, _begin bigint")
    placed = order.join(F.broadcast(first), (F.col("_like.b") == F.col("b")) & (F.col("_like.w") == F.col("w")))
    table = placed.select("_source", "_c", (F.col("_at") - F.col("_begin")).alias("_turn"), F.col("blocks").alias("_blocks"))
    return table, dict(weights), dict(sizes)


def before_round(sizes: Column, round_: Column) -> Column:
    """The slots of a class that its members take before a round, given ``(size, n)`` of its members."""
    return F.aggregate(
        sizes, F.lit(0).cast("bigint"), lambda sum_, of: sum_ + of["n"] * F.least(of["size"], round_)
    )


def frame_slots(source: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Release, deadline and slot of a frame's blocks, in the order of their sources and numbers.

    ``end`` is when the block's source ends, in parts of the frame.
    """
    n = len(source)
    first = np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1]]))
    k = np.diff(np.append(first, n))
    end = np.maximum(end[first], 1e-9)
    # the blocks of sources that have ended, and the blocks a frame of those that have not
    order = np.argsort(end, kind="stable")
    ended = np.concatenate([[0], np.cumsum(k[order])])
    rate = np.append(np.cumsum((k / end)[order][::-1])[::-1], 0.0)

    def slots_at(time: np.ndarray) -> np.ndarray:
        past = np.searchsorted(end[order], time)
        return ended[past] + rate[past] * time

    each, j = np.repeat(end / k, k), np.arange(n) - np.repeat(first, k)
    release = np.floor(slots_at(j * each) + NEARLY).astype(np.int64)
    deadline = np.ceil(slots_at((j + 1) * each) - NEARLY).astype(np.int64)
    slot, ready = np.empty(n, np.int64), []
    waiting = np.argsort(-release, kind="stable").tolist()
    released, due = release.tolist(), (deadline * n + np.arange(n)).tolist()
    for now in range(n):
        while waiting and released[waiting[-1]] <= now:
            heapq.heappush(ready, due[waiting.pop()])
        slot[heapq.heappop(ready) % n] = now
    return release, deadline, slot


def _frames(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of frames that come in order, with their slots."""

    def placed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        own = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        found = frame_slots(own.column("_c").to_numpy(), own.column("end").to_numpy())
        names = ["_c", "block", "blocks", "frame"]
        return pa.RecordBatch.from_arrays(
            [*[own.column(c) for c in names], *map(pa.array, found)], [*names, "release", "deadline", "slot"]
        )

    held, now = [], None
    for part in parts:
        frame = part.column("frame").to_numpy()
        at = np.concatenate([[0], np.flatnonzero(frame[1:] != frame[:-1]) + 1, [len(frame)]])
        for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if begin == end:
                continue
            if held and now != frame[begin]:
                yield placed(held)
                held = []
            now = frame[begin]
            held.append(part.slice(begin, end - begin))
    if held:
        yield placed(held)


def framed(sources: DataFrame) -> DataFrame:
    """``(_c, block, blocks, release, deadline, slot)`` of all blocks of ``sources(_c, weight, blocks)``."""
    spark = sources.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = sources.agg(F.coalesce(F.sum("weight"), F.lit(1.0))).first()[0]
    # the order of summing must not show
    span = RESOLUTION / float(f"{total:.9e}")
    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1, F.lit(RESOLUTION).cast("bigint")))
    runs = sources.select("_c", "weight", "blocks", begin.alias("_begin")).repartition(partitions, "_c", "_begin")
    until = F.least(F.col("_begin") + RESOLUTION, "blocks") - 1
    blocks = runs.select("_c", "weight", "blocks", F.explode(F.sequence("_begin", until)).alias("block"))
    point = F.pmod(F.lit(0.5) + F.col("_c") * F.lit(APART), F.lit(1.0))
    at = F.floor(F.least(F.lit(1e18), (F.col("block") + point) / F.col("weight") / F.lit(span))).cast("bigint")
    blocks = blocks.withColumn("frame", at)
    end = F.least(F.lit(1.0), F.col("blocks") / F.col("weight") / F.lit(span) - F.col("frame"))
    blocks = blocks.select("_c", "block", "blocks", "frame", end.alias("end"))
    dealt = blocks.repartition(partitions, "frame").sortWithinPartitions("frame", "_c", "block")
    found = staged(dealt.mapInArrow(_frames, FRAMED), "frames")
    before = running_offsets(found.groupBy("frame").agg(F.count("*").alias("_n")), "frame", "_n")
    slots = [(F.col(c) + F.col("before")).alias(c) for c in ("release", "deadline", "slot")]
    return found.join(before, "frame").select("_c", "block", "blocks", *slots)


def phases(weights: dict, blocks: dict, resolution: int | None, whole: bool):
    """``(plan, first, base, slots, end)`` of every phase.

    ``plan`` is a period as far as the phase goes, ``first`` has the blocks that
    each source had before, and ``base`` is the phase's first slot; ``end`` is the
    first slot after it, counted from there.
    """
    left, first, base = dict(blocks), dict.fromkeys(blocks, 0), 0
    while left:
        slots = shares({s: weights[s] for s in left}, resolution or max(RESOLUTION, SLOTS_EACH * len(left)))
        length = sum(slots.values())
        # whole periods in which no source runs out, then the slots up to the first that does
        cycles = min(left[s] // k for s, k in slots.items())
        over = {s: left[s] - cycles * k for s, k in slots.items()}
        placed, rest = [], length
        for row in _placed(slots):
            if rest == length and row[1] >= over[row[0]]:
                rest = row[4]
                if whole and not cycles:
                    break
            placed.append(row)
        taken = Counter(s for s, _, _, _, slot in placed if slot < rest)
        end = cycles * length + rest
        yield placed, first, base, slots, end
        if not whole:
            return
        base += end
        first = {s: first[s] + cycles * k + taken[s] for s, k in slots.items()}
        left = {s: blocks[s] - n for s, n in first.items() if n < blocks[s]}
        first = {s: first[s] for s in left}


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce("source", F.lit("")).alias("_source"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_doc"),
        F.xxhash64(text).alias("_digest"),
        text.alias("_body"),
    )


def _block_starts(docs: DataFrame) -> DataFrame:
    """The words of a source before each document of it, in hash order."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = F.size(F.filter(F.split("_body", BLANKS), lambda w: w != "")).cast("bigint")
    units = _keyed(docs).select(*KEY, words.alias("words")).groupBy(*KEY).agg(F.sum("words").alias("words"))
    units = units.withColumn("_order", F.xxhash64("_doc", "_digest"))
    # a large source is cut over many partitions, and sums run within each
    order = ["_source", "_order", "_doc"]
    dealt = staged(units.repartitionByRange(partitions, *order).withColumn("_part", F.spark_partition_id()), "units")
    here = Window.partitionBy("_part", "_source").orderBy("_order", "_doc", "_digest")
    here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = dealt.withColumn("_upto", F.sum("words").over(here))
    totals = dealt.groupBy("_source", "_part").agg(F.sum("words").alias("_words"))
    # a row for each partition in which a source has documents
    parts = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_source", "_part", F.coalesce(F.sum("_words").over(parts), F.lit(0)).alias("_before"))
    return running.join(before, ["_source", "_part"]).select(
        *KEY, "words", "_order", (F.col("_before") + F.col("_upto") - F.col("words")).alias("_start")
    )


def schedule(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_words: int = BLOCK_WORDS,
    resolution: int | None = None,
    smoothing: float = SMOOTHING,
    whole: bool | None = None,
    alike: bool = False,
) -> DataFrame:
    """For every distinct document its block, release, deadline and slot, and whether it is in the mixture.

    The mixture is ``whole`` unless a resolution is given: then, or if it is false, it
    ends when the first source runs out. With ``alike`` sources take part in classes.
    """
    whole = resolution is None if whole is None else whole
    starts = staged(_block_starts(docs), "block-starts")
    sources = starts.groupBy("_source").agg(F.sum("words").alias("words"))
    sources = staged(_counted(sources, smoothing, weights, block_words, whole), "source-blocks")
    if resolution is not None or alike:
        return _in_phases(starts, sources, block_words, resolution, whole)
    members = dense_numbers(sources, ["weight", "_source"], "_c")
    blocks = framed(members.select("_c", "weight", "blocks"))
    end = None
    if not whole:
        end = blocks.filter(F.col("block") == F.col("blocks") - 1).agg(F.min("deadline")).first()[0]
    placed = starts.withColumn("block", F.floor(F.col("_start") / block_words))
    members = members.select("_source", "_c", F.col("blocks").alias("_blocks"))
    placed = placed.join(members, "_source", "left")
    # a text without words after the last block belongs to it
    placed = placed.withColumn("block", F.least("block", F.col("_blocks") - 1) if whole else F.col("block"))
    placed = placed.join(blocks.drop("blocks"), ["_c", "block"], "left")
    within = F.col("slot").isNotNull() if end is None else F.coalesce(F.col("slot") < end, F.lit(False))
    return placed.select(*KEY, "words", "_order", "block", "release", "deadline", "slot", within.alias("in_mix"))


def _in_phases(
    starts: DataFrame, sources: DataFrame, block_words: int, resolution: int | None, whole: bool
) -> DataFrame:
    """The schedule in periods made on the driver: of sources with a resolution, of classes without."""
    spark = starts.sparkSession
    members, weight, sizes = classes(sources) if resolution is None else singles(sources, resolution)
    made = phases(
        weight, {c: sum(n * k for n, k in of.items()) for c, of in sizes.items()}, resolution, whole
    )
    rows, spans, end = [], defaultdict(list), 0
    for p, (plan, first, base, slots, length) in enumerate(made):
        rows += [(c, p, j, base + release, base + deadline, base + slot) for c, j, release, deadline, slot in plan]
        for c, k in slots.items():
            spans[c].append((p, first[c], k, sum(slots.values())))
        end = base + length

    small = lambda df, n: F.broadcast(df) if n <= SMALL else df
    names = ["_c", "_phase", "_j", "release", "deadline", "slot"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    table = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names))
    span = "array<struct<phase:bigint,first:bigint,k:bigint,length:bigint>>"
    known = [(c, spans[c], sorted(of.items())) for c, of in sizes.items()]
    known = spark.createDataFrame(known, f"_c int, _spans {span}, _sizes array<struct<size:bigint,n:bigint>>")
    placed = starts.withColumn("block", F.floor(F.col("_start") / block_words))
    n_sources = sum(sum(of.values()) for of in sizes.values())
    placed = placed.join(small(members, n_sources), "_source", "left").join(F.broadcast(known), "_c", "left")
    if whole:
        # a text without words after the last block belongs to it
        placed = placed.withColumn("block", F.least("block", F.col("_blocks") - 1))
    placed = placed.withColumn("_number", before_round(F.col("_sizes"), F.col("block")) + F.col("_turn"))
    begun = F.filter("_spans", lambda s: s["first"] <= F.col("_number"))
    placed = placed.withColumn("_span", F.get(begun, F.size(begun) - 1)).withColumn("_phase", F.col("_span.phase"))
    since = F.col("_number") - F.col("_span.first")
    placed = placed.withColumn("_j", F.pmod(since, "_span.k")).withColumn(
        "_cycle", F.floor(since / F.col("_span.k")) * F.col("_span.length")
    )
    placed = placed.join(small(table, len(rows)), ["_c", "_phase", "_j"], "left")
    shifted = [(F.col(c) + F.col("_cycle")).alias(c) for c in ("release", "deadline", "slot")]
    return placed.select(*KEY, "words", "_order", "block", *shifted).withColumn(
        "in_mix", F.coalesce(F.col("slot") < end, F.lit(False))
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """``row`` with the columns of ``docs``, and its place in the schedule."""
    return _keyed(docs).drop("_body").join(schedule(docs, **settings), KEY)


def in_order(found: DataFrame) -> DataFrame:
    """The documents of the mixture, dealt and sorted by slot."""
    partitions = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["slot", "_order", "_doc"]
    chosen = found.filter("in_mix").select("row", *order)
    return chosen.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("row.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "row.doc_id", F.col("row.source").alias("source"), "words", "block", "release", "deadline", "slot", "in_mix"
    )
