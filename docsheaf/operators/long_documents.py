"""Chunks of documents that are larger than a row.

A document comes in pieces and is never put together. Pieces are cleaned as they
come, all but the lines that meet others. Lines are put in order once and travel
from there in blocks of some hundred, a row each. What decides over chunks are a
few numbers for each line: the words of its sentences, whether it is blank and
how it ends. A block knows all of its paragraphs but those that its first and its
last line may share with others; words of these are added up over blocks, and
running sums over blocks number paragraphs and units (a unit is a paragraph, or a
sentence of a long one). So a paragraph may lie in any number of tasks. Units are
numbered over the whole collection and packed in blocks of their own:

* Prefix sums of a block's counts give for every unit the next one that opens a
  chunk if it does; pointers that jump twice as far each time lead from there to
  the block's last chunk. A change of segment (document, long paragraph, run of
  short ones) opens one in any case.
* What the units before a block left open is one number, the sum so far, and
  decides only where the block's first chunk opens. So a block is a map from
  sums to sums; mostly all sums lead to the same. The others are composed in
  order, a run of such blocks at a time.

The text travels when lines are put in order and when its blocks meet the numbers
of chunks; a chunk within one block is whole there. Counts are estimated by words,
which add up over lines.
"""

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docsheaf import constants as C
from docsheaf.functions import text as T
from docsheaf.functions.text import WHITESPACE
from docsheaf.functions.tokens import tokens_of_words
from docsheaf.operators.numbering import running_offsets
from docsheaf.session import materialize, small_batches, workspace

#: Lines of a row, and characters after which it is closed.
LINES, LINE_CHARS = 1024, 1 << 18
#: Units of a block, and blocks whose order is kept in one row.
BLOCK, BLOCKS_PER_ROW = 4096, 4096

MAPS = (
    "block bigint, first int, none_opens boolean, total bigint, prefix array<bigint>, leaves array<bigint>, fixed bigint"
)


LINE_BLOCKS = (
    "b bigint, docs array<bigint>, texts array<string>, sizes array<int>, words array<int>, ends array<boolean>,"
    " paras bigint, units bigint, head bigint, head_starts bigint, tail bigint, tail_starts bigint,"
    " joined boolean, after_end boolean, first_doc bigint, first_blank boolean,"
    " last_doc bigint, last_blank boolean, last_ends boolean"
)
#: Bits of a line block's number that count within its task; the task's number is above them.
TASK_BITS = 33


# --- lines -----------------------------------------------------------------------------------


@F.pandas_udf(StringType())
def _tidied(texts: pd.Series) -> pd.Series:
    """As ``text.nfc`` and ``text.replace_artefacts``; a pass over ASCII text finds nothing to do but line ends."""
    swaps = [*zip(C.ARTEFACT_CHARS, C.ARTEFACT_CHARS_TO, strict=True), *((c, "") for c in C.ARTEFACT_REMOVED)]
    swaps.append((C.EM_DASH, C.EM_DASH_TO))

    def tidy(text):
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            for before, after in swaps:
                text = text.replace(before, after)
        return text.replace("\r\n", "\n").replace("\r", "\n")

    return texts.map(tidy, na_action="ignore")


def _tidy(df: DataFrame) -> DataFrame:
    return df.withColumn("text", _tidied(F.col("text")))


def cleaned_pieces(pieces: DataFrame, patterns) -> DataFrame:
    """``(doc_seq, piece_no, last, head, tail, lines)``: the first and the last line of each piece as they
    are, and those between, which meet no others, cleaned and without boilerplate, with their places."""
    cut = pieces.select("doc_seq", "piece_no", F.split("raw_text", "\n").alias("lines"))
    last = F.size("lines") - 1
    inner = F.array_join(F.slice("lines", F.lit(2), F.greatest(last - 1, F.lit(0))), "\n")
    cut = cut.select(
        "doc_seq", "piece_no", last.alias("last"), F.get("lines", F.lit(0)).alias("head"),
        F.when(last > 0, F.get("lines", last)).alias("tail"), F.when(last > 1, inner).alias("text"),
    )
    lines = F.transform(F.split("text", "\n"), lambda t, k: F.struct((k + 1).alias("k"), t.alias("text")))
    if patterns:
        regex = F.lit(T.boilerplate_regex(patterns))
        lines = F.filter(lines, lambda line: ~F.rlike(line["text"], regex))
    lines = F.transform(lines, lambda line: F.struct(line["k"].alias("k"), T.py_rstrip(line["text"]).alias("text")))
    return _tidy(cut).select("doc_seq", "piece_no", "last", "head", "tail", lines.alias("lines"))


def document_lines(pieces: DataFrame, patterns=C.BOILERPLATE_PATTERNS) -> DataFrame:
    """``(doc_seq, line_no, text)``: cleaned lines of ``pieces(doc_seq, piece_no, raw_text)`` without boilerplate.

    Newlines are unified. Only the first and the last line of a piece meet others.
    """
    spark = pieces.sparkSession
    cut = materialize(cleaned_pieces(pieces, patterns), workspace(spark, "pieces"))
    before = Window.partitionBy("doc_seq").orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each piece, without text
    first = cut.select(
        "doc_seq", "piece_no", F.coalesce(F.sum(F.col("last").cast("bigint")).over(before), F.lit(0)).alias("first")
    )
    each = cut.join(first, ["doc_seq", "piece_no"])
    inner = each.select("doc_seq", "first", F.inline("lines")).select(
        "doc_seq", (F.col("first") + F.col("k")).alias("line_no"), "text"
    )
    edge = F.array(
        F.struct(F.col("first").alias("line_no"), F.col("head").alias("text")),
        F.struct((F.col("first") + F.col("last")).alias("line_no"), F.col("tail").alias("text")),
    )
    parts = F.sort_array(F.collect_list(F.struct("piece_no", "text")))
    edges = each.select("doc_seq", "piece_no", F.inline(edge)).filter("text IS NOT NULL")
    joined = edges.groupBy("doc_seq", "line_no").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text")
    )
    joined = _tidy(joined)
    if patterns:
        joined = joined.filter(~F.rlike("text", F.lit(T.boilerplate_regex(patterns))))
    joined = joined.withColumn("text", T.py_rstrip(F.col("text")))
    return inner.unionByName(materialize(joined, workspace(spark, "edges")))


#: A sentence ends before the white space of each match.
SENTENCE_END = re.compile(f"[.!?][{re.escape(WHITESPACE)}]+")


def sentence_texts(line: str) -> list[str]:
    out, at = [], 0
    for end in SENTENCE_END.finditer(line):
        out.append(line[at : end.start() + 1])
        at = end.end()
    return [*out, line[at:]]


def tokens(words: np.ndarray) -> np.ndarray:
    """As ``tokens_of_words``."""
    return np.floor(words * float(C.TOKENS_PER_WORD)).astype(np.int64)


class Lines:
    """The lines of a block: their paragraphs, and where units begin, as far as the block knows.

    ``sizes`` are the sentences of each line, none of a blank one; ``words`` are those of each sentence.
    """

    def __init__(self, docs, sizes, words, ends):
        self.docs, self.sizes, self.words = docs, sizes, words
        filled = sizes > 0
        self.new = filled.copy()
        self.new[1:] &= ~filled[:-1] | (docs[1:] != docs[:-1])
        self.para = np.cumsum(self.new) - 1
        self.paras = int(self.new.sum())
        #: for each sentence its line and paragraph, and whether it begins a unit of a long or a short paragraph
        self.line = np.repeat(np.arange(len(sizes)), sizes)
        self.of = self.para[self.line]
        leads = np.ones(len(words), bool)
        leads[1:] = self.line[1:] != self.line[:-1]
        ended = np.concatenate([[False], ends[:-1]])
        self.if_short = leads & self.new[self.line]
        self.if_long = ~leads | self.new[self.line] | ended[self.line]
        self.para_words = np.bincount(self.of, words, self.paras).astype(np.int64)
        self.head = 0 if self.paras and filled[0] else None
        self.tail = self.paras - 1 if self.paras and filled[-1] else None

    def facts(self, most: int) -> dict:
        """What is known of the paragraphs; the first and the last are told apart where others may have a share."""
        starts = np.bincount(self.of, self.if_long, self.paras).astype(np.int64)
        units = np.where(tokens(self.para_words) > most, starts, 1)
        open_ = [p for p in {self.head, self.tail} if p is not None]
        tail = None if self.tail == self.head else self.tail
        return {
            "paras": self.paras, "units": int(units.sum() - units[open_].sum()),
            "head": None if self.head is None else int(self.para_words[0]),
            # but for the first sentence, which may belong to a unit of the block before
            "head_starts": None if self.head is None else int(starts[0]) - 1,
            "tail": None if tail is None else int(self.para_words[tail]),
            "tail_starts": None if tail is None else int(starts[tail]),
        }

    def units(self, row: dict, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every sentence the number of its unit and whether it begins it; for every paragraph if it is long."""
        long = tokens(self.para_words) > most
        if self.head is not None:
            long[0] = row["head_long"]
        if self.tail is not None and self.tail != self.head:
            long[self.tail] = row["tail_long"]
        starts = np.where(long[self.of], self.if_long, self.if_short)
        if row["joined"]:
            starts[0] = long[0] and row["after_end"]
        return row["units_before"] + np.cumsum(starts) - 1, starts, long


def _line_blocks(max_tokens: int):
    """Blocks of the sorted lines of a task."""
    schema = pa.schema(
        [("b", pa.int64()), ("docs", pa.list_(pa.int64())), ("texts", pa.list_(pa.string())),
         ("sizes", pa.list_(pa.int32())), ("words", pa.list_(pa.int32())), ("ends", pa.list_(pa.bool_())),
         *[(c, pa.int64()) for c in ("paras", "units", "head", "head_starts", "tail", "tail_starts")],
         ("joined", pa.bool_()), ("after_end", pa.bool_()), ("first_doc", pa.int64()), ("first_blank", pa.bool_()),
         ("last_doc", pa.int64()), ("last_blank", pa.bool_()), ("last_ends", pa.bool_())]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        b, last = TaskContext.get().partitionId() << TASK_BITS, None
        docs, texts, chars = [], [], 0

        def block():
            sizes, words = [], []
            for text in texts:
                if text:
                    cut = sentence_texts(text)
                    sizes.append(len(cut))
                    words += [len(s.split()) for s in cut]
                else:
                    sizes.append(0)
            ends = [text[-1:] in (".", "!", "?") for text in texts]
            lines = Lines(np.array(docs, np.int64), np.array(sizes, np.int64), np.array(words, np.int64), np.array(ends, bool))
            # the first block of a task does not know the line before it
            joined = None if last is None else last["last_doc"] == docs[0] and not last["last_blank"] and bool(texts[0])
            row = {
                "b": b, "docs": docs, "texts": texts, "sizes": sizes, "words": words, "ends": ends,
                **lines.facts(max_tokens), "joined": joined, "after_end": last and last["last_ends"],
                "first_doc": docs[0], "first_blank": not texts[0],
                "last_doc": docs[-1], "last_blank": not texts[-1], "last_ends": ends[-1],
            }
            return row, pa.RecordBatch.from_pylist([row], schema)

        for part in parts:
            for doc, text in zip(part.column("doc_seq").to_pylist(), part.column("text").to_pylist(), strict=True):
                docs.append(doc)
                texts.append(text)
                chars += len(text)
                if len(texts) >= LINES or chars >= LINE_CHARS:
                    last, batch = block()
                    yield batch
                    b, docs, texts, chars = b + 1, [], [], 0
        if texts:
            yield block()[1]

    return run


def line_blocks(lines: DataFrame, max_tokens: int) -> DataFrame:
    """The lines in the order of ``doc_seq`` and ``line_no``, in blocks numbered in that order, not without gaps."""
    spark = lines.sparkSession
    order = ["doc_seq", "line_no"]
    dealt = lines.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    blocks = dealt.sortWithinPartitions(*order).select("doc_seq", "text").mapInArrow(_line_blocks(max_tokens), LINE_BLOCKS)
    return materialize(blocks, workspace(spark, "line-blocks"))


def block_numbers(blocks: DataFrame, max_tokens: int) -> DataFrame:
    """``(b, joined, after_end, paras_before, head_long, tail_long, units_before, n_units)`` of blocks of lines.

    ``joined``: the first line goes on with a paragraph of the block before; ``after_end``: a sentence ended before it.
    """
    spark = blocks.sparkSession
    # a row for each task
    first, last = F.struct("b", "first_doc", "first_blank"), F.struct("last_doc", "last_blank", "last_ends")
    tasks = blocks.groupBy(F.shiftright("b", TASK_BITS).alias("task")).agg(F.min_by(first, "b"), F.max_by(last, "b"))
    rows, end = [], None
    for _, (b, doc, blank), following in sorted(tasks.collect(), key=lambda row: row[0]):
        joined = end is not None and end[0] == doc and not end[1] and not blank
        rows.append((b, joined, bool(end and end[2])))
        end = following
    begins = spark.createDataFrame(pd.DataFrame(rows, columns=["b", "_joined", "_after"]), "b bigint, _joined boolean, _after boolean")
    facts = blocks.select("b", "paras", "units", "head", "head_starts", "tail", "tail_starts", "joined", "after_end")
    facts = facts.join(F.broadcast(begins), "b", "left").withColumns(
        {"joined": F.coalesce("joined", "_joined"), "after_end": F.coalesce("after_end", "_after")}
    )
    facts = facts.drop("_joined", "_after").withColumn("fresh", F.col("paras") - F.col("joined").cast("bigint"))
    facts = materialize(facts, workspace(spark, "line-facts"))
    numbered = facts.join(running_offsets(facts, "b", "fresh").withColumnRenamed("before", "paras_before"), "b")
    # paragraphs are counted from 1
    head = F.col("paras_before") + 1 - F.col("joined").cast("bigint")
    tail = F.col("paras_before") + F.col("fresh")
    numbered = numbered.withColumns({"_head": F.when(F.col("head").isNotNull(), head), "_tail": F.when(F.col("tail").isNotNull(), tail)})
    shares = F.array(
        F.struct(F.col("_head").alias("para"), F.col("head").alias("words")),
        F.struct(F.col("_tail").alias("para"), F.col("tail").alias("words")),
    )
    shares = numbered.select(F.inline(shares)).filter("para IS NOT NULL")
    long = shares.groupBy("para").agg((tokens_of_words(F.sum("words")) > max_tokens).alias("long"))
    long = materialize(long, workspace(spark, "open-paragraphs"))
    for edge in ("head", "tail"):
        named = long.select(F.col("para").alias(f"_{edge}"), F.col("long").alias(f"{edge}_long"))
        numbered = numbered.join(named, f"_{edge}", "left")
    begun = F.when(F.col("head_long"), F.col("head_starts") + (~F.col("joined") | F.col("after_end")).cast("bigint"))
    begun = F.when(F.col("head").isNull(), 0).otherwise(begun.otherwise((~F.col("joined")).cast("bigint")))
    ended = F.when(F.col("tail").isNull(), 0).when(F.col("tail_long"), F.col("tail_starts")).otherwise(1)
    numbered = numbered.withColumn("n_units", F.col("units") + begun + ended)
    numbered = materialize(
        numbered.select("b", "joined", "after_end", "paras_before", "head_long", "tail_long", "n_units"),
        workspace(spark, "line-numbers"),
    )
    before = running_offsets(numbered, "b", "n_units").withColumnRenamed("before", "units_before")
    return materialize(numbered.join(before, "b"), workspace(spark, "line-blocks-numbered"))


KNOWN = ["joined", "after_end", "paras_before", "head_long", "tail_long", "units_before"]


def _known(part: pa.RecordBatch) -> Iterator[tuple[dict, Lines, int]]:
    """Blocks of a batch that have units: their numbers, their lines and their places."""
    columns = {c: part.column(c).to_pylist() for c in KNOWN}
    lists = {c: part.column(c) for c in ("docs", "sizes", "words", "ends")}
    for k in range(part.num_rows):
        own = {c: v[k].values.to_numpy(zero_copy_only=False) for c, v in lists.items()}
        if len(own["words"]):
            lines = Lines(own["docs"], own["sizes"].astype(np.int64), own["words"].astype(np.int64), own["ends"])
            yield {c: v[k] for c, v in columns.items()}, lines, k


def line_units(blocks: DataFrame, numbers: DataFrame, max_tokens: int) -> DataFrame:
    """``(n, doc_seq, para, long, tokens)``: the units of all blocks, numbered in order without gaps."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, lines, _ in _known(part):
                n, _, long = lines.units(row, max_tokens)
                at = np.flatnonzero(np.diff(n, prepend=n[0] - 1))
                para = lines.of[at]
                whole = np.ones(len(at), bool)
                # the first and the last may go on in other blocks
                whole[[0, -1]] = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n[at]), pa.array(lines.docs[lines.line[at]]), pa.array(para + (row["paras_before"] + 1 - row["joined"])),
                     pa.array(long[para]), pa.array(np.add.reduceat(lines.words, at)), pa.array(whole)],
                    names=["n", "doc_seq", "para", "long", "words", "whole"],
                )

    spark = blocks.sparkSession
    each = blocks.select("b", "docs", "sizes", "words", "ends").join(numbers, "b")
    schema = "n bigint, doc_seq bigint, para bigint, long boolean, words bigint, whole boolean"
    each = materialize(each.mapInArrow(run, schema), workspace(spark, "line-units"))
    key = ["n", "doc_seq", "para", "long"]
    shared = each.filter("NOT whole").groupBy(*key).agg(F.sum("words").alias("words"))
    units = each.filter("whole").select(*key, "words").unionByName(shared)
    return units.select(*key, tokens_of_words(F.col("words")).cast("bigint").alias("tokens"))


# --- packing ---------------------------------------------------------------------------------


def opens(units: pd.DataFrame) -> np.ndarray:
    """Where a segment begins, for units in order; the first one is taken to."""
    doc, para, long = (units[c].to_numpy() for c in ("doc_seq", "para", "long"))
    new = np.ones(len(units), bool)
    long = long.astype(bool)
    new[1:] = (doc[1:] != doc[:-1]) | (long[1:] & (para[1:] != para[:-1])) | (~long[1:] & long[:-1])
    return new


class Block:
    """A block's units; ``lead`` is the unit before them, if any."""

    def __init__(self, rows: pd.DataFrame, max_tokens: int):
        rows = rows.sort_values("n")
        forced = opens(rows)
        lead = int(rows["lead"].iloc[0])
        self.rows, self.forced, self.most = rows.iloc[lead:], forced[lead:], max_tokens
        self.n = len(self.rows)
        self.sums = np.concatenate([[0], np.cumsum(self.rows["tokens"].to_numpy(np.int64))])
        places = np.flatnonzero(self.forced)
        self.first = int(places[0]) if len(places) else self.n
        # the next unit that opens a chunk if this one does
        at = np.arange(self.n)
        over = np.searchsorted(self.sums, self.sums[:-1] + max_tokens, side="right") - 1
        following = np.append(places, self.n)[np.searchsorted(places, at, side="right")]
        self.following = np.append(np.minimum(np.maximum(over, at + 1), following), self.n)

    def last_from(self) -> np.ndarray:
        """For every unit the last one that opens a chunk if this one does, by jumps of twice the length each time."""
        jump, last = self.following.copy(), np.arange(self.n + 1)
        while (jump < self.n).any():
            more = jump < self.n
            last[more] = last[jump[more]]
            jump = jump[jump]
        return last

    def begin(self, open_sum: int) -> int:
        """The first unit that opens a chunk after units that left ``open_sum``."""
        if open_sum > self.most:
            return 0
        return min(self.first, self.n, int(np.searchsorted(self.sums, self.most - open_sum, side="right")) - 1)

    def map(self) -> tuple:
        """What ``applied`` needs to know."""
        total = int(self.sums[-1])
        reach = self.begin(0)
        last = self.last_from()
        leaves = total - self.sums[last[: reach + 1]]
        # a block without an opening passes its sum on
        fixed = reach < self.n and len(set(leaves.tolist())) == 1
        return reach, total, self.sums[: reach + 2], leaves, int(leaves[0]) if fixed else None

    def opened(self, open_sum: int) -> np.ndarray:
        """For every unit the number of chunks that were opened in the block up to it."""
        marks = np.zeros(self.n, np.int64)
        at = self.begin(open_sum)
        while at < self.n:
            marks[at] = 1
            at = int(self.following[at])
        return np.cumsum(marks)


def applied(row, open_sum: int, max_tokens: int) -> int:
    """The sum that a block leaves open, by its map."""
    at = 0 if open_sum > max_tokens else int(np.searchsorted(row.prefix, max_tokens - open_sum, side="right")) - 1
    # the map's last place opens a chunk only if the block has a unit there
    at = min(at, int(row.first))
    return open_sum + int(row.total) if at == row.first and row.none_opens else int(row.leaves[at])


def in_blocks(units: DataFrame) -> DataFrame:
    """Units with their block; the last unit of each is the next one's lead."""
    own = units.withColumns({"block": F.floor(F.col("n") / BLOCK), "lead": F.lit(False)})
    lead = own.filter(F.col("n") % BLOCK == BLOCK - 1).withColumns({"block": F.col("block") + 1, "lead": F.lit(True)})
    return own.unionByName(lead)


def _maps(max_tokens: int):
    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, max_tokens)
        if not block.n:
            return pd.DataFrame(columns=[field.split()[0] for field in MAPS.split(", ")])
        first, total, prefix, leaves, fixed = block.map()
        return pd.DataFrame(
            {"block": [key[0]], "first": [first], "none_opens": [first >= block.n], "total": [total],
             "prefix": [prefix.tolist()], "leaves": [leaves.tolist()], "fixed": pd.array([fixed], "Int64")}
        )

    return one


def open_sums(maps: DataFrame, max_tokens: int) -> DataFrame:
    """``(block, open_sum)``: what the units before each block left open."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        now, out = 0, []
        for row in rows.itertuples():
            out.append((row.block, now))
            if row.prefix is None:
                break
            now = applied(row, now, max_tokens) if pd.isna(row.fixed) else int(row.fixed)
        # the block that leads a run, and the one after it, are answered without the run
        return pd.DataFrame(out[2:] if not pd.isna(rows["fixed"].iloc[0]) else out, columns=["block", "open_sum"])

    # after a block that leaves the same whatever was open nothing needs to be composed
    direct = maps.filter("fixed IS NOT NULL").select((F.col("block") + 1).alias("block"), F.col("fixed").alias("open_sum"))

    # a run: a block that leaves the same whatever was open, and those after it up to the next such one
    rows = maps.withColumns({"_row": F.floor(F.col("block") / BLOCKS_PER_ROW), "_is": F.col("fixed").isNotNull()})
    start = F.when(F.col("_is"), F.col("block"))
    here = Window.partitionBy("_row").orderBy("block")
    above = Window.partitionBy(F.lit(0)).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each BLOCK * BLOCKS_PER_ROW units
    upto = rows.groupBy("_row").agg(F.max(start).alias("_last")).select(
        "_row", F.max("_last").over(above).alias("_carried")
    )
    runs = rows.withColumn("_run", F.max(start).over(here)).join(upto, "_row")
    runs = runs.withColumn("_run", F.coalesce("_run", "_carried", F.lit(-1)))
    # runs of one such block are answered already
    runs = runs.join(runs.filter("NOT _is").select("_run").distinct(), "_run", "left_semi")
    # the block that ends a run needs its answer too, but not its map
    closing = maps.filter("fixed IS NOT NULL").select("block")
    follows = runs.select((F.col("block") + 1).alias("block"), F.col("_run").alias("_of"))
    ends = closing.join(follows, "block").select("block", F.col("_of").alias("_run"))
    columns = maps.columns
    empty = [F.lit(None).cast(kind).alias(c) for c, kind in maps.dtypes[1:]]
    asked = runs.select("_run", *columns).unionByName(ends.select("_run", "block", *empty))
    found = asked.groupBy("_run").applyInPandas(run, "block bigint, open_sum bigint")
    known = maps.select("block").join(found.unionByName(direct), "block", "left")
    return known.select("block", F.coalesce("open_sum", F.lit(0)).alias("open_sum"))


def packed_blocks(units: DataFrame, max_tokens: int) -> DataFrame:
    """``(block, chunks)``: for each block of units the numbers of their chunks over the whole collection, from 1.

    Takes ``units(n, doc_seq, para, long, tokens)``, ``n`` counting from 0 without gaps.
    """
    spark = units.sparkSession
    blocks = in_blocks(units.select("n", "doc_seq", "para", "long", "tokens"))
    maps = materialize(blocks.groupBy("block").applyInPandas(_maps(max_tokens), MAPS), workspace(spark, "unit-maps"))
    entered = blocks.join(open_sums(maps, max_tokens), "block")

    def places(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, max_tokens)
        opened = block.opened(int(rows["open_sum"].iloc[0]))
        return pd.DataFrame({"block": [key[0]], "opened": [opened]}).iloc[: block.n]

    found = entered.groupBy("block").applyInPandas(places, "block bigint, opened array<bigint>")
    found = materialize(found, workspace(spark, "unit-places"))
    counts = found.select("block", F.element_at("opened", -1).alias("chunks"))
    # the offset is handed to the loop as a column, never captured in it
    here = F.arrays_zip(F.col("opened"), F.array_repeat("before", F.size("opened")).alias("before"))
    return found.join(running_offsets(counts, "block", "chunks"), "block").select(
        "block", F.transform(here, lambda x: x["opened"] + x["before"]).alias("chunks")
    )


def packed_units(units: DataFrame, max_tokens: int) -> DataFrame:
    """``(n, chunk)``: units in order get the number of their chunk over the whole collection, from 1."""
    each = packed_blocks(units, max_tokens).select("block", F.posexplode("chunks").alias("k", "chunk"))
    return each.select((F.col("block") * BLOCK + F.col("k")).alias("n"), "chunk")


# --- chunks ----------------------------------------------------------------------------------


def _shares(max_tokens: int):
    """What each block has of chunks: ``(doc_seq, chunk, b, whole, text)``."""
    names = ["doc_seq", "chunk", "b", "whole", "text"]

    def shares(row: dict, lines: Lines, texts: list[str], chunks: np.ndarray, b: int) -> list[tuple]:
        n, starts, long = lines.units(row, max_tokens)
        lowest = max(row["units_before"] - 1, 0)
        own = chunks[n - lowest]
        # ``chunks`` begin with that of the unit before the block, if there is one
        opens = np.diff(chunks, prepend=chunks[0] if row["units_before"] else 0)[n - lowest].astype(bool) & starts
        opens, starts, long = opens.tolist(), starts.tolist(), long.tolist()
        places, sizes, paras = (np.cumsum(lines.sizes) - lines.sizes).tolist(), lines.sizes.tolist(), lines.para.tolist()
        out, held, begin, whole = [], [], 0, False

        def close():
            out.append((int(lines.docs[lines.line[begin]]), int(own[begin]), b, whole, "".join(held)))

        for text, size, at, para in zip(texts, sizes, places, paras, strict=True):
            if not size:
                continue
            between, members = (" ", sentence_texts(text)) if long[para] else ("\n\n", [text])
            for k, member in enumerate(members, at):
                if opens[k]:
                    if held:
                        close()
                    held, begin, whole = [member.lstrip(WHITESPACE)], k, True
                elif starts[k]:
                    held += [between, member.lstrip(WHITESPACE)]
                else:
                    held += ["\n", member]
        # the last may go on in the next block
        whole = False
        close()
        return out

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, chunks, numbers = part.column("texts"), part.column("chunks"), part.column("b")
            for row, lines, k in _known(part):
                own = shares(row, lines, texts[k].as_py(), chunks[k].values.to_numpy(), numbers[k].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*own, strict=True)], names=names)

    return run


def chunk_long_documents(
    pieces: DataFrame, max_tokens: int = C.DEFAULT_MAX_TOKENS, patterns=C.BOILERPLATE_PATTERNS
) -> DataFrame:
    """``(doc_seq, chunk_index, total_chunks, text)`` of documents in ``pieces(doc_seq, piece_no, raw_text)``.

    Equal to cleaning and chunking whole documents with estimated counts.
    ``doc_seq`` is unique and not null, a document's ``piece_no`` ascends.
    """
    spark = pieces.sparkSession
    small_batches(spark)
    blocks = line_blocks(document_lines(pieces, patterns), max_tokens)
    numbers = block_numbers(blocks, max_tokens)
    units = materialize(line_units(blocks, numbers, max_tokens), workspace(spark, "units"))
    packed = packed_blocks(units, max_tokens)
    # the chunks of a block's units and of the one before them, from the blocks of units that they lie in
    low, high = F.greatest(F.col("units_before") - 1, F.lit(0)), F.col("units_before") + F.col("n_units") - 1
    asked = numbers.select("b", low.alias("low"), high.alias("high")).filter("low <= high")
    asked = asked.select("*", F.explode(F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK))).alias("block"))
    begin = F.greatest(F.col("low") - F.col("block") * BLOCK, F.lit(0)).cast("int")
    end = F.least(F.col("high") - F.col("block") * BLOCK, F.lit(BLOCK - 1)).cast("int")
    found = asked.join(packed, "block").select("b", "block", F.slice("chunks", begin + 1, end - begin + 1).alias("chunks"))
    found = found.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("block", "chunks"))).alias("found"))
    found = found.select("b", F.flatten(F.transform("found", lambda x: x["chunks"])).alias("chunks"))
    each = blocks.select("b", "docs", "texts", "sizes", "words", "ends").join(numbers, "b").join(found, "b")
    schema = "doc_seq bigint, chunk bigint, b bigint, whole boolean, text string"
    each = materialize(each.mapInArrow(_shares(max_tokens), schema), workspace(spark, "chunk-shares"))
    parts = F.sort_array(F.collect_list(F.struct("b", "text")))
    joined = each.filter("NOT whole").groupBy("doc_seq", "chunk").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text")
    )
    joined = materialize(joined, workspace(spark, "long-chunks"))
    told = each.filter("whole").select("doc_seq", "chunk", "text").unionByName(joined)
    totals = told.groupBy("doc_seq").agg(F.min("chunk").alias("first"), F.count("*").alias("total_chunks"))
    return told.join(totals, "doc_seq").select(
        "doc_seq", (F.col("chunk") - F.col("first")).cast("int").alias("chunk_index"),
        F.col("total_chunks").cast("int").alias("total_chunks"), "text",
    )
