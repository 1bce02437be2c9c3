"""Text files of any size, read in byte ranges.

A file is cut into ranges, and ranges of all files are dealt out in splits of
about equal bytes: many small files share a split, a large one has many. No task
holds more than a range.

Whether a whole file is UTF-8 is decided without holding it. A range is run
through the UTF-8 automaton from each of its states, which gives a map from the
state before the range to the state after it; at most three bytes differ between
these runs. Maps are composed in the order of the ranges. A file whose maps lead
from the first state back to it is UTF-8, any other is Latin-1. A file of one
range is decoded where it was read; the ranges of others are read once more when
their encoding is known. Each gives the characters that begin in it.
"""

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsheaf.functions.text import let
from docsheaf.operators.numbering import dense_numbers, running_offsets
from docsheaf.session import materialize, workspace
from docsheaf.sources import files as text_files

RANGE_BYTES, SPLIT_BYTES = 32 << 20, 128 << 20
#: What opening a file counts for, in bytes.
OPEN_COST = 64 << 10
#: Maps that are composed in one row.
MAPS_PER_ROW = 1024

# States: between characters; 1 to 3 bytes to come; after E0, ED, F0 and F4, which narrow the next byte; invalid.
BETWEEN, AFTER_E0, AFTER_ED, AFTER_F0, AFTER_F4, INVALID = 0, 4, 5, 6, 7, 8
#: (least, greatest, state before, state after) of the bytes.
STEPS = (
    (0x00, 0x7F, BETWEEN, BETWEEN),
    (0xC2, 0xDF, BETWEEN, 1), (0xE0, 0xE0, BETWEEN, AFTER_E0), (0xE1, 0xEC, BETWEEN, 2),
    (0xED, 0xED, BETWEEN, AFTER_ED), (0xEE, 0xEF, BETWEEN, 2), (0xF0, 0xF0, BETWEEN, AFTER_F0),
    (0xF1, 0xF3, BETWEEN, 3), (0xF4, 0xF4, BETWEEN, AFTER_F4),
    (0x80, 0xBF, 1, BETWEEN), (0x80, 0xBF, 2, 1), (0x80, 0xBF, 3, 2),
    (0xA0, 0xBF, AFTER_E0, 1), (0x80, 0x9F, AFTER_ED, 1), (0x90, 0xBF, AFTER_F0, 2), (0x80, 0x8F, AFTER_F4, 2),
)
PIECE_BYTES = 1 << 20


def step(state: int, byte: int) -> int:
    return next((after for low, high, before, after in STEPS if before == state and low <= byte <= high), INVALID)


def _end_between(raw: memoryview) -> int:
    """The state after bytes that begin between characters."""
    decoder = codecs.getincrementaldecoder("utf-8")("strict")
    try:
        for at in range(0, len(raw), PIECE_BYTES):
            decoder.decode(raw[at : at + PIECE_BYTES])
    except UnicodeDecodeError:
        return INVALID
    state = BETWEEN
    for byte in decoder.getstate()[0]:
        state = step(state, byte)
    return state


def end_states(raw: bytes) -> list[int]:
    """The state after the bytes, for each state before them."""
    view, known = memoryview(raw), {}

    def end(state: int) -> int:
        at = 0
        while state not in (BETWEEN, INVALID) and at < len(raw):
            state, at = step(state, raw[at]), at + 1
        if state != BETWEEN:
            return state
        if at not in known:
            known[at] = _end_between(view[at:])
        return known[at]

    return [end(state) for state in range(INVALID + 1)]


def _continued(raw: bytes) -> int:
    """How many bytes at the beginning belong to a character that began before."""
    n = 0
    while n < min(3, len(raw)) and 0x80 <= raw[n] <= 0xBF:
        n += 1
    return n


def piece_text(before: bytes, raw: bytes, behind: bytes, utf8: bool) -> str:
    """The characters that begin in ``raw``, with unified newlines, given its neighbours' bytes."""
    if before.endswith(b"\r") and raw.startswith(b"\n"):
        raw = raw[1:]
    if utf8:
        own = raw[_continued(raw) if before else 0 :]
        text = (own + behind[: _continued(behind)]).decode() if own else ""
    else:
        text = raw.decode("latin-1")
    return text.replace("\r\n", "\n").replace("\r", "\n")


# --- ranges and splits ---------------------------------------------------------------------


def byte_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row for each range of ``files(source, size)``: ``(..., ranges, range_no, start, length)``."""
    ranges = F.greatest(F.lit(1), F.ceil(F.col("size") / range_bytes)).cast("bigint")
    cut = files.withColumn("ranges", ranges).select("*", F.explode(F.sequence(F.lit(0), ranges - 1)).alias("range_no"))
    start = F.col("range_no") * range_bytes
    return cut.withColumns({"start": start, "length": F.least(F.lit(range_bytes), F.col("size") - start)})


def in_splits(files: DataFrame, range_bytes: int = RANGE_BYTES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The ranges, dealt out in the order of their files so that every partition has about ``split_bytes``."""
    spark = files.sparkSession
    # files are listed from stores: once, as a range sort reads its rows twice
    files = materialize(files, workspace(spark, "listed"))
    numbered = materialize(dense_numbers(files, ["source"], "file_no"), workspace(spark, "files"))
    sized = numbered.select("file_no", (F.col("size") + OPEN_COST).alias("cost"))
    total = sized.agg(F.coalesce(F.sum("cost"), F.lit(0))).first()[0]
    ranges = byte_ranges(numbered.join(running_offsets(sized, "file_no", "cost"), "file_no"), range_bytes)
    dealt = ranges.withColumn("_at", F.col("before") + F.col("start"))
    splits = max(1, -(-total // split_bytes))
    return dealt.repartitionByRange(splits, "_at").sortWithinPartitions("_at").drop("_at", "before", "file_no")


class _Opened:
    """The file of the row at hand, opened once for ranges that follow each other."""

    def __init__(self):
        self.source, self.file = None, None

    def read_at(self, source: str, length: int, start: int) -> bytes:
        from pyarrow import fs

        if source != self.source:
            self.close()
            store, path = fs.FileSystem.from_uri(text_files._uri(source))
            self.file, self.source = store.open_input_file(path), source
        return self.file.read_at(length, start)

    def close(self) -> None:
        file, self.source, self.file = self.file, None, None
        if file is not None:
            file.close()


def _read_together(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose ranges have at most ``PIECE_BYTES`` together, or one row."""
    for part in parts:
        at, size = 0, 0
        for k, length in enumerate(part.column("length").to_pylist()):
            if k > at and size + length > PIECE_BYTES:
                yield part.slice(at, k - at)
                at, size = k, 0
            size += length
        if part.num_rows:
            yield part.slice(at)


def _scanned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The content of files of one range, and the map of every range of others."""
    file = _Opened()
    for own in _read_together(parts):
        contents, maps, errors = [], [], []
        for row in own.to_pylist():
            content, ends, error = None, None, None
            try:
                raw = file.read_at(row["source"], row["length"], row["start"])
                if len(raw) < row["length"]:
                    raise OSError(f"{len(raw)} bytes of {row['length']} at {row['start']}")
                if row["ranges"] == 1:
                    content = raw
                else:
                    ends = end_states(raw)
            except Exception as problem:  # noqa: BLE001 - any problem becomes the file's reject
                error = str(problem).split("\n")[0]
                file.close()
            contents.append(content)
            maps.append(ends)
            errors.append(error)
        yield pa.RecordBatch.from_arrays(
            [*own.columns, pa.array(contents, pa.binary()), pa.array(maps, pa.list_(pa.int32())), pa.array(errors, pa.string())],
            [*own.schema.names, "content", "ends", "error"],
        )
    file.close()


def scan_ranges(ranges: DataFrame) -> DataFrame:
    """Add ``content``, ``ends`` and ``error`` to the ranges; one of the three is not null."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in ranges.dtypes)
    return ranges.mapInArrow(_scanned, f"{schema}, content binary, ends array<int>, error string")


def encodings(scanned: DataFrame) -> DataFrame:
    """``(source, utf8, error)`` of every file of several ranges; ``error`` is the first range's that has one."""

    def composed(maps, state):
        return F.aggregate(maps, state, lambda now, m: F.get(m["ends"], now))

    several = scanned.filter("ranges > 1").withColumn("row", F.floor(F.col("range_no") / MAPS_PER_ROW))
    first_error = F.min(F.when(F.col("error").isNotNull(), F.struct("range_no", "error")))
    rows = several.groupBy("source", "row").agg(
        F.array_sort(F.collect_list(F.struct("range_no", "ends"))).alias("maps"), first_error.alias("failed")
    )
    states = F.sequence(F.lit(0), F.lit(INVALID))
    whole = rows.select(
        "source", "row", "failed", let(F.col("maps"), lambda m: F.transform(states, lambda s: composed(m, s))).alias("ends")
    )
    per_file = whole.groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct("row", "ends"))).alias("maps"), F.min("failed").alias("failed")
    )
    return per_file.select(
        "source", (composed(F.col("maps"), F.lit(BETWEEN)) == BETWEEN).alias("utf8"), F.col("failed.error").alias("error")
    )


def _decoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    file = _Opened()
    for own in _read_together(parts):
        texts = []
        for row in own.to_pylist():
            first = max(0, row["start"] - 1)
            raw = file.read_at(row["source"], row["start"] - first + row["length"] + 3, first)
            begin = row["start"] - first
            end = begin + row["length"]
            texts.append(piece_text(raw[:begin], raw[begin:end], raw[end:], row["utf8"]))
        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(texts, pa.string())], [*own.schema.names, "raw_text"])
    file.close()


def read_text_pieces(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, split_bytes: int = SPLIT_BYTES
) -> tuple[DataFrame, DataFrame]:
    """The text files below ``path`` in pieces, and the rejects of those that could not be read.

    Pieces are ``(source, source_type, pieces, piece_no, raw_text)``; a file's
    pieces in order are its text. Blank and empty files have one piece.
    """
    listed = text_files.route_files(text_files.list_files(spark, path)).filter(F.col("source_type") == "file_txt")
    # contents of small files are written once; of the others maps, and then their pieces
    scanned = materialize(scan_ranges(in_splits(listed, range_bytes, split_bytes)), workspace(spark, "ranges"))
    several = encodings(scanned)
    whole = scanned.filter("content is not null").withColumn("raw_text", text_files.decode_text(F.col("content")))
    asked = scanned.filter("ranges > 1").drop("content", "ends", "error").join(
        several.filter("error is null").select("source", "utf8"), "source"
    )
    # the rows are small and what is read for them is not: dealt out by the bytes of their ranges
    cost = F.col("length") + F.when(F.col("range_no") == 0, OPEN_COST).otherwise(0)
    total = scanned.filter("ranges > 1").agg(F.coalesce(F.sum(cost), F.lit(0))).first()[0]
    asked = asked.repartitionByRange(max(1, -(-total // split_bytes)), "source", "start")
    asked = asked.sortWithinPartitions("source", "start")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in asked.dtypes)
    columns = ["source", "source_type", "ranges", "range_no", "raw_text"]
    cut = asked.mapInArrow(_decoded, f"{schema}, raw_text string").select(*columns)
    # whoever asks for pieces by their number would have all ranges read again for each question
    cut = materialize(cut, workspace(spark, "pieces"))
    pieces = whole.select(*columns).unionByName(cut)
    bad = scanned.filter("ranges = 1 and error is not null").select("source", "error").unionByName(
        several.filter("error is not null").select("source", "error")
    )
    rejects = text_files.unreadable_files(bad)
    return pieces.withColumnsRenamed({"ranges": "pieces", "range_no": "piece_no"}), rejects


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """``(source, source_type, raw_text)``: files whose text fits in a row, from their pieces."""
    one = pieces.filter("pieces = 1").select("source", "source_type", "raw_text")
    parts = F.array_sort(F.collect_list(F.struct("piece_no", "raw_text")))
    several = pieces.filter("pieces > 1").groupBy("source", "source_type").agg(
        F.array_join(F.transform(parts, lambda p: p["raw_text"]), "").alias("raw_text")
    )
    return one.unionByName(several)
