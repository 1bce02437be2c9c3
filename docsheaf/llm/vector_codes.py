"""Short codes of vectors: for each part of a vector the nearest entry of a small codebook.

Components become integers, ``floor(SCALE * x)``, and all further work is exact.
Every task packs its vectors into chunks. In a chunk, and for each part on its
own, the parts are sorted along a Hilbert curve and cut into flat blocks of
``BLOCK``, so that those of a block lie close together; a block stores the box
of its least and greatest components and their sums. Chunks are written once.

A round compares boxes with entries first. No point of a box is nearer to an
entry than the box is, or farther than the box's farthest corner, so an entry
farther from the box than some other's farthest corner is out. If one entry is
left, the block's stored sums are added to it and its parts are not looked at;
else the parts are compared with the entries of this shortlist, in integers. What
leaves a task are sums and counts of each entry.

Vectors that are null, or have a null, an infinite or an undefined component are
dropped. A vector shorter than the longest one, or than a multiple of ``PARTS``,
ends in zeros. Components beyond ``largest()`` in size, at eight parts of eight
about 2^27, are taken as that, as squared distances would not fit a long. Null
identifiers come last in the choice of the first entries; repeated identifiers
are ordered by their components, and rows repeated as a whole are coded each.
With fewer than ``ENTRIES`` vectors the codebooks have as many entries; an
empty table gives an empty one. Other columns, whatever their names, are not read.
"""

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf.llm.common import give_back, staged

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Parts of a block, and the vectors and bytes of a chunk.
BLOCK = 128
CHUNK_ROWS, CHUNK_BYTES = 1 << 14, 8 << 20

SUMS = "part int, entry int, at int, n bigint, total bigint"


def largest(size: int) -> int:
    """Components of up to this size have squared distances over ``size`` of them that fit a long."""
    return min(math.isqrt(2**62 // (4 * max(1, size))), 2**31 - 1)


# --- chunks


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """For each row the place of its cell on a Hilbert curve through the box of all rows.

    A key has 62 bits at most: of more than 62 components the first ones count.
    """
    points = points[:, :62]
    n, width = points.shape
    if not n or not width:
        return np.zeros(n, np.int64)
    bits = max(1, 62 // width)
    low, high = points.min(axis=0), points.max(axis=0)
    share = (points - low) / np.maximum(high - low, 1)
    x = np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1).T.copy()
    # turn and mirror the cells from the largest to the smallest, then take the Gray code's rank
    step = 1 << (bits - 1)
    while step > 1:
        low_bits = step - 1
        for k in range(width):
            far = (x[k] & step) != 0
            swap = np.where(far, 0, (x[0] ^ x[k]) & low_bits)
            x[0] ^= np.where(far, low_bits, swap)
            x[k] ^= swap
        step >>= 1
    for k in range(1, width):
        x[k] ^= x[k - 1]
    flip, step = np.zeros(n, np.int64), 1 << (bits - 1)
    while step > 1:
        flip ^= np.where(x[-1] & step, step - 1, 0)
        step >>= 1
    x ^= flip
    keys = np.zeros(n, np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(width):
            keys = keys << 1 | (x[k] >> bit & 1)
    return keys


def block_starts(n: int) -> np.ndarray:
    return np.append(np.arange(0, n, BLOCK), n)


class Chunk:
    """For each part its sorted vectors, their places, and the boxes and sums of their blocks."""

    def __init__(self, row: dict, parts: int, width: int):
        n = row["n"]
        self.n, self.starts = n, block_starts(n)
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.order = read("places", "<u4").reshape(parts, n)
        self.values = read("components", "<i4").reshape(parts, n, width)
        blocks = len(self.starts) - 1
        self.low = read("low", "<i4").reshape(parts, blocks, width)
        self.high = read("high", "<i4").reshape(parts, blocks, width)
        self.sums = read("sums", "<i8").reshape(parts, blocks, width)


def _packed(components: np.ndarray, parts: int) -> dict:
    n, width = len(components), components.shape[1] // parts
    cells = components.reshape(n, parts, width)
    starts = block_starts(n)[:-1]
    out = {name: [] for name in ("places", "components", "low", "high", "sums")}
    for part in range(parts):
        own = cells[:, part]
        places = np.argsort(hilbert_keys(own), kind="stable")
        own = own[places]
        out["places"].append(places.astype("<u4").tobytes())
        out["components"].append(own.astype("<i4").tobytes())
        for name, what in (("low", np.minimum), ("high", np.maximum), ("sums", np.add)):
            kind = "<i8" if name == "sums" else "<i4"
            out[name].append(what.reduceat(own, starts, axis=0).astype(kind).tobytes())
    return {"n": n, **{name: b"".join(pieces) for name, pieces in out.items()}}


def integers(vectors: pa.Array, size: int) -> np.ndarray:
    """A row of ``size`` components for each vector, zeros after its last."""
    lengths = pc.list_value_length(vectors).to_numpy().astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    most = float(largest(size))
    out = np.zeros((len(vectors), size), np.int64)
    row = np.repeat(np.arange(len(vectors)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = np.clip(np.floor(flat * SCALE), -most, most).astype(np.int64)
    return out


def _chunks(size: int, parts: int, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = max(1, min(CHUNK_ROWS, CHUNK_BYTES // max(1, 4 * size)))
    held = []

    def chunk(table: pa.Table) -> pa.RecordBatch:
        whole = {name: table.column(name).combine_chunks() for name in ("vec_id", "label", "vector")}
        own = _packed(integers(whole["vector"], size), parts)
        ends = pa.array([0, len(table)], pa.int32())
        lists = {name: pa.ListArray.from_arrays(ends, whole[name]) for name in ("vec_id", "label")}
        return pa.RecordBatch.from_arrays(
            [lists[f.name] if f.name in lists else pa.array([own[f.name]], f.type) for f in schema], schema.names
        )

    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held)
            yield chunk(table.slice(0, rows))
            held = table.slice(rows).to_batches()
    if sum(b.num_rows for b in held):
        yield chunk(pa.Table.from_batches(held))


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows whose vectors are whole."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.filter(F.col("vector").isNotNull() & F.forall("vector", finite))


def chunks(rows: DataFrame, size: int, parts: int) -> DataFrame:
    kinds = dict(rows.dtypes)
    fields = f"n int, vec_id array<{kinds['vec_id']}>, label array<{kinds['label']}>, places binary, "
    fields += "components binary, low binary, high binary, sums binary"
    kinds = {"n": pa.int32(), "vec_id": None, "label": None}
    names = [f.split()[0] for f in fields.split(", ")]
    schema = pa.schema([(name, kinds.get(name) or pa.binary()) for name in names])
    return staged(rows.mapInArrow(partial(_chunks, size, parts, schema), fields), "vector-chunks")


# --- rounds


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """A row for each block: which entries can be the nearest of a point in its box."""
    low, high = low[:, None].astype(np.int64), high[:, None].astype(np.int64)
    gap = np.maximum(np.maximum(low - entries, entries - high), 0)
    reach = np.maximum(np.abs(low - entries), np.abs(high - entries))
    least, most = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
    return least <= most.min(axis=1)[:, None]


def nearest(values: np.ndarray, sizes: np.ndarray, lists: np.ndarray, entries: np.ndarray) -> tuple:
    """For each part its nearest entry of its block's shortlist, the first of equals, and the squared distance."""
    best = np.full(len(values), -1, np.int64)
    code = np.zeros(len(values), np.int64)
    for entry, asked in enumerate(lists.T):
        rows = np.flatnonzero(np.repeat(asked, sizes))
        off = values[rows] - entries[entry]
        far = (off * off).sum(axis=1)
        nearer = (best[rows] < 0) | (far < best[rows])
        code[rows[nearer]], best[rows[nearer]] = entry, far[nearer]
    return code, best


def _sums(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, entries, width = books.shape
    total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
    for row in _rows(batches):
        chunk = Chunk(row, parts, width)
        sizes = np.diff(chunk.starts)
        for part in range(parts):
            lists = shortlists(chunk.low[part], chunk.high[part], books[part])
            sure = lists.sum(axis=1) == 1
            first = lists.argmax(axis=1)
            np.add.at(total[part], first[sure], chunk.sums[part][sure])
            np.add.at(count[part], first[sure], sizes[sure])
            rows = np.flatnonzero(np.repeat(~sure, sizes))
            values = chunk.values[part][rows].astype(np.int64)
            code, _ = nearest(values, sizes[~sure], lists[~sure], books[part])
            np.add.at(total[part], code, values)
            count[part] += np.bincount(code, minlength=entries)
    part, entry = np.nonzero(count)
    # an entry's count travels with every component, and alone where there is none
    at = np.tile(np.arange(max(1, width)), len(part))
    part, entry = np.repeat(part, max(1, width)), np.repeat(entry, max(1, width))
    sums = total[part, entry, at] if width else np.zeros(len(at), np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()),
         pa.array(count[part, entry]), pa.array(sums)],
        ["part", "entry", "at", "n", "total"],
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One chunk at a time; memory held for the ones before is given back."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield dict(zip(batch.schema.names, (c[k].as_py() for c in batch.columns), strict=True))
            give_back()


def next_books(chunked: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry replaced by the mean of its parts, rounded down."""
    columns = chunked.select("n", "places", "components", "low", "high", "sums")
    wide = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    found = columns.mapInArrow(partial(_sums, books), SUMS).groupBy("part", "entry", "at").agg(wide("n"), wide("total"))
    out = books.copy()
    # a row for each component of the codebooks at most
    for part, entry, at, n, total in found.collect():
        if books.shape[2]:
            out[part, entry, at] = int(total) // int(n)
    return out


def first_books(rows: DataFrame, size: int, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest identifiers."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).toArrow()
    own = integers(first.column("vector").combine_chunks(), size)
    return own.reshape(len(own), parts, size // parts).transpose(1, 0, 2).copy()


def trained(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """The chunks of all whole vectors, and their codebooks: part, entry, component."""
    rows = usable(vectors)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    size = -(-longest // parts) * parts
    chunked = chunks(rows, size, parts)
    books = first_books(rows, size, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        books = next_books(chunked, books)
    return chunked, books


def _codes(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    for batch in batches:
        for k in range(batch.num_rows):
            own = batch.slice(k, 1)
            row = {name: own.column(name)[0].as_py() for name in own.schema.names if name not in ("vec_id", "label")}
            chunk = Chunk(row, parts, width)
            codes, error = np.zeros((chunk.n, parts), np.uint8), np.zeros(chunk.n, np.int64)
            for part in range(parts):
                lists = shortlists(chunk.low[part], chunk.high[part], books[part])
                values = chunk.values[part].astype(np.int64)
                code, far = nearest(values, np.diff(chunk.starts), lists, books[part])
                codes[chunk.order[part], part] = code
                error[chunk.order[part]] += far
            raw = pa.py_buffer(codes.tobytes())
            code = pa.Array.from_buffers(pa.binary(parts), chunk.n, [None, raw]).cast(pa.binary())
            ids, labels = own.column("vec_id").flatten(), own.column("label").flatten()
            yield pa.RecordBatch.from_arrays([ids, labels, code, pa.array(error)], ["vec_id", "label", "code", "error"])
            give_back()


def coded(chunked: DataFrame, books: np.ndarray) -> DataFrame:
    """``(vec_id, label, code, error)``: a byte for each part, and the sum of the squared distances."""
    kinds = dict(chunked.dtypes)
    inner = lambda name: kinds[name].removeprefix("array<").removesuffix(">")
    schema = f"vec_id {inner('vec_id')}, label {inner('label')}, code binary, error bigint"
    return chunked.mapInArrow(partial(_codes, books), schema)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def digest(vectors: DataFrame) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every whole vector."""
    chunked, books = trained(vectors)
    rows = staged(coded(chunked, books), "vector-codes")
    labels = rows.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return rows.join(labels, _same(F.col("label"), F.col("_label"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )
