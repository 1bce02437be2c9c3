"""Token ids of documents in a compressed file format of blocks.

Format. A store is a folder of two tables. ``codes`` has a row for each id that
occurs: ``(id, length)``. The codes are canonical: ordered by length, then id,
they are consecutive binary numbers, so the lengths say it all. They are those
of a length-limited Huffman code of the ids' counts over the whole corpus.
``blocks`` has a row for each block of whole documents: the codes of its ids
end to end, first bit first, as ``payload``; ``bits``, the position of the code
of every ``EVERY``-th id; the documents with the number of ids of each; the
block's range (``part``) and its ids before it in that range. Documents ascend
within a block, blocks within a range, ranges by number. Every block is decoded
on its own, from all its checkpoints at once, by one table lookup an id.

Null texts count as empty and have the end id alone. A null identifier sorts
first. Repeated rows are stored each. An empty table gives an empty store.
Other columns, whatever their names, are not read.
"""

import re
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import partial
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsheaf.llm.common import batches, split_words, staged, string_bytes
from docsheaf.session import workspace

END_ID = 2
#: Longest code: a decoding table of 2**20 entries.
LONGEST = 20
#: Ids from one checkpoint to the next, and ids after which a block is closed.
EVERY = 64
BLOCK_IDS = 1 << 17
#: Pieces of words whose ids a Python worker remembers at most, but for those of a batch.
REMEMBERED = 600_000
#: Documents of a batch: the more there are, the fewer pieces are looked up twice.
BATCH_ROWS = 2048

IDS = "doc_id bigint, n_tokens bigint, ids binary"
BLOCKS = (
    "part int, before bigint, doc_ids array<bigint>, sizes array<bigint>, bits array<bigint>, payload binary"
)
NAMES = ["part", "before", "doc_ids", "sizes", "bits", "payload"]


# --- tokens

#: A text with this can hold a special token, which is found before words are.
SPECIAL = "<|"
#: Lower-case Latin letters of two bytes, and their capitals: composed, and no combining mark among them.
LATIN, CAPITAL = "ß-öø-ÿā-įı-ſ", "À-ÖØ-Þ"


def byte_letters() -> dict[int, str]:
    """The tokenizer's letter for every byte: itself where that can be printed, else the next from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(0x100) if byte not in printed]
    return {byte: chr(byte) for byte in printed} | {byte: chr(0x100 + k) for k, byte in enumerate(others)}


token_id = attrgetter("id")


class WordTokens:
    """Ids of whole texts, each distinct piece of a word tokenised once.

    The tokenizer drops white space, lower-cases, and never joins what white
    space parts, so the ids of a text are those of its words. Words of printable
    ASCII and composed Latin letters are cut into the tokenizer's pieces here and
    each distinct piece goes to its model; other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Fixed value: the tokenizer's own pieces, for the lower-case characters here
        letters = f"a-z{LATIN}"
        self.pieces = f"('s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^{letters}0-9]+)"
        self.other = f"[^!-~{LATIN}{CAPITAL}]"
        self.is_other = re.compile(self.other).search
        self.letters = byte_letters()
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.array = partial(array, "H" if self.kind == "<u2" else "I")
        # pieces used of late, and those used before them; frequent ones stay
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def piece(self, piece: str) -> bytes:
        if self.is_other(piece):
            return self.whole(piece)
        spelt = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        # of few numbers, an array of Python's own is made sooner than one of numpy
        return self.array(map(token_id, self.model.tokenize(spelt))).tobytes()

    def words(self, words: pa.Array) -> pa.Array:
        """The ids of each word."""
        other = pc.match_substring_regex(words, self.other)
        lower = pc.if_else(other, words, pc.utf8_lower(words))
        # other words, and those of letters alone, are one piece
        several = pc.invert(pc.or_(other, pc.utf8_is_alpha(lower)))
        cut = pc.replace_substring_regex(lower.filter(several), self.pieces, r"\1 ")
        pieces, starts = split_words(pc.replace_with_mask(lower, several, cut))
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = list(map(self.known.get, distinct))
        for k in [k for k, ids in enumerate(found) if ids is None]:
            piece = distinct[k]
            ids = self.older.get(piece)
            found[k] = self.known[piece] = self.piece(piece) if ids is None else ids
        raw, at = string_bytes(pa.array(found, pa.binary()).take(coded.indices))
        offsets = pa.py_buffer(at[starts].astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(words), [None, offsets, pa.py_buffer(raw)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, the end id after each, and where each text's begin."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        special = pc.match_substring(texts, SPECIAL)
        words, starts = split_words(texts, lower=True)
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy()
        # an entry more: the end of a text
        end = pa.array([np.array([END_ID], self.kind).tobytes()], pa.binary())
        found = pa.concat_arrays([self.words(coded.dictionary), end])
        ends = np.insert(index, starts[1:], len(found) - 1)
        raw, at = string_bytes(found.take(pa.array(ends)))
        ids = raw.view(self.kind)
        bounds = at[starts + np.arange(len(starts))] // ids.itemsize
        for k in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist()[::-1]:
            own = np.append(np.frombuffer(self.whole(texts[k].as_py()), self.kind), np.array(END_ID, self.kind))
            ids = np.concatenate([ids[: bounds[k]], own, ids[bounds[k + 1] :]])
            bounds[k + 1 :] += len(own) - (bounds[k + 1] - bounds[k])
        return ids, bounds


def in_worker(name: str, make: Callable):
    """An object that lives as long as its Python worker, shared by the worker's tasks."""
    kept = sys.modules.setdefault("_docsheaf_worker", types.ModuleType("_docsheaf_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def _encode(path: str, part: pa.RecordBatch):
    tokens = in_worker("tokens:" + path, lambda: WordTokens(path))
    ids, bounds = tokens(part.column("text"))
    offsets = pa.py_buffer((bounds * ids.itemsize).astype(np.int32))
    data = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(ids))])
    return [part.column("doc_id"), np.diff(bounds), data]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)``: little-endian ids of every document, as narrow as the vocabulary lets."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(batches(partial(_encode, path), ["doc_id", "n_tokens", "ids"], BATCH_ROWS), IDS)


def _numbers(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of encoded rows and the number of each row."""
    sizes = part.column("n_tokens").to_numpy()
    data = part.column("ids")
    raw, _ = string_bytes(data)
    width = len(raw) // max(1, int(sizes.sum())) or 2
    return raw.view(f"<u{width}").astype(np.int64), sizes


# --- the code


def id_counts(ids: DataFrame) -> DataFrame:
    """``(id, n)`` over all encoded rows; each task adds up its own first."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in parts:
            own = np.bincount(_numbers(part)[0], minlength=len(total))
            own[: len(total)] += total
            total = own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return ids.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code of at most ``longest`` bits, or as many as the symbols need, by package-merge.

    Each round pairs up the cheapest entries of the one before and merges the
    pairs with the symbols. The cheapest 2n - 2 entries of the last round are
    followed back: a symbol is as long as the number of rounds it appears in.
    """
    n = len(counts)
    if n <= 2:
        return np.ones(n, np.int64)
    longest = max(longest, (n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    weights = np.asarray(counts, np.int64)[order]
    row, symbols = weights, [np.ones(n, bool)]
    for _ in range(longest - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        sort = np.argsort(both, kind="stable")
        row = both[sort]
        symbols.append(sort < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_symbol in reversed(symbols):
        # symbols come in order of weight, so those taken are the first ones
        singles = int(is_symbol[:take].sum())
        lengths[:singles] += 1
        take = 2 * (take - singles)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical prefix code."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order], lengths[order]
        self.width = int(lengths.max()) if len(ids) else 1
        # each code takes a share of all words of ``width`` bits, in order
        share = 1 << (self.width - self.lengths)
        start = np.cumsum(share) - share
        self.codes = start >> (self.width - self.lengths)
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code_of, self.length_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = self.codes, self.lengths

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The codes end to end, and the bit where that of every ``EVERY``-th id begins."""
        lengths = self.length_of[ids]
        at = np.cumsum(lengths) - lengths
        word, shift = at >> 5, 64 - (at & 31) - lengths
        value = self.code_of[ids].astype(np.uint64) << shift.astype(np.uint64)
        words = np.zeros(int(at[-1] + lengths[-1] >> 5) + 2 if len(ids) else 0, np.int64)
        # codes do not overlap, so sums of their halves are the words
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        if len(ids):
            high = (value >> np.uint64(32)).astype(np.int64)
            low = (value & np.uint64(0xFFFFFFFF)).astype(np.int64)
            words[word[starts]] += np.add.reduceat(high, starts)
            words[word[starts] + 1] += np.add.reduceat(low, starts)
        return words.astype(">u4").tobytes(), at[::EVERY]

    def table(self) -> np.ndarray:
        """For every word of ``width`` bits the id whose code it begins with, and its length in the lowest six bits."""
        entry = self.ids << 6 | self.lengths
        entry = entry.astype(np.int32 if not len(entry) or entry.max() < 1 << 31 else np.int64)
        filled = np.repeat(entry, 1 << (self.width - self.lengths))
        # words that begin with no code
        return np.append(filled, np.repeat(filled[-1:], max(0, (1 << self.width) - len(filled))))

    @staticmethod
    def unpack(payload: bytes, bits: np.ndarray, n: int, width: int, table) -> np.ndarray:
        """``n`` ids, an id from every checkpoint at a time."""
        if not n:
            return np.zeros(0, np.int64)
        words = np.frombuffer(payload + bytes(8), ">u4").astype(np.uint64)
        # from every word on 64 bits
        words = words[:-1] << np.uint64(32) | words[1:]
        at, least, most = bits.copy(), 64 - width, (1 << width) - 1
        out = np.zeros((EVERY, len(at)), table.dtype)
        last = n - EVERY * (len(at) - 1)
        for k in range(EVERY):
            if k == last:
                at = at[:-1]
                if not len(at):
                    break
            window = words[at >> 5] >> (least - (at & 31)).astype(np.uint64)
            entry = table[window.astype(np.int64) & most]
            out[k, : len(at)] = entry
            at = at + (entry & 63)
        return (out.T.reshape(-1)[:n] >> 6).astype(np.int64)


def corpus_code(counts: DataFrame) -> Code:
    """The code of ``counts(id, n)``: a row for each id, so at most the vocabulary comes to the driver."""
    rows = counts.toPandas()
    ids = rows["id"].to_numpy(np.int64)
    return Code(ids, code_lengths(rows["n"].to_numpy(np.int64)))


# --- files


def _blocks(code: Code, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted rows of one range."""
    from pyspark import TaskContext

    part, before = TaskContext.get().partitionId(), 0
    docs, sizes, held = [], [], []

    def close():
        payload, bits = code.pack(np.concatenate(held))
        row = [part, before, pa.concat_arrays(docs).to_pylist(), np.concatenate(sizes).tolist(), bits.tolist(), payload]
        schema = pa.schema(
            [("part", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
             ("sizes", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())), ("payload", pa.binary())]
        )
        return pa.RecordBatch.from_pylist([dict(zip(NAMES, row, strict=True))], schema)

    for batch in parts:
        ids, count = _numbers(batch)
        ends = np.cumsum(count)
        # a document belongs to the block in which it begins
        block = (ends - count) // BLOCK_IDS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(count)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            docs.append(pc.add(batch.column("doc_id").slice(lo, hi - lo), 0))
            sizes.append(count[lo:hi])
            held.append(ids[ends[lo] - count[lo] : ends[hi - 1]])
            if sum(map(len, held)) >= BLOCK_IDS:
                yield close()
                before += sum(map(len, held))
                docs, sizes, held = [], [], []
    if docs:
        yield close()


def write_store(docs: DataFrame, path: str, tokenizer: str, partitions: int | None = None) -> None:
    """Encode all documents and write them, ascending by identifier, to a store at ``path``."""
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = staged(encoded(docs, tokenizer), "token-ids")
    code = corpus_code(id_counts(ids))
    table = pa.table({"id": code.ids, "length": code.lengths})
    spark.createDataFrame(table.to_pandas(), "id bigint, length bigint").coalesce(1).write.parquet(f"{path}/codes")
    # repeated and null identifiers are dealt by their rows
    keys = ["doc_id", F.xxhash64("ids"), "n_tokens"]
    ordered = ids.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys, "ids")
    ordered.mapInArrow(partial(_blocks, code), BLOCKS).write.parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str, function: Callable, columns: list[str], schema: str) -> DataFrame:
    """Apply ``function(doc_ids, sizes, ids, starts)`` to every decoded block.

    ``starts`` are the numbers of ids in the whole store before each document.
    """
    lengths = spark.read.parquet(f"{path}/codes").toPandas()
    code = Code(lengths["id"].to_numpy(np.int64), lengths["length"].to_numpy(np.int64))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # a row for each range
    totals = blocks.select("part", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    rows = totals.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    offsets, total = {}, 0
    for part, n in rows:
        offsets[part] = total
        total += n

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = code.table()
        for batch in parts:
            for part, before, docs, sizes, bits, payload in zip(*batch.columns, strict=True):
                sizes = sizes.values.to_numpy()
                ids = code.unpack(payload.as_py(), bits.values.to_numpy(), int(sizes.sum()), code.width, table)
                starts = offsets[part.as_py()] + before.as_py() + np.cumsum(sizes) - sizes
                yield from pa.table(function(docs.values, sizes, ids, starts), names=columns).to_batches()

    return blocks.mapInArrow(decode, schema)


def _checksums(docs: pa.Array, sizes: np.ndarray, ids: np.ndarray, starts: np.ndarray):
    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes) * 4
    begin = ends - sizes * 4
    sums = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
    return [docs, starts, sizes, np.array(sums, np.int64)]


def store_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write a store and read it back: ``(doc_id, start, n_tokens, ids_crc32)``."""
    path = workspace(docs.sparkSession, "token-store")
    write_store(docs, path, tokenizer)
    return read_store(
        docs.sparkSession, path, _checksums, ["doc_id", "start", "n_tokens", "ids_crc32"],
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    )
