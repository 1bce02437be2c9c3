"""Scores of texts under an n-gram model held in a log-frequency Bloom filter.

Texts are taken in batches of documents. Of its distinct words and word pairs,
each batch sends one block of hashes and counts to every shard of the hash
space, so what is shuffled are a few large rows, combined before. How many
shards there are follows from the corpus: from its tokens for pairs, and for
words from the distinct hashes in a fixed share of the hash space. A task has its
blocks in the order of their shards and adds them up one after another, so it
holds one shard. A shard of words keeps the exact counts; a shard of pairs is a Bloom
filter of the counts, quantised to powers of two: a pair of level q is held under
the levels 1 to q, and its level is read by asking for one after another.

The filter is broadcast while all its shards take at most ``BROADCAST_BYTES``, with
a level for each token trained on. Beyond that pairs travel once: each batch sends its
pairs to their shards with their counts, and a task that has all blocks of a shard
makes its filter and answers them. Words are asked for in a second pass, as what
is known of them is needed by all. Both ways read the same bits and give the same scores.
Blocks are cut, read and answered many at once, as they get more and smaller with the corpus.

A pair's probability is that of its count with ``PRIOR`` pseudo-counts shared
out by the words' smoothed probabilities. A false positive of the filter can
only appear for two known words and is bounded by their counts. A level stands
for the mean of its counts, so the chances of a word's followers add up to one
only nearly.

Documents whose identifier, as text, has a CRC-32 divisible by ten are held out
of training; a null identifier is. Null and blank texts have the end token
alone. Repeated rows are trained on and scored each, an empty table gives an
empty one. Other columns, whatever their names, are not read.
"""

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsheaf.llm.common import cuts, give_back, per_text, split_words, staged
from docsheaf.session import small_batches

#: Documents of a batch.
BATCH = 512
#: Bytes of rows that Spark sends to Python at once.
ROWS_BYTES = 4 << 20
PSEUDO = 0.1
PRIOR = 16.0
#: Keys that a task adds up before it sends them on.
HELD_KEYS = 400_000
#: Tokens to a shard of pairs, and distinct words to a shard of words; one word hash in ``SAMPLED`` is counted for that.
PAIR_TOKENS, SHARD_WORDS, SAMPLED = 1 << 20, 1 << 17, 1 << 8
#: Questions for words, over all batches, to a shard of words.
SHARD_QUESTIONS = 1 << 22
LEAST_SHARDS = 16
#: Bits of the filter for each level of each pair, and probes for each.
BITS, PROBES = 6, 4
BROADCAST_BYTES = 64 << 20

#: No word has these bytes.
END, BEGIN = b"\n", b" "

BATCHES = (
    "batch bigint, doc_ids array<bigint>, held array<boolean>, starts binary, tokens binary, words binary, "
    "n_tokens bigint, n_train bigint, sample array<bigint>"
)
WORDS, PAIRS = 0, 1
BLOCKS = "kind int, shard int, keys binary, counts binary"
MODEL = "kind int, shard int, n_tokens bigint, n_keys bigint, keys binary, data binary"
PAIR_BLOCKS = "shard int, batch bigint, keys binary, counts binary"
ANSWERS = "batch bigint, shard int, found binary"
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _record(schema: str, **values) -> pa.RecordBatch:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()),
    }
    fields = [column.split() for column in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([values[name]], kinds[kind]) for name, kind in fields], [name for name, _ in fields]
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(before * np.uint64(0x9E3779B97F4A7C15) + word)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys >> np.uint64(33)).astype(np.int64) % shards


class Shards(NamedTuple):
    """Number of shards of words and of pairs."""

    words: int
    pairs: int


# --- batches


def _to_planes(numbers: np.ndarray) -> bytes:
    """Lowest bytes first, then the next: the upper ones are almost all zero and compress away."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for part in parts:
        for at, end in cuts(part, BATCH):
            own = part.slice(at, end - at)
            words, starts = split_words(own.column("text"), lower=True)
            coded = words.dictionary_encode()
            names = [END, BEGIN, *[w.encode() for w in coded.dictionary.to_pylist()]]
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
            tokens = np.insert(coded.indices.to_numpy().astype(np.uint32) + 2, starts[1:], 0)
            held = own.column("held").to_pylist()
            yield _record(
                BATCHES,
                batch=number,
                doc_ids=own.column("doc_id").to_pylist(),
                held=held,
                starts=(starts + np.arange(len(starts))).tobytes(),
                tokens=_to_planes(tokens),
                words=hashes.tobytes(),
                n_tokens=len(tokens),
                n_train=int((np.diff(starts) + 1)[~np.array(held, bool)].sum()),
                sample=hashes[hashes % np.uint64(SAMPLED) == 0].view(np.int64).tolist(),
            )
            number += 1
            give_back()


class Batch:
    """A batch of tokenised documents. Tokens are places in ``words``; 0 is the end, 1 the beginning."""

    def __init__(self, row: dict):
        self.doc_ids, self.held = row.get("doc_ids"), np.array(row.get("held", []), bool)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.tokens = _from_planes(row["tokens"])
        self.words = np.frombuffer(row["words"], np.uint64)
        self.before = np.insert(self.tokens[:-1], 0, 1)
        self.before[self.starts[:-1]] = 1

    @property
    def pairs(self) -> np.ndarray:
        return pair_keys(self.words[self.before], self.words[self.tokens])


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time; memory held for the ones before is given back now and then."""
    for part in parts:
        for k in range(part.num_rows):
            yield {name: column[k].as_py() for name, column in zip(part.schema.names, part.columns, strict=True)}
            if k % 16 == 15:
                give_back()
        give_back()


def tokenised(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("string")
    held = F.coalesce(F.pmod(F.crc32(doc_id), F.lit(10)) == 0, F.lit(True)).alias("held")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), held)
    return staged(rows.mapInArrow(_batches, BATCHES), "batches")


def shards_for(batches: DataFrame) -> Shards:
    """As many shards as keep each of them small."""
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", F.octet_length("words"))]
    tokens, asked = batches.agg(*sums).first()
    words = batches.select(F.explode("sample").alias("word")).agg(F.count_distinct("word")).first()[0] * SAMPLED
    return Shards(
        max(LEAST_SHARDS, -(-words // SHARD_WORDS), -(-asked // 8 // SHARD_QUESTIONS)),
        max(LEAST_SHARDS, -(-tokens // PAIR_TOKENS)),
    )


# --- counting


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that has keys by their shards, the shards that have some, and where their keys begin and end in it."""
    shard = shard_of(keys, shards)
    # sorted digit by digit
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    full = np.flatnonzero(np.diff(bounds))
    return order, full, np.append(bounds[full], len(keys))


def _strings(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between each bound and the next."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )


def _values(strings: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in an array of byte strings, end to end, and the bounds of each."""
    wide = pa.types.is_large_binary(strings.type)
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    # copied, as numbers must begin at multiples of their size
    return np.frombuffer(raw.tobytes(), kind), (at - at[0]).astype(np.int64) // np.dtype(kind).itemsize


def _alike(part: pa.RecordBatch, *columns: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Neighbouring rows of the same values in ``columns``, and those."""
    if not part.num_rows:
        return
    own = [part.column(c).to_numpy() for c in columns]
    new = np.logical_or.reduce([x[1:] != x[:-1] for x in own])
    at = np.concatenate([[0], np.flatnonzero(new) + 1, [part.num_rows]]).tolist()
    for begin, end in zip(at[:-1], at[1:], strict=True):
        yield tuple(int(x[begin]) for x in own), part.slice(begin, end - begin)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _count(shards: Shards, kinds: tuple[int, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of counts for every shard; batches are added up as far as ``HELD_KEYS`` allows."""
    held = {kind: [] for kind in kinds}

    def sent(kind: int) -> pa.RecordBatch:
        keys, n = _summed(held[kind])
        held[kind].clear()
        order, full, bounds = _by_shard(keys, shards[kind])
        columns = [np.full(len(full), kind, np.int32), full.astype(np.int32)]
        blocks = [_strings(keys[order], bounds), _strings(n[order].astype("<u4"), bounds)]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), *blocks], ["kind", "shard", "keys", "counts"])

    for batch in map(Batch, _rows(parts)):
        train = np.repeat(~batch.held, np.diff(batch.starts))
        counts = np.bincount(batch.tokens[train], minlength=len(batch.words))
        used = np.flatnonzero(counts)
        held[WORDS].append((batch.words[used], counts[used]))
        if PAIRS in held:
            held[PAIRS].append(np.unique(batch.pairs[train], return_counts=True))
        for kind, own in held.items():
            if sum(len(k) for k, _ in own) > HELD_KEYS:
                yield sent(kind)
    for kind, own in held.items():
        if own:
            yield sent(kind)


def _positions(keys: np.ndarray, level: int, probe: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salt = np.uint64(level * PROBES + probe + 1) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed(keys + salt) % np.uint64(size)).astype(np.int64)


def build_filter(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of a filter, a level for every power of two up to each count."""
    levels = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    size = max(64, int(levels.sum()) * BITS)
    bits = np.zeros(-(-size // 8) * 8, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        held = keys[levels >= level]
        for probe in range(PROBES):
            bits[_positions(held, level, probe, len(bits))] = True
    return np.packbits(bits, bitorder="little")


def read_levels(keys: np.ndarray, bits: np.ndarray, offset, size) -> np.ndarray:
    """The level of every key: the last of those found one after another from the first.

    ``offset`` and ``size`` say, for all keys or for each, where the bits of its shard lie.
    """
    out = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    size = np.broadcast_to(np.asarray(size, np.uint64), len(keys))
    offset = np.broadcast_to(np.asarray(offset, np.int64), len(keys))
    level = 1
    while len(live):
        for probe in range(PROBES):
            at = _positions(keys[live], level, probe, size[live]) + offset[live]
            live = live[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        out[live] = level
        level += 1
    return out


def _shard(kind: int, shard: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, counts = _summed(held)
    kept, data = (keys, counts.tobytes()) if kind == WORDS else (keys[:0], build_filter(keys, counts).tobytes())
    return _record(
        MODEL, kind=kind, shard=shard, n_tokens=int(counts.sum()), n_keys=len(keys), keys=kept.tobytes(), data=data
    )


def _merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of blocks that come in the order of their shards."""
    now, held, room = None, [], HELD_KEYS
    for part in parts:
        for this, own in _alike(part, "kind", "shard"):
            if now != this:
                if held:
                    yield _shard(*now, held)
                now, held, room = this, [], HELD_KEYS
            held.append((_values(own.column("keys"), np.uint64)[0], _values(own.column("counts"), "<u4")[0]))
            if sum(len(keys) for keys, _ in held) > room:
                held = [_summed(held)]
                room = 2 * max(HELD_KEYS, len(held[0][0]))
        give_back()
    if held:
        yield _shard(*now, held)


def trained(batches: DataFrame, shards: Shards, kinds: tuple[int, ...] = (WORDS, PAIRS)) -> DataFrame:
    """A row for each shard: exact counts of its words, or the filter of its pairs."""
    blocks = batches.select("held", "starts", "tokens", "words").mapInArrow(partial(_count, shards, kinds), BLOCKS)
    ordered = blocks.repartition("kind", "shard").sortWithinPartitions("kind", "shard")
    return staged(ordered.mapInArrow(_merge, MODEL), "ngram-model")


# --- questions and answers


def _ask(shards: Shards, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the words of every batch."""
    for row in _rows(parts):
        keys = np.frombuffer(row["words"], np.uint64)
        order, full, bounds = _by_shard(keys, shards.words)
        columns = [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["batch"], np.int64))]
        yield pa.RecordBatch.from_arrays([*columns, _strings(keys[order], bounds)], ["shard", "batch", "keys"])


def _pair_blocks(shards: Shards, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the pairs of every batch, with how often each is trained on."""
    for row in _rows(parts):
        batch = Batch(row)
        train = np.repeat(~batch.held, np.diff(batch.starts))
        keys, place = np.unique(batch.pairs, return_inverse=True)
        counts = np.bincount(place[train], minlength=len(keys)).astype("<u4")
        order, full, bounds = _by_shard(keys, shards.pairs)
        columns = [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["batch"], np.int64))]
        blocks = [_strings(keys[order], bounds), _strings(counts[order], bounds)]
        yield pa.RecordBatch.from_arrays([*columns, *blocks], ["shard", "batch", "keys", "counts"])


def _word_counts(keys: np.ndarray, shard: dict) -> np.ndarray:
    known, counts = np.frombuffer(shard["keys"], np.uint64), np.frombuffer(shard["data"], np.int64)
    at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
    found = known[at] == keys if len(known) else np.zeros(len(keys), bool)
    return np.where(found, counts[at] if len(known) else 0, 0).astype(np.int64)


def _found(batch: np.ndarray, shard: int, values: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(batch), pa.array(np.full(len(batch), shard, np.int32)), _strings(values, bounds)]
    return pa.RecordBatch.from_arrays(columns, ["batch", "shard", "found"])


def _word_answers(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to blocks of words that follow their shard's row, if it has one."""
    known = {}
    for part in parts:
        for (shard,), own in _alike(part, "shard"):
            if own.column("batch")[0].as_py() < 0:
                known = {name: own.column(name)[0].as_py() for name in ("shard", "keys", "data")}
                own = own.slice(1)
            if own.num_rows:
                keys, bounds = _values(own.column("keys"), np.uint64)
                held = known if known.get("shard") == shard else {"keys": b"", "data": b""}
                yield _found(own.column("batch").to_numpy(), shard, _word_counts(keys, held), bounds)
        give_back()


def _pair_answers(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The levels of all pairs of blocks that come in the order of their shards, under the filter of their shard."""

    def answered(shard: int, held: list[tuple]) -> pa.RecordBatch:
        batch, keys, counts, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
        seen = counts > 0
        bits = build_filter(*_summed([(keys[seen], counts[seen])]))
        # a shard without pairs has no filter
        levels = read_levels(keys, bits, 0, len(bits) * 8) if seen.any() else np.zeros(len(keys), np.int64)
        return _found(batch, shard, levels.astype(np.uint8), np.concatenate([[0], np.cumsum(sizes)]))

    now, held = None, []
    for part in parts:
        for (shard,), own in _alike(part, "shard"):
            if held and now != shard:
                yield answered(now, held)
                held = []
            now = shard
            keys, bounds = _values(own.column("keys"), np.uint64)
            counts, _ = _values(own.column("counts"), "<u4")
            held.append((own.column("batch").to_numpy().copy(), keys, counts, np.diff(bounds)))
        give_back()
    if held:
        yield answered(now, held)


def _of_batches(answers: DataFrame, into: str) -> DataFrame:
    """``(batch, into)``: for each batch the answers of all shards, written: what was shuffled for them can go."""
    found = answers.groupBy("batch").agg(F.collect_list(F.struct("shard", "found")).alias(into))
    return staged(found, into.replace("_", "-"))


def _words_found(batches: DataFrame, model: DataFrame, shards: Shards) -> DataFrame:
    asked = batches.select("batch", "words").mapInArrow(partial(_ask, shards), "shard int, batch bigint, keys binary")
    known = model.filter(F.col("kind") == WORDS).select("shard", F.lit(-1).cast("bigint").alias("batch"), "keys", "data")
    both = known.unionByName(asked.withColumn("data", F.lit(None).cast("binary")))
    ordered = both.repartition("shard").sortWithinPartitions("shard", "batch")
    return _of_batches(ordered.mapInArrow(_word_answers, ANSWERS), "words_found")


def _pairs_found(batches: DataFrame, shards: Shards) -> DataFrame:
    columns = ["batch", "held", "starts", "tokens", "words"]
    blocks = batches.select(*columns).mapInArrow(partial(_pair_blocks, shards), PAIR_BLOCKS)
    ordered = blocks.repartition("shard").sortWithinPartitions("shard")
    return _of_batches(ordered.mapInArrow(_pair_answers, ANSWERS), "pairs_found")


def _restored(keys: np.ndarray, shards: int, answers: list[dict], kind) -> np.ndarray:
    """Answers in the order of the keys."""
    order, full, _ = _by_shard(keys, shards)
    found = {a["shard"]: a["found"] for a in answers}
    out = np.zeros(len(keys), np.int64)
    out[order] = np.frombuffer(b"".join(found[s] for s in full.tolist()), kind)
    return out


class Filter:
    """The filter's shards end to end; a shard without pairs has no bits."""

    def __init__(self, model: DataFrame, shards: int):
        rows = model.filter(F.col("kind") == PAIRS).select("shard", "data").toArrow().to_pylist()
        self.bits = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8)
        self.size, self.offset, at = np.zeros(shards, np.uint64), np.zeros(shards, np.int64), 0
        for r in rows:
            self.size[r["shard"]], self.offset[r["shard"]] = len(r["data"]) * 8, at * 8
            at += len(r["data"])


# --- scores


def level_counts(levels: np.ndarray) -> np.ndarray:
    """The mean of all counts of a level; zero for none."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


def _score(shards: Shards, total: int, distinct: int, prior: float, held, parts: Iterator[pa.RecordBatch]):
    columns = [c.split()[0] for c in SCORES.split(", ")]
    for part in parts:
        for k in range(part.num_rows):
            give_back()
            row = part.slice(k, 1).to_pylist()[0]
            batch = Batch(row)
            count = _restored(batch.words, shards.words, row["words_found"], np.int64)
            base = (count + PSEUDO) / (total + PSEUDO * (distinct + 1))
            # as many documents begin as end
            times = count.copy()
            times[1] = count[0]
            pairs = batch.pairs
            if held is None:
                keys, place = np.unique(pairs, return_inverse=True)
                levels = _restored(keys, shards.pairs, row["pairs_found"], np.uint8)[place]
            else:
                levels = np.zeros(len(pairs), np.int64)
                filter_ = held.value
                shard = shard_of(pairs, shards.pairs)
                known = (times[batch.before] > 0) & (count[batch.tokens] > 0) & (filter_.size[shard] > 0)
                known = np.flatnonzero(known)
                shard = shard[known]
                levels[known] = read_levels(pairs[known], filter_.bits, filter_.offset[shard], filter_.size[shard])
            before, own = times[batch.before], count[batch.tokens]
            seen = np.minimum(level_counts(levels), np.minimum(before, own))
            chance = (seen + prior * base[batch.tokens]) / (before + prior)
            starts = batch.starts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.doc_ids, pa.int64()), pa.array(batch.held), pa.array(np.diff(starts)),
                    pa.array(per_text((own > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(np.log10(base)[batch.tokens], starts[:-1])),
                    pa.array(np.add.reduceat(np.log10(chance), starts[:-1])),
                ],
                columns,
            )


def scores(docs: DataFrame, prior: float = PRIOR, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every document."""
    spark = docs.sparkSession
    # a row is a batch of documents already: a few at a time
    small_batches(spark, ROWS_BYTES)
    batches = tokenised(docs)
    shards = shards_for(batches)
    total = batches.agg(F.coalesce(F.sum("n_train"), F.lit(0))).first()[0]
    sent = total * BITS <= broadcast_bytes * 8
    model = trained(batches, shards, (WORDS, PAIRS) if sent else (WORDS,))
    distinct = model.filter(F.col("kind") == WORDS).agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0]
    rows = batches.drop("n_tokens", "n_train", "sample")
    asked = rows.join(_words_found(batches, model, shards), "batch")
    held = None
    if sent:
        held = spark.sparkContext.broadcast(Filter(model, shards.pairs))
    else:
        asked = asked.join(_pairs_found(batches, shards), "batch")
    scored = asked.mapInArrow(partial(_score, shards, total, distinct, prior, held), SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )
