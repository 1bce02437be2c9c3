"""Near duplicates by SimHash and Golay-code fuzzy hashing.

A fingerprint has a bit for each bit of the shingle hashes that is set in more
than half of them. Fingerprints within two bits are linked. They are cut into
three segments. Two differences leave one segment equal and at most two in any
other, so a key is one segment as it is and a *Golay index* of the next one:
the perfect binary Golay code decodes every word of 23 bits to the one codeword
within three bits. The indices of a segment are those of the word and of all
words one bit away, one or six in all, and two words within two bits share one,
that of the word halfway between them.

Buckets of equal keys are joined with themselves and verified while they are
small. A bucket over ``BUCKET`` is not, whatever its size: its members are
grouped by the words halfway instead (the fingerprint and its 64 neighbours at
one bit). All members of such a group are within two bits of each other, there
are at most 65, and any two within two bits meet in one, so the links are
complete and their number grows with the members, not with their square.

Equal fingerprints are one node, so copies never meet in a bucket. Null and
blank texts have the fingerprint zero and are linked like others. A null
identifier belongs to the class of its fingerprint. Unlike texts of one
identifier are linked by their fingerprints alone. Repeated rows give
repeated rows; an empty table gives an empty one.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsheaf.llm.common import batches, split_words, staged, string_bytes
from docsheaf.llm.components import components

SEED = 42
#: Members up to which all pairs of a bucket are compared.
BUCKET = 32

#: (first bit, bits) of the segments; the code takes 23 bits.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
# Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0xAE3
CHECK_BITS = 11


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles of a batch, and where each text's begin.

    Shingles are ``size`` lower-cased words joined by spaces, repeats included;
    a text of fewer words has itself as its only one.
    """
    import xxhash

    words, starts = split_words(texts, lower=True)
    raw, at = string_bytes(words)
    lengths = np.diff(at)
    spaced = np.full(len(raw) + len(words), ord(" "), np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(len(words)), lengths)] = raw
    begin = at[:-1] + np.arange(len(words))
    end = begin + lengths

    n = np.diff(starts)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    word = np.arange(first[-1]) - np.repeat(first[:-1] - starts[:-1], count)
    last = word + np.repeat(np.minimum(n, size), count) - 1
    buffer, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    spans = zip(begin[word].tolist(), end[last].tolist(), strict=True)
    hashes = np.fromiter((digest(buffer[a:b], SEED) for a, b in spans), np.uint64, len(word))
    return hashes, first


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the bits set in more than half of its hashes."""
    count = np.diff(first)
    out = np.zeros(len(count), np.uint64)
    total = np.zeros(len(hashes) + 1, np.int64)
    for bit in range(64):
        np.cumsum((hashes >> np.uint64(bit)) & np.uint64(1), out=total[1:], dtype=np.int64)
        ones = total[first[1:]] - total[first[:-1]]
        out |= (2 * ones > count).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, digest, fp)``: a digest and the 64 bits of every document as signed numbers."""

    def function(part):
        bits = majority_bits(*shingle_hashes(part.column("text"), words))
        return [part.column("doc_id"), part.column("digest"), bits.view(np.int64)]

    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("digest"), text)
    return rows.mapInArrow(
        batches(function, ["doc_id", "digest", "fp"], rows=512), "doc_id bigint, digest bigint, fp bigint"
    )


def _remainder(word: int) -> int:
    for bit in range(22, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


class Golay:
    """Decodes words of 23 bits, many at once, to the index of the nearest codeword."""

    def __init__(self):
        single = [_remainder(1 << bit) for bit in range(23)]
        # remainders are linear: the remainder of a word is the sum of those of its bytes
        self.bytes = np.zeros((3, 256), np.int64)
        for k in range(3):
            for value in range(256):
                for bit in range(8):
                    if value >> bit & 1 and 8 * k + bit < 23:
                        self.bytes[k, value] ^= single[8 * k + bit]
        self.error = np.zeros(1 << CHECK_BITS, np.int64)
        for a in range(23):
            for b in range(a, 23):
                for c in range(b, 23):
                    word = 0
                    for bit in {a, b, c}:
                        word |= 1 << bit
                    self.error[_remainder(word)] = word

    def index(self, words: np.ndarray) -> np.ndarray:
        low, middle, high = self.bytes
        check = low[words & 255] ^ middle[words >> 8 & 255] ^ high[words >> 16]
        return (words ^ self.error[check]) >> CHECK_BITS

    def near(self, words: np.ndarray, bits: int) -> np.ndarray:
        """A row for each word: its index and those of its neighbours in the first ``bits``."""
        flips = np.concatenate([[0], 1 << np.arange(bits)])
        return self.index(words[:, None] ^ flips)


def keys_of(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """``(position, key)``: all keys of the fingerprints; equal keys of one appear once."""
    parts = [(fps >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    rows, keys = [], []
    for i, exact in enumerate(parts):
        j = (i + 1) % len(parts)
        near = np.sort(golay.near(parts[j], SEGMENTS[j][1]), axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        row, _ = np.nonzero(new)
        rows.append(row)
        keys.append((np.int64(i) << 35) | (exact[row] << 12) | near[new])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(part):
    row, key = keys_of(part.column("fp").to_numpy().view(np.uint64), Golay())
    row = pa.array(row)
    return [pa.array(key), part.column("node").take(row), part.column("fp").take(row)]


def close_links(classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: links that join all nodes of ``classes(node, fp)`` within two bits.

    Fingerprints must be distinct.
    """
    schema = "key bigint, node bigint, fp bigint"
    keyed = staged(classes.select("node", "fp").mapInArrow(batches(_keyed, ["key", "node", "fp"]), schema), "keys")
    counts = keyed.groupBy("key").count().filter("count > 1")
    shared = staged(keyed.join(counts, "key"), "shared-keys")

    small = shared.filter(F.col("count") <= bucket).select("key", "node", "fp")
    other = small.select("key", F.col("node").alias("b"), F.col("fp").alias("fp_b"))
    pairs = small.join(other, "key").filter(
        (F.col("node") < F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_b"))) <= 2)
    )
    large = shared.filter(F.col("count") > bucket).select("node", "fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << bit if bit < 63 else -(1 << 63)) for bit in range(64)])
    halfway = large.select("node", F.explode(F.transform(flips, lambda f: f.bitwiseXOR(F.col("fp")))).alias("word"))
    # at most 65 fingerprints lie within one bit of a word
    meeting = halfway.groupBy("word").agg(F.collect_set("node").alias("nodes")).filter(F.size("nodes") > 1)
    stars = meeting.select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b"))
    return pairs.select(F.col("node").alias("a"), "b").union(stars).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, digest, fp, group, component_id)`` of every document.

    ``digest`` tells texts apart, ``group`` is the same for all documents that
    are linked, and ``component_id`` is their smallest identifier.
    """
    fps = staged(fingerprints(docs, words), "fingerprints")
    classes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    nodes = classes.filter("least is not null").select(F.col("fp").alias("node"), "fp")
    groups = components(close_links(nodes, bucket)).withColumnRenamed("node", "fp")
    grouped = classes.join(groups, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("group"))
    named = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    return fps.join(grouped.drop("least").join(named, "group"), "fp").select(
        "doc_id", "digest", "fp", "group", "component_id"
    )


def first_of_groups(groups: DataFrame) -> DataFrame:
    """``(doc_id, digest)`` of the document that stays of every group: the first by identifier, then digest."""
    first = groups.filter("doc_id = component_id").groupBy("group").agg(
        F.min("doc_id").alias("doc_id"), F.min("digest").alias("digest")
    )
    return first.select("doc_id", "digest")


def digest(groups: DataFrame) -> DataFrame:
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
