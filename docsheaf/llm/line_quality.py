"""Quality rules and line labelling with a linear-chain conditional random field.

Every line with a word is content or boilerplate. A chain over the lines of a
document scores each line by its shape and each pair of neighbours by their
labels; Viterbi decoding finds the best labelling, for many documents a line at
a time. A document stays if it passes two base rules and at least
``CONTENT_SHARE`` of its words lie in content lines.

The chain is fitted on a bounded sample of labelled documents: ``SAMPLE`` of
each label, the smallest by the hash of their identifier, and ``SAMPLE_LINES``
lines of each. All lines of a document carry its label while fitting. Only
numbers about lines come to the driver. Without labels of both kinds every line
counts as content and the base rules decide alone.

Null and blank texts have no words and fail the base rules. Repeated rows are
judged each, an empty table gives an empty one. Further columns pass through
the stage unread, whatever their names.
"""

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsheaf.llm.common import batches, per_text, split_words, string_bytes

SAMPLE = 400
SAMPLE_LINES = 50
CONTENT_SHARE = 0.5
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

LABELS = ("boilerplate", "content")
FEATURES = (
    "bias", "words", "word_length", "upper", "digits", "symbols", "exclamation", "stops", "distinct", "repeated",
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")


@dataclass(frozen=True)
class Chain:
    """Weights of a line's features for each label, of neighbours' labels, and of the first label."""

    line: np.ndarray
    step: np.ndarray
    first: np.ndarray


def _bytes_of(characters: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[[ord(c) for c in characters]] = 1
    return table


_UPPER = _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _bytes_of("0123456789")
_SYMBOL = _bytes_of("#*$%&|<>")
_EXCLAMATION = _bytes_of("!")
_STOP = _bytes_of(".,;:?")
# the first byte of a character that is not white space
_CHARACTER = np.ones(256, np.uint8)
_CHARACTER[0x80:0xC0] = 0
_CHARACTER[[0x20, *range(0x09, 0x0E)]] = 0


def _counted(raw: np.ndarray, at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How many bytes of each string a table marks."""
    out = np.zeros(len(at) - 1, np.int64)
    filled = np.flatnonzero(np.diff(at))
    if len(filled):
        out[filled] = np.add.reduceat(table[raw], at[filled], dtype=np.int64)
    return out


def _repeats(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a value came earlier with the same owner; both are small numbers in order of rows."""
    key = owner.astype(np.int64) << 32 | value
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return again


def repeated_words(ids: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text the words that lie in windows of words found twice or more in it."""
    n = np.diff(starts)
    count = np.maximum(n - window + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    begin = np.arange(len(text)) + np.repeat(starts[:-1] - (np.cumsum(count) - count), count)
    # windows of one text are told apart by 64-bit sums of odd multiples of mixed ids
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
        key = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        for k in range(window):
            key = (key ^ key >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) + mixed[begin + k]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key) + 1, bool)
    twice[1:-1] = same if len(key) else twice[1:-1]
    found = begin[order[twice[1:] | twice[:-1]]] if len(key) else begin
    change = np.zeros(len(ids) + window + 1, np.int64)
    np.add.at(change, found, 1)
    np.add.at(change, found + window, -1)
    return per_text((np.cumsum(change)[: len(ids)] > 0).astype(np.int64), starts)


def measured(texts: pa.Array) -> tuple[np.ndarray, dict, np.ndarray, np.ndarray]:
    """Of a batch: features of every line with a word, counts of every text, where each
    text's lines begin, and the words of each line."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    words, at_word = split_words(lines)
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    raw, at = string_bytes(lines)
    n = np.diff(at_word)
    text = np.repeat(np.arange(len(texts)), np.diff(edges))

    characters = _counted(raw, at, _CHARACTER)
    symbols = _counted(raw, at, _SYMBOL)
    line_id = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    again = _repeats(text, line_id) & (n > 0)
    new_words = per_text((~_repeats(np.repeat(np.arange(len(n)), n), ids)).astype(np.int64), at_word)

    size = np.maximum(characters, 1)
    features = np.stack(
        [
            np.ones(len(n)),
            np.log1p(n) / 5,
            np.minimum(characters / np.maximum(n, 1), 30) / 10,
            _counted(raw, at, _UPPER) / size,
            _counted(raw, at, _DIGIT) / size,
            np.minimum(symbols / np.maximum(n, 1), 3),
            np.minimum(_counted(raw, at, _EXCLAMATION) / np.maximum(n, 1), 3),
            np.minimum(_counted(raw, at, _STOP) / np.maximum(n, 1), 1),
            new_words / np.maximum(n, 1),
            again.astype(float),
        ],
        axis=1,
    )
    filled = n > 0
    counts = {
        "n_words": per_text(n, edges),
        "word_chars": per_text(characters, edges),
        "n_symbols": per_text(symbols, edges),
        "n_dup_lines": per_text(again.astype(np.int64), edges),
        "n_repeat_words": repeated_words(ids, at_word[edges]),
    }
    starts = np.concatenate([[0], np.cumsum(filled)])[edges]
    return features[filled], counts, starts, n[filled]


def viterbi(scores: np.ndarray, starts: np.ndarray, chain: Chain) -> np.ndarray:
    """The best label of every line; the k-th lines of all texts are decoded together."""
    n = np.diff(starts)
    order = np.argsort(-n, kind="stable")
    begin, length = starts[:-1][order], n[order]
    labels, back = np.zeros(len(scores), np.int64), np.zeros((len(scores), 2), np.int8)
    best = np.zeros((len(order), 2))
    longest = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -k, side="left")) for k in range(longest)]
    for k in range(longest):
        m = active[k]
        row = begin[:m] + k
        if k == 0:
            best[:m] = chain.first + scores[row]
            continue
        both = best[:m, :, None] + chain.step
        back[row] = both.argmax(axis=1)
        best[:m] = both.max(axis=1) + scores[row]
    label = best.argmax(axis=1)
    for k in reversed(range(longest)):
        m = active[k]
        row = begin[:m] + k
        labels[row] = label[:m]
        label[:m] = back[row, label[:m]]
    return labels


def fit_chain(features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, rounds: int = 120) -> Chain:
    """Maximum likelihood with a Gaussian prior, by gradient steps over all sample documents.

    ``labels`` has one for each document, which all its lines carry.
    """
    d, longest, width = len(lengths), int(lengths.max()), features.shape[1]
    x = np.zeros((longest, d, width))
    begin = np.cumsum(lengths) - lengths
    for k in range(longest):
        live = lengths > k
        x[k, live] = features[begin[live] + k]
    live = np.arange(longest)[:, None] < lengths
    # documents of either label weigh the same in all
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    gold = np.zeros((d, 2))
    gold[np.arange(d), labels] = 1
    parts = [np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2)]
    speed, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]

    def log_sum(values, axis):
        top = values.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for turn in range(1, rounds + 1):
        line, step, first = parts
        score = x @ line
        ahead, after = np.zeros((longest, d, 2)), np.zeros((longest, d, 2))
        ahead[0] = first + score[0]
        for k in range(1, longest):
            new = log_sum(ahead[k - 1][:, :, None] + step, 1) + score[k]
            ahead[k] = np.where(live[k][:, None], new, ahead[k - 1])
        total = log_sum(ahead[-1], 1)
        for k in range(longest - 2, -1, -1):
            new = log_sum(step + (score[k + 1] + after[k + 1])[:, None, :], 2)
            after[k] = np.where(live[k + 1][:, None], new, 0)
        node = np.exp(ahead + after - total[:, None]) * live[:, :, None]
        off = (node - gold * live[:, :, None]) * (weight / lengths)[None, :, None]
        grad = [np.einsum("kdf,kdl->fl", x, off), np.zeros((2, 2)), (node[0] - gold).T @ weight]
        for k in range(1, longest):
            pair = ahead[k - 1][:, :, None] + step + (score[k] + after[k])[:, None, :]
            pair = np.exp(pair - total[:, None, None]) - gold[:, :, None] * gold[:, None, :]
            grad[1] += np.einsum("dij,d->ij", pair, live[k] * weight / lengths)
        for p, g, v, s in zip(parts, grad, speed, square, strict=True):
            g += 1e-4 * p
            v += 0.1 * (g - v)
            s += 0.01 * (g * g - s)
            p -= 0.3 * (v / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.99**turn)) + 1e-8)
    return Chain(*parts)


def _features(part: pa.RecordBatch):
    features, _, starts, _ = measured(part.column("text"))
    rows = [features[a : min(b, a + SAMPLE_LINES)].reshape(-1) for a, b in zip(starts, starts[1:], strict=False)]
    return [part.column("label"), pa.array(rows, pa.list_(pa.float64()))]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """Fit the chain on ``labels(doc_id, quality)``: 1 is content, 0 boilerplate."""
    known = labels.filter("doc_id is not null").select("doc_id", F.col("quality").alias("label"))
    chosen = [
        known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for value in (0, 1)
    ]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # at most 2 * sample rows
    picked = rows.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("label", "text")
    measures = picked.mapInArrow(batches(_features, ["label", "features"]), "label int, features array<double>")
    table = measures.filter("size(features) > 0").limit(2 * sample).toArrow()
    label = table.column("label").to_numpy().astype(np.int64)
    if len(set(label.tolist())) < 2:
        return None
    lists = table.column("features").combine_chunks()
    flat = lists.flatten().to_numpy().reshape(-1, len(FEATURES))
    lengths = pc.list_value_length(lists).to_numpy() // len(FEATURES)
    return fit_chain(flat, lengths.astype(np.int64), label)


def _judge(chain: Chain | None, part: pa.RecordBatch):
    features, counts, starts, words = measured(part.column("text"))
    if chain is None:
        content = np.ones(len(words), np.int64)
    else:
        content = viterbi(features @ chain.line, starts, chain)
    counts["content_words"] = per_text(words * content, starts)
    return [part.column("row"), *[counts[name] for name in COUNTS]]


def judged(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """``row`` with the columns of ``docs``, the counts, ``base_failed`` and ``kept``."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType(
        [T.StructField("row", docs.schema), *[T.StructField(name, T.LongType()) for name in COUNTS]]
    )
    counted = rows.mapInArrow(batches(partial(_judge, chain), ["row", *COUNTS]), schema)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("content_words") >= CONTENT_SHARE * F.col("n_words"))
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("row.doc_id", *COUNTS[:5], "base_failed", "kept", "content_words")
