"""SentencePiece encoding and decoding by suffix-array matching.

A batch's normalised text falls into stretches that no piece crosses. The new
ones are laid end to end and indexed by a suffix array; every piece of the
vocabulary is looked up in it by binary search, which gives the range of its
occurrences. Each occurrence is an edge from its first to its last character,
and the edges are laid out by position.

The model merges pairs of pieces, best score first, leftmost of equals, so it
has no cheapest path; the edges are relaxed in the order of its merges. In each
round every stretch takes the best edge that joins two of its neighbours, all
stretches at once. Long stretches would need too many rounds. There the edges
are relaxed from left to right: the tokenisation of every prefix has one last
piece, so an edge is taken if its piece can follow the last piece before it,
and no other edge to the same place can. Two pieces can be neighbours if
merging the characters of both, on their own, gives just these two; this is
remembered for each pair. Characters without a piece become the pieces of
their bytes.

Decoding joins the pieces, reads bytes as UTF-8 and drops the space that
encoding puts first.

Null texts count as empty and have no pieces. Repeated rows are encoded each,
an empty table gives an empty one. Other columns, whatever their names, are not
read. A text is decoded as the model's own library decodes it: the piece sign
U+2581 itself comes back as a space.
"""

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsheaf.llm.common import batches
from docsheaf.llm.token_store import in_worker

SPACE = "▁"
#: Stretches whose ids a Python worker remembers at most.
REMEMBERED = 500_000
#: Characters of a stretch up to which it is merged in rounds, and of all stretches at a time.
SHORT = 48
AT_ONCE = 200_000


class Vocabulary:
    """Pieces and scores of a model file, and what follows from them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(self.size)]
        self.unknown = model.unk_id()
        self.byte_ids = {}
        self.ids = {}
        for i, piece in enumerate(self.texts):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
        self.scores = [model.get_score(i) for i in range(self.size)]
        self.byte_of = {i: value for value, i in self.byte_ids.items()}
        self.control = {i for i in range(self.size) if model.is_control(i)}
        self.together: dict[tuple[str, str], bool] = {}
        #: No piece crosses two characters that are not neighbours in any piece.
        self.neighbours = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        if any(pair[1] == SPACE and pair[0] != SPACE for pair in self.neighbours):
            raise ValueError("pieces with a space after other characters are not supported")
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def stretches(self, word: str) -> list[str]:
        """A word cut wherever no piece can cross."""
        near = self.neighbours
        cuts = [0, *[k for k in range(1, len(word)) if word[k - 1 : k + 1] not in near], len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging the best pair again and again."""
        parts = list(text)
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = self.scores[i], k
            if best is None:
                return parts
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def can_follow(self, left: str, right: str) -> bool:
        key = left, right
        known = self.together.get(key)
        if known is None:
            if len(self.together) > REMEMBERED:
                self.together.clear()
            known = self.together[key] = self.merged(left + right) == [left, right]
        return known


def suffix_array(raw: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters' positions sorted by the ``width`` bytes from there on, and those bytes.

    No piece is longer than ``width`` bytes, so deeper order is not needed.
    """
    padded = np.concatenate([raw, np.zeros(width, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    keys = np.ascontiguousarray(windows).view(f"S{width}").reshape(-1)
    order = np.argsort(keys, kind="stable")
    return starts[order], keys[order]


class Encoder:
    """Ids of texts; each distinct stretch is matched once."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        pieces = sorted((p.encode(), p) for p in self.vocabulary.ids)
        self.width = max(len(b) for b, _ in pieces)
        self.pieces = [p for _, p in pieces]
        self.low = np.array([b for b, _ in pieces], f"S{self.width}")
        # no UTF-8 text has this byte: it ends the range of a piece's occurrences
        self.high = np.array([b.ljust(self.width, b"\xff") for b, _ in pieces], f"S{self.width}")
        self.sizes = np.array([len(b) for b, _ in pieces])
        self.lengths = np.array([len(p) for p in self.pieces])
        self.piece_ids = np.array([self.vocabulary.ids[p] for p in self.pieces], "<i4")
        # equal scores are equally good, and then the leftmost pair is merged
        scores = np.array([self.vocabulary.scores[i] for i in self.piece_ids])
        _, self.rank = np.unique(-scores, return_inverse=True)
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def edges(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """``(begin, end, piece)`` of all occurrences in the stretches laid end to end, by position."""
        # a byte between them that is in no piece
        joined = b"\xff".join(s.encode() for s in stretches) + b"\xff"
        raw = np.frombuffer(joined, np.uint8)
        starts = np.flatnonzero((raw & 0xC0 != 0x80) & (raw != 0xFF))
        at, keys = suffix_array(raw, starts, self.width)
        lower = np.searchsorted(keys, self.low, side="left")
        upper = np.searchsorted(keys, self.high, side="left")
        # a suffix that is the piece and 0xff to the end is still one of its occurrences
        upper = np.maximum(upper, np.searchsorted(keys, self.high, side="right"))
        count = np.maximum(upper - lower, 0)
        piece = np.repeat(np.arange(len(self.pieces)), count)
        place = np.arange(len(piece)) + np.repeat(lower - (np.cumsum(count) - count), count)
        begin = at[place]
        end = begin + self.sizes[piece]
        # by last character; of these the longest first
        order = np.lexsort((begin, end))
        return begin[order], end[order], piece[order], joined

    def byte_pieces(self, character: str) -> list[int]:
        table = self.vocabulary.byte_ids
        return [table[b] for b in character.encode()] if table else [self.vocabulary.unknown]

    def merge(self, stretches: list[str]) -> None:
        """Find the pieces of short stretches, in rounds."""
        begin, end, piece, joined = self.edges(stretches)
        raw = np.frombuffer(joined, np.uint8)
        # characters are numbered, and each separator counts as one
        number = np.cumsum(raw & 0xC0 != 0x80) - 1
        edge = np.full((number[-1] + 2, int(self.lengths.max()) + 1), -1, np.int32)
        edge[number[begin], self.lengths[piece]] = piece
        size = np.fromiter(map(len, stretches), np.int64, len(stretches))
        owner = np.repeat(np.arange(len(size)), size)
        first = np.arange(len(owner)) + owner
        last = first + 1
        none = len(self.rank)
        done = []
        while len(owner):
            span = last[1:] - first[:-1]
            fits = (owner[1:] == owner[:-1]) & (span < edge.shape[1])
            joins = np.where(fits, edge[first[:-1], np.where(fits, span, 0)], -1)
            rank = np.append(np.where(joins >= 0, self.rank[joins], none), none)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(owner)))
            over = best == none
            done.append((owner[over], first[over], last[over]))
            at = np.flatnonzero((rank == best) & ~over)
            at = at[np.diff(owner[at], prepend=-1) > 0]
            last[at] = last[at + 1]
            keep = ~over
            keep[at + 1] = False
            owner, first, last = owner[keep], first[keep], last[keep]
        owner, first, last = (np.concatenate(part) for part in zip(*done, strict=True))
        order = np.argsort(first, kind="stable")
        owner, found = owner[order], edge[first[order], (last - first)[order]]
        ids = np.where(found >= 0, self.piece_ids[found], -1).astype("<i4")
        bounds = np.searchsorted(owner, np.arange(len(stretches) + 1)) * 4
        every, bare = ids.tobytes(), set(owner[found < 0].tolist())
        for k, (stretch, a, b) in enumerate(zip(stretches, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            self.known[stretch] = every[a:b]
            if k in bare:
                at, own = int(bounds[k]) // 4, []
                place = int(first[order[at]])
                for i, f, t in zip(ids[at : b // 4].tolist(), first[order[at : b // 4]], last[order[at : b // 4]], strict=True):
                    own += [i] if i >= 0 else self.byte_pieces(stretch[f - place : t - place])
                self.known[stretch] = np.array(own, "<i4").tobytes()

    def relax(self, stretches: list[str]) -> None:
        """Find the pieces of stretches of any length, from left to right."""
        vocabulary, follow = self.vocabulary, self.vocabulary.can_follow
        begin, end, piece, joined = self.edges(stretches)
        begin, end, piece, pieces = begin.tolist(), end.tolist(), piece.tolist(), self.pieces
        at, e = 0, 0
        for stretch in stretches:
            size = len(stretch.encode())
            stop = at + size
            # of every position reached: the last piece before it and where that begins
            last: dict[int, tuple[str | None, int]] = {at: (None, at)}
            place = at
            for character in stretch:
                place += len(character.encode())
                while e < len(end) and end[e] < place:
                    e += 1
                while e < len(end) and end[e] == place:
                    start = begin[e]
                    before = last.get(start)
                    if place not in last and before is not None:
                        own = pieces[piece[e]]
                        if before[0] is None or follow(before[0], own):
                            last[place] = own, start
                    e += 1
                if place not in last:
                    # a character without a piece stands alone
                    last[place] = character, place - len(character.encode())
            ids, place = [], stop
            while place > at:
                own, start = last[place]
                i = vocabulary.ids.get(own)
                ids.extend([i] if i is not None else self.byte_pieces(own)[::-1])
                place = start
            self.known[stretch] = np.array(ids[::-1], "<i4").tobytes()
            at = stop + 1

    def learn(self, stretches: list[str]) -> None:
        """Find the pieces of stretches not seen before, a bounded number of characters at a time."""
        part, size = [], 0
        for stretch in stretches:
            if len(stretch) > SHORT:
                self.relax([stretch])
                continue
            part.append(stretch)
            size += len(stretch)
            if size >= AT_ONCE:
                self.merge(part)
                part, size = [], 0
        if part:
            self.merge(part)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > REMEMBERED:
            self.words.clear()
            self.known.clear()
        cut = self.vocabulary.words
        parts = [cut(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        words, known = self.words, self.known
        new = {w: self.vocabulary.stretches(w) for w in dict.fromkeys(w for own in parts for w in own) if w not in words}
        self.learn([s for s in dict.fromkeys(s for own in new.values() for s in own) if s not in known])
        for word, own in new.items():
            words[word] = b"".join([known[s] for s in own])
        return [b"".join([words[w] for w in own]) for own in parts]


class Decoder:
    """Texts of ids."""

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        self.raw = []
        for i, text in enumerate(vocabulary.texts):
            if i in vocabulary.byte_of:
                self.raw.append(bytes([vocabulary.byte_of[i]]))
            elif i in vocabulary.control:
                self.raw.append(b"")
            elif i == vocabulary.unknown:
                self.raw.append(" ⁇ ".encode())
            else:
                self.raw.append(text.replace(SPACE, " ").encode())

    def __call__(self, ids: list[int]) -> str:
        text = b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _encode(path: str, part: pa.RecordBatch):
    encoder = in_worker("pieces:" + path, lambda: Encoder(path))
    found = encoder(part.column("text").to_pylist())
    sizes = np.array([len(f) // 4 for f in found], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
    return [part.column("doc_id"), ids, sizes]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, n_pieces)`` of every whole text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        batches(partial(_encode, path), ["doc_id", "ids", "n_pieces"], rows=1024),
        f"doc_id {kind}, ids array<int>, n_pieces bigint",
    )


def _decode(path: str, part: pa.RecordBatch):
    decoder = in_worker("unpieces:" + path, lambda: Decoder(path))
    ids = part.column("ids")
    texts = [decoder(ids[k].values.to_pylist() if ids[k].is_valid else []) for k in range(len(ids))]
    return [part.column("doc_id"), pa.array(texts, pa.string())]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of ``encoded(doc_id, ids)``; null ids give the empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        batches(partial(_decode, path), ["doc_id", "text"], rows=1024), f"doc_id {kind}, text string"
    )


def _both(path: str, part: pa.RecordBatch):
    encoded = _encode(path, part)
    decoder = in_worker("unpieces:" + path, lambda: Decoder(path))
    texts, ids = part.column("text").to_pylist(), encoded[1]
    values, at = ids.values.to_numpy(), ids.offsets.to_pylist()
    # the piece sign itself stands for a space
    same = [
        decoder(values[a:b].tolist()) == text.replace(SPACE, " ")
        for text, a, b in zip(texts, at[:-1], at[1:], strict=True)
    ]
    return [*encoded, pa.array(same, pa.bool_())]


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, n_pieces, decoded_equal)``: the ids, and whether they decode to the text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        batches(partial(_both, path), ["doc_id", "ids", "n_pieces", "decoded_equal"], rows=1024),
        f"doc_id {kind}, ids array<int>, n_pieces bigint, decoded_equal boolean",
    )
