"""Token counts by byte-pair merges, given a table of ranks.

A text is cut into pieces by a pattern. All distinct pieces of a batch are merged
at once: their bytes lie end to end in one array, and in each round every piece
that has a pair in the table merges its pair of the least rank, the first of
equals. A piece that a worker has seen is not merged again.
"""

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from docsheaf.functions.tokens import TokenCounter

#: Pieces that a worker remembers at most.
REMEMBERED = 1 << 20
NO_RANK = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank table from lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merger:
    """Merges pieces by the ranks of tokens; every byte is a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        size = max(ranks.values()) + 1
        pairs = {
            ranks[token[:k]] * size + ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.size = size
        self.keys = np.array(sorted(pairs), np.int64)
        # a pair's rank is that of the token it makes
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NO_RANK)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """How many tokens each piece has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = sizes.copy()
        token = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), sizes)
        while len(token):
            rank = np.full(len(token), NO_RANK)
            rank[:-1] = self.ranks(token[:-1], token[1:])
            rank[:-1][piece[:-1] != piece[1:]] = NO_RANK
            starts = np.flatnonzero(np.diff(piece, prepend=-1))
            least = np.minimum.reduceat(rank, starts)
            length = np.diff(np.append(starts, len(token)))
            out[piece[starts]] = length
            # pieces without a pair are done; of the others the first place of the least rank merges
            live = least != NO_RANK
            if not live.any():
                break
            places = np.flatnonzero((rank == np.repeat(least, length)) & np.repeat(live, length))
            first = places[np.flatnonzero(np.diff(piece[places], prepend=-1))]
            token[first] = rank[first]
            keep = np.repeat(live, length)
            keep[first + 1] = False
            token, piece = token[keep], piece[keep]
        return out


class PieceCounter:
    """Tokens of texts, each distinct piece merged once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.merger, self.pieces, self.known = Merger(ranks), regex.compile(pattern).findall, {}

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(text) for text in texts]
        new = list({p for pieces in cut for p in pieces if p not in self.known})
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list({p for pieces in cut for p in pieces})
        if new:
            self.known.update(zip(new, self.merger.counts([p.encode() for p in new]).tolist(), strict=True))
        known = self.known
        return [sum(known[p] for p in pieces) for pieces in cut]


def merge_counter(load_ranks: Callable[[], dict[bytes, int]], pattern: str) -> TokenCounter:
    """A counter from a rank table and the pattern of its pieces.

    ``load_ranks`` runs once in each task, such as ``lambda: read_ranks(path)``
    with a path that every executor has.
    """

    @F.pandas_udf(ArrayType(LongType()))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter(load_ranks(), pattern)
        for batch in batches:
            texts = [list(t) if t is not None else [] for t in batch]
            counts = iter(counter([t for own in texts for t in own]))
            rows = [[next(counts) for _ in own] for own in texts]
            yield pd.Series([row if t is not None else None for row, t in zip(rows, batch, strict=True)])

    return lambda texts: count(texts)
