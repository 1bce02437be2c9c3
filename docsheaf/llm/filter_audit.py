"""How much each of several filters removes, in every order, and what it adds to the others.

A document's failures are a set of filters. A *coalition* of filters removes the
documents that fail one of its filters at least, so the counts of all sets
(32 for five filters, for each part) give the removals of all coalitions. What
a step of an order removes is the difference of two coalitions: the filters up
to it, and those before it.

A filter's Shapley value is the coefficient of a least-squares fit: of all
additive functions that give the coalition of all filters its exact removals
(efficiency), the Shapley values are nearest to the removals of all others under
the kernel weight (n-1) / (C(n,s) s (n-s)) of a coalition of s. The normal
equations, with the constraint as a further row, are linear in the removals, so
they are solved once, in rationals, for a unit removal of each coalition, and
the solution is applied to every part. Over all n! orders it is whole numbers.

Texts are read once, for their failures and a SHA-256 digest each. The smallest
identifier of a digest is joined by digest and identifier together, so the
copies of one text never meet in a task; only the first of them finds a partner.

Null text and part are empty strings. An empty text has no words: it fails the
first filter and no rate. A null identifier is neither smaller nor larger than
another, so such a row is never a later copy, and has no labels. Repeated rows count each; equal
identifiers are not smaller than each other. Labels may repeat and disagree: one
row with the mark is enough. An empty table gives an empty one. Other columns,
whatever their names, are not read.
"""

import hashlib
from collections.abc import Iterable
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf.llm.common import batches, per_text, split_words, staged, string_bytes

# The filters' limits and characters.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
MARKS = "[#$%&*|]"
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")


# --- failures


def _failures(part: pa.RecordBatch):
    texts = part.column("text")
    words, starts = split_words(texts)
    n = np.diff(starts)
    # a number for every distinct word of a text
    code = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(n)), n)
    distinct = np.bincount(np.unique(text * (len(code) + 1) + code) // (len(code) + 1), minlength=len(n))
    raw, at = string_bytes(texts)
    capitals = per_text((raw >= ord("A")) & (raw <= ord("Z")), at)
    chars = pc.utf8_length(texts).to_numpy().astype(np.int64)
    failed = [
        n < LEAST_WORDS,
        100 * distinct < DISTINCT_PERCENT * n,
        100 * capitals > CAPITAL_PERCENT * chars,
        pc.match_substring_regex(texts, MARKS).to_numpy(zero_copy_only=False),
    ]
    mask = sum(f.astype(np.int32) << k for k, f in enumerate(failed))
    digest = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return [part.column("doc_id"), part.column("part"), pa.array(digest, pa.binary()), pa.array(mask, pa.int32())]


def failures(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, digest, mask)``: the failures that depend on a document's text alone, a bit for each."""
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    columns = ["doc_id", "part", "digest", "mask"]
    return rows.mapInArrow(batches(_failures, columns), "doc_id bigint, part string, digest binary, mask int")


def with_copies(rows: DataFrame) -> DataFrame:
    """The last failure added to ``mask``: an equal text has a smaller identifier."""
    first = rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    found = rows.join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return found.withColumn("mask", F.when(later, F.col("mask") + COPY).otherwise(F.col("mask"))).drop("first")


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``, by their labels."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    names = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    known = known.agg(*[F.max(mark).alias(name) for name, mark in names.items()])
    return rows.join(known, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in names})


# --- coalitions


def coalitions(n: int) -> list[tuple[int, ...]]:
    """All sets of ``n`` filters; the one at place ``s`` has the filters of the bits of ``s``."""
    return [tuple(k for k in range(n) if s >> k & 1) for s in range(1 << n)]


def shapley_weights(n: int) -> list[list[Fraction]]:
    """For each filter what the removals of each coalition add to its Shapley value."""
    sets = coalitions(n)
    # unknown are the values and a multiplier; the last equation is efficiency
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * len(sets) for _ in range(n + 1)]
    for s, own in enumerate(sets):
        if not 0 < len(own) < n:
            continue
        weight = Fraction(n - 1, comb(n, len(own)) * len(own) * (n - len(own)))
        for i in own:
            right[i][s] += weight
            for j in own:
                matrix[i][j] += weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n][-1] = Fraction(1)
    return _solved(matrix, right)[:n]


def _solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solutions for all columns of ``right``, by elimination."""
    rows = [[*a, *b] for a, b in zip(matrix, right, strict=True)]
    for k in range(len(rows)):
        pivot = next(r for r in range(k, len(rows)) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r, row in enumerate(rows):
            if r != k and row[k]:
                rows[r] = [x - row[k] * y for x, y in zip(row, rows[k], strict=True)]
    return [row[len(matrix) :] for row in rows]


def removals(rows: DataFrame, n: int) -> DataFrame:
    """``(part, n, good, toxic)``: three arrays with what every coalition removes, and the rows as last entry."""
    cells = rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    # a row for each set of failures
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def total(name: str, of) -> Column:
        return F.aggregate(
            "cells", F.lit(0).cast("bigint"), lambda sum_, cell: sum_ + F.when(of(cell["mask"]), cell[name]).otherwise(0)
        )

    def table(name: str) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.lit((1 << n) - 1)), lambda s: total(name, lambda mask: mask.bitwiseAND(s) != 0)
        )
        return F.concat(each, F.array(total(name, lambda mask: F.lit(True))))

    return parts.select("part", *[table(name).alias(name) for name in ("n", "good", "toxic")])


def audit(rows: DataFrame, filters: Iterable[str] = FILTERS) -> DataFrame:
    """A row for every part, order of the filters and step, from ``rows(part, mask, good, toxic)``.

    Bit k of ``mask`` says that a row fails filter k. Filters are named by one
    character each. There are n! orders, so this is for a handful of them.
    """
    filters = list(filters)
    n, every = len(filters), (1 << len(filters)) - 1
    whole = [[weight * factorial(n) for weight in own] for own in shapley_weights(n)]
    assert all(weight.denominator == 1 for own in whole for weight in own)
    table = removals(rows, n)
    values = [
        sum((F.col("n")[s] * int(weight) for s, weight in enumerate(own) if weight), F.lit(0).cast("bigint"))
        for own in whole
    ]
    bit = lambda name: F.pow(F.lit(2), F.position(name, F.lit("".join(filters))) - 1).cast("int")
    orders = F.split(F.lit(",".join("".join(order) for order in permutations(filters))), ",")
    held = staged(table.select("part", "n", "good", "toxic", F.array(*values).alias("values")), "coalitions")
    each = held.withColumn("filter_order", F.explode(orders))
    each = each.select("*", F.posexplode(F.filter(F.split("filter_order", ""), lambda c: c != "")).alias("at", "name"))
    before = F.aggregate(
        F.split(F.left("filter_order", "at"), ""), F.lit(0), lambda sum_, c: sum_ + F.when(c == "", 0).otherwise(bit(c))
    )
    each = each.withColumns({"step": F.col("at") + 1, "own": bit(F.col("name")), "before": before})
    own, after = F.col("own"), F.col("before") + F.col("own")
    at = F.get
    removed = at("n", after) - at("n", "before")
    return each.select(
        "part", "filter_order", "step",
        (at("n", F.lit(every + 1)) - at("n", after)).alias("kept"),
        removed.alias("removed"),
        (at("n", own) - removed).alias("redundant"),
        (at("n", F.lit(every)) - at("n", every - own)).alias("unique_fails"),
        (at("good", after) - at("good", "before")).alias("good_lost"),
        (at("toxic", after) - at("toxic", "before")).alias("toxic_lost"),
        at("values", F.position("name", F.lit("".join(filters))) - 1).alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole texts: a row for every part, order and step."""
    return audit(marked(with_copies(staged(failures(docs), "failures")), labels))
