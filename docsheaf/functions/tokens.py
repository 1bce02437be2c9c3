"""Token counters: functions from ``array<string>`` to ``array<bigint>``.

A counter sees arrays because a document's paragraphs and sentences are
counted together; a Python counter then crosses to Python once per row.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from docsheaf import constants as C
from docsheaf.functions.text import WS, py_strip

TokenCounter = Callable[[Column], Column]


def word_count(text: Column) -> Column:
    stripped = py_strip(text)
    return F.when(stripped == "", 0).otherwise(words_in_stripped(stripped))


def words_in_stripped(text: Column) -> Column:
    """The count for text that is not empty and has no outer whitespace."""
    return F.size(F.split(text, f"{WS}+"))


def tokens_of_words(words: Column) -> Column:
    """Words times a fixed ratio, rounded down."""
    return F.floor(words * F.lit(C.TOKENS_PER_WORD).cast("double"))


def estimate_tokens(text: Column) -> Column:
    return tokens_of_words(word_count(text))


def estimated(texts: Column) -> Column:
    """The default counter, without Python."""
    return F.transform(texts, estimate_tokens)


def encoder_counter(make_encoder: Callable[[], Callable[[str], list]]) -> TokenCounter:
    """A counter from a tokenizer. ``make_encoder`` runs on the executors and
    returns a function from text to its tokens."""

    @F.pandas_udf(ArrayType(LongType()))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make_encoder()
        for batch in batches:
            yield batch.map(lambda texts: [len(encode(t)) for t in texts])

    return lambda texts: count(texts)


def count_one(text: Column, counter: TokenCounter) -> Column:
    return F.get(counter(F.array(text)), F.lit(0))
