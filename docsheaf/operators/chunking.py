"""Packing text into token-bounded chunks.

A text is cut into units: a paragraph within the limit is one unit, a longer
one gives its sentences. Units are packed left to right. A chunk ends when the
next unit would push the sum of unit counts over the limit, and always between
a long paragraph and its neighbours. A unit is never cut, so a sentence above
the limit is a chunk of its own.

All steps are narrow: a document's chunks come from its own row. Helper columns
are passed to higher-order functions as arguments or through ``let``, never
captured in a lambda, as Catalyst may inline a captured column into the loop.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf import constants as C
from docsheaf.functions.text import WS, let, py_strip
from docsheaf.functions.tokens import (
    TokenCounter,
    count_one,
    estimated,
    tokens_of_words,
    words_in_stripped,
)
from docsheaf.session import computed_once

# unit kinds
PARAGRAPH, FIRST_SENTENCE, LATER_SENTENCE = 0, 1, 2
UNITS_PER_BLOCK = 256


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines, stripped, empty ones left out."""
    return F.filter(F.transform(F.split(text, r"\n\n+"), py_strip), lambda p: p != "")


def sentences(paragraph: Column) -> Column:
    """Cut at whitespace that follows a full stop, ``!`` or ``?``."""
    return F.split(paragraph, rf"(?<=[.!?]){WS}+")


def _unit(kind, text, tokens=None) -> Column:
    fields = [kind.alias("kind"), text.alias("text")]
    return F.struct(*fields, *([] if tokens is None else [tokens.alias("tokens")]))


def _sentence_kind(position: Column) -> Column:
    return F.when(position == 0, FIRST_SENTENCE).otherwise(LATER_SENTENCE)


def _estimated_units(paras: Column, max_tokens: int) -> Column:
    """Units with the estimated count, in one pass over the words.

    A cut between sentences never splits a word, so a paragraph has as many
    words as its sentences together.
    """

    def counted(sentence):
        return F.struct(sentence.alias("text"), words_in_stripped(sentence).alias("words"))

    def expand(paragraph):
        def choose(parts):
            words = F.aggregate(parts, F.lit(0), lambda total, s: total + s["words"])
            return let(tokens_of_words(words), lambda tokens: cut(parts, tokens))

        def cut(parts, tokens):
            cuts = F.transform(
                parts,
                lambda s, j: _unit(_sentence_kind(j), s["text"], tokens_of_words(s["words"])),
            )
            whole = F.array(_unit(F.lit(PARAGRAPH), paragraph, tokens))
            return F.when(tokens > max_tokens, cuts).otherwise(whole)

        return let(F.transform(sentences(paragraph), counted), choose)

    return F.flatten(F.transform(paras, expand))


def _units(paras: Column, counts: Column, max_tokens: int) -> Column:
    """Units without counts, from paragraphs and their counts."""

    def expand(pair):
        whole = F.array(_unit(F.lit(PARAGRAPH), pair["text"]))
        cuts = F.transform(
            sentences(pair["text"]), lambda s, j: _unit(_sentence_kind(j), s)
        )
        return F.when(pair["tokens"] > max_tokens, cuts).otherwise(whole)

    pairs = F.arrays_zip(paras.alias("text"), counts.alias("tokens"))
    return F.flatten(F.transform(pairs, expand))


def _with_counts(units: Column, counts: Column) -> Column:
    pairs = F.arrays_zip(units.alias("unit"), counts.alias("tokens"))
    return F.transform(
        pairs, lambda p: _unit(p["unit"]["kind"], p["unit"]["text"], p["tokens"])
    )


def _starts(units: Column, max_tokens: int) -> Column:
    """Positions of the units that open a chunk.

    Appending copies a list, so one list of all positions would cost the square
    of a document's chunks. The units are folded in blocks: each has a short
    list of its own, and only whole blocks are appended to the list of lists.
    """
    begin = F.struct(
        F.lit(0).alias("n"),
        F.lit(0).cast("bigint").alias("sum"),
        F.lit(LATER_SENTENCE).alias("kind"),
        F.array().cast("array<int>").alias("starts"),
    )
    no_blocks = F.array().cast("array<array<int>>").alias("blocks")

    def step(state, unit):
        opens = (
            (unit["kind"] == FIRST_SENTENCE)
            | ((unit["kind"] == PARAGRAPH) & (state["kind"] != PARAGRAPH))
            | (state["sum"] + unit["tokens"] > max_tokens)
        )
        tokens = unit["tokens"].cast("bigint")
        return F.struct(
            (state["n"] + 1).alias("n"),
            F.when(opens, tokens).otherwise(state["sum"] + tokens).alias("sum"),
            unit["kind"].alias("kind"),
            F.when(opens, F.concat(state["starts"], F.array(state["n"])))
            .otherwise(state["starts"])
            .alias("starts"),
        )

    def fold_block(whole, block):
        opened = F.struct(
            whole["state"]["n"].alias("n"),
            whole["state"]["sum"].alias("sum"),
            whole["state"]["kind"].alias("kind"),
            F.array().cast("array<int>").alias("starts"),
        )
        return let(
            F.aggregate(block, opened, step),
            lambda state: F.struct(
                state.alias("state"),
                F.concat(whole["blocks"], F.array(state["starts"])).alias("blocks"),
            ),
        )

    def blocks(every):
        last = F.floor(F.greatest(F.size(every) - 1, F.lit(0)) / UNITS_PER_BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda b: F.slice(every, b * UNITS_PER_BLOCK + 1, F.lit(UNITS_PER_BLOCK)),
        )

    start = F.struct(begin.alias("state"), no_blocks)
    return F.aggregate(
        let(units, blocks), start, fold_block, lambda whole: F.flatten(whole["blocks"])
    )


def _join_chunks(units: Column, starts: Column) -> Column:
    def chunk(doc, start, k):
        end = F.coalesce(F.get(doc["starts"], k + 1), F.size(doc["units"]))
        members = F.slice(doc["units"], start + 1, end - start)
        texts = F.transform(members, lambda u: u["text"])
        whole_paragraphs = F.get(doc["units"], start)["kind"] == PARAGRAPH
        return F.when(whole_paragraphs, F.array_join(texts, "\n\n")).otherwise(
            F.array_join(texts, " ")
        )

    doc = F.struct(units.alias("units"), starts.alias("starts"))
    chunks = let(doc, lambda d: F.transform(d["starts"], lambda s, k: chunk(d, s, k)))
    return F.filter(chunks, lambda c: py_strip(c) != "")


def add_chunks(
    df: DataFrame,
    column="clean_text",
    max_tokens: int = C.DEFAULT_MAX_TOKENS,
    counter: TokenCounter = estimated,
) -> DataFrame:
    """Add ``chunks array<string>``, one element per chunk, in order."""
    keep = df.columns
    paras = df.withColumn("_paras", paragraphs(F.col(column)))
    if counter is estimated:
        units = paras.select(*keep, _estimated_units(F.col("_paras"), max_tokens).alias("_units"))
    else:
        units = (
            paras.withColumn("_counts", counter(F.col("_paras")))
            .select(*keep, _units(F.col("_paras"), F.col("_counts"), max_tokens).alias("_units"))
            .withColumn("_counts", counter(F.transform("_units", lambda u: u["text"])))
            .withColumn("_units", _with_counts(F.col("_units"), F.col("_counts")))
        )
    packed = units.select(*keep, "_units", _starts(F.col("_units"), max_tokens).alias("_starts")).select(
        *keep, _join_chunks(F.col("_units"), F.col("_starts")).alias("chunks")
    )
    return computed_once(packed, "chunks")


def explode_chunks(df: DataFrame, *keep: str) -> DataFrame:
    """One row per chunk. A document without chunks leaves no row.

    The outer form plus a filter on its result: for a plain explode, Catalyst
    infers a filter on the array and pushes it down, packing everything twice.
    """
    return (
        # sized before the explode, or each chunk row would carry the whole array
        df.select(*keep, "chunks", F.size("chunks").alias("total_chunks"))
        .select(
            *keep, "total_chunks", F.posexplode_outer("chunks").alias("chunk_index", "text")
        )
        .filter(F.col("chunk_index").isNotNull())
        .select(*keep, "chunk_index", "total_chunks", "text")
    )


def chunk_documents(
    documents: DataFrame,
    column="clean_text",
    max_tokens: int = C.DEFAULT_MAX_TOKENS,
    counter: TokenCounter = estimated,
) -> DataFrame:
    """Chunk rows of cleaned documents."""
    packed = add_chunks(documents, column, max_tokens, counter)
    return explode_chunks(packed, "doc_seq", "source", "source_type")


def without_chunks(df: DataFrame) -> DataFrame:
    """Rejects: documents that cleaning left without text."""
    return df.filter(F.size("chunks") == 0).select(
        "source", F.lit("preprocess").alias("stage"), F.lit("no usable text").alias("reason")
    )


def doc_stats(df: DataFrame, counter: TokenCounter = estimated) -> DataFrame:
    """Per document: characters before and after cleaning, tokens, chunks.

    Takes documents with ``raw_text``, ``clean_text`` and ``chunks``.
    """
    return df.select(
        "doc_seq",
        "source",
        F.length("raw_text").alias("chars_raw"),
        F.length("clean_text").alias("chars_clean"),
        count_one(F.col("clean_text"), counter).alias("tokens"),
        F.size("chunks").alias("total_chunks"),
    )


def preview(text: Column) -> Column:
    return F.substring(text, 1, C.PREVIEW_CHARS)
