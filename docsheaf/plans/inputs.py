"""Inputs of the registered queries, derived from the given tables in Spark.

The given text is clean and in few shapes, so some queries first vary it. The
same expressions are written in SQL in ``oracles``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsheaf import constants as C
from docsheaf.functions.text import unify_newlines
from docsheaf.operators.chunking import chunk_documents
from docsheaf.operators.cleaning import clean_documents
from docsheaf.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as pipeline documents."""
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc_seq"),
        "source",
        F.lit("file_txt").alias("source_type"),
        F.col("text").alias("raw_text"),
    )
    return rows


def _swap(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def dirty(key: Column, text: Column) -> Column:
    """Whole text with one of eight kinds of dirt, by key."""
    kinds = {
        1: F.concat(text, F.lit("\n\n\n\nAccept all cookies to continue\nTail line.")),
        2: F.concat(
            F.lit("“"),
            _swap(text, (", ", " – "), ("e ", "e’ "), ("a ", "‘a — ")),
            F.lit("”"),
        ),
        3: _swap(text, ("\n", "\r\n"), (". ", ".\r")),
        4: F.concat(_swap(text, ("\n", "  \n"), (". ", ".\n \n\t\n")), F.lit("\n \n \nEnd. ")),
        5: _swap(text, ("\n", "\n\n")),
        6: F.concat(F.lit("﻿"), _swap(text, (", ", ", "), ("e", "e​"))),
        7: F.concat(
            _swap(text, ("é", "é")), F.lit("\ncafé\nSHARE THIS ARTICLE now")
        ),
    }
    kind = F.pmod(key, F.lit(8))
    out = F.when(kind == 0, text)
    for k, variant in kinds.items():
        out = out.when(kind == k, variant)
    return out


def dirty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return docs.withColumn("raw_text", dirty(F.col("doc_seq"), F.col("raw_text")))


def document_pieces(docs: DataFrame, size: int) -> DataFrame:
    """The documents cut after every ``size`` characters, wherever that is."""
    text = docs.select("doc_seq", unify_newlines(F.col("raw_text")).alias("t"))
    # one pass over the text: to find a place by its number takes a pass for each piece
    cuts = F.regexp_extract_all("t", F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1))
    cuts = F.when(F.length("t") > 0, cuts).otherwise(F.array("t"))
    return text.select("doc_seq", F.posexplode(cuts).alias("piece_no", "raw_text"))


def blanked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; some have only white space and lines that cleaning drops."""
    docs = documents(spark, sf_dir)
    blank = F.pmod("doc_seq", F.lit(13)) == 4
    return docs.withColumn("raw_text", F.when(blank, " \n\n\t\nAccept all cookies\n").otherwise(F.col("raw_text")))


def named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as named contents: hidden, underscored, in folders, or empty."""
    prefix = F.element_at(F.array(*map(F.lit, ["", "_", ".", "sub/_x/"])), F.pmod("doc_seq", F.lit(4)).cast("int") + 1)
    content = F.when(F.pmod("doc_seq", F.lit(9)) != 0, F.encode("raw_text", "UTF-8"))
    return documents(spark, sf_dir).select(
        F.concat(prefix, F.col("doc_seq"), F.lit(".txt")).alias("source"), content.alias("content")
    )


def read_files(files: DataFrame) -> DataFrame:
    """The files as read; some could not be."""
    bad = F.pmod(F.length("content"), F.lit(5)) == 2
    return files.select(
        "source",
        F.when(~bad, F.col("content")).alias("content"),
        F.when(bad, F.concat(F.lit("stream ended after "), F.length("content"))).alias("error"),
    )


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as a log of fetches; some failed."""
    failed = F.pmod("page_id", F.lit(11)) == 5
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("source"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("status "), F.length("html"))).alias("error"),
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as captures; some are not HTML, have no type, or are blank."""
    pages = table(spark, sf_dir, "pages")
    kind = F.pmod("page_id", F.lit(10))
    return pages.select(
        "page_id",
        F.col("url").alias("source"),
        F.when(kind == 3, "text/plain")
        .when(kind == 4, "TEXT/HTML")
        .when(kind != 5, "text/html; charset=utf-8")
        .alias("content_type"),
        F.when(kind == 6, " \n\t ").otherwise(F.col("html")).alias("body"),
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as the pages of a document; some fail or are empty."""
    turns = table(spark, sf_dir, "conversations")
    key = F.col("conv_id") * 7 + F.col("turn")
    return turns.select(
        F.col("conv_id").cast("string").alias("source"),
        F.col("turn").alias("page_no"),
        F.when(F.pmod("conv_id", F.lit(9)) == 4, "  ")
        .when(F.pmod(key, F.lit(5)) != 2, F.col("text"))
        .alias("page_text"),
        (F.pmod(key, F.lit(6)) == 1).alias("failed"),
    )


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of calls with a status and a message."""
    events = table(spark, sf_dir, "events")
    log = {
        0: (200, "ok"), 1: (429, "rate limit"), 2: (503, "unavailable"),
        3: (None, "request timeout"), 4: (400, "bad request"), 5: (400, "could not generate"),
    }
    # all columns decide the status and are part of the message
    said = F.concat_ws(" ", "event_type", "props")
    whole = F.coalesce(F.floor(F.abs("value")), F.lit(0))
    kind = F.pmod(F.col("event_id") + F.length(said) + whole, F.lit(6))
    status, message = F.lit(None).cast("int"), F.lit(None).cast("string")
    for k, (code, words) in log.items():
        status = F.when(kind == k, F.lit(code).cast("int")).otherwise(status)
        message = F.when(kind == k, words).otherwise(message)
    message = F.concat_ws(" ", message, said)
    return events.select("event_id", status.alias("status_code"), message.alias("message"))


def recorded_replies(docs: DataFrame, max_tokens: int) -> DataFrame:
    """A recorded outcome for every chunk of the documents, by the length of its text.

    Every 17th length was refused, every 13th was cut short; the rest are full
    records with all capitalised words of the chunk as people.
    """
    return replies_to(chunk_documents(clean_documents(docs), max_tokens=max_tokens))


def replies_to(chunks: DataFrame) -> DataFrame:
    """The recorded outcomes of ``recorded_replies`` for chunks that are cut already."""
    size = F.length("text")
    org = lambda n: F.concat(F.lit("Org "), F.pmod(size, F.lit(n)))
    reply = F.struct(
        F.col("text").alias("summary"),
        F.struct(
            F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)).alias("people"),
            F.array().cast("array<string>").alias("places"),
            F.array(org(7), org(3)).alias("organizations"),
        ).alias("entities"),
        F.struct(
            F.element_at(F.array(*map(F.lit, C.LABELS)), (F.pmod(size, F.lit(3)) + 1).cast("int")).alias("label"),
            (F.pmod(size, F.lit(101)) / F.lit(100.0)).alias("confidence"),
        ).alias("sentiment"),
        F.array(F.concat(F.lit("Why "), size, F.lit("?"))).alias("key_questions"),
    )
    cut = '{"summary": "Cut short", "sentiment": {"label": "Negative", "conf'
    refused = F.pmod(size, F.lit(17)) == 0
    raw = F.when(refused, None).when(F.pmod(size, F.lit(13)) == 0, cut).otherwise(F.to_json(reply))
    return chunks.select(
        "doc_seq", "chunk_index", raw.alias("raw"), F.when(refused, "bad request").alias("error")
    )


def recorded_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for every document, with the answers that its attempts once got, by the length of its text:
    a reply; two rate limits, then a reply; a timeout each time; a refusal each time."""
    docs = documents(spark, sf_dir)
    kinds = {
        0: [("ok", None)],
        1: [("rate_limit", 429), ("rate_limit", 429), ("ok", None)],
        2: [("timeout", None)] * C.MODEL_ATTEMPTS,
        3: [("status", 400)] * C.MODEL_ATTEMPTS,
    }

    def answer(kind, status):
        reply = F.col("raw_text") if kind == "ok" else F.concat(F.lit(f"{kind} after "), F.length("raw_text"))
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(status).cast("int").alias("status_code"), reply.alias("reply")
        )

    size = F.pmod(F.length("raw_text"), F.lit(4))
    answers = F.array(*[answer(*a) for a in kinds[0]])
    for kind, row in kinds.items():
        answers = F.when(size == kind, F.array(*[answer(*a) for a in row])).otherwise(answers)
    request = F.to_json(F.struct(F.col("doc_seq").alias("id"), answers.alias("answers")))
    return docs.select("doc_seq", request.alias("request"))


REPLY_CASES = 32


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model reply for every document, in one of 32 shapes, with ``case_no``.

    A well-formed reply quotes the whole text as its summary, two words of it
    as people, the source as organization and the language as place.
    """
    docs = table(spark, sf_dir, "documents")
    words = F.split("text", r"[ \n]")
    people = F.array(F.get(words, F.lit(0)), F.get(words, F.lit(1)))
    confidence = F.pmod("doc_id", F.lit(101)) / F.lit(100.0)
    docs = docs.select(
        F.col("doc_id").alias("doc_seq"),
        F.col("doc_id").alias("chunk_id"),
        "source",
        F.pmod("doc_id", F.lit(7)).cast("int").alias("chunk_index"),
        F.lit(7).alias("total_chunks"),
        F.substring("text", 1, 200).alias("text_preview"),
        (F.pmod("doc_id", F.lit(REPLY_CASES)) + 1).alias("case_no"),
        F.to_json(F.struct(F.col("text").alias("t"))).alias("_summary"),
        F.to_json(people).alias("_people"),
        F.to_json(F.struct(F.col("source").alias("s"))).alias("_org"),
        F.to_json(F.struct(F.col("lang").alias("s"))).alias("_place"),
        F.element_at(
            F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative")),
            (F.pmod("doc_id", F.lit(3)) + 1).cast("int"),
        ).alias("_label"),
        confidence.cast("string").alias("_conf"),
    )
    summary = F.expr("substring(_summary, 6, length(_summary) - 6)")
    org = F.expr("substring(_org, 6, length(_org) - 6)")
    place = F.expr("substring(_place, 6, length(_place) - 6)")

    def reply(
        summary=summary, people=F.col("_people"), entities=None,
        label=F.col("_label"), conf=F.col("_conf"), questions=F.lit('["q1","q2","q3"]'),
    ):
        entities = entities if entities is not None else F.concat(
            F.lit('{"people":'), people, F.lit(',"places":['), place,
            F.lit('],"organizations":['), org, F.lit("]}"),
        )
        return F.concat(
            F.lit('{"summary":'), summary, F.lit(',"entities":'), entities,
            F.lit(',"sentiment":{"label":"'), label, F.lit('","confidence":'), conf,
            F.lit('},"key_questions":'), questions, F.lit("}"),
        )

    good = reply()
    around = lambda a, b: F.concat(F.lit(a), good, F.lit(b))
    shapes = [
        good,
        around("```json\n", "\n```"),
        around("Here is the result: ", "\nHope this helps."),
        reply(questions=F.lit('["q1","q2","q3", ]')),
        F.concat(
            F.lit('{"summary": "Cut off '), F.col("source"),
            F.lit('", "sentiment": {"label": "Negative", "conf'),
        ),
        F.lit("I cannot help with that."),
        F.lit(" \n\t "),
        F.lit("[]"),
        around("[", "]"),
        F.concat(good, F.lit(","), good),
        F.lit("{}"),
        reply(people=F.lit('"Bob"')),
        reply(people=F.lit("null")),
        reply(conf=F.lit('"high"')),
        reply(conf=F.lit("7")),
        reply(conf=F.lit("NaN")),
        reply(label=F.concat(F.lit(" "), F.col("_label"))),
        reply(questions=F.lit('"only one"')),
        reply(questions=F.lit('["q1","q2","q3","q4"]')),
        reply(summary=F.lit("null")),
        reply(entities=F.lit("[1]")),
        F.lit("{'summary': 'x'}"),
        around("```JSON\n", "\n```"),
        reply(conf=F.lit("true")),
        F.lit('"text"'),
        reply(summary=F.concat(F.lit('"x: NaN, [-Infinity] '), F.col("source"), F.lit('"')), conf=F.lit("NaN")),
        reply(people=F.lit("NaN")),
        reply(people=F.lit('["A",NaN, -Infinity ]'), conf=F.lit("-Infinity")),
        reply(questions=F.lit('["q1",NaN,-Infinity]'), label=F.lit("NaN")),
        F.concat(F.lit('{"summary":"old","key_questions":NaN,'), F.substring(good, 2, 1 << 30)),
        F.lit("[NaN]"),
        reply(entities=F.concat(
            F.lit('{"people":[null,'), org, F.lit('],"places":['), place, F.lit(',null],"organizations":[null]}')
        )),
    ]
    raw = F.lit(None).cast("string")
    for number, shape in reversed(list(enumerate(shapes, 1))):
        raw = F.when(F.col("case_no") == number, shape).otherwise(raw)
    return docs.select(
        "doc_seq", "chunk_id", "source", "chunk_index", "total_chunks", "text_preview",
        "case_no", raw.alias("raw"),
    )
