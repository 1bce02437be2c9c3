"""Result records and their flat form."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf import constants as C

FLAT_COLUMNS = (
    "chunk_id", "source", "chunk_index", "text_preview", "summary", "people", "places",
    "organizations", "sentiment_label", "sentiment_confidence", "question_1", "question_2",
    "question_3", "parse_error",
)


def succeeded(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_path") != "failed")


def failed(parsed: DataFrame) -> DataFrame:
    """Chunks without a record, because the call failed or the reply was unusable."""
    return parsed.filter(F.col("parse_path") == "failed")


def result_records(parsed: DataFrame) -> DataFrame:
    """One record per successful chunk. Takes parsed calls with ``chunk_id``."""
    return succeeded(parsed).select(
        "chunk_id", "source", "chunk_index", "text_preview", "summary", "entities",
        "sentiment", "key_questions", "parse_error", "parse_path",
    )


def flat_rows(results: DataFrame) -> DataFrame:
    """14 scalar columns per result."""

    def joined(kind) -> Column:
        return F.array_join(F.col(f"entities.{kind}"), "; ")

    def question(n) -> Column:
        return F.coalesce(F.get("key_questions", F.lit(n)), F.lit(""))

    return results.select(
        "chunk_id",
        "source",
        "chunk_index",
        F.substring("text_preview", 1, C.FLAT_PREVIEW_CHARS).alias("text_preview"),
        "summary",
        joined("people").alias("people"),
        joined("places").alias("places"),
        joined("organizations").alias("organizations"),
        F.col("sentiment.label").alias("sentiment_label"),
        F.col("sentiment.confidence").alias("sentiment_confidence"),
        question(0).alias("question_1"),
        question(1).alias("question_2"),
        question(2).alias("question_3"),
        F.coalesce("parse_error", F.lit(False)).alias("parse_error"),
    )
