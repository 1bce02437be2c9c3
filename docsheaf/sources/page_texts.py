"""Documents assembled from their pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf.functions.text import is_blank

PAGES_PER_BLOCK = 256


def _in_order(rows: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(rows), lambda r: r["text"]), "\n")


def assemble_pages(pages: DataFrame) -> DataFrame:
    """``(source, raw_text)``, blank ones included.

    Takes ``(source, page_no, page_text, failed)``. Pages are first joined in
    blocks, so that the pages of a very long document are gathered by many
    tasks; the document, one row in the end, is then joined from few blocks.
    """
    usable = pages.filter(~F.col("failed"))
    page = F.struct(F.col("page_no"), F.coalesce("page_text", F.lit("")).alias("text"))
    blocks = usable.groupBy(
        "source", F.floor(F.col("page_no") / PAGES_PER_BLOCK).alias("block")
    ).agg(_in_order(F.collect_list(page)).alias("text"))
    return blocks.groupBy("source").agg(
        _in_order(F.collect_list(F.struct("block", "text"))).alias("raw_text")
    )


def read_page_documents(pages: DataFrame) -> DataFrame:
    """``(source, source_type, raw_text)`` of documents that have any text."""
    return (
        assemble_pages(pages)
        .filter(~is_blank(F.col("raw_text")))
        .select("source", F.lit("file_pdf").alias("source_type"), "raw_text")
    )


def textless_documents(pages: DataFrame) -> DataFrame:
    """Rejects: documents none of whose pages gave text."""
    texts = pages.filter(~F.col("failed") & ~is_blank(F.coalesce("page_text", F.lit(""))))
    return (
        pages.select("source", F.lit(0).alias("has_text"))
        .unionAll(texts.select("source", F.lit(1)))
        .groupBy("source")
        .agg(F.max("has_text").alias("has_text"))
        .filter(F.col("has_text") == 0)
        .select(
            "source", F.lit("ingest").alias("stage"), F.lit("no extractable text").alias("reason")
        )
    )
