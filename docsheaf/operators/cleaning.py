"""Cleaning a document table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsheaf import constants as C
from docsheaf.functions import text as T
from docsheaf.session import computed_once


def clean_documents(
    documents: DataFrame, column="raw_text", into="clean_text", patterns=C.BOILERPLATE_PATTERNS
) -> DataFrame:
    """Add the cleaned text. Narrow; only text that may be denormalized visits Python."""
    cleaned = documents.withColumn(into, T.clean_text(F.col(column), patterns))
    return computed_once(cleaned, into)
