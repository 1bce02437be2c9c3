"""Table schemas, as Spark DDL."""

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

DOCUMENTS = "doc_seq bigint, source string, source_type string, raw_text string"
PAGE_TEXTS = "source string, page_no bigint, page_text string, failed boolean"
CAPTURES = "source string, content_type string, body string"
REJECTS = "source string, stage string, reason string"
CHUNKS = (
    "doc_seq bigint, source string, source_type string, "
    "chunk_index int, total_chunks int, text string"
)
ENTITIES = "struct<people:array<string>,places:array<string>,organizations:array<string>>"
SENTIMENT = "struct<label:string,confidence:double>"
EXTRACTION = (
    f"summary string, entities {ENTITIES}, sentiment {SENTIMENT}, "
    "key_questions array<string>, parse_error boolean"
)
CALL = "raw string, status string, attempts int, waited double, error string"
RESULTS = f"chunk_id bigint, source string, chunk_index int, text_preview string, {EXTRACTION}"


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select the columns of ``ddl`` and fail early if a name or type differs."""
    wanted = StructType.fromDDL(ddl)
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    for field in wanted:
        have = actual.get(field.name)
        if have != field.dataType.simpleString():
            raise TypeError(
                f"column {field.name}: expected {field.dataType.simpleString()}, found {have}"
            )
    return df.select(*wanted.names)
