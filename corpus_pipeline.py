"""From raw documents to token ids: five stages, each on all that the one before kept.

The mixture decides the order of the token ids: the last table's files, in the order
of their names, have the documents in that of the schedule.

Rows without an identifier cannot be told apart, so near-duplicate removal
leaves them alone. Of repeated rows one stays there. Further columns of the
documents are kept up to the last stage; ``n_chars``, if there, follows the text.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsheaf.llm import line_quality, line_runs, mixing, pieces, simhash
from docsheaf.llm.common import as_written, read_table, staged
from docsheaf.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    chain = line_quality.train(docs, read_table(spark, sf_dir, "labels"))
    return line_quality.judged(docs, chain).filter("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those of nothing else go."""
    found = line_runs.without_repeated_runs(docs)
    left = found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        same = F.when(F.col("n_removed") == 0, F.col("row.n_chars"))
        changed["n_chars"] = same.otherwise(F.char_length("text")).cast(kind)
    return left.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by identifier and text, of every group of near duplicates."""
    groups = simhash.near_duplicates(docs)
    first = simhash.first_of_groups(groups).withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("_id"))
    rows = rows.withColumn("_digest", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    # the join has each document's rows together and in order: no shuffle for the window
    once = Window.partitionBy("_id", "_digest").orderBy("_digest")
    kept = rows.join(first, ["_id", "_digest"], "left_semi").withColumn("_copy", F.row_number().over(once))
    return kept.filter("_copy = 1").select("row.*").unionByName(docs.filter("doc_id is null"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture to target weights, in its order."""
    return mixing.in_order(mixing.mixed(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_pieces, decoded_equal)`` of every document, in the order in which they were written."""
    return pieces.encode_and_decode(as_written(docs), tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("encode", encode),
]

#: Trained models and schedules are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
