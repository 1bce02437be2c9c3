"""One query for each operator, over its whole table, and its SQL where there is one."""

from pyspark.sql import DataFrame, SparkSession

from docsheaf.llm import (
    credentials, exact_dedup, filter_audit, line_quality, line_runs, mixing, ngram_model, pieces, pii, simhash,
    token_store, url_filter, vector_codes,
)
from docsheaf.llm.common import read_table
from docsheaf.llm.oracles import ORACLES as ORACLES


def tokenizer_file(name: str) -> str:
    """Where the installed vocabulary files lie; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pieces.encode_and_decode(docs, tokenizer_file("piece_bpe_32k.model"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.digest(mixing.mixed(docs))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.find_secrets(read_table(spark, sf_dir, "documents")))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_store.store_digest(docs, tokenizer_file("word_bpe_49k.json"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(read_table(spark, sf_dir, "documents")))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(read_table(spark, sf_dir, "documents")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    chain = line_quality.train(docs, read_table(spark, sf_dir, "labels"))
    return line_quality.digest(line_quality.judged(docs.select("doc_id", "text"), chain))


def op9_ngram_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_model.scores(read_table(spark, sf_dir, "documents"))


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.digest(line_runs.without_repeated_runs(docs))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(read_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return filter_audit.audited(docs, read_table(spark, sf_dir, "labels"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(url_filter.judged(read_table(spark, sf_dir, "pages")))


QUERIES = {
    "op1_pieces": op1_pieces,
    "op2_mixing": op2_mixing,
    "op3_secrets": op3_secrets,
    "op4_token_store": op4_token_store,
    "op5_pii": op5_pii,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_ngram_model": op9_ngram_model,
    "op10_line_runs": op10_line_runs,
    "op11_vector_codes": op11_vector_codes,
    "op12_filter_audit": op12_filter_audit,
    "op13_url_filter": op13_url_filter,
}
