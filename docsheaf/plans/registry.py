"""The registered queries: every operator over the whole given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsheaf.functions import text as T
from docsheaf.functions.replies import parse_replies
from docsheaf.functions.tokens import estimate_tokens
from docsheaf.operators import calls as X
from docsheaf.operators import report as R
from docsheaf.operators.chunking import (
    add_chunks,
    chunk_documents,
    doc_stats,
    paragraphs,
    preview,
    sentences,
    without_chunks,
)
from docsheaf.operators.cleaning import clean_documents
from docsheaf.operators.long_documents import chunk_long_documents
from docsheaf.operators.numbering import chunk_offsets, dense_numbers, number_chunks
from docsheaf.operators.results import failed, flat_rows, result_records
from docsheaf.plans import inputs
from docsheaf.plans.extraction import run_extraction, save_run
from docsheaf.session import materialize, workspace
from docsheaf.sources import captures as web
from docsheaf.sources import files, page_texts, ranges, sinks
from docsheaf.sources.union import number_by, union_rejects, union_sources

GENERATED_AT = "2024-01-01 00:00:00"


# --- cleaning ---------------------------------------------------------------------------


def _dirty_text(step):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = inputs.dirty_documents(spark, sf_dir)
        return docs.select("doc_seq", step(F.col("raw_text")).alias("text"))

    return query


def clean_documents_query(spark, sf_dir):
    docs = clean_documents(inputs.dirty_documents(spark, sf_dir))
    return docs.select("doc_seq", F.col("clean_text").alias("text"))


def doc_stats_query(spark, sf_dir):
    docs = clean_documents(inputs.dirty_documents(spark, sf_dir))
    return doc_stats(add_chunks(docs, max_tokens=200))


# --- chunking ----------------------------------------------------------------------------


def paragraphs_query(spark, sf_dir):
    docs = clean_documents(inputs.dirty_documents(spark, sf_dir))
    return docs.select(
        "doc_seq", F.posexplode_outer(paragraphs(F.col("clean_text"))).alias("para_no", "text")
    ).select("doc_seq", "para_no", "text", estimate_tokens(F.col("text")).alias("tokens"))


def sentences_query(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return docs.select(
        "doc_seq", F.posexplode_outer(sentences(F.col("raw_text"))).alias("sentence_no", "text")
    ).select("doc_seq", "sentence_no", "text", estimate_tokens(F.col("text")).alias("tokens"))


def _chunks(max_tokens):
    def query(spark, sf_dir):
        docs = clean_documents(inputs.dirty_documents(spark, sf_dir))
        chunks = chunk_documents(docs, max_tokens=max_tokens)
        return chunks.withColumn("text_preview", preview(F.col("text")))

    return query


def long_chunks(spark, sf_dir):
    """The chunks of documents that come in pieces of a thousand characters."""
    pieces = inputs.document_pieces(inputs.dirty_documents(spark, sf_dir), 1000)
    return chunk_long_documents(pieces, max_tokens=60)


def chunk_numbers(spark, sf_dir):
    docs = clean_documents(inputs.documents(spark, sf_dir))
    chunks = chunk_documents(docs, max_tokens=200).select(
        "doc_seq", "source", "chunk_index", "total_chunks"
    )
    chunks = materialize(chunks, workspace(spark, "chunks"))
    return number_chunks(chunks, chunk_offsets(chunks))


def chunks_by_source(spark, sf_dir):
    docs = clean_documents(inputs.documents(spark, sf_dir))
    chunks = chunk_documents(docs, max_tokens=200)
    tokens = chunks.select("source", estimate_tokens(F.col("text")).alias("tokens"))
    return tokens.groupBy("source").agg(
        F.count("*").alias("chunks"), F.round(F.avg("tokens"), 6).alias("mean_tokens")
    )


# --- sources --------------------------------------------------------------------------------


def _file_names(docs: DataFrame) -> DataFrame:
    """The documents as files: encoded content and a path, some not accepted."""
    kind = F.pmod("doc_seq", F.lit(6))
    ext = F.element_at(
        F.array(*map(F.lit, [".txt", ".TXT", ".pdf", ".md", "", ".tar.txt"])), kind.cast("int") + 1
    )
    latin = F.regexp_replace("raw_text", r"[^\x{0}-\x{ff}]", "?")
    as_bytes = F.when(
        F.pmod("doc_seq", F.lit(2)) == 0, F.encode("raw_text", "UTF-8")
    ).otherwise(F.encode(latin, "ISO-8859-1"))
    return docs.select(
        "doc_seq",
        F.concat(F.lit("in.d/"), F.col("source"), F.lit("/"), F.col("doc_seq"), ext).alias("source"),
        as_bytes.alias("content"),
    )


def text_decode(spark, sf_dir):
    docs = _file_names(inputs.dirty_documents(spark, sf_dir))
    return docs.select("doc_seq", files.decode_text(F.col("content")).alias("text"))


def file_routes(spark, sf_dir):
    docs = _file_names(inputs.documents(spark, sf_dir))
    return files.route_files(docs).select("doc_seq", "source", "source_type")


def file_rejects(spark, sf_dir):
    return files.unsupported_files(_file_names(inputs.documents(spark, sf_dir)))


def text_files(spark, sf_dir):
    """Each document written as a file of its own, some empty, hidden or in folders, then scanned."""
    path = workspace(spark, "files")
    files.write_contents(inputs.named_files(spark, sf_dir), path).count()
    found = files.read_text_files(files.scan_files(spark, path))
    name = F.regexp_extract("source", r"/(files-[0-9a-f]{32})/(.*)$", 2)
    return found.select(name.alias("path"), "source_type", F.col("raw_text").alias("text"))


def text_ranges(spark, sf_dir):
    """Each document written as a file, in one of two encodings, and read in ranges of a kilobyte."""
    path = workspace(spark, "files")
    docs = _file_names(inputs.dirty_documents(spark, sf_dir))
    name = F.concat(F.lit("d"), F.pmod("doc_seq", F.lit(10)), F.lit("/"), F.col("doc_seq"), F.lit(".txt"))
    files.write_contents(docs.select(name.alias("source"), "content"), path).count()
    pieces, _ = ranges.read_text_pieces(spark, path, range_bytes=1024, split_bytes=4 << 20)
    found = F.regexp_extract("source", r"/([0-9]+)\.txt$", 1).cast("bigint")
    return ranges.joined_pieces(pieces).select(found.alias("doc_seq"), F.col("raw_text").alias("text"))


def number_files(spark, sf_dir):
    """Files numbered in the order of their paths over 200 partitions, united with the pages."""
    docs = _file_names(inputs.documents(spark, sf_dir)).select(
        "source", F.lit("file_txt").alias("source_type"), F.lit("").alias("raw_text")
    )
    pages = inputs.captures(spark, sf_dir).select(
        "page_id", "source", F.lit("url").alias("source_type"), F.lit("").alias("raw_text")
    )
    both = union_sources((number_by(docs, "source", partitions=200), "position"), (pages, "page_id"))
    return both.select("doc_seq", "source", "source_type")


def assemble_pages(spark, sf_dir):
    return page_texts.read_page_documents(inputs.page_texts(spark, sf_dir))


def page_rejects(spark, sf_dir):
    return page_texts.textless_documents(inputs.page_texts(spark, sf_dir))


def html_main_text(spark, sf_dir):
    pages = web.read_captures(inputs.captures(spark, sf_dir), "page_id")
    return pages.select("page_id", "source", "source_type", F.col("raw_text").alias("text"))


def page_chunks(spark, sf_dir):
    """Captured pages, cleaned and chunked."""
    pages = web.read_captures(inputs.captures(spark, sf_dir), F.col("page_id").alias("doc_seq"))
    return chunk_documents(clean_documents(pages), max_tokens=100)


def capture_rejects(spark, sf_dir):
    return web.blank_captures(inputs.captures(spark, sf_dir))


def missing_rejects(spark, sf_dir):
    """Wanted files that a listing without some of them does not have."""
    wanted = _file_names(inputs.documents(spark, sf_dir))
    return files.missing_files(wanted.select("source"), wanted.filter("doc_seq % 7 <> 3").select("source"))


def pdf_rejects(spark, sf_dir):
    """PDF files of which a quarter have page texts."""
    found = _file_names(inputs.documents(spark, sf_dir))
    return files.pdfs_without_pages(found, found.filter("doc_seq % 4 = 0").select("source"))


def fetch_rejects(spark, sf_dir):
    return web.failed_fetches(inputs.fetches(spark, sf_dir))


def blank_rejects(spark, sf_dir):
    """Documents that cleaning leaves without text."""
    docs = clean_documents(inputs.blanked_documents(spark, sf_dir))
    return without_chunks(add_chunks(docs, max_tokens=200))


def unreadable_rejects(spark, sf_dir):
    """Accepted files of which some had an error when they were read."""
    return files.unreadable_files(inputs.read_files(_file_names(inputs.dirty_documents(spark, sf_dir))))


def all_rejects(spark, sf_dir):
    """Every skipped input of all sources and kinds in one table."""
    return union_rejects(*[reject(spark, sf_dir) for reject in REJECTS])


REJECTS = (
    file_rejects, page_rejects, capture_rejects, missing_rejects, pdf_rejects, fetch_rejects, blank_rejects,
    unreadable_rejects,
)


def union_sources_query(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    pages = web.read_captures(inputs.captures(spark, sf_dir), "page_id")
    return union_sources((docs, "doc_seq"), (pages, "page_id"))


# --- calls --------------------------------------------------------------------------------------


def _requests(provider):
    def query(spark, sf_dir):
        docs = inputs.documents(spark, sf_dir)
        key_variable = X.C.PROVIDERS[provider][0]
        config = X.model_config({"LLM_PROVIDER": provider, key_variable: "set"})
        request = docs.select(
            "doc_seq", X.build_request(F.col("raw_text"), config).alias("request")
        )
        role = lambda n: F.get("request.messages", F.lit(n))["role"]
        return request.select(
            "doc_seq",
            "request.model",
            F.size("request.messages").alias("messages"),
            role(0).alias("first_role"),
            F.element_at("request.messages", 1)["content"].alias("first_content"),
            F.element_at("request.messages", -1)["content"].alias("prompt"),
            "request.temperature",
            "request.timeout",
        )

    return query


def classify_errors(spark, sf_dir):
    return X.classify_log(inputs.call_log(spark, sf_dir))


def _replayed_calls(policy):
    def query(spark, sf_dir):
        """The retry rules over recorded answers, of as many attempts as the policy makes."""
        rows = inputs.recorded_attempts(spark, sf_dir)
        return X.call_rows(rows, "request", X.replay_client, policy, X.no_wait).drop("request")

    return query


def split_outcomes(spark, sf_dir):
    """Calls written once, then split by outcome."""
    calls = materialize(
        _replayed_calls(X.MODEL_POLICY)(spark, sf_dir), workspace(spark, "calls")
    )
    ok = calls.filter(F.col("status") == X.SUCCESS)
    bad = calls.filter(F.col("status") == X.FAILURE)
    return ok.select("doc_seq", F.lit("results").alias("part"), F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("doc_seq", F.lit("failed").alias("part"), "error")
    )


def resume_calls(spark, sf_dir):
    """Calls still to make after a run that recorded only the successes."""
    calls = materialize(
        _replayed_calls(X.MODEL_POLICY)(spark, sf_dir).select("doc_seq", "status"),
        workspace(spark, "calls"),
    )
    rows = inputs.documents(spark, sf_dir).select("doc_seq", "raw_text")
    done = calls.filter(F.col("status") == X.SUCCESS)
    return X.pending(rows, done, "doc_seq").select("doc_seq", F.length("raw_text").alias("chars"))


# --- replies ----------------------------------------------------------------------------------------


def parse_replies_query(spark, sf_dir):
    parsed = parse_replies(inputs.replies(spark, sf_dir))
    return parsed.select("doc_seq", "case_no", "parse_path", "reason", "parse_error")


def _joined(column):
    return F.array_join(column, "|")


def coerce_replies(spark, sf_dir):
    parsed = parse_replies(inputs.replies(spark, sf_dir))
    return parsed.select(
        "doc_seq",
        "summary",
        _joined("entities.people").alias("people"),
        _joined("entities.places").alias("places"),
        _joined("entities.organizations").alias("organizations"),
        F.col("sentiment.label").alias("label"),
        F.col("sentiment.confidence").alias("confidence"),
        _joined("key_questions").alias("questions"),
    )


def _parsed(spark, sf_dir) -> DataFrame:
    return materialize(
        parse_replies(inputs.replies(spark, sf_dir)).drop("raw"), workspace(spark, "parsed")
    )


def flat_rows_query(spark, sf_dir):
    return flat_rows(result_records(parse_replies(inputs.replies(spark, sf_dir))))


def csv_roundtrip(spark, sf_dir):
    results = result_records(parse_replies(inputs.replies(spark, sf_dir)))
    path = workspace(spark, "csv")
    sinks.write_csv(results, path)
    return sinks.read_csv(spark, path, flat_rows(results).schema)


def json_roundtrip(spark, sf_dir):
    results = result_records(parse_replies(inputs.replies(spark, sf_dir)))
    path = workspace(spark, "json")
    sinks.write_json(results, path)
    return flat_rows(spark.read.schema(results.drop("parse_path").schema).json(path))


# --- report ---------------------------------------------------------------------------------------------


def report_overview(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    return R.overview(
        inputs.table(spark, sf_dir, "documents"), result_records(parsed), failed(parsed)
    )


def _over_results(section):
    def query(spark, sf_dir):
        return section(result_records(parse_replies(inputs.replies(spark, sf_dir))))

    return query


def mean_confidence(results):
    return R.sentiment_summary(results).select(
        "total", F.round("mean_confidence", 6).alias("mean_confidence")
    )


def top_entities(results):
    return R.top_entities(results).select(
        F.element_at(F.array(*[F.lit(k) for k, _ in R.KINDS]), F.col("kind_no") + 1).alias("kind"),
        "rank", "name", "mentions", F.col("first_seen.chunk_id").alias("first_chunk"),
    )


def report_lines(spark, sf_dir):
    """The report, with the place of each line."""
    parsed = _parsed(spark, sf_dir)
    lines = R.report_lines(
        inputs.table(spark, sf_dir, "documents"), result_records(parsed), failed(parsed), GENERATED_AT
    )
    return lines


# --- everything ---------------------------------------------------------------------------------------------


def no_client():
    """Every chunk has a recorded outcome, so nothing may be sent."""

    def call(request):
        raise X.CallError("a call without a client")

    return call


def _run(spark, sf_dir):
    """Documents to results: clean, chunk, take the recorded replies, parse, number."""
    docs = inputs.dirty_documents(spark, sf_dir)
    return run_extraction(
        docs, no_client, workspace(spark, "run"), max_tokens=200, waves=3,
        recorded=inputs.replies_to, generated_at=GENERATED_AT,
    )


def extraction_run(spark, sf_dir):
    return flat_rows(_run(spark, sf_dir).results)


def extraction_failures(spark, sf_dir):
    return _run(spark, sf_dir).failures


def stop_on_empty(spark, sf_dir):
    """Runs that stop and save nothing: without documents, without text in any, with every call refused."""
    docs = inputs.documents(spark, sf_dir)
    blank = docs.withColumn("raw_text", F.regexp_replace("raw_text", r"\S", " "))
    refused = lambda chunks: inputs.replies_to(chunks).withColumns(
        {"raw": F.lit(None).cast("string"), "error": F.coalesce("error", F.lit("refused"))}
    )
    rows = []
    for case, these, recorded in (("none", docs.filter("doc_seq is null"), None), ("blank", blank, None), ("refused", docs, refused)):
        folder = workspace(spark, "stopped")
        try:
            run = run_extraction(these, no_client, f"{folder}/run", max_tokens=200, recorded=recorded)
            save_run(run, folder, "r1")
            reason = None
        except sinks.EmptyStage as stop:
            reason = str(stop)
        rows.append((case, reason, these.count(), sinks.published(spark, folder, "r1") is not None))
    return spark.createDataFrame(rows, "case string, reason string, documents bigint, saved boolean")


def saved_run(spark, sf_dir):
    """The files of a run as read back, each row with the name of its file."""
    run = _run(spark, sf_dir)
    paths = save_run(run, workspace(spark, "saved"), "r1", compression="gzip")
    name = lambda path: F.lit(path.rpartition("/")[2]).alias("file")
    rows = flat_rows(run.results)
    nested = spark.read.schema(run.results.drop("parse_path").schema).json(paths["json"])
    flat = sinks.read_csv(spark, paths["csv"], rows.schema)
    return flat_rows(nested).select(name(paths["json"]), "*").unionByName(
        flat.select(name(paths["csv"]), "*")
    )


def report_roundtrip(spark, sf_dir):
    """The report as written and read back: its parts in the order of their names."""
    path = workspace(spark, "report")
    sinks.write_report(report_lines(spark, sf_dir), path)
    # a summary may have several lines
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    return dense_numbers(rows, ["part", "block", "row"], "line_no").select("line_no", "line")


QUERIES = {
    "clean_replace": _dirty_text(T.replace_artefacts),
    "clean_nfc": _dirty_text(T.nfc),
    "clean_boilerplate": _dirty_text(T.drop_boilerplate),
    "clean_newlines": _dirty_text(T.collapse_newlines),
    "clean_trim": _dirty_text(T.trim_lines),
    "clean_text": clean_documents_query,
    "doc_stats": doc_stats_query,
    "paragraphs": paragraphs_query,
    "sentences": sentences_query,
    "chunks_60": _chunks(60),
    "chunks_200": _chunks(200),
    "chunks_800": _chunks(800),
    "long_chunks": long_chunks,
    "chunk_numbers": chunk_numbers,
    "chunks_by_source": chunks_by_source,
    "text_decode": text_decode,
    "file_routes": file_routes,
    "file_rejects": file_rejects,
    "text_files": text_files,
    "text_ranges": text_ranges,
    "number_files": number_files,
    "missing_rejects": missing_rejects,
    "pdf_rejects": pdf_rejects,
    "fetch_rejects": fetch_rejects,
    "blank_rejects": blank_rejects,
    "assemble_pages": assemble_pages,
    "page_rejects": page_rejects,
    "html_main_text": html_main_text,
    "page_chunks": page_chunks,
    "capture_rejects": capture_rejects,
    "unreadable_rejects": unreadable_rejects,
    "all_rejects": all_rejects,
    "union_sources": union_sources_query,
    "requests_openai": _requests("openai"),
    "requests_gemini": _requests("gemini"),
    "classify_errors": classify_errors,
    "call_rows_model": _replayed_calls(X.MODEL_POLICY),
    "call_rows_fetch": _replayed_calls(X.FETCH_POLICY),
    "split_outcomes": split_outcomes,
    "resume_calls": resume_calls,
    "parse_replies": parse_replies_query,
    "coerce_replies": coerce_replies,
    "flat_rows": flat_rows_query,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "report_overview": report_overview,
    "report_sources": _over_results(R.chunks_per_source),
    "report_sentiment": _over_results(R.sentiment_distribution),
    "report_confidence": _over_results(mean_confidence),
    "report_entities": _over_results(top_entities),
    "report_lines": report_lines,
    "report_roundtrip": report_roundtrip,
    "extraction_run": extraction_run,
    "stop_on_empty": stop_on_empty,
    "saved_run": saved_run,
    "extraction_failures": extraction_failures,
}
