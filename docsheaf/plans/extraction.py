"""The whole run: documents to chunks, calls, results, files and report.

Each stage is written once and the next one reads what was written. A text is
written as a chunk, a reply with its call and a record when it is parsed; calls
are looked up by the numbers of their chunks. What is shuffled for a stage goes
with it, and given outcomes go once their wave has its calls.
"""

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsheaf import constants as C
from docsheaf import schemas
from docsheaf.functions.replies import parse_replies
from docsheaf.functions.tokens import TokenCounter, estimated
from docsheaf.operators import calls as X
from docsheaf.operators.chunking import chunk_documents, preview
from docsheaf.operators.cleaning import clean_documents
from docsheaf.operators.numbering import chunk_offsets, number_chunks
from docsheaf.operators.report import added_counters, chunks_per_source, counted_totals, merged_sources, report_lines
from docsheaf.operators.report import counters as report_counters
from docsheaf.operators.results import failed, result_records
from docsheaf.operators.shared_rate import write_outcomes_at_rate
from docsheaf.session import configure, exists, remove, shuffles_end
from docsheaf.sources import sinks
from docsheaf.sources.journal import OUTCOME, read_outcomes, write_outcomes

KEYS = ("doc_seq", "chunk_index")
KEY_TYPES = "doc_seq bigint, chunk_index int"
#: Of the tables of a run, which hold each text about three times.
CODEC = "zstd"
#: ``(doc_seq, chunk_index, raw, error)`` of chunks whose outcome is known, or how to look it up for written chunks.
Recorded = DataFrame | Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Run:
    """The tables of a finished run, as read back from its folder."""

    chunks: DataFrame
    calls: DataFrame
    results: DataFrame
    failures: DataFrame
    totals: DataFrame
    report: Callable[[], DataFrame]

    @cached_property
    def lines(self) -> DataFrame:
        """The report's lines. Top names are counted when it is first asked for."""
        return self.report()


class StaleFolder(RuntimeError):
    """A stage in the folder was made from other documents or with other settings."""


def _finished(spark: SparkSession, path: str, settings: str) -> StructType | None:
    """The schema of a complete stage; raises if it is that of another run."""
    marker = f"{path}.done"
    if not exists(spark, marker):
        return None
    found = spark.read.parquet(marker).first()
    if found.settings != settings:
        raise StaleFolder(f"{path} was made with {found.settings}, not {settings}")
    return StructType.fromJson(json.loads(found.schema))


def _finish(
    spark: SparkSession, path: str, settings: str, schema: StructType, counted: dict | None = None
) -> StructType:
    row = (settings, schema.json(), json.dumps(counted))
    marker = spark.createDataFrame([row], "settings string, schema string, counted string")
    marker.coalesce(1).write.mode("overwrite").parquet(f"{path}.done")
    return schema


def counted_in(spark: SparkSession, path: str) -> dict:
    """What was counted while a finished stage was written."""
    return json.loads(spark.read.parquet(f"{path}.done").first().counted)


def _write(rows: DataFrame, path: str, *partition_by) -> None:
    with shuffles_end(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)


def _stage(
    spark: SparkSession, path: str, settings: str, build: Callable[[], DataFrame], *partition_by, counters=()
) -> DataFrame:
    """The table at ``path``, built unless an earlier run of this folder finished it.

    ``counters`` are counted by the tasks that write it and kept with its marker;
    a task that is tried again counts once.
    """
    schema = _finished(spark, path, settings)
    if schema is None:
        built, counted = build(), None
        rows = built
        if counters:
            observed = Observation(f"stage-{uuid.uuid4().hex}")
            rows = built.observe(observed, *counters)
        _write(rows, path, *partition_by)
        if counters:
            counted = observed.get
        schema = _finish(spark, path, settings, built.schema, counted)
    # a table without rows has no files to tell its columns
    return spark.read.schema(schema).parquet(path)


def settings_of(documents: DataFrame, **values) -> str:
    """Everything that a stage's rows depend on, as text. Reads the documents once."""
    digest = F.sum(F.xxhash64(*documents.columns).cast("decimal(38,0)"))
    n, total = documents.agg(F.count("*"), digest).first()
    return json.dumps({"documents": n, "digest": str(total), **values}, sort_keys=True)


def chunk_stage(documents: DataFrame, max_tokens: int, counter: TokenCounter, waves: int) -> DataFrame:
    """Chunks with their ``wave``: documents in order are cut into about equal waves.

    Neighbours share a wave, so a task writes to few of them.
    """
    chunks = chunk_documents(clean_documents(documents), "clean_text", max_tokens, counter)
    chunks = chunks.withColumn("text_preview", preview(F.col("text")))
    shares = [k / waves for k in range(1, waves)]
    cuts = documents.approxQuantile("doc_seq", shares, 0.001) if shares else []
    wave = F.lit(0)
    for cut in cuts:
        wave = wave + (F.col("doc_seq") > cut).cast("int")
    return chunks.withColumn("wave", wave)


def _recorded_stage(chunks: DataFrame, recorded: Recorded) -> DataFrame:
    """The given outcomes of the chunks with their wave, without texts."""
    known = (recorded(chunks) if callable(recorded) else recorded).select(*KEYS, "raw", "error")
    return chunks.select(*KEYS, "wave").join(known, list(KEYS)).withColumns(
        {
            "status": F.when(F.col("error").isNull(), X.SUCCESS).otherwise(X.FAILURE),
            "attempts": F.lit(0),
            "waited": F.lit(0.0),
        }
    )


def call_stage(
    spark: SparkSession, chunks: DataFrame, path: str, settings: str,
    send: Callable[[DataFrame], DataFrame], waves: int, recorded: Recorded | None = None,
    ended: Callable[[int], None] = lambda wave: None,
) -> DataFrame:
    """An outcome for every chunk, wave by wave. ``ended`` is called after each.

    ``send`` makes the calls of chunks without an outcome in ``recorded(doc_seq,
    chunk_index, raw, error)``, which is written once by wave. A wave is written
    and marked when it ends; a finished one is not looked at again, and what an
    interrupted run repeats of the others is up to ``send``. A wave's given outcomes
    are removed when it has ended.
    """
    known = None
    for wave in range(waves):
        part = f"{path}/wave={wave}"
        schema = _finished(spark, f"{path}.wave-{wave}", settings)
        if schema is not None:
            remove(spark, f"{path}.recorded/wave={wave}")
            ended(wave)
            continue
        if recorded is not None and known is None:
            build = lambda: _recorded_stage(chunks, recorded)
            known = _stage(spark, f"{path}.recorded", settings, build, "wave")
        todo = chunks.filter(F.col("wave") == wave).drop("wave")
        if known is None:
            outcomes = send(todo)
        else:
            given = known.filter(F.col("wave") == wave).drop("wave")
            outcomes = given
            # keys alone: texts are only dealt out if there are calls to make
            left = X.pending(todo.select(*KEYS), given, *KEYS)
            if not left.isEmpty():
                outcomes = send(todo.join(left, list(KEYS), "left_semi")).unionByName(outcomes)
        _write(outcomes, part)
        schema = _finish(spark, f"{path}.wave-{wave}", settings, outcomes.schema)
        remove(spark, f"{path}.recorded/wave={wave}")
        ended(wave)
    return spark.read.schema(schema).parquet(path)


def journalled(
    make_client: Callable, folder: str, policy: X.RetryPolicy, sleep: Callable[[float], None],
    concurrency: int | None = None, in_flight: int = 1,
) -> Callable[[DataFrame], DataFrame]:
    """A ``send`` whose outcomes, without the texts, are on record in ``folder`` as each call ends.

    Rows with an outcome there are not sent. A policy with a rate has it over
    all tasks, which then run at once: ``concurrency`` of them, or one for every
    slot.
    """

    def send(rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        todo = X.pending(rows, read_outcomes(spark, folder, KEY_TYPES), *KEYS)
        if policy.calls_per_second:
            tasks = concurrency or spark.sparkContext.defaultParallelism
            write_outcomes_at_rate(todo, folder, KEYS, make_client, policy, sleep, tasks, in_flight)
        else:
            todo = todo.repartition(concurrency, *KEYS) if concurrency else todo
            write_outcomes(todo, folder, KEYS, X.caller(make_client, policy, sleep), in_flight)
        return rows.select(*KEYS).join(read_outcomes(spark, folder, KEY_TYPES), list(KEYS))

    return send


def parsed_calls(calls: DataFrame, offsets: DataFrame) -> DataFrame:
    """Parsed and numbered calls; only failed ones keep their text.

    Numbering joins them with one offset per document: a wide shuffle of the
    parsed rows, unless the offsets are small enough for Spark to broadcast.
    """
    parsed = parse_replies(calls)
    parsed = parsed.withColumns(
        {
            "text": F.when(F.col("parse_path") == "failed", F.col("text")),
            "reason": F.coalesce("error", "reason"),
        }
    ).drop("raw", "status", "attempts", "waited", "error")
    return number_chunks(parsed, offsets)


def parse_wave(
    spark: SparkSession, folder: str, settings: str, wave: int, offsets: DataFrame, chunks: DataFrame
) -> StructType:
    """Parse a wave's calls, and add what the report counts to that of the waves before.

    The sums up to a wave lie beside it, so a report after it reads neither
    the waves before nor their replies again.
    """
    marker = f"{folder}/parsed.wave-{wave}"
    schema = _finished(spark, marker, settings)
    if schema is not None:
        return schema
    path = f"{folder}/parsed/wave={wave}"
    own = chunks.filter(F.col("wave") == wave).drop("wave")
    calls = spark.read.parquet(f"{folder}/calls/wave={wave}").select(*KEYS, *OUTCOME)
    built = parsed_calls(own.join(calls, list(KEYS)), offsets)
    observed = Observation(f"wave-{uuid.uuid4().hex}")
    _write(built.observe(observed, *report_counters()), path)
    own = chunks_per_source(result_records(spark.read.schema(built.schema).parquet(path)))
    counts, sources = [observed.get], [own]
    if wave:
        counts.append(counted_in(spark, f"{folder}/parsed.wave-{wave - 1}"))
        sources.append(spark.read.parquet(f"{folder}/sources.upto-{wave - 1}"))
    merged_sources(*sources).write.mode("overwrite").parquet(f"{folder}/sources.upto-{wave}")
    return _finish(spark, marker, settings, built.schema, added_counters(counts))


def progress(spark: SparkSession, folder: str, wave: int) -> tuple[DataFrame, DataFrame]:
    """The report's totals and chunks per source up to a finished wave of a run in ``folder``."""
    marker = spark.read.parquet(f"{folder}/parsed.wave-{wave}.done").first()
    totals = counted_totals(spark, json.loads(marker.settings)["documents"], json.loads(marker.counted))
    return totals, spark.read.parquet(f"{folder}/sources.upto-{wave}")


def run_extraction(
    documents: DataFrame,
    make_client: Callable[[], Callable[[dict], str]],
    folder: str,
    config: X.ModelConfig = X.DEFAULT_CONFIG,
    max_tokens: int = C.DEFAULT_MAX_TOKENS,
    counter: TokenCounter = estimated,
    policy: X.RetryPolicy | None = None,
    sleep: Callable[[float], None] = time.sleep,
    concurrency: int | None = None,
    in_flight: int = 1,
    waves: int = 1,
    recorded: Recorded | None = None,
    generated_at: str | None = None,
) -> Run:
    """Run every stage in ``folder``, which lies in storage all executors share.

    A client gets the whole request: model, messages, temperature and timeout.
    ``config`` chooses it and, without a ``policy``, the retry rules. Chunks
    with an outcome in ``recorded`` are not sent; a function gets the written
    chunks, so that what it looks up by their text need not cut them again.

    Calling it again with the same folder resumes: finished stages and waves
    are reused, and of a wave that was interrupted the calls that ended are on
    record. Other documents or settings than those the folder was begun with
    raise ``StaleFolder``.
    """
    spark = configure(documents.sparkSession)
    documents = schemas.conform(documents, schemas.DOCUMENTS)
    policy = policy or X.policy_for(config)
    chosen = {
        "max_tokens": max_tokens, "waves": waves, "provider": config.provider, "model": config.model,
        "counter": f"{getattr(counter, '__module__', '')}.{getattr(counter, '__qualname__', repr(counter))}",
    }
    settings = settings_of(documents, **chosen)
    chunks = _stage(
        spark, f"{folder}/chunks", settings,
        lambda: chunk_stage(documents, max_tokens, counter, waves), "wave",
    )
    if chunks.isEmpty():
        sinks.require_rows(documents, "documents")
        raise sinks.EmptyStage("no chunks")

    journal = journalled(
        X.request_client(make_client), f"{folder}/journal", policy, sleep, concurrency, in_flight
    )

    def send(todo: DataFrame) -> DataFrame:
        return journal(todo.withColumn("request", F.to_json(X.build_request(F.col("text"), config))))

    offsets = _stage(spark, f"{folder}/offsets", settings, lambda: chunk_offsets(chunks))
    ended = lambda wave: parse_wave(spark, folder, settings, wave, offsets, chunks)
    calls = call_stage(spark, chunks, f"{folder}/calls", settings, send, waves, recorded, ended)
    parsed = spark.read.schema(ended(waves - 1)).parquet(f"{folder}/parsed")
    results = sinks.require_rows(result_records(parsed), "results")
    failures = failed(parsed).select(
        "chunk_id", "doc_seq", "source", "source_type", "chunk_index", "total_chunks", "text", "reason"
    )

    stamp = generated_at or datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    totals, sources = progress(spark, folder, waves - 1)
    report = lambda: report_lines(documents, results, failures, stamp, counted=totals, sources=sources)
    calls = chunks.join(calls.select(*KEYS, *OUTCOME), list(KEYS)).select(*chunks.drop("wave").columns, *OUTCOME, "wave")
    return Run(chunks.drop("wave"), calls, results, failures, totals, report)


def save_run(run: Run, folder: str, run_id: str | None = None, compression: str | None = None) -> dict[str, str]:
    """Publish the JSON, CSV and report of a run together, under run-stamped names.

    A save that was stopped may be repeated; one that ended gives its paths again.
    With a ``compression``, such as ``gzip``, the parts of all files have it.
    """
    run_id = run_id or datetime.now().strftime("%Y%m%d_%H%M%S")
    # the report is sorted, and what it shuffles is gone before the others are written
    outputs = {
        "report": (f"summary_{run_id}.txt", lambda path: sinks.write_report(run.lines, path, compression)),
        "json": (f"results_{run_id}.json", lambda path: sinks.write_json(run.results, path, compression)),
        "csv": (f"results_{run_id}.csv", lambda path: sinks.write_csv(run.results, path, compression)),
    }
    with shuffles_end(run.results.sparkSession):
        return sinks.publish(run.results.sparkSession, folder, run_id, outputs)
