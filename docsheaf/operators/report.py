"""Report aggregations and the report as lines of text.

Every aggregate combines before its shuffle, so one source, label or name that
holds a third of all rows is no hot group. The report is a table of lines with
an order; only the chunk summaries grow with the data.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsheaf import constants as C
from docsheaf.functions.numbers import two_decimals, whole_percent
from docsheaf.operators.top_names import candidate_counts

KINDS = C.ENTITY_HEADINGS
POSITION_BITS = 20


# --- aggregations -------------------------------------------------------------------


def overview(documents: DataFrame, results: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: documents, chunks processed, succeeded, failed."""

    def tagged(df, tag):
        return df.select(F.lit(tag).alias("tag"))

    rows = tagged(documents, "document").unionAll(tagged(results, "ok")).unionAll(
        tagged(failures, "failed")
    )
    return rows.agg(
        F.count_if(F.col("tag") == "document").alias("documents"),
        F.count_if(F.col("tag") != "document").alias("chunks"),
        F.count_if(F.col("tag") == "ok").alias("succeeded"),
        F.count_if(F.col("tag") == "failed").alias("failed"),
    )


def totals(documents: DataFrame, results: DataFrame, failures: DataFrame) -> DataFrame:
    """One row with all that the report counts over whole tables, each read once."""
    names = [kind for kind, _ in KINDS]
    none = [F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("confidence")]
    none += [F.lit(False).alias(kind) for kind in names]
    found = [F.size(f"entities.{kind}") > 0 for kind in names]
    rows = (
        documents.select(F.lit("document").alias("tag"), *none)
        .unionAll(results.select(F.lit("ok"), "sentiment.label", "sentiment.confidence", *found))
        .unionAll(failures.select(F.lit("failed"), *none))
    )
    tag = F.col("tag")
    return rows.agg(
        F.count_if(tag == "document").alias("documents"),
        F.count_if(tag != "document").alias("chunks"),
        F.count_if(tag == "ok").alias("succeeded"),
        F.count_if(tag == "failed").alias("failed"),
        F.count_if(tag == "ok").alias("total"),
        F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("mean_confidence"),
        *[F.count_if(F.col("label") == name).alias(name) for name in C.LABELS],
        *[F.count_if(F.col(kind)).alias(f"with_{kind}") for kind in names],
    )


def chunks_per_source(results: DataFrame) -> DataFrame:
    return results.groupBy("source").agg(
        F.count("*").alias("chunks"), F.min("chunk_id").alias("first_chunk")
    )


def sentiment_summary(results: DataFrame) -> DataFrame:
    """One row: total, the mean confidence and the count of each label."""
    label = F.col("sentiment.label")
    return results.agg(
        F.count("*").alias("total"),
        F.coalesce(F.avg("sentiment.confidence"), F.lit(0.0)).alias("mean_confidence"),
        *[F.count_if(label == name).alias(name) for name in C.LABELS],
    )


def sentiment_distribution(results: DataFrame) -> DataFrame:
    """Always one row per label: position, label, count, percent."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("label"), F.col(n).alias("chunks"))
        for i, n in enumerate(C.LABELS)
    ]
    total = F.greatest("total", F.lit(1))
    return (
        sentiment_summary(results)
        .select("total", F.inline(F.array(*rows)))
        .select(
            "position",
            "label",
            "chunks",
            ((F.col("chunks") * 100).cast("double") / total.cast("double")).alias("percent"),
        )
    )


def mentions(results: DataFrame) -> DataFrame:
    """``(grp, name, place)`` of every name in every result.

    Chunk and position are one number, so that the aggregate can hash: a chunk
    has fewer than 2**20 names, and there are fewer than 2**43 chunks.
    """

    def mentions_of(kind_no: int, kind: str) -> Column:
        def mention(name, position):
            return F.struct(F.lit(kind_no).alias("grp"), name.alias("name"), position.alias("position"))

        return F.transform(f"entities.{kind}", mention)

    every = F.concat(*[mentions_of(k, kind) for k, (kind, _) in enumerate(KINDS)])
    place = F.shiftleft(F.col("chunk_id").cast("bigint"), POSITION_BITS).bitwiseOR(F.col("position").cast("bigint"))
    return results.select("chunk_id", F.inline(every)).select("grp", "name", place.alias("place"))


def top_entities(results: DataFrame, n: int = C.TOP_ENTITIES) -> DataFrame:
    """The most frequent names of each kind; ties go to the one seen first.

    Names that cannot be among the first ``n`` are not shuffled, and Spark keeps
    only the best ``n`` per kind in every task before the last shuffle.
    """
    counts = candidate_counts(mentions(results), n)
    order = Window.partitionBy("grp").orderBy(F.desc("n"), "place")
    first = F.struct(
        F.shiftright("place", POSITION_BITS).alias("chunk_id"),
        F.col("place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("position"),
    )
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select(F.col("grp").alias("kind_no"), "rank", "name", F.col("n").alias("mentions"), first.alias("first_seen"))
    )


# --- counted while a stage is written --------------------------------------------------


def counters() -> list[Column]:
    """What the report counts over all parsed calls, to be observed while they are written."""
    ok = F.col("parse_path") != "failed"
    return [
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        F.sum(F.when(ok, F.col("sentiment.confidence"))).alias("confidence"),
        *[F.count_if(ok & (F.col("sentiment.label") == name)).alias(name) for name in C.LABELS],
        *[F.count_if(ok & (F.size(f"entities.{kind}") > 0)).alias(f"with_{kind}") for kind, _ in KINDS],
    ]


def added_counters(counts: list[dict]) -> dict:
    """The counters of several parts as one."""
    return {name: sum(c[name] or 0 for c in counts) for name in counts[0]}


def merged_sources(*parts: DataFrame) -> DataFrame:
    """``chunks_per_source`` of several parts as one."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("source").agg(F.sum("chunks").alias("chunks"), F.min("first_chunk").alias("first_chunk"))


def counted_totals(spark, documents: int, counted: dict) -> DataFrame:
    """The row of ``totals`` from counters that were observed."""
    n = counted["succeeded"]
    row = {
        "documents": documents, "chunks": n + counted["failed"], "succeeded": n, "failed": counted["failed"], "total": n,
        "mean_confidence": (counted["confidence"] or 0.0) / n if n else 0.0,
        **{name: counted[name] for name in C.LABELS},
        **{f"with_{kind}": counted[f"with_{kind}"] for kind, _ in KINDS},
    }
    types = ", ".join(f"{name} {'double' if name == 'mean_confidence' else 'bigint'}" for name in row)
    return spark.createDataFrame([tuple(row.values())], types)


# --- lines ----------------------------------------------------------------------------

SECTION_OVERVIEW, SECTION_SOURCES, SECTION_SENTIMENT = 1, 2, 3
SECTION_ENTITIES, SECTION_CHUNKS, SECTION_FAILED, SECTION_END = 4, 5, 6, 7
# an item_no beyond every chunk number, for lines that close a section
LAST_ITEM = 2**62


def _lines(df: DataFrame, section: int, item: Column, lines: Column) -> DataFrame:
    """Rows ``(section_no, item_no, line_no, line)`` from an array of lines per row."""
    return df.select(
        F.lit(section).alias("section_no"),
        item.cast("bigint").alias("item_no"),
        F.posexplode(lines).alias("line_no", "line"),
    )


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _number(value: Column, width: int = 0) -> Column:
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(" "))


def _fixed_lines(spark, rows) -> DataFrame:
    """The headings, which are the same for all data."""
    return spark.createDataFrame(
        rows, "section_no int, item_no bigint, line_no int, line string"
    )


def report_lines(
    documents: DataFrame,
    results: DataFrame,
    failures: DataFrame,
    generated_at: str,
    title: str = "DOCUMENT EXTRACTION — SUMMARY REPORT",
    counted: DataFrame | None = None,
    sources: DataFrame | None = None,
) -> DataFrame:
    """``(section_no, item_no, line_no, line)``; sorted by these it is the report.

    ``counted`` is the row of ``totals``, ``sources`` the ``chunks_per_source``,
    where they are known already.
    """
    rule, banner = "-" * C.RULE_WIDTH, "=" * C.BANNER_WIDTH
    opening = [banner, f"  {title}", f"{C.GENERATED_LINE}{generated_at}", banner, ""]
    headings = {
        SECTION_OVERVIEW: [C.OVERVIEW_HEADING, rule],
        SECTION_SOURCES: [C.SOURCES_HEADING, rule],
        SECTION_SENTIMENT: [C.SENTIMENT_HEADING, rule],
        SECTION_ENTITIES: [C.ENTITIES_HEADING, rule],
        SECTION_CHUNKS: [C.CHUNKS_HEADING, rule],
    }
    fixed = [(0, 0, i, line) for i, line in enumerate(opening)]
    for section, lines in headings.items():
        fixed += [(section, -1, i, line) for i, line in enumerate(lines)]
        fixed += [(section, LAST_ITEM, 0, "")]
    fixed += [(SECTION_END, 0, i, s) for i, s in enumerate([banner, C.CLOSING_LINE, banner])]

    sections = [
        _fixed_lines(results.sparkSession, fixed),
        _total_lines(totals(documents, results, failures) if counted is None else counted, rule),
        _source_lines(chunks_per_source(results) if sources is None else sources),
        _entity_lines(results),
        _chunk_lines(results),
        _failure_lines(failures),
    ]
    lines = sections[0]
    for section in sections[1:]:
        lines = lines.unionByName(section)
    return lines


def _total_lines(row: DataFrame, rule: str) -> DataFrame:
    """All lines that follow from the totals: overview, sentiment, kinds without
    names, and heading and end of the failure listing if there are failures."""

    def lines(section, item, texts, first=0, when=None):
        made = F.array(
            *[
                F.struct(
                    F.lit(section).alias("section_no"), F.lit(item).cast("bigint").alias("item_no"),
                    F.lit(first + k).alias("line_no"), text.alias("line"),
                )
                for k, text in enumerate(texts)
            ]
        )
        return made if when is None else F.when(when, made).otherwise(F.filter(made, lambda _: F.lit(False)))

    total = F.greatest("total", F.lit(1)).cast("double")

    def percent(name, words):
        share = (F.col(name) * 100).cast("double") / total
        return _text(words, _number(F.col(name), 3), "  (", whole_percent(share), ")")

    overview_lines = [_text(words, _number(F.col(name))) for name, words in C.OVERVIEW_LINES]
    mean = _text(C.CONFIDENCE_LINE, two_decimals(F.col("mean_confidence")))
    failed = F.col("failed") > 0
    parts = [
        lines(SECTION_OVERVIEW, 0, overview_lines),
        lines(SECTION_SENTIMENT, 0, [*[percent(*entry) for entry in C.SENTIMENT_LINES], F.lit(""), mean]),
        *[
            lines(SECTION_ENTITIES, k, [F.lit(C.NO_ENTITY_LINE)], 1, F.col(f"with_{kind}") == 0)
            for k, (kind, _) in enumerate(KINDS)
        ],
        lines(SECTION_FAILED, -1, [F.lit(C.FAILED_HEADING), F.lit(rule)], when=failed),
        lines(SECTION_FAILED, LAST_ITEM, [F.lit("")], when=failed),
    ]
    return row.select(F.inline(F.concat(*parts)))


def _source_lines(sources) -> DataFrame:
    line = F.format_string(C.SOURCE_LINE, F.col("source"), _number(F.col("chunks")))
    return _lines(sources, SECTION_SOURCES, F.col("first_chunk"), F.array(line))


def _entity_lines(results) -> DataFrame:
    """A heading per kind, then its names."""
    headings = _fixed_lines(
        results.sparkSession,
        [(SECTION_ENTITIES, k, 0, heading) for k, (_, heading) in enumerate(KINDS)],
    )
    # at most n rows per kind reach this point
    top = top_entities(results).select(
        F.lit(SECTION_ENTITIES).alias("section_no"),
        F.col("kind_no").cast("bigint").alias("item_no"),
        F.col("rank").alias("line_no"),
        F.format_string(C.ENTITY_LINE, F.col("name"), _number(F.col("mentions"))).alias("line"),
    )
    return headings.unionByName(top)


def _chunk_lines(results) -> DataFrame:
    head = [
        F.lit(""),
        F.format_string(
            C.CHUNK_LINE, _number(F.col("chunk_id")), F.col("source"),
            _number(F.col("chunk_index") + 1),
        ),
        F.format_string(
            C.CHUNK_SENTIMENT_LINE, F.col("sentiment.label"),
            two_decimals(F.col("sentiment.confidence")),
        ),
        _text(C.CHUNK_SUMMARY_LINE, F.col("summary")),
    ]
    questions = F.transform("key_questions", lambda q: _text(C.QUESTION_LINE, q))
    listed = F.when(
        F.size("key_questions") > 0, F.concat(F.array(F.lit(C.QUESTIONS_LINE)), questions)
    ).otherwise(questions)
    return _lines(results, SECTION_CHUNKS, F.col("chunk_id"), F.concat(F.array(*head), listed))


def _failure_lines(failures) -> DataFrame:
    line = F.format_string(
        C.FAILED_LINE, F.col("source"), _number(F.col("chunk_index") + 1),
        _number(F.col("total_chunks")),
    )
    return _lines(failures, SECTION_FAILED, F.col("chunk_id"), F.array(line))
