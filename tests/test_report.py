import pytest
from pyspark.sql import functions as F

from docsheaf import schemas
from docsheaf.functions.numbers import two_decimals, whole_percent
from docsheaf.operators import report as R
from docsheaf.operators.results import FLAT_COLUMNS, flat_rows
from docsheaf.sources import sinks


def result(i, source, people=(), places=(), orgs=(), label="neutral", conf=0.5, summary="S", error=None):
    return (i, source, 0, "pre", summary, (list(people), list(places), list(orgs)), (label, conf), ["a", "b", "c"], error)


@pytest.fixture
def results(spark):
    rows = [
        result(1, "b", ["X", "X", "Y"], label="positive", conf=0.125),
        result(3, "a", ["Z", "Y", "W", "V", "U"], orgs=["O"], conf=1.0, summary='say "hi", é\nline'),
        result(4, "b", ["y"], label="positive", conf=0.0, error=True),
    ]
    return spark.createDataFrame(rows, schemas.RESULTS)


@pytest.fixture
def failures(spark):
    return spark.createDataFrame([(2, "b", 1, 3)], "chunk_id bigint, source string, chunk_index int, total_chunks int")


def test_two_decimals_is_pythons(spark):
    values = [k / 1000 for k in range(1001)] + [0.155, 0.145, 0.285, 1 / 3, 0.57, 0.999, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = [r[0] for r in df.select(two_decimals(df.v)).collect()]
    assert out == [f"{v:.2f}" for v in values]


def test_whole_percent_is_pythons(spark):
    values = [100 * n / d for d in range(1, 41) for n in range(d + 1)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(whole_percent(df.v)).collect()] == [f"{v:.0f}%" for v in values]


def test_top_entities(results):
    rows = R.top_entities(results).orderBy("kind_no", "rank").collect()
    # ties in order of first appearance; "y" is another name, and sixth
    assert [(r.kind_no, r.name, r.mentions) for r in rows] == [
        (0, "X", 2), (0, "Y", 2), (0, "Z", 1), (0, "W", 1), (0, "V", 1), (2, "O", 1),
    ]


def test_top_entities_are_cut_before_the_shuffle(results):
    plan = R.top_entities(results)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


EXPECTED = """\
======================================================================
  TITLE
  Generated: now
======================================================================

OVERVIEW
----------------------------------------
  Total documents ingested : 7
  Total chunks processed   : 4
  Successful extractions   : 3
  Failed / skipped chunks  : 1

SOURCES
----------------------------------------
  • b  (2 chunk(s))
  • a  (1 chunk(s))

SENTIMENT DISTRIBUTION
----------------------------------------
  Positive :   2  (67%)
  Neutral  :   1  (33%)
  Negative :   0  (0%)

  Average sentiment confidence: 0.38

TOP ENTITIES
----------------------------------------
  People:
    - X (2x)
    - Y (2x)
    - Z (1x)
    - W (1x)
    - V (1x)
  Places:
    (none found)
  Organizations:
    - O (1x)

CHUNK SUMMARIES
----------------------------------------

  [Chunk 1]  b  (part 1)
  Sentiment : positive (conf: 0.12)
  Summary   : S
  Key Questions:
    ? a
    ? b
    ? c

  [Chunk 3]  a  (part 1)
  Sentiment : neutral (conf: 1.00)
  Summary   : say "hi", é
line
  Key Questions:
    ? a
    ? b
    ? c

  [Chunk 4]  b  (part 1)
  Sentiment : positive (conf: 0.00)
  Summary   : S
  Key Questions:
    ? a
    ? b
    ? c

FAILED / SKIPPED CHUNKS
----------------------------------------
  - Source: b  Part 2/3

======================================================================
END OF REPORT
======================================================================
"""


def read_report(path):
    return "".join(p.read_text(encoding="utf8") for p in sorted(path.glob("part-*")))


def test_report_text(spark, results, failures, tmp_path):
    lines = R.report_lines(spark.range(7), results, failures, "now", "TITLE")
    path = tmp_path / "report"
    sinks.write_report(lines, str(path))
    assert read_report(path) == EXPECTED
    # without failures their section is gone
    lines = R.report_lines(spark.range(7), results, failures.limit(0), "now", "TITLE")
    assert lines.filter(F.col("section_no") == R.SECTION_FAILED).isEmpty()


def test_report_of_nothing(spark, results, failures):
    none = results.limit(0)
    assert R.sentiment_summary(none).first().mean_confidence == 0.0
    assert [r.percent for r in R.sentiment_distribution(none).collect()] == [0.0, 0.0, 0.0]
    lines = R.report_lines(spark.range(0), none, failures, "now")
    assert lines.filter(F.col("line") == "    (none found)").count() == 3


def test_flat_rows_and_sinks(spark, results, tmp_path):
    flat = flat_rows(results)
    assert tuple(flat.columns) == FLAT_COLUMNS
    expected = sorted(map(tuple, flat.collect()))
    assert expected[1][5:8] == ("Z; Y; W; V; U", "", "O") and expected[2][-1] is True
    sinks.write_csv(results, str(tmp_path / "csv"))
    assert sorted(map(tuple, sinks.read_csv(spark, str(tmp_path / "csv"), flat.schema).collect())) == expected
    raw = "".join(p.read_text(encoding="utf8") for p in (tmp_path / "csv").glob("part-*"))
    assert raw.startswith(",".join(FLAT_COLUMNS)) and '"say ""hi"", é\nline"' in raw
    sinks.write_json(results, str(tmp_path / "json"))
    text = "".join(p.read_text(encoding="utf8") for p in (tmp_path / "json").glob("part-*"))
    assert text.count("parse_error") == 1 and "é" in text
    back = spark.read.schema(results.schema).json(str(tmp_path / "json"))
    assert sorted(map(tuple, flat_rows(back).collect())) == expected
