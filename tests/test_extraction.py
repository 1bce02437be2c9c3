import sys

import clients
import pytest
from clients import rule_model
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docsheaf.functions.tokens import estimated
from docsheaf.operators.calls import no_wait as no_sleep
from docsheaf.plans import extraction as E
from docsheaf.session import workspace
from docsheaf.sources.sinks import EmptyStage

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(clients)


def documents(spark):
    rows = [(i, f"s{i % 3}", "file_txt", "word " * (i * 7) + "end.") for i in range(40)]
    rows.append((40, "s0", "file_txt", " \n "))
    return spark.createDataFrame(rows, "doc_seq bigint, source string, source_type string, raw_text string")


def no_calls():
    def call(prompt):
        raise AssertionError("called again")

    return call


@pytest.mark.parametrize("waves", [1, 3])
def test_run_and_resume(spark, tmp_path, waves):
    folder = workspace(spark, "run")
    args = dict(max_tokens=60, sleep=no_sleep, waves=waves, concurrency=4, generated_at="now")
    run = E.run_extraction(documents(spark), rule_model, folder, **args)
    n, ok, bad = run.chunks.count(), run.results.count(), run.failures.count()
    assert ok + bad == n == run.calls.count() and bad > 0
    ids = [r.chunk_id for r in run.results.select("chunk_id").unionAll(run.failures.select("chunk_id")).collect()]
    assert sorted(ids) == list(range(1, n + 1))
    failed_text = {r.text for r in run.failures.collect()}
    assert all(len(t) % 17 == 0 for t in failed_text)
    assert run.failures.filter(F.col("reason") != "bad request").isEmpty()
    assert "Total documents ingested : 41" in run.lines.filter("section_no = 1 and item_no = 0 and line_no = 0").first().line

    paths = E.save_run(run, str(tmp_path / "out"), "r1")
    assert spark.read.json(paths["json"]).count() == ok
    assert set(paths) == {"json", "csv", "report"}

    again = E.run_extraction(documents(spark), no_calls, folder, **args)
    assert again.results.count() == ok


def test_interrupted_waves_are_completed(spark):
    folder = workspace(spark, "run")
    args = dict(max_tokens=60, sleep=no_sleep, waves=3, generated_at="now")

    def breaks(todo):
        raise RuntimeError("interrupted")

    docs = documents(spark)
    settings = "s"
    chunks = E.chunk_stage(docs, 60, estimated, 3).cache()
    assert {r.wave for r in chunks.select("wave").distinct().collect()} == {0, 1, 2}
    send = lambda todo: todo.select("*", F.lit("{}").alias("raw"))
    sent = []

    def first_two(todo):
        if len(sent) == 2:
            breaks(todo)
        sent.append(todo.count())
        return send(todo)

    with pytest.raises(RuntimeError):
        E.call_stage(spark, chunks, f"{folder}/calls", settings, first_two, 3)
    calls = E.call_stage(spark, chunks, f"{folder}/calls", settings, send, 3)
    assert calls.count() == chunks.count() == calls.select(*E.KEYS).distinct().count()
    assert calls.count() > sum(sent)
    assert E.run_extraction(docs, rule_model, workspace(spark, "run"), **args).calls.count() == chunks.count()


def test_other_settings_or_documents_are_refused(spark):
    folder, docs = workspace(spark, "run"), documents(spark)
    args = dict(sleep=no_sleep, generated_at="now")
    E.run_extraction(docs, rule_model, folder, max_tokens=60, **args)
    for other in ({"max_tokens": 20}, {"max_tokens": 60, "waves": 2}):
        with pytest.raises(E.StaleFolder):
            E.run_extraction(docs, rule_model, folder, **other, **args)
    with pytest.raises(E.StaleFolder):
        E.run_extraction(docs.filter("doc_seq > 3"), rule_model, folder, max_tokens=60, **args)


def test_recorded_outcomes_are_not_sent(spark):
    docs = documents(spark)
    recorded = spark.createDataFrame(
        [(d, 0, "{}" if d % 2 else None, None if d % 2 else "lost") for d in range(10)],
        "doc_seq bigint, chunk_index int, raw string, error string",
    )
    run = E.run_extraction(
        docs, rule_model, workspace(spark, "run"), max_tokens=800, sleep=no_sleep, recorded=recorded, generated_at="now"
    )
    calls = {r.doc_seq: (r.attempts, r.raw, r.error) for r in run.calls.collect()}
    assert [calls[d][0] for d in range(12)] == [0] * 10 + [1, 1]
    assert calls[3][1] == "{}" and calls[4][2] == "lost"


def test_stop_on_empty(spark):
    docs = documents(spark)
    for rows, what in ((docs.limit(0), "documents"), (docs.filter("doc_seq = 40"), "chunks")):
        with pytest.raises(EmptyStage, match=what):
            E.run_extraction(rows, rule_model, workspace(spark, "run"), sleep=no_sleep)
    with pytest.raises(EmptyStage, match="results"):
        E.run_extraction(docs, no_calls, workspace(spark, "run"), sleep=no_sleep)


def test_totals_are_counted_while_the_stage_is_written(spark, tmp_path):
    from docsheaf.operators import report as R

    folder = workspace(spark, "run")
    args = dict(max_tokens=60, sleep=no_sleep, generated_at="now")
    run = E.run_extraction(documents(spark), rule_model, folder, **args)
    whole = R.totals(documents(spark), run.results, run.failures).first().asDict()
    found = run.totals.first().asDict()
    assert abs(found.pop("mean_confidence") - whole.pop("mean_confidence")) < 1e-9
    assert found == whole and list(found) == list(whole)
    # a resumed run has them from the marker
    again = E.run_extraction(documents(spark), no_calls, folder, **args)
    assert again.totals.first() == run.totals.first()
    lines = again.lines._jdf.queryExecution().analyzed().toString()
    assert "raw_text" not in lines


def test_tasks_that_are_tried_again_count_once(spark, tmp_path):
    from pyspark.sql import functions as F

    mark = tmp_path / "failed-once"

    def fails_once(parts):
        import os

        from pyspark import TaskContext

        if TaskContext.get().partitionId() == 1 and not os.path.exists(mark):
            open(mark, "w").close()
            # the rows are written, then the task is lost
            yield from parts
            raise RuntimeError("lost")
        yield from parts

    rows = spark.range(0, 1000, 1, 4).mapInArrow(fails_once, "id bigint")
    counters = [F.count("*").alias("n"), F.sum("id").alias("sum")]
    path = workspace(spark, "stage")
    if spark.sparkContext.master.startswith("local[") and "," not in spark.sparkContext.master:
        # one machine does not try a task again: the whole stage is
        with pytest.raises(Exception, match="lost"):
            E._stage(spark, path, "s", lambda: rows, counters=counters)
    assert E._stage(spark, path, "s", lambda: rows, counters=counters).count() == 1000
    assert E.counted_in(spark, path) == {"n": 1000, "sum": 499500}


def test_report_parts_are_kept_per_wave(spark):
    from docsheaf.operators import report as R

    folder, n = workspace(spark, "run"), 4
    args = dict(max_tokens=60, sleep=no_sleep, waves=n, generated_at="now")
    run = E.run_extraction(documents(spark), rule_model, folder, **args)
    waves = {r.doc_seq: r.wave for r in spark.read.parquet(f"{folder}/chunks").select("doc_seq", "wave").collect()}
    parsed = spark.read.parquet(f"{folder}/parsed")
    for wave in range(n):
        totals, sources = E.progress(spark, folder, wave)
        upto = parsed.filter(F.col("wave") <= wave)
        results, failures = E.result_records(upto), E.failed(upto)
        whole = R.totals(documents(spark), results, failures).first().asDict()
        found = totals.first().asDict()
        assert abs(found.pop("mean_confidence") - whole.pop("mean_confidence")) < 1e-9 and found == whole
        recount = R.chunks_per_source(results)
        assert sorted(map(tuple, sources.collect())) == sorted(map(tuple, recount.collect()))
    assert set(waves.values()) == set(range(n))
    lines = R.report_lines(documents(spark), run.results, run.failures, "now")
    key = lambda r: tuple(r)
    assert sorted(run.lines.collect(), key=key) == sorted(lines.collect(), key=key)


def test_an_interrupted_wave_is_counted_once(spark, monkeypatch):
    folder = workspace(spark, "run")
    args = dict(max_tokens=60, sleep=no_sleep, waves=3, generated_at="now")
    real, calls = E.merged_sources, []

    def breaks(*parts):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("interrupted")
        return real(*parts)

    monkeypatch.setattr(E, "merged_sources", breaks)
    with pytest.raises(RuntimeError):
        E.run_extraction(documents(spark), rule_model, folder, **args)
    monkeypatch.undo()
    run = E.run_extraction(documents(spark), rule_model, folder, **args)
    assert run.totals.first().succeeded == run.results.count() and run.totals.first().failed == run.failures.count()


def test_known_outcomes_are_looked_up_for_written_chunks(spark):
    from docsheaf.plans import inputs
    from docsheaf.plans.registry import no_client

    rows = [(k, f"s{k % 3}", "file_txt", f"Anna met Bo {'again ' * (k % 9)}in Rome.\n\n" * (k % 5 + 1)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_seq bigint, source string, source_type string, raw_text string")
    seen, found = [], []

    def known(chunks):
        seen.append(set(chunks.columns))
        return inputs.replies_to(chunks)

    for recorded in (inputs.recorded_replies(docs, 20), known):
        run = E.run_extraction(docs, no_client, workspace(spark, "run"), max_tokens=20, waves=2, recorded=recorded)
        found.append([sorted(map(str, df.collect())) for df in (run.calls, run.results, run.failures)])
    assert found[0] == found[1] and found[0][1]
    # of the chunks as written, not as cut again
    assert len(seen) == 1 and "wave" in seen[0]


def test_texts_and_replies_are_kept_once(spark, tmp_path):
    from docsheaf.plans import inputs
    from docsheaf.plans.registry import no_client
    from docsheaf.session import exists

    folder = workspace(spark, "run")
    args = dict(max_tokens=60, waves=2, recorded=inputs.replies_to, generated_at="now")
    run = E.run_extraction(documents(spark), no_client, folder, **args)
    # calls have the text of their chunks by number alone, and what was given for them is gone
    assert "text" not in spark.read.parquet(f"{folder}/calls").columns
    assert run.calls.filter("text is not null").count() == run.chunks.count() > 0
    assert not any(exists(spark, f"{folder}/calls.recorded/wave={wave}") for wave in range(2))
    again = E.run_extraction(documents(spark), no_client, folder, **args)
    assert sorted(map(str, again.calls.collect())) == sorted(map(str, run.calls.collect()))
    # packed files hold the same
    plain = E.save_run(run, str(tmp_path / "plain"), "r1")
    packed = E.save_run(run, str(tmp_path / "packed"), "r1", compression="gzip")
    for name, read in (("json", spark.read.json), ("report", spark.read.text)):
        assert sorted(map(str, read(plain[name]).collect())) == sorted(map(str, read(packed[name]).collect()))
    size = lambda path: sum(f.stat().st_size for f in tmp_path.glob(f"{path}/**/part-*"))
    assert size("packed") < size("plain")
