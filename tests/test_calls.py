import sys
import time

import keyed
import pytest
from keyed import keyed_client
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docsheaf import constants as C
from docsheaf.operators import calls as X
from docsheaf.operators.calls import no_wait as no_sleep
from docsheaf.sources import captures

cloudpickle.register_pickle_by_value(keyed)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def outcomes(policy, client, text):
    waits = []
    row = X.attempt_call(client, text, policy, waits.append)
    return row, waits


@pytest.mark.parametrize(
    "key, policy, expected, waits",
    [
        (0, X.MODEL_POLICY, ("reply of 3", "success", 1, 0.0, None), []),
        (1, X.MODEL_POLICY, ("reply of 3", "success", 3, 4.0, None), [2, 2]),
        (2, X.MODEL_POLICY, (None, "failed", 4, 8.0, "request timeout"), [2, 2, 4]),
        (3, X.MODEL_POLICY, (None, "failed", 1, 0.0, "bad request"), []),
        (1, X.FETCH_POLICY, ("reply of 3", "success", 3, 6.0, None), [2, 4]),
        (2, X.FETCH_POLICY, (None, "failed", 3, 6.0, "request timeout"), [2, 4]),
        # any HTTP error status of a fetch is tried again
        (3, X.FETCH_POLICY, (None, "failed", 3, 6.0, "bad request"), [2, 4]),
    ],
)
def test_policies(key, policy, expected, waits):
    assert outcomes(policy, keyed_client(), f"{key}\nx") == (expected, waits)


def test_waits_are_bounded():
    assert [X.MODEL_POLICY.wait(n) for n in range(1, 8)] == [2, 2, 4, 8, 16, 30, 30]


def test_unexpected_errors_are_final_and_become_data():
    def broken(text):
        raise KeyError("oops")

    for policy in (X.MODEL_POLICY, X.FETCH_POLICY):
        row, waits = outcomes(policy, broken, "t")
        assert row[1:3] == ("failed", 1) and waits == []


def test_retry_rules():
    assert X.retry_by_type(X.CallError("x", "status", 500))
    assert not X.retry_by_type(X.CallError("x", "status", 404))
    assert not X.retry_by_type(X.CallError("x"))
    assert X.retry_by_message(Exception("HTTP 429")) and X.retry_by_message(Exception("Quota"))
    assert X.retry_by_message(Exception("could not generate"))
    assert not X.retry_by_message(Exception("unavailable"))
    assert X.retry_fetch(X.CallError("x", "status", 404)) and X.retry_fetch(X.CallError("x", "connection"))


def test_call_rows_keeps_columns_and_spreads(spark):
    df = spark.range(40).select("id", F.concat("id", F.lit("\nx")).alias("t"))
    out = X.call_rows(df, "t", keyed_client, X.MODEL_POLICY, no_sleep, ("id",), concurrency=5)
    assert out.columns == ["id", "t", "raw", "status", "attempts", "waited", "error"]
    assert out.rdd.getNumPartitions() == 5
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 40
    for key, row in rows.items():
        assert row.status == ("success" if key % 4 < 2 else "failed")
        assert row.attempts == [1, 3, 4, 1][key % 4]
    done = out.filter("status = 'success'")
    assert {r.id % 4 for r in X.pending(df, done, "id").collect()} == {2, 3}


def test_rate_cap(spark):
    policy = X.RetryPolicy(1, 1, 0, 1, X.retry_by_type, calls_per_second=50)
    df = spark.range(1).select(F.lit("0\nx").alias("t"))
    assert X.call_rows(df, "t", keyed_client, policy).first().status == "success"


def test_classify_log(spark):
    rows = [(200, "ok"), (429, "rate limit"), (503, "unavailable"), (None, "Request Timeout"),
            (400, "bad request"), (400, "could not generate"), (None, "connection reset")]
    log = X.classify_log(spark.createDataFrame(rows, "status_code int, message string"))
    assert [(r.typed_class, r.message_class) for r in log.collect()] == [
        ("success", "success"), ("retry", "retry"), ("retry", "fatal"), ("retry", "retry"),
        ("fatal", "fatal"), ("fatal", "retry"), ("fatal", "fatal"),
    ]


def test_model_config():
    assert X.model_config({"OPENAI_API_KEY": "k"}) == X.ModelConfig("openai", "gpt-4o-mini", "OPENAI_API_KEY")
    groq = X.model_config({"LLM_PROVIDER": "GROQ", "GROQ_API_KEY": "k", "GROQ_MODEL": "m"})
    assert (groq.provider, groq.model) == ("groq", "m")
    with pytest.raises(OSError):
        X.model_config({"LLM_PROVIDER": "gemini"})
    with pytest.raises(ValueError):
        X.model_config({"LLM_PROVIDER": "other"})


def test_requests(spark):
    df = spark.createDataFrame([("body",)], "t string")
    for provider, roles, timeout in (("openai", ["system", "user"], 45), ("gemini", ["user"], None)):
        config = X.ModelConfig(provider, "m", "K")
        request = df.select(X.build_request(df.t, config).alias("r")).first().r
        assert [m.role for m in request.messages] == roles
        assert (request.model, request.temperature, request.timeout) == ("m", 0.1, timeout)
        assert request.messages[-1].content.endswith(
            f"\n\n{C.TEXT_START_MARKER}\nbody\n{C.TEXT_END_MARKER}"
        )


def test_fetch_pages(spark):
    def make_transport():
        def get(url, timeout, headers):
            assert timeout == 15 and headers["User-Agent"]
            if url.endswith("/gone"):
                raise X.CallError("HTTP 404", "status", 404)
            kind = None if url.endswith("/none") else "text/html"
            return kind, "" if url.endswith("/blank") else "<p>a</p><p>b</p>"

        return get

    urls = spark.createDataFrame([(i, f"http://h/{p}") for i, p in enumerate(["ok", "gone", "none", "blank"])], "position bigint, source string")
    fetched = captures.fetch_pages(urls, make_transport, sleep=no_sleep).cache()
    ok = fetched.filter("status = 'success'")
    docs = {r.source: r.raw_text for r in captures.read_captures(ok, "position").collect()}
    assert docs == {"http://h/ok": "a\nb", "http://h/none": "<p>a</p><p>b</p>"}
    rejects = captures.failed_fetches(fetched).unionAll(captures.blank_captures(ok)).collect()
    assert {tuple(r) for r in rejects} == {
        ("http://h/gone", "fetch", "HTTP 404"), ("http://h/blank", "ingest", "empty content"),
    }


def test_calls_in_flight_keep_order_and_rate(spark):
    import threading

    def make_client():
        name = threading.get_ident()

        def call(text):
            time.sleep(0.05)
            return f"{text}:{name}"

        return call

    df = spark.range(24, numPartitions=1).select("id", F.col("id").cast("string").alias("t"))
    policy = X.RetryPolicy(1, 1, 0, 1, X.retry_by_type, calls_per_second=100)
    rows = X.call_rows(df, "t", make_client, policy, in_flight=6).collect()
    assert [r.raw.split(":")[0] for r in rows] == [str(r.id) for r in rows]
    assert 1 < len({r.raw.split(":")[1] for r in rows}) <= 6
    waits = []
    pace = X.Pace(10, waits.append)
    for _ in range(4):
        pace.wait()
    assert [round(w, 1) for w in waits] == [0.1, 0.2, 0.3]


def test_policy_of_a_provider():
    assert X.policy_for(X.ModelConfig("openai", "m", "K")).retriable is X.retry_by_type
    assert X.policy_for(X.ModelConfig("gemini", "m", "K")).retriable is X.retry_by_message


def test_replayed_answers():
    import json

    answers = [{"kind": "rate_limit", "status_code": 429, "reply": "slow"}, {"kind": "ok", "reply": "fine"}]
    call = X.replay_client()
    for key in (1, 1, 2):
        text = json.dumps({"id": key, "answers": answers})
        assert outcomes(X.MODEL_POLICY, call, text) == (("fine", "success", 2, 2.0, None), [2])
    lasting = json.dumps({"id": 3, "answers": [{"kind": "timeout", "reply": "late"}]})
    assert outcomes(X.MODEL_POLICY, call, lasting) == ((None, "failed", 4, 8.0, "late"), [2, 2, 4])


def test_requests_come_in_batches_by_bytes(spark):
    from docsheaf import session

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    df = spark.range(0, 3000, 1, 1).select(F.concat(F.lit("0\n"), F.repeat(F.lit("x"), 8000)).alias("t"))

    def client():
        return lambda text: str(len(text))

    def sized(batches):
        for batch in batches:
            yield batch.assign(n=int(batch["t"].str.len().sum()))

    try:
        out = X.call_rows(df, "t", client, X.MODEL_POLICY, no_sleep)
        assert out.agg(F.min("raw"), F.max("raw"), F.count("*")).first() == ("8002", "8002", 3000)
        most = df.mapInPandas(sized, "t string, n bigint").agg(F.max("n")).first()[0]
        assert most <= session.ARROW_BYTES + 8002
    finally:
        spark.conf.unset(key)
        session.configure(spark)
