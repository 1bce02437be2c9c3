"""Governed external calls over rows: page fetches and model requests.

The caller supplies the transport as ``make_client``, a function that runs on
an executor and returns ``call(text) -> str``. A failed call raises
``CallError``. Every row ends with an outcome as data; nothing stops the job.

Calls cost money and may answer differently each time, so the outcome must be
written once and read back; see ``plans.extraction``. Leave speculation off.
"""

import json
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsheaf import constants as C
from docsheaf import schemas
from docsheaf.session import small_batches

SUCCESS, FAILURE = "success", "failed"


class CallError(Exception):
    """A failed call. ``kind``: rate_limit, timeout, connection, status or other."""

    def __init__(self, message: str, kind: str = "other", status_code: int | None = None):
        super().__init__(message)
        self.kind = kind
        self.status_code = status_code


# --- which errors deserve another attempt ------------------------------------------


def retry_by_type(error: Exception) -> bool:
    """Rate limits, timeouts and server errors."""
    kind, status = getattr(error, "kind", None), getattr(error, "status_code", None)
    return kind in ("rate_limit", "timeout") or (status or 0) >= 500


def retry_by_message(error: Exception) -> bool:
    """For clients without typed errors. "rate" also matches inside other words."""
    message = str(error).lower()
    return any(sign in message for sign in ("429", "quota", "rate", "timeout"))


def retry_fetch(error: Exception) -> bool:
    """Timeouts, connection errors and any HTTP error status."""
    return getattr(error, "kind", None) in ("timeout", "connection", "status", "rate_limit")


def retry_by_type_column(status_code: Column, message: Column) -> Column:
    """``retry_by_type`` over a recorded call log; a timeout has no status."""
    timeout = status_code.isNull() & F.contains(F.lower(message), F.lit("timeout"))
    return F.coalesce(timeout | (status_code == 429) | (status_code >= 500), F.lit(False))


def retry_by_message_column(message: Column) -> Column:
    return F.rlike(F.lower(message), F.lit("429|quota|rate|timeout"))


def classify_log(log: DataFrame) -> DataFrame:
    """Add both verdicts to a call log with ``status_code`` and ``message``."""
    ok = F.coalesce(F.col("status_code") < 400, F.lit(False))

    def verdict(retry):
        return F.when(ok, "success").when(retry, "retry").otherwise("fatal")

    return log.withColumns(
        {
            "typed_class": verdict(retry_by_type_column(F.col("status_code"), F.col("message"))),
            "message_class": verdict(retry_by_message_column(F.col("message"))),
        }
    )


# --- policies -----------------------------------------------------------------------


@dataclass(frozen=True)
class RetryPolicy:
    """Attempts, the wait after each failed one, and the retry rule."""

    attempts: int
    base: float
    min_wait: float
    max_wait: float
    retriable: Callable[[Exception], bool]
    calls_per_second: float | None = None  # attempts, over all tasks of a run; in call_rows, of each partition

    def wait(self, attempt: int) -> float:
        return min(max(self.base * 2 ** (attempt - 1), self.min_wait), self.max_wait)


MODEL_POLICY = RetryPolicy(
    C.MODEL_ATTEMPTS, 1, C.MODEL_MIN_WAIT_SECONDS, C.MODEL_MAX_WAIT_SECONDS, retry_by_type
)
FETCH_POLICY = RetryPolicy(C.FETCH_ATTEMPTS, 2, 0, float("inf"), retry_fetch)


def attempt_call(call, text: str, policy: RetryPolicy, sleep, begin=lambda: None, failed=lambda error: None) -> tuple:
    """One row: ``(raw, status, attempts, waited, error)``.

    ``begin()`` comes before every attempt, ``failed(error)`` after one that failed.
    """
    waited = 0.0
    for attempt in range(1, policy.attempts + 1):
        begin()
        try:
            return call(text) or "", SUCCESS, attempt, waited, None
        except Exception as error:  # noqa: BLE001 - any error becomes the row's outcome
            failed(error)
            if attempt == policy.attempts or not policy.retriable(error):
                return None, FAILURE, attempt, waited, str(error)
        pause = policy.wait(attempt)
        sleep(pause)
        waited += pause


def caller(make_client: Callable, policy: RetryPolicy, sleep: Callable[[float], None]) -> Callable:
    """A maker of functions from a request to its outcome, with a client for each thread."""

    def make():
        own = threading.local()

        def one(request):
            if not hasattr(own, "client"):
                own.client = make_client()
            return attempt_call(own.client, request, policy, sleep)

        return one

    return make


class Pace:
    """Lets callers of several threads begin at most so many times a second."""

    def __init__(self, per_second: float | None, sleep: Callable[[float], None]):
        self.gap = 1 / per_second if per_second else 0.0
        self.sleep, self.lock, self.next = sleep, threading.Lock(), 0.0

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            begin = max(now, self.next)
            self.next = begin + self.gap
        if begin > now:
            self.sleep(begin - now)


#: Rows begun or ended behind a slow call, for each call under way.
AHEAD = 8


def in_order(batches: Iterator, one: Callable, in_flight: int) -> Iterator[list]:
    """The outcomes of every batch of rows, with ``in_flight`` calls under way also across batches.

    A slow call holds back its batch's outcomes, but no other call until
    ``AHEAD`` times as many rows wait behind it.
    """
    sizes, running, done = deque(), deque(), []

    def ended() -> Iterator[list]:
        done.append(running.popleft().result())
        while sizes and len(done) >= sizes[0]:
            n = sizes.popleft()
            yield done[:n]
            del done[:n]

    with ThreadPoolExecutor(in_flight) as threads:
        for batch in batches:
            sizes.append(len(batch))
            for row in batch:
                if len(running) == AHEAD * in_flight:
                    yield from ended()
                running.append(threads.submit(one, row))
        while running:
            yield from ended()
    yield from (done[:0] for _ in sizes)


def call_rows(
    df: DataFrame,
    column: str,
    make_client: Callable[[], Callable[[str], str]],
    policy: RetryPolicy = MODEL_POLICY,
    sleep: Callable[[float], None] = time.sleep,
    spread_by: tuple[str, ...] = (),
    concurrency: int | None = None,
    in_flight: int = 1,
) -> DataFrame:
    """Add the outcome columns ``raw, status, attempts, waited, error``.

    Only the text goes to Python; other columns stay in the JVM. A task has at
    most ``in_flight`` calls under way, each on a thread with a client of its
    own; outcomes keep the order of the rows. ``concurrency`` sets the number
    of partitions by hashing on ``spread_by``, which must identify a row so
    that no partition is hot. A policy's rate holds for a partition, over all
    its threads.
    """
    if concurrency:
        df = df.repartition(concurrency, *spread_by)
    # a worker holds a batch of requests, its outcomes and what is ahead: by bytes, not by rows
    small_batches(df.sparkSession)

    def calls(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, pace = threading.local(), Pace(policy.calls_per_second, sleep)
        names = ["raw", "status", "attempts", "waited", "error"]

        def one(text):
            if not hasattr(own, "client"):
                own.client = make_client()
            return attempt_call(own.client, text, policy, sleep, pace.wait)

        for outcomes in in_order(batches, one, in_flight):
            yield pd.DataFrame(outcomes, columns=names)

    # nondeterministic: Catalyst must neither repeat nor move the calls
    outcome = F.pandas_udf(calls, StructType.fromDDL(schemas.CALL)).asNondeterministic()
    return df.withColumn("_call", outcome(F.col(column))).select(*df.columns, "_call.*")


def pending(rows: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows whose call has no recorded outcome yet, for resuming a run."""
    return rows.join(done.select(*keys), list(keys), "left_anti")


def no_wait(seconds: float) -> None:
    """For trying a policy without its pauses."""


def replay_client() -> Callable[[str], str]:
    """A client that gives the answers recorded with a request, an attempt each: for trying policies on past calls.

    A request is JSON with an ``id`` and ``answers`` of ``kind``, ``status_code`` and ``reply``.
    """
    last, left = None, []

    def call(text: str) -> str:
        nonlocal last, left
        request = json.loads(text)
        if request["id"] != last:
            last, left = request["id"], request["answers"]
        answer, left = left[0], left[1:] or left
        if answer["kind"] == "ok":
            last = None
            return answer["reply"]
        raise CallError(answer["reply"], answer["kind"], answer.get("status_code"))

    return call


# --- model requests ------------------------------------------------------------------


def build_prompt(text: Column) -> Column:
    head = f"{C.REPLY_CONTRACT}\n\n{C.TEXT_START_MARKER}\n"
    return F.concat(F.lit(head), text, F.lit(f"\n{C.TEXT_END_MARKER}"))


@dataclass(frozen=True)
class ModelConfig:
    provider: str
    model: str
    key_variable: str

    @property
    def system_and_timeout(self) -> bool:
        """One provider takes the prompt alone, with its own default timeout."""
        return self.provider != "gemini"


#: For a run whose caller chose none.
DEFAULT_CONFIG = ModelConfig(C.DEFAULT_PROVIDER, C.PROVIDERS[C.DEFAULT_PROVIDER][2], C.PROVIDERS[C.DEFAULT_PROVIDER][0])


def policy_for(config: ModelConfig) -> RetryPolicy:
    """The retry rules of a provider: by the error's type, or by its message where clients have no types."""
    return MODEL_POLICY if config.system_and_timeout else replace(MODEL_POLICY, retriable=retry_by_message)


def request_client(make_client: Callable) -> Callable:
    """A maker of clients for JSON text, from one of clients for requests as dictionaries."""

    def make():
        client = make_client()
        return lambda text: client(json.loads(text))

    return make


def model_config(environment: Mapping[str, str]) -> ModelConfig:
    """Choose and check the provider on the driver, before any job starts.

    The key itself is not kept: clients read it on the executors.
    """
    provider = environment.get(C.PROVIDER_VARIABLE, C.DEFAULT_PROVIDER).lower()
    if provider not in C.PROVIDERS:
        raise ValueError(f"unknown provider {provider!r}; choose one of {', '.join(C.PROVIDERS)}")
    key_variable, model_variable, default_model = C.PROVIDERS[provider]
    if not environment.get(key_variable):
        raise OSError(f"environment variable {key_variable} is not set")
    return ModelConfig(provider, environment.get(model_variable, default_model), key_variable)


def build_request(text: Column, config: ModelConfig) -> Column:
    """The request as a struct: model, messages, temperature, timeout."""

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = [message("user", build_prompt(text))]
    if config.system_and_timeout:
        messages.insert(0, message("system", F.lit(C.SYSTEM_MESSAGE)))
    timeout = C.MODEL_TIMEOUT_SECONDS if config.system_and_timeout else None
    return F.struct(
        F.lit(config.model).alias("model"),
        F.array(*messages).alias("messages"),
        F.lit(C.MODEL_TEMPERATURE).alias("temperature"),
        F.lit(timeout).cast("int").alias("timeout"),
    )
