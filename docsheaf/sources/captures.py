"""Captured web pages as documents."""

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf import constants as C
from docsheaf.functions.html import html_main_text
from docsheaf.functions.text import is_blank
from docsheaf.operators.calls import FETCH_POLICY, RetryPolicy, call_rows
from docsheaf.session import computed_once


def body_text(content_type: Column, body: Column) -> Column:
    """Main text where the content type says html (case matters), else the body.

    The condition gates the input: other bodies reach Python only as null.
    """
    is_html = F.contains(content_type, F.lit("html"))
    return F.coalesce(html_main_text(F.when(is_html, body)), body)


def with_body_text(captures: DataFrame) -> DataFrame:
    """Add ``raw_text`` to captures ``(source, content_type, body, ...)``."""
    text = body_text(F.col("content_type"), F.col("body"))
    return computed_once(captures.withColumn("raw_text", text), "raw_text")


def read_captures(captures: DataFrame, *keep: str) -> DataFrame:
    """``(keep..., source, source_type, raw_text)`` of pages that have any text."""
    return (
        with_body_text(captures)
        .filter(~is_blank(F.col("raw_text")))
        .select(*keep, "source", F.lit("url").alias("source_type"), "raw_text")
    )


def blank_captures(captures: DataFrame) -> DataFrame:
    """Rejects: pages without text."""
    return (
        with_body_text(captures)
        .filter(is_blank(F.col("raw_text")))
        .select("source", F.lit("ingest").alias("stage"), F.lit("empty content").alias("reason"))
    )


def fetch_pages(
    urls: DataFrame,
    make_transport: Callable[[], Callable[[str, float, dict[str, str]], tuple[str | None, str]]],
    policy: RetryPolicy = FETCH_POLICY,
    sleep: Callable[[float], None] = time.sleep,
    concurrency: int | None = None,
    in_flight: int = 1,
    timeout: float = C.FETCH_TIMEOUT_SECONDS,
    user_agent: str = C.USER_AGENT,
) -> DataFrame:
    """Capture live pages: adds ``content_type, body`` and the call's outcome.

    ``make_transport`` runs on an executor and returns a function of the URL,
    the seconds to wait and the headers to send, to ``(content type, body)``;
    it raises ``CallError``. Write the result once.
    """

    def make_client():
        transport = make_transport()

        def call(url):
            content_type, body = transport(url, timeout, {"User-Agent": user_agent})
            return json.dumps({"content_type": content_type, "body": body})

        return call

    calls = call_rows(urls, "source", make_client, policy, sleep, ("source",), concurrency, in_flight)
    page = F.from_json("raw", "content_type string, body string")
    return calls.withColumn("_page", page).select(
        *urls.columns, "_page.content_type", "_page.body", "status", "attempts", "waited", "error"
    )


def failed_fetches(fetched: DataFrame) -> DataFrame:
    """Rejects: fetches that ended in failure."""
    return fetched.filter(F.col("status") != "success").select(
        "source", F.lit("fetch").alias("stage"), F.col("error").alias("reason")
    )
