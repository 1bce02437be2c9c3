"""Verdicts on URLs by rules, and by a character language-model ratio where no rule fits.

The URLs that rules decide are the examples: one model of accepted and one of
rejected URLs. A model is a Markov chain of variable order over the symbols of
host and path: the chance of a symbol after its three predecessors is smoothed
with that after two, one and none (Witten-Bell), and a context that was never
seen leaves the chance to the next shorter one. A URL's score is the difference
of its two log-likelihoods for each symbol. One example in ``FOLDS`` is held out
of training and calibrates the filter: the score from which URLs are accepted
is the one with the least sum of both kinds' shares of errors on those examples
(the one nearest to zero if several are).

A URL has 32 symbols, so a model has 32^4 grams at most, whatever the number of
URLs, and is sent to every task. Counts, scores and calibration are DataFrame
expressions; the logarithms are summed as integers, so that no verdict depends
on the order of rows.

A null URL, or one without ``://``, has an empty host and path and one symbol,
the end. Where no example of a kind is held out, the filter is at zero; without
any examples every score is zero, and zero is accepted. Repeated rows are judged
each, a null ``page_id`` is passed on, an empty table gives an empty one. Other
columns, whatever their names, are not read.
"""

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsheaf.functions.text import let
from docsheaf.llm.common import staged

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Symbols 1 to 30; every digit is a 0. Before the first and after the last symbol is 0, all others are 31.
SYMBOLS = string.ascii_lowercase + "0.-/"
SIZE = 32
ORDER = 3
#: Examples whose MD5 digest begins with one of these are held out.
HELD = ("0", "1", "2")
#: Logarithms are summed in these units, and scores calibrated in steps of ``1 / STEPS``.
UNIT = 1 << 32
STEPS = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, after, k), F.lit("")) for k in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def first_rule(host: Column, path: Column, rules, value) -> Column:
    """``value(rule)`` of the longest rule that fits, the first of equally long ones; else null."""
    fits = [
        F.when(((host == at) | host.endswith(f".{at}")) & path.startswith(begin), F.lit(value((verdict, at, begin))))
        for verdict, at, begin in sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, text, held)``; rule and verdict are null where none fits."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    text = F.translate(F.concat("host", "path"), string.ascii_uppercase, string.ascii_lowercase)
    return rows.select(
        "*",
        first_rule(F.col("host"), F.col("path"), rules, lambda rule: rule[1] + rule[2]).alias("rule"),
        first_rule(F.col("host"), F.col("path"), rules, lambda rule: rule[0]).alias("verdict"),
        text.alias("text"),
        F.left(F.md5(text), F.lit(1)).isin(*HELD).alias("held"),
    )


def grams(text: Column) -> Column:
    """For every symbol and the end a number made of it and the ``ORDER`` symbols before it."""
    chars = F.filter(F.split(F.translate(text, "123456789", "0" * 9), ""), lambda c: c != "")
    place = lambda c: F.position(c, F.lit(SYMBOLS))
    codes = F.transform(chars, lambda c: F.when(place(c) > 0, place(c)).otherwise(SIZE - 1))
    edge = lambda n: F.array(*[F.lit(0)] * n)

    def number(codes: Column, at: Column) -> Column:
        out = F.lit(0)
        for back in range(ORDER, -1, -1):
            out = out * SIZE + F.get(codes, at - back)
        return out

    return let(
        F.concat(edge(ORDER), codes, edge(1)),
        lambda codes: F.transform(F.sequence(F.lit(ORDER), F.size(codes) - 1), lambda at: number(codes, at)),
    )


def gram_counts(urls: DataFrame) -> DataFrame:
    """``(gram, allow, block)``: all grams, with how often they occur in the examples of each kind."""
    example = lambda kind: F.coalesce((F.col("verdict") == kind) & ~F.col("held"), F.lit(False)).alias(kind)
    every = urls.select(example("allow"), example("block"), F.explode(grams(F.col("text"))).alias("gram"))
    return every.groupBy("gram").agg(F.count_if("allow").alias("allow"), F.count_if("block").alias("block"))


def chances(counts: DataFrame) -> DataFrame:
    """``(gram, p_allow, p_block)``: the smoothed chance of every gram's last symbol after the others."""
    below = None
    for order in range(ORDER + 1):
        own = counts.groupBy((F.col("gram") % SIZE ** (order + 1)).alias("gram")).agg(
            F.sum("allow").alias("allow"), F.sum("block").alias("block")
        )
        own = own.withColumn("context", F.shiftright("gram", 5))
        after = own.groupBy("context").agg(
            *[F.sum(kind).alias(f"n_{kind}") for kind in ("allow", "block")],
            *[F.count_if(F.col(kind) > 0).alias(f"kinds_{kind}") for kind in ("allow", "block")],
        )
        rows = own.join(after, "context")
        if below is None:
            rows = rows.withColumns({"q_allow": F.lit(1.0 / SIZE), "q_block": F.lit(1.0 / SIZE)})
        else:
            shorter = below.select(
                F.col("gram").alias("shorter"), F.col("p_allow").alias("q_allow"), F.col("p_block").alias("q_block")
            )
            rows = rows.withColumn("shorter", F.col("gram") % SIZE**order).join(shorter, "shorter")
        below = rows.select("gram", *[_smoothed(kind).alias(f"p_{kind}") for kind in ("allow", "block")])
    return below


def _smoothed(kind: str) -> Column:
    n, kinds, shorter = F.col(f"n_{kind}"), F.col(f"kinds_{kind}"), F.col(f"q_{kind}")
    return F.when(n > 0, (F.col(kind) + kinds * shorter) / (n + kinds)).otherwise(shorter)


def scored(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``urls`` with ``score``, the mean difference of log-likelihoods, and its ``step``; a row for each row.

    ``model(gram, ratio)`` has every gram of the URLs, at most ``SIZE`` to the
    power ``ORDER + 1`` of them.
    """
    rows = urls.withColumn("_row", F.monotonically_increasing_id())
    each = rows.select("*", F.explode(grams(F.col("text"))).alias("gram"))
    # a URL's symbols are neighbours in one task, so all but one row of each are added up before the shuffle
    found = each.join(F.broadcast(model), "gram").groupBy("_row", *urls.columns)
    score = F.sum("ratio") / (F.count("*") * UNIT)
    return found.agg(score.alias("score"), F.floor(score * STEPS).alias("step")).drop("_row")


def calibrated(examples: DataFrame) -> int:
    """The step from which URLs are accepted, from held-out examples with ``verdict`` and ``step``.

    The table of steps has a row for each that occurs, which smoothing bounds.
    """
    steps = examples.groupBy("step").agg(
        *[F.count_if(F.col("verdict") == kind).alias(kind) for kind in ("allow", "block")]
    )
    upwards = Window.partitionBy(F.lit(0)).orderBy("step")
    everything = Window.partitionBy(F.lit(0))
    lost = (F.sum("allow").over(upwards) - F.col("allow")) / F.sum("allow").over(everything)
    passed = 1 - (F.sum("block").over(upwards) - F.col("block")) / F.sum("block").over(everything)
    both = (F.sum("allow").over(everything) > 0) & (F.sum("block").over(everything) > 0)
    # all from the step after the one below have the same errors
    since = F.lag("step").over(Window.partitionBy(F.lit(0)).orderBy("step")) + 1
    nearest = F.greatest(F.least("step", F.lit(0)), since).alias("least")
    errors = steps.select(nearest, F.when(both, F.round(lost + passed, 12)).alias("errors")).filter("errors is not null")
    best = errors.orderBy("errors", F.abs("least"), "least").first()
    return best.least if best else 0


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` of every URL; ``score`` is null where a rule decides."""
    urls = parsed(pages, rules)
    ratio = F.round((F.log("p_allow") - F.log("p_block")) * UNIT).cast("bigint").alias("ratio")
    model = staged(chances(staged(gram_counts(urls), "url-grams")).select("gram", ratio), "url-model")
    asked = staged(scored(urls.filter("verdict is null or held"), model), "url-scores")
    least = calibrated(asked.filter("verdict is not null"))
    by_rule = urls.filter("verdict is not null").withColumn("score", F.lit(None).cast("double"))
    by_model = asked.filter("verdict is null").withColumn(
        "verdict", F.when(F.col("step") >= least, "allow").otherwise("block")
    )
    columns = ["page_id", "host", "path", "rule", "verdict", "score"]
    return by_rule.select(*columns).unionByName(by_model.select(*columns))


def digest(found: DataFrame) -> DataFrame:
    return found.select("page_id", "host", "path", "rule", "verdict")
