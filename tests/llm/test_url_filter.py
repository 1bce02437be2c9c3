import hashlib
import math
import random
import re
import string
from collections import Counter

from docsheaf.llm import url_filter as uf

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SYMBOLS = string.ascii_lowercase + "0.-/"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return lower(host), path


def ruled(host, path):
    fits = [(at + begin, verdict) for at, begin, verdict in RULES
            if (host == at or host.endswith("." + at)) and path.startswith(begin)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def codes(text):
    own = [SYMBOLS.find("0" if c in string.digits else c) + 1 or 31 for c in text]
    return [0, 0, 0, *own, 0]


def brute(urls):
    """Verdicts of all URLs by dictionaries of contexts."""
    rows = []
    for url in urls:
        host, path = parsed(url)
        text = lower(host + path)
        rows.append((host, path, *ruled(host, path), text, hashlib.md5(text.encode()).hexdigest()[0] in "012"))
    after = {kind: Counter() for kind in ("allow", "block")}
    for _, _, _, verdict, text, held in rows:
        if verdict and not held:
            c = codes(text)
            for at in range(3, len(c)):
                for n in range(4):
                    after[verdict][tuple(c[at - n : at]), c[at]] += 1
    contexts = {kind: {} for kind in after}
    for kind, counts in after.items():
        for (context, _), n in counts.items():
            total, kinds = contexts[kind].get(context, (0, 0))
            contexts[kind][context] = total + n, kinds + 1

    def chance(kind, context, symbol):
        below = chance(kind, context[1:], symbol) if context else 1 / 32
        total, kinds = contexts[kind].get(context, (0, 0))
        return (after[kind][context, symbol] + kinds * below) / (total + kinds) if total else below

    def step(text):
        c, total = codes(text), 0
        for at in range(3, len(c)):
            context = tuple(c[at - 3 : at])
            total += round((math.log(chance("allow", context, c[at])) - math.log(chance("block", context, c[at]))) * 2**32)
        return math.floor(total / ((len(c) - 3) * 2**32) * 1000)

    held = [(step(text), verdict) for _, _, _, verdict, text, out in rows if verdict and out]
    n = Counter(verdict for _, verdict in held)
    least = 0
    if n["allow"] and n["block"]:
        scale = sorted({s for s, _ in held})
        errors = lambda t: round(
            sum(s < t and v == "allow" for s, v in held) / n["allow"]
            + 1 - sum(s < t and v == "block" for s, v in held) / n["block"], 12
        )
        # all whole steps up to the greatest
        least = min(range(min(scale[0], 0), scale[-1] + 1), key=lambda t: (errors(t), abs(t), t))
    return [
        (host, path, rule, verdict or ("allow" if step(text) >= least else "block"))
        for host, path, rule, verdict, text, _ in rows
    ]


def result(df):
    return {r.page_id: tuple(r)[1:] for r in uf.digest(uf.judged(df)).collect()}


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def made(rnd, n):
    hosts = ["a.example.net", "EXAMPLE.net", "spam-farm.example.com", "b.example.com", "x.example.org", "cornet", "net",
             "my.other.de", "casino.org", "b-c.example.org", "q.example.com:80", "日本.jp", "u@h.net"]
    paths = ["/en/", "/en", "/de/", "/fr/", "", "/", "/EN/", "//en/", "/es/é_~", "/fr/😀"]
    tails = ["", "?a=/de/", "#/en/", "?x=http://y.net/en/"]
    return [
        f"{rnd.choice(['http', 'https', ''])}://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', rnd.randrange(10**4)])}"
        f"{rnd.choice(tails)}"
        for _ in range(n)
    ]


def test_against_brute_force(spark):
    for seed in (1, 2, 3):
        urls = made(random.Random(seed), 300)
        assert result(pages(spark, urls)) == dict(enumerate(brute(urls)))


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = df.select("page_id", "url").orderBy("page_id").collect()
    found = result(df)
    assert [found[r.page_id] for r in rows] == brute([r.url for r in rows])
    assert {verdict for *_, rule, verdict in found.values() if rule is None} == {"allow", "block"}


def test_odd_rows(spark):
    urls = [None, "", "no scheme", "://", "http://", "http:///path", "http://Net/", "a\nb://x.net/en/\n?", "http://" + "x" * 50_000,
            "http://a.net/" + "é" * 20_000, "HTTP://WWW.EXAMPLE.NET/en/x", "http://a.net/", "http://a.net/"]
    assert result(pages(spark, urls)) == dict(enumerate(brute(urls)))
    extra = spark.createDataFrame(
        [(k, u, None, "x", 1, 2) for k, u in enumerate(urls)],
        "page_id bigint, url string, html string, host string, gram int, `_row` int",
    )
    assert result(extra) == dict(enumerate(brute(urls)))
    assert result(pages(spark, []).limit(0)) == {}
    twice = uf.judged(pages(spark, urls).union(pages(spark, urls)))
    assert twice.count() == 2 * len(urls)
    nameless = spark.createDataFrame([(None, "http://x.de/a"), (None, "http://x.de/a")], "page_id bigint, url string")
    assert uf.judged(nameless).count() == 2


def test_without_examples_all_are_accepted(spark):
    urls = ["http://a.de/x", None, "http://b.fr"]
    assert {v for *_, v in result(pages(spark, urls)).values()} == {"allow"}


def test_a_model_is_on_the_native_path(spark):
    plan = uf.judged(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_seen_kinds_of_urls_are_told_apart(spark):
    rnd = random.Random(6)
    good = [f"http://h{rnd.randrange(9)}.org/fr/garden-{rnd.randrange(999)}" for _ in range(200)]
    bad = [f"http://h{rnd.randrange(9)}.net/win-casino-{rnd.randrange(999)}" for _ in range(200)]
    asked = [f"http://k.org/es/garden-{k}" for k in range(20)] + [f"http://k.org/es/win-casino-{k}" for k in range(20)]
    found = result(pages(spark, good + bad + asked))
    verdicts = [found[400 + k][-1] for k in range(40)]
    assert verdicts == ["allow"] * 20 + ["block"] * 20
