"""SQL of the operators that SQL can express."""

EXACT_DEDUP = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
    FROM documents
), r AS (
    SELECT *, first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size
    FROM d WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM r
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """A pair of table expressions for every round: each part's nearest entry, and the means of the parts."""
    steps = [
        f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS r,
           len(embedding) // {parts} AS width
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS (
    SELECT r, width, embedding, unnest(range({parts})) AS part FROM kept
), place AS (
    SELECT r, width, embedding, part, unnest(range(width)) AS pos FROM part
), cell AS MATERIALIZED (
    SELECT r, part, pos, CAST(floor(4096 * CAST(embedding[part * width + pos + 1] AS DOUBLE)) AS BIGINT) AS x
    FROM place
), book0 AS MATERIALIZED (
    SELECT part, r AS entry, pos, x AS y FROM cell WHERE r < {entries}
)"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f""", near{k} AS MATERIALIZED (
    SELECT r, part, entry, d
    FROM (SELECT r, part, entry, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d
          FROM cell JOIN book{k} USING (part, pos) GROUP BY r, part, entry)
    QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1
)"""
        )
        if k < rounds:
            steps.append(
                f""", mean{k} AS (
    SELECT part, entry, pos, sum(x) AS s, count(*) AS n
    FROM cell JOIN near{k} USING (r, part) GROUP BY part, entry, pos
), book{k + 1} AS MATERIALIZED (
    SELECT part, entry, pos, CAST(coalesce((s - ((s % n) + n) % n) // n, y) AS BIGINT) AS y
    FROM book{k} LEFT JOIN mean{k} USING (part, entry, pos)
)"""
            )
    steps.append(
        f""", coded AS (
    SELECT r, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code,
           CAST(sum(d) AS BIGINT) AS error
    FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds})
           AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""
    )
    return "".join(steps)


FILTER_AUDIT = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), l AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id
), f AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
    FROM d
), c AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask
), letter AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS own
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order,
           [a.own, b.own, c.own, d.own, e.own] AS owns
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE a.own + b.own + c.own + d.own + e.own = 31 AND a.own | b.own | c.own | d.own | e.own = 31
), steps AS (
    SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step, owns FROM orders
), s AS (
    SELECT filter_order, step, owns[step] AS own, coalesce(list_sum(owns[1:step - 1]), 0)::INTEGER AS before
    FROM steps
), g AS (
    SELECT part, filter_order, step, own,
           CAST(coalesce(sum(n) FILTER (WHERE mask & (before | own) = 0), 0) AS BIGINT) AS kept,
           CAST(coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & own > 0), 0) AS BIGINT) AS removed,
           CAST(coalesce(sum(n) FILTER (WHERE mask & before > 0 AND mask & own > 0), 0) AS BIGINT) AS redundant,
           CAST(coalesce(sum(n) FILTER (WHERE mask = own), 0) AS BIGINT) AS unique_fails,
           CAST(coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & own > 0), 0) AS BIGINT) AS good_lost,
           CAST(coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & own > 0), 0) AS BIGINT) AS toxic_lost
    FROM c, s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""


def _url_filter(order: int = 3, symbols: str = "abcdefghijklmnopqrstuvwxyz0.-/") -> str:
    """Rules, then a pair of table expressions for every length of context: counts, and smoothed chances."""
    upper, lower = symbols[:26].upper(), symbols[:26]
    number = "((c[i] * 32 + c[i + 1]) * 32 + c[i + 2]) * 32 + c[i + 3]"
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    rules = [
        ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
        ("net", "/", "block"),
    ]
    cases = [(fits.format(at, begin), at + begin, verdict) for at, begin, verdict in rules]
    chosen = lambda k: " ".join(f"WHEN {case[0]} THEN '{case[k]}'" for case in cases)
    steps = [
        f"""
WITH parsed AS (
    SELECT page_id, row_number() OVER () AS r,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{upper}', '{lower}') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE {chosen(1)} END AS rule, CASE {chosen(2)} END AS by_rule,
           translate(host || path, '{upper}', '{lower}') AS t
    FROM parsed
), urls AS MATERIALIZED (
    SELECT *, md5(t)[1] IN ('0', '1', '2') AS held,
           list_concat([0, 0, 0], list_transform(
               list_filter(string_split(translate(t, '123456789', '000000000'), ''), lambda x: x <> ''),
               lambda x: CASE WHEN strpos('{symbols}', x) > 0 THEN strpos('{symbols}', x) ELSE 31 END), [0]) AS c
    FROM ruled
), grams AS MATERIALIZED (
    SELECT r, by_rule, held, unnest(list_transform(range(1, len(c) - 2), lambda i: {number})) AS gram FROM urls
), counts AS MATERIALIZED (
    SELECT gram, count(*) FILTER (WHERE by_rule = 'allow' AND NOT held) AS allow,
           count(*) FILTER (WHERE by_rule = 'block' AND NOT held) AS block
    FROM grams GROUP BY gram
)"""
    ]
    for k in range(order + 1):
        below = f"JOIN chance{k - 1} q ON o.gram % {32**k} = q.gram" if k else ""
        p = lambda kind: f"q.p_{kind}" if k else "1.0::DOUBLE / 32"  # noqa: B023, E731
        smoothed = ", ".join(
            f"CASE WHEN n_{kind} > 0 THEN (o.{kind} + kinds_{kind} * {p(kind)}) / (n_{kind} + kinds_{kind})::DOUBLE "
            f"ELSE {p(kind)} END AS p_{kind}"
            for kind in ("allow", "block")
        )
        steps.append(
            f""", own{k} AS (
    SELECT gram % {32 ** (k + 1)} AS gram, sum(allow)::BIGINT AS allow, sum(block)::BIGINT AS block
    FROM counts GROUP BY gram % {32 ** (k + 1)}
), after{k} AS (
    SELECT gram >> 5 AS context, sum(allow)::BIGINT AS n_allow, sum(block)::BIGINT AS n_block,
           count(*) FILTER (WHERE allow > 0) AS kinds_allow, count(*) FILTER (WHERE block > 0) AS kinds_block
    FROM own{k} GROUP BY gram >> 5
), chance{k} AS MATERIALIZED (
    SELECT o.gram, {smoothed}
    FROM own{k} o JOIN after{k} ON o.gram >> 5 = context {below}
)"""
        )
    steps.append(
        f""", model AS (
    SELECT gram, CAST(round((ln(p_allow) - ln(p_block)) * 4294967296) AS BIGINT) AS ratio FROM chance{order}
), scored AS MATERIALIZED (
    SELECT r, any_value(by_rule) AS by_rule, any_value(held) AS held,
           floor(sum(ratio)::DOUBLE / (count(*) * 4294967296)::DOUBLE * 1000) AS step
    FROM grams JOIN model USING (gram) GROUP BY r
), steps AS (
    SELECT step, count(*) FILTER (WHERE by_rule = 'allow') AS allow, count(*) FILTER (WHERE by_rule = 'block') AS block
    FROM scored WHERE held AND by_rule IS NOT NULL GROUP BY step
), errors AS (
    SELECT greatest(least(step, 0), lag(step) OVER (ORDER BY step) + 1) AS least,
           sum(allow) OVER () AS every_allow, sum(block) OVER () AS every_block,
           sum(allow) OVER (ORDER BY step) - allow AS lost, sum(block) OVER (ORDER BY step) - block AS stopped
    FROM steps
), best AS (
    SELECT least FROM errors WHERE every_allow > 0 AND every_block > 0
    ORDER BY round(lost::DOUBLE / every_allow + 1 - stopped::DOUBLE / every_block, 12), abs(least), least LIMIT 1
)
SELECT page_id, host, path, rule,
       coalesce(urls.by_rule, CASE WHEN step >= coalesce((SELECT least FROM best), 0) THEN 'allow' ELSE 'block' END)
           AS verdict
FROM urls JOIN scored USING (r)
"""
    )
    return "".join(steps)


ORACLES = {
    "op6_exact_dedup": EXACT_DEDUP,
    "op11_vector_codes": _vector_codes(),
    "op12_filter_audit": FILTER_AUDIT,
    "op13_url_filter": _url_filter(),
}
