"""Personal data in whole texts, with built-in expressions only.

Regular expressions propose spans, checksums and value ranges confirm them, and
words shortly before a span adjust its score.

Splitting a text by a pattern gives the gaps between its matches; running sums
over the lengths of gaps and matches give the positions, in code points. Where
a pattern could start anew inside a long run of its own characters, it is held
to the beginning of the run or the end of the match before, which finds the
same matches in linear time; possessive repeats keep Java's matcher from
recursing.

Null and empty texts have no spans. Repeated rows give repeated rows, an empty
table an empty one. Other columns, whatever their names, are not read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before a span in which context words count.
CONTEXT_CHARS = 48
#: Matches whose positions are summed up at once.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """One kind of personal data."""

    name: str
    pattern: str
    #: a text without a match of this cheaper pattern cannot hold one: spares the search
    needs: str
    #: from the matched text: is it one?
    confirm: object
    #: score of a confirmed match, and what a context word adds
    score: float
    context: str
    bonus: float = 0.25
    #: least score; base kinds are reported whatever their score
    least: float = 0.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _within(low: int, high: int):
    return lambda value: F.length(_digits(value)).between(low, high)


def _luhn(value: Column) -> Column:
    return F.call_function("luhn_check", _digits(value))


def _mod97(value: Column) -> Column:
    """ISO 7064: letters count as 10 to 35, the first four characters go last."""
    compact = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))
    number = F.transform(
        F.split(moved, ""), lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    )
    rest = F.aggregate(
        number,
        F.lit(0),
        lambda sum_, n: F.pmod(sum_ * F.when(n > 9, 100).otherwise(10) + n, F.lit(97)).cast("int"),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


_PART = "0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"

# Patterns and limits of the base kinds, in the order of the report.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda value: F.lit(True),
        0.7,
        r"mail|contact|write to|@",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        lambda value: value.rlike(rf"^{_PART}(\.{_PART}){{3}}$"),
        0.5,
        r"\bip\b|addr|host|server|client",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
        "[0-9](?:[ -]?[0-9]){3}",
        _luhn,
        0.6,
        r"card|visa|credit|debit|pay",
    ),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", _within(8, 15), 0.5, r"phone|call|tel|mobile|fax"),
)
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}
#: The country gives the length, so what follows the number is not taken with it. Codes
#: without a known length are taken without spaces.
_IBANS = "|".join(
    [
        f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}+"
        for length, codes in IBAN_LENGTHS.items()
    ]
    + [f"(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}+"]
)

#: Found by checksum, or by context alone where the number has none.
ADDED = (
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBANS})(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
        _mod97,
        0.7,
        r"iban|account|bank|konto|compte|cuenta",
        least=0.6,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "[0-9]-[0-9]",
        lambda value: ~value.rlike("^(000|666|9)|-00-|0000$"),
        0.3,
        r"\bssn\b|social security",
        bonus=0.5,
        least=0.6,
    ),
)


def _running(lengths: Column, total: Column) -> Column:
    """For every element the sum of those before it.

    Blocks are summed up on their own, so that no list of all matches is copied
    for each match.
    """
    zero = F.lit(0).cast("bigint")
    add = lambda acc, x: F.struct(
        (acc["sum"] + x).alias("sum"), F.concat(acc["list"], F.array(acc["sum"])).alias("list")
    )
    start = lambda at: F.struct(at.alias("sum"), F.array().cast("array<bigint>").alias("list"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((total - 1) / BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)),
    )
    summed = F.transform(
        blocks, lambda block: F.aggregate(block, start(zero), lambda acc, x: add(acc, x))
    )
    joined = F.aggregate(
        summed,
        F.struct(
            zero.alias("sum"), F.array().cast("array<array<bigint>>").alias("list")
        ),
        lambda acc, block: F.struct(
            (acc["sum"] + block["sum"]).alias("sum"),
            F.concat(acc["list"], F.array(F.transform(block["list"], lambda x: x + acc["sum"]))).alias("list"),
        ),
        lambda acc: F.flatten(acc["list"]),
    )
    return joined


def _found(kind: Kind) -> Column:
    """All matches; null where a text cannot hold one."""
    every = F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))
    return F.when(F.col("text").rlike(kind.needs), every)


def _placed(kind: Kind) -> Column:
    """``(kind, start, end, score)`` of the confirmed matches of a kind."""
    value = F.col(f"_{kind.name}")
    gaps = F.split("text", kind.pattern, -1)
    pairs = F.zip_with(
        # the gap after the last match has no match
        F.slice(gaps, F.lit(1), F.size(value)),
        value,
        lambda gap, match: F.struct(
            F.char_length(gap).cast("bigint").alias("gap"),
            F.char_length(match).cast("bigint").alias("length"),
            match.alias("value"),
            F.lower(F.right(gap, F.lit(CONTEXT_CHARS))).rlike(kind.context).alias("near"),
        ),
    )
    return F.when(F.size(value) > 0, pairs)


def _spans(kind: Kind) -> Column:
    pairs = F.col(f"_at_{kind.name}")
    lengths = F.transform(pairs, lambda p: p["gap"] + p["length"])
    placed = F.zip_with(
        pairs,
        _running(lengths, F.size(pairs)),
        lambda p, before: F.struct(
            F.concat_ws(
                ":", F.lit(kind.name), before + p["gap"], before + p["gap"] + p["length"]
            ).alias("span"),
            p["value"].alias("value"),
            F.when(p["near"], kind.score + kind.bonus).otherwise(F.lit(kind.score)).alias("score"),
        ),
    )
    confirmed = F.filter(placed, lambda s: kind.confirm(s["value"]) & (s["score"] >= kind.least))
    none = F.array().cast("array<struct<span:string,value:string,score:double>>")
    return F.when(F.col(f"_at_{kind.name}").isNotNull(), confirmed).otherwise(none)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, <kind>...)``: for every kind an array of ``(span, value, score)``.

    ``span`` is ``kind:start:end`` in code points, end exclusive; ``score`` is
    between 0 and 1.
    """
    kinds = BASE + ADDED
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("*", *[_found(k).alias(f"_{k.name}") for k in kinds])
    paired = found.select("doc_id", *[_placed(k).alias(f"_at_{k.name}") for k in kinds])
    return paired.select("doc_id", *[_spans(k).alias(k.name) for k in kinds])


def digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, all spans, and their scores."""
    spans = lambda kinds: F.array_join(
        F.flatten(F.array(*[F.transform(k.name, lambda s: s["span"]) for k in kinds])), ","
    )
    scores = F.flatten(F.array(*[F.transform(k.name, lambda s: s["score"]) for k in BASE + ADDED]))
    return found.select(
        "doc_id",
        *[F.size(k.name).cast("bigint").alias(f"n_{k.name}") for k in BASE],
        F.sha2(spans(BASE), 256).alias("base_sha256"),
        spans(BASE + ADDED).alias("spans"),
        *[F.size(k.name).cast("bigint").alias(f"n_{k.name}") for k in ADDED],
        F.array_join(F.transform(scores, lambda s: F.format_number(s, 2)), ",").alias("scores"),
    )
