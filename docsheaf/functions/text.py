"""Text cleaning as Spark columns."""

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docsheaf import constants as C

# Python's str.isspace() set; Java's Unicode \s is the same without U+001C-1F
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
WS = r"(?U:[\s\x1c-\x1f])"

# Characters that composition can neither change nor attach to: text made of
# these alone is already in NFC. (test_text checks every one of them.)
NFC_STABLE = (
    r"\x{0}-\x{2ff}\x{400}-\x{482}\x{48a}-\x{52f}\x{2002}-\x{2027}\x{2030}-\x{205e}"
    r"\x{20a0}-\x{20bf}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fff}"
    r"\x{ac00}-\x{d7a3}\x{feff}-\x{feff}\x{1f300}-\x{1faf0}"
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def py_strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def py_rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return py_strip(text) == ""


@F.pandas_udf(StringType())
def _normalize(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(text: Column) -> Column:
    """NFC form. Text that is plainly stable reaches Python only as null."""
    unstable = F.rlike(text, F.lit(f"[^{NFC_STABLE}]"))
    return F.coalesce(_normalize(F.when(unstable, text)), text)


def unify_newlines(text: Column) -> Column:
    lf = F.lit("\n")
    return F.replace(F.replace(text, F.lit("\r\n"), lf), F.lit("\r"), lf)


def replace_artefacts(text: Column) -> Column:
    """Typographic quotes and dashes, odd spaces, BOM and line ends."""
    plain = F.translate(text, C.ARTEFACT_CHARS + C.ARTEFACT_REMOVED, C.ARTEFACT_CHARS_TO)
    return unify_newlines(F.replace(plain, F.lit(C.EM_DASH), F.lit(C.EM_DASH_TO)))


def _first_characters(patterns) -> set[str] | None:
    """The characters a match can start with, if each pattern has a fixed one."""
    starts = set()
    for pattern in patterns:
        outside = re.sub(r"\([^()]*\)|\[[^\]]*\]", "", pattern)
        fixed = pattern[:1].isalpha() or pattern[:1] == "\u00a9"
        if not fixed or "|" in outside or pattern[1:2] in ("?", "*", "{"):
            return None
        starts |= {pattern[0].lower(), pattern[0].upper()}
    # case folding also maps the long s and the Kelvin sign to letters
    return starts | {"\u017f", "\u212a"}


def boilerplate_regex(patterns=C.BOILERPLATE_PATTERNS) -> str:
    """One case-insensitive alternation of the patterns.

    Flags: Unicode case folding and digits, and ``.`` stopping at newline only.
    A look-ahead for the possible first characters skips most positions cheaply.
    """
    union = "|".join(p.replace(r"\s", WS) for p in patterns)
    starts = _first_characters(patterns)
    ahead = f"(?=[{''.join(sorted(starts))}])" if starts else ""
    return f"{ahead}(?iuUd:{union})"


def drop_boilerplate(text: Column, patterns=C.BOILERPLATE_PATTERNS) -> Column:
    """Drop each line in which any pattern is found; other text is untouched."""
    if not patterns:
        return text
    regex = F.lit(boilerplate_regex(patterns))
    keep = lambda line: ~F.rlike(line, regex)
    return let(
        text,
        lambda t: F.when(
            F.rlike(t, regex), F.array_join(F.filter(F.split(t, "\n"), keep), "\n")
        ).otherwise(t),
    )


def collapse_newlines(text: Column) -> Column:
    # a byte search spares most texts the regex, which decodes and encodes them
    return let(
        text,
        lambda t: F.when(
            F.contains(t, F.lit("\n\n\n")), F.regexp_replace(t, r"\n{3,}", "\n\n")
        ).otherwise(t),
    )


def trim_lines(text: Column) -> Column:
    return py_strip(F.array_join(F.transform(F.split(text, "\n"), py_rstrip), "\n"))


def clean_text(text: Column, patterns=C.BOILERPLATE_PATTERNS) -> Column:
    """Normalize, replace artefacts, drop boilerplate, collapse newlines, trim."""
    return trim_lines(
        collapse_newlines(drop_boilerplate(replace_artefacts(nfc(text)), patterns))
    )
