import re
import unicodedata

from pyspark.sql import functions as F

from docsheaf.functions import text as T
from docsheaf.functions import tokens


def test_whitespace_is_pythons(texts):
    chars = [chr(c) for c in range(0x3101)] + ["﻿", "\U0001f600"]
    spaces = [c.isspace() for c in chars]
    assert texts(lambda t: F.rlike(t, F.lit(f"^{T.WS}$")), chars) == spaces
    assert texts(T.is_blank, chars) == spaces
    wrapped = [f"{c}a{c}b{c}" for c in chars]
    assert texts(T.py_strip, wrapped) == [w.strip() for w in wrapped]
    assert texts(T.py_rstrip, wrapped) == [w.rstrip() for w in wrapped]


def test_stable_characters_cannot_change_under_nfc():
    second = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(int(parts[1], 16))
    for low, high in re.findall(r"\\x\{(\w+)\}-\\x\{(\w+)\}", T.NFC_STABLE):
        for code in range(int(low, 16), int(high, 16) + 1):
            char = chr(code)
            assert unicodedata.combining(char) == 0
            assert unicodedata.is_normalized("NFC", char)
            assert code not in second


def test_nfc(texts):
    values = ["plain", "é", "é", "가", "Å", "q̣̇", "日本か゚", "", None]
    expected = [v and unicodedata.normalize("NFC", v) for v in values]
    expected[-2] = ""
    assert texts(T.nfc, values) == expected


def test_artefacts(texts):
    given = ["‘a’ “b” – — c d​e﻿", "a\r\nb\rc\n\rd", "\r\r\n"]
    assert texts(T.replace_artefacts, given) == ["'a' \"b\" - -- c de", "a\nb\nc\n\nd", "\n\n"]


def test_boilerplate_lines(texts):
    dropped = [
        "Please accept cookies", "ACCEPTING ALL COOKIES now", "Subscribe to our newsletter!",
        "subscribe to newsletter", "Sign up for our free newsletter", "sign up for newsletter",
        "© 2024 ACME. All Rights Reserved.", "©2024 all rights reserved",
        "© ٢٠٢٤ all rights reserved", "© 2024 x\u2028y all rights reserved",
        "© 2024 x\x85y all rights reserved", "Privacy Policy | Terms", "privacy policy·terms of use",
        "privacy policy\x1c|\x1fterms", "Share this article", "share post", "SHARE PAGE", "Follow us on X",
        "an advertisement inside a long paragraph", "skip to main content", "Skip to navigation",
        "Read also: that", "READ MORE- that", "adverti\u017fement", "\u017fhare post",
    ]
    kept = [
        "accept  all cookies", "accepts cookies", "© 24 all rights reserved", "privacy policy terms",
        "share that article", "follow us", "read more about it", "skip to the content", "plain",
    ]
    assert texts(T.drop_boilerplate, dropped) == [""] * len(dropped)
    assert texts(T.drop_boilerplate, kept) == kept
    mixed = "one\n advertisement \ntwo\n\nfollow us on\n"
    assert texts(T.drop_boilerplate, [mixed]) == ["one\ntwo\n\n"]
    # a match must lie within one line
    assert texts(T.drop_boilerplate, ["© 2024 x\nall rights reserved"]) == ["© 2024 x\nall rights reserved"]


def test_own_boilerplate_patterns(texts):
    given = ["foo\nbar\nbaz", "Kilo\nx"]
    assert texts(lambda t: T.drop_boilerplate(t, ["foo|bar"]), given) == ["baz", "Kilo\nx"]
    assert texts(lambda t: T.drop_boilerplate(t, ["kilo"]), given) == ["foo\nbar\nbaz", "x"]
    assert texts(lambda t: T.drop_boilerplate(t, [r"\d?ba"]), given) == ["foo", "Kilo\nx"]
    assert texts(lambda t: T.drop_boilerplate(t, []), given) == given


def test_newlines_collapse_before_trimming(texts):
    assert texts(T.collapse_newlines, ["a\n\n\n\nb\n\nc", "a\n \n \n \nb"]) == [
        "a\n\nb\n\nc", "a\n \n \n \nb",
    ]
    assert texts(T.clean_text, ["a\n \n \n \nb  \n\n\n\n c \t"]) == ["a\n\n\n\nb\n\n c"]


def test_clean_text(texts):
    given = ["﻿ “Hi”\r\nShare this post\r\n\r\n\r\n\r\ncafé — ok \r\n", "   ", "advertisement", ""]
    assert texts(T.clean_text, given) == ['"Hi"\n\ncafé -- ok', "", "", ""]


def test_token_estimate(spark, texts):
    given = ["", "  ", "one", "a b", " a\x1cb　c\n\nd ", "w " * 100]
    counts = [len(g.split()) for g in given]
    assert texts(tokens.word_count, given) == counts
    assert texts(tokens.estimate_tokens, given) == [int(n * 1.33) for n in counts]
    ns = spark.range(5000).select("id", F.floor(F.col("id") * F.lit(1.33).cast("double")).alias("t"))
    assert [r.t for r in ns.orderBy("id").collect()] == [int(n * 1.33) for n in range(5000)]
