"""The main text of an HTML page.

Pages are read in two ways with one result. A page of plain markup (whole tags
with plain attributes, comments, complete character references) is cut into
tokens by one scan of a regular expression, and a short loop follows what is
open. Any other page, one in which the scan meets something else, goes through
the tolerant parser, which is several times slower.
"""

import re
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docsheaf import constants as C

# elements that have no content and no end tag
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# elements whose text is not shown as text, even where the element is kept
HIDDEN = frozenset(["template", "rt", "rp"])


def named_character(name: str) -> str:
    return html5.get(name + ";", "&" + name)


def numbered_character(name: str) -> str:
    code = int(name[1:], 16) if name[:1] in "xX" else int(name)
    try:
        # numbers below 256 are often meant as Windows-1252
        return bytes([code]).decode("cp1252") if code < 256 else chr(code)
    except (ValueError, OverflowError):
        return chr(code) if code < 256 else "\N{REPLACEMENT CHARACTER}"


class MainText(HTMLParser):
    """Collects text nodes per region while reading tags once, without a tree.

    A text node ends at any tag, comment or declaration. Closing a tag also
    closes whatever is still open inside it; a stray end tag closes nothing.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.open = []        # names of open elements, outermost first
        self.count = Counter()  # how often each name is open
        self.ignored = 0      # how many of them are noise or hidden
        self.noise = 0        # how many of them are noise
        self.piece = []
        self.texts = {"": []}  # region -> text nodes; "" is the whole page
        self.inside = {}      # region -> depth of its first element while open
        self.void_open = Counter()  # void elements seen without an end tag

    def end_text(self):
        text = "".join(self.piece).strip()
        self.piece.clear()
        if text and not self.ignored:
            for region in ("", *self.inside):
                self.texts[region].append(text)

    def handle_data(self, data):
        self.piece.append(data)

    def handle_entityref(self, name):
        self.piece.append(named_character(name))

    def handle_charref(self, name):
        self.piece.append(numbered_character(name))

    def handle_starttag(self, tag, attrs):
        self.end_text()
        if tag in VOID:
            self.void_open[tag] += 1
            return
        if tag in C.MAIN_REGIONS and not self.noise and tag not in self.texts:
            self.texts[tag] = []
            self.inside[tag] = len(self.open)
        self.open.append(tag)
        self.count[tag] += 1
        self.noise += tag in C.NOISE_TAGS
        self.ignored += tag in C.NOISE_TAGS or tag in HIDDEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in VOID:
            self.void_open[tag] -= 1
        else:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.void_open[tag]:
            self.void_open[tag] -= 1
            return
        self.end_text()
        if not self.count[tag]:
            return
        while True:
            closed = self.open.pop()
            self.count[closed] -= 1
            self.noise -= closed in C.NOISE_TAGS
            self.ignored -= closed in C.NOISE_TAGS or closed in HIDDEN
            if self.inside.get(closed) == len(self.open):
                del self.inside[closed]
            if closed == tag:
                return

    def handle_comment(self, data):
        self.end_text()

    handle_decl = unknown_decl = handle_pi = handle_comment

    def result(self) -> str:
        self.close()
        self.end_text()
        region = next((r for r in C.MAIN_REGIONS if r in self.texts), "")
        return "\n".join(self.texts[region])


def main_text(html: str) -> str:
    parser = MainText()
    try:
        parser.feed(html)
        return parser.result()
    except (AssertionError, ValueError, RecursionError):
        return html


# --- pages of plain markup -----------------------------------------------------------

_NAME = "[a-zA-Z][a-zA-Z0-9]*"
_ATTRIBUTES = r"""(?:\s+[a-zA-Z][a-zA-Z0-9_:-]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>=`/]+))?)*\s*"""
#: Elements whose content is not read as markup.
RAW, TEXT_ONLY = ("script", "style"), ("title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext")
#: Those of the latter in which character references count.
REFERENCES = ("title", "textarea")
_TOKEN = re.compile(
    rf"""(?P<text>[^<]+)
    |<(?P<raw>{"|".join(RAW)})(?:{_ATTRIBUTES})>[^<]*(?:<(?!!|/(?P=raw))[^<]*)*</(?P=raw)\s*>
    |<(?P<only>{"|".join(TEXT_ONLY)})(?:{_ATTRIBUTES})>(?P<inside>[^<]*)</(?P=only)\s*>
    |<(?P<end>/?)(?P<tag>{_NAME})(?P<rest>{_ATTRIBUTES})(?P<single>/?)>
    |<!--(?:[^<>-]|-(?!-))*-->
    |<!doctype[^<>\[\]]*>
    |(?P<other><)""".replace("\n    ", ""),
    re.IGNORECASE,
)
_PLAIN_REFERENCES = re.compile(rf"(?:[^&]|&{_NAME};|&\#[0-9]+;|&\#[xX][0-9a-fA-F]+;|&(?=\s))*")
_REFERENCE = re.compile(rf"&(?:({_NAME})|\#([0-9]+|[xX][0-9a-fA-F]+));")
_SPECIAL = frozenset((*RAW, *TEXT_ONLY))
_NOISE, _REGIONS = frozenset(C.NOISE_TAGS), frozenset(C.MAIN_REGIONS)
_IGNORED = _NOISE | HIDDEN


def _shown(match) -> str:
    name, number = match.groups()
    return named_character(name) if name else numbered_character(number)


def plain_text(html: str) -> str | None:
    """The main text of a page of plain markup, none for any other page."""
    texts, inside, opened, noise, ignored = {"": []}, {}, [], 0, 0
    for text, _, only, content, end, tag, rest, single, other in _TOKEN.findall(html):
        if text or only:
            if only:
                name = only.lower()
                if name in _NOISE or not content:
                    continue
                if "&" in content and name not in REFERENCES:
                    return None
                text = content
            if ignored:
                continue
            if "&" in text:
                if not _PLAIN_REFERENCES.fullmatch(text):
                    return None
                text = _REFERENCE.sub(_shown, text)
            text = text.strip()
            if text:
                texts[""].append(text)
                for region in inside:
                    texts[region].append(text)
        elif tag:
            tag = tag.lower()
            if tag in _SPECIAL or end and (rest.strip() or single or tag in VOID):
                return None
            if tag in VOID:
                continue
            if single:
                return None
            if not end:
                if tag in _REGIONS and not noise and tag not in texts:
                    texts[tag] = []
                    inside[tag] = len(opened)
                opened.append(tag)
                if tag in _IGNORED:
                    ignored += 1
                    noise += tag in _NOISE
            elif tag in opened:
                while True:
                    closed = opened.pop()
                    if closed in _IGNORED:
                        ignored -= 1
                        noise -= closed in _NOISE
                    if inside.get(closed) == len(opened):
                        del inside[closed]
                    if closed == tag:
                        break
        elif other:
            return None
    return "\n".join(texts[next((r for r in C.MAIN_REGIONS if r in texts), "")])


def page_text(html: str) -> str:
    text = plain_text(html)
    return main_text(html) if text is None else text


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(page_text, na_action="ignore")


def html_main_text(html: Column) -> Column:
    """Text of the first article, else main, else body, else the whole page.

    Null stays null, so a caller gates the work by gating the input.
    """
    return _main_text(html)
