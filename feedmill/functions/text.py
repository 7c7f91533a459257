"""Text cleaning expressions.

Whitespace means what Python's ``str.strip`` and ``str.split`` mean by it; the
JVM classes ``\\s`` and ``trim`` cover other sets, so the set is spelled out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode whitespace as regex class body and as trim characters.
SPACE_CLASS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same set for the JVM: Latin blanks as single characters and a range test
# in front of the others, so an ordinary letter is ruled out at once.
_JVM_SPACE = (
    r"[\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)
_SPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
SPACE_CHARS = "".join(chr(c) for low, high in _SPACE_RANGES for c in range(low, high + 1))

# Markup, link and emoji patterns.
HTML_PATTERN = r"<[^>]+>"
URL_PATTERN = rf"(?i)https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+"
# Every spelling of ``www.`` ends in one of these; a byte search finds them.
_WWW_ENDS = ("ww.", "WW.", "wW.", "Ww.")
EMOJI_PATTERNS = {
    "reference": (
        # The wide first range takes in symbols, flags and Asian scripts alike.
        r"[\x{24C2}-\x{1F251}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}]+"
    ),
    # Keeps Asian scripts and takes in the newer pictograph blocks.
    "narrow": (
        r"[\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}"
        r"\x{1F1E0}-\x{1F1FF}\x{2600}-\x{27BF}]+"
    ),
}

# Entities in the order in which they are decoded.
ENTITIES = (
    ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
    ("&#39;", "'"), ("&nbsp;", " "), ("&apos;", "'"),
)

# Blocks whose characters are NFC on their own and never join a neighbour.
_NFC_STABLE = (
    r"\x{0}-\x{2FF}\x{2002}-\x{20CF}\x{2190}-\x{2328}\x{3041}-\x{3098}"
    r"\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}\x{1F000}-\x{1FAFF}"
)


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends (linear, unlike an anchored regex)."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def is_blank(col: Column) -> Column:
    return col.isNull() | (strip(col) == "")


def words(col: Column, stripped: bool = False) -> Column:
    """Whitespace-separated tokens, none of them empty; ``stripped`` texts have
    no whitespace at their ends any more."""
    none = F.expr("cast(array() as array<string>)")
    text = col if stripped else strip(col)
    return bind(text, lambda t: F.when(t == "", none).otherwise(F.split(t, _JVM_SPACE + "+")))


def one_if_filled(col: Column) -> Column:
    """Array of the stripped text, empty if it is blank.

    Exploded in the outer form and filtered on the result, it drops blank texts
    while their costly expression runs once; a plain filter would be pushed
    below the projection and run it again.
    """
    return F.filter(F.array(strip(col)), lambda t: t != "")


@lru_cache(maxsize=None)
def _nfc_batch() -> Callable[[Column], Column]:
    # A local function travels to the workers by value: they need not have
    # this package installed.
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return F.pandas_udf(compose, T.StringType())


def nfc(col: Column) -> Column:
    """Unicode NFC. Spark has no such function, so texts that may need it go to
    an Arrow UDF; the UDF sees null for all others, which are NFC already. The
    tests go from cheap to exact: ASCII, Latin letters, all stable blocks."""
    wide = F.octet_length(col) > F.length(col)
    exact = col.rlike(r"[^\x{0}-\x{2FF}]") & col.rlike(rf"[^{_NFC_STABLE}]")
    candidate = F.when(wide & exact, col)
    return F.coalesce(_nfc_batch()(candidate), col)


def bind(col: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of the value of ``col``, which is computed once however often used."""
    return F.transform(F.array(col), fn)[0]


def _has(col: Column, *parts: str) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(col, F.lit(part))
    return found


def _step(col: Column, needed: Callable[[Column], Column], step: Callable[[Column], Column]) -> Column:
    """Run a regex step only on texts that can match: a byte search is far
    cheaper than a scan by the regex engine, and most texts need few steps."""
    return bind(col, lambda t: F.when(needed(t), step(t)).otherwise(t))


def strip_html(col: Column) -> Column:
    """Tags become a blank. Nothing behind the last ``>`` can match, and a search
    there would run to the end of the text from every ``<``."""

    def strip_tags(text: Column) -> Column:
        tail = F.substring_index(text, ">", -1)
        head = F.substr(text, F.lit(1), F.length(text) - F.length(tail))
        return F.concat(F.regexp_replace(head, HTML_PATTERN, " "), tail)

    return _step(col, lambda t: _has(t, "<") & _has(t, ">"), strip_tags)


def strip_urls(col: Column) -> Column:
    return _step(
        col,
        lambda t: _has(t, "://", *_WWW_ENDS),
        lambda t: F.regexp_replace(t, URL_PATTERN, " "),
    )


def strip_emoji(col: Column, emoji_class: str = "reference") -> Column:
    pattern = EMOJI_PATTERNS[emoji_class]
    return _step(col, lambda t: F.octet_length(t) > F.length(t), lambda t: F.regexp_replace(t, pattern, " "))


def decode_entities(col: Column) -> Column:
    """Ordered replacement: a decoded ``&`` can form the next entity."""

    def decode(text: Column) -> Column:
        for entity, char in ENTITIES:
            text = F.replace(text, F.lit(entity), F.lit(char))
        return text

    return _step(col, lambda t: _has(t, "&"), decode)


def collapse_punct(col: Column) -> Column:
    """Runs of three or more of one mark become a single mark."""
    runs = [mark * 3 for mark in "!?.,;:-"]
    return _step(
        col, lambda t: _has(t, *runs), lambda t: F.regexp_replace(t, r"([!?.,;:-])\1{2,}", "$1")
    )


def collapse_spaces(col: Column) -> Column:
    return _step(col, lambda t: _has(t, "  "), lambda t: F.regexp_replace(t, " {2,}", " "))


def collapse_newlines_strip(col: Column) -> Column:
    runs = _step(col, lambda t: _has(t, "\n\n\n"), lambda t: F.regexp_replace(t, "\n{3,}", "\n\n"))
    return strip(runs)


def normalize_text(col: Column, emoji_class: str = "reference") -> Column:
    """All cleaning steps in their order; null becomes the empty text."""
    col = strip_urls(strip_html(nfc(F.coalesce(col, F.lit("")))))
    col = strip_emoji(col, emoji_class)
    return collapse_newlines_strip(collapse_spaces(collapse_punct(decode_entities(col))))


def truncate_bytes(col: Column, limit: int = 5000) -> Column:
    """The longest prefix of at most ``limit`` UTF-8 bytes made of whole characters."""
    cut = F.substring(F.encode(col, "UTF-8"), 1, limit).cast("string")
    # Only a broken last character makes the cut invalid; repair turns it into
    # replacement characters at the end, which then go.
    repaired = F.regexp_replace(F.make_valid_utf8(cut), r"\x{FFFD}$", "")
    return (
        F.when(F.octet_length(col) <= limit, col)
        .when(F.is_valid_utf8(cut), cut)
        .otherwise(repaired)
    )


def decode_utf8(content: Column) -> Column:
    """Bytes to text, bad bytes replaced."""
    return F.make_valid_utf8(content.cast("string"))
