"""Unicode tables: the few fixed ones, and the ones built from a rule.

Spark has no normalization builtin.  Text is therefore split by a cheap gate:

* ASCII text needs no work;
* text made only of *plain* characters - NFKC leaves them alone and dropping
  accents maps each to one character - is handled by ``translate`` in the JVM;
* only the rest crosses to an Arrow UDF.

A character missing from the plain set costs time, never correctness, because
the UDF gives the exact answer for any text.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# The few functions that run in Python workers travel with the job, so the
# package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FORMS = StructType().add("nfkc", StringType()).add("plain", StringType())

# Look-alike character -> Latin letter.
CONFUSABLES: dict[str, str] = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i",
    "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ɡ": "g", "м": "m", "т": "t",
    "н": "h", "в": "b", "к": "k", "А": "a", "В": "b", "Е": "e", "К": "k", "М": "m",
    "Н": "h", "О": "o", "Р": "p", "С": "c", "Т": "t", "Х": "x", "І": "i", "Ѕ": "s",
    "Ј": "j", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Β": "b", "Ε": "e", "Η": "h", "Ι": "i",
    "Κ": "k", "Μ": "m", "Ν": "n", "Ο": "o", "Ρ": "p", "Τ": "t", "Χ": "x", "ı": "i",
    "ł": "l", "ƿ": "p", "ɐ": "a",
}

# Character classes, in a notation Java and RE2 both read.
INVISIBLE = (
    r"\x{AD}\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}"
    r"\x{2060}-\x{2064}\x{206A}-\x{206F}\x{FEFF}\x{E0000}-\x{E007F}"
)
ISOLATES = r"\x{2066}-\x{2069}"
BIDI = r"\x{200E}\x{200F}\x{202A}-\x{202E}\x{2066}-\x{2069}"
ZERO_WIDTH = (
    r"\x{AD}\x{180E}\x{200B}-\x{200D}\x{2060}-\x{2064}\x{FEFF}\x{E0000}-\x{E007F}"
)
CONTROLS = r"\x{00}-\x{1F}\x{7F}-\x{9F}"
MARKS = r"\x{300}-\x{36F}"
# Whitespace that is not the plain space.
ASCII_WIDE_SPACE = r"\x{09}-\x{0D}"
WIDE_SPACE = (
    r"\x{09}-\x{0D}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}\x{FEFF}"
)
SPACE = r"\x{20}" + WIDE_SPACE


def python_class(spec: str) -> str:
    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), spec)


_MARKS = re.compile("[\u0300-\u036f]+")


def strip_accents_of(char: str) -> str:
    """NFD without U+0300-U+036F, for one character or a whole text."""
    return _MARKS.sub("", unicodedata.normalize("NFD", char))


def _is_plain(code: int) -> bool:
    char = chr(code)
    return (
        not 0xD800 <= code <= 0xDFFF
        and unicodedata.combining(char) == 0
        # vowel and tail jamo and a few spacing marks join the character before
        and unicodedata.category(char) not in ("Mc", "Mn", "Me", "Cn")
        and not 0x1100 <= code <= 0x11FF
        and unicodedata.normalize("NFKC", char) == char
        and len(strip_accents_of(char)) == 1
    )


@functools.lru_cache(maxsize=1)
def plain_class() -> str:
    """Regex class of plain characters.

    Built by rule: runs of plain characters in the general scripts below
    U+0530 and in general punctuation, and the long runs above, so the class
    stays short enough to be quick.
    """
    runs: list[tuple[int, int]] = []
    start = None
    for code in range(0x0, 0x2FA20):
        if _is_plain(code):
            start = code if start is None else start
        elif start is not None:
            runs.append((start, code - 1))
            start = None
    keep = [
        (a, b)
        for a, b in runs
        if a < 0x530 or 0x2000 <= a < 0x2100 or b - a >= 127
    ]
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in keep)


@functools.lru_cache(maxsize=1)
def accent_table() -> dict[str, str]:
    """Plain character -> its base, for every one that carries an accent."""
    table = {}
    for code in range(0x80, 0x2FA20):
        if _is_plain(code):
            base = strip_accents_of(chr(code))
            if base != chr(code):
                table[chr(code)] = base
    return table


def is_ascii(text: Column) -> Column:
    """One byte per character; both lengths are counted without decoding."""
    return F.octet_length(text) == F.char_length(text)


def needs_unicode(text: Column) -> Column:
    """True where only full normalization gives the right answer.

    The lookahead settles ASCII and the Latin-1 letters first, since Java
    walks a long class range by range.
    """
    return ~is_ascii(text) & text.rlike(
        r"(?![\x{00}-\x{9F}\x{C0}-\x{FF}])[^" + plain_class() + "]"
    )


def for_python(text: Column, wanted: Column) -> Column:
    """Input of an Arrow function: null where it is not wanted, never bad bytes.

    Bytes that are no UTF-8 would fail the task; they cross as U+FFFD.
    """
    return F.when(wanted, F.make_valid_utf8(text))


def translate(text: Column, table: dict[str, str]) -> Column:
    return F.translate(text, "".join(table), "".join(table.values()))


_INVISIBLE = re.compile("[" + python_class(INVISIBLE) + "]")
_FOLD = str.maketrans(CONFUSABLES)


def plain_form(text: str) -> str:
    """Text composed, stripped, folded and without accents."""
    visible = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    return strip_accents_of(visible.translate(_FOLD))


@F.pandas_udf(_FORMS)
def unicode_forms(texts: pd.Series) -> pd.DataFrame:
    """NFKC form, and the plain form."""
    rows = [
        (None, None)
        if text is None
        else (unicodedata.normalize("NFKC", text), plain_form(text))
        for text in texts
    ]
    return pd.DataFrame(rows, columns=["nfkc", "plain"])


@F.pandas_udf(StringType())
def plain_forms(texts: pd.Series) -> pd.Series:
    return texts.map(plain_form, na_action="ignore")


@F.pandas_udf(StringType())
def accentless(texts: pd.Series) -> pd.Series:
    return texts.map(strip_accents_of, na_action="ignore")


@F.pandas_udf(StringType())
def compose_compatibility(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")
