"""Text columns: normalization for cue matching, safe echo, lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperward.functions import unicode as U

# Characters echoed from a payload and from a field name.
MAX_PAYLOAD_CHARS = 200
MAX_NAME_CHARS = 80

# Settles Latin letters before a long class is walked; the soft hyphen is none.
_NOT_LATIN = r"(?![\x{00}-\x{AC}\x{AE}-\x{FF}])"

OBFUSCATIONS = ("bidi-control", "compatibility-form", "confusable", "zero-width")


def nfkc(text: Column) -> Column:
    return F.coalesce(
        U.compose_compatibility(U.for_python(text, U.needs_unicode(text))), text
    )


def strip_invisible(text: Column, strip_isolates: bool = False) -> Column:
    """Drop characters that carry no ink.

    U+2065-U+2069 stay unless ``strip_isolates`` is set: they raise the bidi
    flag but are not part of the stripped class.
    """
    spec = U.INVISIBLE + (U.ISOLATES if strip_isolates else "")
    return F.when(U.is_ascii(text), text).otherwise(
        F.regexp_replace(text, f"[{spec}]", "")
    )


def fold_confusables(text: Column) -> Column:
    return F.when(U.is_ascii(text), text).otherwise(U.translate(text, U.CONFUSABLES))


def deaccent(text: Column) -> Column:
    """NFD without U+0300-U+036F."""
    hard = U.accentless(U.for_python(text, U.needs_unicode(text)))
    easy = F.when(U.is_ascii(text), text).otherwise(
        U.translate(text, U.accent_table())
    )
    return F.coalesce(hard, easy)


def collapse_whitespace(text: Column, also: str = "") -> Column:
    """Runs of whitespace (and of the class ``also``) to one space, trimmed.

    Single plain spaces, nearly all matches of a naive pattern, are left in
    place: a match needs another kind of space or two in a row.
    """
    def runs(wide: str) -> Column:
        return F.regexp_replace(
            text, rf"\x20*[{wide}][\x20{wide}]*|\x20{{2,}}", " "
        )

    # the short class is three times quicker, and enough for most text
    return F.btrim(
        F.when(U.is_ascii(text), runs(U.ASCII_WIDE_SPACE + also)).otherwise(
            runs(U.WIDE_SPACE + also)
        )
    )


def obfuscation_flags(raw: Column, composed: Column) -> Column:
    """Sorted evasions of ``raw``, given its NFKC form ``composed``."""
    # look-alikes are never invisible, so the strip need not come first
    look_alikes = "".join(U.CONFUSABLES)
    flags = F.array(
        F.when(composed.rlike(f"{_NOT_LATIN}[{U.BIDI}]"), OBFUSCATIONS[0]),
        F.when(composed != raw, OBFUSCATIONS[1]),
        F.when(composed.rlike(f"{_NOT_LATIN}[{look_alikes}]"), OBFUSCATIONS[2]),
        F.when(composed.rlike(f"{_NOT_LATIN}[{U.ZERO_WIDTH}]"), OBFUSCATIONS[3]),
    )
    none = F.array().cast("array<string>")
    # most accented text holds nothing of the kind, which one search tells
    odd = composed.rlike(f"{_NOT_LATIN}[{look_alikes}{U.BIDI}{U.ZERO_WIDTH}]")
    return (
        F.when(U.is_ascii(raw), none)
        .when(odd, F.array_compact(flags))
        .when(composed != raw, F.array(F.lit(OBFUSCATIONS[1])))
        .otherwise(none)
    )


def folded_text(raw: Column, plain: Column) -> Column:
    """Text stripped, folded, without accents, in lower case.

    ``plain`` holds the UDF's answer, or null where the JVM can do it alone.
    """
    # One pass does both steps: folding yields ASCII, which has no accents, and
    # dropping an accent happens after folding, so its result is never folded.
    both = {**U.accent_table(), **U.CONFUSABLES}
    visible = F.regexp_replace(raw, f"{_NOT_LATIN}[{U.INVISIBLE}]", "")
    easy = F.when(U.is_ascii(raw), raw).otherwise(U.translate(visible, both))
    return F.lower(F.coalesce(plain, easy))


def safe_payload(raw: Column, limit: int = MAX_PAYLOAD_CHARS) -> Column:
    """Text that is safe to show: no invisibles, no controls, cut short."""
    return cut_utf16(collapse_whitespace(strip_invisible(raw), U.CONTROLS), limit)


def cut_utf16(text: Column, limit: int) -> Column:
    """First ``limit`` UTF-16 units; a pair split by the cut is dropped whole."""
    units = F.encode(text, "UTF-16BE")
    last = F.conv(F.hex(F.substring(units, 2 * limit - 1, 1)), 16, 10).cast("int")
    kept = F.when(last.between(0xD8, 0xDB), limit - 1).otherwise(limit)
    astral = utf16_length(text) > F.char_length(text)
    return F.when(
        astral, F.decode(F.substring(units, F.lit(1), 2 * kept), "UTF-16BE")
    ).otherwise(F.substring(text, 1, limit))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, the length a JSON consumer in a browser sees."""
    wide = (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint")
    return F.when(U.is_ascii(text), F.octet_length(text).cast("bigint")).otherwise(wide)


def safe_filename(name: Column) -> Column:
    """Name that cannot leave a quoted header value."""
    return F.regexp_replace(name, '["\r\n]', "_")
