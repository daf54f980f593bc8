"""Pieces of the checking SQL, written independently of the Spark columns."""

from __future__ import annotations

from collections.abc import Sequence

from paperward.functions import lexicon as L
from paperward.functions import unicode as U
from paperward.queries import planted as P


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(key: str, values: Sequence[str]) -> str:
    return f"[{', '.join(lit(v) for v in values)}][CAST(({key}) % {len(values)} + 1 AS INT)]"


def planted(text: str, key: str) -> str:
    return f"({text} || chr(10) || {pick(key, P.CUE_PLANTS)})"


# Compatibility forms the inputs hold: fullwidth ASCII and two wide spaces.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + " 　"
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F)) + "  "


def composed(x: str) -> str:
    return f"translate(nfc_normalize({x}), {lit(_WIDE)}, {lit(_NARROW)})"


def stripped(x: str) -> str:
    return f"regexp_replace({x}, '[{U.INVISIBLE}]', '', 'g')"


def folded(x: str) -> str:
    return (
        f"translate({x}, {lit(''.join(U.CONFUSABLES))},"
        f" {lit(''.join(U.CONFUSABLES.values()))})"
    )


def collapsed(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{U.SPACE}]+', ' ', 'g'), ' ')"


def normalized(x: str) -> str:
    return collapsed(f"lower(strip_accents({folded(stripped(composed(x)))}))")


def flags(x: str) -> str:
    c = composed(x)
    look_alike = "[" + "".join(U.CONFUSABLES) + "]"
    parts = ", ".join([
        f"CASE WHEN regexp_matches({c}, '[{U.BIDI}]') THEN 'bidi-control' END",
        f"CASE WHEN {c} <> {x} THEN 'compatibility-form' END",
        f"CASE WHEN regexp_matches({stripped(c)}, '{look_alike}') THEN 'confusable' END",
        f"CASE WHEN regexp_matches({c}, '[{U.ZERO_WIDTH}]') THEN 'zero-width' END",
    ])
    return f"concat_ws(',', {parts})"


def payload(x: str, limit: int) -> str:
    spaced = f"regexp_replace({stripped(x)}, '[{U.CONTROLS}]', ' ', 'g')"
    return f"substr({collapsed(spaced)}, 1, {limit})"


def utf16_length(x: str) -> str:
    return (
        f"CAST(length({x}) + length(regexp_replace({x},"
        r" '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS BIGINT)"
    )


def lexicon() -> str:
    rows = ", ".join(f"({lit(c)}, {lit(p)})" for c, _, p in L.phrases())
    return f"(VALUES {rows}) lexicon(category, phrase)"


def imperative(t: str) -> str:
    verbs = ", ".join(lit(v) for v in dict.fromkeys(L.IMPERATIVE_VERBS))
    person = "|".join(L.SECOND_PERSON)
    first = r"regexp_extract(c, '^[ \"''(\[]*([a-z]+)', 1)".replace('\\"', '"')
    return (
        rf"(regexp_matches({t}, '\b({person})\b') AND len(list_filter("
        rf"regexp_split_to_array({t}, '[.!?;:\n|]+'), lambda c: {first} IN ({verbs}))) > 0)"
    )


def classified(source: str, key: str, value: str) -> str:
    """CTEs ``norm``, ``hits`` and ``matched`` over ``source``."""
    return f"""
    src AS (SELECT *, {value} AS v FROM {source}),
    norm AS (SELECT {key}, v, {normalized('v')} AS t FROM src),
    hits AS (
        SELECT DISTINCT {key}, category FROM norm JOIN {lexicon()} ON contains(t, phrase)
        UNION SELECT {key}, 'imperative-address' FROM norm WHERE {imperative('t')}),
    cats AS (
        SELECT {key}, string_agg(category, ',' ORDER BY category) AS categories,
               count(*) AS n FROM hits GROUP BY {key}),
    matched AS (
        SELECT norm.{key}, v, t, coalesce(categories, '') AS categories,
               CASE WHEN n >= 2 THEN 'confident'
                    WHEN categories IN ('delimiter-mimicry', 'role-address')
                    THEN 'tentative' END AS confidence
        FROM norm LEFT JOIN cats ON norm.{key} = cats.{key})"""
