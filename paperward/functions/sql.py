"""Names for use in SQL text: native SQL functions over column expressions.

``CREATE TEMPORARY FUNCTION ... RETURN`` bodies in Spark's own SQL, so a query that calls
them is planned and compiled as if it had spelt the rules out.  Only text that needs full
Unicode normalization crosses to Python; the one function that does it gets nulls else.
"""

from __future__ import annotations

import ipaddress
import json

from pyspark.sql import SparkSession

from paperward.functions import cues as C
from paperward.functions import lexicon as L
from paperward.functions import net as N
from paperward.functions import text as T
from paperward.functions import unicode as U


def _text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _replaced(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {_text(pattern)}, {_text(by)})"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _functions() -> dict[str, str]:
    """Signature and body of each function, in an order in which each calls earlier ones."""
    def ascii_(t: str) -> str:
        return f"(octet_length({t}) = char_length({t}))"

    plain = r"(?![\x{00}-\x{9F}\x{C0}-\x{FF}])[^" + U.plain_class() + "]"
    table = {**U.accent_table(), **U.CONFUSABLES}
    visible = _replaced("t", f"{T._NOT_LATIN}[{U.INVISIBLE}]")
    folded = f"translate({visible}, {_text(''.join(table))}, {_text(''.join(table.values()))})"
    tail = f"paperward_plain_form(CASE WHEN NOT {ascii_('t')} AND t RLIKE {_text(plain)} THEN make_valid_utf8(t) END)"

    def spaced(wide: str) -> str:
        return _replaced("x", rf"\x20*[{wide}][\x20{wide}]*|\x20{{2,}}", " ")

    stems = [
        {"stem": stem, "cues": [{"category": c, "phrase": p} for c, p in group]} for stem, group in C._compiled()
    ]
    lexicon = f"from_json({_text(json.dumps(stems, ensure_ascii=False))}, {_text(C._STEM_TABLE)})"
    opens, person = C.imperative_patterns()
    strong = ", ".join(_text(c) for c in L.HIGH_CONFIDENCE)

    def lies_in(networks, number) -> str:
        nets = [ipaddress.ip_network(n) for n in networks]
        return "(" + " OR ".join(f"n BETWEEN {number(int(n[0]))} AND {number(int(n[-1]))}" for n in nets) + ")"

    graded = (
        f"CASE WHEN size(c) >= 2 THEN named_struct('categories', c, 'confidence', {_text(L.CONFIDENT)})"
        f" WHEN get(c, 0) IN ({strong}) THEN named_struct('categories', c, 'confidence', {_text(L.TENTATIVE)})"
        " ELSE named_struct('categories', CAST(NULL AS ARRAY<STRING>), 'confidence', CAST(NULL AS STRING)) END"
    )
    found = (
        f"concat(array_distinct(transform(filter(flatten(transform(filter({lexicon}, g -> contains(x, g.stem)), g -> g.cues)),"
        f" c -> contains(x, c.phrase)), c -> c.category)), CASE WHEN x RLIKE {_text(opens)} AND x RLIKE {_text(person)}"
        f" THEN array({_text(L.IMPERATIVE)}) ELSE CAST(array() AS ARRAY<STRING>) END)"
    )
    return {
        "paperward_folded(t STRING) RETURNS STRING":
            f"lower(coalesce({tail}, CASE WHEN {ascii_('t')} THEN t ELSE {folded} END))",
        "normalize_text(t STRING) RETURNS STRING": _let(
            "paperward_folded(t)", "x",
            f"btrim(CASE WHEN {ascii_('x')} THEN {spaced(U.ASCII_WIDE_SPACE)} ELSE {spaced(U.WIDE_SPACE)} END)",
        ),
        "classify_injection(t STRING) RETURNS STRUCT<categories: ARRAY<STRING>, confidence: STRING>":
            _let(f"array_sort({_let('normalize_text(t)', 'x', found)})", "c", graded),
        "paperward_v4_number(t STRING) RETURNS BIGINT":
            f"CASE WHEN t RLIKE {_text(N._V4)} THEN aggregate(split(t, {_text(chr(92) + '.')}), 0L, (n, o) -> n * 256 + CAST(o AS BIGINT)) END",
        "paperward_groups(t STRING) RETURNS ARRAY<STRING>":
            "CASE WHEN t = '' THEN CAST(array() AS ARRAY<STRING>) ELSE split(t, ':', -1) END",
        "paperward_filled(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS ARRAY<STRING>":
            "CASE WHEN size(a) + size(b) < 8 THEN concat(a, array_repeat('0', 8 - size(a) - size(b)), b) END",
        # groups of an address without an embedded version 4 tail, those left out put back
        "paperward_v6_groups(t STRING) RETURNS ARRAY<STRING>":
            "CASE size(split(t, '::', -1)) WHEN 1 THEN paperward_groups(t) WHEN 2 THEN paperward_filled("
            "paperward_groups(get(split(t, '::', -1), 0)), paperward_groups(get(split(t, '::', -1), 1))) END",
        "paperward_v6_plain(t STRING) RETURNS STRING":
            "CASE WHEN NOT contains(t, '.') THEN t ELSE regexp_extract(t, '^(.*:)[^:]*$', 1) || regexp_replace("
            "lpad(lower(hex(paperward_v4_number(substring_index(t, ':', -1)))), 8, '0'), '^(.{4})', '$1:') END",
        "paperward_v6_hex(t STRING) RETURNS STRING": _let(
            "paperward_v6_groups(paperward_v6_plain(t))", "g",
            "CASE WHEN size(g) = 8 AND forall(g, x -> x RLIKE '^[0-9a-fA-F]{1,4}$')"
            " THEN array_join(transform(g, x -> lpad(lower(x), 4, '0')), '') END",
        ),
        "paperward_blocked_v4(t BIGINT) RETURNS BOOLEAN": _let("t", "n", lies_in(N.BLOCKED_V4, lambda n: f"{n}L")),
        "paperward_blocked_v6(t STRING) RETURNS BOOLEAN": _let(
            "t", "n",
            f"CASE WHEN startswith(n, {_text(N.MAPPED_V4)}) THEN {_let('CAST(conv(substring(n, 25, 8), 16, 10) AS BIGINT)', 'n', lies_in(N.BLOCKED_V4, lambda n: f'{n}L'))}"
            f" ELSE {lies_in(N.BLOCKED_V6, lambda n: _text(f'{n:032x}'))} END",
        ),
        "paperward_blocked(t STRING) RETURNS BOOLEAN":
            "CASE WHEN contains(t, ':') THEN paperward_blocked_v6(paperward_v6_hex(t)) ELSE paperward_blocked_v4(paperward_v4_number(t)) END",
        "is_blocked_ip(ip STRING) RETURNS BOOLEAN": "coalesce(paperward_blocked(substring_index(ip, '%', 1)), true)",
    }


def register(spark: SparkSession) -> None:
    """Register ``normalize_text``, ``classify_injection``, ``is_blocked_ip`` and their parts."""
    spark.udf.register("paperward_plain_form", U.plain_forms)
    for signature, body in _functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
