"""URL and IP address columns.

Addresses are compared as lower-case hex of their bytes: 8 digits for v4, 32
for v6, so one string range test serves both and sorts like the number.
"""

from __future__ import annotations

import functools
import ipaddress
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperward.functions import unicode

# Networks a document fetch must never reach.  IPv4-mapped IPv6
# addresses are judged as the IPv4 address they carry.
BLOCKED_V4 = """
0.0.0.0/8 10.0.0.0/8 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.168.0.0/16
100.64.0.0/10 192.0.0.0/24 192.0.2.0/24 198.18.0.0/15 198.51.100.0/24
203.0.113.0/24 224.0.0.0/3
""".split()
BLOCKED_V6 = "::/96 fe80::/10 fc00::/7 ff00::/8".split()
MAPPED_V4 = "00000000000000000000ffff"

ALLOWED_SCHEMES = ("http", "https")
MAX_REDIRECTS = 5

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- addresses --------------------------------------------------------------


def bare_address(ip: Column) -> Column:
    """Address without its zone (``fe80::1%en0``)."""
    return F.substring_index(ip, "%", 1)


def v4_number(ip: Column) -> Column:
    """A dotted address as a number, null where it is none."""
    number = F.aggregate(
        F.split(ip, r"\."),
        F.lit(0).cast("bigint"),
        lambda n, octet: n * 256 + octet.cast("bigint"),
    )
    return F.when(ip.rlike(_V4), number)


def _v4_hex(ip: Column) -> Column:
    return F.lpad(F.lower(F.hex(v4_number(ip))), 8, "0")


def _v6_hex(ip: Column) -> Column:
    def groups(part: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.when(part == "", none).otherwise(F.split(part, ":", -1))

    def joined(text: Column) -> Column:
        halves = F.split(text, "::", -1)
        head, tail = groups(F.get(halves, F.lit(0))), groups(F.get(halves, F.lit(1)))
        short = F.size(halves) == 2
        missing = 8 - F.size(head) - F.size(tail)
        full = (
            F.when(F.size(halves) == 1, head)
            .when(
                short & (missing >= 1),
                F.concat(head, F.array_repeat(F.lit("0"), missing), tail),
            )
        )
        return let(
            full,
            lambda g: F.when(
                (F.size(g) == 8) & F.forall(g, lambda x: x.rlike("^[0-9a-fA-F]{1,4}$")),
                F.array_join(F.transform(g, lambda x: F.lpad(F.lower(x), 4, "0")), ""),
            ),
        )

    # an embedded v4 tail becomes two groups
    tail = _v4_hex(F.substring_index(ip, ":", -1))
    lead = F.regexp_extract(ip, r"^(.*:)[^:]*$", 1)
    plain = F.when(~F.contains(ip, F.lit(".")), ip).otherwise(
        F.concat(lead, F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4))
    )
    return F.when(F.contains(ip, F.lit(":")), let(plain, joined))


def ip_hex(ip: Column) -> Column:
    """Bytes of an address as hex, null where it does not parse."""
    return let(
        bare_address(ip),
        lambda b: F.when(F.contains(b, F.lit(":")), _v6_hex(b)).otherwise(_v4_hex(b)),
    )


def ip_bytes(ip: Column) -> Column:
    return F.unhex(ip_hex(ip))


def _any_range(networks: Sequence[str], test: Callable) -> Column:
    """The ranges are a fixed handful: constants in the expression, no join."""
    nets = [ipaddress.ip_network(n) for n in networks]
    return functools.reduce(
        lambda a, b: a | b, [test(int(n[0]), int(n[-1])) for n in nets]
    )


def _blocked_v4(number: Column) -> Column:
    return _any_range(BLOCKED_V4, lambda lo, hi: number.between(lo, hi))


def _blocked_v6(address: Column) -> Column:
    tail = F.conv(F.substring(address, 25, 8), 16, 10).cast("bigint")
    other = _any_range(
        BLOCKED_V6, lambda lo, hi: address.between(f"{lo:032x}", f"{hi:032x}")
    )
    return F.when(
        F.startswith(address, F.lit(MAPPED_V4)), _blocked_v4(tail)
    ).otherwise(other)


def _blocked_bare(bare: Column) -> Column:
    """Blocked test; what did not parse comes out null."""
    return F.when(
        F.contains(bare, F.lit(":")), let(_v6_hex(bare), _blocked_v6)
    ).otherwise(let(v4_number(bare), _blocked_v4))


def parse_allowed(setting: str | None) -> list[str]:
    """Addresses of a comma-separated operator setting."""
    return [a for a in (s.strip() for s in (setting or "").split(",")) if a]


def is_blocked(ip: Column, allowed: Sequence[str] = ()) -> Column:
    """Must a fetch refuse this address?

    Allow-listed addresses are compared as text, zone left off, before parsing.
    """
    blocked = F.coalesce(let(bare_address(ip), _blocked_bare), F.lit(True))
    if allowed:
        blocked = ~bare_address(ip).isin(*allowed) & blocked
    return F.coalesce(blocked, F.lit(True))


def canonical_v6(address: Column) -> Column:
    """32 hex digits as the short text form: longest run of zeros cut out."""
    groups = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.regexp_replace(F.substr(address, i * 4 + 1, F.lit(4)), "^0{1,3}", ""),
    )
    runs = F.lit([":0" * n + ":" for n in range(8, 1, -1)])

    def compress(text: Column) -> Column:
        run = F.get(F.filter(runs, lambda r: F.contains(text, r)), F.lit(0))
        at = F.position(run, text)
        cut = F.concat(
            F.substr(text, F.lit(1), at - 1), F.lit("::"), F.substr(text, at + F.length(run))
        )
        # the text comes with a colon at either end, for runs at the borders
        return F.regexp_replace(F.coalesce(cut, text), "^:(?!:)|(?<!:):$", "")

    return let(F.concat(F.lit(":"), F.array_join(groups, ":"), F.lit(":")), compress)


# -- URLs -------------------------------------------------------------------


@functools.lru_cache(maxsize=1)
def _ascii_forms() -> dict[str, str]:
    """Characters a host parser reads as one ASCII character, by rule."""
    table = {"。": ".", "．": ".", "｡": "."}
    for code in range(0x80, 0x1FC00):
        if not 0xD800 <= code <= 0xDFFF:
            form = unicodedata.normalize("NFKC", chr(code))
            if len(form) == 1 and "!" <= form <= "~":
                table.setdefault(chr(code), form)
    return table


@functools.lru_cache(maxsize=1)
def _long_forms() -> dict[str, str]:
    """Characters that a host parser reads as several ASCII characters, by rule."""
    table = {}
    for code in range(0x80, 0x1FC00):
        if not 0xD800 <= code <= 0xDFFF:
            form = unicodedata.normalize("NFKC", chr(code))
            if len(form) > 1 and all("!" <= c <= "~" for c in form):
                table[chr(code)] = form
    return table


# Code points that a host parser drops.
_DROPPED = r"[\x{AD}\x{34F}\x{180B}-\x{180F}\x{200B}\x{2060}\x{2064}\x{FE00}-\x{FE0F}\x{FEFF}\x{1BCA0}-\x{1BCA3}\x{E0100}-\x{E01EF}]"


def _ascii_host(host: Column) -> Column:
    """A host with letters beyond ASCII as a parser reads it, in lower case.

    Dropped code points go, wide and enclosed forms become the ASCII they stand for.
    """
    short = unicode.translate(F.regexp_replace(host, _DROPPED, ""), _ascii_forms())
    names = list(_long_forms())
    forms = F.map_from_arrays(F.lit(names), F.lit([_long_forms()[c] for c in names]))
    spelled = F.array_join(
        F.transform(F.split(short, ""), lambda c: F.coalesce(F.try_element_at(forms, c), c)), ""
    )
    return F.lower(F.when(short.rlike("[" + "".join(names) + "]"), spelled).otherwise(short))


def trim_url(url: Column) -> Column:
    """As URL parsers do: outer blanks go, tabs and line breaks go anywhere."""
    outer = F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    cleaned = F.regexp_replace(outer, "[\t\r\n]", "")
    unclean = url.rlike(r"^[\x00-\x20]|[\x00-\x20]$|[\t\r\n]")
    return F.when(unclean, cleaned).otherwise(url)


def url_scheme(url: Column) -> Column:
    """Lower-case scheme, null for text that is no absolute URL."""
    found = F.lower(F.regexp_extract(trim_url(url), _SCHEME, 1))
    return F.when(found != "", found)


# Weights of the parts of a dotted address; also the sizes the last part of a
# shortened one may fill.
_WEIGHTS = [256**3, 256**2, 256, 1]
_TOO_BIG = 2**40


def _number(part: Column) -> Column:
    """One part of a numeric host: decimal, octal or hex.  Null if neither."""

    def read(pattern: str, base: int, digits: int) -> Column:
        body = F.regexp_extract(part, pattern, 1)
        return F.when(F.length(body) > digits, F.lit(_TOO_BIG)).otherwise(
            F.conv(body, base, 10).cast("bigint")
        )

    return (
        F.when(part.rlike("^0[xX]0*$|^0+$"), F.lit(0))
        .when(part.rlike("^0[xX]"), read("^0[xX]0*([0-9a-fA-F]+)$", 16, 8))
        .when(part.rlike("^0"), read("^0+([0-7]+)$", 8, 11))
        .otherwise(read("^([0-9]+)$", 10, 10))
        .cast("bigint")
    )


def _numeric_host(host: Column) -> Column:
    """Dotted v4 text of a host whose last part is a number, else null."""
    weights = F.array(*[F.lit(w).cast("bigint") for w in _WEIGHTS])

    def value(parts: Column) -> Column:
        count = F.size(parts)
        last = F.element_at(parts, -1)
        front = F.slice(parts, F.lit(1), count - 1)
        total = F.aggregate(
            F.zip_with(front, F.slice(weights, F.lit(1), count - 1), lambda x, w: x * w),
            last,
            lambda a, x: a + x,
        )
        good = (
            F.forall(parts, lambda p: p.isNotNull())
            & F.forall(front, lambda p: p <= 255)
            & (last < F.element_at(weights, count) * 256)
        )
        return F.when(F.when(count <= 4, good).otherwise(False), total)

    parts = F.split(F.regexp_replace(host, r"\.$", ""), r"\.", -1)
    number = let(F.transform(parts, _number), value)
    return let(
        number,
        lambda n: F.when(
            n.isNotNull(),
            F.concat_ws(
                ".",
                *[
                    F.shiftright(n, shift).bitwiseAND(F.lit(255)).cast("string")
                    for shift in (24, 16, 8, 0)
                ],
            ),
        ),
    )


def url_host(url: Column) -> Column:
    """Canonical host of an http or https URL, null where the URL is invalid.

    IPv6 hosts come without brackets.  Numeric spellings of an IPv4 address
    (``127.1``, ``0x7f000001``, ``2130706433``) become dotted decimal, since
    that is where a client would connect.
    """
    hostport = F.regexp_extract(
        trim_url(url), r"(?i)^https?:[/\\]*(?:[^/\\?#]*@)?([^/\\?#]*)", 1
    )

    def named(text: Column) -> Column:
        host = F.regexp_extract(text, "^([^:]*)(?::[0-9]*)?$", 1)
        decoded = F.try_url_decode(F.regexp_replace(host, r"\+", "%2B"))
        plain = F.when(
            host.rlike(r"^[A-Za-z0-9.\-]*$"), F.lower(host)
        ).otherwise(_ascii_host(decoded))
        return let(
            plain,
            lambda h: F.when(
                (h != "") & ~h.rlike(r'[\x00-\x20#/:<>?@\[\\\]^|%\x7f\p{C}\p{Z}]'),
                F.when(h.rlike(r"(?:^|\.)(?:[0-9]+|0x[0-9a-f]*)\.?$"), _numeric_host(h))
                .otherwise(h),
            ),
        )

    def bracketed(text: Column) -> Column:
        inner = F.regexp_extract(text, r"^\[([0-9a-fA-F:.]*)\](?::[0-9]*)?$", 1)
        return let(
            ip_hex(inner),
            lambda a: F.when(F.length(a) == 32, canonical_v6(a)),
        )

    def parse(text: Column) -> Column:
        port = F.regexp_extract(text, ":0*([0-9]*)$", 1)
        size = F.length(port)
        port_ok = (size < 5) | ((size == 5) & (port <= "65535"))
        return F.when(
            port_ok,
            F.when(F.startswith(text, F.lit("[")), bracketed(text)).otherwise(named(text)),
        )

    # most URLs name a plain host, which needs no more than lower case
    # (possessive, so that a host of very many labels cannot exhaust the stack)
    plain = r"^(?:[A-Za-z0-9\-]++\.)*+[A-Za-z][A-Za-z0-9\-]*+$"
    return let(
        hostport,
        lambda h: F.when(h.rlike(plain), F.lower(h)).when(h != "", parse(h)),
    )


def is_literal_ip(host: Column) -> Column:
    """Is a canonical host an address?"""
    return F.contains(host, F.lit(":")) | host.rlike(_V4)


def url_verdict(url: Column) -> Column:
    """``invalid-url``, ``scheme-refused`` or ``ok``."""
    scheme = url_scheme(url)
    return (
        F.when(scheme.isNull(), "invalid-url")
        .when(
            scheme.isin(*ALLOWED_SCHEMES),
            F.when(url_host(url).isNull(), "invalid-url").otherwise("ok"),
        )
        .otherwise("scheme-refused")
    )


def invalid_location(location: Column, current: Column) -> Column:
    """A redirect target that cannot be resolved against the current URL.

    Only a target that names a host can fail; paths and queries always resolve.
    """
    text = trim_url(location)
    relative_host = text.rlike(r"^[/\\]{2}")
    absolute = F.when(relative_host, F.concat(url_scheme(current), F.lit(":"), text)).otherwise(text)
    return (relative_host | text.rlike(_SCHEME)) & (url_verdict(absolute) == "invalid-url")


def url_path(url: Column) -> Column:
    return F.regexp_extract(
        trim_url(url), _SCHEME + r"[/\\]*[^/\\?#]*([^?#]*)", 2
    )


def _decode_component(text: Column) -> Column:
    """Percent-decoding that keeps ``+``; null for broken escapes or UTF-8."""
    plus_kept = F.try_url_decode(F.regexp_replace(text, r"\+", "%2B"))
    broken = F.contains(plus_kept, F.lit("�")) & ~text.rlike("(?i)�|%EF%BF%BD")
    return F.when(~broken, plus_kept)


def _encode_path(text: Column) -> Column:
    """The escapes a URL parser puts into a path."""
    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c: F.when(
                c.rlike(r'[^\x21-\x7e]|["<>^`{}]'),
                F.regexp_replace(F.url_encode(c), r"\+", "%20"),
            ).otherwise(c),
        ),
        "",
    )


def url_display_name(url: Column) -> Column:
    """Name of a fetched document: decoded last path segment, or ``document``."""
    # Read from the end: ``..`` drops the segment before it, and the first
    # segment left standing is the name.
    start = F.struct(F.lit(0).alias("drop"), F.lit(None).cast("string").alias("name"))

    def back(state: Column, segment: Column) -> Column:
        dots = F.lower(F.regexp_replace(segment, "(?i)%2e", "."))

        def now(drop: Column, name: Column | None = None) -> Column:
            kept = state["name"] if name is None else name
            return F.struct(drop.cast("int").alias("drop"), kept.alias("name"))

        return (
            F.when(state["name"].isNotNull() | (dots == "."), state)
            .when(dots == "..", now(state["drop"] + 1))
            .when(state["drop"] > 0, now(state["drop"] - 1))
            .when(segment != "", now(state["drop"], segment))
            .otherwise(state)
        )

    segments = F.split(F.translate(url_path(url), "\\", "/"), "/", -1)
    last = F.aggregate(F.reverse(segments), start, back)
    base = F.coalesce(last["name"], F.lit(""))
    return let(
        base,
        lambda b: let(
            F.coalesce(_decode_component(b), _encode_path(b)),
            lambda n: F.when(n.isin("", "/"), "document").otherwise(n),
        ),
    )
