"""Queries over URLs, addresses and fetch logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperward.functions import net as N
from paperward.functions import sql as names
from paperward.operators import network as K
from paperward.operators import ranges as G
from paperward.queries import planted as P
from paperward.queries import sqltext as S
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


# URL, verdict, host, display name - the last three are the expected answers.
URL_PLANTS = [
    ("http://a.example/x/y%20z.pdf?q=1#f", "ok", "a.example", "y z.pdf"),
    ("HTTP://user:pw@EX.example:8080/a+b.pdf", "ok", "ex.example", "a+b.pdf"),
    ("http://127.1/", "blocked", "127.0.0.1", "document"),
    ("http://0x7f000001/a", "blocked", "127.0.0.1", "a"),
    ("http://2130706433", "blocked", "127.0.0.1", "document"),
    ("http://0177.0.0.1/x", "blocked", "127.0.0.1", "x"),
    ("http://8.8.8.8/x/", "ok", "8.8.8.8", "x"),
    ("http://[::1]/r", "blocked", "::1", "r"),
    ("http://[0:0:0:0:0:0:0:1]:80/a", "blocked", "::1", "a"),
    ("http://[2001:db8:0:0:1::]/a", "ok", "2001:db8:0:0:1::", "a"),
    ("http://256.1.1.1/", "invalid-url", None, "document"),
    ("http://1.2.3.4.5/", "invalid-url", None, "document"),
    ("http://", "invalid-url", None, "document"),
    ("https://ex.example:99999/", "invalid-url", None, "document"),
    ("http://ex example/", "invalid-url", None, "document"),
    ("https:\\\\ex.example\\a\\b", "ok", "ex.example", "b"),
    ("file:///etc/passwd", "scheme-refused", None, "passwd"),
    ("ftp://x.example/y", "scheme-refused", None, "y"),
    ("/rel/path", "invalid-url", None, None),
    ("  https://t.example/x\ty ", "ok", "t.example", "xy"),
    ("http://ex.example/a/b/..", "ok", "ex.example", "a"),
    ("http://ex.example/%E3%81%82.pdf", "ok", "ex.example", "あ.pdf"),
    ("http://ex.example/%ff.pdf", "ok", "ex.example", "%ff.pdf"),
    ("http://１２７.0.0.1/", "blocked", "127.0.0.1", "document"),
    ("http://169.254.169.254/latest/meta-data", "blocked", "169.254.169.254", "meta-data"),
    ("http://127.0.0.1\u00ad/a", "blocked", "127.0.0.1", "a"),
    ("http://127.0.0.1\u200b/a", "blocked", "127.0.0.1", "a"),
    ("http://169.254.169.254\u2060/a", "blocked", "169.254.169.254", "a"),
    ("http://127.0.0.%C2%AD1/a", "blocked", "127.0.0.1", "a"),
    ("http://10.0.0.\u2469/a", "blocked", "10.0.0.10", "a"),
    ("http://\u2491\u0030.0.1/a", "blocked", "10.0.0.1", "a"),
    ("http://\ufe0f/a", "invalid-url", None, "a"),
    ("http://a\u200db.example/a", "invalid-url", None, "a"),
    ("http://a\u202eb.example/a", "invalid-url", None, "a"),
    ("http://b\u00fccher.example/a", "ok", "b\u00fccher.example", "a"),
]
_URLS = [u for u, *_ in URL_PLANTS]
_N = len(URL_PLANTS)

# Address, bytes as hex, blocked - expected answers by hand.
IP_PLANTS = [
    ("0.0.0.0", "00000000", True),
    ("0.255.255.255", "00ffffff", True),
    ("1.0.0.0", "01000000", False),
    ("9.255.255.255", "09ffffff", False),
    ("10.0.0.0", "0a000000", True),
    ("10.255.255.255", "0affffff", True),
    ("11.0.0.0", "0b000000", False),
    ("100.63.255.255", "643fffff", False),
    ("100.64.0.0", "64400000", True),
    ("100.127.255.255", "647fffff", True),
    ("100.128.0.0", "64800000", False),
    ("126.255.255.255", "7effffff", False),
    ("127.0.0.1", "7f000001", True),
    ("128.0.0.0", "80000000", False),
    ("169.253.255.255", "a9fdffff", False),
    ("169.254.0.0", "a9fe0000", True),
    ("169.255.0.0", "a9ff0000", False),
    ("172.15.255.255", "ac0fffff", False),
    ("172.16.0.0", "ac100000", True),
    ("172.31.255.255", "ac1fffff", True),
    ("172.32.0.0", "ac200000", False),
    ("192.0.0.255", "c00000ff", True),
    ("192.0.1.0", "c0000100", False),
    ("192.0.2.1", "c0000201", True),
    ("192.0.3.0", "c0000300", False),
    ("192.88.99.1", "c0586301", False),
    ("192.167.255.255", "c0a7ffff", False),
    ("192.168.0.0", "c0a80000", True),
    ("192.169.0.0", "c0a90000", False),
    ("198.17.255.255", "c611ffff", False),
    ("198.18.0.0", "c6120000", True),
    ("198.19.255.255", "c613ffff", True),
    ("198.20.0.0", "c6140000", False),
    ("198.51.100.9", "c6336409", True),
    ("198.51.101.0", "c6336500", False),
    ("203.0.113.0", "cb007100", True),
    ("203.0.114.0", "cb007200", False),
    ("223.255.255.255", "dfffffff", False),
    ("224.0.0.0", "e0000000", True),
    ("255.255.255.255", "ffffffff", True),
    ("::", "0" * 32, True),
    ("::1", "0" * 31 + "1", True),
    ("::10.0.0.1", "0" * 24 + "0a000001", True),
    ("::ffff:10.0.0.1", "0" * 20 + "ffff0a000001", True),
    ("::ffff:8.8.8.8", "0" * 20 + "ffff08080808", False),
    ("fe80::1%en0", "fe80" + "0" * 27 + "1", True),
    ("febf::1", "febf" + "0" * 27 + "1", True),
    ("fec0::1", "fec0" + "0" * 27 + "1", False),
    ("fbff::1", "fbff" + "0" * 27 + "1", False),
    ("fdff::1", "fdff" + "0" * 27 + "1", True),
    ("ff02::1", "ff02" + "0" * 27 + "1", True),
    ("64:ff9b::a00:1", "0064ff9b" + "0" * 16 + "0a000001", False),
    ("2002:a00:1::", "20020a000001" + "0" * 20, False),
    ("2001:DB8::1", "20010db8" + "0" * 23 + "1", False),
    ("1:2:3:4:5:6:7::", "00010002000300040005000600070000", False),
    ("1:2:3:4::5:6:7:8", None, True),
    ("1::2::3", None, True),
    ("12345::", None, True),
    ("010.0.0.1", None, True),
    ("1.2.3", None, True),
    ("not-an-ip", None, True),
]
_IPS = [ip for ip, *_ in IP_PLANTS]
ALLOWED = ["::1", "10.0.0.0", "fe80::1"]


def _expected(table: str, rows, names: str) -> str:
    def show(v):
        return "NULL" if v is None else S.lit(v) if isinstance(v, str) else str(v).upper()

    values = ", ".join(
        "(" + ", ".join([str(i), *map(show, row)]) + ")" for i, row in enumerate(rows)
    )
    return f"{table}(i, {names}) AS (VALUES {values})"


def urls_of(pages):
    """Every page's own URL and, as a row of its own, one of the planted ones."""
    both = F.array(F.col("url"), P.pick(F.col("page_id") % _N, _URLS))
    rows = pages.select("page_id", F.posexplode(both).alias("planted", "url"))
    return rows.select("page_id", (F.col("planted") == 1).alias("planted"), "url")


def _urls(spark, folder):
    return urls_of(read_table(spark, folder, "pages"))


URLS_SQL = f"""
    {_expected('plant', URL_PLANTS, 'url, verdict, host, name')},
    urls AS (
        SELECT page_id, true AS planted, plant.url, verdict, host, name
        FROM pages JOIN plant ON page_id % {_N} = plant.i
        UNION ALL
        SELECT page_id, false, url, 'ok', lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)),
               coalesce(nullif(regexp_extract(
                        regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''),
                        '^https?://[^/]+.*/([^/]+)$', 1), ''), 'document')
        FROM pages)"""


@query(f"""
    WITH {URLS_SQL}
    SELECT page_id, planted, CASE WHEN verdict = 'blocked' THEN 'ok' ELSE verdict END AS verdict,
           CASE WHEN verdict = 'invalid-url' AND url NOT LIKE 'http%' THEN NULL
                ELSE lower(regexp_extract(trim(url), '^([A-Za-z]+):', 1)) END AS scheme
    FROM urls
""")
def url_scheme(spark, folder):
    return _urls(spark, folder).select(
        "page_id",
        "planted",
        N.url_verdict(F.col("url")).alias("verdict"),
        N.url_scheme(F.col("url")).alias("scheme"),
    )


@query(f"WITH {URLS_SQL} SELECT page_id, planted, host, verdict FROM urls")
def url_screen(spark, folder):
    return K.screen_urls(_urls(spark, folder)).select("page_id", "planted", "host", "verdict")


@query(f"""
    WITH {URLS_SQL}
    SELECT page_id, planted, CASE WHEN verdict = 'invalid-url' THEN NULL ELSE name END AS name
    FROM urls
""")
def url_display_name(spark, folder):
    url = F.col("url")
    name = F.when(N.url_verdict(url) != "invalid-url", N.url_display_name(url))
    return _urls(spark, folder).select("page_id", "planted", name.alias("name"))


def _addresses(spark, folder):
    """Every event: a planted address, or one made of its id."""
    i = F.col("event_id")
    made = F.concat_ws(
        ".", i * 7919 % 256, i * 104729 % 256, i * 31 % 256, i % 256
    )
    ip = F.when(i % 3 == 0, P.pick(F.floor(i / 3), _IPS)).otherwise(made)
    return read_table(spark, folder, "events").select("event_id", "user_id", ip.alias("ip"))


_V4_BLOCKED = """(a = 0 OR a = 10 OR a = 127 OR (a = 169 AND b = 254)
    OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)
    OR (a = 100 AND b BETWEEN 64 AND 127) OR (a = 192 AND b = 0 AND c IN (0, 2))
    OR (a = 198 AND b IN (18, 19)) OR (a = 198 AND b = 51 AND c = 100)
    OR (a = 203 AND b = 0 AND c = 113) OR a >= 224)"""

_ADDRESSES_SQL = f"""
    {_expected('plant', IP_PLANTS, 'ip, hex, blocked')},
    made AS (SELECT event_id, user_id, event_id * 7919 % 256 AS a, event_id * 104729 % 256 AS b,
                    event_id * 31 % 256 AS c, event_id % 256 AS d FROM events),
    ips AS (
        SELECT event_id, user_id,
               CASE WHEN plant.i IS NULL THEN a || '.' || b || '.' || c || '.' || d
                    ELSE plant.ip END AS ip,
               CASE WHEN plant.i IS NULL THEN printf('%02x%02x%02x%02x', a, b, c, d)
                    ELSE hex END AS hex,
               CASE WHEN plant.i IS NULL THEN {_V4_BLOCKED} ELSE blocked END AS blocked
        FROM made LEFT JOIN plant
        ON event_id % 3 = 0 AND (event_id // 3) % {len(IP_PLANTS)} = plant.i)"""


@query(f"WITH {_ADDRESSES_SQL} SELECT event_id, ip, hex FROM ips")
def ip_parse(spark, folder):
    return _addresses(spark, folder).select(
        "event_id", "ip", N.ip_hex(F.col("ip")).alias("hex")
    )


@query(f"WITH {_ADDRESSES_SQL} SELECT event_id, ip, blocked FROM ips")
def ip_block(spark, folder):
    return K.screen_addresses(_addresses(spark, folder)).select("event_id", "ip", "blocked")


@query(f"WITH {_ADDRESSES_SQL} SELECT blocked, count(*) AS n, count(DISTINCT ip) AS ips FROM ips GROUP BY blocked")
def sql_blocked_ip(spark, folder):
    """The rule called by name from SQL text."""
    names.register(spark)
    return spark.sql(
        "SELECT is_blocked_ip(ip) AS blocked, count(*) AS n, count(DISTINCT ip) AS ips FROM {ips} GROUP BY ALL",
        ips=_addresses(spark, folder),
    )


_BARE = "regexp_replace(ip, '%.*$', '')"
_ALLOWED_SQL = f"({', '.join(map(S.lit, ALLOWED))})"


@query(f"""
    WITH {_ADDRESSES_SQL}
    SELECT event_id, ip, blocked AND {_BARE} NOT IN {_ALLOWED_SQL} AS blocked FROM ips
""")
def ip_allowlist(spark, folder):
    out = K.screen_addresses(_addresses(spark, folder), allowed=ALLOWED)
    return out.select("event_id", "ip", "blocked")


@query(f"""
    WITH {_ADDRESSES_SQL},
    listed AS (SELECT DISTINCT {_BARE} AS bare FROM ips WHERE user_id % 10 = 3)
    SELECT event_id, ip FROM ips WHERE {_BARE} NOT IN (SELECT bare FROM listed)
""")
def ip_allowlist_table(spark, folder):
    """The allow list as a table: the addresses of some users."""
    addresses = _addresses(spark, folder)
    allowed = addresses.where("user_id % 10 = 3").select("ip")
    return K.without_allowed(addresses, allowed).select("event_id", "ip")


@query(f"""
    WITH {_ADDRESSES_SQL}
    SELECT 'host-' || user_id AS host, bool_or(blocked) AS refused, count(*) AS answers,
           count(*) FILTER (blocked) AS blocked_answers
    FROM ips GROUP BY user_id
""")
def dns_screen(spark, folder):
    answers = _addresses(spark, folder).select(
        F.concat(F.lit("host-"), "user_id").alias("host"), "ip"
    )
    return K.screen_hosts(answers)


def _spelt(number, family6, x, y):
    """An address in text, of version 4 from a number, of version 6 from two groups."""
    octets = [F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    six = F.concat(F.lit("2001:db8:"), F.lower(F.hex(x)), F.lit(":"), F.lower(F.hex(y)), F.lit("::7"))
    return F.when(family6, six).otherwise(F.concat_ws(".", *octets))


def range_table(events):
    """One range for each event, many inside each other; some spelt with bits beyond their length."""
    key = F.col("event_id")
    number = (key * 40503 * 65537 + 11) % (1 << 32)
    length = F.when(key % 5 == 0, 32 + key % 33).otherwise(4 + key % 29)
    address = _spelt(number, key % 5 == 0, key * 7919 % 64, key * 104729 % 65536)
    return events.select(F.concat(address, F.lit("/"), length).alias("network"), (key % 3 != 0).alias("blocked"))


def ranged_addresses(events):
    """An address for each event: plain, mapped, version 6, or none at all."""
    key = F.col("event_id")
    plain = _spelt(key * 2654435761 % (1 << 32), key % 5 == 0, key % 64, key * 31 % 65536)
    mapped = F.when((key % 7 == 0) & (key % 5 != 0), F.concat(F.lit("::ffff:"), plain)).otherwise(plain)
    return events.select("event_id", F.when(key % 17 == 0, "not-an-ip").otherwise(mapped).alias("ip"))


@query("""WITH spelt AS (
        SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN 6 ELSE 4 END AS family,
               CASE WHEN event_id % 5 = 0 THEN 64 ELSE 32 END AS wide,
               CASE WHEN event_id % 5 = 0 THEN 32 + event_id % 33 ELSE 4 + event_id % 29 END AS length,
               CAST(CASE WHEN event_id % 5 = 0 THEN (event_id * 7919 % 64) * 65536 + event_id * 104729 % 65536
                    ELSE (event_id * 40503 * 65537 + 11) % 4294967296 END AS HUGEINT) AS range,
               CAST(CASE WHEN event_id % 5 = 0 THEN (event_id % 64) * 65536 + event_id * 31 % 65536
                    ELSE event_id * 2654435761 % 4294967296 END AS HUGEINT) AS ip
        FROM events),
    full_ AS (SELECT *, CAST(power(2, wide - length) AS HUGEINT) AS below,
                     CASE WHEN family = 6 THEN CAST(536939960 AS HUGEINT) * 4294967296 ELSE 0 END AS top FROM spelt),
    ranges AS (SELECT family, length, (top + range) // below AS bits, bool_or(id % 3 <> 0) AS blocked FROM full_ GROUP BY ALL),
    lengths AS (SELECT DISTINCT family, wide, length, below FROM full_),
    met AS (
        SELECT a.id, max({'length': r.length, 'blocked': r.blocked}) AS best
        FROM full_ a JOIN lengths l ON a.family = l.family
        JOIN ranges r ON r.family = a.family AND r.length = l.length AND r.bits = (a.top + a.ip) // l.below
        WHERE a.id % 17 <> 0 GROUP BY a.id)
    SELECT event_id, CAST(best.length AS INTEGER) AS prefix, coalesce(best.blocked, event_id % 17 = 0) AS blocked
    FROM events LEFT JOIN met ON id = event_id
""")
def ip_ranges_table(spark, folder):
    """Ranges and exceptions as a table, as large as that of the addresses."""
    events = read_table(spark, folder, "events")
    return G.match_ranges(ranged_addresses(events), range_table(events)).select("event_id", "prefix", "blocked")


# Fetches: what each hop log looks like, and the expected
# (requests, outcome, ended_at, status).
SCENARIOS = [
    ([("", 200, None, 10, 10, 5)], 1, "ok", 0, 200),
    ([("", 302, "/n", None, None, 5)] * 5 + [("", 200, None, None, 7, 9)], 6, "ok", 5, 200),
    ([("", 301, "/n", None, None, 5)] * 7, 7, "redirect-limit", 5, 301),
    (
        [("", 302, "file:///x", None, None, 5), ("file:///x", None, None, None, None, 5)],
        2, "scheme-refused", 1, None,
    ),
    (
        [("", 307, "http://127.1/", None, None, 5), ("http://127.1/", None, None, None, None, 5)],
        2, "blocked", 1, None,
    ),
    ([("", None, None, None, None, 30001)], 1, "timeout", 0, None),
    ([("", 302, None, None, None, 5)], 1, "http-error", 0, 302),
    ([("", 404, None, None, None, 5)], 1, "http-error", 0, 404),
    ([("", 200, None, 10485761, 5, 5)], 1, "declared-too-large", 0, 200),
    ([("", 200, None, 10485760, 10485761, 5)], 1, "received-too-large", 0, 200),
    ([("", 200, None, None, 0, 5)], 1, "empty-body", 0, 200),
    ([("", 302, "http://[bad", None, None, 5)], 1, "invalid-location", 0, 302),
    ([("", None, None, None, None, 5)], 1, "unreachable", 0, None),
    ([("not a url", None, None, None, None, 5)], 1, "invalid-url", 0, None),
    ([("", 302, "/n", None, None, 5)], 1, "unfinished", None, None),
    ([("", 200, None, 10485760, 10485760, 30000)], 1, "ok", 0, 200),
    # the time limit holds for the whole chain
    ([("", 302, "/n", None, None, 10000)] * 3 + [("", 200, None, None, 7, 1)], 4, "timeout", 3, 200),
    ([("", 302, "/n", None, None, 15001)] * 2 + [("", 200, None, None, 7, 1)], 3, "timeout", 1, None),
    (
        [("", 302, "http://10.0.0.1/", None, None, 30000), ("http://10.0.0.1/", None, None, None, None, 5)],
        2, "blocked", 1, None,
    ),
]


def _hops(spark, folder):
    """A hop log per page, one scenario after the other."""
    hop_type = (
        "array<struct<url string, status int, location string,"
        " declared_len bigint, received_len bigint, elapsed_ms bigint>>"
    )
    chains = F.array(*[
        F.array(*[F.struct(*[F.lit(v) for v in hop]) for hop in hops]).cast(hop_type)
        for hops, *_ in SCENARIOS
    ])
    chain = F.element_at(chains, (F.col("page_id") % len(SCENARIOS) + 1).cast("int"))
    return read_table(spark, folder, "pages").select(
        F.col("page_id").alias("fetch_id"),
        F.col("url").alias("own"),
        F.posexplode(chain).alias("hop", "h"),
    ).select(
        "fetch_id",
        "hop",
        F.when(F.col("h.url") == "", F.col("own")).otherwise(F.col("h.url")).alias("url"),
        "h.status",
        "h.location",
        "h.declared_len",
        "h.received_len",
        "h.elapsed_ms",
    )


_SCENARIOS_SQL = _expected(
    "scenario", [s[1:] for s in SCENARIOS], "requests, outcome, ended_at, status"
)


@query(f"""
    WITH {_SCENARIOS_SQL}
    SELECT page_id AS fetch_id, CAST(requests AS BIGINT) AS requests, outcome,
           CAST(ended_at AS BIGINT) AS ended_at, CAST(status AS BIGINT) AS status
    FROM pages JOIN scenario ON page_id % {len(SCENARIOS)} = i
""")
def fetch_outcome(spark, folder):
    return K.fetch_outcomes(_hops(spark, folder)).select(
        "fetch_id",
        "requests",
        "outcome",
        F.col("ended_at").cast("bigint").alias("ended_at"),
        F.col("status").cast("bigint").alias("status"),
    )


# What each scenario says; %s stands for the URL asked for.
_MESSAGES = {
    "scheme-refused": "%s redirected to a file: URL, which is not allowed — only http:/https:",
    "blocked": "refusing to fetch %s: it resolves to a non-routable or otherwise blocked"
    " address (loopback, link-local/metadata, private or reserved).",
    "timeout": "fetching %s timed out after 30s",
    "unreachable": "could not fetch %s",
    "redirect-limit": "%s exceeded the redirect limit (5)",
    "invalid-location": '%s redirected to an invalid location "http://[bad"',
    "invalid-url": 'not a valid URL: "%s"',
    "declared-too-large": "%s is 10.0 MB by its Content-Length, over the 10 MB limit.",
    "received-too-large": "%s is over the 10 MB limit — stopped after 10.0 MB.",
    "empty-body": "%s returned an empty body",
}
_MESSAGES_SQL = " ".join(
    f"WHEN '{k}' THEN replace({S.lit(v)}, '%s', url)" for k, v in _MESSAGES.items()
)


@query(f"""
    WITH {_SCENARIOS_SQL},
    asked AS (SELECT page_id, outcome, status, CASE WHEN outcome = 'invalid-url' THEN 'not a url' ELSE url END AS url,
              coalesce(nullif(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''),
                       '^https?://[^/]+.*/([^/]+)$', 1), ''), 'document') AS name
              FROM pages JOIN scenario ON page_id % {len(SCENARIOS)} = i)
    SELECT page_id AS fetch_id, CASE outcome {_MESSAGES_SQL}
             WHEN 'http-error' THEN 'fetching ' || url || ' failed with HTTP ' || status END AS message,
           CASE WHEN outcome = 'ok' THEN name END AS name
    FROM asked
""")
def fetch_message(spark, folder):
    """The same outcomes in words, and the name of what was fetched."""
    return K.fetch_outcomes(_hops(spark, folder)).select("fetch_id", "message", "name")


_HOPS_SQL = ", ".join(
    f"({i}, {n}, {'NULL' if label is None else S.lit(label)})"
    for i, (hops, _, outcome, ended, _) in enumerate(SCENARIOS)
    for n in range(len(hops))
    for label in [
        None if ended is None or n < ended
        # a hop by itself only knows its own time
        else outcome if outcome != "timeout" or hops[n][5] > 30000
        else None if hops[n][1] == 302 else "ok"
    ]
)


@query(f"""
    WITH hop(i, hop, outcome) AS (VALUES {_HOPS_SQL})
    SELECT page_id AS fetch_id, CAST(hop AS BIGINT) AS hop, outcome
    FROM pages JOIN hop ON page_id % {len(SCENARIOS)} = i
""")
def redirect_chain(spark, folder):
    """What each hop of a chain ends with; null where it leads on."""
    return K.hop_outcomes(_hops(spark, folder)).select(
        "fetch_id", F.col("hop").cast("bigint").alias("hop"), "outcome"
    )


FAILURE_PLANTS = [
    (401, '{"error":"bad_key"}', "bad_key", "rejected-key"),
    (402, '{"error":"quota","message":"50 of 50 used"}', "quota", "over-quota"),
    (422, "not json", "http_422", "not-analysable"),
    (429, '{"error":7}', "http_429", "rate-limited"),
    (503, "{}", "http_503", "busy"),
    (500, '{"message":"boom"}', "http_500", "other"),
]


@query(f"""
    WITH {_expected('plant', FAILURE_PLANTS, 'status, body, code, failure')}
    SELECT event_id, code, failure FROM events JOIN plant ON event_id % {len(FAILURE_PLANTS)} = i
""")
def http_failure_label(spark, folder):
    turn = F.col("event_id") % len(FAILURE_PLANTS)
    calls = read_table(spark, folder, "events").select(
        "event_id",
        P.pick(turn, [str(p[0]) for p in FAILURE_PLANTS]).cast("int").alias("status"),
        P.pick(turn, [p[1] for p in FAILURE_PLANTS]).alias("body"),
    )
    return K.describe_failures(calls).select("event_id", "code", "failure")
