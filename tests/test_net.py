"""Addresses, URLs and fetch logs."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from paperward.functions import net as N
from paperward.functions import sql as names
from paperward.operators import network as K
from paperward.queries.network import IP_PLANTS, URL_PLANTS


def _ips(spark, ips):
    return spark.createDataFrame(list(enumerate(ips)), "i int, ip string")


def test_addresses_by_hand(spark):
    df = _ips(spark, [ip for ip, *_ in IP_PLANTS])
    out = df.select("i", N.ip_hex(F.col("ip")).alias("h"), N.is_blocked(F.col("ip")).alias("b"))
    for r in out.collect():
        _, want_hex, want_blocked = IP_PLANTS[r["i"]]
        assert (r["h"], r["b"]) == (want_hex, want_blocked), IP_PLANTS[r["i"]]


def _random_addresses(count, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        kind = rng.randrange(5)
        if kind == 0:
            out.append(".".join(str(rng.randrange(258)) for _ in range(4)))
        elif kind == 1:
            groups = [rng.choice(["0", "0", f"{rng.randrange(65536):x}"]) for _ in range(8)]
            out.append(str(ipaddress.ip_address(":".join(groups))))
        elif kind == 2:
            groups = [f"{rng.randrange(65536):X}" for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(len(groups) + 1)
            out.append(":".join(groups[:at]) + "::" + ":".join(groups[at:]))
        elif kind == 3:
            head = rng.choice(["::", "::ffff:", "64:ff9b::", "1:2:3:4:5:6:", "1:2:3:4:5:6:7:", "fe80::"])
            out.append(head + ".".join(str(rng.randrange(256)) for _ in range(4)))
        else:
            out.append("".join(rng.choice("0123456789abcdefg:.%") for _ in range(rng.randrange(1, 14))))
    return out


def test_random_addresses_against_standard_library(spark):
    ips = _random_addresses(4000, 11)
    out = _ips(spark, ips).select(
        "i", N.ip_hex(F.col("ip")).alias("h"), N.is_blocked(F.col("ip")).alias("b")
    )
    for r in out.collect():
        ip = ips[r["i"]]
        try:
            want = ipaddress.ip_address(ip.split("%")[0]).packed.hex()
        except ValueError:
            want = None
        assert r["h"] == want, ip
        assert r["b"] == blocked(ip), ip


def blocked(ip):
    """By the standard library."""
    try:
        address = ipaddress.ip_address(ip.split("%")[0])
    except ValueError:
        return True
    address = getattr(address, "ipv4_mapped", None) or address
    nets = [ipaddress.ip_network(n) for n in (*N.BLOCKED_V4, *N.BLOCKED_V6)]
    return any(address in n for n in nets if n.version == address.version)


def test_sql_name_agrees_with_the_column(spark):
    """On spellings that are nearly addresses as well."""
    rng = random.Random(6)
    parts = ["0", "1", "ffff", "10", "255", "256", "01", ":", "::", ".", "%a", "g", "fe80", "127.0.0.1", ""]
    ips = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(4000)]
    ips += [":".join(rng.choice(["0", "1", "fc00", "", "ffff", "10.0.0.1"]) for _ in range(rng.randrange(1, 10))) for _ in range(4000)]
    names.register(spark)
    _ips(spark, ips).createOrReplaceTempView("odd_ips")
    out = spark.table("odd_ips").withColumn("a", N.is_blocked(F.col("ip"))).withColumn("b", F.expr("is_blocked_ip(ip)"))
    assert [(r["ip"], r["a"], r["b"]) for r in out.where("a <> b").collect()] == []


def test_address_screen_by_sql_name(spark):
    names.register(spark)
    _ips(spark, [ip for ip, *_ in IP_PLANTS]).createOrReplaceTempView("planted_ips")
    out = spark.sql("SELECT i, is_blocked_ip(ip) AS b, is_blocked_ip(NULL) AS n FROM planted_ips").collect()
    assert all(r["b"] == IP_PLANTS[r["i"]][2] and r["n"] is True for r in out)


def test_canonical_v6(spark):
    rng = random.Random(3)
    addresses = [
        ipaddress.IPv6Address(
            int("".join(rng.choice(["0000", "0000", "0001", "ab00", "0c0d"]) for _ in range(8)), 16)
        )
        for _ in range(800)
    ]
    df = spark.createDataFrame(
        [(str(a), a.packed.hex()) for a in addresses if not a.ipv4_mapped], "want string, hex string"
    )
    assert df.where(N.canonical_v6(F.col("hex")) != F.col("want")).count() == 0


def test_bytes(spark):
    row = _ips(spark, ["10.1.2.3"]).select(N.ip_bytes(F.col("ip")).alias("b")).first()
    assert bytes(row["b"]) == bytes([10, 1, 2, 3])


def test_allow_list_is_textual(spark):
    df = _ips(spark, ["::1", "0:0:0:0:0:0:0:1", "fe80::1%en0", "10.0.0.1", "bad"])
    allowed = N.parse_allowed(" ::1, fe80::1 ,,bad")
    assert allowed == ["::1", "fe80::1", "bad"]
    out = K.screen_addresses(df, allowed=allowed).orderBy("i").collect()
    assert [r["blocked"] for r in out] == [False, True, False, True, False]
    table = spark.createDataFrame([("::1",), ("fe80::1",)], "ip string")
    assert [r["i"] for r in K.without_allowed(df, table).orderBy("i").collect()] == [1, 3, 4]


def test_null_address_is_blocked(spark):
    df = spark.createDataFrame([(None,)], "ip string")
    assert K.screen_addresses(df).first()["blocked"] is True
    assert K.screen_addresses(df, allowed=["::1"]).first()["blocked"] is True


def test_any_bad_answer_refuses_the_host(spark):
    df = spark.createDataFrame(
        [("a", "8.8.8.8"), ("a", "10.0.0.1"), ("b", "8.8.8.8"), ("b", "1.1.1.1"), ("c", "x")],
        "host string, ip string",
    )
    out = {r["host"]: (r["refused"], r["answers"], r["blocked_answers"]) for r in K.screen_hosts(df).collect()}
    assert out == {"a": (True, 2, 1), "b": (False, 2, 0), "c": (True, 1, 1)}


def test_urls_by_hand(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URL_PLANTS)], "i int, url string")
    url = F.col("url")
    out = K.screen_urls(df).withColumn("name", N.url_display_name(url))
    for r in out.collect():
        _, verdict, host, name = URL_PLANTS[r["i"]]
        assert (r["verdict"], r["host"]) == (verdict, host), URL_PLANTS[r["i"]]
        if name is not None:
            assert r["name"] == name, URL_PLANTS[r["i"]]


@pytest.mark.parametrize(
    "url, host",
    [
        ("http://1.2.3/", "1.2.0.3"),
        ("http://0x/", "0.0.0.0"),
        ("http://00000000177.1", "127.0.0.1"),
        ("http://4294967295", "255.255.255.255"),
        ("http://4294967296", None),
        ("http://1.2.3.256", None),
        ("http://09.1.1.1", None),
        ("http://a.0x7f/", None),
        ("http://%31%32%37.0.0.1/", "127.0.0.1"),
        ("http://1.2.3.4./", "1.2.3.4"),
        ("http://ex.example./a", "ex.example."),
        ("http://a b/", None),
        ("http://a%20b/", None),
        ("http://a:b/", None),
        ("http://a:/", "a"),
        ("http://a:65535/", "a"),
        ("http://a:65536/", None),
        ("http://a:000080/", "a"),
        ("http://u@v@host/", "host"),
        ("http:/one", "one"),
        ("http:one", "one"),
        ("http:///one", "one"),
        ("http://[::1", None),
        ("http://[1.2.3.4]/", None),
        ("http://[::ffff:1.2.3.4]/", "::ffff:102:304"),
        ("ws://host/", None),
    ],
)
def test_hosts(spark, url, host):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(N.url_host(F.col("url")).alias("h")).first()["h"] == host


def test_names(spark):
    rows = [
        ("http://x/a+b", "a+b"), ("http://x/%41%2e", "A."), ("http://x/%2F", "document"),
        ("http://x/%2Fa", "/a"), ("http://x", "document"), ("http://x/?a/b", "document"),
        ("http://x/a//", "a"), ("http://x/a/%2e%2E/b/.", "b"), ("http://x/../..", "document"),
        ("http://x/é", "é"), ("http://x/%zz é", "%zz%20%C3%A9"), ("http://x/%EF%BF%BD", "�"),
        ("http://x/%C3%28", "%C3%28"),
    ]
    df = spark.createDataFrame(rows, "url string, want string")
    out = df.withColumn("got", N.url_display_name(F.col("url"))).where("got != want").collect()
    assert out == []


def test_hostile_lengths(spark):
    rows = [("http://" + "a." * 100_000 + "b/" + "x/" * 100_000 + "../end/.",), ("http://h/" + "a/" * 50_000 + "../" * 50_001,)]
    df = spark.createDataFrame(rows, "url string")
    out = df.select(N.url_display_name(F.col("url")).alias("n"), F.length(N.url_host(F.col("url"))).alias("h")).collect()
    assert [(r["n"], r["h"]) for r in out] == [("end", 200_001), ("document", 1)]


def test_redirect_targets(spark):
    rows = [("/a", False), ("//", True), ("//h/x", False), ("http://", True), ("http://[bad", True),
            ("file:///x", False), ("?q", False), ("", False), ("http://1.2.3.4.5", True), ("#f", False)]
    df = spark.createDataFrame(rows, "location string, want boolean")
    got = N.invalid_location(F.col("location"), F.lit("https://a.example/"))
    assert df.where(got != F.col("want")).count() == 0


def _hop(fetch, hop, url="https://a.example/", status=200, location=None, declared=None, received=1, elapsed=1, dns=False):
    return (fetch, hop, url, status, location, declared, received, elapsed, dns)


HOPS = (
    "fetch_id int, hop int, url string, status int, location string, declared_len bigint,"
    " received_len bigint, elapsed_ms bigint, dns_blocked boolean"
)


def test_first_ending_hop_wins(spark):
    rows = [
        _hop(1, 0, status=302, location="/b"), _hop(1, 1, status=500), _hop(1, 2),
        _hop(2, 0, dns=True), _hop(3, 0, status=304), _hop(4, 0, status=300, location=""),
        _hop(5, 0, elapsed=30001, status=None), _hop(6, 0, elapsed=30000),
        _hop(7, 0, received=None), _hop(8, 0, url="gopher://x"),
    ]
    df = spark.createDataFrame(rows, HOPS)
    out = {r["fetch_id"]: (r["outcome"], r["ended_at"]) for r in K.fetch_outcomes(df).collect()}
    assert out == {
        1: ("http-error", 1), 2: ("blocked", 0), 3: ("http-error", 0), 4: ("http-error", 0),
        5: ("timeout", 0), 6: ("ok", 0), 7: ("empty-body", 0), 8: ("scheme-refused", 0),
    }
    raised = {r["fetch_id"]: r["outcome"] for r in K.fetch_outcomes(df, timeout="40000").collect()}
    assert raised[5] == "unreachable"


def test_timeout_setting():
    good = K.DEFAULT_TIMEOUT_MS
    assert [K.timeout_ms(v) for v in (None, "", "x", "0", "-1", "inf", "nan")] == [good] * 7
    assert K.timeout_ms("250") == 250


def test_failure_messages(spark):
    df = spark.createDataFrame(
        [(402, '{"error":"quota","message":"used up"}'), (429, None), (418, '{"message":5}')],
        "status int, body string",
    )
    out = {r["status"]: r["message"] for r in K.describe_failures(df).collect()}
    assert out[402] == "The account is over its monthly quota (quota) — used up"
    assert out[429].startswith("Rate limited (http_429). Without a key")
    assert out[418] == "The service returned HTTP 418 (http_418)"
