"""Longest-prefix matching against the standard library."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from paperward.operators import ranges as G


def random_address(rng):
    if rng.random() < 0.4:
        return ipaddress.IPv6Address((0x20010DB8 << 96) | rng.getrandbits(rng.choice([8, 70, 96])))
    return ipaddress.IPv4Address((10 << 24) | rng.getrandbits(rng.choice([4, 16, 24])))


def brute(ip, rules):
    try:
        address = ipaddress.ip_address(ip.split("%")[0])
    except ValueError:
        return None, True
    if address.version == 6 and address.ipv4_mapped:
        address = address.ipv4_mapped
    held = [(n.prefixlen, b) for n, b in rules.items() if n.version == address.version and address in n]
    return max(held, default=(None, False))


def test_against_the_standard_library(spark):
    """Ten thousand overlapping ranges, some twice."""
    rng = random.Random(2)
    rows, rules = [], {}
    for _ in range(10_000):
        a = random_address(rng)
        length = rng.randrange(0, a.max_prefixlen + 1)
        blocked = rng.random() < 0.6
        rows.append((f"{a}/{length}", blocked))
        net = ipaddress.ip_network(f"{a}/{length}", strict=False)
        rules[net] = rules.get(net, False) or blocked
    ips = [str(random_address(rng)) for _ in range(400)] + ["::ffff:10.0.0.9", "fe80::1%eth0", "x", "", "10.0.0.256"]
    ips += [ips[0]] * 50
    addresses = spark.createDataFrame([(i, ip, True, {"a": 1}) for i, ip in enumerate(ips)], "i int, ip string, blocked boolean, m map<string,int>")
    table = spark.createDataFrame(rows, "network string, blocked boolean")
    got = G.match_ranges(addresses, table)
    assert got.columns == ["i", "ip", "m", "prefix", "blocked"]
    found = {r["i"]: (r["prefix"], r["blocked"]) for r in got.collect()}
    # of IPv6 ranges that hold all mapped addresses none is longer than 96 bits here
    assert found == {i: brute(ip, rules) for i, ip in enumerate(ips)}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_edges(spark):
    addresses = spark.createDataFrame([(1, None), (2, "1.2.3.4"), (3, "::ffff:1.2.3.4"), (4, "::1")], "i int, ip string")
    rule = lambda *rows: spark.createDataFrame(list(rows), "network string, blocked boolean")
    run = lambda table: {r["i"]: (r["prefix"], r["blocked"]) for r in G.match_ranges(addresses, table).collect()}
    assert run(rule().limit(0)) == {1: (None, True), 2: (None, False), 3: (None, False), 4: (None, False)}
    assert run(rule(("0.0.0.0/0", True), ("::ffff:1.2.3.4", False), (" ::/0 ", None))) == {
        1: (None, True), 2: (32, False), 3: (32, False), 4: (0, True)
    }
    assert run(rule(("1.2.3.4", True), ("1.2.3.4/32", False)))[2] == (32, True)
    assert G.match_ranges(addresses.limit(0), rule(("::/0", True))).count() == 0


@pytest.mark.parametrize("network", ["10.0.0.0/33", "::/129", "x/8", "", "1.2.3.4/", "1.2.3.4/8/8", "10.0.0.0/-1", None])
def test_a_rule_that_cannot_be_read_stops_the_job(spark, network):
    table = spark.createDataFrame([(network, True)], "network string, blocked boolean")
    with pytest.raises(Exception, match="not a network"):
        G.read_ranges(table).collect()


def test_rows_of_one_range_and_address_are_many_tasks_work(spark):
    conf = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    addresses = spark.range(200_000).selectExpr("id", "if(id % 10 < 8, '9.9.9.9', concat_ws('.', 9, id % 200, id % 7, 1)) AS ip")
    table = spark.createDataFrame([("9.0.0.0/8", True)], "network string, blocked boolean")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = G.match_ranges(addresses, table).groupBy(F.spark_partition_id()).agg(F.count_if("blocked").alias("n")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r["n"] for r in out]
    assert sum(sizes) == 200_000 and len(sizes) >= 8 and max(sizes) <= 2 * sum(sizes) / len(sizes), sizes
