"""Address ranges that are a table: a longest-prefix join.

A range is keyed by family, prefix length and the bits of its prefix.  An address is
looked up by equality once for each length that occurs in the table, so there is no
comparison join, and of the ranges it lies in the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.functions import net as N
from paperward.operators.network import screen_urls
from paperward.plans.shape import materialize
from paperward.plans.skew import attach, attach_counted, hashable

_KEY = ["family", "length", "bits"]


def _family(digits: Column) -> Column:
    """4 or 6 by the hex digits of an address; mapped addresses are judged as version 4."""
    return F.when((F.length(digits) == 8) | F.startswith(digits, F.lit(N.MAPPED_V4)), 4).when(F.length(digits) == 32, 6)


def _own_digits(digits: Column) -> Column:
    return F.when(F.startswith(digits, F.lit(N.MAPPED_V4)) & (F.length(digits) == 32), F.right(digits, F.lit(8))).otherwise(digits)


def prefix_bits(digits: Column, length: Column) -> Column:
    """The first ``length`` bits of hex digits: whole digits, then the masked rest of one."""
    whole, rest = F.floor(length / 4).cast("int"), length % 4
    digit = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    # a mask of 1, 2 or 3 leading bits
    masked = F.when(rest == 1, digit.bitwiseAND(F.lit(8))).when(rest == 2, digit.bitwiseAND(F.lit(12))).otherwise(
        digit.bitwiseAND(F.lit(14))
    )
    return F.concat(F.substring(digits, F.lit(1), whole), F.when(rest > 0, F.lower(F.hex(masked))).otherwise(""))


def read_ranges(ranges: DataFrame) -> DataFrame:
    """Rows (family, length, bits, blocked) of ``ranges(network, blocked)``, one for each network.

    A network is an address, or one with ``/`` and a length; bits beyond the length don't
    count.  Of equal networks the blocking one wins, and a null ``blocked`` blocks.  A
    network that can't be read stops the job, as a rule must not get lost.
    """
    parts = F.split(F.btrim("network"), "/", -1)
    digits = N.ip_hex(F.get(parts, F.lit(0)))
    given = F.when(F.size(parts) == 2, F.get(parts, F.lit(1)))
    most = F.length("digits") * 4
    table = ranges.select("network", F.coalesce("blocked", F.lit(True)).alias("blocked"), digits.alias("digits"), given.alias("given"), F.size(parts).alias("parts"))
    length = F.when(F.col("parts") == 1, most).when(F.col("given").rlike("^[0-9]{1,3}$"), F.col("given").cast("int"))
    table = table.withColumn("length", length)
    # a mapped range is one of version 4 if it holds nothing else
    mapped = F.startswith("digits", F.lit(N.MAPPED_V4)) & (F.length("digits") == 32) & (F.col("length") >= 96)
    plain = F.when(mapped, F.right("digits", F.lit(8))).otherwise(F.col("digits"))
    own = F.when(mapped, F.col("length") - 96).otherwise(F.col("length"))
    good = F.coalesce((F.col("length") <= most) & F.col("digits").isNotNull(), F.lit(False))
    told = F.raise_error(F.concat(F.lit("not a network: "), F.coalesce("network", F.lit("null"))))
    family = F.when(F.length(plain) == 8, 4).otherwise(6)
    table = table.select(
        F.when(good, family).otherwise(told.cast("int")).alias("family"), own.alias("length"),
        prefix_bits(plain, own).alias("bits"), "blocked",
    )
    return table.groupBy(*_KEY).agg(F.bool_or("blocked").alias("blocked"))


def match_ranges(addresses: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """``addresses`` with ``prefix``, the length of the longest range each lies in, and ``blocked``.

    An address in no range is not blocked and has a null ``prefix``; one that does not
    parse, or is null, is blocked.  A mapped address is judged as version 4.

    Columns of these names are replaced.  Each distinct address is looked up once, however often it stands in the table, and
    both joins are salted: a range that holds most addresses, and an address on most rows,
    are many tasks' work.
    """
    table = materialize(read_ranges(ranges))
    lengths = table.select("family", "length").distinct().collect()  # 162 at most
    asked = {f: sorted(r["length"] for r in lengths if r["family"] == f) for f in (4, 6)}
    none = F.array().cast("array<int>")
    arrays = {f: F.array(*map(F.lit, v)) if v else none for f, v in asked.items()}
    digits = N.ip_hex(F.col(ip))
    rows = addresses.withColumn("_digits", _own_digits(digits))
    known = materialize(rows.where("_digits IS NOT NULL").groupBy("_digits").agg(F.count("*").alias("_n")))
    family = F.when(F.length("_digits") == 8, 4).otherwise(6)
    every = F.explode(F.when(family == 4, arrays[4]).otherwise(arrays[6]))
    probes = known.select("_digits", family.alias("family"), every.alias("length"))
    probes = probes.withColumn("bits", prefix_bits(F.col("_digits"), F.col("length")))
    met = attach_counted(probes, table, _KEY, ["_digits"]).where("blocked IS NOT NULL")
    longest = met.groupBy("_digits").agg(F.max(F.struct("length", "blocked")).alias("_range"))
    found = materialize(known.join(longest, "_digits").select("_digits", "_range", "_n"))
    joined = attach(rows, found, ["_digits"], "_n", hashable(addresses))
    blocked = F.coalesce("_range.blocked", F.col("_digits").isNull())
    kept = [c for c in addresses.columns if c not in ("prefix", "blocked")]
    return joined.select(*kept, F.col("_range.length").alias("prefix"), blocked.alias("blocked"))


def screen_urls_by_rules(urls: DataFrame, ranges: DataFrame, allowed: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host`` and ``verdict``, under the fixed rules and two tables.

    A literal host in one of ``ranges(network, blocked)`` goes by the longest, over the
    fixed ranges; in none, by those.  One on the list ``allowed(ip)``, compared as text
    without zone, passes both.
    """
    rows = screen_urls(urls, url).select(
        F.struct(*urls.columns).alias("_row"), "host", "verdict", F.xxhash64(*hashable(urls)).alias("_spread")
    )
    literal = F.when(N.is_literal_ip(F.col("host")) & F.col("verdict").isin("ok", "blocked"), F.col("host"))
    rows = materialize(rows.withColumn("_ip", literal))
    rows = match_ranges(rows, ranges, "_ip").withColumn("_bare", N.bare_address(F.col("_ip")))
    listed = allowed.select(N.bare_address(F.col("ip")).alias("_bare"), F.lit(True).alias("_listed")).distinct()
    rows = attach_counted(materialize(rows), listed, ["_bare"], ["_spread"])
    by_rule = F.when(F.col("prefix").isNotNull(), F.when(F.col("blocked"), "blocked").otherwise("ok"))
    verdict = F.when(F.col("_listed"), "ok").when(F.col("_ip").isNotNull(), F.coalesce(by_rule, "verdict"))
    return rows.select("_row.*", "host", F.coalesce(verdict, "verdict").alias("verdict"))
