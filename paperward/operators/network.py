"""Screening of URLs, addresses and fetch logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.functions import net as N
from paperward.plans.shape import compute_once

# Limits of a fetch.
MAX_BYTES = 10 * 1024 * 1024
DEFAULT_TIMEOUT_MS = 30_000

# What an HTTP status of the service means.
FAILURES = {
    401: ("rejected-key", "The API key was rejected (%s). Check the configured key."),
    402: ("over-quota", "The account is over its monthly quota (%s)"),
    422: ("not-analysable", "The service could not analyse that file (%s)"),
    429: (
        "rate-limited",
        "Rate limited (%s)",
    ),
    503: ("busy", "The service is busy (%s). Retry in a few seconds."),
}
RATE_HINT = (
    ". Without a key the anonymous allowance is 10 documents an hour;"
    " a free key raises it."
)


def screen_addresses(df: DataFrame, ip: str = "ip", allowed: Sequence[str] = ()) -> DataFrame:
    """Add ``blocked``; allow-listed addresses pass."""
    return df.withColumn("blocked", N.is_blocked(F.col(ip), allowed))


def without_allowed(addresses: DataFrame, allowed: DataFrame, ip: str = "ip") -> DataFrame:
    """Addresses not on an allow-list table, compared as text without zone."""
    keys = allowed.select(N.bare_address(F.col("ip")).alias("_bare")).distinct()
    return (
        addresses.withColumn("_bare", N.bare_address(F.col(ip)))
        .join(keys, "_bare", "left_anti")
        .drop("_bare")
    )


def screen_hosts(answers: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """Refuse a host if any of its addresses is blocked.

    ``answers (host, ip)``.  ``bool_or`` combines before the shuffle, so a host
    with very many answers is no burden.
    """
    return (
        screen_addresses(answers, "ip", allowed)
        .groupBy("host")
        .agg(
            F.bool_or("blocked").alias("refused"),
            F.count("*").alias("answers"),
            F.count_if("blocked").alias("blocked_answers"),
        )
    )


def screen_urls(df: DataFrame, url: str = "url", allowed: Sequence[str] = ()) -> DataFrame:
    """Add ``host`` and ``verdict`` of each URL, literal addresses screened."""
    df = compute_once(df, "host", N.url_host(F.col(url)))
    literal = N.is_literal_ip(F.col("host"))
    verdict = F.when(
        F.col("host").isNull(),
        F.when(
            N.url_scheme(F.col(url)).isNull()
            | N.url_scheme(F.col(url)).isin(*N.ALLOWED_SCHEMES),
            "invalid-url",
        ).otherwise("scheme-refused"),
    ).otherwise(
        F.when(literal & N.is_blocked(F.col("host"), allowed), "blocked").otherwise("ok")
    )
    return df.withColumn("verdict", verdict)


def timeout_ms(setting) -> float:
    """Timeout setting; only a finite number above zero replaces the default."""
    try:
        value = float(setting)
    except (TypeError, ValueError):
        return DEFAULT_TIMEOUT_MS
    return value if 0 < value < float("inf") else DEFAULT_TIMEOUT_MS


def _hop_outcome(limit: float, allowed: Sequence[str]) -> Column:
    """What one hop ends with, null where it leads on to the next."""
    status = F.coalesce(F.col("status"), F.lit(0))
    redirect = status.between(300, 399) & (F.coalesce("location", F.lit("")) != "")
    return (
        F.when(F.col("verdict") != "ok", F.col("verdict"))
        .when(F.coalesce("dns_blocked", F.lit(False)), "blocked")
        .when(F.col("elapsed_ms") > limit, "timeout")
        .when(F.col("status").isNull(), "unreachable")
        .when(redirect & (F.col("hop") >= N.MAX_REDIRECTS), "redirect-limit")
        .when(redirect & N.invalid_location(F.col("location"), F.col("url")), "invalid-location")
        .when(redirect, F.lit(None))
        .when(~status.between(200, 299), "http-error")
        .when(F.col("declared_len") > MAX_BYTES, "declared-too-large")
        .when(F.col("received_len") > MAX_BYTES, "received-too-large")
        .when(F.coalesce("received_len", F.lit(0)) == 0, "empty-body")
        .otherwise("ok")
    )


def hop_outcomes(
    hops: DataFrame, timeout=None, allowed: Sequence[str] = ()
) -> DataFrame:
    """Add ``outcome`` to each hop of a fetch log.

    ``hops (fetch_id, hop, url, status, location, declared_len, received_len,
    elapsed_ms)``, hop 0 first, each with the time it took by itself; an optional ``dns_blocked`` tells that the host
    resolved to a blocked address.
    """
    if "dns_blocked" not in hops.columns:
        hops = hops.withColumn("dns_blocked", F.lit(False))
    screened = screen_urls(hops, "url", allowed)
    return screened.withColumn("outcome", _hop_outcome(timeout_ms(timeout), allowed))


def fetch_outcomes(
    hops: DataFrame, timeout=None, allowed: Sequence[str] = ()
) -> DataFrame:
    """One row per fetch: its first hop that ends it, and the reason.

    Each hop is judged alone and the earliest one wins by ``min``.  The time limit
    holds for all hops of a fetch together: a sum for each hop that a fetch may
    have, so there is no window and no task that holds a whole chain.
    """
    limit = timeout_ms(timeout)
    last = N.MAX_REDIRECTS
    spent = [
        F.sum(F.when(F.col("hop") <= h, F.col("elapsed_ms"))).alias(f"_spent_{h}") for h in range(last + 1)
    ]
    ended = F.when(
        F.col("outcome").isNotNull(),
        F.struct(
            "hop", "outcome", "status", "url", "location", "declared_len", "received_len"
        ),
    )
    ends = (
        hop_outcomes(hops, timeout, allowed)
        .groupBy("fetch_id")
        .agg(
            F.count("*").alias("requests"),
            F.min_by("url", "hop").alias("url"),
            F.min(ended).alias("_end"),
            *spent,
        )
    )
    # the hop in which the time ran out, unless the chain had ended before
    late = F.coalesce(*[F.when(F.col(f"_spent_{h}") > limit, F.lit(h)) for h in range(last + 1)])
    refused = F.col("_end.outcome").isin("invalid-url", "scheme-refused", "blocked")
    sooner = F.col("_end").isNull() | (late < F.col("_end.hop")) | ((late == F.col("_end.hop")) & ~refused)
    kind = dict(ends.select("_end.*").dtypes)
    instead = {"hop": late, "outcome": F.lit("timeout"), "status": F.when(late == F.col("_end.hop"), F.col("_end.status"))}
    timed_out = F.struct(*[
        instead.get(c, F.lit(None)).cast(t).alias(c) for c, t in kind.items()
    ])
    ends = ends.withColumn("_end", F.when(late.isNotNull() & sooner, timed_out).otherwise(F.col("_end")))
    outcome = F.coalesce("_end.outcome", F.lit("unfinished"))
    return ends.select(
        "fetch_id",
        "url",
        "requests",
        outcome.alias("outcome"),
        F.col("_end.hop").alias("ended_at"),
        F.col("_end.status").alias("status"),
        fetch_message(F.col("url"), F.col("_end"), limit).alias("message"),
        F.when(outcome == "ok", N.url_display_name(F.col("url"))).alias("name"),
    )


def fetch_message(url: Column, end: Column, limit: float) -> Column:
    """Why a fetch failed, in words; null where it did not.

    A blocked address is never named: it is what a prober wants to learn.
    """

    def text(pattern: str, *args: Column) -> Column:
        return F.format_string(pattern, url, *args)

    def megabytes(length: Column) -> Column:
        return length / F.lit(1024.0 * 1024.0)

    scheme = N.url_scheme(end["url"])
    seconds = f"{limit / 1000:g}"
    refused = F.when(
        end["hop"] == 0,
        F.format_string(
            'url must be http: or https: — refusing %s: ("%s").', scheme, url
        ),
    ).otherwise(
        text(
            "%s redirected to a %s: URL, which is not allowed — only http:/https:", scheme
        )
    )
    words = {
        "invalid-url": text('not a valid URL: "%s"'),
        "scheme-refused": refused,
        "blocked": text(
            "refusing to fetch %s: it resolves to a non-routable or otherwise blocked"
            " address (loopback, link-local/metadata, private or reserved)."
        ),
        "timeout": text(f"fetching %s timed out after {seconds}s"),
        "unreachable": text("could not fetch %s"),
        "redirect-limit": text(f"%s exceeded the redirect limit ({N.MAX_REDIRECTS})"),
        "invalid-location": text(
            '%s redirected to an invalid location "%s"', end["location"]
        ),
        "http-error": text("fetching %s failed with HTTP %d", end["status"]),
        "declared-too-large": text(
            "%s is %.1f MB by its Content-Length, over the 10 MB limit.",
            megabytes(end["declared_len"]),
        ),
        "received-too-large": text(
            "%s is over the 10 MB limit — stopped after %.1f MB.",
            megabytes(end["received_len"]),
        ),
        "empty-body": text("%s returned an empty body"),
    }
    message = F.when(F.lit(False), "")
    for outcome, line in words.items():
        message = message.when(end["outcome"] == outcome, line)
    return message


def describe_failures(df: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """Add ``code``, ``failure`` and ``message`` for failed service calls.

    The six cases are fixed, so they are a column expression and not a join.
    """
    parsed = F.try_parse_json(F.col(body))

    def text_at(path: str) -> Column:
        value = F.try_variant_get(parsed, path, "variant")
        return F.when(
            F.schema_of_variant(value) == "STRING", F.try_variant_get(parsed, path, "string")
        )

    code = F.coalesce(text_at("$.error"), F.concat(F.lit("http_"), F.col(status).cast("string")))
    detail = F.coalesce(F.concat(F.lit(" — "), text_at("$.message")), F.lit(""))
    with_detail = (402, 422, 429)
    df = df.withColumn("code", code)
    failure, message = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for number, (name, text) in FAILURES.items():
        line = F.format_string(text, F.col("code"))
        if number in with_detail:
            line = F.concat(line, detail)
        if number == 429:
            line = F.concat(line, F.lit(RATE_HINT))
        failure = failure.when(F.col(status) == number, name)
        message = message.when(F.col(status) == number, line)
    other = F.concat(
        F.lit("The service returned HTTP "), F.col(status).cast("string"),
        F.lit(" ("), F.col("code"), F.lit(")"), detail,
    )
    return df.withColumn("failure", failure.otherwise("other")).withColumn(
        "message", message.otherwise(other)
    )
