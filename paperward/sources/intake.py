"""Document intake: listing files, and the rules a document must pass."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperward.functions.net import let

# The size limit and the reasons, in the order they are tested.
MAX_UPLOAD_BYTES = 10 * 1024 * 1024
REASONS = (
    "not-absolute",
    "missing",
    "not-a-file",
    "empty",
    "outside-allowed",
    "too-large",
)
ACCEPTED = "accepted"

# Messages about the choice between a path and a URL.
BOTH = "give either path or url, not both"
NEITHER = "give a document: either path (a file on this machine) or url (http/https)"


def scan_documents(spark: SparkSession, location: str) -> DataFrame:
    """Files below a folder.  Select without ``content`` and no file is opened."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    )
    return files.withColumn("path", F.regexp_replace("path", "^file:/*", "/"))


def load_documents(spark: SparkSession, location: str) -> DataFrame:
    """Files of a folder with name, length, digest, content and ``reason``.

    A file over the size limit is never opened: it has a row with the reason and
    neither digest nor content.  Spark's listing leaves out files of no bytes.
    """
    files = scan_documents(spark, location)
    fits = F.col("length") <= MAX_UPLOAD_BYTES
    named = ["path", basename(F.col("path")).alias("name"), "length"]
    loaded = files.where(fits).select(
        *named, F.sha2("content", 256).alias("sha256"), "content", F.lit(ACCEPTED).alias("reason")
    )
    refused = files.where(~fits).select(
        *named, F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("binary").alias("content"),
        F.lit(REASONS[5]).alias("reason"),
    )
    return loaded.unionByName(refused)


def manifest(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """Join wanted paths to a listing: adds ``exists``, ``is_file``, ``length``.

    Spark's file listing leaves out files of no bytes, so those show as missing.
    """
    seen = listing.select(
        "path", F.lit(True).alias("exists"), F.lit(True).alias("is_file"), "length"
    )
    return wanted.join(seen, "path", "left").withColumn(
        "exists", F.coalesce("exists", F.lit(False))
    )


def parse_roots(setting: str | None) -> list[str]:
    """Absolute folders of a setting separated by colons or commas."""
    parts = (p.strip() for p in (setting or "").replace(",", ":").split(":"))
    roots = [posixpath.normpath(p) for p in parts if p.startswith("/")]
    return ["/" + r.lstrip("/") for r in roots]


def canonical_path(path: Column) -> Column:
    """Absolute path without ``.``, ``..`` and doubled slashes."""
    none = F.array().cast("array<string>")

    def walk(done: Column, segment: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return (
            F.when(segment.isin("", "."), done)
            .when(segment == "..", up)
            .otherwise(F.array_append(done, segment))
        )

    kept = F.aggregate(F.split(path, "/", -1), none, walk)
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def is_within(path: Column, root: str) -> Column:
    """Root itself or below it.

    A child whose own name starts with two dots counts as outside.
    """
    prefix = root if root.endswith("/") else root + "/"
    below = F.startswith(path, F.lit(prefix))
    rest = F.substring(path, len(prefix) + 1, 2)
    return (path == root) | (below & (rest != ".."))


def inside_allowed(path: Column, roots: Sequence[str]) -> Column:
    """Canonical path lies in one of the roots; no roots, no limit."""
    if not roots:
        return F.lit(True)

    def any_root(p: Column) -> Column:
        found = F.lit(False)
        for root in roots:
            found = found | is_within(p, root)
        return found

    return let(canonical_path(path), any_root)


def intake_reason(
    path: Column,
    exists: Column,
    is_file: Column,
    length: Column,
    roots: Sequence[str] = (),
    real_path: Column | None = None,
) -> Column:
    """First reason to refuse a file, or ``accepted``."""
    real = path if real_path is None else real_path
    return (
        F.when(~F.startswith(path, F.lit("/")), REASONS[0])
        .when(~F.coalesce(exists, F.lit(False)), REASONS[1])
        .when(~F.coalesce(is_file, F.lit(False)), REASONS[2])
        .when(length == 0, REASONS[3])
        .when(~inside_allowed(real, roots), REASONS[4])
        .when(length > MAX_UPLOAD_BYTES, REASONS[5])
        .otherwise(ACCEPTED)
    )


def intake_message(path: Column, reason: Column, length: Column) -> Column:
    """Refusal a caller can act on; null for accepted files."""
    size = F.format_string("%.1f", length / F.lit(1024.0 * 1024.0))

    def line(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    return (
        F.when(reason == REASONS[0], line('path must be absolute, got "', path, '"'))
        .when(reason == REASONS[1], line("no file at ", path))
        .when(reason == REASONS[2], line(path, " is not a file"))
        .when(reason == REASONS[3], line(path, " is empty"))
        .when(
            reason == REASONS[4],
            line(
                path,
                " is outside the directories this server is allowed to read. Move the"
                " file into an allowed directory or send it by url.",
            ),
        )
        .when(reason == REASONS[5], line(path, " is ", size, " MB, over the 10 MB limit."))
    )


def check_manifest(files: DataFrame, roots: Sequence[str] = ()) -> DataFrame:
    """Add ``reason``, ``message`` and ``name`` to a manifest."""
    real = F.col("real_path") if "real_path" in files.columns else None
    reason = intake_reason(
        F.col("path"), F.col("exists"), F.col("is_file"), F.col("length"), roots, real
    )
    files = files.withColumn("reason", reason)
    message = intake_message(F.col("path"), F.col("reason"), F.col("length"))
    return files.withColumn("message", message).withColumn("name", basename(F.col("path")))


def basename(path: Column) -> Column:
    return F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)


def choose_source(path: Column, url: Column) -> Column:
    """Exactly one of path and URL: struct of ``path``, ``url``, ``error``.

    A URL is trimmed before use, a path is taken as it is.
    """
    blank = r"^[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]*$"
    has_path = F.coalesce(~path.rlike(blank), F.lit(False))
    has_url = F.coalesce(~url.rlike(blank), F.lit(False))
    outer = blank[1:-2]
    trimmed = F.regexp_replace(url, f"^{outer}+|{outer}+$", "")
    return F.struct(
        F.when(has_path & ~has_url, path).alias("path"),
        F.when(has_url & ~has_path, trimmed).alias("url"),
        F.when(has_path & has_url, BOTH).when(~has_path & ~has_url, NEITHER).alias("error"),
    )
