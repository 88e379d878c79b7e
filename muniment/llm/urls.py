"""URL filters: rules on host suffixes and path prefixes, found by hash.

A rule (host, path) fits its host and all subdomains, and every path that begins with its own. A URL is therefore expanded into
host suffixes times path prefixes; prefixes are cut only at the lengths that some rule has, since no other can match. Expressions
and rules are joined on the first ``BITS`` bits of their SHA-256 (a cheap equal join), candidates are confirmed by the full digest, and of the rules that
fit the longest decides; of equally long ones the one with the longer host, and blocking before allowing.

The join is planned by Spark, which broadcasts the rules only if they are small. Equal hosts and paths are judged once, so a
host that holds many rows costs one expansion per distinct URL part.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule; equal rows get equal results; a null in a rule
makes it fit nothing; a repeated rule counts once; an empty table or an empty rule list gives the default verdict, or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the digest's prefix that is joined on (four bits each).
PREFIX_DIGITS = 8

RULE_SCHEMA = "host string, path string, action string"


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules written as (action, ``host/path``)."""
    rows = [(r[: r.index("/")], r[r.index("/") :], action) for action, r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty without one. Host and path are both read from here."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1), letters, letters.lower())


def path_of(url: Column) -> Column:
    """From the slash behind the host up to ``?``, ``#`` or the end; empty if the host ends otherwise."""
    return F.regexp_extract(rest_of(url), r"^[^/?#]*(/[^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and every part of it behind a dot."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per page: its id, ``host``, ``path``, the deciding ``rule`` (null if none) and the ``verdict``."""
    url = F.col(f"`{url_col}`")
    parts = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("action").isNotNull()).groupBy("host", "path").agg(
        F.max("action").alias("action"))  # block sorts behind allow
    expression = F.concat(F.col("host"), F.col("path"))
    listed = known.select(F.col("host").alias("r_host"), expression.alias("rule"), "action", F.sha2(F.concat_ws("\0", "host", "path"), 256).alias("r_digest"))
    listed = listed.withColumn("short", F.substring("r_digest", 1, PREFIX_DIGITS))
    # The lengths of rule paths: distinct numbers, never more than the longest path has characters.
    lengths = [r.n for r in known.select(F.length("path").alias("n")).distinct().collect()]
    urls = parts.where("host != ''").select("host", "path").distinct()
    wanted = F.filter(F.array(*map(F.lit, sorted(lengths) or [0])), lambda n: n <= F.length("path"))
    expanded = urls.select("host", "path", F.explode(suffixes(F.col("host"))).alias("suffix"), wanted.alias("lengths")).select(
        "host", "path", "suffix", F.explode("lengths").alias("n"))
    probes = expanded.select("host", "path", F.sha2(F.concat(F.col("suffix"), F.lit("\0"), F.expr("substring(path, 1, n)")), 256).alias("digest"))
    probes = probes.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    found = probes.join(listed, "short").where("digest = r_digest")
    rank = F.struct(F.length("rule"), F.length("r_host"), F.col("action"), F.col("rule"))
    best = found.groupBy("host", "path").agg(F.max(rank).alias("best")).select(
        F.col("host").alias("b_host"), F.col("path").alias("b_path"), F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))
    out = parts.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
