"""URL filter lists by expression expansion and hash-prefix lookup.

Every URL is expanded into expressions ``host suffix + path prefix`` (suffixes
cut at dots, prefixes cut after slashes, no longer than the longest rule). The
expressions meet the rules in an equi-join on a four-byte prefix of their
SHA-256, each distinct expression once; the full digests confirm the match, and
the longest confirmed rule wins. URLs are expanded once per distinct host and path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankshelf.llm.text import lower_az
from rankshelf.session import small_enough, stage

PREFIX_HEX = 8  # hex digits of the short hash prefix: four bytes


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(url.isNotNull() & (at > 0), F.expr("substr(_u, instr(_u, '://') + 3)")).otherwise(F.lit(""))
    return lower_az(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` rules as ``rule, verdict, digest, prefix``; one row per rule, block before allow.

    A path is cut at slashes when URLs are expanded, so a rule's path must start
    and end with ``/``; any other rule raises when the table is read.
    """
    expression = F.concat(lower_az(F.col("host")), F.col("path"))
    checked = F.when(F.col("path").rlike("^/(.*/)?$"), expression).otherwise(
        F.raise_error(F.concat(F.lit("rule path must start and end with '/': "), F.coalesce("path", F.lit("null"))))
    )
    return (
        rules.select(checked.alias("rule"), "verdict")
        .groupBy("rule").agg(F.max("verdict").alias("verdict"))
        .withColumn("digest", F.sha2("rule", 256))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    A rule fits a URL whose host is the rule's or a subdomain of it and whose
    path starts with the rule's. Of several, the longest rule wins; the same rule
    listed as allow and block blocks. Without a rule the verdict is ``default``
    and ``rule`` is null, which is also the result for null, empty and malformed
    URLs and for an empty rule table. Repeated rows are judged alike; other
    columns are ignored.
    """
    table = rule_table(rules)
    # one row: how many labels and how many path cuts the longest rules have
    most = table.select(
        F.max(F.size(F.split(F.substring_index("rule", "/", 1), r"\."))).alias("labels"),
        F.max(F.size(F.split("rule", "/")) - 1).alias("cuts"),
    ).first()
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("_u"))
    host, path = host_and_path(F.col("_u"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    if most.labels is None:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    parts = rows.select("host", "path").distinct().withColumn("_l", F.split("host", r"\.")).withColumn("_s", F.split("path", "/"))
    suffixes = parts.withColumn(
        "_h", F.explode(F.expr(f"transform(sequence(1, least(size(_l), {most.labels})), k -> array_join(slice(_l, -k, k), '.'))"))
    )
    expressions = (
        suffixes.where(F.size("_s") > 1)
        .withColumn("_p", F.explode(F.expr(f"transform(sequence(1, least(size(_s) - 1, {most.cuts})), k -> concat(array_join(slice(_s, 1, k), '/'), '/'))")))
        .select("host", "path", F.sha2(F.concat("_h", "_p"), 256).alias("_digest"))
        .withColumn("prefix", F.substring("_digest", 1, PREFIX_HEX))
    )
    # every URL of a domain makes that domain's expressions: the rules are looked up once for each
    confirmed = stage(
        expressions.select("prefix", "_digest").distinct()
        .join(table, "prefix")
        .where(F.col("_digest") == F.col("digest"))
        .select("_digest", "rule", "verdict"),
        "url-rules",
    )
    # no more rows than rules; sent to the expressions while they are few, else AQE splits a hot expression
    hits = F.broadcast(confirmed) if small_enough(confirmed) else confirmed
    won = (
        expressions.join(hits, "_digest")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return rows.join(won, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
