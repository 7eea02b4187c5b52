"""Secret scan with multipart credential linking.

One pass over the texts turns the matches of every pattern into lengths (the
gaps between matches and the matches), written once without the texts. All that
follows works on these narrow rows: a running sum per document and pattern gives
the spans in code points, and weak candidates are linked by an interval join in
the form of a sweep: span ends and starts are ordered within their document, and
range frames count the parts that began up to ``SCOPE`` code points after a span and,
to take away, those that ended more than ``SCOPE`` before it, so no pair of spans is
built. Parts that overlap the span (credentials inside an endpoint) are among them.

Kinds. Always reported: ``assign``, ``access``, ``hex``. Reported only in
company: ``weak_id`` (20 capital letters and digits) next to a secret part,
``weak_secret`` (40 base64 characters) next to an identifier, ``endpoint`` next
to both. Identifiers are ``access`` and ``weak_id``; secrets are ``assign``,
``hex`` and ``weak_secret``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankshelf.llm.text import whole_text
from rankshelf.session import stage

SCOPE = 400  # code points between the parts of one credential

# Fixed patterns: kind, expression, group to measure, its least length, role.
# For access and hex the least length is in the expression: a run that is too
# short has no longer one inside it. For assign it is checked after matching.
KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, "secret"),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16, "id"),
    ("hex", r"[0-9a-f]{32,}", 0, 32, "secret"),
    ("weak_id", r"(?<![A-Z0-9])(?!AKIA)[A-Z0-9]{20}(?![A-Z0-9])", 0, 20, "id"),
    ("weak_secret", r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", 0, 40, "secret"),
    ("endpoint", r"\b(?:https?|s3)://[A-Za-z0-9./_:-]+", 0, 1, "endpoint"),
]
N_BASE = 3


def _matches(number: int) -> Column:
    """Array of (kind number, k, gap before, length, valid) of one kind, empty when nothing matches."""
    _, pattern, group, least, _ = KINDS[number]
    regex, text = F.lit(pattern), F.col("_s_text")
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("part"),
    )
    found = F.transform(
        zipped,
        lambda x, k: F.struct(
            F.lit(number).alias("kind"), k.alias("k"), F.length(x.gap).alias("gap"),
            F.length(x.hit).alias("n"), (F.length(x.part) >= least).alias("valid"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,k:int,gap:int,n:int,valid:boolean>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _spans(rows: DataFrame) -> DataFrame:
    """``_s_row, kind, start, stop`` of the valid matches, in code points, end exclusive."""
    hits = rows.select("_s_row", F.explode("_s_hits").alias("m")).select("_s_row", "m.*").where("n IS NOT NULL")
    before = Window.partitionBy("_s_row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        hits.withColumn("stop", F.sum(F.col("gap") + F.col("n")).over(before))
        .where("valid")
        .select("_s_row", "kind", (F.col("stop") - F.col("n")).alias("start"), "stop")
    )


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """The weak spans that overlap complementary parts or have them within ``scope`` code points before or after."""
    roles = F.element_at(F.array(*[F.lit(k[4]) for k in KINDS]), F.col("kind") + 1)
    weak_rows = spans.where(f"kind >= {N_BASE}").select("_s_row").distinct()
    events = (
        spans.join(weak_rows, "_s_row", "left_semi")
        .withColumn("role", roles)
        .withColumn("_e", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(True).alias("opens")), F.struct(F.col("stop").alias("at"), F.lit(False).alias("opens")))))
        .select("_s_row", "kind", "start", "stop", "role", "_e.at", "_e.opens")
    )
    order = Window.partitionBy("_s_row").orderBy("at")

    def near(role: str) -> Column:
        ended = F.sum(F.when((F.col("role") == role) & ~F.col("opens"), 1).otherwise(0)).over(order.rangeBetween(Window.unboundedPreceding, -scope - 1))
        begun = F.sum(F.when((F.col("role") == role) & F.col("opens"), 1).otherwise(0)).over(order.rangeBetween(Window.unboundedPreceding, scope))
        return F.when(F.col("opens"), -F.coalesce(ended, F.lit(0))).otherwise(begun)

    sides = events.withColumn("near_id", near("id")).withColumn("near_secret", near("secret")).where(f"kind >= {N_BASE}")
    # a span's own role is never the one it looks for, and its two events are one row each
    both = sides.groupBy("_s_row", "kind", "start", "stop").agg((F.sum("near_id") > 0).alias("near_id"), (F.sum("near_secret") > 0).alias("near_secret"))
    return both.withColumn("role", roles).where(
        "role = 'id' AND near_secret OR role = 'secret' AND near_id OR role = 'endpoint' AND near_id AND near_secret"
    ).select("_s_row", "kind", "start", "stop")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: the id and ``found``, an array of (start, kind_no, kind, stop) in order.

    Null and empty texts have an empty array; repeated rows are scanned alike
    and keep their own rows; an empty table gives no rows; other columns are
    ignored.
    """
    hits = F.concat(*[_matches(i) for i in range(len(KINDS))])
    rows = stage(
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("_s_text"))
        .select("doc_id", F.monotonically_increasing_id().alias("_s_row"), hits.alias("_s_hits")),
        "secret-hits",
    )
    spans = stage(_spans(rows), "secret-spans")
    reported = spans.where(f"kind < {N_BASE}").unionByName(_linked(spans, scope))
    name = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind") + 1)
    per_row = reported.groupBy("_s_row").agg(
        F.sort_array(F.collect_list(F.struct("start", F.col("kind").alias("kind_no"), name.alias("kind"), "stop"))).alias("found")
    )
    empty = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,stop:bigint>>")
    return rows.select("doc_id", "_s_row").join(per_row, "_s_row", "left").select("doc_id", F.coalesce("found", empty).alias("found"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.stop)), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x.kind == kind)).cast("long")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda x: x.kind_no < N_BASE)
