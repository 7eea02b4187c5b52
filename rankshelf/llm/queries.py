"""Registered queries of the operators, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankshelf.llm import exact_dedup, fingerprints, lm_scoring, mixing, packing, periodic_runs, quality, secrets, simhash, spelling, suffix_dedup, token_shards, url_filters
from rankshelf.llm.text import whole_text, words_of

LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Fixed rules of the URL query: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts; all digests are asked for."""
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), hash_unique=True)


OP1_SQL = f"""
WITH d AS (SELECT doc_id, {LOWER_SQL.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, calibrated probability and draw of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        F.col("_row.doc_id").alias("doc_id"), *mixing.DIMENSIONS, "tokens", F.round("probability", 6).alias("probability"), "sampled"
    )


def _mixing_sql() -> str:
    """Rounds of raking, written out one scaling after the other; enough for the marginals of any table of ours to agree."""
    count = "length(t) - length(regexp_replace(t, '[{}]', '', 'g'))"
    steps, last = [], "w0"
    for d in mixing.DIMENSIONS:
        steps.append(f"""g_{d} AS (SELECT {d} AS value, p / sum(p) OVER () AS target FROM (
  SELECT {d}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {mixing.ALPHA}) AS p FROM cells GROUP BY {d}))""")
    for n in range(24):
        for d in mixing.DIMENSIONS:
            steps.append(f"""w{n}_{d} AS MATERIALIZED (SELECT source, lang, topic, tokens, w * target / sum(w) OVER (PARTITION BY {d}) AS w
  FROM {last} JOIN g_{d} ON {last}.{d} = g_{d}.value)""")
            last = f"w{n}_{d}"
    return f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
d AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) + 1 AS tokens,
         CASE WHEN ({count.format("0-9")}) * 10 > length(t) THEN 'numbers'
              WHEN ({count.format("#*$%&|<>")}) * 20 > length(t) THEN 'symbols'
              WHEN ({count.format("A-Z")}) * 3 > length(t) THEN 'capitals'
              WHEN ({count.format(chr(92) + "n")}) * 40 > length(t) THEN 'lists' ELSE 'prose' END AS topic
  FROM t
),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL),
w0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS w FROM cells),
{", ".join(steps)},
p AS (SELECT source, lang, topic, w / tokens / max(w / tokens) OVER () AS probability FROM {last})
SELECT doc_id, source, lang, topic, tokens, round(probability, 6) AS probability,
       ('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 13))::BIGINT / {float(1 << 52)!r}::DOUBLE < probability AS sampled
FROM d JOIN p USING (source, lang, topic)
"""


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as shards in training order; every record as read back."""
    return token_shards.training_order(_table(spark, sf_dir, "documents")).select(
        "doc_id", "seq_no", "slot", "shard", "n_tokens", F.xxhash64("ids").alias("ids_hash")
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeated strings of 400 bytes, and the digest of what stays."""
    return suffix_dedup.strip_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    return simhash.simhash_classes(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base spans, list of all spans."""
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    base = secrets.base_spans(F.col("found"))
    return found.select(
        "doc_id",
        *[secrets.count_kind(F.col("found"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("found")).alias("spans"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every document."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def packing_sql(documents: str = "documents") -> str:
    """The dynamic program written out bucket by bucket over all pairs of lengths."""
    k = packing.BUCKETS
    layers = ["b0 AS (SELECT 0::BIGINT AS j, 0::HUGEINT AS cost, 0::BIGINT AS i)"]
    for n in range(1, k + 1):
        layers.append(f"""b{n} AS MATERIALIZED (SELECT j, pick.cost AS cost, pick.i AS i FROM (
  SELECT h.j, min({{'cost': b.cost + h.l * (h.c - g.c) - (h.t - g.t), 'i': b.j}}) AS pick
  FROM h JOIN b{n - 1} b ON b.j < h.j JOIN h0 g ON g.j = b.j GROUP BY h.j))""")
    path = [f"p{k} AS (SELECT j, i FROM b{k} WHERE j = (SELECT max(j) FROM h))"]
    path += [f"p{n} AS (SELECT b.j, b.i FROM b{n} b JOIN p{n + 1} p ON b.j = p.i)" for n in range(k - 1, 0, -1)]
    return f"""
WITH d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS n_tokens FROM {documents}),
h AS MATERIALIZED (SELECT row_number() OVER o AS j, l, sum(n) OVER o AS c, sum(l * n) OVER o AS t
  FROM (SELECT n_tokens AS l, count(*) AS n FROM d GROUP BY 1) WINDOW o AS (ORDER BY l)),
h0 AS MATERIALIZED (SELECT j, c, t FROM h UNION ALL SELECT 0, 0, 0),
{", ".join(layers)}, {", ".join(path)},
tops AS (SELECT DISTINCT l FROM h WHERE j IN ({" UNION ALL ".join(f"SELECT j FROM p{n}" for n in range(1, k + 1))}) OR (SELECT max(j) FROM h) <= {k}),
r AS (SELECT doc_id, n_tokens, (SELECT min(l) FROM tops WHERE l >= n_tokens) AS bucket FROM d),
s AS (SELECT *, greatest(1, {packing.BUDGET} // bucket) AS room, row_number() OVER (PARTITION BY bucket ORDER BY doc_id, n_tokens) - 1 AS nth FROM r)
SELECT doc_id, n_tokens, bucket, nth // room AS batch, nth % room AS slot, bucket - n_tokens AS padding FROM s
"""


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and model score of every document."""
    return lm_scoring.lm_scores(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.quality_report(_table(spark, sf_dir, "documents"))


_R = quality.Rules()
OP9_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN c USING (doc_id)
),
f AS (
  SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words AS base_failed,
         n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words
         OR word_chars < {_R.min_word_length}::DOUBLE * n_words OR word_chars > {_R.max_word_length}::DOUBLE * n_words
         OR 100 * n_symbols > {_R.max_symbol_percent} * n_words
         OR 100 * n_dup_lines > {_R.max_dup_line_percent} * n_lines AS any_failed
  FROM m
),
h AS (SELECT source, count(*) AS n, sum(any_failed::INT)::BIGINT AS x FROM f GROUP BY source),
q AS (SELECT sum(x) / sum(n) AS m, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) ** 2 AS v FROM h),
k AS (SELECT source, round(CASE WHEN v > 1e-12
             THEN (x + m * greatest(1, m * (1 - m) / v - 1)) / (n + greatest(1, m * (1 - m) / v - 1)) ELSE m END, 6) AS host_rate
      FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rate,
       host_rate >= {_R.host_limit} AS host_rejected,
       NOT base_failed AND NOT (host_rate >= {_R.host_limit} AND any_failed) AS kept
FROM f LEFT JOIN k ON f.source IS NOT DISTINCT FROM k.source
"""


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"), rules)


OP10_SQL = f"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, {LOWER_SQL.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rhost, rpath, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
m AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (page_id)
"""

def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of all documents with the form it is taken for; misspelt words are planted."""
    return spelling.spelling_variants(spelling.word_counts(_table(spark, sf_dir, "documents"), drop_every=97))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its text with the second half replaced, and how like they are."""
    rows = fingerprints.beside_next(_table(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, length(text) - CAST(floor(length(text) / 2) AS INT)), next_head)"))
    rows = fingerprints.with_fingerprint(rows, F.col("edited"), "edited_fingerprint")
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text("fingerprint").alias("fingerprint"), fingerprints.as_text("edited_fingerprint").alias("edited_fingerprint"),
        fingerprints.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        fingerprints.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; with h = crc32(doc_id), a tenth of the texts goes on periodically from some word."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    at = docs.select("doc_id", whole_text("text").alias("text"), F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, words_of(whole_text("text"))).alias("_w"))
    at = at.withColumn("_n", F.size("_w")).withColumn("_a", F.expr("CASE WHEN _n > 0 THEN CAST(_g % _n AS INT) END"))
    at = at.withColumn("_p", F.expr("CAST(1 + (_n - _a) DIV (3 + _g % 8) AS INT)"))
    tail = F.expr("array_join(transform(sequence(0, _n - 1), i -> get(_w, CASE WHEN i < _a THEN i ELSE _a + (i - _a) % _p END)), ' ')")
    return at.select("doc_id", F.when(F.col("_n") > 0, tail).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, its longest one, and digests of the list and of the collapsed text."""
    found = periodic_runs.periodic_runs(with_periodic_tails(_table(spark, sf_dir, "documents")))
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS less, r.start AS start, r.period AS period)))")
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed")).select(
        "doc_id", "n_runs", "best.start", (-F.col("best.less")).alias("length"), "best.period",
        F.expr("(-best.less) * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_token_shards": op3_token_shards,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_simhash": op5_simhash,
    "op6_secret_scan": op6_secret_scan,
    "op7_packing": op7_packing,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filters": op10_url_filters,
    "op11_spelling": op11_spelling,
    "op12_fingerprints": op12_fingerprints,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    "op1_exact_dedup": OP1_SQL,
    "op2_mixing": _mixing_sql(),
    "op7_packing": packing_sql(),
    "op9_quality_rules": OP9_SQL,
    "op10_url_filters": OP10_SQL,
}
