"""The query catalogue: one Spark query per operator family, each with its DuckDB twin.

Every query reads the whole bound tables of a scale-factor folder (nothing is
sampled or cut to keep the check cheap); limits appear only where a top-k list
is the result itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankshelf.functions.columns import WHITE_SPACE_CLASS
from rankshelf.operators.collaborative import collaborative, coread_counts, similar_user_counts
from rankshelf.operators.content import CONTENT_EXTRA, content_based, cosine_knn, radius_union
from rankshelf.operators.embed import describable, embed, embedding_job, pool, token_states, vectors_long
from rankshelf.operators.fusion import fusion_weights, rrf, stack_rankings
from rankshelf.operators.master import flatten, genre_slice, interaction_chunks, master_table, tfidf, top_terms
from rankshelf.operators.metrics import METRICS, mean_metrics
from rankshelf.operators.ordering import global_rank
from rankshelf.operators.popularity import popular, top_unread
from rankshelf.operators.readlists import (
    distinct_users, history_holdout, histories_of, item_readers, read_list_summary, reader_summary, split_ids,
)
from rankshelf.plans import oracle_sql as O
from rankshelf.plans.evaluate import EVAL_N, cold_per_user, compare, evaluate, test_users, warm_per_user
from rankshelf.plans.recommend import adhoc_histories, recommend
from rankshelf.session import scratch_dir, stage
from rankshelf.sources import io
from rankshelf.sources.tables import Tables

SERVE_N = 10  # list length served by default (fixed value of the reference)
RADIUS = 0.7  # cosine distance radius of the neighbourhood-union query
TOTAL_ROWS = 256  # vectors per batch in the shard and totals queries, small enough to make several
TOP_TERMS = 5
NESTED_ROWS = 8  # interactions in one nested row of the query


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _warm(t: Tables) -> DataFrame:
    return histories_of(t.reads)


def _warm_once(t: Tables) -> DataFrame:
    """The histories, written for plans that use them several times; the reads are joined once."""
    return stage(histories_of(t.reads_once), "histories")


# ---- 2.1 / 2.2 ingest, filters, projections ----------------------------------

def q01_read_filter(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).reads.select("user_id", "item_id", "rating", "is_reviewed")


def q02_distinct_users(spark, d):
    return distinct_users(Tables(spark, d).reads)


def q03_user_read_lists(spark, d):
    return read_list_summary(Tables(spark, d).reads)


def q04_item_reader_lists(spark, d):
    return reader_summary(Tables(spark, d).reads)


def q05_user_split(spark, d):
    return split_ids(distinct_users(Tables(spark, d).reads), "user_id", distinct=True)


def q06_item_split(spark, d):
    return split_ids(Tables(spark, d).items.select("item_id"), "item_id")


def q07_history_holdout(spark, d):
    return history_holdout(Tables(spark, d).reads).select("user_id", "pos", "n_items", "item_id", "part")


def q08_popularity_rank(spark, d):
    return popular(Tables(spark, d).items)


def q09_top_unread(spark, d):
    t = Tables(spark, d)
    return top_unread(popular(t.items), t.users, _warm(t), SERVE_N)


# ---- collaborative ------------------------------------------------------------

def q10_similar_users(spark, d):
    t = Tables(spark, d)
    return similar_user_counts(_warm_once(t), t.reads_once)


def q11_coread_counts(spark, d):
    t = Tables(spark, d)
    per_user = lambda counts: counts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("total"), F.max("cnt").alias("most"))
    return coread_counts(_warm_once(t), t.reads_once, then=per_user).groupBy("user_id").agg(
        F.sum("n").cast("bigint").alias("n_candidates"),
        F.sum("total").cast("bigint").alias("total_count"),
        F.max("most").cast("bigint").alias("max_count"),
    )


def q12_cf_topn(spark, d):
    t = Tables(spark, d)
    return collaborative(_warm_once(t), t.reads_once, SERVE_N)


# ---- content ------------------------------------------------------------------

def q13_train_embeddings(spark, d):
    t = Tables(spark, d)
    train = split_ids(t.items.select("item_id"), "item_id").where(F.col("split") == "train")
    return t.embeddings.join(train, "item_id", "left_semi").select(
        "item_id", F.size("embedding").alias("dims"), F.element_at("embedding", 1).cast("double").alias("first_value")
    )


def q14_cosine_knn(spark, d):
    t = Tables(spark, d)
    hist = _warm_once(t)
    lens = hist.groupBy("user_id").agg(F.count(F.lit(1)).alias("hist_len"))
    k = hist.select("user_id", "item_id").distinct().join(lens, "user_id").groupBy("item_id").agg(
        F.max(F.lit(CONTENT_EXTRA) + F.col("hist_len")).alias("k")
    )
    queries = stage(k.join(t.embeddings, "item_id").select(F.col("item_id").alias("query_id"), "embedding", "k"), "knn-queries")
    knn = cosine_knn(queries, t.embeddings)
    return knn.select("query_id", "knn_rank", "item_id", r6("distance").alias("distance"))


def q15_content_topn(spark, d):
    t = Tables(spark, d)
    out = content_based(_warm_once(t), t.embeddings, SERVE_N)
    return out.select("user_id", "rank", "item_id", r6("distance").alias("distance"))


# ---- fusion and hybrid ------------------------------------------------------------

def _three(t: Tables, n: int):
    hist = _warm_once(t)
    return (
        top_unread(popular(t.items), t.users, hist, n),
        collaborative(hist, t.reads_once, n),
        content_based(hist, t.embeddings, n),
    )


def q16_rrf(spark, d):
    t = Tables(spark, d)
    fused = rrf(stack_rankings(*_three(t, SERVE_N)))
    return fused.select("user_id", "rank", "item_id", r6("score").alias("score"))


def q17_popularity_weight(spark, d):
    t = Tables(spark, d)
    w = fusion_weights(_warm(t), t.users)
    return w.select("user_id", "history_len", r6("w0").alias("w0"), r6("w1").alias("w1"), r6("w2").alias("w2"))


def _hybrid(t: Tables, weighted: bool = False) -> DataFrame:
    out = recommend(t.users, histories_of(t.reads_once), t.reads_once, popular(t.items), t.embeddings, SERVE_N, weighted=weighted)
    return out.select("user_id", "rank", "item_id", r6("score").alias("score"))


def q18_weighted_rrf(spark, d):
    return _hybrid(Tables(spark, d), weighted=True)


def q19_hybrid(spark, d):
    return _hybrid(Tables(spark, d))


def last_order_histories(reads: DataFrame) -> DataFrame:
    """REC-7 input built from data: each reader's most recent order is an ad-hoc history."""
    last = reads.groupBy("user_id").agg(F.max(F.struct(F.col("seq.ts").alias("ts"), F.col("seq.order_key").alias("ok"))).alias("last"))
    return (
        reads.join(last, "user_id")
        .where((F.col("seq.ts") == F.col("last.ts")) & (F.col("seq.order_key") == F.col("last.ok")))
        .select("user_id", "item_id")
    )


def q20_adhoc_history(spark, d):
    t = Tables(spark, d)
    hist = adhoc_histories(last_order_histories(t.reads_once))
    out = recommend(distinct_users(t.reads_once), hist, t.reads_once, popular(t.items), t.embeddings, SERVE_N)
    return out.select("user_id", "rank", "item_id", r6("score").alias("score"))


# ---- evaluation ----------------------------------------------------------------------

def _test_users(t: Tables) -> DataFrame:
    return stage(test_users(t.reads_once), "test-users")


def _warm_users(t: Tables, metrics=None, ndcg_form: str = "reference") -> DataFrame:
    return warm_per_user(_test_users(t), t.reads_once, popular(t.items), t.embeddings, metrics=metrics, ndcg_form=ndcg_form)


def _evaluated(t: Tables):
    return evaluate(_test_users(t), t.reads_once, popular(t.items), t.embeddings)


def q21_metrics_per_user(spark, d):
    return _warm_users(Tables(spark, d)).select("user_id", "metric", r6("value").alias("value"))


def q22_eval_warm(spark, d):
    m = mean_metrics(_warm_users(Tables(spark, d)))
    return m.select("metric", r6("value").alias("value"), "n_users")


def q23_eval_cold(spark, d):
    t = Tables(spark, d)
    m = mean_metrics(cold_per_user(_test_users(t), t.reads_once, popular(t.items)))
    return m.select("metric", r6("value").alias("value"), "n_users")


def q24_compare(spark, d):
    warm, cold, _ = _evaluated(Tables(spark, d))
    return compare(warm, cold, with_report=True).select(
        "metric", r6("regular").alias("regular"), r6("cold_start").alias("cold_start"), r6("difference").alias("difference"), "report"
    )


def q25_missing_users(spark, d):
    """Wanted users without a read list; every 50th customer stands under an id nobody reads with, too."""
    t = Tables(spark, d)
    wanted = t.users.unionByName(t.users.where("user_id % 50 = 0").select((-F.col("user_id")).alias("user_id")))
    return wanted.join(t.reads_once.select("user_id"), "user_id", "left_anti")


# ---- sources / sinks / stages --------------------------------------------------------

def q26_json_ingest(spark, d):
    """All fields of the catalogue through JSON lines, beside lines that are broken, blank or without a usable id."""
    t = Tables(spark, d)
    root = scratch_dir(spark, "items-json")
    shelf = lambda name: F.struct(F.col("item_id").cast("string").alias("count"), F.lit(name).alias("name"))
    full = t.items.withColumns({
        "series": F.array(F.col("title"), F.lit("s")),
        "popular_shelves": F.array(shelf("to-read"), shelf("owned")),
        "authors": F.array(F.struct(F.concat(F.lit("a"), F.col("item_id")).alias("author_id"), F.lit("").alias("role"))),
    })
    io.write_items_json(full, root + "/items")
    odd = ["{\"book_id\": \"1\", broken", " ", "{\"book_id\": null, \"title\": \"t\"}", "{\"title\": \"t\"}", "{\"book_id\": \"abc\"}"]
    spark.createDataFrame([(x,) for x in odd], "value string").write.mode("append").text(root + "/items")
    items = io.items_from_json(io.read_items_json(spark, root + "/items", "PERMISSIVE"))
    return items.select(
        "item_id", "title", "average_rating", F.coalesce(F.length("description"), F.lit(0)).cast("bigint").alias("description_chars"),
        F.array_join("series", "|").alias("series"), F.element_at("authors", 1)["author_id"].alias("author"),
        F.array_join(F.transform("popular_shelves", lambda x: F.concat_ws("=", x["name"], x["count"])), "|").alias("shelves"),
    )


def q27_description_filter(spark, d):
    return describable(Tables(spark, d).descriptions).select("item_id", F.length("text").cast("bigint").alias("n_chars"))


def q28_embed_job(spark, d):
    vecs = embed(describable(Tables(spark, d).descriptions), mode="query")
    return vectors_long(vecs).select("item_id", F.col("bucket").cast("int").alias("bucket"),
                                     r6(F.col("weight").cast("double")).alias("weight"))


def q29_pooling(spark, d):
    states = stage(token_states(describable(Tables(spark, d).descriptions)), "states")
    out = None
    for mode in ("sentence", "query"):
        p = pool(states, mode).select("item_id", F.lit(mode).alias("mode"), "dim", r6("value").alias("value"))
        out = p if out is None else out.unionByName(p)
    return out


def q30_merge_shards(spark, d):
    t = Tables(spark, d)
    root = scratch_dir(spark, "emb-shards")
    ranked = global_rank(t.embeddings, [F.col("item_id")], "rn")
    io.write_embedding_shards(ranked.withColumn("batch", F.expr(f"(rn - 1) div {TOTAL_ROWS}")).drop("rn"), root + "/shards")
    merged = io.merge_shards(spark, root + "/shards")
    return merged.select("item_id", F.col("batch").cast("bigint").alias("batch"), F.posexplode("embedding").alias("place", "value")).withColumn("value", r6(F.col("value").cast("double")))


def q31_csv_ingest(spark, d):
    t = Tables(spark, d)
    root = scratch_dir(spark, "csv-ingest")
    io.write_interactions_csv(t.interactions, root + "/interactions_csv")
    return io.csv_to_parquet(spark, root + "/interactions_csv", root + "/reads_parquet")


def q32_materialise_once(spark, d):
    t = Tables(spark, d)
    path = scratch_dir(spark, "stage") + "/popularity"
    io.write_parquet(t.users, path)
    io.write_parquet(popular(t.items).limit(0), path, "overwrite", single_file=True)  # replaced by a later write
    io.write_parquet(popular(t.items), path, "overwrite")
    io.materialise(spark, path, lambda: t.users)
    return io.materialise(spark, path, lambda: popular(t.items))  # second call reads the stored stage


def q33_textbook_ndcg(spark, d):
    ndcg = [m for m in METRICS if m[1] == "ndcg"]
    return _warm_users(Tables(spark, d), ndcg, "textbook").select("user_id", "metric", r6("value").alias("value"))


def q34_metric_sink(spark, d):
    t = Tables(spark, d)
    path = scratch_dir(spark, "metrics") + "/runs"
    run = "r1"
    warm, cold, _ = _evaluated(t)
    io.append_metrics(warm, path, run, "warm")
    io.append_metrics(cold, path, run, "cold")
    io.append_metrics(cold, path, run, "cold")  # a repeated run leaves the same rows
    return io.read_metrics(spark, path).select("run", "scenario", "metric", r6("value").alias("value"))


def q35_embedding_totals(spark, d):
    ranked = global_rank(describable(Tables(spark, d).descriptions).select("item_id"), [F.col("item_id")], "rn")
    return ranked.groupBy(F.expr(f"(rn - 1) div {TOTAL_ROWS}").alias("batch")).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# ---- ideas tier ------------------------------------------------------------------------

def q36_master_table(spark, d):
    t = Tables(spark, d)
    role = F.when((F.col("item_id") + F.col("author_id")) % 3 == 0, "editor").otherwise("")  # the data has none
    m = master_table(t.items, t.item_authors.withColumn("role", role), t.authors, t.genres, t.reads_once)
    return m.select(
        "item_id", "title", "average_rating", F.coalesce(F.length("description"), F.lit(0)).cast("bigint").alias("description_chars"),
        F.coalesce(F.array_join(F.transform("authors", lambda a: F.concat_ws("=", a["author_id"], a["name"], a["average_rating"].cast("decimal(12,2)"), a["role"])), "|"), F.lit("")).alias("authors"),
        F.coalesce(F.array_join("genres", "|"), F.lit("")).alias("genres"),
        F.coalesce(F.col("n_reads"), F.lit(0)).cast("bigint").alias("n_reads"),
        F.coalesce(F.col("n_readers"), F.lit(0)).cast("bigint").alias("n_readers"),
    )


def q37_flatten(spark, d):
    t = Tables(spark, d)
    flat = flatten(t.items, t.item_authors, t.authors, t.genres)
    return flat.select("item_id", "title", "average_rating", "author_id", "author_name", "genre")


def q38_master_slices(spark, d):
    t = Tables(spark, d)
    return genre_slice(t.items, t.genres, t.reads)


def q39_tfidf(spark, d):
    w = tfidf(describable(Tables(spark, d).descriptions))
    return top_terms(w, TOP_TERMS).select("item_id", "rank", "term", r6("weight").alias("weight"))


def q40_radius(spark, d):
    t = Tables(spark, d)
    per_user = lambda near: near.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    near = radius_union(_warm_once(t), t.embeddings, RADIUS, then=per_user)
    return near.groupBy("user_id").agg(F.sum("n").cast("bigint").alias("n_within"))


# ---- single behaviours ---------------------------------------------------------------

def q41_first_test_users(spark, d):
    """RNK-9: the first ten test users in shuffle order."""
    return test_users(Tables(spark, d).reads, num_users=10)


def q42_preview(spark, d):
    """PRJ-4: the head of the read interactions."""
    return io.preview(Tables(spark, d).reads.select("user_id", "item_id", "rating"), ["user_id", "item_id", "rating"], 20)


def q43_item_readers(spark, d):
    """AGG-3 in row form: every item's readers with their places."""
    return item_readers(Tables(spark, d).reads)


def q44_embedding_job(spark, d):
    """The embedding job from JSON lines to merged shards."""
    root = scratch_dir(spark, "embedding-job")
    io.write_items_json(Tables(spark, d).items, root + "/items")
    embedding_job(spark, root + "/items", root + "/vectors", mode="query")
    return vectors_long(io.merge_shards(spark, root + "/vectors")).select(
        "item_id", F.col("bucket").cast("int").alias("bucket"), r6(F.col("weight").cast("double")).alias("weight")
    )


def q45_text_ids(spark, d):
    """Interactions with text ids through CSV in two deliveries, beside broken lines and bad fields; good rows and rejects."""
    t = Tables(spark, d)
    root = scratch_dir(spark, "text-ids")
    key = F.col("seq.order_key")
    spoilt = lambda every, bad, value: F.when(key % every == 0, F.lit(bad)).otherwise(value.cast("string"))
    line = F.concat_ws(
        ",", spoilt(97, " ", F.concat(F.lit("u"), "user_id")), spoilt(89, "", F.concat(F.lit("b"), "item_id")),
        spoilt(83, "maybe", F.when(key % 2 == 0, F.col("is_read").cast("string")).otherwise(F.when(F.col("is_read") == 1, "True").otherwise("false"))),
        spoilt(79, "4.5", F.col("rating")), spoilt(73, "yes", F.col("is_reviewed")),
    )
    line = F.when(key % 71 == 0, F.concat(line, F.lit(",more"))).otherwise(line)
    out = None
    for delivery in (0, 1):  # the second one brings ids that sort before known ones
        part = t.interactions.where(F.pmod(F.col("item_id") + F.col("user_id"), F.lit(2)) != delivery)
        part.select(line.alias("value")).write.text(f"{root}/csv-{delivery}")
        good, rejects = io.ingest_interactions(spark, f"{root}/csv-{delivery}", root + "/users", root + "/items", header=False)
        same = good.select("user_id", "item_id", "is_read", "rating", "is_reviewed", F.lit("").alias("reason")).unionByName(
            rejects.select("reason").withColumns({c: F.lit(0).cast("bigint") for c in ("user_id", "item_id")} | {c: F.lit(0) for c in ("is_read", "rating", "is_reviewed")})
        ).withColumn("delivery", F.lit(delivery))
        out = same if out is None else out.unionByName(same)
    return out


def q46_master_chunks(spark, d):
    """IDEA-1 with nested interactions; the bound is small enough for items to span several rows."""
    order = [F.col("seq.ts"), F.col("seq.order_key"), F.col("seq.line"), F.col("user_id"), F.col("rating"), F.col("is_reviewed")]
    chunks = interaction_chunks(Tables(spark, d).reads, order, NESTED_ROWS)
    return chunks.select(
        "item_id", "chunk", F.size("interactions").cast("bigint").alias("n_rows"),
        F.array_join(F.transform("interactions", lambda r: F.concat_ws(":", r["user_id"], r["rating"], r["is_reviewed"])), "|").alias("interactions"),
    )


QUERIES = {name: fn for name, fn in sorted(globals().items()) if name[:1] == "q" and name[1:3].isdigit()}


# =========================================================================================
# DuckDB oracle
# =========================================================================================

_STRIP = f"regexp_replace(description, '^{WHITE_SPACE_CLASS}+|{WHITE_SPACE_CLASS}+$', '', 'g')"
_DESCR = ("descr", f"SELECT item_id, t FROM (SELECT item_id, {_STRIP} AS t FROM items) WHERE t IS NOT NULL AND t <> ''")
_TOKLIST = ("tl", f"SELECT item_id, list_filter(regexp_split_to_array(lower(t), '{O.TOKEN_SPLIT}'), lambda x: x <> '') AS toks FROM descr")
_TOKPOS = ("tp", "SELECT item_id, unnest(range(0, len(toks))) AS pos, unnest(toks) AS tok FROM tl")
_BUCKET = "CAST(CAST(('0x' || substr(md5(tok), 1, 8)) AS BIGINT) % 64 AS INTEGER)"


def _three_sql(n: int, users: str = "users", restrict: str | None = None) -> list[tuple[str, str]]:
    keep = f" WHERE user_id IN (SELECT user_id FROM {restrict})" if restrict else ""
    return [
        (f"p{n}", O.top_unread_sql(users, "hist", n)),
        (f"c{n}", f"SELECT * FROM ({O.cf_top_sql(n)}){keep}"),
        (f"b{n}", f"SELECT * FROM ({O.cb_top_sql(n)}){keep}"),
    ]


_CHAIN = ["users", "hist", "pop", "cfcnt", "cbcand"]


def _warm_eval_ctes(textbook: bool = False, ndcg_only: bool = False) -> tuple[list[str], list[tuple[str, str]]]:
    extra = _three_sql(EVAL_N, "test_users", "test_users")
    extra += [
        ("sc", O.rrf_sql(f"p{EVAL_N}", f"c{EVAL_N}", f"b{EVAL_N}")),
        ("preds", O.fused_top_sql("sc", EVAL_N)),
        ("truth", "SELECT user_id, item_id FROM holdout WHERE user_id IN (SELECT user_id FROM test_users)"),
    ]
    extra += O.metrics_sql("preds", "truth", "test_users", textbook, ndcg_only)
    return _CHAIN + ["test_users", "holdout"], extra


def _cold_eval_ctes() -> tuple[list[str], list[tuple[str, str]]]:
    extra = [
        ("preds", f"SELECT u.user_id, p.pop_rank AS rank, p.item_id FROM test_users u JOIN pop p ON p.pop_rank <= {EVAL_N}"),
        ("truth", "SELECT user_id, item_id FROM reads WHERE user_id IN (SELECT user_id FROM test_users)"),
    ]
    extra += O.metrics_sql("preds", "truth", "test_users")
    return ["test_users", "pop", "reads"], extra


def _means(prefix: str, names_extra) -> list[tuple[str, str]]:
    names, extra = names_extra
    renamed = [(f"{prefix}_{n}", b) for n, b in extra]
    # re-point references to the renamed CTEs
    out = []
    for n, b in renamed:
        for old, _ in extra:
            b = _replace_ident(b, old, f"{prefix}_{old}")
        out.append((n, b))
    return out


def _replace_ident(sql: str, old: str, new: str) -> str:
    import re

    return re.sub(rf"(?<![\w.]){re.escape(old)}(?![\w(])", new, sql)


def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["q01_read_filter"] = O.with_(["reads"], "SELECT user_id, item_id, rating, is_reviewed FROM reads")
    s["q02_distinct_users"] = O.with_(["reads"], "SELECT DISTINCT user_id FROM reads")
    s["q03_user_read_lists"] = O.with_(["pos"], """
SELECT user_id, max(n_items) AS n_items, count(DISTINCT item_id) AS n_distinct,
       max(CASE WHEN pos = 1 THEN item_id END) AS first_item,
       max(CASE WHEN pos = n_items THEN item_id END) AS last_item
FROM pos GROUP BY user_id""")
    s["q04_item_reader_lists"] = O.with_(["reads"], """
SELECT item_id, count(*) AS n_reads, count(DISTINCT user_id) AS n_readers FROM reads GROUP BY item_id""")
    s["q05_user_split"] = O.with_(["usplit"], "SELECT user_id, shuffle_pos, split FROM usplit")
    s["q06_item_split"] = O.with_(["isplit"], "SELECT item_id, shuffle_pos, split FROM isplit")
    s["q07_history_holdout"] = O.with_(["pos"], """
SELECT user_id, pos, n_items, item_id, CASE WHEN pos <= n_items // 2 THEN 'history' ELSE 'holdout' END AS part FROM pos""")
    s["q08_popularity_rank"] = O.with_(["pop"], "SELECT item_id, average_rating, pop_rank FROM pop")
    s["q09_top_unread"] = O.with_(["users", "hist", "pop"], O.top_unread_sql("users", "hist", SERVE_N))
    s["q10_similar_users"] = O.with_(["simpairs"], "SELECT user_id, count(*) AS n_similar FROM simpairs GROUP BY user_id")
    s["q11_coread_counts"] = O.with_(["cfcnt"], """
SELECT user_id, count(*) AS n_candidates, CAST(sum(cnt) AS BIGINT) AS total_count, max(cnt) AS max_count
FROM cfcnt GROUP BY user_id""")
    s["q12_cf_topn"] = O.with_(["cfcnt"], O.cf_top_sql(SERVE_N))
    s["q13_train_embeddings"] = O.with_(["emb", "isplit"], """
SELECT e.item_id, CAST(len(e.embedding) AS INTEGER) AS dims, CAST(e.embedding[1] AS DOUBLE) AS first_value
FROM emb e WHERE e.item_id IN (SELECT item_id FROM isplit WHERE split = 'train')""")
    s["q14_cosine_knn"] = O.with_(["knn"], "SELECT query_id, knn_rank, item_id, round(distance, 6) AS distance FROM knn")
    s["q15_content_topn"] = O.with_(["cbcand"], f"""
SELECT user_id, rank, item_id, round(distance, 6) AS distance FROM ({O.cb_top_sql(SERVE_N)})""")
    three = _three_sql(SERVE_N)
    scores = ("sc", O.rrf_sql(f"p{SERVE_N}", f"c{SERVE_N}", f"b{SERVE_N}"))
    s["q16_rrf"] = O.with_(_CHAIN, f"""
SELECT user_id, rank, item_id, round(score, 6) AS score FROM ({O.fused_top_sql('sc', None)})""", three + [scores])
    weights = ("w", """
SELECT u.user_id, coalesce(l.hist_len, 0) AS history_len,
       1.0 / (1.0 + exp(-CAST(coalesce(l.hist_len, 0) AS DOUBLE) / 20.0)) AS w0,
       (1.0 - 1.0 / (1.0 + exp(-CAST(coalesce(l.hist_len, 0) AS DOUBLE) / 20.0))) / 2 AS w1,
       (1.0 - 1.0 / (1.0 + exp(-CAST(coalesce(l.hist_len, 0) AS DOUBLE) / 20.0))) / 2 AS w2
FROM (SELECT DISTINCT user_id FROM users) u LEFT JOIN hlen l ON l.user_id = u.user_id""")
    s["q17_popularity_weight"] = O.with_(["users", "hlen"], """
SELECT user_id, CAST(history_len AS BIGINT) AS history_len, round(w0, 6) AS w0, round(w1, 6) AS w1, round(w2, 6) AS w2 FROM w""",
                                       [weights])
    wscores = ("sc", O.rrf_sql(f"p{SERVE_N}", f"c{SERVE_N}", f"b{SERVE_N}", "w"))
    s["q18_weighted_rrf"] = O.with_(_CHAIN + ["hlen"], f"""
SELECT user_id, rank, item_id, round(score, 6) AS score FROM ({O.fused_top_sql('sc', SERVE_N)})""", three + [weights, wscores])
    s["q19_hybrid"] = O.with_(_CHAIN, f"""
SELECT user_id, rank, item_id, round(score, 6) AS score FROM ({O.fused_top_sql('sc', SERVE_N)})""", three + [scores])
    adhoc = """
SELECT r.user_id, CAST(NULL AS BIGINT) AS pos, r.item_id FROM reads r JOIN (
  SELECT user_id, ts, order_key FROM (
    SELECT user_id, ts, order_key, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, order_key DESC) AS rn FROM reads)
  WHERE rn = 1) l ON r.user_id = l.user_id AND r.ts = l.ts AND r.order_key = l.order_key"""
    s["q20_adhoc_history"] = O.with_(
        _CHAIN + ["readers"], f"""
SELECT user_id, rank, item_id, round(score, 6) AS score FROM ({O.fused_top_sql('sc', SERVE_N)})""",
        _three_sql(SERVE_N, "readers") + [scores],
        override={"hist": adhoc},
    )
    names, extra = _warm_eval_ctes()
    s["q21_metrics_per_user"] = O.with_(names, "SELECT user_id, metric, round(value, 6) AS value FROM per_user", extra)
    s["q22_eval_warm"] = O.with_(names, """
SELECT metric, round(avg(value), 6) AS value, count(*) AS n_users FROM per_user GROUP BY metric""", extra)
    cnames, cextra = _cold_eval_ctes()
    s["q23_eval_cold"] = O.with_(cnames, """
SELECT metric, round(avg(value), 6) AS value, count(*) AS n_users FROM per_user GROUP BY metric""", cextra)
    wx = _means("wm", (names, extra))
    cx = _means("cm", (cnames, cextra))
    s["q24_compare"] = O.with_(names + cnames, """
SELECT w.metric, round(w.value, 6) AS regular, round(c.value, 6) AS cold_start, round(w.value - c.value, 6) AS difference,
       rpad(w.metric, 15, ' ') || printf(' %.4f %.4f %.4f', w.value, c.value, w.value - c.value) AS report
FROM (SELECT metric, avg(value) AS value FROM wm_per_user GROUP BY metric) w
JOIN (SELECT metric, avg(value) AS value FROM cm_per_user GROUP BY metric) c ON w.metric = c.metric""", wx + cx)
    s["q25_missing_users"] = O.with_(["users", "reads"], """
SELECT u.user_id FROM (SELECT user_id FROM users UNION ALL SELECT -user_id FROM users WHERE user_id % 50 = 0) u
WHERE NOT EXISTS (SELECT 1 FROM reads r WHERE r.user_id = u.user_id)""")
    s["q26_json_ingest"] = O.with_(["items"], """
SELECT item_id, title, average_rating, CAST(coalesce(length(description), 0) AS BIGINT) AS description_chars,
       concat_ws('|', title, 's') AS series, 'a' || item_id AS author, 'to-read=' || item_id || '|owned=' || item_id AS shelves
FROM items WHERE item_id IS NOT NULL""")
    s["q27_description_filter"] = O.with_(["items"], "SELECT item_id, CAST(length(t) AS BIGINT) AS n_chars FROM descr", [_DESCR])
    s["q28_embed_job"] = O.with_(["items"], f"""
SELECT item_id, bucket, round(CAST(CAST(CAST(c AS DOUBLE) / sqrt(sum(c * c) OVER (PARTITION BY item_id)) AS FLOAT) AS DOUBLE), 6) AS weight
FROM (SELECT item_id, {_BUCKET} AS bucket, count(*) AS c FROM tp GROUP BY ALL)""", [_DESCR, _TOKLIST, _TOKPOS])
    s["q44_embedding_job"] = s["q28_embed_job"]
    s["q29_pooling"] = O.with_(["items"], f"""
SELECT item_id, 'sentence' AS mode, {_BUCKET} AS dim, CAST(1.0 AS DOUBLE) AS value FROM tp WHERE pos = 0
UNION ALL
SELECT b.item_id, 'query' AS mode, b.dim, round(CAST(b.c AS DOUBLE) / CAST(n.m AS DOUBLE), 6) AS value
FROM (SELECT item_id, {_BUCKET} AS dim, count(*) AS c FROM tp WHERE length(tok) > 1 GROUP BY ALL) b
JOIN (SELECT item_id, count(*) AS m FROM tp WHERE length(tok) > 1 GROUP BY item_id) n ON n.item_id = b.item_id""", [_DESCR, _TOKLIST, _TOKPOS])
    s["q30_merge_shards"] = O.with_(["emb"], f"""
SELECT item_id, batch, unnest(range(0, len(embedding)))::INTEGER AS place, round(CAST(unnest(embedding) AS DOUBLE), 6) AS value
FROM (SELECT item_id, embedding, (row_number() OVER (ORDER BY item_id) - 1) // {TOTAL_ROWS} AS batch FROM emb)""")
    s["q31_csv_ingest"] = O.with_(["reads"], "SELECT user_id, item_id, is_read, rating, is_reviewed FROM reads")
    s["q46_master_chunks"] = f"""
WITH r AS (
  SELECT CAST(l_partkey AS BIGINT) AS item_id, CAST(o_custkey AS BIGINT) AS u, CAST(ceil(l_quantity / 10) AS INTEGER) AS g, CAST(l_linestatus = 'F' AS INTEGER) AS v,
         row_number() OVER (PARTITION BY l_partkey ORDER BY o_orderdate, l_orderkey, l_linenumber, o_custkey, ceil(l_quantity / 10), l_linestatus = 'F') - 1 AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R')
SELECT item_id, pos // {NESTED_ROWS} AS chunk, count(*) AS n_rows, string_agg(u || ':' || g || ':' || v, '|' ORDER BY pos) AS interactions
FROM r GROUP BY 1, 2"""
    s["q45_text_ids"] = """
WITH ia AS (
  SELECT o_orderkey AS k, CAST(o_custkey AS BIGINT) AS u, CAST(l_partkey AS BIGINT) AS b, CAST(l_returnflag <> 'R' AS INTEGER) AS r,
         CAST(ceil(l_quantity / 10) AS INTEGER) AS g, CAST(l_linestatus = 'F' AS INTEGER) AS v, CAST((o_custkey + l_partkey) % 2 = 0 AS INTEGER) AS delivery
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
j AS (SELECT *, CASE WHEN k % 71 = 0 THEN 'malformed' WHEN k % 97 = 0 THEN 'no user' WHEN k % 89 = 0 THEN 'no item' WHEN k % 83 = 0 THEN 'bad is_read'
                     WHEN k % 79 = 0 THEN 'bad rating' WHEN k % 73 = 0 THEN 'bad is_reviewed' ELSE '' END AS reason FROM ia),
un AS (SELECT u, row_number() OVER (ORDER BY min(delivery), 'u' || u) AS n FROM j WHERE reason = '' GROUP BY u),
bn AS (SELECT b, row_number() OVER (ORDER BY min(delivery), 'b' || b) AS n FROM j WHERE reason = '' GROUP BY b)
SELECT un.n AS user_id, bn.n AS item_id, r AS is_read, g AS rating, v AS is_reviewed, reason, delivery FROM j JOIN un USING (u) JOIN bn USING (b) WHERE reason = ''
UNION ALL SELECT 0, 0, 0, 0, 0, reason, delivery FROM j WHERE reason <> ''"""
    s["q32_materialise_once"] = s["q08_popularity_rank"]
    tnames, textra = _warm_eval_ctes(textbook=True, ndcg_only=True)
    s["q33_textbook_ndcg"] = O.with_(tnames, "SELECT user_id, metric, round(value, 6) AS value FROM per_user", textra)
    s["q34_metric_sink"] = O.with_(names + cnames, """
SELECT 'r1' AS run, 'warm' AS scenario, metric, round(avg(value), 6) AS value FROM wm_per_user GROUP BY metric
UNION ALL
SELECT 'r1' AS run, 'cold' AS scenario, metric, round(avg(value), 6) AS value FROM cm_per_user GROUP BY metric""", wx + cx)
    s["q35_embedding_totals"] = O.with_(["items"], f"""
SELECT (rn - 1) // {TOTAL_ROWS} AS batch, count(*) AS n_rows
FROM (SELECT row_number() OVER (ORDER BY item_id) AS rn FROM descr) GROUP BY 1""", [_DESCR])
    genres = """
SELECT DISTINCT item_id, trim(g) AS genre FROM (
  SELECT CAST(p_partkey AS BIGINT) AS item_id,
         unnest(regexp_split_to_array(lower(p_brand) || ', ' || lower(p_type), ',\\s*')) AS g FROM part)
WHERE trim(g) <> ''"""
    ia = "SELECT DISTINCT CAST(l_partkey AS BIGINT) AS item_id, CAST(l_suppkey AS BIGINT) AS author_id FROM lineitem"
    s["q36_master_table"] = O.with_(["items", "reads"], """
SELECT i.item_id, i.title, i.average_rating, CAST(coalesce(length(i.description), 0) AS BIGINT) AS description_chars,
       coalesce(a.n, '') AS authors, coalesce(g.n, '') AS genres,
       coalesce(r.n_reads, 0) AS n_reads, coalesce(r.n_readers, 0) AS n_readers
FROM items i
LEFT JOIN (SELECT item_id, string_agg(author_id || '=' || s_name || '=' || CAST(s_acctbal AS DECIMAL(12,2)) || '=' || CASE WHEN (item_id + author_id) % 3 = 0 THEN 'editor' ELSE '' END, '|' ORDER BY author_id) AS n
           FROM ia JOIN supplier ON s_suppkey = author_id GROUP BY item_id) a ON a.item_id = i.item_id
LEFT JOIN (SELECT item_id, string_agg(genre, '|' ORDER BY genre) AS n FROM gn GROUP BY item_id) g ON g.item_id = i.item_id
LEFT JOIN (SELECT item_id, count(*) AS n_reads, count(DISTINCT user_id) AS n_readers FROM reads GROUP BY item_id) r ON r.item_id = i.item_id""",
                                  [("gn", genres), ("ia", ia)])
    flat = """
SELECT i.item_id, i.title, i.average_rating, ia.author_id, s.s_name AS author_name, gn.genre
FROM items i LEFT JOIN ia ON ia.item_id = i.item_id
LEFT JOIN supplier s ON CAST(s.s_suppkey AS BIGINT) = ia.author_id
LEFT JOIN gn ON gn.item_id = i.item_id"""
    s["q37_flatten"] = O.with_(["items"], "SELECT * FROM flat", [("gn", genres), ("ia", ia), ("flat", flat)])
    s["q38_master_slices"] = O.with_(["items", "reads"], """
SELECT g.genre, count(*) AS n_items, CAST(coalesce(sum(r.n), 0) AS BIGINT) AS n_reads
FROM (SELECT DISTINCT item_id, genre FROM flat WHERE genre IS NOT NULL) g
LEFT JOIN (SELECT item_id, count(*) AS n FROM reads GROUP BY item_id) r ON r.item_id = g.item_id
GROUP BY g.genre""", [("gn", genres), ("ia", ia), ("flat", flat)])
    s["q39_tfidf"] = O.with_(["items"], f"""
SELECT item_id, rank, term, round(weight, 6) AS weight FROM (
  SELECT item_id, term, weight, row_number() OVER (PARTITION BY item_id ORDER BY weight DESC, term) AS rank FROM (
    SELECT w.item_id, w.term, w.w / sqrt(sum(w.w * w.w) OVER (PARTITION BY w.item_id)) AS weight FROM (
      SELECT tf.item_id, tf.term,
             tf.c * (ln((1.0 + (SELECT count(DISTINCT item_id) FROM descr)) / (1.0 + df.n)) + 1.0) AS w
      FROM (SELECT item_id, tok AS term, CAST(count(*) AS DOUBLE) AS c FROM tp GROUP BY ALL) tf
      JOIN (SELECT tok AS term, CAST(count(DISTINCT item_id) AS DOUBLE) AS n FROM tp GROUP BY tok) df ON df.term = tf.term) w))
WHERE rank <= {TOP_TERMS}""", [_DESCR, _TOKLIST, _TOKPOS])
    s["q40_radius"] = O.with_(["hd", "embn"], f"""
SELECT h.user_id, count(DISTINCT n.item_id) AS n_within
FROM hd h JOIN (
  SELECT a.item_id AS query_id, c.item_id FROM embn a CROSS JOIN embn c
  WHERE a.item_id IN (SELECT item_id FROM hd)
    AND (CASE WHEN a.nrm = 0 OR c.nrm = 0 THEN 1.0
              ELSE least(greatest(1.0 - list_inner_product(a.v, c.v) / (a.nrm * c.nrm), 0.0), 2.0) END) <= {RADIUS}) n
  ON n.query_id = h.item_id
GROUP BY h.user_id""")
    s["q41_first_test_users"] = O.with_(["usplit"], "SELECT user_id FROM usplit WHERE split = 'test' AND shuffle_pos <= 10")
    s["q42_preview"] = O.with_(["reads"], "SELECT user_id, item_id, rating FROM reads ORDER BY user_id, item_id, rating LIMIT 20")
    s["q43_item_readers"] = O.with_(["reads"], """
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY user_id) AS pos, user_id FROM reads""")
    return s


ORACLE = _sql()
