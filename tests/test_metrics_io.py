"""Metrics, splits, ingest and sinks on hand-made fixtures."""

from __future__ import annotations

import itertools
import math
import hashlib
import os
import subprocess
import sys
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankshelf.functions.columns import unicode_strip
from rankshelf.operators.embed import check_mode, describable, embed, embedding_job, pool, pooled, token_states
from rankshelf.operators.metrics import METRICS, mean_metrics, ranking_metrics
from rankshelf.operators.readlists import history_holdout, split_ids, user_read_lists
from rankshelf.sources import io


def dcg(rel):
    return sum(r / math.log2(i + 2) for i, r in enumerate(rel))


def tie_averaged_ndcg(relevance):
    """Truth = sorted relevance, score = relevance; average DCG over orders of tied scores."""
    truth = sorted(relevance, reverse=True)
    idcg = dcg(truth)
    if idcg == 0:
        return 0.0
    idx = list(range(len(relevance)))
    ones = [i for i in idx if relevance[i] == 1]
    zeros = [i for i in idx if relevance[i] == 0]
    total, count = 0.0, 0
    for a in itertools.permutations(ones):
        for b in itertools.permutations(zeros):
            order = list(a) + list(b)
            total += dcg([truth[i] for i in order])
            count += 1
    return total / count / idcg


def test_ndcg_reference_form_against_brute_force(spark):
    cases = [bits for m in range(1, 7) for bits in itertools.product([0, 1], repeat=m)]
    preds, truth, users = [], [], []
    for u, bits in enumerate(cases):
        users.append((u,))
        for r, b in enumerate(bits):
            preds.append((u, r + 1, 1000 + r))
            if b:
                truth.append((u, 1000 + r))
        truth.append((u, -1))  # every user has a truth list
    p = spark.createDataFrame(preds, "user_id bigint, rank bigint, item_id bigint")
    t = spark.createDataFrame(truth, "user_id bigint, item_id bigint")
    us = spark.createDataFrame(users, "user_id bigint")
    got = {r.user_id: r.value for r in ranking_metrics(p, t, us, [("NDCG@10", "ndcg", 10)]).collect()}
    for u, bits in enumerate(cases):
        assert got[u] == pytest.approx(tie_averaged_ndcg(list(bits)), abs=1e-12), bits
    assert got[cases.index((0, 1, 0, 0, 0))] == pytest.approx(0.4871, abs=1e-4)


def test_recall_and_precision_denominators(spark):
    p = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12)], "user_id bigint, rank bigint, item_id bigint")
    t = spark.createDataFrame([(1, 10), (1, 10), (1, 12), (1, 99)], "user_id bigint, item_id bigint")
    us = spark.createDataFrame([(1,), (2,)], "user_id bigint")  # user 2 has no list: skipped
    got = {r.metric: r.value for r in ranking_metrics(p, t, us).collect()}
    assert got["Recall@10"] == pytest.approx(2 / 4)  # distinct hits over the list with duplicates
    assert got["Precision@10"] == pytest.approx(2 / 10)  # divides by k even with 3 predictions
    assert got["Precision@1"] == pytest.approx(1.0)
    assert set(got) == {m for m, _, _ in METRICS}
    means = {r.metric: r.n_users for r in mean_metrics(ranking_metrics(p, t, us)).collect()}
    assert set(means.values()) == {1}


def test_textbook_ndcg_option(spark):
    p = spark.createDataFrame([(1, r, 100 + r) for r in range(1, 6)], "user_id bigint, rank bigint, item_id bigint")
    t = spark.createDataFrame([(1, 102)], "user_id bigint, item_id bigint")
    us = spark.createDataFrame([(1,)], "user_id bigint")
    got = ranking_metrics(p, t, us, [("NDCG@10", "ndcg", 10)], "textbook").first().value
    assert got == pytest.approx(1 / math.log2(3))
    with pytest.raises(ValueError):
        ranking_metrics(p, t, us, ndcg_form="other")


def test_split_seven_ids(spark):
    ids = spark.createDataFrame([(i,) for i in range(7)], "item_id bigint")
    rows = split_ids(ids, "item_id").collect()
    test = [r.item_id for r in rows if r.split == "test"]
    train = [r.item_id for r in rows if r.split == "train"]
    assert len(test) == 1 and len(train) == 6 and not set(test) & set(train)
    assert sorted(test + train) == list(range(7))
    assert rows == split_ids(ids.repartition(3), "item_id").collect() or sorted(rows) == sorted(split_ids(ids.repartition(3), "item_id").collect())


def test_history_holdout_halves(spark):
    rows = [(1, 10, 1), (2, 20, 1), (2, 21, 2), (3, 30, 1), (3, 31, 2), (3, 30, 3)]
    reads = spark.createDataFrame(
        [(u, i, (s,)) for u, i, s in rows], "user_id bigint, item_id bigint, seq struct<s:int>"
    )
    got = sorted((r.user_id, r.pos, r.item_id, r.part) for r in history_holdout(reads).collect())
    assert got == [
        (1, 1, 10, "holdout"),
        (2, 1, 20, "history"), (2, 2, 21, "holdout"),
        (3, 1, 30, "history"), (3, 2, 31, "holdout"), (3, 3, 30, "holdout"),
    ]
    lists = {r.user_id: r.items for r in user_read_lists(reads).collect()}
    assert lists[3] == [30, 31, 30]


def test_unicode_strip(spark):
    df = spark.createDataFrame([("\t\n  ",), ("  a b \n",), (None,)], "d string")
    got = [r.s for r in df.select(unicode_strip("d").alias("s")).collect()]
    assert got == ["", "a b", None]


def test_json_ingest_modes(spark):
    folder = tempfile.mkdtemp(prefix="json-")
    path = os.path.join(folder, "items.json")
    with open(path, "w") as f:
        f.write('{"book_id": "1", "average_rating": "4.0", "description": "x"}\n')
        f.write("\n")
        f.write("   \n")
        f.write('{"book_id": "2", "average_rating": \n')
        f.write('{"average_rating": "3.0"}\n')
        f.write('{"book_id": null, "average_rating": "3.0"}\n')
        f.write('{"book_id": "3", "average_rating": "", "description": null}\n')
    permissive = io.read_items_json(spark, path, "PERMISSIVE")
    assert io.malformed_count(permissive) == 1
    assert sorted(r.item_id for r in io.items_from_json(permissive).collect()) == [1, 3]
    dropped = io.read_items_json(spark, path, "DROPMALFORMED")
    assert sorted(r.item_id for r in io.items_from_json(dropped).collect()) == [1, 3]
    with pytest.raises(Exception):
        io.read_items_json(spark, path, "FAILFAST").collect()


def test_unfinished_stage_is_built_again(spark):
    path = tempfile.mkdtemp(prefix="stage-") + "/t"
    spark.range(24).write.parquet(path)
    os.remove(path + "/_SUCCESS")  # what a crashed write leaves
    assert io.materialise(spark, path, lambda: spark.range(100)).count() == 100
    assert io.materialise(spark, path, lambda: spark.range(3)).count() == 100


def test_scratch_needs_a_shared_folder_off_local_masters():
    from rankshelf.session import ensure_checkpoint_dir

    class Stub:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, *_):
            return None

    stub = Stub()
    stub.sparkContext = stub.conf = stub
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(stub)


def test_scratch_is_gone_after_the_session():
    code = (
        "from rankshelf.session import local_session, stage\n"
        "s = local_session('1', 1)\n"
        "d = stage(s.range(3), 'x')\n"
        "print('AT', d._staged_at)\n"
        "s.stop()\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = done.stdout.split("AT ")[1].split()[0].removeprefix("file:")
    assert not os.path.exists(os.path.dirname(path))


def test_text_ids_are_mapped(spark):
    raw = spark.createDataFrame([("b", "B"), ("a", "A"), (None, "-"), ("b", "B2"), ("7", "S")], "book_id string, title string")
    ids = io.id_map(raw)
    got = sorted((r.item_id, r.title) for r in io.items_from_json(raw, ids).collect())
    assert got == [(1, "S"), (2, "A"), (3, "B"), (3, "B2")]
    assert [(r.item_id, r.title) for r in io.items_from_json(raw).collect()] == [(7, "S")]  # no null id comes out


def test_authors_and_genres_readers(spark):
    root = tempfile.mkdtemp(prefix="aux-")
    with open(root + "/a.csv", "w") as f:
        f.write('author_id,name,average_rating,text_reviews_count,ratings_count\n5,"Doe, J.",4.5,1,2\n')
    with open(root + "/g.json", "w") as f:
        f.write('{"book_id": "9", "genres": {"history, biography": 3}}\n')
    assert io.read_authors_csv(spark, root + "/a.csv").first().name == "Doe, J."
    assert io.read_genres_json(spark, root + "/g.json").first().genres == {"history, biography": 3}


def test_merge_shards_rejects_duplicate_ids(spark):
    root = tempfile.mkdtemp(prefix="shards-")
    df = spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0), (2, [3.0], 1)], "item_id bigint, embedding array<float>, batch int")
    io.write_embedding_shards(df, root + "/s")
    with pytest.raises(ValueError):
        io.merge_shards(spark, root + "/s")


def test_materialise_builds_once(spark):
    path = tempfile.mkdtemp(prefix="stage-") + "/t"
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    io.materialise(spark, path, build)
    assert io.materialise(spark, path, build).count() == 3
    assert len(calls) == 1


def test_embed_builds_one_encoder_per_worker(spark):
    class TwoTokenEncoder:
        """States of the first two characters; a blank is masked out. Leaves a file for every build."""

        def __init__(self, folder):
            self._file = tempfile.mkstemp(dir=folder)

        def encode(self, texts):
            codes = np.array([[ord(c) for c in t[:2].ljust(2)] for t in texts], float)
            return np.stack([codes, codes * 2], axis=2), codes != 32

    folder = tempfile.mkdtemp(prefix="builds-")
    texts = spark.createDataFrame([(i, f"{chr(97 + i % 26)} text") for i in range(200)], "item_id bigint, text string").repartition(16)
    factory = lambda: TwoTokenEncoder(folder)
    first = {r.item_id: list(r.embedding) for r in embed(texts, factory, "two", 7).collect()}
    mean = {r.item_id: list(r.embedding) for r in embed(texts, factory, "two", 7, mode="query").collect()}
    assert first[1] == [98.0, 196.0] and mean[1] == [98.0, 196.0]  # the blank in second place is masked out
    assert len(first) == len(mean) == 200
    assert len(os.listdir(folder)) <= spark.sparkContext.defaultParallelism * 2 < 16
    with pytest.raises(ValueError):
        embed(texts, factory)


def test_pooled_masks():
    states = np.arange(12.0).reshape(1, 3, 4)
    assert (pooled(states, np.array([[0, 1, 1]]), "query") == states[0, 1:].mean(axis=0)).all()
    assert (pooled(states, np.array([[0, 0, 0]]), "query") == 0).all()
    assert (pooled(states, np.array([[0, 1, 1]]), "sentence") == states[0, 0]).all()


def test_hashing_embed(spark):
    items = spark.createDataFrame(
        [(1, "  Der Hund, der Hund!  "), (2, "\t\n"), (3, "Éte 42 été"), (4, None), (5, " - ")], "item_id bigint, description string"
    )
    texts = describable(items)
    rows = {r.item_id: np.array(r.embedding) for r in embed(texts, mode="query").collect()}
    assert sorted(rows) == [1, 3, 5] and all(len(v) == 64 for v in rows.values())
    assert np.linalg.norm(rows[1]) == pytest.approx(1) and (rows[1] > 0).sum() == 2 and not rows[5].any()
    with pytest.raises(ValueError, match="Invalid mode"):
        check_mode("other")
    with pytest.raises(ValueError, match="Invalid mode"):
        embed(texts, mode="other")


def test_rows_that_share_an_id_keep_their_own_vector(spark):
    rows = [(1, "alpha beta"), (1, "gamma"), (None, "gamma gamma"), (2, None), (1, "alpha beta"), (3, "wort " * 5000 + "ende")]
    texts = spark.createDataFrame(rows, "item_id bigint, text string").repartition(3)

    def bucket(token):
        return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 64

    def plain(text, mode):
        words = (text or "").split()[: 1 if mode == "sentence" else None]
        v = np.bincount([bucket(w) for w in words], minlength=64).astype(float)
        return tuple(np.float32(v / (np.linalg.norm(v) or 1)))

    for mode in ("query", "sentence"):
        out = embed(texts, mode=mode)
        got = sorted((r.item_id or 0, tuple(np.float32(r.embedding))) for r in out.collect())
        assert np.allclose([g[1] for g in got], [e[1] for e in sorted((i or 0, plain(t, mode)) for i, t in rows)])
    plan = embed(spark.createDataFrame(rows, "item_id bigint, text string"), mode="query")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan


def test_embedding_job_writes_bounded_shards(spark):
    root = tempfile.mkdtemp(prefix="job-")
    with open(root + "/items.json", "w") as f:
        f.write('{"book_id": "3", "description": "c"}\n{broken\n\n{"book_id": "1", "description": "a b"}\n')
        f.write('{"book_id": "x", "description": "no number"}\n{"book_id": "2", "description": " "}\n{"description": "no id"}\n')
    embedding_job(spark, root + "/items.json", root + "/out", shard_rows=1)
    merged = io.merge_shards(spark, root + "/out")
    assert sorted((r.batch, r.item_id) for r in merged.collect()) == [(0, 1), (1, 3)]
    assert all(len([f for f in os.listdir(f"{root}/out/batch={b}") if f.endswith(".parquet")]) == 1 for b in (0, 1))


def test_pooling_modes(spark):
    texts = spark.createDataFrame([(1, "bb aa aa x"), (2, "x y")], "item_id bigint, text string")
    states = token_states(texts, dim=1000)
    first = pool(states.where("item_id = 1"), "sentence").collect()
    assert len(first) == 1 and first[0].value == 1.0
    mean = sorted((r.item_id, round(r.value, 6)) for r in pool(states, "query").collect())
    assert mean == [(1, round(1 / 3, 6)), (1, round(2 / 3, 6))]  # tokens of one character are masked out


def test_streaming_ingest_is_incremental(spark):
    from rankshelf.streaming.ingest import start_read_filter

    root = tempfile.mkdtemp(prefix="stream-")
    src, out, ckpt = root + "/in", root + "/out", root + "/ckpt"
    os.makedirs(src)
    with open(src + "/a.csv", "w") as f:
        f.write("user_id,item_id,is_read,rating,is_reviewed\n1,10,1,5,0\n1,11,0,3,0\n")
    q = start_read_filter(spark, src, out, ckpt)
    q.awaitTermination()
    assert sorted((r.user_id, r.item_id) for r in spark.read.parquet(out).collect()) == [(1, 10)]
    with open(src + "/b.csv", "w") as f:
        f.write("user_id,item_id,is_read,rating,is_reviewed\n2,12,1,4,1\n")
    q = start_read_filter(spark, src, out, ckpt)  # restart: only the new file is taken
    q.awaitTermination()
    assert sorted((r.user_id, r.item_id) for r in spark.read.parquet(out).collect()) == [(1, 10), (2, 12)]


def test_csv_ingest_explicit_and_inferred(spark):
    root = tempfile.mkdtemp(prefix="csv-")
    with open(root + "/part-0.csv", "w") as f:
        f.write("user_id,book_id,is_read,rating,is_reviewed\n1,10,1,5,0\n2,11,0,0,0\n3,12,1,4,1\n")
    inferred = io.read_interactions_csv(spark, root + "/part-0.csv", infer=True)
    assert dict(inferred.dtypes)["user_id"] == "int" and "item_id" in inferred.columns
    out = io.csv_to_parquet(spark, root + "/part-0.csv", root + "/pq")
    assert sorted((r.user_id, r.item_id) for r in out.collect()) == [(1, 10), (3, 12)]
    with pytest.raises(Exception):  # the sink refuses to overwrite, like the reference's writer default
        io.csv_to_parquet(spark, root + "/part-0.csv", root + "/pq")
    head = io.preview(out, ["user_id"], 1).collect()
    assert [(r.user_id, r.item_id) for r in head] == [(1, 10)]


def test_sql_cosine_matches_numpy(spark):
    import numpy as np

    from rankshelf.functions.columns import cosine_distance_unit, normalize

    rng = np.random.default_rng(1)
    a, b = rng.normal(size=6), rng.normal(size=6)
    df = spark.createDataFrame([(a.tolist(), b.tolist()), ([0.0] * 6, b.tolist())], "a array<double>, b array<double>")
    got = [r.d for r in df.select(cosine_distance_unit(normalize("a"), normalize("b")).alias("d")).collect()]
    want = 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    assert got[0] == pytest.approx(want, abs=1e-12)
    assert got[1] == pytest.approx(1.0)  # zero vector: distance 1


def test_compare_report_line(spark):
    from rankshelf.plans.evaluate import compare

    w = spark.createDataFrame([("NDCG@10", 0.5)], "metric string, value double")
    c = spark.createDataFrame([("NDCG@10", 0.25)], "metric string, value double")
    row = compare(w, c, with_report=True).first()
    assert row.difference == 0.25
    assert row.report == "NDCG@10         0.5000 0.2500 0.2500"


def test_checkpoint_folder_is_reused_and_public_api_imports(spark):
    import rankshelf
    from rankshelf.session import ensure_checkpoint_dir, scratch_dir, stage

    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()
    assert scratch_dir(spark, "t").startswith(first)
    staged = stage(spark.range(5), "api")
    assert staged.count() == 5
    assert callable(rankshelf.recommend) and "recommend" in rankshelf.__all__


def test_dictionary_numbers_never_change(spark):
    path = tempfile.mkdtemp(prefix="ids-") + "/d"
    frame = lambda *x: spark.createDataFrame([(i,) for i in x], "text_id string")
    numbers = lambda: {r.text_id: r.id for r in io.read_dictionary(spark, path).collect()}
    assert numbers() == {}
    io.extend_dictionary(spark, path, frame("m", None, "k", "m"))
    assert numbers() == {"k": 1, "m": 2}
    io.extend_dictionary(spark, path, frame("a", "m", "z"))
    assert numbers() == {"k": 1, "m": 2, "a": 3, "z": 4}
    os.makedirs(path + "/000002")  # what a crashed run leaves: no marker
    with open(path + "/000002/part-0.parquet", "w") as f:
        f.write("broken")
    assert numbers() == {"k": 1, "m": 2, "a": 3, "z": 4}
    io.extend_dictionary(spark, path, frame("k"))  # nothing new: no generation
    assert numbers() == {"k": 1, "m": 2, "a": 3, "z": 4}
    io.extend_dictionary(spark, path, frame("b", ""))
    assert numbers() == {"k": 1, "m": 2, "a": 3, "z": 4, "": 5, "b": 6}


def test_ingest_of_text_ids_rejects_with_reasons(spark):
    root = tempfile.mkdtemp(prefix="ingest-")
    lines = ["user_id,book_id,is_read,rating,is_reviewed", "u1,b9,1,5,0", "u1,b2,TRUE,,0", ",b2,1,1,1", "u2, ,1,1,1", "u2,b2,maybe,1,1", "u2,b2,0,x,1",
             "u2,b2,0,1,2", "u2,b2,0,1", "u2,b2,0,1,1,7", " u0 ,b2,false,3,true", "u1,b9,1,5,0"]
    with open(root + "/in.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    good, rejects = io.ingest_interactions(spark, root + "/in.csv", root + "/users", root + "/items")
    assert sorted(map(tuple, good.collect())) == [(1, 1, 0, 3, 1), (2, 2, 1, 5, 0), (2, 2, 1, 5, 0)]
    assert sorted(r.reason for r in rejects.collect()) == sorted(
        ["bad rating", "no user", "no item", "bad is_read", "bad rating", "bad is_reviewed", "malformed", "malformed"]
    )
    with open(root + "/more.csv", "w") as f:
        f.write("header\na,b9,1,1,1\n")
    good, rejects = io.ingest_interactions(spark, root + "/more.csv", root + "/users", root + "/items")
    assert [tuple(r) for r in good.collect()] == [(3, 2, 1, 1, 1)] and rejects.count() == 0


def test_repeated_metric_runs_replace_their_rows(spark):
    path = tempfile.mkdtemp(prefix="metrics-") + "/m"
    frame = lambda v: spark.createDataFrame([("ndcg", v), ("recall", v / 2)], "metric string, value double")
    for run, scenario, value in (("1", "warm", 0.4), ("1", "cold", 0.2), ("2", "warm", 0.6), ("1", "warm", 0.8)):
        io.append_metrics(frame(value), path, run, scenario)
    got = {(r.run, r.scenario, r.metric): r.value for r in io.read_metrics(spark, path).collect()}
    assert got == {("1", "warm", "ndcg"): 0.8, ("1", "warm", "recall"): 0.4, ("1", "cold", "ndcg"): 0.2, ("1", "cold", "recall"): 0.1,
                   ("2", "warm", "ndcg"): 0.6, ("2", "warm", "recall"): 0.3}


def test_stale_stages_are_built_again(spark):
    root = tempfile.mkdtemp(prefix="stage-")
    source, path, built = root + "/in", root + "/out", []

    def stage_of(k):
        mark = io.input_fingerprint(spark, {"k": k}, source)
        return io.materialise(spark, path, lambda: built.append(k) or spark.read.parquet(source).limit(k), mark).count()

    spark.range(10).write.parquet(source)
    assert stage_of(3) == 3 and stage_of(3) == 3 and built == [3]
    assert stage_of(4) == 4 and built == [3, 4]  # another parameter
    spark.range(2).write.mode("overwrite").parquet(source)
    assert stage_of(4) == 2 and built == [3, 4, 4]  # another input
    os.remove(path + "/_FINGERPRINT")  # a crash after the data
    assert stage_of(4) == 2 and built == [3, 4, 4, 4]
