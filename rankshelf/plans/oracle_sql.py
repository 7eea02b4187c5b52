"""DuckDB twins of the catalogue queries (the correctness oracle).

Each query is assembled from named common table expressions that bind the
driver's tables exactly as :mod:`rankshelf.sources.tables` does. The oracle
is written the plain way (window over everything, cross products where the
Spark side uses blocked kernels) because it only runs on small scale factors.
"""

from __future__ import annotations

# Unicode white space as Python's str.strip() sees it (fixed character set).
WS_CLASS = r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"

CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (deps, body)


cte("inter", [], """
SELECT CAST(o.o_custkey AS BIGINT) AS user_id, CAST(l.l_partkey AS BIGINT) AS item_id,
       CAST(l.l_returnflag <> 'R' AS INTEGER) AS is_read,
       CAST(ceil(l.l_quantity / 10) AS INTEGER) AS rating,
       CAST(l.l_linestatus = 'F' AS INTEGER) AS is_reviewed,
       o.o_orderdate AS ts, l.l_orderkey AS order_key, l.l_linenumber AS line
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
cte("reads", ["inter"], "SELECT * FROM inter WHERE is_read = 1")
cte("users", [], "SELECT CAST(c_custkey AS BIGINT) AS user_id FROM customer")
cte("readers", ["reads"], "SELECT DISTINCT user_id FROM reads")
cte("pos", ["reads"], """
SELECT user_id, item_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, order_key, line, item_id) AS pos,
       count(*) OVER (PARTITION BY user_id) AS n_items
FROM reads""")
cte("hist", ["pos"], "SELECT user_id, pos, item_id FROM pos WHERE pos <= n_items // 2")
cte("holdout", ["pos"], "SELECT user_id, pos, item_id FROM pos WHERE pos > n_items // 2")
cte("hd", ["hist"], "SELECT DISTINCT user_id, item_id FROM hist")
cte("hlen", ["hist"], "SELECT user_id, count(*) AS hist_len, count(DISTINCT item_id) AS hist_distinct FROM hist GROUP BY user_id")
cte("items", [], """
SELECT CAST(p.p_partkey AS BIGINT) AS item_id,
       CASE WHEN p.p_partkey % 17 = 0 THEN '' ELSE CAST(r.avg_q AS VARCHAR) END AS average_rating,
       p.p_name AS title, d.text AS description
FROM part p
LEFT JOIN (SELECT l_partkey, avg(l_quantity) AS avg_q FROM lineitem GROUP BY l_partkey) r ON p.p_partkey = r.l_partkey
LEFT JOIN documents d ON p.p_partkey = d.doc_id""")
cte("pop", ["items"], """
SELECT item_id, rating AS average_rating, row_number() OVER (ORDER BY rating DESC, item_id) AS pop_rank
FROM (SELECT item_id, TRY_CAST(average_rating AS DOUBLE) AS rating FROM items
      WHERE item_id IS NOT NULL AND average_rating IS NOT NULL AND average_rating <> '')
WHERE rating IS NOT NULL AND NOT isnan(rating)""")
cte("emb", [], "SELECT CAST(vec_id AS BIGINT) AS item_id, embedding FROM embeddings")
cte("embn", ["emb"], """
SELECT item_id, CAST(embedding AS DOUBLE[]) AS v,
       sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS nrm
FROM emb""")
cte("usplit", ["reads"], """
SELECT user_id, shuffle_pos, CASE WHEN shuffle_pos <= n // 5 THEN 'test' ELSE 'train' END AS split
FROM (SELECT user_id,
             row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR) || ':42'), user_id) AS shuffle_pos,
             count(*) OVER () AS n
      FROM (SELECT DISTINCT user_id FROM reads))""")
cte("test_users", ["usplit"], "SELECT user_id FROM usplit WHERE split = 'test'")
cte("isplit", ["items"], """
SELECT item_id, shuffle_pos, CASE WHEN shuffle_pos <= n // 5 THEN 'test' ELSE 'train' END AS split
FROM (SELECT item_id,
             row_number() OVER (ORDER BY md5(CAST(item_id AS VARCHAR) || ':42'), item_id) AS shuffle_pos,
             count(*) OVER () AS n
      FROM items)""")
# collaborative
cte("mult", ["reads"], "SELECT user_id AS other_id, item_id, count(*) AS mult FROM reads GROUP BY user_id, item_id")
cte("simpairs", ["hd", "reads"], """
SELECT DISTINCT h.user_id, r.user_id AS other_id
FROM hd h JOIN (SELECT DISTINCT user_id, item_id FROM reads) r ON h.item_id = r.item_id
WHERE h.user_id <> r.user_id""")
cte("cfcnt", ["simpairs", "mult", "hd"], """
SELECT c.user_id, c.item_id, c.cnt FROM (
  SELECT s.user_id, m.item_id, CAST(sum(m.mult) AS BIGINT) AS cnt
  FROM simpairs s JOIN mult m ON s.other_id = m.other_id GROUP BY s.user_id, m.item_id) c
WHERE NOT EXISTS (SELECT 1 FROM hd WHERE hd.user_id = c.user_id AND hd.item_id = c.item_id)""")
# content
cte("qk", ["hd", "hlen"], """
SELECT h.item_id AS query_id, max(10 + l.hist_len) AS k FROM hd h JOIN hlen l ON h.user_id = l.user_id GROUP BY h.item_id""")
cte("knn", ["qk", "embn"], """
SELECT query_id, item_id, distance, knn_rank FROM (
  SELECT q.query_id, c.item_id, q.k, d.distance,
         row_number() OVER (PARTITION BY q.query_id ORDER BY d.distance, c.item_id) AS knn_rank
  FROM qk q JOIN embn a ON a.item_id = q.query_id CROSS JOIN embn c,
  LATERAL (SELECT CASE WHEN a.nrm = 0 OR c.nrm = 0 THEN 1.0
                       ELSE least(greatest(1.0 - list_inner_product(a.v, c.v) / (a.nrm * c.nrm), 0.0), 2.0) END AS distance) d)
WHERE knn_rank <= k""")
cte("cbcand", ["hd", "hlen", "knn"], """
SELECT b.user_id, b.item_id, min(b.distance) AS distance FROM (
  SELECT h.user_id, k.item_id, k.distance FROM hd h JOIN hlen l ON h.user_id = l.user_id
  JOIN knn k ON k.query_id = h.item_id WHERE k.knn_rank <= 10 + l.hist_len) b
WHERE NOT EXISTS (SELECT 1 FROM hd WHERE hd.user_id = b.user_id AND hd.item_id = b.item_id)
GROUP BY b.user_id, b.item_id""")


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CTE[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_(names: list[str], body: str, extra: list[tuple[str, str]] | None = None,
          override: dict[str, str] | None = None) -> str:
    """``WITH`` the named CTEs (and their dependencies), then ``extra`` in order, then ``body``.

    ``override`` replaces the body of a named CTE (same name, dependencies kept).
    """
    override = override or {}
    parts = [f"{n} AS ({override.get(n, CTE[n][1])})" for n in _closure(names)]
    parts += [f"{n} AS ({b})" for n, b in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---- parameterised fragments -------------------------------------------------

def top_unread_sql(users_cte: str, hist_cte: str, n: int) -> str:
    """Top ``n`` popular items not in the history, per user of ``users_cte``."""
    return f"""
SELECT user_id, rank, item_id FROM (
  SELECT u.user_id, p.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY p.pop_rank) AS rank
  FROM (SELECT DISTINCT user_id FROM {users_cte}) u
  LEFT JOIN (SELECT user_id, count(DISTINCT item_id) AS m FROM {hist_cte} GROUP BY user_id) hm ON hm.user_id = u.user_id
  JOIN pop p ON p.pop_rank <= {n} + coalesce(hm.m, 0)
  WHERE NOT EXISTS (SELECT 1 FROM {hist_cte} h WHERE h.user_id = u.user_id AND h.item_id = p.item_id))
WHERE rank <= {n}"""


def cf_top_sql(n: int) -> str:
    return f"""
SELECT user_id, rank, item_id, cnt FROM (
  SELECT user_id, item_id, cnt, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, item_id) AS rank FROM cfcnt)
WHERE rank <= {n}"""


def cb_top_sql(n: int) -> str:
    return f"""
SELECT user_id, rank, item_id, distance FROM (
  SELECT user_id, item_id, distance, row_number() OVER (PARTITION BY user_id ORDER BY distance, item_id) AS rank FROM cbcand)
WHERE rank <= {n}"""


def rrf_sql(pop_cte: str, cf_cte: str, cb_cte: str, weights_cte: str | None = None) -> str:
    """Scores per (user, item) with the first-seen tie keys; weights optional."""
    if weights_cte:
        w = {0: "w.w0", 1: "w.w1", 2: "w.w2"}
        join = f"LEFT JOIN {weights_cte} w ON w.user_id = s.user_id"
    else:
        w = {0: "1.0", 1: "1.0", 2: "1.0"}
        join = ""
    return f"""
SELECT user_id, item_id,
       coalesce(max(CASE WHEN source = 0 THEN c END), 0.0)
     + coalesce(max(CASE WHEN source = 1 THEN c END), 0.0)
     + coalesce(max(CASE WHEN source = 2 THEN c END), 0.0) AS score,
       arg_min(source, source * 1000000000 + rank) AS first_source,
       arg_min(rank, source * 1000000000 + rank) AS first_rank
FROM (
  SELECT s.user_id, s.item_id, s.source, s.rank,
         (CASE s.source WHEN 0 THEN {w[0]} WHEN 1 THEN {w[1]} ELSE {w[2]} END) * (1.0 / (CAST(s.rank AS DOUBLE) + 60.0)) AS c
  FROM (SELECT user_id, item_id, 0 AS source, rank FROM {pop_cte}
        UNION ALL SELECT user_id, item_id, 1 AS source, rank FROM {cf_cte}
        UNION ALL SELECT user_id, item_id, 2 AS source, rank FROM {cb_cte}) s {join})
GROUP BY user_id, item_id"""


def fused_top_sql(scores_cte: str, n: int | None) -> str:
    cut = f"WHERE rank <= {n}" if n is not None else ""
    return f"""
SELECT user_id, rank, item_id, score FROM (
  SELECT user_id, item_id, score,
         row_number() OVER (PARTITION BY user_id ORDER BY score DESC, first_source, first_rank) AS rank
  FROM {scores_cte}) {cut}"""


METRIC_VALUES = """
SELECT * FROM (VALUES ('NDCG@10', 'ndcg', 10), ('NDCG@20', 'ndcg', 20), ('Recall@10', 'recall', 10),
  ('Recall@20', 'recall', 20), ('Recall@50', 'recall', 50), ('Recall@100', 'recall', 100),
  ('Precision@1', 'precision', 1), ('Precision@2', 'precision', 2), ('Precision@5', 'precision', 5),
  ('Precision@10', 'precision', 10)) t(metric, kind, k)"""


def dsum(x: str) -> str:
    """``D(x) = sum_{j=1..x} 1/log2(j+1)`` as a left fold (same order as the Spark side)."""
    return f"list_reduce(list_prepend(0.0, list_transform(range(1, greatest({x}, 0) + 1), lambda j: 1.0 / log2(j + 1.0))), lambda acc, y: acc + y)"


def metrics_sql(preds_cte: str, truth_cte: str, users_cte: str, textbook: bool = False, ndcg_only: bool = False) -> list[tuple[str, str]]:
    """Extra CTEs ending in ``per_user(user_id, metric, value)``."""
    metric_filter = "WHERE kind = 'ndcg'" if ndcg_only else ""
    extra = [
        ("mv", f"SELECT * FROM ({METRIC_VALUES}) {metric_filter}"),
        ("tn", f"SELECT user_id, count(*) AS n_true FROM {truth_cte} GROUP BY user_id"),
        ("tset", f"SELECT DISTINCT user_id, item_id FROM {truth_cte}"),
        ("npred", f"SELECT user_id, count(*) AS n_pred FROM {preds_cte} GROUP BY user_id"),
        ("hr", f"""SELECT p.user_id, list_sort(list(CAST(p.rank AS INTEGER))) AS hit_ranks FROM {preds_cte} p
                 WHERE EXISTS (SELECT 1 FROM tset t WHERE t.user_id = p.user_id AND t.item_id = p.item_id)
                 GROUP BY p.user_id"""),
        ("ev", f"""SELECT u.user_id, tn.n_true, coalesce(np.n_pred, 0) AS n_pred,
                          coalesce(hr.hit_ranks, CAST([] AS INTEGER[])) AS hit_ranks
                   FROM (SELECT DISTINCT user_id FROM {users_cte}) u JOIN tn ON tn.user_id = u.user_id
                   LEFT JOIN npred np ON np.user_id = u.user_id LEFT JOIN hr ON hr.user_id = u.user_id"""),
        ("mb", """SELECT ev.user_id, ev.n_true, ev.n_pred, ev.hit_ranks, mv.metric, mv.kind, mv.k,
                         least(mv.k, ev.n_pred) AS m,
                         len(list_filter(ev.hit_ranks, lambda x: x <= mv.k)) AS r
                  FROM ev CROSS JOIN mv"""),
    ]
    if textbook:
        ndcg = f"""CASE WHEN r = 0 THEN 0.0 ELSE
                     list_reduce(list_prepend(0.0, list_transform(list_filter(hit_ranks, lambda x: x <= k), lambda x: 1.0 / log2(x + 1.0))), lambda acc, y: acc + y)
                     / {dsum('r')} END"""
    else:
        ndcg = f"""CASE WHEN r = 0 THEN 0.0 WHEN r = m THEN 1.0 ELSE
                     CAST(len(list_filter(hit_ranks, lambda x: x <= r)) AS DOUBLE) / r
                     + (CAST(r - len(list_filter(hit_ranks, lambda x: x <= r)) AS DOUBLE) / (m - r)) * ({dsum('m')} - {dsum('r')}) / {dsum('r')} END"""
    extra.append(("per_user", f"""
SELECT user_id, metric,
       CASE WHEN kind = 'ndcg' THEN (CASE WHEN m = 0 THEN 0.0 ELSE {ndcg} END)
            WHEN kind = 'recall' THEN CAST(r AS DOUBLE) / CAST(n_true AS DOUBLE)
            ELSE CAST(r AS DOUBLE) / CAST(k AS DOUBLE) END AS value
FROM mb"""))
    return extra
