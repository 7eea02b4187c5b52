"""rankshelf: Spark-native recommendation and ranking evaluation.

The public surface, all DataFrame in / DataFrame out::

    from rankshelf import Tables, popular, top_unread, collaborative, content_based
    from rankshelf import rrf, recommend, ranking_metrics, evaluate, embed
"""

from rankshelf.operators.collaborative import collaborative, coread_counts, similar_user_counts, similar_users
from rankshelf.operators.content import content_based, cosine_knn, radius_union
from rankshelf.operators.embed import embed, embedding_job, pool
from rankshelf.operators.fusion import fusion_weights, rrf, stack_rankings
from rankshelf.operators.metrics import mean_metrics, ranking_metrics
from rankshelf.operators.popularity import popular, top_unread
from rankshelf.operators.readlists import (
    history_holdout, histories_of, holdouts_of, split_ids, user_read_lists,
)
from rankshelf.plans.evaluate import compare, evaluate, test_users
from rankshelf.plans.recommend import adhoc_histories, recommend
from rankshelf.sources.tables import Tables

__all__ = [
    "Tables", "popular", "top_unread", "collaborative", "coread_counts", "similar_users", "similar_user_counts",
    "content_based", "cosine_knn", "radius_union", "rrf", "stack_rankings", "fusion_weights", "recommend",
    "adhoc_histories", "ranking_metrics", "mean_metrics", "evaluate", "compare", "test_users", "split_ids",
    "history_holdout", "histories_of", "holdouts_of", "user_read_lists", "embed", "embedding_job", "pool",
]
