"""Exact top-k inner products through an impact-ordered index.

Vectors are dealt into shards. In each shard, every dimension has posting
segments: the vectors whose component falls into one quantisation level. They
lie in tiers by descending impact (what a vector of the segment gains over the
dimension's worst one), and a block of queries visits tier by tier, adding
impacts to its accumulators. A query stops only on proof: what the unvisited
segments can still add at most must leave a short list of possible members,
every other vector being below the k-th lower bound. Possible members are
rescored exactly.

Vectors that are null or hold null or non-finite components, and rows without
an id, take no part. Vectors of different lengths have no inner product and are
no candidates of each other; components and scores beyond 64 bits are told as the
nearest long. Ties go
to the smaller id; repeated rows are separate candidates, but equal queries are
asked once; a query's own id is never its candidate; fewer than k candidates
are all returned; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SHARD_ROWS = 16_384  # vectors per index shard: bounds a task's memory
QUERY_BLOCK = 256  # queries that meet a shard in one task
LEVEL = 8  # width of a quantisation level
EXACT_SINGLE, EXACT_DOUBLE = 1 << 24, 1 << 53  # sums of whole numbers below these are exact as floats
SHORT_LIST = 64  # possible members at which a search may stop
TIER_SHARES = (0.75, 0.5, 0.0)  # of a dimension's levels: where its tiers end
TOGETHER = 128  # queries that go through the tiers at a time: bounds the accumulators


def quantise(embedding: Column, scale: int = 256) -> Column:
    """Each component x, as double, becomes floor(scale * x); null where the vector is unusable."""
    usable = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))
    return F.when(embedding.isNotNull() & usable, whole)


class ShardIndex:
    """Posting segments of one shard in tiers of descending impact, for blocks of queries.

    A segment's impact on a query is the query's weight times the segment's gain: its distance from the
    dimension's worst level, which is the lowest for positive weights and the highest for negative ones.
    Tiers are cut by gain, so each holds the postings with the next largest gains of all dimensions, and one
    product adds a tier's impacts to the accumulators of all queries that still need it.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.largest = max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0))))
        self._tiers: dict[type, list[tuple[np.ndarray, np.ndarray]]] = {}

    def tiers(self, kind: type) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per tier, by descending gain: the postings' least gains for weights of either sign (0: no posting), and what
        a vector can still gain at most in each dimension and sign by segments of later tiers."""
        if kind not in self._tiers:
            levels = self.vectors // LEVEL
            floor = np.concatenate([levels.min(axis=0), -levels.max(axis=0)])
            steps = np.concatenate([levels, -levels], axis=1) - floor  # levels above the worst one
            span = steps.max(axis=0)
            out, above = [], span + 1
            for share in TIER_SHARES:
                cut = np.ceil(span * share).astype(steps.dtype)
                posted = (steps >= cut) & (steps < above)
                out.append((np.where(posted, steps * LEVEL, 0).astype(kind), np.maximum(cut * LEVEL - 1, 0)))
                above = cut
            self._tiers[kind] = out
        return self._tiers[kind]

    def _search_all(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same where sums may leave 64 bits: exact whole numbers, told as the nearest long."""
        rest = np.flatnonzero(self.ids != query_id)
        scores = self.vectors[rest].astype(object) @ query.astype(object)
        best = sorted(range(len(rest)), key=lambda i: (-scores[i], self.ids[rest[i]]))[:k]
        limit = np.iinfo(np.int64)
        told = [min(max(scores[i], limit.min), limit.max) for i in best]
        return self.ids[rest[best]], np.array(told, np.int64)

    def _rescore(self, rest: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        rest = rest[self.ids[rest] != query_id]
        scores = self.vectors[rest].astype(np.int64) @ query
        best = np.lexsort((self.ids[rest], -scores))[:k]
        return self.ids[rest][best], scores[best]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, ids and scores of the shard's k best, ties to the smaller id."""
        n, width = self.vectors.shape
        found: list = [None] * len(queries)
        heaviest = [max((abs(w) for w in q), default=0) for q in queries.tolist()]
        # gains reach twice the largest component and a level more
        sums = [width * h * 2 * (self.largest + LEVEL) for h in heaviest]
        for i, total in enumerate(sums):
            if total >= EXACT_DOUBLE:
                found[i] = self._search_all(int(query_ids[i]), queries[i], k)
        for kind, least, limit in ((np.float32, 0, EXACT_SINGLE), (np.float64, EXACT_SINGLE, EXACT_DOUBLE)):
            chosen = [i for i, total in enumerate(sums) if least <= total < limit]
            for start in range(0, len(chosen), TOGETHER):
                self._search_tiers(np.array(chosen[start : start + TOGETHER]), query_ids, queries, k, kind, found)
        return found

    def _search_tiers(
        self, open_: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, kind: type, found: list
    ) -> None:
        """Answers of the queries at ``open_``, put into ``found``; all sums are whole numbers that ``kind`` holds."""
        n = len(self.ids)
        asked = queries[open_]
        weights = np.concatenate([np.maximum(asked, 0), np.maximum(-asked, 0)], axis=1)
        lower = np.zeros((len(open_), n), kind)
        own = [int((self.ids == query_ids[i]).sum()) for i in open_]  # the query's own rows may be among the best
        tiers = self.tiers(kind)
        for number, (gains, later) in enumerate(tiers):
            lower += weights.astype(kind) @ gains.T
            # counted by their least gain, postings gain a level less one more; others what later tiers hold
            slack = weights @ np.maximum(later, LEVEL - 1)
            keep = min(k + max(own), n)
            bound = np.partition(lower, n - keep, axis=1)[:, n - keep]
            near = lower >= (bound - slack)[:, None]
            listed = near.sum(axis=1)
            last = number == len(tiers) - 1
            done = listed <= max(SHORT_LIST, n // 64) if not last else np.ones(len(open_), bool)
            for row in np.flatnonzero(done).tolist():
                i = int(open_[row])
                found[i] = self._rescore(np.flatnonzero(near[row]), int(query_ids[i]), queries[i], k)
            if done.all():
                return
            going = ~done
            open_, weights, lower = open_[going], weights[going], lower[going]
            own = [o for o, goes in zip(own, going) if goes]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    id: str,
    vector: str,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best of ``vectors``, itself excluded.

    ``vector`` holds integers (see ``quantise``). Vectors of another length than
    the query's are no candidates of it; a score beyond 64 bits is told as the
    greatest or least long, and still ranked exactly. Each block of queries meets
    each shard once, in a task of its own; a shard answers with k rows per query.
    """
    usable = F.col(id).isNotNull() & F.col(vector).isNotNull()
    shards = F.lit(max(1, -(-vectors.where(usable).count() // shard_rows)))
    blocks = F.lit(max(1, -(-queries.where(usable).count() // query_block)))
    rows = vectors.where(usable).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
    asked = queries.where(usable).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
    pair = ["shard", "block"]
    indexed = rows.select(
        F.pmod(F.xxhash64("id", "v"), shards).alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "id", "v",
    )
    put = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("shard"),
        F.pmod(F.xxhash64("id", "v"), blocks).alias("block"), "id", "v",
    ).distinct()

    def search(table: pa.Table, questions: pa.Table) -> pa.Table:
        def matrices(t: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
            """Ids and vectors by the vectors' length."""
            listed = t.column("v").combine_chunks()
            ids, lengths = t.column("id").to_numpy(), listed.value_lengths().to_numpy()
            out = {}
            for length in np.unique(lengths).tolist():
                places = np.flatnonzero(lengths == length)
                flat = listed.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
                small = len(flat) == 0 or (flat.min() >= -(2**31) and flat.max() < 2**31)
                out[length] = ids[places], flat.astype(np.int32 if small else np.int64).reshape(len(places), length)
            return out

        out = {"query_id": [], "vec_id": [], "score": []}
        asked = matrices(questions) if table.num_rows and questions.num_rows else {}
        for width, (ids_, vectors_) in (matrices(table) if asked else {}).items():
            index = ShardIndex(ids_, vectors_) if width in asked else None
            if index is None:
                continue
            query_ids, queries_ = asked[width]
            for query_id, (ids, scores) in zip(query_ids.tolist(), index.search(query_ids, queries_.astype(np.int64), k)):
                out["query_id"] += [query_id] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    found = indexed.groupBy(*pair).cogroup(put.groupBy(*pair)).applyInArrow(
        search, "query_id bigint, vec_id bigint, score bigint"
    )
    return _best(found, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of all shards' answers; cut to k per query before the shuffle."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
