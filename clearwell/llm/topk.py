"""Exact top-k inner products without random access.

Every component is a list of the candidates, sorted by its value. A query reads all lists from the end that suits
the sign of its own component, in steps. What a candidate has shown so far, with the list's last read
value for the rest, is an upper bound of its score; with the list's least value, a lower bound. Reading
stops when no candidate outside the ``k`` best lower bounds can reach them; the few that remain
are scored exactly.

Candidates are dealt out over blocks, queries over chunks; a task reads the lists of one block for
one chunk and hands on ``k`` rows per query, so neither all vectors nor all pairs are ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.session import stage

BLOCK_ROWS = 8192
CHUNK_ROWS = 512
#: Shares of the lists that are read between two looks at the bounds.
STEPS = (1 / 32, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 1)
_PIECE = ["block", "chunk"]


def usable(vector: Column) -> Column:
    """Whether a vector has components, none of them NULL, infinite or NaN."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def quantised(vector: Column, factor: int = 256) -> Column:
    """Each component as floor(factor * x), x as double, kept as a whole-valued double."""
    return F.transform(vector, lambda x: F.rint(F.floor(x.cast("double") * factor).cast("double")))


def _exact(candidates: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; beyond 2**53 in Python's integers, held to the range of a long."""
    if np.abs(candidates).max(initial=0) * np.abs(query).max(initial=0) * len(query) < 2**53:
        return (candidates @ query).astype(np.int64)
    one = [int(x) for x in query]
    sums = (sum(int(x) * y for x, y in zip(row, one, strict=True)) for row in candidates)
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in sums], dtype=np.int64)


class SortedLists:
    """Sorted lists of one block of candidates."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, rows: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.rows = self.ids if rows is None else rows[order]
        self.sorted = np.sort(self.values, axis=0)
        rank = np.argsort(np.argsort(self.values, axis=0, kind="stable"), axis=0)
        self.from_low, self.from_high = rank, len(ids) - 1 - rank
        self.lowest, self.highest = self.sorted[0], self.sorted[-1]

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its number, and ids and scores of its best candidates, by falling score and rising id.

        ``own`` are the rows of the queries, which they do not meet.
        """
        n = len(self.ids)
        open_ = np.arange(len(queries))
        # Doubles hold the bounds exactly as long as all sums stay below 2**53.
        scale = np.abs(self.values).max(initial=0) * np.abs(queries).max(initial=0) * queries.shape[1]
        steps = STEPS if scale < 2**53 else (1,)
        for share in steps:
            if not len(open_):
                return
            depth = max(min(n, 4 * k), int(n * share))
            plus, minus = np.maximum(queries[open_], 0), np.minimum(queries[open_], 0)
            last_high, last_low = self.sorted[n - depth], self.sorted[depth - 1]
            high, low = self.from_high < depth, self.from_low < depth
            known = np.where(high, self.values, 0) @ plus.T + np.where(low, self.values, 0) @ minus.T
            rest_high, rest_low = (~high).astype(float), (~low).astype(float)
            upper = known + rest_high @ (plus * last_high).T + rest_low @ (minus * last_low).T
            lower = known + rest_high @ (plus * self.lowest).T + rest_low @ (minus * self.highest).T
            own_row = self.rows[:, None] == own[open_]
            upper[own_row] = lower[own_row] = -np.inf
            kth = np.partition(lower, max(0, n - k), axis=0)[max(0, n - k)]
            outside = (upper >= kth).sum(axis=0)
            done = (outside <= 8 * k) | (depth == n)
            for column in np.flatnonzero(done):
                rows = np.flatnonzero((upper[:, column] >= kth[column]) & ~own_row[:, column])
                scores = _exact(self.values[rows], queries[open_[column]])
                best = np.lexsort((self.ids[rows], -scores.astype(object) if scale >= 2**53 else -scores))[:k]
                yield int(open_[column]), self.ids[rows][best], scores[best]
            open_ = open_[~done]


def _search(pieces: DataFrame, k: int) -> DataFrame:
    def searched(piece: pd.DataFrame) -> pd.DataFrame:
        asked, others = piece[piece["side"] == 0], piece[piece["side"] == 1]
        found = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if len(asked) and len(others):
            values = np.stack(others["vector"].to_numpy())
            lists = SortedLists(others["vec_id"].to_numpy(), values, others["row"].to_numpy())
            ids, rows = asked["vec_id"].to_numpy(), asked["row"].to_numpy()
            queries = np.stack(asked["vector"].to_numpy())
            for start in range(0, len(ids), 128):
                part = slice(start, start + 128)
                for q, best, scores in lists.top(queries[part], rows[part], k):
                    found["query_row"] += [int(rows[start + q])] * len(best)
                    found["query_id"] += [int(ids[start + q])] * len(best)
                    found["vec_id"] += best.tolist()
                    found["score"] += scores.tolist()
        return pd.DataFrame(found)

    return pieces.groupBy("length", *_PIECE).applyInPandas(
        searched, "query_row long, query_id long, vec_id long, score long"
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          factor: int = 256) -> DataFrame:
    """``query_id, rank, <key>, score``: for every query the ``k`` largest inner products with other rows.

    Components are quantised to floor(factor * x). Ties go to the smaller key. Fewer than ``k`` candidates are all
    returned. Vectors that are NULL, empty or hold a NULL or non-finite component take no part, nor
    do rows with a NULL key; vectors meet only others of their length. Rows that repeat are rows of their own: a query
    meets all but itself, and of several query rows with one key each has its own result. An empty table gives an empty result; other columns are not read. Scores beyond a long are
    held to its range.
    """
    has(vectors, key=key, vector=vector)
    rows = vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("vec_id"), quantised(F.col(vector), factor).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    rows = rows.withColumns({"length": F.size("vector"), "row": F.monotonically_increasing_id()})
    rows = stage(rows, "topk-vectors")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("query")).first()
    # Enough blocks for every task of a shuffle, none larger than BLOCK_ROWS.
    wide = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-n // BLOCK_ROWS), min(wide, -(-n // 256)), 1)
    chunks = max(-(-asked // CHUNK_ROWS), 1)
    place = F.xxhash64("row")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    columns = ["length", "block", "chunk", "side", "row", "vec_id", "vector"]
    candidates = rows.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int")).withColumn("chunk", every(chunks))
    queries = rows.where("query").withColumn("chunk", F.pmod(place, F.lit(chunks)).cast("int"))
    queries = queries.withColumn("block", every(blocks))
    pieces = candidates.withColumn("side", F.lit(1)).select(*columns).unionByName(
        queries.withColumn("side", F.lit(0)).select(*columns)
    )
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = _search(pieces, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(key), "score")
