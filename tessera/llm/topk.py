"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging of lists.

Rows are dealt into shards of bounded size. A task holds one shard as a matrix while the query
set streams past it in blocks; each tile is one matrix product of integer values. A tile hands
on only its k best per query, and the lists are merged shard group by shard group, then overall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions

#: Rows of a shard (16 MB as 64 float32) and queries of a block.
SHARD_ROWS, BLOCK_ROWS = 65_536, 1_024
#: Shards whose lists meet in one node of the merge tree.
FAN_IN = 32
_EXACT = 2.0 ** 53
_OUT = "query_id long, query_hash long, shard long, vec_id long, score long"


def _scores(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Integer inner products; floats carry them exactly below 2**53, big integers beyond it (cut to 64 bits)."""
    bound = max(1, queries.shape[1]) * np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0)
    if bound < _EXACT:
        return queries @ shard.T
    big = np.vectorize(int, otypes=[object])
    return np.clip(big(queries) @ big(shard).T, -2 ** 63, 2 ** 63 - 1)


def _best(row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest; among equals the lowest places."""
    if len(row) <= k:
        return np.arange(len(row))
    kth = np.partition(row, len(row) - k)[len(row) - k]
    above = np.flatnonzero(row > kth)
    return np.concatenate([above, np.flatnonzero(row == kth)[: k - len(above)]])


def _tile(qid, qhash, queries, ids, shard, shard_no, k):
    """Rows of the lists of one tile; ``ids`` ascend, so equal scores go to the smaller id."""
    out = [[] for _ in range(5)]
    scores = _scores(queries, shard)
    for r in range(len(qid)):
        others = np.flatnonzero(ids != qid[r])
        row = scores[r] if len(others) == len(ids) else scores[r][others]
        for c in _best(row, k):
            for col, v in zip(out, (qid[r], qhash[r], shard_no, ids[others[c]], int(row[c]))):
                col.append(int(v))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                      ["query_id", "query_hash", "shard", "vec_id", "score"])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, parts, matrix = None, [], [], None  # the shard that is being read; its matrix once queries begin
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            lists = batch.column(4)
            values = np.floor(1024.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            width = cols[3]
            starts = np.concatenate([[0], np.cumsum(width)])
            # runs of rows of the same shard, width and kind
            edge = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(width) != 0) | (np.diff(cols[1]) != 0)) + 1
            for a, b in zip([0, *edge], [*edge, len(width)]):
                if a == b:
                    continue
                rows = values[starts[a]:starts[b]].reshape(b - a, int(width[a]))
                if (cols[0][a], width[a]) != now:
                    now, ids, parts, matrix = (cols[0][a], width[a]), [], [], None
                if cols[1][a] == 0:
                    ids.append(cols[2][a:b])
                    parts.append(rows)
                    continue
                if not parts:
                    continue
                if matrix is None:
                    order = np.argsort(all_ids := np.concatenate(ids), kind="stable")
                    matrix = np.concatenate(parts)[order], all_ids[order]
                    ids, parts = [None], [None]
                qhash = batch.column(5).to_numpy(zero_copy_only=False)
                for s in range(a, b, BLOCK_ROWS):
                    e = min(b, s + BLOCK_ROWS)
                    yield _tile(cols[2][s:e], qhash[s:e], rows[s - a:e - a], matrix[1], matrix[0], int(cols[0][a]), k)
    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of each query.

    Components become ``floor(1024 * x)``. ``is_query`` is a column expression on the rows; every
    other row is a candidate. Ties go to the smaller id; fewer than k candidates give a shorter
    list. Rows without id, null vectors and vectors with null or non-finite components take no
    part; vectors of different widths have no score. A query's own row is every row with its id;
    repeats of one query row (same id and vector) answer once. Other columns are ignored.
    Scores beyond 64 bits are cut to the nearest long.
    """
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = (vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("vec_id"), is_query.alias("is_query"),
                    F.col(vector_col).alias("vector")))
    shards = max(partitions(vectors), -(-vectors.count() // SHARD_ROWS))
    width = F.size("vector")
    hashed = F.xxhash64("vec_id", "vector")
    shard_rows = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"),
                             "vec_id", width.alias("width"), "vector", F.lit(0).cast("long").alias("query_hash"))
    queries = rows.where("is_query").select("vec_id", "vector", hashed.alias("query_hash")).dropDuplicates()
    dealt = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                           F.lit(1).alias("kind"), "vec_id", width.alias("width"), "vector", "query_hash")
    tiles = (shard_rows.unionByName(dealt).repartition(shards, "shard")
             .sortWithinPartitions("shard", "width", "kind").mapInArrow(_search(k), _OUT))
    best = Window.orderBy(F.desc("score"), "vec_id")
    node = best.partitionBy("query_id", "query_hash", F.floor(F.col("shard") / FAN_IN))
    lists = tiles.withColumn("rank", F.row_number().over(node)).where(F.col("rank") <= k).drop("rank")
    ranked = lists.withColumn("rank", F.row_number().over(best.partitionBy("query_id", "query_hash")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
