"""Nearest neighbours by randomly rotated one-bit codes.

Index: vectors are dealt to lists by their nearest centroid; a vector's residual from the centroid is
turned by a random matrix of orthonormal columns into ``BITS`` coordinates, of which only the signs are
kept, packed, with two correction scalars: the residual's length and the code's inner product with the
turned residual. From them the inner product of a query with the residual is estimated without bias,
and the estimate's error is below ``EPSILON / sqrt(BITS - 1)`` times a factor known per vector with
high probability. Search: a query visits its nearest list first, which bounds the distance of its k-th
neighbour; in the other lists it visits, only vectors whose lower bound does not exceed that, nor the
block's own (k+1)-th upper bound, are compared exactly (reranked), in double precision.

How many lists a query visits follows from the data: ``CALIBRATION`` queries are compared with every
vector, and the least number of lists that holds ``RECALL`` of their true neighbours is taken. Centroids
are fitted on at most about ``SAMPLE`` vectors (chosen by hash) and number at most ``LISTS``; these are
all that the driver holds. Every vector is indexed and every query is searched.

Work is dealt as (list, block, chunk): blocks bound the vectors of a list that one task holds, chunks the
queries that meet a block in one task, so a list holding a third of all vectors is many tasks. Equal
vectors are one entry with their k + 1 smallest ids, so copies are never compared with each other.

Defined results: rows whose id is null, whose vector is null, zero or holds null or non-finite components
take no part. Only vectors of equal length are compared (an index per length). Rows of the query's own id
are never its neighbours; repeated rows of one id and vector count once; an id with several vectors is a
query and a candidate with each. Ties go to the smaller id. An empty table has no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.session import materialize

NEIGHBOURS = 10
BITS = 256              # coordinates of the turned residual, at least the vector's length
EPSILON = 2.5           # width of the error bound in standard errors of the estimate
LIST_ROWS = 1024        # vectors a list holds on average, until there are LISTS of them
LISTS = 4096
SAMPLE = 65_536
CALIBRATION = 64
RECALL = 0.97
BLOCK = 2048            # vectors of a list that one task compares at once
CHUNK = 8192            # queries that meet a block in one task
SEED = 11


def clean(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (array<double>) of the rows that take part, each pair once."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(finite & F.exists("v", lambda x: x != 0.0))
    return rows.dropDuplicates(["id", "v"])


def entries(rows: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """v, ids: equal vectors once, with their k + 1 smallest ids (cut before the exchange)."""
    first = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def rotation(dim: int, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Random ``max(bits, dim)`` x ``dim`` matrix of orthonormal columns, rows a multiple of 8."""
    wide = -(-max(bits, dim) // 8) * 8
    q, r = np.linalg.qr(np.random.RandomState(seed).standard_normal((wide, dim)))
    return q * np.sign(np.diag(r))


def matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def nearest_lists(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances to the centroids up to a term of the row."""
    return (centroids ** 2).sum(1) - 2.0 * x @ centroids.T


def fit_centroids(sample: np.ndarray, lists: int, seed: int = SEED, steps: int = 6) -> np.ndarray:
    """Lloyd's steps from distinct sample vectors; a list that runs empty keeps its centroid."""
    rng = np.random.RandomState(seed)
    c = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(steps):
        near = np.concatenate([np.argmin(nearest_lists(sample[i:i + 4096], c), axis=1) for i in range(0, len(sample), 4096)])
        count, sums = np.bincount(near, minlength=len(c)), np.zeros_like(c)
        np.add.at(sums, near, sample)
        c = np.where(count[:, None] > 0, sums / np.maximum(1, count)[:, None], c)
    return c


def encode(x: np.ndarray, centroids: np.ndarray, turn: np.ndarray):
    """List, packed signs, residual length and <code, turned unit residual> of each row."""
    near = np.argmin(nearest_lists(x, centroids), axis=1)
    rest = x - centroids[near]
    norm = np.sqrt((rest ** 2).sum(1))
    turned = (rest / np.where(norm > 0, norm, 1)[:, None]) @ turn.T
    fit = np.abs(turned).sum(1) / np.sqrt(turn.shape[0])
    return near.astype(np.int32), np.packbits(turned > 0, axis=1), norm, np.where(norm > 0, fit, 1.0)


def index(entry: DataFrame, centroids: np.ndarray, turn: np.ndarray) -> DataFrame:
    """Entries with list, code, norm and fit."""
    shared = entry.sparkSession.sparkContext.broadcast((centroids, turn))

    def run(batches):
        c, t = shared.value
        for batch in batches:
            if batch.num_rows:
                near, code, norm, fit = encode(matrix(batch.column(0)), c, t)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near), pa.array([r.tobytes() for r in code], pa.binary()),
                                                  pa.array(norm), pa.array(fit)], names=["v", "ids", "list", "code", "norm", "fit"])

    return entry.select("v", "ids").mapInArrow(run, "v array<double>, ids array<long>, list int, code binary, norm double, fit double")


def true_lists(indexed: DataFrame, queries: list[tuple[int, list[float]]], k: int = NEIGHBOURS) -> DataFrame:
    """q (number of the query), list: where the true neighbours of a few queries lie, by comparing
    them with every entry; a task keeps the k nearest it has met."""
    own, x = np.array([i for i, _ in queries]), np.array([v for _, v in queries])

    def run(batches):
        best = [[] for _ in queries]
        for batch in batches:
            y, ids, lists = matrix(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            if not len(y):
                continue
            d = (x ** 2).sum(1)[:, None] - 2 * x @ y.T + (y ** 2).sum(1)
            for q in range(len(queries)):
                near = np.argpartition(d[q], k)[:k + 1] if len(y) > k + 1 else range(len(y))
                new = [(float(d[q, j]), i, lists[j]) for j in near for i in ids[j] if i != own[q]]
                best[q] = sorted(best[q] + new)[:k]
        rows = [(q, d, i, at) for q, found in enumerate(best) for d, i, at in found]
        cols = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.float64(), pa.int64(), pa.int32()))], names=["q", "d", "id", "list"])

    found = indexed.select("v", "ids", "list").mapInArrow(run, "q int, d double, id long, list int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))
    return found.withColumn("_r", rank).filter(F.col("_r") <= k).select("q", "list")


def lists_to_visit(indexed: DataFrame, queries: list[tuple[int, list[float]]], centroids: np.ndarray, recall: float = RECALL, k: int = NEIGHBOURS) -> int:
    """Least number of nearest lists that holds ``recall`` of the given queries' true neighbours."""
    if not queries or len(centroids) == 1:
        return 1
    order = np.argsort(nearest_lists(np.array([v for _, v in queries]), centroids), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    ranks = sorted(int(place[r["q"], r["list"]]) for r in true_lists(indexed, queries, k).collect())
    return ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)] + 1 if ranks else 1


def visits(queries: DataFrame, centroids: np.ndarray, sizes: np.ndarray, most: int, k: int = NEIGHBOURS) -> DataFrame:
    """One row per query and list to visit: qid, qkey, v, list, place (0 for the nearest). Lists are
    added beyond ``most`` until they hold k + 1 entries."""
    shared = queries.sparkSession.sparkContext.broadcast((centroids, sizes))

    def run(batches):
        c, n = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(nearest_lists(matrix(batch.column(2)), c), axis=1, kind="stable")
            held = np.cumsum(n[order], axis=1)
            count = np.maximum(most, np.minimum((held < k + 1).sum(1) + 1, len(c)))
            picked = pa.array([o[:m].astype(np.int32) for o, m in zip(order, count)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), picked], names=["qid", "qkey", "v", "lists"])

    rows = queries.select("qid", "qkey", "v").mapInArrow(run, "qid long, qkey long, v array<double>, lists array<int>")
    return rows.select("qid", "qkey", "v", F.posexplode("lists").alias("place", "list"))


def search_block(ids, y, code, norm, fit, centroid, turn, qid, x, limit, k):
    """Neighbours (query row, squared distance, id) that a block adds: estimates from the packed codes,
    bounds, then exact distances of what the bounds leave."""
    bits = turn.shape[0]
    signs = np.unpackbits(code, axis=1).astype(np.float32) * 2 - 1
    rest = x - centroid
    length = np.sqrt((rest ** 2).sum(1))
    turned = ((rest / np.where(length > 0, length, 1)[:, None]) @ turn.T).astype(np.float32)
    estimate = (turned @ signs.T).astype(np.float64) / np.sqrt(bits) / fit
    error = EPSILON / np.sqrt(bits - 1) * np.sqrt(np.maximum(0.0, 1 - fit ** 2)) / fit
    base, slope = norm ** 2 + (length ** 2)[:, None], 2 * norm * length[:, None]
    lower, upper = base - slope * (estimate + error), base - slope * (estimate - error)
    if len(y) > k + 1:
        limit = np.minimum(limit, np.partition(upper, k, axis=1)[:, k])
    for q in range(len(x)):
        near = np.flatnonzero(lower[q] <= limit[q] * (1 + 1e-9) + 1e-12)
        d = ((y[near] - x[q]) ** 2).sum(1)
        found = sorted((float(np.sqrt(d[j])), i, float(d[j])) for j in (np.argsort(d, kind="stable") if len(d) <= 4 * k else np.flatnonzero(d <= np.partition(d, k)[k]))
                       for i in ids[near[j]] if i != qid[q])
        for _, i, dist in found[:k]:
            yield q, dist, i


FOUND = "qid long, qkey long, id long, d double"


def search(indexed: DataFrame, wanted: DataFrame, blocks: DataFrame, centroids: np.ndarray, turn: np.ndarray, k: int = NEIGHBOURS) -> DataFrame:
    """qid, qkey, id, d: at most k neighbours per query and block. ``wanted``: qid, qkey, v, list and
    limit (squared distance beyond which nothing is wanted); ``blocks``: list, blocks (of its entries)."""
    spark = indexed.sparkSession
    chunks = wanted.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    plan = F.broadcast(blocks.join(chunks, "list"))     # at most LISTS rows of three integers
    piece = lambda value, n: F.pmod(F.xxhash64(value), n).cast("int")
    none = lambda kind: F.lit(None).cast(kind)
    rows = indexed.join(plan, "list").select("list", piece("v", F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                                             F.lit(0).alias("kind"), "v", "ids", "code", "norm", "fit", none("long").alias("qid"), none("long").alias("qkey"), none("double").alias("limit"))
    asks = wanted.join(plan, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), piece("qid", F.col("chunks")).alias("chunk"),
                                            F.lit(1).alias("kind"), "v", none("array<long>").alias("ids"), none("binary").alias("code"), none("double").alias("norm"), none("double").alias("fit"),
                                            "qid", "qkey", "limit")
    dealt = rows.unionByName(asks).repartition("list", "block", "chunk").sortWithinPartitions("list", "block", "chunk", "kind")
    shared = spark.sparkContext.broadcast((centroids, turn))

    def run(batches):
        c, t = shared.value
        at, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            for i, j in zip(cuts, np.r_[cuts[1:], len(keys)]):
                part, key, kind = batch.slice(i, j - i), tuple(keys[i, :3]), keys[i, 3]
                if key != at:
                    at, held, block = key, [], None
                if kind == 0:
                    held.append(part)
                    continue
                if block is None:
                    got = pa.Table.from_batches(held).combine_chunks() if held else None
                    block = got and (got["ids"].to_pylist(), matrix(got["v"].combine_chunks()),
                                     np.frombuffer(b"".join(got["code"].to_pylist()), np.uint8).reshape(got.num_rows, -1), got["norm"].to_numpy(), got["fit"].to_numpy())
                if not block:
                    continue
                for s in range(0, part.num_rows, 512):
                    some = part.slice(s, 512)
                    x, qid, qkey = matrix(some.column(4)), some.column(9).to_numpy(), some.column(10).to_numpy()
                    out = [(qid[q], qkey[q], n, d) for q, d, n in search_block(*block, c[at[0]], t, qid, x, some.column(11).to_numpy(), k)]
                    cols = list(zip(*out)) if out else [()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(v, kind_) for v, kind_ in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=["qid", "qkey", "id", "d"])

    return dealt.mapInArrow(run, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("qid", "qkey").orderBy(F.sqrt("d"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, wanted, k: int = NEIGHBOURS, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL,
            list_rows: int = LIST_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest rows found for every row for
    which the column ``wanted`` (over the id, named ``id``) holds."""
    spark = vectors.sparkSession
    rows = materialize(spark, clean(vectors, vec_id, vector), "vectors")
    results = None
    for dim in [r[0] for r in rows.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]:
        mine = rows.filter(F.size("v") == dim)
        found = _nearest_of_length(mine, mine.filter(wanted), dim, k, recall, list_rows)
        results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return results.select(F.col("qid").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.sqrt("d").alias("score"))


def _nearest_of_length(rows: DataFrame, wanted: DataFrame, dim: int, k: int, recall: float, list_rows: int) -> DataFrame:
    spark = rows.sparkSession
    entry = materialize(spark, entries(rows, k), "vector-entries")
    n = entry.count()
    lists = int(np.clip(n // list_rows, 1, LISTS))
    share = min(1.0, SAMPLE / max(1, n))
    by_hash = F.pmod(F.xxhash64(F.lit(SEED), "v"), 1 << 30)
    some = entry.filter(by_hash < int(share * (1 << 30))).select("v") if lists > 1 else entry.select("v").limit(1)
    sample = np.concatenate([matrix(c) for c in some.toArrow()["v"].chunks if len(c)])
    centroids, turn = fit_centroids(sample[np.lexsort(sample.T)], lists), rotation(dim)
    indexed = materialize(spark, index(entry, centroids, turn), "vector-codes")
    sizes = np.zeros(len(centroids), np.int64)
    for r in indexed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    blocks = spark.createDataFrame([(i, int(-(-s // BLOCK))) for i, s in enumerate(sizes.tolist()) if s], "list int, blocks int")

    asked = wanted.select(F.col("id").alias("qid"), F.xxhash64("v").alias("qkey"), "v")
    tried = [(r["qid"], r["v"]) for r in asked.orderBy(F.xxhash64(F.lit(SEED), "qid", "qkey"), "qid").limit(CALIBRATION).collect()]
    most = lists_to_visit(indexed, tried, centroids, recall, k)
    visit = materialize(spark, visits(asked, centroids, sizes, most, k), "vector-visits")

    def look(part: DataFrame, name: str) -> DataFrame:
        return materialize(spark, best(search(indexed, part, blocks, centroids, turn, k), k).select("qid", "qkey", "id", "d"), name)

    first = look(visit.filter("place = 0").withColumn("limit", F.lit(float("inf"))), "vector-first")
    bound = first.groupBy("qid", "qkey").agg(F.when(F.count("*") >= k, F.max("d")).otherwise(float("inf")).alias("limit"))
    rest = visit.filter("place > 0").join(bound, ["qid", "qkey"], "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    return best(first.unionByName(look(rest, "vector-rest")), k)
