"""Random forests and boosted trees for all keys in one plan.

Trees grow level by level from histograms. Features are binned by per-key quantiles; a level's state is
the count and label sum per (key, tree, node, feature, bin), which Spark merges from partial counts.
Labels are integers (scaled per key), so sums are exact in any order: the layout of the rows, the number
of shards and reruns never change a tree. Row weights (bootstrap) and the features a node may use come
from a seeded hash of the tree, the row's position and the node.

Rows of a key are dealt to shards of about ``SHARD_ROWS``. A key of one shard grows all its trees in the
task that holds the shard, all such keys in one job. Keys of several shards grow together: one
aggregation per level over all of them, whatever their number, for a forest all trees at once. Their rows
are dealt once, into a table with one row per shard (bins, labels and predictions so far as packed
arrays); a level reads that table where it lies and shuffles only the nodes' sums, one row per shard and
node. Boosting writes the shards anew after each tree, with the moved predictions and the next tree's
root sums; the splits of the tree in growth (at most 31 for each key of several shards) go over the
driver, as in Spark ML, for its hundreds of short jobs take longer to plan than to run. Both ways run the same functions on the same sums and give the same trees. No task holds more
than a few shards' rows, a key's trees and one level's sums of a key's tree.

Split rule: left if value <= cut; the largest drop of the squared error wins, ties go to the earlier
feature, then the lower cut; a node without a drop is a leaf. Forests average ``RF_TREES`` trees of
bootstrap weights (Poisson, mean 1) and a third of the features per node. Boosting fits twice the
residual with rate ``RATE`` after a first tree on the label, the squared-error gradient steps of Spark ML.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.constants import GBT_DEPTH, GBT_ITER, RF_DEPTH, RF_TREES, SEED
from tickwise.operators.lookup import BROADCAST_MAX_BYTES
from tickwise.session import materialize, release, scratch_path

BINS = 32               # bins of a feature, as in Spark ML
QUANTILE_ACCURACY = 10_000
SHARD_ROWS = 250_000
RATE = 0.1              # weight of every boosted tree after the first
_SCALE_BITS = 28        # labels become integers of at most so many bits


class Trees(NamedTuple):
    """What to grow: number of trees, depth, features a node may use (0: all), boosted or averaged."""
    count: int
    depth: int
    subset: int
    boosted: bool


FOREST = Trees(RF_TREES, RF_DEPTH, 3, False)
BOOSTED = Trees(GBT_ITER, GBT_DEPTH, 0, True)
KINDS = {"RandomForest": FOREST, "GBT": BOOSTED}


# ---------------------------------------------------------------- functions on arrays
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _salt(*parts: int) -> np.uint64:
    out = np.array([SEED], np.uint64)
    for p in parts:
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + np.array([p], np.uint64))
    return out[0]


_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])


def row_weights(tree: int, pos: np.ndarray) -> np.ndarray:
    """Bootstrap weights of rows: Poisson draws (mean 1) from a hash of tree and position."""
    u = (_mix(pos.astype(np.uint64) + _salt(1, tree)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(_POISSON, u).astype(np.float64)


def allowed(spec: Trees, tree: int, node: int, features: int) -> np.ndarray:
    """Which features the node may split on."""
    if not spec.subset or spec.subset >= features:
        return np.ones(features, bool)
    order = np.argsort(_mix(np.arange(features, dtype=np.uint64) + _salt(2, tree, node)), kind="stable")
    out = np.zeros(features, bool)
    out[order[:spec.subset]] = True
    return out


@lru_cache(1024)
def usable(spec: Trees, tree: int, level: int, features: int) -> np.ndarray:
    """Features (ascending) that each node of the level may split on, [node, feature]."""
    first = (1 << level) - 1
    return np.stack([np.flatnonzero(allowed(spec, tree, first + i, features)) for i in range(1 << level)])


def codes_of(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin of each value: the first cut that is not below it."""
    return np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(x.shape[1])], axis=1).astype(np.uint8)


def step(codes: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Node of every row one step further (heap numbers, root 0); leaves keep theirs."""
    f = feature.take(node)
    code = codes.reshape(-1).take(np.arange(len(codes)) * codes.shape[1] + np.maximum(f, 0))
    return np.where(f >= 0, 2 * node + 1 + (code > cut.take(node)), node)


def route(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Node of every row after at most ``levels`` steps."""
    node = np.zeros(len(codes), np.int64)
    for _ in range(levels):
        node = step(codes, node, feature, cut)
    return node


def histogram(codes: np.ndarray, node: np.ndarray, level: int, weight: np.ndarray | None, label: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight (None: 1 each) and weighted label sum by (node of the level, usable feature, bin); whole numbers."""
    first, features, size = (1 << level) - 1, codes.shape[1], BINS << level
    live = np.flatnonzero(node >= first)
    at, start, w, y = node[live] - first, live * features, weight, label
    if len(live) < len(node):
        w, y = None if w is None else w[live], y[live]
    wy = y if w is None else w * y
    flat, cell = codes.reshape(-1), at * BINS
    n, s = np.empty((2, 1 << level, use.shape[1], BINS), np.int64)
    for j in range(use.shape[1]):
        i = cell + flat.take(start + use[:, j].take(at))
        n[:, j] = np.bincount(i, w, size).reshape(-1, BINS)
        s[:, j] = np.bincount(i, wy, size).reshape(-1, BINS)
    return n, s


def best_split(n: np.ndarray, s: np.ndarray, may: np.ndarray) -> tuple[int, int, int, int, int, int]:
    """(feature, cut, left weight and sum, right weight and sum) of one node's (feature, bin) sums;
    feature -1 when nothing lowers the squared error."""
    f0 = int(np.argmax(n.sum(1)))       # every feature counts the same rows
    total_n, total_s = int(n[f0].sum()), int(s[f0].sum())
    if total_n < 2:
        return -1, 0, total_n, total_s, 0, 0
    ln, ls = np.cumsum(n, axis=1)[:, :-1], np.cumsum(s, axis=1)[:, :-1]
    rn, rs = total_n - ln, total_s - ls
    ok = (ln > 0) & (rn > 0) & may[:, None]
    left, right, whole = ls.astype(np.float64), rs.astype(np.float64), float(total_s)
    gain = np.where(ok, left * left / np.maximum(ln, 1) + right * right / np.maximum(rn, 1) - whole * whole / total_n, -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, BINS - 1)
    if not gain[f, b] > 1e-12 * max(1.0, whole * whole / total_n):
        return -1, 0, total_n, total_s, 0, 0
    return f, b, int(ln[f, b]), int(ls[f, b]), int(rn[f, b]), int(rs[f, b])


def split_of(n: np.ndarray, s: np.ndarray, use: np.ndarray) -> tuple[int, int, int, int, int, int]:
    """The best split of a node from the sums of its usable features."""
    f, *rest = best_split(n, s, np.ones(len(use), bool))
    return (int(use[f]) if f >= 0 else f, *rest)


def note(split: tuple, node: int, feature: np.ndarray, cut: np.ndarray, n: np.ndarray, s: np.ndarray) -> None:
    """Enter a node's split (or leaf) into the tree's arrays."""
    f, b, ln, ls, rn, rs = split
    feature[node], cut[node] = f, b
    n[node], s[node] = ln + rn, ls + rs
    if f >= 0:
        n[2 * node + 1], s[2 * node + 1], n[2 * node + 2], s[2 * node + 2] = ln, ls, rn, rs


class Grown:
    """Trees of one key as arrays [tree, node]."""

    def __init__(self, spec: Trees):
        shape = (spec.count, (1 << (spec.depth + 1)) - 1)
        self.spec, self.feature, self.cut = spec, np.full(shape, -1, np.int8), np.zeros(shape, np.uint8)
        self.n, self.s = np.zeros(shape, np.int64), np.zeros(shape, np.int64)

    def values(self, scale: float) -> np.ndarray:
        """What each node adds to the prediction."""
        share = np.full((self.spec.count, 1), 1.0 / self.spec.count)
        if self.spec.boosted:
            share[:] = RATE
            share[0] = 1.0
        return share * (self.s / np.maximum(self.n, 1)) / scale

    def add(self, tree: int, node: int, split: tuple) -> None:
        note(split, node, self.feature[tree], self.cut[tree], self.n[tree], self.s[tree])


def tree_labels(spec: Trees, tree: int, label: np.ndarray, so_far: np.ndarray | None, scale: float) -> np.ndarray:
    """Whole-number labels that the tree fits: the label, or twice the residual of the boosting so far."""
    y = 2.0 * (label - so_far) if spec.boosted and tree else label
    return np.rint(y * scale)


def drawn(spec: Trees, tree: int, codes: np.ndarray, pos: np.ndarray | None, y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Codes, weights and labels of the rows that count for a tree."""
    if spec.boosted:
        return codes, None, y
    w = row_weights(tree, pos)
    kept = np.flatnonzero(w)
    return codes[kept], w[kept], y[kept]


def grow(codes: np.ndarray, pos: np.ndarray, label: np.ndarray, scale: float, spec: Trees) -> Grown:
    """All trees of a key whose rows are at hand."""
    out, so_far = Grown(spec), np.zeros(len(label))
    for t in range(spec.count):
        part, w, y = drawn(spec, t, codes, pos, tree_labels(spec, t, label, so_far, scale))
        node = np.zeros(len(y), np.int64)
        for level in range(spec.depth):
            use = usable(spec, t, level, codes.shape[1])
            n, s = histogram(part, node, level, w, y, use)
            for i in np.flatnonzero(n[:, 0].sum(axis=1)).tolist():
                out.add(t, (1 << level) - 1 + i, split_of(n[i], s[i], use[i]))
            node = step(part, node, out.feature[t], out.cut[t])
        if spec.boosted:
            so_far += out.values(scale)[t][node]
    return out


# ---------------------------------------------------------------- Spark plans
MODEL = "cuts array<double>, feature binary, cut binary, value binary"
_META = "cuts array<double>, scale double, shards int"


def key_info(rows: DataFrame, key: str, features: Sequence[str], label: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per key: cuts (features x (BINS - 1) quantiles, ascending), label scale and number of shards."""
    cuts = F.flatten(F.array(*[F.percentile_approx(f, [i / BINS for i in range(1, BINS)], QUANTILE_ACCURACY) for f in features]))
    most = F.greatest(F.max(F.abs(F.col(label))), F.lit(1e-300))
    # twice a residual may exceed the label's range
    return rows.groupBy(key).agg(cuts.cast("array<double>").alias("cuts"), (F.lit(float(1 << (_SCALE_BITS - 4))) / most).alias("scale"),
                                 F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))


def _dealt(rows: DataFrame, per_key: DataFrame, key: str, features: Sequence[str], label: str, parts: int | None = None) -> DataFrame:
    """``per_key`` rows (kind 0, one to each shard) and data rows (kind 1) sorted by (key, shard, kind)."""
    fields = per_key.schema.fields
    heads = per_key.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn("kind", F.lit(0))
    data = rows.join(per_key.select(key, "shards"), key)
    data = data.select(key, F.pmod(F.xxhash64("pos"), F.col("shards")).cast("int").alias("shard"), F.lit(1).alias("kind"),
                       F.array(*[F.col(f).cast("double") for f in features]).alias("x"), F.col(label).cast("double").alias("y"), F.col("pos").cast("long").alias("pos"))
    both = heads.unionByName(data, allowMissingColumns=True).select(
        key, "shard", "kind", "x", "y", "pos", *[f.name for f in fields if f.name != key])
    spread = both.repartition(parts, key, "shard") if parts else both.repartition(key, "shard")
    return spread.sortWithinPartitions(key, "shard", "kind")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Table]]:
    """(head row, data rows) of every (key, shard) of ``_dealt`` that has data."""
    at, head, held = None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, shard = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        edge = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or shard[i] != shard[i - 1]]
        for i, j in zip(edge, [*edge[1:], len(keys)]):
            part = batch.slice(i, j - i)
            if (keys[i], int(shard[i])) != at:
                if held:
                    yield head, pa.Table.from_batches(held)
                at, head, held = (keys[i], int(shard[i])), None, []
            if head is None and part.column(2)[0].as_py() == 0:
                head, part = part.slice(0, 1).to_pylist()[0], part.slice(1)
            if part.num_rows:
                held.append(part)
    if held:
        yield head, pa.Table.from_batches(held)


def _arrays(head: dict, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, positions and labels of a group's rows, and the key's cuts."""
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["x"].chunks]).reshape(table.num_rows, -1)
    cuts = np.array(head["cuts"], float).reshape(x.shape[1], BINS - 1)
    return codes_of(x, cuts), table["pos"].to_numpy(), table["y"].to_numpy(), cuts


def _model_row(key_value, cuts, grown: Grown, scale: float) -> tuple:
    return key_value, list(np.ravel(cuts)), grown.feature.tobytes(), grown.cut.tobytes(), grown.values(scale).tobytes()


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    cols = list(zip(*rows)) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)


def _schema(rows: DataFrame, key: str, ddl: str) -> T.StructType:
    return T.StructType([T.StructField(key, rows.schema[key].dataType), *T.StructType.fromDDL(ddl).fields])


def fit(rows: DataFrame, key: str, features: Sequence[str], label: str, spec: Trees, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per key: its trees (``MODEL``). ``rows`` carry ``pos``, a number that tells the rows of a
    key apart; rows with equal ``pos`` and values are interchangeable."""
    spark = rows.sparkSession
    info = materialize(spark, key_info(rows, key, features, label, shard_rows), "tree-keys")
    out = _schema(rows, key, MODEL)

    def local(batches):
        for head, table in _groups(batches):
            codes, pos, y, cuts = _arrays(head, table)
            yield _batch([_model_row(head[key], cuts, grow(codes, pos, y, head["scale"], spec), head["scale"])], out)

    models = _dealt(rows, info.filter("shards = 1"), key, features, label).mapInArrow(local, out)
    large = info.filter("shards > 1")
    keys, shards = large.agg(F.count("*"), F.sum("shards")).first()
    if not keys:
        return models
    return models.unionByName(_fit_sharded(rows, large, keys, shards, key, features, label, spec, out))


SPLIT = "tree int, node int, f int, b int, ln long, ls long, rn long, rs long"
SPLIT_BYTES = 128        # of a split in a broadcast list, roughly
KEPT_SPLITS = 50_000     # splits of finished trees that the driver holds before it writes them
SHARD = "scale double, codes binary, pos binary, y binary, so_far binary, root binary"


def _with_splits(info: DataFrame, splits: DataFrame | None, key: str) -> DataFrame:
    """``info`` with the list ``grown`` of each key's splits."""
    if splits is None:
        return info.withColumn("grown", F.array().cast(f"array<struct<{SPLIT.replace(' ', ':').replace(',:', ',')}>>"))
    lists = splits.groupBy(key).agg(F.collect_list(F.struct(*[c.split()[0] for c in SPLIT.split(", ")])).alias("grown"))
    return info.join(lists, key)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _grown(head: dict, spec: Trees) -> Grown:
    out = Grown(spec)
    for r in sorted(head["grown"] or [], key=lambda r: (r["tree"], r["node"])):
        out.add(r["tree"], r["node"], tuple(r[c] for c in ("f", "b", "ln", "ls", "rn", "rs")))
    return out


def _fit_sharded(rows: DataFrame, info: DataFrame, keys: int, shards: int, key: str, features: Sequence[str], label: str, spec: Trees, out: T.StructType) -> DataFrame:
    """Trees of the ``keys`` keys that have several shards (``shards`` in all), level by level."""
    spark, width = rows.sparkSession, len(features)
    shard, cells, found = _schema(rows, key, SHARD), _schema(rows, key, "tree int, node int, sums binary"), _schema(rows, key, SPLIT)
    home = scratch_path(spark, "tree-splits")

    def packed(key_value, codes, pos, y, so_far, scale, tree):
        """A shard's row; for boosting with the sums of the tree's root."""
        if not spec.boosted:
            return _batch([(key_value, scale, codes.tobytes(), pos.tobytes(), y.tobytes(), None, None)], shard)
        root = histogram(codes, np.zeros(len(y), np.int64), 0, None, tree_labels(spec, tree, y, so_far, scale), usable(spec, tree, 0, width))
        return _batch([(key_value, scale, codes.tobytes(), None, y.tobytes(), so_far.tobytes(), np.stack(root)[:, 0].tobytes())], shard)

    def pack_shards(batches):
        for head, table in _groups(batches):
            codes, pos, y, _ = _arrays(head, table)
            yield packed(head[key], codes, pos, y, np.zeros(len(y)), head["scale"], 0)

    def arrays(head):
        part = [None if head.get(c) is None else np.frombuffer(head[c], kind) for c, kind in (("codes", np.uint8), ("pos", np.int64), ("y", np.float64), ("so_far", np.float64))]
        return part[0].reshape(-1, width), *part[1:]

    def splits(names: list[str]) -> DataFrame | None:
        return spark.read.schema(found).parquet(*[f"{home}/{n}" for n in names]) if names else None

    def met(table: DataFrame, names: list[str], held: int) -> DataFrame:
        """Shards with their keys' splits, at most ``held`` a key; few enough are sent to the shards."""
        if spec.boosted:
            return table
        heads = _with_splits(info.select(key), splits(names), key)
        return table.join(F.broadcast(heads) if keys * held * SPLIT_BYTES <= BROADCAST_MAX_BYTES else heads, key)

    def by_key(tree: list) -> dict:
        out = {}
        for r in tree:
            out.setdefault(r[key], []).append(r.asDict())
        return out

    def level_cells(trees: range, level: int, names: list[str], tree: list) -> DataFrame:
        known = by_key(tree)

        def sums(batches):
            for head in _rows(batches):
                codes, pos, label_, so_far = arrays(head)
                grown, first = _grown({"grown": known.get(head[key])} if spec.boosted else head, spec), (1 << level) - 1
                for t in trees:
                    part, w, y = drawn(spec, t, codes, pos, tree_labels(spec, t, label_, so_far, head["scale"]))
                    n, s = histogram(part, route(part, grown.feature[t], grown.cut[t], level), level, w, y, usable(spec, t, level, width))
                    yield _batch([(head[key], t, first + i, np.stack([n[i], s[i]]).tobytes()) for i in np.flatnonzero(n[:, 0].sum(axis=1)).tolist()], cells)

        if spec.boosted and not level:
            return state.select(key, F.lit(trees.start).alias("tree"), F.lit(0).alias("node"), F.col("root").alias("sums"))
        return met(state.drop("root"), names, len(trees) << level).mapInArrow(sums, cells)

    def choose(batches):
        def best():
            k, t, node = at
            level = (node + 1).bit_length() - 1
            return *at, *split_of(*total, usable(spec, t, level, width)[node + 1 - (1 << level)])

        at, total = None, None
        for batch in batches:
            done = []
            for *one, sums in zip(*(c.to_pylist() for c in batch.columns)):
                if one != at:
                    if at:
                        done.append(best())
                    at, total = one, 0
                total = total + np.frombuffer(sums, np.int64).reshape(2, -1, BINS)
            yield _batch(done, found)
        if at:
            yield _batch([best()], found)

    by, parts = [key, "tree", "node"], max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    state = materialize(spark, _dealt(rows, info, key, features, label, parts).mapInArrow(pack_shards, shard), "tree-state")
    every: list[str] = []
    done: list = []

    def keep(name: str) -> None:
        spark.createDataFrame(done, found).write.parquet(f"{home}/{name}")
        every.append(name)
        done.clear()

    for trees in [range(t, t + 1) for t in range(spec.count)] if spec.boosted else [range(spec.count)]:
        tree: list = []
        for level in range(spec.depth):
            part = level_cells(trees, level, every, tree).repartition(*by).sortWithinPartitions(*by).mapInArrow(choose, found)
            if spec.boosted:
                tree += part.collect()
            else:
                part.write.parquet(f"{home}/{level}")
                every.append(f"{level}")
        done += tree
        if len(done) > KEPT_SPLITS:
            keep(f"until-{trees.start}")
        if spec.boosted and trees.stop < spec.count:    # the rows' predictions move on by the round's tree
            def move(batches, t=trees.start, known=by_key(tree)):
                for head in _rows(batches):
                    codes, _, y, so_far = arrays(head)
                    grown = _grown({"grown": known[head[key]]}, spec)
                    moved = so_far + grown.values(head["scale"])[t][route(codes, grown.feature[t], grown.cut[t], spec.depth)]
                    yield packed(head[key], codes, None, y, moved, head["scale"], t + 1)

            before, state = state, materialize(spark, state.drop("root").mapInArrow(move, shard), "tree-state")
            release(spark, before)
    if done:
        keep("last")
    release(spark, state)

    def pack(batches):
        for batch in batches:
            yield _batch([_model_row(head[key], head["cuts"], _grown(head, spec), head["scale"]) for head in batch.to_pylist()], out)

    return _with_splits(info, splits(every), key).select(key, "cuts", "scale", "grown").mapInArrow(pack, out)


def unpack(head: dict, spec: Trees, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    shape = (spec.count, (1 << (spec.depth + 1)) - 1)
    return (np.array(head["cuts"], float).reshape(features, BINS - 1), np.frombuffer(head["feature"], np.int8).reshape(shape),
            np.frombuffer(head["cut"], np.uint8).reshape(shape), np.frombuffer(head["value"], np.float64).reshape(shape))


def predicted(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int) -> np.ndarray:
    out = np.zeros(len(codes))
    for t in range(len(feature)):
        out += value[t][route(codes, feature[t], cut[t], depth)]
    return out


def predict(rows: DataFrame, models: DataFrame, key: str, features: Sequence[str], label: str, spec: Trees, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """key, pos, label and ``prediction`` of the rows whose key has a model. A key's model meets its rows
    once per shard, so it is never joined to each row."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    schema = _schema(rows, key, f"pos long, `{label}` double, prediction double")

    def run(batches):
        for head, table in _groups(batches):
            if head is None:
                continue
            cuts, feature, cut, value = unpack(head, spec, len(features))
            codes, pos, y, _ = _arrays(head, table)
            got = predicted(codes, feature, cut, value, spec.depth)
            yield pa.RecordBatch.from_arrays([pa.array([head[key]] * len(y)), pa.array(pos), pa.array(y), pa.array(got)], names=schema.names)

    return _dealt(rows, models.join(sizes, key), key, features, label).mapInArrow(run, schema)


def next_features(prices: list[float], pcts: list[float], consistent: bool) -> dict[str, float]:
    """The features of the next step, as ``forecast.step_features`` defines them."""
    def ratio(a, b):
        return a / b if b else 1.0
    lag1 = pcts[-1]
    lag2 = pcts[-2] if len(pcts) > 1 else lag1
    last7 = pcts[-7:]
    mean = sum(last7) / len(last7)
    squares = sum((p - mean) * (p - mean) for p in last7)     # a power would raise where this overflows
    ma7, ma14 = sum(prices[-7:]) / len(prices[-7:]), sum(prices[-14:]) / len(prices[-14:])
    back, free = (6, 1) if consistent else (5, 0)
    base = prices[-back] if len(prices) >= back else 0.0
    return {"pct_lag1": lag1, "pct_lag2": lag2, "pct_lag3": pcts[-3] if len(pcts) > 2 else lag2,
            "ma_ratio": ratio(prices[-1], ma7), "ma_cross": ratio(ma7, ma14),
            "volatility": (squares / (len(last7) - free)) ** 0.5 if len(last7) > free else float("nan"),
            "momentum": (prices[-1] - base) / base * 100 if base else 0.0}


def forecast(ctx: DataFrame, models: DataFrame, key: str, features: Sequence[str], spec: Trees, horizon: int, consistent: bool = False) -> DataFrame:
    """Key, step, ts, price, pct of the recursive forecast. ``ctx`` has one row per key (prices,
    pcts, last_ts, interval_s); a key's steps run in the task that holds its row and its model."""
    from decimal import ROUND_HALF_UP, Decimal
    names = list(features)
    schema = _schema(ctx, key, "step long, ts double, price double, pct double")

    def cents(x: float) -> float:
        return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP)) if abs(x) < 1e15 else x    # beyond, no cents are left

    def run(batches):
        for batch in batches:
            out = []
            for head in batch.to_pylist():
                cuts, *parts = unpack(head, spec, len(names))
                prices, pcts = list(head["prices"]), list(head["pcts"])
                for i in range(1, horizon + 1):
                    f = next_features(prices, pcts, consistent)
                    pct = float(predicted(codes_of(np.array([[f[n] for n in names]]), cuts), *parts, spec.depth)[0])
                    prices.append(cents(prices[-1] * (1 + pct / 100)))
                    pcts.append(pct)
                    out.append((head[key], i, head["last_ts"] + head["interval_s"] * float(i), prices[-1], pct))
            yield _batch(out, schema)

    held = models.withColumnRenamed(key, "_mk")
    return ctx.join(held, F.col(key) == F.col("_mk")).drop("_mk").mapInArrow(run, schema)
