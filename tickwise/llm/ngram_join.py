"""Jaccard self-join of documents on their word n-gram sets, by prefix trees. Words per n-gram and
the threshold NUM / DEN are arguments (default: 3 words and J >= 9/10).

A trie of globally ordered sets does the join (``block_links``): n-grams are ordered from rare to
frequent, a probe walks the trie sharing the overlap counted so far among all sets below a node,
and leaves a subtree as soon as the n-grams remaining on either side cannot reach the overlap that
the set sizes require. Spark brings together the sets that can link:

1. Equal sets become one (a 64-bit digest of the sorted n-gram hashes names a set).
2. The n-grams of the corpus have one order, by the number of sets that hold them, then by hash. Linked
   sets overlap in J * n n-grams, so they share one among the first n - ceil(J * n) + 1 of either (the
   prefix). N-grams of a single set come first and link nothing, so most texts that are no near copies
   have no key at all. Counts need one exchange of packed n-grams by ranges of their codes, which gives
   equal results for any number of ranges, and one back of those that several sets hold. Codes are
   narrower than hashes: codes that coincide only add candidates (``prefix_keys``).
3. Sets that share keys form candidate clusters (a star per key, then connected components).
4. A cluster is one trie block. A large one (by sets or by n-grams) is dealt by size class, then into
   chunks, and every two chunks of a class meet in one block, so a block is bounded whatever the
   cluster's size. Blocks report links that join something new, not all pairs.

Defined results: ASCII letters are compared in lower case; a text of fewer words than an n-gram has its whole
sequence as its only n-gram; a text without words (or null) has none and links with nothing. Rows
that repeat a doc_id are rows of their own. The component is named by its smallest doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.components import components
from tickwise.llm.joins import lookup
from tickwise.llm.text import column_bytes, lower_ascii, mix64, row_chunks, row_shingles, word_hashes
from tickwise.session import materialize, release

WORDS = 3
# J >= 9/10: 10 * I >= 9 * U, that is 19 * I >= 9 * (a + b)
NUM, DEN = 9, 10
BLOCK = 1024                # sets of a block
BLOCK_GRAMS = 1 << 20       # and their n-grams, besides its longest set

_HEAD = np.dtype([("d", "<i8"), ("count", "<u4")])
SPREAD_GRAMS = 1 << 20      # n-grams that a task packs at once


def prefix_length(n: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """First n-grams of a set of ``n`` among which a linked set's first ones must appear."""
    return n - -(-num * n // den) + 1


def _codes(grams: np.ndarray, ranges: int) -> np.ndarray:
    """Range (upper half) and 32-bit code of n-grams as one number."""
    mixed = mix64(grams ^ np.uint64(0x5851F42D4C957F2D))
    return (((mixed >> np.uint64(32)) % np.uint64(ranges)) << np.uint64(32)) | (mixed & np.uint64(0xFFFFFFFF))


def _runs(values: np.ndarray):
    """(from, to) of every run of equal values."""
    cut = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return zip(cut.tolist(), [*cut[1:].tolist(), len(values)])


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    if not len(columns[0]):
        return np.zeros(0, bool)
    return np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)]


def _pack(names: list[int], sets: list[np.ndarray], ranges: int):
    """(range, heads, codes) of some sets: for every set in a range a head and its distinct codes."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    full = _codes(np.concatenate(sets), ranges)
    part = (full >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((full, owner, part))
    full, owner, part = full[order], owner[order], part[order]
    new = _firsts(full, owner)
    full, owner, part = full[new], owner[new], part[new]
    first = np.flatnonzero(_firsts(part, owner))
    heads = np.zeros(len(first), _HEAD)
    heads["d"], heads["count"] = np.array(names, np.int64)[owner[first]], np.diff(np.r_[first, len(full)])
    code = (full & np.uint64(0xFFFFFFFF)).astype("<u4")
    for i, j in _runs(part[first]):
        lo, hi = first[i], first[j] if j < len(first) else len(full)
        yield int(part[lo]), heads[i:j].tobytes(), code[lo:hi].tobytes()


def _shared_codes(heads: np.ndarray, codes: np.ndarray):
    """(sets, codes, numbers of holding sets, 255 at most) for the codes of a range that several sets hold,
    sorted by set. A set that comes several times (copies) counts once."""
    d = np.repeat(heads["d"], heads["count"])
    order = np.lexsort((d, codes))
    codes, d = codes[order], d[order]
    new = _firsts(codes, d)
    codes, d = codes[new], d[new]
    first = np.flatnonzero(_firsts(codes))
    size = np.diff(np.r_[first, len(codes)])
    held = np.repeat(size, size)
    keep = held > 1
    codes, d, held = codes[keep], d[keep], np.minimum(held[keep], 255).astype(np.uint8)
    order = np.lexsort((codes, d))
    return d[order], codes[order], held[order]


def _prefix_of(d: np.ndarray, keys: np.ndarray, held: np.ndarray, alone_and_prefix) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) for the shared codes that lie in their set's prefix. Codes that no other set holds come
    before them in the order; ``alone_and_prefix(sets, counts)`` gives how many these are, and the prefix."""
    order = np.lexsort((keys, held, d))
    d, keys = d[order], keys[order]
    first = np.flatnonzero(_firsts(d))
    count = np.diff(np.r_[first, len(d)])
    alone, prefix = alone_and_prefix(d[first], count)
    place = np.arange(len(d)) - np.repeat(first, count)
    mine = np.repeat(alone, count) + place < np.repeat(prefix, count)
    return d[mine], keys[mine]


def _packs(batches, at: str):
    """Per value of the (sorted) column ``at``: its rows."""
    held, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[at] != held:
                if rows:
                    yield held, rows
                held, rows = row[at], []
            rows.append(row)
    if rows:
        yield held, rows


def prefix_keys(docs: DataFrame, rows: DataFrame, ranges: int, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """(d, key): for every set the n-grams of its prefix that other sets hold too. ``rows``: d, n and codes
    (its number of distinct codes, ``_codes`` for ``ranges``) of the sets of ``docs``."""

    def spread(batches):
        names, sets, met = [], [], 0

        def packed():
            out = list(_pack(names, sets, ranges))
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["range", "heads", "codes"])

        for batch in batches:
            for some in gram_sets(batch.column(0), words):
                for s in some:
                    if len(s):
                        names.append(set_digest(s))
                        sets.append(s)
                        met += len(s)
                if met >= SPREAD_GRAMS:
                    yield packed()
                    names, sets, met = [], [], 0
        if sets:
            yield packed()

    def meet(batches):
        for number, found in _packs(batches, "range"):
            heads = np.frombuffer(b"".join(r["heads"] for r in found), _HEAD)
            d, codes, held = _shared_codes(heads, np.frombuffer(b"".join(r["codes"] for r in found), "<u4"))
            home = d % ranges
            order = np.argsort(home, kind="stable")
            d, codes, held, home = d[order], codes[order], held[order], home[order]
            out = []
            for i, j in _runs(home):
                first = np.flatnonzero(_firsts(d[i:j]))
                head = np.zeros(len(first), _HEAD)
                head["d"], head["count"] = d[i:j][first], np.diff(np.r_[first, j - i])
                out.append((int(home[i]), number, head.tobytes(), codes[i:j].tobytes(), held[i:j].tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["home", "range", "heads", "codes", "held"])

    def choose(batches):
        for _, found in _packs(batches, "home"):
            packs, sets = [r for r in found if r["heads"] is not None], [r for r in found if r["heads"] is None]
            if not packs or not sets:
                continue
            info = np.array(sorted({(r["d"], r["n"], r["distinct"]) for r in sets}), np.int64)

            def alone_and_prefix(d, count, info=info):
                n, codes = info[np.searchsorted(info[:, 0], d)][:, 1:].T
                return codes - count, prefix_length(n, num, den)

            heads = np.concatenate([np.frombuffer(r["heads"], _HEAD) for r in packs])
            keys = np.concatenate([np.frombuffer(r["codes"], "<u4").astype(np.int64) + (r["range"] << 32) for r in packs])
            d, key = _prefix_of(np.repeat(heads["d"], heads["count"]), keys, np.concatenate([np.frombuffer(r["held"], np.uint8) for r in packs]), alone_and_prefix)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(key)], names=["d", "key"])

    packed = docs.select("text").mapInArrow(spread, "range int, heads binary, codes binary")
    shared = packed.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(meet, "home int, range int, heads binary, codes binary, held binary")
    sets = rows.filter("d is not null").select(F.pmod("d", F.lit(ranges)).cast("int").alias("home"), "d", "n", "distinct")
    return shared.unionByName(sets, allowMissingColumns=True).repartition(ranges, "home").sortWithinPartitions("home").mapInArrow(choose, "d long, key long")


def gram_sets(texts: pa.Array, k: int = WORDS):
    """The sorted distinct n-gram hashes of every text of a column, row by row."""
    data, offsets = column_bytes(texts)
    for i, j in row_chunks(offsets):
        words, _, _, first = word_hashes(lower_ascii(data[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i])
        yield [np.unique(s) for s in row_shingles(words, first, k)]


def set_digest(grams: np.ndarray) -> int:
    """64-bit name of a set: order-free sum of mixed hashes and the size."""
    return int(mix64(np.array([np.sum(mix64(grams + np.uint64(0x632BE59BD9B4E019)), dtype=np.uint64) + np.uint64(len(grams))]))[0].view(np.int64))


def _named(docs: DataFrame, k: int, ranges: int) -> DataFrame:
    """doc_id, text_hash, n, d (set name, null without n-grams), distinct (codes of the set)."""

    def run(batches):
        for batch in batches:
            sets = [(len(s), set_digest(s) if len(s) else None, len(np.unique(_codes(s, ranges)))) for some in gram_sets(batch.column(2), k) for s in some]
            cols = list(zip(*sets)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in cols]], names=["doc_id", "text_hash", "n", "d", "distinct"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n long, d long, distinct long")


def _needed(a: int, b: int, num: int = NUM, den: int = DEN) -> int:
    return -(-num * (a + b) // (num + den))


class _Node:
    """A run of tokens (``label``), the sets that end behind it, and branches by their next token."""

    __slots__ = ("label", "children", "sets", "least", "deep")

    def __init__(self, label: np.ndarray):
        self.label, self.children, self.sets, self.least, self.deep = label, {}, [], 1 << 62, 0


class Trie:
    """Sets as ascending token arrays (tokens below ``codes``). Runs of tokens without a branch are
    one node, so there are at most two nodes a set, however long the sets are."""

    def __init__(self, codes: int, num: int = NUM, den: int = DEN):
        self.root, self.num, self.den = _Node(np.zeros(0, np.int64)), num, den
        self.marked = np.zeros(codes, bool)

    def add(self, tokens: np.ndarray, size: int, name: int) -> None:
        node, i = self.root, 0
        while True:
            node.least, node.deep = min(node.least, size), max(node.deep, len(tokens) - i)
            i += len(node.label)
            if i == len(tokens):
                node.sets.append((name, size))
                return
            token = int(tokens[i])
            child = node.children.get(token)
            if child is None:
                child = node.children[token] = _Node(tokens[i:])
            else:
                n = min(len(child.label), len(tokens) - i)
                other = np.flatnonzero(child.label[:n] != tokens[i:i + n])
                same = int(other[0]) if len(other) else n
                if same < len(child.label):     # branch off inside the run
                    upper = node.children[token] = _Node(child.label[:same])
                    upper.least, upper.deep = child.least, child.deep
                    child.label, child.deep = child.label[same:], child.deep - same
                    upper.children[int(child.label[0])] = child
                    child = upper
            node = child

    def probe(self, tokens: np.ndarray, size: int):
        """Names of the sets whose overlap with ``tokens`` reaches the need."""
        num, den = self.num, self.den
        n, least_size = len(tokens), -(-num * size // den)
        self.marked[tokens] = True
        found, stack = [], [(self.root, 0, 0)]
        while stack:
            node, i, got = stack.pop()
            if got + min(n - i, node.deep) < _needed(size, max(node.least, least_size), num, den):
                continue
            if len(node.label):
                got += int(np.count_nonzero(self.marked[node.label]))
                i += int(np.searchsorted(tokens[i:], node.label[-1], side="right"))
            found += [name for name, other in node.sets if other >= least_size and got >= _needed(size, other, num, den)]
            stack += [(child, i, got) for child in node.children.values()]
        self.marked[tokens] = False
        return found


def block_links(names: list[int], sets: list[np.ndarray], home: list[bool] | None = None, num: int = NUM, den: int = DEN) -> list[tuple[int, int]]:
    """Links (J >= num / den) among the sets of a block that connect what was not connected yet; two sets
    that are both not at ``home`` in this block meet elsewhere."""
    sizes = np.array([len(s) for s in sets])
    grams, code, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), np.int64)
    rank[np.lexsort((grams, uses))] = np.arange(len(grams))     # rare first; n-grams of one set cannot overlap
    code = np.where(uses[code] > 1, rank[code], -1)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    trie, links = Trie(len(grams), num, den), []
    for k in np.argsort(sizes, kind="stable").tolist():
        part = code[edge[k]:edge[k + 1]]
        tokens = np.sort(part[part >= 0])
        size = int(sizes[k])
        if _needed(size, -(-num * size // den), num, den) <= len(tokens):
            for other in trie.probe(tokens, size):
                a, b = find(k), find(other)
                if a != b and (home is None or home[k] or home[other]):
                    parent[a] = b
                    links.append((names[k], names[other]))
            trie.add(tokens, size, k)
    return links


def _blocks(members: DataFrame, num: int, den: int) -> DataFrame:
    """(d, n, cluster) dealt into blocks: adds block (string) and home."""
    fits = (F.count("*") <= BLOCK) & (F.sum("n") <= BLOCK_GRAMS)
    rows = lookup(members, members.groupBy("cluster").agg(fits.alias("_fits")), ["cluster"])
    small = rows.filter("_fits").select("d", "n", "cluster", F.concat_ws("/", "cluster").alias("block"), F.lit(True).alias("home"))
    large = rows.filter("NOT _fits")
    # a class and, as visitors, the class below it
    size_class = F.floor(F.log(F.col("n").cast("double")) / float(np.log(den / num)))
    dealt = large.withColumn("_class", F.explode(F.array(size_class, size_class + 1))).withColumn("home", F.col("_class") == size_class)
    # a visitor may be linked only if sizes allow: the ratio is checked again in the block
    chunks = F.greatest(F.ceil(F.count("*") / (BLOCK // 2)), F.ceil(F.sum("n") / (BLOCK_GRAMS // 2)))
    per = dealt.groupBy("cluster", "_class").agg(chunks.cast("int").alias("chunks"))
    dealt = lookup(dealt, per, ["cluster", "_class"])
    own = F.pmod(F.xxhash64("d"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.least(own, j).alias("a"), F.greatest(own, j).alias("b")))
    dealt = dealt.withColumn("_pair", F.explode(pairs))
    return small.unionByName(dealt.select("d", "n", "cluster", F.concat_ws("/", "cluster", "_class", "_pair.a", "_pair.b").alias("block"), "home"))


def _join_blocks(docs: DataFrame, members: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links (u, v) found in the blocks. ``members``: d, n, cluster and the (doc_id, text_hash) of the
    row of ``docs`` whose text gives the set. Texts are dealt once to read their sets, sets once to
    their blocks; rows that repeat a doc_id and text come to a block together and count once."""
    places = _blocks(members.select("d", "n", "cluster"), num, den).groupBy("d").agg(F.collect_list(F.struct("block", "home")).alias("places"))
    wanted = lookup(members.select("d", "doc_id", "text_hash"), places, ["d"])
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"), F.xxhash64("text").alias("_hash"), "text")
    texts = source.join(wanted, (F.col("_doc") == F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")))

    def read_sets(batches):
        for batch in batches:
            raw = [g.tobytes() for sets in gram_sets(batch.column(2), words) for g in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["d", "places", "grams"])

    sets = texts.select("d", "places", "text").mapInArrow(read_sets, "d long, places array<struct<block:string,home:boolean>>, grams binary")
    rows = sets.select("d", F.explode("places").alias("p"), "grams").select("p.block", "d", "p.home", "grams")

    def run(batches):
        held, names, grams, home = None, [], [], []

        def done():
            links = block_links(names, grams, home, num, den) if len(names) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["u", "v"])

        for batch in batches:
            for block, d, at_home, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if block != held:
                    yield done()
                    held, names, grams, home = block, [], [], []
                if names and names[-1] == d:
                    home[-1] |= at_home
                    continue
                names.append(d)
                grams.append(np.frombuffer(raw, np.uint64))
                home.append(at_home)
        yield done()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "block").sortWithinPartitions("block", "d").mapInArrow(run, "u long, v long")


def jaccard_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, component_id; links are J >= num / den on n-grams of
    ``words`` words."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(spark, _named(docs, words, ranges), "ngram-rows")
    pairs = materialize(spark, prefix_keys(docs, rows, ranges, words, num, den), "ngram-keys")
    shared = pairs.groupBy("key").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo < hi").select("key", "lo")
    edges = lookup(pairs, shared, ["key"]).filter("d <> lo").select(F.col("d").alias("u"), F.col("lo").alias("v"))
    clusters = components(edges)
    release(spark, pairs)
    # one row per candidate set; its n-grams are read again from the text that names it
    named = rows.filter("d is not null")
    one = named.groupBy("d", "n").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "text_hash")).alias("m"))
    members = one.join(clusters, F.col("d") == F.col("node")).withColumnRenamed("component", "cluster")
    members = materialize(spark, members.select("d", "n", "cluster", "m.doc_id", "m.text_hash"), "ngram-members")
    links = materialize(spark, _join_blocks(docs, members.filter("n > 0"), words, num, den), "ngram-links")
    release(spark, members)
    linked = components(links)
    labels = lookup(named, linked.select(F.col("node").alias("d"), F.col("component").alias("_l")), ["d"], "left")
    labels = materialize(spark, labels.select("doc_id", "text_hash", "n", F.coalesce("_l", "d").alias("label")), "ngram-labels")
    least = labels.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = lookup(labels, least, ["label"]).select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("d is null").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id (all rows of
    that id, should it repeat)."""
    kept = jaccard_components(docs, words, num, den).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"]) == F.col("_hash")), "left_semi")
