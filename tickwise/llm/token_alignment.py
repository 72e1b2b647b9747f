"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids.

Tasks work on Arrow columns throughout: id lists are flattened with their parent indices, byte ends are
cumulative sums of token lengths taken back to each text's start, an Acero hash join on (text, end) gives
the links, and ``Table.group_by`` counts id pairs per block of texts, which Spark merges. In a second pass
a block's texts meet the dictionary of the block's pairs with their corpus-wide counts, so that counts are
exchanged once per block and distinct pair, never once per link.

    texts -> (block, row of a text with its pairs) and (block, pair, n)    written once
    (pair, n) -> counts -> highest count per B id                          at most one row per B id, broadcast
    block's rows + block's (pair, count, highest) -> result rows

A block ends at ``BLOCK_LINKS`` links, or at the end of a task, which bounds its dictionary.

Defined results: null and empty texts, and texts whose tokens do not give back the text's bytes behind one
space in both vocabularies, have no tokens: zeros and the empty digest. Repeated rows are aligned and counted
each. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.packing import Encoder
from tickwise.llm.text import row_chunks, text_runs
from tickwise.session import materialize

BLOCK_LINKS = 1_000_000
LOOKUP_LINKS = 1 << 16      # links looked up at once
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_SPACE_PIECE = "▁"


def default_paths() -> tuple[str, str, str]:
    """Rank file and tokenizer file of vocabulary A, model file of vocabulary B."""
    import public_tokenizers as p
    return p.path("byte_bpe_50k.tiktoken"), p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")


class Vocabularies:
    """Both tokenizers and the bytes of their tokens; loaded at first use, pickled as their paths."""

    def __init__(self, paths: tuple[str, str, str]):
        self.paths, self._b = paths, None
        self.encode_a = Encoder(paths[:2])

    def __getstate__(self):
        return {"paths": self.paths, "encode_a": self.encode_a, "_b": None}

    @property
    def b(self):
        if self._b is None:
            import sentencepiece
            self._b = sentencepiece.SentencePieceProcessor(model_file=self.paths[2])
        return self._b

    def bytes_a(self) -> pa.Array:
        tokens = self.encode_a.tokens()
        return pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.binary())

    def bytes_b(self) -> pa.Array:
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        one = [_BYTE_PIECE.fullmatch(p) for p in pieces]
        return pa.array([bytes([int(m[1], 16)]) if m else p.replace(_SPACE_PIECE, " ").encode() for m, p in zip(one, pieces)], pa.binary())

    def lists_a(self, texts: list[str]) -> pa.ListArray:
        ids = [self.encode_a(" " + t) if t else np.zeros(0, np.uint16) for t in texts]
        ends = np.cumsum([0, *map(len, ids)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.uint16)]).astype(np.int32)))

    def lists_b(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.b.encode(texts, num_threads=1), pa.list_(pa.int32()))


def spelt(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """Bytes of each list's tokens, joined."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values)), pa.scalar(b""))


def emptied(ids: pa.ListArray, keep: pa.Array) -> pa.ListArray:
    """Lists where ``keep`` holds, empty ones elsewhere."""
    size = np.where(keep.to_numpy(zero_copy_only=False), pc.list_value_length(ids).to_numpy(), 0)
    kept = ids.filter(keep)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.r_[0, size]), pa.int32()), kept.flatten())


def end_keys(ids: pa.ListArray, lengths: pa.Array) -> pa.Array:
    """(text << 32 | byte end) of every token: the cumulative sum of lengths less the sum before the
    text's first token."""
    values, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(lengths.take(values))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total])
    end = pc.subtract(total, before.take(ids.offsets.take(parent)))
    return pc.bit_wise_or(pc.shift_left(parent.cast(pa.int64()), pa.scalar(32, pa.int64())), end)


def link(ids_a: pa.ListArray, ids_b: pa.ListArray, keys_a: pa.Array, keys_b: pa.Array) -> pa.Table:
    """key, a, b: every pair of an A and a B token that end together."""
    left = pa.table({"key": keys_a, "a": pc.list_flatten(ids_a)})
    right = pa.table({"key": keys_b, "b": pc.list_flatten(ids_b)})
    return left.join(right, "key", join_type="inner", use_threads=False).sort_by("key")


def grouped_text(ids: pa.ListArray, keys: pa.Array, cuts: np.ndarray) -> pa.Array:
    """Ids of each group, comma-joined; groups end at the keys ``cuts``."""
    ends = np.searchsorted(keys.to_numpy(), cuts, side="right")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pc.list_flatten(ids).cast(pa.string())), ",")


def align(texts: list[str], words: Vocabularies, bytes_a: pa.Array, bytes_b: pa.Array, size_a: pa.Array, size_b: pa.Array):
    """(counts n_a, n_b, n_groups, n_links per text; digests; links) of some texts."""
    n = len(texts)
    ids_a, ids_b = words.lists_a(texts), words.lists_b(texts)
    want = pa.array([(" " + t).encode() if t else None for t in texts], pa.binary())
    same = pc.fill_null(pc.and_(pc.equal(spelt(ids_a, bytes_a), want), pc.equal(spelt(ids_b, bytes_b), want)), False)
    ids_a, ids_b = emptied(ids_a, same), emptied(ids_b, same)
    keys_a, keys_b = end_keys(ids_a, size_a), end_keys(ids_b, size_b)
    links = link(ids_a, ids_b, keys_a, keys_b)
    ends = links["key"].to_numpy()
    cuts = ends[np.r_[True, ends[1:] != ends[:-1]]] if len(ends) else ends
    groups = pc.binary_join_element_wise(grouped_text(ids_a, keys_a, cuts), grouped_text(ids_b, keys_b, cuts), "|")
    first = np.searchsorted(cuts >> 32, np.arange(n + 1))
    spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), groups), ";").to_pylist()
    size = lambda ids: pc.list_value_length(ids).to_numpy()
    held = np.searchsorted(ends >> 32, np.arange(n + 1))
    digests = [hashlib.sha256(s.encode()).hexdigest() if k else "" for s, k in zip(spelled, size(ids_a))]
    return size(ids_a), size(ids_b), np.diff(first), held, digests, links


_NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "pair", "n"]


def pair_type(size_a: int, size_b: int) -> pa.DataType:
    """Of the number A id * size_b + B id."""
    return pa.int32() if size_a * size_b < 1 << 31 else pa.int64()


def _rows(height: int, pair_kind: pa.DataType, **cols) -> pa.RecordBatch:
    special = {"groups_sha256": pa.string(), "pairs": pa.list_(pair_kind), "pair": pair_kind}
    kinds = [special.get(name, pa.int64()) for name in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array(cols[name], kind) if name in cols else pa.nulls(height, kind) for name, kind in zip(_NAMES, kinds)], names=_NAMES)


def aligned(docs: DataFrame, words: Vocabularies, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Rows of texts (``pair`` null) with their links' pairs (see ``pair_type``), and rows of the blocks'
    pair counts (``pair``, ``n``)."""
    width = words.b.vocab_size()
    kind = pair_type(len(words.bytes_a()), width)

    def run(batches):
        from pyspark import TaskContext
        bytes_a, bytes_b = words.bytes_a(), words.bytes_b()
        size_a, size_b = (pc.binary_length(t).cast(pa.int64()) for t in (bytes_a, bytes_b))
        block, counts, met = TaskContext.get().partitionId() << 32, [], 0

        def closed():
            total = pa.concat_tables(counts).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return _rows(total.num_rows, kind, block=np.full(total.num_rows, block), pair=total["pair"].combine_chunks(), n=total["n_sum"].combine_chunks())

        for batch in batches:
            ids, texts, at = batch.column(0), [t or "" for t in batch.column(1).to_pylist()], 0
            for some in text_runs(texts):
                n_a, n_b, n_groups, held, digests, links = align(some, words, bytes_a, bytes_b, size_a, size_b)
                pair = pc.add(pc.multiply(links["a"].cast(pa.int64()), width), links["b"].cast(pa.int64())).combine_chunks().cast(kind)
                yield _rows(len(some), kind, block=np.full(len(some), block), doc_id=ids.slice(at, len(some)), n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=np.diff(held),
                            groups_sha256=digests, pairs=pa.ListArray.from_arrays(pa.array(held, pa.int32()), pair))
                counts.append(pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"]))
                met, at = met + len(pair), at + len(some)
                if met >= block_links:
                    yield closed()
                    block, counts, met = block + 1, [], 0
        if counts:
            yield closed()

    number = "int" if kind == pa.int32() else "long"
    schema = f"block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<{number}>, pair {number}, n long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _looked_up(texts: pa.RecordBatch, known: pa.Table) -> pa.RecordBatch:
    """Result rows of some texts from their block's dictionary (pair, n, top)."""
    lists = texts.column(texts.schema.names.index("pairs"))
    links = pa.table({"text": pc.list_parent_indices(lists), "pair": pc.list_flatten(lists)})
    per_text = links.group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")]).join(known, "pair", join_type="inner", use_threads=False)
    times = per_text["count_all"]
    per_text = pa.table({"text": per_text["text"], "sum": pc.multiply(times, per_text["n"]), "best": pc.multiply(times, per_text["top"])})
    total = per_text.group_by("text", use_threads=False).aggregate([("sum", "sum"), ("best", "sum")])
    sums, best = np.zeros(texts.num_rows, np.int64), np.zeros(texts.num_rows, np.int64)
    sums[total["text"].to_numpy()], best[total["text"].to_numpy()] = total["sum_sum"].to_numpy(), total["best_sum"].to_numpy()
    col = dict(zip(texts.schema.names, texts.columns)) | {"n_best": pa.array(best), "count_sum": pa.array(sums)}
    names = [f.split()[0] for f in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([col[name] for name in names], names=names)


def alignment(docs: DataFrame, paths: tuple[str, str, str] | None = None, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    words = Vocabularies(paths or default_paths())
    rows = materialize(spark, aligned(docs, words, block_links), "aligned")
    counted = rows.filter("pair is not null").select("block", "pair", "n")
    total = counted.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", (F.col("pair") % words.b.vocab_size()).cast("int"))
    total = materialize(spark, total, "pair-counts")
    highest = total.groupBy("b").agg(F.max("total").alias("highest"))    # one row per id of vocabulary B
    known = total.join(F.broadcast(highest), "b").select("pair", F.col("total").alias("n"), (F.col("total") == F.col("highest")).cast("long").alias("top"))
    shared = counted.select("block", "pair").join(known, "pair")
    parts = shared.withColumn("kind", F.lit(0)).unionByName(
        rows.filter("pair is null").drop("pair", "n").withColumn("kind", F.lit(1)), allowMissingColumns=True)
    names = ["block", "kind", "pair", "n", "top", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
    dealt = parts.select(*names).repartition("block").sortWithinPartitions("block", "kind")

    def run(batches):
        at, held, known_ = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            for i, j in zip(cuts, np.r_[cuts[1:], len(keys)]):
                part = batch.slice(i, j - i)
                if keys[i, 0] != at:
                    at, held, known_ = keys[i, 0], [], None
                if keys[i, 1] == 0:
                    held.append(part.select(["pair", "n", "top"]))
                    continue
                if known_ is None:
                    known_ = pa.Table.from_batches(held, schema=held[0].schema if held else part.select(["pair", "n", "top"]).schema)
                size = np.cumsum(part.column(names.index("n_links")).to_numpy())
                for i, j in row_chunks(np.r_[0, size], LOOKUP_LINKS):
                    yield _looked_up(part.slice(i, j - i), known_)

    return dealt.mapInArrow(run, RESULT)
