"""Mixture-controlled packing by deficit round-robin over source queues.

Every source has a queue, its documents' tokens in a fixed order. A round is one window of ``window``
tokens (a sequence by default) and gives each source its quantum, in proportion to the targets; what a
quantum lacks of whole tokens is carried as the source's deficit into the next round. Written out, the
tokens source s has got after round k are ``served(s, k) = min(T_s, floor(k * N_s / D))``, so the round
and place of any token follow from its index in its queue, without visiting earlier rounds: partitions
need only the number of tokens that earlier partitions hold of each source, and deficits carry over
windows and partitions alike. Rounds follow each other without gaps in one stream, which is cut into
sequences of ``LENGTH`` tokens; any stretch of a round's length holds each source's quantum, up to a few
tokens, until queues run dry. The tail becomes sequences of falling powers of two, so nothing is padded.

The token table is written once (2 bytes a token) and read once; no exchange moves texts or ids. A
piece costs one sum over the sources.

Defined results: null text counts as empty and is the end mark alone; a null source is a queue of
its own; repeated rows are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.text import text_runs
from tickwise.session import materialize

LENGTH = 1024
WINDOW = LENGTH         # tokens of a round
PARTS = 1 << 20         # a quantum is a whole number of these parts of a token
SLICE = 1 << 16         # tokens placed at once
EMIT = 1 << 15          # pieces in a batch, those of one text at least
END_ID = 0
_LONG_GAP = re.compile(r"\s{10000}")


def default_vocabulary() -> tuple[str, str]:
    """Paths of the rank file and of the same vocabulary's tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Text -> ids. The rank file gives the ids of the tokenizer file at several times the speed;
    texts with very long gaps, on which its splitter recurses, go to the latter. The vocabularies
    are loaded at first use and never travel: a pickled encoder is its paths."""

    def __init__(self, paths: tuple[str, str]):
        self.paths, self._fast, self._slow = paths, None, None

    def __getstate__(self):
        return {"paths": self.paths, "_fast": None, "_slow": None}

    def tokens(self) -> dict[int, bytes]:
        """Bytes of every id."""
        with open(self.paths[0], "rb") as f:
            return {int(b): base64.b64decode(a) for a, b in (line.split() for line in f)}

    def __call__(self, text: str) -> np.ndarray:
        if _LONG_GAP.search(text):
            if self._slow is None:
                from tokenizers import Tokenizer
                self._slow = Tokenizer.from_file(self.paths[1])
                self._slow.encode_special_tokens = True
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint16)
        if self._fast is None:
            import public_tokenizers
            import tiktoken
            ranks = {raw: i for i, raw in self.tokens().items()}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return np.array(self._fast.encode_ordinary(text), np.uint16)


def tokenise(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """doc_id, source, part (the task's number), start (tokens of the same source before the row
    in the task), tokens, ids (little-endian unsigned 16-bit, the end mark last)."""
    encode = Encoder(paths)

    def run(batches):
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            ids, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts, at = [t or "" for t in batch.column(2).to_pylist()], 0
            for run_ in text_runs(texts):
                starts, sizes, data = [], [], []
                for k, text in enumerate(run_):
                    got = np.append(encode(text), np.uint16(END_ID)).astype("<u2")
                    source = sources[at + k]
                    starts.append(seen.get(source, 0))
                    seen[source] = starts[-1] + len(got)
                    sizes.append(len(got))
                    data.append(got.tobytes())
                to = at + len(run_)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at:to], pa.int64()), pa.array(sources[at:to], pa.string()), pa.array([part] * len(run_), pa.int32()),
                                                  pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())],
                                                 names=["doc_id", "source", "part", "start", "tokens", "ids"])
                at = to

    source = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")
    return source.mapInArrow(run, "doc_id long, source string, part int, start long, tokens long, ids binary")


class Rounds:
    """Closed form of the rounds for queues of ``totals`` tokens with target ``weights`` (default:
    the totals, so all queues end together). Queues that end early leave shorter rounds."""

    def __init__(self, totals: list[int], weights: list[float] | None = None, window: int = WINDOW, length: int = LENGTH):
        self.totals, self.length = np.array(totals, np.int64), length
        self.all = int(self.totals.sum())
        share = np.array(totals if weights is None else weights, float)
        self.num = np.maximum(1, np.round(share / max(share.sum(), 1e-300) * window * PARTS)).astype(np.int64)
        self.whole, self.part = self.num // PARTS, self.num % PARTS
        self.tail = self.all - self.all % length
        rest = self.all - self.tail         # the tail's sequences: falling powers of two
        sizes = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
        self.tail_starts = self.tail + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]]).astype(np.int64)

    def served(self, k) -> np.ndarray:
        """Tokens each queue has given after ``k`` rounds (one row for each of several ``k``)."""
        k = np.asarray(k, np.int64)[..., None]
        return np.minimum(self.totals, k * self.whole + k * self.part // PARTS)

    def round_of(self, s: int, start: int, n: int) -> np.ndarray:
        """Round of each of tokens start .. start + n of queue ``s``: the first that serves beyond it."""
        num = int(self.num[s])
        q, r = divmod(start * PARTS, num)
        return q + (r + np.arange(1, n + 1, dtype=np.int64) * PARTS - 1) // num

    def places(self, s: int, start: int, n: int) -> np.ndarray:
        """Place in the stream of each of tokens start .. start + n of queue ``s``."""
        k = self.round_of(s, start, n)
        new = np.r_[True, k[1:] != k[:-1]]
        rounds, base = k[new], []
        step = max(1, (1 << 20) // len(self.totals))
        for a in range(0, len(rounds), step):
            before, after = self.served(rounds[a:a + step]), self.served(rounds[a:a + step] + 1)
            # the round's tokens of earlier queues, then those of the queue itself
            base.append(after[:, :s].sum(axis=1) + before[:, s:].sum(axis=1) - before[:, s])
        return np.concatenate(base)[np.cumsum(new) - 1] + np.arange(start, start + n)

    def sequence(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset in it for places of the stream."""
        number, offset = place // self.length, place % self.length
        late = place >= self.tail
        if late.any():
            at = np.searchsorted(self.tail_starts, place[late], side="right") - 1
            number[late], offset[late] = self.tail // self.length + at, place[late] - self.tail_starts[at]
        return number, offset

    def pieces(self, s: int, start: int, n: int):
        """Index in the document, length, sequence and offset of the pieces of tokens start .. start + n
        of queue ``s``: runs of neighbouring places in one sequence (cut where a slice ends, too)."""
        for a in range(0, n, SLICE):
            m = min(SLICE, n - a)
            place = self.places(s, start + a, m)
            number, offset = self.sequence(place)
            first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1] + 1) | (number[1:] != number[:-1])])
            yield first + a, np.diff(np.r_[first, m]), number[first], offset[first]


PIECES = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, weights: dict | None = None, window: int = WINDOW, length: int = LENGTH,
         paths: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents; ``weights`` maps sources to target shares (default: their shares
    of all tokens). The driver holds one number per source. With ``with_ids`` each piece also
    carries its ids."""
    spark = docs.sparkSession
    tokens = materialize(spark, tokenise(docs, paths or default_vocabulary()), "tokens")
    held = tokens.groupBy("part", "source").agg(F.sum("tokens").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = materialize(spark, held.select("part", "source", F.coalesce(earlier, F.lit(0)).alias("base"), "n"), "token-base")
    totals = sorted(((r["source"], r["n"]) for r in base.groupBy("source").agg(F.sum("n").alias("n")).collect()), key=lambda x: (x[0] is None, x[0] or ""))
    queue = {s: i for i, (s, _) in enumerate(totals)}
    rounds = Rounds([n for _, n in totals] or [0], [weights[s] for s, _ in totals] if weights else None, window, length)
    schema = PIECES + (", ids binary" if with_ids else "")

    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            col = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n != "ids"}
            out, counts, crcs, raws, held = [], [], [], [], 0

            def emit(lo: int, hi: int):
                """The pieces of rows ``lo`` .. ``hi`` of the batch."""
                first, length, number, offset = (np.concatenate(x) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 4
                rep = lambda name, kind: pa.array(col[name][lo:hi], kind).take(pa.array(np.repeat(np.arange(hi - lo), counts)))
                cols = [rep("doc_id", pa.int64()), rep("source", pa.string()), pa.array(first), pa.array(length), pa.array(crcs, pa.int64()),
                        rep("tokens", pa.int64()), pa.array(number), pa.array(offset)] + ([pa.array(raws, pa.binary())] if with_ids else [])
                for x in (out, counts, crcs, raws):
                    x.clear()
                return pa.RecordBatch.from_arrays(cols, names=names)

            lo = 0
            for i in range(batch.num_rows):
                wide = memoryview(np.frombuffer(batch.column("ids")[i].as_buffer(), "<u2").astype("<u4")).cast("B")
                counts.append(0)
                for part in rounds.pieces(queue[col["source"][i]], col["base"][i] + col["start"][i], col["tokens"][i]):
                    out.append(part)
                    counts[-1] += len(part[0])
                    cut = [wide[4 * f:4 * (f + m)] for f, m in zip(part[0].tolist(), part[1].tolist())]
                    crcs += map(zlib.crc32, cut)
                    if with_ids:
                        raws += map(bytes, cut)
                held += counts[-1]
                if held >= EMIT:
                    yield emit(lo, i + 1)
                    lo, held = i + 1, 0
            yield emit(lo, batch.num_rows)

    b = base.select("part", F.col("source").alias("_s"), "base")
    # one row per task and source: joined by Spark's own size check, broadcast only while small
    joined = tokens.join(b, (tokens["part"] == b["part"]) & tokens["source"].eqNullSafe(b["_s"]))
    return joined.select("doc_id", "source", "base", "start", "tokens", "ids").mapInArrow(run, schema)
