"""Secret scan over whole texts with a trigram inverted index.

Each Arrow batch of documents is an index segment. From every rule's regular expression a
Boolean query over trigrams is derived (``trigram_query``); the segment's index holds the
postings of the trigrams that the rules ask for, the query intersects and unites postings, and
the rule's expression verifies the candidates it leaves. A rule without mandatory trigrams (hex
runs) scans every text. The index folds A-Z to a-z, which can only add candidates.

Segments need no exchange: work is one scan, memory one batch, and a lost task is read again.
Defined results: null text counts as empty; no spans gives an empty string.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as sc
from re import _parser as sp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0      # the part whose length counts
    least: int = 1      # shortest accepted length of that part
    base: bool = False


# The three base kinds in their listed order, then well-known public token formats.
RULES = (
    Rule("assign", r"""(?P<name>(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)

MAX_SET = 16   # strings kept per sub-expression before they turn into trigrams


def _grams(s: str) -> frozenset:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _all_of(strings: set[str]):
    """The query "one of these strings occurs": OR over strings of AND over their trigrams; True
    when a string is too short to have one."""
    if any(len(s) < 3 for s in strings):
        return True
    return _or([("and", _grams(s)) for s in strings])


def _or(parts: list):
    parts = [p for p in parts if p is not False]
    return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _and(parts: list):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("both", tuple(parts))


def _analyse(tree) -> tuple[list, set | None]:
    """Queries that any match implies and, if the whole expression can be enumerated, its
    lower-cased strings (then there are no queries)."""
    found, run, open_ended = [], {""}, False

    def close():
        nonlocal run, open_ended
        found.append(_all_of(run))
        run, open_ended = {""}, True

    for op, arg in tree:
        part = None
        if op is sc.LITERAL:
            part = {chr(arg).lower()}
        elif op is sc.IN and len(arg) <= MAX_SET and all(o is sc.LITERAL for o, _ in arg):
            part = {chr(a).lower() for _, a in arg}
        elif op is sc.AT:
            part = {""}
        elif op is sc.SUBPATTERN:
            inner, part = _analyse(arg[-1])
            found += inner
        elif op is sc.BRANCH:
            branches = [_analyse(b) for b in arg[1]]
            if all(strings is not None for _, strings in branches):
                part = set().union(*(strings for _, strings in branches))
            else:
                found.append(_or([_and([*inner, *([] if strings is None else [_all_of(strings)])]) for inner, strings in branches]))
        elif op in (sc.MAX_REPEAT, sc.MIN_REPEAT):
            low, high, sub = arg
            inner, strings = _analyse(sub)
            if low:
                found += inner if strings is None else [_all_of(strings)]
            if strings is not None and (low, high) == (0, 1):
                part = strings | {""}
        if part is None:
            close()
        elif len(run) * len(part) > MAX_SET:
            close()
            run = set(part)
        else:
            run = {x + y for x in run for y in part}
    if not open_ended:
        return [], run
    close()
    return [q for q in found if q is not True], None


def trigram_query(pattern: str):
    """Boolean trigram query that every text with a match satisfies; True when none is mandatory."""
    found, exact = _analyse(sp.parse(pattern))
    return _and([*found, *([] if exact is None else [_all_of(exact)])])


def query_grams(query) -> set[str]:
    if query is True:
        return set()
    kind, parts = query
    return set(parts) if kind == "and" else set().union(*(query_grams(p) for p in parts))


class Segment:
    """Inverted index of one batch: trigram -> ascending row numbers, for the given trigrams."""

    def __init__(self, texts: list[str], grams: set[str]):
        self.size = len(texts)
        folded = [t.encode("utf-8", "surrogatepass").lower() for t in texts]  # of bytes: A-Z only
        self.postings = {}
        for gram in sorted(grams):
            wanted = gram.encode()
            self.postings[gram] = np.fromiter((i for i, t in enumerate(folded) if wanted in t), np.int64)

    def search(self, query) -> np.ndarray:
        if query is True:
            return np.arange(self.size)
        kind, parts = query
        if kind == "and":
            lists = sorted((self.postings[g] for g in parts), key=len)
        else:
            lists = [self.search(p) for p in parts]
        out = lists[0]
        for x in lists[1:]:
            out = np.union1d(out, x) if kind == "or" else np.intersect1d(out, x, assume_unique=True)
        return out


def rule_spans(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _compile(rule: Rule) -> re.Pattern:
    # a run of one class: asking for its least length at once gives the same spans, faster
    if rule.pattern == r"[0-9a-f]+":
        return re.compile(r"[0-9a-f]{%d,}" % rule.least)
    return re.compile(rule.pattern, re.ASCII)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id and ``found``, an array of (kind, start, end) in order of
    start, then of the rules. Offsets are code points, ends exclusive."""
    queries = [trigram_query(r.pattern) for r in rules]
    grams = set().union(*(query_grams(q) for q in queries))

    def run(batches):
        compiled = [_compile(r) for r in rules]
        kinds = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            index = Segment(texts, grams)
            spans: list[list] = [[] for _ in texts]
            for k, (rule, query) in enumerate(zip(rules, queries)):
                for i in index.search(query).tolist():
                    spans[i] += [(a, k, b) for a, b in rule_spans(rule, compiled[k], texts[i])]
            rows = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(s)] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kinds))], names=["doc_id", "found"])

    # F.col of a backquoted name keeps clashing or dotted extra columns out of the way
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(run, "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text."""
    base = [r.kind for r in rules if r.base]
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    only = F.filter("found", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *[count(k) for k in base], F.sha2(joined(only), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
