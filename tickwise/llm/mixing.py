"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). Token capacity
flows from patterns to source quotas; a pattern's first pass costs less than its second and that
less than its third, so repetition is spread before it deepens (convex costs). The flow says how
many words of each pattern to take: some whole passes and a part of one more, which goes to the
documents first in a seeded order; one larger than what is left is passed over.

Only totals by pattern and by source and a few last documents reach the driver. The seeded order is never sorted as a whole:
its first bits are counted per pattern, and only the slice in which the quota ends is ordered.

Defined results: null text has size 0 and is never taken; a null or empty source array is a
membership in nothing and never taken; equal places in the order go by doc_id, then size; rows that
repeat doc_id and size are taken one by one; an empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.ordering import ranked
from tickwise.session import materialize

MAX_REPEAT = 3
SEED = 17
SLICE_BITS = 12
WALK_ROWS = 2000    # what a round leaves is gone through on the driver when it is no more rows
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def capped_targets(sizes: list[int], weights: list[float], most: float = MAX_REPEAT) -> list[float]:
    """Shares of sum(sizes) by weight, none above ``most`` times its size; what is above is
    shared again by weight until none is."""
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > most * sizes[i]] if total else []
        if not over:
            for i in free:
                target[i] = left * weights[i] / total if total else 0.0
            break
        for i in over:
            target[i] = float(most * sizes[i])
            left -= target[i]
            free.discard(i)
    return target


def min_cost_flow(capacity: list[int], members: list[list[int]], quota: list[int], passes: int = MAX_REPEAT) -> list[dict[int, int]]:
    """Words from each pattern to each of its sources. Pattern p has ``passes`` layers of
    ``capacity[p]`` words, layer r at cost r a word. Sources are filled along cheapest
    residual paths (Bellman-Ford), so the total cost is least for the amount routed."""
    flow = [{s: 0 for s in m} for m in members]
    used = [0] * len(capacity)
    into = [[p for p, m in enumerate(members) if s in m] for s in range(len(quota))]
    need = list(quota)
    for goal in range(len(quota)):
        while need[goal] > 0:
            # from the goal back: reach a pattern with room, moving other sources' words on the way
            cost, came = {("s", goal): 0}, {("s", goal): None}
            work = [("s", goal)]
            while work:
                kind, i = work.pop(0)
                if kind == "s":
                    steps = [("p", p) for p in into[i]]
                else:
                    steps = [("s", s) for s, f in flow[i].items() if f > 0]
                for node in steps:
                    if node not in cost:
                        cost[node], came[node] = 0, (kind, i)
                        work.append(node)
            rooms = [(used[p] // capacity[p], p) for k, p in cost if k == "p" and capacity[p] and used[p] < passes * capacity[p]]
            if not rooms:
                break
            layer, p = min(rooms)
            amount = min(need[goal], (layer + 1) * capacity[p] - used[p])
            path, node = [], ("p", p)
            while node is not None:
                path.append(node)
                node = came[node]
            for here, there in zip(path[1::2], path[2::2]):     # a source hands words of the next pattern on
                amount = min(amount, flow[there[1]][here[1]])
            for (_, pattern), (_, source) in zip(path[::2], path[1::2]):
                flow[pattern][source] += amount
            for (_, source), (_, pattern) in zip(path[1::2], path[2::2]):
                flow[pattern][source] -= amount
            used[p] += amount
            need[goal] -= amount
    return flow


def _part_pass(base: DataFrame, gaps: dict[str, int]) -> tuple[dict[str, list[tuple[int, int]]], DataFrame]:
    """Documents of each pattern in its seeded order, each one that fits what is left of ``gaps``.

    A round takes the slices before the one in which the gap ends, of documents no larger than the
    gap, and of that slice what fits, rows that repeat doc_id and size one by one. The next round goes on
    with the documents that still fit, until none does. Returns the rounds' (gap, slice) by pattern and,
    of end slices, how many (``_n``) of the equal rows (``_m``) are taken."""
    spark = base.sparkSession
    key = ["_pattern", "_slice", "_order", "_id", "_size"]
    marks = "_id string, _order long, _pattern string, _n long, _m long"
    rules: dict[str, list[tuple[int, int]]] = {}
    hits = spark.createDataFrame([], marks)
    left = base.groupBy(*key).agg(F.count("*").alias("_m"))     # equal rows are one
    while gaps:
        open_ = spark.createDataFrame(list(gaps.items()), "_key string, _gap long")
        fit = left.join(F.broadcast(open_), F.col("_pattern") == F.col("_key")).filter("_size > 0 AND _size <= _gap").drop("_key")
        if rules:
            fit = materialize(spark, fit, "mixing-left")
            few = fit.limit(WALK_ROWS + 1).collect()
            if len(few) <= WALK_ROWS:
                return rules, hits.unionByName(spark.createDataFrame(_walk(few), marks))
        sums = fit.groupBy("_pattern", "_slice", "_gap").agg(F.sum(F.col("_size") * F.col("_m")).alias("n"))
        sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("_pattern").orderBy("_slice")))
        ends = sums.filter("upto > _gap").groupBy("_pattern").agg(F.min(F.struct(F.col("_slice").alias("slice"), (F.col("_gap") - F.col("upto") + F.col("n")).alias("room"))).alias("end"))
        end = {r["_pattern"]: (r["end"]["slice"], r["end"]["room"]) for r in ends.collect()}
        for name, gap in gaps.items():
            rules.setdefault(name, []).append((gap, end.get(name, (1 << SLICE_BITS, 0))[0]))
        at = spark.createDataFrame([(k, *v) for k, v in end.items()], "_key string, _end long, _room long")
        marked = fit.join(F.broadcast(at), F.col("_pattern") == F.col("_key")).drop("_key")
        before = F.coalesce(F.sum(F.col("_size") * F.col("_m")).over(Window.partitionBy("_pattern").orderBy("_order", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        edge = marked.filter("_slice = _end").withColumn("_before", before)
        edge = materialize(spark, edge.withColumn("_n", F.expr("least(_m, greatest(0L, (_room - _before) div _size))")), "mixing-edge")
        hits = hits.unionByName(edge.filter("_n > 0").select("_id", "_order", "_pattern", "_n", "_m"))
        took = {r["_pattern"]: r["n"] for r in edge.groupBy("_pattern").agg(F.sum(F.col("_size") * F.col("_n")).alias("n")).collect()}
        gaps = {k: room - took.get(k, 0) for k, (_, room) in end.items() if room > took.get(k, 0)}
        # of rows in part taken the rest is larger than the gap that is left
        left = marked.filter("_slice > _end").select(*key, "_m").unionByName(edge.filter("_n = 0").select(*key, "_m"))
    return rules, hits


def _walk(rows: list) -> list[tuple]:
    """The rounds of ``_part_pass`` for a few rows, one document after the other."""
    gap = {r["_pattern"]: r["_gap"] for r in rows}
    out = []
    for r in sorted(rows, key=lambda r: (r["_pattern"], r["_order"], r["_id"] is not None, r["_id"] or "", r["_size"])):
        n = min(r["_m"], gap[r["_pattern"]] // r["_size"])
        if n:
            gap[r["_pattern"]] -= n * r["_size"]
            out.append((r["_id"], r["_order"], r["_pattern"], n, r["_m"]))
    return out


def mix(docs: DataFrame, sources: Column, size: Column, weights=None, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> tuple[DataFrame, dict]:
    """``docs`` with sources, size, repeats and taken (columns of those names are replaced), and per
    source its words and its target.

    ``sources`` is an array column (a document may belong to several); ``weights(names)`` gives the
    relative weight of each name in the sorted list (default 1, 2, 3 in turn). Targets share all
    words by weight (``capped_targets``). Of rows that repeat doc_id and size any may be taken, each counts."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("sources", "size", "repeats", "taken")]
    members = F.sort_array(F.array_distinct(F.transform(sources, lambda s: F.struct(s.isNull().alias("none"), F.coalesce(s, F.lit("")).alias("name")))))
    rows = docs.withColumns({"_members": members, "_size": size}).select(*[F.col(f"`{c}`") for c in own], "_members", "_size")
    rows = rows.withColumns({"_pattern": F.to_json("_members"), "_order": F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "_size")})
    rows = rows.withColumn("_slice", F.shiftrightunsigned("_order", 64 - SLICE_BITS))
    base = materialize(spark, rows.select(F.col("doc_id").cast("string").alias("_id"), "_members", "_size", "_pattern", "_order", "_slice"), "mixing")

    totals = base.groupBy("_pattern").agg(F.first("_members").alias("members"), F.sum("_size").alias("n")).collect()
    patterns = [[(m["none"], m["name"]) for m in r["members"] or []] for r in totals]
    capacity = [int(r["n"]) for r in totals]
    listed = sorted({m for p in patterns for m in p})
    number = {m: i for i, m in enumerate(listed)}
    reach = [sum(c for p, c in zip(patterns, capacity) if m in p) for m in listed]
    names = [None if none else name for none, name in listed]
    target = capped_targets(reach, weights(names) if weights else [1 + i % 3 for i in range(len(listed))], max_repeat)
    flow = min_cost_flow(capacity, [[number[m] for m in p] for p in patterns], [round(t) for t in target], max_repeat)
    quota = [sum(f.values()) for f in flow]
    plan = [(r["_pattern"], q // c if c else 0, q % c if c else 0) for r, q, c in zip(totals, quota, capacity)]
    rules, hits = _part_pass(base, {key: rest for key, _, rest in plan if rest})
    plan = spark.createDataFrame([(key, full, rules.get(key, [])) for key, full, _ in plan], "_key string, _full long, _rules array<struct<gap:long,end:long>>")

    rows = rows.join(F.broadcast(plan), F.col("_pattern") == F.col("_key"))
    hits = materialize(spark, hits.select(*[F.col(c).alias(f"_h{c}") for c in hits.columns]), "mixing-hits")
    same = F.col("doc_id").cast("string").eqNullSafe(F.col("_h_id")) & (F.col("_order") == F.col("_h_order")) & (F.col("_pattern") == F.col("_h_pattern"))
    part = hits.filter("_h_n < _h_m")       # one group of equal rows per pattern and round at most
    out = rows.join(hits, same, "left").filter("_h_n is null OR _h_n = _h_m").withColumn("_nth", F.lit(0).cast("long"))
    if not part.isEmpty():
        group = ["_pattern", "_order", "_h_id"]
        placed = ranked(rows.join(F.broadcast(part), same).withColumn("_row", F.monotonically_increasing_id()), [*group, "_row"], "mixing-part")
        first = placed.groupBy(*group).agg(F.min("place").alias("_first"))
        first = first.select(*[F.col(c).alias(f"_f{c}") for c in group], "_first")
        mine = (F.col("_pattern") == F.col("_f_pattern")) & (F.col("_order") == F.col("_f_order")) & F.col("_h_id").eqNullSafe(F.col("_f_h_id"))
        placed = placed.join(F.broadcast(first), mine).withColumn("_nth", F.col("place") - F.col("_first") + 1)
        out = out.unionByName(placed.select(*out.columns))
    swept = F.exists("_rules", lambda r: (F.col("_size") <= r["gap"]) & (F.col("_slice") < r["end"]))
    extra = (swept | F.coalesce(F.col("_nth") <= F.col("_h_n"), F.lit(False))).cast("long")
    repeats = F.when(F.col("_size") > 0, F.col("_full") + F.coalesce(extra, F.lit(0))).otherwise(0)
    named = F.transform("_members", lambda m: F.when(~m["none"], m["name"]))
    out = out.select(*[F.col(f"`{c}`") for c in own], named.alias("sources"), F.col("_size").alias("size"), repeats.alias("repeats"), (repeats * F.col("_size")).alias("taken"))
    return out, dict(zip(names, zip(reach, target)))


def mix_by_source(docs: DataFrame) -> DataFrame:
    """Every document belongs to its one ``source`` (null is a source of its own): doc_id, source,
    size, source_size, target, taken and repeats."""
    spark = docs.sparkSession
    sized = materialize(spark, docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")), "mixing-sizes")
    out, listed = mix(sized.withColumnRenamed("size", "_words"), F.array("source"), F.col("_words"))
    table = spark.createDataFrame(pd.DataFrame({"_name": list(listed), "source_size": [n for n, _ in listed.values()], "target": [float(t) for _, t in listed.values()]}),
                                  "_name string, source_size long, target double")
    return out.join(table, out["source"].eqNullSafe(table["_name"])).select("doc_id", "source", "size", "source_size", "target", "taken", "repeats")
