"""Result documents and served views.

A document is a table of its members, so no task and no row holds a whole one: ``i`` (section
number), ``section`` (name), ``part`` (0 opens the section, 1 is a member, 2 closes it), ``sort``
(order inside the section) and ``json`` (the text of the line). :func:`write_document` puts the
lines in order by a range sort; its part files, joined by name, are one JSON object.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.session import materialize

_SORT = "array<struct<num:double,txt:string>>"
_KEEP_NULLS = {"ignoreNullFields": "false"}


def _sort_key(df: DataFrame, order) -> Column:
    """Order expressions of any atomic types as one comparable value."""
    items = []
    for c in order or []:
        numeric = isinstance(df.select(c).schema[0].dataType, T.NumericType)
        items.append(F.struct((c.cast("double") if numeric else F.lit(None).cast("double")).alias("num"),
                              (F.lit(None).cast("string") if numeric else c.cast("string")).alias("txt")))
    return F.array(*items).cast(_SORT)


def _lines(parts: list[tuple[str, str, str, DataFrame, list | None, Column | None]]) -> DataFrame:
    """Document rows of (section, opening text, closing text, rows, order, member text) parts."""
    out, frames = None, []
    for i, (name, opening, closing, df, order, text) in enumerate(parts):
        text = F.to_json(F.struct(*df.columns), _KEEP_NULLS) if text is None else text
        rows = df.select(F.lit(i).alias("i"), F.lit(name).alias("section"), F.lit(1).alias("part"),
                         _sort_key(df, order).alias("sort"), text.alias("json"))
        out = rows if out is None else out.unionByName(rows)
        frames += [(i, name, 0, None, opening), (i, name, 2, None, closing)]
    return out.unionByName(out.sparkSession.createDataFrame(frames, f"i int, section string, part int, sort {_SORT}, json string"))


def _list_parts(sections: dict, first: str, last: str) -> list:
    parts = []
    for k, (name, sec) in enumerate(sections.items()):
        df, order = sec if isinstance(sec, tuple) else (sec, None)
        parts.append((name, (first if k == 0 else ",") + json.dumps(name) + ":[",
                      "]" + (last if k == len(sections) - 1 else ""), df, order, None))
    return parts


def combined_document(sections: dict[str, tuple[DataFrame, list] | DataFrame]) -> DataFrame:
    """Rows of the JSON object ``{name: [rows...], ...}``; an empty section is
    ``[]`` and NULL fields stay ``null`` (valid JSON, R10). A section is its rows, or (rows, order)."""
    return _lines(_list_parts(sections, "{", "}"))


def served_data(results: dict | None, live: DataFrame, news: DataFrame) -> DataFrame:
    """Rows of the data endpoint's object ``{"spark": <results document>, "live": [...],
    "news": [...]}``; without results ``spark`` is ``[]`` as in the original (R17)."""
    head = _list_parts(results, '{"spark":{', "}") if results else []
    return _lines(head + _list_parts({"live": live, "news": news}, "," if results else '{"spark":[],', "}"))


def forecast_document(result: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows of ``{symbol: {history, forecast, model}}``, one line per symbol."""
    member = F.to_json(F.create_map(F.col(key), F.struct("history", "forecast", "model")), _KEEP_NULLS)
    return _lines([("forecast", "{", "}", result, [F.col(key)], F.substring(member, F.lit(2), F.length(member) - 2))])


def members(doc: DataFrame) -> DataFrame:
    """The members of a document: section and JSON text."""
    return doc.where("part = 1").select("section", "json")


def document_lines(doc: DataFrame) -> DataFrame:
    """The lines of a document in order, commas set. Equal members of a section become one line;
    the first one of each section (a handful of rows, one per section) goes without a comma."""
    keys = ["i", "part", "sort", "json"]
    rows = materialize(doc.sparkSession, doc.select(*keys), "document").groupBy(*keys).agg(F.count("*").cast("int").alias("n"))
    first = rows.where("part = 1").groupBy(F.col("i").alias("_i")).agg(F.min(F.struct("sort", "json")).alias("_f"))
    j = rows.join(first, rows["i"] == first["_i"], "left")
    comma = F.when((F.col("part") != 1) | (F.struct("sort", "json") == F.col("_f")), F.lit("")).otherwise(F.lit(","))
    line = F.concat(comma, F.array_join(F.array_repeat("json", F.col("n")), ","))
    return j.select("i", "part", "sort", "json", line.alias("value")).orderBy(*keys).select("value")


def write_document(doc: DataFrame, path: str) -> None:
    """Write a document as text (overwrite): part files whose lines, in file order, are the object."""
    document_lines(doc).write.mode("overwrite").text(path)
