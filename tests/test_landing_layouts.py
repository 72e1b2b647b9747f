"""Landing documents as other writers lay them out: indented, wrapped, truncated."""

import json

from tickwise import schemas
from tickwise.sources import landing

SCHEMA = next(v for k, v in vars(schemas).items() if k.startswith("PRICE") and hasattr(v, "fields"))
RECORDS = [{"symbol": s, "price_usd": float(i)} for i, s in enumerate("ABC")]


def test_multi_line_documents_give_all_records(spark, tmp_path):
    files = {"array.json": json.dumps(RECORDS, indent=2), "wrapped.json": "\n " + json.dumps({"n": 3, "events": RECORDS}, indent=2),
             "line.json": json.dumps(RECORDS), "cut.json": json.dumps(RECORDS, indent=2)[:40], "empty.json": "{}"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = landing.read_array_files(spark, str(tmp_path), SCHEMA).collect()
    got = {}
    for r in rows:
        if r["symbol"] is not None and r["price_usd"] is not None:
            got.setdefault(r["_file"].rsplit("/", 1)[1], []).append((r["_pos"], r["symbol"], r["price_usd"]))
    want = [(i, r["symbol"], r["price_usd"]) for i, r in enumerate(RECORDS)]
    assert all(sorted(got[n]) == want for n in ("array.json", "wrapped.json", "line.json"))
    bad = {r["_file"].rsplit("/", 1)[1] for r in landing.bad_files(spark, str(tmp_path), SCHEMA).collect()}
    assert "empty.json" in bad and not bad & {"array.json", "wrapped.json", "line.json"}
