"""The pipeline's stages against plain versions, each on its own input, and the registry."""

import brute
from cases import empty, messy  # noqa: F401
import corpus_pipeline as P
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    results = {}
    for name, stage in P.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        results[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = results["language_id"]
    assert after.count() >= 0.95 * len(before)
    before, after = results["line_dedup"]
    want = brute.line_windows(before)
    assert {(r["doc_id"], r["text"]) for r in after.collect()} == {(d, t) for (d, raw), t in want.items() if t or raw == t}
    before, after = results["ngram_jaccard"]
    assert sorted(r["doc_id"] for r in after.collect()) == brute.kept_of_near_copies(before)
    before, after = results["source_mixing"]
    assert {r["doc_id"] for r in after.collect()} <= {d for d, _ in before}
    before, after = results["packing"]
    assert {r["doc_id"] for r in after.collect()} == {d for d, _ in before}


def test_run_and_registry(spark):
    assert [n for n in E.queries() if n == "pipeline" or n.startswith("op")].__len__() == 14
    assert set(E.oracle_sql()) <= set(E.queries())
    out = E.queries()["pipeline"](spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_messy_rows_pass_all_stages(spark, messy, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (messy, empty):
        for name, stage in P.STAGES:
            from tickwise.session import materialize
            docs = materialize(spark, stage(spark, docs, SF), name)
            assert name == "packing" or docs.columns == columns
