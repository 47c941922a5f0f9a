import math

import corpus_pipeline
from listwell.llm.mixing import with_copies
from listwell.llm.quality import fit_quality_model, quality_report

from .test_jaccard import brute as similar
from .test_packing import check
from .test_substring_dedup import brute

SF = "/root/testdata/sf0.01"


def test_each_stage_against_brute_force(spark, tmp_path):
    source = docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [[r.asDict() for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        tables.append(docs.collect() if name == "packing" else [r.asDict() for r in docs.collect()])
        assert name == "packing" or docs.columns == columns
    start, good, distinct, cut, mixed, packed = tables
    model = fit_quality_model(source, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in quality_report(source, model).collect() if r.kept}
    by_id = lambda rows: sorted(rows, key=lambda r: r["doc_id"])
    assert by_id(good) == by_id(r for r in start if r["doc_id"] in kept) and len(good) < len(start)
    groups = similar([(r["doc_id"], r["text"]) for r in good])
    assert by_id(distinct) == by_id(r for r in good if groups[r["doc_id"]] == r["doc_id"]) and len(distinct) < len(good)
    want = brute([(r["doc_id"], r["text"]) for r in distinct])
    assert {r["doc_id"] for r in cut} == {i for i, (n, gone, _) in want.items() if gone < n}
    old = {r["doc_id"]: r for r in distinct}
    for r in cut:
        n, gone, _ = want[r["doc_id"]]
        assert len(r["text"].split()) == n - gone and r["n_chars"] == len(r["text"])
        assert gone or r == old[r["doc_id"]]
    copies = {r.doc_id: r.copies for r in with_copies(spark.read.parquet(str(tmp_path / "repeated_passages"))).selectExpr("doc.doc_id as doc_id", "mix.copies as copies").collect()}
    assert by_id(mixed) == by_id(r for r in cut for _ in range(copies[r["doc_id"]]))
    n = check(packed, [(r["doc_id"], r["text"]) for r in mixed], 2048)
    assert n <= math.ceil(sum(r.length for r in packed) / 2048) * 1.01 + 1


def test_run_and_registration(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert len([n for n in __spark_entry__.queries() if n.startswith("op")]) == 10


def test_stages_take_odd_rows_and_extra_columns(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, None, "en", None, None), (10**6, "", None, "src0", 0), (10**6 + 1, "w " * 60_000, "en", "src0", 120_000)], docs.schema)
    wide = docs.unionByName(odd).selectExpr("*", "1 as id", "'x' as rest", "2 as chunk", "3 as mix", "array(4) as fp", "named_struct('text', 1) as doc", "5 as component_id", "6 as `_`", "cast(null as string) as kept_text")
    for case in (wide, wide.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, case, "/root/testdata/sf0.001")
            assert name == "packing" or out.schema.names == wide.columns
            assert (out.count() > 0) == (case is wide)
