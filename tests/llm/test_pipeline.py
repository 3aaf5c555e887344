import corpus_pipeline as cp
from skyflow.llm.decontaminate import word_shingles
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_line_dedup import brute as dedup_lines
from tests.llm.test_packing import brute_check

DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    items = [word_shingles(r.text or "", 5) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, DIR)
        if k == 4:
            brute_check(out.collect(), before)
            break
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        after = {r.doc_id: r.text for r in docs.collect()}
        if k == 0:
            assert after.items() <= before.items() and len(after) > 0.8 * len(before)
        elif k == 1:
            assert after == dedup_lines(before, 20)
        elif k == 2:
            assert after == {i: before[i] for i, _, c in components(before) if i == c}
        else:
            leaks = {i for i, t in before.items() for q in items if q and 100 * len(q & word_shingles(t or "", 5)) >= 80 * len(q)}
            assert after == {i: t for i, t in before.items() if i not in leaks}


def test_rows_with_nulls_and_repeated_ids(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(40))
    item = " ".join(f"q{i}" for i in range(12))
    toxic, plain = "zork qued " * 30, "fine words here and there"
    rows = [(1, words), (1, words + " x"), (1, words), (2, words + " y"), (None, item + " lead"), (None, None), (3, item), (3, plain), (4, ""), (4, "")]
    rows += [(100 + i, (toxic if i % 2 else " ".join(f"t{i}{k}" for k in range(20))) + f" e{i}") for i in range(120)]
    rows += [(5, toxic + "e5"), (5, "an innocent namesake of it")]
    docs = spark.createDataFrame([(i, t, None, None, None, "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, doc_key string")
    spark.createDataFrame([(100 + i, i % 2, i % 2) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = cp.reject_toxic(spark, docs, str(tmp_path))
    have = [(r.doc_id, r.text) for r in kept.collect()]
    assert (5, "an innocent namesake of it") in have and (5, toxic + "e5") not in have and kept.columns == docs.columns
    near = cp.keep_one_of_near_copies(spark, docs.filter("doc_id < 5 or doc_id is null"), str(tmp_path))
    have = sorted([(r.doc_id or 0, r.text or "") for r in near.collect()])
    assert len([t for _, t in have if t.startswith("w0")]) == 1
    assert len(have) == 6 and have.count((4, "")) == 2  # (3, item) is a near copy of the row before
    clean = cp.reject_benchmark(spark, docs, str(tmp_path))
    have = [(r.doc_id, r.text) for r in clean.collect()]
    assert (3, plain) in have and (3, item) not in have and (None, None) in have and (None, item + " lead") not in have
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
