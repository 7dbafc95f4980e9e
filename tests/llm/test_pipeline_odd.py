import pytest

import corpus_pipeline


@pytest.fixture
def sf(spark, tmp_path, benchmark, labels):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_take_odd_and_empty_tables(spark, odd, empty, sf):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf)
        if name != "packing":
            assert out.columns == odd.columns
        if name == "secrets":
            assert out.count() == odd.count()
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in odd.collect()}
        assert stage(spark, empty, sf).count() == 0


def test_one_of_each_group_of_repeated_and_missing_ids(spark, sf):
    one, two, three = ("".join(f"{c}{i} " for i in range(40)) for c in "xyz")
    rows = [(3, one), (7, one), (7, two), (9, three), (9, three), (9, three + "and some more"), (None, three), (4, None), (5, None), (6, ""), (6, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1, 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, component long")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.one_of_each_group(spark, df, sf).collect()), key=str)
    assert kept == sorted([(3, one), (9, three), (None, three), (4, None), (5, None), (6, "")], key=str)
