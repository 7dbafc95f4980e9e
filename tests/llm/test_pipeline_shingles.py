import corpus_pipeline
from riskspark.llm.near_duplicates import near_duplicates


def test_stage_measures_five_words(spark):
    """Three edits of 100 words: 98 of 122 four-word sets are shared (0.80), 94 of 124 five-word ones (0.76)."""
    words = [f"w{i}" for i in range(113)]
    other = list(words)
    for at in (30, 60, 90):
        other[at] = f"x{at}"
    df = spark.createDataFrame([(1, " ".join(words), "en", "s", 1), (2, " ".join(other), "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert near_duplicates(df).filter("kept").count() == 1
    assert corpus_pipeline.one_of_each_group(spark, df, "").count() == 2
