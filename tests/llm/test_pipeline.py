import random
import re

import corpus_pipeline
from riskspark.llm.common import written


def test_stages_on_a_small_corpus(spark, tmp_path):
    item = "one two three four five six seven eight nine ten eleven"
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(1, 9)))
    noise = lambda: r.choice(["", f" Note {word()}={word()}{r.randint(1, 10**9)} end.", f" {item.upper()[:30]}, 12."])
    prose = [" ".join(word() for _ in range(r.randint(25, 90))).capitalize() + "." + (f" password=Abcdefgh{i}x{i * 7919} end." if i % 5 == 0 else noise()) for i in range(60)]
    junk = [" ".join("#$%&"[j % 4] * 3 + "AB" for j in range(40 + i)) for i in range(30)]
    texts = prose + junk + [prose[0], prose[1] + f" and then {item} too."]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(i, int(i < 60), 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "stage")
        kept[name] = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "secrets":
            assert not [r for r in docs.collect() if re.search("Abcdefgh", r.text)] and all(r.n_chars == len(r.text) for r in docs.collect())
    assert kept["quality classifier"] == set(range(60)) | {90, 91}
    assert kept["near-duplicates"] == kept["quality classifier"] - {90} and kept["decontamination"] == kept["near-duplicates"] - {91}
    assert kept["packing"] == kept["secrets"] == kept["decontamination"]
