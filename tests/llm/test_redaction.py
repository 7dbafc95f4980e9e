import random
import time

from pyspark.sql import functions as F

from riskspark.llm import common, secrets


def direct(text, spans, mark):
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_spans_of_any_place_and_length(spark):
    r = random.Random(6)
    rows = []
    for i in range(150):
        text = "".join(r.choice("abé日😀 \n") for _ in range(r.choice([0, 1, 5, 255, 256, 257, 512, 3000])))
        cuts = sorted(tuple(sorted((r.randint(0, len(text)), r.randint(0, len(text))))) for _ in range(r.choice([0, 1, 2, 40])))
        if i % 2:
            cuts = [(a, min(len(text), a + r.randint(0, 9))) for a, _ in cuts]
        rows.append((i, text, cuts))
    df = spark.createDataFrame(rows, "id int, text string, spans array<struct<start:int,end:int>>")
    got = {x.id: x.out for x in df.select("id", common.replaced(F.col("text"), F.col("spans"), "[*]").alias("out")).collect()}
    assert got == {i: direct(t, s, "[*]") for i, t, s in rows}


def test_runs_that_overlap_no_base_span(spark):
    r = random.Random(7)
    rows = []
    for i in range(80):
        spans = lambda n: sorted((a, a + r.randint(1, 9)) for a in r.sample(range(400), n))
        rows.append((i, spans(r.choice([0, 1, 5, 60])), spans(r.choice([0, 1, 5, 60]))))
    shape = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame(rows, f"id int, base {shape}, runs {shape}")
    got = {x.id: [tuple(y) for y in x.out] for x in df.select("id", secrets.clear_of(F.col("base"), F.col("runs")).alias("out")).collect()}
    assert got == {i: [x for x in runs if not any(a < x[1] and x[0] < b for a, b in base)] for i, base, runs in rows}


def test_many_secrets_in_one_text(spark):
    """24,000 assignments, which took over a minute while each span went through the text from its start."""
    n = 24_000
    df = spark.createDataFrame([(1, "".join(f"password=abcdefgh{i % 10} " for i in range(n)))], "doc_id long, text string")
    began = time.perf_counter()
    assert secrets.redact(df).first().text == "[SECRET] " * n
    assert time.perf_counter() - began < 60
