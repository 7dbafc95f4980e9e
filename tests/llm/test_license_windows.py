"""All matches of license templates against a direct search of every line and window."""

import random
import re
import time

from riskspark.llm import licenses

WORD = re.compile(licenses.WORD)


def direct(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    """Templates of which some line, or some window of as many words as a match may take, holds enough words."""
    words, found = WORD.findall(text.lower()), set()
    for k, (label, given) in enumerate(templates):
        tokens = set(licenses.template_words(given))
        need, width = licenses.needed_words(len(tokens), threshold), licenses.window_words(given, threshold)
        blocks = [set(WORD.findall(x)) for x in text.lower().split("\n")] + [set(words[i : i + width]) for i in range(len(words))]
        if any(len(tokens & b) >= need for b in blocks):
            found.add((k, label))
    return ",".join(f"{k}:{label}" for k, label in sorted(found))


def some_texts(n=120, seed=8):
    """Notices whole, with words lost, added, moved over lines and repeated, in filler that has template words too."""
    r = random.Random(seed)
    filler = ["the", "of", "license", "under", "and", "data", "lorem", "public", "apache", "released", "x"]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(r.randint(0, 5)):
            own = r.choice(licenses.TEMPLATES)[1].split()
            own = [w for w in own if r.random() > r.choice([0, 0.1, 0.3])]
            for _ in range(r.randint(0, 4)):
                own.insert(r.randrange(len(own) + 1), r.choice(filler))
            words += own * r.choice([1, 1, 1, 3]) + [r.choice(filler) for _ in range(r.choice([0, 2, 70]))]
        texts.append("".join(w + r.choice([" "] * 9 + ["\n", ", "]) for w in words))
    return texts


def test_every_match_is_found(spark):
    texts = some_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    want = {i: direct(t) for i, t in enumerate(texts)}
    assert {i: r.matches for i, r in got.items()} == want and sum(map(bool, want.values())) > 50
    for i, r in got.items():
        matched = {x.split(":")[1] for x in want[i].split(",") if x}
        labels = {x for x in r.labels.split(",") if x} - {x for x in r.base_labels.split(",") if x}
        assert labels <= matched and bool(matched) <= bool(r.labels) and (r.score >= licenses.THRESHOLD) == bool(r.labels)


def test_all_templates_that_a_line_reaches(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License."), (2, "released under the license")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.matches) for r in licenses.scan_licenses(df).collect()}
    number = {text: k for k, (_, text) in enumerate(licenses.TEMPLATES)}
    mit, bsd = number["released under the mit license"], number["released under the bsd license"]
    assert got[1][0] == "mit" and got[2][1] == f"{mit}:mit,{bsd}:bsd" and f"{bsd}:bsd" in got[1][1]


def test_other_templates_and_thresholds(spark):
    given = [("a", "one two three four five"), ("b", "three four five six seven"), ("c", "rare words only"), ("d", "!!")]
    texts = ["one two three four five six seven", "three x four y five z six", "five four three two one one one", "only rare\nwords", "", "one\ntwo\nthree\nfour"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    templates = spark.createDataFrame([*given, (None, "no label"), ("e", None)], "label string, text string")
    for threshold in (0.6, 0.8, 1.0):
        got = {r.doc_id: r.matches for r in licenses.scan_licenses(df, threshold=threshold, templates=templates).collect()}
        assert got == {i: direct(t, given[:3], threshold) for i, t in enumerate(texts)}


def test_a_notice_without_end(spark):
    """20,000 words of one notice, in a line and in 4,000 lines, take little more time than few do."""
    seconds = []
    for n in (5, 5, 4000):
        texts = [("released under the mit license " * n,), ("released under the mit license\n" * n,)]
        df = spark.createDataFrame(texts, "text string").selectExpr("1 AS doc_id", "text")
        began = time.perf_counter()
        assert {(r.labels, r.n_words) for r in licenses.scan_licenses(df).collect()} == {("mit", 5 * n)}
        seconds.append(time.perf_counter() - began)
    assert seconds[2] - seconds[1] < 20
