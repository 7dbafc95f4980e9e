"""Secret scans: patterns, and two character Markov models.

The base patterns find keys by their form. The method finds the rest: each run
of key characters outside the base matches is scored by two character Markov
models of order one, one of random strings and one of ordinary identifiers, and
is a secret when the log-likelihood ratio reaches a threshold per character and
another for the whole run.

Both models are trained on labelled samples. Some are made by rule, random keys
on one side and dates, versions, paths, numbers and the like on the other. The
rest comes from the table itself with weak labels: what the base patterns
matched counts as random, though some of it isn't, and short runs of key
characters as ordinary.

Only DataFrame functions touch rows. Places come from splitting a text at the
matches: the lengths of the pieces and the matches add up to offsets.
"""

from __future__ import annotations

import math
import random
import uuid
from collections import Counter
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, places, replaced, running_greatest, text_of, written

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
#: Runs that the models judge; those of less than MIXED characters need a digit, longer ones that or letters of both cases.
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
MIXED = 20
#: A run of this form is an identifier, whatever its characters.
IDENTIFIER = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
#: Short runs of key characters, which train the ordinary model.
SHORT = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{3,15}(?![A-Za-z0-9+/_.=-])"
#: The models' alphabet; any other character is its last class.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
CLASSES = len(ALPHABET) + 1
#: Log-likelihood ratio, per character, from which a run is a secret.
THRESHOLD = 0.5
#: Log-likelihood ratio of the whole run that it takes besides.
EVIDENCE = 10.0
#: Rows that the ordinary model is trained on, about.
TRAIN_ROWS = 20_000
#: Fixed order of kinds at equal places.
KINDS = ("assign", "access", "hex", "markov")


def _spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """array<struct<start, rank, end, kind, found>> of the kept matches, empty where there are none."""
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string,found:string>>)")
    found = places(text, pattern)
    found = F.filter(found, keep) if keep else found
    shaped = F.transform(found, lambda x: F.struct(x["start"], F.lit(KINDS.index(kind)).alias("rank"), x["end"], F.lit(kind).alias("kind"), x["found"]))
    return F.when(text.rlike(pattern), shaped).otherwise(none)


def _judged(x: Column) -> Column:
    s = x["found"]
    mixed = (F.char_length(s) >= MIXED) & s.rlike("[a-z]") & s.rlike("[A-Z]")
    return (s.rlike("[0-9]") | mixed) & ~s.rlike(IDENTIFIER)


def clear_of(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span, in order of start.

    Both stand in one array by start; the greatest end of base spans before a run
    and the least start of those behind it decide, so no run is held against all
    base spans.
    """
    side = lambda xs, n: F.transform(xs, lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("side"), x["end"].alias("end"), x.alias("x")))
    far = 1 << 30

    def judged(both: Column, until: Column, behind: Column) -> Column:
        free = lambda x, i: (x["side"] == 1) & (F.get(until, i) <= x["start"]) & (far - F.get(behind, F.size(both) - 1 - i) >= x["end"])
        return F.array_compact(F.transform(both, lambda x, i: F.when(free(x, i), x["x"])))

    def swept(both: Column) -> Column:
        ends = running_greatest(F.transform(both, lambda x: F.when(x["side"] == 0, x["end"]).otherwise(0)))
        starts = running_greatest(F.transform(F.reverse(both), lambda x: F.when(x["side"] == 0, far - x["start"]).otherwise(0)))
        return bound(ends, lambda until: bound(starts, lambda behind: judged(both, until, behind)))

    some = (F.size(base) > 0) & (F.size(runs) > 0)
    return F.when(some, bound(F.sort_array(F.concat(side(base, 0), side(runs, 1))), swept)).otherwise(runs)


def with_spans(texts: DataFrame, *keep: str) -> DataFrame:
    """``keep``, base and runs: the base spans, and the candidate runs that overlap none of them."""
    text = F.col("text")
    base = F.concat(
        _spans(text, "assign", ASSIGN, lambda x: F.char_length(F.regexp_extract(x["found"], ASSIGN, 2)) >= 8),
        _spans(text, "access", ACCESS, lambda x: F.char_length(x["found"]) >= 16),
        _spans(text, "hex", HEX),
    )
    runs = _spans(text, "markov", CANDIDATE, _judged)
    df = texts.select(*keep, F.array_sort(base).alias("base"), runs.alias("runs"))
    return df.select(*keep, "base", clear_of(F.col("base"), F.col("runs")).alias("runs"))


def labelled_samples(n: int = 2000, seed: int = 17) -> tuple[list[str], list[str]]:
    """(random keys, ordinary strings), made by rule."""
    r = random.Random(seed)
    kinds = [ALPHABET[:62], ALPHABET[:64], "0123456789abcdef", ALPHABET[26:62]]
    keys = ["".join(r.choice(kinds[i % len(kinds)]) for _ in range(r.randint(20, 64))) for i in range(n)]
    parts = "app bin build cache client config core data docs file home index item lib list local main model name node note page path report server share source src table temp test tools type user usr util var version view web".split()
    word, number = lambda: r.choice(parts), lambda: str(r.randint(0, 10 ** r.randint(1, 9)))
    day = lambda: f"{r.randint(1970, 2040)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}"
    made = [
        number, day, lambda: f"{day()}T{r.randint(0, 23):02}-{r.randint(0, 59):02}-{r.randint(0, 59):02}Z", lambda: "-".join(number() for _ in range(r.randint(2, 5))), lambda: ".".join(str(r.randint(0, 30)) for _ in range(3)),
        lambda: "/" + "/".join(word() + r.choice(["", "", str(r.randint(1, 20))]) for _ in range(r.randint(2, 6))), lambda: f"{word()}-{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 99)}", lambda: "_".join([word(), word(), number()]),
        lambda: f"{word()}{word().capitalize()}{r.randint(1, 99)}", lambda: f"{word()}-{day()}-{number()}", lambda: "=" * r.randint(5, 60), lambda: "-" * r.randint(5, 60), lambda: str(uuid.UUID(int=r.getrandbits(128))) if r.random() < 0.2 else f"id-{number()}",
    ]
    return keys, [made[i % len(made)]() for i in range(n)]


def _chars(s: Column) -> Column:
    """The characters of a string, in time linear in it."""
    return F.split(s, "")


def _bigrams(strings: DataFrame) -> Counter:
    """Counts of neighbouring characters in column ``s``, whose characters are of the alphabet."""
    pairs = bound(_chars(F.col("s")), lambda c: F.zip_with(c, F.slice(c, 2, F.size(c)), lambda a, b: F.concat(a, b)))
    counts = strings.filter(F.char_length("s") >= 2).select(F.explode(pairs).alias("ab")).filter("ab is not null").groupBy("ab").count()
    return Counter({(ALPHABET.find(r["ab"][0]) % CLASSES, ALPHABET.find(r["ab"][1]) % CLASSES): r["count"] for r in counts.collect()})


def sample_bigrams(strings: list[str]) -> Counter:
    return Counter((ALPHABET.find(a) % CLASSES, ALPHABET.find(b) % CLASSES) for s in strings for a, b in pairwise(s))


def log_ratios(random: Counter, ordinary: Counter, smooth: float = 0.5) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary), row by row."""

    def table(counts: Counter) -> list[float]:
        out = []
        for a in range(CLASSES):
            row = [counts.get((a, b), 0) + smooth for b in range(CLASSES)]
            out += [math.log(x / sum(row)) for x in row]
        return out

    return [x - y for x, y in zip(table(random), table(ordinary), strict=True)]


def train_ratios(spans: DataFrame, documents: DataFrame, id_col: str, train_rows: int = TRAIN_ROWS) -> list[float]:
    """The two models, from samples made by rule and from the table's own.

    Random: the values that the base patterns matched, from all rows, a weak
    label. Ordinary: the short runs of key characters, words among them, in about
    ``train_rows`` rows, taken by a hash of the id. What isn't in the table comes
    from the samples alone.
    """
    hit = F.explode("base")
    values = spans.filter(F.size("base") > 0).select(hit.alias("x")).select(F.when(F.col("x.kind") == "assign", F.regexp_extract("x.found", ASSIGN, 2)).otherwise(F.col("x.found")).alias("s"))
    rows = documents.count()
    share = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, train_rows / max(1, rows)))
    runs = text_of(documents.filter(share)).select(F.explode(F.regexp_extract_all("text", F.lit(SHORT), F.lit(0))).alias("s"))
    keys, strings = labelled_samples()
    return log_ratios(_bigrams(values) + sample_bigrams(keys), _bigrams(runs) + sample_bigrams(strings))


def markov_score(s: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio per character pair, in time linear in the string."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    classes = F.transform(_chars(s), lambda ch: F.pmod(F.instr(F.lit(ALPHABET), ch) - 1, F.lit(CLASSES)))
    steps = bound(classes, lambda c: F.zip_with(c, F.slice(c, 2, F.size(c)), lambda a, b: F.coalesce(F.get(table, a * CLASSES + b), F.lit(0.0))))
    return F.aggregate(steps, F.lit(0.0).cast("double"), lambda acc, x: acc + x) / (F.char_length(s) - 1)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _found(ratios: list[float], threshold: float) -> Column:
    """All spans, from the columns base and runs."""
    needed = lambda s: F.greatest(F.lit(threshold), EVIDENCE / (F.char_length(s) - 1))
    more = F.filter("runs", lambda r: markov_score(r["found"], ratios) >= needed(r["found"]))
    return F.when(F.size("runs") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", more)))


def find_secrets(documents: DataFrame, id_col: str = "doc_id", threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per document: n_assign, n_access, n_hex, base_sha256, spans, and ``found`` with all spans' places.

    Null and empty texts have no spans; repeated rows are scanned each; an empty
    table gives no rows. Only the id and the text are read.

    One pass over the texts writes the spans, which are few; the models and the
    result read those. The models are CLASSES x CLASSES numbers whatever the table.
    """
    spans = written(with_spans(text_of(documents, F.col(id_col).cast("long").alias("doc_id")), "doc_id"), "spans")
    ratios = train_ratios(spans, documents, id_col, train_rows)
    every = spans.select("doc_id", "base", _found(ratios, threshold).alias("found"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return every.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), F.col("found"))


def redact(documents: DataFrame, id_col: str = "doc_id", mark: str = "[SECRET]", threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``documents`` with each secret in its text replaced by ``mark``; rows and columns stay.

    Spans that overlap are replaced once, from the first start to the last end. A
    text without secrets, null included, stays as it is. One scan writes the rows
    with their spans, which the models and the replacement read; no shuffle of
    texts.
    """
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = written(with_spans(packed, "row"), "spans")
    ratios = train_ratios(rows.select("base"), documents, id_col, train_rows)
    spans = rows.select("row", F.coalesce(F.col("row.text"), F.lit("")).alias("text"), _found(ratios, threshold).alias("found"))

    text = F.when(F.size("found") > 0, replaced(F.col("text"), F.col("found"), mark)).otherwise(F.col("row.text"))
    return spans.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
