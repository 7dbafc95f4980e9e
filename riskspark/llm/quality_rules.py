"""Quality rules as weak supervision: votes, estimated accuracies, posteriors.

Every rule votes good, votes bad or abstains. The rules' accuracies are unknown;
expectation-maximisation estimates, for each rule, how often it casts each vote
on good and on bad documents, and how many documents are good. A document's
posterior probability of being good then takes the place of "passes all rules".

Only DataFrame functions touch rows. Documents with equal votes are alike to the
model, so EM runs on the counts of the vote patterns, of which there are at most
3 to the number of rules.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, text_of, written

#: Words of a window in which repeats count.
WINDOW = 8
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: A word that ends in a symbol, and a word of letters with at most one mark after it.
SYMBOL_ENDS = r"[#*$%&|<>](?=[\x20\x09-\x0D]|$)"
PLAIN_WORD = r"(?<![^\x20\x09-\x0D])\p{L}+[.,;:?!]?(?![^\x20\x09-\x0D])"
GOOD, BAD, ABSTAIN = 1, 0, 2


def with_word_counts(df: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rules' own counts of the whole ``text``."""
    text = F.col("text")
    df = df.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    df = df.withColumn("lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).withColumn("joined", F.array_join("words", ""))
    # Each word is hashed once, and a window's hash is that of its words' hashes.
    hashed = F.when(F.size("words") >= WINDOW, F.transform("words", lambda w: F.xxhash64(w)))
    windows = bound(hashed, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    df = df.withColumn("windows", F.coalesce(windows, F.expr("cast(array() as array<bigint>)")))
    return df.select(
        *[c for c in df.columns if c not in ("text", "words", "lines", "joined", "windows")],
        F.size("words").cast("long").alias("n_words"),
        F.char_length("joined").cast("long").alias("word_chars"),
        F.regexp_count("joined", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _covered(F.col("windows"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.regexp_count("joined", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("joined", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count("joined", F.lit("!")).cast("long").alias("n_exclaims"),
        F.regexp_count("text", F.lit(SYMBOL_ENDS)).cast("long").alias("n_symbol_ends"),
        F.regexp_count("text", F.lit(PLAIN_WORD)).cast("long").alias("n_plain_words"),
    )


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more, in one sort of the windows and one of the repeated places."""

    def of_sorted(s: Column) -> Column:
        def place(i: Column) -> Column:
            same = (F.get(s, i)["h"] == F.get(s, i - 1)["h"]) | (F.get(s, i)["h"] == F.get(s, i + 1)["h"])
            return F.when(same, F.get(s, i)["i"])

        return F.array_sort(F.array_compact(F.transform(F.sequence(F.lit(0), F.size(s) - 1), place)))

    def of_places(p: Column) -> Column:
        # Each repeated window covers its words up to the next one's start.
        steps = F.transform(F.sequence(F.lit(0), F.size(p) - 1), lambda j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - F.get(p, j), F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # A one-element array binds a value, so that it is computed once.
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.transform(F.array(ordered), of_sorted)
    return F.get(F.transform(places, of_places), F.lit(0))


def votes() -> dict[str, Column]:
    """The rules' votes on the counts of ``with_word_counts``."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))

    def low_is_good(x: Column, good: float, bad: float) -> Column:
        return F.when(x <= good, GOOD).when(x > bad, BAD).otherwise(ABSTAIN)

    length = F.col("word_chars") / words
    distinct = F.col("n_distinct_words") / words
    return {
        "symbols": low_is_good(F.col("n_symbols") / chars, 0.02, 0.06),
        "symbol_ends": low_is_good(F.col("n_symbol_ends") / words, 0.02, 0.15),
        "plain_words": F.when(F.col("n_plain_words") >= 0.85 * words, GOOD).when(F.col("n_plain_words") < 0.60 * words, BAD).otherwise(ABSTAIN),
        "upper": low_is_good(F.col("n_upper") / chars, 0.10, 0.40),
        "digits": low_is_good(F.col("n_digits") / chars, 0.10, 0.35),
        "exclaims": low_is_good(F.col("n_exclaims") / words, 0.02, 0.30),
        "word_length": F.when(length.between(3.0, 12.0), GOOD).when((length < 2.0) | (length > 20.0), BAD).otherwise(ABSTAIN),
        "repeats": F.when(F.col("n_words") < WINDOW, ABSTAIN).otherwise(low_is_good(F.col("n_repeat_words") / words, 0.05, 0.30)),
        "lines": F.when(F.col("n_lines") < 3, ABSTAIN).otherwise(low_is_good(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.05, 0.50)),
        "variety": F.when(F.col("n_words") < 20, ABSTAIN).when(distinct < 0.15, F.when(F.col("n_words") < 2000, BAD).otherwise(ABSTAIN)).when(distinct > 0.30, GOOD).otherwise(ABSTAIN),
    }


def fit_votes(counts: list[tuple[tuple[int, ...], int]], rules: int = 0, rounds: int = 200, smooth: float = 1.0) -> tuple[float, list[list[list[float]]]]:
    """EM over vote patterns: the share of good documents and ``P(vote | rule, class)``.

    Starts from the share of good among each pattern's votes. The model alone
    can't tell which class is the good one; it is the one to which the rules' votes
    say good more often than to the other, all rules together, so classes that
    have changed places are put back. A table without rows, or votes, leaves the
    start's even odds.
    """
    if not counts:
        return 0.5, [[[1 / 3] * 3] * 2 for _ in range(rules)]
    patterns, n = np.array([p for p, _ in counts]), np.array([k for _, k in counts], float)
    cast = np.stack([patterns == v for v in range(3)], axis=2).astype(float)  # pattern, rule, vote
    votes_good, votes_bad = cast[:, :, GOOD].sum(1), cast[:, :, BAD].sum(1)
    # A lone bad vote is weighed as half the document: rules are made to vote bad rarely.
    good = (votes_good + 0.5) / (votes_good + votes_bad + 1.0) * 0.5**votes_bad
    prior = 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - good) * n, good * n])
        old, prior = prior, (weight[1].sum() + smooth) / (n.sum() + 2 * smooth)
        table = np.einsum("cp,prv->rcv", weight, cast) + smooth
        table /= table.sum(2, keepdims=True)
        log_odds = np.log(prior / (1 - prior)) + np.einsum("prv,rv->p", cast, np.log(table[:, 1] / table[:, 0]))
        good = 1 / (1 + np.exp(-np.clip(log_odds, -700, 700)))
        if abs(prior - old) < 1e-9:
            break
    said = np.log(table[:, 1] / table[:, 0])
    if (said[:, GOOD] - said[:, BAD]).sum() < 0:
        prior, table = 1 - prior, table[:, ::-1]
    return float(prior), table.tolist()


def posterior(pattern: tuple[int, ...], prior: float, table: list[list[list[float]]]) -> float:
    log_odds = math.log(prior / (1 - prior)) + sum(math.log(t[1][v] / t[0][v]) for t, v in zip(table, pattern, strict=True))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, log_odds))))


def posterior_column(prior: float, table: list[list[list[float]]], names: list[str]) -> Column:
    """The posterior as an expression of the vote columns ``names``."""
    log_odds = F.lit(math.log(prior / (1 - prior)))
    for name, t in zip(names, table, strict=True):
        log_odds = log_odds + F.get(F.array(*[F.lit(math.log(t[1][v] / t[0][v])) for v in range(3)]), F.col(name))
    return 1 / (1 + F.exp(-log_odds))


def judge_quality(documents: DataFrame, id_col: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """Per document: the base counts, base_failed, kept, the votes and the posterior.

    Null and empty texts have no words, so they fail the base rules; repeated
    rows are judged each; an empty table gives no rows. Only the id and the text
    are read. ``kept`` needs the base rules and a posterior of ``threshold``.

    One pass over the texts; the counts, a few numbers a document, are written
    and read twice: for the pattern counts and for the result.
    """
    counted = with_word_counts(text_of(documents, F.col(id_col).cast("long").alias("doc_id")))
    rules = votes()
    names = [f"vote_{x}" for x in rules]
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = written(counted.select(*base, *[v.alias(n) for n, v in zip(names, rules.values(), strict=True)]), "votes")
    patterns = judged.groupBy(*names).count().collect()
    prior, table = fit_votes([(tuple(r[n] for n in names), r["count"]) for r in patterns], len(names))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = judged.select(*base, failed.alias("base_failed"), *names, posterior_column(prior, table, names).alias("p_good"))
    return scored.select(*base, "base_failed", (~F.col("base_failed") & (F.col("p_good") >= threshold)).alias("kept"), "p_good", *names)
