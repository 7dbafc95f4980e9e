"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order tree of byte contexts, up to ``ORDER`` bytes,
counted on its training texts and then frozen. A context predicts each byte it
has seen by its count; the rest of the probability is the escape (method C: as
many counts as distinct bytes seen), shared among the other bytes as the next
shorter context predicts them, without those already excluded. The code length
of a text is the sum of -log2 of its bytes' predictions, exactly; the language
with the shortest code is predicted.

The trees are kept sparse: of each language the bytes that its contexts have seen,
with the bits of the prediction, and for each context the bits of its escape; about
half a megabyte a language. With frozen statistics a prediction depends on the
context and the byte alone, so texts are scored by their distinct grams, each
looked up once a language.

Before counting and scoring, A-Z are lowered, digits become ``0`` and ASCII
white space becomes a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of, written

ORDER = 3
#: Texts of each language, about, that the trees are counted on.
TRAIN_TEXTS = 1500
#: A context joins the tree when seen so often.
SEEN = 3
#: Languages up to which their sampling rates are broadcast.
MOST_BROADCAST = 100_000
UNKNOWN = "und"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if b in b" \t\n\x0b\x0c\r" else b for b in range(256))
_PAD = b" " * ORDER
#: Bytes scored at once.
CHUNK = 1 << 20


def folded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD)


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, each text after a pad, and the texts' starts and ends."""
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes + ORDER)
    return np.frombuffer(b"".join(y for x in texts for y in (_PAD, x)), np.uint8), ends - sizes, ends


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of ``ORDER`` + 1 bytes, as big-endian numbers, and their counts."""
    raw, starts, ends = _laid_out(texts)
    grams = np.zeros(max(0, len(raw) - ORDER), np.uint32)
    for k in range(ORDER + 1):
        grams = grams << np.uint32(8) | raw[k : len(raw) - ORDER + k]
    inside = np.zeros(len(raw) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    return np.unique(grams[np.cumsum(inside[:-1])[ORDER:] > 0], return_counts=True)


@dataclass
class Tree:
    """One language's frozen contexts of each order, from 0 to ``ORDER``, as sorted big-endian numbers."""

    grams: list[np.ndarray]  # context and byte that it has seen
    gram_bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escape_bits: list[np.ndarray]  # what an unseen byte costs before the next shorter context predicts it

    def bits(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Code lengths of the last byte of each gram of ``order`` + 1 bytes after those before it."""
        out = np.zeros(len(grams))
        left, keys = np.arange(len(grams)), grams.astype(np.uint64)
        for k in range(order, -1, -1):
            own = keys & np.uint64((1 << 8 * (k + 1)) - 1)
            at, there = _sought(self.grams[k], own)
            out[left[there]] += self.gram_bits[k][at[there]]
            left, keys, own = left[~there], keys[~there], own[~there]
            at, there = _sought(self.contexts[k], own >> np.uint64(8))
            out[left[there]] += self.escape_bits[k][at[there]]
        out[left] += 8.0
        return out


def _sought(numbers: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted numbers among sorted ones, and whether they are there."""
    if not len(numbers):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(numbers, wanted), len(numbers) - 1)
    return at, numbers[at] == wanted


@dataclass
class Trees:
    """The frozen trees of all languages."""

    languages: list[str]
    trees: list[Tree]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        raw, starts, ends = _laid_out(texts)
        for begin in range(0, len(raw), CHUNK):
            stop = min(begin + CHUNK, len(raw))
            some = raw[max(0, begin - ORDER) : stop].astype(np.uint32)
            if len(some) <= ORDER:
                continue
            first = max(begin, ORDER)
            grams = np.zeros(len(some) - ORDER, np.uint32)
            for k in range(ORDER + 1):
                grams = grams << np.uint32(8) | some[k : len(some) - ORDER + k]
            distinct, back = np.unique(grams, return_inverse=True)
            lo, hi = np.searchsorted(ends, first, "right"), np.searchsorted(starts, stop, "left")
            a, b = np.clip(starts[lo:hi], first, stop) - first, np.clip(ends[lo:hi], first, stop) - first
            real = np.flatnonzero(b > a)
            if not len(real):
                continue
            marks = np.column_stack([a[real], b[real]]).ravel()
            for i, tree in enumerate(self.trees):
                bits = np.append(tree.bits(distinct)[back], 0.0)
                out[lo + real, i] += np.add.reduceat(bits, marks)[::2]
        return out

    @property
    def symbol(self) -> np.ndarray:
        """Byte -> symbol of the spread-out table; the last symbol stands for every byte that no language has seen."""
        used = np.unique(np.concatenate([[32], *(t.grams[0] for t in self.trees)])).astype(np.int64)
        out = np.full(256, len(used), np.int16)
        out[used] = np.arange(len(used))
        return out

    @property
    def bits(self) -> np.ndarray:
        """(context and symbol, language) of all contexts, for a look at small trees; scoring doesn't need it."""
        symbol = self.symbol
        a = int(symbol.max()) + 1
        byte = np.array([np.flatnonzero(symbol == k)[0] if (symbol == k).any() else 0 for k in range(a)], np.uint64)
        rows = []
        for order in range(ORDER + 1):
            contexts = np.unique(np.concatenate([t.contexts[order] for t in self.trees])).astype(np.uint64)
            grams = (contexts[:, None] << np.uint64(8) | byte[None, :]).ravel()
            rows.append(np.column_stack([t.bits(grams, order) for t in self.trees]))
        return np.concatenate(rows)


def build_tree(grams: np.ndarray, counts: np.ndarray, seen: int = SEEN) -> Tree:
    """A language's tree from its grams of ``ORDER`` + 1 bytes and their counts."""
    tree = Tree([], [], [], [])
    shares: list[np.ndarray] = []
    for order in range(ORDER + 1):
        own, back = np.unique(grams.astype(np.uint64) & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
        m = np.bincount(back, counts, minlength=len(own))
        contexts, row = np.unique(own >> np.uint64(8), return_inverse=True)
        n = np.bincount(row, m, minlength=len(contexts))
        kept = n >= (seen if order else 1)
        own, m, row = own[kept[row]], m[kept[row]], (np.cumsum(kept) - 1)[row[kept[row]]]
        contexts, n = contexts[kept], n[kept]
        q = np.bincount(row, minlength=len(contexts)).astype(float)
        # What the shorter contexts give to the bytes that this one hasn't seen.
        below = 2.0 ** -tree_bits(tree, own, order - 1)
        left = np.maximum(1 - np.bincount(row, below, minlength=len(contexts)), 0)
        left = np.where((q < 256) & (left > 1e-12), left, 0)
        escapes = np.where(left > 0, q, 0)
        p = m / (n + escapes)[row]
        tree.grams.append(own)
        tree.gram_bits.append(-np.log2(p))
        tree.contexts.append(contexts)
        tree.escape_bits.append(np.where(left > 0, -np.log2(np.maximum(q / (n + q), 1e-300) / np.where(left > 0, left, 1)), 40.0))
    return tree


def tree_bits(tree: Tree, grams: np.ndarray, order: int) -> np.ndarray:
    """Bits of the last bytes by the contexts up to ``order``, of which -1 is every byte alike."""
    return tree.bits(grams & np.uint64((1 << 8 * (order + 1)) - 1), order) if order >= 0 else np.full(len(grams), 8.0)


def build_trees(counts: dict[str, tuple[np.ndarray, np.ndarray]], seen: int = SEEN) -> Trees:
    """Trees from each language's grams and counts."""
    languages = sorted(counts)
    return Trees(languages, [build_tree(*counts[k], seen) for k in languages])


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def train_trees(documents: DataFrame, id_col: str = "doc_id", train_texts: int = TRAIN_TEXTS) -> Trees | None:
    """Trees of all languages that training rows name, or None if there are none.

    Training rows have a text and a language and aren't held out. Of each
    language about ``train_texts`` whole texts are taken, by a hash of the id, so
    the grams that reach the driver are bounded by that parameter and the number
    of languages, half a megabyte each: 50 MB for 100.
    """
    rows = documents.filter(~held_out(id_col) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.col(id_col).cast("string").alias("id"))
    rates = written(rows.groupBy("lang").agg((F.lit(float(train_texts)) / F.count("*")).alias("rate")), "rates")
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    known = F.broadcast(rates) if rates.count() <= MOST_BROADCAST else rates
    sample = rows.join(known, "lang").filter(place < F.col("rate")).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = (batch.column(i).to_pylist() for i in range(2))
            for lang in dict.fromkeys(langs):
                grams, n = gram_counts([folded(t) for k, t in zip(langs, texts, strict=True) if k == lang])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    grams = sample.mapInArrow(lean(counted), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found: dict[str, tuple[list[int], list[int]]] = {}
    for lang, gram, n in grams.toLocalIterator():
        own = found.setdefault(lang, ([], []))
        own[0].append(gram)
        own[1].append(n)
    return build_trees({k: (np.array(g, np.uint32), np.array(n, np.int64)) for k, (g, n) in found.items()}) if found else None


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def identify_language(documents: DataFrame, id_col: str = "doc_id", train_texts: int = TRAIN_TEXTS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document row.

    ``score`` is the posterior of the predicted language under equal priors.
    Texts that are null or have no letter get ``und`` and 0, and so does every
    text when no training row names a language. Ties go to the language that
    sorts first. Repeated rows are predicted each; only the id, the text and (for
    training rows) the language are read.
    """
    trees = train_trees(documents, id_col, train_texts)
    held = documents.sparkSession.sparkContext.broadcast(trees)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = held.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            some = [i for i, x in enumerate(texts) if trees is not None and has_letter(x)]
            start, size = 0, 0
            for j, i in enumerate(some):
                size += len(texts[i])
                if size >= CHUNK or j == len(some) - 1:
                    own = some[start : j + 1]
                    bits = trees.code_lengths([folded(texts[x]) for x in own])
                    best = bits.argmin(1)
                    odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000))
                    scores[own] = 1 / odds.sum(1)
                    for x, b in zip(own, best.tolist(), strict=True):
                        langs[x] = trees.languages[b]
                    start, size = j + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    read = text_of(documents, F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"))
    return read.mapInArrow(lean(predicted), "doc_id long, held_out boolean, lang_pred string, score double")
