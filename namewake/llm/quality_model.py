"""Operator 3: quality classifier from weak labels.

*Labellers.* Heuristics vote good, bad or nothing on each document: symbols, capitals,
repetition, repeated lines, length, function words, variety, line ends, plain words. They
overlap and err.

*Expectation-maximisation.* Each labeller has unknown rates of voting for good and for bad
documents. Documents with the same votes are alike here, so the votes of all documents are
counted by pattern (at most ``3 ** 9`` of them, however many documents), and EM over the
patterns finds the rates, the share of good documents, and each pattern's posterior.

*Scorer.* Posteriors are soft labels for a linear model over hashed features (shapes of
words, binned figures, frequent words), which judges documents where most labellers are
silent too. It is fitted to a sample of at most ``TRAIN_ROWS`` documents, by hash of the
text. All documents are scored where they lie.

Marked labels are never used; tests hold the result against them.

Defined results: null and empty texts get a score like others, from the features of an
empty text. Repeated rows come back as often as they occur. Without documents the result is
empty. Null ids are kept. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import (
    U64, Batches, by_text, find_words, hash_words, lists, lower_ascii, map_arrow, pieces, save,
    ship, strings, text_bytes,
)
from namewake.llm.quality_rules import word_stats

TRAIN_ROWS, EM_ROUNDS, DIMENSIONS, EPOCHS = 20_000, 100, 1 << 14, 12

#: Function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that for it as was with be by on are this from or an at a not have "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de des du et en un une que est pour qui dans par sur au plus pas "
    "el los las de que y en un una por con no para es se del al lo como más su"
).split()
FIGURES = ("symbols", "capitals", "repeated", "lines_again", "words", "function", "variety", "line_ends", "plain")
#: For each figure: (bad, good) limits. Rising figures are bad above the first and good below
#: the second; falling ones bad below and good above.
RISING = {"symbols": (0.2, 0.03), "capitals": (0.5, 0.2), "repeated": (0.3, 0.1), "lines_again": (0.3, 0.02)}
FALLING = {"words": (1, 40), "function": (0.06, 0.15), "variety": (0.15, 0.35), "line_ends": (0.2, 0.6), "plain": (0.5, 0.8)}
#: Shares that say nothing about a text of fewer words than this.
SHARES, MIN_WORDS = ("repeated", "function", "variety", "line_ends"), 20

_END = re.compile(r"[.!?…:;\"”»)]$")


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word's shape (runs of letters, capitals, digits, marks), and plainness."""
    kind = np.full(256, 5, np.uint8)
    kind[97:123] = 1
    kind[128:] = 1
    kind[65:91] = 2
    kind[48:58] = 3
    kind[list(b".,;:?")] = 4
    cls = kind[data]
    if not len(starts):
        return np.empty(0, U64), np.empty(0, bool)
    new = np.ones(len(cls), bool)
    new[1:] = cls[1:] != cls[:-1]
    new[starts] = True
    place = np.zeros(len(cls) + 1, np.int64)
    np.cumsum(new, out=place[1:])
    shapes = hash_words(cls[new], place[starts], place[ends])
    odd = np.zeros(len(cls) + 1, np.int64)
    np.cumsum((cls == 3) | (cls == 5), out=odd[1:])
    return shapes, odd[ends] == odd[starts]


def figures(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The figures of every text, and its hashed features with their values."""
    data, offs = text_bytes(texts)
    starts, ends, first = find_words(data, offs)
    low = lower_ascii(data)
    hashes = hash_words(low, starts, ends)
    shapes, plain = _shapes(data, starts, ends)
    stats = word_stats(texts)
    n = np.maximum(stats["n_words"], 1)
    upper = by_text((data >= 65) & (data < 91), offs)
    lower = by_text((data >= 97) & (data < 123), offs)
    marks = stats["n_symbols"] + by_text(data == ord("!"), offs)
    common = np.isin(hashes, _function_hashes())
    x = np.zeros((len(texts), len(FIGURES)))
    x[:, 0] = marks / n
    x[:, 1] = upper / np.maximum(1, upper + lower)
    x[:, 2] = stats["n_repeat_words"] / n
    x[:, 4] = stats["n_words"]
    x[:, 5] = by_text(common, first) / n
    x[:, 8] = by_text(plain, first) / n
    where, values = [], []
    for i, text in enumerate(strings(texts)):
        lines = [s for line in text.split("\n") if (s := line.strip())]
        x[i, 3] = 1 - len(set(lines)) / len(lines) if lines else 0
        x[i, 7] = sum(bool(_END.search(s)) for s in lines) / max(1, len(lines))
        a, b = first[i], first[i + 1]
        x[i, 6] = len(np.unique(hashes[a:b])) / np.sqrt(n[i]) / 10 if b > a else 0
        shape, count = np.unique(shapes[a:b], return_counts=True)
        seen = np.unique(hashes[a:b][common[a:b]])
        bins = np.floor(np.clip(np.log1p(np.abs(x[i]) * [20, 20, 20, 20, 1, 20, 20, 20, 20]) * 2, 0, 31)).astype(np.int64)
        where.append(np.concatenate([
            (shape % U64(DIMENSIONS - 512)).astype(np.int64) + 512,
            (seen % U64(DIMENSIONS - 512)).astype(np.int64) + 512,
            np.arange(len(FIGURES)) * 32 + bins,
        ]))
        values.append(np.concatenate([np.sqrt(count / n[i]), np.full(len(seen), 0.1), np.ones(len(FIGURES))]))
    return x, where, values


_known: dict[str, np.ndarray] = {}


def _function_hashes() -> np.ndarray:
    if "f" not in _known:
        words = pa.array(sorted({w for w in FUNCTION_WORDS}))
        data, offs = text_bytes(words)
        _known["f"] = hash_words(data, *find_words(data, offs)[:2])
    return _known["f"]


def votes(x: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, 2 nothing; a row for each document."""
    out = np.full(x.shape, 2, np.int8)
    for j, name in enumerate(FIGURES):
        bad, good = (RISING | FALLING)[name]
        if name in RISING:
            out[x[:, j] > bad, j], out[x[:, j] < good, j] = 0, 1
        else:
            out[x[:, j] < bad, j], out[x[:, j] > good, j] = 0, 1
        if name in SHARES:
            out[x[:, FIGURES.index("words")] < MIN_WORDS, j] = 2
    return out


def expectation_maximisation(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS
) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each pattern; rates[class, labeller, vote]; the share of good.

    A labeller's silence tells nothing: short texts, on which many are silent, aren't bad.
    """
    good = ((patterns == 1).sum(axis=1) + 1) / ((patterns != 2).sum(axis=1) + 2)
    rates, share = np.zeros((2, patterns.shape[1], 2)), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        for v in range(2):
            rates[:, :, v] = weight @ (patterns == v) + 0.5
        rates /= rates.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        said = np.log(rates)[:, np.arange(patterns.shape[1]), np.minimum(patterns, 1)]
        told = np.where(patterns == 2, 0.0, said).sum(axis=2)
        odds = np.log(share / (1 - share)) + told[1] - told[0]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return good, rates, share


def train(where: list[np.ndarray], values: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Weights of a hashed linear model, bias last, by adaptive gradient steps on soft labels."""
    w, scale = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-8)
    if not len(y):
        return w
    for epoch in range(EPOCHS):
        order = np.random.Generator(np.random.PCG64(epoch)).permutation(len(y))
        for lot in np.array_split(order, max(1, len(y) // 64)):
            at = np.concatenate([np.r_[where[i], DIMENSIONS] for i in lot])
            v = np.concatenate([np.r_[values[i], 1.0] for i in lot])
            row = np.repeat(np.arange(len(lot)), [len(where[i]) + 1 for i in lot])
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[at] * v, len(lot)), -30, 30)))
            grad = np.bincount(at, (p - y[lot])[row] * v, DIMENSIONS + 1) / len(lot) + 1e-5 * w
            scale += grad**2
            w -= 0.2 * grad / np.sqrt(scale)
    return w


def _votes(batches: Batches) -> Batches:
    for batch in batches:
        texts = batch.column(0)
        for lo, hi in pieces(texts):
            x, _, _ = figures(texts.slice(lo, hi - lo))
            codes = votes(x).astype(np.int64) @ (3 ** np.arange(len(FIGURES)))
            seen, counts = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), pa.array(counts, pa.int64())], names=["pattern", "n"]
            )


def _examples(batches: Batches) -> Batches:
    for batch in batches:
        hashes, texts = batch.columns
        for lo, hi in pieces(texts):
            x, where, values = figures(texts.slice(lo, hi - lo))
            codes = votes(x).astype(np.int64) @ (3 ** np.arange(len(FIGURES)))
            yield pa.RecordBatch.from_arrays(
                [hashes.slice(lo, hi - lo), pa.array(codes, pa.int32()), lists(where, pa.int32()), lists(values, pa.float64())],
                names=["h", "pattern", "at", "v"],
            )


def _score(weights: np.ndarray, posteriors: dict[int, float]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, texts = batch.columns
            for lo, hi in pieces(texts):
                x, where, values = figures(texts.slice(lo, hi - lo))
                codes = (votes(x).astype(np.int64) @ (3 ** np.arange(len(FIGURES)))).tolist()
                z = np.array([weights[a] @ v + weights[-1] for a, v in zip(where, values)])
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array([posteriors[c] for c in codes]), pa.array(score),
                     pa.array((score >= 0.5).astype(np.int32)), pa.array(score >= 0.5)],
                    names=["doc_id", "weak_label", "score", "predicted", "kept"],
                )

    return run


def training_texts(docs: DataFrame, train_rows: int) -> DataFrame:
    """(h, text) of the ``train_rows`` distinct texts of smallest hash, however often each occurs."""
    h = F.xxhash64("text").alias("h")
    last = docs.select(h).distinct().orderBy("h").limit(train_rows).agg(F.max("h")).first()[0]
    return docs.select(h, "text").filter(F.col("h") <= F.lit(last)).dropDuplicates(["h"])


def score(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, weak_label (posterior), score, predicted and kept for every row of ``docs``."""
    ship(docs.sparkSession)
    counted = map_arrow(docs.select("text"), _votes, "pattern int, n bigint")
    rows = counted.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in rows], np.int64)
    patterns = (codes[:, None] // 3 ** np.arange(len(FIGURES))) % 3
    good, _, _ = expectation_maximisation(patterns, np.array([r["n"] for r in rows], float))
    posteriors = dict(zip(codes.tolist(), good.tolist()))
    sample = training_texts(docs, train_rows)
    found = map_arrow(sample, _examples, "h bigint, pattern int, at array<int>, v array<double>").toArrow()
    found = found.sort_by("h")  # at most train_rows rows
    weights = train(
        [a.values.to_numpy() for a in found["at"]], [v.values.to_numpy() for v in found["v"]],
        np.array([posteriors[c] for c in found["pattern"].to_pylist()]),
    )
    return map_arrow(docs.select("doc_id", "text"), _score(weights, posteriors),
                     "doc_id bigint, weak_label double, score double, predicted int, kept boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
