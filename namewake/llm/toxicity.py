"""Operator 4: toxicity by a fuzzy lexicon and the context of its hits.

*Lexicon.* Abusive words (``WORDS``, a parameter), and terms that labelled texts add: words
and word beginnings far more frequent in toxic texts than chance allows. All stand in one
trie. A Levenshtein automaton runs over it: a state is a set of (trie node, edits so far),
kept as one state of a lazily built deterministic automaton. So a word of a text costs one
look-up per letter, mostly ends after a few letters, and misspelled terms are caught within
0, 1 or 2 edits by length. Forms that clean labelled texts use are ordinary words, not
misspellings.

*Context.* Around a hit, quotation marks, words of reporting and of address decide whether
the term is quoted or aimed at somebody.

*Score.* A logistic function of the hits by kind, fitted to labelled texts. Texts without
hits, empty ones too, get the score of such texts.

Labels are learned from a sample of at most ``TRAIN_ROWS`` rows, by hash of the id; never
from rows held out (crc32(doc_id) mod 5 = 0). Terms are learned from counts over the sample:
the driver gets those that at least ``MIN_SUPPORT`` toxic texts of it have, and the forms
near a term that its clean texts have; the sample bounds both. Documents are scored where
they lie, without a shuffle.

Defined results: null and empty texts have no hits. Null labels are ignored; a document
labelled both ways is toxic. Without labels the weights are ``PRIOR_WEIGHTS``. Repeated rows
come back as often as they occur. Rows without an id are never learned from and not held
out. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import (
    U64, Batches, find_words, hash_windows, hash_words, lower_ascii, map_arrow, pieces, save,
    ship, strings, text_bytes,
)

#: Common words of abuse in four languages; whole words.
WORDS = (
    "idiot", "moron", "scum", "clown", "trash", "loser", "stupid", "worthless", "pathetic",
    "disgusting", "imbecile", "bastard", "asshole", "bitch", "retard", "vermin",
    "arschloch", "abschaum", "vollidiot", "dummkopf", "connard", "salaud", "ordure",
    "abruti", "imbécile", "idiota", "estúpido", "imbécil", "basura", "cabrón",
)
TRAIN_ROWS, MIN_SUPPORT = 20_000, 3
PREFIXES = range(4, 9)
WINDOW = 8
KEEP = 400_000

_TOKEN = re.compile(r"[\w@*]+")
_QUOTES = "\"“”„«»‘’"
REPORTING = frozenset(
    "said says wrote called calls word term quote quoted reported sagte schrieb nannte wort "
    "zitat dit écrit appelé mot citation dijo escribió llamó palabra cita".split()
)
ADDRESS = frozenset("you your yours u ur du dein ihr sie euch tu toi vous votre tú usted vosotros eres".split())
FEATURES = ("aimed", "aimed_fuzzy", "aimed_start", "quoted", "quoted_fuzzy", "share")
#: Bias, then one for each feature.
PRIOR_WEIGHTS = (-3.0, 2.5, 1.5, 2.0, 0.5, 0.2, 2.0)


def edits_for(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Accepts what lies within a term's edits of it; tells the fewest edits, or None."""

    def __init__(self, words: Iterable[str], starts: Iterable[str] = ()):
        # A node: children by letter, the whole word's edits, whether a beginning ends here.
        self.nodes: list[tuple[dict[str, int], int | None, bool]] = [({}, None, False)]
        self.reach: list[int] = [0]
        for term, edits in [(w, edits_for(w)) for w in words] + [(s, None) for s in starts]:
            at = 0
            for c in term:
                if c not in self.nodes[at][0]:
                    self.nodes[at][0][c] = len(self.nodes)
                    self.nodes.append(({}, None, False))
                    self.reach.append(0)
                self.reach[at] = max(self.reach[at], edits or 0)
                at = self.nodes[at][0][c]
            self.reach[at] = max(self.reach[at], edits or 0)
            children, whole, start = self.nodes[at]
            self.nodes[at] = (children, edits if edits is not None else whole, start or edits is None)
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int | None, bool]] = []
        self.first = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Close under letters of a term left out; keep the fewest edits of each node."""
        least: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, e = todo.pop()
            if e > self.reach[node] or least.get(node, 99) <= e:
                continue
            least[node] = e
            todo += [(child, e + 1) for child in self.nodes[node][0].values()]
        key = frozenset(least.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            ends = [e for n, e in key if self.nodes[n][1] is not None and e <= self.nodes[n][1]]
            begun = any(e == 0 and self.nodes[n][2] for n, e in key)
            self.accepts.append((min(ends, default=None), begun))
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        pairs = set()
        for node, e in self.states[state]:
            pairs.add((node, e + 1))  # a letter too many
            for letter, child in self.nodes[node][0].items():
                pairs.add((child, e if letter == c else e + 1))
        to = self.moves[state][c] = self._state(pairs)
        return to

    def match(self, word: str) -> int | None:
        """Edits from the nearest whole word; 9 where the word begins with a listed start."""
        at, begun = self.first, False
        for c in word:
            to = self.moves[at].get(c)
            at = self._move(at, c) if to is None else to
            begun = begun or self.accepts[at][1]
            if not self.states[at]:
                break
        whole = self.accepts[at][0]
        return whole if whole == 0 else 9 if begun else whole


@dataclass
class Lexicon:
    words: tuple[str, ...]
    starts: tuple[str, ...] = ()
    ordinary: frozenset[str] = frozenset()


class Scanner:
    """Hits of a lexicon in texts, by kind and context."""

    def __init__(self, lexicon: Lexicon):
        self.automaton = LexiconAutomaton(lexicon.words, lexicon.starts)
        self.ordinary, self.known = lexicon.ordinary, {}

    def hit(self, word: str) -> int | None:
        if word in self.known:
            return self.known[word]
        plain = word.strip("@*")
        found = self.automaton.match(plain) if len(plain) > 3 else None
        if found in (1, 2) and plain in self.ordinary:
            found = None
        if len(self.known) > KEEP:
            self.known.clear()
        self.known[word] = found
        return found

    def fuzzy_forms(self, text: str) -> set[str]:
        return {w.strip("@*") for w in set(_TOKEN.findall(text.lower())) if self.hit(w) in (1, 2)}

    def features(self, text: str) -> list[float]:
        low = text.lower()
        tokens = _TOKEN.findall(low)
        hits = {w: h for w in set(tokens) if (h := self.hit(w)) is not None}
        counts = [0.0] * 5
        if hits:
            spans = [m.span() for m in _TOKEN.finditer(low)]
            for i, w in enumerate(tokens):
                if w in hits:
                    quoted = self._quoted(low, tokens, spans, i)
                    kind = 2 if hits[w] == 9 else 1 if hits[w] else 0
                    counts[(4 if kind else 3) if quoted else kind] += 1
        return [math.log1p(c) for c in counts] + [math.sqrt(sum(counts) / max(1, len(tokens)))]

    @staticmethod
    def _quoted(low: str, tokens: list[str], spans: list[tuple[int, int]], i: int) -> bool:
        lo, hi = max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1)
        before, after = low[spans[lo][0] : spans[i][0]], low[spans[i][1] : spans[hi - 1][1] + 1]
        score = 1.0 if any(q in before for q in _QUOTES) and any(q in after for q in _QUOTES) else 0.0
        score += 0.6 if REPORTING.intersection(tokens[max(0, i - 4) : i]) else 0.0
        score -= 0.6 if ADDRESS.intersection(tokens[lo:hi]) else 0.0
        return score >= 0.6


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic model, drawn towards the prior ones, by Newton steps."""
    prior = np.array(PRIOR_WEIGHTS)
    if not len(y):
        return prior
    a, w = np.c_[np.ones(len(x)), x], prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * (w - prior)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _terms_of(text: str) -> set[str]:
    """Whole words, marked by a blank, and beginnings of longer words."""
    words = {w for w in _TOKEN.findall(text.lower()) if len(w) > 3 and w.isalpha()}
    return {w[:k] for w in words for k in PREFIXES if len(w) > k} | {w + " " for w in words}


def _signatures(texts: pa.Array) -> list[int]:
    """Alike for most near copies: the smallest shingle hash."""
    data, offs = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = find_words(data, offs)
    words = hash_words(data, starts, ends)
    runs = hash_windows(words, 5) >> U64(1)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        own = runs[a : b - 4] if b - a >= 5 else words[a:b] >> U64(1)
        out.append(int(own.min()) if len(own) else 0)
    return out


def _toxic_terms(batches: Batches) -> Batches:
    for batch in batches:
        texts = batch.column(0)
        for lo, hi in pieces(texts):
            part = texts.slice(lo, hi - lo)
            for text, sig in zip(strings(part), _signatures(part)):
                terms = list(_terms_of(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, pa.string()), pa.array([sig] * len(terms), pa.int64())], names=["term", "sig"]
                )


def _clean_counts(candidates: frozenset[str]):
    def run(batches: Batches) -> Batches:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in strings(batch.column(0)):
                counts.update(_terms_of(text) & candidates)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
        )

    return run


def _telling(
    toxic: dict[str, int], clean: dict[str, int], rate: float, words: Iterable[str]
) -> list[str]:
    """Terms whose share of toxic texts is beyond chance for so many candidates.

    Not those that only say what the lexicon's ``words`` say already.
    """
    known = {w[:k] for w in words for k in PREFIXES} | {w + " " for w in words}
    bar, out = math.log(max(2, len(toxic))) + 3, {}
    for term, t in toxic.items():
        c = clean.get(term, 0)
        p = t / (t + c)
        if p < 0.8 or p <= rate or term in known:
            continue
        gain = p * math.log(p / rate) + ((1 - p) * math.log((1 - p) / (1 - rate)) if p < 1 else 0)
        if (t + c) * gain >= bar:
            out[term] = p
    # A beginning already in the list says as much as what begins with it.
    return [t for t in out if not any(out.get(t.strip()[:k], 0) >= out[t] for k in PREFIXES if k < len(t.strip()))]


def _features(lexicon: Lexicon):
    def run(batches: Batches) -> Batches:
        scanner = Scanner(lexicon)
        for batch in batches:
            texts, toxic = batch.columns
            x = np.array([scanner.features(t) for t in strings(texts)], np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x[:, i]) for i in range(len(FEATURES))], toxic], names=[*FEATURES, "toxic"]
            )

    return run


def _fuzzy_forms(lexicon: Lexicon):
    def run(batches: Batches) -> Batches:
        scanner = Scanner(lexicon)
        for batch in batches:
            for text in strings(batch.column(0)):
                forms = list(scanner.fuzzy_forms(text))
                yield pa.RecordBatch.from_arrays([pa.array(forms, pa.string())], names=["form"])

    return run


def learn(
    docs: DataFrame, labels: DataFrame, words: Iterable[str] = WORDS, train_rows: int = TRAIN_ROWS
) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and weights from labelled rows that are not held out."""
    words = tuple(words)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("of")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("of"), "of").limit(train_rows)
    chosen = save(chosen, "training-ids")
    sample = save(
        docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select("text", "toxic")
        .repartition(2 * docs.sparkSession.sparkContext.defaultParallelism),
        "training",
    )
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = sample.filter("toxic = 1"), sample.filter("toxic = 0")
    lexicon = Lexicon(words)
    if sizes.get(1) and sizes.get(0):
        seen = map_arrow(bad.select("text"), _toxic_terms, "term string, sig bigint").distinct()
        seen = seen.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_SUPPORT)
        toxic = {r["term"]: r["n"] for r in seen.orderBy("term").collect()}
        counted = map_arrow(good.select("text"), _clean_counts(frozenset(toxic)), "term string, n bigint")
        clean = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        found = _telling(toxic, clean, sizes[1] / (sizes[0] + sizes[1]), words)
        whole = sorted({t.strip() for t in found if t.endswith(" ")} - set(words))
        lexicon = Lexicon((*words, *whole), tuple(sorted(t for t in found if not t.endswith(" "))))
    if sizes.get(0):
        forms = map_arrow(good.select("text"), _fuzzy_forms(lexicon), "form string").distinct()
        lexicon = Lexicon(lexicon.words, lexicon.starts, frozenset(r["form"] for r in forms.collect()))
    kinds = ", ".join(f"{f} double" for f in FEATURES)
    table = map_arrow(sample, _features(lexicon), f"{kinds}, toxic int").toPandas()  # at most train_rows rows
    return lexicon, fit(table[list(FEATURES)].to_numpy(float), table["toxic"].to_numpy(float))


def _score(lexicon: Lexicon, weights: np.ndarray):
    def run(batches: Batches) -> Batches:
        scanner = Scanner(lexicon)
        for batch in batches:
            ids, held, texts = batch.columns
            for lo, hi in pieces(texts):
                x = np.array([scanner.features(t) for t in strings(texts.slice(lo, hi - lo))])
                score = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), held.slice(lo, hi - lo), pa.array(score),
                     pa.array((score >= 0.5).astype(np.int32)), *[pa.array(x[:, i]) for i in range(len(FEATURES))]],
                    names=["doc_id", "held_out", "score", "predicted", *FEATURES],
                )

    return run


def score(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted, and the features behind them."""
    ship(docs.sparkSession)
    kinds = ", ".join(f"{f} double" for f in FEATURES)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_arrow(rows, _score(lexicon, weights),
                     f"doc_id bigint, held_out boolean, score double, predicted int, {kinds}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lexicon, weights = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, lexicon, weights)
