import random

import numpy as np
import pytest

from namewake.llm import toxicity
from namewake.llm.toxicity import Lexicon, LexiconAutomaton, Scanner, edits_for
from tests.llm.odd import no_docs, odd_docs, odd_rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_accepts_exactly_what_is_within_reach():
    rng = random.Random(1)
    terms = ["".join(rng.choice("abc") for _ in range(rng.choice([3, 4, 5, 6, 9, 10]))) for _ in range(12)]
    automaton = LexiconAutomaton(terms)
    for _ in range(5000):
        word = list(rng.choice(terms)) if rng.random() < 0.7 else [rng.choice("abcd") for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(word))
            word[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "d"])
        word = "".join(word)
        best = min((d for t in terms if (d := distance(word, t)) <= edits_for(t)), default=None)
        assert automaton.match(word) == best, word


def test_beginnings_match_without_edits():
    automaton = LexiconAutomaton(["idiot"], ["bada"])
    assert [automaton.match(w) for w in ("badass", "bada", "bad", "bedass", "idiot", "id1ot", "idiots")] == [9, 9, None, None, 0, 1, 1]


def test_quotation_and_abuse():
    scanner = Scanner(Lexicon(("idiot", "moron"), (), frozenset({"oron"})))
    aimed = scanner.features("you are an idiot and you are a m0ron")
    quoted = scanner.features('the report said "idiot" is a word of the century')
    assert aimed[0] > 0 and aimed[1] > 0 and aimed[3] == 0
    assert quoted[3] > 0 and quoted[0] == 0
    assert scanner.features("oron oron") == [0.0] * 6
    w = np.array(toxicity.PRIOR_WEIGHTS)
    assert w[0] + w[1:] @ aimed > 0 > w[0] + w[1:] @ quoted


def test_learns_terms_and_scores_held_out_documents(spark):
    rng = random.Random(2)
    clean = [f"{a}{b}" for a in "ka lo mi nu pe".split() for b in "sta rin dol fek gup".split()]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(clean) for _ in range(40)]
        if i % 4 == 0:  # half by a listed word, half by inflected forms of an unknown stem
            for _ in range(3):
                words[rng.randrange(40)] = "moron" if i % 8 else "zzurg" + rng.choice(["a", "as", "en", "oth"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    lexicon, weights = toxicity.learn(docs, table)
    assert any("zzurgen".startswith(s) for s in lexicon.starts)
    got = toxicity.score(docs, lexicon, weights).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert 40 < len(held) < 120
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in held)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(50)], "doc_id bigint, text string")
    labels = docs.select("doc_id", toxicity.held_out(docs.doc_id).cast("int").alias("toxic"))
    lexicon, weights = toxicity.learn(docs, labels)  # all that is left is clean
    assert lexicon.words == toxicity.WORDS and lexicon.starts == ()
    assert all(r.predicted == 0 for r in toxicity.score(docs, lexicon, weights).collect())


def test_odd_rows_and_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, 0, 0), (2, None, None), (None, 1, 1), (6, 0, 0), (999, 1, 1)], "doc_id bigint, quality int, toxic int"
    )
    lexicon, weights = toxicity.learn(docs, labels)
    got = toxicity.score(docs, lexicon, weights).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    none = toxicity.learn(no_docs(spark), labels.limit(0))
    assert none[1] == pytest.approx(toxicity.PRIOR_WEIGHTS)
    assert toxicity.score(no_docs(spark), *none).count() == 0
