import random
from collections import Counter, defaultdict

import pytest

from namewake.llm import jaccard_join
from namewake.llm.components import components
from tests.llm.odd import no_docs, odd_docs, odd_rows, prose, shingles


def plain_components(texts):
    """(number of shingles, smallest id reachable) by comparing all that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    having = defaultdict(list)
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in having[x]).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
        for x in s:
            having[x].append(i)
    return {i: (len(sets[i]), top(i)) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def test_odd_rows(spark):
    got = jaccard_join.classes(odd_docs(spark), filter_bits=16)
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    assert found(got) == plain_components({r[0]: r[1] for r in odd_rows() if r[0] is not None})
    assert [r.component_id for r in rows if r.doc_id is None] == [None, None]


@pytest.mark.parametrize("leaf,levels,frequent,bits", [(2, 6, 1, 12), (3, 1, 2, 20), (1, 0, 4, 11)])
def test_recursion_of_regions_is_exact(spark, monkeypatch, leaf, levels, frequent, bits):
    """Many versions of few texts, with few frequent shingles, small leaves and full filters."""
    for name, value in (("LEAF", leaf), ("LEVELS", levels), ("FREQUENT", frequent)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng, texts = random.Random(leaf), {}
    for family in range(4):
        seed = prose(rng, 60 + 40 * family).split(" ")
        versions = [seed]
        for _ in range(25):
            v = list(rng.choice(versions))
            for _ in range(rng.randint(0, 4)):
                v[rng.randrange(len(v))] = f"w{rng.randint(0, 9999)}"
            if rng.random() < 0.3:
                v = v[: int(len(v) * rng.uniform(0.75, 1))]
            versions.append(v)
            texts[len(texts)] = " ".join(v)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert found(jaccard_join.classes(docs, filter_bits=bits)) == plain_components(texts)


def test_one_of_each_keeps_columns_and_the_smallest_id(spark):
    docs = odd_docs(spark)
    kept = jaccard_join.one_of_each(docs)
    assert kept.schema == docs.schema
    want = plain_components({r[0]: r[1] for r in odd_rows() if r[0] is not None})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(i for i, (_, c) in want.items() if i == c)


def test_one_of_each_judges_rows_by_their_text(spark):
    """Ids that are repeated with other texts, or missing."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a), (7, a), (7, b), (9, b), (None, c), (None, c), (None, c + " more"), (None, b), (3, a), (5, None), (5, None)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id bigint, text string, `a.b` string").repartition(3)
    kept = sorted((r.doc_id is None, r.doc_id, r.text) for r in jaccard_join.one_of_each(docs).collect())
    assert kept[:-1] == [(False, 3, a), (False, 5, None), (False, 5, None), (False, 7, b)]
    assert kept[-1][:2] == (True, None) and kept[-1][2] in (c, c + " more") and len(kept) == 5


def test_empty(spark):
    assert jaccard_join.classes(no_docs(spark), filter_bits=12).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (300, 299)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {299: 299, 300: 299}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
