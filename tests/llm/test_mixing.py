from collections import defaultdict

import numpy as np
import pytest

from namewake.llm import mixing
from pyspark.sql import functions as F
from tests.llm.odd import no_docs, odd_docs, odd_rows, words_of


def plain_targets(sizes):
    """Shares by weight, filled up to three times the size, the rest shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight, left, open_, out = {s: i % 3 + 1 for i, s in enumerate(order)}, sum(sizes.values()), set(sizes), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= full
        if not open_:
            return out


def docs_of(spark, sizes):
    rows, i = [], 0
    for source, many in sizes.items():
        for n in many:
            rows.append((i, " ".join(f"w{k}" for k in range(n)), source))
            i += 1
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3), rows


@pytest.mark.parametrize("block", [1, 7, 64])
def test_mix_meets_its_targets_and_no_document_is_taken_too_often(spark, block):
    sizes = {"a": [500, 3, 70], "b": [5], "c": [200, 0, 333], None: [40, 90], "ä": [64]}
    docs, rows = docs_of(spark, sizes)
    table, targets, mixed = mixing.plan(docs, block_words=block)
    want = plain_targets({s: sum(n) for s, n in sizes.items()})
    got = {r.skey: r.target for r in targets.collect()}
    assert {("0" + s) if s is not None else "1": t for s, t in want.items()} == pytest.approx(got)
    taken, spans = defaultdict(int), defaultdict(list)
    for r in mixed.collect():
        taken[r.doc_id] += r.hi - r.lo
        spans[r.doc_id, r.epoch].append((r.lo, r.hi))
    by_source = defaultdict(int)
    for i, text, source in rows:
        assert taken[i] <= 3 * len(words_of(text))
        by_source[source] += taken[i]
    assert dict(by_source) == {s: round(t) for s, t in want.items()}
    for own in spans.values():  # an epoch takes no word twice
        own.sort()
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))
    again = mixing.plan(docs.repartition(5), block_words=block)[2]
    key = ["shard", "slot", "epoch", "doc_id", "lo", "hi"]
    assert sorted(map(tuple, again.select(*key).collect())) == sorted(map(tuple, mixed.select(*key).collect()))
    assert mixed.select("shard").distinct().count() > 1


def test_mixed_documents_have_the_words_taken(spark):
    docs, rows = docs_of(spark, {"a": [500, 3, 70], "b": [5], "c": [200, 333]})
    out = mixing.mixed_documents(docs)
    assert out.schema == docs.schema
    words = defaultdict(int)
    for r in out.collect():
        words[r.source] += len(words_of(r.text))
        assert set(words_of(r.text)) <= set(words_of(dict((i, t) for i, t, _ in rows)[r.doc_id]))
    want = plain_targets({"a": 573, "b": 5, "c": 533})
    assert dict(words) == {s: round(t) for s, t in want.items()}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    table, targets, mixed = mixing.plan(docs)
    assert table.count() == len(odd_rows())
    sizes = defaultdict(int)
    for r in odd_rows():
        sizes["1" if r[3] is None else "0" + r[3]] += len(words_of(r[1]))
    assert {r.skey: r.source_size for r in targets.collect()} == dict(sizes)
    assert mixing.mixed_documents(docs).schema == docs.schema
    assert mixed.agg(F.sum(F.col("hi") - F.col("lo"))).first()[0] == pytest.approx(sum(sizes.values()), abs=3)


def test_no_documents_and_no_words(spark):
    assert mixing.plan(no_docs(spark))[2].count() == 0
    docs, _ = docs_of(spark, {"a": [0, 0], None: [0]})
    assert mixing.plan(docs)[2].count() == 0 and mixing.mixed_documents(docs).count() == 0


def test_permutations():
    for n in (1, 2, 3, 5, 64, 1000):
        seen = {tuple(mixing.feistel(np.arange(n), n, key).tolist()) for key in range(5)}
        assert all(sorted(p) == list(range(n)) for p in seen) and (n < 64 or len(seen) == 5)
        for e in range(3):
            p = mixing.feistel(np.arange(n), n, mixing._epoch_key(9, e))
            assert p[mixing._place_of_last(n, 9, e)] == n - 1


def test_repeated_rows_are_all_mixed_and_all_come_back(spark, tmp_path):
    rows = [(1, "a b c d", "s")] * 2 + [(2, "e f g", "s")] * 9000 + [(None, "x y", "t")] * 3 + [(4, None, "t")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r["size"] for r in got) == 8 + 27_000 + 6
    assert {r.source_size for r in got if r.doc_id in (1, 2)} == {27_008}
    assert all(r.taken <= 3 * r["size"] for r in got)
    words = sum(len(words_of(r.text)) for r in mixing.mixed_documents(docs).collect())
    assert words == sum(r.taken for r in got) == 18 + round(27_014 - 18)
