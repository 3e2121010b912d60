import zlib

import pytest

from namewake.llm import sharding
from tests.llm.odd import SCHEMA, no_docs, odd_docs, odd_rows

SHORT = "doc_id bigint, text string"


def plain_shards(rows, shards):
    """(id, size, checksum, start, shard, slot) of (id, text) rows, by one loop."""
    sized = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    sized.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    whole, start, slots, out = sum(s for _, s, _ in sized), 0, {}, []
    for i, size, crc in sized:
        shard = min(shards - 1, (2 * start + size) * shards // (2 * whole))
        out.append((i, size, crc, start, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        start += size
    return out


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[3]))


@pytest.mark.parametrize("shards", [1, 3, 8, 200])
def test_shards_equal_those_of_one_loop(spark, shards):
    want = plain_shards([(r[0], r[1]) for r in odd_rows()], shards)
    assert by_id(sharding.assign_shards(odd_docs(spark), shards).collect()) == want


def test_equal_rows_and_one_id_are_dealt_out(spark):
    """A third of the rows are one row, another third share an id; null ids come first."""
    rows = [(7, "same")] * 200 + [(9, f"text {i}") for i in range(200)] + [(None, "x")] * 50
    rows += [(i, "y" * (i % 50)) for i in range(1000, 1150)]
    docs = spark.createDataFrame(rows, SHORT).repartition(5)
    got = by_id(sharding.assign_shards(docs).collect())
    want = plain_shards(rows, 8)
    assert [r[1:] for r in got] == [r[1:] for r in want] and [r[0] for r in got] == [r[0] for r in want]
    sizes = [sum(r[1] for r in got if r[4] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r[1] for r in got)


def test_a_document_larger_than_a_shard_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b" * 10_000), (3, None), (4, "")], SHORT)
    got = by_id(sharding.assign_shards(docs).collect())
    assert got == plain_shards([(1, "a"), (2, "b" * 10_000), (3, None), (4, "")], 8)
    assert sharding.assign_shards(no_docs(spark)).collect() == []


def test_written_shards_hold_the_same_documents_in_order(spark, tmp_path):
    docs = odd_docs(spark).withColumnRenamed("region", "shard").withColumnRenamed("part", "ord")
    sharding.write_shards(docs, str(tmp_path / "out"), 5)
    stored = spark.read.parquet(str(tmp_path / "out"))
    got = [(r.document.doc_id, r.document.text, r.shard) for r in stored.orderBy("ord").collect()]
    want = plain_shards([(r[0], r[1]) for r in odd_rows()], 5)
    assert [(g[0], g[2]) for g in got] == [(w[0], w[4]) for w in want]
    rows = [tuple(r.document) for r in stored.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, odd_rows())) and len(SCHEMA.split(",")) == len(rows[0])


def test_texts_are_not_shuffled_to_find_the_cuts(spark):
    plan = sharding.in_order(odd_docs(spark).select(*sharding.measured(odd_docs(spark), "doc_id", "text")), sharding._order())
    shown = plan._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in shown.splitlines() if "Exchange range" in line)
    assert "text#" not in exchange and "Python" not in shown and "Arrow" not in shown
