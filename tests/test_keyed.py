import uuid

import pytest
from pyspark.sql import functions as F

from namewake.operators.keyed import KeyedTable
from tests.helpers import plan_text


def keyed(spark, path, rows, buckets=8):
    df = spark.createDataFrame(rows, "id bigint, k bigint, note string").repartition(3)
    return KeyedTable.write(df, "k", f"t{uuid.uuid4().hex}", str(path), ["id"], buckets)


ROWS = [(i, 7 if i % 3 == 0 else None if i % 3 == 1 else i % 50, f"n{i}") for i in range(3000)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_equal_plain_ones_and_do_not_move_the_rows(spark, tmp_path, how):
    table = keyed(spark, tmp_path / "t", ROWS)
    lookup = [(k, f"name{k}") for k in [*range(0, 40, 2), 7, None]]
    other = spark.createDataFrame(lookup, "ok bigint, name string")
    joined = table.join(other, "ok", how)
    plain = plan_text(joined)
    scans = [line for line in plain.splitlines() if "FileScan" in line and "note" in line]
    assert len(scans) == 1 and "Bucketed: true" in scans[0]
    moved = [line for line in plain.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 1 and "ok#" in moved[0] and "note#" not in moved[0]
    names = {k: n for k, n in lookup if k is not None}
    want = {
        "inner": [(*r, names[r[1]]) for r in ROWS if r[1] in names],
        "left": [(*r, names.get(r[1])) for r in ROWS],
        "left_semi": [r for r in ROWS if r[1] in names],
        "left_anti": [r for r in ROWS if r[1] not in names],
    }[how]
    assert sorted(map(str, map(tuple, joined.collect()))) == sorted(map(str, want))


def test_hot_keys_lie_in_several_buckets(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", ROWS, buckets=8)
    files = table.rows().groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) < len(ROWS) / 3
    assert sorted(map(tuple, table.rows().select("id").collect())) == [(r[0],) for r in ROWS]


def test_empty_table_and_wrong_joins(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", [])
    other = spark.createDataFrame([(1, "a")], "ok bigint, name string")
    assert table.join(other, "ok").collect() == []
    with pytest.raises(ValueError, match="full"):
        table.join(other, "ok", "full")
