import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from namewake.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, depth int, pos int, owner string, w int"
EXTRA = ("k", 1, 2, "o", 3)


def ordered_turns(table):
    """Turns of each conversation in the order that the operator states."""
    hashed = table.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).select("*", F.xxhash64("role", "text", F.lit(0)).alias("t1"), F.xxhash64("text", "role", F.lit(~0)).alias("t2"))
    out = {}
    for r in sorted(hashed.collect(), key=lambda r: (r.conv_id, r.turn is not None, r.turn or 0, r.t1, r.t2)):
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    return out


def plain_trie(turns):
    """Nodes by rebuilding every conversation in full."""
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        under = [below[k] for k in kids.get(node, [])]
        below[node] = (sum(u[0] for u in under) or int(not under), own + sum(u[1] for u in under))
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(rebuilt[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(kids.get(node, [])), *below[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def nodes_of(table):
    c = F.col("conv_id")
    head = F.crc32(c.cast("string").cast("binary")) % 6
    return sorted(tuple(r) for r in prefix_trie.prefix_trie(table, c - F.pmod(c, F.lit(100)), head).collect())


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)


def odd_conversations():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 40), *range(95, 130), *range(250, 262), 10**12 + 7]:
        for t in range(rng.choice([1, 2, 3, 6, 9])):
            text = rng.choice(["a", "b", "", None, "é long " * 30])
            rows.append((c, t, rng.choice(["user", "assistant", None]), text))
    rows += [(3, None, "user", "first")] * 2 + [(4, 1, "user", "tie"), (4, 1, "user", "other tie")]
    rows += [(None, 1, "user", "nobody's")] * 3
    return rows


def test_trie_equals_that_of_rebuilt_conversations(spark):
    table = table_of(spark, odd_conversations())
    assert nodes_of(table) == plain_trie(ordered_turns(table))


def test_one_conversation_and_one_group_hold_a_third_each(spark):
    """A long conversation over all tasks; copies of another; one turn repeated."""
    rng = random.Random(4)
    rows = [(100, t, "user", f"t{t % 7}") for t in range(400)]
    rows += [(200 + c, t, "user", "same") for c in range(100) for t in range(4)]
    rows += [(501, None, "user", "again")] * 300
    rows += [(c, t, "user", str(rng.randint(0, 3))) for c in range(600, 700) for t in range(4)]
    table = table_of(spark, rows)
    assert nodes_of(table) == plain_trie(ordered_turns(table))


def test_turnless_and_empty(spark):
    table = table_of(spark, [(5, 0, "user", "x"), (107, 0, "user", "y"), (109, 0, "user", "z")])
    assert nodes_of(table) == plain_trie(ordered_turns(table))
    assert nodes_of(table_of(spark, [(None, 0, "user", "x")])) == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100])
def test_powers(n):
    for b in prefix_trie.BASES:
        assert list(prefix_trie.powers(b, n)) == [pow(b, i, prefix_trie.PRIME) for i in range(n)]


def test_products_do_not_depend_on_where_partitions_end(spark):
    """The scan and the carry over borders give plain products at every place."""
    rows = [(c, t, "user", f"{c} {t * t % 5}") for c, n in ((1, 3), (2, 90), (3, 1), (4, 60)) for t in range(n)]
    table = table_of(spark, rows).select(
        "conv_id", "turn", F.xxhash64("text").alias("t1"), F.xxhash64("role", "text").alias("t2"), F.length("text").cast("bigint").alias("chars")
    )
    want, state = {}, {}
    for r in sorted(table.collect(), key=lambda r: (r.conv_id, r.turn)):
        n, w, p = state.get(r.conv_id, (0, 0, (0,) * 4))
        e = [(t >> s & prefix_trie.PRIME) % prefix_trie.PRIME for t in (r.t1, r.t2) for s in (0, 31)]
        p = tuple((x * b + y) % prefix_trie.PRIME for x, b, y in zip(p, prefix_trie.BASES, e))
        state[r.conv_id] = (n + 1, w + r.chars, p)
        want[r.conv_id, n + 1] = (w + r.chars, *p)
    got = {(r.conv_id, r.pos): (r.w, r.p0, r.p1, r.p2, r.p3) for r in prefix_trie.stored_products(table).collect()}
    assert got == want
