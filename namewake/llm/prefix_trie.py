"""Operator 11: conversation prefix trie, over conversations that exist only as products.

A conversation is rebuilt from the head of another one and its own later turns. No rebuilt
text is made. A turn is an affine map x -> base * x + e over a prime field, e being drawn
from the turn's content; a sequence of turns is the product of its maps, and such products
form a monoid. The fingerprint of rebuilt conversation c up to depth d is therefore put
together from stored products: that of the base's head, and that of c's turns up to the
place, of which the product of c's own head is divided out. Four fields of 31 bits make up
a fingerprint.

* One scan gives the products of all prefixes of the stored conversations. Rows are dealt
  by ranges of (conversation, turn), so one conversation may be spread over many tasks;
  the products of the at most two conversations that reach over each border are multiplied
  up between tasks.
* Prefixes with equal (depth, fingerprint) are one node. Each refers to its last stored
  turn by a content key of 128 bits. Within a group all keys must agree, and turns of one
  key must agree in role and text; dividing by an equal last turn leaves equal shorter
  prefixes, so by induction all turns are equal. Should any group fail, all is done again
  with other hashes: results are exact.
* The smallest member owns a node, and it owns all nodes below on its own path. So one
  number a conversation, the depth from which it owns its path, turns sums over subtrees
  into sums over members: leaves, children and shared characters need no walk of the tree.

Keys with many members are salted in the joins and pre-aggregated elsewhere. The ids of the
conversations that end in a node are packed to pieces in order, then hashed as a stream.

Defined results: rows without a conversation id belong to no conversation. A null role or
text is an empty one. Null turns come first; rows of one turn are ordered by a hash of
role and text, equal rows count as often as they occur. A conversation without turns is a
member of the root only. An empty table has no nodes, not even a root. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import map_arrow, save
from namewake.llm.ranges import PACKED_BYTES, ROW_BITS, in_order, stream_sha256
from namewake.operators.joins import lookup_join

#: The field, and the bases of the four maps.
PRIME = (1 << 31) - 1
BASES = (1103515245, 1597334677, 747796405, 1812433253)
INVERSES = tuple(pow(b, -1, PRIME) for b in BASES)
FIELDS = range(len(BASES))

MAX_HEAD = 5

_P, _B = [f"p{i}" for i in FIELDS], [f"b{i}" for i in FIELDS]
_LOCAL = "conv_id bigint, part int, k bigint, t1 bigint, t2 bigint, chars bigint, w bigint, " + ", ".join(
    f"{c} bigint" for c in _P + _B
)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) in the field."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, PRIME)) % np.uint64(PRIME)
        have += more
    return out[:n]


def elements(t1: np.ndarray, t2: np.ndarray) -> list[np.ndarray]:
    """The four field elements of a turn."""
    low, u = np.uint64(PRIME), np.uint64(31)
    return [x % low for t in (t1.astype(np.uint64), t2.astype(np.uint64)) for x in (t & low, (t >> u) & low)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix products of each conversation within one partition of ordered rows."""
    prime, conv, k0, w0, sums = np.uint64(PRIME), None, 0, 0, [np.uint64(0)] * len(BASES)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, t1, t2, chars, ord_ = (batch.column(i).to_numpy() for i in range(5))
        new = np.ones(n, bool)
        new[1:] = ids[1:] != ids[:-1]
        new[0] = conv is None or ids[0] != conv
        if new[0]:
            k0, w0, sums = 0, 0, [np.uint64(0)] * len(BASES)
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new, at, -1))  # -1: goes on from the last batch
        k = at - start + np.where(start < 0, k0, 1)
        run = np.concatenate([[0], np.cumsum(chars)])
        w = run[1:] - run[np.maximum(start, 0)] + np.where(start < 0, w0, 0)
        longest = int(k.max()) + 1
        columns = []
        steps = []
        for i, e in enumerate(elements(t1, t2)):
            up, down = powers(BASES[i], longest), powers(INVERSES[i], longest)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(e * down[k] % prime)])
            part = total[1:] - total[np.maximum(start, 0)] + np.where(start < 0, sums[i], np.uint64(0))
            part %= prime
            columns.append((part * up[k] % prime).astype(np.int64))
            steps.append(up[k].astype(np.int64))
            sums[i] = part[-1]
        conv, k0, w0 = ids[-1], int(k[-1]), int(w[-1])
        made = [ids, (ord_ >> ROW_BITS).astype(np.int32), k, t1, t2, chars, w, *columns, *steps]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], ["conv_id", "part", "k", "t1", "t2", "chars", "w", *_P, *_B])


def _times(a: dict, b: dict) -> dict:
    """The product of two runs of turns."""
    out = {"k": a["k"] + b["k"], "w": a["w"] + b["w"]}
    for p, step in zip(_P, _B):
        out[p], out[step] = (a[p] * b[step] + b[p]) % PRIME, a[step] * b[step] % PRIME
    return out


def _carried(local: DataFrame) -> DataFrame:
    """What precedes the first conversation of each partition in earlier ones.

    At most two rows for each partition come to the driver.
    """
    ends = local.groupBy("part").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi"))
    border = local.join(F.broadcast(ends), "part").filter("conv_id = lo OR conv_id = hi")
    last = F.max(F.struct("k", "w", *_P, *_B)).alias("last")
    rows = border.groupBy("part", "conv_id").agg(last).collect()
    before, conv, out = None, None, []
    for r in sorted(rows, key=lambda r: (r["part"], r["conv_id"])):
        own = r["last"].asDict()
        if r["conv_id"] == conv:
            out.append((r["part"], conv, *(before[c] for c in ("k", "w", *_P, *_B))))
            own = _times(before, own)
        before, conv = own, r["conv_id"]
    names = [f"c_{c}" for c in ("part", "conv_id", "k", "w", *_P, *_B)]
    schema = f"{names[0]} int, " + ", ".join(f"{c} bigint" for c in names[1:])
    return local.sparkSession.createDataFrame(out, schema)


def stored_products(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, t1, t2, chars) with their place and the product up to them.

    ``pos`` counts from 1, ``w`` sums the characters, ``p0`` .. ``p3`` are the product,
    ``b0`` .. ``b3`` the bases to the power of ``pos``.
    """
    narrow = save(turns, "trie-turns")
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    placed = in_order(narrow, by).select("conv_id", "t1", "t2", "chars", "ord")
    local = save(map_arrow(placed, _scan, _LOCAL), "trie-products")
    on = (F.col("part") == F.col("c_part")) & (F.col("conv_id") == F.col("c_conv_id"))
    met = local.join(F.broadcast(_carried(local)), on, "left")

    def joint(p: str, b: str) -> Column:
        return F.coalesce((F.col(f"c_{p}") * F.col(b) + F.col(p)) % PRIME, F.col(p)).alias(p)

    return met.select(
        "conv_id",
        (F.col("k") + F.coalesce("c_k", F.lit(0))).alias("pos"),
        "t1",
        "t2",
        "chars",
        (F.col("w") + F.coalesce("c_w", F.lit(0))).alias("w"),
        *(joint(p, b) for p, b in zip(_P, _B)),
        *(F.coalesce(F.col(f"c_{b}") * F.col(b) % PRIME, F.col(b)).alias(b) for b in _B),
    )


def _rebuilt(products: DataFrame, base: Column, head: Column) -> DataFrame:
    """One row for each conversation: how it is put together.

    ``heads`` holds the base's first turns, ``hb`` how many of them are used, ``len`` the
    turns there are; a stored turn at ``pos`` beyond ``head`` has the product
    p + q * b and the characters w + wq.
    """
    first = F.when(F.col("pos") <= MAX_HEAD, F.struct("pos", "t1", "t2", "chars", "w", *_P))
    stored = products.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.sort_array(F.collect_list(first)).alias("own")
    )
    stored = save(stored.withColumns({"base": base, "head": head.cast("int")}), "trie-heads")
    bases = stored.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("own").alias("heads"))
    met = stored.join(bases, "base", "left").withColumn(
        "hb", F.least("head", F.coalesce("base_n", F.lit(0))).cast("int")
    )

    def at(rows: str, place: str, field: str) -> Column:
        return F.when(F.col(place) > 0, F.try_element_at(F.col(rows), F.col(place))[field]).otherwise(0)

    more = F.col("n") > F.col("head")
    q = []
    for i, p in enumerate(_P):
        back = F.array(*[F.lit(pow(INVERSES[i], h, PRIME)).cast("bigint") for h in range(MAX_HEAD + 1)])
        gap = (at("heads", "hb", p) - at("own", "head", p) + PRIME) % PRIME
        q.append((gap * F.element_at(back, F.col("head") + 1) % PRIME).alias(f"q{i}"))
    return met.select(
        "conv_id",
        "heads",
        "head",
        "hb",
        (F.col("hb") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("len"),
        F.when(more, at("heads", "hb", "w") - at("own", "head", "w")).alias("wq"),
        *q,
    )


def _key(depth: Column, f: list[Column]) -> Column:
    pairs = [(F.shiftleft(f[i], 31).bitwiseOR(f[i + 1])).cast("string") for i in (0, 2)]
    return F.concat_ws(":", depth.cast("string"), *pairs)


def prefixes(products: DataFrame, base: Column, head: Column) -> DataFrame:
    """A row for each rebuilt conversation and depth: key, last turn, characters, length."""
    rebuilt = save(_rebuilt(products, base, head), "trie-rebuilt")
    told = ["t1", "t2", "chars", "w"]
    nothing = F.struct(*(F.lit(0).cast("bigint").alias(c) for c in [*told, *_P]))
    reach = rebuilt.select("conv_id", "len", "heads", F.explode(F.sequence(F.lit(0), "hb")).alias("depth"))
    ref = F.when(F.col("depth") > 0, F.try_element_at("heads", F.col("depth")).dropFields("pos"))
    upper = reach.select("conv_id", "len", F.col("depth").cast("bigint"), F.coalesce(ref, nothing).alias("r")).select(
        "conv_id", "depth", "len", _key(F.col("depth"), [F.col(f"r.{p}") for p in _P]).alias("key"),
        *(F.col(f"r.{c}") for c in told),
    )
    flat = rebuilt.filter("wq IS NOT NULL").drop("heads").withColumnRenamed("conv_id", "of")
    met = lookup_join(products, flat, "conv_id", "of", "inner", row_id=["conv_id", "pos"])
    depth = F.col("hb") + F.col("pos") - F.col("head")
    f = [(F.col(p) + F.col(f"q{i}") * F.col(b)) % PRIME for i, (p, b) in enumerate(zip(_P, _B))]
    lower = met.filter(F.col("pos") > F.col("head")).select(
        "conv_id", depth.alias("depth"), "len", _key(depth, f).alias("key"), "t1", "t2", "chars", (F.col("w") + F.col("wq")).alias("w")
    )
    return upper.unionByName(lower)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one key end to end, each after a comma, in pieces."""
    key, at, held, size = None, 0, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array([at]), pa.array([("," + ",".join(held)).encode()])], ["key", "at", "piece"]
        )

    for batch in batches:
        for k, c, ord_ in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if k != key or size > PACKED_BYTES:
                if held:
                    yield piece()
                key, at, held, size = k, ord_, [], 0
            held.append(str(c))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def _ends(rows: DataFrame) -> DataFrame:
    ends = rows.filter("depth = len").select("key", "conv_id")
    placed = in_order(ends, [F.col("key"), F.col("conv_id")])
    pieces = map_arrow(placed, _pack, "key string, at bigint, piece binary")
    return stream_sha256(pieces, ["key"], ["at"], skip=1)


def _nodes(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Nodes out of prefixes, given those with several members (key, owner, leaf)."""
    lookup = shared.select(F.col("key").alias("skey"), "owner", "leaf")
    held = rows.select("conv_id", "depth", "key", "w", "len")
    met = lookup_join(held, lookup, "key", "skey", "inner", row_id=["conv_id", "depth"])
    other = F.col("owner") != F.col("conv_id")
    inner = F.when(F.col("depth") == F.col("len"), other | ~F.col("leaf"))
    marks = met.groupBy("conv_id").agg(
        (F.max(F.when(other, F.col("depth"))) + 1).alias("owns_from"),
        F.max(F.when(other, F.struct("depth", "owner")))["owner"].alias("above"),
        F.max(F.when(other, F.col("w"))).alias("shared_chars"),
        F.max(inner).alias("inner"),
    )
    marks = save(marks.withColumnRenamed("conv_id", "of"), "trie-owners")
    told = lookup_join(rows, marks, "conv_id", "of", "left", row_id=["conv_id", "depth"])
    since, depth, c = F.coalesce("owns_from", F.lit(0)), F.col("depth"), F.col("conv_id")
    parent = F.when(depth == 0, F.lit(None)).when(since < depth, c).otherwise(F.col("above"))
    child = (since <= depth + 1) & (depth + 1 <= F.col("len"))
    # Of a member that does not own the node, the turns below that smaller members have too.
    saved = F.when(since > depth, F.col("shared_chars") - F.col("w") + F.col("chars"))
    leaf = ~F.coalesce("inner", F.lit(False))
    return told.groupBy("key").agg(
        F.min(F.struct(c.alias("conv_id"), parent.cast("bigint").alias("parent"))).alias("top"),
        F.max(depth).alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(child.cast("bigint")).alias("n_children"),
        F.sum(leaf.cast("bigint")).alias("n_leaves"),
        F.coalesce(F.sum(saved), F.lit(0)).alias("saved_tokens"),
    )


def prefix_trie(conversations: DataFrame, base: Column, head: Column) -> DataFrame:
    """Nodes of the trie of rebuilt conversations.

    ``base`` and ``head`` are expressions over ``conv_id``: a conversation is rebuilt as
    the first ``head`` turns (``MAX_HEAD`` at most) of ``base`` and its own after as many.
    Columns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    read = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    for seed in count():
        keys = {
            "t1": F.xxhash64("role", "text", F.lit(seed)),
            "t2": F.xxhash64("text", "role", F.lit(~seed)),
        }
        turns = read.withColumns(keys | {"chars": F.length("text").cast("bigint")})
        ranges = [f(c).alias(f"{c}_{f.__name__}") for c in ("role", "text") for f in (F.min, F.max)]
        alike = turns.groupBy("t1", "t2").agg(*ranges)
        if not alike.filter("role_min != role_max OR text_min != text_max").isEmpty():
            continue
        products = stored_products(turns.select("conv_id", "turn", "t1", "t2", "chars"))
        rows = save(prefixes(products, base, head), "trie-prefixes")
        ended = F.sum((F.col("depth") == F.col("len")).cast("bigint"))
        groups = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv_id").alias("owner"),
            (ended == F.count(F.lit(1))).alias("leaf"),
            ((F.min("t1") != F.max("t1")) | (F.min("t2") != F.max("t2"))).alias("mixed"),
        )
        shared = save(groups.filter("n > 1"), "trie-shared")
        if shared.filter("mixed").isEmpty():
            break
    nodes = _nodes(rows, shared)
    joined = nodes.join(_ends(rows), "key", "left")
    return joined.select(
        "top.conv_id",
        "depth",
        F.col("top.parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


#: Conversations of one group share the head of the group's first.
GROUP = 100


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    c = F.col("conv_id")
    return prefix_trie(table, c - F.pmod(c, F.lit(GROUP)), F.crc32(c.cast("string").cast("binary")) % (MAX_HEAD + 1))


ORACLE = r"""
WITH RECURSIVE steps AS (
    SELECT range AS i, range::BIGINT AS c, 0 AS k FROM range(256)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id AS c, conv_id - conv_id % 100 AS base,
           xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
                           lambda s, x: xor(s >> 8, t[xor(s & 255, x) + 1]), 4294967295), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), kept AS (
    SELECT c, pos, role, text, 0 AS own FROM ids JOIN turns ON conv_id = base AND pos <= h
    UNION ALL
    SELECT c, pos, role, text, 1 FROM ids JOIN turns ON conv_id = c AND pos > h
), rebuilt AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, role, text FROM kept
), chain AS (  -- every prefix by the hash of its turns
    SELECT c, 0::BIGINT AS d, sha256('') AS node, NULL::VARCHAR AS up, 0::BIGINT AS chars FROM ids
    UNION ALL
    SELECT r.c, r.d, sha256(p.node || sha256(r.role) || sha256(r.text)), p.node, length(r.text)
    FROM chain p JOIN rebuilt r ON r.c = p.c AND r.d = p.d + 1
), lens AS (
    SELECT c, max(d) AS len FROM chain GROUP BY c
), nodes AS (
    SELECT node, any_value(up) AS up, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs,
           any_value(chars) AS chars,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len), '')) AS ends_sha256
    FROM chain JOIN lens USING (c) GROUP BY node
), kids AS (
    SELECT up AS node, count(*) AS n_children FROM nodes GROUP BY up
), below AS (  -- every node with each node above it, itself included
    SELECT node AS top, node FROM nodes
    UNION ALL
    SELECT n.up, b.node FROM below b JOIN nodes n ON n.node = b.top WHERE n.up IS NOT NULL
), sums AS (
    SELECT top AS node, sum((n_convs - 1) * chars) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
    FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN kids k ON k.node = b.node GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes p ON p.node = n.up
"""
