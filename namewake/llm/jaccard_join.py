"""Operator 5: exact n-gram Jaccard join in a metric space of pivots and regions.

A document is the set of its distinct five-word shingles. 1 - Jaccard similarity is a
metric, so distances to pivots bound the distance of two documents.

1. *Classes.* Documents with the same set are one point of the space (``sid``).
2. *First regions.* In any fixed order of all shingles, two sets of similarity 0.8 share a
   shingle among the first ``n - ceil(0.8 n) + 1`` of each. The order puts shingles of one
   document first, frequent ones last, the rest by hash. A shingle of one document only
   joins nothing, so most documents drop out here; each other one makes a region of the
   sets that have it in front. Counts behind the order cover all shingles of all documents.
3. *Recursion.* A region whose sets are already linked to each other is done. A small one is
   joined pair by pair. In a larger one, two pivots are chosen from different components,
   all exact distances to them are computed, and each set goes to the Voronoi region of
   the nearer pivot, and to the other's too if the triangle inequality leaves a link across
   open: when its distance there is within twice the radius of the smaller one. Links found
   on the way join components, so that large groups of near copies, which lie within the
   radius of a pivot, take one round and as many comparisons as sets. Pairs are compared only
   where sizes, and what both have from the region's shingle on, allow a link. Regions that
   no pivot splits further are joined pair by pair within windows of size at the end.

All tables are spread by shingle, set or pair. No list of documents or links is collected;
what is broadcast are two bit tables of fixed size (``FILTER_BITS``). They only order and
prune: a collision in them makes a shingle look shared, never the reverse.

Exactness is that of 64-bit hashes of shingles and sets.

Defined results: a null or empty text, or one of white space, has no shingle, links to
nothing and is its own component. Fewer than five words are one shingle, the whole
sequence. Repeated rows are copies; each comes back. A null doc_id takes part, and its
component is the smallest id that is not null, or null. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewake.llm.common import (
    U64, Batches, find_words, hash_windows, hash_words, lists, lower_ascii, map_arrow, mix,
    packed, partitions, pieces, row_key, save, ship, text_bytes,
)
from namewake.llm.components import components, near_labels
from namewake.llm.ranges import with_copy
from namewake.operators.joins import lookup_join

SHINGLE, PERCENT = 5, 80
FILTER_BITS = 27
#: Shingles of more documents than this count as frequent and come last in the order.
FREQUENT = 32
LEAF, LEVELS = 12, 2
_FLUSH = 1 << 20


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a piece."""
    data, offs = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = find_words(data, offs)
    words = hash_words(data, starts, ends)
    runs = hash_windows(words, shingle)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= shingle:
            own = np.sort(runs[a : b - shingle + 1])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
        else:
            out.append(hash_windows(words[a:b], b - a) if b > a else np.empty(0, U64))
    return out


def _flush(sets: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Shingles by bucket: 32 bits of each, those seen once apart from those with a count."""
    keys, counts = np.unique(np.concatenate(sets), return_counts=True)
    low = ((keys >> U64(32 - bits)) & U64(0xFFFFFFFF)).astype("<u4")
    edges = np.searchsorted(keys >> U64(64 - bits), np.arange((1 << bits) + 1, dtype=U64))
    cols: tuple[list, ...] = ([], [], [], [])
    for b in np.flatnonzero(np.diff(edges)).tolist():
        k, c = low[edges[b] : edges[b + 1]], counts[edges[b] : edges[b + 1]]
        for col, v in zip(cols, (b, k[c == 1].tobytes(), k[c > 1].tobytes(),
                                 np.minimum(c[c > 1], 255).astype(np.uint8).tobytes())):
            col.append(v)
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
        names=["bucket", "once", "more", "counts"],
    )


def _shingle_counts(bits: int):
    def run(batches: Batches) -> Batches:
        held, size = [], 0
        for batch in batches:
            texts = batch.column(0)
            for lo, hi in pieces(texts):
                for s in shingle_sets(texts.slice(lo, hi - lo)):
                    if len(s):
                        held.append(s)
                        size += len(s)
                if size >= _FLUSH:
                    yield _flush(held, bits)
                    held, size = [], 0
        if held:
            yield _flush(held, bits)

    return run


def _bucket_bits(bits: int, filter_bits: int):
    """A bucket's slices of two bit tables: shingles of two documents or more; frequent ones."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        for once, more, c in zip(*(table.column(i).to_pylist() for i in (1, 2, 3))):
            keys += [np.frombuffer(once, "<u4"), np.frombuffer(more, "<u4")]
            counts += [np.ones(len(once) // 4, np.int64), np.frombuffer(c, np.uint8).astype(np.int64)]
        k, c = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(k, kind="stable")
        k, c = k[order], c[order]
        at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        k, c = k[at], np.add.reduceat(c, at)
        slots = k >> np.uint32(32 - (filter_bits - bits))
        out = []
        for least in (2, FREQUENT + 1):
            flags = np.zeros(1 << (filter_bits - bits), bool)
            flags[slots[c >= least]] = True
            out.append(pa.array([np.packbits(flags).tobytes()], pa.binary()))
        return pa.table([table.column(0).slice(0, 1).combine_chunks(), *out],
                        names=["bucket", "shared", "frequent"])

    return run


def shingle_classes(docs: DataFrame, filter_bits: int) -> tuple[Broadcast, Broadcast]:
    """Bit tables, by the first bits of a shingle's hash, over all shingles of all documents."""
    spark = docs.sparkSession
    bits = min(filter_bits - 3, max(8, (8 * partitions(spark)).bit_length()))
    rows = map_arrow(
        docs.select("text"), _shingle_counts(bits),
        "bucket int, once binary, more binary, counts binary",
    )
    slices = rows.groupBy("bucket").applyInArrow(
        _bucket_bits(bits, filter_bits), "bucket int, shared binary, frequent binary"
    )
    none = bytes(1 << (filter_bits - bits - 3))
    # As many bytes as the tables have, however many documents.
    rows = {r["bucket"]: (bytes(r["shared"]), bytes(r["frequent"])) for r in slices.collect()}
    tables = [b"".join(rows.get(b, (none, none))[i] for b in range(1 << bits)) for i in range(2)]
    return tuple(spark.sparkContext.broadcast(t) for t in tables)


def _points(shared: Broadcast, frequent: Broadcast, filter_bits: int, percent: int):
    def run(batches: Batches) -> Batches:
        tables = [np.frombuffer(b.value, np.uint8) for b in (shared, frequent)]

        def flags(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
            return (table[slots >> U64(3)] >> (U64(7) - (slots & U64(7))).astype(np.uint8)) & 1

        none = np.empty(0, np.int64)
        for batch in batches:
            ids, texts = batch.columns
            for lo, hi in pieces(texts):
                n, sids, alone, posts, sets = [], [], [], [], []
                for s in shingle_sets(texts.slice(lo, hi - lo)):
                    n.append(len(s))
                    total = np.add.reduce(mix(s ^ U64(0x5851F42D4C957F2D)), dtype=U64)
                    sids.append(mix(np.array([total + U64(len(s))], U64))[0])
                    slots = s >> U64(64 - filter_bits)
                    first, last = flags(tables[0], slots), flags(tables[1], slots)
                    front = len(s) - (percent * len(s) + 99) // 100 + 1
                    alone.append(len(s) - int(first.sum()))
                    open_ = front - alone[-1]
                    if len(s) and open_ > 0:
                        mine = s[first == 1]
                        mine = mine[np.argsort(last[first == 1], kind="stable")][:open_]
                        posts.append(mine.astype(np.int64))
                        sets.append(s.astype("<u8").tobytes())
                    else:
                        posts.append(none)
                        sets.append(None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array(np.array(sids, U64).astype(np.int64)), pa.array(alone, pa.int64()),
                     lists(posts, pa.int64()), pa.array(sets, pa.binary())],
                    names=["own", "n", "sid", "alone", "front", "shingles"],
                )

    return run


def _overlaps(batches: Batches) -> Batches:
    for batch in batches:
        a, b, sa, sb = batch.columns
        both, either = [], []
        for x, y in zip(sa, sb):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            both.append(len(np.intersect1d(x, y, assume_unique=True)))
            either.append(len(x) + len(y) - both[-1])
        yield pa.RecordBatch.from_arrays(
            [a, b, pa.array(both, pa.int64()), pa.array(either, pa.int64())],
            names=["a", "b", "both", "either"],
        )


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact sizes of intersection and union for pairs of sets (a, b)."""
    with_a = pairs.join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("sa")), "a")
    with_b = with_a.join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("sb")), "b")
    return save(
        map_arrow(with_b.select("a", "b", "sa", "sb"), _overlaps,
                  "a bigint, b bigint, both bigint, either bigint"),
        "distances",
    )


def _pairs_within(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of a region's sets in different components that may still link.

    Two sets that meet first at the region's shingle have no more in common than what either
    has from there on (``rest``); pairs that met before are found in that earlier region.
    """
    x, y = (
        members.select("region", F.col("sid").alias(s), F.col("n").alias(f"n{s}"),
                       F.col("rest").alias(f"r{s}"), F.col("comp").alias(f"c{s}"))
        for s in "ab"
    )
    both = F.least("ra", "rb")
    enough = 100 * both >= percent * (F.col("na") + F.col("nb") - both)
    met = x.join(y, "region").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & enough)
    return met.select("a", "b").distinct()


def _size_windows(members: DataFrame, percent: int) -> DataFrame:
    """Regions cut into windows of size; sets that can link share one."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    windows = F.explode(F.array(band, band + 1)).alias("band")
    cut = members.select("region", "sid", "n", "rest", "comp", windows)
    return cut.withColumn("region", F.xxhash64("region", "band")).drop("band")


def _different(regions: DataFrame) -> DataFrame:
    """One of all regions with the same members, of those with two members or more.

    Copies share dozens of shingles, and pivots that part nothing give equal regions twice.
    The one kept is the first in the order of shingles, where all members have most left.
    """
    alike = [F.bit_xor(F.xxhash64("sid", F.lit(i))).alias(f"x{i}") for i in range(2)]
    told = regions.groupBy("region").agg(
        F.count(F.lit(1)).alias("size"), F.sum("rest").alias("left"), *alike
    ).filter("size > 1")
    first = told.groupBy("size", "x0", "x1").agg(F.max(F.struct("left", "region")).alias("best"))
    return regions.join(first.select(F.col("best.region").alias("region")), "region")


def _linked(links: DataFrame | None, regions: DataFrame) -> DataFrame:
    """Members (region, sid, n, rest, own) with their components."""
    if links is None:
        return regions.withColumn("comp", F.col("sid"))
    own = regions.join(links, F.col("sid") == F.col("node"), "left")
    return own.withColumn("comp", F.coalesce("comp", "sid")).drop("node")


def similar_sets(points: DataFrame, percent: int) -> DataFrame | None:
    """(node, comp) for sets linked to another set; None where there are none."""
    own = points.filter(F.col("shingles").isNotNull())
    sets = save(own.groupBy("sid").agg(
        F.first("n").alias("n"), F.first("alone").alias("alone"), F.first("front").alias("front"),
        F.first("shingles").alias("shingles"),
    ), "sets")
    fronts = sets.select("sid", "n", "alone", F.posexplode("front").alias("at", "region")).select(
        "region", "sid", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("rest"),
        (F.col("alone") / F.col("n")).alias("own"),
    )
    regions = save(_different(fronts), "regions")
    links, found = None, None
    for level in range(LEVELS + 1):
        members = _linked(links, regions)
        # One pivot with few shingles of its own, in the midst of the others; one of any component.
        central = F.struct("own", F.xxhash64("sid", F.lit(level)).alias("h"), "sid")
        other = F.struct(F.xxhash64("comp", F.lit(level)).alias("c"), F.xxhash64("sid", F.lit(level)).alias("h"), "sid")
        state = members.groupBy("region").agg(
            F.count(F.lit(1)).alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
            F.min(central).alias("p"), F.max(other).alias("q"),
        ).filter("c0 <> c1").select(
            "region", "size", F.col("p.sid").alias("p"), F.col("q.sid").alias("q")
        )
        members = save(members.join(state, "region"), "members")
        if members.isEmpty():
            break
        small = F.col("size") <= LEAF
        if level == LEVELS:
            pairs = _pairs_within(_size_windows(members, percent), percent)
        else:
            to_pivot = members.filter(~small).select("sid", F.explode(F.array("p", "q")).alias("to"))
            pairs = _pairs_within(members.filter(small), percent).unionByName(
                to_pivot.filter("sid <> to").select(
                    F.least("sid", "to").alias("a"), F.greatest("sid", "to").alias("b")
                )
            ).distinct()
        compared = _compare(pairs, sets)
        new = compared.filter(100 * F.col("both") >= percent * F.col("either")).select(
            F.col("a").alias("u"), F.col("b").alias("v")
        )
        found = new if found is None else found.unionByName(new)
        if level == LEVELS:
            break
        links = save(near_labels(found), "labels")  # enough to pass over what is linked already
        regions = _voronoi(members.filter(~small), compared, 1 - percent / 100)
        regions = save(_different(regions), "regions")
    return None if found is None else components(found)


def _voronoi(members: DataFrame, compared: DataFrame, radius: float) -> DataFrame:
    """The regions of both pivots, each with its boundary sets."""
    gap = 1 - F.col("both") / F.col("either")
    away = compared.select("a", "b", gap.alias("d"))
    away = away.unionByName(away.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    rows = members.select("region", "sid", "n", "rest", "own", F.explode(F.array_distinct(F.array("p", "q"))).alias("pivot"))
    far = rows.join(
        away, (F.col("sid") == F.col("a")) & (F.col("pivot") == F.col("b")), "left"
    ).withColumn("d", F.coalesce("d", F.lit(0.0)))  # none for the pivot itself
    nearest = F.min("d").over(Window.partitionBy("region", "sid"))
    reach = F.col("nearest") + 2 * radius + 1e-9
    near = far.withColumn("nearest", nearest).filter(F.col("d") <= reach)
    return near.select(F.xxhash64("region", "pivot").alias("region"), "sid", "n", "rest", "own")


def _classes(docs: DataFrame, percent: int, filter_bits: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, rk (of the text), n, comp, null without shingles."""
    ship(docs.sparkSession)
    shared, frequent = shingle_classes(docs, filter_bits)
    read = docs.select(F.struct("doc_id", row_key("text").alias("rk")).alias("own"), "text")
    points = save(
        map_arrow(read, _points(shared, frequent, filter_bits, percent),
                  "own struct<doc_id:bigint,rk:bigint>, n bigint, sid bigint, alone bigint, front array<bigint>, shingles binary"),
        "points",
    )
    for table in (shared, frequent):  # workers are used again by later queries
        table.destroy()
    links = similar_sets(points, percent)
    rows = points.select("own.doc_id", "own.rk", "n", "sid")
    if links is not None:
        rows = lookup_join(rows, save(links, "components"), "sid", "node", row_id=["doc_id", "rk"])
    else:
        rows = rows.withColumn("comp", F.lit(None).cast("bigint"))
    return rows.withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "sid"))).drop("sid")


def classes(docs: DataFrame, percent: int = PERCENT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    rows = _classes(docs, percent, filter_bits)
    least = rows.filter("comp IS NOT NULL").groupBy(F.col("comp").alias("of")).agg(
        F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("least")
    )
    groups = save(least.filter("size > 1").drop("size"), "groups")
    out = lookup_join(rows, groups, "comp", "of", row_id=["doc_id", "rk"])
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of the smallest id; the columns of ``docs``.

    A document is an id and a text: a row that shares its id with a copy of another text is
    judged by its own text. Of rows without an id the one of the smallest text hash stays if
    its component has no id, and of equal rows one. Texts without shingles all stay.
    """
    rows = _classes(docs, percent, FILTER_BITS)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk")).alias("best")
    groups = rows.filter("comp IS NOT NULL").groupBy(F.col("comp").alias("of")).agg(F.count(F.lit(1)).alias("size"), best)
    groups = groups.filter("size > 1").select(
        "of", F.col("best.doc_id").alias("best_id"), F.col("best.rk").alias("best_rk"), F.lit(True).alias("several")
    )
    met = lookup_join(rows, save(groups, "groups"), "comp", "of", "inner", row_id=["doc_id", "rk"])
    same = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("rk") == F.col("best_rk"))
    gone = met.filter(~same).select(_name(F.col("doc_id"), F.col("rk")).alias("__gone")).distinct()
    own = packed(docs, F.col("doc_id").alias("__id"), row_key("text").alias("__rk")).withColumn(
        "__name", _name(F.col("__id"), F.col("__rk"))
    )
    kept = lookup_join(own, save(gone, "copies"), "__name", "__gone", "left_anti", row_id=["__name"])
    if not met.filter(same).groupBy("doc_id", "rk").count().filter("count > 1").isEmpty():
        several = met.filter(same).select(_name(F.col("doc_id"), F.col("rk")).alias("__same")).distinct()
        numbered = with_copy(kept, ["__id", "__rk"])
        met = lookup_join(numbered, save(several.withColumn("__one", F.lit(True)), "kept"), "__name", "__same", "left", row_id=["__name", "__copy"])
        kept = met.filter("__one IS NULL OR __copy = 0")
    out = {c: F.col(f"__row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("__text")}
    return kept.select(*[out[c].alias(c) for c in docs.columns])


def _name(doc_id: Column, rk: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), rk.cast("string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
