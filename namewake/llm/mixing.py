"""Operator 2: mix sources to target weights, out of fixed-length blocks of words.

1. *Pack.* A source's documents, in order of doc_id, are one stream of words, cut into blocks
   of ``block_words`` (the last is shorter). A document is a stretch of one or more blocks.
2. *Targets.* Sources share all words by weight; none gets more than ``most`` times its own
   size, and what it can't take is shared out again by weight until none is above.
3. *Draw.* A source's slots, as many as its target needs, are dealt to output shards by a
   multinomial draw with a seed of its own. The draw is conditional on the total, so counts
   differ from shard to shard, and the whole mix is on target.
4. *Map.* A slot's number gives an epoch and a place in it, and a keyed permutation of the
   source's block numbers (a Feistel network that walks within range), new for each epoch,
   gives the block. So a block is used as often as any other of its source, or once more;
   the last slot takes just the words that are left to the target.
5. *Join.* Slots and stretches of documents meet by (source, block). Keys are single blocks,
   so a source with a third of all rows is spread like the others.

Positions in the streams are running sums over ranges of (source, doc_id), so that no task
gets a whole source. What the driver gets is one row per range. Sources are told apart by
their rows in a table; weights by rank are given in one task over distinct sources.

Defined results: null is a source of its own, last in order. Null and empty texts have size
0 and take nothing. Rows alike in doc_id, source and text are documents of their own, told
apart by a number; each is mixed and comes back. An empty table gives an empty mix, and so do sources without words. Other columns are kept by
``mixed_documents``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewake.llm.common import Batches, map_arrow, mix, packed, partitions, row_key, save, unpacked, with_row
from namewake.llm.ranges import with_copy

BLOCK_WORDS, MOST, SHARDS, SEED = 64, 3, 64, 20240607
#: Weights by rank of the source, repeating.
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"
_SLOTS_AT_ONCE = 1 << 16
_COPIES = 4096


def feistel(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A permutation of range(size), keyed; each index is mapped on its own."""
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            f = mix(right + np.uint64((key + r * 0x9E3779B97F4A7C15) % (1 << 64)))
            left, right = right, left ^ (f & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _source_key(source: Column) -> Column:
    """Equal for equal sources, and for nulls; in code point order with null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def sizes_of(docs: DataFrame) -> DataFrame:
    """All rows: doc_id, rk, copy, skey, size; rows alike in all else are told apart by ``copy``."""
    n = partitions(docs.sparkSession)
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(
        "doc_id", row_key("source", "text").alias("rk"), _source_key(F.col("source")).alias("skey"), words.alias("size")
    )
    times = save(rows.groupBy("doc_id", "rk", "skey", "size").agg(F.count(F.lit(1)).alias("times")), "sizes")
    several = times.filter("times > 1")
    if several.isEmpty():
        return times.select("doc_id", "rk", F.lit(0).cast("bigint").alias("copy"), "skey", "size")
    # In lots that are dealt to tasks, since one row may be there any number of times.
    lots = several.withColumn("lot", F.explode(F.expr(f"sequence(0, (times - 1) div {_COPIES})")))
    lots = lots.repartition(n, "doc_id", "rk", "lot").withColumn(
        "copy", F.explode(F.expr(f"sequence(lot * {_COPIES}, least(times, (lot + 1) * {_COPIES}) - 1)"))
    )
    single = times.filter("times = 1").withColumn("copy", F.lit(0).cast("bigint"))
    columns = ["doc_id", "rk", "copy", "skey", "size"]
    return save(single.select(*columns).unionByName(lots.select(*columns)), "rows")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """skey, source_size, target for every source."""
    per = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("skey")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    table = save(per.withColumn("weight", weight), "sources")
    room = most * F.col("source_size").cast("double")
    all_words, all_weights = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (all_words or 0) / (all_weights or 1)
    while True:  # each round fills at least one more source, or is the last
        full = F.lit(level) * F.col("weight") >= room
        taken, left = table.agg(
            F.sum(F.when(full, room).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not left or (all_words - taken) / left <= level * (1 + 1e-12):
            break
        level = (all_words - taken) / left
    return table.select("skey", "source_size", F.least(F.lit(level) * F.col("weight"), room).alias("target"))


def streams(sizes: DataFrame) -> DataFrame:
    """Documents with words, with ``begin``: words of the source's documents before it."""
    spark = sizes.sparkSession
    n = partitions(spark)
    order = ["skey", F.col("doc_id").asc_nulls_first(), "rk", "copy"]
    ranged = sizes.filter("size > 0").repartitionByRange(n, *order).sortWithinPartitions(*order)
    within = save(map_arrow(
        ranged.withColumn("part", F.spark_partition_id()).select("doc_id", "rk", "copy", "skey", "size", "part"),
        _running, "doc_id bigint, rk bigint, copy bigint, skey string, size bigint, part int, before bigint",
    ), "streams")
    # Words of a source in earlier ranges: a range holds many sources or a source many ranges.
    totals = within.groupBy("skey", "part").agg(F.sum("size").alias("total"))
    earlier = F.sum("total").over(Window.partitionBy("skey").orderBy("part")) - F.col("total")
    offsets = totals.select(F.col("skey").alias("of"), F.col("part").alias("in"), earlier.alias("offset"))
    met = within.join(offsets, (F.col("skey") == F.col("of")) & (F.col("part") == F.col("in")))
    return met.select("doc_id", "rk", "copy", "skey", "size", (F.col("before") + F.col("offset")).alias("begin"))


def _running(batches: Batches) -> Batches:
    last, total = None, 0
    for batch in batches:
        before = []
        for key, size in zip(batch.column("skey").to_pylist(), batch.column("size").to_pylist()):
            if key != last:
                last, total = key, 0
            before.append(total)
            total += size
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(before, pa.int64())], names=[*batch.schema.names, "before"]
        )


def _key_of(skey: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{skey}".encode(), digest_size=8).digest(), "little")


def _draw(block: int, shards: int, seed: int):
    """A source's slots by shard, in lots: (skey, size, target, shard, slot, n)."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for skey, size, target in zip(*(c.to_pylist() for c in batch.columns)):
                words = int(round(target))
                slots = _slots(words, size, block, _key_of(skey, seed))
                rng = np.random.Generator(np.random.PCG64(_key_of(skey, seed)))
                counts = rng.multinomial(slots, np.full(shards, 1 / shards))
                rows, slot = [], 0
                for shard, n in enumerate(counts.tolist()):
                    for lo in range(0, n, _SLOTS_AT_ONCE):
                        rows.append((shard, slot + lo, min(_SLOTS_AT_ONCE, n - lo)))
                    slot += n
                if rows:
                    cols = list(zip(*rows))
                    m = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([skey] * m), pa.array([size] * m, pa.int64()), pa.array([words] * m, pa.int64()),
                         *[pa.array(c, pa.int64()) for c in cols]],
                        names=["skey", "size", "words", "shard", "slot", "n"],
                    )

    return run


def _slots(words: int, size: int, block: int, key: int) -> int:
    """How many slots hold ``words`` words, the last one cut."""
    if not words or not size:
        return 0
    blocks, (epochs, rest) = -(-size // block), divmod(words, size)
    if not rest:
        return epochs * blocks
    short = size - (blocks - 1) * block
    at = _place_of_last(blocks, key, epochs)
    full = -(-rest // block)
    if full <= at:
        return epochs * blocks + full
    left = rest - at * block - short
    return epochs * blocks + at + 1 + max(0, -(-left // block))


def _place_of_last(blocks: int, key: int, epoch: int) -> int:
    """Where the permutation puts the last, shorter block: found by running it backwards."""
    half = max(1, ((max(blocks, 2) - 1).bit_length() + 1) // 2)
    mask, x = (1 << half) - 1, blocks - 1
    own = _epoch_key(key, epoch)
    while True:
        left, right = x >> half, x & mask
        for r in reversed(range(4)):
            f = int(mix(np.array([(left + (own + r * 0x9E3779B97F4A7C15)) % (1 << 64)], np.uint64))[0])
            left, right = right ^ (f & mask), left
        x = (left << half) | right
        if x < blocks:
            return x


def _epoch_key(key: int, epoch: int) -> int:
    return (key + epoch * 0xD6E8FEB86659FD93) % (1 << 64)


def _map_slots(block: int, seed: int):
    """Slots to blocks: (skey, shard, slot, epoch, block, words), words the block's share."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for skey, size, words, shard, slot, n in zip(*(c.to_pylist() for c in batch.columns)):
                blocks, key = -(-size // block), _key_of(skey, seed)
                slots = np.arange(slot, slot + n)
                epochs, places = np.divmod(slots, blocks)
                taken, numbers = np.empty(n, np.int64), np.empty(n, np.int64)
                for e in np.unique(epochs).tolist():
                    at = epochs == e
                    numbers[at] = feistel(places[at], blocks, _epoch_key(key, e))
                    full = np.where(numbers[at] == blocks - 1, size - (blocks - 1) * block, block)
                    # Words of this epoch before each slot; the short block comes at one place.
                    last = _place_of_last(blocks, key, e)
                    before = places[at] * block - np.where(places[at] > last, blocks * block - size, 0)
                    taken[at] = np.clip(words - e * size - before, 0, full)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([skey] * n), pa.array(np.full(n, shard)), pa.array(slots), pa.array(epochs),
                     pa.array(numbers), pa.array(taken)],
                    names=["skey", "shard", "slot", "epoch", "block", "words"],
                )

    return run


def plan(
    docs: DataFrame, *, block_words: int = BLOCK_WORDS, most: int = MOST, shards: int = SHARDS,
    weights: tuple[int, ...] = WEIGHTS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes, source targets, and the mix: for every slot the stretches of documents in it.

    The mix has shard, slot, epoch, doc_id, rk, copy, and the words ``lo`` to ``hi`` of the document.
    """
    n = partitions(docs.sparkSession)
    sizes = sizes_of(docs)
    targets = save(source_targets(sizes, weights, most), "targets")
    lots = map_arrow(
        targets.filter("target > 0").select("skey", "source_size", "target").repartition(n, "skey"),
        _draw(block_words, shards, seed),
        "skey string, size bigint, words bigint, shard bigint, slot bigint, n bigint",
    )
    slots = map_arrow(
        lots.repartition(n, "skey", "slot"), _map_slots(block_words, seed),
        "skey string, shard bigint, slot bigint, epoch bigint, block bigint, words bigint",
    ).filter("words > 0")
    first = F.floor(F.col("begin") / block_words)
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    stretches = streams(sizes).select(
        "doc_id", "rk", "copy", F.col("skey").alias("of"), "begin", "size", F.explode(F.sequence(first, last)).alias("in_block")
    )
    # Slots come out of a small table of sources and would be taken for small themselves.
    met = slots.hint("merge").join(stretches, (F.col("skey") == F.col("of")) & (F.col("block") == F.col("in_block")))
    at = F.col("block") * block_words - F.col("begin")
    lo, hi = F.greatest(at, F.lit(0)), F.least(at + F.col("words"), F.col("size"))
    mixed = met.select("shard", "slot", "epoch", "doc_id", "rk", "copy", lo.alias("lo"), hi.alias("hi")).filter("lo < hi")
    return sizes, targets, mixed


def _cut(batches: Batches) -> Batches:
    word = re.compile(WORD)
    for batch in batches:
        rows, texts, spans, sizes = batch.columns
        out = []
        for text, own, size in zip(texts.to_pylist(), spans.to_pylist(), sizes.to_pylist()):
            runs: list[list[int]] = []
            for s in sorted((s["lo"], s["hi"]) for s in own):
                if runs and runs[-1][1] >= s[0]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            if runs != [[0, size]]:
                at = [m.span() for m in word.finditer(text)]
                text = "\n".join(text[at[a][0] : at[b - 1][1]] for a, b in runs)
            out.append(text)
        yield pa.RecordBatch.from_arrays([rows, pa.array(out, pa.string())], names=["__row", "__text"])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row for each document and epoch, with the words it takes.

    Whole documents keep their text, others the text of their stretches, one to a line.
    The columns of ``docs``; a document taken twice comes twice.
    """
    _, _, mixed = plan(docs, **options)
    taken = mixed.groupBy(
        F.col("doc_id").alias("__id"), F.col("rk").alias("__rk"), F.col("copy").alias("__nth"), "epoch"
    ).agg(F.collect_list(F.struct("lo", "hi")).alias("__spans"))
    size = F.regexp_count("text", F.lit(WORD)).cast("bigint")
    own = packed(docs, row_key("source", "text").alias("__own"), size.alias("__size"), F.col("doc_id").alias("__doc"))
    own = with_copy(own, ["__doc", "__own"])
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__rk")) & (F.col("__copy") == F.col("__nth"))
    rows = own.join(taken.hint("merge"), same).select("__row", "__text", "__spans", "__size")
    return unpacked(map_arrow(rows, _cut, with_row("__text string", rows)), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes, targets, mixed = plan(docs)
    taken = mixed.groupBy(
        F.col("doc_id").alias("__id"), F.col("rk").alias("__rk"), F.col("copy").alias("__nth")
    ).agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("rk") == F.col("__rk")) & (F.col("copy") == F.col("__nth"))
    rows = sizes.join(targets.withColumnRenamed("skey", "of"), F.col("skey") == F.col("of")).join(
        taken.hint("merge"), same, "left"
    )
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))
