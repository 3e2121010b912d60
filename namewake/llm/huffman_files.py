"""Operator 7: token ids in files, packed by a canonical length-limited Huffman code.

1. Every text is encoded once and its ids are kept in the shared folder (16 bits each).
2. The ids are counted over all documents; code lengths of at most 16 bits are found from
   the counts by package-merge, and the codes follow from the lengths alone (canonical).
3. Documents are packed, dealt out by ranges of doc_id, sorted, and written as segments.

Files are parquet: a codebook (id, bits) and segments, each a row with its place in the
order and a self-contained binary of whole documents (``MAGIC``, layout in ``Segment``). A
document's codes begin at a byte, and every ``BLOCK`` ids there is a checkpoint, the bit
offset of the next code. Blocks are independent: a reader decodes any of them, or all of a
segment side by side, with one table look-up of 16 bits for each id.

Counts come to one row for each id and task; what the driver gets is bounded by the
vocabulary, and by the number of ranges for their totals. A segment ends at ``SEGMENT_IDS``
ids, or after the one document that is longer.

Defined results: null and empty texts are documents with only the end id. Order is
ascending doc_id, null first, equal ids by their packed bytes; repeated rows are written
as often as they occur. An empty table gives no segments. Other columns are not written.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import Batches, map_arrow, partitions, pieces, save, text_bytes
from namewake.llm.word_arrays import array_encoder, binaries, flat, with_end
from namewake.llm.words_bpe import tokenizer_path
from namewake.scratch import shared_folder

MAX_BITS, BLOCK, SEGMENT_IDS, END_ID = 16, 1024, 1 << 20, 1
MAGIC = b"NWHF0001"


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits by package-merge; 0 where not counted."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} ids do not fit codes of {most} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(most):
        both = np.concatenate([weights, packages])
        leaf = np.arange(len(both)) < len(weights)
        by = np.argsort(both, kind="stable")
        levels.append(leaf[by])
        both = both[by]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    need, out = 2 * len(used) - 2, np.zeros(len(used), np.uint8)
    for leaf in reversed(levels):
        leaves = int(leaf[:need].sum())
        out[:leaves] += 1
        need = 2 * (need - leaves)
    lengths[order] = out
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by (length, id), as many bits as the length says."""
    codes = np.zeros(len(lengths), np.uint32)
    order = [i for i in np.lexsort((np.arange(len(lengths)), lengths)).tolist() if lengths[i]]
    code, bits = 0, 0
    for i in order:
        code <<= int(lengths[i]) - bits
        bits = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every 16 bits: the id whose code they begin with, and its length."""
    ids, bits = np.zeros(1 << MAX_BITS, np.uint16), np.zeros(1 << MAX_BITS, np.uint8)
    used = np.flatnonzero(lengths)
    codes = canonical_codes(lengths)
    begin = codes[used].astype(np.int64) << (MAX_BITS - lengths[used].astype(np.int64))
    order = np.argsort(begin)
    used, spans = used[order], 1 << (MAX_BITS - lengths[used[order]].astype(np.int64))
    ids[: spans.sum()] = np.repeat(used, spans)
    bits[: spans.sum()] = np.repeat(lengths[used], spans)
    return ids, bits


def pack(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    """Codes of documents end to end, each from a byte on: bytes, byte offsets, checkpoints.

    Checkpoints are bit offsets within the document, one before every ``BLOCK`` ids, end to end.
    """
    first = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=first[1:])
    bits = lengths[ids].astype(np.int64)
    run = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(bits, out=run[1:])
    begin = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum((np.diff(run[first]) + 7) // 8, out=begin[1:])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    within = run[:-1] - run[first[:-1]][doc]
    at = within + 8 * begin[:-1][doc]
    word, shift = at >> 6, 64 - (at & 63) - bits
    value = codes[ids].astype(np.uint64)
    out = np.zeros((int(begin[-1]) + 7) // 8 + 1, np.uint64)
    fits = np.where(shift >= 0, value << np.maximum(shift, 0).astype(np.uint64),
                    value >> np.maximum(-shift, 0).astype(np.uint64))
    if len(ids):
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[heads]] = np.bitwise_or.reduceat(fits, heads)
        over = np.flatnonzero(shift < 0)
        out[word[over] + 1] |= value[over] << (64 + shift[over]).astype(np.uint64)
    marks = within[(np.arange(len(ids)) - first[:-1][doc]) % BLOCK == 0].astype("<u4")
    return out.astype(">u8").view(np.uint8)[: begin[-1]], begin, marks


def unpack(data: bytes, at: np.ndarray, counts: np.ndarray, table) -> np.ndarray:
    """Ids, end to end, of blocks that begin at bits ``at`` and hold ``counts`` ids.

    All blocks are decoded side by side, the long ones go on where short ones have ended.
    """
    ids, bits = table
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    order = np.argsort(-counts, kind="stable")
    pos, left = at[order].astype(np.int64), counts[order]
    out = np.zeros(int(counts.sum()), np.uint16)
    to = (np.cumsum(counts) - counts)[order]
    longest = int(left[0]) if len(left) else 0
    for i, live in enumerate(np.searchsorted(-left, -np.arange(1, longest + 1), "right").tolist()):
        p = pos[:live]
        byte = p >> 3
        window = (raw[byte] << 16) | (raw[byte + 1] << 8) | raw[byte + 2]
        window = (window >> (8 - (p & 7)).astype(np.uint32)) & 0xFFFF
        out[to[:live] + i] = ids[window]
        pos[:live] = p + bits[window]
    return out


@dataclass
class Segment:
    """Documents in order. Layout, little-endian: magic, documents u4, checkpoints u4, first
    start u8; then for all documents id i8, null u1, ids u4, bytes u4; checkpoints u4; codes.
    """

    start: int
    doc_ids: np.ndarray
    nulls: np.ndarray
    sizes: np.ndarray
    byte_sizes: np.ndarray
    marks: np.ndarray
    codes: bytes

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.marks)], "<u4").tobytes()
        cols = [(self.doc_ids, "<i8"), (self.nulls, "u1"), (self.sizes, "<u4"),
                (self.byte_sizes, "<u4"), (self.marks, "<u4")]
        body = b"".join(np.asarray(c).astype(k).tobytes() for c, k in cols)
        return MAGIC + head + np.array([self.start], "<u8").tobytes() + body + self.codes

    @classmethod
    def from_bytes(cls, raw: bytes) -> Segment:
        if raw[:8] != MAGIC:
            raise ValueError("not a segment of this format")
        n, m = np.frombuffer(raw, "<u4", 2, 8).tolist()
        start, at, cols = int(np.frombuffer(raw, "<u8", 1, 16)[0]), 24, []
        for count, kind in ((n, "<i8"), (n, "u1"), (n, "<u4"), (n, "<u4"), (m, "<u4")):
            cols.append(np.frombuffer(raw, kind, count, at))
            at += count * np.dtype(kind).itemsize
        return cls(start, *cols, raw[at:])

    def ids(self, table) -> np.ndarray:
        """All documents' ids, end to end."""
        blocks = -(-self.sizes.astype(np.int64) // BLOCK)
        base = np.zeros(len(self.sizes), np.int64)
        np.cumsum(self.byte_sizes[:-1], out=base[1:])
        at = self.marks.astype(np.int64) + 8 * np.repeat(base, blocks)
        counts = np.full(len(at), BLOCK, np.int64)
        last = np.cumsum(blocks) - 1
        counts[last] = self.sizes - (blocks - 1) * BLOCK
        return unpack(self.codes, at, counts, table)


def _tokenize(path: str, bounds: list[int], end_id: int):
    def run(batches: Batches) -> Batches:
        coder = array_encoder(path or tokenizer_path())
        for batch in batches:
            ids, texts = batch.columns
            for lo, hi in pieces(texts):
                coded, n = with_end(*coder.encode(*text_bytes(texts.slice(lo, hi - lo))), end_id)
                own = ids.slice(lo, hi - lo)
                part = np.searchsorted(bounds, own.fill_null(0).to_numpy(), "right") + 1
                part[own.is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(part, pa.int32()), pa.array(n), binaries(coded, n)],
                    names=["doc_id", "part", "n", "ids"],
                )

    return run


def _count_ids(batches: Batches) -> Batches:
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        counts += np.bincount(flat(batch.column(0), "<u2"), minlength=1 << 16)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(counts[used])], names=["id", "count"]
    )


def _pack(lengths: bytes):
    def run(batches: Batches) -> Batches:
        bits = np.frombuffer(lengths, np.uint8)
        codes = canonical_codes(bits)
        for batch in batches:
            for lo, hi in pieces(batch.column(3)):
                ids, part, n, raw = batch.slice(lo, hi - lo).columns
                sizes = n.to_numpy()
                data, begin, marks = pack(flat(raw, "<u2"), sizes, bits, codes)
                yield pa.RecordBatch.from_arrays(
                    [ids, part, n, binaries(marks, -(-sizes // BLOCK)), binaries(data, np.diff(begin))],
                    names=["doc_id", "part", "n", "marks", "codes"],
                )

    return run


def _segments(starts: dict[int, int]):
    """Rows sorted by (part, doc_id) into segments; a part's first start is known."""

    def run(batches: Batches) -> Batches:
        held, part, start, seq, size = [], None, 0, 0, 0

        def close() -> pa.RecordBatch:
            ids, nulls, n, bytes_, marks, codes = (list(c) for c in zip(*held))
            segment = Segment(
                start, *(np.concatenate(c) for c in (ids, nulls, n, bytes_, marks)), b"".join(c.tobytes() for c in codes)
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([segment.to_bytes()], pa.binary())],
                names=["part", "seq", "start", "segment"],
            )

        for batch in batches:
            parts, sizes = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
            for lo, end in zip(edges, edges[1:]):
                while lo < end:
                    if held and parts[lo] != part:
                        yield close()
                        held, size = [], 0
                    if parts[lo] != part:
                        part, seq, start = int(parts[lo]), 0, starts[int(parts[lo])]
                    fits = int(np.searchsorted(np.cumsum(sizes[lo:end]), SEGMENT_IDS - size, "right"))
                    if not fits and held:
                        yield close()
                        start, seq, held, size = start + size, seq + 1, [], 0
                        continue
                    hi = lo + max(fits, 1)
                    ids, _, n, marks, codes = batch.slice(lo, hi - lo).columns
                    held.append((
                        ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), n.to_numpy(),
                        pc.binary_length(codes).to_numpy(), flat(marks, "<u4"), flat(codes, "u1"),
                    ))
                    size += int(sizes[lo:hi].sum())
                    lo = hi
        if held:
            yield close()

    return run


def write_ids(docs: DataFrame, folder: str, path: str = "", end_id: int = END_ID) -> None:
    """Encode all of ``docs`` (doc_id, text) and write ``folder``/codebook and /segments."""
    spark = docs.sparkSession
    ranges = 4 * partitions(spark)
    quantiles = docs.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.2 / ranges)
    bounds = sorted({int(q) for q in quantiles})
    coded = save(
        map_arrow(docs.select("doc_id", "text"), _tokenize(path, bounds, end_id),
                  "doc_id bigint, part int, n bigint, ids binary"),
        "token-ids",
    )
    counts = np.zeros(1 << 16, np.int64)
    counted = map_arrow(coded.select("ids"), _count_ids, "id int, count bigint")
    for r in counted.groupBy("id").agg(F.sum("count").alias("n")).collect():  # the vocabulary at most
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    book = [(i, int(lengths[i])) for i in np.flatnonzero(lengths).tolist()]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")
    starts, at = {}, 0
    for r in coded.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one per range
        starts[r["part"]], at = at, at + r["n"]
    packed = map_arrow(coded, _pack(lengths.tobytes()),
                       "doc_id bigint, part int, n bigint, marks binary, codes binary")
    dealt = packed.repartition(ranges, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "codes")
    map_arrow(dealt.select("doc_id", "part", "n", "marks", "codes"), _segments(starts),
              "part int, seq int, start bigint, segment binary").write.option(
        "compression", "uncompressed").parquet(f"{folder}/segments")


def _read(book: list[tuple[int, int]], digests: bool):
    def run(batches: Batches) -> Batches:
        lengths = np.zeros(1 << 16, np.uint8)
        for i, bits in book:
            lengths[i] = bits
        table = decode_table(lengths)
        for batch in batches:
            for raw in batch.column(0):
                segment = Segment.from_bytes(raw.as_buffer().to_pybytes())
                ids, sizes = segment.ids(table), segment.sizes.astype(np.int64)
                ends = np.cumsum(sizes)
                if digests:
                    wide, at = memoryview(ids.astype("<u4").tobytes()), (4 * ends).tolist()
                    sums = [zlib.crc32(wide[a:b]) for a, b in zip([0, *at], at)]
                    last = pa.array(sums, pa.int64())
                else:
                    last = binaries(ids.astype("<u2"), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment.doc_ids, mask=segment.nulls.astype(bool)), pa.array(segment.start + ends - sizes),
                     pa.array(sizes), last],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"],
                )

    return run


def read_ids(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """Documents (doc_id, start, n_tokens, ids or ids_crc32) out of the files alone."""
    book = [(r["id"], r["bits"]) for r in spark.read.schema("id int, bits int").parquet(f"{folder}/codebook").collect()]
    kind = "part int, seq int, start bigint, segment binary"
    segments = spark.read.schema(kind).parquet(f"{folder}/segments").select("segment")
    last = "ids_crc32 bigint" if digests else "ids binary"
    return map_arrow(segments, _read(book, digests), f"doc_id bigint, start bigint, n_tokens bigint, {last}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "huffman")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_ids(spark, folder, digests=True)
