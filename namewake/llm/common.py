"""What several operators of this subpackage share: shared tables, Arrow batches, hashed words."""

from __future__ import annotations

import ctypes
import io
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewake.scratch import shared_folder

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = b" \t\n\x0b\x0c\r"

#: Bytes of text worked on at once inside a task. A longer text is worked on alone.
PIECE_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_shipped: set[str] = set()


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, packed = Path(__file__).resolve().parents[2], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted((root / "namewake").rglob("*.py")):
            z.write(p, p.relative_to(root))
    path = Path(tempfile.mkdtemp(prefix="namewake-ship-"), "namewake_package.zip")
    path.write_bytes(packed.getvalue())
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


Batches = Iterator[pa.RecordBatch]

#: A worker gives memory back at most this often while it works, in seconds, and at the end.
GIVE_BACK_S = 0.2


def give_back() -> None:
    """Return memory that was freed to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library
        trim(0)


def giving_back(fn: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The same function; an executor's other workers and tasks get what it has freed."""

    def run(batches: Batches) -> Batches:
        last = time.monotonic()
        for out in fn(batches):
            yield out
            del out
            if time.monotonic() - last > GIVE_BACK_S:
                give_back()
                last = time.monotonic()
        give_back()

    return run


def map_arrow(df: DataFrame, fn: Callable[[Batches], Batches], schema: str | T.StructType) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(giving_back(fn), schema)


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """``__text``, ``__row`` with all other columns, whatever their names, and ``more``."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    row = F.struct(F.lit(True).alias("__row"), *rest)  # never empty
    return docs.select(F.col("text").alias("__text"), row.alias("__row"), *more)


def with_row(schema: str, rows: DataFrame) -> T.StructType:
    """A schema after ``__row``, which is as in ``rows``."""
    return T.StructType([rows.schema["__row"], *T.StructType.fromDDL(schema).fields])


def unpacked(done: DataFrame, docs: DataFrame) -> DataFrame:
    """``__text`` and ``__row`` as the columns of ``docs``; ``n_chars`` is that of the text."""
    out = {c: F.col(f"__row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("__text")}
    if "n_chars" in out:
        out["n_chars"] = F.length("__text").cast("bigint")
    return done.select(*[out[c].alias(c) for c in docs.columns])


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each."""
    offs = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(texts))
        yield lo, hi
        lo = hi


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins; null is empty."""
    offs = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offs[0] : offs[-1]], (offs - offs[0]).astype(np.int64)


@cache
def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def among(data: np.ndarray, chars: bytes) -> np.ndarray:
    return _table(chars)[data]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def find_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each text's first word."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~among(data, SPACES)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[offs[:-1][offs[:-1] < n]] = False
    after[offs[1:][offs[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        size = max(n, PIECE_BYTES + 1)
        steps = np.full(size, base, U64)
        steps[0] = 1
        out = np.cumprod(steps)
        if n > 4 * PIECE_BYTES:  # too long to keep
            return out
        _powers[base] = out
    return _powers[base][:n]


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, by differences of one running polynomial."""
    run = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * _power(_BASE, len(data)), out=run[1:])
    back = _power(pow(_BASE, -1, 1 << 64), len(data))
    return mix((run[ends] - run[starts]) * back[starts])


def hash_windows(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` words; the last ``k - 1`` positions have none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = out * U64(0xD6E8FEB86659FD93) + words[i : i + n]
    return mix(out + U64(k))


def by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each text's range."""
    run = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=run[1:])
    return np.diff(run[first])


def strings(col: pa.Array) -> list[str]:
    return ["" if x is None else x for x in col.to_pylist()]


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column out of numpy arrays."""
    offs = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offs[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, kind))


def row_key(*columns: str) -> F.Column:
    """Tells rows of one doc_id apart: a hash of the given columns."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])
