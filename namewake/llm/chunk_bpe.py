"""Operator 9: BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last bytes cuts texts into chunks, so that a passage that several
documents share is cut alike in all of them, wherever it begins. Each chunk is encoded once
in a worker process and then reused by every document that has it.

A chunk encoded alone may be wrong at its edges, where a word is cut. So of a chunk only
the tokens between its first and its last white space are kept, and every join is repaired:
the stretch around it is encoded anew, and grows, over whole chunks where need be, until
both its ends fall on white space. There both encodings agree exactly, since the tokenizer
never joins text across white space. The result is the library's, token by token.

Reuse is per worker process and bounded (``KEEP_CHUNKS``); documents do not move, so the
operator has no shuffle and needs no more memory for more documents.

Defined results: null and empty texts have no ids and decode to the empty text. A text
without white space is one repair stretch. Repeated rows come back as often as they went in.
Other columns are passed on by ``encode``, except those it makes itself, which it replaces.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import (
    Batches, SPACES, U64, _BASE, _power, map_arrow, mix, packed, pieces, text_bytes, with_row,
)
from namewake.llm.words_bpe import encoder, library, tokenizer_path

WINDOW, CHUNK_BYTES = 24, 256
KEEP_CHUNKS = 100_000


def cuts(data: np.ndarray, mean: int = CHUNK_BYTES) -> np.ndarray:
    """Where chunks begin: after each window of bytes whose hash says so."""
    if len(data) <= WINDOW:
        return np.empty(0, np.int64)
    run = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * _power(_BASE, len(data)), out=run[1:])
    back = _power(pow(_BASE, -1, 1 << 64), len(data))
    windows = mix((run[WINDOW:] - run[:-WINDOW]) * back[: len(data) - WINDOW + 1])
    at = np.flatnonzero(windows % U64(mean) == 0) + WINDOW
    at = at[at < len(data)]
    return at[(data[at] & 0xC0) != 0x80]  # not inside a character


_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")


def split_chunk(chunk: bytes) -> tuple[bytes, bytes, bytes] | None:
    """The cut words at both edges and what is between white space; None without any."""
    first = _BLANK.search(chunk)
    if not first:
        return None
    last = len(chunk) - len(chunk.split()[-1]) if chunk[-1] not in SPACES else len(chunk)
    return chunk[: first.start()], chunk[first.start() : last], chunk[last:]


class ChunkEncoder:
    """Ids of texts as little-endian 16-bit values, chunk by chunk."""

    def __init__(self, path: str):
        self.words = encoder(path)
        self.known: dict[bytes, tuple[bytes, bytes, bytes] | None] = {}

    def encode(self, data: np.ndarray, offs: np.ndarray) -> list[bytes]:
        """Ids of the texts that lie in ``data`` end to end, from ``offs`` on."""
        raw, known = data.tobytes(), self.known
        edges = np.unique(np.concatenate([cuts(data), offs])).tolist()
        at = np.searchsorted(edges, offs).tolist()
        chunks = [raw[a:b] for a, b in zip(edges, edges[1:])]
        if len(known) > KEEP_CHUNKS:
            known.clear()
        new = [(c, split_chunk(c)) for c in set(chunks).difference(known)]
        inner = self.words.encode([s[1].decode() for _, s in new if s])
        coded = iter(inner)
        for c, s in new:
            known[c] = s and (s[0], next(coded), s[2])
        # Joins: the cut words around every edge, up to white space on both sides.
        plans, joins = [], {}
        for lo, hi in zip(at, at[1:]):
            plan, open_ = [], b""
            for c in chunks[lo:hi]:
                s = known[c]
                if s is None:
                    open_ += c
                    continue
                if joined := open_ + s[0]:
                    plan.append((joined, b""))
                    joins[joined] = b""
                plan.append((b"", s[1]))
                open_ = s[2]
            if open_:
                plan.append((open_, b""))
                joins[open_] = b""
            plans.append(plan)
        joins = dict(zip(joins, self.words.encode([j.decode() for j in joins])))
        return [b"".join([joins[j] if j else ids for j, ids in plan]) for plan in plans]


@cache
def _chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


@cache
def _token_texts(path: str) -> list[bytes]:
    tokenizer = library(path)
    size = max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1
    return [(tokenizer.id_to_token(i) or "").encode() for i in range(size)]


def decode(ids: list[int], path: str) -> str:
    """What the library's decode gives, special tokens kept.

    Without a decoder in the file that is the tokens with blanks between them.
    """
    tokenizer = library(path)
    if tokenizer.decoder is not None:
        return tokenizer.decode(ids, skip_special_tokens=False)
    return b" ".join([_token_texts(path)[i] for i in ids]).decode()


def _encode(path: str, digests: bool):
    def run(batches: Batches) -> Batches:
        path_ = path or tokenizer_path()
        chunked, decimal = _chunk_encoder(path_), [b"%d" % i for i in range(1 << 16)]
        for batch in batches:
            rows, texts = batch.columns
            for lo, hi in pieces(texts):
                data, offs = text_bytes(texts.slice(lo, hi - lo))
                coded = chunked.encode(data, offs)
                n = pa.array([len(c) // 2 for c in coded], pa.int64())
                out = [rows.slice(lo, hi - lo), n]
                if digests:
                    shas = ([], [])
                    for c in coded:
                        ids = np.frombuffer(c, "<u2").tolist()
                        shas[0].append(hashlib.sha256(b" ".join([decimal[i] for i in ids])).hexdigest())
                        shas[1].append(hashlib.sha256(decode(ids, path_).encode()).hexdigest())
                    out += [pa.array(s, pa.string()) for s in shas]
                    names = ["__row", "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    out.append(pa.array(coded, pa.binary()))
                    names = ["__row", "n_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def _run(docs: DataFrame, path: str, digests: bool) -> DataFrame:
    made = ["ids_sha256 string", "decoded_sha256 string"] if digests else ["ids binary"]
    own = {m.split()[0] for m in made} | {"n_tokens"}
    rest = [c for c in docs.columns if c not in own | {"text"}]
    # A struct keeps whatever other columns there are.
    rows = packed(docs).select("__row", "__text")
    coded = map_arrow(rows, _encode(path, digests), with_row("n_tokens bigint, " + ", ".join(made), rows))
    return coded.select(
        *[F.col(f"__row.`{c}`").alias(c) for c in rest],
        *["n_tokens", *[m.split()[0] for m in made]],
    )


def encode(docs: DataFrame, path: str = "") -> DataFrame:
    """Documents with n_tokens and ``ids`` (little-endian 16-bit) in place of the text."""
    return _run(docs, path, digests=False)


def encode_digests(docs: DataFrame, path: str = "") -> DataFrame:
    """Documents with n_tokens and digests of the ids and of the decoded text."""
    return _run(docs, path, digests=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_digests(docs)
