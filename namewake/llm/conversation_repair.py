"""Operator 12: conversation structure repair, by the auction algorithm for shortest paths.

A conversation should read system?, then user and assistant in turn, ending with the
assistant. Its rows are a path through a lattice: node (i, q) stands for i rows read and
state q of that grammar; arcs delete, keep or rerole a row or insert an empty turn, at whole
costs. The auction algorithm keeps a path from the start and a price at each node, no price
above the cost of an arc plus the price at its head. Where the path's last node is cheaper
than all it could go on to, its price is raised to that and the path contracted; else the
path is extended by the best arc. When the path arrives, every cheapest path has tight
arcs only (price = cost + price at the head). These are traced in order of their letters,
dead ends left out: the first arrival is the least of all cheapest edit strings.

A long conversation is cut into blocks of ``BLOCK`` rows. Prices at the end of a block are
those at the start of the next, so blocks are solved from the last to the first, each with
the prices beyond it as its last arcs. Rows are dealt by ranges of (conversation, turn), so
that one conversation may lie on many tasks. The at most two conversations that reach over
each border give a 4 x 4 matrix of cheapest costs for each piece; these are multiplied up,
which yields prices at the borders, and from these all pieces are solved at once. Repaired
texts are hashed as a stream.

Equal texts of a conversation are found by SHA-256 of role and text, joined with salts.
Texts go through two shuffles: into order, and to their edits by part of that order.

Defined results: a null role or text counts as one space. Null turns come first; rows of one
turn are ordered by a hash of role and text. Rows without a conversation id make up one
conversation, whose id is null. An empty role has no initial and cannot be kept. An empty
table has no conversations. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import map_arrow, partitions, save, ship
from namewake.llm.ranges import PACKED_BYTES, in_order, part_of, stream_sha256
from namewake.operators.joins import lookup_join

BLOCK = 32

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# A row's code: its role's initial in the lower two bits, then its faults.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
BLANK, DUPLICATE, OPEN = 4, 8, 16

# States: nothing yet, after system, after user, after assistant.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = STATES = (0, 1, 2, 3)
#: The state after the one turn by user or assistant that may come next.
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
NAMES = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
#: Cheapest cost of ending in each state, by inserted turns.
ENDING = (0, 2 * INSERT, INSERT, 0)
LEGAL_PAIRS = frozenset({(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)})

FAR = 1 << 60  # no path


def kept_state(q: int, initial: int) -> int | None:
    """The state after keeping a row, if it may stand there."""
    if initial == SYSTEM:
        return AFTER_SYSTEM if q == START else None
    return NEXT[q] if initial in (USER, ASSISTANT) and NEXT[q] == initial + 1 else None


Arc = tuple[str, int, int]  # letter, cost, head


def lattice(codes: bytes, beyond: tuple[int, ...] | None) -> list[list[Arc]]:
    """Arcs by node 4 * row + state, in order of their letters; the last node is the goal.

    ``beyond`` are the prices of the states after the last row, ``FAR`` for none; if it is
    not given, the conversation ends there.
    """
    n = len(codes)
    goal, arcs = 4 * (n + 1), []
    for i, code in enumerate(codes):
        late = TRUNCATED if code & OPEN else 0
        for q in STATES:
            out = [("D", DELETE, 4 * i + 4 + q), ("I", INSERT, 4 * i + NEXT[q])]
            if not code & (BLANK | DUPLICATE):
                kept = kept_state(q, code & 3)
                if kept is not None:
                    out.append(("K", KEEP + late, 4 * i + 4 + kept))
                out.append(("R", REROLE + late, 4 * i + 4 + NEXT[q]))
            arcs.append(out)
    for q in STATES:
        if beyond is not None:
            arcs.append([("", beyond[q], goal)] if beyond[q] < FAR else [])
        else:
            done = [("", 0, goal)] if q in (START, AFTER_ASSISTANT) else []
            arcs.append([*done, ("I", INSERT, 4 * n + NEXT[q])])
    return arcs


def auction(arcs: list[list[Arc]], prices: list[int], origin: int) -> None:
    """Raise ``prices`` until the goal, the last node, is reached from ``origin``."""
    goal, path = len(arcs), [origin]
    while path[-1] != goal:
        i = path[-1]
        best, ahead = FAR, goal
        for _, cost, j in arcs[i]:
            if cost + prices[j] < best:
                best, ahead = cost + prices[j], j
        if prices[i] < best:
            prices[i] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(ahead)


def trace(arcs: list[list[Arc]], prices: list[int], origin: int) -> tuple[str, int]:
    """The least string of letters over tight arcs, and the state before the goal."""
    goal, dead, path, letters = len(arcs), set(), [(origin, 0)], []
    while True:
        i, at = path.pop()
        for at in range(at, len(arcs[i])):
            letter, cost, j = arcs[i][at]
            if prices[i] == cost + prices[j] and j not in dead:
                if j == goal:
                    return "".join(letters), i % 4
                path += [(i, at + 1), (j, 0)]
                letters.append(letter)
                break
        else:
            dead.add(i)
            letters.pop()


Solution = tuple[int, str, int]  # price at the start, edits, state at the end


@lru_cache(1 << 14)
def solve_block(codes: bytes, beyond: tuple[int, ...] | None, origins: tuple[int, ...]) -> tuple[Solution, ...]:
    arcs = lattice(codes, beyond)
    prices = [0] * (len(arcs) + 1)
    for q in origins:
        auction(arcs, prices, q)
    return tuple((prices[q], *trace(arcs, prices, q)) for q in origins)


def solve(codes: bytes, beyond: tuple[int, ...] | None, origins: tuple[int, ...]) -> list[Solution]:
    """Solutions of a whole piece for each state that it may be entered in."""
    blocks = [codes[i : i + BLOCK] for i in range(0, len(codes), BLOCK)]
    solved = []
    for i in range(len(blocks) - 1, -1, -1):
        lowest = min(beyond) if beyond else 0
        rest = tuple(b - lowest for b in beyond) if beyond else None
        found = solve_block(blocks[i], rest, STATES if i else origins)
        solved.append([(price + lowest, edits, q) for price, edits, q in found])
        beyond = tuple(price for price, _, _ in solved[-1])
    solved.reverse()
    out = []
    for n in range(len(origins)):
        price, edits, q = solved[0][n]
        pieces = [edits]
        for later in solved[1:]:
            _, edits, q = later[q]
            pieces.append(edits)
        out.append((price, "".join(pieces), q))
    return out


@lru_cache(1 << 14)
def block_matrix(codes: bytes) -> tuple[tuple[int, ...], ...]:
    """Cheapest costs from each state to each, ``FAR`` where there is no way."""
    systems = any(c & 3 == SYSTEM and not c & (BLANK | DUPLICATE) for c in codes)
    out = [[FAR] * 4 for _ in STATES]
    for q in STATES:
        arcs = lattice(codes, tuple(0 if e == q else FAR for e in STATES))
        ways = {START: [START], AFTER_SYSTEM: [AFTER_SYSTEM] + [START] * systems}.get(q, STATES)
        prices = [0] * (len(arcs) + 1)
        for origin in ways:
            auction(arcs, prices, origin)
            out[origin][q] = prices[origin]
    return tuple(map(tuple, out))


def matrix(codes: bytes) -> list[list[int]]:
    out = None
    for i in range(0, len(codes), BLOCK):
        m = block_matrix(codes[i : i + BLOCK])
        out = m if out is None else times(out, m)
    return out


def times(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[min(FAR, *(a[p][r] + b[r][q] for r in STATES)) for q in STATES] for p in STATES]


# Rows and their codes


def placed_turns(turns: DataFrame) -> DataFrame:
    """Turns in order, with all that their edits depend on beside role and text."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    read = turns.select("conv_id", F.col("turn").cast("bigint"), role.alias("role"), text.alias("text"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    whole = F.concat_ws("\n", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("conv_id").isNull().cast("string"), F.length("role").cast("string"), "role", "text")
    coded = read.withColumns(
        {
            "kind": kind,
            "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
            "open": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
            "same": F.sha2(whole.cast("binary"), 256),
        }
    )
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.xxhash64("role", "text")]
    return save(in_order(coded, by), "repair-turns")


def _codes(placed: DataFrame) -> DataFrame:
    narrow = placed.select("conv_id", "ord", "kind", "blank", "open", "same")
    groups = narrow.groupBy(F.col("same").alias("of")).agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = save(groups.filter("n > 1").drop("n"), "repair-repeated")
    met = lookup_join(narrow, repeated, "same", "of", "left", row_id=["ord"])
    again = ~F.col("blank") & F.coalesce(F.col("ord") != F.col("first"), F.lit(False))
    late = F.col("open") & ~F.col("blank") & ~again
    faults = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(late, OPEN).otherwise(0)
    return met.select("conv_id", "ord", part_of(F.col("ord")).alias("part"), (F.col("kind") + faults).cast("tinyint").alias("code"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation and part of the order: place, codes."""
    held, codes, run = None, bytearray(), None

    def told(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [run, pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv_id", "part", "at", "codes"]
        )

    for batch in batches:
        run, out = batch.schema.field(0).type, []
        for conv, ord_, part, code in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or (conv, part) != held[:2]:
                if held is not None:
                    out.append((*held, bytes(codes)))
                held, codes = (conv, part, ord_), bytearray()
            codes.append(code)
        if out:
            yield told(out)
    if held is not None:
        yield told([(*held, bytes(codes))])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, codes = batch.column("at"), batch.column("codes").to_pylist()
        flat = [[x for row in matrix(c) for x in row] for c in codes]
        yield pa.RecordBatch.from_arrays([at, pa.array(flat, pa.list_(pa.int64()))], ["at", "costs"])


_SOLVED = "part int, at bigint, split boolean, entry int, exit int, cost bigint, audit string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first int, last int"


def _solutions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        convs, out = [], []
        for conv, part, at, codes, beyond, split in zip(*(c.to_pylist() for c in batch.columns)):
            beyond = tuple(beyond) if beyond is not None else None
            row = np.frombuffer(codes, np.uint8)
            counts = [int(np.count_nonzero(row & bit)) for bit in (BLANK, DUPLICATE, OPEN)]
            kinds = (row & 3).tolist()
            illegal = sum(pair not in LEGAL_PAIRS for pair in zip(kinds, kinds[1:]))
            origins = STATES if split else (START,)
            for entry, (price, edits, end) in zip(origins, solve(codes, beyond, origins)):
                cost = price - (beyond[end] if beyond else 0)
                convs.append(conv)
                out.append((part, at, split, entry, end, cost, edits, *counts, illegal, kinds[0], kinds[-1]))
        if not out:
            continue
        kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.int32(), pa.int32()]
        names = [c.split()[0] for c in _SOLVED.split(", ")]
        arrays = [pa.array(convs, batch.schema.field(0).type), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", *names])


def _border_prices(runs: DataFrame) -> tuple[DataFrame, dict[int, object]]:
    """Pieces of conversations on several parts with the prices beyond them.

    At most two pieces for each part of the order come to the driver, sixteen numbers each.
    """
    several = runs.groupBy(F.col("conv_id").alias("of")).count().filter("count > 1").drop("count")
    split = runs.join(F.broadcast(several), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    ids = {r["at"]: r["conv_id"] for r in split.select("at", "conv_id").collect()}
    costs = {
        r["at"]: [r["costs"][i : i + 4] for i in range(0, 16, 4)]
        for r in map_arrow(split.select("at", "codes"), _matrices, "at bigint, costs array<bigint>").collect()
    }
    prices, ahead, conv = [], None, None
    for at in sorted(ids, reverse=True):
        if ahead is None or ids[at] != conv:
            ahead, conv = ENDING, ids[at]
            prices.append((at, None))
        else:
            prices.append((at, list(ahead)))
        ahead = tuple(min(c + p for c, p in zip(row, ahead)) for row in costs[at])
    found = runs.sparkSession.createDataFrame(prices, "border bigint, beyond array<bigint>")
    return found, ids


def edits(placed: DataFrame) -> DataFrame:
    """For each conversation and part of the order: cost, edits, the state it begins in, counts."""
    spark, n = placed.sparkSession, partitions(placed.sparkSession)
    id_type = placed.schema["conv_id"].dataType.simpleString()
    ordered = _codes(placed).select("conv_id", "ord", "part", "code").repartition(n, "part").sortWithinPartitions("ord")
    runs = save(map_arrow(ordered, _pieces, f"conv_id {id_type}, part int, at bigint, codes binary"), "repair-pieces")
    prices, ids = _border_prices(runs)
    split = F.col("border").isNotNull()
    met = runs.join(F.broadcast(prices), F.col("at") == F.col("border"), "left")
    told = met.select("conv_id", "part", "at", "codes", "beyond", split.alias("split"))
    solved = save(map_arrow(told, _solutions, f"conv_id {id_type}, {_SOLVED}"), "repair-solutions")
    ways = {(r["at"], r["entry"]): r["exit"] for r in solved.filter("split").select("at", "entry", "exit").collect()}
    chosen, state, conv, first = [], START, None, True
    for at in sorted(ids):
        if first or ids[at] != conv:
            state, conv, first = START, ids[at], False
        chosen.append((at, state))
        state = ways[at, state]
    taken = spark.createDataFrame(chosen, "border bigint, begun int")
    met = solved.join(F.broadcast(taken), F.col("at") == F.col("border"), "left")
    return save(met.filter("NOT split OR entry = begun").drop("border", "begun"), "repair-edits")


# Repaired texts


def _read_part(turns: pa.Table, pieces: pa.Table) -> Iterator[tuple[dict, list[tuple[str, str]]]]:
    """Each piece of a part with its repaired turns."""
    turns = turns.sort_by("ord")
    at = turns.column("ord").to_numpy()
    for piece in pieces.sort_by("at").to_pylist():
        lo = int(np.searchsorted(at, piece["at"]))
        rows = turns.slice(lo, sum(piece["audit"].count(c) for c in "DKR")).select(["role", "text"])
        q, lines, rows = piece["entry"], [], iter(zip(*(c.to_pylist() for c in rows.columns)))
        for edit in piece["audit"]:
            role, text = next(rows) if edit != "I" else ("", "")
            if edit == "D":
                continue
            if edit == "K":
                q = AFTER_SYSTEM if role[:1] == "s" else NEXT[q]
            else:
                q = NEXT[q]
                role = NAMES[q]
            lines.append((role, text))
        yield piece, lines


def _together(placed: DataFrame, found: DataFrame, fn, schema: str) -> DataFrame:
    ship(placed.sparkSession)
    turns = placed.select(part_of(F.col("ord")).alias("part"), "ord", "role", "text")
    pieces = found.select("part", "conv_id", "at", "split", "entry", "audit")
    return turns.groupBy("part").cogroup(pieces.groupBy("part")).applyInArrow(fn, schema)


def _arrays(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def repaired_turns(placed: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, at, place (both order the turns), role, text."""
    names = ["conv_id", "at", "place", "role", "text"]

    def turns(rows: pa.Table, pieces: pa.Table) -> pa.Table:
        out = [
            (piece["conv_id"], piece["at"], i, role, text)
            for piece, lines in _read_part(rows, pieces)
            for i, (role, text) in enumerate(lines)
        ]
        kinds = [pieces.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.string(), pa.string()]
        return _arrays(out, kinds, names)

    id_type = placed.schema["conv_id"].dataType.simpleString()
    return _together(placed, found, turns, f"conv_id {id_type}, at bigint, place int, role string, text string")


def repaired_hashes(placed: DataFrame, found: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation as ``role:text`` lines; none if it is empty."""
    names = ["conv_id", "at", "no", "piece", "sha256"]

    def hashes(rows: pa.Table, pieces: pa.Table) -> pa.Table:
        out = []
        for piece, lines in _read_part(rows, pieces):
            whole = "".join(f"\n{role}:{text}" for role, text in lines).encode()
            if not piece["split"]:
                out.append((piece["conv_id"], piece["at"], 0, None, hashlib.sha256(whole[1:]).hexdigest()))
                continue
            for no in range(0, len(whole), PACKED_BYTES):
                out.append((piece["conv_id"], piece["at"], no // PACKED_BYTES, whole[no : no + PACKED_BYTES], None))
        kinds = [pieces.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.binary(), pa.string()]
        return _arrays(out, kinds, names)

    id_type = placed.schema["conv_id"].dataType.simpleString()
    kinds = f"conv_id {id_type}, at bigint, no int, piece binary, sha256 string"
    made = save(_together(placed, found, hashes, kinds), "repair-hashes")
    parts = made.filter("piece IS NOT NULL").select("conv_id", "at", "no", "piece")
    streamed = stream_sha256(parts, ["conv_id"], ["at", "no"], skip=1)
    return made.filter("sha256 IS NOT NULL").select("conv_id", "sha256").unionByName(streamed)


def report(placed: DataFrame, found: DataFrame) -> DataFrame:
    """Of each conversation that has rows: gaps, faults, illegal pairs, cost and edits."""
    turn = F.col("turn")
    turns = placed.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).alias("gaps")
    )
    pieces = F.sort_array(F.collect_list(F.struct("at", "first", "last", "audit")))  # one for each part
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    whole = found.groupBy("conv_id").agg(*sums, pieces.alias("pieces"))
    legal = F.array(*[F.lit(4 * a + b) for a, b in sorted(LEGAL_PAIRS)])
    pairs = F.zip_with(
        F.slice("pieces", 1, F.size("pieces") - 1),
        F.slice("pieces", 2, F.size("pieces")),
        lambda a, b: (~F.array_contains(legal, 4 * a["last"] + b["first"])).cast("bigint"),
    )
    between = F.aggregate(pairs, F.lit(0).cast("bigint"), lambda s, x: s + x)
    told = whole.select(
        F.col("conv_id").alias("of"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + between).alias("illegal"),
        "cost",
        F.array_join(F.col("pieces.audit"), "").alias("audit"),
    )
    return turns.join(told, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in order and the edits that repair them; see ``report`` and ``repaired_turns``."""
    placed = placed_turns(turns)
    return placed, edits(placed)


# The query


def damage(conversations: DataFrame) -> DataFrame:
    """Faults by a hash of conversation and turn: dropped, emptied, cut, repeated, reroled."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    hit = conversations.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("hit"))
    text = F.coalesce("text", space)

    def at(n: int, then: Column, other: Column) -> Column:
        return F.when(F.col("hit") == n, then).otherwise(other)

    cut = at(2, F.regexp_replace(text, "[.!?]", ""), text)
    return hit.filter("hit != 0").select(
        "conv_id",
        "turn",
        at(4, F.lit("user"), F.coalesce("role", space)).alias("role"),
        at(1, F.lit(""), cut).alias("text"),
        F.explode(F.sequence(F.lit(1), at(3, F.lit(2), F.lit(1)))).alias("copy"),
    ).drop("copy")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    placed, found = repair(damage(table))
    told = report(placed, found).withColumnRenamed("conv_id", "of")
    hashes = repaired_hashes(placed, found).withColumnRenamed("conv_id", "hash_of")
    every = table.select("conv_id").distinct()
    joined = every.join(told, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    joined = joined.join(hashes, F.col("conv_id").eqNullSafe(F.col("hash_of")), "left")
    return joined.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
