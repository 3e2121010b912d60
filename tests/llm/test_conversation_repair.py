import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from namewake.llm import conversation_repair as repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, at bigint, codes string, ord bigint, hit int"
EXTRA = (1, 2, "c", 3, 4)
GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(c, t, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def faults_of(rows):
    out, seen = [], set()
    for role, text in rows:
        inner = re.sub(r"[\x20\x09-\x0D]+", " ", text).strip(" ")
        out.append("blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def follow(q, initial):
    """The state after a turn, or None: nothing yet, s, u, a."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((q, initial))


def plain_edits(rows, faults):
    """(cost, edits) by dynamic programming over (cost, string) from the end."""
    best = {q: ((0, "") if q in ("", "a") else None) for q in ("", "s", "u", "a")}

    def with_inserts(best):
        for _ in range(4):
            for q in best:
                for i in "ua":
                    to = follow(q, i)
                    if to and best[to] and (best[q] is None or (best[to][0] + 3, "I" + best[to][1]) < best[q]):
                        best[q] = (best[to][0] + 3, "I" + best[to][1])
        return best

    best = with_inserts(best)
    for (role, _), fault in zip(reversed(rows), reversed(faults)):
        now = {}
        for q in best:
            ways = [(best[q][0] + 4, "D" + best[q][1])] if best[q] else []
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                for letter, initial, cost in [("K", role[:1], 0), ("R", "u", 3), ("R", "a", 3)]:
                    to = follow(q, initial)
                    if to and best[to]:
                        ways.append((best[to][0] + cost + late, letter + best[to][1]))
            now[q] = min(ways, default=None)
        best = with_inserts(now)
    return best[""]


def plain_repaired(rows, edits):
    out, q, left = [], "", list(rows)
    for e in edits:
        if e == "I":
            q = "u" if q != "u" else "a"
            out.append(({"u": "user", "a": "assistant"}[q], ""))
            continue
        role, text = left.pop(0)
        if e == "K":
            q = role[:1]
            out.append((role, text))
        elif e == "R":
            q = "u" if q != "u" else "a"
            out.append(({"u": "user", "a": "assistant"}[q], text))
    assert not left and GRAMMAR.fullmatch("".join(r[:1] for r, _ in out))
    return out


def plain_report(rows, order):
    """The contract's result, conversation by conversation."""
    out = []
    for c in {r[0] for r in rows}:
        own = sorted((r for r in plain_damage(rows) if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, order[r[2:]]))
        pairs = [(role, text) for _, _, role, text in own]
        faults = faults_of(pairs)
        turns = {t for _, t, _, _ in own if t is not None}
        initials = [r[:1] for r, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, edits = plain_edits(pairs, faults)
        text = "\n".join(f"{r}:{t}" for r, t in plain_repaired(pairs, edits))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((c, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def order_of(table):
    kept = repair.damage(table).distinct().select("role", "text", F.xxhash64("role", "text").alias("h"))
    return {(r.role, r.text): r.h for r in kept.collect()}


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(4)


def report_of(spark, table, tmp_path):
    path = str(tmp_path / "sf")
    table.write.parquet(f"{path}/conversations.parquet")
    got = repair.query(spark, path).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0))


def random_turns(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "s"]
    texts = ["Yes.", "No!", "why", "So?  \n", "", " \t", None, "é." * 40, "cut off"]
    return [(rng.choice([t, t, t, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{t}.") for t in range(n)]


def test_report_equals_plain_code(spark, tmp_path):
    rng = random.Random(1)
    rows = [(c, *r) for c in [*range(60), None, -5, 10**13] for r in random_turns(rng, rng.choice([1, 1, 2, 4, 7]))]
    rows += [(200, t, "user", None) for t in range(3)] + [(201, 5, "user", "twice.")] * 3
    table = table_of(spark, rows)
    assert report_of(spark, table, tmp_path) == plain_report(rows, order_of(table))


def test_one_conversation_holds_most_rows(spark, tmp_path):
    """It lies on all tasks; its pieces are solved apart and agree with one pass over all."""
    rng = random.Random(2)
    rows = [(7, t, *r[1:]) for t, r in enumerate(random_turns(rng, 600))]
    rows += [(c, t, "user", "same.") for c in range(20, 50) for t in range(4)]
    rows += [(9, 1, "assistant", "x.")] * 200  # equal rows
    table = table_of(spark, rows)
    placed, found = repair.repair(repair.damage(table))
    assert found.filter("split").select("part").distinct().count() > 1
    assert report_of(spark, table, tmp_path) == plain_report(rows, order_of(table))


def test_repaired_turns_are_legal_and_whole(spark):
    rng = random.Random(6)
    rows = [(c, *r) for c in range(12) for r in random_turns(rng, 9)]
    placed, found = repair.repair(table_of(spark, rows))
    got = {}
    for r in repair.repaired_turns(placed, found).orderBy("conv_id", "at", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got and all(GRAMMAR.fullmatch("".join(r[:1] for r, _ in turns)) for turns in got.values())


def test_empty_table(spark, tmp_path):
    assert report_of(spark, spark.createDataFrame([], SCHEMA), tmp_path) == []


def test_auction_equals_all_edit_strings():
    """Short rows against every string of edits, by the definition."""
    for n in range(1, 4):
        for kinds in itertools.product(range(4), repeat=n):
            for faults in itertools.product((0, repair.BLANK, repair.OPEN), repeat=n):
                codes = bytes(k + f for k, f in zip(kinds, faults))
                names = ["suax"[k] for k in kinds]
                tags = [{0: "", repair.BLANK: "blank", repair.OPEN: "truncated"}[f] for f in faults]
                price, edits, _ = repair.solve(codes, None, (repair.START,))[0]
                assert (price, edits) == every_string(tuple(names), tuple(tags))


def every_string(names, tags):
    best = None
    frontier = [(0, "", 0, "")]  # cost, edits, rows read, output
    while frontier:
        cost, edits, i, out = frontier.pop()
        if best and cost > best[0] or cost > 4 * len(names):
            continue
        if i == len(names) and GRAMMAR.fullmatch(out):
            best = min(best or (cost, edits), (cost, edits))
        frontier += [(cost + 3, edits + "I", i, out + c) for c in "ua"]
        if i < len(names):
            frontier.append((cost + 4, edits + "D", i + 1, out))
            if tags[i] != "blank":
                late = 3 * (tags[i] == "truncated")
                frontier.append((cost + late, edits + "K", i + 1, out + names[i]))
                frontier += [(cost + late + 3, edits + "R", i + 1, out + c) for c in "ua"]
        frontier = [f for f in frontier if re.fullmatch(r"s?(ua)*u?", f[3])]
    return best


@pytest.mark.parametrize("seed", range(20))
def test_blocks_and_matrices_equal_one_pass(seed):
    """Any cuts give the same costs; edits cut at a border are those of the whole."""
    rng = random.Random(seed)
    codes = bytes(rng.randrange(4) + rng.choice([0, 0, repair.BLANK, repair.DUPLICATE, repair.OPEN]) for _ in range(rng.randrange(1, 150)))
    names, marks = ["suax"[c & 3] for c in codes], {0: "", 4: "blank", 8: "duplicate", 16: "truncated"}
    want = plain_edits([(n, "") for n in names], [marks[c & 28] for c in codes])
    assert repair.solve(codes, None, (repair.START,))[0][:2] == want
    at = rng.randrange(len(codes))
    a, b = codes[:at], codes[at:]
    ahead = tuple(min(c + p for c, p in zip(row, repair.ENDING)) for row in repair.matrix(b))
    if a:
        price, edits, q = repair.solve(a, ahead, repair.STATES)[0]
        assert (price, edits + repair.solve(b, None, repair.STATES)[q][1]) == want
    else:
        assert ahead[0] == want[0]
