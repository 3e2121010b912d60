import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from namewake.llm import disclosure
from tests.llm.odd import no_docs, odd_docs, odd_rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    """The rules as they are written, by regular expressions."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def named(spans):
    return [(disclosure.KINDS[k], a, b) for k, a, b in spans]


def test_base_spans_follow_the_rules():
    rng = random.Random(3)
    bits = ["1", "2", "5", "9", "0", ".", ".", "-", " ", "@", "a", "b.c", "+", "(", ")", "é", "4111 1111 1111 1111", "255", "1.2.3.4"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert named(disclosure.base_spans(text)) == plain_spans(text), text


def long_runs(n):
    return "a" * 20 * n + " " + "1" * 20 * n + " " + "1." * 10 * n + "@" * n + "+1" + "(" * 10 * n + "4111 1111 " * n


def test_base_spans_of_long_runs_take_linear_time():
    assert named(disclosure.base_spans(long_runs(30))) == plain_spans(long_runs(30))
    took = []
    for n in (1000, 16_000):
        text = long_runs(n)
        began = time.process_time()
        disclosure.base_spans(text)
        took.append(time.process_time() - began)
    assert took[1] < 4 * 16 * max(took[0], 0.005)  # 256 times if it were quadratic


def plain_terms(rows, min_contexts, least):
    """Disclosive (entity, term) pairs by the definition; an entity occurs once in a document."""
    terms_of, held, n = [], [], len(rows)
    for _, text in rows:
        spans = [(a, b) for _, a, b in plain_spans(text)]
        words = [m for m in re.finditer(r"\w+", text) if len(m[0]) > 2 and not any(a < m.end() and m.start() < b for a, b in spans)]
        terms_of.append({m[0].lower() for m in words})
        own = {}
        for a, b in spans:
            at = sum(m.start() < a for m in words)
            own[text[a:b]] = tuple(m[0].lower() for m in words[max(0, at - 8) : at + 8])
        held.append(own)
    with_term, with_entity, both, around = Counter(), Counter(), Counter(), defaultdict(set)
    for own, terms in zip(held, terms_of):
        with_term.update(terms)
        with_entity.update(own.keys())
        for e, context in own.items():
            for t in terms:
                both[e, t] += 1
                around[e, t].add(context)
    return {
        (e, t) for (e, t), k in both.items()
        if len(around[e, t]) >= min_contexts and with_entity[e] < n
        and math.log(n * k / (with_term[t] * with_entity[e])) >= least * math.log(n / with_entity[e]) - 1e-12
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_added_terms_equal_plain_counting(spark, seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(30)] + [f"rare{i}" for i in range(40)]
    entities = [f"p{i}@example.org" for i in range(8)] + ["10.0.0.7"]
    rows = []
    for i in range(150):
        text = [rng.choice(words[:30]) for _ in range(25)] + rng.sample(words[30:], 2)
        for e in rng.sample(range(len(entities)), rng.choice([0, 0, 1, 2])):
            text += [entities[e]] + [f"rare{4 * e + rng.randrange(4)}"] * rng.randrange(3)
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
    pairs = plain_terms(rows, 3, 0.5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.spans for r in disclosure.digest(disclosure.find_spans(docs, min_contexts=3, disclosure=0.5)).collect()}
    marked = 0
    for i, text in rows:
        own = {text[a:b] for _, a, b in plain_spans(text)}
        tells = {t for e, t in pairs if e in own}
        want = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"\w+", text) if m[0].lower() in tells]
        assert [s for s in got[i].split(",") if s.startswith("term")] == want, i
        marked += len(want)
    assert marked > 10


def corpus():
    """An address that a rare word gives away, in four different surroundings and copies."""
    rng = random.Random(4)
    filler = [f"common{i}" for i in range(40)]
    rows = []
    for i in range(60):
        words = [rng.choice(filler) for _ in range(40)]
        if i < 4:
            words[20:20] = ["Zanzibar", "mail", "joe@example.org", "4711"]
        elif i < 10:
            words.insert(5, "mail")
        elif i < 14:
            words[3:3] = ["seldom", "ann@example.org"] if i == 10 else words[3:5]
        rows.append((i, " ".join(words)))
    return rows + [(100 + i, dict(rows)[10]) for i in range(5)]  # copies: one surrounding


@pytest.mark.parametrize("limit", ["0", str(64 << 20)])
def test_terms_that_disclose_are_added(spark, limit):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    spark.conf.set("spark.namewake.broadcastBytes", limit)
    try:
        got = {r.doc_id: r for r in disclosure.digest(disclosure.find_spans(docs)).collect()}
        clean = {r.doc_id: r.text for r in disclosure.sanitize(docs).collect()}
    finally:
        spark.conf.unset("spark.namewake.broadcastBytes")
    for i, text in corpus():
        base = [f"{k}:{a}:{b}" for k, a, b in plain_spans(text)]
        terms = [text[slice(*map(int, s.split(":")[1:]))] for s in got[i].spans.split(",") if s.startswith("term")]
        assert got[i].spans.split(",")[: len(base)] == (base or [""])[: len(base)]
        assert terms == (["Zanzibar", "4711"] if i < 4 else []), i
    assert "[name] mail [email] [number]" in clean[0]
    assert "seldom [email]" in clean[10] and clean[30] == dict(corpus())[30]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = disclosure.digest(disclosure.find_spans(docs)).collect()
    want = [",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(r[1] or "")) for r in odd_rows()]
    assert sorted(r.base_sha256 for r in got) == sorted(hashlib.sha256(w.encode()).hexdigest() for w in want)
    clean = disclosure.sanitize(docs)
    assert clean.schema == docs.schema and clean.count() == docs.count()
    assert disclosure.find_spans(no_docs(spark)).count() == 0


def test_sanitized_covers_overlapping_spans():
    assert disclosure.sanitized("abc def ghi", [(0, 0, 5), (1, 4, 9), (4, 8, 11)]) == "[email][ip]"


def test_terms_far_from_the_entity_are_marked(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        words = [f"common{rng.randrange(40)}" for _ in range(60)]
        if i < 5:
            words[50:50] = ["joe@example.org"]
            words[30:30] = ["Zanzibar"]  # 20 words off
            words[2:2] = ["Zanzibar"]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in disclosure.sanitize(docs).collect()}
    for i, text in rows:
        assert clean[i] == text.replace("Zanzibar", "[name]").replace("joe@example.org", "[email]")
