"""A small table with everything that may go wrong, and plain-Python counterparts."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns beside those of documents have names that operators use inside.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "host string, row bigint, key string, region bigint, part int, n_tokens string, words int, "
    "frequent string, epoch int, `a.b` string, first bigint, `size` int, __copy int"
)
EXTRA = ("h", 1, "k", 2, 3, "t", 4, "f", 5, "dot", 6, 7, 8)


def prose(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
                    + str(rng.randint(0, 99)) for _ in range(n))


def odd_texts():
    """Texts with ids; near copies, exact copies, short, empty and very long ones."""
    rng = random.Random(5)
    base = prose(rng, 200)
    words = base.split(" ")
    out = [(1, base), (2, base), (3, None), (4, ""), (5, " \t\n "), (6, "one two"), (7, "One  two"), (8, "x")]
    for i in range(10, 40):  # near copies in a chain and around a centre
        copy = list(words)
        for _ in range(i % 7):
            copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 999)}"
        out.append((i, " ".join(copy)))
    shared = prose(rng, 60)  # a passage in otherwise different texts
    out += [(i, shared + "\n" + prose(rng, 30 + i)) for i in range(40, 60)]
    out += [(60, prose(rng, 20_000)), (61, "y" * 50_000), (62, "é 1 " * 500), (63, "a<|endoftext|>B <|ENDOFTEXT|>")]
    return out


def odd_rows():
    rng = random.Random(6)
    rows = [(i, t, "en", rng.choice(["b", "a", None]), len(t or ""), *EXTRA) for i, t in odd_texts()]
    rows += [(None, "no id one two three four five six", None, None, None, *EXTRA)] * 2
    return rows


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = words_of(lower_az(text))
    if len(w) >= 5:
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()
