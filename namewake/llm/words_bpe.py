"""Encoding by a public tokenizer file, with work shared between equal words.

The tokenizer drops white space and splits the rest into words by a rule before it merges
letters. Of texts that hold nothing but ASCII and Latin letters the words are found here,
by the same rule; words seen before are looked up, new ones encoded together by the
tokenizers library. Other texts go to the library part by part between white space, across
which no token reaches. Everything kept is bounded: when ``KEEP`` words are held, all are
dropped and the table fills anew.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from functools import cache

import numpy as np

KEEP = 400_000
TOKENIZER = "word_bpe_49k.json"

#: Texts of ASCII and Latin letters, which the normaliser only lower-cases.
_SIMPLE = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: Fixed value: the tokenizer's split rule, for such texts.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the file is on this machine; ``NAMEWAKE_TOKENIZERS`` names another folder."""
    if folder := os.environ.get("NAMEWAKE_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@cache
def _model_alone(path: str):
    """The same merges, given words apart by blanks, without normaliser and split rule."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    told |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "WhitespaceSplit"},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    }}
    return Tokenizer.from_str(json.dumps(told))


class WordEncoder:
    """Token ids of texts as little-endian 16-bit values."""

    def __init__(self, path: str):
        self.words: dict[str, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.tokenizer, self.model = library(path), _model_alone(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        if max(vocab.values()) >= 1 << 16:
            raise ValueError("ids of this vocabulary take more than 16 bits")
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = [t.content.lower() for t in added]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words that the split rule leaves whole, encoded together: sizes, and ids end to end."""
        sizes, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint16)]
        for lot in _lots(words, 1000):
            ids.append(np.array(self.model.encode(" ".join(lot), add_special_tokens=False).ids, "<u2"))
            sizes.append(np.diff(np.flatnonzero(self.closes[ids[-1]]), prepend=-1))
        return np.concatenate(sizes), np.concatenate(ids)

    def _learn_words(self, new: set[str]) -> None:
        words = list(new)
        sizes, ids = self.encode_words(words)
        ends, raw = (2 * np.cumsum(sizes)).tolist(), ids.tobytes()
        self.words.update(zip(words, [raw[a:b] for a, b in zip([0, *ends], ends)]))

    def _learn_parts(self, new: set[bytes]) -> None:
        for lot in _lots(list(new), 500):
            done = self.tokenizer.encode_batch([p.decode() for p in lot], add_special_tokens=False)
            self.parts.update((p, np.array(e.ids, "<u2").tobytes()) for p, e in zip(lot, done))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text."""
        if len(self.words) > KEEP:
            self.words.clear()
        if len(self.parts) > KEEP // 4:
            self.parts.clear()
        split, by_part = [], []
        for i, text in enumerate(texts):
            low = text.lower()
            if _SIMPLE.fullmatch(text) and not any(s in low for s in self.specials):
                split.append(_SPLIT.findall(low))
            else:
                split.append(text.encode().split())
                by_part.append(i)
        other = set(by_part)
        if new := set().union(*[w for i, w in enumerate(split) if i not in other]).difference(self.words):
            self._learn_words(new)
        if by_part and (new := set().union(*[split[i] for i in by_part]).difference(self.parts)):
            self._learn_parts(new)
        word, part = self.words.__getitem__, self.parts.__getitem__
        return [b"".join(map(part if i in other else word, ws)) for i, ws in enumerate(split)]


def _lots(items: list, size: int) -> Iterable[list]:
    for i in range(0, len(items), size):
        yield items[i : i + size]


@cache
def encoder(path: str) -> WordEncoder:
    """One for each worker process, used from task to task."""
    return WordEncoder(path)
