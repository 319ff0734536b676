"""Token ids of whole texts by a public byte-level vocabulary, whose files are a parameter."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Letters, digits and signs whose classes are alike in both libraries; other texts go to the slower one.
PLAIN = re.compile("[\\x00-ɏ–—‘-„…€]*")
DOUBLE_SPACE = re.compile(r"\s\s")


class Ids:
    """``name``.json through the tokenizers library decides; the rank file of the same vocabulary gives the same ids
    some six times faster and serves texts of plain characters without the literal of an
    added token. Between single white-space characters the look-ahead
    of its pattern never applies, and without it the pattern is faster still."""

    def __init__(self, folder: str, name: str) -> None:
        with open(f"{folder}/{name}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        make = lambda n, p: tiktoken.Encoding(n, pat_str=p, mergeable_ranks=ranks, special_tokens={})
        self.full = make("full", public_tokenizers.PATTERN)
        self.single = make("single", public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", ""))
        self.exact = Tokenizer.from_file(f"{folder}/{name}.json")
        added = {i: t.content for i, t in self.exact.get_added_tokens_decoder().items()}
        self.added = re.compile("|".join(map(re.escape, added.values())) or r"(?!)")
        self.bytes_of = np.zeros(max(*ranks.values(), *added) + 1, np.int64)
        for i, t in added.items():
            self.bytes_of[i] = len(t.encode())
        for k, v in ranks.items():
            self.bytes_of[v] = len(k)

    def __call__(self, text: str) -> np.ndarray:
        if not PLAIN.fullmatch(text) or self.added.search(text):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = (self.full if DOUBLE_SPACE.search(text) else self.single)._core_bpe.encode_ordinary(text)
        return np.fromiter(ids, np.uint32, len(ids))


@lru_cache(4)
def load(folder: str, name: str) -> Ids:
    return Ids(folder, name)


def folder() -> str:
    return public_tokenizers.path("").rstrip("/")
