"""Byte-level BPE ids of whole texts, as the ``tokenizers`` library gives them.

Texts are merged by rank with ``tiktoken`` over the ranks read from the same
file, which is proved equal on loading (the n-th merge makes the n-th token
after the bytes, so rank order is merge order). Without that proof, and for
texts that hold a special string or a very long run, the ``tokenizers`` library itself encodes.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: From this length on, runs without a break are looked for: merging one long
#: run by rank takes quadratic time, the library's queue doesn't.
LONG_TEXT, LONG_RUN = 20_000, 5_000
_BLANK_RUN = re.compile(r"\s{%d}" % LONG_RUN)


def has_long_run(text: str) -> bool:
    return len(text) > LONG_TEXT and (max(map(len, text.split()), default=0) > LONG_RUN or bool(_BLANK_RUN.search(text)))


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters are themselves, the rest follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def rank_encoding(path: str, pattern: str):
    """A ``tiktoken`` encoding with the ids of the file, or None if the file's
    merges aren't in the order of the ids."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    special = {t["content"] for t in spec.get("added_tokens") or ()}
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ordered = all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)) and len(ranks) == 256 + len(merges)
    plain = not spec.get("normalizer") and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
    if not (ordered and plain):
        return None
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        self.ranks = rank_encoding(path, pattern)

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self.ranks is None or self.special.search(text) or has_long_run(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranks.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)
