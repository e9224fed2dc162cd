"""Token counts by a whole-token shortcut.

Before the run, every vocabulary string is proved or not to encode alone as one
token: the pre-tokeniser leaves it whole and the library gives its id and no
other. A pre-token equal to a proved string counts one without any merging;
only the rest is merged by the library's model, each string once while it stays
in a bounded table.

Cases: null and empty texts count zero; special strings inside a text count one
each, as the library does by default; an empty table gives no rows; repeated
rows are counted each; other columns are not read.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_letters
from .common import slices

LIMIT = 1024
#: Merged strings kept per Python worker.
REST_ENTRIES = 500_000
#: Unicode white space, written out: Python's own class holds four control characters more.
_WHITE = r"\t-\r \x85\xa0  -     　"


class _Counts(dict):
    """Pre-token -> number of tokens; proved strings stay, others come and go."""

    def __init__(self, proved: dict[str, int], merge):
        super().__init__(proved)
        self.merge, self.proved = merge, proved

    def __missing__(self, pre: str) -> int:
        if len(self) >= len(self.proved) + REST_ENTRIES:
            self.clear()
            self.update(self.proved)
        n = self[pre] = self.merge(pre)
        return n


class WholeTokens:
    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        pattern = pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]")
        self.split = regex.compile(pattern).findall
        special = [t["content"] for t in spec.get("added_tokens") or ()]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        letter = {b: c for c, b in byte_letters().items()}
        self.letters = [letter[b] for b in range(256)]
        self.counts = _Counts(self._proved(spec["model"]["vocab"], set(special)), self._merged)

    def _proved(self, vocab: dict[str, int], special: set[str]) -> dict[str, int]:
        back, strings, ids = byte_letters(), [], []
        for t, i in vocab.items():
            if t in special:
                continue
            try:
                s = bytes(back[c] for c in t).decode()
            except (UnicodeDecodeError, KeyError):
                continue
            if self.split(s) == [s]:
                strings.append(s)
                ids.append(i)
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return {s: 1 for s, i, e in zip(strings, ids, found, strict=True) if e.ids == [i]}

    def _merged(self, pre: str) -> int:
        return len(self.tokenizer.model.tokenize("".join([self.letters[b] for b in pre.encode()])))

    def count(self, text: str) -> int:
        if self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.count, parts))
        return sum(map(self.counts.__getitem__, self.split(text)))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> WholeTokens:
    return WholeTokens(path, pattern)


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""

    def run(batches):
        counter = load(path, pattern)
        for batch in slices(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
