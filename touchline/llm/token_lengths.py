"""Lengths of texts in tokens, where no prefix is asked for: packing needs totals only.

The merges of a byte-level vocabulary are given to ``tiktoken`` as ranks. It merges by the result of a pair
where the vocabulary names the pair, which is the same as long as every token is the result of one merge; the
vocabulary is refused if not.

Defined results: a missing text has no tokens; a special string inside a text is one token, as in the
tokenizer's own library; ids may be missing or repeat; extra columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import json
import re

import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from touchline.llm.batches import per_text, shipped
from touchline.llm.token_counts import SPACES, byte_letters

# fixed values: the pre-token pattern of byte-level vocabularies, with possessive repeats
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SAFE = 50_000  # code points that may hold white space of any length
LONG_SPACE = re.compile("[" + "".join(sorted(SPACES)) + "]{1000,}")


class Lengths:
    """Counts under one byte-level BPE vocabulary, given as the text of its tokenizer file. Built where it is first used."""

    def __init__(self, tokenizer: str):
        self.tokenizer, self.count_plain = tokenizer, None

    def __getstate__(self):
        return {"tokenizer": self.tokenizer, "count_plain": None}

    def build(self) -> None:
        spec = json.loads(self.tokenizer)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        letters = byte_letters()
        ranks = {bytes([b]): b for b in range(256)}
        for rank, merge in enumerate(spec["model"]["merges"], 256):
            token = bytes(letters[c] for c in ("".join(merge) if isinstance(merge, list) else merge.replace(" ", "")))
            if ranks.setdefault(token, rank) != rank:
                raise ValueError("two merges make one token")
        special = [t["content"] for t in spec["added_tokens"]]
        self.cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special = special
        self.count_plain = tiktoken.Encoding("lengths", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def plain(self, text: str) -> int:
        if len(text) <= SAFE:
            return len(self.count_plain(text))
        # the pattern fails on very long white space; its last character begins a pre-token of its own if something follows
        ends = [m.end() - 1 for m in LONG_SPACE.finditer(text) if m.end() < len(text)]
        return sum(len(self.count_plain(text[a:b])) for a, b in zip([0, *ends], [*ends, len(text)]))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.count_plain is None:
            self.build()
        if self.cut and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return sum(map(self.plain, parts)) + len(parts) - 1
        return self.plain(text)


def token_lengths(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", name: str = "n_tokens") -> DataFrame:
    """(id, n_tokens) of every text. The vocabulary (a few MB, whatever the data) travels with the tasks."""
    shared = shipped(df.sparkSession, Lengths(tokenizer))

    def work():
        lengths = shared.value
        return lambda texts: [[lengths.count(t) for t in texts]]

    return per_text(df, text, [id_column], [StructField(name, LongType())], work)
