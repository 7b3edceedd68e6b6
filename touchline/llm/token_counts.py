"""Exact token counts at every prefix of every text, by dynamic programming over prefixes.

The last token of the byte-pair encoding of a prefix is the one token that ends there and
follows validly on the last token of the prefix before it; so ``count[i] = count[i - len] + 1``.
Texts are cut where a new pre-token surely begins (a single space between two non-space
characters); the table of such a piece is the same wherever it stands, so short pieces are remembered, in
a bounded number of bytes. A text's table is stored as differences, one byte for each code point where they
fit (two otherwise). From it every truncation or budget question is answered without encoding anything again.

Defined results: a missing text counts as empty (0 bytes, 0 tokens); ids may be missing or repeat
(each row is counted on its own); extra columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField

from touchline.llm.batches import per_text, shipped
from touchline.session import scratch_dir

# fixed values: the pre-token pattern of the byte-level vocabulary
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# fixed values: the white space of that pattern (Unicode White_Space)
SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
REMEMBERED = 96 << 20  # bytes of tables and pieces kept by a worker, about
LONG_WORD = 120  # bytes from which a pre-token is walked by itself and not remembered
LONG_PIECE = 64  # code points of a piece that is not remembered
SEEN = 1 << 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in byte-level vocabularies: printable Latin-1 as is, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """Prefix tables under one byte-level BPE vocabulary, given as the text of its tokenizer file.

    Tokens are numbered by age: single bytes 0..255, then results of merges in their order.
    """

    def __init__(self, tokenizer: str):
        spec = json.loads(tokenizer)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        letters = byte_letters()
        self.special = [t["content"] for t in spec["added_tokens"]]
        ages = {bytes([b]): b for b in range(256)}
        halves = [(-1, -1)] * 256
        for age, merge in enumerate(spec["model"]["merges"], 256):
            left, right = (bytes(letters[c] for c in t) for t in (merge if isinstance(merge, list) else merge.split(" ")))
            halves.append((ages[left], ages[right]))
            ages[left + right] = age
        self.left, self.right = (np.array(h, np.int64) for h in zip(*halves))
        pairs = self.left[256:] << 20 | self.right[256:]
        order = np.argsort(pairs)
        self.pairs, self.pair_age = pairs[order], order + 256
        # the trie of all tokens: (state << 8 | byte) -> state, and the age of the token that ends in a state
        steps: dict[int, int] = {}
        ends = {}
        for token, age in ages.items():
            state = 0
            for byte in token:
                state = steps.setdefault(state << 8 | byte, len(steps) + 1)
            ends[state] = age
        self.step_key = np.array(sorted(steps), np.int64)
        self.step_to = np.array([steps[k] for k in self.step_key.tolist()], np.int64)
        self.age = np.full(len(steps) + 1, -1, np.int64)
        self.age[list(ends)] = list(ends.values())
        self.seen_key = np.full(SEEN, -1, np.int64)
        self.seen = np.zeros(SEEN, bool)
        self.tables: dict[str, bytes] = {}
        self.pieces: dict[str, bytes | None] = {}
        self.older_tables: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes | None] = {}
        self.held = 0
        self.passing: list[str] = []  # long pieces and pre-tokens, kept for one list of texts only
        self.ages = ages
        self.lengths = sorted({len(t) for t in ages})
        self.followers: dict[int, bool] = {}
        self.halves = list(zip(self.left.tolist(), self.right.tolist()))
        self.merged = dict(zip(self.pairs.tolist(), self.pair_age.tolist()))
        self.pattern = regex.compile(PRE_TOKENS)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def step(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The next states of the token trie, -1 where it ends."""
        out = np.full(len(states), -1, np.int64)
        alive = np.flatnonzero(states >= 0)
        keys = states[alive] << 8 | letters[alive]
        at = np.minimum(np.searchsorted(self.step_key, keys), len(self.step_key) - 1)
        out[alive] = np.where(self.step_key[at] == keys, self.step_to[at], -1)
        return out

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the encoding of both tokens' bytes is these two tokens."""
        keys = left << 20 | right
        slots = (keys.astype(np.uint64) * SPREAD >> np.uint64(40)).astype(np.int64) & (SEEN - 1)
        new = np.flatnonzero(self.seen_key[slots] != keys)
        out = self.seen[slots]
        if len(new):
            distinct, place = np.unique(keys[new], return_inverse=True)
            found = self._apart(distinct >> 20, distinct & 0xFFFFF)
            out[new] = found[place]
            self.seen_key[slots[new]] = keys[new]  # of several in one slot the last stays, in both
            self.seen[slots[new]] = out[new]
        return out

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """No merge across the border comes before the merges that made the two tokens standing
        at it: the later of the two is undone step by step, and each pair met is looked up."""
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), len(self.left), np.int64)
        good, open_ = np.ones(len(left), bool), np.arange(len(left))
        while len(open_):
            a, b, most = left[open_], right[open_], limit[open_]
            keys = a << 20 | b
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            bad = (self.pairs[at] == keys) & (self.pair_age[at] < most)
            good[open_[bad]] = False
            undo_left = (a > b) & (self.left[a] >= 0) | (self.left[b] < 0) & (self.left[a] >= 0)
            undo_right = ~undo_left & (self.left[b] >= 0)
            limit[open_] = np.where(undo_left, a, b + 1)
            left[open_] = np.where(undo_left, self.right[a], a)
            right[open_] = np.where(undo_right, self.left[b], b)
            open_ = open_[~bad & (undo_left | undo_right)]
        return good

    def one_apart(self, left: int, right: int) -> bool:
        """As _apart, for one pair."""
        limit, merged, halves = len(self.halves), self.merged, self.halves
        while merged.get(left << 20 | right, limit) >= limit:
            if left > right and left >= 256:
                limit, left = left, halves[left][1]
            elif right >= 256:
                limit, right = right + 1, halves[right][0]
            elif left >= 256:
                limit, left = left, halves[left][1]
            else:
                return True
        return False

    def walked(self, data: bytes) -> np.ndarray:
        """Tokens of every byte prefix of one long pre-token. Only the last tokens within a longest token's reach are looked at."""
        counts, last, ages, known = [0], [-1], self.ages, self.followers
        for end in range(1, len(data) + 1):
            for size in self.lengths:
                token = ages.get(data[end - size:end]) if size <= end else None
                if token is None:
                    continue
                before = last[end - size]
                if before >= 0:
                    key = before << 20 | token
                    if key not in known:
                        if len(known) >= SEEN:
                            known.clear()
                        known[key] = self.one_apart(before, token)
                    if not known[key]:
                        continue
                last.append(token)
                counts.append(counts[end - size] + 1)
                break
        return np.array(counts[1:], np.int32)

    def tables_of(self, words: list[str]) -> list[bytes]:
        """Differences of the tables of pre-tokens, by code point. Equal beginnings are one node of
        a tree of prefixes, so the program runs once for each distinct prefix, a level at a time; long pre-tokens are walked."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(d) for d in data], np.int64)
        firsts = np.cumsum(sizes) - sizes
        every = np.frombuffer(b"".join(data), np.uint8)
        counts = np.zeros(len(every), np.int32)
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            counts[firsts[i]:firsts[i] + sizes[i]] = self.walked(data[i])
        active = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))  # the words that are longer than the level
        node = np.zeros(len(active), np.int64)  # the node of each of them
        last, total = np.array([-1]), np.array([0])  # of the nodes of the level before
        behind: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # trie state, last token and count, 1, 2, .. levels before
        level = 0
        while len(active):
            key, node = np.unique(node << 8 | every[firsts[active] + level], return_inverse=True)
            parent, letter = key >> 8, key & 255
            behind = [(np.zeros(len(last), np.int64), last, total), *behind]
            behind = [(self.step(s[parent], letter), l[parent], t[parent]) for s, l, t in behind]
            while behind and not (behind[-1][0] >= 0).any():
                behind.pop()
            last, total = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
            missing = np.arange(len(key))
            for state, before, count in behind:
                token = np.where(state[missing] >= 0, self.age[state[missing]], -1)
                able = np.flatnonzero(token >= 0)
                able = able[(b := before[missing[able]]) < 0], able[b >= 0]
                follows = self.may_follow(before[missing[able[1]]], token[able[1]])
                done = np.concatenate([able[0], able[1][follows]])
                last[missing[done]], total[missing[done]] = token[done], count[missing[done]] + 1
                missing = np.delete(missing, done)
                if not len(missing):
                    break
            counts[firsts[active] + level] = total[node]
            level += 1
            stay = sizes[active] > level
            active, node = active[stay], node[stay]
        ends = np.append((every[1:] & 0xC0) != 0x80, True)[:len(every)]  # bytes that end a code point
        points = np.append(0, np.cumsum(ends))
        begin, stop = points[firsts], points[firsts + sizes]
        at_ends = counts[ends]
        steps = np.diff(at_ends, prepend=0)
        own = begin[sizes > 0]
        steps[own] = at_ends[own]
        flat = steps.astype(np.int16).tobytes()
        out = [flat[2 * b:2 * e] for b, e in zip(begin.tolist(), stop.tolist())]
        for i, w in enumerate(words):
            if w in ("'re", "'ve", "'ll"):  # shorter prefixes of it are not contractions
                whole = int(np.frombuffer(out[i], np.int16).sum())
                out[i] = np.array([1, 1, whole - 2], np.int16).tobytes()
        return out

    def know(self, words: set[str]) -> None:
        new = []
        for w in words:
            if w not in self.tables:
                if w in self.older_tables:
                    self.tables[w] = self.older_tables[w]
                    self.held += 250 + 4 * len(w)
                else:
                    new.append(w)
        new.sort()
        self.tables.update(zip(new, self.tables_of(new)))
        for w in new:
            self.held += 250 + 4 * len(w)
            if len(w) > LONG_PIECE:
                self.passing.append(w)

    def general(self, text: str) -> bytes:
        """Differences for any text without special tokens."""
        words = self.pattern.findall(text)
        runs = {w + a[0] for w, a in zip(words, words[1:]) if w[-1] in SPACES and a[0] in SPACES}
        if any(w not in self.tables for w in words) or runs:
            self.know({*words, *runs})
        made = [self.tables[w] for w in words]
        if not runs:
            return b"".join(made)
        flat, at = np.frombuffer(bytearray(b"".join(made)), np.int16), 0
        for word, table, after in zip(words, made, words[1:]):
            if word[-1] in SPACES and after[0] in SPACES:
                # a prefix that ends inside a run of white space ends with the whole run as one pre-token
                place = at + len(word)
                run = int(np.frombuffer(self.tables[word + after[0]], np.int16).sum(dtype=np.int64))
                own = int(np.frombuffer(table, np.int16).sum(dtype=np.int64))
                moved = int(flat[place]) - (run - own)
                flat[place] -= moved
                flat[place + 1] += moved
            at += len(word)
        return flat.tobytes()

    def learn(self, texts: Sequence[str]) -> None:
        """Remember the tables of all pieces between single spaces, each with the space before it."""
        for w in self.passing:
            self.tables.pop(w, None)
            self.pieces.pop(w, None)
        self.passing = []
        if self.held > REMEMBERED // 2:  # what is asked for again comes back from the older half
            self.older_tables, self.older_pieces, self.tables, self.pieces, self.held = self.tables, self.pieces, {}, {}, 0
        words: dict[str, list[str]] = {}
        for piece in {p for t in texts for p in t.split(" ")}:
            if piece in self.pieces:
                continue
            if piece in self.older_pieces:
                self.pieces[piece] = self.older_pieces[piece]
                self.held += 250 + 4 * len(piece)
                continue
            if len(piece) > LONG_PIECE:
                self.passing.append(piece)
            self.held += 250
            if piece.isalpha():
                words[piece] = [" " + piece]
            elif piece[:-1].isalpha() and piece[-1] in ",.;:!?":
                words[piece] = [" " + piece[:-1], piece[-1]]
            elif piece and piece[0] not in SPACES and piece[-1] not in SPACES:
                words[piece] = self.pattern.findall(" " + piece)
            else:
                self.pieces[piece] = None  # white space on both sides of a space
        firsts = {w for t in texts for w in self.pattern.findall(t.split(" ", 1)[0])}
        self.know(firsts.union(*words.values()))
        known = self.tables
        made = {p: known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for p, ws in words.items()}
        self.pieces.update(made)
        for piece, ws in words.items():
            if len(ws) > 2 and any(w[-1] in SPACES and a[0] in SPACES for w, a in zip(ws, ws[1:])):
                self.pieces[piece] = self.general(" " + piece)

    def ordinary(self, text: str) -> bytes:
        """Differences for a text without special tokens, piece by piece where it can be cut at single spaces."""
        first, *rest = text.split(" ")
        if first and first[0] not in SPACES and first[-1] not in SPACES:
            tables = list(map(self.pieces.get, rest))
            if None not in tables:
                return self.general(first) + b"".join(tables)
        return self.general(text)

    def differences(self, text: str) -> np.ndarray:
        """count[i] - count[i - 1] for the prefixes of 1..len(text) code points; faster for texts given to learn() before."""
        found = list(self.cut.finditer(text)) if self.cut and any(s in text for s in self.special) else []
        if not found:
            return np.frombuffer(self.ordinary(text), np.int16)
        out, start = [], 0
        for m in found:
            # an unfinished special token is ordinary text, a finished one is one token and cuts the text
            whole = np.frombuffer(self.ordinary(text[start:m.start()]), np.int16)
            part = np.frombuffer(self.ordinary(text[start:m.end() - 1]), np.int16)
            at_end = int(whole.sum(dtype=np.int64)) + 1 - int(part.sum(dtype=np.int64))
            out += [part, np.array([at_end], np.int16)]
            start = m.end()
        out.append(np.frombuffer(self.ordinary(text[start:]), np.int16))
        return np.concatenate(out)


def longest_within(counts: np.ndarray, limit: int) -> int:
    """Code points of the longest prefix of at most ``limit`` tokens."""
    fits = np.flatnonzero(counts <= limit)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_tables(
    df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", limits: Sequence[int] = (), store: bool = True
) -> DataFrame:
    """One row for each text: id, n_bytes, n_tokens, ``cut_<limit>`` (code points of the longest prefix within
    the limit) and, with ``store``, the table as ``prefix_tokens`` (see ``packed_table``).

    ``tokenizer`` is the content of the vocabulary file; it travels with the tasks (a few MB, whatever the data).
    """
    limits = list(limits)
    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    fields += [StructField(f"cut_{n}", LongType()) for n in limits]
    fields += [StructField("prefix_tokens", BinaryType())] if store else []
    shared = shipped(df.sparkSession, PrefixCounter(tokenizer))

    def work():
        counter = shared.value  # stays in the worker with what it has learnt

        def compute(texts):
            sizes, tokens, cuts, tables = [], [], [[] for _ in limits], []
            texts = [t or "" for t in texts]
            counter.learn(texts)
            for t in texts:
                steps = counter.differences(t)
                counts = np.cumsum(steps, dtype=np.int64)
                sizes.append(len(t.encode("utf-8", "surrogatepass")))
                tokens.append(int(counts[-1]) if len(counts) else 0)
                for n, out in zip(limits, cuts):
                    out.append(longest_within(counts, n))
                if store:
                    tables.append(packed_table(steps))
            return [sizes, tokens, *cuts] + ([tables] if store else [])

        return compute

    return per_text(df, text, [id_column], fields, work)


def packed_table(steps: np.ndarray) -> bytes:
    """A table as stored: the bytes of a number (1 or 2), then the differences."""
    width = 1 if not len(steps) or (steps.min() >= -128 and steps.max() <= 127) else 2
    return bytes([width]) + steps.astype(f"<i{width}").tobytes()


def steps_of(table: bytes) -> np.ndarray:
    return np.frombuffer(table, f"<i{table[0]}", offset=1)


def tokens_at(table: bytes, position: int) -> int:
    """Tokens of the first ``position`` code points, from a stored table."""
    return int(steps_of(table)[:position].sum(dtype=np.int64))


def cut_for(table: bytes, budget: int) -> int:
    """Code points of the longest prefix within the budget, from a stored table."""
    return longest_within(np.cumsum(steps_of(table), dtype=np.int64), budget)


def written_tables(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The tables of all texts (id, n_bytes, prefix_tokens), written to the shared folder and read again."""
    path = scratch_dir(df.sparkSession, "prefix-tokens")
    made = prefix_tables(df, tokenizer, id_column, text).select(f"`{id_column}`", "n_bytes", "prefix_tokens")
    made.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def answered(tables: DataFrame, id_column: str = "doc_id", limits: Sequence[int] = ()) -> DataFrame:
    """(id, n_bytes, n_tokens, ``cut_<limit>``, ..) from stored tables, without any text."""
    limits = list(limits)
    fields = [StructField("n_tokens", LongType()), *[StructField(f"cut_{n}", LongType()) for n in limits]]

    def work():
        def compute(stored):
            counts = [np.cumsum(steps_of(t), dtype=np.int64) for t in stored]
            return [[int(c[-1]) if len(c) else 0 for c in counts], *[[longest_within(c, n) for c in counts] for n in limits]]

        return compute

    return per_text(tables, "prefix_tokens", [id_column, "n_bytes"], fields, work)
