"""Byte-level BPE encoding and decoding.

Pre-tokenisation works on arrays, without regular expressions: a batch of
texts becomes one array of code points, a table turns these into classes, and
a scan runs the automaton of the split pattern over all of them.  The scan is
associative: every block of characters is reduced to its transition function
(the state it ends in, for each kind of state before it), the functions are
composed by a prefix scan, and then every block runs from its true state.  A
slice starts where the three states around a character say so.

Slices are merged by the ranks once and cached as their ids; token offsets
come from the lengths of the ids, and decoding copies each token's bytes to
its offset.

The pattern: contractions ('s 't 're 've 'm 'll 'd); letters, numbers or other
characters, each run with at most one space before; white space.

Defined results: a null text is empty and has no ids; one text, however long,
is encoded as a whole; repeated rows give repeated results; an empty table
gives an empty result; other columns, whatever their names, are untouched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import packed

# classes of characters
END, LETTER, STMD, RV, E, LL, NUMBER, OTHER, QUOTE, SPACE, WHITE = range(11)
N_CLASSES = 11
# states: what the match that holds the character is
S_END, S_LETTERS, S_NUMBERS, S_OTHERS, S_SPACE, S_WHITE, S_QUOTE, S_SHORT, S_RV, S_L, S_LONG = range(11)
N_STATES = 11
# states with equal transitions, by one of each
KINDS = [S_END, S_OTHERS, S_QUOTE, S_RV, S_L]
KIND = np.array([0, 0, 0, 1, 1, 0, 2, 0, 3, 4, 0], np.uint8)

#: Code points of white space (fixed values).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def class_table() -> np.ndarray:
    """Class of every code point."""
    major = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE], out[0x20], out[ord("'")] = WHITE, SPACE, QUOTE
    for chars, c in (("stmd", STMD), ("rv", RV), ("e", E), ("l", LL)):
        out[[ord(x) for x in chars]] = c
    return out


def _transitions() -> np.ndarray:
    t = np.empty((N_STATES, N_CLASSES), np.uint8)
    for s in range(N_STATES):
        t[s] = [S_END, *[S_LETTERS] * 5, S_NUMBERS, S_OTHERS, S_OTHERS if s in (S_SPACE, S_OTHERS, S_QUOTE) else S_QUOTE, S_SPACE, S_WHITE]
    t[S_QUOTE, [STMD, RV, LL]] = S_SHORT, S_RV, S_L
    t[S_RV, E] = t[S_L, LL] = S_LONG
    return t


def _starts_here(before: int, here: int, after: int) -> bool:
    """Whether a match starts at a character, from the states of the three."""
    blank = (S_SPACE, S_WHITE)
    if before == S_END or here in (S_END, S_QUOTE):
        return True
    if here == S_LETTERS:
        return before not in (S_LETTERS, S_RV, S_L, S_SPACE)
    if here == S_NUMBERS:
        return before not in (S_NUMBERS, S_SPACE)
    if here == S_OTHERS:
        return before not in (S_OTHERS, S_QUOTE, S_SPACE)
    if here in (S_RV, S_L):
        return after != S_LONG
    if here in blank:  # of a run of white space the last one stays for what follows
        return before not in blank or after not in (*blank, S_END)
    return False  # S_SHORT, S_LONG


TRANSITIONS = _transitions()
STARTS = np.array([_starts_here(b, h, a) for b in range(N_STATES) for h in range(N_STATES) for a in range(N_STATES)])


def scan(classes: np.ndarray, block: int = 256) -> np.ndarray:
    """The state after every character."""
    n, flat = len(classes), TRANSITIONS.ravel().astype(np.uint8)
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    f = np.repeat(np.array(KINDS, np.uint8)[:, None], rows, axis=1)
    for column in grid:  # the transition function of each block, by kind of state before
        f = flat.take(f * np.uint8(N_CLASSES) + column)
    step = 1
    while step < rows:  # functions of blocks 0 to i
        f = np.concatenate([f[:, :step], np.take_along_axis(f[:, step:], KIND[f[:, :-step]].astype(np.intp), axis=0)], axis=1)
        step *= 2
    state = np.concatenate([np.array([S_END], np.uint8), f[0, :-1]])
    out = np.empty((block, rows), np.uint8)
    for i, column in enumerate(grid):
        out[i] = state = flat.take(state * np.uint8(N_CLASSES) + column)
    return np.ascontiguousarray(out.T).ravel()[:n]


def starts(classes: np.ndarray) -> np.ndarray:
    """Positions where matches start; a character of class END is its own."""
    s = scan(classes).astype(np.uint16)
    edge = np.array([S_END], np.uint16)
    before, after = np.concatenate([edge, s[:-1]]), np.concatenate([s[1:], edge])
    return np.flatnonzero(STARTS[(before * N_STATES + s) * N_STATES + after])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: the adjacent pair of least rank, leftmost first, is
    joined until none has a rank.  A heap keeps long slices near-linear."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n <= 32:  # looking at every pair is faster here
        get, none = ranks.get, len(ranks) + (1 << 20)
        cut = list(range(n + 1))
        pair = [get(piece[i: i + 2], none) for i in range(n - 1)]
        while pair and (least := min(pair)) < none:
            i = pair.index(least)
            del cut[i + 1], pair[i]
            if i < len(pair):
                pair[i] = get(piece[cut[i]: cut[i + 2]], none)
            if i:
                pair[i - 1] = get(piece[cut[i - 1]: cut[i + 1]], none)
        return [ranks[piece[a:b]] for a, b in zip(cut, cut[1:])]
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(ranks[piece[i: i + 2]], i, i + 2) for i in range(n - 1) if piece[i: i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != e:
            continue
        alive[j], end[i] = False, e
        if e < n:
            before[e] = i
            if (r := ranks.get(piece[i: end[e]])) is not None:
                heapq.heappush(heap, (r, i, end[e]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p: e])) is not None:
            heapq.heappush(heap, (r, p, e))
    return [ranks[piece[i: end[i]]] for i in range(n) if alive[i]]


class Slices(dict):
    """Ids of slices, as little-endian unsigned 32-bit integers; bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        if len(self) > 400_000:
            self.clear()
        self[piece] = out = np.array(merge(piece.encode("utf-8", "surrogatepass"), self.ranks), "<u4").tobytes()
        return out


class Codec:
    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray):
        self.slices, self.classes = Slices(ranks), classes
        order = sorted(ranks, key=ranks.get)
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.place = np.zeros_like(self.lengths)
        index = np.array([ranks[x] for x in order], np.int64)
        self.lengths[index] = [len(x) for x in order]
        self.place[index] = np.cumsum(self.lengths[index]) - self.lengths[index]
        self.bytes = np.frombuffer(b"".join(order), np.uint8)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in turn; short texts share an array pass."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > 1_000_000:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if not texts:
            return
        joined = "\0".join(texts) + "\0"
        classes = self.classes[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        last = np.cumsum([len(x) + 1 for x in texts]) - 1
        classes[last] = END
        at = starts(classes)
        at_list = at.tolist()
        pieces = [joined[a:b] for a, b in zip(at_list, at_list[1:])]
        ids, first = self.slices.__getitem__, 0
        for stop in np.searchsorted(at, last).tolist():
            yield np.frombuffer(b"".join(map(ids, pieces[first:stop])), "<u4")
            first = stop + 1

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token, and the length of the text at the end."""
        return np.concatenate([np.zeros(1, np.int64), np.cumsum(self.lengths[ids])])

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for i in range(0, len(ids), 200_000):
            part = ids[i: i + 200_000]
            offset = self.offsets(part)
            move = np.repeat(self.place[part] - offset[:-1], self.lengths[part])
            out.append(self.bytes[np.arange(offset[-1]) + move].tobytes())
        return b"".join(out)


def rank_file(path: str) -> dict[bytes, int]:
    """Ranks from lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def vocab_file(path: str) -> dict[bytes, int]:
    """Ranks from a tokenizer file in JSON whose ids are in merge order and
    whose tokens write a byte as one printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"] for x in spec.get("added_tokens", [])}
    return {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def shared_codec(spark, ranks: dict[bytes, int]):
    """Broadcast of what a Codec is made from: the vocabulary (some 50,000
    tokens) and the class table (1.1 MB), which don't grow with the data."""
    return spark.sparkContext.broadcast((ranks, class_table()))


def _digests(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(*shared.value)
        for batch in batches:
            texts = [x if isinstance(x, str) else "" for x in batch["text"]]
            out = [(len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()) for ids in codec.encode(texts)]
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])], axis=1)
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``docs`` (doc_id, text) with ``ids`` and the byte ``offsets`` of the
    tokens (one more than ids)."""
    shared = shared_codec(docs.sparkSession, ranks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(*shared.value)
        for batch in batches:
            ids = list(codec.encode([x if isinstance(x, str) else "" for x in batch["text"]]))
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "ids": [x.astype(np.int32) for x in ids], "offsets": [codec.offsets(x) for x in ids]})
    return _texts(docs).mapInPandas(run, "doc_id long, ids array<int>, offsets array<long>")


def decode(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, bytes) from (doc_id, ids)."""
    shared = shared_codec(tokens.sparkSession, ranks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(*shared.value)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "bytes": [codec.decode(np.asarray(x, np.int64)) for x in batch["ids"]]})
    return tokens.select("doc_id", "ids").mapInPandas(run, "doc_id long, bytes binary")


def _texts(docs: DataFrame) -> DataFrame:
    return packed(docs).select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.text").alias("text"))


def round_trip(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Per row doc_id, n_tokens, and digests of the ids and of what they
    decode to."""
    shared = shared_codec(docs.sparkSession, ranks)
    return _texts(docs).mapInPandas(_digests(shared), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
