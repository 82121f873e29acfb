"""Substring deduplication by level-wise doubling.

A window of ``width`` words that starts at two or more places is repeated,
and every word it covers goes.  Window lengths double from a quarter of the
width (9, 18, 35 for 35); a window is hashed at one length only if its parts
were repeated at the length before, so nearly all text drops out early.

* Level 1 looks at anchors: of the 9-word windows inside each 35-word window
  the one with the least hash (all on ties).  Equal 35-word windows have equal
  anchors at the same place, so a repeated window has a repeated anchor, and
  one position in 14 is shuffled, not every one.
* Level 2 extends a repeated anchor to 18 words to the right and to the left.
  A 35-word window around it holds one of the two at least.
* Level 3 hashes all 35-word windows whose 18-word parts were repeated and
  removes those that start twice or more.

Occurrences are counted with map-side sums, then joined back: a passage that
a third of all documents share is a skewed join key that Spark splits, never
a group in one task.  Level 3 sends back the windows found once, which are
few, so the copies of a frequent passage don't return either.

Documents are identified by doc_id and a hash of their text.  Defined
results: a null text has no words; rows that repeat doc_id and text are
copies of each other, so their windows are repeated; an empty table gives an
empty result; other columns are untouched.  Windows are compared by 64-bit
hashes at three lengths, so unequal windows pass only if all three collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import packed, saved, small_or_none, tidy

WIDTH = 35
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


class WordIds(dict):
    """64-bit ids of words, computed once each; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def split_words(text) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of a text; bytes.split() splits at just these."""
    return text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []


def word_ids(words: list[bytes], ids: WordIds) -> np.ndarray:
    return np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the multiplier and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(1 << 16, 2 * n)
            self.up = np.cumprod(np.full(size, MULTIPLIER, np.uint64), dtype=np.uint64)
            self.down = np.cumprod(np.full(size, pow(MULTIPLIER, -1, 1 << 64), np.uint64), dtype=np.uint64)
        return self.up[:n], self.down[:n]


class Windows:
    """Hashes of all windows of a document, any length, in O(1) each."""

    def __init__(self, ids: np.ndarray, powers: Powers):
        up, self.down = powers(len(ids))
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(ids * up, out=self.sums[1:])

    def at(self, start: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.down[start]).view(np.int64)

    def all(self, length: int) -> np.ndarray:
        """Of all places."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n]).view(np.int64)


def _sliding(x: np.ndarray, width: int, f) -> np.ndarray:
    """f over every ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        x, span = f(x[:-span], x[span:]), span * 2
    return f(x[: len(x) - (width - span)], x[width - span:]) if span < width else x


def anchors(first: np.ndarray, around: int) -> np.ndarray:
    """Positions whose hash is the least of some ``around`` neighbours."""
    least = _sliding(first, around, np.minimum)
    edge = np.full(around - 1, np.iinfo(first.dtype).min, first.dtype)
    most = _sliding(np.concatenate([edge, least, edge]), around, np.maximum)
    return np.flatnonzero(first == most)


def _levels(width: int) -> tuple[int, int]:
    return -(-width // 4), -(-width // 2)


class Rows:
    """Collects arrays of rows for each document, and makes one frame of many."""

    def __init__(self, *columns: str):
        self.columns, self.parts, self.owners, self.size = columns, [], [], 0

    def add(self, doc, key, *arrays: np.ndarray) -> None:
        self.parts.append(arrays)
        self.owners.append((doc, key, len(arrays[0])))
        self.size += len(arrays[0])

    def frame(self) -> pd.DataFrame:
        doc, key, n = zip(*self.owners)
        out = {"doc": pd.Series(doc, dtype="Int64").repeat(n).array, "key": np.repeat(np.array(key, np.int64), n)}
        out |= {c: np.concatenate(x) for c, x in zip(self.columns, zip(*self.parts))}
        self.parts, self.owners, self.size = [], [], 0
        return pd.DataFrame(out)


def anchor_rows(width: int):
    """mapInPandas function: documents to their anchors, one row each; the
    18-word hashes are 0 where the document ends before."""
    l1, l2 = _levels(width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, powers, rows = WordIds(), Powers(), Rows("pos", "h1", "right", "left")
        for batch in batches:
            for doc, key, text in zip(batch["doc"], batch["key"], batch["text"]):
                w = split_words(text)
                if len(w) < width:
                    continue
                win = Windows(word_ids(w, ids), powers)
                first = win.all(l1)
                pos = anchors(first, width - l1 + 1)
                right, left = np.zeros((2, len(pos)), np.int64)
                ok = pos + l2 <= len(w)
                right[ok] = win.at(pos[ok], l2)
                start = pos + l1 - l2
                ok = start >= 0
                left[ok] = win.at(start[ok], l2)
                rows.add(doc, key, pos.astype(np.int32), first[pos], right, left)
                if rows.size > 100_000:
                    yield rows.frame()
        if rows.size:
            yield rows.frame()
    return run


def _candidates(n: int, pos: np.ndarray, right: np.ndarray, left: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows whose parts were repeated at level 2: around an
    anchor, the right part must be if the window holds it, so the left."""
    l1, l2 = _levels(width)
    mark = np.zeros(n - width + 1, bool)
    for offset in range(width - l1 + 1):
        ok = np.ones(len(pos), bool)
        if offset + l2 <= width:
            ok &= right
        if offset + l1 - l2 >= 0:
            ok &= left
        start = pos[ok] - offset
        mark[start[(start >= 0) & (start < len(mark))]] = True
    return np.flatnonzero(mark)


def window_rows(width: int):
    """mapInPandas function: documents with their repeated anchors to the
    hashes of their candidate windows, each with its count in the document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, powers, rows = WordIds(), Powers(), Rows("h", "c")
        for batch in batches:
            for doc, key, text, marks in zip(batch["doc"], batch["key"], batch["text"], batch["marks"]):
                w = split_words(text)
                start = _starts(len(w), marks, width)
                if len(start):
                    rows.add(doc, key, *np.unique(Windows(word_ids(w, ids), powers).at(start, width), return_counts=True))
                if rows.size > 100_000:
                    yield rows.frame()
        if rows.size:
            yield rows.frame()
    return run


def _starts(n: int, marks, width: int) -> np.ndarray:
    """``marks`` holds 4 * position + 2 * right + left."""
    m = np.asarray(marks, np.int64)
    return _candidates(n, m >> 2, (m & 2) > 0, (m & 1) > 0, width)


def outcome(width: int, texts: bool):
    """pandas UDF (text, marks, once) -> what is left of the document."""
    types = "n_words long, n_removed long, kept_sha256 string, kept_text string"

    @F.pandas_udf(types)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        ids, powers = WordIds(), Powers()
        for batch in batches:
            out = []
            for text, marks, once in zip(*batch):
                w = split_words(text)
                n, gone = len(w), 0
                if marks is not None:
                    start = _starts(n, marks, width)
                    if once is not None and len(start):
                        start = start[~np.isin(Windows(word_ids(w, ids), powers).at(start, width), np.asarray(once, np.int64))]
                    cover = np.zeros(n + 1, np.int64)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + width, -1)
                    keep = np.cumsum(cover[:-1]) == 0
                    gone, w = int((~keep).sum()), [x for x, k in zip(w, keep.tolist()) if k]
                left = b" ".join(w)
                kept = (left.decode("utf-8", "surrogatepass") if gone else text) if texts else None
                out.append((n, gone, hashlib.sha256(left).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` occurs twice or more.  The list of keys is
    written, so that both sides of the join are plain shuffles, of which Spark
    splits the partition of a frequent key."""
    twice = saved(rows.groupBy(key).agg(F.count("*").alias("__n")).filter("__n > 1").select(key), "twice")
    return rows.join(twice, key)


def repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, key, marks, once) of the documents with repeated parts: anchors
    that lead to candidate windows, and hashes of candidates found once."""
    level1 = saved(docs.select("doc", "key", "text").mapInPandas(
        anchor_rows(width), "doc long, key long, pos int, h1 long, right long, left long"), "anchors")
    alive = _repeated(level1, "h1")
    sides = alive.select("doc", "key", "pos", F.explode(F.array(
        F.struct(F.lit(2).alias("side"), F.col("right").alias("h2")), F.struct(F.lit(1).alias("side"), F.col("left").alias("h2")))).alias("s"))
    sides = sides.select("doc", "key", "pos", "s.side", F.xxhash64("s.side", "s.h2").alias("h2"), (F.col("s.h2") == 0).alias("none"))
    level2 = _repeated(saved(sides.filter("not none").drop("none"), "sides"), "h2")
    marks = level2.groupBy("doc", "key", "pos").agg(F.max(F.when(F.col("side") == 2, 2).otherwise(0)).alias("r"), F.max(F.when(F.col("side") == 1, 1).otherwise(0)).alias("l"))
    marks = saved(marks.groupBy("doc", "key").agg(F.collect_list(F.col("pos") * 4 + F.col("r") + F.col("l")).alias("marks")), "marks")
    ids = small_or_none(marks.select(F.col("doc").alias("__doc"), F.col("key").alias("__key")))
    marked = docs.select("doc", "key", "text")  # leaves the other texts out of the shuffle, if the list is small
    marked = marked.join(ids, (F.col("key") == F.col("__key")) & F.col("doc").eqNullSafe(F.col("__doc")), "left_semi") if ids is not None else marked
    level3 = joined(marked, marks, "inner").mapInPandas(window_rows(width), "doc long, key long, h long, c long")
    level3 = saved(level3, "windows")
    once = level3.groupBy("h").agg(F.sum("c").alias("n"), F.first("doc").alias("doc"), F.first("key").alias("key")).filter("n = 1")
    once = saved(once.groupBy("doc", "key").agg(F.collect_list("h").alias("once")), "once")
    return joined(marks, once, "left")


def joined(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on (doc, key), null doc ids equal."""
    b = b.withColumnsRenamed({"doc": "__doc", "key": "__key"})
    return a.join(b, (F.col("key") == F.col("__key")) & F.col("doc").eqNullSafe(F.col("__doc")), how).drop("__doc", "__key")


def _keyed(docs: DataFrame) -> DataFrame:
    text: Column = F.col("__row.text")
    return packed(docs).select("__row", F.col("__row.doc_id").alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"))


def substring_dedup(docs: DataFrame, width: int = WIDTH, keep_rows: bool = False) -> DataFrame:
    """Per row doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space); with ``keep_rows`` also ``__row`` and ``kept_text``, the
    text as it was where nothing went, else the kept words joined by spaces."""
    keyed = _keyed(docs)
    rows = joined(keyed if keep_rows else keyed.drop("__row"), repeats(keyed, width), "left")
    rows = rows.withColumn("__o", outcome(width, keep_rows)("text", "marks", "once"))
    return rows.select(*["__row"] * keep_rows, F.col("doc").alias("doc_id"), "__o.n_words", "__o.n_removed", "__o.kept_sha256", *["__o.kept_text"] * keep_rows)


@tidy
def remove_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without repeated passages, with their columns;
    ``n_chars``, if there is one, follows the text."""
    out = substring_dedup(docs, keep_rows=True).withColumn("n_chars", F.length("kept_text").cast("long"))
    new = {"text": F.col("kept_text"), "n_chars": F.col("n_chars")}
    return out.select(*[new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])
