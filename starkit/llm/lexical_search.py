"""Ranked lexical search by best-first document intervals over posting lists
with range-maximum sparse tables.

1. Documents are tokenised once; those terms that an item has keep their
   occurrences, and the numbers of documents, of terms and of documents a term
   come from group-bys over all documents.
2. A task takes its documents ``SHARD_POSTINGS`` postings at a time and builds
   the posting lists of these: documents by ascending id, the impact of each
   posting, and a sparse table of the positions of range maxima.
3. For each item a search starts with one interval, all documents of the shard.
   An interval is bounded by the sum of its lists' range maxima, weighted.  The
   interval of the greatest bound (``WIDTH`` of them at a time, for the sake
   of vector operations) is split at the document of its largest impact: that
   document is scored, and two range-maximum look-ups a list bound what
   lies before and after it.  Intervals that cannot hold one of the best ``k``
   any more are never opened, and what a task has found before raises the bar in
   its later shards.  An interval whose lists are all empty has the bound 0.
4. A task returns the best ``k`` an item at most; a window per item ranks them.

Scores are 64-bit integers, so nothing depends on the order of additions.
Items come in blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` terms;
a block's terms are what the tasks get as a broadcast, and all that reaches the
driver: at most one row a term.  The documents are read once a block.

Defined results: a null or empty text has no terms, whether document or item,
and ranks nowhere and returns nothing; a term counts once in an item; each row
is a document or an item of its own, also where ids repeat; a null doc_id is
the last of equal scores; whole texts are read, whatever their length; without
documents or items the result is empty; other columns are untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import batches_of, packed, saved

SHARD_POSTINGS = 1_000_000
SHARD_DOCS = 16_384
WIDTH = 64
BLOCK_ITEMS = 1_000
BLOCK_TERMS = 500_000

#: Bytes of UTF-8 that belong to terms stay, A-Z in lower case; all others separate.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(x))) for x in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("q"), batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["q", "item_id", "terms"])


def _occurrences(shared):
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            ids, n, terms, tfs = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                counts = Counter(terms_of(text.as_py()))
                found = [(t, c) for x, c in counts.items() if (t := number.get(x)) is not None]
                if counts:
                    ids.append(doc)
                    n.append(counts.total())
                    terms.append([t for t, _ in found])
                    tfs.append([c for _, c in found])
            yield pa.record_batch([pa.array(ids, pa.int64()), *map(pa.array, (n, terms, tfs), kinds)], ["doc_id", "n", "terms", "tfs"])
    return run


class Shard:
    """Posting lists of some documents, with sparse tables of their maxima."""

    def __init__(self, ids: list[int | None], n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, vocabulary: int, all_docs: int, all_terms: int):
        no_id, known = np.array([x is None for x in ids]), np.array([x or 0 for x in ids], np.int64)
        order = np.lexsort((known, no_id))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.no_id, self.ids, self.docs = no_id[order], known[order], len(ids)
        doc = np.repeat(place, sizes)
        key = terms.astype(np.int64) * self.docs + doc
        by_key = np.argsort(key)
        self.key, self.doc = key[by_key], doc[by_key]
        length = 50 + 50 * n * all_docs // all_terms
        tf = tfs[by_key]
        self.impact = 1_000_000_000 * tf // (1000 * tf + 20 * length[order][self.doc])
        self.first = np.searchsorted(self.key, np.arange(vocabulary + 1, dtype=np.int64) * self.docs)
        longest = int(np.diff(self.first).max(initial=0))
        self.table = [np.arange(len(self.key), dtype=np.int32)]
        while 1 << len(self.table) <= longest:
            below, half = self.table[-1], 1 << (len(self.table) - 1)
            left, right = below[:-half], below[half:]
            self.table.append(np.where(self.impact[left] >= self.impact[right], left, right))

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest impact in each range of postings (0 if empty), and its position."""
        best, at = np.zeros(lo.shape, np.int64), np.zeros(lo.shape, np.int64)
        size = hi - lo
        level = np.frexp(np.maximum(size, 1))[1] - 1
        for j in np.unique(level[size > 0]):
            here = (level == j) & (size > 0)
            a, b = self.table[j][lo[here]], self.table[j][hi[here] - (1 << int(j))]
            at[here] = np.where(self.impact[a] >= self.impact[b], a, b)
            best[here] = self.impact[at[here]]
        return best, at


class Best:
    """The best documents of an item so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.no_id, self.ids = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    @property
    def bar(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        use = score >= max(1, self.bar)
        score, no_id, ids = (np.concatenate([old, new[use]]) for old, new in ((self.score, score), (self.no_id, no_id), (self.ids, ids)))
        order = np.lexsort((ids, no_id, -score))[:self.k]
        self.score, self.no_id, self.ids = score[order], no_id[order], ids[order]

    def open(self, bound: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether an interval with this bound, and this least id, may hold a better document."""
        if len(self.score) < self.k:
            return bound > 0
        earlier = (no_id < self.no_id[-1]) | ((no_id == self.no_id[-1]) & (ids < self.ids[-1]))
        return (bound > self.bar) | ((bound == self.bar) & earlier)


def search_shard(shard: Shard, terms: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Take the shard's documents for one item into ``best``; returns how many were scored."""
    held = shard.first[terms + 1] > shard.first[terms]
    terms, weight = terms[held], weight[held]
    lo, hi = shard.first[terms][None], shard.first[terms + 1][None]
    if not len(terms):
        return 0
    start, scored = np.array([0]), 0
    top, at = shard.maxima(lo, hi)
    bound, at = top @ weight, shard.doc[at[:, (top * weight).argmax()]]
    while True:
        alive = np.flatnonzero(best.open(bound, shard.no_id[start], shard.ids[start]))
        if not len(alive):
            return scored
        lo, hi, start, bound, at = (x[alive] for x in (lo, hi, start, bound, at))
        now = np.argpartition(-bound, WIDTH)[:WIDTH] if len(bound) > WIDTH else np.arange(len(bound))
        d = at[now]
        p = np.searchsorted(shard.key, terms * shard.docs + d[:, None])
        inside = np.minimum(p, len(shard.key) - 1)
        hit = (p < hi[now]) & (shard.doc[inside] == d[:, None])
        best.add(np.where(hit, shard.impact[inside], 0) @ weight, shard.no_id[d], shard.ids[d])
        scored += len(d)
        halves = np.concatenate([lo[now], p + hit]), np.concatenate([p, hi[now]]), np.concatenate([start[now], np.minimum(d + 1, shard.docs - 1)])
        top, where = shard.maxima(*halves[:2])
        largest = shard.doc[where[np.arange(len(top)), (top * weight).argmax(1)]]
        keep = np.ones(len(bound), bool)
        keep[now] = False
        lo, hi, start, bound, at = (np.concatenate([x[keep], y]) for x, y in zip((lo, hi, start, bound, at), (*halves, top @ weight, largest)))


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, vocabulary, all_docs, all_terms = shared.value
        best = {q: Best(k) for q, _, _ in items}
        pending, postings, docs = [], 0, 0

        def take() -> None:
            table = pa.Table.from_batches(pending)
            lists = {c: table[c].combine_chunks() for c in ("terms", "tfs")}
            shard = Shard(table["doc_id"].to_pylist(), table["n"].to_numpy(), lists["terms"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
                          lists["terms"].flatten().to_numpy(), lists["tfs"].flatten().to_numpy(), vocabulary, all_docs, all_terms)
            for q, terms, weight in items:
                search_shard(shard, terms, weight, best[q])

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                pending.append(part)
                postings, docs = postings + len(part.column("terms").flatten()), docs + part.num_rows
                if postings >= SHARD_POSTINGS or docs >= SHARD_DOCS:
                    take()
                    pending, postings, docs = [], 0, 0
        if pending:
            take()
        for q, _, _ in items:
            b = best[q]
            if len(b.score):
                yield pa.record_batch([pa.array([q] * len(b.score), pa.int64()), pa.array(b.ids, mask=b.no_id), pa.array(b.score)], ["q", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text):
    item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    texts = packed(docs).select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.text").cast("binary").alias("text"))
    asked = packed(items).select(F.monotonically_increasing_id().alias("q"), F.col("__row.item_id").alias("item_id"), F.col("__row.text").cast("binary").alias("text"))
    asked = saved(asked.mapInArrow(_item_terms, f"q long, item_id {asked.schema['item_id'].dataType.simpleString()}, terms array<binary>"), "search-items")
    size = asked.agg(F.count("*").alias("n"), F.sum(F.size("terms")).alias("terms")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-(size.terms or 0) // BLOCK_TERMS))
    out = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block).collect()
        words = sorted({bytes(t) for r in rows for t in r.terms})
        number = {x: i for i, x in enumerate(words)}
        with batches_of(spark, 256):
            found = saved(texts.mapInArrow(_occurrences(spark.sparkContext.broadcast(number)), "doc_id long, n long, terms array<int>, tfs array<bigint>"), "search-postings")
        total = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(words), np.int64)
        for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most a row a term of the block
            df[r.t] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        queries = []
        for r in rows:
            t = np.array([number[bytes(x)] for x in r.terms], np.int64)
            queries.append((r.q, t, weight[t]))
        shared = spark.sparkContext.broadcast((queries, len(words), total.docs, total.terms))
        with batches_of(spark, 1024):
            part = saved(found.filter(F.size("terms") > 0).mapInArrow(_search(shared, k), "q long, doc_id long, score long"), "search-found")
        out = part if out is None else out.unionByName(part)
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
