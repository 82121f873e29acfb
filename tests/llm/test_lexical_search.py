"""Ranked search against brute force: ties, nulls, repeated rows, long texts, many
shards and blocks, empty tables and clashing columns; and that intervals are left closed."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from starkit.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, item_id string, rank int", "item_id long, text string, q string, n string"


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    r = random.Random(9)
    vocab = ["Ünï", "naïve", "İx", "\x80a", "K", "ſ", "x1", "42", "día"] + ["".join(r.choice("abCDe") for _ in range(r.randint(1, 4))) for _ in range(150)]
    prose = lambda n: r.choice(" -\n_'").join(r.choice(vocab) for _ in range(n))
    docs = [(i, prose(r.choice([1, 3, 20, 60]))) for i in r.sample(range(-50, 2000), 300)]
    docs += [(3000 + i, docs[7][1]) for i in range(90)] + [docs[9]] * 30 + [(None, docs[7][1]), (None, None), (5000, ""), (5001, "?! \x00 \x7f"), (5002, prose(40_000))]
    items = [(i, prose(r.choice([1, 5, 30]))) for i in range(12)] + [(50, docs[7][1]), (51, None), (52, "zzzzz nowhere"), (53, ""), (54, docs[9][1]), (54, docs[9][1]), (None, "K ſ")]
    return docs, items


@pytest.mark.parametrize("k,postings,items_a_block", [(50, 1_000_000, 1000), (7, 300, 5), (1, 50, 1000)])
def test_search(spark, tables, monkeypatch, k, postings, items_a_block):
    monkeypatch.setattr(lexical_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", items_a_block)
    monkeypatch.setattr(lexical_search, "WIDTH", 4)
    docs, items = tables
    out = lexical_search.search(spark.createDataFrame([(*x, "c", 1) for x in docs], DOCS).repartition(3), spark.createDataFrame([(*x, "c", "c") for x in items], ITEMS), k)
    assert sorted(map(tuple, out.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute(docs, items, k)


def test_empty_tables(spark, tables):
    docs, items = (spark.createDataFrame([(*x, None, None) for x in rows], schema) for rows, schema in zip(tables, (DOCS, ITEMS)))
    assert lexical_search.search(docs.limit(0), items).count() == lexical_search.search(docs, items.limit(0)).count() == 0


def test_intervals_that_cannot_win_stay_closed():
    """Range maxima bound the intervals: a search scores a small share of the documents."""
    r = np.random.default_rng(2)
    n_docs, vocabulary, per_doc = 4000, 400, 12
    terms_ = np.concatenate([r.choice(vocabulary, per_doc, replace=False) for _ in range(n_docs)]).astype(np.int32)
    tfs = r.geometric(0.5, len(terms_))
    n = np.add.reduceat(tfs, np.arange(0, len(tfs), per_doc))
    shard = lexical_search.Shard(list(range(n_docs)), n, np.full(n_docs, per_doc), terms_, tfs, vocabulary, n_docs, int(n.sum()))
    query, weight = np.array([3, 50, 333]), np.array([3000, 2000, 2500])
    best = lexical_search.Best(10)
    scored = lexical_search.search_shard(shard, query, weight, best)
    exact = np.zeros(n_docs, np.int64)
    for t, w in zip(query, weight):
        lo, hi = shard.first[t], shard.first[t + 1]
        exact[shard.doc[lo:hi]] += w * shard.impact[lo:hi]
    assert best.score.tolist() == sorted(exact.tolist())[::-1][:10] and scored < np.count_nonzero(exact)
    for lo, hi in r.integers(0, len(terms_), (200, 2)):
        a, b = shard.first[terms_[lo]], shard.first[terms_[lo] + 1]
        x, y = sorted((a + lo % (b - a), a + hi % (b - a) + 1))
        top, at = shard.maxima(np.array([x]), np.array([y]))
        assert top[0] == shard.impact[x:y].max(initial=0) and (x == y or (x <= at[0] < y and shard.impact[at[0]] == top[0]))
