"""Near duplicates: repeated doc_ids, families that do not link, small tiles, and recall."""

import random

import numpy as np
import pytest

from starkit.llm import minhash_dedup as mh


def shingle_set(text, size):
    w = (text or "").lower().split()
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(rows, size, percent=80):
    """(doc_id, n, component): rows of one doc_id are one document."""
    sets = [shingle_set(t, size) for _, t in rows]
    comp = {i: i for i, _ in rows if i is not None}
    links = [(rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0])
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in comp:
        before = dict(comp)
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
        if comp == before:
            break
    return sorted([(i, len(s), comp.get(i), i is None or comp[i] == i) for (i, _), s in zip(rows, sets)], key=str)


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=str)


def test_a_doc_id_with_several_texts_is_one_document(spark):
    r = random.Random(1)
    w, v = (" ".join(r.choice("abcdefghij") * r.randint(1, 5) for _ in range(60)) for _ in range(2))
    rows = [(1, w), (1, v), (2, w + " more"), (3, v + " other"), (4, "else"), (None, w), (1, w)]
    out = got(mh.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2))
    assert out == brute(rows, 2)
    assert {x[0]: x[2] for x in out if x[0]} == {1: 1, 2: 1, 3: 1, 4: 4}


@pytest.fixture(scope="module")
def family():
    """Copies of a text with edits in a tenth to a third of it: some link, most do
    not; and long texts that differ little."""
    r = random.Random(5)
    base = [f"w{r.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(260):
        w = list(base)
        for at in r.sample(range(120), r.choice([1, 3, 6, 12, 16, 20])):
            w[at] = f"x{r.randrange(30)}"
        rows.append((i * 7 % 1009, " ".join(w)))
    long_ = [f"l{r.randrange(900)}" for _ in range(9000)]
    rows += [(5000 + i, " ".join(long_[i * 300:])) for i in range(6)] + [(6000 + i, " ".join(f"u{r.randrange(50)}" for _ in range(40))) for i in range(60)]
    return rows


@pytest.mark.parametrize("rounds,tile,set_tile", [(2, 2048, 1024), (0, 8, 7), (1, 3, 50)])
def test_families_in_tiles(spark, family, monkeypatch, rounds, tile, set_tile):
    monkeypatch.setattr(mh, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(mh, "TILE", tile)
    monkeypatch.setattr(mh, "SET_TILE", set_tile)
    monkeypatch.setattr(mh, "COLUMNS", 64)
    out = got(mh.near_dedup(spark.createDataFrame(family, "doc_id long, text string").repartition(3), shingle=2))
    assert out == brute(family, 2)


def test_recall_at_the_threshold(spark):
    """3,000 pairs of a similarity from 0.80 to 0.85: at least 0.99 are found
    (0.996 a pair at 0.80 by the tables)."""
    r = np.random.default_rng(3)
    rows, pairs = [], 0
    for p in range(3000):
        n = int(r.integers(150, 260))
        a = [f"{p}.{i}" for i in range(n)]
        b = list(a)
        edits = round(n * float(r.uniform(0.082, 0.108)))  # from the end, so each costs one shingle on both sides
        b[n - edits:] = [f"{p}:{i}" for i in range(edits)]
        x, y = shingle_set(" ".join(a), 1), shingle_set(" ".join(b), 1)
        j = len(x & y) / len(x | y)
        if 0.8 <= j <= 0.85:
            rows += [(2 * p, " ".join(a)), (2 * p + 1, " ".join(b))]
            pairs += 1
    assert pairs > 2000
    out = mh.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), shingle=1)
    found = out.filter("doc_id % 2 = 1 and component_id = doc_id - 1").count()
    assert out.filter("component_id not in (doc_id, doc_id - 1)").count() == 0
    assert found >= 0.99 * pairs, (found, pairs)
