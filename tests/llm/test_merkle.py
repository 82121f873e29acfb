"""The Merkle manifest against hashlib: fan-outs, many small chunks, nulls, ties,
repeated rows, long texts, an empty table and clashing columns."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starkit.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, pos string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def climb(levels, at, digest, fanout):
    proof = []
    for level in levels[:-1]:
        run = level[at // fanout * fanout:(at // fanout + 1) * fanout]
        slot = at % fanout
        proof += run[:slot] + run[slot + 1:]
        digest, at = h(*run[:slot], digest, *run[slot + 1:]), at // fanout
    return digest, proof


def brute(rows, changed, fanout):
    groups = {}
    for r in rows:
        leaf = [h(*map(field, (r[0], r[3], r[2], n, r[1]))) for n in (r[4], changed(r))]
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, *leaf))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels_of([leaf for *_, leaf, _ in sorted(groups[x])], fanout) for x in names}
    top = levels_of([trees[x][-1][0] for x in names], fanout) if names else None
    out = []
    for g, x in enumerate(names):
        for i, (known, key, leaf, other) in enumerate(sorted(groups[x])):
            sub, proof = climb(trees[x], i, other, fanout)
            folded, above = climb(top, g, sub, fanout)
            out.append((key if known else None, leaf, trees[x][-1][0], top[-1][0], h(*proof, *above), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    langs = ["en"] * 6 + ["de", "é", None, "😀", "￮"]
    out = [(i, r.choice([None, "", "ä text", "x" * r.randrange(300)]), r.choice(langs), r.choice(["s", None]), r.choice([None, 9, 99]), "g", "p") for i in range(150)]
    out += [(1000, "only one", "lone", None, -1, None, None), (1001, "long " * 60_000, "en", "s", 5, None, None)]
    return out + [out[3]] * 20 + [(None, "no id", "en", None, 1, None, None), (None, None, None, None, None, None, None), (5, "same id", "en", "s", 3, None, None)]


@pytest.mark.parametrize("fanout,chunk", [(2, 4096), (2, 4), (3, 9), (5, 8)])
def test_manifest(spark, rows, monkeypatch, fanout, chunk):
    monkeypatch.setattr(merkle, "CHUNK", chunk)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    n = F.col("__row.n_chars")
    out = merkle.manifest(docs, tampered={"n_chars": F.when(F.col("__row.doc_id") % 3 == 0, n + 1).otherwise(n)}, fanout=fanout)
    expected = brute(rows, lambda r: r[4] + 1 if r[0] is not None and r[0] % 3 == 0 and r[4] is not None else r[4], fanout)
    got = sorted(map(tuple, out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)
    assert got == expected and not all(r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_single(spark, rows, n):
    docs = spark.createDataFrame(rows[:n], SCHEMA)
    got = [tuple(r) for r in merkle.manifest(docs).collect()]
    assert got == brute(rows[:n], lambda r: r[4], 2)


def test_states_are_those_of_the_library():
    """Folding resumes a retained state; a state is what the hash is after the blocks before the slot."""
    import numpy as np

    nodes = np.random.default_rng(1).integers(0, 256, (7, 32), dtype=np.uint8)
    up, before = merkle.lift(nodes, 4)
    assert [x.tobytes().hex() for x in up] == [h(*[x.tobytes().hex() for x in nodes[i:i + 4]]) for i in (0, 4)]
    state = merkle.compress(before[1][:, 1:], merkle.blocks(nodes[6:7]))  # slot 2 of the second parent
    assert (merkle.closed(state, np.array([3])) == up[1:]).all()
