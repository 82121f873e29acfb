"""Near-duplicate documents by MinHash with tensored banding.

A table key is made of one key of a first small collection and one of a
second: 8 keys of 3 minhashes and 11 keys of 3 give 88 tables of 6 minhashes,
for which only 57 minhashes are computed.  Two texts with similarity 0.8 share
a table key with probability (1 - 0.488^8) * (1 - 0.488^11) = 0.996, and more
above.

Distinct shingle sets are the nodes (grouped with map-side combine), so copies
never meet again; the texts of a doc_id that is repeated are nodes linked with
each other.  Keys that two nodes have are found by a count, and only those rows
go on: a few in a hundred.  Candidates are then verified on the full sets:

* In ``STAR_ROUNDS`` rounds every bucket has one centre, and a node is compared
  with the centre that it meets most often, one pair a node and round.  Large
  groups of copies become one component here.
* What is left are buckets whose members lie in several components.  Tasks of
  bounded size compare the sketches of their members, 64 bytes of minhashes
  each, a bucket at a time, and return for each member with a close one in another
  component the first of those that it reaches: a row a member, not a pair.
  These rows group the members to families.
* The full sets of a family's members are compared with one another in tiles of
  bounded size, by a product of their membership matrices over the shingles that
  two of them share, and a tile returns the links of a spanning forest.

So a bucket of thousands of copies costs one pair a member, no pair becomes a
row, and no link between components is lost: whatever pair was not verified
lies in one component, or has sketches that agree in fewer than ``LEAST_EQUAL``
bytes (at similarity 0.8 with a probability of about 1e-7).  Members of a family
that are too different to link are compared with all of it, in tiles: that work,
though no row or task, grows with the square of the family.

Defined results: a null or empty text has an empty set and links with
nothing; rows with the same doc_id count as one document; a null doc_id
links with nothing, has a null component and is kept; an empty table gives
an empty result; very long texts have as many shingles as they have, a tile then
holds fewer of them; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batches_of, packed, partitions, saved, small_or_none, tidy
from starkit.llm.substring_dedup import WordIds, mixed, word_ids

FIRST, SECOND = (8, 3), (11, 3)  # keys, and minhashes of a key, in the two collections
STAR_ROUNDS = 2         # rounds in which a member meets one centre only
SKETCH = 64             # bytes, of a minhash each
LEAST_EQUAL = 34        # of them, in a pair whose sets are compared; 51 are expected at similarity 0.8
TILE = 2_048            # members of a bucket that a task compares with as many others
SET_TILE, TILE_BYTES = 1_024, 8 << 20  # sets, and bytes of sets, that a task compares with as many others
COLUMNS = 8_192         # shingles of a membership matrix at a time
BLOCK_BYTES, BLOCK_PAIRS = 8 << 20, 20_000  # sets, and about as many pairs, that a task compares
BATCH = 1_000           # texts or sets a Python worker is handed at a time


def shingles(text, size: int, ids: WordIds) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not w:
        return np.empty(0, np.uint64)
    h = word_ids(w, ids)
    size = min(size, len(w))
    out = np.full(len(h) - size + 1, np.uint64(size))
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i: len(h) - size + 1 + i]
    out = mixed(out)
    return np.unique(out)


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_229)
    n = max(SKETCH, FIRST[0] * FIRST[1] + SECOND[0] * SECOND[1])
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minhashes(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """One minhash for each (mul, add)."""
    out = np.full(len(mul), np.iinfo(np.uint64).max)
    for i in range(0, len(s), 2048):  # keeps the table small for a long text
        np.minimum(out, (mul[:, None] * s[None, i: i + 2048] + add[:, None]).min(axis=1), out=out)
    return out


def features(size: int):
    """mapInPandas function: (doc_id, text) to the size of its shingle set, a
    128-bit hash of the set, the sketch and the table keys."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, (mul, add) = WordIds(), _seeds()
        table = np.arange(FIRST[0] * SECOND[0], dtype=np.uint64)
        cut = FIRST[0] * FIRST[1]

        def combined(m: np.ndarray, keys: int) -> np.ndarray:
            m, out = m.reshape(keys, -1), np.zeros(keys, np.uint64)
            for column in m.T:
                out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + column)
            return out
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                s = shingles(text, size, ids)
                if not len(s):
                    out.append((doc, 0, None, None, None))
                    continue
                m = minhashes(s, mul, add)
                with np.errstate(over="ignore"):
                    sketch = (mixed(m[:SKETCH]) >> np.uint64(17)).astype(np.uint8).tobytes()
                    u, v = combined(m[:cut], FIRST[0]), combined(m[cut: cut + SECOND[0] * SECOND[1]], SECOND[0])
                    keys = mixed((u[:, None] * np.uint64(3) + v[None, :]).ravel() + table * np.uint64(0xD6E8FEB86659FD93))
                out.append((doc, len(s), xxhash.xxh3_128_digest(s.tobytes()), sketch, keys.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "n", "set_id", "sketch", "keys"]).astype({"doc_id": "Int64"})
    return run


def set_rows(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for batch in batches:
            sets = [shingles(t, size, ids).tobytes() for t in batch["text"]]
            mine = [xxhash.xxh3_128_digest(s) == wanted for s, wanted in zip(sets, batch["set_id"])]  # a doc_id may have other texts
            yield pd.DataFrame({"node": batch["node"], "s": sets})[mine]
    return run


def compared(percent: int):
    """cogroup function: sets (node, s) of a block and rows (b, sb, others) to
    the pairs with 100 * intersection >= percent * union."""
    def run(sets: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        of = {node: np.frombuffer(s, np.uint64) for node, s in zip(sets["node"], sets["s"])}
        out = []
        for b, s, others in zip(rows["b"], rows["sb"], rows["others"]):
            y = np.frombuffer(s, np.uint64)
            found = [(a, of[a]) for a in others]
            n = np.array([len(x) for _, x in found])
            x = np.concatenate([x for _, x in found])  # no more than the sets of the block
            same = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
            both = np.add.reduceat(same, np.cumsum(n) - n, dtype=np.int64)
            out.extend((found[i][0], b) for i in np.flatnonzero(100 * both >= percent * (n + len(y) - both)))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``links`` (a, b) and ``labels`` (node,
    comp): the least label that each can reach.  A round gives every label
    the least label linked with it and then follows these pointers one step
    further, so chains shrink by a power of the rounds."""
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = labels.unionByName(nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("comp")))
    la, lb = (labels.select(F.col("node").alias(x), F.col("comp").alias("c" + x)) for x in "ab")
    edges = links.join(la, "a").join(lb, "b").select(F.col("ca").alias("x"), F.col("cb").alias("y"))
    edges = saved(edges.filter("x != y").distinct(), "edges")
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("p")).select("x", F.least("x", "p").alias("p"))
        step = low.alias("l").join(low.alias("r"), F.col("l.p") == F.col("r.x"), "left").select(F.col("l.x").alias("x"), F.coalesce("r.p", "l.p").alias("p"))
        step = saved(step, "step")
        moved = edges.join(step.withColumnsRenamed({"p": "px"}), "x").join(step.select(F.col("x").alias("y"), F.col("p").alias("py")), "y")
        edges = saved(moved.select(F.col("px").alias("x"), F.col("py").alias("y")).filter("x != y").distinct(), "edges")
        labels = labels.join(step.withColumnsRenamed({"x": "comp"}), "comp", "left").select("node", F.coalesce("p", "comp").alias("comp"))
    return saved(labels, "labels")


def groups_of(work: Callable[[dict[str, np.ndarray], np.ndarray], tuple[np.ndarray, np.ndarray]], columns: list[str], by: list[str]):
    """mapInArrow function over rows sorted on ``by``: ``work`` gets the columns
    of whole groups, and where the groups start, and returns links (a, b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None

        def take(table: pa.Table) -> pa.RecordBatch:
            keys = [table[c].to_numpy() for c in by]
            changed = np.logical_or.reduce([k[1:] != k[:-1] for k in keys]) if table.num_rows > 1 else np.empty(0, bool)
            a, b = work({c: table[c].combine_chunks() for c in columns}, np.flatnonzero(np.r_[True, changed]))
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            last = np.ones(table.num_rows, bool)
            for c in by:
                k = table[c].to_numpy()
                last &= k == k[-1]
            cut = int(last.argmax())  # the last group may go on in the next batch
            if cut:
                yield take(table.slice(0, cut))
            left = table.slice(cut)
        if left is not None and left.num_rows:
            yield take(left)
    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least position that each of n can reach by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _close(percent: int):
    """Members of buckets to (member, first of those that it reaches by close sketches in other components)."""
    def work(rows: dict, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        node, comp, n = (rows[c].to_numpy(zero_copy_only=False) for c in ("node", "comp", "n"))
        sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(node)]))
        found_a, found_b, at = [], [], np.arange(len(node))
        for step in range(1, len(node)):
            at = at[at + step < len(node)]
            at = at[group[at] == group[at + step]]  # members that still have one so far behind them
            if not len(at):
                break
            x, y = at, at + step
            keep = (comp[x] != comp[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
            x, y = x[keep], y[keep]
            same = (sketch[x] == sketch[y]).sum(1) >= LEAST_EQUAL
            found_a.append(x[same])
            found_b.append(y[same])
        a, b = (np.concatenate(f) if f else np.empty(0, np.int64) for f in (found_a, found_b))
        root = forest(a, b, len(node))
        met = np.flatnonzero(root != np.arange(len(node)))
        return node[met], node[root[met]]
    return work


def _linked(percent: int):
    """Sets of tiles to the links of a spanning forest of those with 100 * intersection >= percent * union."""
    def work(rows: dict, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        node, out = rows["node"].to_numpy(zero_copy_only=False), []
        for start, end in zip(starts, np.r_[starts[1:], len(node)]):
            sets = [np.frombuffer(x, np.uint64) for x in rows["s"].slice(start, end - start).to_pylist()]
            n = np.array([len(x) for x in sets])
            values, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            member = np.repeat(np.arange(len(sets)), n)[times[at] > 1]
            column = (np.cumsum(times > 1) - 1)[at[times[at] > 1]]
            both = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers far below 2**24
            for c in range(0, int((times > 1).sum()), COLUMNS):
                here = (column >= c) & (column < c + COLUMNS)
                matrix = np.zeros((len(sets), COLUMNS), np.float32)
                matrix[member[here], column[here] - c] = 1
                both += matrix @ matrix.T
            a, b = np.nonzero(np.triu(100 * both.astype(np.int64) >= percent * (n[:, None] + n[None] - both.astype(np.int64)), 1))
            root = forest(a, b, len(sets))
            met = np.flatnonzero(root != np.arange(len(sets)))
            out.append((node[start + met], node[start + root[met]]))
        return tuple(np.concatenate(x) for x in zip(*out))
    return work


def sets_of(wanted: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, s): the full sets of the nodes ``wanted`` (node, doc, set_id), saved."""
    if small_or_none(wanted) is not None:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, docs["doc_id"] == wanted["doc"]).select("node", "set_id", "text")
    with batches_of(docs.sparkSession, BATCH):
        return saved(texts.mapInPandas(set_rows(shingle), "node long, s binary").dropDuplicates(["node"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""
    # a set goes once to each block that has pairs of it, not once a pair
    size = sets.agg(F.coalesce(F.sum(F.length("s")), F.lit(0))).first()[0]
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(max(1, size // BLOCK_BYTES)).cast("long"))
    placed = pairs.withColumn("block", block("a"))
    shares = placed.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_PAIRS).alias("shares"))
    placed = placed.join(shares, "block").withColumn("share", F.pmod(F.xxhash64("b"), "shares"))
    rows = placed.groupBy("block", "share", "b").agg(F.collect_list("a").alias("others"))
    rows = rows.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    left = sets.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi").withColumn("block", block("node")).join(shares, "block")
    left = left.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).select("block", "share", "node", "s")
    return left.groupBy("block", "share").cogroup(rows.groupBy("block", "share")).applyInPandas(compared(percent), "a long, b long").distinct()


def relabelled(known: DataFrame, labels: DataFrame) -> DataFrame:
    now = labels.select("node", F.col("comp").alias("__now"))
    return known.join(now, "node", "left").withColumn("comp", F.coalesce("__now", "comp")).drop("__now")


def unresolved(known: DataFrame) -> DataFrame:
    """Buckets whose members lie in several components: key, members, the
    component with the most of them (main), and the number of the others."""
    parts = known.groupBy("key", "comp").agg(F.count("*").alias("k"))
    state = parts.groupBy("key").agg(F.sum("k").alias("members"), F.max(F.struct("k", "comp")).alias("largest"), F.count("*").alias("parts"))
    return state.filter("parts > 1").select("key", "members", F.col("largest.comp").alias("main"), (F.col("members") - F.col("largest.k")).alias("rest"))


def star_pairs(known: DataFrame, round_: int) -> DataFrame:
    """A pair (centre, node) for each node of an unresolved bucket: with the centre, of its
    buckets, that it meets most often and that is not in its component."""
    order = F.xxhash64("node", F.lit(round_)) if round_ else F.col("node")
    centres = known.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "comp")).alias("c"), F.min("comp").alias("x"), F.max("comp").alias("y"))
    centres = centres.filter("x != y").select("key", F.col("c.node").alias("c"), F.col("c.comp").alias("cc"))
    met = known.join(centres, "key").filter("comp != cc").groupBy("node", "c").agg(F.count("*").alias("k"))
    best = met.groupBy("node").agg(F.max(F.struct("k", (-F.col("c")).alias("c"))).alias("m")).select("node", (-F.col("m.c")).alias("c"))
    return best.select(F.col("c").alias("a"), F.col("node").alias("b"))  # many have one centre, which shares split by b


def tiled(known: DataFrame, state: DataFrame) -> DataFrame:
    """Members of unresolved buckets, dealt to tiles (i, j).  A bucket of up to
    two tiles' members is one; in a larger one, blocks of the members outside its main
    component meet all blocks."""
    here = known.join(state, "key")
    rest, main = F.ceil(F.col("rest") / TILE), F.ceil((F.col("members") - F.col("rest")) / TILE)
    mine = lambda n: F.pmod(F.xxhash64("node"), n)
    zero, pair = F.lit(0).cast("long"), lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    of_main = F.transform(F.sequence(zero, rest - 1), lambda i: pair(i, mine(main)))
    of_rest = F.concat(F.transform(F.sequence(zero, main - 1), lambda j: pair(mine(rest), j)),
                       F.transform(F.sequence(zero, rest - 1), lambda i: pair(F.least(i, mine(rest)), main + F.greatest(i, mine(rest)))))
    tiles = F.when(F.col("members") <= 2 * TILE, F.array(pair(zero, zero))).when(F.col("comp") == F.col("main"), of_main).otherwise(of_rest)
    return here.withColumn("t", F.explode(tiles)).select("key", "t.i", "t.j", "node", "comp")


def families(members: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """(node, comp): members of unresolved buckets that are close to others, and
    the family in which they are; ``facts`` has (node, n, sketch)."""
    by = ["key", "i", "j"]
    rows = members.join(facts, "node").repartition(partitions(members.sparkSession), *by).sortWithinPartitions(*by)
    close = rows.select(*by, "node", "comp", "n", "sketch").mapInArrow(groups_of(_close(percent), ["node", "comp", "n", "sketch"], by), "a long, b long")
    edges = saved(close.distinct(), "close")
    return components(edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).limit(0), edges)


def family_links(family: DataFrame, facts: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) inside the families (node, comp), by their full sets."""
    sets = sets_of(family.join(facts, "node").select("node", "doc", "set_id"), docs, shingle)
    size = family.join(facts, "node").groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    size = size.withColumn("blocks", F.greatest(F.ceil(F.col("m") / SET_TILE), F.ceil(F.col("n") * 8 / TILE_BYTES)))
    placed = family.join(size.select("comp", "blocks"), "comp").withColumn("mine", F.pmod(F.xxhash64("node"), "blocks"))
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("mine")).alias("i"), F.greatest(x, F.col("mine")).alias("j")))
    by = ["comp", "i", "j"]
    rows = placed.withColumn("t", F.explode(tiles)).select("comp", "t.i", "t.j", "node").join(sets, "node")
    rows = rows.repartition(partitions(docs.sparkSession), *by).sortWithinPartitions(*by)
    with batches_of(docs.sparkSession, BATCH):
        return saved(rows.select(*by, "node", "s").mapInArrow(groups_of(_linked(percent), ["node", "s"], by), "a long, b long"), "links")


@tidy
def near_dedup(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row doc_id, n_shingles, component_id, kept."""
    docs = packed(docs).select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.text").alias("text"))
    spark = docs.sparkSession
    with batches_of(spark, BATCH):
        rows = saved(docs.mapInPandas(features(shingle), "doc_id long, n long, set_id binary, sketch binary, keys array<long>"), "features")
    usable = rows.filter("n > 0 and doc_id is not null")
    classes = usable.groupBy("set_id").agg(F.min("doc_id").alias("doc")).withColumn("node", F.monotonically_increasing_id())
    classes = saved(classes, "classes")  # makes the numbers of the sets data
    facts = usable.join(classes, "set_id").filter("doc_id = doc").dropDuplicates(["node"])
    facts = saved(facts.select("node", "doc", "set_id", "n", "sketch", "keys"), "nodes")
    # the texts of one doc_id are one document
    of_doc = usable.join(classes, "set_id").groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x != y").select("doc_id", "x")
    same_doc = usable.join(of_doc, "doc_id").join(classes, "set_id").filter("node != x").select(F.col("x").alias("a"), F.col("node").alias("b"))
    nothing = facts.select("node", F.col("node").alias("comp")).limit(0)
    labels = components(nothing, saved(same_doc.distinct(), "same-doc"))

    active = facts.select(F.explode("keys").alias("key"), "node")
    shared = active.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key").hint("merge")
    known = saved(active.join(shared, "key"), "shared").withColumn("comp", F.col("node"))
    facts = facts.drop("keys")
    for round_ in range(STAR_ROUNDS):
        known = relabelled(known, labels)
        pairs = saved(star_pairs(known, round_), "pairs")
        if not pairs.limit(1).count():
            break
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(facts, "node").select("node", "doc", "set_id")
        sets = sets_of(saved(wanted, "wanted"), docs, shingle)
        with batches_of(spark, BATCH):
            labels = components(labels, saved(verified(pairs, sets, percent), "links"))
    known = saved(relabelled(known, labels), "known")
    state = saved(unresolved(known), "state")
    family = families(tiled(known, state), facts.select("node", "n", "sketch"), percent)
    labels = components(labels, family_links(family, facts, docs, shingle, percent))

    placed = classes.join(labels, "node", "left").select("set_id", "doc", F.coalesce("comp", "node").alias("comp"))
    lowest = placed.groupBy("comp").agg(F.min("doc").alias("component_id"))
    final = placed.join(lowest, "comp").select("set_id", "component_id")
    out = rows.filter("n > 0").join(final, "set_id", "left").select("doc_id", "n", "component_id")
    out = out.unionByName(rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, with its columns."""
    gone = near_dedup(docs).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    rows = packed(docs)
    return rows.join(gone, F.col("__row.doc_id") == F.col("__gone"), "left_anti").select("__row.*")
