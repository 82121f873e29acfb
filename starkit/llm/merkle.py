"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

Leaves are digests of rows; every ``fanout`` consecutive nodes of a group have
the SHA-256 of their digests (as hex text) as their parent, until one node
remains; the groups' roots have a tree of their own above them.  A digest in
hex is exactly one SHA-256 block, so the state of a parent's hash before any of
its child slots is eight words.  Parents retain these states: folding a
replaced child upwards resumes the state before its slot, takes in the
replacement and the siblings to its right, and never reads those to its left.

On Spark:

* leaves are numbered within their group over range partitions, so that a
  group with most of the rows has no task of its own;
* ``CHUNK`` consecutive nodes of a group are one row of the manifest, which
  holds the subtree over them: node digests level by level, and the retained
  states.  The roots of the chunks are the nodes of the next, ``CHUNK`` times
  smaller stage, so 10**12 rows take four stages;
* what folding needs above a chunk is the same for all its leaves, and is one
  path in the chunk's row.  So leaves meet one chunk row each and are folded
  up to the root in one step, ``CHUNK`` at a time.

All stages are written to the shared folder; a lost executor repeats the
chunks of one stage.

Defined results: a null field is ``-``; a null group is a group, the first one;
rows of a group with equal or null order key (null first) are ordered by their
leaf; repeated rows are leaves each; an empty table has no root and gives an
empty result; texts of any length are hashed whole by Spark and never reach
Python; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import batches_of, packed, saved
from starkit.operators.ordered import GROUP, PID, range_split

FANOUT = 2
CHUNK = 4096  # nodes of a chunk, at most


def _fractions(root: int, count: int) -> np.ndarray:
    """First 32 bits of the fractions of the square or cube roots of the first primes."""
    primes = [p for p in range(2, 400) if all(p % d for d in range(2, isqrt(p) + 1))][:count]
    out = []
    for p in primes:
        x = p << 32 * root
        low, high = 0, 1 << 40
        while low < high:  # the integer root of x
            mid = (low + high + 1) // 2
            low, high = (mid, high) if mid ** root <= x else (low, mid - 1)
        out.append(low & 0xFFFFFFFF)
    return np.array(out, np.uint32)


START, ROUND = _fractions(2, 8), _fractions(3, 64)
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
HEX_PAIRS = np.stack([HEX[np.arange(256) >> 4], HEX[np.arange(256) & 15]], 1)


def _turn(x: np.ndarray, a: int, b: int, c: int, shift: bool = False) -> np.ndarray:
    """Rotations to the right by a, b and c (c a plain shift if ``shift``), combined by xor."""
    twice = x.astype(np.uint64) * np.uint64(0x100000001)
    low = ((twice >> np.uint64(a)) ^ (twice >> np.uint64(b))).astype(np.uint32)
    return low ^ (x >> np.uint32(c) if shift else (twice >> np.uint64(c)).astype(np.uint32))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """SHA-256 states (8, n) after one more block (16, n) of 32-bit words."""
    n = block.shape[1]
    w = np.empty((64, n), np.uint32)
    w[:16] = block
    for t in range(16, 64, 2):
        w[t:t + 2] = w[t - 16:t - 14] + _turn(w[t - 15:t - 13], 7, 18, 3, True) + w[t - 7:t - 5] + _turn(w[t - 2:t], 17, 19, 10, True)
    w += ROUND[:, None]
    a, b, c, d, e, f, g, h = np.broadcast_to(state, (8, n))
    for t in range(64):
        x = h + _turn(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + w[t]
        y = _turn(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = x + y, a, b, c, d + x, e, f, g
    return np.stack([a, b, c, d, e, f, g, h]) + state


def blocks(digests: np.ndarray) -> np.ndarray:
    """(n, 32) digest bytes as their hex text: one block (16, n) each."""
    return HEX_PAIRS[digests].reshape(len(digests), 64).view(">u4").T.astype(np.uint32)


def closed(state: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of states (8, n) that have taken in ``taken`` blocks."""
    pad = np.zeros((16, state.shape[1]), np.uint32)
    bits = np.asarray(taken, np.uint64) * np.uint64(512)
    pad[0], pad[14], pad[15] = 0x80000000, bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return as_bytes(compress(state, pad))


def as_bytes(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.T.astype(">u4")).view(np.uint8).reshape(-1, 32)


def as_states(raw: bytes | np.ndarray) -> np.ndarray:
    return np.frombuffer(bytes(raw), ">u4").reshape(-1, 8).T.astype(np.uint32)


def started(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, 1)


def lift(nodes: np.ndarray, fanout: int) -> tuple[np.ndarray, np.ndarray]:
    """Parents of (n, 32) nodes, and their states before slots 1 to fanout - 1,
    (fanout - 1, 8, parents); the state before slot 0 is that of an empty hash."""
    n = len(nodes)
    parents, inputs = -(-n // fanout), blocks(nodes)
    state, before = started(parents), []
    for slot in range(fanout):
        if slot:
            before.append(state.copy())
        children = inputs[:, slot::fanout]
        if children.shape[1]:  # all parents but perhaps the last
            state[:, :children.shape[1]] = compress(state[:, :children.shape[1]], children)
    taken = np.minimum(fanout, n - fanout * np.arange(parents))
    return closed(state, taken), np.array(before)


def depth(n: int, fanout: int) -> int:
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


class Chunk:
    """A row of the manifest: the subtree over consecutive nodes of a group."""

    def __init__(self, nodes: list[np.ndarray], states: list[np.ndarray], fanout: int):
        self.nodes, self.states, self.fanout = nodes, states, fanout

    @classmethod
    def over(cls, bottom: np.ndarray, levels: int, fanout: int) -> Chunk:
        nodes, states = [bottom], []
        for _ in range(levels):
            up, before = lift(nodes[-1], fanout)
            nodes.append(up)
            states.append(before)
        return cls(nodes, states, fanout)

    @classmethod
    def read(cls, row: dict, fanout: int) -> Chunk:
        digests, kept = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32), np.frombuffer(row["states"], np.uint8)
        nodes, states, n, i, j = [], [], row["width"], 0, 0
        for level in range(row["levels"] + 1):
            nodes.append(digests[i:i + n])
            i, n = i + n, -(-n // fanout)
            if level < row["levels"]:
                size = (fanout - 1) * n * 32
                states.append(np.stack([as_states(x) for x in kept[j:j + size].reshape(fanout - 1, -1)]))
                j += size
        return cls(nodes, states, fanout)

    def row(self) -> dict:
        kept = b"".join(as_bytes(s).tobytes() for level in self.states for s in level)
        return {"width": len(self.nodes[0]), "levels": len(self.states), "nodes": b"".join(x.tobytes() for x in self.nodes),
                "states": kept, "root": self.nodes[-1].tobytes()}

    def slots(self, at: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parent, slot and number of children of the parent, of the nodes ``at`` a level."""
        parent, slot = np.divmod(at, self.fanout)
        return parent, slot, np.minimum(self.fanout, len(self.nodes[level]) - parent * self.fanout)

    def path(self, at: int) -> list[dict]:
        """Upwards from a node: its slot, the state before it, and its siblings."""
        out = []
        for level, before in enumerate(self.states):
            parent, slot, n = (int(x) for x in self.slots(np.array(at), level))
            run = self.nodes[level][parent * self.fanout:parent * self.fanout + n]
            state = before[slot - 1, :, parent:parent + 1] if slot else started(1)
            out.append({"slot": slot, "state": as_bytes(state).tobytes(), "siblings": np.delete(run, slot, 0).tobytes()})
            at = parent
        return out

    def fold(self, at: np.ndarray, digests: np.ndarray, proof: Proof) -> np.ndarray:
        """Roots of the chunk with the nodes ``at`` replaced, each by itself."""
        for level, before in enumerate(self.states):
            parent, slot, n = self.slots(at, level)
            state = started(len(at))
            for s in range(1, self.fanout):
                here = slot == s
                state[:, here] = before[s - 1][:, parent[here]]
            state = compress(state, blocks(digests))
            for s in range(self.fanout):
                beside = np.flatnonzero((s != slot) & (s < n))
                sibling = blocks(self.nodes[level][parent[beside] * self.fanout + s])
                proof.take(beside, sibling)
                right = s > slot[beside]
                state[:, beside[right]] = compress(state[:, beside[right]], sibling[:, right])
            digests, at = closed(state, n), parent
        return digests


class Proof:
    """Running hashes over the siblings met on the way up."""

    def __init__(self, n: int):
        self.state, self.taken = started(n), np.zeros(n, np.int64)

    def take(self, rows: np.ndarray, block: np.ndarray) -> None:
        self.state[:, rows] = compress(self.state[:, rows], block)
        self.taken[rows] += 1


def fold_path(path: list[dict], digests: np.ndarray, proof: Proof) -> np.ndarray:
    """Digests folded along one path that all of them share."""
    n, every = len(digests), np.arange(len(digests))
    for step in path:
        siblings = [np.repeat(blocks(x[None]), n, 1) for x in np.frombuffer(step["siblings"], np.uint8).reshape(-1, 32)]
        for sibling in siblings:
            proof.take(every, sibling)
        state = compress(np.repeat(as_states(step["state"]), n, 1), blocks(digests))
        for sibling in siblings[step["slot"]:]:
            state = compress(state, sibling)
        digests = closed(state, np.full(n, len(siblings) + 1))
    return digests


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


PATH = "array<struct<slot:int,state:binary,siblings:binary>>"
CHUNK_ROW = "g long, chunk long, n long, width int, levels int, nodes binary, states binary, root binary"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """SHA-256 of the values, each with its length in bytes before it."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def places(rows: DataFrame, by: str, order: list[Column], of_group: DataFrame | None = None) -> DataFrame:
    """Rows with their place ``pos`` in their group, and what ``of_group`` says
    of the group.  No group is held by one task."""
    ranged = range_split(rows, [by], order)
    counts = saved(ranged.groupBy(PID, GROUP).agg(F.count("*").alias("__n")), "merkle-counts")  # at most groups + partitions rows
    earlier = Window.partitionBy(GROUP).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = counts.select(PID, GROUP, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__carry"))
    if of_group is not None:
        carry = carry.join(of_group, GROUP)
    local = Window.partitionBy(PID, GROUP).orderBy(*order)
    return ranged.join(carry, [PID, GROUP]).withColumn("pos", F.row_number().over(local) - 1 + F.col("__carry")).drop(PID, GROUP, "__carry")


def grouped_leaves(leaves: DataFrame, group: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with the number ``g`` of their group (null first, then
    bytewise), their place ``pos`` in it and its size ``n``; and (g, group)."""
    sizes = leaves.groupBy(group).agg(F.count("*").alias("n")).withColumn("__all", F.lit(0))
    groups = saved(places(saved(sizes, "merkle-sizes"), "__all", [F.col(group).asc_nulls_first()]).select(F.col("pos").alias("g"), group, "n"), "merkle-groups")
    return places(leaves, group, order, groups.select(F.struct(group).alias(GROUP), "g", "n")), groups.drop("n")


def span(fanout: int) -> tuple[int, int]:
    """Levels of a chunk and its width."""
    levels = 1
    while fanout ** (levels + 1) <= CHUNK:
        levels += 1
    return levels, fanout ** levels


def _build(fanout: int, most: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        g, chunk, n = (table[c][0].as_py() for c in ("g", "chunk", "n"))
        row = Chunk.over(_digests(table["digest"]), min(most, depth(n, fanout)), fanout).row()
        return pa.Table.from_pylist([{"g": g, "chunk": chunk, "n": n, **row}], schema=pa.schema(
            [("g", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("width", pa.int32()), ("levels", pa.int32()),
             ("nodes", pa.binary()), ("states", pa.binary()), ("root", pa.binary())]))
    return run


def grow(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """Manifest stages over (g, pos, n, digest), the lowest first, and (g, digest) of the roots."""
    levels, width = span(fanout)
    stages, roots = [], None
    while True:
        chunks = nodes.select("g", F.expr(f"pos div {width}").alias("chunk"), "pos", "n", "digest")
        stage = saved(chunks.groupBy("g", "chunk").applyInArrow(_build(fanout, levels), CHUNK_ROW), "merkle-stage")
        stages.append(stage)
        top = stage.filter(F.col("n") <= width).select("g", F.col("root").alias("digest"))
        roots = top if roots is None else roots.unionByName(top)
        more = stage.filter(F.col("n") > width)
        if more.isEmpty():
            return stages, roots
        nodes = more.select("g", F.col("chunk").alias("pos"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), F.col("root").alias("digest"))


def _node_paths(fanout: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("state", pa.binary()), ("siblings", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk, first = Chunk.read(row, fanout), row["first"]
                for a in range(0, row["width"], 512):
                    at = range(a, min(row["width"], a + 512))
                    yield pa.record_batch([pa.array([row["g"]] * len(at)), pa.array([first + i for i in at]),
                                           pa.array([chunk.path(i) + row["path"] for i in at], kind)], ["g", "pos", "path"])
    return run


def with_paths(stages: list[DataFrame], above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The lowest stage with the path from each chunk's root upwards;
    ``above`` has the path (g, path) from the root of each group."""
    levels, width = span(fanout)
    below = None  # (g, pos, path) of the nodes of the stage above
    for stage in reversed(stages):
        ends = stage.filter(F.col("n") <= width).join(above, "g")
        out = ends if below is None else ends.unionByName(stage.filter(F.col("n") > width).join(below.withColumnRenamed("pos", "chunk"), ["g", "chunk"]), allowMissingColumns=True)
        if stage is stages[0]:
            return out
        rows = out.select("g", (F.col("chunk") * width).alias("first"), "width", "levels", "nodes", "states", "path")
        with batches_of(stage.sparkSession, 8):
            below = saved(rows.mapInArrow(_node_paths(fanout), f"g long, pos long, path {PATH}"), "merkle-paths")


def _fold(fanout: int, kept: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    levels, width = span(fanout)

    def run(leaves: pa.Table, chunks: pa.Table) -> pa.Table:
        row = chunks.to_pylist()[0]
        chunk, folded, proofs = Chunk.read(row, fanout), [], []
        for a in range(0, leaves.num_rows, CHUNK):  # several replacements of a leaf may be asked for
            part = leaves.slice(a, CHUNK)
            proof = Proof(part.num_rows)
            digests = chunk.fold(part["pos"].to_numpy() - row["chunk"] * width, _digests(part["replacement"]), proof)
            folded += [x.tobytes() for x in fold_path(row["path"], digests, proof)]
            proofs += [x.tobytes() for x in closed(proof.state, proof.taken)]
        out = {c: leaves[c] for c in kept} | {c: pa.array(x, pa.binary()) for c, x in (
            ("subroot", [row["subroot"]] * len(folded)), ("folded_root", folded), ("proof", proofs))}
        return pa.table(out)
    return run


def fold(replacements: DataFrame, lowest: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``replacements`` (g, pos, replacement and others) with the root after
    each replacement by itself, the root of its group before, and the SHA-256
    over the siblings on its way.  ``lowest`` comes from :func:`with_paths`,
    with the roots of the groups as ``subroot``."""
    levels, width = span(fanout)
    kept = [c for c in replacements.columns if c != "replacement"]
    schema = ", ".join(f"`{c}` {replacements.schema[c].dataType.simpleString()}" for c in kept)
    chunks = lowest.select("g", "chunk", "width", "levels", "nodes", "states", "path", "subroot").groupBy("g", "chunk")
    asked = replacements.withColumn("chunk", F.expr(f"pos div {width}")).groupBy("g", "chunk")
    return asked.cogroup(chunks).applyInArrow(_fold(fanout, kept), f"{schema}, subroot binary, folded_root binary, proof binary")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS,
             tampered: Mapping[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """Per row the ``order`` column, its leaf, the root of its group (subroot), the
    root, the hash of its proof, the root folded from the leaf with the columns of
    ``tampered`` in place of its own, and whether that is the root."""
    row = packed(docs)
    value = {c: F.col(f"__row.`{c}`") for c in {*fields, group, order}}
    now = {c: F.col(f"__row.`{c}`") for c in fields} | (tampered or {})
    changed = F.lit(False)
    for c in tampered or {}:
        changed = changed | ~now[c].eqNullSafe(value[c])
    leaf_ = leaf(*[value[c] for c in fields])
    leaves = saved(row.select(value[order].alias("key"), value[group].alias("grp"), leaf_.alias("digest"),
                              F.when(changed, leaf(*[now[c] for c in fields])).alias("other"),
                              F.monotonically_increasing_id().alias("row_id")), "merkle-leaves")
    placed, groups = grouped_leaves(leaves, "grp", [F.col("key").asc_nulls_first(), F.col("digest"), F.col("row_id")])
    placed = saved(placed, "merkle-placed")

    stages, subroots = grow(placed, fanout)
    tops = saved(subroots.join(groups, "g"), "merkle-subroots")
    top_nodes = tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(tops.count()).cast("long").alias("n"), "digest")
    top_stages, roots = grow(top_nodes, fanout)
    spark = docs.sparkSession
    nothing_above = roots.select("g", F.array().cast(PATH).alias("path"))
    levels, width = span(fanout)
    top = with_paths(top_stages, nothing_above, fanout).select("g", (F.col("chunk") * width).alias("first"), "width", "levels", "nodes", "states", "path")
    with batches_of(spark, 8):
        above = saved(top.mapInArrow(_node_paths(fanout), f"g long, pos long, path {PATH}").select(F.col("pos").alias("g"), "path"), "merkle-above")
    lowest = saved(with_paths(stages, above, fanout).join(tops.select("g", F.col("digest").alias("subroot")), "g"), "merkle-lowest")

    first = roots.first()  # one digest
    root = F.lit(bytes(first.digest) if first else None).cast("binary")
    folded = fold(placed.select("key", "digest", "g", "pos", F.coalesce("other", "digest").alias("replacement")), lowest, fanout)
    text = {"leaf": F.col("digest"), "subroot": F.col("subroot"), "root": root, "proof_sha256": F.col("proof"), "folded_root": F.col("folded_root")}
    return folded.select(F.col("key").alias(order), *[F.lower(F.hex(c)).alias(name) for name, c in text.items()],
                         F.col("folded_root").eqNullSafe(root).alias("verified"))
