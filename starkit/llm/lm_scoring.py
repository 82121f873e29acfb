"""Scores of a class-based bigram language model, after Brown et al.

P(w_i | w_{i-1}) = P(c_i | c_{i-1}) * P(w_i | c_i), the classes by exchange.

* Words are counted once, all of them.  Every word that occurs ``LEAST_COUNT``
  times or more in the training text is an exchange unit of its own; only rarer
  and unseen words share the back-off unit of their ending (one of ``ENDINGS``),
  so every word, seen or not, has a class.
* The ``KNOWN_WORDS`` most frequent words are broadcast, a number that doesn't
  grow with the input (if ties or counts over 1000 exceed it, those with a share
  of ``COUNT_SHARE``).  The texts are written once as numbers, in blocks: the place
  of a known word, or a place in the block's own list of its other words.
* No word bigrams are counted.  A unit's gain needs its counts with each class
  only: every round reads the numbers, adds up (unit, class before or after it) in
  each task, and merges the sums of the tasks, a range of units at a time, ``FAN``
  at a time.
* The exchange starts from classes of coarse units, the words with a share of at
  least ``UNIT_SHARE`` and the endings of all others.  Their pairs, whose number doesn't
  grow with the input, are counted once, and these rounds read the pairs.  Then all known units move:
  every round, half of them (by hash) go to the class that raises the likelihood of
  the class bigrams most, given all others.  As they move at once, a class takes in a
  share of its own size only, and a round that lowers the likelihood is taken back
  and repeated with half that share; until few would move or the rounds are done.
* The words beyond the broadcast lie in a table.  Given the classes of the known
  words, those with ``LEAST_COUNT`` occurrences move at once, each to its best class
  by its counts with the classes around it; a neighbour that isn't known counts with
  the class of its ending.  A join a word and block then brings their classes and
  counts back to the blocks.  No key of it can be hot, each word having
  less than the share of a known one.
* P(c | c') has additive smoothing over classes, P(w | c) over the class's
  words and one unseen word: (n + 0.5) / (N_c + 0.5 * (V_c + 1)).  An end
  token of its own class closes each text, and the start counts as an end.

Words are compared by 64-bit hashes.  Defined results: a null or empty text
is its end token alone; a null doc_id counts as the empty string in the
split; with no training rows every count is 0; an empty table gives an empty
result; rows with the same doc_id and text get the same score each; a very long
text is counted and scored whole, as a block of its own; other columns are
untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starkit.llm.common import batches_of, packed, removed_after, saved, tidy

UNIT_SHARE = 1e-4       # of the coarse units
COUNT_SHARE = 1e-6
KNOWN_WORDS = 500_000
LEAST_COUNT = 3         # occurrences in the training text that make a word a unit of its own
ENDINGS = 2048
CLASSES = 48            # of words; the end token has one more
ROUNDS = 10
WORD_ROUNDS = 6         # of the exchange of all words
LEAST_MOVED = 0.01      # share of a round's units below which the exchange ends
INFLOW = 0.5            # of a class's tokens that may move into it in a round
ADD = 0.5

END = -1                # word of the end token; hashes are masked to be positive
END_UNIT = ENDINGS      # units: endings, the end token, known words from FIRST_KNOWN on
FIRST_KNOWN = ENDINGS + 1  # known words are numbered by falling count
K = CLASSES + 1
CODES = 2 * K + 1       # of a unit's contexts: the class before it, K + the class after it, 2 K the unit itself

BLOCK_TOKENS = 250_000  # tokens of a block, unless the texts split at once have more
CHARS = 2_000_000       # bytes of texts that are split at once, unless one text has more
HELD_WORDS = 1_000_000  # words that a task holds before it adds up their counts
DENSE = FIRST_KNOWN + 8192  # units that a task adds up in an array; the others are sorted
HELD = 4_000_000        # contexts that a task holds before it sorts them
TEXTS = 512             # rows of texts that Python holds at once
BLOCKS = 4              # blocks, or rows of sums
RANGE = 1024            # units of a row of sums
PAIR_RANGE = 64         # first units of a row of pairs
FAN = 32                # rows of sums merged at once


def split_of(doc_id: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about CHARS bytes of text at a time."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.flatnonzero(np.diff(np.cumsum(sizes) // CHARS)) + 1
    for start, stop in pairwise([0, *bounds.tolist(), len(batch)]):
        yield batch.slice(start, stop - start)


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of texts with A-Z lower-cased, as places among the distinct ones, these, and how many
    words each text has.  Arrow's ASCII functions know just the white space and capitals of the contract."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    some = pc.greater(pc.binary_length(texts), 0)
    split = pc.ascii_split_whitespace(texts.filter(some))
    n = np.zeros(len(texts), np.int64)
    n[some.to_numpy(zero_copy_only=False)] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    words = split.flatten().dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False), words.dictionary, n


MASK = np.uint64((1 << 63) - 1)


def _hashed(words: pa.Array) -> np.ndarray:
    words = words.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & MASK).view(np.int64)


class Endings:
    """Unit of each word's ending, for words that are no unit of their own: the
    last two bytes and whether it is short.  Each ending's is computed once."""

    def __init__(self):
        self.units = np.full((257, 256, 2), -1, np.int32)  # by the byte before the last, 256 for none, the last, and whether it is long

    def __call__(self, words: pa.Array) -> np.ndarray:
        if not len(words):
            return np.zeros(0, np.int32)
        words = words.cast(pa.large_binary())
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]
        text, size, stop = np.frombuffer(words.buffers()[2], np.uint8), np.diff(bounds), bounds[1:]
        at = np.where(size > 1, text[np.maximum(stop - 2, 0)].astype(np.int64), 256), text[stop - 1], (size >= 6).astype(np.int64)
        new = np.flatnonzero(self.units[at] < 0)
        for before, last, long in set(zip(*(x[new].tolist() for x in at))):
            self.units[before, last, long] = zlib.crc32(bytes([before, last][before > 255:]) + (b"l" if long else b"s")) % ENDINGS
        return self.units[at]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (word, ending, n), summed within a task as far as it holds them."""
    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def out(counts: pa.Table, ends: int) -> pa.RecordBatch:
        words = counts["word"].combine_chunks()
        return pa.RecordBatch.from_arrays([pa.array(np.append(_hashed(words), END)), pa.array(np.append(endings(words), np.int32(END))),
                                           pa.array(np.append(counts["n"].to_numpy(), ends))], ["word", "ending", "n"])
    held, size, ends, endings = [], 0, 0, Endings()
    for batch in batches:
        for some in _sliced(batch):
            places, words, _ = _words(some["text"])
            held.append(pa.table({"word": words, "n": np.bincount(places, minlength=len(words)).astype(np.int64)}))
            size, ends = size + len(words), ends + len(some)
            if size > HELD_WORDS:
                held = [summed()]
                size = len(held[0])
                if size > HELD_WORDS // 2:
                    yield out(held[0], ends)
                    held, size, ends = [], 0, 0
    if held:
        yield out(summed(), ends)


class Lookup:
    """Place of word hashes in a sorted array, or -1."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(x), -1)
        at = np.minimum(np.searchsorted(self.hashes, x), len(self.hashes) - 1)
        return np.where(self.hashes[at] == x, at, -1)


NUMBERS = "train boolean, docs array<string>, lengths array<int>, ids binary, words array<long>, endings array<int>"


def _numbers(shared):
    """mapInArrow function: texts as blocks of numbers.  Of V known words number i is
    the i-th, V the end token, V + 1 + j the j-th of the block's other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, place = shared.value
        find, endings, v = Lookup(hashes), Endings(), len(hashes)
        held = {True: ([], [], [], [], []), False: ([], [], [], [], [])}  # docs, lengths, numbers, hashes and endings of other words
        size = {True: 0, False: 0}

        def out(train: bool) -> pa.RecordBatch:
            docs, lengths, numbers, others, ends = held[train]
            n, other = np.concatenate(numbers), np.concatenate(others)
            words, first, local = np.unique(other, return_index=True, return_inverse=True)
            n[n > v] = v + 1 + local
            row = {"train": pa.array([train]), "docs": pa.array([docs], pa.list_(pa.string())), "lengths": pa.array([np.concatenate(lengths)], pa.list_(pa.int32())),
                   "ids": pa.array([n.astype(np.int32).tobytes()]), "words": pa.array([words], pa.list_(pa.int64())),
                   "endings": pa.array([np.concatenate(ends)[first]], pa.list_(pa.int32()))}
            held[train], size[train] = ([], [], [], [], []), 0
            return pa.RecordBatch.from_pydict(row)
        for batch in batches:
            for some in _sliced(batch):
                places, words, n = _words(some["text"])
                hashed, ending = _hashed(words), endings(words)
                at = find(hashed)
                number = np.append(np.where(at < 0, v + 1, place[at]) if v else np.full(len(at), v + 1), v)
                ends = np.cumsum(n + 1) - 1
                token = np.full(len(places) + len(n), len(words), np.int64)  # the end token unless a word
                token[np.delete(np.arange(len(token)), ends)] = places
                trains = some["train"].to_numpy(zero_copy_only=False).astype(bool)
                for train in np.unique(trains).tolist():
                    chosen = trains == train
                    mine = token[np.repeat(chosen, n + 1)]
                    numbers = number[mine]
                    away = mine[numbers > v]
                    held[train][0].extend(some["doc"].filter(pa.array(chosen)).to_pylist())
                    for into, value in zip(held[train][1:], ((n[chosen] + 1).astype(np.int32), numbers, hashed[away], ending[away])):
                        into.append(value)
                    size[train] += len(mine)
                    if size[train] > BLOCK_TOKENS:
                        yield out(train)
        for train in size:
            if size[train]:
                yield out(train)
    return run


def _with_start(ids: bytes, end: int) -> np.ndarray:
    return np.concatenate([[end], np.frombuffer(ids, np.int32)])


def _rows_of_sums(keys: np.ndarray, ns: np.ndarray, table: np.ndarray | None, width: int = CODES * RANGE) -> pd.DataFrame:
    """Sorted keys (unit * CODES + code) and their sums as a row for each range of
    units, and the table of class pairs as row -1."""
    bounds = np.flatnonzero(np.diff(keys // width, prepend=-1))
    rows = [(int(k[0] // width), k.tobytes(), n.tobytes()) for k, n in zip(np.split(keys, bounds[1:]), np.split(ns, bounds[1:])) if len(k)]
    if table is not None:
        rows.append((-1, b"", table.tobytes()))
    return pd.DataFrame(rows, columns=["range", "keys", "ns"])


def _contexts(shared):
    """mapInPandas function: sums of the contexts of the units that may move, and of
    the pairs of classes, from blocks of training text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit_of, class_of, moves = shared.value
        table, dense, held, size = np.zeros(K * K, np.int64), np.zeros(DENSE * CODES, np.int64), [], 0
        for batch in batches:
            for ids, endings in zip(batch["ids"], batch["endings"]):
                u = np.concatenate([unit_of, [END_UNIT], endings]).astype(np.int32)[_with_start(ids, len(unit_of))]
                c = class_of[u].astype(np.int64)
                table += np.bincount(c[:-1] * K + c[1:], minlength=K * K)
                if moves is None:
                    continue
                m, same = moves[u], u[:-1] == u[1:]
                left, right, own = (np.flatnonzero(x) for x in (m[1:] & ~same, m[:-1] & ~same, m[1:] & same))
                base = u.astype(np.int64) * CODES
                keys = np.concatenate([base[left + 1] + c[left], base[right] + K + c[right + 1], base[own] + 2 * K])
                low = keys < len(dense)
                dense += np.bincount(keys[low], minlength=len(dense))
                held.append(keys[~low])
                size += len(held[-1])
                if size > HELD:
                    yield _rows_of_sums(*np.unique(np.concatenate(held), return_counts=True), None)
                    held, size = [], 0
        at = np.flatnonzero(dense)
        rest = np.unique(np.concatenate(held), return_counts=True) if held else (at[:0], at[:0])
        yield _rows_of_sums(np.concatenate([at, rest[0]]), np.concatenate([dense[at], rest[1]]), table)
    return run


def _summed(keys: list[np.ndarray], ns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and the sums of their numbers."""
    codes, at = np.unique(np.concatenate(keys), return_inverse=True)
    return codes, np.bincount(at, weights=np.concatenate(ns), minlength=len(codes)).astype(np.int64)


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of sums of one range as one."""
    first = rows.iloc[0]
    ns = [np.frombuffer(x, np.int64) for x in rows["ns"]]
    if first["range"] < 0:
        keys, sums = b"", np.sum(ns, axis=0)
    else:
        codes, sums = _summed([np.frombuffer(x, np.int64) for x in rows["keys"]], ns)
        keys = codes.tobytes()
    return pd.DataFrame([(first["range"], first["turn"], keys, sums.tobytes())], columns=["range", "turn", "keys", "ns"])


SUMS = "range long, keys binary, ns binary"


@contextmanager
def broadcast(spark: SparkSession, value) -> Iterator[Broadcast]:
    """``value`` for the jobs run inside; at their end its copies go, the driver's too."""
    shared = spark.sparkContext.broadcast(value)
    yield shared
    shared.destroy()


def merged(rows: DataFrame) -> DataFrame:
    """The tasks' rows of sums as a row for each range."""
    order = F.row_number().over(Window.partitionBy("range").orderBy("part", "place"))
    rows = saved(rows.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "sums")
    numbered = rows.select("range", "part", "place", order.alias("turn"))  # without the sums
    most = numbered.agg(F.coalesce(F.max("turn"), F.lit(0))).first()[0]
    rows = rows.join(numbered, ["range", "part", "place"]).select("range", F.col("turn").cast("long"), "keys", "ns")
    while True:
        rows = rows.withColumn("turn", F.expr(f"turn div {FAN}")).groupBy("range", "turn").applyInPandas(_merged, "range long, turn long, keys binary, ns binary")
        rows, most = saved(rows, "sums"), most // FAN
        if most == 0:
            return rows


def contexts(blocks: DataFrame, unit_of: np.ndarray, class_of: np.ndarray, moves: np.ndarray | None) -> DataFrame:
    """A row of sums for each range of units, and the class pairs as row -1."""
    with broadcast(blocks.sparkSession, (unit_of, class_of.astype(np.int8), moves)) as shared:
        return merged(blocks.filter("train").select("ids", "endings").mapInPandas(_contexts(shared), SUMS))


def _unit_pairs(shared):
    """mapInPandas function: sums of the pairs of units that follow each other (first * width + second)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit_of, width = shared.value
        held, size = [], 0
        for batch in batches:
            for ids, endings in zip(batch["ids"], batch["endings"]):
                u = np.concatenate([unit_of, [END_UNIT], endings])[_with_start(ids, len(unit_of))].astype(np.int64)
                held.append(np.unique(u[:-1] * width + u[1:], return_counts=True))
                size += len(held[-1][0])
                if size > HELD // 2:
                    held = [_summed(*zip(*held))]
                    size = len(held[0][0])
                    if size > HELD // 4:
                        yield _rows_of_sums(*held[0], None, width * PAIR_RANGE)
                        held, size = [], 0
        if held:
            yield _rows_of_sums(*_summed(*zip(*held)), None, width * PAIR_RANGE)
    return run


def unit_pairs(blocks: DataFrame, unit_of: np.ndarray, width: int) -> DataFrame:
    """How often units below ``width`` follow each other, a row for each range of first units: of
    coarse units, whose number is bounded, so the rounds don't read the texts again."""
    with broadcast(blocks.sparkSession, (unit_of, width)) as shared:
        return merged(blocks.filter("train").select("ids", "endings").mapInPandas(_unit_pairs(shared), SUMS))


def _pair_contexts(shared):
    """mapInPandas function: as _contexts, from the pairs of units."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width, class_of, moves = shared.value
        table, dense = np.zeros(K * K, np.int64), np.zeros(width * CODES, np.int64)
        for batch in batches:
            for keys, ns in zip(batch["keys"], batch["ns"]):
                (a, b), n = np.divmod(np.frombuffer(keys, np.int64), width), np.frombuffer(ns, np.int64)
                before, after = class_of[a].astype(np.int64), class_of[b].astype(np.int64)
                table += np.bincount(before * K + after, weights=n, minlength=K * K).astype(np.int64)
                if moves is None:
                    continue
                same = a == b
                for chosen, code in ((moves[b] & ~same, b * CODES + before), (moves[a] & ~same, a * CODES + K + after), (moves[b] & same, b * CODES + 2 * K)):
                    dense += np.bincount(code[chosen], weights=n[chosen], minlength=len(dense)).astype(np.int64)
        at = np.flatnonzero(dense)
        if table.any():  # a task without pairs has no sums
            yield _rows_of_sums(at, dense[at], table)
    return run


def pair_contexts(pairs: DataFrame, width: int, class_of: np.ndarray, moves: np.ndarray | None) -> DataFrame:
    """As :func:`contexts`, of the pairs that :func:`unit_pairs` counted.  A task has at least one
    of their few rows, so the tasks' sums are merged at once."""
    with broadcast(pairs.sparkSession, (width, class_of[:width].astype(np.int8), None if moves is None else moves[:width])) as shared:
        rows = pairs.select("keys", "ns").mapInPandas(_pair_contexts(shared), SUMS).withColumn("turn", F.lit(0).cast("long"))
        return saved(rows.groupBy("range").applyInPandas(_merged, "range long, turn long, keys binary, ns binary"), "sums")


def _phi(x):
    logs = np.maximum(x, 1e-9)
    np.log(logs, out=logs)
    logs *= x
    return logs


def best_class(dense: np.ndarray, c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class, but that of the end token, that raises the likelihood most, of each
    unit: its counts by code (a row of ``dense``), its class, all pairs of classes."""
    l, r, own = dense[:, :K], dense[:, K: 2 * K], dense[:, 2 * K]
    gain, here = np.zeros((len(c), K)), np.arange(len(c))
    for x, other, t in ((l, r, table), (r, l, table.T)):
        at, i = np.nonzero(x)
        v, at_c, pairs = x[at, i], c[at], np.arange(len(at))
        n, was = t[i], _phi(t)[i]  # without the unit; its bigrams with itself apart
        n[pairs, at_c] -= v
        inner = np.flatnonzero(i == at_c)
        n[inner] -= other[at[inner]]
        n[inner, at_c[inner]] -= own[at[inner]]
        was[pairs, at_c], was[inner] = _phi(n[pairs, at_c]), _phi(n[inner])  # the others are those of the table
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
        if len(first):
            gain[at[first]] += np.add.reduceat(_phi(n + v[:, None]) - was, first)
    total = l.sum(1) + own
    d = np.tile(np.diag(table), (len(c), 1))
    d[here, c] -= l[here, c] + r[here, c] + own
    gain += _phi(d + l + r + own[:, None]) - _phi(d + l) - _phi(d + r) + _phi(d)
    for sums in (table.sum(1), table.sum(0)):  # what comes before and after stays in its class's sum
        rest, was = np.tile(sums, (len(c), 1)), np.tile(_phi(sums), (len(c), 1))
        rest[here, c] -= total
        was[here, c] = _phi(rest[here, c])
        gain -= _phi(rest + total[:, None]) - was
    return gain[:, : K - 1].argmax(1)


def _gains(shared):
    """mapInPandas function: (unit, class, n) of the best class of each unit."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, class_of = shared.value
        for batch in batches:
            for r, keys, ns in zip(batch["range"], batch["keys"], batch["ns"]):
                dense = np.zeros(RANGE * CODES)
                dense[np.frombuffer(keys, np.int64) - r * RANGE * CODES] = np.frombuffer(ns, np.int64)
                dense = dense.reshape(RANGE, CODES)
                at = np.flatnonzero(dense.any(1))
                unit = r * RANGE + at
                n = dense[at][:, :K].sum(1) + dense[at, 2 * K]
                yield pd.DataFrame({"unit": unit, "class": best_class(dense[at], class_of[unit], table), "n": n.astype(np.int64)})
    return run


def exchange(spark: SparkSession, count: Callable[[np.ndarray, np.ndarray | None], DataFrame], class_of: np.ndarray, hashed: np.ndarray,
             rounds: int = WORD_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units whose sums ``count`` gives for classes and units that may move, by exchange from
    ``class_of``, and the table of pairs of classes; ``hashed`` has a hash for each unit.  At most KNOWN_WORDS and ENDINGS moves come to the driver."""
    best, share = None, INFLOW
    for turn in range(rounds + 1):
        half = ((hashed ^ (hashed >> 29)) * 0x9E3779B97F4A7C1 >> 33) + turn & 1 == 0
        half[END_UNIT] = False
        with removed_after(spark):
            met = count(class_of, half if turn < rounds else None)
            table = np.frombuffer((met.filter("range = -1").first() or {"ns": np.zeros(K * K, np.int64)})["ns"], np.int64).reshape(K, K).astype(float)  # one row
            likelihood = _phi(table).sum() - _phi(table.sum(0)).sum() - _phi(table.sum(1)).sum()
            better = best is None or likelihood > best[0]
            if better:
                best = (likelihood, class_of, table)
            if turn == rounds:
                break
            if better:
                with broadcast(spark, (table, class_of)) as shared:
                    moves = met.filter("range >= 0").select("range", "keys", "ns").mapInPandas(_gains(shared), "unit long, class long, n long").toPandas()
                unit, to, n = (moves[c].to_numpy(np.int64) for c in ("unit", "class", "n"))
                moving = to != class_of[unit]
                if moving.sum() <= LEAST_MOVED * len(unit):
                    break
                inflow = np.bincount(to[moving], weights=n[moving], minlength=K)
                size = np.maximum(table.sum(1), table.sum() / K / 5)
            else:  # too many moved at once: fewer of the same moves
                share /= 2
                class_of = best[1]
        chance = np.minimum(1.0, share * size / np.maximum(inflow, 1))
        drawn = ((hashed[unit] ^ (hashed[unit] >> 31)) * (0x2545F4914F6CDD1D + 2 * turn) >> 40 & 0xFFFFF) / (1 << 20)
        now = moving & (drawn < chance[to])
        class_of = class_of.copy()
        class_of[unit[now]] = to[now]
    return best[1].copy(), best[2]


def _rare_contexts(shared):
    """mapInPandas function: (word, code, n) of the words that are not known."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known_class, class_of_ending = shared.value
        v = len(known_class)
        for batch in batches:
            for ids, words, endings in zip(batch["ids"], batch["words"], batch["endings"]):
                u = _with_start(ids, v)
                c = np.concatenate([known_class, [CLASSES], class_of_ending[endings]]).astype(np.int64)[u]
                m, same, base = u > v, u[:-1] == u[1:], (u.astype(np.int64) - v - 1) * CODES
                left, right, own = (np.flatnonzero(x) for x in (m[1:] & ~same, m[:-1] & ~same, m[1:] & same))
                keys, n = np.unique(np.concatenate([base[left + 1] + c[left], base[right] + K + c[right + 1], base[own] + 2 * K]), return_counts=True)
                yield pd.DataFrame({"word": np.asarray(words, np.int64)[keys // CODES], "code": keys % CODES, "n": n})
    return run


def _rare_gains(shared):
    """mapInPandas function: (word, class) from (word, ending, codes, ns)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, class_of_ending = shared.value
        for big in batches:
            for start in range(0, len(big), 1024):
                batch = big.iloc[start: start + 1024]
                u = np.repeat(np.arange(len(batch)), [len(x) for x in batch["codes"]])
                dense = np.zeros((len(batch), CODES))
                dense[u, np.concatenate(batch["codes"].tolist())] = np.concatenate(batch["ns"].tolist())
                yield pd.DataFrame({"word": batch["word"].to_numpy(), "class": best_class(dense, class_of_ending[batch["ending"].to_numpy()], table)})
    return run


def rare_classes(blocks: DataFrame, rest: DataFrame, known_class: np.ndarray, class_of_ending: np.ndarray, table: np.ndarray) -> DataFrame:
    """(word, class, n) of the words in ``rest`` (word, ending, n): those seen
    LEAST_COUNT times move to their best class, the others have that of their ending."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((known_class, class_of_ending))
    met = blocks.filter("train").select("ids", "words", "endings").mapInPandas(_rare_contexts(shared), "word long, code int, n long")
    with batches_of(spark, BLOCKS):
        met = saved(met.groupBy("word", "code").agg(F.sum("n").alias("n")), "rare-contexts")
    met = met.groupBy("word").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("ns"))  # at most CODES
    own = rest.filter(F.col("n") >= LEAST_COUNT).select("word", "ending").dropDuplicates(["word"])
    shared = spark.sparkContext.broadcast((table, class_of_ending))
    moved = met.join(own, "word").select("word", "ending", "codes", "ns").mapInPandas(_rare_gains(shared), "word long, class long").withColumnRenamed("class", "to")
    by_ending = F.element_at(F.lit(class_of_ending.tolist()), F.col("ending") + 1).cast("long")
    summed = rest.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))
    return saved(summed.join(moved, "word", "left").select("word", F.coalesce("to", by_ending).alias("class"), "n"), "rare-words")


def with_words(blocks: DataFrame, rest: DataFrame | None) -> DataFrame:
    """``blocks`` with ``classes`` and ``counts`` of their own words (null: not seen)."""
    if rest is None:
        none = F.lit(None).cast("array<long>")
        return blocks.withColumn("classes", none).withColumn("counts", none)
    words = blocks.select("block", F.posexplode("words").alias("at", "word")).join(rest, "word")
    found = words.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "class", "n"))).alias("f"))  # a block's own words
    found = found.select("block", F.col("f.at").alias("at"), F.col("f.class").alias("classes"), F.col("f.n").alias("counts"))
    return blocks.join(found, "block", "left")


def _own(row, class_of_ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes and counts of a block's own words."""
    classes, counts = class_of_ending[row.endings].astype(np.int64), np.zeros(len(row.endings), np.int64)
    if row.classes is not None:
        at = row.at if "at" in row._fields else np.arange(len(row.classes))
        classes[at], counts[at] = row.classes, row.counts
    return classes, counts


def _class_pairs(shared):
    """mapInPandas function: (a, b, n) of classes in training blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known_class, class_of_ending = shared.value
        table = np.zeros(K * K, np.int64)
        for batch in batches:
            for row in batch.itertuples():
                c = np.concatenate([known_class, [CLASSES], _own(row, class_of_ending)[0]])[_with_start(row.ids, len(known_class))]
                table += np.bincount(c[:-1] * K + c[1:], minlength=K * K)
        yield pd.DataFrame({"a": np.arange(K * K) // K, "b": np.arange(K * K) % K, "n": table})
    return run


def _scores(shared):
    """mapInPandas function: a row for each document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known_class, class_of_ending, known_count, log_move, log_class = shared.value
        v = len(known_class)
        for batch in batches:
            for row in batch.itertuples():
                classes, counts = _own(row, class_of_ending)
                u = _with_start(row.ids, v)
                c = np.concatenate([known_class, [CLASSES], classes])[u]
                count = np.concatenate([known_count, counts])[u[1:]]  # of V words and the end token
                begin = np.cumsum([0, *row.lengths[:-1]])
                each = lambda x: np.add.reduceat(x, begin)
                yield pd.DataFrame({"doc": row.docs, "n_tokens": row.lengths,
                                    "n_known": each((count > 0).astype(np.int64)), "logs": each(np.log10(count + ADD)),
                                    "rest": each(log_move[c[:-1], c[1:]] - log_class[c[1:]])})
    return run


@tidy
def score(docs: DataFrame, folds: int = 5, held_out: int = 1, known_words: int = KNOWN_WORDS) -> DataFrame:
    """Per row doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (unigrams with additive smoothing) and score (the class model)."""
    spark = docs.sparkSession
    docs = packed(docs).select(F.col("__row.doc_id").cast("long").cast("string").alias("doc"), F.col("__row.text").alias("text"))
    docs = docs.withColumn("train", split_of(F.col("doc"), folds) != held_out)

    with batches_of(spark, TEXTS):
        vocabulary = docs.filter("train").select("text").mapInArrow(_word_counts, "word long, ending int, n long")
        vocabulary = saved(vocabulary.groupBy("word", "ending").agg(F.sum("n").alias("n")), "vocabulary")
    total, size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = vocabulary.filter(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = vocabulary.filter(F.col("word") != END)

    least = max(1001.0, COUNT_SHARE * total)
    many = {r["n"]: r["words"] for r in words.groupBy(F.least("n", F.lit(1001)).alias("n")).agg(F.count("*").alias("words")).collect()}  # at most 1001 rows
    fit = 0
    for n in sorted(many, reverse=True):
        fit += many[n]
        if fit > known_words:
            break
        least = n
    known = words.filter(F.col("n") >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])  # at most KNOWN_WORDS or 1 / COUNT_SHARE rows
    hashes, counts, endings = (known[c].to_numpy(np.int64) for c in ("word", "n", "ending"))
    rest = words.filter(F.col("n") < least) if fit > len(known) else None

    place = np.argsort(hashes)
    with batches_of(spark, TEXTS), broadcast(spark, (hashes[place], place)) as shared:
        blocks = docs.mapInArrow(_numbers(shared), NUMBERS).withColumn("block", F.monotonically_increasing_id())
        blocks = saved(blocks, "numbers")

    often = np.flatnonzero(counts >= max(1, UNIT_SHARE * total))  # at most 1 / UNIT_SHARE
    coarse = endings.copy()
    coarse[often] = FIRST_KNOWN + often
    class_of = np.zeros(FIRST_KNOWN + len(hashes), np.int64)
    weight = np.bincount(endings, minlength=ENDINGS)
    rank = np.concatenate([FIRST_KNOWN + often, np.argsort(-weight, kind="stable")])
    class_of[rank] = np.arange(len(rank)) % CLASSES
    class_of[END_UNIT] = CLASSES
    hashed = np.concatenate([np.arange(FIRST_KNOWN) * 0x9E3779B97F4A7C1, hashes])
    with batches_of(spark, BLOCKS):
        with removed_after(spark):
            width = FIRST_KNOWN + len(often)  # of the words by falling count
            class_of, _ = exchange(spark, partial(pair_contexts, unit_pairs(blocks, coarse, width), width), class_of, hashed, ROUNDS)
        class_of[FIRST_KNOWN:] = class_of[coarse]
        unit_of = np.where(counts >= LEAST_COUNT, FIRST_KNOWN + np.arange(len(hashes)), endings)
        class_of, table = exchange(spark, partial(contexts, blocks, unit_of), class_of, hashed)
    known_class, class_of_ending = class_of[unit_of], class_of[:ENDINGS]

    tokens, types = np.zeros((2, K))
    np.add.at(tokens, known_class, counts)
    np.add.at(types, known_class, 1)
    tokens[CLASSES], types[CLASSES] = ends, int(ends > 0)
    if rest is not None:
        rest = rare_classes(blocks, rest, known_class, class_of_ending, table)
        for r in rest.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # a row for each class
            tokens[r["class"]] += r["n"]
            types[r["class"]] += r["v"]
    blocks = with_words(blocks, rest)
    if rest is not None:
        blocks = saved(blocks, "numbers")
        shared = spark.sparkContext.broadcast((known_class, class_of_ending))
        with batches_of(spark, BLOCKS):
            pairs = blocks.filter("train").select("ids", "endings", "at", "classes", "counts").mapInPandas(_class_pairs(shared), "a int, b int, n long")
            for r in pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():  # a row for each pair of classes
                table[r["a"], r["b"]] = r["n"]

    log_class = np.log10(tokens + ADD * (types + 1))
    log_move = np.log10((table + ADD) / (table.sum(1, keepdims=True) + ADD * K))
    base_log = float(np.log10(total + ADD * (size + 1)))
    shared = spark.sparkContext.broadcast((known_class, class_of_ending, np.append(counts, ends), log_move, log_class))
    with batches_of(spark, BLOCKS):
        rows = saved(blocks.drop("block", "train", "words").mapInPandas(_scores(shared), "doc string, n_tokens long, n_known long, logs double, rest double"), "scores")
    return rows.select(
        F.col("doc").cast("long").alias("doc_id"), (split_of(F.col("doc"), folds) == held_out).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), (F.col("logs") - F.col("n_tokens") * F.lit(base_log)).alias("base_score"),
        (F.col("logs") + F.col("rest")).alias("score"))
