"""Best-fit packing of token sequences by hierarchical residual packing.

Documents are cut only where they are longer than a sequence, into a first
piece of what is left over and full pieces after it.  Then, in rounds:

* every partition packs its items by best fit, longest first, with bins
  found by the residual room that fits most tightly;
* bins with less room left than any item could use, or nearly full ones, are
  emitted; the others go on as items of the next round, as long as they fill;
* the next round has a quarter of the partitions, so underfull bins meet
  those of other partitions, until a round packs them all in few tasks or
  no longer saves any.

A task holds a bounded number of items: the partitions of a round follow from
the number of items left.  Items carry their pieces (at most one for each
token of a sequence), so no join is needed at the end, and everything a round
returns is written, so a lost executor repeats one round at most.

Defined results: a null or empty text is one piece with the end token alone;
repeated rows are packed each; an empty table gives an empty result; other
columns, whatever their names, are untouched.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.byte_bpe import vocab_file
from starkit.llm.common import packed, saved

LENGTH = 1024
END_ID = 2
ITEMS_PER_TASK = 20_000
FAN_IN = 4
NEARLY_FULL = 0.995     # share of a sequence from which a bin is emitted before the last round
LEAST_GAIN = 0.002      # share of the bins a round has to save for another to follow


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: what is left over first."""
    first = n % length
    return ([(0, first)] if first else []) + [(i, length) for i in range(first, n, length)]


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens of a tokenizer file, which are found anywhere in a text."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens", [])
    if any(x.get(rule) for x in tokens for rule in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that depend on what is around them are not supported")
    return {x["content"]: x["id"] for x in tokens}


def pieces(spark, docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row.  The ids are
    those of the tokenizer file: its vocabulary is in merge order, and the
    rank encoder gives the same ids as its own library, four times faster;
    the file's added tokens have their ids wherever a text holds them."""
    from public_tokenizers import PATTERN

    shared = spark.sparkContext.broadcast((vocab_file(tokenizer), PATTERN, added_tokens(tokenizer)))  # some 50,000 tokens

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks, pattern, added = shared.value
        encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encoder.encode(text if isinstance(text, str) else "", allowed_special="all"), end_id], "<u4")
                out += [(doc, k, a, n, zlib.crc32(ids[a: a + n].tobytes())) for k, (a, n) in enumerate(cut(len(ids), length))]
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    texts = packed(docs).select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.text").alias("text"))
    return texts.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Bins (lists of positions) by best fit of items in the given order.  A
    bit for each room that some bin has finds the tightest at once."""
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms, bins, room = 0, [], []
    for i, size in enumerate(sizes):
        fitting = rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
            bins[b].append(i)
        else:
            r, b = length, len(bins)
            bins.append([i])
            room.append(0)
        left = r - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


ITEM = "size long, members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"


def _round(number: int, length: int, emit_all: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyspark

        part = pyspark.TaskContext.get().partitionId()
        items = [(int(size), [tuple(m.values()) if isinstance(m, dict) else tuple(m) for m in members])
                 for batch in batches for size, members in zip(batch["size"], batch["members"])]
        # the order is that of the contents: a repeated task gives the same bins
        items.sort(key=lambda x: (-x[0], [(m[0] is None, m[0] or 0, m[1]) for m in x[1]], [m[4] for m in x[1]]))
        rows = []
        for k, bin_ in enumerate(best_fit([x[0] for x in items], length)):
            members, at = [], 0
            for i in bin_:
                members += [(*m[:5], m[5] + at) for m in items[i][1]]
                at += items[i][0]
            done = emit_all or at >= NEARLY_FULL * length
            rows.append((at, members, done, (number << 56) | (part << 28) | k if done else -1))
            if len(rows) >= 5_000:
                yield pd.DataFrame(rows, columns=["size", "members", "done", "sequence_id"])
                rows = []
        yield pd.DataFrame(rows, columns=["size", "members", "done", "sequence_id"])
    return run


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Per piece doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    all_pieces = saved(pieces(spark, docs, tokenizer, length, end_id), "pieces")
    full = all_pieces.filter(F.col("length") == length)
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    items = all_pieces.filter(F.col("length") < length).select(F.col("length").alias("size"), F.array(member).alias("members"))
    out = full.select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = saved(out, "sequences")
    number, n, tasks = 0, items.count(), None
    while n:
        need = -(-n // items_per_task)
        tasks = need if tasks is None else max(need, -(-tasks // FAN_IN))
        last = tasks == 1 and number > 0
        spread = F.xxhash64(F.lit(number), "size", "members")  # equal rows meet, in numbers a task holds
        dealt = items.withColumn("__h", spread).repartition(tasks, "__h").drop("__h")
        packed_ = saved(dealt.mapInPandas(_round(number, length, last), ITEM + ", done boolean, sequence_id long"), "bins")
        underfull = packed_.filter("not done").count()
        if number and underfull > (1 - LEAST_GAIN) * n:  # what is left doesn't fit together
            packed_ = packed_.withColumn("sequence_id", F.when(F.col("done"), F.col("sequence_id")).otherwise(F.lit((number << 56) | (1 << 55)) + F.monotonically_increasing_id())).withColumn("done", F.lit(True))
            underfull = 0
        bins = packed_.filter("done").select(F.explode("members").alias("m"), "sequence_id")
        out = out.unionByName(bins.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset"))
        items, n, number = packed_.filter("not done").select("size", "members"), underfull, number + 1
    return out
