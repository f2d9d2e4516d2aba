"""Token-id files with Re-Pair grammar compression.

Documents are range-partitioned and sorted by id, so that the partitions, one after the
other, hold the ids of the corpus in order. Each partition writes blocks of bounded size.
A block is a grammar: frequent pairs of neighbouring ids are repeatedly replaced by
nonterminals (the frequent pairs of a round all at once, overlaps going to the left one),
and the rules are stored with the number of ids that each nonterminal stands for. A
document starts at a known symbol of its block, and the lengths of the symbols lead from
there to any of its ids without expanding what lies before.

The files are a Parquet table with a row for each block:

    shard, block    place of the block; (shard, block) order is document order
    docs, lengths   the documents' ids and their numbers of token ids
    ends            number of symbols up to the end of each document
    left, right     the rules: nonterminal FIRST + i stands for left[i] right[i]
    size            ids that nonterminal FIRST + i stands for
    symbols         the block's text in ids and nonterminals
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import gathered, library_encoder

FIRST = 1 << 17  # nonterminals begin here; ids are below
BLOCK_IDS = 1 << 20
ROUNDS, RULES_PER_ROUND, LEAST_COUNT = 12, 4096, 16
LEAST_GAIN = 0.02
SLOTS = 1 << 18

COLUMNS = {
    "shard": pa.int32(),
    "block": pa.int32(),
    "docs": pa.list_(pa.int64()),
    "lengths": pa.list_(pa.int64()),
    "ends": pa.list_(pa.int64()),
    "left": pa.binary(),
    "right": pa.binary(),
    "size": pa.binary(),
    "symbols": pa.binary(),
}
SCHEMA = (
    "shard int, block int, docs array<long>, lengths array<long>, ends array<long>, "
    "left binary, right binary, size binary, symbols binary"
)


def compress(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, symbols up to each document's end, left, right). No rule spans two documents."""
    symbols = ids.astype(np.int64)
    last = np.zeros(len(symbols), bool)
    ends = np.cumsum(lengths)
    last[ends[lengths > 0] - 1] = True
    left, right = [], []
    made = FIRST
    for _ in range(ROUNDS):
        pairs = (symbols[:-1] << 32) | symbols[1:]
        inner = ~last[:-1]
        ordered = pairs.compress(inner)
        ordered.sort()
        if not len(ordered):
            break
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(starts, len(ordered)))
        often = np.flatnonzero(counts >= LEAST_COUNT)
        if len(often) > RULES_PER_ROUND:
            often = often[np.argsort(-counts[often], kind="stable")[:RULES_PER_ROUND]]
        if not len(often):
            break
        chosen = ordered[starts[often]]
        chosen = chosen[np.unique(_slots(chosen), return_index=True)[1]]  # a pair for each slot
        at, which = _occurrences(pairs, inner, chosen)
        if len(at) < LEAST_GAIN * len(symbols):
            break
        symbols[at] = made + which.astype(np.int64)
        last[at] = last[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, last = symbols.compress(stay), last.compress(stay)
        left.append(chosen >> 32)
        right.append(chosen & 0xFFFFFFFF)
        made += len(chosen)
    until = np.zeros(len(lengths), np.int64)
    until[lengths > 0] = np.flatnonzero(last) + 1
    none = np.zeros(0, np.int64)
    return symbols, np.maximum.accumulate(until), np.concatenate([none, *left]), np.concatenate([none, *right])


def _slots(pairs: np.ndarray) -> np.ndarray:
    slots = pairs * 0x9E3779B97F4A7C1
    slots >>= 40
    slots &= SLOTS - 1
    return slots


def _occurrences(pairs: np.ndarray, inner: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chosen pairs stand without overlap, and which they are: of a run of overlapping
    ones, every second."""
    table = np.full(SLOTS, -1, np.int16)
    table[_slots(chosen)] = np.arange(len(chosen))
    which = table.take(_slots(pairs))
    at = np.flatnonzero((which >= 0) & inner)
    which = which.take(at)
    hit = chosen.take(which) == pairs.take(at)
    at, which = at.compress(hit), which.compress(hit)
    begins = np.concatenate(([True], at[1:] != at[:-1] + 1))[: len(at)]
    place = np.arange(len(at))
    run = np.maximum.accumulate(place * begins)
    apart = (place - run) & 1 == 0
    return at.compress(apart), which.compress(apart)


def rule_sizes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids that each nonterminal stands for; a rule only names nonterminals made before it."""
    sizes = []
    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        sizes.append((1 if x < FIRST else sizes[x - FIRST]) + (1 if y < FIRST else sizes[y - FIRST]))
    return np.array(sizes, np.int64)


class Block:
    """One stored block, ready to be read at any place."""

    def __init__(self, row: dict):
        self.docs, self.lengths = row["docs"], row["lengths"]
        self.ends = np.array(row["ends"], np.int64)
        self.left, self.right, self.size, self.symbols = (np.frombuffer(row[c], "<u4") for c in ("left", "right", "size", "symbols"))

    def all_ids(self) -> np.ndarray:
        """The ids of the whole block: those of each rule are laid out once, and every symbol
        copies its own."""
        made: list[list[int]] = []
        for x, y in zip(self.left.tolist(), self.right.tolist(), strict=True):
            made.append((made[x - FIRST] if x >= FIRST else [x]) + (made[y - FIRST] if y >= FIRST else [y]))
        # behind the ids of the rules, those that stand for themselves
        laid = np.array([i for ids in made for i in ids], "<u4")
        itself = self.symbols < FIRST
        number = np.where(itself, 0, self.symbols - FIRST).astype(np.int64)
        sizes, begins = np.append(self.size, 1).astype(np.int64), np.append(np.cumsum(self.size, dtype=np.int64) - self.size, 0)
        sizes = np.where(itself, 1, sizes.take(number))
        begins = np.where(itself, len(laid) - 1 + np.cumsum(itself), begins.take(number))
        return gathered(np.concatenate([laid, self.symbols.compress(itself)]), begins, sizes)

    def id_at(self, doc: int, place: int) -> int:
        """The id at ``place`` of the block's ``doc``-th document, found by the symbols' lengths."""
        if not 0 <= place < self.lengths[doc]:
            raise IndexError(place)
        begin = self.ends[doc - 1] if doc else 0
        symbols = self.symbols[begin : self.ends[doc]].astype(np.int64)
        until = np.cumsum(np.where(symbols < FIRST, 1, self.size[np.maximum(symbols - FIRST, 0)] if len(self.size) else 1))
        k = int(np.searchsorted(until, place, side="right"))
        symbol, rest = int(symbols[k]), place - (int(until[k - 1]) if k else 0)
        while symbol >= FIRST:
            x, y = int(self.left[symbol - FIRST]), int(self.right[symbol - FIRST])
            ahead = 1 if x < FIRST else int(self.size[x - FIRST])
            symbol, rest = (x, rest) if rest < ahead else (y, rest - ahead)
        return symbol


def write(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the id files of all documents to ``folder``.

    A null text counts as empty and has the end id alone; repeated rows are written each;
    rows without an id come first; an empty table writes no block. Rows of equal id are
    ordered by their text.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = src.repartitionByRange(n, "doc").sortWithinPartitions("doc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, end = library_encoder(path), np.uint32(end_id).tobytes()
        shard, block = TaskContext.get().partitionId(), 0
        names: list = []
        held: list[bytes] = []
        size = 0

        def packed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            lengths = np.array([len(x) // 4 for x in held], np.int64)
            symbols, ends, left, right = compress(ids, lengths)
            row = [shard, block, list(names), lengths, ends]
            row += [x.astype("<u4").tobytes() for x in (left, right, rule_sizes(left, right), symbols)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, COLUMNS.values(), strict=True)], names=list(COLUMNS))

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), library.encode_all(batch.column(1).to_pylist()), strict=True):
                names.append(name)
                held.append(ids + end)
                size += len(held[-1]) // 4
                if size >= BLOCK_IDS:
                    yield packed()
                    names, held, size, block = [], [], 0, block + 1
        if held:
            yield packed()

    ordered.mapInArrow(run, SCHEMA).write.parquet(folder)


def read_back(
    spark: SparkSession, folder: str, summary: Callable[[bytes], int] = zlib.crc32, name: str = "ids_crc32"
) -> DataFrame:
    """(doc, start, n_tokens, ``name``) for each document in the id files of ``folder``.

    ``start`` is the number of ids of all documents before it, ``summary`` a number that is
    computed from its packed ids.
    """
    blocks = spark.read.parquet(folder)
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = blocks.select("shard", "block", total.alias("ids"))
    # running sums in two steps: over the shards, of which there are as many as partitions,
    # and over the blocks of each shard
    shards = sizes.groupBy("shard").agg(F.sum("ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    within = F.sum("ids").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", "block", F.coalesce(within, F.lit(0)).alias("block_start")).join(shards, "shard")
    starts = starts.select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("start"))
    columns = [c for c in COLUMNS if c not in ("shard", "block")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                ids = block.all_ids()
                until = np.cumsum(np.array(block.lengths, np.int64))
                begin = until - np.array(block.lengths, np.int64)
                values = [summary(ids[a:b].tobytes()) for a, b in zip(begin.tolist(), until.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(until), pa.int32()),
                        pa.array([row["block"]] * len(until), pa.int32()),
                        pa.array(block.docs, pa.int64()),
                        pa.array(begin, pa.int64()),
                        pa.array(block.lengths, pa.int64()),
                        pa.array(values, pa.int64()),
                    ],
                    names=["shard", "block", "doc", "begin", "n_tokens", name],
                )

    found = blocks.select("shard", "block", *columns).mapInArrow(
        run, f"shard int, block int, doc long, begin long, n_tokens long, `{name}` long"
    )
    return found.join(starts, ["shard", "block"]).select("doc", (F.col("start") + F.col("begin")).alias("start"), "n_tokens", name)
