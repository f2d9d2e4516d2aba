"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A seed is a word trigram of a benchmark item that chance alone would hardly ever produce:
its expected number of occurrences, from the word frequencies of the whole corpus, is
small. (Rarity is not the observed count: a leaked passage may be in a third of all
documents, and its trigrams would then look common.) A leak in very many documents raises
the frequencies of its own words, and some items have frequent words only; so in each
stretch of STRETCH words the rarest trigram is a seed whatever its frequency, and every
STRETCH unchanged words of an item are met. A document that holds a seed is aligned word by word with the item around the seed; local alignment survives replaced,
inserted and dropped words, so edited and paraphrased copies score as well.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Memo
from tidemark.llm.worker import in_slices, kept

SEED_WORDS = 3
# Seeds that a text of a million words would hold by chance less than so many times
RARE_PER_MILLION = 0.05
# In so many successive words of an item there is a seed, however frequent they are
STRETCH = 8
MATCH, MISMATCH, GAP = 2, -1, -1
# Share of the item's greatest possible score from which a document is contaminated, and
# the least number of words that have to match.
MIN_SHARE, MIN_MATCHED = 0.4, 6
# The score of so many words without a change is enough in an item of any length
PASSAGE_WORDS = 40
# Items are taken in blocks of so many characters; a block is all that is sent to the tasks.
BLOCK_CHARS = 4_000_000
MARGIN = 16
MARKS = b".,;:!?\"'()[]*#$%&"


def bare(word: bytes) -> bytes:
    """A word without punctuation at its ends."""
    return word.strip(MARKS) or word


class Numbering:
    """Texts as word numbers, 0 for words that the items lack. A-Z is folded to lower case."""

    @staticmethod
    def of(name: str, vocabulary: dict[bytes, int]) -> Numbering:
        """The numbering of this name that the worker keeps."""
        return kept(("numbering", name), lambda: Numbering(vocabulary))

    def __init__(self, vocabulary: dict[bytes, int]):
        self.known = Memo(lambda w: vocabulary.get(bare(w), 0))

    def __call__(self, text: str | None) -> np.ndarray:
        return np.array([self.known[w] for w in (text or "").encode().lower().split()], np.int64)


class Items:
    """A block of benchmark items: words as numbers, and their trigrams."""

    def __init__(self, rows: list[tuple]):
        self.name = uuid4().hex
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [r[0] for r in rows]
        for row in rows:
            for word in row[1].encode().lower().split():
                self.vocabulary.setdefault(bare(word), len(self.vocabulary) + 1)
        number = Numbering(self.vocabulary)
        self.words = [number(r[1]) for r in rows]
        self.grams, self.where = np.zeros(0, np.int64), {}

    def trigrams(self, words: np.ndarray) -> np.ndarray:
        """A number for each run of three known words, 0 where a word is unknown."""
        n = len(words) - SEED_WORDS + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        size = len(self.vocabulary) + 1
        x, y, z = words[:n], words[1 : n + 1], words[2:]
        return np.where((x > 0) & (y > 0) & (z > 0), (x * size + y) * size + z, 0)

    def seed(self, counts: dict[int, int], total: int, rare: float) -> None:
        """Keep the trigrams whose expected number in a million words is below ``rare``, and
        the rarest of each stretch of STRETCH words (of the whole item, if it is shorter)."""
        share = np.ones(len(self.vocabulary) + 1)
        for number, count in counts.items():
            share[number] = count / max(1, total)
        where = defaultdict(list)
        for item, words in enumerate(self.words):
            grams = self.trigrams(words).tolist()
            expected = [share[words[at : at + SEED_WORDS]].prod() * 1e6 for at in range(len(grams))]
            run = min(STRETCH - SEED_WORDS + 1, len(grams))
            rarest = {min(range(first, first + run), key=lambda at: expected[at]) for first in range(len(grams) - run + 1) if run}
            for at, gram in enumerate(grams):
                if at in rarest or expected[at] < rare:
                    where[gram].append((item, at))
        self.where = dict(where)
        self.grams = np.array(sorted(where), np.int64)


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int, int]:
    """(score, matched, start, end) of the best local alignment; the place is in ``text``.

    Rows run over the item. A gap along the text is resolved by a running maximum, so a
    row is a handful of vector operations. Each cell carries the number of matches and the
    start of its best path.
    """
    n = len(text)
    score, matched = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)
    column = np.arange(n + 1)
    best = (0, 0, 0, 0)
    for word in item:
        same = text == word
        new = np.zeros(n + 1, np.int64)
        hits, since = np.zeros(n + 1, np.int64), column.copy()
        diagonal = score[:-1] + np.where(same, MATCH, MISMATCH)
        down = score[1:] + GAP
        take = diagonal >= down
        value = np.where(take, diagonal, down)
        alive = value > 0
        new[1:] = np.where(alive, value, 0)
        hits[1:] = np.where(alive, np.where(take, matched[:-1] + same, matched[1:]), 0)
        since[1:] = np.where(alive, np.where(take, start[:-1], start[1:]), column[1:])
        # gaps along the text: the best cell to the left, less its distance
        reach = np.maximum.accumulate(new - GAP * column)
        source = np.maximum.accumulate(np.where(new - GAP * column == reach, column, 0))
        along = reach + GAP * column
        better = along > new
        score = np.where(better, along, new)
        matched = np.where(better, hits[source], hits)
        start = np.where(better, since[source], since)
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(matched[top]), int(start[top]), top)
    return best


def matches(items: Items, words: np.ndarray, share: float, least: int) -> list[tuple[int, int, float, int, int]]:
    """(item, score, share of the greatest score, first word, end) of the items in a text."""
    grams = items.trigrams(words)
    if not len(grams) or not len(items.grams):
        return []
    place = np.minimum(np.searchsorted(items.grams, grams), len(items.grams) - 1)
    spans: dict[int, list[list[int]]] = defaultdict(list)
    for at in np.flatnonzero(items.grams[place] == grams).tolist():
        for item, offset in items.where[int(grams[at])]:
            size = len(items.words[item])
            low, high = max(0, at - offset - MARGIN), min(len(words), at - offset + size + MARGIN)
            last = spans[item]
            # neighbouring seeds of an item share a window; one of a late offset may reach back over several
            while last and low <= last[-1][1]:
                before = last.pop()
                low, high = min(low, before[0]), max(high, before[1])
            last.append([low, high])
    found = []
    for item, windows in spans.items():
        size = len(items.words[item])
        enough = min(share * size, max(least, PASSAGE_WORDS))
        best = (0, 0, 0, 0)
        known = np.zeros(len(items.vocabulary) + 1, bool)
        known[items.words[item]] = True
        for low, high in windows:
            # no more words than these can match: frequent seeds seldom need an alignment
            if np.count_nonzero(known[words[low:high]]) < max(enough, min(least, size)):
                continue
            score, matched, first, end = align(words[low:high], items.words[item])
            if score > best[0]:
                best = (score, matched, first + low, end + low)
        if best[0] >= MATCH * enough and best[1] >= min(least, size):
            found.append((item, best[0], best[0] / (MATCH * size), best[2], best[3]))
    return sorted(found)


def _counted(docs: DataFrame, items: Items) -> tuple[dict[int, int], int]:
    """Occurrences of the items' words in all documents, and the number of all words."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)
    size, name = len(items.vocabulary) + 1, items.name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = Numbering.of(name, shared.value), np.zeros(size, np.int64)
        for batch in in_slices(batches):
            texts = [number(t) for t in batch.column(0).to_pylist()]
            total += np.bincount(np.concatenate(texts) if texts else [], minlength=size).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["word", "n"])

    rows = docs.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r.word: r.n for r in rows}
    return {k: v for k, v in counts.items() if k}, sum(counts.values())


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in lists of bounded size, one list at a time on the driver. The partitions
    of the sorted items are read one after another, so none of them is there as a whole."""
    rows = benchmark.select(F.col(item_col), F.col(text_col)).where(F.col(text_col).isNotNull())
    block, size = [], 0
    for row in rows.toLocalIterator():
        if block and size + len(row[1]) > block_chars:
            yield block
            block, size = [], 0
        block.append(tuple(row))
        size += len(row[1])
    if block:
        yield block


def _seeded(docs: DataFrame, text_col: str, rows: list[tuple], rare: float) -> Items:
    items = Items(rows)
    items.seed(*_counted(docs.select(text_col), items), rare)
    return items


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: float = MIN_SHARE,
    least: int = MIN_MATCHED,
    rare: float = RARE_PER_MILLION,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id_col, item_col, score, share, first_word, end_word): the leaks, one row for each
    row of ``docs`` and item that it holds, with the best alignment of the two.

    The items are a stated query set. They are taken in blocks of ``block_chars``, each of
    which is sent to the tasks and compared with all documents, so nothing broadcast grows
    with either table. Null or empty texts and items of fewer than three words hold and
    give no seed; repeated rows and repeated items are reported each; null ids stay null;
    empty tables give an empty result.
    """
    src = docs.select(F.col(id_col), F.col(text_col))
    kinds = [src.schema[0].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()]
    item_type = pa.Table.from_pandas(benchmark.select(item_col).limit(0).toPandas()).schema.field(0).type
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, score long, share double, first_word long, end_word long"
    found = docs.sparkSession.createDataFrame([], schema)
    for rows in _blocks(benchmark, item_col, item_text_col, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(_seeded(docs, text_col, rows, rare))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            number = Numbering.of(items.name, items.vocabulary)
            for batch in in_slices(batches):
                at, hits = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for hit in matches(items, number(text), share, least):
                        at.append(i)
                        hits.append(hit)
                columns = list(zip(*hits, strict=True)) or [()] * 5
                named = pa.array([items.ids[i] for i in columns[0]], item_type)
                kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
                rest = [pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), named, *rest],
                    names=[id_col, item_col, "score", "share", "first_word", "end_word"],
                )

        found = found.union(src.mapInArrow(run, schema))
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns as they are."""
    given = {"share": MIN_SHARE, "least": MIN_MATCHED, "rare": RARE_PER_MILLION, "block_chars": BLOCK_CHARS} | options
    at = docs.columns.index(text_col)
    schema = docs.schema
    for rows in _blocks(benchmark, item_col, item_text_col, given["block_chars"]):
        shared = docs.sparkSession.sparkContext.broadcast(_seeded(docs, text_col, rows, given["rare"]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            number = Numbering.of(items.name, items.vocabulary)
            for batch in in_slices(batches):
                texts = batch.column(at).to_pylist()
                clean = [not matches(items, number(t), given["share"], given["least"]) for t in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
