"""Periodic runs of words, by a dictionary of basic factors.

Every factor of a power-of-two length gets a name, so that two factors of a document are
equal exactly if their names are; the names of one length are the ranks of pairs of names
of half of it. Starts of equal factors that follow one another at a distance p between
half the factor's length and the whole of it form arithmetic progressions: a stretch of
starts a..b, each with its next occurrence p words on, is the run from a to b + p + length
with period p, and no neighbouring word extends it, because the starts on both sides have
their next occurrence elsewhere. A primitive period of at most the factor's length cannot
occur at a shorter distance inside its run, so p is the smallest period, and every period
is looked at in one length only, so no run is found twice.

All documents of a batch are named together. A start whose factor occurs once in its
document takes no part in longer factors, which in plain prose are nearly all of them
after a few rounds.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_REPEATS = 4
# Texts are named together until they have this many characters; a longer text is alone
BATCH_CHARS = 4_000_000

RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, equal ones by place, and where in it a new key begins."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return order, first


def runs_of(codes: np.ndarray, sizes: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in documents that lie one after another.

    ``codes`` has a number for each word, ``sizes`` the documents' numbers of words.
    """
    total = len(codes)
    none = np.empty(0, np.int64)
    if not total:
        return none, none, none
    doc = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    longest = int(sizes.max()) // repeats
    width = int(codes.max()) + 1
    at = np.arange(total)
    keys = doc * width + codes
    # the name of the factor at each place, -1 where it occurs once or does not fit
    names = np.full(total, -1, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 1
    while len(at):
        order, first = _named(keys)
        place, name = at[order], np.cumsum(first) - 1
        again = ~first[1:]
        gap = np.zeros(total, np.int64)
        gap[place[:-1][again]] = (place[1:] - place[:-1])[again]
        starts = np.flatnonzero((gap > size // 2) & (gap <= size))
        if len(starts):
            period = gap[starts]
            opens = np.ones(len(starts), bool)
            opens[1:] = (starts[1:] != starts[:-1] + 1) | (period[1:] != period[:-1])
            begin = np.flatnonzero(opens)
            last = starts[np.append(begin[1:], len(starts)) - 1]
            low, step = starts[begin], period[begin]
            high = last + step + size
            enough = high - low >= np.maximum(least, repeats * step)
            found.append((low[enough], high[enough], step[enough]))
        if size >= longest:
            break
        # only factors that occur twice in their document go on
        shared = np.zeros(len(order), bool)
        shared[1:] |= again
        shared[:-1] |= again
        names[at] = -1
        names[place[shared]] = name[shared]
        at = np.sort(place[shared])
        at = at[at + 2 * size <= ends[at]]
        at = at[names[at + size] >= 0]
        keys = names[at] * (int(name[-1]) + 1) + names[at + size]
        size *= 2
    if not found:
        return none, none, none
    low, high, step = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((step, low))
    return low[order], high[order], step[order]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run has after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(compress(words, (np.cumsum(edge)[:-1] == 0).tolist()))


def _found(texts: list[str | None], least: int, repeats: int) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs, collapsed text) of each text."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    # without arguments, split() of bytes cuts at exactly the six white space characters of ASCII
    words = [(t or "").encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.fromiter((numbers[w] for ws in words for w in ws), np.int64, int(sizes.sum()))
    low, high, step = runs_of(codes, sizes, least, repeats)
    begins = np.cumsum(sizes) - sizes
    owner = np.searchsorted(begins, low, side="right") - 1
    # texts without words begin where the next one does; the run is the last text's that has a word there
    rows: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for d, a, b, p in zip(owner.tolist(), low.tolist(), high.tolist(), step.tolist(), strict=True):
        a0 = a - int(begins[d])
        rows[d].append((a0, b - a, p))
    for ws, runs in zip(words, rows, strict=True):
        yield len(ws), runs, _collapsed(ws, runs)


def _pieces(texts: list[str | None]) -> Iterator[slice]:
    """The texts in stretches of bounded size; a text over the bound is a stretch by itself."""
    begin = held = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > begin and held + n > BATCH_CHARS:
            yield slice(begin, i)
            begin, held = i, 0
        held += n
    if begin < len(texts):
        yield slice(begin, len(texts))


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    repeats: int = LEAST_REPEATS,
) -> DataFrame:
    """(id_col, n_words, runs, collapsed) of every row: all stretches of words that repeat a
    smallest period at least ``repeats`` times and have at least ``least`` words, each as
    long as its period holds, by start and then period; and the text without what follows
    the first period of any run, one space between words.

    Words are what ASCII white space parts. Rows are read one by one, so hot values move
    nothing. A null, empty or blank text has no word, no run and an empty ``collapsed``;
    null ids stay null, repeated rows are reported each, equal runs of different periods
    that start together stand by period; an empty table gives no row; further columns of
    ``docs`` are not read. A very long text is taken whole, in memory in proportion to its
    length.
    """
    if repeats < 3 or least < 1:
        # with two repeats a factor as long as its period need not come again inside the run
        raise ValueError("a run needs at least three repeats and one word")
    src = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = src.schema[0].dataType.simpleString()
    run_type = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _pieces(texts):
                found = list(_found(texts[part], least, repeats))
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rows] for _, rows, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.start, part.stop - part.start),
                        pa.array([n for n, _, _ in found], pa.int64()),
                        pa.array(runs, run_type),
                        pa.array([text for _, _, text in found], pa.binary()).cast(pa.string()),
                    ],
                    names=[id_col, "n_words", "runs", "collapsed"],
                )

    return src.mapInArrow(run, f"`{id_col}` {kind}, n_words long, runs {RUN}, collapsed string")
