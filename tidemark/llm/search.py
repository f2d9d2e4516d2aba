"""Exact BM25 top-k search over document shards with block-max pruning.

Document frequencies, the number of documents and their mean length are counted over all
shards first, so a score means the same in every shard and the shards' best lists merge
into the exact result. A task holds some of the queries and takes shards of bounded size
one after another, each as an inverted index.

Shards are searched in rounds, each with three times as many shards as all rounds before it.
A query takes the k-th best score so far along as its threshold, from round to round and in
a task from shard to shard: a shard hands back only what reaches it, about k rows a query and
task, so the results grow with the queries and the logarithm of the shards, not with their
product.

The documents of a shard are grouped by the frequent terms they share. In a group some
hundred terms are dense: their impacts are a matrix, in blocks with each block's greatest.
All others are added up through their postings. The sums and the greatest impacts bound the
scores of a block; where no bound reaches a query's threshold the matrix is left unread, and
elsewhere it is multiplied with the weights of many queries at once. These scores are of
single precision and only say which documents can be among the best; the scores that are
handed back are added up anew, in double precision and in the order of the terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.decontam import MARKS
from tidemark.session import written

K1, B = 1.2, 0.75
DOCS_PER_SHARD = 16384
FIRST_SHARDS = 8  # of the first round
# A task takes up to so many shards, as long as there are so many tasks for each core
SHARDS_PER_TASK, TASKS_PER_CORE = 8, 2
# Of a round with few shards, queries beyond this number go to further tasks with the shard's documents
QUERIES_PER_TASK = 8192
HELD_QUERIES = 65536  # a task never holds many more
MAX_TASKS = 8192
QUERIES_AT_ONCE = 128
EXPANDED_AT_ONCE = 8
RESCORED_AT_ONCE = 2048
BLOCK = 32
BLOCKS_AT_ONCE = 16
GROUPS, GROUPED_BY, GROUPING_STEPS = 16, 512, 4
# A term in more than this share of a group's documents is dense there
FREQUENT = 0.1
DIGITS = 6
SLACK = 2 * 10.0**-DIGITS  # scores that can be equal when rounded
ROUNDING = 2.0**-23  # greatest relative error of a sum in single precision, for each of its terms, twice


def terms_of(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(distinct terms in order, their counts, number of words); A-Z is folded to lower case."""
    words = (text or "").encode().lower().split()
    number = xxhash.xxh3_64_intdigest
    # without a call of ``bare`` for each word; a memo of so many words takes longer than their numbers
    found = np.fromiter([number(w.strip(MARKS) or w) for w in words], np.uint64, len(words)).view(np.int64)
    found.sort()
    ends = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1], [True]))) if len(found) else np.zeros(1, np.int64)
    return found[ends[:-1]], np.diff(ends), len(words)


def _expanded(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all members of runs."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


class Held:
    """Queries that a task holds, with their terms as places in the vocabulary of them all."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.pieces: list[tuple] = []

    def add(self, query: pa.Array, least: np.ndarray, terms: pa.ListArray, dfs: pa.ListArray, counts: pa.ListArray) -> None:
        every, df = np.asarray(terms.flatten()), np.asarray(dfs.flatten())
        known, first, place = np.unique(every, return_index=True, return_inverse=True)
        sizes = np.asarray(terms.value_lengths()).astype(np.int64)
        self.pieces.append((query, least, known, df[first], place.astype(np.int32), np.asarray(counts.flatten()).astype(np.int32), sizes))

    def finish(self) -> None:
        query, least, known, dfs, place, counts, sizes = zip(*self.pieces, strict=True)
        self.pieces = []
        self.query, self.least = pa.concat_arrays(query), np.concatenate(least)
        self.vocabulary, first = np.unique(np.concatenate(known), return_index=True)
        df = np.concatenate(dfs)[first]
        self.idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        self.terms = np.concatenate([np.searchsorted(self.vocabulary, v).astype(np.int32)[p] for v, p in zip(known, place, strict=True)])
        counts = np.concatenate(counts)
        self.counts = counts.astype(np.min_scalar_type(counts.max(initial=0)))
        self.starts = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        self.best: dict[int, np.ndarray] = {}  # scores of a query's best so far, at most k

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Places of terms in the vocabulary, -1 for those that no query has."""
        if not len(self.vocabulary):
            return np.full(len(terms), -1, np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == terms, at, -1).astype(np.int32)

    def reached(self, query: int, scores: np.ndarray) -> None:
        """Raises a query's threshold by scores of documents not seen before."""
        scores = np.concatenate((self.best.get(query, np.zeros(0)), scores))
        if len(scores) >= self.k:
            scores = np.partition(scores, len(scores) - self.k)[len(scores) - self.k :]
            self.least[query] = max(self.least[query], scores[0])
        self.best[query] = scores


def groups_of(has: np.ndarray) -> np.ndarray:
    """A group for each row of a 0-1 matrix, by k-means of directions from rows drawn far apart."""
    n = len(has)
    rows = has / np.maximum(np.sqrt(has.sum(axis=1, keepdims=True)), 1)
    draw = np.random.default_rng(0)
    centres, near = [rows[0]], np.full(n, -1.0, np.float32)
    for _ in range(min(GROUPS, n) - 1):
        near = np.maximum(near, rows @ centres[-1])
        far = np.maximum(1 - near, 0).astype(np.float64) ** 2
        if far.sum() <= 1e-6:
            break
        centres.append(rows[draw.choice(n, p=far / far.sum())])
    middle = np.array(centres)
    for step in range(GROUPING_STEPS):
        group = np.argmax(rows @ middle.T, axis=1)
        if step + 1 < GROUPING_STEPS:
            total = (group == np.arange(len(middle))[:, None]).astype(np.float32) @ rows
            middle = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    return group


class Shard:
    """Index of some documents for the terms that held queries have: impacts of dense terms by
    group and block, postings of all others, and each document's terms."""

    def __init__(self, held: Held, docs: list, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, mean: float):
        self.held, self.docs, n, known = held, docs, len(docs), len(held.vocabulary)
        self.terms, self.counts, self.own = terms, counts, np.concatenate(([0], np.cumsum(sizes)))
        self.norm = K1 * (1 - B + B * lengths / max(mean, 1e-9))
        doc = np.repeat(np.arange(n, dtype=np.int32), sizes)
        df = np.bincount(terms, minlength=known)
        group = self._group(doc, df)
        order = np.lexsort((sizes, group))
        members = np.bincount(group)
        width = -(-members // BLOCK) * BLOCK  # a group's columns: its documents, in blocks
        self.edge = np.concatenate(([0], np.cumsum(width)))
        column = np.empty(n, np.int64)
        column[order] = np.arange(n) + np.repeat(self.edge[:-1] - np.cumsum(members) + members, members)
        self.doc_of = np.full(self.edge[-1], -1)
        self.doc_of[column] = np.arange(n)

        often = np.flatnonzero(df > max(1.0, FREQUENT * min(BLOCK, n)))
        self.often = np.full(known, -1, np.int32)
        self.often[often] = np.arange(len(often))
        at, of = self.often[terms], group.astype(np.int32)[doc]
        some = at >= 0
        found = np.bincount(at[some].astype(np.int64) * len(members) + of[some], minlength=len(often) * len(members)).reshape(-1, len(members))
        dense = (found > np.maximum(1.0, FREQUENT * members)) & (members >= BLOCK)
        self.row = np.where(dense, np.cumsum(dense, axis=0) - 1, -1).astype(np.int32).T  # of a term in the matrix of a group
        rows = dense.sum(axis=0)
        begin = np.concatenate(([0], np.cumsum(rows * width)))
        where = np.full(len(terms), -1, np.int64)
        row = self.row[of[some], at[some]]
        where[some] = np.where(row >= 0, begin[of[some]] + row * width[of[some]] + column[doc[some]] - self.edge[of[some]], -1)
        del at, of, some, row
        impact = (counts * (K1 + 1) / (counts + self.norm[doc])).astype(np.float32)
        flat = np.zeros(begin[-1], np.float32)
        flat[where[where >= 0]] = impact[where >= 0]
        self.dense = [flat[begin[g] : begin[g + 1]].reshape(rows[g], width[g]) for g in range(len(members))]
        self.greatest = [d.reshape(len(d), d.shape[1] // BLOCK, BLOCK).max(axis=2) for d in self.dense]

        rest = np.flatnonzero(where < 0)
        rest = rest[np.argsort(terms[rest], kind="stable")]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(terms[rest], minlength=known))))
        self.postings = np.empty((len(rest), 2), np.int32)  # column, and the bits of the value
        self.postings[:, 0] = column[doc[rest]]
        self.postings[:, 1] = (impact[rest] * held.idf[terms[rest]].astype(np.float32)).view(np.int32)
        self.weight = np.zeros(known)
        self.room = np.empty(0, np.int64), np.empty(0, np.int64)

    def _group(self, doc: np.ndarray, df: np.ndarray) -> np.ndarray:
        n = len(self.docs)
        by = np.flatnonzero(df > max(1.0, FREQUENT * n))
        by = by[np.argsort(-df[by], kind="stable")[:GROUPED_BY]]
        if not len(by) or n < 2 * BLOCK:
            return np.zeros(n, np.int64)
        place = np.full(len(df), -1, np.int32)
        place[by] = np.arange(len(by))
        at = place[self.terms]
        has = np.zeros((n, len(by)), np.float32)
        has[doc[at >= 0], at[at >= 0]] = 1
        return np.unique(groups_of(has), return_inverse=True)[1]

    def search(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, documents, scores) with a positive score that reaches the query's threshold and
        is among the k best, ties included; raises the thresholds."""
        total = len(self.held.starts) - 1
        sums = np.empty((min(total, QUERIES_AT_ONCE), self.edge[-1]), np.float32)
        for low in range(0, total, QUERIES_AT_ONCE):
            high = min(total, low + QUERIES_AT_ONCE)
            yield from self._search(low, high, sums[: high - low])

    def _search(self, low: int, high: int, sums: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        held, n = self.held, high - low
        own = held.starts[low : high + 1] - held.starts[low]
        terms, counts = held.terms[held.starts[low] : held.starts[high]], held.counts[held.starts[low] : held.starts[high]]
        self._add_postings(own, terms, counts, sums)
        # what a score in single precision cannot be below if the exact one reaches some other
        error = (np.diff(own) + 16) * ROUNDING

        def short(scores: np.ndarray) -> np.ndarray:
            return ((scores - SLACK) * (1 - error) - SLACK).astype(np.float32)

        reach = short(held.least[low:high])
        query = np.repeat(np.arange(n), np.diff(own))
        at = self.often[terms]
        query, at, weight = query[at >= 0], at[at >= 0], (counts * held.idf[terms])[at >= 0].astype(np.float32)
        for g, dense in enumerate(self.dense):
            if not len(dense):
                continue
            row = self.row[g][at]
            weights = np.zeros((n, len(dense)), np.float32)
            weights[query[row >= 0], row[row >= 0]] = weight[row >= 0]
            here = sums[:, self.edge[g] : self.edge[g + 1]]
            bound = here.reshape(n, -1, BLOCK).max(axis=2) + weights @ self.greatest[g]
            for first in range(0, bound.shape[1], BLOCKS_AT_ONCE):
                live = np.flatnonzero((bound[:, first : first + BLOCKS_AT_ONCE] >= reach[:, None]).any(axis=1))
                part = slice(first * BLOCK, (first + BLOCKS_AT_ONCE) * BLOCK)
                if len(live) == n:
                    here[:, part] += weights @ dense[:, part]
                elif len(live):
                    here[live, part] += weights[live] @ dense[:, part]
        blocks = sums.reshape(n, -1, BLOCK)
        top = blocks.max(axis=2)
        if held.k <= top.shape[1]:
            # so many documents, of different blocks, have at least this score
            reach = np.maximum(reach, short(np.partition(top, top.shape[1] - held.k, axis=1)[:, top.shape[1] - held.k]))
        query, block = np.nonzero((top >= reach[:, None]) & (top > 0))
        some, place = np.nonzero((blocks[query, block] >= reach[query][:, None]) & (blocks[query, block] > 0))
        query, column = query[some], block[some] * BLOCK + place
        edges = np.searchsorted(query, np.arange(n + 1))
        for i in np.flatnonzero(np.diff(edges)).tolist():
            mine = slice(own[i], own[i + 1])
            likely = column[edges[i] : edges[i + 1]]
            if len(likely) > held.k:
                found = sums[i, likely]
                least = np.partition(found, len(found) - held.k)[len(found) - held.k]
                likely = likely[found >= (least - SLACK) * (1 - error[i]) - SLACK]
            docs = self.doc_of[likely]
            docs, scores = self._best(docs, self._exact(docs, terms[mine], counts[mine]), held.k, held.least[low + i])
            if len(docs):
                held.reached(low + i, scores)
                yield low + i, docs, scores

    def _add_postings(self, own: np.ndarray, terms: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        sums[:] = 0
        for first in range(0, len(sums), EXPANDED_AT_ONCE):
            last = min(len(sums), first + EXPANDED_AT_ONCE)
            some = slice(own[first], own[last])
            begin = self.starts[terms[some]]
            size = self.starts[terms[some] + 1] - begin
            ends = np.concatenate(([0], np.cumsum(size)))
            at = _expanded(begin, size)
            if len(at) > len(self.room[0]):
                self.room = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
            found, column = (r[: len(at)] for r in self.room)
            self.postings.view(np.int64).reshape(-1).take(at, out=found, mode="clip")
            column[:] = found.view(np.int32)[::2]
            value = np.repeat(counts[some].astype(np.float32), size)
            value *= found.view(np.float32)[1::2]
            for i in range(first, last):
                mine = slice(ends[own[i] - own[first]], ends[own[i + 1] - own[first]])
                np.add.at(sums[i], column[mine], value[mine])

    def _exact(self, docs: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        self.weight[terms] = counts * self.held.idf[terms]
        scores = np.empty(len(docs))
        for first in range(0, len(docs), RESCORED_AT_ONCE):
            some = docs[first : first + RESCORED_AT_ONCE]
            size = self.own[some + 1] - self.own[some]
            at = _expanded(self.own[some], size)
            tf = self.counts[at]
            parts = self.weight[self.terms[at]] * (tf * (K1 + 1) / (tf + np.repeat(self.norm[some], size)))
            scores[first : first + RESCORED_AT_ONCE] = np.add.reduceat(parts, np.cumsum(size) - size)
        self.weight[terms] = 0
        return scores

    def _best(self, docs: np.ndarray, scores: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        found = np.flatnonzero((scores >= least - SLACK) & (scores > 0))
        if len(found) > k:
            kth = np.partition(scores[found], len(found) - k)[len(found) - k]
            found = found[scores[found] >= kth - SLACK]
        best, docs = np.round(scores[found], DIGITS), docs[found]
        if len(found) > k:  # ties, as of copies: those with the smallest ids
            order = sorted(range(len(found)), key=lambda i: (-best[i], self.docs[docs[i]] is not None, self.docs[docs[i]] or 0))[:k]
            docs, best = docs[order], best[order]
        return docs, best


class Gathered:
    """Documents of a shard on their way into its index."""

    def __init__(self, held: Held):
        self.held = held
        self.docs: list = []
        self.pieces: list[tuple] = []

    def add(self, docs: pa.Array, texts: pa.Array) -> None:
        names = docs.to_pylist()
        for first in range(0, len(texts), RESCORED_AT_ONCE):
            found = [terms_of(t) for t in texts[first : first + RESCORED_AT_ONCE].to_pylist()]
            place = self.held.places(np.concatenate([f[0] for f in found]))
            doc = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])[place >= 0]
            counts = np.concatenate([f[1] for f in found])[place >= 0].astype(np.int32)
            sizes = np.bincount(doc, minlength=len(found))
            some = np.flatnonzero(sizes)  # no query finds the others
            self.docs.extend(names[first + i] for i in some.tolist())
            self.pieces.append((place[place >= 0], counts, sizes[some], np.array([f[2] for f in found], np.float64)[some]))

    def search(self, mean: float) -> Iterator[tuple[int, list, np.ndarray]]:
        terms, counts, sizes, lengths = (np.concatenate(c) for c in zip(*self.pieces, strict=True))
        self.pieces = []
        if len(terms):
            shard = Shard(self.held, self.docs, terms, counts, sizes, lengths, mean)
            for query, docs, scores in shard.search():
                yield query, [self.docs[d] for d in docs], scores


def statistics(docs: DataFrame, text_col: str) -> tuple[DataFrame, int, float]:
    """Document frequency of each term (term, df), number of documents, mean length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(t) for t in batch.column(0).to_pylist()]
            terms, df = np.unique(np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *terms.tolist()], pa.int64()),
                    pa.array([len(found), *df.tolist()], pa.int64()),
                    pa.array([sum(f[2] for f in found)] + [0] * len(terms), pa.int64()),
                ],
                names=["term", "df", "words"],
            )

    counted = docs.select(text_col).mapInArrow(run, "term long, df long, words long")
    counted = written(counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words")), "frequencies")
    whole = counted.where("term is null").first()
    n, words = (whole.df, whole.words) if whole else (0, 0)
    return counted.where("term is not null").select("term", "df"), n, words / max(1, n)


def _counted(queries: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(query, place, terms, dfs, counts): the distinct terms of each query that documents have,
    the documents that have each, and its number in the query; ``place`` tells rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                ],
                names=["query", "terms", "counts"],
            )

    kind = queries.schema["query"].dataType.simpleString()
    rows = queries.mapInArrow(run, f"query {kind}, terms array<long>, counts array<long>")
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = written(rows.select("place", "query", F.explode(F.arrays_zip("terms", "counts")).alias("t")), "query-terms")
    pairs = rows.select("place", "query", F.col("t.terms").alias("term"), F.col("t.counts").cast("int").alias("count")).join(frequencies, "term")
    pairs = pairs.select("place", "query", F.struct("term", "df", "count").alias("pair"))
    found = pairs.groupBy("place").agg(F.first("query").alias("query"), F.array_sort(F.collect_list("pair")).alias("pairs"))
    return found.select("query", "place", F.col("pairs.term").alias("terms"), F.col("pairs.df").alias("dfs"), F.col("pairs.count").alias("counts"))


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "query_id",
    query_text_col: str = "text",
) -> DataFrame:
    """(query_id, id_col, rank, score): for each row of ``queries`` the k documents with the
    highest BM25 scores, with score above 0, in order; equal scores go by id, nulls first.

    ``queries`` is a stated query set; each of its rows is matched with every shard, round by
    round (see the head of this module). Null or empty texts are documents of length 0 that no query finds, and queries that find
    nothing. Repeated documents are found each; rows of ``queries`` with one id share k places.
    Empty tables give an empty result.
    """
    frequencies, n, mean = statistics(docs, text_col)
    shards = max(1, -(-n // DOCS_PER_SHARD))
    asked = queries.select(F.col(query_id_col).alias("query"), F.col(query_text_col).alias("text"))
    asked = written(_counted(asked, frequencies), "queries")
    doc, text = F.col(id_col), F.col(text_col)
    shard = F.pmod(F.xxhash64(doc, text), F.lit(shards)).cast("int").alias("shard")
    rows = docs.select(shard, doc.alias("doc"), text.alias("text"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc")))
    known = asked.count()
    tasks, cores = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism
    low, high, best = 0, min(shards, FIRST_SHARDS), None
    while low < shards:
        parts = max(1, min(-(-known // QUERIES_PER_TASK), tasks // (high - low)), -(-known // HELD_QUERIES))
        together = max(1, min(SHARDS_PER_TASK, (high - low) * parts // max(1, TASKS_PER_CORE * cores)))
        found = _round(rows, asked, best, low, high, parts, together, k, n, mean)
        found = found if best is None else best.select("query", "doc", "score").unionByName(found)
        best = found.withColumn("rank", rank).where(F.col("rank") <= k)
        if high < shards:
            best = written(best, "best")
        low, high = high, min(shards, 4 * high)
    return best.select(F.col("query").alias(query_id_col), F.col("doc").alias(id_col), F.col("rank").cast("long").alias("rank"), "score")


def _round(
    docs: DataFrame, asked: DataFrame, best: DataFrame | None, low: int, high: int, parts: int, together: int, k: int, n: int, mean: float
) -> DataFrame:
    """(query, doc, score): what the shards ``low`` to ``high`` - 1 add to the k best so far.

    A cell is ``together`` shards and one of ``parts`` of the queries."""
    doc_kind, query_kind = docs.schema["doc"].dataType.simpleString(), asked.schema["query"].dataType.simpleString()
    here = docs.where((F.col("shard") >= low) & (F.col("shard") < high))
    if best is None:
        asked = asked.withColumn("least", F.lit(0.0))
    else:
        least = best.where(F.col("rank") == k).select(F.col("query").alias("_query"), F.col("score").alias("least"))
        asked = asked.join(least, F.col("query").eqNullSafe(F.col("_query")), "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    part = F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int")
    first = F.floor((F.col("shard") - low) / together).cast("int") * parts
    no_query = {"query": query_kind, "least": "double", "terms": "array<long>", "dfs": "array<long>", "counts": "array<int>"}
    given = here.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        (first + F.col("part")).alias("cell"), "shard", "doc", "text", *(F.lit(None).cast(t).alias(c) for c, t in no_query.items())
    )
    # a cell's queries come before its documents
    sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(low), F.lit(high - 1), F.lit(together)))).select(
        (first + part).alias("cell"), F.lit(-1).alias("shard"), F.lit(None).cast(doc_kind).alias("doc"), F.lit(None).cast("string").alias("text"), *no_query
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, shard, held, gathered, kinds = None, None, None, None, None

        def results() -> Iterator[pa.RecordBatch]:
            query, doc, score = [], [], []
            for q, docs, scores in gathered.search(mean) if gathered else ():
                query.extend([q] * len(docs))
                doc.extend(docs)
                score.extend(scores.tolist())
                if len(query) > 50_000:
                    yield packed(query, doc, score)
                    query, doc, score = [], [], []
            yield packed(query, doc, score)

        def packed(query: list, doc: list, score: list) -> pa.RecordBatch:
            names = held.query.take(pa.array(query, pa.int64())) if query else pa.array([], kinds[0])
            return pa.RecordBatch.from_arrays([names, pa.array(doc, kinds[1]), pa.array(score, pa.float64())], names=["query", "doc", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = batch.columns
            kinds = columns[4].type, columns[2].type
            cells, shards = (np.asarray(c) for c in columns[:2])
            edges = np.flatnonzero((cells[1:] != cells[:-1]) | (shards[1:] != shards[:-1])) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(cells)], strict=True):
                if (cells[i], shards[i]) != (cell, shard):
                    yield from results()
                    if cells[i] != cell:
                        held = None
                    (cell, shard), gathered = (cells[i], shards[i]), None
                some = [c.slice(i, j - i) for c in columns]
                if shard < 0:
                    held = held or Held(n, k)
                    held.add(some[4], np.array(some[5]), *some[6:9])
                elif held:
                    if held.pieces:
                        held.finish()
                    gathered = gathered or Gathered(held)
                    gathered.add(some[2], some[3])
                    if len(gathered.docs) >= 2 * DOCS_PER_SHARD:  # of rows with the same id and text, which one shard has
                        yield from results()
                        gathered = None
        if kinds:
            yield from results()

    cells = min(-(-(high - low) // together) * parts, MAX_TASKS)
    dealt = given.unionByName(sent).repartitionById(cells, F.pmod(F.col("cell"), F.lit(cells))).sortWithinPartitions("cell", "shard")
    return dealt.mapInArrow(run, f"query {query_kind}, doc {doc_kind}, score double")
