"""Near-duplicate documents: SuperMinHash signatures, banding, verification, components.

A document is its set of distinct five-word shingles. SuperMinHash gives every element a
random permutation of the signature's components and the ranks ``j + r`` along it, so the
components of one element never compete at the same rank; the signature is complete as
soon as every component holds a value below the next rank, which ends the work early.

Equal sets are first put together, whatever their number. Buckets of equal bands then
propose links between a bucket's leader, the member that meets most others, and the rest, so
a group of g copies costs about g verifications. Members of buckets that still hold different
components are then joined exactly, by the rarest of their shingles; so every link of two
documents with a band in common is found, or already joined by others.
Every link is verified on the full sets, and components come from verified links alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import Memo
from tidemark.llm.worker import kept
from tidemark.session import written

WORDS_PER_SHINGLE = 5
SIMILARITY = 75  # percent
COMPONENTS, BAND = 128, 4
CHUNK = 1 << 16

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def scrambled(x: np.ndarray) -> np.ndarray:
    """The next 64 random bits of each generator state (the splitmix step)."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes() -> Memo:
    return kept("word hashes", lambda: Memo(xxhash.xxh3_64_intdigest))


def shingles(text: str | None, words: Memo) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; with fewer words, the whole sequence as one."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.array([words[w] for w in found], dtype=np.uint64)
    size = min(WORDS_PER_SHINGLE, len(hashes))
    count = len(hashes) - size + 1
    rolled = np.full(count, size, np.uint64)
    for j in range(size):
        rolled = scrambled(rolled ^ hashes[j : j + count])
    return np.unique(rolled)


def superminhash(sets: list[np.ndarray], size: int = COMPONENTS) -> np.ndarray:
    """One signature per non-empty set, all sets at once and rank by rank.

    Values of rank ``j`` lie in [j, j + 1), so a component that has a value keeps it when
    later ranks are drawn: only open components matter, and sets without any are done.
    """
    n = len(sets)
    signature = np.full(n * size, np.iinfo(np.uint64).max, np.uint64)
    filled = np.zeros(n * size, bool)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    state = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = None
    for j in range(size):
        state = scrambled(state)
        drawn = j + ((state & np.uint64(0xFFFFFFFF)) * np.uint64(size - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            component, first = drawn, drawn
        else:
            rows = np.arange(len(state))
            if order is None:  # the first rank needs no table; now its exchange is made up for
                order = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.int32), (len(state), 1))
                order[rows, first], order[:, 0] = 0, first
            component = order[rows, drawn].astype(np.int64)
            order[rows, drawn] = order[:, j]
            order[:, j] = component
        at = owner * size + component
        new = ~filled[at]
        np.minimum.at(signature, at[new], state[new])
        filled[at] = True
        open_sets = ~filled.reshape(n, size).all(axis=1)
        if not open_sets.any():
            break
        keep = open_sets[owner]
        if 2 * keep.sum() < len(keep):
            owner, state, first = owner[keep], state[keep], first[keep]
            order = order[keep] if order is not None else None
    return signature.reshape(n, size)


def band_keys(signatures: np.ndarray, rows: int = BAND) -> np.ndarray:
    """A key for each band, different bands having different keys."""
    n, size = signatures.shape
    bands = signatures[:, : size // rows * rows].reshape(n, size // rows, rows)
    key = np.broadcast_to(np.arange(size // rows, dtype=np.uint64), (n, size // rows))
    for r in range(rows):
        key = scrambled(key ^ bands[:, :, r])
    return key.view(np.int64) if key.flags.c_contiguous else np.ascontiguousarray(key).view(np.int64)


def row_key(doc: Column, text: Column) -> tuple[Column, Column]:
    return F.xxhash64(doc, text).alias("row_a"), F.xxhash64(text, doc, F.lit(1)).alias("row_b")


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row_a, row_b, n_shingles, set_id, bands) for each row; the last two are null for
    an empty set, and equal rows, no others, have equal ``row_a`` and ``row_b``."""
    doc, text = F.col(id_col), F.col(text_col)
    src = docs.select(text.alias("text"), doc.alias("doc"), *row_key(doc, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_hashes()
        for batch in batches:
            sizes, names, keys = [], [], []
            held: list[np.ndarray] = []

            def flush():
                filled = [s for s in held if len(s)]
                found = iter(band_keys(superminhash(filled)))
                for s in held:
                    sizes.append(len(s))
                    names.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    keys.append(next(found) if len(s) else None)
                held.clear()

            for text in batch.column(0).to_pylist():
                held.append(shingles(text, words))
                if sum(map(len, held[-64:])) >= CHUNK or len(held) >= 64:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc", "row_a", "row_b", "n_shingles", "set_id", "bands"],
            )

    kind = src.schema["doc"].dataType.simpleString()
    return src.mapInArrow(run, f"doc {kind}, row_a long, row_b long, n_shingles long, set_id binary, bands array<long>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """(node, items): the packed shingles of the sets in ``wanted`` (node, set_id, row). A set's
    text is found by the key of one row that has it, of which id and text are parts: rows
    without ids, or many texts under one id, meet only their own sets."""
    src = docs.select(F.col(text_col).alias("text"), *row_key(F.col(id_col), F.col(text_col)))
    known = wanted.select("node", "set_id", "row.row_a", "row.row_b").hint("shuffle_hash")
    src = src.join(known, ["row_a", "row_b"]).select("node", "set_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_hashes()
        for batch in batches:
            nodes, items = [], []
            for node, name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packed = shingles(text, words).tobytes()
                if xxhash.xxh3_128_digest(packed) == name:
                    nodes.append(node)
                    items.append(packed)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(items, pa.binary())], names=["node", "items"])

    return src.mapInArrow(run, "node long, items binary")


def verified(pairs: DataFrame, items: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    of = {c: items.select(F.col("node").alias(c), F.col("items").alias(f"{c}_items")) for c in "ab"}
    src = pairs.select("a", "b").join(of["b"], "b").join(of["a"], "a").select("a", "b", "a_items", "b_items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = 0
                if 100 * min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return src.mapInArrow(run, "a long, b long")


def contracted(edges: DataFrame) -> DataFrame:
    """Union-find inside each task: the same components with a forest's worth of edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["a", "b"]
        )

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component, for every node that has an edge.

    Tasks contract their own edges by union-find, then large and small stars alternate
    until nothing changes; each round ends as a table, so no lineage builds up, and no
    task needs a component as a whole.
    """

    def smallest(links: DataFrame) -> DataFrame:
        return links.groupBy("a").agg(F.min("b").alias("low"))

    def marked(links: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("total")
        return written(links.observe(seen, F.count(F.lit(1)).alias("n"), total), "links"), seen.get

    links, now = marked(contracted(edges))
    before = None
    while now != before:
        before = now
        both = links.union(links.select("b", "a"))
        low = smallest(both).withColumn("low", F.least("low", "a"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = written(large, "links")
        low = smallest(large)
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links, now = marked(small.union(low.select("a", F.col("low").alias("b"))).distinct())
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(links.select("b", "b").distinct())


def _candidates(open_nodes: DataFrame, items: DataFrame, similarity: int) -> DataFrame:
    """All pairs (a, b) of different labels that can be similar enough, by prefix filtering.

    The shingles of every set are put in one order, the rarest first. Two sets of the wanted
    similarity share a shingle among the first (1 - similarity) of each, so passages that
    many texts have in common, which come last, propose no pairs.
    """
    src = open_nodes.select("node", "label").join(items, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(s.as_buffer()) // 8 for s in batch.column(2)], np.int64)
            part = np.cumsum(sizes) // CHUNK  # a few sets at a time: a row here is many there
            for begin, end in zip(*(np.searchsorted(part, np.unique(part), side=s) for s in ("left", "right")), strict=True):
                few, count = batch.slice(begin, end - begin), sizes[begin:end]
                rows = pa.array(np.repeat(np.arange(len(count)), count))
                shingles = np.concatenate([np.frombuffer(s.as_buffer(), np.int64) for s in few.column(2)])
                yield pa.RecordBatch.from_arrays(
                    [few.column(0).take(rows), few.column(1).take(rows), pa.array(np.repeat(count, count)), pa.array(shingles)],
                    names=["node", "label", "size", "shingle"],
                )

    tokens = written(src.mapInArrow(run, "node long, label long, size long, shingle long"), "tokens")
    # only shingles of several sets are counted here; the others come first, in any order
    known = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = tokens.join(known, "shingle")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sets"), F.desc("shingle")))
    least = F.ceil(F.col("size") * similarity / 100)
    # from the end: the last ``least`` - 1 places of a set are not in its prefix
    prefix = shared.withColumn("rest", place).where(F.col("rest") >= least).select("node", "label", "size", "shingle", "rest")
    prefix = written(prefix, "prefixes")
    other = prefix.select(*(F.col(c).alias(f"b_{c}") for c in ("node", "label", "size", "rest")), "shingle")
    # at their first common shingle, what is left of the shorter rest bounds the intersection
    enough = F.least("rest", "b_rest") * (100 + similarity) >= (F.col("size") + F.col("b_size")) * similarity
    pairs = prefix.join(other, "shingle").where(enough & (F.col("label") < F.col("b_label")))
    return pairs.select(F.col("node").alias("a"), F.col("b_node").alias("b"))


def _buckets(sets: DataFrame) -> DataFrame:
    """(key, node, order): the buckets of two sets or more; ``order`` is the greater the more
    other sets a node meets in all its buckets."""
    keys = sets.select("node", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(keys.join(sizes, "key"), "met")
    tie = F.pmod(F.xxhash64("node"), F.lit(1 << 20))
    order = met.groupBy("node").agg(F.sum("n").alias("n")).select("node", (F.col("n") * (1 << 20) + tie).alias("order"))
    return written(met.select("key", "node").join(order, "node"), "buckets")


def _links(buckets: DataFrame, items: DataFrame, similarity: int) -> DataFrame:
    """(node, label) of every set that is linked with another."""
    leaders = buckets.groupBy("key").agg(F.max_by("node", "order").alias("leader"))
    pairs = buckets.join(leaders, "key").where("node <> leader")
    pairs = pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    tested = written(pairs, "pairs")
    edges = written(verified(tested, items, similarity), "edges")
    labels = components(edges)
    marked = buckets.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = marked.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    open_nodes = marked.join(mixed.select("key"), "key", "left_semi").select("node", "label").distinct()
    pairs = _candidates(open_nodes, items, similarity)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    return components(edges.union(written(verified(pairs, items, similarity), "edges")))


def _classified(docs: DataFrame, id_col: str, text_col: str, similarity: int) -> DataFrame:
    """Every row's sketch (without bands), the label and name of its component, and ``kept``."""
    sketch = written(sketches(docs, id_col, text_col), "sketches")
    groups = sketch.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc").alias("doc"), F.min(F.struct("row_a", "row_b")).alias("row"), F.first("bands").alias("bands")
    )
    sets = written(groups.withColumn("node", F.monotonically_increasing_id()), "sets")
    buckets = _buckets(sets)
    wanted = buckets.select("node").distinct()
    items = written(full_sets(docs, id_col, text_col, sets.join(wanted, "node", "left_semi")), "shingles")
    labels = written(_links(buckets, items, similarity), "labels")
    named = sets.select("set_id", "node", "doc").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("doc").alias("name"))
    named = named.join(names, "label").select("set_id", "label", "name")
    name = F.when(F.col("set_id").isNull(), F.col("doc")).otherwise(F.col("name"))
    return (
        sketch.drop("bands")
        .join(named, "set_id", "left")
        .withColumn("component_id", name)
        .withColumn("kept", F.coalesce(F.col("doc") == F.col("component_id"), F.col("component_id").isNull()))
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row for each row of ``docs``.

    Two documents are linked where 100 * intersection >= similarity * union. The component
    is named by its smallest id and ``kept`` marks the rows that bear it. A null, empty or
    blank text has no shingles and is linked with nothing, so it is kept. Repeated rows are
    linked like other copies and, having one id, are kept or not together. Rows without an
    id take part in components; a component without any id has a null name, and all its
    rows are kept. An empty table gives an empty result.
    """
    found = _classified(docs, id_col, text_col, similarity)
    return found.select(F.col("doc").alias(id_col), "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, one for each component and all blank ones, with all
    their columns as they are. Of rows that bear the component's name (repeated rows, or
    rows without ids) one stays."""
    found = _classified(docs, id_col, text_col, similarity).where("kept and label is not null")
    chosen = found.groupBy("label").agg(F.min(F.struct("doc", "row_a", "row_b")).alias("row"))
    chosen = chosen.select(F.col("row.row_a").alias("_a"), F.col("row.row_b").alias("_b"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col(f"`{text_col}`")
    a, b = row_key(F.col(f"`{id_col}`"), text)
    rows = docs.select(F.struct(*columns).alias("row"), a.alias("_a"), b.alias("_b"))
    rows = rows.join(chosen, ["_a", "_b"], "left_semi").dropDuplicates(["_a", "_b"]).select("row.*")
    return rows.union(docs.where(text.isNull() | ~text.rlike(r"[^\x20\x09-\x0D]")))
