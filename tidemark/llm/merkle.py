"""A Merkle manifest of a table, with a proof for every row.

Rows are leaves; the leaves of a group form a binary tree, and the groups' roots form one
more tree above them. A node is (tree, level, idx): its children are (tree, level - 1,
2 idx) and the next one, and the top of a group's tree is the leaf of that number of tree
``TOP``.

Levels are hashed in blocks of neighbouring nodes, ``BLOCK_LEVELS`` levels at once, so that
a table of 10^10 rows takes three passes and no task has more than one block in hand.
Proofs come by pointer jumping: every node begins with the segment of its own sibling and a
pointer to its parent; a self-join on the pointer puts the ancestor's segment behind the
node's and takes over the ancestor's pointer, so that the distance doubles each time.
Pointers from a level that 2^(k+1) divides go 2^k levels up in round k; so of the inner
nodes only those that a later round needs are carried on, and only leaves get whole paths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.session import written

TOP = -1
BLOCK_LEVELS = 12
# In round k a pointer's target is asked for by at most 2^(2^k) nodes of one tree; from round 4 on
# that many are spread over copies of the target
COPIES = {4: 256}
MOST_COPIES = 4096

# A step of a path: one of these bytes and, but for ALONE, the 32 bytes of the sibling's digest
ALONE, LEFT, RIGHT = 0, 1, 2


def digest(fields: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields, each as ``-`` if null, else its UTF-8 byte count,
    a colon and the value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def numbered(df: DataFrame, keys: list[Column], label: str) -> DataFrame:
    """``df`` with ``part`` and ``number``, its rows' places in the order of ``keys`` from 0.

    The rows are dealt by ranges and sorted there; only the counts of the parts are summed
    up in one place.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    at = written(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    at = at.withColumn("part", F.shiftright("_at", 33))
    parts = at.groupBy("part").agg(F.count("*").alias("_n"), F.min("_at").alias("_low"))
    before = F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", "_low", F.coalesce(before, F.lit(0)).alias("_before"))
    return at.join(parts, "part").withColumn("number", F.col("_at") - F.col("_low") + F.col("_before")).drop("_at", "_low", "_before")


def _parent(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one block: each with its step, and what remains on top with its digest."""
    rows = rows.sort_values("idx")
    tree, level, idx = int(rows["tree"].iloc[0]), int(rows["level"].iloc[0]), int(rows["idx"].iloc[0])
    n, hashes = int(rows["n"].iloc[0]), rows["hash"].tolist()
    out = []
    for _ in range(BLOCK_LEVELS):
        if n == 1:
            break
        for i, own in enumerate(hashes):
            pair = i ^ 1
            if pair < len(hashes):
                step = bytes([LEFT if pair < i else RIGHT]) + bytes.fromhex(hashes[pair])
            else:
                step = bytes([ALONE])
            out.append((tree, level, idx + i, n, None, step))
        hashes = [_parent(hashes[i : i + 2]) for i in range(0, len(hashes), 2)]
        level, idx, n = level + 1, idx // 2, (n + 1) // 2
    out += [(tree, level, idx + i, n, own, None) for i, own in enumerate(hashes)]
    return pd.DataFrame(out, columns=["tree", "level", "idx", "n", "hash", "step"])


NODE = "tree long, level int, idx long, n long, hash string, step binary"


def _hashed(leaves: DataFrame, most: int, label: str) -> tuple[DataFrame, DataFrame]:
    """(nodes below the roots with their steps, roots) of the trees over ``leaves`` (tree, idx,
    n, hash), n being the leaves of the tree and ``most`` the greatest n."""
    rows = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", "hash")
    height = max(most - 1, 0).bit_length()
    nodes, roots = [], [rows.where("n = 1")]
    for _ in range(0, height, BLOCK_LEVELS):
        block = F.shiftright("idx", BLOCK_LEVELS).alias("block")
        done = written(rows.where("n > 1").groupBy("tree", block).applyInPandas(_block, NODE), label)
        nodes.append(done.where("step IS NOT NULL"))
        rows = done.where("step IS NULL").drop("step")
        roots.append(rows.where("n = 1"))
    below = rows.sparkSession.createDataFrame([], NODE) if not nodes else nodes[0]
    for more in nodes[1:]:
        below = below.union(more)
    tops = roots[0]
    for more in roots[1:]:
        tops = tops.union(more)
    return below, tops.select("tree", "hash")


def _folded(path: bytes, leaf: str) -> tuple[str, str]:
    """(the top that the leaf leads to, the digest of all siblings)."""
    at, own, siblings = 0, leaf, []
    while at < len(path):
        side = path[at]
        at += 1
        if side == ALONE:
            own = _parent([own])
            continue
        other = path[at : at + 32].hex()
        at += 32
        siblings.append(other)
        own = _parent([other, own] if side == LEFT else [own, other])
    return own, _parent(siblings)


def with_proofs(manifest: DataFrame, claimed_col: str = "leaf") -> DataFrame:
    """``manifest`` with ``folded_root`` and ``proof_sha256``: the top that the digest in
    ``claimed_col`` leads to by the row's path, and the digest of the path's siblings.

    A null digest has a null ``folded_root``; all other columns stay as they are.
    """
    schema = StructType([*manifest.schema.fields]).add("folded_root", StringType()).add("proof_sha256", StringType())
    path_at, leaf_at = manifest.columns.index("path"), manifest.columns.index(claimed_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(path_at).to_pylist(), batch.column(leaf_at).to_pylist(), strict=True)
            folded = [_folded(path, leaf or "") + (leaf is None,) for path, leaf in pairs]
            roots = pa.array([None if missing else root for root, _, missing in folded], pa.string())
            proofs = pa.array([proof for _, proof, _ in folded], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, roots, proofs], names=schema.names)

    return manifest.mapInArrow(run, schema)


def manifest(
    docs: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    group_col: str = "lang",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """(id_col, leaf, subroot, root, path, and the columns of ``extra``) of every row.

    ``leaf`` is the digest of ``fields``; ``path`` holds the siblings up to the root (a byte
    for the side, then the digest). A group's leaves stand by ``id_col``, groups by their
    value, null first in both. ``extra`` are expressions over ``docs`` that are carried along,
    such as the digest of a row as it is claimed to be.

    Nulls in any column are fields of their own kind (``-``), so a null and an empty text
    differ; rows of equal id stand by their digest, and rows that are equal in all fields are
    interchangeable; very long texts are only hashed; an empty table gives no row; further
    columns of ``docs`` are not read.
    """
    extra = extra or {}
    spark = docs.sparkSession
    given = docs.select(
        F.col(id_col).alias("id"),
        F.col(group_col).alias("grp"),
        F.unhex(digest([F.col(f) for f in fields])).alias("leaf"),
        F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in extra.items()]).alias("extra"),
    )
    given = written(given, "merkle-leaves")
    order = [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf")]
    rows = numbered(given, order, "merkle-order")

    # a group of any size is joined by (part, group), so a hot one is spread over its parts
    spread = rows.groupBy("part", "grp").agg(F.min("number").alias("first"), F.count("*").alias("rows"))
    groups = spread.groupBy("grp").agg(F.min("first").alias("start"), F.sum("rows").alias("n"))
    groups = numbered(groups, [F.col("start")], "merkle-groups")
    groups = groups.select("grp", "start", "n", F.col("number").alias("tree"))
    n_groups, most = groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    named = groups.select(F.col("grp").alias("g"), "start", "n", "tree")
    spread = spread.join(named, F.col("grp").eqNullSafe(F.col("g"))).select(F.col("part").alias("p"), "g", "start", "n", "tree")
    leaves = rows.join(spread, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))).select(
        "part", "tree", "n", (F.col("number") - F.col("start")).alias("idx"), "id", "leaf", "extra"
    )
    leaves = written(leaves, "merkle-placed")

    below, subroots = _hashed(leaves.select("tree", "idx", "n", F.lower(F.hex("leaf")).alias("hash")), most, "merkle-levels")
    tops = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_groups).alias("n"), "hash")
    above, roots = _hashed(written(tops, "merkle-subroots"), n_groups, "merkle-top")
    first = roots.first()
    root = first["hash"] if first else None

    top_height = max(n_groups - 1, 0).bit_length()
    # of two nodes on a level the parent is the top of its tree, and so a leaf of the tree above
    enters = (F.col("tree") != TOP) & (F.col("n") == 2)
    nodes = below.union(above).select(
        "tree", "level", "idx", F.col("step").alias("path"),
        F.when(enters, F.lit(TOP)).otherwise(F.col("tree")).alias("up_tree"),
        F.when(enters, F.lit(0)).otherwise(F.col("level") + 1).alias("up_level"),
        F.when(enters, F.col("tree")).otherwise(F.shiftright("idx", 1)).alias("up_idx"),
    )

    # Leaves begin at themselves with an empty path; the only leaf of a tree is a leaf of the top
    alone = F.col("n") == 1
    paths = leaves.select(
        "part", "tree", "idx", "id", "leaf", "extra",
        F.lit(b"").alias("path"),
        F.when(alone, F.lit(TOP).cast("long")).otherwise(F.col("tree")).alias("up_tree"),
        F.lit(0).alias("up_level"),
        F.when(alone, F.col("tree")).otherwise(F.col("idx")).alias("up_idx"),
    )
    at_root = (F.col("up_tree") == TOP) & (F.col("up_level") == top_height)

    def jumped(rows: DataFrame, over: DataFrame, copies: int) -> DataFrame:
        """``rows`` with the segment and the pointer of the node that they point to."""
        kept = [c for c in rows.columns if c not in ("path", "up_tree", "up_level", "up_idx")]
        # rows at the root meet no node, so they may go anywhere
        asked = rows.withColumn("_copy", F.when(at_root, -1 - F.col("idx")).otherwise(F.col("idx") % copies))
        target = over.select(
            F.col("tree").alias("_t"), F.col("level").alias("_l"), F.col("idx").alias("_i"), F.col("path").alias("_path"),
            F.col("up_tree").alias("_ut"), F.col("up_level").alias("_ul"), F.col("up_idx").alias("_ui"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("_c"),
        )
        meets = (
            (F.col("up_tree") == F.col("_t")) & (F.col("up_level") == F.col("_l"))
            & (F.col("up_idx") == F.col("_i")) & (F.col("_copy") == F.col("_c"))
        )
        return asked.join(target, meets, "left").select(
            *kept,
            F.concat("path", F.coalesce("_path", F.lit(b""))).alias("path"),
            F.coalesce("_ut", "up_tree").alias("up_tree"),
            F.coalesce("_ul", "up_level").alias("up_level"),
            F.coalesce("_ui", "up_idx").alias("up_idx"),
        )

    in_top = F.col("tree") == TOP
    tallest = max(most - 1, 0).bit_length() + top_height
    # the first step of a leaf is that of its own node
    paths = jumped(paths, nodes.where(in_top | (F.col("level") == 0)), 1)
    nodes = nodes.where(in_top | (F.col("level") > 0))
    reach, k = 1, 0
    while reach < tallest:
        # here nodes reach 2^k levels up and those of levels that 2^k divides are left
        copies = 1 if k < 4 else COPIES.get(k, MOST_COPIES)
        met = nodes.where(in_top | (F.col("level") % (2 * reach) == reach))
        paths = jumped(paths, met, copies)
        if 2 * reach < tallest:
            going_on = nodes.where(in_top | (F.col("level") % (2 * reach) == 0))
            nodes = written(jumped(going_on, met, copies), "merkle-segments")
        reach, k = 2 * reach, k + 1

    # subroots come by (part, tree), as the groups did
    places = spread.select(F.col("p"), F.col("tree").alias("t")).join(subroots.withColumnRenamed("tree", "t"), "t")
    found = paths.join(places, (F.col("part") == F.col("p")) & (F.col("tree") == F.col("t")))
    return found.select(
        F.col("id").alias(id_col), F.lower(F.hex("leaf")).alias("leaf"), F.col("hash").alias("subroot"), F.lit(root).alias("root"), "path",
        *[F.col("extra").getField(name).alias(name) for name in extra],
    )
