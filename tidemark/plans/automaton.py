"""Event sequences of any shape: steps that follow one another at once or later, or several times.

A pattern is compiled to a chain of places, each with the kinds that lead to it and whether
other events may come in between. A match begins at every event of the first kind and goes
on with the first event that fits, so it is one walk along the chain. In batch the walks of
all starts are taken together, place by place, over numpy arrays; the stream's fold keeps
the unfinished walks of a key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.halo import default_width, micros, with_segments


@dataclass(frozen=True)
class Step:
    """``times`` events of one of ``kinds``. They follow what is before them at once, or
    with ``relaxed`` after any others."""

    kinds: tuple[str, ...]
    times: int = 1
    relaxed: bool = False


def step(*kinds: str, times: int = 1, relaxed: bool = False) -> Step:
    return Step(kinds, times, relaxed)


def chain(steps: Sequence[Step]) -> list[tuple[frozenset[str], bool]]:
    """The places in order: what leads there, and whether others may come before it."""
    places = [(frozenset(s.kinds), s.relaxed) for s in steps for _ in range(s.times)]
    if not places:
        raise ValueError("a pattern needs a step")
    return places


def _walks(group: np.ndarray, own: np.ndarray, us: np.ndarray, bits: np.ndarray, places: list[tuple[int, bool]], within: int):
    """(first, last) row of every match that begins at an own row, in sorted rows of whole groups."""
    fits = {bit: np.flatnonzero(bits >> bit & 1) for bit, _ in places}
    first = fits[places[0][0]]
    first = first[own[first]]
    at = first
    for bit, relaxed in places[1:]:
        if relaxed:
            there = fits[bit]
            k = np.searchsorted(there, at, side="right")
            ok = k < len(there)
            first, at, to = first[ok], at[ok], there[k[ok]]
        else:
            ok = at + 1 < len(group)
            first, at = first[ok], at[ok]
            to = at + 1
            ok = (bits[to] >> bit & 1).astype(bool)
            first, at, to = first[ok], at[ok], to[ok]
        ok = (group[to] == group[at]) & (us[to] - us[first] < within)
        first, at = first[ok], to[ok]
    return first, at


def find_sequences(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, kind: str, steps: Sequence[Step], within: str,
) -> DataFrame:
    """(keys, first_tie, first_at, last_at) of every match of ``steps`` in less than ``within``.

    Keys are cut into time segments that also hold what follows within reach, so one
    shuffle by (key, segment) serves any pattern and a hot key is spread over its segments.
    Rows without a time, and kinds that are null, match nothing; the latter still part
    what has to follow at once.
    """
    keys, reach = list(keys), micros(within)
    places = chain(steps)
    sets = list(dict.fromkeys(kinds for kinds, _ in places))
    walk = [(sets.index(kinds), relaxed) for kinds, relaxed in places]
    bits = sum((F.when(F.col(kind).isin(sorted(kinds)), 1 << i).otherwise(0) for i, kinds in enumerate(sets)), F.lit(0))
    slim = df.where(F.col(ts).isNotNull()).select(
        *keys, ts, F.unix_micros(ts).alias("_us"), F.col(tie).cast("long").alias("_tie"), bits.cast("long").alias("_bits")
    )
    cut = with_segments(slim, ts, default_width(reach), ahead_us=reach).drop(ts)
    # neighbouring groups are told apart by a hash of 64 bits
    rows = cut.select(*keys, "_segment", F.xxhash64(*keys, "_segment").alias("_group"), "_own", "_us", "_tie", "_bits")
    rows = rows.repartition(*keys, "_segment").sortWithinPartitions(*keys, "_segment", "_us", "_tie")
    out = T.StructType([slim.schema[k] for k in keys] + [T.StructField(n, T.LongType()) for n in ("first_tie", "_first", "_last")])

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        group, us, tie_of, bits_of = (table.column(c).to_numpy() for c in ("_group", "_us", "_tie", "_bits"))
        own = table.column("_own").to_numpy(zero_copy_only=False).astype(bool)
        first, last = _walks(group, own, us, bits_of, walk, reach)
        named = [table.column(k).take(pa.array(first)).combine_chunks() for k in keys]
        named = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in named]
        return pa.RecordBatch.from_arrays([*named, pa.array(tie_of[first]), pa.array(us[first]), pa.array(us[last])], names=out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last group, which may go on
        name = None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("_group").to_numpy()
            cut_at = int(np.flatnonzero(np.append(True, group[1:] != group[:-1]))[-1])
            if cut_at or (held and name != group[0]):
                whole = [*held, batch.slice(0, cut_at)] if cut_at else held
                yield found(whole)
                held = []
            held.append(batch.slice(cut_at))
            name = group[-1]
        if held:
            yield found(held)

    matches = rows.mapInArrow(run, out)
    return matches.select(*keys, "first_tie", F.timestamp_micros("_first").alias("first_at"), F.timestamp_micros("_last").alias("last_at"))
