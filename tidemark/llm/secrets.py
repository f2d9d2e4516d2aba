"""Secrets in texts: known forms, and strings of high entropy. Native expressions only.

Spark finds all matches of a pattern but not where they are; splitting the text by the
same pattern gives what lies between them, and the running lengths of both give the
places, in code points.

The entropy scan takes candidate strings (unbroken runs of key characters), puts each in a
character class and slides a window over it. The counts of the window's characters are
carried along: a step adds the character that enters, removes the one that leaves, and
corrects the sum of c log2 c for these two alone. Windows over the class's threshold are
joined into spans. Candidates on the allow-list are left out. A second scan takes the pieces
between - _ / and + by themselves, with classes that only an unbroken piece can be judged by.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forms in the order in which they are listed. (kind, pattern, group that
# holds the value, its least length). For the last two, a longer least run in the pattern
# finds what the shorter one finds and drops later.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
FORMS = (
    ("assign", ASSIGN, 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
ENTROPY = "entropy"
KINDS = (*(f[0] for f in FORMS), ENTROPY)

WINDOW = 20
PLACED_AT_ONCE = 256
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
# (what all of a candidate of the class matches, bits a character from which a window counts);
# the first class that fits is the candidate's, and one that fits none is no candidate
CLASSES = (
    (r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", 2.9),
    (r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", 3.3),
    (r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z]).+$", 3.6),
)
PIECE = r"(?<![A-Za-z0-9])[A-Za-z0-9]{20,}+"
# Hex or capitals after a prefix; lower case with digits; both cases without digits, where
# capitals stand closer together than in joined words
PIECE_CLASSES = (
    *CLASSES[:2],
    (r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", 3.6),
    (r"^(?=.*[a-z])(?=[A-Za-z]+$)(?>.*?[A-Z][a-z]?[A-Z]){3}", 3.7),
)
# Candidates that match are never secrets: those of which every window touches a placeholder,
# counted-up or equal characters, and UUIDs. Longer ones are measured with all their windows.
ALLOWED = (
    r"^(?=.{20,512}$)(?>.{0,19}?(?:(?i:example|sample|placeholder|dummy|changeme|0123456789|abcdefghijk)|(.)\1{7,}+))+.{0,19}$",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)


def _placed(found: Column, between: Column) -> Column:
    """(start, end) of every match, from the matches and what lies between them. Spans are
    collected in blocks, since an array is copied when something is put behind it."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(between, i))
        end = start + F.length(F.get(found, i))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("spans"))

    def block(state: Column, first: Column) -> Column:
        places = F.sequence(first, F.least(first + PLACED_AT_ONCE, F.size(found)) - 1)
        return F.aggregate(
            places, F.struct(state["at"].alias("at"), empty.alias("spans")), step,
            lambda s: F.struct(s["at"].alias("at"), F.concat(state["blocks"], F.array(s["spans"])).alias("blocks")),
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int>>>").alias("blocks"))
    firsts = F.sequence(F.lit(0), F.size(found) - 1, F.lit(PLACED_AT_ONCE))
    walked = F.aggregate(firsts, zero, block, lambda s: F.flatten(s["blocks"]))
    return F.when(F.size(found) > 0, walked).otherwise(empty)


def _plogp(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(F.greatest(count, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))


def windows_over(text: Column, threshold: Column, window: int = WINDOW) -> Column:
    """(start, end) of the joined windows of ``text`` with at least ``threshold`` bits a character.

    The text is split into the codes of its characters once. The span that may still grow
    is carried by itself and put to the others when the next one begins.
    """
    empty = F.array().cast("array<struct<start:int,end:int>>")
    codes = F.transform(F.slice(F.split(text, ""), F.lit(1), F.length(text)), lambda c: F.instr(F.lit(ALPHABET), c))

    def closed(state: Column) -> Column:
        open_one = F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))
        return F.when(state["end"] > 0, F.concat(state["spans"], open_one)).otherwise(state["spans"])

    def walk(bound: Column) -> Column:
        codes, least = bound["codes"], bound["least"]

        def step(state: Column, i: Column) -> Column:
            enters, leaves, full = F.get(codes, i), F.get(codes, i - window), i >= window
            before = F.get(state["counts"], enters)
            total = state["total"] + _plogp(before + 1) - _plogp(before)
            gone = F.get(state["counts"], leaves) + F.when(enters == leaves, 1).otherwise(0)
            total = F.when(full, total - _plogp(gone) + _plogp(gone - 1)).otherwise(total)
            counts = F.transform(
                state["counts"],
                lambda c, k: c + F.when(k == enters, 1).otherwise(0) - F.when(full & (k == leaves), 1).otherwise(0),
            )
            bits = F.log2(F.lit(float(window))) - total / window
            start, end = (i - window + 1).cast("int"), (i + 1).cast("int")
            hit = (i >= window - 1) & (bits >= least)
            fresh = hit & (state["end"] < start)
            return F.struct(
                counts.alias("counts"), total.alias("total"),
                F.when(fresh | (hit & (state["end"] == 0)), start).otherwise(state["start"]).alias("start"),
                F.when(hit, end).otherwise(state["end"]).alias("end"),
                F.when(fresh, closed(state)).otherwise(state["spans"]).alias("spans"),
            )

        zero = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("total"),
            F.lit(0).alias("start"), F.lit(0).alias("end"), empty.alias("spans"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step, closed)

    # bound by a lambda, so that both are made once and not at every step
    bound = F.struct(codes.alias("codes"), threshold.alias("least"))
    walked = F.get(F.transform(F.array(bound), walk), F.lit(0))
    return F.when(F.length(text) >= window, walked).otherwise(empty)


def with_spans(docs: DataFrame, text: Column, name: str, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with a column ``name``: the spans (start, rank, end) of ``text`` in order,
    rank being the place of the kind in KINDS. ``name`` also begins the names of columns
    that come and go on the way."""
    whole = F.coalesce(text, F.lit(""))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    found = {}
    scans = ((ENTROPY, CANDIDATE, CLASSES), ("piece", PIECE, PIECE_CLASSES))
    patterns = (*FORMS, *((kind, pattern, 0, 0) for kind, pattern, _ in scans))
    for kind, pattern, group, _ in patterns:
        found[f"{name}_{kind}"] = F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))
        if group:
            found[f"{name}_{kind}_value"] = F.regexp_extract_all(whole, F.lit(pattern), F.lit(group))
    docs = docs.select(*cols, *(c.alias(k) for k, c in found.items()))
    placed = []
    for kind, pattern, _, _ in patterns:
        hits = F.col(f"{name}_{kind}")
        between = F.when(F.size(hits) > 0, F.split(whole, pattern, -1))
        placed.append(between.alias(f"{name}_{kind}_between"))
    docs = docs.select("*", *placed)

    def form_spans(rank: int, kind: str, group: int, least: int) -> Column:
        hits = F.col(f"{name}_{kind}")
        values = F.col(f"{name}_{kind}_value") if group else hits
        zipped = F.zip_with(
            _placed(hits, F.col(f"{name}_{kind}_between")), values,
            lambda s, v: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.length(v).alias("size")),
        )
        long_enough = F.filter(zipped, lambda s: s["size"] >= least)
        return F.transform(long_enough, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))

    base = F.concat(*(form_spans(rank, kind, group, least) for rank, (kind, _, group, least) in enumerate(FORMS)))

    def scanner(classes: tuple) -> Callable[[Column, Column], Column]:
        def scanned(s: Column, text: Column) -> Column:
            threshold = F.coalesce(*(F.when(text.rlike(pattern), bits) for pattern, bits in classes))
            secret = threshold.isNotNull() & ~reduce(Column.__or__, (text.rlike(a) for a in allowed), F.lit(False))
            inside = F.when(secret, windows_over(text, threshold)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
            return F.transform(
                inside,
                lambda w: F.struct((s["start"] + w["start"]).alias("start"), F.lit(len(FORMS)).alias("rank"), (s["start"] + w["end"]).alias("end")),
            )

        return scanned

    added = []
    for kind, _, classes in scans:
        hits = F.col(f"{name}_{kind}")
        spans = F.zip_with(_placed(hits, F.col(f"{name}_{kind}_between")), hits, scanner(classes))
        added.append(F.flatten(spans).alias(f"{name}_added_{kind}"))
    docs = docs.select(*cols, base.alias(f"{name}_base"), *added)

    def beside(spans: Column, others: Column) -> Column:
        return F.filter(spans, lambda a: ~F.exists(others, lambda b: (b["start"] <= a["start"]) & (a["end"] <= b["end"])))

    whole_ones, pieces = (F.col(f"{name}_added_{kind}") for kind, *_ in scans)
    new = beside(F.concat(whole_ones, beside(pieces, whole_ones)), F.col(f"{name}_base"))
    return docs.select(*cols, F.array_sort(F.concat(F.col(f"{name}_base"), new)).alias(name))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """(id_col, spans) for each row, the spans being (start, rank, end) in code points.

    The forms are found leftmost and non-overlapping per kind, and the short ones dropped;
    a span covers the whole match. The entropy scan adds what lies in no span of a form.
    A null or empty text has no spans; repeated rows and null ids are kept as they are; an
    empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return with_spans(src, F.col("_text"), "spans", allowed).select(F.col("_id").alias(id_col), "spans")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = None, mask: str = "[SECRET]", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by ``mask``; spans that overlap
    or touch become one. ``chars_col``, if given, gets the new length where it held one.
    Texts without a secret, null texts and all other columns stay as they are."""
    name = "_spans"
    while any(c.startswith(name) for c in docs.columns):
        name = f"_{name}"
    text = F.col(f"`{text_col}`")
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def merge(merged: Column, s: Column) -> Column:
        last = F.try_element_at(merged, F.lit(-1))
        joins = (F.size(merged) > 0) & (last["end"] >= s["start"])
        return F.when(
            joins,
            F.concat(F.slice(merged, 1, F.size(merged) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(merged, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    marked = with_spans(docs, text, name, allowed)
    holes = marked.select(*(F.col(f"`{c}`") for c in docs.columns), F.aggregate(F.col(name), empty, merge).alias(name))
    ends = F.concat(F.array(F.lit(0)), F.transform(F.col(name), lambda s: s["end"]))
    starts = F.concat(F.transform(F.col(name), lambda s: s["start"]), F.array(F.length(text)))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a))
    clean = F.when(F.size(name) > 0, F.array_join(kept, mask))
    # a column of its own: next to a new column called like the text, the text's name would be ambiguous
    masked = holes.select(*(F.col(f"`{c}`") for c in docs.columns), clean.alias(name))
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    columns[text_col] = F.coalesce(F.col(name), text)
    if chars_col:
        chars = F.col(f"`{chars_col}`")
        new = F.when(chars.isNotNull() & F.col(name).isNotNull(), F.length(name)).otherwise(chars)
        columns[chars_col] = new.cast(docs.schema[chars_col].dataType)
    return masked.select(*(value.alias(c) for c, value in columns.items()))
