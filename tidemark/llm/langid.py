"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises every substring of that
text. Parsing a document greedily into the longest matches with one language's text gives
a number of phrases; the more the document is like that text, the longer the matches and
the fewer the phrases. Each language learns from as much text as it has, up to a bound. A
phrase points to a place in that text and so costs the logarithm of its length in bits; the
language in which a document costs the fewest bits wins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import SuffixAutomaton
from tidemark.llm.worker import kept

UNKNOWN = "und"
# Bounds of what is learnt from, whatever the size of the corpus
SAMPLE_DOCS, SAMPLE_CHARS_PER_DOC, SAMPLE_CHARS = 128, 1000, 24_000
# Bounds over all languages: so many texts are drawn, and so many characters learnt in all
SAMPLE_ROWS, ALL_CHARS = 8192, 64 * SAMPLE_CHARS
PARTS = 64
WINDOW = 512
LANES = 4_000_000
PHRASE = np.int32(1 << 30)
# Codes of letters that are not in the model, and of whatever is not a letter
OTHER, SPACE = 0, 1
TABLE = 0x3000
# Amounts of text that differ by less than this share are made equal: equal amounts compare exactly
NEAR = 1 / 8
# Added to the amount learnt, so that a phrase of a language with hardly any text is not for nothing
LITERALS = 256
# A text that costs its best language more than this multiple of the bits a char that the
# language needs for its own held-back text is in none of the languages.
REJECT_RATIO = 2.5
# Share of the most that other languages need which a language without held-back text is
# taken to need; less, as the short phrases of a small language let any text fit better
UNSEEN = 0.8
FEW_PHRASES = 24  # too few to reject a short text


@dataclass
class Model:
    """``step[language, state * alphabet + char]``: the next state, with the bit ``PHRASE``
    where a phrase ended before this char. ``bits``: what a phrase costs. ``typical``: bits
    per char of own text."""

    languages: list[str]
    alphabet: dict[int, int]
    step: np.ndarray
    bits: np.ndarray
    typical: np.ndarray

    @property
    def width(self) -> int:
        return len(self.alphabet) + SPACE + 1


def sample(docs: DataFrame, text_col: str, lang_col: str, order: Column) -> DataFrame:
    """(lang, text, place): at most SAMPLE_DOCS distinct texts of each language, the start of
    each; the only rows that reach the driver. Beyond SAMPLE_ROWS rows each language has
    fewer, the same number or one more than another, and none is left out. Texts are drawn by their hashes, so that only
    those of the drawn ones are looked up. Copies are counted as one before the draw, and
    Spark keeps SAMPLE_DOCS hashes a language and task before the shuffle, so neither a hot
    text nor a hot language is heavier than another."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.substring(text_col, 1, SAMPLE_CHARS_PER_DOC).alias("text"), order.alias("draw"))
    rows = rows.where("lang is not null and length(trim(text)) > 0").withColumn("name", F.xxhash64("text"))
    distinct = rows.groupBy("lang", "name").agg(F.min("draw").alias("draw"))
    # ranked in parts of a language first, so that no task sees what every input task keeps of it
    part = F.row_number().over(Window.partitionBy("lang", F.pmod("name", F.lit(PARTS))).orderBy("draw", "name"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "name"))
    drawn = distinct.withColumn("part", part).where(F.col("part") <= SAMPLE_DOCS).drop("part")
    drawn = drawn.withColumn("place", place).where(F.col("place") <= SAMPLE_DOCS).orderBy("place", "lang").limit(SAMPLE_ROWS)
    found = rows.join(F.broadcast(drawn.select("lang", "name", "place")), ["lang", "name"])
    return found.groupBy("lang", "place").agg(F.min("text").alias("text"))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: Column | None = None) -> Model:
    """Automata of a bounded sample of the labelled rows. Null and blank texts, and rows
    without a label, teach nothing. More than SAMPLE_ROWS labels are an error.

    ``order`` draws the sample; by default a hash of the text. Every fourth text is held
    back to find what a language needs for text of its own that it has not seen. A language
    of fewer than four texts holds none back and is measured by the others (UNSEEN); if no language has text held back, nothing is rejected.
    """
    rows = sample(docs, text_col, lang_col, F.xxhash64(text_col) if order is None else order)
    texts: dict[str, list[str]] = {}
    for row in rows.orderBy("lang", "place").collect():
        texts.setdefault(row.lang, []).append(row.text.lower())
    languages = sorted(texts)
    if len(languages) >= SAMPLE_ROWS:
        raise ValueError(f"{SAMPLE_ROWS} labels or more: too many for languages")
    if not languages:
        return Model([], {}, np.zeros((0, 1), np.int32), np.zeros(0), np.zeros(0))
    taught = {x: [t for i, t in enumerate(texts[x]) if i % 4 or len(texts[x]) < 4] for x in languages}
    most = min(SAMPLE_CHARS, ALL_CHARS // len(languages))
    sizes = _sizes({x: min(most, sum(map(len, t))) for x, t in taught.items()})
    common: dict[int, int] = {}
    words = {}
    for x in languages:
        # an equal share of every text, so that one long text does not stand for a language;
        # what a short text leaves goes to the longer ones
        words[x], room = [], sizes[x]
        for i, t in enumerate(sorted(taught[x], key=len)):
            part = t[: -(-room // (len(taught[x]) - i))]
            words[x].append(part)
            room -= len(part)
        for ch in filter(str.isalpha, "".join(words[x])):
            common.setdefault(ord(ch), len(common) + SPACE + 1)
    if len(common) > 250:  # the automaton reads bytes; the rarest characters share one code
        counted = sorted(common, key=lambda c: (-sum(w.count(chr(c)) for v in words.values() for w in v), c))[:250]
        common = {c: i + SPACE + 1 for i, c in enumerate(counted)}
    steps = []
    for x in languages:
        coded = {c.tobytes(): 0 for c in coder(common)(words[x])}
        steps.append(_table(SuffixAutomaton(coded), len(common) + SPACE + 1))
    longest = max(map(len, steps))
    step = np.zeros((len(languages), longest), np.int32)
    for i, s in enumerate(steps):
        step[i, : len(s)] = s
    bits = np.log2(LITERALS + np.array([sizes[x] for x in languages]))
    model = Model(languages, common, step, bits, np.full(len(languages), np.nan))
    held = {x: [t for i, t in enumerate(texts[x]) if i % 4 == 0 and len(texts[x]) >= 4] for x in languages}
    for i, x in enumerate(languages):
        phrases, chars, foreign = _parsed(model, held[x])
        if chars.sum():
            model.typical[i] = _cost(model, phrases, foreign)[:, i].sum() / chars.sum()
    unseen = np.isnan(model.typical)
    model.typical[unseen] = np.inf if unseen.all() else UNSEEN * model.typical[~unseen].max()
    return model


def _sizes(given: dict[str, int]) -> dict[str, int]:
    """How much each language learns: what it has, made equal where that is nearly the same.
    No language loses more than the share NEAR, however little another one has."""
    sizes, group = {}, []
    for x in sorted(given, key=lambda x: -given[x]):
        if group and given[x] < (1 - NEAR) * given[group[0]]:
            group = []
        group.append(x)
        sizes.update(dict.fromkeys(group, given[x]))
    return sizes


def _cost(model: Model, phrases: np.ndarray, foreign: np.ndarray) -> np.ndarray:
    """Bits of each text in each language. A letter that no language has is a phrase in
    every one, and costs each the same."""
    return (phrases - foreign[:, None]) * model.bits + foreign[:, None] * model.bits.max()


def _table(automaton: SuffixAutomaton, width: int) -> np.ndarray:
    """Where a state has no step for a char, the phrase ends and the char starts the next."""
    states = len(automaton.link)
    root = np.full(width, PHRASE, np.int32)
    for c in range(width):
        root[c] = PHRASE | automaton.edges.get(c, 0)
    table = np.tile(root, (states, 1))
    for key, target in automaton.edges.items():
        table[key >> 8, key & 255] = target
    table[0] = root & ~PHRASE  # the start of a text ends no phrase
    table[0][(root & ~PHRASE) == 0] = PHRASE  # a char that the language lacks is a phrase
    return table.reshape(-1)


def coder(alphabet: dict[int, int]) -> Callable[[list[str]], list[np.ndarray]]:
    """Texts as codes of their lower-case letters; what is between letters is one SPACE."""
    lookup = np.array([OTHER if chr(c).isalpha() else SPACE for c in range(TABLE)], np.uint8)
    far = {c: code for c, code in alphabet.items() if c >= TABLE}
    for c, code in alphabet.items():
        if c < TABLE:
            lookup[c] = code

    def code(text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        codes = lookup[np.minimum(points, TABLE - 1)]
        for at in np.flatnonzero(points >= TABLE):
            codes[at] = far.get(int(points[at]), OTHER)
        spaces = codes == SPACE
        spaces[1:] &= spaces[:-1].copy()
        spaces[:1] = False
        return codes[~spaces]

    return lambda texts: [code(t) for t in texts]


def parse(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(phrases[text, language], codes[text]) of whole texts."""
    return _parsed(model, texts)[:2]


def _parsed(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``parse``, and how many of the codes are letters that are not in the model.

    Texts are cut into windows of WINDOW chars that are parsed side by side, a column of
    chars at a time; a phrase also ends with its window, for every language alike.
    """
    codes = coder(model.alphabet)(texts)
    chars = np.array([len(c) for c in codes], np.int64)
    foreign = np.array([len(c) - np.count_nonzero(c) for c in codes], np.int64)
    owner = np.repeat(np.arange(len(texts)), -(-chars // WINDOW))
    pieces = [c[i : i + WINDOW] for c in codes for i in range(0, len(c), WINDOW)]
    sizes = np.array([len(p) for p in pieces], np.int64)
    phrases = np.zeros((len(texts), len(model.languages)), np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(by_size):
        longest = int(sizes[by_size[at]])
        lanes = by_size[at : at + max(1, LANES // longest)]
        at += len(lanes)
        grid = np.zeros((longest, len(lanes)), np.uint8)
        for lane, p in enumerate(lanes):
            grid[: sizes[p], lane] = pieces[p]
        alive = np.searchsorted(-sizes[lanes], -np.arange(1, longest + 1), side="right")
        for i in range(len(model.languages)):
            step, state, ended = model.step[i], np.zeros(len(lanes), np.int32), np.ones(len(lanes), np.int32)
            for position in range(longest):
                n = alive[position]
                to = step[state[:n] * model.width + grid[position, :n]]
                ended[:n] += to >> 30
                state[:n] = to & ~PHRASE
            np.add.at(phrases[:, i], owner[lanes], ended)
    return phrases, chars, foreign


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, accepted) for each row; only the text is looked at.

    ``score`` is one minus the share of bits that the winner needs of the runner-up's
    (0: undecided; 1: the only language). Ties go to the label that sorts first. A null
    text, or one without letters, is ``und`` with score 0, as is every text if no language
    was learnt. ``accepted`` is false for ``und`` and for texts that fit their best
    language no better than text of another language would. Repeated rows and null ids
    are kept as they are; an empty table gives an empty result.
    """
    src = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = src.schema[0].dataType.simpleString()
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(("languages", name), lambda: shared.value)
        for batch in batches:
            labels, scores, accepted = judged(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), labels, scores, accepted], names=[id_col, "lang_pred", "score", "accepted"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, accepted boolean")


def judged(model: Model, texts: list[str | None]) -> tuple[pa.Array, pa.Array, pa.Array]:
    lettered = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    labels = [UNKNOWN] * len(texts)
    scores, accepted = np.zeros(len(texts)), np.zeros(len(texts), bool)
    if model.languages and lettered:
        phrases, chars, foreign = _parsed(model, [texts[i] for i in lettered])
        cost = _cost(model, phrases, foreign)
        best = cost.argmin(axis=1)
        rows = np.arange(len(lettered))
        least = cost[rows, best]
        rest = cost.copy()
        rest[rows, best] = np.inf
        second = rest.min(axis=1)
        scores[lettered] = np.maximum(0.0, 1 - least / second)
        few = phrases[rows, best] <= FEW_PHRASES
        accepted[lettered] = few | (least <= REJECT_RATIO * model.typical[best] * chars)
        for i, b in zip(lettered, best, strict=True):
            labels[i] = model.languages[b]
    return pa.array(labels, pa.string()), pa.array(scores), pa.array(accepted)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is accepted, with all their columns as they are."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(("languages", name), lambda: shared.value)
        for batch in batches:
            yield batch.filter(judged(model, batch.column(at).to_pylist())[2])

    return docs.mapInArrow(run, docs.schema)
