"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

BPE gives the prefixes of a word a simple structure: if ``t`` is the last token of the
encoding of a prefix, then the encoding of the rest of that prefix is what stands before
it. So each prefix has exactly one possible last token, namely the vocabulary token that
is a suffix of the prefix and can stand behind the last token of the remaining prefix.
The suffix automaton of the vocabulary gives the suffixes that are tokens, byte by byte;
``compatible`` decides the second condition from the merge ranks alone.

Words recur, so every task keeps a bounded memo from a word to its ids; a word that is
not in it goes through the dynamic programming, however long it is. New words of usual
length are taken together, the prefixes of one length of all of them in one step. Few or
long ones are taken in sorted order, and each begins behind the prefix that it shares with
the one before.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.worker import in_slices, kept

MEMO_WORDS = 150_000
LONGEST_MEMO_WORD = 64
LONGEST_KEY = 15
TOGETHER = 64  # fewer new words are taken one by one
PAIR_SLOTS = 1 << 20
SPREAD = 0x9E3779B97F4A7C1
INFINITE = 1 << 60

# Fixed value: the word pattern of the byte-level vocabulary
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


# The characters of two bytes that are letters in every version of Unicode
SHORT_LETTERS = np.array([regex.match(r"\p{L}", chr(c)) is not None for c in range(0x500)])
SPACES_MEET = re.compile(r"\s\s")


class Memo(dict):
    """A dict that computes what it lacks. When it is full it keeps what it holds as the
    older generation, from which words that come again move back, and forgets the one before."""

    def __init__(self, compute, size: int = MEMO_WORDS):
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, word):
        found = self.older.get(word)
        if found is None:
            found = self.compute(word)
        if len(word) <= LONGEST_MEMO_WORD:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def vocabulary_bytes(spec: dict) -> dict[str, bytes]:
    byte = {c: b for b, c in enumerate(byte_characters())}
    return {t: bytes(byte[c] for c in t) for t in spec["model"]["vocab"]}


class SuffixAutomaton:
    """All substrings of a set of byte strings; a state knows the string that ends there."""

    def __init__(self, words: dict[bytes, int]):
        following: list[dict[int, int]] = [{}]
        self.link, self.length, self.token = [-1], [0], [-1]

        def state(length: int, link: int, edges: dict[int, int]) -> int:
            following.append(edges)
            self.link.append(link)
            self.length.append(length)
            self.token.append(-1)
            return len(following) - 1

        def split(above: int, char: int, target: int) -> int:
            copy = state(self.length[above] + 1, self.link[target], dict(following[target]))
            self.link[target] = copy
            while above >= 0 and following[above].get(char) == target:
                following[above][char] = copy
                above = self.link[above]
            return copy

        for word, number in words.items():
            last = 0
            for char in word:
                target = following[last].get(char)
                if target is not None:
                    if self.length[target] != self.length[last] + 1:
                        target = split(last, char, target)
                    last = target
                    continue
                fresh, above = state(self.length[last] + 1, 0, {}), last
                while above >= 0 and char not in following[above]:
                    following[above][char] = fresh
                    above = self.link[above]
                if above >= 0:
                    target = following[above][char]
                    if self.length[target] != self.length[above] + 1:
                        target = split(above, char, target)
                    self.link[fresh] = target
                last = fresh
            self.token[last] = number
        self.edges = {(s << 8) | c: t for s, edges in enumerate(following) for c, t in edges.items()}
        # (number, length) of the words that are suffixes of a state's string, the longest
        # first: with the string itself, and without it
        self.whole: list[tuple] = [()] * len(following)
        self.proper: list[tuple] = [()] * len(following)
        for s in sorted(range(1, len(following)), key=self.length.__getitem__):
            self.proper[s] = self.whole[self.link[s]]
            own = ((self.token[s], self.length[s]),) if self.token[s] >= 0 else ()
            self.whole[s] = own + self.proper[s]


def slots_of(keys: np.ndarray, size: int) -> np.ndarray:
    """A place for each key in a table whose size is a power of 2."""
    return (keys * SPREAD >> 30) & (size - 1)


class Table:
    """A fixed map from keys (0 or above) to numbers (0 or above) that is asked for many keys at once."""

    def __init__(self, known: dict[int, int]):
        self.size = 1 << max(4, (4 * len(known)).bit_length())
        self.keys, self.values = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int32)
        keys, values = np.fromiter(known.keys(), np.int64, len(known)), np.fromiter(known.values(), np.int32, len(known))
        slots = slots_of(keys, self.size)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]  # of keys with one place, one stays
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & (self.size - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for an unknown one."""
        slots = slots_of(keys, self.size)
        there = self.keys[slots]
        found = np.where(there == keys, self.values[slots], np.int32(-1))
        other = np.flatnonzero((there != keys) & (there >= 0))
        while len(other):
            slots[other] = (slots[other] + 1) & (self.size - 1)
            at, wanted = slots[other], keys[other]
            there = self.keys[at]
            hit = there == wanted
            found[other[hit]] = self.values[at[hit]]
            other = other[~hit & (there >= 0)]
        return found


def gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` that begin at ``starts``, one behind the other."""
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(len(at))
    return ids.take(at)


class Known:
    """The ids of pieces of at most LONGEST_KEY bytes, asked for and added many at once.

    A piece is known by two numbers that hold its bytes and its length, so equal numbers are
    equal pieces. It takes 50 to 80 bytes, with the ids.
    """

    def __init__(self):
        self.count = self.filled = 0
        self.slots = np.full(1 << 12, -1, np.int32)
        self.low, self.high = np.empty(1 << 10, np.uint64), np.empty(1 << 10, np.uint64)
        self.starts, self.sizes = np.empty(1 << 10, np.int32), np.empty(1 << 10, np.int32)
        self.ids = np.empty(1 << 12, "<u4")

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(SPREAD))) * np.uint64(SPREAD)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(SPREAD)
        return (mixed >> np.uint64(64 - (len(self.slots).bit_length() - 1))).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for an unknown one."""
        slots = self._slots(low, high)
        found = self.slots[slots]
        other = np.flatnonzero((found >= 0) & ((self.low[found] != low) | (self.high[found] != high)))
        while len(other):
            slots[other] = (slots[other] + 1) & (len(self.slots) - 1)
            at = found[other] = self.slots[slots[other]]
            other = other[(at >= 0) & ((self.low[at] != low[other]) | (self.high[at] != high[other]))]
        return found

    def room(self, ids: np.ndarray) -> int:
        """Lays ids behind those in use, where the next ones added go; gives their place."""
        if self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.filled], np.empty(self.filled + len(ids), "<u4")])
        self.ids[self.filled : self.filled + len(ids)] = ids
        return self.filled

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Distinct pieces that are not known yet, their ids one behind the other."""
        count = self.count + len(low)
        if count > len(self.low):
            more = np.empty(count, np.uint64)
            self.low, self.high = (np.concatenate([x[: self.count], more]) for x in (self.low, self.high))
            more = np.empty(count, np.int32)
            self.starts, self.sizes = (np.concatenate([x[: self.count], more]) for x in (self.starts, self.sizes))
        new = slice(self.count, count)
        self.low[new], self.high[new], self.sizes[new] = low, high, sizes
        self.starts[new] = self.room(ids) + np.cumsum(sizes) - sizes
        self.filled += len(ids)
        first, self.count = self.count, count
        if 3 * count > len(self.slots):
            self.slots, first = np.full(1 << (4 * count).bit_length(), -1, np.int32), 0
        numbers = np.arange(first, count, dtype=np.int32)
        slots = self._slots(self.low[first:count], self.high[first:count])
        while len(numbers):
            free = self.slots[slots] < 0
            self.slots[slots[free]] = numbers[free]  # of pieces with one place, one stays
            waiting = self.slots[slots] != numbers
            numbers, slots = numbers[waiting], (slots[waiting] + 1) & (len(self.slots) - 1)

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces one behind the other, and how many each has."""
        sizes = self.sizes[numbers]
        return gathered(self.ids, self.starts[numbers].astype(np.int64), sizes.astype(np.int64)), sizes


OTHER, LETTER, DIGIT, MARK, BLANK, LINE_END = range(6)


def looked_up(table: bytes, chars: np.ndarray) -> np.ndarray:
    """What ``table`` has for each byte."""
    return np.frombuffer(chars.tobytes().translate(table), np.uint8)


def _classes() -> tuple[bytes, bytes, bytes]:
    """The class of every byte; whether a word ends between bytes of two classes, which are in one
    number; whether a byte is a space (1) or the first of a character beyond ASCII that may be one (2).
    An apostrophe may begin a word with letters, so it is no MARK."""
    of = np.full(256, OTHER, np.uint8)
    for c in map(chr, range(33, 127)):
        of[ord(c)] = LETTER if c.isalpha() else DIGIT if c.isdigit() else MARK if c != "'" else OTHER
    of[ord(" ")], of[ord("\n")] = BLANK, LINE_END
    ends = np.zeros(256, bool)
    for x in range(6):
        for y in range(6):
            ends[x << 3 | y] = y in (BLANK, LINE_END) or x == LINE_END or (x != y and {x, y} <= {LETTER, DIGIT, MARK})
    spaces = np.array([chr(b).isspace() and b < 128 for b in range(256)], np.uint8)
    spaces[[0xC2, 0xE1, 0xE2, 0xE3]] = 2
    return of.tobytes(), ends.tobytes(), spaces.tobytes()


CLASS, WORD_ENDS, SPACES = _classes()
SPACE_PAIRS = np.array([0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380])
KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Encoder:
    """Texts to packed ids by way of their words, for the byte-level word pattern.

    Where no two spaces meet, a word ends before every blank, around every line end, and
    between a letter, a digit and a mark of ASCII, so a text is cut there without the
    pattern. Texts are taken some at a time; their pieces are cut and looked up by array
    operations, each distinct piece that is not known is encoded once, and what was found
    lately is kept. The ids of the texts are then gathered from those of the pieces.
    """

    CHARS_AT_ONCE = 1_000_000
    PIECES = 1_000_000
    LONG_PIECES = 50_000

    def __init__(self, special: Iterable[str]):
        self.special = list(special)
        self.known, self.before = Known(), Known()
        self.long = Memo(None, self.LONG_PIECES)

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Packed ids (little-endian unsigned 32-bit integers) of each text, in order."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= self.CHARS_AT_ONCE:
                yield from self._group(held)
                held, size = [], 0
        yield from self._group(held)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces as they are cut here, each a text of its own."""
        return self.encode_whole(pieces)

    def _group(self, texts: list[str]) -> list[bytes]:
        chars, offsets = as_array(texts)
        # such a text is one piece
        whole = [i for i in may_have_spaces_meet(chars, offsets) if SPACES_MEET.search(texts[i])]
        whole = sorted({*whole, *(i for i, t in enumerate(texts) if any(s in t for s in self.special))})
        out = dict(zip(whole, self.encode_whole([texts[i] for i in whole]), strict=True))
        rest = [i for i in range(len(texts)) if i not in out]
        if whole:
            chars, offsets = as_array([texts[i] for i in rest])
        if len(chars):
            kinds = looked_up(CLASS, chars)
            cut = np.ones(len(chars), bool)
            cut[1:] = looked_up(WORD_ENDS, kinds[:-1] << 3 | kinds[1:]).view(bool)
            cut[offsets[:-1][offsets[:-1] < len(chars)]] = True
            begins = np.flatnonzero(cut)
            ids, sizes = self._ids(chars, begins, np.diff(begins, append=len(chars)))
            ends = np.concatenate(([0], np.cumsum(sizes)))
            packed, cuts = ids.tobytes(), (4 * ends[np.searchsorted(begins, offsets)]).tolist()
        else:
            packed, cuts = b"", [0] * len(offsets)
        for k, i in enumerate(rest):
            out[i] = packed[cuts[k] : cuts[k + 1]]
        return [out[i] for i in range(len(texts))]

    def _ids(self, chars: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one behind the other, and how many each has."""
        if self.known.count > self.PIECES:
            self.before, self.known = self.known, Known()
        known, raw = self.known, chars.tobytes()
        padded = np.concatenate([chars, np.zeros(16, np.uint8)])
        eight = np.ndarray(len(chars) + 9, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        short = np.flatnonzero(lengths <= LONGEST_KEY)
        at, size = begins[short], lengths[short]
        low = eight[at] & KEEP[np.minimum(size, 8)]
        high = eight[at + 8] & KEEP[np.maximum(size - 8, 0)] | size.astype(np.uint64) << np.uint64(56)
        found = known.find(low, high)
        lacking = np.flatnonzero(found < 0)
        if len(lacking):
            order = lacking[np.lexsort((low[lacking], high[lacking]))]
            first = np.ones(len(order), bool)
            first[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
            new = order[first]
            numbers = self.before.find(low[new], high[new])
            again = numbers >= 0
            known.add(low[new[again]], high[new[again]], *self.before.ids_of(numbers[again]))
            new = new[~again]
            pieces = [raw[a:b].decode() for a, b in zip(at[new].tolist(), (at[new] + size[new]).tolist(), strict=True)]
            known.add(low[new], high[new], *joined_ids(self.encode_pieces(pieces)))
            found[lacking] = known.find(low[lacking], high[lacking])
        starts, sizes = np.empty(len(begins), np.int64), np.empty(len(begins), np.int64)
        starts[short], sizes[short] = known.starts[found], known.sizes[found]
        if len(short) < len(begins):
            long = np.flatnonzero(lengths > LONGEST_KEY)
            ids, sizes[long] = joined_ids(self._long([raw[a : a + n] for a, n in zip(begins[long].tolist(), lengths[long].tolist(), strict=True)]))
            starts[long] = known.room(ids) + np.cumsum(sizes[long]) - sizes[long]
        return gathered(known.ids, starts, sizes), sizes

    def _long(self, pieces: list[bytes]) -> list[bytes]:
        memo, older = self.long, self.long.older
        found = {p: memo[p] if p in memo else older.get(p) for p in dict.fromkeys(pieces)}
        new = [p for p, ids in found.items() if ids is None]
        found |= zip(new, self.encode_pieces([p.decode() for p in new]), strict=True)
        memo.compute = found.__getitem__
        for p in found:
            if len(p) <= LONGEST_MEMO_WORD:
                memo[p]
        memo.compute = None
        return [found[p] for p in pieces]


def as_array(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; the end comes last."""
    made = pa.array(texts, pa.large_string())
    _, offsets, chars = made.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1) if texts else np.zeros(1, np.int64)
    return np.frombuffer(chars, np.uint8, offsets[-1]) if offsets[-1] else np.zeros(0, np.uint8), offsets


def may_have_spaces_meet(chars: np.ndarray, offsets: np.ndarray) -> list[int]:
    """The texts in which two spaces of ASCII meet, or that may hold other spaces."""
    if len(chars) < 2:
        return []
    kinds = looked_up(SPACES, chars)
    at = np.flatnonzero((kinds[:-1] & kinds[1:] & 1).view(bool))
    lead = np.flatnonzero(kinds[:-1] == 2)
    lead = lead[np.isin(chars[lead].astype(np.int64) << 8 | chars[lead + 1], SPACE_PAIRS)]
    return np.unique(np.searchsorted(offsets, np.concatenate([at, lead]), side="right") - 1).tolist()


def one_words(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The numbers of the texts that are surely one word of the pattern: letters, digits of ASCII or marks
    of ASCII, a blank before them or not."""
    texts = np.flatnonzero(np.diff(offsets))
    if not len(texts):
        return texts
    begins, lasts = offsets[texts], offsets[texts + 1] - 1
    kinds = looked_up(CLASS, chars).copy()
    lead = np.flatnonzero((chars >= 0xC2) & (chars < 0xD4))
    lead = lead[SHORT_LETTERS[(chars[lead] & np.int64(31)) << 6 | chars[lead + 1] & 63]]
    kinds[lead] = kinds[lead + 1] = LETTER
    blank = begins[(kinds[begins] == BLANK) & (begins < lasts)]
    kinds[blank] = kinds[blank + 1]
    changes = np.concatenate(([0], np.cumsum(kinds[1:] != kinds[:-1])))
    return texts[(changes[begins] == changes[lasts]) & np.isin(kinds[begins], (LETTER, DIGIT, MARK))]


def joined_ids(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4


class ByteLevelBpe(Encoder):
    """One tokenizer file: a byte-level BPE vocabulary with its merges in order."""

    @staticmethod
    def check(path: str) -> dict:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("only plain byte-level BPE files are understood")
        return spec

    def __init__(self, path: str):
        spec = self.check(path)
        self.ids_of = {x["content"]: x["id"] for x in spec["added_tokens"]}
        super().__init__(self.ids_of)
        model = spec["model"]
        as_bytes = vocabulary_bytes(spec)
        ids = {as_bytes[t]: i for t, i in model["vocab"].items()}
        self.rank, self.parts, self.pair = {}, {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (as_bytes[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = ids[left + right]
            self.pair.setdefault((ids[left] << 20) | ids[right], rank)
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = rank, (ids[left], ids[right])
        self.automaton = SuffixAutomaton({b: i for b, i in ids.items() if len(b) == 1 or i in self.rank})
        self.bytes = {i: b for b, i in ids.items()} | {i: s.encode() for s, i in self.ids_of.items()}
        self.words = regex.compile(WORDS)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.matches: dict[int, bool] = {}
        self._tables()
        self.fresh: dict[str, bytes] = {}
        self.word = Memo(self._word, self.PIECES // 10)

    def _tables(self) -> None:
        """The automaton as arrays: edges, the longest token that ends in a state, with its whole
        string and without it, and of each token the longest other token that it ends with."""
        a = self.automaton
        self.edge_table = Table(a.edges)
        self.links, self.lengths = np.array(a.link, np.int32), np.array(a.length, np.int32)
        self.longest = np.array([[x[0][0] if x else -1 for x in side] for side in (a.proper, a.whole)], np.int32)
        self.sizes, self.shorter = np.zeros(1 << 20, np.uint8), np.full(1 << 20, -1, np.int32)
        for token, proper in zip(a.token, a.proper):
            if token >= 0:
                self.sizes[token] = min(len(self.bytes[token]), 255)
                self.shorter[token] = proper[0][0] if proper else -1
        self.pairs = np.full(PAIR_SLOTS, -1, np.int64)  # pair and whether it fits, the latest of each place

    def _fit(self, pairs: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs of tokens."""
        slots = slots_of(pairs, PAIR_SLOTS)
        known = self.pairs[slots]
        fits = (known & 1).astype(bool)
        unknown = np.flatnonzero(known >> 1 != pairs)
        if len(unknown):
            distinct, where = np.unique(pairs[unknown], return_inverse=True)
            found = np.array([self.compatible(p >> 20, p & 0xFFFFF) for p in distinct.tolist()])
            fits[unknown] = found[where]
            self.pairs[slots_of(distinct, PAIR_SLOTS)] = distinct << 1 | found
        return fits

    def encode_together(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of at most LONGEST_MEMO_WORD bytes: what ``encode_words`` does for a word, for
        the prefixes of one length of all words at once."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        lengths = np.array([len(words[i]) for i in order], np.int64)
        longest = int(lengths[0])
        chars = np.frombuffer(b"".join(words[i].ljust(longest, b"\0") for i in order), np.uint8).reshape(len(words), longest).T
        state, matched = np.zeros(len(words), np.int64), np.zeros(len(words), np.int32)
        last = np.zeros((longest + 1, len(words)), np.int32)
        for end in range(1, longest + 1):
            n = int(np.searchsorted(-lengths, -end, side="right"))  # words with a prefix of this length
            char, at = chars[end - 1, :n].astype(np.int64), state[:n]
            step = self.edge_table.get(at << 8 | char)
            lost = np.flatnonzero(step < 0)
            while len(lost):
                at[lost] = self.links[at[lost]]
                if (at[lost] < 0).any():
                    raise ValueError("no token ends here: the vocabulary lacks a byte")
                matched[lost] = self.lengths[at[lost]]
                step[lost] = self.edge_table.get(at[lost] << 8 | char[lost])
                lost = lost[step[lost] < 0]
            state[:n] = step
            matched[:n] += 1
            token = self.longest[(self.lengths[step] == matched[:n]).astype(np.int8), step]
            open_words = np.arange(n)
            while len(open_words):
                if (token < 0).any():
                    raise ValueError("no token ends here: the vocabulary lacks a byte")
                size = self.sizes[token].astype(np.int64)
                fits = size == end
                inner = np.flatnonzero(~fits)
                before = last[end - size[inner], open_words[inner]].astype(np.int64)
                fits[inner] = self._fit(before << 20 | token[inner])
                last[end, open_words[fits]] = token[fits]
                open_words, token = open_words[~fits], self.shorter[token[~fits]]
        ends, chosen = lengths.copy(), np.zeros((len(words), longest + 1), bool)
        open_words = np.flatnonzero(ends)
        while len(open_words):
            at = ends[open_words]
            chosen[open_words, at] = True
            ends[open_words] = at - self.sizes[last[at, open_words]]
            open_words = open_words[ends[open_words] > 0]
        ids = last.T[chosen].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(chosen.sum(axis=1))).tolist()]
        found = [b""] * len(words)
        for k, i in enumerate(order):
            found[i] = ids[cuts[k] : cuts[k + 1]]
        return found

    def compatible(self, first: int, second: int) -> bool:
        """Whether BPE leaves the two tokens side by side.

        ``x`` runs over the right edge of the first token's merge tree and ``y`` over the
        left edge of the second's. The two meet while both exist; then they are merged if
        their rank comes before the merges that consume either of them (at an equal rank
        the occurrence further left is merged first).
        """
        x, x_until = first, INFINITE
        while True:
            y, y_until = second, INFINITE
            x_from = self.rank.get(x, -1)
            while True:
                y_from = self.rank.get(y, -1)
                if max(x_from, y_from) < min(x_until, y_until):
                    merge = self.pair.get((x << 20) | y, INFINITE)
                    if merge < x_until and merge <= y_until and merge != INFINITE:
                        return False
                if y_from < 0:
                    break
                y, y_until = self.parts[y][0], y_from
            if x_from < 0:
                return True
            x, x_until = self.parts[x][1], x_from

    def _word(self, word: str) -> bytes:
        found = self.fresh.get(word)
        return packed(next(self.encode_words([word.encode()]))) if found is None else found

    def encode_words(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of each word. What is known of a prefix depends on it alone, so a word begins
        where it parts from the one before; sorted words share most of their bytes."""
        a, edges, matches = self.automaton, self.automaton.edges, self.matches
        link, length, whole, proper = a.link, a.length, a.whole, a.proper
        if len(matches) > self.PIECES:
            matches.clear()
        # of each prefix: the automaton's state, the length matched there, and the last token
        states, lengths, last = [0], [0], [0]
        before = b""
        for word in words:
            end = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                end += 1
            before = word
            del states[end + 1 :], lengths[end + 1 :], last[end + 1 :]
            state, matched = states[end], lengths[end]
            for char in word[end:] if end else word:
                end += 1
                step = edges.get((state << 8) | char)
                while step is None:
                    state = link[state]
                    matched = length[state]
                    step = edges.get((state << 8) | char)
                state = step
                matched += 1
                for token, size in whole[state] if length[state] == matched else proper[state]:
                    if size == end:
                        break
                    pair = (last[end - size] << 20) | token
                    fits = matches.get(pair)
                    if fits is None:
                        fits = matches[pair] = self.compatible(pair >> 20, token)
                    if fits:
                        break
                else:
                    raise ValueError("no token ends here: the vocabulary lacks a byte")
                states.append(state)
                lengths.append(matched)
                last.append(token)
            ids = []
            while end:
                ids.append(last[end])
                end -= len(self.bytes[last[end]])
            yield ids[::-1]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        return self._encode(pieces)

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Words that are new here are encoded together."""
        cut = [self.words.findall(t) for t in texts]
        memo, older = self.word, self.word.older
        new = [w for w in {w for ws in cut for w in ws} if w not in memo and w not in older]
        as_bytes = [w.encode() for w in new]
        short = [i for i, b in enumerate(as_bytes) if len(b) <= LONGEST_MEMO_WORD]
        short = short if len(short) >= TOGETHER else []
        self.fresh = dict(zip((new[i] for i in short), self.encode_together([as_bytes[i] for i in short]) if short else [], strict=True))
        rest = sorted((b, w) for b, w in zip(as_bytes, new, strict=True) if w not in self.fresh)
        self.fresh |= zip((w for _, w in rest), map(packed, self.encode_words(b for b, _ in rest)), strict=True)
        found = [b"".join(map(memo.__getitem__, ws)) if len(ws) != 1 else memo[ws[0]] for ws in cut]
        self.fresh = {}
        return found

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        parts = [self.specials.split(t) if self.specials and any(s in t for s in self.special) else [t] for t in texts]
        plain = iter(self._encode([p for ps in parts for p in ps if p not in self.ids_of]))
        return [b"".join(packed([self.ids_of[p]]) if p in self.ids_of else next(plain) for p in ps) for ps in parts]


class Decoder:
    """The bytes of every id; all that decoding needs of a tokenizer file."""

    def __init__(self, path: str):
        spec = ByteLevelBpe.check(path)
        as_bytes = vocabulary_bytes(spec)
        self.bytes = {i: as_bytes[t] for t, i in spec["model"]["vocab"].items()}
        self.bytes |= {x["id"]: x["content"].encode() for x in spec["added_tokens"]}

    def decode(self, ids: bytes) -> str:
        known = self.bytes
        return b"".join([known[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


class LibraryEncoder(Encoder):
    """The tokenizers library, asked once for each distinct piece."""

    WORDS_AT_ONCE = 64

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = ByteLevelBpe.check(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        super().__init__(t.content for t in self.library.get_added_tokens_decoder().values())
        self.letters = np.array(list(map(ord, byte_characters())), "<u2")
        self.model, self.end = Tokenizer(self.library.model), self._end(spec["model"])

    def _end(self, model: dict) -> int | None:
        """The id of the byte 255, which no text holds, if no merge takes it: words that it stands between are
        encoded as if each were alone."""
        letter = chr(self.letters[255])
        changed = any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        return None if changed or any(letter in x for m in model["merges"] for x in m) else model["vocab"].get(letter)

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Pieces that are one word of the pattern go to the library's model, WORDS_AT_ONCE together with
        the byte 255 behind each; others go to the whole library."""
        chars, offsets = as_array(pieces)
        words = one_words(chars, offsets) if self.end is not None else np.zeros(0, np.int64)
        rest = np.ones(len(pieces), bool)
        rest[words] = False
        rest = np.flatnonzero(rest).tolist()
        found = [b""] * len(pieces)
        for i, ids in zip(rest, self.encode_whole([pieces[i] for i in rest]), strict=True):
            found[i] = ids
        sizes = np.diff(offsets)[words]
        ends = np.cumsum(sizes + 1)
        laid = np.full(ends[-1] if len(words) else 0, 255, np.uint8)
        inner = np.ones(len(laid), bool)
        inner[ends - 1] = False
        laid[inner] = gathered(chars, offsets[words], sizes)
        mapped = self.letters[laid].tobytes().decode("utf-16-le")
        cuts = [0, *ends[self.WORDS_AT_ONCE - 1 : -1 : self.WORDS_AT_ONCE].tolist(), len(laid)]
        encode = self.model.encode_batch_fast
        asked = (encode([mapped[a:b]], add_special_tokens=False)[0].ids for a, b in pairwise(cuts))
        ids = np.fromiter(chain.from_iterable(asked), "<u4")
        stops = (4 * np.flatnonzero(ids == self.end)).tolist() if len(words) else []
        packed, begin = ids.tobytes(), 0
        for i, stop in zip(words.tolist(), stops, strict=True):
            found[i] = packed[begin:stop]
            begin = stop + 4
        return found


def library_encoder(path: str) -> LibraryEncoder:
    """Loaded once in every Python worker, which remembers pieces from one task to the next."""
    return kept(("library", path), lambda: LibraryEncoder(path), lasting=True)


def tokenizer(path: str) -> ByteLevelBpe:
    """Loaded once in every Python worker."""
    return kept(("bpe", path), lambda: ByteLevelBpe(path))


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", pieces: int = 300_000
) -> DataFrame:
    """Token ids of every text: (id_col, ids), ids being packed little-endian 32-bit integers.

    The ids are those of the vocabulary's own library without added special tokens; a
    special string inside a text becomes its special id. A null text counts as empty and
    has no ids, repeated rows are encoded one by one, a null id stays null, and an empty
    table gives an empty result. ``pieces`` bounds what a worker remembers (about 0.1 kB
    each, twice as many at most); with fewer it takes longer and gives the same ids.
    """
    src = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        bpe.PIECES, bpe.word.size, bpe.long.size = pieces, pieces // 10, pieces // 20
        for batch in in_slices(batches):
            ids = pa.array(list(bpe.encode_all(batch.column(1).to_pylist())), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, ids, text): the text of packed ids, as ``encode`` gives them.

    Bytes that are not UTF-8 (ids cut inside a character) decode to the replacement
    character. Null or no ids give an empty text; an id that the vocabulary lacks is an error.
    """
    src = encoded.select(F.col(id_col), F.coalesce(F.col("ids"), F.lit(b"")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = kept(("decoder", path), lambda: Decoder(path))
        for batch in in_slices(batches):
            text = pa.array([decoder.decode(x) for x in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], names=[id_col, "ids", "text"])

    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, ids binary, text string")
