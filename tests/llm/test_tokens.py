"""Encoding, decoding, counting and id files against the tokenizers library."""

import hashlib
import json
import os
import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from edges import LONG, TEXTS, documents, table
from tokenizers import Tokenizer

from tidemark.llm import bpe, counts, queries, repair, worker

LIBRARY = Tokenizer.from_file(queries.BYTE_BPE)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def strings():
    rng = random.Random(7)
    parts = ["a", "th", "e", " ", "\n", "1", ".", "é", "'s", "!", "aa", "  ", "\t", "中", "\xa0", "The", "<|endoftext|>", "\r\n", "́"]
    found = ["", " ", "\n\n", "a" * 300, "!" * 300, "it's 'S <|endoftext|> x"]
    return found + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(3000)]


def test_words_as_the_library():
    mine, decoder = bpe.tokenizer(queries.BYTE_BPE), bpe.Decoder(queries.BYTE_BPE)
    for text in strings():
        ids = mine.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), text
        assert decoder.decode(ids) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


def test_word_by_word_as_the_library(monkeypatch):
    encoder = bpe.LibraryEncoder(queries.BYTE_BPE)
    monkeypatch.setattr(bpe.Encoder, "CHARS_AT_ONCE", 500)
    monkeypatch.setattr(bpe.Encoder, "PIECES", 50)
    for text, ids in zip(strings(), encoder.encode_all(strings()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), text


def test_a_full_memo_forgets():
    memo = bpe.Memo(len, 2)
    assert [memo[w] for w in ("a", "bb", "ccc", "a", "dddd", "x" * 100)] == [1, 2, 3, 1, 4, 100]
    assert len(memo) <= 2 and set(memo.older) == {"ccc", "a"} and set(memo) == {"dddd"}


def test_cut_characters_decode_to_replacements():
    decoder = bpe.Decoder(queries.BYTE_BPE)
    cut = np.array(library_ids("中")[:1], "<u4").tobytes()
    assert decoder.decode(cut) == LIBRARY.decode(library_ids("中")[:1], skip_special_tokens=False)


def test_edges_round_trip(spark):
    rows = bpe.decode(bpe.encode(documents(spark), queries.BYTE_BPE), queries.BYTE_BPE).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == sorted((str(i), t or "") for i, t in TEXTS)
    assert {tuple(np.frombuffer(r.ids, "<u4")[:9]) for r in rows if r.doc_id == 6} == {tuple(library_ids(LONG)[:9])}
    assert bpe.encode(documents(spark, []), queries.BYTE_BPE).count() == 0


def test_bpe_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    for r in queries.op2_bpe(spark, "/root/testdata/sf0.001").collect():
        ids = library_ids(texts[r.doc_id])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_sorted_words_begin_behind_a_shared_prefix():
    mine = bpe.tokenizer(queries.BYTE_BPE)
    words = sorted(w.encode() for t in strings()[:400] for w in mine.words.findall(t))
    words += [b"ab", b"", b"abc", b"abc", b"abcd", b"ab"]  # any order gives the same ids
    for word, ids in zip(words, mine.encode_words(words), strict=True):
        assert ids == next(mine.encode_words([word]))


def test_new_words_are_encoded_together():
    mine = bpe.ByteLevelBpe(queries.BYTE_BPE)
    words = sorted({w.encode() for t in strings() for w in mine.words.findall(t) if len(w.encode()) <= bpe.LONGEST_MEMO_WORD})
    rng = random.Random(3)
    words += ["".join(rng.choice("aetnhs éж") for _ in range(rng.randint(0, 30))).encode() for _ in range(3000)]
    rng.shuffle(words)
    steps = [0]
    together = bpe.Table.get
    bpe.Table.get = lambda self, keys: steps.append(steps[0]) or together(self, keys)
    try:
        found = mine.encode_together(words)
    finally:
        bpe.Table.get = together
    assert found == [bpe.packed(ids) for ids in mine.encode_words(words)]
    assert len(steps) < 10 * bpe.LONGEST_MEMO_WORD  # steps for the prefixes of a length, not for each word


def test_few_places_for_pairs(monkeypatch):
    monkeypatch.setattr(bpe, "PAIR_SLOTS", 8)
    mine = bpe.ByteLevelBpe(queries.BYTE_BPE)
    words = sorted({w.encode() for t in strings()[:500] for w in mine.words.findall(t) if len(w) <= 20})
    assert mine.encode_together(words) == [bpe.packed(ids) for ids in mine.encode_words(words)]


def test_a_table_of_many_keys():
    rng = random.Random(5)
    known = {rng.randrange(1 << 40): rng.randrange(1 << 30) for _ in range(5000)} | {k: k for k in range(3000)}
    asked = [*known, *(rng.randrange(1 << 40) for _ in range(3000)), *range(2990, 3010)]
    assert bpe.Table(known).get(np.array(asked, np.int64)).tolist() == [known.get(k, -1) for k in asked]
    assert bpe.Table({}).get(np.array([3], np.int64)).tolist() == [-1]


def test_texts_of_a_group(monkeypatch):
    texts = ["", "a", "a ", " a", "\na", "a\n", "\n", " ", "a b\nc d", "a\n\nb", "a\r\nb", "x" * 90 + " " + "y" * 90 + "\n" + "z" * 90]
    texts += ["\x1c a", "a\x1cb \x1fc", "\x85a b", "b \u3000", "<|endoftext|>", "a <|endoftext|>\nb", "it's\n's 's", "a\u2028b c\u2028"]
    for encoder in (bpe.ByteLevelBpe(queries.BYTE_BPE), bpe.LibraryEncoder(queries.BYTE_BPE)):
        for again in range(2):
            for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), (text, again)
            assert list(encoder.encode_all([])) == []


def mixed_pieces():
    """Letters, digits, marks and apostrophes beside one another, and keys of every length."""
    rng = random.Random(11)
    parts = [*"ab1', .&-éßж中²_", "'s", "'ll", "\t", "\x00", "Ünd", "12", "...", "\n", "x" * 15, "y" * 16, "z" * 80, "\u2014"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(3000)] + ["a", "a\x00", "", "a\x00\x00"]


def test_a_known_piece_is_not_encoded_again(monkeypatch):
    for encoder in (bpe.ByteLevelBpe(queries.BYTE_BPE), bpe.LibraryEncoder(queries.BYTE_BPE)):
        asked, plain = [], encoder.encode_pieces
        monkeypatch.setattr(encoder, "encode_pieces", lambda ps, asked=asked, plain=plain: asked.extend(ps) or plain(ps))
        texts = mixed_pieces()
        for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), text
        # a mark behind a word is a piece of its own, so that the word is known without it
        first = len(asked)
        assert first == len(set(asked)) and list(encoder.encode_all([" und&&& und, und.", " und"]))
        assert set(asked[first:]) <= {" und", "&&&", ",", "."}
        first = len(asked)
        list(encoder.encode_all([" und. und&&&", ", und"]))
        assert asked[first:] == []


def test_known_pieces_are_forgotten_in_turn(monkeypatch):
    monkeypatch.setattr(bpe.Encoder, "CHARS_AT_ONCE", 300)
    for encoder in (bpe.ByteLevelBpe(queries.BYTE_BPE), bpe.LibraryEncoder(queries.BYTE_BPE)):
        encoder.PIECES, encoder.long.size = 40, 3
        for text, ids in zip(mixed_pieces(), encoder.encode_all(mixed_pieces()), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), text
            assert encoder.known.count <= 40 + 600 and len(encoder.long) <= 3


def test_letters_that_are_words_for_the_library():
    encoder = bpe.LibraryEncoder(queries.BYTE_BPE)
    texts = [f"a{chr(c)}" for c in range(33, 0x600)] + [f" {chr(c)}b" for c in range(33, 0x600)]
    for text, ids in zip(texts, encoder.encode_pieces(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), text


class Counted:
    """A tokenizer, or a part of one, that notes the calls of its methods."""

    def __init__(self, inner, calls):
        self._inner, self._calls = inner, calls

    def __getattr__(self, name):
        found = getattr(self._inner, name)
        if not callable(found):
            return Counted(found, self._calls) if name == "model" else found
        return lambda *args, **more: self._calls.append(name) or found(*args, **more)


def test_new_words_go_to_the_library_together():
    encoder, calls = bpe.LibraryEncoder(queries.BYTE_BPE), []
    for name, thing in list(vars(encoder).items()):
        if isinstance(thing, Tokenizer):
            setattr(encoder, name, Counted(thing, calls))
    rng = random.Random(17)
    texts = [" ".join("".join(rng.choice("aetnhséж") for _ in range(rng.randint(1, 30))) for _ in range(100)) for _ in range(50)]
    texts += ["\xff \xffÿ a\xff", "Ã¿ Ä", "ÿ"]  # what the byte 255 is written as, in texts
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), text
    assert 0 < len(calls) < 300  # a call was made for each of some 5,000 words


def test_a_worker_keeps_the_library_between_tasks(spark):
    library, path = bpe.library_encoder, queries.BYTE_BPE

    def run(batches):
        marks = vars(library(path)).setdefault("marks", [uuid.uuid4().hex])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x] * batch.num_rows) for x in (os.getpid(), marks[0])], names=["worker", "mark"])

    found = spark.range(0, 40, 1, 40).mapInArrow(run, "worker long, mark string").distinct().collect()
    assert len(found) == len({r.worker for r in found})  # each of the 40 tasks loaded it


def test_another_thing_drops_what_lasts():
    made = []
    ask = lambda key, **more: worker.kept(key, lambda: made.append(key) or len(made), **more)
    assert [ask("a", lasting=True), ask("a", lasting=True), ask("b"), ask("b"), ask("a", lasting=True), ask("b")] == [1, 1, 2, 2, 3, 4]
    worker.lasting_things().clear()
    worker._kept.clear()


def test_words_that_are_surely_one():
    plain = regex.compile(r" ?(?:[\p{L}&&[\u0000-\u04ff]]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)", regex.V1)
    pieces = ["", " ", "  ", " a", "a ", "a a", "aé", "éa", " é", "é1", "1 ", " 12", "'", "a'", "''", "\n", "...", ". ", "a\x00", "ԁ", "中"]
    pieces += [x for c in range(0x20, 0x600) for x in (chr(c), f" {chr(c)}a", f"1{chr(c)}")] + mixed_pieces()
    found = bpe.one_words(*bpe.as_array(pieces)).tolist()
    assert found == [i for i, p in enumerate(pieces) if plain.fullmatch(p)]
    assert bpe.one_words(*bpe.as_array([])).tolist() == bpe.one_words(*bpe.as_array([""])).tolist() == []


@pytest.mark.parametrize("change", ["merge", "ignore_merges"])
def test_a_vocabulary_that_words_cannot_share_a_call_of(change, tmp_path):
    with open(queries.BYTE_BPE, encoding="utf-8") as file:
        spec = json.load(file)
    if change == "merge":
        spec["model"]["merges"].insert(0, ["a", "\xff"])
        spec["model"]["vocab"]["a\xff"] = 60_000
    else:
        spec["model"]["ignore_merges"] = True
    path = tmp_path / "changed.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    encoder, library = bpe.LibraryEncoder(str(path)), Tokenizer.from_file(str(path))
    assert encoder.end is None
    for text, ids in zip(mixed_pieces(), encoder.encode_all(mixed_pieces()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_what_an_encoder_remembers_is_small():
    encoder = bpe.ByteLevelBpe(queries.BYTE_BPE)
    texts = [" ".join(f"w{'abcdefghij'[i % 10]}{i}x" for i in range(at, at + 5_000)) for at in range(0, 100_000, 5_000)]
    assert len(list(encoder.encode_all(texts))) == 20
    known = encoder.known
    held = [known.slots, known.low, known.high, known.starts, known.sizes, known.ids]
    # three pieces of a word; a dict of strings took some 400 bytes for each
    assert known.count > 100_000 and sum(x.nbytes for x in held) < 150 * known.count


def test_counts_and_cache(spark, tmp_path):
    cache, library = str(tmp_path / "cache"), Tokenizer.from_file(queries.WORD_BPE)
    expected = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    for _ in range(2):  # the second time everything is in the cache
        rows = counts.token_counts(documents(spark), queries.WORD_BPE, cache, 5).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == expected
        assert all(r.over_limit == (r.n_tokens > 5) for r in rows)
        assert spark.read.parquet(cache).count() == 6  # one for each distinct normalised content
    assert counts.token_counts(documents(spark, []), queries.WORD_BPE, cache, 5).count() == 0


def test_counted_words_as_the_library():
    library = Tokenizer.from_file(queries.WORD_BPE)
    count = counts.counter(queries.WORD_BPE)
    for text in strings() + ["<|startoftext|>A<|endoftext|>", "İ ΑΣ ẞ", "a\x85b　c"]:
        words = [w for w in " ".join(text.replace("\t", " ").replace("\r", " ").split("\n")).split(" ") if w]
        assert sum(count[w] for w in words) == len(library.encode(text, add_special_tokens=False).ids), text


def test_id_files(spark, tmp_path):
    folder = str(tmp_path / "ids")
    repair.write(documents(spark), folder, queries.BYTE_BPE, 2)
    rows = sorted(repair.read_back(spark, folder).collect(), key=lambda r: r.start)
    ordered = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc, text) in zip(rows, ordered, strict=True):
        ids = np.array([*library_ids(text), 2], "<u4")
        assert (row.doc, row.start, row.n_tokens, row.ids_crc32) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    empty = str(tmp_path / "none")
    repair.write(documents(spark, []), empty, queries.BYTE_BPE, 2)
    assert repair.read_back(spark, empty).count() == 0


@pytest.mark.parametrize("kind", ["runs", "random", "text"])
def test_grammar_and_random_access(kind):
    rng = np.random.default_rng(3)
    ids = {
        "runs": np.repeat(5, 3000),
        "random": rng.integers(0, 50_000, 3000),
        "text": np.array(library_ids("the cat sat on the mat. " * 300)),
    }[kind].astype("<u4")
    lengths = np.array([0, 1000, 0, len(ids) - 1000, 0])
    symbols, ends, left, right = repair.compress(ids, lengths)
    sizes = repair.rule_sizes(left, right)
    packed = {k: v.astype("<u4").tobytes() for k, v in (("left", left), ("right", right), ("size", sizes), ("symbols", symbols))}
    block = repair.Block({"docs": list(range(5)), "lengths": lengths.tolist(), "ends": ends.tolist()} | packed)
    assert block.all_ids().tobytes() == ids.tobytes()
    assert kind == "random" or len(symbols) < len(ids) / 4
    for place in (0, 1, 500, 999):
        assert block.id_at(1, place) == ids[place]
    for place in (0, 7, len(ids) - 1001):
        assert block.id_at(3, place) == ids[1000 + place]
    with pytest.raises(IndexError):
        block.id_at(0, 0)


def test_id_files_query(spark):
    start = 0
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    for r in sorted(queries.op7_token_files(spark, "/root/testdata/sf0.001").collect(), key=lambda r: r.doc_id):
        ids = np.array([*library_ids(texts[r.doc_id]), 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_a_worker_takes_a_batch_in_slices():
    from tidemark.llm.worker import in_slices

    batches = [pa.RecordBatch.from_pydict({"n": list(range(at, at + size))}) for at, size in ((0, 6_000), (6_000, 0), (6_000, 3))]
    parts = list(in_slices(batches))
    assert [p.num_rows for p in parts] == [2_500, 2_500, 1_000, 3]
    assert [n for p in parts for n in p.column(0).to_pylist()] == list(range(6_003))


def test_a_worker_lets_an_encoder_go():
    import weakref

    from tidemark.llm.worker import kept

    class Holder:
        def __init__(self):
            self.word = bpe.Memo(self.encode)

        def encode(self, word):
            return word

    held = weakref.ref(kept("held by itself", Holder))
    assert held() is not None
    kept("another", dict)
    assert held() is None
