from __future__ import annotations

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from tables import documents, mixed_texts

from trovelake.llm import bpe_trie, token_records

LETTERS = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "中", "😀", "1", "23", "'s", "'ll", "the",
           "<|endoftext|>", "<|endof", "\x1c", "\x85", "\xa0", "\u2028", "\u200b", "\u0301", "ǅ",
           "Ⅷ", "²", "!", "...", "_", "\u3000", "\r\n", "\ufeff", "i\u0307", "\u180e"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_trie.vocabulary_path())


def strange_texts(n=1500):
    rng = random.Random(1)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return texts + ["", " ", "  ", "\n", "a" * 3000, " " * 500 + "x", "<|endoftext|>" * 3]


@pytest.mark.parametrize("make", [bpe_trie.Encoder, token_records.LibraryEncoder])
def test_encoders_equal_the_library(library, make):
    own = make(bpe_trie.vocabulary_path())
    texts = strange_texts()
    for text, packed in zip(texts, own.encoded(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text)


def test_known_words_are_bounded_without_effect(library, monkeypatch):
    monkeypatch.setattr(bpe_trie, "KNOWN_WORDS", 5)
    monkeypatch.setattr(bpe_trie, "KNOWN_CHUNKS", 4)
    monkeypatch.setattr(bpe_trie, "KNOWN_PAIRS", 5)
    own = bpe_trie.Encoder(bpe_trie.vocabulary_path())
    for text in ["the cat sat on the mat", "dogs and cats\nand other animals", "the cat", "the mat"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encoded([text])[0], "<u4").tolist() == ids
    assert len(own.chunks.new) <= 8 and len(own.words.new) <= 12


def test_digests_equal_the_library(spark, library):
    texts = mixed_texts()
    path = bpe_trie.vocabulary_path()
    rows = bpe_trie.digested(bpe_trie.encoded(documents(spark, texts), path), path).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        back = library.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_empty_table(spark, tmp_path):
    path = bpe_trie.vocabulary_path()
    none = documents(spark, [])
    assert bpe_trie.digested(bpe_trie.encoded(none, path), path).collect() == []


def test_records_round_trip(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_records, "CHUNK_BYTES", 2000)
    texts = mixed_texts()
    ids = [None if i == 4 else 1000 - i if i % 3 else -i for i in range(len(texts))]
    ids[7] = ids[8]  # a repeated doc_id
    folder = str(tmp_path / "tokens")
    token_records.written(documents(spark, texts, ids), folder, bpe_trie.vocabulary_path())
    got = sorted(token_records.read_back(spark, folder).collect(), key=lambda r: r.start)
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    start = 0
    for row, (doc_id, text) in zip(got, order, strict=True):
        own = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(own))
        assert row.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)
    drawn = token_records.shuffled(spark, folder, 1).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, len(r.ids)) for r in drawn) == sorted(
        (r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in got)
    assert [r.doc_id for r in drawn] != [r.doc_id for r in got]


def test_frames_are_checked():
    good = token_records.frame(b"abc") + token_records.frame(b"") + b"\n"
    assert [p for _, p in token_records.frames(good)] == [b"abc", b""]
    for at in range(len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises((ValueError, struct.error, OverflowError)):
            list(token_records.frames(bytes(bad)))
    with pytest.raises(ValueError):
        list(token_records.frames(good[:-1]))


def test_payload_widths():
    for ids in ([], [1, 65535], [65536, 5]):
        packed = np.array(ids, "<u4").tobytes()
        doc_id, back = token_records.ids_of(token_records.payload_of(-5, packed))
        assert doc_id == -5 and back.tolist() == ids


def test_records_of_empty_table(spark, tmp_path):
    folder = str(tmp_path / "none")
    token_records.written(documents(spark, []), folder, bpe_trie.vocabulary_path())
    assert token_records.read_back(spark, folder).collect() == []


def packed_by(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_letters_and_a_stop_need_no_pattern(library):
    own = bpe_trie.Encoder(bpe_trie.vocabulary_path())
    asked, pattern = [], own.splitter.words

    class Counted:
        def findall(self, text):
            asked.append(text)
            return pattern.findall(text)

    own.splitter.words = Counted()
    text = "A word again. And again, a word; it's two 2s"
    assert own.encoded([text, text]) == [packed_by(library, text)] * 2
    assert sorted(asked) == [" 2s", " it's", "A"]


@pytest.mark.parametrize("make", [bpe_trie.Encoder, token_records.LibraryEncoder])
def test_texts_in_any_mixture_of_chunks(library, make):
    rng = random.Random(1)
    special = list(bpe_trie.Encoder(bpe_trie.vocabulary_path()).special)
    parts = ["", " ", "  ", "a", "the", "end.", "so,", "é", "it's", "\n", "\t", "x.y", ".", "?!", "42",
             "日本", " ", *special]
    texts = [rng.choice(["", " "]).join(rng.choices(parts, k=rng.randrange(9))) for _ in range(300)]
    own = make(bpe_trie.vocabulary_path())
    assert own.encoded(texts) == [packed_by(library, t) for t in texts]
    assert own.encoded([]) == []


def test_decoder_keeps_texts_apart(library, monkeypatch):
    monkeypatch.setattr(bpe_trie, "RUN_IDS", 3)
    texts = ["", "a b c d e f g", "日本 and é", "", "x"]
    cut = [packed_by(library, t)[4:] for t in texts]  # may start inside a letter
    found = list(bpe_trie.Decoder(bpe_trie.vocabulary_path()).decoded(cut))
    assert found == [library.decode(
        np.frombuffer(c, dtype="<u4").tolist(), skip_special_tokens=False) for c in cut]
    assert list(bpe_trie.Decoder(bpe_trie.vocabulary_path()).decoded([])) == []
