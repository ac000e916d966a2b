"""Byte-level BPE encoding by prefix-sharing tries, and decoding.

The encoding of a byte string is determined by one token per prefix: the last
token of the prefix's own encoding. The last token of a prefix is the one
vocabulary entry that ends it and that may follow, as a valid pair, the last
token of what is left before it. So the distinct words of a batch are put into a
trie, kept as their sorted list, and a depth-first walk computes the last token
of every node once, however many words share the prefix. The encoding of a word
is read off by stepping back from its node, a token at a time.

Documents never leave their partition: every task splits its texts, encodes the
words that its worker has not met lately, and joins the ids of the words. The
memory of known words has a fixed size; forgetting only costs time. Chunks between
spaces are numbered per run of texts, so that only distinct ones are looked up, and
the ids of the texts are laid out in one step.

* A null text is taken as the empty text: no ids, empty decoded text.
* Words of any length are encoded whole.
* Repeated rows are encoded each; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Collection, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from trovelake.llm.common import query, rows_out, table, worker_cache

KNOWN_CHUNKS = 120_000  # chunks between spaces that a worker remembers, twice
KNOWN_WORDS = 150_000   # words that it remembers, twice
KNOWN_PAIRS = 200_000   # token pairs a worker remembers

# The split pattern of byte-level BPE, tried in this order.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
STOPS = frozenset(".,;:!?")  # one of these at the end of a word is a word
RUN_IDS = 500_000            # ids that are decoded at once, about


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file -> the byte.

    Printable bytes stand for themselves, the others are numbered from 256.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Splitter:
    """Texts -> words, as byte-level BPE splits them."""

    def __init__(self, special: dict[str, int]):
        import regex

        self.special = special
        self.words = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(
            regex.escape(t) for t in sorted(special, key=len, reverse=True)) or r"(?!)")
        # whether letters after a space and a stop can hold no special token
        self.plain = all(any(not (c.isalpha() or c == " " or c in STOPS) for c in t)
                         for t in special)

    def pieces(self, text: str) -> list[str]:
        """The words of a text; special tokens are words of their own."""
        if self.plain and text.isascii() and text[:1] == " ":  # most need no pattern
            if text[1:].isalpha():
                return [text]
            if text[-1] in STOPS and text[1:-1].isalpha():
                return [text[:-1], text[-1]]
        if not self.special:
            return self.words.findall(text)
        out, at = [], 0
        for match in self.specials.finditer(text):
            out += self.words.findall(text[at:match.start()])
            out.append(match.group())
            at = match.end()
        return out + (self.words.findall(text[at:]) if at else self.words.findall(text))


class Remembered:
    """A map of bounded size that forgets what was not asked for lately.

    There are two generations; a full one becomes the old one, and what is asked
    for again comes back from there. ``new`` holds all keys asked for last.
    """

    def __init__(self, limit: int):
        self.new: dict = {}
        self.old: dict = {}
        self.limit = limit

    def lacking(self, keys: Collection) -> list:
        """The keys that are not known; the others are in ``new`` afterwards."""
        if len(self.new) + len(keys) > self.limit:
            self.old, self.new = self.new, {}
        out, new, old = [], self.new, self.old
        for key in keys:
            if key not in new:
                if key in old:
                    new[key] = old[key]
                else:
                    out.append(key)
        return out


def raw_of(letters: dict[str, int], token: str) -> bytes:
    return bytes([letters[c] for c in token])


def tokens_of(content: dict) -> tuple[dict[bytes, int], dict[str, int], list[bytes]]:
    """Ids of tokens, ids of special tokens, and the bytes of each id."""
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    vocabulary = content["model"]["vocab"]
    ids = {raw_of(letters, t): i for t, i in vocabulary.items() if t not in special}
    token_bytes = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
    for token, number in ids.items():
        token_bytes[number] = token
    for token, number in special.items():
        token_bytes[number] = token.encode()
    return ids, special, token_bytes


class Vocabulary:
    """Tokens as bytes, merge ranks and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        self.ids, self.special, self.token_bytes = tokens_of(content)
        self.token_lengths = [len(t) for t in self.token_bytes]
        # lengths of the tokens that end in the same (up to) three bytes, longest first
        lengths: dict[bytes, set[int]] = {}
        for token in self.ids:
            lengths.setdefault(token[-3:], {1, 2}).add(len(token))
        self.endings = {end: tuple(sorted(n, reverse=True)) for end, n in lengths.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(content["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            left, right = raw_of(letters, left), raw_of(letters, right)
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.pairs: dict[int, bool] = {}

    def merged(self, content: bytes) -> list[int]:
        """Encoding of a short byte string by its merges, lowest rank first."""
        parts = [self.ids[content[i:i + 1]] for i in range(len(content))]
        while len(parts) > 1:
            ranked = [(self.merges[pair][0], i) for i, pair in enumerate(zip(parts, parts[1:]))
                      if pair in self.merges]
            if not ranked:
                break
            at = min(ranked)[1]
            parts[at:at + 2] = [self.merges[parts[at], parts[at + 1]][1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are an encoding."""
        return self.merged(self.token_bytes[left] + self.token_bytes[right]) == [left, right]

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Encode distinct words by one depth-first walk over their trie.

        The trie is held as the sorted list of its words: a word shares its
        path with the word before it up to the first byte that differs, and
        walking the list visits the nodes in depth-first order. ``states[i]`` is
        the last token of the encoding of the path's first i bytes; the states
        of the shared part are kept, so every node is worked out once.
        """
        found: dict[bytes, list[int]] = {}
        states, before = [-1], b""
        token_of, lengths_of, pairs = self.ids.get, self.endings.get, self.pairs
        for word in sorted(words):
            shared, limit = 0, min(len(before), len(word))
            while shared < limit and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                for length in lengths_of(word[end - 3:end] if end > 3 else word[:end], (2, 1)):
                    if length > end:
                        continue
                    token = token_of(word[end - length:end])
                    if token is None:
                        continue
                    if length == end:
                        break
                    pair = states[end - length] << 32 | token
                    known = pairs.get(pair)
                    if known is None:
                        if len(pairs) >= KNOWN_PAIRS:
                            pairs.clear()
                        known = pairs[pair] = self.may_follow(states[end - length], token)
                    if known:
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                states.append(token)
            found[word] = self.read_back(states, len(word))
            before = word
        return found

    def read_back(self, states: list[int], end: int) -> list[int]:
        ids = []
        while end:
            token = states[end]
            ids.append(token)
            end -= self.token_lengths[token]
        return ids[::-1]


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Texts -> packed ids, with a bounded memory of chunks and words.

    A chunk runs from one space to the next. Between two characters that are no
    white space, a space always starts a new word, so chunks are encoded alone.
    A text with a chunk that is empty, or starts or ends with white space, is
    split by the pattern as a whole.
    """

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.start(self.vocabulary.special)

    def start(self, special: dict[str, int]) -> None:
        self.splitter = Splitter(special)
        self.special = {t: i.to_bytes(4, "little") for t, i in special.items()}
        self.chunks, self.words = Remembered(KNOWN_CHUNKS), Remembered(KNOWN_WORDS)

    def encoded_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, packed."""
        content = [w.encode() for w in words]
        found = self.vocabulary.encode_words(content)
        return [packed_ids(found[w]) for w in content]

    def pieces_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are split by the pattern as a whole."""
        out: list[bytes] = []
        for at in range(0, len(texts), 20_000):
            split = [self.splitter.pieces(t) for t in texts[at:at + 20_000]]
            lacking = self.words.lacking({p for own in split for p in own} - self.special.keys())
            known = self.words.new
            known.update(zip(lacking, self.encoded_words(lacking)))
            known.update(self.special)
            out += [known[own[0]] if len(own) == 1 else b"".join(map(known.__getitem__, own))
                    for own in split]
        return out

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        edges = split.offsets.to_numpy()
        numbered = split.flatten().dictionary_encode()
        chunks, numbers = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        new = self.chunks.lacking(chunks)
        plain = [c for c in new if c and not c[0].isspace() and not c[-1].isspace()]
        known = self.chunks.new
        known.update(dict.fromkeys(new))
        known.update(zip(plain, self.pieces_packed([" " + c for c in plain])))
        # the first chunk of a text has no space before it
        firsts, first = np.unique(numbers[edges[:-1]], return_inverse=True)
        starts = [chunks[n] for n in firsts]
        places = numbers.astype(np.int64)
        places[edges[:-1]] = len(chunks) + first
        laid = pa.array([*map(known.__getitem__, chunks), *self.pieces_packed(starts)],
                        pa.large_binary()).take(pa.array(places))
        ends = np.frombuffer(laid.buffers()[1], dtype=np.int64)[edges].tolist()
        content = memoryview(laid.buffers()[2] or b"")
        out = [bytes(content[a:b]) for a, b in zip(ends, ends[1:])]
        # texts with a chunk that cannot stand alone
        open_ = np.array([not c or c[-1].isspace() for c in starts], dtype=bool)
        lacks = np.zeros(len(places) + 1, dtype=np.int64)
        np.cumsum(laid.is_null().to_numpy(zero_copy_only=False), out=lacks[1:])
        apart = (np.diff(lacks[edges]) > 0) | (open_[first] & (np.diff(edges) > 1))
        whole = np.flatnonzero(apart).tolist()
        for i, packed in zip(whole, self.pieces_packed([texts[i] for i in whole])):
            out[i] = packed
        return out


class Decoder:
    """Packed ids -> texts; it holds the bytes of the tokens and nothing else."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.tokens = pa.array(tokens_of(json.load(file))[2], pa.large_binary())

    def decoded(self, packed: list[bytes]) -> Iterator[str]:
        sizes = np.array([len(p) // 4 for p in packed], dtype=np.int64)
        run = (np.cumsum(sizes) - sizes) // RUN_IDS
        edges = np.flatnonzero(np.diff(run, prepend=-1, append=-1)).tolist()
        for start, end in zip(edges, edges[1:]):
            ids = np.frombuffer(b"".join(packed[start:end]), dtype="<u4")
            laid = self.tokens.take(pa.array(ids))
            ends = np.concatenate([[0], np.cumsum(sizes[start:end])])
            ends = np.frombuffer(laid.buffers()[1], dtype=np.int64)[ends].tolist()
            content = memoryview(laid.buffers()[2] or b"")
            for a, b in zip(ends, ends[1:]):
                yield str(content[a:b], "utf-8", errors="replace")


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    cache = worker_cache("encoders")
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def decoder(path: str) -> Decoder:
    """The worker's decoder, beside the encoder: a worker serves one or the other."""
    cache = worker_cache("encoders")
    if (path, "decoder") not in cache:
        cache[path, "decoder"] = Decoder(path)
    return cache[path, "decoder"]


def slices(batch: pa.RecordBatch, limit: int = 2_000_000) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts) of runs of rows of about ``limit`` bytes, or of one row."""
    texts = batch["text"]
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes) - sizes) // limit
    edges = np.flatnonzero(np.diff(run, prepend=-1, append=-1))
    for start, end in zip(edges, edges[1:]):
        yield (batch["doc_id"].slice(start, end - start).to_pylist(),
               [t or "" for t in texts.slice(start, end - start).to_pylist()])


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, packed as little-endian
    unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for keys, texts in slices(batch):
                yield rows_out(IDS, {"doc_id": keys, "ids": own.encoded(texts)})

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def digested(ids: DataFrame, path: str) -> DataFrame:
    """Decode ids; (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in batches:
            packed = batch["ids"].to_pylist()
            yield rows_out(DIGESTS, {
                "doc_id": batch["doc_id"].to_pylist(),
                "n_tokens": [len(p) // 4 for p in packed],
                "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                "decoded_sha256": [hashlib.sha256(text.encode()).hexdigest()
                                   for text in own.decoded(packed)],
            })

    return ids.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op6_bpe_trie")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path()
    return digested(encoded(table(spark, sf_dir, "documents"), path), path)
