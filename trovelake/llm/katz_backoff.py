"""Language-model scores by Katz backoff over words.

The probability of a word after another is, if the pair was seen in training, its
Good-Turing discounted count over the count of the context plus one; else the
context's backoff weight times the probability of the word alone, which recurses
in the same way to the class of unknown words. The weight of a context is what
its seen pairs leave, divided by what the words after them leave of the lower
order, so all words together have probability one. (The "plus one", an event
kept for the unseen, leaves every context some mass.) Only counts up to K are
discounted.

Words get ids by falling count, so that the count of an id is known from a short
table (there are at most sqrt(2N) different counts). The counts of words are a
table in parts. Texts travel packed to batches of bounded size, where words
become ids; pairs travel as packed ids to buckets by context, where they are
counted, and where the same pairs are scored for all documents. What needs the
discounts of the whole corpus comes back as a few sums per document and bucket.

A frequent context (share of 1/HOT or more of all tokens) is split over buckets
by its next word; pairs of two frequent words are counted by batch and never
travel one by one. There are at most HOT frequent words and HOT^2 such pairs.

* A null text is an empty one: a single end token, after the start.
* Without training texts every score is 0: all words are the unknown one.
* A row without a doc_id is a training text. Repeated rows count and are scored
  each. Extra columns are not read; texts are scored whole.
* Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from trovelake.llm.common import (
    WordHashes, as_bytes, held_out, query, rows_out, table, window_hashes, word_hashes, words_of,
)
from trovelake.plans.settle import settled

K = 5                       # counts up to this are discounted
HOT = 512
BATCH_BYTES = 8_000_000     # text of a batch, about
BUCKET_BYTES = 24_000_000   # text whose pairs share a bucket, about
SLICES = 4                  # parts of a bucket that are worked on in turn
TASK_WORDS = 400_000        # words that a task counts before it passes them on
END = b""                   # no word is empty; as a context it is the start
UNKNOWN = np.uint32(0xFFFFFFFF)


def hashed(words) -> np.ndarray:
    hashes: WordHashes = word_hashes()
    return np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64)


def spread(numbers: np.ndarray, parts: int) -> np.ndarray:
    """A part for each whole number."""
    return (window_hashes(numbers.astype(np.uint64), 1) % np.uint64(parts)).astype(np.int64)


def by_part(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, positions) of each part that occurs."""
    order = np.argsort(parts, kind="stable")
    starts = np.flatnonzero(np.diff(parts[order], prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(order)]):
        yield int(parts[order[start]]), order[start:end]


# --- words: counts and ids -------------------------------------------------

COUNTS = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
COUNTS_DDL = "part long, keys binary, counts binary"


def word_counts(texts: DataFrame, parts: int) -> DataFrame:
    """Counts of the words of training texts, in ``parts`` parts:
    (part, keys, counts, levels, sizes), keys ascending; levels are the
    different counts and sizes the number of words of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            keys = hashed(found)
            values = np.fromiter(found.values(), dtype=np.int64, count=len(found))
            rows = [(p, keys[at].tobytes(), values[at].tobytes())
                    for p, at in by_part((keys % np.uint64(parts)).astype(np.int64))]
            return rows_out(COUNTS, dict(zip(COUNTS.names, zip(*rows))))

        for batch in batches:
            for text, held in zip(as_bytes(batch["text"]), batch["held_out"].to_pylist()):
                if not held:
                    found.update(words_of(text))
                    found[END] += 1
                if len(found) > TASK_WORDS:
                    yield passed_on()
                    found.clear()
        if found:
            yield passed_on()

    def add(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(rows["keys"]), dtype=np.uint64)
        counts = np.frombuffer(b"".join(rows["counts"]), dtype=np.int64)
        own, at = np.unique(keys, return_inverse=True)
        total = np.zeros(len(own), dtype=np.int64)
        np.add.at(total, at, counts)
        levels, sizes = np.unique(total, return_counts=True)
        return pd.DataFrame({"part": [key[0]], "keys": [own.tobytes()],
                             "counts": [total.tobytes()], "levels": [levels], "sizes": [sizes]})

    counted = texts.select("text", "held_out").mapInArrow(count, COUNTS_DDL)
    return counted.groupBy("part").applyInPandas(
        add, COUNTS_DDL + ", levels array<long>, sizes array<long>")


def with_ids(counts: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Give the words ids by falling count.

    Returns (part, keys, ids) and, for the whole corpus, the different counts
    from high to low with the number of words of each.
    """
    levels = counts.select("part", F.explode(F.arrays_zip("levels", "sizes")).alias("x")).select(
        "part", F.col("x.levels").alias("level"), F.col("x.sizes").alias("size"))
    # at most sqrt(2N) rows
    whole = levels.groupBy("level").agg(F.sum("size").alias("size")).orderBy(
        F.desc("level")).toArrow()
    level, size = (np.array(whole[c].to_pylist(), dtype=np.int64) for c in ("level", "size"))
    assert size.sum() < int(UNKNOWN), "ids take four bytes"
    starts = dict(zip(level.tolist(), (np.cumsum(size) - size).tolist()))
    sent = counts.sparkSession.sparkContext.broadcast(starts)
    earlier = W.partitionBy("level").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = levels.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    offsets = before.groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("level", "before"))).alias("offsets"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, keys, counts_, own, before_ in zip(*(batch[c].to_pylist() for c in (
                    "part", "keys", "counts", "level", "before"))):
                values = np.frombuffer(counts_, dtype=np.int64)
                order = np.argsort(values, kind="stable")
                first = np.searchsorted(values[order], own)
                place = np.arange(len(order)) - first[np.searchsorted(own, values[order])]
                offset = np.array([sent.value[x] + b for x, b in zip(own, before_)], dtype=np.int64)
                ids = np.empty(len(order), dtype=np.uint32)
                ids[order] = offset[np.searchsorted(own, values[order])] + place
                rows.append((part, keys, ids.tobytes()))
            yield rows_out(COUNTS, dict(zip(COUNTS.names, zip(*rows))) if rows
                           else {n: [] for n in COUNTS.names})

    joined = counts.join(offsets, "part").select(
        "part", "keys", "counts", F.col("offsets.level").alias("level"),
        F.col("offsets.before").alias("before"))
    return joined.mapInArrow(number, COUNTS_DDL).withColumnRenamed("counts", "ids"), level, size


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's Good-Turing discounts of counts 0 to K (index 0 is not used), from
    the numbers of kinds seen 1 to K + 1 times.

    Where the counts of counts do not give a discount between 0 and 1, the
    absolute discount n1 / (n1 + 2 n2) of the count is taken.
    """
    out = np.ones(K + 1)
    n = [float(x) for x in n]
    absolute = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    common = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        turing = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 0.0
        found = (turing - common) / (1 - common) if common < 1 else 0.0
        out[r] = found if 0 < found < 1 else (r - absolute) / r
    return out


class Words:
    """What is known of all words: counts by id, and probabilities alone."""

    def __init__(self, level: np.ndarray, size: np.ndarray):
        self.level, self.last = level, np.cumsum(size)
        self.tokens = int((level * size).sum())
        self.kinds = int(size.sum())
        kinds = dict(zip(level.tolist(), size.tolist()))
        self.discount = discounts(np.array([kinds.get(r, 0) for r in range(1, K + 2)]))
        share = self.alone_of(level)
        # what the known words leave is the unknown word's; 1 without any
        self.unknown = 1.0 - float((share * size).sum())
        self.hot = min(HOT, int(size[level * HOT >= max(self.tokens, 1)].sum()))

    def alone_of(self, counts: np.ndarray) -> np.ndarray:
        low = self.discount[np.minimum(counts, K)]
        return np.where(counts > K, 1.0, low) * counts / (self.tokens + 1)

    def count(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.level):
            return np.zeros(len(ids), dtype=np.int64)
        at = np.searchsorted(self.last, ids.astype(np.int64), side="right")
        return np.where(ids == UNKNOWN, 0, self.level[np.minimum(at, len(self.level) - 1)])

    def alone(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids == UNKNOWN, self.unknown, self.alone_of(self.count(ids)))


# --- texts in batches ------------------------------------------------------

BLOCKS = pa.schema([("batch", pa.int64()), ("block", pa.binary())])


def packed_texts(texts: DataFrame, batches_: int) -> DataFrame:
    """(batch, block): documents dealt to batches, their words compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        held: dict[int, list] = {}
        size = 0

        def blocks() -> pa.RecordBatch:
            return rows_out(BLOCKS, {"batch": list(held), "block": [
                press.compress(pickle.dumps(rows)) for rows in held.values()]})

        for batch in batches:
            for doc_id, out, number, text in zip(
                    batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(),
                    batch["batch"].to_pylist(), as_bytes(batch["text"])):
                own = b" ".join(words_of(text))
                held.setdefault(number, []).append((out, doc_id, own))
                size += len(own)
                if size > 48_000_000:
                    yield blocks()
                    held, size = {}, 0
        if held:
            yield blocks()

    number = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(batches_))
    return texts.withColumn("batch", number).mapInArrow(pack, "batch long, block binary")


def unpacked(blocks) -> list[tuple[bool, int | None, bytes]]:
    """Documents of a batch, training texts first, in an order that a repeated
    task finds again."""
    import zstandard

    rows = [row for block in blocks
            for row in pickle.loads(zstandard.ZstdDecompressor().decompress(block))]
    return sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))


ENTRIES = "part long, batch long, blob binary"
PAIRS_PART = -1   # counts of pairs of frequent words
DOCS_PART = -2    # a batch's documents


def word_ids(blocks: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """(batch, keys, ids): the ids of the words of each batch."""

    def wanted(key, rows: pd.DataFrame) -> pd.DataFrame:
        words = {END}
        for _, _, text in unpacked(rows["block"]):
            words.update(text.split())
        keys = np.sort(hashed(words))
        out = [(p, key[0], keys[at].tobytes())
               for p, at in by_part((keys % np.uint64(parts)).astype(np.int64))]
        return pd.DataFrame(out, columns=["part", "batch", "keys"])

    def found(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(known["keys"]), dtype=np.uint64)
        numbers = np.frombuffer(b"".join(known["ids"]), dtype=np.uint32)
        out = []
        for batch, own in zip(asked["batch"], asked["keys"]):
            own_keys = np.frombuffer(own, dtype=np.uint64)
            at = np.minimum(np.searchsorted(keys, own_keys), max(len(keys) - 1, 0))
            there = keys[at] == own_keys if len(keys) else np.zeros(len(own_keys), dtype=bool)
            out.append((batch, own_keys[there].tobytes(), numbers[at[there]].tobytes()))
        return pd.DataFrame(out, columns=["batch", "keys", "ids"])

    asked = blocks.groupBy("batch").applyInPandas(wanted, "part long, batch long, keys binary")
    return asked.groupBy("part").cogroup(ids.groupBy("part")).applyInPandas(
        found, "batch long, keys binary, ids binary")


class Numbers(dict):
    """word -> id, by the word's hash; filled as words are asked for."""

    def __init__(self, keys: np.ndarray, numbers: np.ndarray):
        super().__init__()
        self.by_hash = dict(zip(keys.tolist(), numbers.tolist()))
        self.hashes = word_hashes()

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self.by_hash.get(self.hashes[word], int(UNKNOWN))
        return value


def tokens_of(texts: list[bytes], keys: np.ndarray,
              numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.uint32]:
    """Ids of the words of all texts, each text with its end; the texts' numbers of
    tokens; the id of the end.

    The words are many small objects, so they live in here only, and those of one
    text at a time.
    """
    number_of = Numbers(keys, numbers)
    end_id = number_of[END]
    parts, sizes = [], np.empty(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.split()
        own = np.empty(len(words) + 1, dtype=np.uint32)
        own[:-1] = np.fromiter(map(number_of.__getitem__, words), dtype=np.uint32, count=len(words))
        own[-1] = end_id
        parts.append(own)
        sizes[i] = len(own)
    return np.concatenate(parts), sizes, np.uint32(end_id)


def pairs_of_batches(blocks: DataFrame, ids: DataFrame, words: Words, buckets: int) -> DataFrame:
    """(part, batch, blob): pairs by bucket, counts of pairs of frequent words,
    and the documents with what can be scored at once."""
    sent = blocks.sparkSession.sparkContext.broadcast(words)

    def run(key, block_rows: pd.DataFrame, id_rows: pd.DataFrame) -> pd.DataFrame:
        known: Words = sent.value
        docs = unpacked(block_rows["block"])
        keys = np.frombuffer(b"".join(id_rows["keys"]), dtype=np.uint64)
        numbers = np.frombuffer(b"".join(id_rows["ids"]), dtype=np.uint32)
        tokens, sizes, end_id = tokens_of([text for _, _, text in docs], keys, numbers)
        ends = np.cumsum(sizes) - 1
        context = np.empty_like(tokens)
        context[1:] = tokens[:-1]
        context[ends - sizes + 1] = end_id  # the start
        doc = np.repeat(np.arange(len(docs), dtype=np.uint32), sizes)
        training = sum(not out for out, _, _ in docs)

        counts = known.count(tokens)
        base = np.log10((counts + 1) / (known.tokens + known.kinds + 1))
        alone = np.log10(known.alone(tokens))
        many = len(docs)
        new_context = context == UNKNOWN
        hot_context, hot_word = context < known.hot, tokens < known.hot
        hot_pair = hot_context & hot_word
        lost = hot_context & (tokens == UNKNOWN)  # never seen: only the weight is missing
        at_once = new_context | lost
        summary = {
            "doc_id": [d for _, d, _ in docs], "held_out": [bool(o) for o, _, _ in docs],
            "n_tokens": sizes, "n_known": np.bincount(doc, counts > 0, many).astype(np.int64),
            "base": np.bincount(doc, base, many),
            "score": np.bincount(doc[at_once], alone[at_once], many).astype(float),
            "lost": (doc[lost], context[lost].astype(np.uint16)),
            "hot": (doc[hot_pair], context[hot_pair] * np.uint32(HOT) + tokens[hot_pair]),
        }
        out = [(DOCS_PART - key[0], key[0], pickle.dumps(summary))]
        if hot_pair.any():
            trained = hot_pair & (doc < training)
            kinds, n = np.unique(context[trained] * np.uint32(HOT) + tokens[trained],
                                 return_counts=True)
            out.append((PAIRS_PART, key[0], pickle.dumps((kinds, n))))

        rest = np.flatnonzero(~(at_once | hot_pair))
        h, w, d = context[rest], tokens[rest], doc[rest]
        part = spread(np.where(h < known.hot, w, h), buckets)
        order = np.lexsort((d, w, h, part))
        h, w, d, part = h[order], w[order], d[order], part[order]
        narrow = np.uint16 if many < 1 << 16 else np.uint32
        for start, end in zip(*runs(part)):
            first, last = runs(h[start:end])
            own = w[start:end]
            wide = own >= 0xFFFF
            out.append((int(part[start]), key[0], pickle.dumps((
                training, h[start:end][first], (last - first).astype(np.uint32),
                np.where(wide, 0xFFFF, own).astype(np.uint16), own[wide],
                d[start:end].astype(narrow)))))
        return pd.DataFrame(out, columns=["part", "batch", "blob"])

    return blocks.groupBy("batch").cogroup(ids.groupBy("batch")).applyInPandas(run, ENTRIES)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, np.append(first[1:], len(values))


# --- buckets: count pairs, and score them ----------------------------------

COUNTED = "kind string, id long, numbers array<double>, blob binary"


def scored_pairs(known: Words, h: np.ndarray, w: np.ndarray, place: np.ndarray,
                 trained: np.ndarray):
    """Count the pairs (h, w) in training and score all of them.

    Returns how many kinds were seen 1 to K + 1 times; the sums of frequent
    contexts; and, by place, what is known of the scores: the place's sum, how
    many of its pairs have each small count, and the contexts whose weight its
    unseen pairs lack, with the contexts' sums.
    """
    pair = h.astype(np.uint64) << np.uint64(32) | w
    order = np.argsort(pair, kind="stable")
    pair, h, w, place, trained = (x[order] for x in (pair, h, w, place, trained))
    first, last = runs(pair)
    count = np.add.reduceat(trained.astype(np.int64), first)
    seen = count > 0

    # contexts: sums over the pairs seen after them
    ph, pw, pc = h[first][seen], w[first][seen], count[seen]
    starts, _ = runs(ph)
    contexts = ph[starts]
    sums = np.zeros((len(contexts), K + 2))  # kinds seen 1..K times, larger counts, share
    if len(contexts):
        for r in range(1, K + 1):
            sums[:, r - 1] = np.add.reduceat((pc == r).astype(float), starts)
        sums[:, K] = np.add.reduceat(np.where(pc > K, pc, 0).astype(float), starts)
        sums[:, K + 1] = np.add.reduceat(known.alone(pw), starts)
    hot = contexts < known.hot
    kinds = np.array([float((pc == r).sum()) for r in range(1, K + 2)])

    # entries: what is known of their scores
    each = np.repeat(count, last - first)
    was = each > 0
    value = np.where(was, np.log10(np.maximum(each, 1)) - np.log10(known.count(h) + 1.0),
                     np.log10(known.alone(w)))
    target, at = np.unique(place, return_inverse=True)
    few = np.zeros((len(target), K), dtype=np.uint32)
    small = was & (each <= K)
    np.add.at(few, (at[small], each[small] - 1), 1)
    # a context that training never went on from has all its weight left
    asked = np.unique(h[~was])
    there = np.minimum(np.searchsorted(contexts, asked), max(len(contexts) - 1, 0))
    own = np.zeros((len(asked), K + 2))
    if len(contexts):
        inside = contexts[there] == asked
        own[inside] = sums[there[inside]]
    hot_sums = [(int(c), list(x)) for c, x in zip(contexts[hot], sums[hot])]
    return kinds, hot_sums, (target, np.bincount(at, value, len(target)), few, asked, own,
                             place[~was], np.searchsorted(asked, h[~was]))


def pairs_of_slice(blobs, at: int) -> tuple[np.ndarray, ...]:
    """(h, w, place, trained) of the pairs whose context is in a slice, from the
    blobs of a bucket. The other slices are never unfolded beside it."""
    parts = []
    for row, blob in enumerate(blobs):
        training, own_h, n, short, wide, doc = pickle.loads(blob)
        chosen = own_h % SLICES == at
        inside = np.repeat(chosen, n)
        own = short.astype(np.uint32)
        own[short == 0xFFFF] = wide
        doc = doc[inside]
        parts.append((np.repeat(own_h[chosen], n[chosen]), own[inside],
                      np.int64(row) << 32 | doc.astype(np.int64), doc < training))
    return tuple(map(np.concatenate, zip(*parts)))


def counted_pairs(entries: DataFrame, words: Words) -> DataFrame:
    """Rows (kind, id, numbers, blob):

    * ``kinds``: numbers of pairs seen 1 to K + 1 times in a bucket
    * ``context``: a frequent context's part of its sums (id: the context)
    * ``pairs``: counts of pairs of frequent words
    * ``documents``: as they came (id: the batch)
    * ``scores``: what a bucket knows of the scores of documents
    """
    sent = entries.sparkSession.sparkContext.broadcast(words)

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        known: Words = sent.value
        names = ["kind", "id", "numbers", "blob"]
        if key[0] <= DOCS_PART:
            return pd.DataFrame([("documents", b, None, blob) for b, blob in zip(
                rows["batch"], rows["blob"])], columns=names)
        if key[0] == PAIRS_PART:
            got = [pickle.loads(b) for b in rows["blob"]]
            kinds, at = np.unique(np.concatenate([k for k, _ in got]), return_inverse=True)
            total = np.zeros(len(kinds), dtype=np.int64)
            np.add.at(total, at, np.concatenate([n for _, n in got]))
            return pd.DataFrame([("pairs", 0, None, pickle.dumps((kinds, total)))], columns=names)

        numbers = rows["batch"].tolist()
        kinds, contexts, found = np.zeros(K + 1), [], []
        for at in range(SLICES):  # contexts in turn, to need less memory at once
            pairs = pairs_of_slice(rows["blob"], at)
            if len(pairs[0]):
                seen, hot, part = scored_pairs(known, *pairs)
                kinds += seen
                contexts += hot
                found.append(part)
        out = [("kinds", 0, list(kinds), None)]
        out += [("context", c, sums, None) for c, sums in contexts]

        places, value, few, asked, sums, lacking, context = zip(*found)
        target, at = np.unique(np.concatenate(places), return_inverse=True)
        all_few = np.zeros((len(target), K), dtype=np.uint32)
        np.add.at(all_few, at, np.concatenate(few))
        offset = np.cumsum([0, *map(len, asked)])
        blob = (np.array(numbers), (target >> 32).astype(np.uint32),
                (target & 0xFFFFFFFF).astype(np.uint32),
                np.bincount(at, np.concatenate(value), len(target)),
                all_few.astype(np.uint8) if all_few.max(initial=0) < 256 else all_few,
                np.concatenate(asked), np.concatenate(sums),
                np.searchsorted(target, np.concatenate(lacking)).astype(np.uint32),
                np.concatenate([c + o for c, o in zip(context, offset)]).astype(np.uint32))
        out.append(("scores", 0, None, pickle.dumps(blob)))
        return pd.DataFrame(out, columns=names)

    return entries.groupBy("part").applyInPandas(run, COUNTED)


class Weights:
    """Discounts of pairs, and backoff weights of contexts, as log10."""

    def __init__(self, words: Words, kinds: np.ndarray, contexts: dict[int, np.ndarray],
                 pairs: tuple[np.ndarray, np.ndarray]):
        self.words = words
        hot, counts = pairs
        kinds = kinds + np.array([(counts == r).sum() for r in range(1, K + 2)])
        self.discount = discounts(kinds)
        sums = np.zeros((words.hot, K + 2))
        for context, part in contexts.items():
            sums[context] = part
        known = counts > 0
        hot, counts = hot[known], counts[known]
        context, word = hot // HOT, hot % HOT
        for r in range(1, K + 1):
            np.add.at(sums[:, r - 1], context[counts == r], 1)
        np.add.at(sums[:, K], context[counts > K], counts[counts > K])
        np.add.at(sums[:, K + 1], context, words.alone(word.astype(np.uint32)))
        ids = np.arange(words.hot, dtype=np.uint32)
        self.hot_weight = self.weight(ids, sums)
        # score of each pair of frequent words
        alone = np.log10(words.alone(ids))
        self.hot_pairs = self.hot_weight[:, None] + alone[None, :] if words.hot else np.zeros((0, 0))
        low = np.where(counts > K, 1.0, self.discount[np.minimum(counts, K)])
        self.hot_pairs[context, word] = np.log10(low * counts) - np.log10(
            words.count(context.astype(np.uint32)) + 1.0)

    def weight(self, ids: np.ndarray, sums: np.ndarray) -> np.ndarray:
        taken = sums[:, :K] @ (self.discount[1:] * np.arange(1, K + 1)) + sums[:, K]
        left = 1.0 - taken / (self.words.count(ids) + 1.0)
        return np.log10(left) - np.log10(1.0 - sums[:, K + 1])


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def scored(counted: DataFrame, weights: Weights) -> DataFrame:
    """Bring the sums of all buckets together, per batch."""
    sent = counted.sparkSession.sparkContext.broadcast(weights)
    parts = pa.schema([("batch", pa.int64()), ("blob", pa.binary())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Weights = sent.value
        low = np.log10(known.discount[1:])
        for batch in batches:
            for blob in batch["blob"].to_pylist():
                numbers, where, doc, value, few, asked, sums, at, context = pickle.loads(blob)
                value = value + few @ low
                weight = known.weight(asked, sums)
                hot = asked < known.words.hot
                weight[hot] = known.hot_weight[asked[hot]]
                value = value + np.bincount(at, weight[context], len(value))
                rows = [(int(numbers[where[a]]), pickle.dumps((doc[a:b], value[a:b])))
                        for a, b in zip(*runs(where))]
                yield rows_out(parts, dict(zip(parts.names, zip(*rows))) if rows
                               else {n: [] for n in parts.names})

    def add(key, docs: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        known: Weights = sent.value
        summary = pickle.loads(docs["blob"].iloc[0])
        score = summary["score"].copy()
        doc, pair = summary["hot"]
        score += np.bincount(doc, known.hot_pairs[pair // HOT, pair % HOT], len(score))
        doc, context = summary["lost"]
        score += np.bincount(doc, known.hot_weight[context], len(score))
        for blob in sums["blob"]:
            doc, value = pickle.loads(blob)
            np.add.at(score, doc, value)
        return pd.DataFrame({
            "doc_id": pd.array(summary["doc_id"], dtype="Int64"), "held_out": summary["held_out"],
            "n_tokens": summary["n_tokens"], "n_known": summary["n_known"],
            "train_tokens": known.words.tokens, "base_score": summary["base"], "score": score})

    documents = counted.where("kind = 'documents'").select(F.col("id").alias("batch"), "blob")
    sums = counted.where("kind = 'scores'").select("blob").mapInArrow(
        finish, "batch long, blob binary")
    return documents.groupBy("batch").cogroup(sums.groupBy("batch")).applyInPandas(add, SCORED)


def katz(documents: DataFrame, held) -> DataFrame:
    """Score every text; ``held`` is true for the rows not to learn from.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                             F.coalesce(held, F.lit(False)).alias("held_out"))
    size = texts.agg(F.coalesce(F.sum(F.length("text") + 8), F.lit(0)).alias("n")).first().n
    batches, buckets = (max(1, -(-size // n)) for n in (BATCH_BYTES, BUCKET_BYTES))

    counts = settled(word_counts(texts, batches))
    ids, level, sizes = with_ids(counts)
    ids, words = settled(ids), Words(level, sizes)

    blocks = packed_texts(texts, batches)
    found = word_ids(blocks, ids, batches)
    counted = settled(counted_pairs(pairs_of_batches(blocks, found, words, buckets), words))

    kinds = counted.where("kind = 'kinds'").select(
        *[F.sum(F.col("numbers")[r]).alias(f"n{r}") for r in range(K + 1)]).first()
    # at most HOT contexts, and HOT^2 pairs
    rows = counted.where("kind = 'context'").groupBy("id").agg(
        *[F.sum(F.col("numbers")[i]).alias(f"s{i}") for i in range(K + 2)]).collect()
    hot = counted.where("kind = 'pairs'").select("blob").collect()
    none = (np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))
    weights = Weights(
        words, np.array([x or 0.0 for x in kinds]),
        {r.id: np.array([r[f"s{i}"] for i in range(K + 2)]) for r in rows},
        pickle.loads(hot[0].blob) if hot else none)
    return scored(counted, weights)


@query("op8_katz_backoff")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))
