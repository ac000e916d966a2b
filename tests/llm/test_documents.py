from __future__ import annotations

import base64
import hashlib
import json
import math
import pickle
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import documents, mixed_texts, prose, sentence

from trovelake.llm import (
    katz_backoff, line_chunks, quality_gam, shingle_join, template_decontamination,
    warc_derivatives,
)
from trovelake.llm.common import held_out, words_of

# --- near duplicates --------------------------------------------------------


def shingle_set(text):
    words = words_of(text.encode()) if text else []
    width = min(5, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def components(texts, ids):
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            near = a and b and 100 * len(a & b) >= 80 * len(a | b)
            if ids[i] is not None and ids[j] is not None and (near or ids[i] == ids[j]):
                label[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(texts)):
        groups[find(i)].append(ids[i])
    return [(ids[i], len(sets[i]), ids[i] if ids[i] is None else min(groups[find(i)]))
            for i in range(len(texts))]


def near_texts(seed, base, copies, edits):
    """Chains of edited copies around the limit, star-like copies of one text,
    and a passage that many share."""
    rng = random.Random(seed)
    shared = prose(rng, 3)
    texts = []
    for _ in range(base):
        words = prose(rng, rng.randint(2, 8)).split()
        for _ in range(copies):
            words = list(words)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 10**6)}"
            texts.append(" ".join(words))
    words = prose(rng, 12).split()
    for _ in range(copies):
        own = list(words)
        for _ in range(rng.randint(1, 3)):
            own[rng.randrange(len(own))] = f"v{rng.randint(0, 5)}"
        texts.append(" ".join(own))
    texts += [shared + "\n" + " ".join(f"u{i}w{j}" for j in range(rng.randint(1, 20)))
              for i in range(30)]
    return texts


@pytest.mark.parametrize("seed, base, copies, edits", [(1, 12, 6, 4), (2, 3, 60, 5), (3, 40, 3, 2)])
def test_components_equal_brute_force(spark, seed, base, copies, edits):
    texts = near_texts(seed, base, copies, edits) + mixed_texts()
    ids = [2000 - 3 * i for i in range(len(texts))]
    ids[-2], ids[-3] = None, ids[5]
    got = shingle_join.clustered(documents(spark, texts, ids)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(components(texts, ids), key=str)


def family_texts(seed, pairs):
    """Members that differ from a central text by more than the limit, two and
    two alike, and the central text."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(base)]
    for p in range(pairs):
        words = list(base)
        for at in rng.sample(range(0, 200, 5), 8):
            words[at] = f"p{p}w{at}"
        for m in range(2):
            own = list(words)
            for at in rng.sample([i for i in range(200) if words[i] == base[i]], 2):
                own[at] = f"m{p}.{m}.{at}"
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("several", [False, True])
def test_repeated_rows_lose_no_link(spark, monkeypatch, several):
    texts = family_texts(5, 12)
    # an order that leaves the family in one group: what it shares comes first
    classes = np.full(shingle_join.CELLS, 255, dtype=np.uint8)
    classes[shingle_join.cells_of(shingle_join.shingles(texts[0].encode()))] = 0
    monkeypatch.setattr(shingle_join, "frequency_classes", lambda *_: classes)
    ids = list(range(len(texts)))
    if several:  # doc_ids that also have another text
        texts += [t + " " + " ".join(f"e{i}x{j}" for j in range(3)) for i, t in enumerate(texts)]
        ids += ids
    expected = dict((i, c) for i, _, c in components(texts, ids))
    assert len(set(expected.values())) > 10
    got = shingle_join.clustered(documents(spark, texts * 6, ids * 6)).collect()
    assert len(got) == 6 * len(texts)
    assert {(r.doc_id, r.component_id) for r in got} == set(expected.items())


def test_components_of_empty_table(spark):
    assert shingle_join.clustered(documents(spark, [])).collect() == []


def test_prefixes_share_a_token_for_any_order():
    rng = np.random.default_rng(2)
    tried = 0
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 60))).astype(np.uint64))
        kept = a[rng.random(len(a)) < 0.93]
        b = np.unique(np.append(kept, rng.integers(0, 2**63, len(a) // 20).astype(np.uint64)))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < 80 * len(np.union1d(a, b)):
            continue
        classes = rng.integers(0, 3, shingle_join.CELLS).astype(np.uint8)
        tried += 1
        assert len(np.intersect1d(shingle_join.prefix(a, classes), shingle_join.prefix(b, classes)))
    assert tried > 100


# --- lines ------------------------------------------------------------------


def cut_by_hand(texts, ids):
    places = defaultdict(list)
    for i, text in zip(ids, texts):
        lines = text.encode().split(b"\n") if text else []
        for a, b, counts in line_chunks.chunk_bounds(lines):
            chunk = b"\n".join(lines[a:b])
            if counts and chunk.strip() and i is not None:
                places[chunk].append((i, a))
    out = []
    for i, text in zip(ids, texts):
        lines = text.encode().split(b"\n") if text else []
        drop = set()
        for a, b, counts in line_chunks.chunk_bounds(lines):
            at = places.get(b"\n".join(lines[a:b]), [])
            if counts and i is not None and len(at) > 1 and (i, a) != min(at):
                drop.update(range(a, b))
        kept = b"\n".join(x for n, x in enumerate(lines) if n not in drop).decode()
        out.append((i, text if text is None else kept, len(drop)))
    return out


def test_repeated_chunks_go_and_the_first_stays(spark):
    rng = random.Random(8)
    block, paragraph = prose(rng, 12), " ".join(f"p{i}" for i in range(60))
    texts = [prose(rng, rng.randint(1, 9)) for _ in range(20)]
    texts += [prose(rng, 2) + "\n" + block + "\n" + prose(rng, 2) for _ in range(10)]
    texts += [prose(rng, 1) + "\n" + paragraph + "\n" + prose(rng, 1) for _ in range(4)]
    texts += [block + "\n" + block, *mixed_texts()]
    ids = [500 - i for i in range(len(texts))]
    ids[3] = None
    rows = line_chunks.deduplicated(documents(spark, texts, ids)).collect()
    got = sorted(((r.doc_id, r.row.text, r.removed_lines) for r in rows), key=str)
    assert got == sorted(cut_by_hand(texts, ids), key=str)
    # copies of the block are cut wherever they stand, at most to its edges
    cut = [r for r in rows if r.row.text and texts[500 - r.doc_id if r.doc_id else 3].count(block)]
    assert sum(r.removed_lines >= 6 for r in cut) >= 9
    assert sum(paragraph in (r.row.text or "") for r in rows) == 1
    assert {r.row.key for r in rows} == {"k"}


def test_boundaries_resist_shifts():
    rng = random.Random(4)
    lines = prose(rng, 200).encode().split(b"\n")
    def chunks(x):
        return {b"\n".join(x[a:b]) for a, b, _ in line_chunks.chunk_bounds(x)}
    first, second = chunks(lines), chunks([b"new line here", *lines])
    assert len(first & second) >= len(first) - 2


def test_whole_repeated_stretches_go(spark):
    """Wherever a stretch of two or more lines stands, and whatever its hashes."""
    rng = random.Random(11)
    stretches = [[f"s{n} {sentence(rng, 9)}" for _ in range(n)] for n in (2, 2, 3, 3, 4, 5) * 5]
    stretches.append(["s split", "", "s by a blank line"])
    texts, alone = [], ["lone line", "", "x"]
    for copy in range(2):
        for k, lines in enumerate(stretches):
            around = [f"{side}{copy}.{k} {sentence(rng, 8)}" for side in "ab"]
            texts.append("\n".join([around[0], *lines, around[1], *alone[:2], f"c{copy}.{k}"]))
    rows = line_chunks.deduplicated(documents(spark, texts)).collect()
    got = {r.doc_id: r.removed_lines for r in rows}
    n = len(stretches)
    assert [got[i] for i in range(n)] == [0] * n
    assert [got[n + i] for i in range(n)] == [len(lines) for lines in stretches]
    # a line that repeats by itself stays
    assert all("lone line" in r.row.text for r in rows)


def test_line_dedup_of_empty_table(spark):
    assert line_chunks.deduplicated(documents(spark, [])).collect() == []


# --- benchmark --------------------------------------------------------------

ITEM = "In spring Alice walked 12 km from the old harbour to Bergen and paid 30 dollars for Bob and Alice"


@pytest.mark.parametrize("passage, found", [
    (ITEM, True),
    (ITEM.replace("Alice", "Carol").replace("12", "47").replace("30", "9"), True),
    (ITEM.replace("km", "miles"), True),
    # what stands word for word beside an edit is a copy
    (ITEM.replace("Bob and Alice", "Bob and Dora"), True),
    (ITEM.replace("Bob", "Alice"), True),
    # other values throughout that do not map one to one are another text
    (ITEM.replace("Alice walked", "Dora walked").replace("12", "47").replace("30", "9")
     .replace("Bergen", "Oslo"), False),
    ("we walked from the old harbour to the town and paid nothing at all", False),
])
def test_reparameterised_questions(spark, passage, found):
    rng = random.Random(1)
    texts = [prose(rng, 5) + ".\n" + passage + ".\n" + prose(rng, 5), prose(rng, 9), None, "", "x"]
    items = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "too short"), (None, ITEM)],
        "item_id long, text string")
    got = template_decontamination.contaminated(documents(spark, texts), items).collect()
    assert [(r.doc_id, r.item_ids) for r in got] == ([(0, [1])] if found else [])


def copied_by_hand(texts, items):
    """(doc, item) that share a run of words and values, as long as the item or
    eight words, whichever is shorter."""
    def runs(text, width=None):
        words, values = template_decontamination.canonical(text or "")
        line = [w if v is None else v for w, v in zip(words, values)]
        width = min(8, len(line)) if width is None else width
        return width, {tuple(line[i:i + width]) for i in range(len(line) - width + 1)}

    out = set()
    for j, item in items.items():
        width, wanted = runs(item)
        if width >= 3:
            out |= {(i, j) for i, t in enumerate(texts) if runs(t, width)[1] & wanted}
    return out


def test_copies_are_found_whatever_they_are_made_of(spark):
    rng = random.Random(21)
    words = "7 12 3.5 km Ann Bob Oslo crates boxes of the and paid for red 40% May".split()
    items = {k: " ".join(rng.choice(words) for _ in range(rng.randint(3, 30)))
             for k in range(25)}
    items |= {30: "What is 12 times 7?", 31: "7 12 40% 3.5 7 12 9 Ann Bob", 32: "2 3",
              33: "In 36 boxes lay 7 crates of red apples and 7 crates of pears for Ann"}
    texts = [prose(rng, 3) + "\n" + rng.choice(["", "so "]) + item + "\n" + prose(rng, 2)
             for item in items.values()]
    texts += [items[33].replace("7 crates of pears", "36 crates of pears"),
              items[33].replace("Ann", "Bob"), None, "", prose(rng, 9), "What is 12 times 8?"]
    rows = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = template_decontamination.contaminated(documents(spark, texts), rows).collect()
    found = {(r.doc_id, j) for r in got for j in r.item_ids}
    wanted = copied_by_hand(texts, items)
    assert wanted <= found
    planted = {(n, k) for n, k in enumerate(items) if k != 32}
    assert planted <= wanted and {(29, 33), (30, 33)} <= wanted
    # what is found besides are copies of the template with other values
    assert all(j != 30 for _, j in found - wanted) and (34, 30) not in found


def test_repeated_rows_null_ids_and_long_texts(spark):
    rng = random.Random(22)
    long = prose(rng, 3000) + ".\n" + ITEM
    docs = documents(spark, [long, long, ITEM, ITEM], [1, 1, None, 2])
    items = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, long)], "item_id long, text string")
    got = template_decontamination.contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_ids) for r in got) == [(1, [1]), (2, [1])]


def test_short_items_and_empty_tables(spark):
    docs = documents(spark, ["zero one two three four five six seven", "one two three"])
    schema = "item_id long, text string"
    short = spark.createDataFrame([(9, "one two three four five")], schema)
    got = template_decontamination.contaminated(docs, short).collect()
    assert [(r.doc_id, r.item_ids, r.windows) for r in got] == [(0, [9], 1)]
    none = spark.createDataFrame([], schema)
    assert template_decontamination.contaminated(docs, none).collect() == []
    assert template_decontamination.contaminated(documents(spark, []), short).collect() == []


def test_canonical_words():
    words, values = template_decontamination.canonical(
        "He paid $12.50 for 3kg. Then Ann, 40 years old, ran 5 km! Oslo")
    assert words == ["he", "paid", "<number>", "for", "<number>", "<unit>", "then", "<name>",
                     "<number>", "<unit>", "old", "ran", "<number>", "<unit>", "oslo"]
    assert [v for v in values if v] == ["12.50", "3", "kg", "ann", "40", "years", "5", "km"]


# --- WARC -------------------------------------------------------------------


def test_derivatives_keep_links_and_digests(spark):
    page = ("<!DOCTYPE html><html lang='en'><head><title>A &amp; B</title><script>x='</p>'</script>"
            "</head><body><!-- no --><p>one <b>two</b></p><a href=\"/x?a=1&amp;b=2\">three</a></body></html>")
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nb", page, 0), (2, None, None, 0), (1, "http://a/\r\nb", page, 0),
         (None, "", "", 0)], "page_id long, url string, html string, record int")
    made = warc_derivatives.responses(pages)
    sources = {r.page_id: warc_derivatives.parse_record(r.record) for r in made.collect()}
    rows = warc_derivatives.derivatives(made).collect()
    assert Counter((r.page_id, r.kind) for r in rows) == {
        (1, "metadata"): 2, (1, "conversion"): 2, (2, "metadata"): 1, (2, "conversion"): 1,
        (None, "metadata"): 1, (None, "conversion"): 1}
    for row in rows:
        headers, block = warc_derivatives.parse_record(row.record)
        source, source_block = sources[row.page_id]
        assert headers["warc-refers-to"] == row.refers_to == source["warc-record-id"]
        assert headers["warc-type"] == row.kind and headers["warc-date"] == source["warc-date"]
        assert headers["warc-target-uri"] == source["warc-target-uri"] == row.target_uri
        sha1 = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert headers["warc-block-digest"] == row.block_digest == sha1
        assert row.source_payload_digest == source["warc-payload-digest"]
        if row.page_id == 1 and row.kind == "conversion":
            assert block.decode() == "A & B\none two\nthree"
        if row.page_id == 1 and row.kind == "metadata":
            facts = json.loads(block)
            assert facts["page"] == {"title": "A & B", "lang": "en",
                                     "links": [{"tag": "a", "url": "/x?a=1&b=2"}]}
            assert facts["payload"]["digest_agrees"] and facts["http"]["status"] == "HTTP/1.1 200 OK"
            assert source["warc-target-uri"] == "http://a/%0D%0Ab"


def test_records_that_are_no_response(spark):
    request = warc_derivatives.record([("WARC-Type", "request")], b"x")
    rows = spark.createDataFrame([(1, bytearray(request)), (2, bytearray(b"junk")), (3, None)],
                                 "page_id long, record binary")
    got = warc_derivatives.derivatives(rows).collect()
    assert sorted((r.page_id, r.kind) for r in got) == [(2, "error"), (3, "error")]
    assert warc_derivatives.derivatives(rows.where("page_id > 9")).collect() == []


# --- quality ----------------------------------------------------------------


def test_quality_model_learns_features_and_pairs():
    rng = np.random.default_rng(0)
    rows = rng.random((4000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)  # no single feature tells
    model = quality_gam.fitted(rows[:3000], labels[:3000])
    score = model.scores(rows[3000:])
    good, bad = score[labels[3000:] == 1], score[labels[3000:] == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert (0, 1) in {(i, j) for i, j, _ in model.pairs}
    # tables are additive: adding them up by hand gives the score
    bins = model.bins(rows[:1])[0]
    total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins))
    total += sum(g[bins[i], bins[j]] for i, j, g in model.pairs)
    assert math.isclose(model.scores(rows[:1])[0], 1 / (1 + math.exp(-total)))


def test_quality_of_documents(spark):
    rng = random.Random(2)
    good = [prose(rng, 5) for _ in range(150)]
    bad = [" ".join(w + "###" for w in prose(rng, 5).split()) for _ in range(60)]
    texts = good + bad + [None, "", good[0]]
    labels = [(i, int(i < 150), 0) for i in range(210)]
    labels += [(0, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (3, 7, 0), (999, 1, 1)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    model = quality_gam.trained(docs, known, ~held_out("doc_id", 5, 0))
    got = {r.doc_id: r for r in quality_gam.scored(docs, model).collect()}
    assert len(got) == len(texts) and got[5].key == "k"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert min(got[i].score for i in range(150)) > max(got[i].score for i in range(150, 210))
    kept = {r.doc_id for r in quality_gam.accepted(docs, known).collect()}
    assert kept >= set(range(150)) and not kept & set(range(150, 210))
    empty = quality_gam.trained(docs, known.where("false"))
    assert {r.score for r in quality_gam.scored(docs, empty).collect()} == {0.5}
    assert quality_gam.accepted(documents(spark, []), known).collect() == []


# --- language model ---------------------------------------------------------


class Katz:
    """The same model, counted and evaluated one token at a time."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for text in texts:
            before = None
            for word in [*words_of(text), b""]:
                self.words[word] += 1
                self.pairs[before, word] += 1
                before = word
        self.n = sum(self.words.values())
        self.starts = self.words[b""]
        self.low = katz_backoff.discounts(self.kinds(self.words))
        self.high = katz_backoff.discounts(self.kinds(self.pairs))
        self.unknown = 1 - sum(self.alone(w) for w in self.words)
        self.after = defaultdict(list)
        for h, w in self.pairs:
            self.after[h].append(w)

    @staticmethod
    def kinds(counts):
        found = Counter(counts.values())
        return np.array([found[r] for r in range(1, katz_backoff.K + 2)])

    def alone(self, word):
        c = self.words.get(word, 0)
        if not c:
            return self.unknown
        return (self.low[c] if c <= katz_backoff.K else 1.0) * c / (self.n + 1)

    def context(self, h):
        return self.starts if h is None else self.words.get(h, 0)

    def seen(self, h, w):
        c = self.pairs[h, w]
        return (self.high[c] if c <= katz_backoff.K else 1.0) * c / (self.context(h) + 1)

    def probability(self, h, w):
        if (h, w) in self.pairs:
            return self.seen(h, w)
        if not self.context(h):
            return self.alone(w)
        left = 1 - sum(self.seen(h, x) for x in self.after[h])
        return left / (1 - sum(self.alone(x) for x in self.after[h])) * self.alone(w)

    def score(self, text):
        total, before = 0.0, None
        for word in [*words_of(text), b""]:
            total += math.log10(self.probability(before, word))
            before = word
        return total


def lm_texts():
    rng = random.Random(9)
    texts = [prose(rng, rng.randint(1, 6)).encode() for _ in range(120)]
    texts += [b"rare%d word%d" % (i, i) for i in range(40)]
    return [t.decode() for t in texts] + mixed_texts()


@pytest.mark.parametrize("hot, batch, bucket", [(512, 10**7, 10**7), (3, 2000, 3000), (1, 500, 700)])
def test_katz_scores_equal_brute_force(spark, monkeypatch, hot, batch, bucket):
    monkeypatch.setattr(katz_backoff, "HOT", hot)
    monkeypatch.setattr(katz_backoff, "BATCH_BYTES", batch)
    monkeypatch.setattr(katz_backoff, "BUCKET_BYTES", bucket)
    texts = lm_texts()
    ids = list(range(len(texts)))
    ids[6], ids[9] = None, ids[8]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids]
    model = Katz([(t or "").encode() for t, h in zip(texts, held) if not h])
    expected = []
    for i, text, h in zip(ids, texts, held):
        words = [*words_of((text or "").encode()), b""]
        base = sum(math.log10((model.words.get(w, 0) + 1) / (model.n + len(model.words) + 1))
                   for w in words)
        expected.append((i, h, len(words), sum(w in model.words for w in words), model.n,
                         base, model.score((text or "").encode())))
    got = katz_backoff.katz(documents(spark, texts, ids), held_out("doc_id", 7, 2)).collect()
    def order(row):
        return (row[0] is None, row[0] or 0, row[2], row[5])
    for row, wanted in zip(sorted(map(tuple, got), key=order), sorted(expected, key=order), strict=True):
        assert row[:5] == wanted[:5]
        assert row[5:] == pytest.approx(wanted[5:], rel=1e-9)


def test_katz_is_normalised():
    model = Katz([(t or "").encode() for t in lm_texts()])
    for h in [None, b"alpha", b"rare1", b"never"]:
        total = sum(model.probability(h, w) for w in [*model.words, b"<unknown>"])
        assert total == pytest.approx(1, abs=1e-9)


def test_katz_without_training_texts(spark):
    got = katz_backoff.katz(documents(spark, ["a b", None]), F.lit(True)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got} == {
        (3, 0, 0, 0.0), (1, 0, 0, 0.0)}
    assert katz_backoff.katz(documents(spark, []), F.lit(False)).collect() == []


def test_katz_holds_the_words_of_one_text_at_a_time():
    words = sorted([b"a", b"b%d" % 7, katz_backoff.END])
    keys = katz_backoff.hashed(words)
    order = np.argsort(keys)
    numbers = np.arange(len(keys), dtype=np.uint32)
    texts = [b"a b7 new " * 50] * 4000 + [b""]
    tracemalloc.start()
    tokens, sizes, end = katz_backoff.tokens_of(texts, keys[order], numbers[order])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    number = dict(zip(words, range(3))) | {b"new": int(katz_backoff.UNKNOWN)}
    want = [number[w] for w in texts[0].split()] + [number[b""]]
    assert tokens[:151].tolist() == want and tokens[-1] == end == number[b""]
    assert sizes.tolist() == [151] * 4000 + [1] and len(tokens) == sizes.sum()
    assert peak < 8 * len(tokens) + 2_000_000  # a list of words takes five times that


def test_katz_unfolds_the_pairs_of_one_slice_at_a_time():
    rng, blobs, whole = np.random.default_rng(1), [], []
    for row in range(20):
        h = np.arange(1000, dtype=np.uint32)
        n = rng.integers(1, 20, 1000).astype(np.uint32)
        w = rng.integers(65_000, 66_000, n.sum()).astype(np.uint32)
        doc = rng.integers(0, 50, n.sum()).astype(np.uint16)
        wide = w >= 0xFFFF
        blobs.append(pickle.dumps((30, h, n, np.where(wide, 0xFFFF, w).astype(np.uint16),
                                   w[wide], doc)))
        whole += zip(np.repeat(h, n).tolist(), w.tolist(), [row << 32 | int(d) for d in doc],
                     (doc < 30).tolist())
    peaks, got = [], []
    for at in range(katz_backoff.SLICES):
        tracemalloc.start()
        slice_ = katz_backoff.pairs_of_slice(blobs, at)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        want = [p for p in whole if p[0] % katz_backoff.SLICES == at]
        assert list(zip(*[x.tolist() for x in slice_])) == want
        got += want
    assert len(got) == len(whole) and max(peaks) < 17 * len(whole)  # all unfolded at once
