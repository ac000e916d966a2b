"""Benchmark decontamination by templates.

Texts are split into words and made canonical: numbers, names and units become
typed placeholders, other words are lower-cased without the marks around them.
Windows of ``WIDTH`` canonical words of documents and benchmark items meet in a
hash join. For each run of matches along one alignment of a document and an
item, the values behind the placeholders must map one to one, the same item
value always to the same document value. So a passage counts if it is a copy, or
the same question with other parameters, and not if only its shape agrees.

A fixed-size filter (``FILTER_CELLS`` bits of the benchmark's window hashes, no
matter how large the benchmark is) drops most windows beside the scan; it lets
every match through. What passes is joined by hash, so no side is broadcast
unless Spark finds it under its own limit.

* A null or empty text has no windows and is clean.
* Items with fewer than ``WIDTH`` words have one window, the whole item; items
  below ``LEAST_WORDS`` words are no passages and not searched for. A match by
  template of windows with fewer than ``LEAST_LITERALS`` words that are no
  placeholders says nothing by itself; down to ``SLOT_LITERALS`` its placeholders
  are checked with those of the other windows of the alignment.
* Repeated items count once per item_id; repeated documents are judged by
  doc_id, and all rows of a contaminated doc_id are. Rows without a doc_id are
  not searched and reported clean; items without an item_id are not searched for.
* Whole texts are searched. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.llm.common import (
    CellFilter, few_rows, query, rows_out, table, window_hashes, worker_cache,
)
from trovelake.plans.settle import settled

WIDTH = 8
LEAST_WORDS = 3      # words of an item
LEAST_LITERALS = 5   # words that are no placeholders, for a window to tell something
SLOT_LITERALS = 3    # ... and to be looked at for its placeholders, beside such a window
FILTER_CELLS = 1 << 22
BLOCK_CHARACTERS = 1 << 19   # of texts that are hashed together

NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
# Units that may follow a number.
UNITS = set("""
% $ £ € ° a c cal cent cents cl cm cm2 cm3 day days dl dollar dollars eur euro euros f feet foot
ft g gal gallon gallons gb ghz gram grams h hour hours hr hrs hz in inch inches j k kb kcal kg
kilogram kilograms kilometer kilometers kilometre kilometres kj km km/h kmh kw kwh l lb lbs liter
liters litre litres m m/s m2 m3 mb meter meters metre metres mg mhz mi mile miles min minute minutes
ml mm month months mph ms n ounce ounces oz pa pence penny percent pound pounds pt rpm s sec second
seconds t tb ton tonne tonnes tons usd v volt volts w watt watts week weeks yard yards yd year years
""".split())
NUMERIC = re.compile(r"[+\-−]?[$£€]?(\d[\d.,:/]*)([^\W\d_°%]{0,4}|[%°$£€])$")
EDGES = "\"'“”‘’«»()[]{}<>,;:!?…|*#&~_=+-–—"
ENDS = (".", "!", "?", ":", "…")


EMPTY, NUMERAL, UNIT_WORD, CAPITAL, PLAIN = range(5)


def parsed(word: str) -> tuple:
    """(kind, value, second, ends a sentence) of a word, wherever it stands."""
    bare = word.strip(EDGES)
    ends = bare.endswith(ENDS) or word.rstrip("\"'”’»)]}").endswith(ENDS)
    bare = bare.rstrip(".…")
    if not bare:
        return EMPTY, word if word in UNITS else None, None, ends
    number = NUMERIC.match(bare) if bare[-1:].isalnum() or bare[0].isdigit() else None
    low = bare.lower()
    if number and (not number.group(2) or number.group(2).lower() in UNITS):
        return NUMERAL, number.group(1).rstrip(".,:/"), number.group(2).lower() or None, ends
    capital = bare[0].isupper() and (len(bare) == 1 or bare[1:].islower())
    if low in UNITS:
        return UNIT_WORD, low, capital, ends
    return CAPITAL if capital else PLAIN, low, None, ends


class ParsedWords(dict):
    """word -> its parts; emptied when it holds ``limit`` words."""

    def __missing__(self, word: str) -> tuple:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = parsed(word)
        return value


def known_words() -> ParsedWords:
    cache = worker_cache("words")
    if "parsed" not in cache:
        cache["parsed"] = ParsedWords()
    return cache["parsed"]


def canonical(text: str) -> tuple[list[str], list[str | None]]:
    """Template words of a text, and the value behind each placeholder."""
    words: list[str] = []
    values: list[str | None] = []
    parts = known_words()
    for line in text.split("\n"):
        fresh = True  # at the start of a sentence a capital letter tells nothing
        for word in line.split():
            kind, value, second, ends = parts[word]
            if kind == PLAIN:
                words.append(value)
                values.append(None)
            elif kind == EMPTY:
                if value and words and words[-1] == NUMBER:
                    words.append(UNIT)
                    values.append(value)
                fresh = fresh or ends
                continue
            elif kind == NUMERAL:
                words.append(NUMBER)
                values.append(value)
                if second:
                    words.append(UNIT)
                    values.append(second)
            elif kind == UNIT_WORD and words and words[-1] == NUMBER:
                words.append(UNIT)
                values.append(value)
            elif not fresh and (kind == CAPITAL or second):
                words.append(NAME)
                values.append(value)
            else:
                words.append(value)
                values.append(None)
            fresh = ends
    return words, values


class TextHashes(dict):
    """text -> 64-bit hash; emptied when it holds ``limit`` texts."""

    def __missing__(self, text: str) -> int:
        import xxhash

        if len(self) >= 200_000:
            self.clear()
        value = self[text] = xxhash.xxh3_64_intdigest(text)
        return value


def text_hashes() -> TextHashes:
    cache = worker_cache("words")
    if "texts" not in cache:
        cache["texts"] = TextHashes()
    return cache["texts"]


class Windows:
    """Windows of some texts by template, and by words and values. The texts stand
    end to end, and a window lies within one."""

    def __init__(self, keys: list, texts: list[str | None]):
        self.keys, words, self.values, ends = keys, [], [], []
        for text in texts:
            if text:
                own, values = canonical(text)
                words += own
                self.values += values
            ends.append(len(words))
        self.ends = np.array(ends, dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        known = text_hashes()
        self.template = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        self.exact = self.template.copy()
        slots = [i for i, v in enumerate(self.values) if v is not None]
        # the word itself, whether its place makes it a name or not
        self.exact[slots] = np.fromiter(
            (known[self.values[i]] for i in slots), np.uint64, len(slots))
        is_literal = np.ones(len(words), dtype=np.int64)
        is_literal[slots] = 0
        self.literal = np.concatenate([[0], np.cumsum(is_literal)])
        self.owner = np.repeat(np.arange(len(keys)), self.ends - self.starts)

    def found(self, width: int, exact: bool, wanted) -> Iterator[tuple]:
        """Rows of the windows whose hash ``wanted`` holds for."""
        if width > len(self.owner):
            return
        hashed = window_hashes(self.exact if exact else self.template, width)
        literals = self.literal[width:] - self.literal[:-width]
        there = (self.owner[:len(hashed)] == self.owner[width - 1:]) & wanted(hashed)
        if not exact:
            there &= literals >= SLOT_LITERALS
        for at in np.flatnonzero(there).tolist():
            text = self.owner[at]
            yield (self.keys[text], at - int(self.starts[text]), int(hashed[at].astype(np.int64)),
                   int(literals[at]), exact,
                   [] if exact else [v for v in self.values[at:at + width] if v is not None])


WINDOWS = pa.schema([("id", pa.int64()), ("at", pa.int32()), ("key", pa.int64()),
                     ("literals", pa.int32()), ("exact", pa.bool_()),
                     ("slots", pa.list_(pa.string()))])
WINDOWS_DDL = "id long, at int, key long, literals int, exact boolean, slots array<string>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return rows_out(WINDOWS, dict(zip(WINDOWS.names, zip(*rows))) if rows
                    else {n: [] for n in WINDOWS.names})


def item_windows(items: DataFrame) -> DataFrame:
    """(id, at, key, literals, exact, slots) of the windows of benchmark items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                windows = Windows([key], [text])
                width = min(WIDTH, len(windows.owner))
                if width >= LEAST_WORDS:
                    for exact in (False, True):
                        rows += windows.found(width, exact, lambda keys: np.True_)
            yield _batch(rows)

    known = items.where("item_id is not null").select("item_id", "text").distinct()
    return known.mapInArrow(run, WINDOWS_DDL)


def short_widths(items: DataFrame, width: int = WIDTH) -> list[int]:
    """Lengths below ``width`` that items have, so that documents are searched
    with those windows too. At most width - 1 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = {len(canonical(t or "")[0]) for t in batch["text"].to_pylist()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(sorted(n for n in lengths if LEAST_WORDS <= n < width), pa.int32())],
                names=["n"])

    found = items.select("text").mapInArrow(run, "n int").distinct().collect()
    return sorted(r.n for r in found)


def blocks_of(keys: list, texts: list) -> Iterator[tuple[list, list]]:
    """Some texts at a time, about BLOCK_CHARACTERS long together."""
    start = size = 0
    for number, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= BLOCK_CHARACTERS or number + 1 == len(texts):
            yield keys[start:number + 1], texts[start:number + 1]
            start, size = number + 1, 0


def candidate_windows(documents: DataFrame, wanted: DataFrame, widths: list[int]) -> DataFrame:
    """Windows of documents whose hash may be among the wanted keys."""
    passing = CellFilter(wanted.select("key"), FILTER_CELLS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = passing.test()
        for batch in (few for whole in batches for few in few_rows(whole)):
            for keys, texts in blocks_of(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                windows = Windows(keys, texts)
                yield _batch([row for width in widths for exact in (False, True)
                              for row in windows.found(width, exact, wanted)])

    known = documents.where("doc_id is not null").select("doc_id", "text")
    return known.mapInArrow(run, WINDOWS_DDL)


def matches(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, offset, windows, slots, renamed): alignments of a
    document and an item that hold, with the number of matching windows, of
    different placeholder values, and of those that differ from the item's."""
    wanted = settled(item_windows(items))
    widths = sorted({WIDTH, *short_widths(items)})
    there = candidate_windows(documents, wanted, widths)
    there = there.withColumnsRenamed({"id": "doc_id", "at": "doc_at", "slots": "doc_slots"})
    pairs = there.join(wanted.drop("literals").withColumnsRenamed(
        {"id": "item_id", "at": "item_at", "slots": "item_slots"}), ["key", "exact"])
    says = F.col("exact") | (F.col("literals") >= LEAST_LITERALS)
    aligned = pairs.where(F.size("doc_slots") == F.size("item_slots")).select(
        "doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("offset"),
        F.when(says, F.col("item_at")).alias("item_at"), "exact",
        F.arrays_zip(F.col("item_slots").alias("item"), F.col("doc_slots").alias("doc"))
        .alias("slots"))
    # an alignment has at most as many windows as the item has words
    runs = aligned.groupBy("doc_id", "item_id", "offset").agg(
        F.countDistinct("item_at").alias("windows"), F.bool_or("exact").alias("copied"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    sides = [F.size(F.array_distinct(F.col(f"slots.{side}"))) for side in ("item", "doc")]
    agree = (sides[0] == F.size("slots")) & (sides[1] == F.size("slots"))
    return runs.where((F.col("windows") > 0) & (F.col("copied") | agree)).select(
        "doc_id", "item_id", "offset", "windows", F.size("slots").alias("slots"),
        F.size(F.filter("slots", lambda s: s["item"] != s["doc"])).alias("renamed"))


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_ids, windows, renamed) of the contaminated documents."""
    by_item = matches(documents, items).groupBy("doc_id", "item_id").agg(
        F.max("windows").alias("windows"), F.min("renamed").alias("renamed"))
    # a document holds no more items than windows
    return by_item.groupBy("doc_id").agg(
        F.sort_array(F.collect_list("item_id")).alias("item_ids"),
        F.sum("windows").cast("long").alias("windows"),
        F.sum("renamed").cast("long").alias("renamed"))


@query("op3_template_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(documents, table(spark, sf_dir, "benchmark"))
    return documents.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        "item_ids", "windows", "renamed")
