"""Benchmark decontamination by template canonicalisation.

Words lose their punctuation and case; numbers, quantities ("5kg"), names (capitalised words) and units become typed
placeholders, so a benchmark question with other numbers or names has the same template.  Windows of ``WINDOW`` template
words of every document are looked up in the hash table of the benchmark's windows.  Where windows agree, the compared
words must be the same template words and the slots must be consistent: one value of the item stands for one value in
the document and the reverse.  A second table holds the windows of the plain words, case-folded and with nothing replaced,
whatever they are, so copies in any case are found too.  An item is found in a document if the consistent runs of both
tables cover ``COVERAGE`` of its words.

The benchmark is taken in blocks of a bounded number of items, each broadcast and matched with all rows; the work per
document does not depend on how many documents share a passage.

NULL texts, empty texts and items without words match nothing; an item shorter than a window must occur as a whole;
windows with fewer than ``LITERALS`` words outside slots are left out of the template table, as any text has them, and
match by their plain words only.  Repeated rows give repeated rows; an item id may stand for several texts and counts
once; texts without an id count as one item NULL, last in the list; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField

from larder.llm.common import WordHashes, corpus, per_document, shingles

WINDOW = 8
LITERALS = 3
COVERAGE = 0.5
ITEMS_PER_BLOCK = 50_000

# Measuring units taken as slots.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms pound pounds ounce ounces "
    "ton tons l ml liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years dollar dollars cent cents euro euros percent degree degrees meter meters metre metres "
    "kilometer kilometers kilometre kilometres".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
_QUANTITY = re.compile(r"[+-]?\d[\d.,]*([^\W\d_]+)")
_EDGES = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
SLOTS = ("<number>", "<quantity>", "<unit>", "<name>")


def canonical(word: str) -> str:
    """The template word: a placeholder, the word in lower case, or nothing for bare punctuation."""
    if word.isalpha() and word.islower():
        return "<unit>" if word in UNITS else word
    word = _EDGES.sub("", word)
    low = word.lower()
    if _NUMBER.fullmatch(word):
        return "<number>"
    if (m := _QUANTITY.fullmatch(low)) and m[1] in UNITS:
        return "<quantity>"
    if low in UNITS:
        return "<unit>"
    if word[:1].isupper() and word[1:] == word[1:].lower() and any(c.isalpha() for c in word):
        return "<name>"
    return low if any(c.isalnum() for c in low) else ""


class TemplateHashes(WordHashes):
    """Hashes of template words by raw word; bare punctuation is 0, and so is an empty word."""

    def __missing__(self, word: bytes) -> int:
        shape = canonical(word.decode("utf-8"))
        value = WordHashes.__missing__(_PLAIN, shape.encode("utf-8")) if shape else 0
        if len(self) < self.limit:
            self[word] = value
        return value


class PlainHashes(WordHashes):
    """Hashes of case-folded words without punctuation by raw word, 0 where a template has no word either."""

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8")
        low = (text if text.isalnum() else _EDGES.sub("", text)).casefold()
        value = WordHashes.__missing__(_PLAIN, low.encode("utf-8")) if any(c.isalnum() for c in low) else 0
        if len(self) < self.limit:
            self[word] = value
        return value


_PLAIN = WordHashes(0)
_SLOT_HASHES = np.array([_PLAIN[s.encode()] for s in SLOTS], np.uint64)


class Template:
    """The template words of a text, with hash, raw word and slot mark of each; plain words have no slots."""

    def __init__(self, text: str, hashes: WordHashes):
        self.raw = text.encode("utf-8").split()
        all_hashes = hashes.of(self.raw)
        self.at = np.flatnonzero(all_hashes)
        self.hashes = all_hashes[self.at]
        self.slot = np.isin(self.hashes, _SLOT_HASHES)

    def word(self, i: int) -> str:
        return _EDGES.sub("", self.raw[self.at[i]].decode("utf-8")).lower()

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows with enough words outside slots."""
        n = len(self.hashes)
        if n < width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        literal = np.concatenate([[0], np.cumsum(~self.slot)])
        starts = np.flatnonzero(literal[width:] - literal[:-width] >= min(LITERALS, width))
        return starts, shingles(self.hashes, width)[starts]


_MARKS = b".,;:!?)'\""
_UNIT_WORDS = frozenset(u.encode() for u in UNITS)
_UNIT, _NAME = _PLAIN[b"<unit>"], _PLAIN[b"<name>"]


class BothHashes(dict):
    """Numbers of raw words as a task's dictionary, and the template and plain hash of each number."""

    def __init__(self, limit: int = 1 << 18):
        super().__init__()
        self.limit, self.template, self.plain = limit, array("Q"), array("Q")
        self.slow = TemplateHashes(0), PlainHashes(0)

    def __missing__(self, word: bytes) -> int:
        core = word.rstrip(_MARKS)
        if core.isalpha():  # letters of ASCII only, as these are bytes: what the general rules make of them
            low = core.lower()
            plain = xxhash.xxh3_64_intdigest(low)
            name = core[:1] != low[:1] and core[1:] == low[1:]
            template = _UNIT if low in _UNIT_WORDS else _NAME if name else plain
        else:
            template, plain = (kind[word] for kind in self.slow)
        self[word] = number = len(self.plain)
        self.template.append(template)
        self.plain.append(plain)
        return number

    def of(self, words: list[bytes]) -> dict[type, np.ndarray]:
        if len(self) > self.limit:
            self.clear()
            self.template, self.plain = array("Q"), array("Q")
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not len(numbers):
            return {kind: np.zeros(0, np.uint64) for kind in (TemplateHashes, PlainHashes)}
        kinds = ((TemplateHashes, self.template), (PlainHashes, self.plain))
        return {kind: np.frombuffer(hashes, np.uint64)[numbers] for kind, hashes in kinds}


class Words:
    """The words of some texts, split and looked up once for both tables."""

    def __init__(self, texts: list[str], both: BothHashes):
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary
        _, offsets, data = distinct.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(distinct) + 1].tolist() if len(distinct) else [0]
        data = data.to_pybytes() if data else b""
        self.hashes = both.of([data[lo:hi] for lo, hi in zip(ends, ends[1:])])
        self.number = coded.indices.to_numpy(zero_copy_only=False)
        self.text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))

    def hashed(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words that have one in this kind of table, in order, and their texts."""
        found = self.hashes[kind][self.number]
        at = np.flatnonzero(found)
        return found[at], self.text[at]


def _shift(bits: np.ndarray) -> np.uint64:
    """How far a hash is shifted to leave as many bits as the filter's address has."""
    return np.uint64(64 - (len(bits).bit_length() - 1))


class BenchmarkBlock:
    """Hash table of the windows of some items, with a bit filter in front of it."""

    def __init__(self, items: list[tuple[int, str]], kind: type[WordHashes] = TemplateHashes):
        hashes = kind()
        self.items = {i: Template(t, hashes) for i, t in items}
        self.table: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for i, t in self.items.items():
            width = min(WINDOW, len(t.hashes))
            if width:
                for start, h in zip(*t.windows(width)):
                    self.table[width][int(h)].append((i, int(start)))
        self.table = {w: dict(t) for w, t in self.table.items()}
        self.filters = {}
        for width, table in self.table.items():
            bits = max(16, math.ceil(math.log2(len(table))) + 6)
            keys = np.fromiter(table, np.uint64, len(table))
            self.filters[width] = np.zeros(1 << bits, bool)
            self.filters[width][(keys >> np.uint64(64 - bits)).astype(np.int64)] = True

    def suspects(self, texts: list[str], hashes: WordHashes) -> list[int]:
        """Positions of the texts with a window whose hash is in the table; all others contain no item."""
        return self.suspected(Words(texts, BothHashes()), type(hashes))

    def suspected(self, texts: Words, kind: type) -> list[int]:
        words, doc = texts.hashed(kind)
        hit = set()
        for width, table in self.table.items():
            if len(words) < width:
                continue
            keys, seen = shingles(words, width), self.filters[width]
            for k in np.flatnonzero(seen[(keys >> _shift(seen)).astype(np.int64)]).tolist():
                if doc[k] == doc[k + width - 1] and int(keys[k]) in table:
                    hit.add(int(doc[k]))
        return sorted(hit)

    def found(self, doc: Template) -> dict[int, float]:
        """Covered share of every item that has a consistent run in the document."""
        return {i: len(c) / len(self.items[i].hashes) for i, c in self.covered(doc).items()}

    def covered(self, doc: Template) -> dict[int, set[int]]:
        """Covered words of every item that has a consistent run in the document."""
        runs: dict[tuple[int, int], set[int]] = defaultdict(set)
        for width, table in self.table.items():
            starts, keys = doc.windows(width)
            seen = self.filters[width]
            for k in np.flatnonzero(seen[(keys >> _shift(seen)).astype(np.int64)]):
                for item, start in table.get(int(keys[k]), ()):
                    if np.array_equal(self.items[item].hashes[start : start + width], doc.hashes[starts[k] : starts[k] + width]):
                        runs[item, int(starts[k]) - start].update(range(start, start + width))
        covered: dict[int, set[int]] = defaultdict(set)
        for (item, shift), words in runs.items():
            covered[item] |= self._consistent(self.items[item], doc, shift, sorted(words))
        return {i: c for i, c in covered.items() if c}

    @staticmethod
    def _consistent(item: Template, doc: Template, shift: int, words: list[int]) -> set[int]:
        """Words of the longest stretch along one alignment in which slots map one to one."""
        best: set[int] = set()
        now: set[int] = set()
        there, back = {}, {}
        for i in words:
            if item.slot[i]:
                kind, a, b = int(item.hashes[i]), item.word(i), doc.word(i + shift)
                if there.setdefault((kind, a), b) != b or back.setdefault((kind, b), a) != a:
                    best, now = max(best, now, key=len), set()
                    there, back = {(kind, a): b}, {(kind, b): a}
            now.add(i)
        best = max(best, now, key=len)
        return best if len(best) >= min(WINDOW, len(item.hashes)) else set()


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    coverage: float = COVERAGE,
    items_per_block: int = ITEMS_PER_BLOCK,
    keep=(),
) -> DataFrame:
    """Id, ``items`` (ids of the benchmark items found, ascending) and ``coverage`` (the largest covered share)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("t")).where(
        "t is not null"
    )
    items = items.distinct()
    blocks = max(1, math.ceil(items.count() / items_per_block))
    fields = [StructField("items", ArrayType(LongType())), StructField("coverage", DoubleType())]
    out, kept = df, list(keep)
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == b).collect()
        shared = df.sparkSession.sparkContext.broadcast([(r.item, r.t) for r in block])

        def make(shared=shared):
            # Texts are matched by their number, as one id may stand for several and some have none.
            ids = [i for i, _ in shared.value]
            texts_of_block = list(enumerate(t for _, t in shared.value))
            both = BothHashes()
            tables = [(BenchmarkBlock(texts_of_block, kind), kind()) for kind in (TemplateHashes, PlainHashes)]
            n_words = {i: len(t.hashes) for i, t in tables[0][0].items.items()}

            def work(texts):
                covered: list[dict[int, set[int]]] = [{} for _ in texts]
                words_of_texts = Words(texts, both)
                for table, hashes in tables:
                    for i in table.suspected(words_of_texts, type(hashes)):
                        for item, words in table.covered(Template(texts[i], hashes)).items():
                            covered[i].setdefault(item, set()).update(words)
                found = [{item: len(words) / n_words[item] for item, words in c.items()} for c in covered]
                return {
                    "items": [sorted({ids[i] for i, c in f.items() if c >= coverage}, key=lambda i: (i is None, i or 0)) for f in found],
                    "coverage": [max(f.values(), default=0.0) for f in found],
                }

            return work

        # Each block passes over the documents; what earlier blocks found travels along.
        before = [] if b == 0 else ["found", "share"]
        carry = [text_col] if b + 1 < blocks else []
        step = per_document(out, make, fields, id_col, text_col, [*kept, *before, *[c for c in carry if c not in kept]])
        if b:
            step = step.withColumns(
                {"items": F.array_sort(F.array_distinct(F.concat("found", "items"))), "coverage": F.greatest("share", "coverage")}
            ).drop("found", "share")
        out = step if b + 1 == blocks else step.withColumnsRenamed({"items": "found", "coverage": "share"})
    return out


def op10_decontaminate(spark, folder: str) -> DataFrame:
    found = decontaminate(corpus(spark, folder), corpus(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.round("coverage", 6).alias("coverage"),
        (F.size("items") > 0).alias("contaminated"),
    )
