"""Phrases that occur together more often than by chance, from a multikey quicksort of suffix pointers.

A suffix is the text from a word on, here at most five words long.  Suffixes are routed by their leading words, so all
that can add to a phrase meet in one task, which sorts pointers to them by three-way partitioning, one word deeper in the
equal part each time.  The size of the equal part is the count of the phrase; a part below the least count is abandoned,
as nothing inside it can reach that count.

Before the routing, suffixes are cut short by what is known: words are counted first, then pairs of frequent words, and a
suffix ends where its next pair is infrequent; those of fewer than three words are not sent.  Which words and pairs are
frequent goes to the tasks as bit tables of a bounded size; a false positive there costs a row and changes no count.

Equal suffixes are put together in a task before they are sent.  Leading words that hold a large share of all positions
are routed by one word more, up to the whole suffix; parts above the routing depth are then partial counts, which are
never abandoned and are added up afterwards.  Such prefixes are found without a pass of their own: a prefix of a share of
2 / K of all positions has 1 / K in enough chunks of the text for their counts to add up to 1 / K, so each chunk reports
those (at most K).

A word is a 64-bit symbol, hashed with its language; the table of all words proves that no frequent word shares its symbol
with another word of the corpus, else another seed is taken.

Input: text and language.  NULL text is empty; a NULL language is ``und``; repeated rows count each; an empty table or
one without frequent phrases gives no rows.  Nothing but whole texts is counted, and counts are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import corpus, mix, stored
from larder.llm.packed import by_bucket, gathered, how_many, split

LEAST, WORDS, TOP = 100, 5, 2000
# Drop a phrase where a longer one has at least this many hundredths of its count.
SHARE = 100
UNKNOWN = "und"
# Positions that a task handles at once, words that it keeps, and bits of a table (32 MB at most).
CHUNK, KEPT, BITS = 1 << 21, 1_000_000, 28

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STOPS = b".,;:!?\x0a\x0b\x0c\x0d"
_STOP = b"."
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _STOPS, bytes(range(97, 123)) + _STOP * len(_STOPS))


def words_and_stops(text: str) -> list[bytes]:
    """Words in order, with a stop wherever a piece ends."""
    # After the table only spaces and tabs are left of what bytes.split takes for white space.
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).replace(_STOP, b" . ").split()


def symbol_of(lang: bytes, word: bytes, seed: int) -> int:
    """Never 0, which stands for the end of a suffix."""
    return xxhash.xxh3_64_intdigest(lang + b"\xff" + word, seed) or 1


def prefix_hash(columns: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(columns[0]), np.uint64(len(columns)))
    for c in columns:
        out = mix(out * _ODD + c)
    return out


class Coder:
    """Codes of words in a task: 0 for stops and words that are not in the bit table."""

    def __init__(self, table: np.ndarray, seed: int):
        self.table, self.last, self.seed = memoryview(table), len(table) * 8 - 1, seed
        self.clear()

    def clear(self) -> None:
        self.by_lang: dict[str, _Codes] = {}
        self.symbols = [0]

    def full(self) -> bool:
        return sum(map(len, self.by_lang.values())) > KEPT

    def codes(self, lang: str, text: str) -> np.ndarray:
        if lang not in self.by_lang:
            self.by_lang[lang] = _Codes(self, lang.encode("utf-8"))
        found = words_and_stops(text)
        return np.fromiter(map(self.by_lang[lang].__getitem__, found), np.int32, len(found))


class _Codes(dict):
    def __init__(self, coder: Coder, lang: bytes):
        super().__init__({_STOP: 0})
        self.coder, self.lang = coder, lang

    def __missing__(self, word: bytes) -> int:
        coder = self.coder
        symbol = symbol_of(self.lang, word, coder.seed)
        at, code = symbol & coder.last, 0
        if coder.table[at >> 3] >> (at & 7) & 1:
            code = len(coder.symbols)
            coder.symbols.append(symbol)
        self[word] = code
        return code


def in_table(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = (key & np.uint64(len(table) * 8 - 1)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def chunks(batches: Iterator[pa.RecordBatch], table: np.ndarray, seed: int, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of some texts, a stop between two of them, and the symbols of the codes."""
    coder, held, n = Coder(table, seed), [], 0
    stop = np.zeros(1, np.int32)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = coder.codes(lang, text or "")
            held += [codes, stop]
            n += len(codes) + 1
            if n >= size:
                yield np.concatenate(held), np.array(coder.symbols, np.uint64)
                held, n = [], 0
                if coder.full():
                    coder.clear()
    if n:
        yield np.concatenate(held), np.array(coder.symbols, np.uint64)


def bit_table(keys: DataFrame, count: int, most: int = BITS) -> np.ndarray:
    """A table with a bit for every 64-bit key (binary column ``key``), with 16 bits for a key up to 2**most bits."""
    bits = 1 << min(most, max(15, (16 * max(1, count) - 1).bit_length()))
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def place(batches):
        for b in batches:
            at = np.frombuffer(b"".join(b.column(0).to_pylist()), "<u8") & np.uint64(bits - 1)
            yield pa.RecordBatch.from_pydict({"at": at.astype(np.int64), "block": (at >> np.uint64(15)).astype(np.int64)})

    def pack(frames):
        blocks: dict[int, np.ndarray] = {}  # no more of them than the table has
        for f in frames:
            for block, at in f.groupby("block")["at"]:
                blocks.setdefault(block, np.zeros(1 << 15, np.uint8))[at.to_numpy() & 32767] = 1
        for block, marks in blocks.items():
            yield pd.DataFrame({"block": [block], "marks": [np.packbits(marks, bitorder="little").tobytes()]})

    placed = keys.select("key").mapInArrow(place, "at long, block long").repartition(parts, "block")
    table = np.zeros(bits // 8, np.uint8)
    for r in placed.mapInPandas(pack, "block long, marks binary").collect():
        table[r.block * 4096 : (r.block + 1) * 4096] = np.frombuffer(r.marks, np.uint8)
    return table


def _binary(columns: list[np.ndarray]) -> list[bytes]:
    """Symbols side by side as the bytes of a phrase."""
    raw = np.stack(columns, 1).astype("<u8")
    return [row.tobytes() for row in raw]


def _texts(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """All words: symbol, lang, word, f."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        held: dict[str, Counter] = {}

        def rows():
            flat = ((symbol_of(lang.encode("utf-8"), w, seed).to_bytes(8, "little"), lang, w, n) for lang, c in held.items() for w, n in c.items())
            while part := list(zip(*islice(flat, 1 << 15))):
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.binary()), pa.array(part[1], pa.string()), pa.array(part[2], pa.binary()), pa.array(part[3], pa.int64())], names=["symbol", "lang", "word", "f"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = held.setdefault(lang, Counter())
                found.update(words_and_stops(text or ""))
                found.pop(_STOP, None)
            if sum(map(len, held.values())) > KEPT:
                yield from rows()
        yield from rows()

    partial = texts.mapInArrow(count, "symbol binary, lang string, word binary, f long")
    return partial.repartition(parts, "symbol").groupBy("symbol", "lang", "word").agg(F.sum("f").alias("f"))


def proven_words(texts: DataFrame, least: int, name: str = "phrase-words") -> tuple[DataFrame, int]:
    """Word counts under a seed with which no frequent word shares its symbol."""
    for seed in range(8):
        words = stored(word_counts(texts, seed), name)
        shared = words.groupBy("symbol").agg(F.count("*").alias("n"), F.max("f").alias("f")).where((F.col("n") > 1) & (F.col("f") >= least))
        if shared.isEmpty():
            return words, seed
    raise RuntimeError("no seed separates the words")


_PACKED_PAIRS = "bucket long, s1 binary, s2 binary, n binary, prefix binary, depth int, held long"


def pair_counts(texts: DataFrame, table, seed: int, least: int, share: int, buckets: int, size: int = CHUNK) -> DataFrame:
    """Frequent pairs (``phrase``, ``f``, ``hash``), and prefixes with a large share of a chunk (``depth`` 2 to 4, ``f``)."""

    def local(batches):
        for codes, symbols in chunks(batches, table.value, seed, size):
            both = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
            key = codes[both].astype(np.int64) << 32 | codes[both + 1]
            sort = np.sort(key)
            first = np.flatnonzero(np.concatenate([[True], sort[1:] != sort[:-1]])) if len(sort) else sort
            n = np.diff(first, append=len(sort))
            s1, s2 = symbols[sort[first] >> 32], symbols[sort[first] & 0xFFFFFFFF]
            rows = [(*r, None, None, None) for r in split(buckets, prefix_hash([s1, s2]), s1, s2, n.astype("<u4"))]
            # Heavy prefixes of the chunk; a deeper one is looked for at the places of a heavy shorter one only.
            limit = len(codes) / share
            heavy = n >= limit
            rows += _heavy([s1[heavy], s2[heavy]], n[heavy], buckets)
            places = both[np.isin(key, sort[first[heavy]])]
            for depth in (3, 4):
                places = places[places + depth - 1 < len(codes)]
                places = places[codes[places + depth - 1] > 0]
                columns = [symbols[codes[places + d]] for d in range(depth)]
                sort, start, count = _runs(columns)
                heavy = count >= limit
                rows += _heavy([c[sort[start[heavy]]] for c in columns], count[heavy], buckets)
                places = places[sort][np.repeat(heavy, count)]
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["bucket", "s1", "s2", "n", "prefix", "depth", "held"])

    def summed(frames):
        for _, rows in by_bucket(frames):
            whole = rows["prefix"].isna()
            held = rows[~whole].groupby(["prefix", "depth"], as_index=False)["held"].sum()
            if len(held):
                yield pd.DataFrame({"phrase": held["prefix"], "depth": held["depth"], "f": held["held"], "hash": None})
            rows = rows[whole]
            if len(rows) == 0:
                continue
            s1, s2 = (np.frombuffer(b"".join(rows[c]), "<u8") for c in ("s1", "s2"))
            n = np.frombuffer(b"".join(rows["n"]), "<u4").astype(np.int64)
            sort, start, _ = _runs([s1, s2])
            total = np.add.reduceat(n[sort], start)
            kept = total >= least
            a, b = s1[sort[start[kept]]], s2[sort[start[kept]]]
            yield pd.DataFrame({"phrase": _binary([a, b]), "depth": 2, "f": total[kept], "hash": _binary([prefix_hash([a, b])])})

    packed = texts.mapInArrow(local, _PACKED_PAIRS)
    both = stored(gathered(packed).mapInPandas(summed, "phrase binary, depth int, f long, hash binary"), "phrase-pairs")
    return both.where("hash is not null"), both.where("hash is null").drop("hash")


def _heavy(columns: list[np.ndarray], n: np.ndarray, buckets: int) -> list[tuple]:
    """Rows of prefixes, dealt out like the pairs."""
    to = (prefix_hash(columns) % np.uint64(buckets)).tolist()
    return [(b, None, None, None, p, len(columns), c) for b, p, c in zip(to, _binary(columns), n.tolist())]


def _runs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by all columns, and start and length of each run of equal rows."""
    sort = np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])
    new = np.ones(len(sort), bool)
    if len(sort):
        new[1:] = False
        for c in columns:
            new[1:] |= c[sort][1:] != c[sort][:-1]
    start = np.flatnonzero(new)
    return sort, start, np.diff(start, append=len(sort))


def suffixes(texts: DataFrame, table, pairs, hot, seed: int, buckets: int, words: int = WORDS, size: int = CHUNK) -> DataFrame:
    """Suffixes of three words and more, equal ones of a chunk together, packed by the group they are routed to."""

    def local(batches):
        known, heavy = pairs.value, {d: np.array(h, np.uint64) for d, h in hot.value.items()}
        for codes, symbols in chunks(batches, table.value, seed, size):
            at = symbols[codes]
            link = np.zeros(len(codes) + words, bool)
            link[: len(codes) - 1] = (codes[:-1] > 0) & (codes[1:] > 0)
            both = np.flatnonzero(link)
            link[both] = in_table(known, prefix_hash([at[both], at[both + 1]]))
            runs = [link[: len(codes)]]
            for d in range(1, words - 1):
                runs.append(runs[-1] & link[d : d + len(codes)])
            start = np.flatnonzero(runs[1])
            columns = [at[start], at[start + 1], at[start + 2]]
            for d in range(3, words):
                ok = runs[d - 1][start]
                columns.append(np.where(ok, at[np.minimum(start + d, len(at) - 1)], np.uint64(0)))
            key = prefix_hash(columns)
            sort = np.argsort(key)
            new = np.ones(len(sort), bool)
            if len(sort):
                new[1:] = key[sort][1:] != key[sort][:-1]
                for c in columns:
                    new[1:] |= c[sort][1:] != c[sort][:-1]
            first = np.flatnonzero(new)
            columns = [c[sort[first]] for c in columns]
            n = np.diff(first, append=len(sort)).astype("<u4")
            depth, deeper = np.full(len(n), 2), np.ones(len(n), bool)
            route = prefix_hash(columns[:2])
            for d in range(2, words):
                deeper &= np.isin(prefix_hash(columns[:d]), heavy.get(d, np.zeros(0, np.uint64)))
                depth[deeper] = d + 1
                route[deeper] = prefix_hash([c[deeper] for c in columns[: d + 1]])
            group = (route % np.uint64(buckets)) * np.uint64(8) + depth.astype(np.uint64)
            rows = list(split(8 * buckets, group, *columns, n))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(list(zip(*rows)) or [()] * (words + 2))], names=["bucket", *[f"s{d + 1}" for d in range(words)], "n"])

    return texts.mapInArrow(local, f"bucket long, {', '.join(f's{d + 1} binary' for d in range(words))}, n binary")


def partition_counts(columns: list[np.ndarray], weights: np.ndarray, least: int, complete: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of pointers to suffixes: length, a pointer and the count of each equal part.

    Parts of prefixes of at least ``complete`` words are whole, so what weighs less than ``least`` is abandoned; shorter
    prefixes may have more suffixes elsewhere and are reported at any count.
    """
    pointers = np.arange(len(weights))
    length, sample, count = [], [], []
    todo = [(0, len(pointers), 0)] if len(pointers) else []
    while todo:
        lo, hi, depth = todo.pop()
        part = pointers[lo:hi]
        keys = columns[depth][part]
        pivot = np.sort(keys[[0, len(keys) >> 2, len(keys) >> 1, 3 * len(keys) >> 2, -1]])[2]
        less, equal = keys < pivot, keys == pivot
        weight = weights[part]
        needed = least if depth + 1 >= complete else 1
        n_less, n_equal = int(np.count_nonzero(less)), int(np.count_nonzero(equal))
        same = part[equal]
        if n_equal < len(part):
            below, above = part[less], part[~(less | equal)]
            pointers[lo : lo + n_less], pointers[lo + n_less : lo + n_less + n_equal], pointers[lo + n_less + n_equal : hi] = below, same, above
            if weights[below].sum() >= needed:
                todo.append((lo, lo + n_less, depth))
            if weights[above].sum() >= needed:
                todo.append((lo + n_less + n_equal, hi, depth))
            total = int(weight[equal].sum())
        else:
            total = int(weight.sum())
        if pivot and total >= needed and n_equal:
            length.append(depth + 1)
            sample.append(int(same[0]))
            count.append(total)
            if depth + 1 < len(columns):
                todo.append((lo + n_less, lo + n_less + n_equal, depth + 1))
    return np.array(length, np.int64), np.array(sample, np.int64), np.array(count, np.int64)


def longer_counts(packed: DataFrame, least: int, words: int = WORDS) -> DataFrame:
    """Phrases of three words and more: ``phrase``, ``depth``, ``f``."""
    names = [f"s{d + 1}" for d in range(words)]

    def sort(frames):
        for bucket, rows in by_bucket(frames):
            columns = [np.frombuffer(b"".join(rows[c]), "<u8") for c in names]
            weights = np.frombuffer(b"".join(rows["n"]), "<u4").astype(np.int64)
            length, sample, count = partition_counts(columns, weights, least, int(bucket) % 8)
            out = [(length == d, d) for d in range(3, words + 1)]
            phrases = [p for at, d in out for p in _binary([c[sample[at]] for c in columns[:d]])]
            yield pd.DataFrame({"phrase": phrases, "depth": [d for at, d in out for _ in range(at.sum())], "f": np.concatenate([count[at] for at, _ in out])})

    found = gathered(packed).mapInPandas(sort, "phrase binary, depth int, f long")
    return found.groupBy("phrase", "depth").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(
    df: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST,
    words: int = WORDS,
    top: int = TOP,
    share: int = SHARE,
    size: int = CHUNK,
    hot: int | None = None,
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``hot`` is K above: leading words with more than 2 / K of all positions are routed deeper (4 times the partitions).
    """
    spark = df.sparkSession
    texts = _texts(df, lang_col, text_col)
    counted, seed = proven_words(texts, least)
    sizes = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counted.where(F.col("f") >= least)
    number, positions = counted.agg(F.count(F.when(F.col("f") >= least, 1)), F.coalesce(F.sum("f"), F.lit(0))).first()
    table = spark.sparkContext.broadcast(bit_table(frequent.select(F.col("symbol").alias("key")), number))
    buckets = how_many(df)
    hot = hot or buckets
    pairs, heavy = pair_counts(texts, table, seed, least, hot, buckets, size)
    links = spark.sparkContext.broadcast(bit_table(pairs.select(F.col("hash").alias("key")), pairs.count()))
    # At most K prefixes of a depth have this many positions.
    large = heavy.where(F.col("f") >= F.lit(positions / hot)).collect()
    routes = {d: [int(prefix_hash([np.frombuffer(r.phrase[8 * i : 8 * i + 8], "<u8") for i in range(d)])[0]) for r in large if r.depth == d] for d in (2, 3, 4)}
    packed = suffixes(texts, table, links, spark.sparkContext.broadcast(routes), seed, buckets, words, size)
    longer = stored(longer_counts(packed, least, words), "phrase-longer")
    return ranked(frequent, sizes, pairs.select("phrase", "depth", "f").unionByName(longer), top, share)


def ranked(frequent: DataFrame, sizes: DataFrame, phrases: DataFrame, top: int, share: int) -> DataFrame:
    """Score the phrases by their lowest cut, drop those inside longer ones, and take the first of each language."""
    known = frequent.select(F.col("symbol").alias("part"), F.col("f").alias("part_f"), "lang").unionByName(
        phrases.select(F.col("phrase").alias("part"), F.col("f").alias("part_f"), F.lit(None).cast("string").alias("lang"))
    )
    # Any longer phrase that holds a phrase holds it at an end of one that is a word longer and occurs no less.
    ends = phrases.where("depth > 2").select(
        F.explode(F.array(F.expr("substring(phrase, 1, 8 * (depth - 1))"), F.expr("substring(phrase, 9)"))).alias("phrase"), F.col("f").alias("longer")
    )
    best_longer = ends.groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = phrases.join(best_longer, "phrase", "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("f"))
    )
    cuts = kept.select("phrase", "depth", F.col("f").alias("a"), F.explode(F.expr("sequence(1, depth - 1)")).alias("k"))
    cuts = cuts.select("phrase", "depth", "a", "k", F.expr("substring(phrase, 1, 8 * k)").alias("first"), F.expr("substring(phrase, 8 * k + 1)").alias("rest"))
    left = cuts.join(known.select(F.col("part").alias("first"), F.col("part_f").alias("l"), "lang"), "first")
    both = left.join(known.select(F.col("part").alias("rest"), F.col("part_f").alias("r")), "rest")
    one = both.groupBy("phrase", "depth", "a").agg(F.max("lang").alias("lang"), F.collect_list(F.struct("k", "l", "r")).alias("cuts"))
    with_n = one.join(sizes, "lang")
    scored = with_n.withColumn(
        "best",
        F.expr(
            """array_min(transform(cuts, c -> named_struct(
                'score', (cast(1000 as decimal(4, 0)) * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0)))
                    div (cast(c.l as decimal(19, 0)) * cast(c.r as decimal(19, 0))),
                'k', c.k, 'l', c.l, 'r', c.r)))"""
        ),
    ).select("lang", "phrase", "depth", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").cast("long").alias("score"))
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = scored.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= top).drop("place")
    spelled = near.withColumn("at", F.explode(F.expr("sequence(0, depth - 1)"))).withColumn("symbol", F.expr("substring(phrase, 8 * at + 1, 8)"))
    spelled = spelled.join(frequent.select("symbol", F.decode("word", "UTF-8").alias("word")), "symbol")
    keys = ["lang", "phrase", "a", "l", "r", "n", "score"]
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    whole = spelled.groupBy(*keys).agg(text.alias("text"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    return whole.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score"
    )


def op12_collocations(spark, folder: str) -> DataFrame:
    return collocations(corpus(spark, folder))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
pieces AS (
  SELECT d, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
),
numbered AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM numbered),
sizes AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, t AS cut, x.f AS l, y.f AS r, s.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * s.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS t FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : t], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[t + 1 : c.k], ' ')
  JOIN sizes s ON s.lang = c.lang
),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM cuts) WHERE o = 1
),
inside AS (
  SELECT lang, array_to_string(w[b : b + z - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, k, z, unnest(range(1, k - z + 2)) AS b
        FROM (SELECT *, unnest(range(2, k)) AS z FROM cand WHERE k > 2))
  GROUP BY 1, 2
),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN inside i ON i.lang = l.lang AND i.phrase = l.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * l.a
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, score
FROM ranked WHERE rank <= 2000
"""
