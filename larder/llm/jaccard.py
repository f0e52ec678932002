"""Similarity join on word shingles by vertical partitioning.

A document's set are its distinct five-word shingles; documents link at a Jaccard similarity of 0.75 or more and the
result names for each the smallest document id it can reach by links.

1. Equal sets form one class; everything below compares classes.
2. Candidates: under any global order of shingles, linked sets share one of their first ``n - ceil(0.75 n) + 1``.  The
   order puts frequent shingles last (by hash among equals), so those prefixes meet in short lists.  Short lists give
   all their pairs of fitting size.  Pairs whose parity sketches differ in more cells than linked sets may differ in
   shingles are left out: by 256 cells first, then, if both sets have more shingles, by as many cells as shingles.
3. Verification: the global order is cut into ``FRAGMENTS`` ranges, each pair's overlap is counted in every fragment
   separately and the partial counts are summed.  Sets travel only where their class is used: as one or the other side
   of a pair, or in a long list.
4. Long lists with one smallest class are put together (copies share most of their lists) and never written out as
   pairs.  Their members' sets go, cut into tiles of bounded size, to tasks that keep apart what is connected so far:
   pairs not yet connected are compared by sketches of ``SKETCH`` cells, then as sets, and only the links that connect
   something are returned, fewer than the members.  Pairs inside a component need no comparison: the components are
   exact.  Comparing sketches is the part that grows with the square of a list.

The frequent shingles are broadcast: those with more than ``FREQUENT`` prefix entries, of which the threshold is doubled
until at most ``BROADCAST`` are left (8 MB).  They only set the order; any choice gives the same links.

Shingles and classes are known by 64-bit hashes.  NULL texts and texts without words have an empty set and link with
nothing; fewer than five words are one shingle; repeated rows are in one class; a NULL id never names a component, but
links through such documents count (a hash of the text stands for the id); an empty table gives an empty result.  Similar
documents of one component are not expanded into all their pairs, so no number of links is returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import WordHashes, corpus, lower_ascii, shingles, stored
from larder.llm.components import components
from larder.llm.packed import by_bucket, gathered, how_many, split

WIDTH = 5
PERCENT = 75
FRAGMENTS = 8
FREQUENT = 4
BROADCAST = 1 << 20
SHORT = 8
# Cells of the parities that every set has.
PARITIES = 256
# Bytes of sets in a block of a long list; cells of the sketches that are compared there (a power of two).
TILE, SKETCH = 16 << 20, 4096


class ShingleSets:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self):
        self.hashes = WordHashes(1 << 18)

    def of(self, text: str) -> np.ndarray:
        return np.unique(shingles(self.hashes.of(lower_ascii(text).split()), WIDTH))


def _name(shingle_set: np.ndarray) -> int:
    """Name of the class of equal sets: 64 bits of their shingles' hash."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingle_set.astype("<u8").tobytes())).view(np.int64))


def _parity(shingle_set: np.ndarray) -> list[int]:
    """For each of 256 cells whether an odd number of shingles falls into it, as four words."""
    bits, word = np.uint64(1) << (shingle_set & np.uint64(63)), (shingle_set >> np.uint64(6)) & np.uint64(3)
    return [int(np.bitwise_xor.reduce(bits[word == k], initial=np.uint64(0)).view(np.int64)) for k in range(4)]


def _prefix_length(n: int) -> int:
    return n - (-(-PERCENT * n // 100)) + 1


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def _named(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def _sketch(shingle_set: np.ndarray, cells: int) -> np.ndarray:
    """For each of the cells (a power of two) whether an odd number of shingles falls into it, packed into words."""
    odd = np.bincount((shingle_set & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def _own_sketch(shingle_set: np.ndarray) -> bytes | None:
    """A sketch with as many cells as shingles, up to the next power of two; none where the parities have as many."""
    n = len(shingle_set)
    return _sketch(shingle_set, 1 << (n - 1).bit_length()).tobytes() if n > PARITIES else None


def _apart(x: bytes, y: bytes) -> int:
    """Cells in which two sketches differ; the halves of the larger one are united until both have the same cells."""
    x, y = (np.frombuffer(s, np.uint64) for s in sorted((x, y), key=len))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


PARITY = "p0 long, p1 long, p2 long, p3 long, sketch binary"


def first_pass(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Set size ``n``, ``class``, parities and sketch of every document by ``id`` (or ``stand_in``); where ``n`` is NULL, a ``shingle``
    with more than ``FREQUENT`` prefix entries under the plain hash order, and their number.

    Texts are cut into shingles once, so documents travel with the packed counts, dealt evenly; only what is left of the
    counts after they met is written.
    """
    buckets = how_many(df)
    fields = [("bucket", pa.int64()), ("id", pa.int64()), ("stand_in", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), *[(f"p{k}", pa.int64()) for k in range(4)]]
    fields += [("sketch", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())]
    schema = pa.schema(fields)

    def run(batches):
        sets = ShingleSets()
        for batch in batches:
            found = [sets.of(t) for t in batch.column(2).to_pylist()]
            sizes = [len(s) for s in found]
            own = [pa.array(np.arange(len(found)) % buckets), batch.column(0), batch.column(1), pa.array(sizes, pa.int64())]
            parity = np.array([_parity(s) for s in found], np.int64).reshape(len(found), 4)
            own += [pa.array([_name(s) for s in found], pa.int64()), *[pa.array(parity[:, k]) for k in range(4)]]
            own += [pa.array([_own_sketch(s) for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([*own, *[pa.nulls(len(found), t) for _, t in fields[10:]]], schema=schema)
            parts = [s[: _prefix_length(len(s))] for s in found if len(s)]
            if parts:
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                bucket, *packed = zip(*split(buckets, keys, keys, counts.astype("<u4")))
                nothing = [pa.nulls(len(bucket), t) for _, t in fields[1:10]]
                yield pa.RecordBatch.from_arrays([pa.array(bucket), *nothing, *[pa.array(c, pa.binary()) for c in packed]], schema=schema)

    names = [name for name, _ in fields[1:10]]
    out = pa.schema([*fields[1:10], ("shingle", pa.int64()), ("entries", pa.int64())])

    def meet(batches):
        now, keys, counts = None, [], []
        for batch in batches:
            document = batch.column("n").is_valid()
            own = batch.filter(document)
            if own.num_rows:
                nothing = pa.nulls(own.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in names], nothing, nothing], schema=out)
            rest = batch.filter(batch.column("n").is_null())
            for bucket, k, n in zip(*[rest.column(c).to_pylist() for c in ("bucket", "keys", "counts")]):
                if bucket != now and keys:
                    yield _hot(keys, counts, out)
                    keys, counts = [], []
                now = bucket
                keys.append(k)
                counts.append(n)
        if keys:
            yield _hot(keys, counts, out)

    named = _named(df, id_col, text_col).select("id", F.when(F.col("id").isNull(), F.xxhash64("t")).alias("stand_in"), "t")
    columns = f"id long, stand_in long, n long, class long, {PARITY}"
    packed = named.mapInArrow(run, f"bucket long, {columns}, keys binary, counts binary")
    return stored(gathered(packed).mapInArrow(meet, f"{columns}, shingle long, entries long"), "jaccard-first")


def _hot(keys: list[bytes], counts: list[bytes], out: pa.Schema) -> pa.RecordBatch:
    """The shingles of a bucket with more than ``FREQUENT`` entries."""
    found, at = np.unique(np.frombuffer(b"".join(keys), "<u8"), return_inverse=True)
    total = np.bincount(at, np.frombuffer(b"".join(counts), "<u4")).astype(np.int64)
    hot = total > FREQUENT
    nothing = [pa.nulls(int(hot.sum()), t) for t in out.types[:-2]]
    return pa.RecordBatch.from_arrays([*nothing, pa.array(found[hot].view(np.int64)), pa.array(total[hot])], schema=out)


def frequent_shingles(hot: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles (``shingle``, ``entries``) with the most prefix entries."""
    limit = FREQUENT
    while hot.where(F.col("entries") > limit).count() > BROADCAST:
        limit *= 2
    return np.sort(hot.where(F.col("entries") > limit).select("shingle").toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


class Members:
    """Look-up in a sorted array of hashes, with a table of their leading bits in front."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.bits = hashes, np.zeros(1 << 24, bool)
        self.bits[(hashes >> np.uint64(40)).astype(np.int64)] = True

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = self.bits[(keys >> np.uint64(40)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            out[at] = self.hashes[np.minimum(np.searchsorted(self.hashes, keys[at]), len(self.hashes) - 1)] == keys[at]
        return out


def prefixes(sets: list[np.ndarray], frequent: Members) -> tuple[np.ndarray, np.ndarray]:
    """The prefix entries of all sets, frequent shingles last: shingle and set of each."""
    lengths = np.array([len(s) for s in sets])
    keys, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    late, begin = frequent.of(keys), np.cumsum(lengths) - lengths
    early = np.concatenate([[0], np.cumsum(~late)])
    before = early[:-1] - early[begin][owner]  # rarer shingles of the set before each entry
    rare = early[begin + lengths] - early[begin]
    place = np.where(late, rare[owner] + np.arange(len(keys)) - begin[owner] - before, before)
    pick = place < (lengths - (-(-PERCENT * lengths // 100)) + 1)[owner]
    return keys[pick], owner[pick]


def _fits(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * small >= PERCENT * large


def candidates(df: DataFrame, text_col: str, frequent: np.ndarray) -> DataFrame:
    """Pairs of classes (``a``, ``b``); where ``a`` is NULL, the members (``class``, ``n``) of long lists by hub (``list``)."""
    buckets, shared = how_many(df), df.sparkSession.sparkContext.broadcast(frequent)

    def emit(frames):
        sets, hot = ShingleSets(), Members(shared.value)
        for f in frames:
            first = {_name(s): s for s in map(sets.of, f["t"]) if len(s)}  # copies within a batch count once
            if first:
                keys, owner = prefixes(list(first.values()), hot)
                names = np.array(list(first), "<i8")[owner]
                sizes = np.array([len(s) for s in first.values()], "<u4")[owner]
                yield pd.DataFrame(split(buckets, keys, keys, names, sizes), columns=["bucket", "keys", "names", "sizes"])

    columns = ["a", "b", "list", "class", "n"]

    def meet(batches):
        for _, f in by_bucket(b.to_pandas() for b in batches):
            keys = np.frombuffer(b"".join(f["keys"]), "<u8")
            names = np.frombuffer(b"".join(f["names"]), "<i8")
            sizes = np.frombuffer(b"".join(f["sizes"]), "<u4").astype(np.int64)
            order = np.lexsort((names, keys))
            keys, names, sizes = keys[order], names[order], sizes[order]
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])])
            keys, names, sizes = keys[new], names[new], sizes[new]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            lengths = np.diff(np.append(starts, len(keys)))
            pairs, lists = [], []
            for gap in range(1, SHORT):  # all pairs of the short lists, by distance within the list
                inside = np.flatnonzero(np.repeat((lengths > gap) & (lengths <= SHORT), lengths))
                left = inside[inside + gap < len(keys)]
                left = left[keys[left + gap] == keys[left]]
                pairs.append((left, left + gap))
            for s, n in zip(starts[lengths > SHORT].tolist(), lengths[lengths > SHORT].tolist()):
                lists.append(np.arange(s, s + n))
            a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            fit = _fits(np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b]))
            both = np.unique(np.stack([names[a[fit]], names[b[fit]]], axis=1), axis=0) if fit.any() else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), *[pa.nulls(len(both), pa.int64())] * 3], names=columns)
            if lists:
                # Copies share most of their lists: those with the same smallest class, the hub, are put together.
                hubs = np.concatenate([np.full(len(x), names[x[0]]) for x in lists])
                at = np.concatenate(lists)
                rows = np.unique(np.stack([hubs, names[at], sizes[at]], axis=1), axis=0)
                nothing = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([nothing, nothing, *[pa.array(rows[:, i]) for i in range(3)]], names=columns)

    packed = _texts(df, text_col).mapInPandas(emit, "bucket long, keys binary, names binary, sizes binary")
    return stored(gathered(packed).mapInArrow(meet, "a long, b long, list long, class long, n long"), "jaccard-candidates")


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose parities allow a link: sets differ in at least as many shingles as their parities in cells."""
    side = lambda c: classes.select(F.col("class").alias(c), F.col("n").alias(f"n{c}"), *[F.col(f"p{k}").alias(f"{c}{k}") for k in range(4)])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    apart = sum(F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in range(4))
    # A similarity of 3/4 means that at most a seventh of both sizes differs.
    return both.where((100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("na") + F.col("nb"))).select("a", "b")


def sketched(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose own sketches allow a link; parities have too few cells to tell large sets apart."""
    side = lambda c: classes.select(F.col("class").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))

    def run(frames):
        for f in frames:
            both = zip(f["na"] + f["nb"], f["sa"], f["sb"])
            may = [x is None or y is None or (100 + PERCENT) * _apart(x, y) <= (100 - PERCENT) * n for n, x, y in both]
            yield f.loc[may, ["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a long, b long")


LEFT, RIGHT, LISTED = 1, 2, 4


def uses(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The classes whose sets are needed, with what for (``use``): sides of pairs, members of long lists."""
    use = lambda df, c, bit: df.select(F.col(c).alias("class"), F.lit(bit).alias("use"))
    every = use(pairs, "a", LEFT).union(use(pairs, "b", RIGHT)).union(use(members, "class", LISTED))
    return every.groupBy("class").agg(F.bit_or("use").alias("use"))


def used(parts: DataFrame, bit: int) -> DataFrame:
    return parts.where(F.col("use").bitwiseAND(bit) != 0)


def segments(df: DataFrame, classes: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The sets of the wanted classes, cut into fragments of the global order: class, size, use, fragment, shingles."""
    kinds = classes.join(wanted, "class")
    reps = stored(kinds.select(F.col("rep").isNull().alias("unnamed"), F.coalesce("rep", "stand_in").alias("key"), "class", "use"), "jaccard-reps")
    texts = _named(df, id_col, text_col).select(
        F.col("id").isNull().alias("unnamed"), F.coalesce("id", F.xxhash64("t")).alias("key"), "t"
    )

    def cut(frames):
        sets, seen = ShingleSets(), set()
        edges = np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64(2**64 // FRAGMENTS)
        for f in frames:
            for lo in range(0, len(f), 256):
                out, part = [], f.iloc[lo : lo + 256]
                for wanted_class, use, s in zip(part["class"], part["use"], map(sets.of, part["t"])):
                    # A key may stand for several texts or rows; one of them has the class, and counts once.
                    if _name(s) == wanted_class and wanted_class not in seen:
                        seen.add(wanted_class)
                        cuts = np.split(s.view(np.int64), np.searchsorted(s, edges))
                        out += [(wanted_class, len(s), use, k, p) for k, p in enumerate(cuts) if len(p)]
                yield pd.DataFrame(out, columns=["class", "n", "use", "fragment", "shingles"])

    chosen = _likely(texts, reps).join(reps.hint("shuffle_hash"), ["unnamed", "key"]).select("class", "use", "t")
    return chosen.mapInPandas(cut, "class long, n long, use int, fragment int, shingles array<long>")


def _likely(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """The texts whose key has the 26-bit hash of a representative's: most others need not travel to the join.

    The bits go out in at most 2 ** 20 words of 64, however many representatives there are.
    """
    cell = F.shiftrightunsigned(F.xxhash64("unnamed", "key"), 38).alias("cell")
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    words = reps.select(cell).groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    near = texts.select("*", cell).join(F.broadcast(words), F.shiftright("cell", 6) == F.col("word"))
    return near.where("bit_get(bits, cast(cell & 63 as int)) = 1").select("unnamed", "key", "t")


def verified(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs of classes that link: partial overlaps by fragment, summed for each pair."""
    left = used(parts, LEFT).select(F.col("class").alias("a"), F.col("n").alias("na"), "fragment", F.col("shingles").alias("xa"))
    right = used(parts, RIGHT).select(F.col("class").alias("b"), F.col("n").alias("nb"), "fragment", F.col("shingles").alias("xb"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("xa", "xb")).alias("part")
    )
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("both"))
    return total.where(100 * F.col("both") >= PERCENT * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def tiles(members: DataFrame, parts: DataFrame) -> DataFrame:
    """The sets of long lists' members, by ``list`` and pair of blocks ``p`` <= ``q`` in which they are compared.

    A list whose sets take more than ``TILE`` bytes is dealt by hash into blocks of about that size, and each pair of
    blocks is a tile of its own.
    """
    blocks = members.groupBy("list").agg(F.ceil(F.sum(F.col("n") * 8 + SKETCH // 8) / TILE).cast("int").alias("blocks"))
    dealt = members.join(blocks, "list").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    each = dealt.select("list", "class", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = each.select("list", "class", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    return placed.join(parts.select("class", "fragment", "shingles").hint("shuffle_hash"), "class")


def spanning_links(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all sets which links between a set of ``first`` and one of ``second`` connect.

    A pair that found links connect already is not looked at; of the others those whose sketches allow a link are
    compared as sets.  So the links found are fewer than the sets, however many pairs link.
    """
    sizes, label, links = np.array([len(s) for s in sets]), np.arange(len(sets)), []
    sketches = np.array([_sketch(s, SKETCH) for s in sets])
    for i in np.flatnonzero(first).tolist():
        near = second & (label != label[i]) & _fits(np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i]))
        at = np.flatnonzero(near)
        apart = np.bitwise_count(sketches[at] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        # A similarity of 3/4 means that at most a seventh of both sizes differs.
        for j in at[(100 + PERCENT) * apart <= (100 - PERCENT) * (sizes[at] + sizes[i])].tolist():
            if label[j] != label[i]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= PERCENT * (sizes[i] + sizes[j] - both):
                    links.append((i, j))
                    label[label == label[j]] = label[i]
    return links


def list_links(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Links of classes (``a``, ``b``) that connect the members of each long list as all their links do."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["class", "fragment"])
        begin = np.flatnonzero(np.concatenate([[True], np.diff(f["class"].to_numpy()) != 0]))
        names, block = f["class"].to_numpy()[begin], f["block"].to_numpy()[begin]
        pieces = f["shingles"].tolist()
        sets = [np.concatenate(pieces[lo:hi]).view(np.uint64) for lo, hi in zip(begin, [*begin[1:], len(f)])]
        found = spanning_links(sets, block == f["p"].iloc[0], block == f["q"].iloc[0])
        pairs = np.sort(names[np.array(found, np.int64).reshape(-1, 2)], axis=1)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return tiles(members, parts).groupBy("list", "p", "q").applyInPandas(run, "a long, b long")


def similar_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` of every document."""
    seen = first_pass(df, id_col, text_col)
    docs = seen.where("n is not null").select("id", "n", "class")
    kinds = seen.where("n > 0").groupBy("class", "n", "p0", "p1", "p2", "p3", "sketch").agg(F.min("id").alias("rep"), F.min("stand_in").alias("stand_in"))
    classes = stored(kinds, "jaccard-classes")
    frequent = frequent_shingles(seen.where("n is null").select("shingle", "entries"))
    found = candidates(df, text_col, frequent)
    near = plausible(found.where("a is not null").select("a", "b").distinct(), classes)
    pairs = stored(sketched(near, classes), "jaccard-pairs")
    members = stored(found.where("a is null").select("list", "class", "n").distinct(), "jaccard-lists")
    parts = stored(segments(df, classes, uses(pairs, members), id_col, text_col), "jaccard-segments")
    links = stored(verified(pairs, parts), "jaccard-links").union(stored(list_links(members, used(parts, LISTED)), "jaccard-links"))
    place = components(links)
    named = docs.join(place, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    smallest = named.where("n > 0").groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(smallest, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def op6_jaccard(spark, folder: str) -> DataFrame:
    return similar_components(corpus(spark, folder))
