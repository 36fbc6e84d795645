"""MinHash near-dedup: b-bit signatures, band candidates, links confirmed on full shingle sets, components.

1. Each text becomes the set of its distinct 5-word shingles; `sid` is the hash of the whole set, so texts with equal
   sets are one node and a thousand copies cost as much as one.
2. 256 minima; 32 bands of 4 full minima give the candidate keys, and the low 2 bits of each minimum are packed into eight
   64-bit words. At a Jaccard similarity of 0.75 all 32 bands differ with a chance of 5e-6.
3. In each band key every node is compared with the key's head alone (a star, linear in the key's size): the packed
   words give a similarity by bit counts, corrected for chance collisions; what can reach the limit is confirmed on the
   full sets. Components follow from these links, and the keys that hold several take another head, a few times.
4. Only nodes of a key that are still in different components are then compared with each other, first by bit counts
   and then on full sets, beside each other in one task (a large key in pairs of blocks). A task passes on a link only where
   it joins two components, so no such link is lost and no group emits its pairs.

Nulls and empty texts have no set and are linked with nothing. Rows with one doc_id are separate rows of one document, told apart by
`tag`, the hash of their text. An empty table gives an empty one; texts are taken whole; ties go to the smaller doc_id, then the smaller tag.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm import textkit as K
from skyloom.llm.common import given_back, input_partitions, sized, written
from skyloom.llm.graph import components

PERMUTATIONS, BANDS, ROWS, LOW_BITS = 256, 32, 4, 2
WORDS = PERMUTATIONS * LOW_BITS // 64
#: Standard deviations of the bit-count estimate that a pair may lie below the limit and still be confirmed exactly.
SLACK = 4.5
#: How often the nodes of a band that are in different components meet a new head before they meet each other.
ROUNDS = 2
BLOCK_NODES = 2048
FILTER_BITS = 1 << 22
_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_BAND = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def minima(grams: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a set of 64-bit shingle hashes."""
    high = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 1024):
        np.minimum(least, (high[at : at + 1024, None] * _MULTIPLY + _ADD).min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of mixed minima of many sets, side by side in 64-bit words."""
    low = (K.mix64(least) & np.uint64((1 << LOW_BITS) - 1)).reshape(len(least), WORDS, 64 // LOW_BITS)
    shift = np.arange(64 // LOW_BITS, dtype=np.uint64) * np.uint64(LOW_BITS)
    return np.bitwise_or.reduce(low << shift, axis=2)


def band_keys(least: np.ndarray) -> np.ndarray:
    parts = K.mix64(least[:, : BANDS * ROWS]).reshape(len(least), BANDS, ROWS)
    return K.mix64((parts * _BAND).sum(axis=2) + np.arange(BANDS, dtype=np.uint64))


def mismatches(left: list[Column], right: list[Column]) -> Column:
    """How many of the packed values differ, by bit counts."""
    mask = 0x5555555555555555
    differs = [(x := a.bitwiseXOR(b)).bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(mask)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda p, q: p + q, [F.bit_count(x) for x in differs])


def similarity(differing: Column) -> Column:
    """The Jaccard similarity that so many differing values stand for, corrected for values that agree by chance."""
    chance = 2.0**-LOW_BITS
    return (1 - differing / PERMUTATIONS - chance) / (1 - chance)


def most_mismatches(least_similarity: float) -> int:
    p = (1 - least_similarity) * (1 - 2.0**-LOW_BITS)
    return int(PERMUTATIONS * p + SLACK * (PERMUTATIONS * p * (1 - p)) ** 0.5)


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each row."""
    for start, stop in K.slices(column):
        grams, begin = K.shingles(*K.words(column.slice(start, stop - start)), k)
        for i in range(stop - start):
            yield start + i, np.unique(grams[begin[i] : begin[i + 1]])


def _set_id(grams: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(K.mix64(np.array([(K.mix64(grams) * np.uint64(3)).sum() + np.uint64(len(grams))]))[0].astype(np.int64))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64()), *((f"s{i}", pa.int64()) for i in range(WORDS)), ("bands", pa.list_(pa.int64()))])


def _sign(k: int) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            size, sid, least = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, PERMUTATIONS), np.uint32)
            for i, grams in _sets(batch.column(1), k):
                size[i] = len(grams)
                if len(grams):
                    sid[i], least[i] = _set_id(grams), minima(grams)
            none = size == 0
            words, keys = packed(least).astype(np.int64), band_keys(least).astype(np.int64)
            bands = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(size), pa.array(sid, mask=none), *(pa.array(words[:, i]) for i in range(WORDS)), bands], schema=_SIGNED)

    return run


def signatures(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, tag, n_shingles, sid (null for an empty set), packed words s0.., bands: one key per band."""
    kinds = ", ".join(f"s{i} long" for i in range(WORDS))
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag")).mapInArrow(_sign(k), f"doc_id long, tag long, n_shingles long, sid long, {kinds}, bands array<long>")


def _wanted_sets(k: int, wanted: np.ndarray) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) % FILTER_BITS
            hit = np.flatnonzero((wanted[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            sid, sets = [], []
            for _, grams in _sets(batch.column(1).take(pa.array(hit)), k):
                if len(grams):
                    sid.append(_set_id(grams))
                    sets.append(grams.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["sid", "grams"])

    return run


def _full_sets(docs: DataFrame, nodes: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """sid, grams of the wanted nodes.

    A bit table of fixed size (half a MiB) holds which documents they come from, so the other texts aren't shuffled;
    what it lets through by chance goes in the join that follows.
    """
    at = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(FILTER_BITS))
    bit = F.expr("bit_or(shiftleft(1L, cast(p % 64 AS int)))")
    bits = reps.join(nodes, "sid", "left_semi").select(at.alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(bit.alias("bits"))
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in bits.toLocalIterator():
        table[row["at"]] = row["bits"] & 0xFFFFFFFFFFFFFFFF
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_wanted_sets(k, table), "sid long, grams array<long>")
    return written(found.join(nodes, "sid", "left_semi").dropDuplicates(["sid"]))


def _confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Of pairs(a, b) of nodes, those with 100 * intersection >= percent * union of their full sets."""
    n = pairs.count()
    nodes = written(sized(pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct(), n))
    sets = _full_sets(docs, nodes, reps, k)
    left, right = (sets.select(F.col("sid").alias(c), F.col("grams").alias(f"g{c}")) for c in "ab")
    common = F.size(F.array_intersect("ga", "gb"))
    held = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("common", common)
    return held.where(100 * F.col("common") >= percent * (F.size("ga") + F.size("gb") - F.col("common"))).select("a", "b")


def _joins(limit: int, percent: int) -> Callable:
    """Rows: band, ab (pair of blocks), part, sid, comp, packed words, grams; sorted by band and ab. Gives links a, b."""

    def compared(rows: list[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        table = pa.Table.from_batches(rows).combine_chunks()
        ab, part, sid, comp = (table.column(c).to_numpy() for c in ("ab", "part", "sid", "comp"))
        words = np.stack([table.column(f"s{i}").to_numpy() for i in range(WORDS)], axis=1).view(np.uint64)
        lists = table.column("grams").combine_chunks()
        flat, begin = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()  # sorted as unsigned numbers
        sets = [flat[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]
        size = np.diff(begin)
        within = (ab >> 15) == (ab & 0x7FFF)  # nodes of one block meet there alone
        label = np.unique(comp, return_inverse=True)[1]
        for i in range(len(sid) - 1):
            x = words[i] ^ words[i + 1 :]
            differing = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1, dtype=np.int64)
            lengths = 100 * np.minimum(size[i], size[i + 1 :]) >= percent * np.maximum(size[i], size[i + 1 :])
            near = np.flatnonzero((differing <= limit) & lengths & (label[i + 1 :] != label[i]) & (within[i] | (part[i + 1 :] != part[i])))
            for j in (near[np.argsort(differing[near], kind="stable")] + i + 1).tolist():
                if label[j] == label[i]:
                    continue
                at = np.minimum(np.searchsorted(sets[i], sets[j]), size[i] - 1)
                common = int((sets[i][at] == sets[j]).sum())
                if 100 * common >= percent * (size[i] + size[j] - common):
                    label[label == label[j]] = label[i]
                    yield int(sid[i]), int(sid[j])

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(links: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            band, ab = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((band[1:] != band[:-1]) | (ab[1:] != ab[:-1])) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if last is not None and last != (band[lo], ab[lo]):
                    yield given(list(compared(held)))
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = (band[lo], ab[lo])
        if held:
            yield given(list(compared(held)))

    return run


def _across(placed: DataFrame, docs: DataFrame, reps: DataFrame, k: int, limit: int, percent: int) -> DataFrame:
    """Links between components among the nodes of each band, confirmed on full sets."""
    words = [f"s{i}" for i in range(WORDS)]
    sets = _full_sets(docs, written(placed.select("sid").distinct()), reps, k)
    counts = written(placed.groupBy("band").agg(F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("parts")))
    rows = placed.join(counts, "band").withColumn("part", F.expr("cast(pmod(xxhash64(sid), parts) AS int)"))
    pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.least(q, F.col("part")) * 32768 + F.greatest(q, F.col("part")))
    dealt = rows.select("band", F.explode(pair).alias("ab"), "part", "sid", "comp", *words).join(sets, "sid")
    met = dealt.select("band", "ab", "part", "sid", "comp", *words, "grams").repartition(input_partitions(docs.sparkSession), "band", "ab").sortWithinPartitions("band", "ab")
    return met.mapInArrow(_joins(limit, percent), "a long, b long").distinct()


def _rank() -> Column:
    """A row's place among the rows of its component; no part of it is null."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("tag").alias("tag"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """Returns, for every row, doc_id, tag, n_shingles, sid, component_id, kept, first.

    component_id is the least doc_id reachable over links (percent: the least Jaccard similarity, as a hundredth),
    the document itself included; kept where it is the document's own. first: whether the row is its component's first by doc_id (nulls
    last), then tag; rows that are equal in both are first together.
    """
    sign = written(signatures(docs, k).withColumn("row", F.monotonically_increasing_id()))  # numbers that stay, since they're written
    words = [f"s{i}" for i in range(WORDS)]
    reps = written(sign.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.min(_rank()).alias("rank")))
    cards = sign.join(reps.select("row"), "row", "left_semi")  # one row for each set, however often it or its document is given
    entries = cards.select("sid", *words, F.explode("bands").alias("band"))
    several = written(entries.groupBy("band").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low <> high").select("band"))
    shared = written(entries.join(several, "band", "left_semi"))
    rows = shared.count()
    limit = most_mismatches(percent / 100)

    alike = mismatches([F.col(w) for w in words], [F.col(f"t{w}") for w in words]) <= limit
    links, comps, placed = None, None, shared.withColumn("comp", F.col("sid"))
    for turn in range(ROUNDS + 1):
        if turn < ROUNDS:
            first = F.min(F.struct(F.xxhash64("sid", F.lit(turn)), "sid", "comp", *words)).alias("h")
            heads = written(sized(placed.groupBy("band").agg(first), rows).select("band", F.col("h.sid").alias("b"), F.col("h.comp").alias("other"), *[F.col(f"h.{w}").alias(f"t{w}") for w in words]))
            pairs = placed.join(heads, "band").where((F.col("comp") != F.col("other")) & alike)
            more = written(_confirmed(written(sized(pairs.select(F.col("sid").alias("a"), "b").distinct(), rows)), docs, reps, k, percent))
        else:
            more = written(_across(placed, docs, reps, k, limit, percent))
        if links is None or not more.isEmpty():
            links = more if links is None else links.union(more)
            comps = components(links)
        if turn < ROUNDS:
            found = shared.join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
            mixed = found.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("band")
            placed = written(sized(found.join(written(sized(mixed, rows)), "band", "left_semi"), rows))
            if not (rows := placed.count()):
                break
    named = comps.join(reps.withColumnRenamed("sid", "node"), "node")
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.min("rank").alias("least"))
    groups = written(comps.join(least, "comp").select(F.col("node").alias("sid"), "component_id", "least"))
    own = reps.select("sid", F.col("doc_id").alias("first_id"), "rank")
    out = sign.select("doc_id", "tag", "n_shingles", "sid").join(own, "sid", "left").join(groups, "sid", "left")
    out = out.withColumns({"component_id": F.coalesce("component_id", "first_id", "doc_id"), "least": F.coalesce("least", "rank")})
    first = F.col("least").isNull() | (F.col("least") == _rank())
    return out.select("doc_id", "tag", "n_shingles", "sid", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), first.alias("first"))
