"""SimHash fingerprints with DataFrame functions alone.

Terms are runs of up to three words from every word on (lower-cased, split at ASCII white space); a term weighs as much
as it occurs. Each occurrence votes on 64 signed bits of its hash. Votes are sums of packed words: bit i of the hash is
counted in the low half and bit i+32 in the high half of one long, so 32 sums hold 64 counters, and they combine on the
map side: one row per text is shuffled, however long it is. A bit is set where more than half of the votes are for it.

Null and empty texts have no terms and the fingerprint 0. A tie is no majority. Equal texts have equal fingerprints.

`near` finds all pairs within a Hamming radius by permuted block tables: with radius r the 64 bits are cut into 2r blocks
and each choice of r of them is a table keyed by these blocks, since r differing bits leave r blocks alike. `neighbours` counts, for
the fingerprints of a stated query set, all others within the radius: the queries' keys meet all fingerprints' in one equi-join, whose
condition holds the distance, so that pairs that are too far leave no row; adaptive execution splits a crowded key.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import input_partitions, text_or_empty, written

SHINGLE = 3
PAIR = 0x0000000100000001
FIRST = -(1 << 63)


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """texts(keys.., words: array<string>) -> keys.., bits: the fingerprint as a long. The keys name a text."""
    gram = lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, SHINGLE)])
    votes = texts.select(*keys, F.explode_outer(F.transform("words", gram)).alias("term"))
    packed = [F.sum(F.shiftrightunsigned("term", i).bitwiseAND(F.lit(PAIR))).alias(f"v{i}") for i in range(32)]
    counted = votes.groupBy(*keys).agg(F.count("term").alias("n"), *packed)
    low = [F.when(2 * F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)) > F.col("n"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(0) for i in range(32)]
    high = [F.when(2 * F.shiftrightunsigned(f"v{i}", 32) > F.col("n"), F.shiftleft(F.lit(1).cast("long"), i + 32)).otherwise(0) for i in range(32)]
    bits = low[0]
    for bit in (*low[1:], *high):
        bits = bits.bitwiseOR(bit)
    return counted.select(*keys, bits.alias("bits"))


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def as_text(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


RADIUS = 3
#: Which rows of a corpus ask for their neighbours.
EVERY = 20


def tables(radius: int) -> Column:
    """t and key of `bits` in each block table."""
    blocks = 2 * radius
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("bits").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)]))


def _met(left: DataFrame, right: DataFrame, radius: int, which: Column) -> DataFrame:
    keyed = lambda rows, name: rows.select("bits", tables(radius).alias("k")).select(F.col("bits").alias(name), "k.t", "k.key")
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    a, b = keyed(left, "a"), keyed(right, "b").withColumnsRenamed({"t": "u", "key": "of"}).hint("merge")  # nothing bounds either side
    return a.join(b, (F.col("t") == F.col("u")) & (F.col("key") == F.col("of")) & which & (distance <= radius)).select("a", "b", distance.alias("distance")).distinct()


def near(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """prints(bits) -> a, b, distance: all pairs of different fingerprints within the radius, a < b, each once."""
    rows = written(prints.select("bits").where("bits is not null").distinct())
    return _met(rows, rows, radius, F.col("a") < F.col("b"))


def neighbours(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """prints(bits), queries(bits) -> bits, n_near: how many other different fingerprints lie within the radius of each different query that has any."""
    every, asked = (written(x.select("bits").where("bits is not null").distinct()) for x in (prints, queries))
    return _met(asked, every, radius, F.col("a") != F.col("b")).groupBy(F.col("a").alias("bits")).agg(F.count("*").alias("n_near"))


def _rank(bounds: list[int], key: Column) -> Column:
    """How many of the ascending bounds are at most the key, in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = int(len(bounds) ** 0.5) + 1
    parts = [bounds[a : a + step] for a in range(0, len(bounds), step)]
    reached = lambda values: F.size(F.filter(values, lambda b: b <= key))
    longs = lambda values: F.array(*[F.lit(b).cast("long") for b in values])
    part = reached(longs([p[0] for p in parts]))
    return F.when(part == 0, 0).otherwise((part - 1) * step + reached(F.get(F.array(*[longs(p) for p in parts]), part - 1)))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, bucket, place, late, next: the next row's text by ascending doc_id, the first row's after the last.

    Ranges of doc_id are the window's partitions, as many as a shuffle has. Their bounds are ids that occur, so the row
    that follows a range is found by its id: a copy of it closes the range (late = 1). No task holds all rows.
    Rows with equal doc_id are ordered by their text's hash; a null doc_id comes first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("k", F.coalesce("doc_id", F.lit(FIRST)))
    n = input_partitions(docs.sparkSession)
    cuts = rows.agg(F.min("k").alias("first"), F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10_000).alias("at")).first()
    if cuts["first"] is None:
        bounds, first = [], FIRST
    else:
        first, bounds = cuts["first"], sorted({*cuts["at"]} - {cuts["first"]})
    real = rows.withColumn("bucket", _rank(bounds, F.col("k"))).withColumn("late", F.lit(0))
    ghosts = real.where(F.col("k").isin([first, *bounds])).withColumn("bucket", F.when(F.col("bucket") == 0, len(bounds)).otherwise(F.col("bucket") - 1)).withColumn("late", F.lit(1))
    order = Window.partitionBy("bucket").orderBy("late", "k", F.xxhash64("text"))
    return real.unionByName(ghosts).withColumns({"place": F.row_number().over(order), "next": F.lead("text").over(order)}).drop("k")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter of code points replaced by the first as many of the following one."""
    n = F.char_length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and n_near of every row.

    n_near: how many other different fingerprints of the table lie within RADIUS bits, for rows whose doc_id EVERY divides; else null.
    """
    rows = with_next(docs).withColumn("edited", F.when(F.col("late") == 0, edited(F.col("text"), F.col("next"))))
    keys = ["bucket", "place", "late", "doc_id", "n_chars", "sha", "side"]
    facts = rows.select("bucket", "place", "late", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("sha"), F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("of")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("of"))).alias("both"))
    texts = facts.select(*keys[:-1], F.explode("both").alias("one")).where("one.of is not null").select(*keys[:-1], "one.side", word_array(F.col("one.of")).alias("words"))
    prints = fingerprints(texts, keys)
    row = prints.groupBy("bucket", "place").agg(F.min("late").alias("late"), F.min("doc_id").alias("doc_id"), F.min("n_chars").alias("n_chars"), F.max("sha").alias("sha"), F.max(F.when(F.col("side") == 0, F.col("bits"))).alias("own"), F.max(F.when(F.col("side") == 1, F.col("bits"))).alias("other"))
    order = Window.partitionBy("bucket").orderBy("place")
    out = written(row.withColumn("next", F.lead("own").over(order)).where("late = 0").select("doc_id", "n_chars", "sha", "own", "other", "next"))
    asks = F.col("doc_id") % EVERY == 0
    counts = neighbours(out.select(F.col("own").alias("bits")), out.where(asks).select(F.col("own").alias("bits")))
    asked = out.where(asks).join(counts, F.col("own") == F.col("bits"), "left").withColumn("n_near", F.coalesce("n_near", F.lit(0))).drop("bits")
    out = asked.unionByName(out.where(~F.coalesce(asks, F.lit(False))).withColumn("n_near", F.lit(None).cast("long")))
    return out.select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"), "n_near")
