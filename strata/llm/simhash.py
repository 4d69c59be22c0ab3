"""Document fingerprints: SimHash, in DataFrame functions only.

Terms are pairs of consecutive words (a text of one word has that word), each as often as it occurs.
Every occurrence votes on each of ``BITS`` bits with the sign of that bit of its hash; a fingerprint's
bit is set if more than half of the votes are for it. Votes are counted two bits at a time (a long
holds two 32-bit counters: ``(hash >> i) & 0x100000001``), so a fingerprint is 64 sums in one
code-generated aggregate over the exploded terms, without a function per bit and word.

``neighbours`` finds all fingerprints within a Hamming radius r by block tables: the bits are cut into
blocks of about 18, a table each, and block i is given f_i flips, where the sum of f_i + 1 is r + 1; of two
fingerprints within r bits at least one block differs by its flips at most. A fingerprint is once in each
table, under the block's value; a query looks up its own value with up to f_i bits flipped. A pair counts
in the first block in which it meets, and all bits confirm it. Fingerprints under one value travel in
arrays of about ``CHUNK``, so that a group of near copies is counted in its arrays, without a row for each pair.

``RADIUS`` bits stand for a cosine of cos(pi * 18 / 128) = 0.90 between the pair counts of two texts, which is
one word in 20 replaced (each is in two pairs); distances scatter by about 4 bits around that.

Cases: NULL and empty texts, and texts of separators only, have no votes and the fingerprint 0; equal
texts have equal fingerprints; rows with the same id and text are one document in the order of
documents, and each a row of the result; a NULL id comes last; a lone document is its own next.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import attach_scalar
from strata.operators.keys import global_sequence
from strata.session import cut_lineage

from .exchange import named, written

#: Bits of a fingerprint (two longs).
BITS = 128
RADIUS = 18
#: Fingerprints of one array in a table, about.
CHUNK = 1024
#: White space between words.
_SPACE = r" \t\n\x0B\f\r"
_PAIR_OF_COUNTERS = 0x0000000100000001


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, high, low): the fingerprint of each key's text, as two longs.

    If the input is already dealt by some of the keys, nothing is shuffled; else votes are counted
    where the texts are, and one row of counters for each key and task goes to the shuffle."""
    words = F.split(F.btrim(named(text_col), F.lit(" \t\n\x0b\f\r")), f"[{_SPACE}]+")
    words = texts.select(*keys, words.alias("words"))
    pairs = words.select(*keys, F.posexplode(F.arrays_zip(F.col("words").alias("a"), F.expr("slice(words, 2, greatest(size(words) - 1, 0))").alias("b"))).alias("place", "pair"))
    # the first row of a text stays even if it is no term, so that every key has a fingerprint
    terms = pairs.where("pair.b IS NOT NULL OR place = 0").select(*keys, F.when(F.col("pair.a") != "", F.xxhash64("pair.a", "pair.b")).alias("h0"))
    terms = terms.select(*keys, "h0", F.when(F.col("h0").isNotNull(), F.xxhash64("h0")).alias("h1"))
    counts = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_PAIR_OF_COUNTERS))).alias(f"{h}_{i}") for h in ("h0", "h1") for i in range(32)]
    votes = terms.groupBy(*keys).agg(F.count("h0").alias("votes"), *counts)

    def fingerprint(h: str) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            for bit, count in ((i, F.col(f"{h}_{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(f"{h}_{i}", 32))):
                out = out.bitwiseOR(F.when(2 * count > F.col("votes"), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
        return out

    return votes.select(*keys, fingerprint("h0").alias("high"), fingerprint("h1").alias("low"))


def shown(high: Column, low: Column) -> Column:
    """32 hexadecimal digits."""
    part = lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")
    return F.concat(part(high), part(low))


def distance(high: Column, low: Column, other_high: Column, other_low: Column) -> Column:
    return F.bit_count(high.bitwiseXOR(other_high)) + F.bit_count(low.bitwiseXOR(other_low))


def likeness(*of: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(*of) / F.lit(float(BITS))


def _blocks(radius: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, flips) of each block; blocks with no flips left (-1) are not searched."""
    n = max(3, -(-(radius + 1) // 3))
    each, more = divmod(radius + 1, n)
    cut = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a, each + (i < more) - 1) for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False))]


def _masks(size: int, flips: int) -> Column:
    """An array of all numbers of that many bits of which at most ``flips`` are set."""
    masks = [sum(1 << x for x in bits) for f in range(flips + 1) for bits in combinations(range(size), f)]
    return F.expr(f"array({', '.join(f'{m}L' for m in masks)})")


def _bits(high: Column, low: Column, first: int, size: int) -> Column:
    """Some bits in a row, as a long; bit 0 is the lowest of low."""
    if size >= 64:
        raise ValueError("a block holds fewer than 64 bits: cut the bits into more blocks")
    mask = F.lit((1 << size) - 1)
    if first >= 64:
        return F.shiftrightunsigned(high, first - 64).bitwiseAND(mask)
    if first + size <= 64:
        return F.shiftrightunsigned(low, first).bitwiseAND(mask)
    return F.shiftrightunsigned(low, first).bitwiseOR(F.shiftleft(high, 64 - first)).bitwiseAND(mask)


def _met(queries: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """(high, low, near): for distinct fingerprints among the queries, arrays of the other distinct ones of
    ``prints`` within the radius; each of these is in one array."""
    blocks = [(t, *b) for t, b in enumerate(_blocks(radius)) if b[2] >= 0]
    high, low = F.col("high"), F.col("low")
    key = lambda t, value: value.bitwiseOR(F.lit(t << 48)).alias("key")  # noqa: E731  blocks have 43 bits at most

    distinct = cut_lineage(prints.select("high", "low").distinct())
    own = distinct.select("high", "low", F.explode(F.array(*[key(t, _bits(high, low, first, size)) for t, first, size, _ in blocks])).alias("key"))
    many = written(own.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK))
    chunk = F.coalesce(F.pmod(F.xxhash64("high", "low"), F.ceil(F.col("n") / CHUNK)), F.lit(0).cast("long")).alias("chunk")
    tables = own.join(many, "key", "left").select("key", chunk, F.struct("high", "low").alias("print")).groupBy("key", "chunk").agg(F.collect_list("print").alias("prints"))

    rows = [F.struct(key(t, _bits(high, low, first, size)).alias("value"), _masks(size, flips).alias("masks")) for t, first, size, flips in blocks]
    asked = queries.select("high", "low").distinct().select("high", "low", F.inline(F.array(*rows)))
    asked = asked.select("high", "low", F.explode("masks").alias("mask"), "value").select("high", "low", F.col("value").bitwiseXOR(F.col("mask")).alias("key"))

    def near(x: Column) -> Column:
        apart = x["high"].bitwiseXOR(high), x["low"].bitwiseXOR(low)
        bits = F.bit_count(apart[0]) + F.bit_count(apart[1])
        first_met = F.coalesce(*[F.when(F.bit_count(_bits(*apart, first, size)) <= flips, F.lit(t)) for t, first, size, flips in blocks])
        return (bits <= radius) & (bits > 0) & (first_met == F.shiftrightunsigned(asked["key"], 48))

    # Spark takes what is asked for as small as before the flips, and would broadcast it
    both = asked.hint("merge").join(tables, (asked["key"] == tables["key"]) & F.exists("prints", near))
    return both.select("high", "low", F.filter("prints", near).alias("near"))


def neighbours(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(high, low, other_high, other_low, bits): for each distinct fingerprint among the queries, all
    other distinct ones of ``prints`` within the radius."""
    both = _met(queries, prints, radius).select("high", "low", F.explode("near").alias("near"))
    both = both.select("high", "low", F.col("near.high").alias("other_high"), F.col("near.low").alias("other_low"))
    return both.withColumn("bits", distance(*[F.col(c) for c in both.columns]))


def n_neighbours(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(high, low, n): how many rows ``neighbours`` has for a fingerprint, if any."""
    return _met(queries, prints, radius).groupBy("high", "low").agg(F.sum(F.size("near")).alias("n"))


def next_of(docs: DataFrame) -> DataFrame:
    """(k1, k2, n, next_k1, next_k2) of distinct (k1, k2): the next document in descending order of ids,
    and the first after the last. docs: (k0, k1, k2, n), where k0 is the id."""
    numbered = global_sequence(docs.select("k0", "k1", "k2", "n").distinct(), ["k0", "k2"], out="seq")
    last = numbered.agg(F.max("seq").alias("last"))
    after = numbered.select(F.col("seq").alias("at"), F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"))
    wanted = attach_scalar(numbered, last).select("k1", "k2", "n", F.when(F.col("seq") == 1, F.col("last")).otherwise(F.col("seq") - 1).alias("at"))
    return wanted.join(after, "at").drop("at")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next), where the edited text has its last third replaced by the beginning of the next document.

    Documents are shuffled once; beginnings of the next ones (a third of a text at most) go to them."""
    text = F.coalesce(named(text_col), F.lit(""))
    base = docs.select(named(id_col).alias("k0"), F.coalesce(named(id_col).cast("long"), F.lit(0)).alias("k1"), F.xxhash64(named(id_col).cast("long"), text).alias("k2"), text.alias("text"))
    counted = base.select("k0", "k1", "k2", F.char_length("text").cast("long").alias("n")).groupBy("k0", "k1", "k2", "n").agg(F.count("*").alias("copies"))
    order = next_of(counted)
    # each document gives the beginning that the one before it needs
    given = order.select(F.col("next_k1").alias("k1"), F.col("next_k2").alias("k2"), F.col("k1").alias("to1"), F.col("k2").alias("to2"), F.expr("cast(floor(n / 3) AS int)").alias("need"))
    plain = base.select("k1", "k2", "text")
    heads = plain.join(given, ["k1", "k2"]).select(F.col("to1").alias("k1"), F.col("to2").alias("k2"), F.expr("substring(text, 1, need)").alias("head")).dropDuplicates(["k1", "k2"])
    both = plain.join(heads, ["k1", "k2"]).select("k1", "k2", "text", F.expr("concat(substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) AS int)), head)").alias("edited"))
    versions = both.select("k1", "k2", F.explode(F.array(F.struct(F.lit(0).alias("version"), F.lit(None).cast("binary").alias("sha"), F.col("text")), F.struct(F.lit(1).alias("version"), F.unhex(F.sha2("edited", 256)).alias("sha"), F.col("edited").alias("text")))).alias("v")).select("k1", "k2", "v.*")
    prints = fingerprints(versions, ["k1", "k2", "version", "sha"])
    of = lambda version, c: F.max(F.when(F.col("version") == version, F.col(c))).alias(f"{c}_{version}")
    prints = cut_lineage(prints.groupBy("k1", "k2").agg(of(0, "high"), of(0, "low"), of(1, "high"), of(1, "low"), of(1, "sha")))
    following = prints.select(F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"), F.col("high_0").alias("next_high"), F.col("low_0").alias("next_low"))
    out = counted.join(order.drop("n"), ["k1", "k2"]).join(prints, ["k1", "k2"]).join(following, ["next_k1", "next_k2"])
    here = F.col("high_0"), F.col("low_0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.col("k0").alias("id"),
        F.col("n").alias("n_chars"),
        F.lower(F.hex("sha_1")).alias("edited_sha256"),
        shown(*here).alias("fingerprint"),
        shown(F.col("high_1"), F.col("low_1")).alias("edited_fingerprint"),
        likeness(*here, F.col("high_1"), F.col("low_1")).alias("near_edited"),
        likeness(*here, F.col("next_high"), F.col("next_low")).alias("near_next"),
        F.col("high_0").alias("high"),
        F.col("low_0").alias("low"),
    )


#: Documents whose ids this divides are the queries of the search.
QUERY_IDS = 50


def op6_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and n_within: for documents whose id is divisible by 50 the number of other
    fingerprints within the radius, found by the block tables (NULL for the others)."""
    made = cut_lineage(edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    queries = made.where(F.col("id") % QUERY_IDS == 0)
    found = n_neighbours(queries, made)
    within = F.when(F.col("id") % QUERY_IDS == 0, F.coalesce("n", F.lit(0).cast("long"))).alias("n_within")
    columns = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return made.join(found, ["high", "low"], "left").select(F.col("id").alias("doc_id"), *columns, within)
