"""Operator 7: benchmark decontamination by item-sized windows, native DataFrame functions only.

Words are runs of letters and digits, lower case. A benchmark item of L words is compared with windows of L words of the documents.
1. Blocking. Similarity is the weighted Jaccard index of five-word shingles, so a window that shares no shingle with any item has
   similarity 0. Each position's shingle hash probes the items' shingles; where a run of shared shingles begins, the alignment
   of that run gives the window, and ``SLACK`` words to either side give its neighbours.
2. Candidates. A window and an item of its length take SimHash fingerprints of their distinct shingles. The radius follows from the
   item: k, the most shingles that can differ on both sides while the weighted similarity holds, bounds the cosine of the two shingle
   sets from below, a bit differs with at most the probability of that angle over pi, and the radius lies four standard deviations and
   one bit above the mean (missed: fewer than 1 in 10,000 windows at the threshold; tests measure it). Items so repetitive
   that the bound says nothing have radius 63. Fingerprints are cut into radius + 1 blocks; two within the radius agree on one block
   at least, so joining on the blocks finds all of them. The join also asks for a common rare shingle: an item's shingles in the order
   of falling weight, until they hold more than ``1 - similarity`` of its weight; a window with none of them lacks too much of
   the item, so this loses nothing, and shingles that very many items share pair nothing.
3. Verification. sum(weight * min(count)) / sum(weight * max(count)) over the shingles of the window and the item, a shingle's weight
   being 1 + ln(items / items with it), and 1 + ln(items) for one that the item does not have; at least ``similarity``.

Only narrow rows (text, position, shingle hash) meet the items' shingles; the windows found are cut from their texts afterwards. Tables
of counted size are broadcast below BROADCAST_ROWS and shuffled beyond; the shuffle grows with the words.

Defined results: null or empty texts and items take no part; repeated items count once, different texts under one item_id each count. An item of fewer than five words has its whole sequence as its one
shingle. A document shorter than an item is compared as one window. Ties between windows go to the earliest. ``n_words`` is the item's length. Rows that
share a doc_id give one row for each item; a null doc_id is a value like any other. Only the id and text columns of both tables
are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revflow.llm.common import unused
from revflow.llm.graph import staged

SHINGLE, SIMILARITY, SLACK = 5, 0.8, 2
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x)


def simhash(hashes: Column, size: Column, field: int) -> Column:
    """The 64-bit majority fingerprint of an array of hashes; ``field`` bits for each counter, so up to 2**(field - 1) - 1 hashes."""
    fields = 64 // field
    ones = sum(1 << field * i for i in range(fields))
    low = sum(((1 << field) - 1) << field * i for i in range(fields - 1))
    tops = sum(1 << field * i + field - 1 for i in range(fields - 1))
    low_ones = sum(1 << field * i for i in range(fields - 1))
    half = F.floor(size / 2).cast("long")
    lift = (F.lit((1 << field - 1) - 1) - half) * F.lit(low_ones)
    out = F.lit(0).cast("long")

    def count_of(k: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(ones)))

    for k in range(field):
        count = count_of(k)
        major = (count.bitwiseAND(F.lit(low)) + lift).bitwiseAND(F.lit(tops))
        last = F.when(F.shiftrightunsigned(count, 64 - field) > half, _signed(1 << 64 - field + k)).otherwise(F.lit(0).cast("long"))
        out = out.bitwiseOR(F.shiftrightunsigned(major, field - 1 - k)).bitwiseOR(last)
    return out


def blocks(fingerprint: str, radius: str) -> Column:
    """Keys (block number and value) of the radius + 1 blocks that cover the 64 bits; two columns' names."""
    first = f"cast(64 * i div ({radius} + 1) as int)"
    width = f"cast(64 * (i + 1) div ({radius} + 1) - 64 * i div ({radius} + 1) as int)"
    return F.expr(f"transform(sequence(0, {radius}), i -> (shiftrightunsigned({fingerprint}, {first}) & (shiftleft(1L, {width}) - 1)) * 64 + i)")


def radius(distinct: Column, both: Column, lost: Column) -> Column:
    """Bits within which two fingerprints of ``distinct`` shingles lie, if at most ``both`` differ on either side, or ``lost`` are missing."""
    cosine = F.greatest(F.lit(0.0), F.least(1 - both / distinct, F.sqrt(F.greatest(F.lit(0.0), 1 - lost / distinct))))
    share = F.acos(cosine) / math.pi
    bits = F.ceil(64 * share + 4 * F.sqrt(64 * share * (1 - share)) + 1)
    return F.when(cosine == 0, F.lit(63)).otherwise(F.least(F.lit(63), bits)).cast("int")


def _shingles(words: Column, q: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - q + 1), lambda i: F.array_join(F.slice(words, i, q), " "))


def _fingerprint(words: Column, q: Column, field: int) -> Column:
    grams = F.transform(F.array_distinct(_shingles(words, q)), lambda g: F.xxhash64(g))
    return simhash(grams, F.size(grams), field)


def _hash(hashes: Column, at: Column, q: int) -> Column:
    return F.xxhash64(F.lit(q), *(F.get(hashes, at + i) for i in range(q)))


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, its words, hashes, length, shingle width and distinct shingles with counts and weights."""
    rows = (items.select(F.col(id_col).cast("long").alias("item_id"), words_of(F.col(text_col)).alias("iw")).filter(F.size("iw") > 0)
            .distinct().withColumn("item", F.xxhash64("item_id", "iw")).withColumn("n", F.size("iw")).withColumn("q", F.least(F.lit(SHINGLE), "n"))
            .withColumn("ih", F.transform("iw", lambda w: F.xxhash64(w))).withColumn("grams", _shingles(F.col("iw"), F.col("q"))))
    df = rows.select(F.explode(F.array_distinct("grams")).alias("g"), "item").distinct().groupBy("g").agg(F.count("*").alias("df"))
    total = rows.agg(F.count("*").alias("total"))
    counts = rows.select("item", F.explode("grams").alias("g")).groupBy("item", "g").agg(F.count("*").cast("int").alias("c"))
    weights = (counts.join(df, "g").join(F.broadcast(total))  # one row
               .groupBy("item").agg(
                   F.sort_array(F.collect_list(F.struct("g", "c", (1 + F.log(F.col("total") / F.col("df"))).alias("w")))).alias("wg"),
                   F.max(1 + F.log("total")).alias("other")))
    return rows.drop("grams").join(weights, "item")


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
            item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, hash of the text, item_id, similarity, word_start, n_words) for every verified window; callers take the best."""
    known = staged(_items(items, item_id, item_text), "items")
    facts = known.agg(F.count("*").alias("rows"), F.max("n").alias("longest"), F.sum(F.col("n") - F.col("q") + 1).alias("grams"),
                      F.collect_set(F.when(F.col("q") < SHINGLE, F.col("q"))).alias("short")).first()
    field = next(f for f in (8, 16, 32) if f == 32 or (facts.longest or 0) < 1 << f - 1)
    small = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_ROWS else df

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    tokens = texts.select("id", F.xxhash64("text").alias("th"), F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("hs"))
    runs = None
    for q in sorted({SHINGLE, *(facts.short or [])}):
        own = known.filter(F.col("q") == q).select("n", "ih", F.posexplode("ih").alias("t", "h")).filter(F.col("t") <= F.col("n") - q)
        own = own.select(_hash(F.col("ih"), F.col("t"), q).alias("g"), "t", "n", F.get("ih", F.col("t") - 1).alias("before")).distinct()
        at = tokens.select("id", "th", "hs", F.posexplode("hs").alias("d", "h0")).filter(F.col("d") <= F.size("hs") - q)
        # the arrays stay behind before anything is joined
        at = at.select("id", "th", F.size("hs").alias("size"), "d", _hash(F.col("hs"), F.col("d"), q).alias("g"), F.get("hs", F.col("d") - 1).alias("last"))
        hit = at.join(small(own, facts.grams or 0), "g")
        begins = (F.col("d") == 0) | (F.col("t") == 0) | (F.col("last") != F.col("before"))
        first = F.explode(F.array(*(F.greatest(F.lit(0), F.least(F.col("d") - F.col("t") + s, F.col("size") - F.col("n")))
                                    for s in range(-SLACK, SLACK + 1))))
        found = hit.filter(begins).select("id", "th", "n", first.alias("p"))
        runs = found if runs is None else runs.unionByName(found)
    places = staged(runs.distinct().groupBy("id", "th", "n").agg(F.collect_set("p").alias("ps")), "places")

    index = known.select("item", "item_id", "iw", "n", "q", "wg", "other", F.aggregate("wg", F.lit(0.0), lambda a, e: a + e["w"] * e["c"]).alias("whole"))
    least = F.array_min(F.transform("wg", lambda e: e["w"]))
    spare = (1 - similarity) * F.col("whole")
    index = index.withColumn("r", radius(F.size("wg"), F.floor(spare / (least + similarity * F.col("other")) + 1e-6), F.floor(spare / least + 1e-6)))
    radii = index.groupBy("n").agg(F.max("r").alias("r"))  # one radius for each length, so that both sides cut alike
    index = index.drop("r").join(radii, "n").withColumn("ifp", _fingerprint(F.col("iw"), F.col("q"), field)).drop("iw")
    index = staged(index, "index")

    # the windows' words are cut from their texts again: what was joined above held positions only
    many = places.count()
    cut = texts.withColumn("th", F.xxhash64("text")).join(
        small(places.withColumnRenamed("id", "at_id").withColumnRenamed("th", "at_th"), many), F.col("id").eqNullSafe(F.col("at_id")) & (F.col("th") == F.col("at_th")))
    cut = cut.select("id", "th", "n", "ps", words_of(F.col("text")).alias("words")).select("id", "th", "n", "words", F.explode("ps").alias("p"))
    windows = cut.select("id", "th", "n", "p", F.slice("words", F.col("p") + 1, F.col("n")).alias("win")).join(small(radii, facts.rows or 0), "n")
    windows = windows.withColumn("fp", _fingerprint(F.col("win"), F.least(F.lit(SHINGLE), "n", F.size("win")), field))
    windows = staged(windows.dropDuplicates(["id", "th", "n", "p"]), "windows")  # staged: what follows reads narrow columns

    weighty = index.select("item", "n", "q", "ifp", "r", "whole", F.explode("wg").alias("e")).select("item", "n", "q", "ifp", "r", "whole", "e.g", "e.c", "e.w")
    heavier = Window.partitionBy("item").orderBy(F.desc("w"), "g").rowsBetween(Window.unboundedPreceding, -1)
    rare = weighty.withColumn("before", F.coalesce(F.sum(F.col("w") * F.col("c")).over(heavier), F.lit(0.0)))
    rare = rare.filter(F.col("before") <= (1 - similarity + 1e-6) * F.col("whole"))  # 1e-6: rounded sums
    rare = rare.select("item", "n", "q", "ifp", "g", F.explode(blocks("ifp", "r")).alias("block"))
    rare = staged(rare, "rare")  # a plain scan on this side lets the skew join split a shingle that very many windows hold
    probes = windows.select("*", F.explode(F.array_distinct(_shingles(F.col("win"), F.least(F.lit(SHINGLE), "n", F.size("win"))))).alias("g"))
    probes = probes.select("id", "th", "n", "p", "fp", "r", "g", F.explode(blocks("fp", "r")).alias("block"))
    close = probes.join(small(rare, 64 * (facts.grams or 0)), ["n", "g", "block"]).filter(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= F.col("r")).select("id", "th", "n", "p", "item", "q").distinct()
    wins = windows.select(F.col("id").alias("at_id"), F.col("th").alias("at_th"), F.col("n").alias("at_n"), F.col("p").alias("at_p"), "win")
    close = close.join(wins, F.expr("id <=> at_id and th = at_th and n = at_n and p = at_p")).select("id", "th", "n", "p", "win", "item", "q")
    # weighted multiset similarity: what the window has of the item, and what it has beyond it, a row for each distinct shingle
    key = ["id", "th", "p", "n", "item"]
    own = close.select(*key, F.explode(_shingles(F.col("win"), F.least(F.col("q"), F.size("win")))).alias("g")).groupBy(*key, "g").agg(F.count("*").alias("o"))
    weights = index.select("item", F.explode("wg").alias("e")).select("item", "e.g", "e.c", "e.w")
    totals = index.select("item", "item_id", "other", "whole")
    scored = own.join(small(weights, facts.grams or 0), ["item", "g"], "left").join(small(totals, facts.rows or 0), "item")
    both = F.coalesce(F.col("w") * F.least("o", "c"), F.lit(0.0))
    beyond = F.coalesce(F.col("w") * F.greatest(F.col("o") - F.col("c"), F.lit(0)), F.col("o") * F.col("other"))
    sums = scored.groupBy(*key).agg(F.sum(both).alias("both"), F.sum(beyond).alias("beyond"), F.max("whole").alias("whole"), F.max("item_id").alias("item_id"))
    sims = sums.withColumn("similarity", F.round(F.col("both") / (F.col("whole") + F.col("beyond")), 9))
    return sims.filter(F.col("similarity") >= similarity).select("id", "th", "item_id", "similarity", F.col("p").alias("word_start"), F.col("n").alias("n_words"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """(doc_id, item_id, similarity, word_start, n_words): each document's best window for each item that it holds."""
    best = F.max(F.struct("similarity", (-F.col("word_start")).alias("s"), "n_words"))
    found = matches(docs, items, id_col, **how).groupBy(F.col("id").alias("doc_id"), "item_id").agg(best.alias("b"))
    return found.select("doc_id", "item_id", "b.similarity", (-F.col("b.s")).alias("word_start"), "b.n_words")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    a = unused(docs, "hit_id")
    b = unused(docs, "hit_text")
    gone = matches(docs, items, id_col, text_col, **how).select(F.col("id").alias(a), F.col("th").alias(b)).distinct()
    return docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col(a)) & (F.xxhash64(F.col(text_col)) == F.col(b)), "left_anti")
