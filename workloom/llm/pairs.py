"""Items that appear together: pair counts, lift and pointwise mutual information over baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.runtime import cut, small_side

#: Distinct items up to which all pairs of a basket are made from one array; larger baskets go by blocks.
BASKET_ITEMS = 2_000


def _upper_pairs(sets: DataFrame) -> DataFrame:
    """(a, b) with a <= b of each sorted array in items; (a, a) carries the marginal count of a."""
    firsts = sets.select(F.posexplode("items").alias("at", "a"), "items")
    return firsts.select("a", F.explode(F.expr("slice(items, at + 1, size(items) - at)")).alias("b"))


def _small_baskets(rows: DataFrame) -> DataFrame:
    return _upper_pairs(rows.groupBy("basket").agg(F.sort_array(F.collect_set("item")).alias("items")))


def _large_baskets(rows: DataFrame, largest: int, limit: int) -> DataFrame:
    """Pairs of baskets too large for one array: the basket's items are dealt to blocks, and each pair of
    blocks is a basket of its own, of at most about limit items."""
    blocks = max(2, -(-2 * largest // limit))
    dealt = rows.distinct().withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    beside = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keyed = beside.select("basket", "item", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    own = keyed.where("low = high").groupBy("basket", "low", "high").agg(F.sort_array(F.collect_list("item")).alias("items"))
    across = (
        keyed.where("low < high").groupBy("basket", "low", "high")
        .agg(F.collect_list(F.when(F.col("block") == F.col("low"), F.col("item"))).alias("l"), F.collect_list(F.when(F.col("block") == F.col("high"), F.col("item"))).alias("h"))
        .select(F.explode("l").alias("x"), "h").select("x", F.explode("h").alias("y"))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )
    return _upper_pairs(own).unionByName(across)


def pair_counts(rows: DataFrame, basket: str, item: str, basket_items: int = BASKET_ITEMS, items_bound: int | None = None) -> DataFrame:
    """a, b, n: in how many baskets both items occur, for a <= b; (a, a) has the baskets of a.

    Repeated items of a basket count once; rows with a null basket or item count nowhere. A hot basket's
    repeats vanish in the map-side part of the aggregation. items_bound: a proven bound of the number of
    distinct items, if there is one; without a bound under basket_items, the basket sizes are looked up first.
    """
    clean = rows.select(F.col(basket).alias("basket"), F.col(item).alias("item")).where("basket is not null and item is not null")
    if items_bound is not None and items_bound <= basket_items:
        pairs = _small_baskets(clean)
    else:
        sizes = clean.distinct().groupBy("basket").agg(F.count(F.lit(1)).alias("size"))
        large = cut(sizes.where(F.col("size") > basket_items))
        largest = large.agg(F.max("size")).first()[0]
        if largest is None:
            pairs = _small_baskets(clean)
        else:
            hot = small_side(large.select("basket"))
            pairs = _small_baskets(clean.join(hot, "basket", "left_anti")).unionByName(_large_baskets(clean.join(hot, "basket", "left_semi"), largest, basket_items))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def cooccurrence(rows: DataFrame, basket: str, item: str, vocabulary: DataFrame | None = None, vocabulary_item: str | None = None, min_count: int = 1, basket_items: int = BASKET_ITEMS) -> DataFrame:
    """item_a, item_b (item_a < item_b), n_ab, n_a, n_b, n_baskets, lift, pmi of the pairs in at least min_count baskets.

    lift = n_ab * n_baskets / (n_a * n_b), pmi = log2(lift). n_baskets counts the distinct non-null baskets of
    all rows, also those without any item of the vocabulary. vocabulary: items outside it are left out; null
    items never count. An empty table gives no rows. Further columns of rows are ignored.
    """
    bound, kept = None, rows.select(basket, item)
    if vocabulary is not None:
        items = vocabulary.select(F.col(vocabulary_item or item).alias(item)).where(F.col(item).isNotNull()).distinct()
        bound = items.limit(basket_items + 1).count()
        kept = kept.join(F.broadcast(items) if bound <= basket_items else items, item, "left_semi")
    counts = cut(pair_counts(kept, basket, item, basket_items, bound))
    n_baskets = rows.agg(F.countDistinct(basket)).first()[0]
    single = counts.where("a = b")
    left = small_side(single.select(F.col("a").alias("item_a"), F.col("n").alias("n_a")))
    right = small_side(single.select(F.col("a").alias("item_b"), F.col("n").alias("n_b")))
    pairs = counts.where((F.col("a") < F.col("b")) & (F.col("n") >= min_count)).select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), F.col("n").alias("n_ab"))
    joined = pairs.join(left, "item_a").join(right, "item_b").withColumn("n_baskets", F.lit(n_baskets).cast("long"))
    lift = F.col("n_ab").cast("double") * F.col("n_baskets") / (F.col("n_a").cast("double") * F.col("n_b"))
    return joined.select("item_a", "item_b", "n_ab", "n_a", "n_b", "n_baskets", lift.alias("lift"), F.log2(lift).alias("pmi"))
