"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws the key -ln(u) / w from its own number u, a hash of its id and a seed, and its quality
weight w; the smallest keys come first. The whole passes over a source that its budget holds come first, each
document once a pass; what is left of the budget is filled in the order of the keys.

The order isn't made by sorting a source, which may hold a third of all rows: keys are dealt to bins by their
logarithms, so that weights of any size spread alike, and the tokens of the bins are summed. The bin in which
the budget ends is dealt to bins again, and only the one of these in which it ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from workloom.runtime import cut, small_side

BINS = 16_384
#: Logarithms of keys between which the bins lie; those beyond belong to the first and the last.
_LOW, _HIGH = -120.0, 120.0
#: Frequent function words of English, French and German.
FUNCTION_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "in", "is", "it", "of", "on", "or", "said", "that", "the", "to", "which", "with",
    "au", "aux", "ce", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pour", "que", "qui", "sur", "un", "une",
    "auf", "aus", "das", "dem", "den", "der", "des", "die", "durch", "ein", "eine", "einer", "für", "im", "ist", "mit", "oder", "und", "von", "zu",
)
#: Words of which this share are function words are plain language, and this share of broken characters spoils a text.
_PLAIN, _SPOILT = 0.2, 0.02


def quality_weight(text) -> F.Column:
    """How much a text is plain language, from 0.05 to 1; 0.05 for null, empty and blank texts.

    The geometric mean of three shares, each from 0 to 1: letters and white space among the characters;
    function words among the words (between blanks) against what plain language has of them, 0.1 at least; and 1
    less the broken characters (U+FFFD and control characters) against what spoils a text. Whole texts are read.
    """
    col = F.col(text) if isinstance(text, str) else text
    n = F.length(col)
    kept = F.regexp_replace(col, r"[^\p{L}\s]+", "")
    function_words = sorted({form for word in FUNCTION_WORDS for form in (word, word.capitalize())})
    n_words = n - F.length(F.replace(col, F.lit(" "), F.lit(""))) + 1
    plain = F.least(F.lit(1.0), 0.1 + 0.9 * F.size(F.filter(F.split(col, " ", -1), lambda x: x.isin(function_words))) / n_words / _PLAIN)
    broken = n - F.length(F.regexp_replace(col, r"[\x{FFFD}\x00-\x08\x0E-\x1F\x7F-\x9F]+", ""))
    clean = F.greatest(F.lit(0.0), 1 - broken / n / _SPOILT)
    return F.greatest(F.lit(0.05), F.when(F.trim(col) != "", F.pow(F.length(kept) / n * plain * clean, F.lit(1 / 3))).otherwise(0.0))


def draw(ident: str, seed: int) -> F.Column:
    """A number in (0, 1) from the id and the seed, the same in every run."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(ident)), 11).cast("double") + 0.5) / F.lit(float(2**53))


def _summed(docs: DataFrame) -> DataFrame:
    """source, bin, bin_tokens, before: the tokens of each bin, at most bins rows a source, and of the bins before it."""
    by_bin = docs.groupBy("source", "bin").agg(F.sum("n_tokens").alias("bin_tokens"))
    before = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    return cut(by_bin.withColumn("before", F.coalesce(F.sum("bin_tokens").over(before), F.lit(0))))


def _ends(by_bin: DataFrame, rests: DataFrame) -> DataFrame:
    """rests (source, rest) with end, the bin in which the rest ends (null if all bins fit in it), and before, the tokens before that bin."""
    over = by_bin.join(rests.select("source", "rest"), "source").where(F.col("before") + F.col("bin_tokens") > F.col("rest"))
    return rests.join(over.groupBy("source").agg(F.min("bin").alias("end"), F.min_by("before", "bin").alias("before")), "source", "left")


def _state() -> F.Column:
    return F.when(F.col("bin") == F.col("end"), "part").when(F.col("bin") > F.col("end"), "none").otherwise("all")


def mix(documents: DataFrame, targets: DataFrame, ident: str = "doc_id", source: str = "source", n_tokens: str = "n_tokens", weight: str | None = None, total: int | None = None, seed: int = 7, bins: int = BINS) -> tuple[DataFrame, DataFrame]:
    """(selection, shares) of documents (ident, source, n_tokens, weight) by targets (source, target_share, max_repeats).

    selection: ident, source, n_tokens, copies >= 1, one row per document used. shares: one row per target
    source: target_share, reachable_share (the target among the sources that have tokens), budget, tokens,
    actual_share, n_documents, n_copies, whole_passes.

    total: tokens of the mixture; if None, as many as every source that has tokens can give at its share, with
    no document more than max_repeats times. With a larger total, sources that run out give all they have. Shares
    of sources without tokens are spread over the others in proportion. The last document chosen of a source may
    not exceed its budget, so a source falls short by less than one document at the cut bin's end. Documents
    without tokens, with a null or untargeted source are never used. Documents whose weight is null or not
    positive come last. Ties of keys go by the id.
    """
    aims = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).where("source is not null")
    aims = small_side(cut(aims))
    worth = F.col(weight).cast("double") if weight else F.lit(1.0)
    key = F.when(worth > 0, -F.log(draw(ident, seed)) / worth).otherwise(float("inf"))
    docs = documents.select(F.col(ident).alias("ident"), F.col(source).alias("source"), F.col(n_tokens).alias("n_tokens"), key.alias("key")).where("n_tokens > 0")
    place = (F.log(F.col("key")) - _LOW) / (_HIGH - _LOW) * bins
    docs = docs.withColumn("bin", F.least(F.lit(bins - 1.0), F.greatest(F.lit(0.0), F.floor(place).cast("double"))).cast("int"))
    docs = cut(docs.join(aims.select("source"), "source", "left_semi"))

    by_bin = _summed(docs)
    held = by_bin.groupBy("source").agg(F.sum("bin_tokens").alias("held"))
    plan = aims.join(held, "source", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    every = W.partitionBy(F.lit(1))  # one row per source
    plan = plan.withColumn("reachable_share", F.when(F.col("held") > 0, F.col("target_share") / F.sum(F.when(F.col("held") > 0, F.col("target_share"))).over(every)).otherwise(0.0))
    most = F.min(F.when((F.col("held") > 0) & (F.col("reachable_share") > 0), F.col("held") * F.col("max_repeats") / F.col("reachable_share"))).over(every)
    plan = plan.withColumn("total", F.coalesce(F.lit(total).cast("double"), most, F.lit(0.0)))
    plan = plan.withColumn("budget", F.least(F.floor(F.col("total") * F.col("reachable_share")), F.col("held") * F.col("max_repeats")).cast("long"))
    plan = plan.withColumn("whole_passes", F.when(F.col("held") > 0, F.floor(F.col("budget") / F.col("held"))).otherwise(0).cast("int"))
    plan = small_side(cut(plan.withColumn("rest", F.col("budget") - F.col("whole_passes") * F.col("held"))))

    cuts = small_side(cut(_ends(by_bin, plan.select("source", "rest", "whole_passes"))))
    placed = docs.join(cuts, "source").withColumn("state", _state())
    chosen = placed.where("state <> 'part'").withColumn("extra", (F.col("state") == "all").cast("int"))
    # the bins of the cut ones: of equal width between the least and greatest key there
    part = cut(placed.where("state = 'part'").drop("bin", "end", "state"))
    spans = part.groupBy("source").agg(F.min("key").alias("low"), F.max(F.when(F.col("key") < float("inf"), F.col("key"))).alias("high"))
    spans = small_side(cut(spans))
    fine = F.least(F.lit(bins - 1.0), F.floor((F.col("key") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)) * (bins - 1)).cast("double"))
    part = part.join(spans, "source").withColumn("bin", F.when(F.isnan("key") | (F.col("key") == float("inf")), bins - 1).otherwise(F.coalesce(fine, F.lit(0.0)).cast("int")))
    inner = _ends(_summed(part), part.groupBy("source").agg(F.first(F.col("rest") - F.col("before")).alias("rest")))
    inner = small_side(cut(inner.withColumnRenamed("rest", "left")))
    part = part.drop("before", "rest", "low", "high").join(inner, "source").withColumn("state", _state())
    order = W.partitionBy("source").orderBy("key", "ident").rowsBetween(W.unboundedPreceding, 0)
    chosen = chosen.unionByName(part.where("state <> 'part'").withColumn("extra", (F.col("state") == "all").cast("int")), allowMissingColumns=True)
    last = part.where("state = 'part'").withColumn("extra", (F.col("before") + F.sum("n_tokens").over(order) <= F.col("left")).cast("int"))
    selection = chosen.unionByName(last, allowMissingColumns=True).select("ident", "source", "n_tokens", (F.col("whole_passes") + F.col("extra")).alias("copies")).where("copies > 0")
    selection = cut(selection)

    used = selection.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("n_documents"), F.sum("copies").alias("n_copies"))
    shares = plan.join(used, "source", "left").na.fill(0, ["tokens", "n_documents", "n_copies"])
    shares = shares.withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(every), F.lit(0)), F.lit(0.0)))
    return (
        selection.withColumnRenamed("ident", ident),
        shares.select("source", "target_share", "reachable_share", "max_repeats", "budget", "tokens", "actual_share", "n_documents", "n_copies", "whole_passes"),
    )
