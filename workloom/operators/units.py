"""Pay amounts written in different units and scales, converted to dollars per hour.

Units and scales that are written are read from the text. Amounts without any written unit get one from a
random forest, trained on the written ones, whose confidence is calibrated by isotonic regression on rows
held out; confident units are converted, the others are left for review.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.runtime import cut, small_side

#: Labelled rows at most from which the classifier is fitted and calibrated.
TRAINING_ROWS = 40_000
#: Calibrated confidence from which a predicted unit is used.
CONFIDENT = 0.9
TREES, DEPTH = 20, 8
#: Units at most in the lookup table; they are the classes of the classifier.
MOST_UNITS = 100

#: How base units and scales are written, looked for in this order, in lower case.
UNIT_WORDS = (
    ("HOUR", r"hour|\bhrs?\b|heure|/ ?h\b"),
    ("BIWEEK", r"bi-?\s?we?e?k|(?:two|2) weeks|fortnight|deux semaines"),
    ("WEEK", r"week|\bwk\b|semaine|hebdo"),
    ("DAY", r"\bday|daily|\bjour"),
    ("MONTH", r"month|\bmo\b|\bmois\b|mensuel"),
    ("YEAR", r"year|\byr\b|\bannu|\bans?\b|\bp\.a\b|\bannum\b"),
)
THOUSANDS = r"thousand|000s|x ?1000|k ?\$|\bk\b|(?<=[0-9])k\b|milliers"
CENTS = r"¢|\bcents?\b|\bc\b|(?<=[0-9])c\b"

_NUMBER = r"[0-9]{1,3}(?:[ ,][0-9]{3})+(?:[.,][0-9]+)?(?![0-9])|[0-9]+(?:[.,][0-9]+)?"
#: White space other than a blank.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def plain_text(text: Column) -> Column:
    """In lower case and trimmed, each run of white space one blank."""
    return F.lower(F.trim(F.regexp_replace(F.translate(text, _BLANKS, " " * len(_BLANKS)), r" {2,}", " ")))


def first_number(text: Column) -> Column:
    """The first number of the text as it is written; empty if there is none."""
    return F.regexp_extract(text, _NUMBER, 0)


def amount_of(number: Column) -> Column:
    """The value of a number; a comma or blank before exactly three digits groups, another comma is a decimal one."""
    bare = F.replace(number, F.lit(" "), F.lit(""))
    grouped = F.when(F.contains(bare, F.lit(",")), F.regexp_replace(F.regexp_replace(bare, r",(?=[0-9]{3}(?:[.,]|$))", ""), ",", ".")).otherwise(bare)
    return grouped.try_cast("double")


def read_amount(text: Column) -> Column:
    return amount_of(first_number(text))


def _base(phrase: Column) -> Column:
    """The unit written in the phrase, whatever its scale."""
    base = F.lit(None).cast("string")
    for code, words in reversed(UNIT_WORDS):
        base = F.when(phrase.rlike(words), code).otherwise(base)
    return F.when(phrase.rlike(r"[^0 $]"), base)


def _scaled(base: Column, phrase: Column) -> Column:
    """The code of the unit with the scale written in the phrase; null for a scale that the unit doesn't have."""
    thousands, cents = phrase.rlike(THOUSANDS), phrase.rlike(CENTS)
    plain = F.when(~thousands & ~cents, base)
    return F.when(base == "HOUR", F.when(cents, "CENTHOUR").otherwise(plain)).when(base.isin("YEAR", "MONTH"), F.when(thousands, F.concat(F.lit("K"), base)).otherwise(plain)).when(base.isNotNull(), plain)


def read_unit(phrase: Column) -> Column:
    """The code of the unit and scale written in the phrase, null if there is none."""
    return _scaled(_base(phrase), phrase)


def beside_amount(text: Column, number: Column) -> Column:
    """What stands beside the first number, without signs of currency, a digit kept in front of a scale that is glued to it."""
    at = F.instr(text, number)
    before = F.substring(text, F.lit(1), at - 1)
    ahead = F.when(before != "", F.regexp_replace(before, r"(?:cad|\$|c\$|\s)+$", "")).otherwise(before)
    return F.replace(F.concat(ahead, F.lit("0"), F.substring(text, at + F.length(number), F.length(text))), F.lit("cad"), F.lit(""))


def _features(long: DataFrame) -> DataFrame:
    log = lambda c: F.coalesce(F.log10(F.when(F.col(c) > 0, F.col(c))), F.lit(-3.0))
    digit = lambda c, n: F.coalesce(F.regexp_extract(c, rf"^([0-9]{{{n}}})", 1).try_cast("double"), F.lit(-1.0))
    bucket = lambda c: F.pmod(F.xxhash64(F.coalesce(c, F.lit(""))), F.lit(32)).cast("double")
    cents = F.round(F.pmod(F.col("amount") * 100, F.lit(100.0)))
    return long.withColumns({
        "f_amount": log("amount"), "f_other": log("other_amount"), "f_ratio": log("amount") - log("other_amount"),
        "f_cents": F.coalesce((cents != 0).cast("double"), F.lit(-1.0)),
        "f_round": F.coalesce((F.pmod(F.col("amount"), F.lit(50.0)) == 0).cast("double"), F.lit(-1.0)),
        "f_major": digit("category", 1), "f_minor": digit("category", 2), "f_kind": bucket(F.col("kind")), "f_source": bucket(F.col("source")),
    })


_FEATURES = ["f_amount", "f_other", "f_ratio", "f_cents", "f_round", "f_major", "f_minor", "f_kind", "f_source"]


def written_units(postings: DataFrame, row_id: str, minimum: str, maximum: str, per: str, category: str, kind: str, source: str) -> DataFrame:
    """One row per amount: row_id, amount_field, amount, unit_code and assigned_by (amount, salary_per, other_amount or null)."""
    told = ((category, "category"), (kind, "kind"), (source, "source"))
    sides = (("low", minimum), ("high", maximum))
    kept = ["row_id", *(n for _, n in told)]
    # a projection for each step: what is used more than once is worked out once
    texts = postings.select(F.col(row_id).alias("row_id"), *(F.col(c).cast("string").alias(n) for c, n in told), plain_text(F.col(per)).alias("per"), *(plain_text(F.col(c)).alias(n) for n, c in sides))
    numbers = texts.select(*kept, "per", *(n for n, _ in sides), _base(F.col("per")).alias("per_base"), *(first_number(F.col(n)).alias(f"{n}_number") for n, _ in sides))
    amounts = numbers.select(*kept, "per", "per_base", *(amount_of(F.col(f"{n}_number")).alias(f"{n}_amount") for n, _ in sides), *(F.when(F.col(f"{n}_number") != "", beside_amount(F.col(n), F.col(f"{n}_number"))).alias(f"{n}_phrase") for n, _ in sides))
    bases = amounts.select(*kept, "per", "per_base", *(f"{n}_{x}" for n, _ in sides for x in ("amount", "phrase")), *(_base(F.col(f"{n}_phrase")).alias(f"{n}_base") for n, _ in sides))
    read = bases.select(*kept, _scaled(F.col("per_base"), F.col("per")).alias("per_unit"), *(F.struct(F.col(f"{n}_amount").alias("amount"), F.when(F.col(f"{n}_amount").isNotNull(), _scaled(F.col(f"{n}_base"), F.col(f"{n}_phrase"))).alias("unit")).alias(n) for n, _ in sides))
    both = F.explode(F.array(F.struct(F.lit("minimum").alias("field"), F.col("low").alias("own"), F.col("high").alias("other")), F.struct(F.lit("maximum").alias("field"), F.col("high").alias("own"), F.col("low").alias("other")))).alias("x")
    long = read.select(*kept, "per_unit", both).where("x.own.amount is not null")
    own, other = F.col("x.own.unit"), F.col("x.other.unit")
    return long.select(
        *kept, F.col("x.field").alias("amount_field"), F.col("x.own.amount").alias("amount"), F.col("x.other.amount").alias("other_amount"),
        F.coalesce(own, "per_unit", other).alias("unit_code"),
        F.when(own.isNotNull(), "amount").when(F.col("per_unit").isNotNull(), "salary_per").when(other.isNotNull(), "other_amount").alias("assigned_by"),
    )


def to_hourly(postings: DataFrame, units: DataFrame, row_id: str = "row_id", minimum: str = "salary_minimum", maximum: str = "salary_maximum", per: str = "salary_per", category: str = "noc21_code", kind: str = "employment_type", source: str = "province_territory", training_rows: int = TRAINING_ROWS, confident: float = CONFIDENT) -> DataFrame:
    """row_id, amount_field, amount, unit_code, assigned_by, confidence, hourly: one row per amount of postings.

    units: unit_code, hours_per_unit, dollars_per_amount. Fields without a number give no row. assigned_by is
    amount, salary_per or other_amount for written units, in this order of precedence; predicted for units
    of the classifier with a calibrated confidence of at least confident; review for the others, whose
    unit_code and hourly are null. Written units that units doesn't have go to review too. The classifier is
    fitted on at most about training_rows labelled amounts, drawn by a hash of the row id; with fewer than 50
    labelled amounts or a single unit nothing is predicted.
    """
    codes = [r[0] for r in units.select("unit_code").distinct().orderBy("unit_code").limit(MOST_UNITS + 1).collect()]
    if len(codes) > MOST_UNITS:
        raise ValueError(f"more than {MOST_UNITS} units")
    rates = units.groupBy("unit_code").agg(F.min("hours_per_unit").alias("hours_per_unit"), F.min("dollars_per_amount").alias("dollars_per_amount"))
    long = cut(written_units(postings, row_id, minimum, maximum, per, category, kind, source))
    known = F.col("unit_code").isin(codes)
    written = long.where(F.col("unit_code").isNotNull()).withColumns({"confidence": F.when(known, 1.0), "assigned_by": F.when(known, F.col("assigned_by")).otherwise("review"), "unit_code": F.when(known, F.col("unit_code"))})
    missing = long.where("unit_code is null").drop("assigned_by", "unit_code")
    predicted = _predict(long.where(known), missing, codes, training_rows, confident)
    columns = ["row_id", "amount_field", "amount", "unit_code", "assigned_by", "confidence"]
    result = written.select(*columns).unionByName(predicted.select(*columns)).join(small_side(rates), "unit_code", "left")
    return result.select(*columns, (F.col("amount") * F.col("dollars_per_amount") / F.col("hours_per_unit")).alias("hourly"))


def _predict(labelled: DataFrame, missing: DataFrame, codes: list[str], training_rows: int, confident: float) -> DataFrame:
    review = missing.withColumns({"unit_code": F.lit(None).cast("string"), "assigned_by": F.lit("review"), "confidence": F.lit(None).cast("double")})
    have = labelled.count()
    number = (F.shiftrightunsigned(F.xxhash64(F.lit(11), "row_id", "amount_field"), 11).cast("double") + 0.5) / F.lit(float(2**53))
    share = min(1.0, training_rows / max(have, 1))
    sample = cut(_features(labelled.withColumn("draw", number).where(F.col("draw") < share)).withColumn("label", F.array_position(F.array(*map(F.lit, codes)), F.col("unit_code")).cast("double") - 1) if codes else labelled)
    if have < 50 or not codes or sample.select("label").distinct().limit(2).count() < 2:
        return review
    gather = VectorAssembler(inputCols=_FEATURES, outputCol="features")
    sample = gather.transform(sample)
    fit, held = sample.where(F.col("draw") < 0.75 * share), sample.where(F.col("draw") >= 0.75 * share)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=5, minInstancesPerNode=5).fit(fit)
    top = lambda df: df.withColumn("score", F.array_max(vector_to_array("probability")))
    scored = top(forest.transform(held)).select("score", (F.col("prediction") == F.col("label")).cast("double").alias("label"))
    calibration = IsotonicRegression(featuresCol="score", predictionCol="confidence").fit(scored)
    told = calibration.transform(top(forest.transform(gather.transform(_features(missing)))))
    sure = F.col("confidence") >= confident
    code = F.get(F.array(*map(F.lit, codes)), F.col("prediction").cast("int"))
    return told.select("row_id", "amount_field", "amount", F.when(sure, code).alias("unit_code"), F.when(sure, "predicted").otherwise("review").alias("assigned_by"), "confidence")
