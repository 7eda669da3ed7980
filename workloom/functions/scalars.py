"""Column functions of the job-market engine: pay, codes, dates, seniority, text. All run as built-in expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hours of each pay unit.
UNIT_HOURS = {"Hour": 1.0, "Day": 8.0, "Week": 40.0, "Bi-weekly": 80.0, "Month": 173.33, "Year": 2080.0}
#: Hourly pay outside of these bounds is an outlier.
HOURLY_BOUNDS = (10, 500)
#: Text that a CSV scan reads as null.
NA_TOKENS = ("", "#N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Text that counts as null at load.
PSEUDO_NULLS = ("NaN", "nan", "None", "")
#: Months by name.
MONTHS = {
    "january": "01", "february": "02", "march": "03", "april": "04", "may": "05", "june": "06", "july": "07", "august": "08", "september": "09", "october": "10", "november": "11", "december": "12",
    "jan": "01", "feb": "02", "mar": "03", "apr": "04", "jun": "06", "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12",
}
#: Seniority tiers, from the lowest.
TIERS = ("intern", "entry_level", "mid_level", "senior", "executive")
#: Tier of each experience label.
LABEL_TIERS = {"Internship": "intern", "Entry level": "entry_level", "Associate": "entry_level", "Mid-Senior level": "mid_level", "Director": "executive", "Executive": "executive"}
#: Words of a title that tell the tier, from the tier that counts first.
TIER_WORDS = {
    "executive": ("director", "vp", "vice president", "head of", "chief", "cto", "ceo", "cfo"),
    "senior": ("senior", "sr", "lead", "principal", "staff"),
    "mid_level": ("mid level", "mid-level", "intermediate"),
    "entry_level": ("junior", "jr", "entry level", "entry-level", "graduate", "trainee"),
    "intern": ("intern", "internship", "co-op", "coop"),
}
#: Skill categories.
CATEGORIES = ("hard_skill", "soft_skill", "tool", "certification")
#: Plural words that stay as they are.
KEPT_PLURALS = (
    "sales", "operations", "logistics", "analytics", "economics", "mathematics", "statistics", "physics", "electronics", "robotics", "dynamics", "graphics", "ceramics", "genetics", "orthotics",
    "prosthetics", "diagnostics", "informatics", "bioinformatics",
)
#: Endings of English plurals and what they become, from the rarest.
PLURALS = (
    (r"(?i)\bpeople$", "person"), (r"(?i)\b(wo)?men$", "$1man"), (r"(?i)(sales|crafts|trades|fore)men$", "$1man"), (r"(?i)\bchildren$", "child"), (r"(?i)\bfeet$", "foot"), (r"(?i)\bteeth$", "tooth"), (r"(?i)\bmice$", "mouse"), (r"(?i)\bgeese$", "goose"),
    (r"(?i)\b(criteri|phenomen)a$", "$1on"), (r"(?i)\b(dat|medi|curricul|memorand|spectr|bacteri)a$", "$1um"), (r"(?i)\b(ind|vert|ap)ices$", "$1ex"), (r"(?i)\b(matr|append)ices$", "$1ix"), (r"(?i)\b(stimul|nucle|foc|radi|alumn)i$", "$1us"),
    (r"(?i)(analy|hypothe|the|synthe|paraly|cri|diagno|progno|parenthe|oa)ses$", "$1sis"), (r"(?i)\baxes$", "axis"),
    (r"(?i)\b(kni|wi|li)ves$", "$1fe"), (r"(?i)(shel|hal|cal|lea|loa|sel|wol|el|thie|shea)ves$", "$1f"),
    (r"(?i)\b(serie|specie)s$", "$1s"), (r"(?i)\bnews$", "news"), (r"(?i)\b(mov|cook|calor|pixie|t|p|l|d|sm|gen|budg|rook|zomb|self|brown|hood|sort)ies$", "$1ie"), (r"(?i)([^aeiou])ies$", "$1y"), (r"(?i)(qu)ies$", "$1y"),
    (r"(?i)\b(tomat|potat|her|ech|vet|carg|torped|embarg)oes$", "$1o"),
    (r"(?i)(ss|sh|[^aeiou]ch|[aeiou]tch|[aeiou]ch|x|zz)es$", "$1"), (r"(?i)(stat|vir|bon|camp|foc|cens|apparat|calcul|chor|circ|consens|surpl|syllab|vers|b)uses$", "$1us"), (r"(?i)\b(g|atl|bi|canv)ases$", "$1as"), (r"(?i)\b(lens|quiz)z?es$", "$1"),
    (r"(?i)([a-z]{2,}[^sui])s$", "$1"),
)


def literal_map(values: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in values.items()))


def looked_up(key: Column, values: dict) -> Column:
    """The value of the key, null for null and unknown keys."""
    return F.try_element_at(literal_map(values), key)


def hourly(amount: Column, unit: Column) -> Column:
    """Pay per hour; null for unknown and null units. Minimum and maximum are converted independently."""
    return amount / looked_up(unit, UNIT_HOURS)


def without_outliers(amount: Column) -> Column:
    """null outside of HOURLY_BOUNDS, which are kept themselves."""
    low, high = HOURLY_BOUNDS
    return F.when(amount.between(low, high), amount)


def number(text: Column) -> Column:
    return text.try_cast("double")


def code_number(code: Column) -> Column:
    """An occupation code as an integer, so that 10, 00010 and 10.0 are the same; null for other text."""
    return F.trim(code).try_cast("double").try_cast("int")


def code_text(code: Column) -> Column:
    return F.lpad(code_number(code).cast("string"), 5, "0")


def major_group(code: Column) -> Column:
    return F.substring(code, 1, 2)


def posting_date(text: Column) -> Column:
    """Dates as 2023/01/15; other text is an error."""
    return F.to_date(text, "yyyy/MM/dd")


def year_month(url: Column) -> Column:
    """2023-01 from the last segment of an address that holds a month's name and a year; null if it doesn't."""
    last = F.lower(F.regexp_extract(url, r"([^/]*)$", 1))
    pattern = r"(" + "|".join(MONTHS) + r")-?([0-9]{4})"
    month = F.nullif(F.regexp_extract(last, pattern, 1), F.lit(""))
    return F.when(month.isNotNull(), F.concat_ws("-", F.regexp_extract(last, pattern, 2), looked_up(month, MONTHS)))


def is_english_address(url: Column) -> Column:
    return F.contains(url, F.lit("-en-")) | F.contains(url, F.lit("-en."))


def label_tier(label: Column) -> Column:
    return looked_up(label, LABEL_TIERS)


def _has_word(title: Column, words: tuple[str, ...]) -> Column:
    return title.rlike(r"(?iU)\b(?:" + "|".join(words) + r")\b")


def keyword_tier(title: Column) -> Column:
    """The tier of the first group of TIER_WORDS that has a whole word in the title."""
    found = F.lit(None).cast("string")
    for tier, words in reversed(TIER_WORDS.items()):
        found = F.when(_has_word(title, words), tier).otherwise(found)
    return found


def seniority(label: Column, title: Column) -> Column:
    """struct(tier, method): the label counts before the title, but a senior word refines a mid-level label."""
    of_label, of_title = label_tier(label), keyword_tier(title)
    refined = (of_label == "mid_level") & _has_word(title, TIER_WORDS["senior"])
    tier = F.when(refined, "senior").otherwise(F.coalesce(of_label, of_title))
    method = F.when(refined, "csv_refined").when(of_label.isNotNull(), "csv").when(of_title.isNotNull(), "title_keyword")
    return F.struct(tier.alias("tier"), method.alias("method"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; a tiny number beside the norms keeps zero vectors from dividing by zero."""
    tiny = F.lit(1e-10)
    return dot(a, b) / ((F.sqrt(dot(a, a)) + tiny) * (F.sqrt(dot(b, b)) + tiny))


def real(text: Column) -> Column:
    """null for the texts that count as null at load."""
    return F.when(~text.isin(*PSEUDO_NULLS), text)


def scanned(text: Column) -> Column:
    """null for the texts that a CSV scan reads as null."""
    return F.when(~text.isin(*NA_TOKENS), text)


def not_nan(value: Column, default: Column) -> Column:
    return F.coalesce(F.when(~F.isnan(value), value), default)


def safe_name(name: Column) -> Column:
    """For ids: other characters than word characters and hyphens as _, 50 at most; unknown for null and empty names."""
    kept = F.substring(F.regexp_replace(name, r"(?U)[^\w\-]", "_"), 1, 50)
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("unknown"))


def content_hash(ids: Column) -> Column:
    """The first 12 hex digits of the MD5 of the ids, in numerical order and joined by commas."""
    return F.substring(F.md5(F.array_join(F.transform(F.array_sort(ids), lambda x: x.cast("string")), ",")), 1, 12)


def mask_secret(connection: Column) -> Column:
    """user:password@ and password=... of a connection string, masked."""
    return F.regexp_replace(F.regexp_replace(connection, r"(://[^:/@\s]+):[^@\s]+@", "$1:***@"), r"(?i)(password|passwd|pwd)=[^\s;&]+", "$1=***")


def singular(name: Column) -> Column:
    """The singular of the last word of a name in lower case by the first of PLURALS that fits; KEPT_PLURALS and other endings stay."""
    out = name
    for pattern, by in reversed(PLURALS):
        out = F.when(name.rlike(pattern), F.regexp_replace(name, pattern, by)).otherwise(out)
    return F.when(F.lower(name).isin(*KEPT_PLURALS), name).otherwise(out)


def truncated(text: Column, n: int = 1500) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, n)


def fitted(text: Column, width: int, missing: str = "") -> Column:
    """Text of exactly width characters for a table of plain text: cut off or filled up with blanks."""
    return F.rpad(F.substring(F.coalesce(text, F.lit(missing)), 1, width), width, " ")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """A share as text, as 12.5%; 0 of nothing is 0."""
    share = F.coalesce(100.0 * part / F.nullif(whole, F.lit(0)), F.lit(0.0))
    return F.concat(F.format_number(F.round(share, digits), digits), F.lit("%"))
