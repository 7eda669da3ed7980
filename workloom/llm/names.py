"""Variant spellings of names: typos, abbreviations, initials, nicknames, reordered parts.

Tokens within a small edit distance are found by a symmetric-delete index: two tokens within k edits share a
string that is left after at most k deletions from each; long tokens, which would leave too many such strings,
share one of 2 k + 1 parts instead. Frequent tokens give the frame of a name (its line of business and the
like), in which rare tokens are compared; candidate names are linked if an optimal assignment aligns all of
their tokens, permitting initials, nicknames and abbreviations. Names that share a rare token and a frame are a
block; a name enters no block of more than BLOCK_NAMES names as long as it has a smaller one, and else only the
part of it that shares a second token. Linked names are gathered into connected components by label propagation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from workloom.runtime import cut, small_side

#: Words that say nothing about which organisation it is.
LEGAL = ("inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "ltee", "limitee", "llc", "llp", "lp", "plc", "gmbh", "enr", "senc")
BRANCH = ("hr", "rh", "dept", "department", "head", "office", "hiring", "canada", "branch", "division", "recruitment", "recruiting", "careers", "jobs", "talent", "acquisition", "team", "location", "site", "store", "succursale", "siege", "social")
LINKING = ("and", "et", "the", "of", "de", "la", "le", "les", "du", "group", "groupe", "grp", "gr")
#: Given names with their common short forms.
NICKNAMES = {
    "alexander": "alex al sandy xander lex", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny", "catherine": "cathy kate cat", "charles": "charlie chuck chas chaz",
    "christopher": "chris kit", "daniel": "dan danny", "david": "dave davy", "dorothy": "dot dottie dolly dora dory", "edward": "ed eddie ted ned teddy", "elizabeth": "liz beth betty eliza lizzie libby bess betsy",
    "francis": "frank fran", "frederick": "fred freddie freddy fritz rick", "george": "geo georgie", "gregory": "greg", "henry": "harry hank", "james": "jim jimmy jamie", "jennifer": "jen jenny", "john": "jack johnny jon",
    "joseph": "joe joey jos", "katherine": "kate kathy katie kat kit kitty kath", "lawrence": "larry", "margaret": "maggie meg peggy marge margie greta rita daisy", "matthew": "matt", "michael": "mike mick micky", "nicholas": "nick",
    "patricia": "pat patty trish", "peter": "pete", "philip": "phil", "rebecca": "becky", "richard": "rick dick rich ricky richie", "robert": "rob bob bobby robbie bert", "samuel": "sam", "stephen": "steve",
    "susan": "sue susie", "theodore": "ted theo teddy", "thomas": "tom tommy thos", "timothy": "tim", "victoria": "vicky tori", "william": "bill will billy willie wm liam",
}
_FULL_NAMES: dict[str, frozenset[str]] = {}
for _full, _short in NICKNAMES.items():
    for _n in (_full, *_short.split()):
        _FULL_NAMES[_n] = _FULL_NAMES.get(_n, frozenset()) | {_full}
#: Letters with marks and their base letters.
_MARKED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
_BASE = "aaaaaaceeeeiiiinoooooouuuuyy"

#: A token is frequent from this share of the names and this number of names on.
FREQUENT_SHARE, FREQUENT_LEAST = 0.0025, 4
#: Names that share a token and a frame, up to which they are all compared.
BLOCK_NAMES = 1_000
#: Pairs of names that a task aligns, as long as all cores have some.
TASK_PAIRS = 50_000
#: Tokens up to this length are indexed by deletions, longer ones by parts.
LONG_TOKEN = 24
#: Tokens from this length on may differ by two edits, shorter ones from four letters on by one.
TWO_EDITS_FROM = 7


def fold(name: Column) -> Column:
    return F.translate(F.replace(F.replace(F.lower(name), F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae")), _MARKED, _BASE)


def name_tokens(name: Column) -> Column:
    """Tokens of a name, an abbreviation's full stop kept, without legal forms, branches, linking words and numbers."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(fold(name), r"\bn['’`]\s", " "), r"['’`]", ""), r"#\s*\w+", " ")
    found = F.regexp_extract_all(bare, F.lit(r"[\p{L}\p{N}]+\.?"), 0)
    empty = [*LEGAL, *BRANCH, *LINKING]
    return F.filter(found, lambda x: ~F.rtrim(x, F.lit(".")).isin(empty) & ~x.rlike(r"^[0-9]+\.?$"))


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, or most + 1 if it is more; only the band of 2 * most + 1 cells is filled."""
    beyond, n = most + 1, len(b)
    if abs(len(a) - n) > most:
        return beyond
    if a == b:
        return 0
    if len(set(a) ^ set(b)) > 2 * most:  # an edit changes two of the letters that occur at most
        return beyond
    before, band = [beyond] * (most + beyond), [max(c - most, 0) if c >= most else beyond for c in range(most + beyond)]
    for i, x in enumerate(a):
        new: list[int] = []
        for c in range(most + beyond):
            j = i + 1 - most + c
            if j <= 0 or j > n:
                new.append(min(i + 1, beyond) if j == 0 else beyond)
                continue
            y = b[j - 1]
            d = band[c] if x == y else 1 + min(band[c], band[c + 1] if c < 2 * most else beyond, new[c - 1] if c else beyond)
            if i and j > 1 and x == b[j - 2] and a[i - 1] == y:
                d = min(d, before[c] + 1)
            new.append(min(d, beyond))
        before, band = band, new
        if min(band) > most:
            return beyond
    return band[n - len(a) + most]


def edits_allowed(n: int) -> int:
    return 0 if n < 4 else 1 if n < TWO_EDITS_FROM else 2


def is_abbreviation(short: str, full: str) -> bool:
    """Whether short, of at least two letters, has the first letter of full and its other letters in order."""
    if len(short) >= len(full) or len(short) < 2 or short[0] != full[0]:
        return False
    rest = iter(full)
    return all(ch in rest for ch in short)


@lru_cache(500_000)
def token_cost(a: str, b: str) -> float | None:
    """How much two tokens of aligned names differ, from 0 to 1; None if they can't stand for one another."""
    if a == b:
        return 0.0
    x, y = a.rstrip("."), b.rstrip(".")
    if x == y:
        return 0.0
    if len(x) > len(y):
        x, y, a, b = y, x, b, a
    full_x, full_y = _FULL_NAMES.get(x), _FULL_NAMES.get(y)
    if full_x and full_y and full_x & full_y:
        return 0.1
    if len(x) == 1:
        return 0.3 if y[0] == x or (full_y and any(f[0] == x for f in full_y)) else None
    if a.endswith(".") and y.startswith(x):
        return 0.2
    most = edits_allowed(len(x))
    d = edits(x, y, most)
    if d <= most:
        return 0.2 * d
    return 0.3 if len(x) <= 6 and is_abbreviation(x, y) and not (full_x or full_y) else None


def assignment(cost: list[list[float]]) -> list[int]:
    """The column of each row in an assignment of least total cost; cost is square. (Hungarian method.)"""
    n = len(cost)
    u, v, owner, way = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, used = [float("inf")] * (n + 1), [False] * (n + 1)
        while True:
            used[j] = True
            i0, delta, j1 = owner[j], float("inf"), 0
            for k in range(1, n + 1):
                if not used[k]:
                    c = cost[i0 - 1][k - 1] - u[i0] - v[k]
                    if c < least[k]:
                        least[k], way[k] = c, j
                    if least[k] < delta:
                        delta, j1 = least[k], k
            for k in range(n + 1):
                if used[k]:
                    u[owner[k]] += delta
                    v[k] -= delta
                else:
                    least[k] -= delta
            j = j1
            if owner[j] == 0:
                break
        while j:
            owner[j], j = owner[way[j]], way[j]
    out = [0] * n
    for k in range(1, n + 1):
        out[owner[k] - 1] = k - 1
    return out


def same_name(a: list[str], b: list[str]) -> bool:
    """Whether all tokens of both names can be aligned."""
    if len(a) != len(b) or not a:
        return False
    there = set(b)
    for x in a:  # most names are told apart by one token
        if x not in there and all(token_cost(x, y) is None for y in b):
            return False
    cost = [[token_cost(x, y) for y in b] for x in a]
    if any(all(c is None for c in row) for row in cost):
        return False
    square = [[100.0 if c is None else c for c in row] for row in cost]
    return sum(square[i][j] for i, j in enumerate(assignment(square))) <= 1.0


def deletions(token: str, most: int) -> set[str]:
    out = {token}
    for _ in range(most):
        out |= {x[:i] + x[i + 1 :] for x in out for i in range(len(x))}
    return out


def part_keys(token: str, most: int) -> set[str]:
    """Keys of which two tokens within most edits share one: an edit touches at most two of 2 * most + 1 equal parts."""
    n, parts = len(token), 2 * most + 1
    out = set()
    for length in range(n - most, n + most + 1):
        for k in range(parts):
            first, last = k * length // parts, (k + 1) * length // parts
            for shift in range(-most, most + 1):
                if 0 <= first + shift and last + shift <= n:
                    part = hashlib.blake2b(token[first + shift : last + shift].encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
                    out.add(f"{k}:{length}:{part}")
    return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, token, n) for each token: what deletions leave of it, or its parts; its prefixes; for abbreviations themselves."""
    for batch in batches:
        keys, tokens, counts = [], [], []
        for token, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            word = token.rstrip(".")
            most, own = edits_allowed(len(word)), set()
            if len(word) <= LONG_TOKEN:
                own |= {f"d:{x}" for x in deletions(word, most)}
            if len(word) > LONG_TOKEN - most:
                own |= {f"d:{x}" for x in part_keys(word, most)}
            if token.endswith(".") and len(word) >= 2:
                own.add(f"p:{word[:LONG_TOKEN]}")
            else:
                own |= {f"p:{word[:k]}" for k in range(2, min(len(word), LONG_TOKEN + 1))}
            keys += own
            tokens += [token] * len(own)
            counts += [n] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(tokens, pa.string()), pa.array(counts, pa.int64())], names=["key", "token", "n"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        yield batch.filter(pa.array([token_cost(a, b) is not None for a, b in pairs], pa.bool_()))


def neighbours(tokens: DataFrame) -> DataFrame:
    """token, other: distinct pairs of different tokens (token, n) that can stand for one another, both ways.

    Keys that only prefixes of full words share give no pairs, nor do keys of a prefix for two abbreviations.
    """
    index = tokens.select("token", "n").mapInArrow(_index, "key string, token string, n long")
    kind = F.when(F.startswith("key", F.lit("d:")), 0).when(F.endswith("token", F.lit(".")), 1).otherwise(2)
    index = index.select("key", "token", kind.alias("kind"))
    left, right = index.alias("l"), index.alias("r")
    fits = ((F.col("l.kind") == 0) & (F.col("r.kind") == 0) & (F.col("l.token") < F.col("r.token"))) | ((F.col("l.kind") == 1) & (F.col("r.kind") == 2))
    pairs = left.join(right, (F.col("l.key") == F.col("r.key")) & fits).select(F.col("l.token").alias("token"), F.col("r.token").alias("other")).distinct()
    checked = pairs.mapInArrow(_verified, "token string, other string")
    return checked.unionByName(checked.select(F.col("other").alias("token"), F.col("token").alias("other"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each connected component of edges (a, b), by label propagation with jumps."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = cut(spread.join(jump, F.col("new") == F.col("at"), "left").select("node", "label", F.least("new", F.coalesce("further", "new")).alias("new")))
        labels = moved.select("node", F.col("new").alias("label"))
        if moved.where("label <> new").isEmpty():
            return labels


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        keep = batch.filter(pa.array([same_name(x, y) for x, y in zip(a, b)], pa.bool_()))
        yield pa.RecordBatch.from_arrays([keep.column(0), keep.column(1)], names=["a", "b"])


def _initials(token: Column) -> Column:
    """The initials a given name or initial may stand for."""
    full = {short: sorted({short[0], *(f[0] for f in names)}) for short, names in _FULL_NAMES.items()}
    known = F.lit(None).cast("array<string>")
    for initials in {tuple(x) for x in full.values() if len(x) > 1}:
        known = F.when(token.isin(sorted(k for k, x in full.items() if tuple(x) == initials)), F.array(*map(F.lit, initials))).otherwise(known)
    return F.coalesce(known, F.array(F.substring(token, 1, 1)))


def _met(framed: DataFrame, ways: DataFrame, tokens: DataFrame, block_names: int) -> DataFrame:
    """a, b (a < b): the names of framed (first, token, within) to be compared.

    A name enters the blocks (token, within) of its tokens and of those they may stand for (ways: token, other).
    Where a token would meet more than block_names names, it is left to the name's other tokens; a name with
    only such tokens meets the names that share its two rarest ones, or, with one, those of which a token begins
    like its first given name too (tokens: first, token, personal). All tokens of linked names stand for one
    another, so this loses only pairs that are alike in their frequent blocks alone: rarest tokens that are
    abbreviated without a full stop, or a given name with another first letter.
    """
    sizes = framed.groupBy(F.col("token").alias("other"), "within").agg(F.count(F.lit(1)).alias("n"))
    entries = cut(framed.join(ways, "token").join(sizes, ["other", "within"]).select("first", "token", "other", "within", "n"))
    of_token = entries.groupBy("first", "token", "within").agg(F.sum("n").alias("n"))
    by_name = W.partitionBy("first").orderBy("n", "token")  # a name's few tokens
    placed = cut(of_token.withColumns({"place": F.row_number().over(by_name), "least": F.min("n").over(W.partitionBy("first"))}))
    entered = entries.drop("n").join(placed.where(F.col("n") <= block_names).select("first", "token"), ["first", "token"], "left_semi")
    blocks = framed.select(F.col("token").alias("other"), "within", F.col("first").alias("b"))
    met = entered.join(blocks, ["other", "within"]).select(F.col("first").alias("a"), "b")

    hot = placed.where((F.col("least") > block_names) & (F.col("place") <= 2)).select("first", "token", "within", "place")
    if not hot.isEmpty():
        hot = cut(hot)
        within = small_side(hot.select("within").distinct())
        here = cut(framed.join(within, "within", "left_semi"))
        other = entries.drop("n").join(hot.select("first", "token", "place"), ["first", "token"])
        one, two = other.where("place = 1"), other.where("place = 2").select("first", F.col("other").alias("second"))
        key = (F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), F.col("within"))
        probes = one.join(two, "first").select(F.col("first").alias("a"), F.col("other").alias("x"), F.col("second").alias("y"), "within").select("a", *key).distinct()
        pairs = here.select(F.col("first").alias("b"), F.col("token").alias("x"), "within").join(here.select(F.col("first").alias("b"), F.col("token").alias("y")), "b").where("x < y")
        met = met.unionByName(probes.join(pairs, ["x", "y", "within"]).select("a", "b"))

        single = one.join(hot.where("place = 2").select("first"), "first", "left_anti").select("first", "other", "within")
        given = tokens.where("personal").groupBy("first").agg(F.min("token").alias("given"))
        singles = single.join(given, "first", "left").select(F.col("first").alias("a"), "other", "within", "given")
        all_of = here.select(F.col("first").alias("b"), F.col("token").alias("other"), "within")
        letters = tokens.join(here.select("first").distinct(), "first", "left_semi").select(F.col("first").alias("b"), F.explode(_initials(F.col("token"))).alias("letter")).distinct()
        bare = singles.where("given is null").join(all_of, ["other", "within"]).select("a", "b")
        lettered = singles.where("given is not null").select("a", "other", "within", F.explode(_initials(F.col("given"))).alias("letter"))
        met = met.unionByName(bare).unionByName(lettered.join(all_of.join(letters, "b"), ["other", "within", "letter"]).select("a", "b"))
    return met.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_names(names: DataFrame, ident: str = "id", name: str = "name", block_names: int = BLOCK_NAMES) -> DataFrame:
    """id, entity, n_links: every id of names (id, name), by entity (the least id of each), with the number of other ids of it.

    Names of the same tokens are one entity at once; among the others, those with a rare token in common, or
    two within few edits, are compared if their frequent tokens are the same (misspelt and abbreviated ones
    are read as the frequent token they stand for). Null names and names without any token are linked to none
    and are entities of their own. Rows without an id have none.
    """
    given = names.select(F.col(ident).cast("long").alias("id"), name_tokens(F.col(name)).alias("tokens")).where("id is not null and size(tokens) > 0")
    signed = cut(given.withColumn("signature", F.array_join(F.array_sort("tokens"), " ")))
    firsts = signed.groupBy("signature").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("tokens").alias("tokens"))
    distinct = cut(firsts)
    n_names = max(distinct.count(), 1)

    counted = cut(distinct.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    frequent = max(FREQUENT_LEAST, FREQUENT_SHARE * n_names)
    near = cut(neighbours(counted).join(counted, "token").join(counted.select(F.col("token").alias("other"), F.col("n").alias("other_n")), "other"))

    # the frequent token that a rarer one stands for: at most 1 / FREQUENT_SHARE tokens a name are frequent
    common = counted.where(F.col("n") >= frequent).select(F.rtrim("token", F.lit(".")).alias("word"), "n").groupBy("word").agg(F.max("n").alias("n"))
    given_names = F.col("word").isin(sorted(_FULL_NAMES))
    lines = small_side(common.where(~given_names & (F.length("word") > 3)))
    shortform = F.endswith("token", F.lit("."))
    rare = counted.where((F.col("n") < frequent) | shortform)
    close = near.where((F.col("other_n") >= frequent) & (F.col("n") * 3 < F.col("other_n"))).select("token", F.rtrim("other", F.lit(".")).alias("word"), F.col("other_n").alias("weight"), F.levenshtein(F.rtrim("token", F.lit(".")), F.rtrim("other", F.lit("."))).alias("d"))
    close = close.where((F.col("d") <= 2) & ~F.endswith("token", F.lit(".")))
    short = counted.withColumn("bare", F.rtrim("token", F.lit("."))).where("length(bare) between 2 and 7").where(~F.col("bare").isin(sorted(_FULL_NAMES)))
    shortened = short.join(lines, (F.substring("bare", 1, 1) == F.substring("word", 1, 1)) & (F.length("bare") < F.length("word")) & (shortform | (short["n"] * 3 < lines["n"]) | (F.col("bare").rlike("^.[^aeiou]+$") & (short["n"] < lines["n"]))) & F.regexp_like("word", F.concat(F.lit("^"), F.regexp_replace("bare", "(.)", "$1.*"))))
    shortened = shortened.select("token", "word", lines["n"].alias("weight"), F.lit(3).alias("d"))
    read = close.unionByName(shortened).groupBy("token").agg(F.max_by("word", F.struct(-F.col("d"), "weight", "word")).alias("frame"))
    itself = counted.where((F.col("n") >= frequent) & ~shortform).select("token", F.col("token").alias("frame"))
    frames = cut(itself.join(read.select("token", F.col("frame").alias("longer")), "token", "left").select("token", F.coalesce("longer", "frame").alias("frame")).unionByName(read.join(rare, "token", "left_semi")))

    tokens = distinct.select("first", F.explode("tokens").alias("token")).join(small_side(frames), "token", "left")
    bare = F.rtrim("token", F.lit("."))
    part = tokens.withColumn("personal", bare.isin(sorted(_FULL_NAMES)) | (F.length(bare) == 1))
    frame = part.groupBy("first").agg(F.array_join(F.array_sort(F.collect_list(F.when(~F.col("personal"), F.col("frame")))), " ").alias("frame"), F.count(F.when(~F.col("personal") & F.col("frame").isNull(), 1)).alias("n_rare"), F.count(F.lit(1)).alias("n_tokens"))
    frame = frame.withColumn("frame", F.concat_ws(" ", "frame", F.col("n_tokens").cast("string")))  # only names of as many tokens can be aligned
    keyed = part.where("not personal and frame is null").select("first", "token").distinct().join(frame, "first").select("first", "token", F.col("frame").alias("within"))
    framed = cut(keyed.unionByName(frame.where("n_rare = 0").select("first", F.lit("").alias("token"), F.col("frame").alias("within"))))
    ways = near.select("token", "other").unionByName(framed.select("token", F.col("token").alias("other"))).distinct()
    met = cut(_met(framed, ways, part.select("first", bare.alias("token"), "personal"), block_names))
    held = distinct.select("first", "tokens")
    pairs = met.join(held.withColumnsRenamed({"first": "a", "tokens": "x"}), "a").join(held.withColumnsRenamed({"first": "b", "tokens": "y"}), "b").select("a", "b", "x", "y")
    # the alignment is Python's work: every core has pairs, and no task too many
    edges = pairs.repartition(max(names.sparkSession.sparkContext.defaultParallelism, -(-met.count() // TASK_PAIRS))).mapInArrow(_aligned, "a long, b long")
    grouped = components(edges)
    entity = signed.join(distinct.select("signature", "first", "copies"), "signature").join(grouped.withColumnsRenamed({"node": "first"}), "first", "left")
    linked = cut(entity.where("copies > 1 or label is not null").select("id", F.coalesce("label", "first").alias("entity")))
    sizes = linked.groupBy("entity").agg(F.count_distinct("id").alias("size"))
    n_links = linked.distinct().join(sizes, "entity").select("id", "entity", (F.col("size") - 1).alias("n_links"))
    every = names.select(F.col(ident).cast("long").alias("id")).where("id is not null").distinct()
    return every.join(n_links, "id", "left").select("id", F.coalesce("entity", "id").alias("entity"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def linked_pairs(linked: DataFrame, a: str, b: str) -> DataFrame:
    """Every pair of ids of one entity, a < b."""
    linked = linked.where("n_links > 0")
    left, right = linked.select(F.col("id").alias(a), "entity"), linked.select(F.col("id").alias(b), "entity")
    return left.join(right, "entity").where(F.col(a) < F.col(b)).select(a, b)
