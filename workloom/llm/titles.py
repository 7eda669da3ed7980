"""Free-typed titles mapped to a reference list by a trie walked with a Levenshtein automaton.

The trie holds the reference entries letter by letter, without blanks, with alias paths beside each: the role
first or last, the short form of field head and role, and common abbreviations of roles and words. The
automaton's state at a node is the row of edit distances (with swaps of neighbours) between the path and all
beginnings of the title; branches whose row exceeds the distance allowed for the title's length are cut. All
entries within the distance are returned, and the nearest one is taken if it is the only nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.llm.names import fold
from workloom.runtime import cut, small_side

#: Short and other forms of roles.
ROLE_ALIASES = {
    "analyst": "anl anlst", "assistant": "asst", "coordinator": "coord", "engineer": "eng engr", "inspector": "insp inspct", "installer": "instlr instler", "instructor": "instr",
    "labourer": "labr laborer", "manager": "mgr mngr", "operator": "op oper optr", "planner": "plnr", "specialist": "spec splst", "supervisor": "sup supv supvr", "technician": "tech techn tchn",
}
#: Short and other forms of words of a field of work.
WORD_ALIASES = {
    "maintenance": "mtce maint", "assembly": "assy", "inspection": "insp", "treatment": "trtmt", "hospital": "hosp", "database": "db", "network": "netwk", "warehouse": "whse", "jewellery": "jewelry", "theatre": "theater",
    "fibre": "fiber", "moulding": "molding", "harbour": "harbor", "cataloguing": "cataloging", "administration": "admin", "management": "mgmt", "production": "prod", "laboratory": "lab", "construction": "constr", "services": "svcs",
    "transportation": "transp", "engineering": "engrg", "manufacturing": "mfg", "equipment": "equip", "electrical": "elec", "mechanical": "mech", "distribution": "distn", "translation": "transl", "scheduling": "sched",
}
#: What is said about a posting, not about the work.
_BEFORE = r"^(?:\s|urgent:?|new!|hiring:?|\d+\s?x\b|sr\.?(?=[\s_.-])|jr\.?(?=[\s_.-])|senior|junior|lead|principal|acting|interim|part[ -]time|full[ -]time|casual|seasonal|experienced|bilingual|[\s_\-:.*])+"
_ANYWHERE = r"\[[^\]]*\]|\((?:[mfhxwd]/)+[mfhxwd]\)|\((?:remote|hybrid|on-?site|part-?time|full-?time|temporary|permanent)\)|req(?:uisition)?\.? ?#? ?\d+|#\s?\d+|w/ ?benefits|[-–/]\s*(?:temp to perm|night shift|day shift|evening shift|immediate start|\d+ month contract|\$\s?\d[\d.,]*(?:/\s?h(?:ou)?r)?)|\|.*$"
_PLACE = r",\s*[^,]+\s(?:on|qc|bc|ab|mb|sk|ns|nb|nl|pe|nt|yt|nu)\s*$"
_LEVEL = r"\s(?:i{1,3}|iv)\s*$"


def allowed_edits(n: int) -> int:
    return 0 if n < 7 else 1 if n < 12 else 2 if n < 26 else 3


def title_key(title: Column) -> Column:
    """The letters of a title, of any alphabet, in lower case and without marks, blanks and what only concerns the posting."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(fold(title), _ANYWHERE, " "), _PLACE, " "), _LEVEL, " ")
    bare = F.regexp_replace(F.regexp_replace(text, _BEFORE, ""), _LEVEL, " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?<=[\s/,(-])(?:dept|department|of|and)\b|&", " "), r"\P{L}+", "")


def paths(entry: str) -> dict[str, int]:
    """The paths of an entry (words, the last one the role in the plural or singular), with the length of the shortest part."""
    words = entry.lower().split()
    if not words:
        return {}
    role, field = words[-1], words[:-1]
    single = role[:-1] if role.endswith("s") else role
    roles = [single, role, *ROLE_ALIASES.get(single, "").split()]
    whole = [""]
    for word in field:
        whole = [w + form for w in whole for form in (word, *WORD_ALIASES.get(word, "").split())]
    heads = [field[0], *WORD_ALIASES.get(field[0], "").split()] if len(field) > 1 else []
    out: dict[str, int] = {}
    for stem in {*whole, *heads}:
        for form in roles:
            least = min([len(form), len(stem)]) if stem else len(form)
            for path in {stem + form, form + stem}:
                path = "".join(filter(str.isalpha, path))
                out[path] = max(out.get(path, 0), least)
    return out


class Automaton:
    """The Levenshtein automaton of up to most edits, for titles of any letters; its table is filled as it is used.

    Before the i-th letter of a path, cell c of a band stands for the title's first i - most + c letters. A state
    is (band, band of swaps begun); a step reads the window of the title's letters i - most - 1 to i + most + 1,
    as bits that tell which equal the path's letter.
    """

    def __init__(self, most: int):
        self.most, self.width = most, 2 * most + 1
        self.window = (1 << (self.width + 2)) - 1
        self.steps: list[dict[int, int]] = []
        self.bands: list[tuple[int, ...]] = []
        #: The first cell of each state's band that is within reach; behind the band if none is.
        self.alive: list[int] = []
        #: For states without an edit left, where in the window the letters are that lead on; None for the others.
        self.ways: list[tuple[int, ...] | None] = []
        self._states: list[tuple[tuple[int, ...], tuple[int, ...]]] = []
        self._numbers: dict[tuple, int] = {}
        self.start = self._number(tuple(c - most if c >= most else most + 1 for c in range(self.width)), (most + 1,) * self.width)

    def _number(self, band: tuple[int, ...], swaps: tuple[int, ...]) -> int:
        found = self._numbers.setdefault((band, swaps), len(self._states))
        if found == len(self._states):
            self._states.append((band, swaps))
            self.bands.append(band)
            self.steps.append({})
            self.alive.append(next((c for c, d in enumerate(band) if d <= self.most), self.width))
            ways = {c + 1 for c, d in enumerate(band) if d <= self.most} | {c for c, d in enumerate(swaps) if d <= self.most}
            self.ways.append(None if min(band) < self.most else tuple(sorted(ways)))
        return found

    def step(self, state: int, seen: int) -> int:
        band, swaps = self._states[state]
        beyond, new = self.most + 1, []
        for c in range(self.width):
            if seen >> (c + 1) & 1:
                d = band[c]
            else:
                d = 1 + min(band[c], band[c + 1] if c + 1 < self.width else beyond, new[c - 1] if c else beyond)
            if seen >> c & 1:
                d = min(d, swaps[c])
            new.append(min(d, beyond))
        begun = tuple(min(band[c] + 1, beyond) if seen >> (c + 2) & 1 else beyond for c in range(self.width))
        found = self.steps[state][seen] = self._number(tuple(new), begun)
        return found


_AUTOMATA: dict[int, Automaton] = {}


def _within(top: dict, key: str, most: int) -> Iterator[tuple[dict, int]]:
    """(node, distance) of the nodes below top whose path from it is within most edits of key."""
    if not most:
        for ch in key:
            top = top.get(ch)
            if top is None:
                return
        yield top, 0
        return
    if most not in _AUTOMATA:
        _AUTOMATA[most] = Automaton(most)
    automaton, n = _AUTOMATA[most], len(key)
    steps, bands, alive, ways, window, width = automaton.steps, automaton.bands, automaton.alive, automaton.ways, automaton.window, automaton.width
    places: dict[str, int] = {}
    for at, ch in enumerate(key, most + 1):
        places[ch] = places.get(ch, 0) | 1 << at
    stack = [(top, automaton.start, 0)]
    while stack:
        node, state, depth = stack.pop()
        end = n - depth + most  # the cell of the whole key; the next one is one less
        if end < width and bands[state][end] <= most:
            yield node, bands[state][end]
        on, left = ways[state], depth - most - 1
        children = node.items() if on is None else [(ch, node[ch]) for ch in {key[left + p] for p in on if 0 <= left + p < n} if ch in node]
        for ch, child in children:
            if ch:
                seen = places.get(ch, 0) >> depth & window
                after = steps[state].get(seen)
                if after is None:
                    after = automaton.step(state, seen)
                if alive[after] < end:
                    stack.append((child, after, depth + 1))


class Trie:
    """Nodes are dicts by letter; under "" a node has its entries as (entry, length of the shortest part).

    A second trie holds the paths backwards. Of the edits between a key and a path, the first or the second half
    of the key has only the lesser part: each trie is entered with the few edits of its first half and gone on
    with the rest, so that the many branches near the root are cut early. No path is lost by this: k edits are
    split into (0, k), (1, k - 1) and so on, the first of which go forwards, the others backwards; and a swap
    across the middle is searched by itself.
    """

    def __init__(self, entries: list[tuple[int, str]]):
        self.forwards: dict = {}
        self.backwards: dict = {}
        self.paths: dict[str, list[tuple[int, int]]] = {}
        for ident, entry in entries:
            for path, least in paths(entry).items():
                self.paths.setdefault(path, []).append((ident, least))
        for path, hits in self.paths.items():
            for node, letters in ((self.forwards, path), (self.backwards, path[::-1])):
                for ch in letters:
                    node = node.setdefault(ch, {})
                node[""] = hits

    def search(self, key: str, most: int) -> dict[int, int]:
        """Every entry that has a path within most edits of key, with the least number of edits.

        Fewer edits are allowed than the shortest part of a path has letters, so that none is wholly edited away.
        """
        found: dict[int, int] = {}

        def add(hits: list[tuple[int, int]], d: int) -> None:
            for ident, least in hits:
                if d < least and d < found.get(ident, most + 1):
                    found[ident] = d

        if not most:
            add(self.paths.get(key, []), 0)
            return found
        half = len(key) // 2
        swapped = half and key[half - 1] != key[half]
        for top, text, at, first in ((self.forwards, key, half, most // 2), (self.backwards, key[::-1], len(key) - half, (most - 1) // 2)):
            for node, d in _within(top, text[:at], first):
                for end, more in _within(node, text[at:], most - d):
                    add(end.get("", []), d + more)
            fewer = (most - 1) // 2 if top is self.forwards else (most - 2) // 2
            if swapped and fewer >= 0:
                for node, d in _within(top, text[: at - 1], fewer):
                    node = node.get(text[at], {}).get(text[at - 1])
                    if node is not None:
                        for end, more in _within(node, text[at + 1 :], most - 1 - d):
                            add(end.get("", []), d + 1 + more)
        return found


def _search(batches: Iterator[pa.RecordBatch], trie: Trie) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key in batch.column(0).to_pylist():
            out += [(key, ident, d) for ident, d in trie.search(key, allowed_edits(len(key))).items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32()))], names=["key", "entry_id", "distance"])


_TRIES: dict[int, Trie] = {}
#: Entries of the reference list in one trie; a longer list is searched in several.
TRIE_ENTRIES = 50_000
#: Keys that a task searches, as long as all cores have one.
TASK_KEYS = 4_000


def candidates(keys: DataFrame, reference: DataFrame) -> DataFrame:
    """key, entry_id, distance: all entries of reference (id, name) within the distance allowed for each distinct key.

    A list of more than TRIE_ENTRIES entries is searched part by part, with one part on the driver and the
    workers at a time.
    """
    spark = keys.sparkSession
    entries = reference.select(F.col("id").cast("long").alias("id"), fold(F.col("name")).alias("name")).where("id is not null and trim(name) <> ''")
    parts, result = max(1, -(-entries.count() // TRIE_ENTRIES)), None
    spread = keys.select("key").repartition(max(spark.sparkContext.defaultParallelism, -(-keys.count() // TASK_KEYS)))
    for part in range(parts):
        own = entries if parts == 1 else entries.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part)
        held = spark.sparkContext.broadcast([(r.id, r.name) for r in own.collect()])  # about TRIE_ENTRIES entries

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            key = hash(tuple(held.value))
            if key not in _TRIES:
                _TRIES.clear()
                _TRIES[key] = Trie(held.value)
            return _search(batches, _TRIES[key])

        found = spread.mapInArrow(run, "key string, entry_id long, distance int")
        if parts > 1:
            found = cut(found)
            held.destroy()
        result = found if result is None else result.unionByName(found)
    return result


def map_titles(postings: DataFrame, reference: DataFrame, ident: str = "job_id", title: str = "raw_title", reference_id: str = "id", reference_name: str = "noc21_name") -> DataFrame:
    """ident, title, entry_id, distance, n_nearest, status: one row per posting.

    status is matched if one entry is nearest; ambiguous if several are (entry_id null); unmatched if none is
    within the distance, which depends on the letters of the key (see allowed_edits), also for null and empty
    titles. Titles that stand for no entry are thus reported, not dropped.
    """
    keyed = cut(postings.select(F.col(ident).alias("ident"), F.col(title).alias("title"), title_key(F.col(title)).alias("key")))  # its patterns are costly
    listed = reference.select(F.col(reference_id).alias("id"), F.col(reference_name).alias("name"))
    keys = cut(keyed.where("key <> ''").select("key").distinct())
    found = candidates(keys, listed)
    near = F.min("distance").alias("distance")
    per_key = found.groupBy("key").agg(near, F.array_sort(F.collect_list(F.struct("distance", "entry_id"))).alias("all"))  # at most the entries of the list
    best = F.filter("all", lambda x: x["distance"] == F.col("distance"))
    per_key = cut(per_key.select("key", "distance", F.size(best).alias("n_nearest"), F.when(F.size(best) == 1, F.get(best, F.lit(0))["entry_id"]).alias("entry_id")))
    status = F.when(F.col("n_nearest") == 1, "matched").when(F.col("n_nearest") > 1, "ambiguous").otherwise("unmatched")
    mapped = keyed.join(small_side(per_key), "key", "left")
    return mapped.select(F.col("ident").alias(ident), F.col("title").alias(title), "entry_id", "distance", F.coalesce("n_nearest", F.lit(0)).alias("n_nearest"), status.alias("status"))
