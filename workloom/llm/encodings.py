"""Text garbled by a wrong character encoding: found and restored by expectation-maximisation.

Each text came through one latent chain of encodings: none, or bytes of one encoding read as another, once or
twice. A text observed under a chain has the probability of its inverse under a model of character pairs, times
the share of the chain in the text's pool (its source and field). Shares and pair model are estimated from all
texts: the E-step takes the posterior of the chains for each distinct text, the M-step sums them up. Each text
is then restored by its most probable chain, word by word, as a text may be damaged in part.

Letters that were lost (U+FFFD, or a question mark in the place of a letter) can't be inverted; the words are
looked up among the undamaged words that differ from them only in letters outside ASCII.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.runtime import cut, small_side

#: The chains, as pairs (encoding that the bytes were read in, encoding that they are in).
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = (
    (),
    (("cp1252", "utf-8"),), (("latin-1", "utf-8"),), (("mac_roman", "utf-8"),), (("cp437", "utf-8"),), (("cp850", "utf-8"),), (("cp1251", "utf-8"),), (("iso8859-15", "utf-8"),), (("cp1250", "utf-8"),), (("koi8-r", "utf-8"),),
    (("utf-16-le", "utf-8"),), (("utf-16-be", "utf-8"),), (("utf-16-le", "cp1252"),), (("utf-16-be", "cp1252"),),
    (("cp1252", "utf-8"), ("cp1252", "utf-8")), (("latin-1", "utf-8"), ("latin-1", "utf-8")), (("cp1252", "utf-8"), ("latin-1", "utf-8")), (("latin-1", "utf-8"), ("cp1252", "utf-8")),
    (("cp1252", "utf-8"), ("cp1252", "utf-8"), ("cp1252", "utf-8")),
    (("mac_roman", "cp1252"),), (("cp437", "cp1252"),), (("cp850", "cp1252"),), (("cp1251", "cp1252"),), (("cp1250", "cp1252"),), (("koi8-r", "cp1252"),),
    (("cp1252", "mac_roman"),), (("cp1252", "cp437"),), (("cp1252", "cp850"),), (("cp1252", "cp1251"),),
)
POOLS = 256
WORD_BINS = 1 << 18
ROUNDS = 4
#: Distinct texts that a task judges, as long as all cores have some.
TASK_TEXTS = 20_000
_SMOOTH = 3.0
#: Longer words are scored anew each time.
_KEPT_WORD = 64
#: Part of the occurrences of a text that doesn't count as evidence for the text itself.
_OWN = 0.9


def chain_name(chain: int) -> str:
    return "+".join(f"{true}>{read}" for read, true in reversed(CHAINS[chain])) or "none"


def _to_bytes(text: str, encoding: str) -> bytes | None:
    if encoding.startswith("utf-16"):
        try:
            return text.encode(encoding)
        except UnicodeEncodeError:
            return None
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        pass
    if not encoding.startswith("cp125"):
        return None
    out = bytearray()  # bytes without a letter in a Windows code page are read as control characters
    for ch in text:
        try:
            out += ch.encode(encoding)
        except UnicodeEncodeError:
            if not 0x80 <= ord(ch) <= 0x9F:
                return None
            out.append(ord(ch))
    return bytes(out)


def invert(text: str, chain: int) -> str | None:
    """The text before the chain, null if it can't have come through it."""
    for read, true in CHAINS[chain]:
        data = _to_bytes(text, read)
        if data is None:
            return None
        try:
            text = data.decode(true)
        except UnicodeDecodeError:
            return None
        if read.startswith("utf-16"):
            text = text.rstrip(" \x00")  # the byte that filled up an odd number
    return text


def _is_wide(chain: int) -> bool:
    return any(read.startswith("utf-16") for read, _ in CHAINS[chain])


def _classes(word: str) -> list[str]:
    """The characters of a word as the model sees them: without case, but with a mark where case jumps up."""
    out, small = ["^"], False
    for ch in word:
        n, low = ord(ch), ch.lower()
        if n < 128:
            c = "0" if ch.isdigit() else low
        elif 0xA0 <= n <= 0x17F or 0x2010 <= n <= 0x203A or n == 0x20AC:
            c = low[0]
        elif 0x80 <= n < 0xA0 or n == 0xFFFD:
            c = "C1"
        else:
            c = f"B{n >> 7}"
        out.append("↑" + c if small and ch != low else c)
        small = ch.isalpha() and ch == low
    out.append("$")
    return out


def word_bin(word: str) -> int:
    return zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORD_BINS


class TextModel:
    """Probability of words: half from the frequency of the word, without case, half from pairs of characters.

    Frequencies are kept for words with letters outside ASCII, by a hash in WORD_BINS bins.
    """

    def __init__(self, pairs: dict[tuple[str, str], float], words: dict[int, float]):
        self.pairs, self.words = pairs, words
        self.left: dict[str, float] = defaultdict(float)
        self.right: dict[str, float] = defaultdict(float)
        for (a, b), n in pairs.items():
            self.left[a] += n
            self.right[b] += n
        self.all = sum(self.left.values()) + 1.0
        self.n_words = self.left.get("^", 0.0) + 1.0
        self.known: dict[str, float] = {}

    def score(self, word: str, without: float = 0.0) -> float:
        """Log-probability of the word; without: occurrences of the word's own text, which are little evidence for it."""
        spelt = self.known.get(word)
        if spelt is None:
            spelt = self._spelt(word)
            if len(word) <= _KEPT_WORD:
                if len(self.known) > 300_000:
                    self.known.clear()
                self.known[word] = spelt
        seen = 0.0 if word.isascii() else self.words.get(word_bin(word), 0.0) - _OWN * without
        if seen < 0.5:
            return spelt
        x, y = spelt - 0.69, math.log(0.5 * seen / self.n_words)
        return max(x, y) + math.log1p(math.exp(-abs(x - y)))

    def _spelt(self, word: str) -> float:
        seen, total = _classes(word), 0.0
        for a, b in zip(seen, seen[1:]):
            if b[0] == "B" or b[:2] == "C1":  # a class of 128 characters
                total -= 4.85
            base = (self.right.get(b, 0.0) + 0.01) / (self.all + 50)
            total += math.log((self.pairs.get((a, b), 0.0) + _SMOOTH * base) / (self.left.get(a, 0.0) + _SMOOTH))
        return total


def _words(text: str) -> list[str]:
    return text.split(" ")


def candidates(text: str) -> dict[int, list[tuple[str, str | None]]]:
    """For each chain by which the text can have come: its words and, for the words that it changes, their inverses."""
    words, out = _words(text), {}
    for chain in range(len(CHAINS)):
        if not chain:
            out[0] = [(w, None) for w in words]
            continue
        if _is_wide(chain):
            whole = None if text.isascii() else invert(text, chain)
            if whole and whole != text and all(ch.isprintable() for ch in whole):
                out[chain] = [(text, whole)]
            continue
        inverses = [None if w.isascii() else _word_inverse(w, chain) for w in words]
        if any(i is not None for i in inverses):
            out[chain] = list(zip(words, inverses))
    return out


@lru_cache(200_000)
def _word_inverse(word: str, chain: int) -> str | None:
    found = invert(word, chain)
    if found is None and CHAINS[chain][0][1] == "utf-8":
        found = invert(word + "\xa0", chain)  # a no-break space that became a blank
    return None if found is None or found == word else found


def likelihoods(text: str, model: TextModel, occurrences: float) -> list[tuple[int, float, str]]:
    """(chain, log-likelihood, restored text) of the chains that the text can have come by; the first is no chain."""
    found = []
    for chain, words in candidates(text).items():
        total, restored = 0.0, []
        for word, inverse in words:
            if inverse is None:
                total += model.score(word, occurrences)
                restored.append(word)
                continue
            changed = sum(map(model.score, _words(inverse))) + math.log(0.8)
            kept = model.score(word, occurrences) + math.log(0.2)
            total += max(changed, kept)
            restored.append(inverse if changed >= kept else word)
        result = " ".join(restored)
        if not chain or result != text:
            found.append((chain, total, result))
    return found


def posterior(found: list[tuple[int, float, str]], shares: list[float]) -> list[tuple[int, float, str]]:
    """(chain, probability, restored text) from the likelihoods and the shares of the chains in a pool."""
    logs = [t + math.log(shares[c]) for c, t, _ in found]
    most = max(logs)
    weights = [math.exp(x - most) for x in logs]
    whole = sum(weights)
    return [(c, w / whole, r) for (c, _, r), w in zip(found, weights)]


def _first_weight(text: str) -> float:
    """Before anything is known, texts that are well-formed garble count little for the pair model."""
    if text.isascii():
        return 1.0
    odd = any(0x80 <= ord(ch) < 0xA0 or ord(ch) > 0x2BFF for ch in text)
    return 0.02 if odd or any(CHAINS[c][0][1] == "utf-8" for c in candidates(text) if c) else 1.0


def _sums(batches: Iterator[pa.RecordBatch], model: TextModel | None, shares: dict[int, list[float]]) -> Iterator[pa.RecordBatch]:
    """Expected pair and chain counts of the distinct texts (value, pools); the M-step adds them up."""
    pairs: dict[tuple[str, str], float] = defaultdict(float)
    chains: dict[tuple[int, int], float] = defaultdict(float)
    words: dict[int, float] = defaultdict(float)

    def add(text: str, weight: float) -> None:
        for word in _words(text):
            seen = _classes(word)
            for pair in zip(seen, seen[1:]):
                pairs[pair] += weight
            if not word.isascii():
                words[word_bin(word)] += weight

    for batch in batches:
        for text, pools in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            plain = model is None or text.isascii()
            found = [] if plain else likelihoods(text, model, sum(x["n"] for x in pools))
            weight = _first_weight(text) if model is None else 1.0
            for x in pools:
                pool, n = x["pool"], x["n"]
                if plain:
                    add(text, n * weight)
                    chains[pool, 0] += n
                    continue
                for chain, share, restored in posterior(found, shares[pool]):
                    if share > 1e-3:
                        add(restored, n * share)
                        chains[pool, chain] += n * share
    rows = [("pair", a, b, w) for (a, b), w in pairs.items()] + [("chain", str(p), str(c), w) for (p, c), w in chains.items()] + [("word", str(b), "", w) for b, w in words.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=["kind", "a", "b", "weight"])


def _expected(values: DataFrame, model: TextModel | None, shares: dict[int, list[float]]) -> list:
    """The summed rows of _sums over values: at most (classes of characters)^2 pairs, POOLS * fields * chains shares and WORD_BINS words, whatever the input."""
    given = values.sparkSession.sparkContext.broadcast(((model.pairs, model.words) if model else None, shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, own = given.value
        return _sums(batches, TextModel(*learned) if learned else None, own)

    return values.mapInArrow(run, "kind string, a string, b string, weight double").groupBy("kind", "a", "b").agg(F.sum("weight").alias("weight")).collect()


def _maximise(rows: list, first: bool) -> tuple[TextModel, dict[int, list[float]]]:
    """The pair model and the shares of the chains in each pool, from expected counts."""
    pairs: dict[tuple[str, str], float] = defaultdict(float)
    words: dict[int, float] = defaultdict(float)
    counts: dict[int, list[float]] = {}
    whole = [0.0] * len(CHAINS)
    for r in rows:
        if r.kind == "pair":
            pairs[r.a, r.b] += r.weight
        elif r.kind == "word":
            words[int(r.a)] += r.weight
        else:
            counts.setdefault(int(r.a), [0.0] * len(CHAINS))[int(r.b)] += r.weight
            whole[int(r.b)] += r.weight
    base = [(w + (20.0 if c == 0 else 0.5)) for c, w in enumerate(whole)]
    base = [b / sum(base) for b in base]
    learned = TextModel(dict(pairs), dict(words))
    if first:  # no chain was weighed yet
        base = [0.9] + [0.1 / (len(CHAINS) - 1)] * (len(CHAINS) - 1)
        return learned, {p: base for p in counts}
    prior = 20.0
    return learned, {p: [(n + prior * b) / (sum(c) + prior) for n, b in zip(c, base)] for p, c in counts.items()}


def _loss_key(word: Column) -> Column:
    """The word with each run of letters that aren't ASCII, or were lost, as one question mark."""
    return F.regexp_replace(F.lower(word), r"[^\x00-\x7F]+|\?+", "?").alias("key")


def _split_words(values: DataFrame, text: str) -> DataFrame:
    return values.select("pool", "value", F.posexplode(F.split(text, " ", -1)).alias("at", "word"))


def repair(records: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """record_id, field, original, restored, chain, probability, status for the damaged ones of records (record_id, field, source, value).

    status is restored, or lost where letters can't be had back or a whole word is a guess (restored then has what could be). chain names
    the encodings, letters that were lost have the chain lost. Null and empty values are never damaged. Pools
    are field and source, the sources hashed to at most POOLS a field. Repeated record ids give repeated rows.
    """
    pooled = records.select("record_id", "field", "value", F.pmod(F.xxhash64("field", F.coalesce("source", F.lit(""))), F.lit(POOLS)).cast("int").alias("pool"))
    counted = pooled.where("value is not null and value <> ''").groupBy("value", "pool").agg(F.count(F.lit(1)).alias("n"))
    values = cut(counted.groupBy("value").agg(F.collect_list(F.struct("pool", "n")).alias("pools")))  # a text has at most POOLS * fields pools
    # texts of ASCII letters came through no chain: what they add to the model is the same in every round
    is_odd = F.col("value").rlike(r"[^\x00-\x7F]")
    plain, odd = values.where(~is_odd), cut(values.where(is_odd))
    # the rounds are Python's work: every core has texts, and no task too many
    odd = cut(odd.repartition(max(records.sparkSession.sparkContext.defaultParallelism, -(-odd.count() // TASK_TEXTS))))
    model, shares, always = None, {}, _expected(plain, None, {})
    for k in range(rounds):
        model, shares = _maximise(always + _expected(odd, model, shares), k == 0)
    given = values.sparkSession.sparkContext.broadcast((model.pairs, model.words, shares))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, known, own = given.value
        final, names = TextModel(pairs, known), [chain_name(c) for c in range(len(CHAINS))]
        for batch in batches:
            out = []
            for text, pools in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = likelihoods(text, final, sum(x["n"] for x in pools))
                for x in pools:
                    weighed = posterior(found, own[x["pool"]])
                    intact = weighed[0][1]
                    chain, _, best = max(weighed[1:], key=lambda w: w[1]) if intact < 0.5 else weighed[0]
                    out.append((x["pool"], text, x["n"], best, names[chain], 1 - intact if chain else intact))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.float64()))], names=["pool", "value", "n", "restored", "chain", "probability"])

    unharmed = plain.select("value", F.explode("pools").alias("x")).select("x.pool", "value", "x.n", F.col("value").alias("restored"), F.lit(chain_name(0)).alias("chain"), F.lit(1.0).alias("probability"))
    judged = cut(odd.mapInArrow(judge, "pool int, value string, n long, restored string, chain string, probability double").unionByName(unharmed))

    words = judged.select(F.explode(F.split("restored", " ", -1)).alias("word"), "n").where(F.col("word").rlike(r"[^\x00-\x7F]") & ~F.col("word").rlike(r"[\x{FFFD}\x{80}-\x{9F}?]"))
    spelled = words.groupBy(_loss_key(F.col("word")), "word").agg(F.sum("n").alias("n"))
    lexicon = spelled.groupBy("key").agg(F.max_by("word", F.struct("n", "word")).alias("known"))
    lossy = judged.where(F.col("restored").rlike(r"[?\x{FFFD}]"))
    parts = _split_words(lossy, "restored").withColumn("last", F.col("at") == F.max("at").over(_by_value()))
    hurt = F.col("word").rlike(r"[?\x{FFFD}]")
    # no undamaged word has a key of the lexicon; a key of its own each keeps them from meeting in one task
    whole = F.concat(F.lit("="), F.xxhash64("pool", "value", "at").cast("string"))
    found = parts.withColumn("key", F.when(hurt, _loss_key(F.col("word"))).otherwise(whole)).join(small_side(lexicon), "key", "left")
    # a question mark by itself at the end of a text, or behind a word, is rightful unless a word is known that lost a letter there
    closing = F.col("last") & (F.col("word") == "?")
    lost = hurt & (F.col("word").rlike(r"\x{FFFD}|\?\p{L}") | (F.col("known").isNotNull() & ~closing))
    known = F.when(F.col("word") == F.upper("word"), F.upper("known")).otherwise(F.col("known"))
    settled = found.select("pool", "value", "at", lost.alias("lost"), (lost & (F.col("known").isNull() | (F.col("key") == "?"))).alias("gone"), F.when(lost, F.coalesce(known, "word")).otherwise(F.col("word")).alias("word"))
    mended = settled.groupBy("pool", "value").agg(F.max("lost").alias("lost"), F.max("gone").alias("gone"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("mended"))

    damaged = (
        judged.join(mended, ["pool", "value"], "left")
        .where((F.col("chain") != "none") | F.coalesce("lost", F.lit(False)) | F.col("value").rlike(r"[\x{80}-\x{9F}]"))
        .select("pool", "value", F.coalesce("mended", "restored").alias("restored"), F.when(F.coalesce("lost", F.lit(False)) & (F.col("chain") == "none"), "lost").otherwise(F.col("chain")).alias("chain"), "probability", F.when(F.coalesce("gone", F.lit(False)) | F.coalesce("mended", "restored").rlike(r"[\x{80}-\x{9F}]"), "lost").otherwise("restored").alias("status"))
    )
    hits = pooled.join(small_side(cut(damaged)), ["pool", "value"])
    return hits.select("record_id", "field", F.col("value").alias("original"), "restored", "chain", "probability", "status")


def _by_value():
    from pyspark.sql import Window

    return Window.partitionBy("pool", "value")
