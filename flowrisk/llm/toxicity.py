"""Toxicity by noisy-channel deobfuscation.

Writers hide words by look-alike characters, spacing and repetition. A stretch of text
that shows one of these is a lattice: a character may stand for itself or a letter it
looks like, a repeated letter may be noise, a separator may be noise or end a word. The
Viterbi path under a character trigram model and the channel's costs is the restored
text. Stretches without such signs have one path and stay as they are.

Restored words are scored by their features, the word and, where it is common to several
words, its beginning of three to seven letters. A feature is either telling, that is found in toxic texts almost only, or says
nothing; labelled training texts give the odds for it, starting from ``TELLING``. A
text's score is that of its most telling feature.

Decoding is exact but dear, so it is done where it can matter. Toxic training texts are
decoded in full. Their features are counted first in the clean texts' words as they stand;
most cannot tell any more. A pattern of the others (`admitting`) says whether a lattice can
spell one of them at all; in clean training texts and in scoring only such stretches are
decoded. This changes no result: words with no feature in the table have no say.

Defined cases: null and empty texts have no feature and the score of one that says
nothing; equal texts get equal scores; equal texts of one label count once; labels that are
null, or of unknown ids, count for nothing, and without toxic labels no feature tells; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from flowrisk.session import written

# Letters that a character stands in for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "€": "e", "£": "l", "¡": "i",
    "*": "abcdefghijklmnopqrstuvwxyz",
}
SEPARATORS = " .-_,~'·"
# Costs of the channel, as negative logarithms of its probabilities.
SWAP, WILD, ODD, REPEAT, JOIN, SPLIT = 1.0, 3.5, 4.0, 0.7, 0.3, 1.5

SYMBOLS = 64          # characters the language model tells apart; it has their cube at most
TELLING = 1e-4        # share of features that tell, before any is seen
PURE = 0.995          # share of toxic texts among those with a telling feature
PREFIXES = range(3, 8)
SUPPORT = 3           # different toxic texts a telling feature occurs in
BROADCAST = 300_000   # features sent to every worker; more are joined
PATTERN = 5_000       # features that are made a pattern; with more of them all stretches are decoded
FEW = 12              # states of a path that is found first
BORDERS = 3           # groups of signs at each end of a word that are tried as letters, besides all of them
TOXIC_FROM = 0.7
WINDOW, OVERLAP = 400, 200  # signs decoded together, and those shared by neighbouring windows
WILD_AT = {c: i for i, c in enumerate(LOOKS_LIKE["*"])}
START, END, OTHER = "\x02", "\x03", "\x01"

_SYMBOL = "".join(re.escape(c) for c in LOOKS_LIKE)
_ONE = rf"(?:[^\W\d_]|[{_SYMBOL}])"
# At least four single characters, each set apart from the next.
_SPACED = re.compile(rf"(?<![^\s.,;:!?()]){_ONE}(?:[ .\-_,~'·]{{1,2}}{_ONE}){{3,}}(?![^\s.,;:!?()])")
# Every such stretch has this after its first character; it starts with a separator, so it is quick to look for.
_HALF_SPACED = re.compile(rf"[ .\-_,~'·](?={_ONE}[ .\-_,~'·]{{1,2}}{_ONE}[ .\-_,~'·])")
_TWISTED = re.compile(rf"[^\W\d_][.\-_~'·]*[{_SYMBOL}]|[{_SYMBOL}][.\-_~'·]*[^\W\d_]|[^\W\d_][.\-_~'·]+[^\W\d_]|(.)\1\1")
_TRIPLE = re.compile(r"(.)\1\1")
_SIGNS = re.compile(rf"(?=[\d*]*[^\d*])[{_SYMBOL}]{{3,}}")  # a word may hide in signs alone, but not in a number
_EDGE = " \t\n\r\x0b\x0c.,;:?\"')[]{}>"  # nothing that stands for a letter
_SEPARATOR_SIGNS = "".join(re.escape(c) for c in SEPARATORS)
_INNER = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class CharacterModel:
    """Interpolated character trigrams; ``counts`` has strings of one to three symbols."""

    counts: dict[str, float]
    alphabet: frozenset[str]
    _known: dict[str, float] = field(default_factory=dict)
    _cube: np.ndarray | None = None

    def cost(self, before: str, c: str) -> float:
        """Negative log probability of ``c`` after the two characters ``before``."""
        key = before + c
        if key not in self._known:
            before = "".join(x if x in self.alphabet or x in (START, END) else OTHER for x in before)
            c = c if c in self.alphabet or c == END else OTHER
            p, n = 1.0 / (len(self.alphabet) + 2), self.counts
            for context in ("", before[1:], before):
                seen, whole = n.get(context + c, 0.0), n.get(context + "*", 0.0)
                p = (seen + 5.0 * p) / (whole + 5.0)
            self._known[key] = -math.log(p)
        return self._known[key]

    def cube(self) -> np.ndarray:
        """The cost of each letter a wild sign may stand for after each two of them."""
        if self._cube is None:
            letters = LOOKS_LIKE["*"]
            self._cube = np.array([[[self.cost(a + b, c) for c in letters] for b in letters] for a in letters])
        return self._cube


def decode(noisy: str, model: CharacterModel) -> str:
    """The likeliest clear text of a lower-case stretch, among all states, at most the square of the letters at a place.

    Where signs for any letter make them many, some path of few states is found first; states
    that cannot end at its cost, whatever follows, are no part of the likeliest path.
    """
    most = _decoded(noisy, model, math.inf, FEW)[1] if noisy.count("*") > 1 else math.inf
    return _decoded(noisy, model, most, None)[0]


def _least(noisy: str) -> Iterator[float]:
    """Costs that no step over a sign is below, sign by sign."""
    before = ""  # the last sign but separators
    for o in noisy:
        if o in SEPARATORS:
            yield min(JOIN, SPLIT)
            continue
        # Only behind itself a sign for any letter may be a repetition.
        repeats = o == before or len(LOOKS_LIKE.get(o, "")) <= 2
        yield 0.0 if o.isalpha() else min(SWAP, WILD, ODD, REPEAT) if repeats else min(WILD, ODD)
        before = o


def _decoded(noisy: str, model: CharacterModel, most: float, few: int | None) -> tuple[str, float]:
    """The likeliest text and its cost, of paths that cost up to ``most``; of the ``few`` cheapest states at a place, if given."""
    places = [{START + START: (0.0, "", "")}]  # of each state: cost, the state before and what was added
    known = model._known
    least = list(_least(noisy)) if most < math.inf else [0.0] * len(noisy)
    left = sum(least)
    for o, sure in zip(noisy, least):
        paths = places[-1]
        step: dict[str, tuple[float, str, str]] = {}

        def offer(state: str, cost: float, before: str, out: str) -> None:
            if state not in step or cost < step[state][0]:
                step[state] = (cost, before, out)

        likes = LOOKS_LIKE.get(o, "")
        dense = len(likes) > 2 and len(paths) > 100
        if dense:
            _any_letter(paths, model, step)
        itself = [(o, 0.0 if o.isalpha() else ODD)]
        stands = itself + [(c, WILD if len(likes) > 2 else SWAP) for c in likes]
        for state, (cost, *_) in paths.items():
            last = state[1]
            if o in SEPARATORS:
                offer(state, cost + JOIN, state, "")
                if last != START:
                    offer(START + START, cost + SPLIT + model.cost(state, END), state, " ")
                continue
            # Written out without calls: most of the time goes here.
            for c, price in itself if dense and state[0] in WILD_AT and last in WILD_AT else stands:
                chance = known.get(state + c)
                whole = cost + price + (model.cost(state, c) if chance is None else chance)
                best = step.get(last + c)
                if best is None or whole < best[0]:
                    step[last + c] = (whole, state, c)
            if last == o or last in likes and len(likes) <= 2:
                offer(state, cost + REPEAT, state, "")
        if few is not None and len(step) > few:
            step = dict(sorted(step.items(), key=lambda x: x[1][0])[:few])
        elif most < math.inf:
            left -= sure
            bound = most - left + 1e-6
            step = {state: found for state, found in step.items() if found[0] <= bound}
        places.append(step)
    whole, state = min((cost + model.cost(state, END), state) for state, (cost, *_) in places[-1].items())
    out = []
    for step in reversed(places):
        _, state, added = step[state] if state in step else (0.0, state, "")
        out.append(added)
    return "".join(reversed(out)), whole


def _any_letter(paths: dict, model: CharacterModel, step: dict) -> None:
    """Offers any letter after the states of two letters, by arrays: there are up to 676 states."""
    n, letters = len(WILD_AT), LOOKS_LIKE["*"]
    costs = np.full((n, n), np.inf)
    for state, (cost, *_) in paths.items():
        if state[0] in WILD_AT and state[1] in WILD_AT:
            costs[WILD_AT[state[0]], WILD_AT[state[1]]] = cost
    whole = costs[:, :, None] + model.cube()
    first, best = whole.argmin(axis=0).tolist(), (whole.min(axis=0) + WILD).tolist()
    for i, b in enumerate(letters):
        for j, c in enumerate(letters):
            if best[i][j] < math.inf:
                step[b + c] = (best[i][j], letters[first[i][j]] + b, c)


def decoded(text: str, model: CharacterModel, admits: re.Pattern | None = None) -> Iterator[list[str]]:
    """Words of a decoded stretch, window by window: each word of up to ``OVERLAP`` signs is whole in one of them.

    With ``admits`` only of windows in which it is found.
    """
    for at in range(0, max(len(text) - OVERLAP, 1), WINDOW - OVERLAP):
        part = text[at:at + WINDOW]
        if admits is None or admits.search(part):
            yield _LETTERS.findall(decode(part, model))


def spaced(text: str, model: CharacterModel, admits: tuple[re.Pattern, re.Pattern] | None = None) -> Iterator[list[str]]:
    """Words of the stretches of single characters in a lower-case text, of those that ``admits`` lets pass.

    Where one word ends there is often left open; so all ends of a decoded word go along.
    """
    for stretch in stretches(text):
        for words in decoded(stretch, model, None if admits is None else admits[1]):
            yield [w[i:] for w in words for i in range(max(1, len(w) - 3))]


def stretches(text: str) -> Iterator[str]:
    """What ``_SPACED`` finds in a text, tried only where one or two signs further on ``_HALF_SPACED`` is found."""
    end, half = 0, _HALF_SPACED.search(text)
    while half:
        at = half.start()
        for start in range(max(end, at - 2), at):
            m = _SPACED.match(text, start)
            if m:
                yield m.group()
                end = at = m.end()
                break
        half = _HALF_SPACED.search(text, max(at, half.start() + 1))


def _borders(run: str) -> list[int]:
    """How many signs of a run beside a word may belong to it: none, or whole groups of a sign that stands for a letter."""
    reach = next((k for k, c in enumerate(run) if c not in LOOKS_LIKE and c not in SEPARATORS), len(run))
    ends = [k for k in range(1, reach + 1) if run[k - 1] in LOOKS_LIKE and run[k - 1:k] != run[k:k + 1]]
    return [0, *ends[:BORDERS], *ends[BORDERS:][-1:]]


def admitting(features: Iterable[str]) -> tuple[re.Pattern, re.Pattern]:
    """Patterns found in every lower-case stretch whose lattice can spell a word with one of the features:
    one for words as they are decoded, one for their ends as well.

    Between the letters of a word a lattice drops separators, and signs that stand for the
    letter before; so each letter is one or more signs for it, with separators among them.
    A letter is never dropped but for its repetition, so a word begins behind no letter and
    a whole word ends before none.
    """
    trie: dict = {}  # END under the last letter of a whole word, "" alone under that of a beginning
    for kind, letters in sorted(((f[0], f[1:]) for f in features), key=lambda x: (len(x[1]), x[0])):
        node = trie
        for c in letters:
            if "" in node:  # a beginning of it is enough
                break
            node = node.setdefault(c, {})
        else:
            if kind == "^":
                node.clear()
                node[""] = {}
            elif "" not in node:
                node[END] = {}
    stands = {}
    for sign, letters in LOOKS_LIKE.items():
        for c in letters:
            stands.setdefault(c, set()).add(sign)

    def written_out(node: dict) -> str:
        branches = []
        for c, below in node.items():
            if c == END:
                branches.append(r"(?![^\W\d_])")
                continue
            signs = "".join(re.escape(x) for x in sorted({c, *stands.get(c, ())}))
            branches.append(f"[{signs}]" + ("" if "" in below else f"[{signs}{_SEPARATOR_SIGNS}]*" + written_out(below)))
        return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"

    found = written_out(trie) if trie else r"(?!)"
    return re.compile(rf"(?<![^\W\d_]){found}"), re.compile(found)


def tripled(text: str) -> set[str]:
    """The tokens of a text in which a character comes three times in a row."""
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found, end = set(), 0
    for at in np.flatnonzero((signs[2:] == signs[1:-1]) & (signs[1:-1] == signs[:-2])).tolist():
        if at < end or text[at].isspace():
            continue  # in the token before
        begin = end = at
        while begin and not text[begin - 1].isspace():
            begin -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        found.add(text[begin:end])
    return found


def readings(token: str) -> list[str]:
    """The stretches of a token that may be a disguised word: signs at its ends hide letters, or are none of the word."""
    token = token.strip(_EDGE)
    inner = _INNER.search(token)
    if inner is None:
        return [token]
    low, high = inner.span()
    ends = [high + k for k in _borders(token[high:])]
    return [token[low - k:end] for k in _borders(token[:low][::-1]) for end in ends]


class Restorer:
    """Words of texts, restored; remembers words it has seen, up to a bound.

    With ``features``, tokens and stretches that can spell none of them are left out: of
    words as they stand those with a feature are picked by look-ups, of all others
    (with signs, or a character three times in a row) those that `admitting` lets pass.
    """

    def __init__(self, model: CharacterModel, features: Iterable[str] | None = None):
        self.model, self.known, self.admits = model, {}, None
        if features is not None:
            features = frozenset(features)
            self.admits = admitting(features)
            self.whole = frozenset(f[1:] for f in features if f[0] == "=")
            self.begins = frozenset(f[1:] for f in features if f[0] == "^")
            self.lengths = sorted({len(f) for f in self.begins})
            self.least = frozenset(f[:self.lengths[0]] for f in self.begins)

    def of_token(self, token: str) -> tuple[str, ...]:
        if token not in self.known:
            if len(self.known) > 300_000:
                self.known.clear()
            plain = token.strip(_EDGE)
            if plain.isalpha() and not _TRIPLE.search(plain):
                self.known[token] = (plain,)
                return self.known[token]
            words = {}
            for core in readings(token):
                if _TWISTED.search(core) or _SIGNS.fullmatch(core):
                    for part in decoded(core, self.model, None if self.admits is None else self.admits[0]):
                        words.update(dict.fromkeys(part))
                else:
                    words.update(dict.fromkeys(_LETTERS.findall(core)))
            self.known[token] = tuple(words)
        return self.known[token]

    def tokens(self, text: str) -> set[str]:
        """The tokens of a lower-case text that may have a say, without punctuation around them."""
        bare = {t if t.isalpha() else t.strip(_EDGE) for t in set(text.split())}
        if self.admits is None:
            return bare
        found = {t for t in bare if not t.isalpha()}
        found |= self.whole & bare
        if self.lengths:
            n = self.lengths[0]
            found.update([t for t in bare if t[:n] in self.least and any(t[:k] in self.begins for k in self.lengths)])
        return found | tripled(text)

    def words(self, text: str) -> set[str]:
        """Distinct restored words of a text, in lower case; with features at least those that have one."""
        text = text.lower()
        found = set()
        for words in spaced(text, self.model, self.admits):
            found.update(words)
        for token in self.tokens(text):
            found.update(self.of_token(token))
        return found


def _held_out(doc_id="doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, weight) of the labelled documents that may be learned from.

    Of equal texts with one label only those of the smallest id are listed, and the weights
    of repeated rows of that id make one. Texts move once; copies are found by their hashes.
    """
    told = labels.filter(F.col("toxic").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    texts = docs.filter(~_held_out() & F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    first = (
        texts.select("doc_id", "_hash").join(told, F.col("doc_id") == F.col("_id"))
        .groupBy("_hash", "toxic", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("_hash", "toxic").agg(F.min(F.struct("doc_id", "rows")).alias("first"))
        .select(F.col("_hash").alias("_same"), "toxic", F.col("first.doc_id").alias("_id"), (1 / F.col("first.rows")).alias("weight"))
    )
    return texts.join(first, (F.col("doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_same"))).select("text", "toxic", "weight")


def character_model(texts: DataFrame) -> CharacterModel:
    """Counts of up to three characters in the words of ``texts``, over its commonest characters."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words: Counter = Counter()
            for text in batch["text"]:
                words.update(set(_LETTERS.findall(text.lower())))
            grams: Counter = Counter()
            for w, n in words.items():
                padded = START + START + w + END
                for i in range(2, len(padded)):
                    grams[padded[i - 2:i + 1]] += n
            yield pd.DataFrame({"gram": pd.Series(list(grams), dtype=object), "n": pd.Series(list(grams.values()), dtype="int64")})

    grams = written(texts.select("text").mapInPandas(count, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), "characters")
    common = grams.groupBy(F.substring("gram", 3, 1).alias("c")).agg(F.sum("n").alias("n"))
    common = common.filter(F.col("c") != END).orderBy(F.desc("n"), "c").limit(SYMBOLS).collect()
    alphabet = frozenset(r["c"] for r in common)
    # Rare characters become one symbol, so at most (SYMBOLS + 3) ** 3 rows are left.
    folded = F.regexp_replace("gram", f"[^{START}{END}" + "".join(re.escape(c) for c in sorted(alphabet)) + "]", OTHER)
    counts: dict[str, float] = defaultdict(float)
    for r in grams.groupBy(folded.alias("gram")).agg(F.sum("n").alias("n")).collect():
        g, n = r["gram"], float(r["n"])
        for k in range(3):
            counts[g[k:]] += n
            counts[g[k:2] + "*"] += n
    return CharacterModel(dict(counts), alphabet)


def _features(word: str) -> list[str]:
    return ["=" + word, *["^" + word[:k] for k in PREFIXES if k < len(word)]]


def _toxic_words(texts: DataFrame, model: CharacterModel) -> DataFrame:
    """(word, mark): restored words of the toxic texts, a mark for each text."""
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for batch in batches:
            found = list({(w, xxhash.xxh3_64_intdigest(t) >> 1) for t in batch["text"] for w in restorer.words(t)})
            yield pd.DataFrame({"word": pd.Series([w for w, _ in found], dtype=object), "mark": pd.Series([m for _, m in found], dtype="int64")})

    return texts.filter("toxic = 1").mapInPandas(words, "word string, mark bigint").distinct()


def _plain_words(texts: DataFrame) -> DataFrame:
    """(word, clean): the weight of the clean texts that have a word as a token, but for punctuation around it."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            clean: Counter = Counter()
            for text, weight in zip(batch["text"], batch["weight"]):
                words = {t if t.isalpha() else t.strip(_EDGE) for t in set(text.lower().split())}
                if weight == 1.0:
                    clean.update(words)
                else:
                    for w in words:
                        clean[w] += weight
            plain = [w for w in clean if w.isalpha() and not _TRIPLE.search(w)]
            yield pd.DataFrame({"word": pd.Series(plain, dtype=object), "clean": pd.Series([clean[w] for w in plain], dtype="float64")})

    return texts.filter("toxic = 0").mapInPandas(count, "word string, clean double").groupBy("word").agg(F.sum("clean").alias("clean"))


def _clean_words(texts: DataFrame, model: CharacterModel, wanted: list[str] | None) -> DataFrame:
    """(word, clean): the weight of the clean texts that have a restored word with a feature of ``wanted`` (None: any word)."""
    listed = None if wanted is None else frozenset(wanted)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, has = Restorer(model, wanted), {}
        for batch in batches:
            clean: Counter = Counter()
            for text, weight in zip(batch["text"], batch["weight"]):
                for w in restorer.words(text):
                    if listed is not None:
                        if w not in has:
                            has[w] = any(f in listed for f in _features(w))
                        if not has[w]:
                            continue
                    clean[w] += weight
            if len(has) > 1_000_000:
                has.clear()
            yield pd.DataFrame({"word": pd.Series(list(clean), dtype=object), "clean": pd.Series(list(clean.values()), dtype="float64")})

    return texts.filter("toxic = 0").mapInPandas(count, "word string, clean double").groupBy("word").agg(F.sum("clean").alias("clean"))


def telling_features(texts: DataFrame, model: CharacterModel) -> tuple[DataFrame, float]:
    """(feature, chance): features and the chance that a text with one is toxic; and that of any other text.

    A feature must occur in ``SUPPORT`` different toxic texts, however many there are.
    """
    totals = texts.agg(*[F.coalesce(F.round(F.sum(x), 3), F.lit(0.0)).alias(n) for n, x in (
        ("n", F.col("weight")), ("t", F.when(F.col("toxic") == 1, F.col("weight"))))]).collect()[0]
    rate = (totals["t"] + 0.5) / (totals["n"] + 1.0)
    prefixes = [F.when(F.length("word") > k, F.concat(F.lit("^"), F.substring("word", 1, k))) for k in PREFIXES]
    listed = F.explode(F.array(F.concat(F.lit("="), "word"), *prefixes)).alias("feature")
    pairs = written(_toxic_words(texts, model), "toxic-words").select(listed, "word", "mark").filter("feature is not null")
    told = pairs.select("feature", "mark").distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("toxic"))
    # A beginning that owes most to one word says no more than that word.
    most = pairs.groupBy("feature", "word").agg(F.count(F.lit(1)).alias("n")).groupBy("feature").agg(F.max("n").alias("most"))
    told = told.join(most, "feature").filter(F.col("feature").startswith("=") | (F.col("most") <= F.col("toxic") / 2))
    told = told.filter(F.col("toxic") >= SUPPORT).select("feature", "toxic")

    def likely(clean_words: DataFrame, told: DataFrame) -> DataFrame:
        clean = clean_words.select(listed, "clean").filter("feature is not null").groupBy("feature").agg(F.round(F.sum("clean"), 3).alias("clean"))
        odds = (math.log(TELLING) + F.col("toxic") * math.log(PURE / rate)
                + F.coalesce("clean", F.lit(0)) * math.log((1 - PURE) / (1 - rate)))
        return told.join(clean, "feature", "left").withColumn("odds", odds).filter("odds > -4.0")

    # Words as they stand are a part of the restored ones: what cannot tell now, cannot at last.
    open_ = written(likely(_plain_words(texts), told).select("feature", "toxic"), "toxic-candidates")
    wanted = [r["feature"] for r in open_.collect()] if open_.count() <= PATTERN else None
    found = likely(_clean_words(texts, model, wanted), open_)
    telling = 1 / (1 + F.exp(-F.least("odds", F.lit(30.0))))
    return written(found.select("feature", (telling * PURE + (1 - telling) * rate).alias("chance")), "toxic-features"), rate


@dataclass
class ToxicityModel:
    characters: CharacterModel
    features: dict[str, float] | None  # None: there are more than ``BROADCAST``, all of them in ``table``
    rate: float
    table: DataFrame | None = None


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    texts = written(training_texts(docs, labels), "toxic-texts")
    characters = character_model(texts)
    table, rate = telling_features(texts, characters)
    few = table.count() <= BROADCAST
    return ToxicityModel(characters, {r["feature"]: r["chance"] for r in table.collect()} if few else None, rate, table)


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs``, which must not have a column of that name, with score, that of the most telling feature of its restored words."""
    if model.features is None:
        return _scored_by_join(docs, model)
    shared = docs.sparkSession.sparkContext.broadcast(ToxicityModel(model.characters, model.features, model.rate))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        tells, known = model.features, {}
        restorer = Restorer(model.characters, tells if len(tells) <= PATTERN else None)

        def of_words(words) -> float:
            return max([tells[f] for w in words for f in _features(w) if f in tells], default=model.rate)

        for batch in batches:
            scores = []
            for text in batch:
                if len(known) > 300_000:
                    known.clear()
                text = text.lower() if isinstance(text, str) else ""
                best = max([model.rate, *[of_words(words) for words in spaced(text, model.characters, restorer.admits)]])
                for token in restorer.tokens(text):
                    p = known.get(token)
                    if p is None:
                        p = known[token] = of_words(restorer.of_token(token))
                    if p > best:
                        best = p
                scores.append(best)
            yield pd.Series(scores, dtype="float64")

    return docs.withColumn("score", score(F.col("text")))


def _scored_by_join(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """As ``score_texts``, with the table of features joined to the words of the texts instead of broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model.characters)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(shared.value)
        for batch in batches:
            for row, text in zip(batch["_at"], batch["text"]):
                words = restorer.words(text) if isinstance(text, str) else ()
                features = list({f for w in words for f in _features(w)})
                yield pd.DataFrame({"_row": row, "feature": pd.Series(features, dtype=object)})

    rows = written(docs.withColumn("_at", F.monotonically_increasing_id()), "toxic-rows")
    found = rows.select("_at", "text").mapInPandas(listed, "_row bigint, feature string").join(model.table, "feature")
    best = found.groupBy("_row").agg(F.max("chance").alias("_best"))
    score = F.greatest(F.coalesce("_best", F.lit(model.rate)), F.lit(model.rate))
    return rows.join(best, F.col("_at") == F.col("_row"), "left").select(*docs.columns, score.alias("score"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, held_out, score and predicted per row of ``docs``."""
    rows = score_texts(docs.select("doc_id", "text"), fit(docs, labels))
    return rows.select("doc_id", "text", _held_out().alias("held_out"), "score",
                       (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
