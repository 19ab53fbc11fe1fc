"""Toxicity by noisy-channel deobfuscation.

A disguised word is read as what a noisy channel made of a plain one: leetspeak
signs for letters, letters said again and again, signs put around or between
letters, letters spaced apart. Viterbi decoding over the lattice of what each sign
may stand for, under a character trigram model, restores it. A token of letters
alone, none of them twice in a row, has one path through its lattice and is its own
decoding; a token without any letter is a number or a mark and isn't decoded. A gap
between letters or signs spaced apart is in the lattice too: it joins or ends a word. Restored texts are scored by words and word beginnings that are
likelier in toxic texts, and a logistic regression over the strongest of them,
their number and their density.

The character model counts every n-gram of every text, labelled or not. The weights
and the regression are learned from all labelled rows of the learning fold: texts of
either label are counted by token, each distinct token is decoded once, and a feature has
the sum over its tokens; the regression's steps are sums over tasks. The score reads only
the text.

Nulls: a null text is empty; an empty text scores what a text without any found
word does, near the least. Null labels aren't learned. With nothing to learn from
every score is 0. Null ids pass through. Ties: an id with both labels is toxic; of
readings that cost the same the one found first is taken, on every run the same. Repeated rows each give
a row. Texts of any length are read whole, disguised words of any length too. Other
columns, whatever their names, are passed by; keep_clean() returns them. An empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

CUT, LEAST_SUPPORT = 0.3, 3
#: What a sign may stand for in a disguised word.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
#: Marks that stand for no letter.
MARK = rf"(?:(?![{re.escape(''.join(SIGNS))}])[\W_])"
EDGE = re.compile(rf"^{MARK}+|{MARK}+$")
#: The same with signs that are punctuation too where they stand in ordinary text.
OPENS, CLOSES = "(¡", "!"
ORDINARY = re.compile(rf"^(?:{MARK}|[{OPENS}])+|(?:{MARK}|[{CLOSES}])+$")
DOUBLED = re.compile(r"(.)\1")
#: What has more than one path, and the letters after it until all paths are in one state: runs of a letter, and other characters, at most one letter apart.
FORKED = r"(?:([^\W\d_])\{0}+|([\W\d_])\{1}*)"
SEGMENT = re.compile(FORKED.format(1, 2) + r"(?:(?:([^\W\d_])(?!\3))?" + FORKED.format(4, 5) + r")*(?:([^\W\d_])(?!\6)){0,2}")
#: The same step by step, for tokens over so many characters, since the pattern above keeps some 400 bytes a step.
LONG_TOKEN, BEGINS, GOES_ON, ENDS = 1000, re.compile(FORKED.format(1, 2)), re.compile(r"(?:([^\W\d_])(?!\1))?" + FORKED.format(2, 3)), re.compile(r"(?:([^\W\d_])(?!\1)){0,2}")
#: A token of one letter or sign, however often said; three or more of them, and mere marks between, are a run of characters spaced apart.
ONE = rf"([^\W\d_]|[{re.escape(''.join(SIGNS))}])"
SHORT = re.compile(rf"{MARK}*[{OPENS}]*{ONE}\1*[{CLOSES}]*{MARK}*")
RUN = re.compile(r"s[-s]*s")
#: The same in one token.
DOTTED = re.compile(rf"{ONE}\1*(?:[.\-_*]+{ONE.replace('(', '(?P<x>', 1)}(?P=x)*){{2,}}")
#: Costs, as negative logarithms: a sign for a letter, a letter repeated, a mark put between letters, a sign that stands for none.
SUBSTITUTE, REPEAT, INSERT, SPURIOUS = 1.0, 0.7, 0.5, 10.0
#: The same of a gap between characters spaced apart that ends a word, as about one in five does.
SPLIT = 2.0
MOST_CACHED, MOST_COUNTED, STRONG = 200_000, 50_000, 2.5
#: Bytes of text that are read at once, segments and costs that are remembered, and words whose n-grams are counted at once.
SLICE, MOST_KEPT, WORDS_AT_ONCE = 2 << 20, 100_000, 1 << 15
#: Steps of the decoder after which what all paths have in common is settled.
COMMON = 4096


ASCII_MARKS = "".join(c for c in map(chr, range(128)) if re.fullmatch(MARK, c))


def bare(token: str) -> str:
    """A token without the marks around it."""
    core = token.strip(ASCII_MARKS)
    return core if core.isascii() or (core[0].isalnum() and core[-1].isalnum()) else EDGE.sub("", core)


def plain(token: str) -> str:
    """A token without the marks and the punctuation around it."""
    core = token.lstrip(ASCII_MARKS + OPENS).rstrip(ASCII_MARKS + CLOSES)
    return core if core.isascii() or (core[0].isalnum() and core[-1].isalnum()) else ORDINARY.sub("", core)


def with_runs(words: list[str], length: int) -> np.ndarray:
    """Places of the words, none of which holds a line end, that say a character two or three times in a row."""
    codes = np.frombuffer("\n".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    same = codes[1:] == codes[:-1]
    at = np.flatnonzero(same if length == 2 else same[1:] & same[:-1])
    return np.unique(np.searchsorted(np.flatnonzero(codes == 10), at))


def gram_code(gram: str) -> int:
    """One to three characters as a number, 21 bits each."""
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


class Grams:
    """Counts of character n-grams: sorted codes, 16 bytes each, since they grow with the corpus."""

    def __init__(self, codes: np.ndarray, numbers: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.numbers = codes[order], numbers[order]

    @classmethod
    def of(cls, counts: Mapping[int, int]) -> Grams:
        return cls(np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts)))

    def get(self, gram: str) -> int:
        code = gram_code(gram)
        at = int(self.codes.searchsorted(code))
        return int(self.numbers[at]) if at < len(self.codes) and self.codes[at] == code else 0


class CharModel:
    """A trigram model of characters in words, with interpolation."""

    def __init__(self, counts: Grams):
        self.counts = counts
        one = counts.numbers[: int(counts.codes.searchsorted(1 << 21))]
        self.kinds, self.total = max(2, len(one)), max(1, int(one.sum()))
        self.cache: dict[str, float] = {}
        self.segments: dict[tuple[str, str, bool], str] = {}

    def cost(self, before: str, c: str) -> float:
        """Negative log probability of c after the two characters before."""
        if (got := self.cache.get(before + c)) is None:
            if len(self.cache) > MOST_KEPT:
                self.cache.clear()
            g = self.counts.get
            p1 = (g(c) + 0.5) / (self.total + self.kinds)
            p2 = (g(before[-1:] + c) + 4 * p1) / (g(before[-1:]) + 4)
            p3 = (g(before + c) + 4 * p2) / (g(before) + 4)
            got = self.cache[before + c] = -math.log(p3)
        return got

    @staticmethod
    def count(words: Mapping[str, int], into: Counter) -> None:
        """Adds the codes of each word's n-grams as often as it is given."""
        if len(words) > WORDS_AT_ONCE:
            items = iter(words.items())
            while part := dict(islice(items, WORDS_AT_ONCE)):
                CharModel.count(part, into)
            return
        if not words:
            return
        codes = np.frombuffer(("^^" + "$\0\0^^".join(words) + "$\0\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 5
        times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), lengths)[:-2]
        # One sort of three characters at each place; shorter n-grams are their beginnings. What has an end mark is none.
        here = np.flatnonzero(codes[:-2])
        kinds, of = np.unique(codes[here] << 42 | codes[here + 1] << 21 | codes[here + 2], return_inverse=True)
        sums = np.bincount(of, weights=times[here]).astype(np.int64)
        for size in (3, 2, 1):
            whole = kinds & 0x1FFFFF != 0
            for k, n in zip(kinds[whole].tolist(), sums[whole].tolist(), strict=True):
                into[k] += n
            kinds, first = np.unique(kinds >> 21, return_index=True)
            sums = np.add.reduceat(sums, first) if size > 1 else sums


def _letter(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c)[0] == "M" or (c.isalnum() and not c.isdecimal())


def _options(c: str, run: int, opens: bool, closes: bool) -> list[tuple[float, str]]:
    """What a run of c may stand for, with costs."""
    options: list[tuple[float, str]] = []
    if c == " ":
        return [(INSERT, ""), (SPLIT, " ")]
    if _letter(c):
        options.append((REPEAT if run > 1 else 0.0, c))
        if run > 1:
            options.append((0.2 if run == 2 else REPEAT, c * 2))
        return options
    for x in SIGNS.get(c, ""):
        options.append((SUBSTITUTE * 1.0 + (REPEAT if run > 1 else 0.0), x))
        if run > 1:
            options.append((SUBSTITUTE * 1.5, x * 2))
    mark = (opens and c in OPENS) or (closes and c in CLOSES)
    options.append((SPURIOUS if not mark and (c in SIGNS or c.isdigit()) else INSERT, ""))
    if c.isdigit() and not SIGNS.get(c):
        options.append((SUBSTITUTE, c))
    return options


def _likeliest(before: str, segment: str, ends: bool, model: CharModel) -> str:
    """What most likely became segment after the two letters before: Viterbi over states of the last two letters written."""
    costs: dict[str, float] = {before: 0.0}
    done: list[str] = []
    steps: list[dict[str, tuple[str, str]]] = []  # where each state came from, since all paths had last been one
    i, n, most = 0, len(segment), COMMON

    def settle(s: str, upto: int | None = None) -> None:
        back = []
        for came in reversed(steps[:upto]):
            s, letters = came[s]
            back.append(letters)
        done.append("".join(reversed(back)))
        del steps[:upto]

    def settle_beginning() -> None:
        """Settles the steps that all paths have in common."""
        at, k = set(costs), len(steps)
        while k and len(at) > 1:
            k -= 1
            at = {steps[k][s][0] for s in at}
        if k:
            settle(*at, k)

    while i < n:
        c, j = segment[i], i + 1
        while j < n and segment[j] == c:
            j += 1
        first, last = before == "^^" if i == 0 else segment[i - 1] == " ", ends if j == n else segment[j] == " "
        alone = first and last  # a sign spaced apart stands for a letter, unless the text begins or ends with it
        options = _options(c, j - i, first and (not alone or i == 0), last and (not alone or j == n))
        after: dict[str, float] = {}
        came: dict[str, tuple[str, str]] = {}
        for state, cost in costs.items():
            for more, letters in options:
                s, total = state, cost + more
                if letters == " ":
                    s, total = "^^", total + model.cost(s, "$")
                else:
                    for x in letters:
                        total += model.cost(s, x)
                        s = s[1:] + x
                if s not in after or total < after[s]:
                    after[s], came[s] = total, (state, letters)
        steps.append(came)
        costs = after
        if len(costs) == 1:
            settle(*costs)
        elif len(steps) >= most:
            settle_beginning()
            most = max(COMMON, 2 * len(steps))
        i = j
    if steps:
        settle(min((cost + (model.cost(s, "$") if ends else 0.0), s) for s, cost in costs.items())[1])
    return "".join(done)


def _segments(token: str) -> Iterator[tuple[int, int]]:
    """Where each segment with more than one path begins and ends."""
    if len(token) <= LONG_TOKEN:
        yield from (m.span() for m in SEGMENT.finditer(token))
        return
    at = 0
    while m := BEGINS.search(token, at):
        end = m.end()
        while n := GOES_ON.match(token, end):
            end = n.end()
        at = ENDS.match(token, end).end()
        yield m.start(), at


def decode(token: str, model: CharModel) -> str:
    """The plain word that most likely became token; of characters spaced apart, the plain words.

    Letters with one path are copied; each segment around them is decided by itself,
    since all paths are in one state before it and after it, and is remembered.
    """
    out, before, at = [], "^^", 0
    for start, end in _segments(token):
        alone, segment, ends = token[at:start], token[start:end], end == len(token)
        at = end
        before = (before + alone)[-2:]
        key = (before, segment, ends)
        if (got := model.segments.get(key)) is None:
            got = _likeliest(*key, model)
            if len(segment) <= 24:
                if len(model.segments) > MOST_KEPT:
                    model.segments.clear()
                model.segments[key] = got
        out += [alone, got]
        before = (before + got)[-2:]
    return "".join(out) + token[at:]


def spaced(core: str) -> str:
    """The characters of a run with one blank in every gap; empty if it is none."""
    return core if " " in core else re.sub(r"[.\-_*]+", " ", core) if DOTTED.fullmatch(core) else ""


def restored(token: str, model: CharModel) -> list[str]:
    """The words of a lower-case token without the marks around it, decoded if its lattice has more than one path."""
    core = token if token.isalpha() else bare(token)
    if (core.isalpha() and not DOUBLED.search(core)) or not any(map(str.isalpha, core)):
        return [core]
    return decode(spaced(core) or core, model).split()


def word_features(word: str) -> list[str]:
    if len(word) < 3:
        return []
    return ["=" + word, *["^" + word[:k] for k in (4, 5, 6) if len(word) > k]]


def kind_of(token: str) -> str:
    """s for a short token, - for mere marks, a dot for others."""
    if token.isalpha():
        return "s" if token[0] == token[-1] and token.count(token[0]) == len(token) else "."
    if len(token) > 1 and token[0].isalnum() and token[1].isalnum() and token[0] != token[1]:
        return "."
    return "s" if SHORT.fullmatch(token) else "." if bare(token) else "-"


def runs_of(tokens: list[str], kinds: str) -> list[str]:
    """Each run of characters spaced apart, with one blank in every gap."""
    return [" ".join(x for t in tokens[m.start() : m.end()] if (x := bare(t))) for m in RUN.finditer(kinds) if m[0].count("s") > 2] if "s" in kinds else []


def words_of(text: str) -> list[str]:
    """Lower-case tokens, and each run of characters spaced apart with one blank in every gap."""
    tokens = text.lower().split()
    return tokens + runs_of(tokens, "".join(map(kind_of, tokens)))


def features(token: str, model: CharModel) -> list[list[str]]:
    """The features of each restored word."""
    return [word_features(w) for w in restored(token, model)]


# ---- scoring


class Scorer:
    """Model: char counts, weight of each feature, regression coefficients."""

    def __init__(self, model: dict):
        self.chars = CharModel(model["chars"])
        self.weights: dict[str, float] = model["weights"]
        self.coefficients = model["coefficients"]
        self.whole = {f[1:] for f in self.weights if f[0] == "="}
        self.starts = {f[1:5] for f in self.weights if f[0] == "^"}
        self.longest = max(map(len, self.whole), default=0)
        self.met: set[str] = set()
        # Of the tokens met, short ones, mere marks, and those that have weights.
        self.short, self.marks, self.hits = set[str](), set[str](), dict[str, tuple[float, ...]]()

    def weight(self, token: str) -> tuple[float, ...]:
        """The largest weight among the features of each restored word that has one."""
        words = restored(token, self.chars)
        got = tuple(w for w in map(self.heaviest, words) if w)
        if not token.isalpha() and spaced(bare(token)):
            got = max(got, self.strong_within("".join(words)), key=sum)
        return got

    def meet(self, tokens: set[str]) -> None:
        """Takes note of the kinds and the weights of tokens."""
        if len(self.met) > MOST_CACHED:
            for known in (self.met, self.short, self.marks, self.hits):
                known.clear()
        fresh = tokens - self.met
        self.met |= fresh
        words = [t for t in fresh if t.isalpha()]
        forked = {words[i] for i in with_runs(words, 2)}
        self.short.update(t for t in forked if t[0] == t[-1] and kind_of(t) == "s")
        self.short.update(t for t in words if len(t) == 1)
        for t in forked:
            if w := self.heaviest(decode(t, self.chars)):
                self.hits[t] = (w,)
        one_path = [t for t in words if t[:4] in self.starts or t in self.whole]
        self.hits.update((t, (w,)) for t in one_path if t not in forked and (w := self.heaviest(t)))
        for t in fresh.difference(words):
            if (kind := kind_of(t)) != ".":
                (self.short if kind == "s" else self.marks).add(t)
            core = bare(t)
            if core.isalpha() and not DOUBLED.search(core):  # one path
                if w := self.heaviest(core):
                    self.hits[t] = (w,)
            elif got := self.weight(t):
                self.hits[t] = got

    def runs(self, tokens: list[str], own: set[str]) -> list[str]:
        """Each run of characters spaced apart in tokens, all of which have been met; own is their set."""
        if not (short := own & self.short):
            return []
        kinds = dict.fromkeys(own & self.marks, "-") | dict.fromkeys(short, "s")
        return runs_of(tokens, "".join([kinds.get(t, ".") for t in tokens]))

    def heaviest(self, word: str) -> float:
        """The largest weight among a word's features, 0 if it has none."""
        n, g, got = len(word), self.weights.get, 0.0
        if n > 2:
            got = g("=" + word, 0.0)
            if n > 4 and word[:4] in self.starts:
                got = max([got, *[g("^" + word[:k], 0.0) for k in (4, 5, 6) if n > k]])
        return got

    def strong_within(self, letters: str) -> tuple[float, ...]:
        """Weights of the strong words in what a run spells, the longest at each place, wherever Viterbi split it."""
        i, out = 0, []
        while i < len(letters):
            for j in range(min(len(letters), i + self.longest), i + 2, -1):
                if (w := self.weights.get("=" + letters[i:j], 0.0)) > STRONG:
                    out.append(w)
                    i = j
                    break
            else:
                i += 1
        return tuple(out)

    def summary(self, text: str) -> list[float]:
        return self.summaries([text])[0]

    def summaries(self, texts: list[str]) -> list[list[float]]:
        """Of each text the three heaviest words, the sum and number of all that weigh, and the strong ones by a root of all words and by all words."""
        docs = [t.lower().split() for t in texts]
        self.meet(set().union(*docs))
        out = []
        for tokens in docs:
            own = set(tokens)
            found = [(w, tokens.count(t)) for t in self.hits.keys() & own for w in self.hits[t]]
            runs = self.runs(tokens, own)
            found += [(w, n) for t, n in Counter(runs).items() for w in self.weight(t)]
            found.sort(reverse=True)
            top = [w for w, n in found[:3] for _ in range(min(n, 3))] + [0.0] * 3
            total, number = sum(w for w, _ in found), sum(n for _, n in found)
            strong = sum(n for w, n in found if w > STRONG)
            n_all = len(tokens) + len(runs)
            out.append([top[0], top[1], top[2], math.log1p(total), math.log1p(number), math.log1p(strong), 10 * strong / math.sqrt(n_all + 10), 100 * strong / (n_all + 50)])
        return out

    def scores(self, texts: list[str]) -> list[float]:
        return [float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(self.coefficients[1:], x) + self.coefficients[0])))))) for x in self.summaries(texts)]

    def score(self, text: str) -> float:
        return self.scores([text])[0]


def _scorer(sent) -> Scorer:
    """One scorer in each worker process, for the model sent last."""
    own = common.remembered("toxicity")
    if sent.id not in own:
        own.clear()
        own[sent.id] = Scorer(sent.value)
    return own[sent.id]


class _Sent:
    """What is broadcast, with a number of its own."""

    def __init__(self, spark: SparkSession, value: dict):
        self.held = spark.sparkContext.broadcast(value)
        self.id = self.held._jbroadcast.id()

    def __getstate__(self):
        return {"held": self.held, "id": self.id}

    @property
    def value(self) -> dict:
        return self.held.value


# ---- learning


class _Plain(dict[str, str]):
    """The word in each token that is more than letters, empty if there is none."""

    def __missing__(self, token: str) -> str:
        if len(self) > MOST_CACHED:
            self.clear()
        w = plain(token)
        self[token] = w = w if w.isalpha() else ""
        return w


def _count(seen: Counter, into: Counter) -> None:
    """Adds the n-grams of the words seen that say no letter three times in a row."""
    seen.pop("", None)
    words = list(seen)
    for i in with_runs(words, 3).tolist():
        del seen[words[i]]
    CharModel.count(seen, into)
    seen.clear()


def _char_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character n-grams of plain words, counted once for each text that has the word."""
    common.remembered("toxicity")
    into, seen, words = Counter(), Counter(), _Plain()
    for b in common.small_batches(batches, "text", SLICE):
        for text in common.strings(b.column(0)):
            own = set(text.lower().split())
            others = [t for t in own if not t.isalpha()]
            own.difference_update(others)
            own.update([words[t] for t in others])
            seen.update(own)
            if len(seen) > MOST_COUNTED:  # n-grams are far fewer than words
                _count(seen, into)
    _count(seen, into)
    yield pa.RecordBatch.from_arrays([pa.array(list(into), pa.int64()), pa.array(list(into.values()), pa.int64())], names=["k", "n"])
    del into, seen, words
    common.release()


def char_counts(texts: DataFrame) -> Grams:
    """All character n-grams of a table with the one column text, with their counts."""
    found = texts.mapInArrow(_char_counts, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    return Grams(found.column("k").to_numpy(), found.column("n").to_numpy())


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that each token, or run of characters spaced apart, is in, by label."""
    common.remembered("toxicity")
    into, met, short, marks = (Counter(), Counter()), set(), set(), set()

    def flush() -> pa.RecordBatch:
        columns = [pa.array([t for c in into for t in c], pa.string()), pa.array([label for label in (0, 1) for _ in into[label]], pa.int32()), pa.array([n for c in into for n in c.values()], pa.int64())]
        for c in into:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=["t", "label", "n"])

    for b in common.small_batches(batches, "text", SLICE):
        for label, text in zip(b.column(0).to_pylist(), common.strings(b.column(1)), strict=True):
            tokens = text.lower().split()
            own = set(tokens)
            if fresh := own - met:
                if len(met) > MOST_CACHED:
                    for known in (met, short, marks):
                        known.clear()
                    fresh = own
                met |= fresh
                for t in fresh:
                    if (not t.isalpha() or t[0] == t[-1]) and (kind := kind_of(t)) != ".":
                        (short if kind == "s" else marks).add(t)
            if here := own & short:
                kinds = dict.fromkeys(own & marks, "-") | dict.fromkeys(here, "s")
                own.update(runs_of(tokens, "".join([kinds.get(t, ".") for t in tokens])))
            into[label].update(own)
        if len(into[0]) + len(into[1]) > MOST_CACHED:
            yield flush()
    yield flush()
    del into, met, short, marks
    common.release()


def _feature_counts(batches: Iterator[pa.RecordBatch], chars: Grams) -> Iterator[pa.RecordBatch]:
    """Of each feature the sums over tokens (t, texts of either label) that have it; every token is decoded once."""
    model, into = CharModel(chars), (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(into[0].keys() | into[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[f] for f in names], pa.int64()) for c in into]], names=["f", "clean", "toxic"])
        for c in into:
            c.clear()
        return out

    for b in batches:
        for t, *numbers in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            own = {f for word in features(t, model) for f in word}
            for c, n in zip(into, numbers, strict=True):
                if n:
                    for f in own:
                        c[f] += n
        if len(into[0]) + len(into[1]) > MOST_CACHED:
            yield flush()
    yield flush()
    del model, into
    common.release()


def _described(batches: Iterator[pa.RecordBatch], sent: _Sent) -> Iterator[pa.RecordBatch]:
    scorer = _scorer(sent)
    for b in common.small_batches(batches, "text", SLICE):
        x = scorer.summaries(common.strings(b.column(2)))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "held_out", "x"])


def _slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the log likelihood at w; intercept first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return x.T @ (y - p), (x * (p * (1 - p))[:, None]).T @ x


def fit(rows: DataFrame) -> np.ndarray:
    """Logistic regression over all rows (label, x) by Newton's method with a small ridge; intercept first. The driver gets one row of sums a task and step."""
    size = 9
    w, ridge = np.zeros(size), np.diag([1e-3] + [0.3] * (size - 1))

    def sums(batches: Iterator[pa.RecordBatch], at: np.ndarray) -> Iterator[pa.RecordBatch]:
        slope, curve = np.zeros(size), np.zeros((size, size))
        for b in batches:
            if b.num_rows:
                one, two = _slopes(b.column(1).flatten().to_numpy().reshape(b.num_rows, -1), b.column(0).to_numpy(), at)
                slope, curve = slope + one, curve + two
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([slope, curve.ravel()]).tolist()], pa.list_(pa.float64()))], names=["s"])

    rows = rows.select("label", "x")
    for _ in range(40):
        got = sorted(r["s"] for r in rows.mapInArrow(lambda it, at=w: sums(it, at), "s array<double>").collect())
        total = np.sum(np.array(got), axis=0)
        step = np.linalg.solve(total[size:].reshape(size, size) + ridge, total[:size] - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _labels_of(labels: DataFrame) -> DataFrame:
    """i and label of every id that may be learned from."""
    of = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & common.in_fold("doc_id"))
    return of.groupBy(F.col("doc_id").cast("long").alias("i")).agg(F.max("toxic").cast("int").alias("label"))


def _with_labels(rows: DataFrame, of: DataFrame) -> DataFrame:
    """label and the columns of those rows whose i has one.

    A filter of bounded size leaves out most others before they move. What is left is
    joined by a shuffle whatever its size, so that a plan measured on a small input is
    that of a large one.
    """
    return common.perhaps_in(rows.where(common.in_fold("i")), "i", of).join(of.hint("shuffle_hash"), "i")


def weigh(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The model but for its coefficients; None if either label has no text to learn from."""
    spark = docs.sparkSession
    common.prepare(spark)
    of = _labels_of(labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("text"))
    n = {r[0]: r[1] for r in _with_labels(rows.select("i"), of).groupBy("label").count().collect()}
    if len(n) < 2:
        return None
    chars = char_counts(rows.select("text"))
    labelled = _with_labels(rows, of).select("label", F.coalesce("text", F.lit("")).alias("text"))
    found = labelled.mapInArrow(_token_counts, "t string, label int, n long").groupBy("t")
    tokens = found.agg(*[F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0)).alias(name) for label, name in ((0, "clean"), (1, "toxic"))])
    counts = tokens.mapInArrow(lambda it: _feature_counts(it, chars), "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("k"))
    # The ratio of shares, with the toxic share low and the clean share high by about a standard deviation.
    least = max(2, min(LEAST_SUPPORT, n[1] // 8))
    a = (F.col("k") - 0.7 * F.sqrt("k")) / n[1]
    c = (F.col("c") + 0.3 + 0.5 * F.sqrt("c")) / n[0]
    strong = counts.where(F.col("k") >= least).select("f", F.log(a / c).alias("w")).where("w > 0.7")
    return {"chars": chars, "weights": dict(sorted(map(tuple, strong.collect()))), "coefficients": np.zeros(9)}


def described(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out and x (what the regression weighs) of every row, kept."""
    sent = _Sent(docs.sparkSession, model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~common.in_fold("doc_id")).alias("held_out"), F.col("text").alias("text"))
    return common.kept(rows.mapInArrow(lambda it: _described(it, sent), "doc_id long, held_out boolean, x array<double>"), "toxic-x")


def fitted(rows: DataFrame, labels: DataFrame) -> np.ndarray:
    """The coefficients, from rows (doc_id, x) of all documents."""
    of = _with_labels(rows.select(F.col("doc_id").cast("long").alias("i"), "x"), _labels_of(labels))
    return fit(common.kept(of.select("label", "x").sortWithinPartitions("label", "x"), "toxic-labelled"))  # sums in one order on every run


def score_of(coefficients: np.ndarray) -> Column:
    """The score of a row that has x."""
    total = F.lit(float(coefficients[0]))
    for k, c in enumerate(coefficients[1:]):
        total = total + F.lit(float(c)) * F.col("x")[k]
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))


def learn(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The model, from every labelled row of the learning fold; None if either label has no text to learn from."""
    if model := weigh(docs, labels):
        model["coefficients"] = fitted(described(docs, model), labels)
    return model


def _scored(batches: Iterator[pa.RecordBatch], sent: _Sent | None) -> Iterator[pa.RecordBatch]:
    scorer = _scorer(sent) if sent else None
    for b in common.small_batches(batches, "text", SLICE):
        scores = scorer.scores(common.strings(b.column(2))) if scorer else [0.0] * b.num_rows
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= CUT) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    common.prepare(docs.sparkSession)
    sent = _Sent(docs.sparkSession, model) if model else None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~common.in_fold("doc_id")).alias("held_out"), F.col("text").alias("text"))
    return rows.mapInArrow(lambda it: _scored(it, sent), "doc_id long, held_out boolean, score double, predicted int")


def _text_columns(columns, sent: _Sent, of=Scorer.scores, kind=float):
    """What `of` gives for each Series of texts, scores by default; what was remembered of words goes with the partition, since workers live on in later stages."""
    import pandas as pd

    scorer = _scorer(sent)
    try:
        for texts in columns:
            out, held, size = [], [], 0
            for t in texts:
                held.append(t or "")
                size += len(held[-1])
                if size > SLICE:  # so that work space doesn't follow text length
                    out += of(scorer, held)
                    held, size = [], 0
            yield pd.Series(out + of(scorer, held), dtype=kind)
    finally:
        del scorer
        common.remembered("toxicity").clear()
        common.release()


def keep_clean(docs: DataFrame, model: dict | None) -> DataFrame:
    """Rows of docs that aren't predicted toxic."""
    common.prepare(docs.sparkSession)
    if not model:
        return docs
    sent = _Sent(docs.sparkSession, model)
    own = F.pandas_udf(lambda columns: _text_columns(columns, sent), "double", F.PandasUDFType.SCALAR_ITER)
    return docs.where(own(F.col("text")) < CUT)


def learn_and_keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that a model learned from them doesn't predict toxic; texts are described once, to learn and to score."""
    if not (model := weigh(docs, labels)):
        return docs
    sent = _Sent(docs.sparkSession, model)
    own = F.pandas_udf(lambda columns: _text_columns(columns, sent, Scorer.summaries, None), "array<double>", F.PandasUDFType.SCALAR_ITER)
    rows = common.kept(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own(F.col("text")).alias("x")), "toxic-x")
    coefficients = fitted(rows.select(F.col("row.doc_id").alias("doc_id"), "x"), labels)
    return rows.where(score_of(coefficients) < CUT).select("row.*")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    if not (model := weigh(docs, labels)):
        return score(docs, None)
    rows = described(docs, model)
    return rows.select("doc_id", "held_out", score_of(fitted(rows, labels)).alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
