"""Toxicity of restored text: obfuscated words are decoded by a noisy channel, then a linear model scores.

A character model of order four is counted over all documents. A chunk of text that digits,
symbols, separators or repeated letters disguise becomes a lattice: each character offers the
letters it may stand for, or nothing, at a cost; the Viterbi path of least cost under channel and
character model is the restored text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from thermocline.llm.rows import add_columns, col_of, map_arrow, others, own_memory, slices
from thermocline.llm.storage import fresh, stored

#: Labelled documents of each class that the classifier is fitted on, at most.
SAMPLE_PER_CLASS = 2000
#: Features the classifier keeps, those that part the classes best.
FEATURES = 4000
THRESHOLD = 0.3
#: Chunks whose features a worker remembers since the last change of memories; the memory before is kept until the next.
REMEMBERED = 120_000

#: What a character may stand for, and the channel's cost of it (natural logarithm). Fixed values.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i",
}
COST_STANDS_FOR, COST_SYMBOL_DROPPED, COST_DIGIT_KEPT = 1.0, 2.5, 3.0
COST_SEPARATOR_DROPPED, COST_SEPARATOR_KEPT, COST_REPEAT_DROPPED = 0.7, 0.7, 0.3
#: Letters of other alphabets that look like Latin ones. Fixed values.
LOOKS_LIKE = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ѕ": "s", "у": "y", "х": "x", "к": "k",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
COST_LOOKS_LIKE, COST_LETTER_KEPT = 0.3, 3.0

_LETTER_SYMBOLS = "".join(re.escape(c) for c in STANDS_FOR)
_EDGE = ".,;:?\"'()[]{}<>%&#*/\\~`^=_-…–—“”„«»¿·"
#: In a chunk: a letter three times, or separators between letters.
_NOISY = re.compile(r"([^\W\d_])\1\1|(?:^|[^\w])\w(?:[._*~-]\w){2,}(?:[^\w]|$)|[^\W\d_][._*~][^\W\d_]")
_LETTER, _SUBSTITUTE = re.compile(r"[^\W\d_]"), re.compile(rf"[{_LETTER_SYMBOLS}]")
#: Three substitutes or more and nothing else.
_SUBSTITUTES = re.compile(rf"[{_LETTER_SYMBOLS}]{{3,}}")
_DOUBLE = re.compile(r"([^\W\d_])\1")
#: A word with doubled letters is decoded if it costs more than this a letter, and the decoded word less by GAIN.
UNLIKELY, GAIN = 2.2, 0.5
#: Three or more single characters with one blank between.
_SPACED = re.compile(r"(?<!\S)[\w@$!|+](?: [\w@$!|+]){2,}(?!\S)")
#: Wherever _SPACED matches there is this; literal beginnings are found fast.
_SINGLES = re.compile(r" \S \S(?!\S)")
_WORD = re.compile(r"[^\W\d_]+")
#: A Latin letter beside one that looks Latin; words of one alphabet aren't disguised.
_MIXED = re.compile("[a-z][{0}]|[{0}][a-z]".format("".join(LOOKS_LIKE)))
#: Letters below this one are Latin.
_GREEK = "\u0370"
_ODD = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff\uff01-\uff5e]")


def visible(chunk: str) -> str:
    """Full-width characters as plain ones, invisible ones gone."""
    if chunk.isascii() or not _ODD.search(chunk):
        return chunk
    return _ODD.sub(lambda m: chr(ord(m.group()) - 0xFEE0).lower() if "\uff01" <= m.group() <= "\uff5e" else "", chunk)


_SIZE = 27
#: Code of a Latin letter without its accents (1-26) by code point; others: 0, the word's border.
_CODES = np.zeros(0x250, np.uint8)


def _fill_codes() -> None:
    import unicodedata

    for point in range(0x250):
        base = unicodedata.normalize("NFKD", chr(point).lower())[:1].replace("ß", "s").replace("æ", "a").replace("ø", "o").replace("œ", "o")
        if "a" <= base <= "z" and chr(point).isalpha():
            _CODES[point] = ord(base) - 96


_fill_codes()


_CODE_OF = {chr(p): int(c) for p, c in enumerate(_CODES) if c}


def _code(c: str) -> int:
    return _CODE_OF.get(c, 0)


def gram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns gram, n: how often each run of four codes occurs over all documents; 27**4 rows at most.

    Summed in each task before the shuffle. Null and empty texts add nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memory(__name__)
        total = np.zeros(_SIZE**4, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                points = np.frombuffer("\n".join(["", *(t for t in part.column(0).to_pylist() if t), ""]).encode("utf-32-le"), np.uint32)
                codes = _CODES[np.minimum(points, 0x24F)].astype(np.int32)
                codes = codes[(codes > 0) | np.append(True, codes[:-1] > 0)]  # one border between words
                if len(codes) > 1:
                    codes = np.concatenate([[0, 0], codes])  # so that the first word has a full context
                    total += np.bincount(((codes[:-3] * _SIZE + codes[1:-2]) * _SIZE + codes[2:-1]) * _SIZE + codes[3:], minlength=_SIZE**4)
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.int32()), pa.array(total[grams])], names=["gram", "n"])

    return map_arrow(docs.select(col_of(text).alias("text")), run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Costs (negative logarithms) of a code after three codes, as an array [27**3, 27].

    The counts gathered are bounded by the alphabet. Each order is smoothed by the next lower one.
    """
    rows = gram_counts(docs, text).collect()
    counts = np.zeros(_SIZE**4)
    for r in rows:
        counts[r["gram"]] = r["n"]
    counts = counts.reshape(_SIZE, _SIZE, _SIZE, _SIZE)
    below = np.full(_SIZE, 1 / _SIZE)
    for order in range(4):
        own = counts.sum(axis=tuple(range(3 - order)))
        below = (own + 5.0 * below) / (own.sum(axis=-1, keepdims=True) + 5.0)
    return -np.log(below.reshape(_SIZE**3, _SIZE)).astype(np.float32)


#: States from which a stretch of a lattice is decoded by arrays; characters of a stretch, and of the blocks it is traced back by.
WIDE, STRETCH, BLOCK = 48, 16_384, 256


def _joined(link: tuple | None) -> str:
    """The text of a path, kept as links to what stands before."""
    parts = []
    while link is not None:
        link, out = link
        parts.append(out)
    return "".join(reversed(parts))


class Restorer:
    """Viterbi decoding under a character model.

    States are the last three codes; none is ever dropped. While few states are alive they are
    walked one by one; where digits and symbols in a row make them many, blocks of characters are
    decoded with arrays over all states, and back-pointers. Paths share what they have in common,
    so memory stays small for any length.
    """

    def __init__(self, costs: np.ndarray):
        #: Flat, as a list: read one by one, these are quicker than an array's.
        self.costs: list[float] = costs.ravel().tolist()
        self.cube = costs.astype(np.float64).reshape(_SIZE, _SIZE, _SIZE, _SIZE)
        self.parts: dict[tuple[int, ...], np.ndarray] = {}

    @staticmethod
    def lattice(chunk: str) -> list[list[tuple[str, float]]]:
        """For each character what it may become: a letter, nothing, or a blank."""
        steps = []
        for k, c in enumerate(chunk):
            if c in STANDS_FOR:
                ways = [(x, COST_STANDS_FOR) for x in STANDS_FOR[c]] + [("", COST_SYMBOL_DROPPED)]
                if c.isdigit():
                    ways.append((c, COST_DIGIT_KEPT))
            elif c in LOOKS_LIKE:
                ways = [(LOOKS_LIKE[c], COST_LOOKS_LIKE), (c, COST_LETTER_KEPT)]
            elif c.isalpha():
                ways = [(c, 0.0)]
                if k and chunk[k - 1] == c:
                    ways.append(("", COST_REPEAT_DROPPED))
            else:
                ways = [("", COST_SEPARATOR_DROPPED), (" ", COST_SEPARATOR_KEPT)]
            steps.append(ways)
        return steps

    def decode(self, chunk: str) -> str:
        """The path of least cost; ties go to the first way found, which depends on the chunk alone."""
        paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        steps, k = self.lattice(chunk), 0
        while k < len(steps):
            if len(paths) < WIDE:
                paths = self._one(paths, steps[k])
                k += 1
            else:
                end = self._narrow(steps, k)
                paths = self._stretch(paths, steps[k:end])
                k = end
        cost = {state: c + (self.costs[state * _SIZE] if state % _SIZE else 0.0) for state, (c, _) in paths.items()}
        return _joined(paths[min(cost, key=cost.get)][1]).strip()

    @staticmethod
    def _narrow(steps: list, k: int) -> int:
        """Where three characters in a row that can be one letter only have led all paths to one state, or STRETCH characters on."""
        end, single = k, 0
        while end < len(steps) and end < k + STRETCH and single < 3:
            single = single + 1 if len(steps[end]) == 1 else 0
            end += 1
        return end

    def _one(self, paths: dict, ways: list[tuple[str, float]]) -> dict:
        """All paths a character further."""
        top, costs = _SIZE * _SIZE, self.costs
        new: dict[int, tuple[float, tuple | None]] = {}
        for state, (cost, done) in paths.items():
            at, border = state * _SIZE, state % _SIZE == 0
            for out, extra in ways:
                if not out:
                    to, now, way = state, cost + extra, done
                else:
                    code = _code(out)
                    if code == 0 and border:
                        to, now = state, cost + extra
                    else:
                        to, now = state % top * _SIZE + code, cost + extra + costs[at + code]
                    way = (done, out)
                if to not in new or now < new[to][0]:
                    new[to] = (now, way)
        return new

    def _part(self, codes: tuple[int, ...]) -> np.ndarray:
        """Costs [next, first, second, third code] over these codes alone."""
        if codes not in self.parts:
            if len(self.parts) >= 32:
                self.parts.clear()
            self.parts[codes] = np.ascontiguousarray(np.moveaxis(self.cube[np.ix_(codes, codes, codes, codes)], 3, 0))
        return self.parts[codes]

    def _stretch(self, paths: dict, steps: list[list[tuple[str, float]]]) -> dict:
        """All paths some characters further, all states of a character at once."""
        used = {0} | {_code(out) for ways in steps for out, _ in ways if out}
        for state in paths:
            used.update((state // _SIZE**2, state // _SIZE % _SIZE, state % _SIZE))
        codes = tuple(sorted(used))
        n, place = len(codes), {c: k for k, c in enumerate(codes)}
        costs, own = self._part(codes), np.arange(n**3, dtype=np.int16 if n**3 < 32768 else np.int32).reshape(n, n, n)
        now = np.full((n, n, n), np.inf)
        links: dict[int, tuple | None] = {}
        for state, (cost, done) in paths.items():
            a, b, c = place[state // _SIZE**2], place[state // _SIZE % _SIZE], place[state % _SIZE]
            now[a, b, c] = cost
            links[(a * n + b) * n + c] = done
        held = None  # the block before: its texts are only made for the states that live on
        for k in range(0, len(steps), BLOCK):
            block = steps[k : k + BLOCK]
            back = []
            for ways in block:
                now, origin, way = self._all(now, ways, n, place, costs, own)
                back.append((origin.ravel(), way.ravel()))
            at = ends = np.flatnonzero(np.isfinite(now.ravel()))
            chosen = []
            for origin, way in reversed(back):
                chosen.append(way[at])
                at = origin[at]
            if held is not None:
                links = self._links(links, *held, np.isin(held[1], at))
            held = ([[out for out, _ in ways] for ways in block], ends, at, np.array(chosen[::-1], np.uint8).T)
        links = self._links(links, *held, np.ones(len(held[1]), bool))
        cost = now.ravel()
        return {(codes[e // (n * n)] * _SIZE + codes[e // n % n]) * _SIZE + codes[e % n]: (float(cost[e]), link) for e, link in links.items()}

    @staticmethod
    def _links(links: dict, outs: list[list[str]], ends: np.ndarray, starts: np.ndarray, rows: np.ndarray, alive: np.ndarray) -> dict:
        return {e: (links[a], "".join([o[w] for o, w in zip(outs, row)])) for e, a, row in zip(ends[alive].tolist(), starts[alive].tolist(), rows[alive].tolist())}

    @staticmethod
    def _all(now: np.ndarray, ways: list[tuple[str, float]], n: int, place: dict[int, int], costs: np.ndarray, own: np.ndarray) -> tuple:
        """Costs, states before and ways taken, of all states, a character further."""
        new, origin, way = np.full((n, n, n), np.inf), np.zeros_like(own), np.zeros((n, n, n), np.uint8)
        for w, (out, extra) in enumerate(ways):
            here = now + extra
            better = None
            if out:
                code = _code(out)
                x = place[code]
                moved = here + costs[x]
                if code == 0:
                    moved[:, :, 0] = np.inf  # a border after a border changes nothing
                    better = np.zeros((n, n, n), bool)
                first = moved.argmin(axis=0)
                least = moved.min(axis=0)
                less = least < new[:, :, x]
                np.copyto(new[:, :, x], least, where=less)
                np.copyto(origin[:, :, x], first * (n * n) + own[0], where=less, casting="unsafe")
                np.copyto(way[:, :, x], w, where=less)
                if better is None:
                    continue
                better[:, :, 0] = here[:, :, 0] < new[:, :, 0]
            else:
                better = here < new
            np.copyto(new, here, where=better)
            np.copyto(origin, own, where=better)
            np.copyto(way, w, where=better)
        return new, origin, way

    def chunk(self, chunk: str) -> str:
        """A chunk without white space, restored; one without disguise stays."""
        chunk = visible(chunk)
        core = re.sub(r"!{2,}$", "", chunk.strip(_EDGE))
        if not core:
            return chunk
        if _NOISY.search(core) or _MIXED.search(core) or (_SUBSTITUTE.search(core) and _LETTER.search(core)) or _SUBSTITUTES.fullmatch(core):
            return self.decode(core) or chunk
        return _WORD.sub(lambda m: self.single(m.group()) or m.group(), chunk)

    def single(self, word: str) -> str | None:
        """A word with doubled letters as decoded, if the character model finds it far likelier; else None."""
        if not (word.isalpha() and _DOUBLE.search(word)) or (own := self.mean_cost(word)) <= UNLIKELY:
            return None
        doubled = [k for k in range(1, len(word)) if word[k] == word[k - 1]]
        if len(doubled) > 3 or any(c in STANDS_FOR or c in LOOKS_LIKE for c in word):
            decoded = self.decode(word)
            return decoded if decoded and self.mean_cost(decoded) <= own - GAIN else None
        # few paths: all of them
        best, cost, mean = word, own * (len(word) + 1), own
        for n in range(1, 1 << len(doubled)):
            gone = {k for j, k in enumerate(doubled) if n >> j & 1}
            path = "".join([c for k, c in enumerate(word) if k not in gone])
            each = self.mean_cost(path)
            if (now := each * (len(path) + 1) + COST_REPEAT_DROPPED * len(gone)) < cost:
                best, cost, mean = path, now, each
        return best if mean <= own - GAIN else None

    def mean_cost(self, word: str) -> float:
        """Cost of a word and the border after it, a character."""
        code, costs, top, at, cost = _CODE_OF.get, self.costs, _SIZE**3, 0, 0.0
        for c in word:
            at = at % top * _SIZE + code(c, 0)
            cost += costs[at]
        return (cost + costs[at % top * _SIZE]) / (len(word) + 1)

    def text(self, text: str) -> str:
        """Text in lower case, white space made one blank, with disguised parts restored."""
        text = " ".join(text.lower().split())
        if _SINGLES.search(text):
            text = _SPACED.sub(lambda m: self.decode(m.group()), text)
        return " ".join(map(self.chunk, text.split(" ")))


def restore(docs: DataFrame, costs: np.ndarray, text: str = "text", restored: str = "restored") -> DataFrame:
    """docs with the restored text added (null stays null); costs is a character_model()."""
    shared = docs.sparkSession.sparkContext.broadcast(costs)

    def make():
        restorer = Restorer(shared.value)
        return lambda texts: [pa.array([None if t is None else restorer.text(t) for t in texts.to_pylist()], pa.string())]

    return add_columns(docs, [text], {restored: T.StringType()}, make)


def stems(word: str) -> list[str]:
    """What a word is counted under: its beginnings of four to six letters, and itself (marked)."""
    return [word[:n] for n in (4, 5, 6) if len(word) >= n] + ["=" + word]


#: Features of a stem: its count reaches one of these, or its share of words one of those.
COUNTS, SHARES = (1, 2, 4, 8), (0.005, 0.01, 0.02, 0.04)


def kinds(n: int, words: int) -> list[int]:
    return [k for k, least in enumerate(COUNTS) if n >= least] + [len(COUNTS) + k for k, least in enumerate(SHARES) if n >= 2 and n >= least * words]


class Counter:
    """Counts the stems of restored texts; with a vocabulary of stems, of those only."""

    def __init__(self, costs: np.ndarray, known: dict[str, int] | None = None):
        self.restorer = Restorer(costs)
        self.known = known
        #: How every word that has a known stem begins.
        self.heads = None if known is None else {family(s) for s in known}
        self.forget()

    def forget(self) -> None:
        #: Of a chunk without stems its number of words; of another -1 less its place in parts.
        self.memory: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.parts: list[tuple[int, list]] = []

    def learn(self, chunk: str) -> int:
        core = chunk.strip(_EDGE)
        if core.isalpha() and (core.isascii() or max(core) < _GREEK):
            if core != chunk:  # the punctuation around a word says nothing
                if (n := self.memory.get(core, self.older.get(core))) is None:
                    n = self.memory[core] = self.learn(core)
                return n
            words = _WORD.findall(self.restorer.chunk(core)) if _DOUBLE.search(core) else [core]
        else:
            words = _WORD.findall(self.restorer.chunk(chunk))
        known = self.known
        if known is None:
            found = [s for w in words for s in stems(w)]
        else:
            found = [known[s] for w in words if w[:4] in self.heads for s in stems(w) if s in known]
        if not found:
            return len(words)
        self.parts.append((len(words), found))
        return -len(self.parts)

    def counts(self, text: str | None) -> tuple[int, dict]:
        """Number of words of a text, and how often each stem occurs."""
        found: dict = {}
        if not text:
            return 0, found
        if len(self.parts) > REMEMBERED:
            self.forget()
        if len(self.memory) > REMEMBERED:
            self.memory, self.older = {}, self.memory
        memory, older = self.memory, self.older
        text = " ".join(text.lower().split())
        spaced: list[str] = []
        if _SINGLES.search(text):
            text = _SPACED.sub(lambda m: spaced.append(m.group()) or "\n", text)
        chunks = text.split()
        for chunk in spaced:
            chunks.extend(self.restorer.decode(chunk).split())
        for chunk in set(chunks).difference(memory):
            n = older.get(chunk)
            memory[chunk] = self.learn(chunk) if n is None else n
        numbers = list(map(memory.__getitem__, chunks))
        total = sum(numbers)
        for k in filter((0).__gt__, numbers):
            words, own = self.parts[-1 - k]
            total += words - k
            for s in own:
                found[s] = found.get(s, 0) + 1
        return total, found


def training_labels(labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """Labels of documents outside the held-out fold (crc32 of the key as text, modulo 4, is 2); null labels and keys are left out."""
    return labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (F.crc32(F.col(key).cast("string")) % 4 != 2))


def family(stem: str) -> str:
    """Stems of one beginning are one sign of toxicity, not several."""
    return stem.lstrip("=")[:4]


def _summary(odds: dict[str, float]) -> list[float]:
    """The three largest log-odds of families, and how many are high; what a text lacks is 0."""
    best = sorted(odds.values(), reverse=True)
    top = [max(x, 0.0) for x in best[:3]]
    return [*top, *[0.0] * (3 - len(top)), float(np.log1p(sum(x > 2 for x in best)))]


def _log_odds(n0: float, n1: float, size0: int, size1: int) -> float:
    return float(np.log((n1 + 0.5) / (size1 + 1)) - np.log((n0 + 0.5) / (size0 + 1)))


class Model:
    """Log-odds of features (stem, kind), and a logistic regression over their summary."""

    def __init__(self, weights: np.ndarray, odds: dict[tuple[str, int], float]):
        self.weights = weights
        self.stems: dict[str, int] = {}
        for stem, _ in odds:
            self.stems.setdefault(stem, len(self.stems))
        self.families = [family(s) for s in self.stems]
        self.odds = {(self.stems[s], k): x for (s, k), x in odds.items()}

    @staticmethod
    def prior(positive: float) -> Model:
        return Model(np.array([0.0, 0, 0, 0, np.log(positive / (1 - positive))]), {})

    def score(self, words: int, counts: dict[int, int]) -> float:
        best: dict[str, float] = {}
        for s, n in counts.items():
            for k in kinds(n, words):
                x = self.odds.get((s, k))
                if x is not None and x > best.get(self.families[s], -1e9):
                    best[self.families[s]] = x
        z = float(np.dot([*_summary(best), 1.0], self.weights))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small L2 penalty, by damped Newton steps; x has a column of ones at its end."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + penalty
        w = w - np.linalg.solve(curve, slope)
    return w


def train(docs: DataFrame, labels: DataFrame, costs: np.ndarray, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A classifier fitted on at most SAMPLE_PER_CLASS documents of each class, drawn by hash of the key, weighted back to the classes' shares.

    A document with several labels is toxic if one says so. Without labelled documents of both
    classes the model is the prior alone: 0.5 without any label.
    """
    spark = docs.sparkSession
    known = training_labels(labels, key, label).groupBy(F.col(key).cast("long").alias("labelled")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model.prior(0.5 if not totals else (0.99 if totals.get(1) else 0.01))
    drawn = [known.where(F.col("y") == y).orderBy(F.xxhash64("labelled"), "labelled").limit(SAMPLE_PER_CLASS) for y in (0, 1)]
    ids = stored(drawn[0].union(drawn[1]).coalesce(1), "sample-ids")  # two columns of at most 2 * SAMPLE_PER_CLASS rows
    rows = docs.select(col_of(key).cast("long").alias("id"), col_of(text).alias("text")).join(F.broadcast(ids), F.col("id") == F.col("labelled")).dropDuplicates(["id"])
    sample = stored(rows.select("id", "y", "text"), "sample")
    shared = spark.sparkContext.broadcast(costs)
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model.prior(totals[1] / (totals[0] + totals[1]))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memory(__name__)
        counter, seen = Counter(shared.value), {}
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, counts = counter.counts(t)
                for stem, n in counts.items():
                    for kind in kinds(n, words):
                        seen.setdefault((stem, kind), [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in seen], pa.string()), pa.array([k for _, k in seen], pa.int32()), *(pa.array([n[y] for n in seen.values()], pa.int64()) for y in (0, 1))], names=["stem", "kind", "n0", "n1"])

    seen = map_arrow(sample.select("y", "text"), tally, "stem string, kind int, n0 long, n1 long").groupBy("stem", "kind").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p0, p1 = F.col("n0") / sizes[0], F.col("n1") / sizes[1]
    pooled = (F.col("n0") + F.col("n1")) / (sizes[0] + sizes[1])
    z = (p1 - p0) / F.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]) + F.lit(1e-9))
    chosen = seen.where((F.col("n1") >= 3) & (p1 > p0)).orderBy(F.desc(z), "stem", "kind").limit(FEATURES).collect()
    number = {(r["stem"], r["kind"]): k for k, r in enumerate(chosen)}
    if not number:
        return Model.prior(totals[1] / (totals[0] + totals[1]))
    names: dict[str, int] = {}
    for stem, _ in number:
        names.setdefault(stem, len(names))
    by_number = {(names[s], k): i for (s, k), i in number.items()}
    shared_names = spark.sparkContext.broadcast((names, by_number))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, by_number = shared_names.value
        counter = Counter(shared.value, names)
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                words, counts = counter.counts(t)
                out.append([by_number[s, k] for s, n in counts.items() for k in kinds(n, words) if (s, k) in by_number])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["y", "features"])

    fitted = map_arrow(sample.select("y", "text"), vectors, "y int, features array<int>").collect()
    y = np.array([r["y"] for r in fitted], float)
    weight = np.where(y > 0, totals[1] / sizes[1], totals[0] / sizes[0])
    x = []
    for r in fitted:
        best: dict[str, float] = {}
        for k in r["features"]:
            # without the document itself, else it would vouch for its own label
            n = [chosen[k]["n0"], chosen[k]["n1"]]
            n[r["y"]] -= 1
            odds = _log_odds(*n, sizes[0], sizes[1])
            name = family(chosen[k]["stem"])
            best[name] = max(odds, best.get(name, -1e9))
        x.append([*_summary(best), 1.0])
    weights = _fit(np.array(x), y, weight)
    return Model(weights, {(r["stem"], r["kind"]): _log_odds(r["n0"], r["n1"], sizes[0], sizes[1]) for r in chosen})


def with_scores(docs: DataFrame, model: Model, costs: np.ndarray, text: str = "text", column: str = "score") -> DataFrame:
    """docs with a score (0 to 1) added, or replaced if it is there. Null and empty texts get the score of a text without any sign; equal texts get equal scores."""
    shared = docs.sparkSession.sparkContext.broadcast((model, costs))

    def make():
        model, costs = shared.value
        counter = Counter(costs, model.stems)
        return lambda texts: [pa.array([model.score(*counter.counts(t)) for t in texts.to_pylist()], pa.float64())]

    return add_columns(docs, [text], {column: T.DoubleType()}, make)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted (1 from threshold on), by a model of these documents and labels. No document moves."""
    costs = character_model(docs, text)
    scored = with_scores(docs.select(*map(col_of, others(docs, "predicted"))), train(docs, labels, costs, key, text), costs, text)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without those whose score reaches threshold; all columns stay, whatever their names."""
    (column,) = fresh(docs, "toxicity_score")
    costs = character_model(docs, text)
    scored = with_scores(docs, train(docs, labels, costs, key, text), costs, text, column)
    return scored.where(F.col(column) < threshold).select(*map(col_of, docs.columns))
