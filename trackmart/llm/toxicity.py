"""Toxicity of deobfuscated text.

A noisy channel turns written words into what is read: letters are swapped for look-alike
digits and signs, words are spaced out or filled with signs, letters are repeated. For a
word with such marks all readings form a lattice, a few arcs for each character, and
Viterbi decoding picks the reading that a letter trigram model, counted over all
documents, and the channel's costs together find likeliest. Words without marks or doubled
letters have one reading and skip the search. A doubled letter is read as one where two are
unlikely; either way the word adds the features of its spelling with single letters. A token
of look-alikes without a letter also has the reading without letters, a number or sign, as
one path.

The gap between two words of at most ``PART`` letters is an arc too, which may be left out
at a cost. Under a trigram model a gap's choice depends on the two letters on either side,
so gaps between words of two letters and more are chosen apart, all gaps of many texts at
once. A one-letter word ties the gaps on its two sides together: their four choices are
compared, again for many texts at once. Runs of two and more single characters go through
one lattice with the words beside them, in which each character has its readings and each gap
may be left out; amid three and more of them, keeping a gap is what costs. A word joined from parts adds its features to those of the parts.

A masking sign between two letters may stand for any letter.

The restored words give binary features: words and their beginnings. Those that go with
the label by a likelihood-ratio test over the labelled sample are weighted by logistic
regression.

Fitting uses at most ``SAMPLE_ROWS`` labelled rows, picked by a hash of the id. The letter
model reads every document; scoring reads whole texts.

Rules
-----
* Null or empty text has no feature and gets the score of the intercept.
* Rows with a null label or id are not learned from; a repeated id or label row counts as
  often as it occurs. With no positive or no negative row, the score is their share, or 0.
* Rows are independent, so repeated rows agree; an empty table gives an empty result.
  Other columns are not read and may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest as hashed

from trackmart.llm.common import (
    Lookup,
    documents,
    exact,
    folds,
    labels,
    map_arrow,
    portions,
    utf8,
)

SAMPLE_ROWS = 20_000
MOST_FEATURES = 20_000
LEAST_RATIO = 25.0  # of the likelihood-ratio statistic
THRESHOLD = 0.7
STEPS, RATE, PENALTY = 300, 0.3, 1e-4
BEGINNINGS = range(3, 9)

# Letters a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SWAP_COST, COLLAPSE_COST = 1.5, 0.5
DOUBLE_COST = 11.0  # leaving out the second of just two equal letters
BLANK_COST = 6.5  # of each look-alike in a token read as having no letters
GAP_COST, PART = 4.0, 6  # leaving out a gap, and the letters a part of a word has at most
KEPT_COST = 6.0  # keeping a gap between single characters where words are spaced out
# Leaving out a digit, a sign that may stand for a letter, any other sign; and what such a
# sign costs more amid a word. A letter costs a few units under the model, so that digits
# are read as letters rather than left out.
DIGIT_COST, SIGN_COST, OTHER_COST, AMID_COST = 12.0, 1.0, 0.5, 8.0
# Letters the model tells apart; every other letter is one class, all else a word's edge.
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáçéèêëíîïñóôöúùûüßœæ"
CLASSES = len(LETTERS) + 2
CODE = {c: n + 1 for n, c in enumerate(LETTERS)}
EDGE_SIGNS = ".,;:?\"'()[]{}<>"
DROPPED = EDGE_SIGNS + "#%&*_~^=/\\`-"
MASK, MASK_COST = "*", 2.0  # a sign for any letter, and what it costs as one
REPEATED = re.compile(r"(.)\1\1")
DOUBLED = re.compile(r"(.)\1")


def letter_classes(text: str) -> np.ndarray:
    """Class of each character of lower-cased text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return _class_table()[np.minimum(codes, 0x3000)]


_TABLE: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    if not _TABLE:
        table = np.array([CLASSES - 1 if chr(c).isalpha() else 0 for c in range(0x3001)], np.int64)
        table[0x3000] = CLASSES - 1
        for letter, number in CODE.items():
            table[ord(letter)] = number
        _TABLE.append(table)
    return _TABLE[0]


def trigram_costs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """-log P(third letter class | first two), counted over all documents.

    Each task sends at most one count for each of the CLASSES ** 3 trigrams.
    """

    def count(batches):
        import pyarrow as pa

        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            texts = utf8(batch.column(0))
            for a, b in portions(texts):
                c = letter_classes("\n\n".join(["", *(t.decode() for t in texts[a:b]), ""]))
                total += np.bincount(
                    (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3
                )
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), pa.array(total[found])], names=["trigram", "n"]
        )

    counts = np.zeros(CLASSES**3)
    counted = docs.select(exact(text_col)).mapInArrow(count, "trigram long, n long")
    for row in counted.groupBy("trigram").agg(F.sum("n").alias("n")).collect():
        counts[row["trigram"]] = row["n"]
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    pairs = counts.sum(0)
    backed_off = (pairs + 0.1) / (pairs + 0.1).sum(1, keepdims=True)
    likely = (counts + 5 * backed_off[None]) / (counts.sum(2, keepdims=True) + 5)
    return -np.log(likely)


def arcs(word: str) -> list[list[tuple[str, float]]]:
    """Readings of each character with their costs; an empty reading leaves it out."""
    out, run = [], 0
    for n, c in enumerate(word):
        run = run + 1 if n and word[n - 1] == c else 1
        if c.isalpha():
            longer = run >= 3 or run == 2 and n + 1 < len(word) and word[n + 1] == c
            ways = [(c, 0.0)]
            if run >= 3:
                ways = [("", COLLAPSE_COST / run)]
            elif run == 2:
                ways.append(("", COLLAPSE_COST if longer else DOUBLE_COST))
        else:
            cost = DIGIT_COST if c.isdigit() else SIGN_COST if c in LOOKALIKES else OTHER_COST
            inside = 0 < n < len(word) - 1 and run == 1 and c in LOOKALIKES
            ways = [("", (cost + AMID_COST * inside) / run)]
            ways += [(x, SWAP_COST) for x in LOOKALIKES.get(c, "")] if run < 3 else []
            if c == MASK and 0 < n < len(word) - 1 and word[n - 1].isalpha() and word[n + 1].isalpha():
                ways += [(x, MASK_COST) for x in LETTERS[:26]]
        out.append(ways)
    return out


def decode(word: str, costs: np.ndarray) -> str:
    """The cheapest reading."""
    return cheapest(arcs(word), costs)[1]


def decode_letterless(word: str, costs: np.ndarray) -> str:
    """The cheapest reading of look-alikes alone; as a number or sign it reads as nothing.

    Either all look-alikes are letters or none is, but for the second of two equal ones.
    """
    word = word.rstrip("!")
    marks = sum(c in LOOKALIKES for c in word)
    if not marks:
        return ""
    lattice = []
    for n, (c, ways) in enumerate(zip(word, arcs(word), strict=True)):
        letters = [w for w in ways if w[0]]
        second = n and word[n - 1] == c
        lattice.append([*letters, *([("", DOUBLE_COST)] if second else [])] if letters else ways)
    cost, reading = cheapest(lattice, costs)
    return reading if cost < BLANK_COST * marks else ""


def cheapest(lattice: list[list[tuple[str, float]]], costs: np.ndarray) -> tuple[float, str]:
    """Cost and letters of the cheapest path: Viterbi over the last two letters. A space is
    a word's edge."""
    other = CLASSES - 1
    best = {(0, 0): (0.0, None)}
    for ways in lattice:
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (p, q), (cost, path) in best.items():
            for letter, extra in ways:
                if letter:
                    c = 0 if letter == " " else CODE.get(letter, other)
                    state, total, longer = (q, c), cost + extra + costs[p, q, c], (letter, path)
                else:
                    state, total, longer = (p, q), cost + extra, path
                if state not in reached or total < reached[state][0]:
                    reached[state] = (total, longer)
        best = reached
    least, path = min(((cost + costs[p, q, 0], n) for n, ((p, q), (cost, _)) in enumerate(best.items())))
    path = list(best.values())[path][1]
    letters = []
    while path:
        letters.append(path[0])
        path = path[1]
    return float(least), "".join(reversed(letters))


def undoubled(word: str, costs: np.ndarray) -> str:
    """:func:`decode` of a word whose only marks are doubled letters, none of them tripled.

    Whatever is chosen, what follows sees the same two letters, so each choice is its own.
    """
    c = [0, *(CODE.get(x, CLASSES - 1) for x in word), 0]
    out, at = [], 0
    for m in DOUBLED.finditer(word):
        before, twice, after = (c[n] for n in (m.start(), m.start() + 1, m.start() + 3))
        if costs[before, twice, twice] + costs[twice, twice, after] > costs[before, twice, after] + DOUBLE_COST:
            out.append(word[at : m.start() + 1])
            at = m.end()
    return "".join(out) + word[at:]


def restore(token: str, costs: np.ndarray) -> str:
    """What a token reads as: its letters if it is plain, else the decoded word."""
    word = token.lower().strip(DROPPED)  # signs that have no reading but to be left out
    doubled = DOUBLED.search(word)
    if word.isalpha() and not (doubled and REPEATED.search(word)):
        return undoubled(word, costs) if doubled else word
    if not any(c.isalpha() for c in word):
        return decode_letterless(word, costs)
    return decode(word, costs)


def single(token: bytes) -> tuple[str, bool, bool] | None:
    """Of a token that is one character but for signs at its edges: the token, and whether
    a sign stands before or after the character."""
    if len(token) > 12:
        return None
    text = token.decode()
    if len(text) == 1:
        return text, False, False
    if len(text.strip(EDGE_SIGNS)) != 1:
        return None
    return text, text[0] in EDGE_SIGNS, text[-1] in EDGE_SIGNS


def joined_spacing(tokens: list[bytes]) -> list[bytes]:
    """Tokens with runs of three or more single characters, not all the same, joined to a word.

    The plain rule that the lattice is compared with in tests; scoring does not use it.
    """
    out: list[bytes] = []
    run: list[str] = []

    def close():
        different = {x.strip(EDGE_SIGNS).lower() for x in run}
        joined = len(run) >= 3 and len(different) > 1
        out.extend([x.encode() for x in (["".join(run)] if joined else run)])
        run.clear()

    for token in tokens:
        found = single(token)
        if not found:
            close()
            out.append(token)
            continue
        text, before, after = found
        if before:
            close()
        run.append(text)
        if after:
            close()
    close()
    return out


def spaced_lattice(tokens: list[str], single: list[bool]) -> list[list[tuple[str, float]]]:
    """Readings of words with gaps between them that may be left out. Single characters have
    the readings of :func:`arcs`; the letters of other words stand. From three on, single
    characters show a writer who spaces words out: then a gap between them that is kept costs
    more than one that is left out."""
    habit = sum(single) > 2
    lattice: list[list[tuple[str, float]]] = []
    for n, (token, alone) in enumerate(zip(tokens, single, strict=True)):
        if n:
            spaced = habit and alone and single[n - 1]
            beside = GAP_COST * (1 + habit)  # who spaces letters out leaves other words apart
            lattice.append([("", 0.0), (" ", KEPT_COST)] if spaced else [("", beside), (" ", 0.0)])
        lattice += arcs(token) if alone else [[(c, 0.0)] for c in token]
    return lattice


def respaced(tokens: list[str], single: list[bool], costs: np.ndarray) -> list[str]:
    """The words of the cheapest reading of a run of short words."""
    return cheapest(spaced_lattice(tokens, single), costs)[1].split()


class Words(Lookup):
    """A :class:`Lookup` of ``make(reading)`` of tokens, with what gaps are chosen by.

    ``ends`` holds the classes of the last two and first two letters, ``letters`` how many a
    reading has, up to PART, else 0. ``flags`` says whether a token may be joined to the one
    after (1), to the one before (2), and is a single character (4). Tokens that differ in
    case and signs at the edges share what was found for one of them.
    """

    def __init__(self, make, costs: np.ndarray, limit: int = 400_000):
        super().__init__(make, limit)
        self.costs, self.flat = costs, costs.ravel()
        self.read: dict[str, tuple] = {}
        self.ends = np.zeros((4, 1024), np.int32)
        self.letters, self.flags = np.zeros(1024, np.uint8), np.zeros(1024, np.uint8)

    def trim(self) -> None:
        if len(self.values) > self.limit:
            self.read.clear()
        super().trim()

    def _described(self, word: str) -> tuple:
        """Value, number of letters, and classes of the last two and the first two of them."""
        reading = restore(word, self.costs)
        n = len(reading) if len(reading) <= PART else 0
        code = [0, *(CODE.get(c, CLASSES - 1) for c in reading), 0] if n else [0, 0, 0]
        found = (self.make(reading), n, (code[-3], code[-2], code[1], code[2]), reading if n else None)
        self.read[word] = found
        return found

    def __missing__(self, key):
        token = key.decode()
        word = token.lower().strip(EDGE_SIGNS)
        value, n, ends, _ = self.read.get(word) or self._described(word)
        self[key] = row = len(self.values)
        self.values.append(value)
        if row == len(self.flags):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)], 1)
            self.letters, self.flags = (np.concatenate([x, np.zeros_like(x)]) for x in (self.letters, self.flags))
        flags = 0
        if len(token) == 1:
            flags = 7
        elif n or len(word) == 1:
            flags = (token[-1] not in EDGE_SIGNS) + 2 * (token[0] not in EDGE_SIGNS) + 4 * (len(word) == 1)
        if n:
            self.ends[:, row] = ends
        self.letters[row], self.flags[row] = n, flags
        return row

    def rows(self, texts: list[bytes]) -> list[set[int]]:
        """Rows of each text's words: of its tokens, and of words joined over gaps."""
        split = [t.split() for t in texts]
        numbers = [self.indices(tokens) for tokens in split]
        found = [set(own.tolist()) for own in numbers]
        for n, word in self._joins(split, numbers):
            found[n].add(self[word])
        return found

    def _joins(self, split: list[list[bytes]], numbers: list[np.ndarray]):
        """(text, word) of each word that is likelier without its gaps."""
        rows = np.concatenate([*numbers, np.zeros(0, np.int64)])
        if len(rows) < 2:
            return
        stops = np.cumsum([len(own) for own in numbers])
        starts = stops - [len(own) for own in numbers]
        flags, letters = self.flags[rows], self.letters[rows]
        may = (flags[:-1] & 1) & (flags[1:] >> 1 & 1)  # gap n is between tokens n and n + 1
        inner = stops[(stops > 0) & (stops < len(rows))]
        may[inner - 1] = 0
        alone = (flags & 4) > 0
        chained = (may > 0) & alone[:-1] & alone[1:]
        may = (may > 0) & (letters[:-1] > 0) & (letters[1:] > 0) & ~chained
        in_chain = np.zeros(len(rows), bool)
        in_chain[:-1] |= chained
        in_chain[1:] |= chained
        joined = self._chosen(rows, may & ~in_chain[:-1] & ~in_chain[1:], letters)

        at = np.flatnonzero(joined)
        # Gaps next to each other, in one text as no gap between texts is open, make one word.
        heads = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        tails = np.append(heads[1:], len(at)) - 1 if len(at) else heads
        owners = np.searchsorted(stops, at[heads], "right")
        for n, x, y in zip(owners.tolist(), at[heads].tolist(), at[tails].tolist(), strict=True):
            yield n, b"".join(split[n][x - starts[n] : y + 2 - starts[n]])
        yield from self._chains(split, rows, starts, stops, chained, may)

    def _chosen(self, rows: np.ndarray, may: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Which of the gaps that ``may`` be left out are, all one-letter words being alone."""
        cost = lambda p, q, c: self.flat[(p * CLASSES + q) * CLASSES + c]
        out = np.zeros(len(may), bool)
        one = letters == 1
        at = np.flatnonzero(may & ~one[:-1] & ~one[1:])
        p, q, a, b = self._around(rows, at, at + 1)
        kept = cost(p, q, 0) + cost(q, 0, a) + cost(0, a, b)
        out[at[GAP_COST + cost(p, q, a) + cost(q, a, b) < kept]] = True

        before, after = np.append(False, may), np.append(may, False)
        u = lambda where: self.ends[2, rows[where]]
        at = np.flatnonzero(one & before & after)
        p, q, a, b = self._around(rows, at - 1, at + 1)
        w = u(at)
        ways = np.array([
            cost(p, q, 0) + cost(q, 0, w) + cost(0, w, 0) + cost(w, 0, a) + cost(0, a, b),
            GAP_COST + cost(p, q, w) + cost(q, w, 0) + cost(w, 0, a) + cost(0, a, b),
            GAP_COST + cost(p, q, 0) + cost(q, 0, w) + cost(0, w, a) + cost(w, a, b),
            2 * GAP_COST + cost(p, q, w) + cost(q, w, a) + cost(w, a, b),
        ])
        best = ways.argmin(axis=0)
        out[at[(best & 1) > 0] - 1] = True
        out[at[(best & 2) > 0]] = True

        at = np.flatnonzero(one & before & ~after)
        p, q, _, _ = self._around(rows, at - 1, at)
        w = u(at)
        out[at[GAP_COST + cost(p, q, w) + cost(q, w, 0) < cost(p, q, 0) + cost(q, 0, w) + cost(0, w, 0)] - 1] = True
        at = np.flatnonzero(one & ~before & after)
        _, _, a, b = self._around(rows, at, at + 1)
        w = u(at)
        out[at[GAP_COST + cost(0, w, a) + cost(w, a, b) < cost(0, w, 0) + cost(w, 0, a) + cost(0, a, b)]] = True
        return out

    def _around(self, rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
        """Classes of the last two letters of ``left`` and the first two of ``right``."""
        return self.ends[0, rows[left]], self.ends[1, rows[left]], self.ends[2, rows[right]], self.ends[3, rows[right]]

    def _chains(self, split, rows, starts, stops, chained, may):
        """Words of runs of single characters, read together with the words beside them."""
        at = np.flatnonzero(chained)
        heads = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        tails = np.append(heads[1:], len(at)) - 1 if len(at) else heads
        owners = np.searchsorted(stops, at[heads], "right")
        for n, x, y in zip(owners.tolist(), at[heads].tolist(), at[tails].tolist(), strict=True):
            first, last = x - bool(x and may[x - 1]), y + 1 + bool(y + 1 < len(may) and may[y + 1])
            words, single = [], []
            for place in range(first, last + 1):
                token = split[n][place - starts[n]].decode()
                word = token.lower().strip(EDGE_SIGNS) or token
                alone = x <= place <= y + 1
                words.append(word if alone else self.read[word][3])
                single.append(alone)
            if any(c.isalpha() for w in words for c in w) and len(set(words)) > 1:
                for word in respaced(words, single, self.costs):
                    if len(word) > 1:
                        yield n, word.encode()


def word_features(word: str) -> list[int]:
    """Hashes of a word and its beginnings, and of those with doubled letters made single."""
    if not word:
        return []
    found = [hashed("=" + word) >> 1, *[hashed(word[:n]) >> 1 for n in BEGINNINGS if n < len(word)]]
    if DOUBLED.search(word):
        word = DOUBLED.sub(r"\1", word)
        found += [hashed("=" + word) >> 1, *[hashed(word[:n]) >> 1 for n in BEGINNINGS if n < len(word)]]
        found = list(dict.fromkeys(found))
    return found


@dataclass
class Model:
    costs: np.ndarray
    weights: dict[int, float]
    intercept: float


def sample_of(docs: DataFrame, marks: DataFrame, allowed: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents: text, label. The chosen ids are broadcast."""
    chosen = (
        marks.where(allowed & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .select("doc_id", F.col("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def _doc_features(texts: list[bytes], words: Words) -> list[set[int]]:
    out = []
    for rows in words.rows(texts):
        found: set[int] = set()
        for row in rows:
            found.update(words.values[row])
        out.append(found)
    return out


def fit(sample: DataFrame, costs: np.ndarray) -> Model:
    """Feature choice by likelihood ratio, then logistic regression on what was chosen."""
    spark = sample.sparkSession
    sent = spark.sparkContext.broadcast(costs)

    def setup():
        return Words(word_features, sent.value, 100_000)

    def count(batch, words):
        texts, marks = utf8(batch.column(0)), batch.column(1).to_pylist()
        for a, b in portions(texts):
            words.trim()
            n: dict[int, list[int]] = {}
            for found, mark in zip(_doc_features(texts[a:b], words), marks[a:b], strict=True):
                for f in found:
                    n.setdefault(f, [0, 0])[mark == 1] += 1
            yield [list(n), [x for x, _ in n.values()], [y for _, y in n.values()]]

    sums = sample.groupBy("label").count().collect()
    positive = sum(r["count"] for r in sums if r["label"] == 1)
    negative = sum(r["count"] for r in sums) - positive
    if not positive or not negative:
        share = positive / max(1, positive + negative)
        return Model(costs, {}, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    counts = (
        map_arrow(sample, count, "feature long, n0 long, n1 long", setup)
        .groupBy("feature")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    seen, rate = F.col("n0") + F.col("n1"), positive / (positive + negative)
    part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    rest1, rest0 = positive - F.col("n1"), negative - F.col("n0")
    absent = positive + negative - seen
    ratio = 2 * (
        part(F.col("n1"), seen * rate)
        + part(F.col("n0"), seen * (1 - rate))
        + part(rest1, absent * rate)
        + part(rest0, absent * (1 - rate))
    )
    chosen = (
        counts.withColumn("ratio", ratio)
        .where(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "feature")
        .limit(MOST_FEATURES)
        .select("feature")
    )
    place = {r["feature"]: n for n, r in enumerate(chosen.collect())}
    known = spark.sparkContext.broadcast(place)

    def rows_of(batch, words):
        place = known.value
        texts, marks = utf8(batch.column(0)), batch.column(1).to_pylist()
        for a, b in portions(texts):
            words.trim()
            found = [sorted(place[f] for f in s if f in place) for s in _doc_features(texts[a:b], words)]
            yield [found, [int(m == 1) for m in marks[a:b]]]

    rows = map_arrow(sample, rows_of, "found array<long>, label int", setup).collect()
    rows = sorted((r["label"], r["found"]) for r in rows)
    y = np.array([label for label, _ in rows], float)
    owner = np.repeat(np.arange(len(rows)), [len(f) for _, f in rows])
    flat = np.array([x for _, f in rows for x in f], np.int64)
    w, b = np.zeros(len(place)), float(np.log(positive / negative))
    rate_w, rate_b = np.full(len(place), 1e-8), 1e-8
    for _ in range(STEPS):
        z = b + np.bincount(owner, w[flat], len(y))
        error = (y - 1 / (1 + np.exp(-z))) / len(y)
        slope = np.bincount(flat, error[owner], len(w)) - PENALTY * w
        rate_w += slope**2
        w += RATE * slope / np.sqrt(rate_w)
        rate_b += error.sum() ** 2
        b += RATE * error.sum() / np.sqrt(rate_b)
    return Model(costs, {f: float(w[n]) for f, n in place.items()}, b)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        model = sent.value

        def weighted(reading):
            return tuple(f for f in word_features(reading) if f in model.weights)

        return Words(weighted, model.costs)

    def per_batch(batch, words):
        model = sent.value
        ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
        scores = []
        for a, b in portions(texts):
            words.trim()
            for rows in words.rows(texts[a:b]):
                found = {f for row in rows for f in words.values[row]}
                z = model.intercept + sum(model.weights[f] for f in sorted(found))
                scores.append(1 / (1 + float(np.exp(-np.clip(z, -500, 500)))))
        yield [ids, scores]

    read = docs.select(exact(id_col).cast("long").alias("doc_id"), exact(text_col).alias("text"))
    return map_arrow(read, per_batch, "doc_id long, score double", setup)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = folds(F.col("doc_id"), 3) == 1
    sample = sample_of(docs, labels(spark, folder), ~held_out)
    scored = score(docs, fit(sample, trigram_costs(docs)))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
