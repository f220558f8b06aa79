"""Language identification with a linear-chain conditional random field over words.

A word's emission score for each language is the sum of learned weights of its hashed
features: the word itself (lexicon), prefixes and suffixes of one to three letters
(affixes) and letter trigrams. Transition weights between languages are learned with
them, from sequences that switch language now and then, so that code-switched text is
labelled in runs. Forward-backward gives every word's label probabilities; a document's
language is the one with the largest mean probability, which is its score. How certain
its labels are is another figure, the mean over words of the largest label probability:
a text split evenly over languages has a low score, but is labelled with certainty.

Fitting uses a bounded sample, ``DOCS_PER_LANGUAGE`` documents a language, picked by a hash
of the text with short ones (``SHORT`` characters) first. Labelling covers whole texts:
each is cut into blocks of words, block transfer matrices are multiplied up first, and
the exact messages then enter each block, so long texts cost no more per word.

Rules
-----
* Null text, or text without a letter: ``und`` with score 0. Words without a letter have
  no features, and take no part in the mean.
* Ties go to the first language by code point. Rows are independent, so repeated rows
  agree. Rows with null language or text are never learned from.
* Without anything to learn from, every text is ``und``. An empty table gives an empty result.
* Other columns are not read and may have any name.
"""

from __future__ import annotations

import random
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trackmart.llm.common import (
    BatchTable,
    documents,
    exact,
    folds,
    map_arrow,
    portions,
    ragged,
    utf8,
)

DOCS_PER_LANGUAGE, SHORT = 150, 4_000
BUCKETS = 1 << 16
TRAIN_LENGTH, TRAIN_RUN = 64, 16  # words in a training sequence, words between switches
BLOCK = 64
PORTION, WORDS_KEPT = 1 << 18, 100_000  # bytes labelled at a time, words a task keeps the scores of
STEPS, RATE, PENALTY = 60, 0.5, 1e-6
UNKNOWN = "und"
EDGES = ".,;:!?\"'()[]{}|*#$%&/<>=+-_0123456789"
EDGE_BYTES = EDGES.encode()
# States of a CRC-32 after one byte each.
CRC_OF_BYTE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    moves: np.ndarray  # languages x languages, log scale


def core(word: bytes) -> bytes:
    """A word in lower case without its edges; empty if it has no letter."""
    if word.isascii():
        bare = word.lower().strip(EDGE_BYTES)
        return bare if bare.isalpha() or any(map(str.isalpha, bare.decode())) else b""
    text = word.decode().lower().strip(EDGES)
    # A digit like ² is no letter.
    return text.encode() if text.isalpha() or any(map(str.isalpha, text)) else b""


def crc32(data: np.ndarray, first: np.ndarray, last: np.ndarray, kind: int) -> np.ndarray:
    """``zlib.crc32(data[first:last], kind)`` of many short spans of bytes."""
    state = np.full(len(first), kind ^ 0xFFFFFFFF, np.uint32)
    sizes = last - first
    for step in range(int(sizes.max(initial=0))):
        more = slice(None) if (sizes > step).all() else np.flatnonzero(sizes > step)
        now = state[more]
        state[more] = CRC_OF_BYTE[(now ^ data[first[more] + step]) & 255] ^ (now >> 8)
    return state ^ 0xFFFFFFFF


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, one word after the other, and how many each word has.

    A word without a letter has none.
    """
    cores = [core(w) for w in words]
    sizes = np.fromiter(map(len, cores), np.int64, len(cores))
    read = sizes > 0
    cores = [c for c in cores if c]
    data = np.frombuffer(b"".join(b"^%b$" % c for c in cores), np.uint8)
    # Letters of several bytes are one character: spans are found in characters, hashed in bytes.
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    ends = np.cumsum(sizes[read] + 2)
    marks = np.searchsorted(at, ends - sizes[read] - 2)
    begin, end = marks + 1, np.searchsorted(at, ends) - 1
    length = end - begin
    counts = 7 + length
    place = np.cumsum(counts) - counts
    found = np.empty(int(counts.sum()), np.int64)
    found[place] = [zlib.crc32(c, 1) for c in cores]
    for n in (1, 2, 3):
        found[place + n] = crc32(data, at[begin], at[np.minimum(begin + n, end)], 2)
        found[place + 3 + n] = crc32(data, at[np.maximum(end - n, begin)], at[end], 3)
    grams = ragged(marks, length)
    found[ragged(place + 7, length)] = crc32(data, at[grams], at[grams + 3], 4)
    sizes[read] = counts
    return found % BUCKETS, sizes


def emissions(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Emission scores of words, and whether a word has features in the last column."""
    out = np.zeros((len(words), weights.shape[1] + 1))
    for a, b in portions(words, PORTION):
        flat, sizes = features(words[a:b])
        owner = np.repeat(np.arange(b - a), sizes)
        for c in range(weights.shape[1]):
            out[a:b, c] = np.bincount(owner, weights[flat, c], b - a)
        out[a:b, -1] = sizes > 0
    return out


def forward_backward(emissions: np.ndarray, moves: np.ndarray, mask: np.ndarray, before, after):
    """Label probabilities in blocks of words, all blocks at once.

    ``emissions`` and ``moves`` are factors, not logarithms: blocks x words x labels and
    labels x labels. ``mask`` tells words from padding. ``before`` and ``after`` are the
    messages that enter each block from its left and right.
    """
    n, length, labels = emissions.shape
    forward = np.empty_like(emissions)
    message = before
    for t in range(length):
        step = (message @ moves) * emissions[:, t]
        step /= step.sum(1, keepdims=True)
        message = np.where(mask[:, t, None], step, message)
        forward[:, t] = message
    out, message = np.empty_like(emissions), after
    for t in range(length - 1, -1, -1):
        both = forward[:, t] * message
        out[:, t] = both / both.sum(1, keepdims=True)
        step = (emissions[:, t] * message) @ moves.T
        step /= step.sum(1, keepdims=True)
        message = np.where(mask[:, t, None], step, message)
    return out


def transfers(emissions: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Each block's product of transition and emission factors, up to scale."""
    n, length, labels = emissions.shape
    product = np.broadcast_to(np.eye(labels), (n, labels, labels)).copy()
    for t in range(length):
        step = (product @ moves) * emissions[:, None, t]
        step /= step.sum((1, 2), keepdims=True)
        product = np.where(mask[:, t, None, None], step, product)
    return product


def label_chains(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Exact label probabilities of the words of several documents, one after the other.

    ``emissions`` holds log scores, words x labels; ``moves`` is on log scale too.
    """
    labels = emissions.shape[1]
    blocks_of = -(-lengths // BLOCK)
    n_blocks = int(blocks_of.sum())
    if not n_blocks:
        return np.zeros((0, labels))
    factors = np.exp(emissions - emissions.max(1, keepdims=True))
    moves = np.exp(moves)
    first_block = np.concatenate([[0], np.cumsum(blocks_of)])[:-1]
    word_doc = np.repeat(np.arange(len(lengths)), lengths)
    nth = np.arange(len(emissions)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = first_block[word_doc] * BLOCK + nth
    padded = np.ones((n_blocks * BLOCK, labels))
    padded[place] = factors
    mask = np.zeros(n_blocks * BLOCK, bool)
    mask[place] = True
    padded, mask = padded.reshape(n_blocks, BLOCK, labels), mask.reshape(n_blocks, BLOCK)
    whole = transfers(padded, moves, mask)
    before, after = np.full((2, n_blocks, labels), 1 / labels)
    for step in range(1, int(blocks_of.max())):
        at = first_block[blocks_of > step] + step
        message = np.einsum("bi,bij->bj", before[at - 1], whole[at - 1])
        before[at] = message / message.sum(1, keepdims=True)
        last = (first_block + blocks_of)[blocks_of > step] - 1 - step
        message = np.einsum("bij,bj->bi", whole[last + 1], after[last + 1])
        after[last] = message / message.sum(1, keepdims=True)
    return forward_backward(padded, moves, mask, before, after).reshape(-1, labels)[place]


def training_sample(
    docs: DataFrame, text: Column, lang: Column, allowed: Column, per_language: int = DOCS_PER_LANGUAGE
) -> list[tuple[str, str]]:
    """At most ``per_language`` (text, language) pairs of each language."""
    order = Window.partitionBy("lang").orderBy(F.length("text") > SHORT, F.xxhash64("text"), "text")
    rows = (
        docs.where(allowed & text.isNotNull() & lang.isNotNull())
        .select(text.alias("text"), lang.alias("lang"))
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= per_language)
        .select("text", "lang")
    )
    return sorted((r["lang"], r["text"]) for r in rows.collect())


def fit(sample: list[tuple[str, str]], steps: int = STEPS) -> Model:
    """Maximum conditional likelihood by gradient steps with per-weight rates."""
    languages = sorted({lang for lang, _ in sample})
    k = max(1, len(languages))
    runs = []
    for lang, text in sample:
        rows = [w for w in text.encode().split() if any(map(str.isalpha, w.decode()))]
        label = languages.index(lang)
        runs += [(label, rows[n : n + TRAIN_RUN]) for n in range(0, len(rows), TRAIN_RUN)]
    runs = [r for r in runs if r[1]]
    model = Model(languages, np.zeros((BUCKETS, k)), np.zeros((k, k)))
    if not runs:
        return Model([], model.weights, model.moves)
    # Half the runs keep their document's order; the others are shuffled, which makes switches.
    half = len(runs) // 2
    mixed = runs[half:]
    random.Random(7).shuffle(mixed)
    chain = [(label, w) for label, ws in runs[:half] + mixed for w in ws]
    chain += [chain[-1]] * (-len(chain) % TRAIN_LENGTH)
    gold = np.array([label for label, _ in chain]).reshape(-1, TRAIN_LENGTH)
    words = {}
    rows = np.array([words.setdefault(w, len(words)) for _, w in chain])
    flat, sizes = features(list(words))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n = len(gold)
    mask = np.ones(gold.shape, bool)
    uniform = np.full((n, k), 1 / k)
    one_hot = np.eye(k)[gold]
    observed = np.zeros((k, k))
    np.add.at(observed, (gold[:, :-1], gold[:, 1:]), 1)
    rate_w, rate_m = np.full((BUCKETS, k), 1e-8), np.full((k, k), 1e-8)
    for _ in range(steps):
        by_word = np.stack(
            [np.bincount(owner, model.weights[flat, c], len(sizes)) for c in range(k)], 1
        )
        scores = by_word[rows].reshape(n, TRAIN_LENGTH, k)
        factors, moves = np.exp(scores - scores.max(2, keepdims=True)), np.exp(model.moves)
        marginals, expected = _expectations(factors, moves, mask, uniform)
        error = (one_hot - marginals).reshape(-1, k)
        per_word = np.stack([np.bincount(rows, error[:, c], len(sizes)) for c in range(k)], 1)
        slope = np.stack([np.bincount(flat, per_word[owner, c], BUCKETS) for c in range(k)], 1)
        slope = slope / len(rows) - PENALTY * model.weights
        rate_w += slope**2
        model.weights += RATE * slope / np.sqrt(rate_w)
        slope = (observed - expected) / len(rows) - PENALTY * model.moves
        rate_m += slope**2
        model.moves += RATE * slope / np.sqrt(rate_m)
    return model


def _expectations(factors, moves, mask, uniform):
    """Label probabilities of every word, and expected numbers of transitions."""
    marginals = forward_backward(factors, moves, mask, uniform, np.ones_like(uniform))
    forward, message = [], uniform
    for t in range(factors.shape[1]):
        message = (message @ moves) * factors[:, t]
        message /= message.sum(1, keepdims=True)
        forward.append(message)
    expected, message = np.zeros_like(moves), np.ones_like(uniform)
    for t in range(factors.shape[1] - 1, 0, -1):
        right = factors[:, t] * message
        pair = forward[t - 1][:, :, None] * moves * right[:, None, :]
        expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        message = right @ moves.T
        message /= message.sum(1, keepdims=True)
    return marginals, expected


def _labels(batch_texts: list[bytes], words: BatchTable, model: Model):
    """Language, score, mean probabilities and certainty of each text."""
    languages = model.languages
    for a, b in portions(batch_texts, PORTION):
        words.trim()
        split = [t.split() if languages else [] for t in batch_texts[a:b]]
        lengths = np.array([len(s) for s in split], np.int64)
        rows = words.indices([w for s in split for w in s])
        scores, counts = words.rows[rows, :-1], words.rows[rows, -1]
        chances = label_chains(scores, lengths, model.moves) * counts[:, None]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        for n in range(len(split)):
            own = slice(ends[n], ends[n + 1])
            total = counts[own].sum()
            if not total:
                yield UNKNOWN, 0.0, [], 0.0
                continue
            shares = chances[own].sum(0) / total
            best = int(shares.argmax())
            certainty = float(chances[own].max(1).sum() / total)
            yield languages[best], min(1.0, float(shares[best])), shares.tolist(), min(1.0, certainty)


def _with_labels(docs: DataFrame, text_col: str, model: Model, schema, arrange) -> DataFrame:
    """Map ``docs`` to ``arrange(columns, labels)`` in batches."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index(text_col)

    def setup():
        weights = sent.value.weights
        return BatchTable(lambda new: emissions(new, weights), weights.shape[1] + 1, WORDS_KEPT)

    def per_batch(batch, words):
        labels = list(_labels(utf8(batch.column(text)), words, sent.value))
        yield arrange(batch.columns, list(zip(*labels)) or [[], [], [], []])

    return map_arrow(docs, per_batch, schema, setup)


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, and the mean probability of each
    language of ``model.languages`` as ``shares``."""
    read = docs.select(exact(id_col).cast("long").alias("doc_id"), exact(text_col).alias("text"))
    schema = "doc_id long, lang_pred string, score double, shares array<double>"
    return _with_labels(
        read, "text", model, schema, lambda columns, labels: [columns[0], *labels[:3]]
    )


def label_rows(
    docs: DataFrame, model: Model, lang_name: str, certainty_name: str, text_col: str = "text"
) -> DataFrame:
    """``docs`` as they are with language and certainty added, of names they must not have."""
    added = [T.StructField(lang_name, T.StringType()), T.StructField(certainty_name, T.DoubleType())]
    kinds = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), *added])
    return _with_labels(
        docs, text_col, model, kinds, lambda columns, labels: [*columns, labels[0], labels[3]]
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = folds(F.col("doc_id"), 5) == 0
    model = fit(training_sample(docs, F.col("text"), F.col("lang"), ~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
