"""Language, toxicity and quality models: held-out accuracy, exact inference, edge rows."""

import itertools
import math
import re
import sys
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.frames import SCHEMA, empty, hard, hard_rows, row
from trackmart.llm import language, quality, toxicity
from trackmart.llm.common import documents, folds

FOLDER = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ language


def test_blockwise_chains_equal_plain_forward_backward():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 0, 5, 200, 64, 65])
    emissions = rng.normal(size=(int(lengths.sum()), 3))
    moves = rng.normal(size=(3, 3))
    got = language.label_chains(emissions, lengths, moves)
    at = 0
    for n in lengths:
        own = np.exp(emissions[at : at + n])
        forward, message = [], np.full(3, 1 / 3)
        for e in own:
            message = (message @ np.exp(moves)) * e
            message /= message.sum()
            forward.append(message)
        message = np.ones(3)
        for t in range(n - 1, -1, -1):
            want = forward[t] * message
            assert got[at + t] == pytest.approx(want / want.sum())
            message = np.exp(moves) @ (own[t] * message)
            message /= message.sum()
        at += n


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    emissions, moves = rng.normal(size=(4, 2)), rng.normal(size=(2, 2))
    total = np.zeros((4, 2))
    for path in itertools.product(range(2), repeat=4):
        weight = np.exp(
            sum(emissions[t, c] for t, c in enumerate(path))
            + sum(moves[a, b] for a, b in zip(path, path[1:]))
            + np.log(np.exp(moves[:, path[0]]).sum())
        )
        for t, c in enumerate(path):
            total[t, c] += weight
    want = total / total.sum(1, keepdims=True)
    assert language.label_chains(emissions, np.array([4]), moves) == pytest.approx(want)


@pytest.fixture(scope="module")
def language_model(spark):
    docs = documents(spark, FOLDER)
    held_out = folds(F.col("doc_id"), 5) == 0
    return language.fit(language.training_sample(docs, F.col("text"), F.col("lang"), ~held_out, 60))


def test_language_of_held_out_documents(spark, language_model):
    docs = documents(spark, FOLDER).where(folds(F.col("doc_id"), 5) == 0)
    found = language.predict(docs, language_model).join(docs, "doc_id")
    right = found.where("lang = lang_pred").count()
    assert right >= 0.97 * found.count()


def test_code_switched_text_has_both_languages(spark, language_model):
    halves = [
        documents(spark, FOLDER).where(F.col("lang") == lang).where("n_chars between 300 and 900")
        .orderBy("doc_id").first().text
        for lang in ("fr", "en")
    ]
    docs = spark.createDataFrame([row(1, "\n".join(halves))], SCHEMA)
    shares = dict(zip(language_model.languages, language.predict(docs, language_model).first().shares))
    assert shares["fr"] > 0.2 and shares["en"] > 0.2 and shares["de"] < 0.1


def test_labelling_holds_a_small_portion_of_texts_at_a_time():
    rng = np.random.default_rng(8)
    weights = rng.normal(size=(language.BUCKETS, 4))
    model = language.Model([*"abcd"], weights, rng.normal(size=(4, 4)))
    words = language.BatchTable(lambda new: language.emissions(new, weights), 5)
    text = b" ".join(b"w%s" % bytes(rng.integers(97, 123, 2, np.uint8)) for _ in range(1000))
    texts = [text] * (2_000_000 // len(text))
    expected = list(language._labels(texts[:1], words, model))
    tracemalloc.start()
    try:
        found = list(language._labels(texts, words, model))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == expected * len(texts)
    assert most < 60 << 20


def plain_features(word):
    """Hashed features of a word, span by span."""
    core = word.lower().strip(language.EDGES)
    if not any(map(str.isalpha, core)):
        return []
    spans = [(core, 1), *((core[:n], 2) for n in (1, 2, 3)), *((core[-n:], 3) for n in (1, 2, 3))]
    marked = f"^{core}$"
    spans += [(marked[n : n + 3], 4) for n in range(len(core))]
    return [zlib.crc32(span.encode(), kind) % language.BUCKETS for span, kind in spans]


def test_bulk_features_equal_those_of_single_words():
    rng = np.random.default_rng(9)
    letters = list("abzé\u00dfİΣж中😀²½ʰ\u0308\u212a'.-019$^")
    words = ["", "1", "²", "a", "É", "İ", "^a$", "l'été", "ΣΑΣ", "z" * 3000, "ж" * 700]
    words += ["".join(rng.choice(letters, n)) for n in rng.integers(1, 9, 3000)]
    flat, sizes = language.features([w.encode() for w in words])
    want = [plain_features(w) for w in words]
    assert sizes.tolist() == list(map(len, want))
    assert flat.tolist() == list(itertools.chain.from_iterable(want))
    for none in ([], [b"1", b"..."]):
        flat, sizes = language.features(none)
        assert flat.tolist() == [] and sizes.tolist() == [0] * len(none)
    weights = rng.normal(size=(language.BUCKETS, 2))
    encoded = [w.encode() for w in words]
    whole = language.emissions(encoded, weights)
    assert (whole == np.concatenate([language.emissions([w], weights) for w in encoded])).all()


def test_describing_a_word_costs_as_many_calls_at_any_length():
    weights = np.ones((language.BUCKETS, 2))

    def calls(length):
        words = [b"%c" % (97 + n % 26) * length for n in range(500)]
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(event in ("call", "c_call")))
        try:
            language.emissions(words, weights)
        finally:
            sys.setprofile(None)
        return sum(seen)

    assert calls(40) <= calls(5) + 50


def test_language_edges(spark, language_model):
    got = {r.doc_id: r for r in language.predict(hard(spark), language_model).collect()}
    for doc_id in (1, 2, 3, 13, 16):
        assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[14].lang_pred in language_model.languages
    assert language.predict(hard(spark), language_model).count() == len(hard_rows())
    assert language.predict(empty(spark), language_model).count() == 0
    marks = [row(n, t) for n, t in enumerate(["²", "½ Ⅷ", "x²", "12 ³ _", "ʰ"])]
    letters = {r.doc_id: r.lang_pred for r in language.predict(spark.createDataFrame(marks, SCHEMA), language_model).collect()}
    assert {n for n, lang in letters.items() if lang == "und"} == {0, 1, 3}
    untrained = language.fit([])
    assert {r.lang_pred for r in language.predict(hard(spark), untrained).collect()} == {"und"}


# ------------------------------------------------------------------ toxicity


@pytest.fixture(scope="module")
def costs(spark):
    return toxicity.trigram_costs(documents(spark, FOLDER))


@pytest.mark.parametrize(
    "written, meant",
    [("1d10t", "idiot"), ("stuuuupid", "stupid"), ("s.t.u.p.i.d", "stupid"), ("m0r0n***", "moron"),
     ("STUPID!!", "stupid"), ("tra$h", "trash"), ("plain", "plain"), ("12.34", ""), ("", "")],
)
def test_restored_words(costs, written, meant):
    assert toxicity.restore(written, costs) == meant


def test_decoding_finds_the_cheapest_reading(costs):
    for word in ("m0r0n", "a11b", "x@@y", "b00k1"):
        readings = {}
        for ways in itertools.product(*toxicity.arcs(word)):
            text = "".join(letter for letter, _ in ways)
            states = [0, 0, *(toxicity.CODE.get(c, toxicity.CLASSES - 1) for c in text), 0]
            cost = sum(c for _, c in ways) + sum(costs[tuple(states[n : n + 3])] for n in range(len(states) - 2))
            readings[text] = min(cost, readings.get(text, np.inf))
        assert readings[toxicity.decode(word, costs)] == pytest.approx(min(readings.values()))


@pytest.mark.parametrize(
    "written, meant",
    [("@$$", "ass"), ("4$$!!", "ass"), ("455", "ass"), ("12.34", ""), ("2024", ""), ("***", ""), ("!!", ""),
     ("stuupid", "stupid"), ("iddiot", "idiot"), ("good", "good"), ("ass", "ass")],
)
def test_letterless_tokens_and_doubled_letters(costs, written, meant):
    assert toxicity.restore(written, costs) == meant


def test_doubled_letters_are_chosen_as_by_viterbi(costs):
    for word in ("stuupid", "good", "iddiott", "aabbcc", "ss", "bookkeeper", "xéé", "classse"):
        assert toxicity.restore(word, costs) == toxicity.decode(word, costs)
    assert set(toxicity.word_features("idiot")) < set(toxicity.word_features("iddiot"))


def test_spaced_words_are_joined():
    tokens = b"you i d i o t here a a a a then x y".split()
    assert toxicity.joined_spacing(tokens) == b"you idiot here a a a a then x y".split()


@pytest.mark.parametrize(
    "text, joined",
    [("e s t ú p i d o", "estúpido"), ("a s s", "ass"), ("b o o b !", "boob!"), ("an i d i o t, a", "idiot,"),
     ('"i d i o t" x', '"idiot"'), ("a, b, c", "c"), ("a a a", "a")],
)
def test_single_characters_are_joined_by_code_points(text, joined):
    assert joined.encode() in toxicity.joined_spacing(text.encode().split())
    if "," in joined or len(joined) == 1:
        assert len(toxicity.joined_spacing(text.encode().split())) == 3


def test_gaps_in_words_are_left_out(costs):
    texts = ["you stu pid man", "", "an idi ot", "st up id", "stu", "pid", "stu, pid", "of the man"]
    words = toxicity.Words(lambda reading: reading, costs)
    found = [{words.values[n] for n in rows} for rows in words.rows([t.encode() for t in texts])]
    assert "stupid" in found[0] and {"stu", "pid"} < found[0]
    assert "idiot" in found[2] and "stupid" in found[3] and not found[1]
    assert found[4:] == [{"stu"}, {"pid"}, {"stu", "pid"}, {"of", "the", "man"}]


def test_toxicity_of_held_out_documents(spark, costs):
    words = [r[1] for r in hard_rows() if r[0] and 100 <= r[0] < 130]
    rows = [row(n, f"{words[n % 30]} {n} {'idiot' if n % 3 == 0 else 'kind'} {words[-n % 30]}") for n in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(n, 1, int(n % 3 == 0)) for n in range(300)] + [(None, 1, 1), (5, 1, None)],
                                  "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.sample_of(docs, marks, F.col("doc_id") < 200), costs)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(got[n] for n in range(201, 300, 3)) > 0.7 > 0.3 > max(got[n] for n in range(202, 300, 3))
    hidden = spark.createDataFrame([row(1, f"{words[0]} 1d10t {words[1]}"), row(2, "i d i o t")], SCHEMA)
    assert all(r.score > 0.5 for r in toxicity.score(hidden, model).collect())
    edges = toxicity.score(hard(spark), model).collect()
    assert len(edges) == len(hard_rows()) and all(0 <= r.score <= 1 for r in edges)
    assert toxicity.score(empty(spark), model).count() == 0


def test_toxicity_without_labels(spark, costs):
    docs = hard(spark)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.sample_of(docs, marks, F.lit(True)), costs)
    assert {round(r.score, 3) for r in toxicity.score(docs, model).collect()} == {0.0}


# ------------------------------------------------------------------ quality


def test_grades_of_held_out_documents(spark):
    words = [r[1] for r in hard_rows() if r[0] and 100 <= r[0] < 130]
    text = lambda n: [f"{'bad ' * 20}!!! ###", f"{words[n % 30]} rude rude", words[n % 30]][n % 3]
    docs = spark.createDataFrame([row(n, text(n)) for n in range(300)], SCHEMA)
    marks = spark.createDataFrame(
        [(n, int(n % 3 > 0), int(n % 3 == 1)) for n in range(300)] + [(None, 1, 0), (7, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.fit(quality.sample_of(docs, marks, F.col("doc_id") < 200))
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r.doc_id: r for r in quality.grade_documents(docs, model).collect()}
    means = [np.mean([got[n].expected_grade for n in range(200, 300) if n % 3 == g]) for g in range(3)]
    assert means[0] < 0.5 < means[1] < means[2]
    assert all((got[n].tail >= 0.5) == (n % 3 > 0) for n in range(200, 300))
    edges = quality.grade_documents(hard(spark), model).collect()
    assert len(edges) == len(hard_rows()) and all(0 <= r.expected_grade <= 2 for r in edges)
    assert quality.grade_documents(empty(spark), model).count() == 0


def test_quality_without_ratings_keeps_all(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(quality.sample_of(hard(spark), marks, F.lit(True)))
    assert quality.grade_documents(hard(spark), model).where("tail < 0.5").count() == 0


# ------------------------------------------------------------------ gaps


def read_words(costs, text):
    words = toxicity.Words(lambda reading: reading, costs)
    return {words.values[n] for n in words.rows([text.encode()])[0]}


@pytest.mark.parametrize(
    "text, word",
    [("e s t ú p i d o", "estúpido"), ("a s s", "ass"), ("an i d i o t, a", "idiot"), ('"i d i o t" x', "idiot"),
     ("1 d 1 0 t", "idiot"), ("st u pid", "stupid"), ("you i d i o t here", "idiot"), ("a st*pid man", "stupid")],
)
def test_spaced_words_are_read_by_the_lattice(costs, text, word):
    assert word in read_words(costs, text)


@pytest.mark.parametrize("text", ["a, b, c", "a a a", "1 2 3", "of the man", "***", "x"])
def test_other_words_stay_apart(costs, text):
    assert read_words(costs, text) <= {toxicity.restore(t, costs) for t in text.split()}


def cheapest_spacing(parts, costs):
    """Cost of the best of all ways to leave out gaps, by trying each of them."""
    best = np.inf
    for kept in itertools.product([True, False], repeat=len(parts) - 1):
        text = parts[0] + "".join((" " if k else "") + p for k, p in zip(kept, parts[1:]))
        code = [0, 0, *(0 if c == " " else toxicity.CODE.get(c, toxicity.CLASSES - 1) for c in text), 0]
        total = toxicity.GAP_COST * (len(kept) - sum(kept))
        total += sum(costs[tuple(code[n : n + 3])] for n in range(len(code) - 2))
        if total < best - 1e-9:
            best, words = total, text.split()
    return words


def test_gaps_are_chosen_as_by_trying_all(costs):
    """Over random splits of words, one-letter parts included, but not two of these in a row."""
    rng = np.random.default_rng(8)
    meant = ["stupid", "idiot", "loser", "trash", "ugly", "moron", "the", "stand", "thering", "reation", "oued"]
    for _ in range(300):
        parts = []
        for word in rng.choice(meant, rng.integers(1, 4)):
            cuts = sorted(rng.choice(np.arange(1, len(word)), min(len(word) - 1, rng.integers(0, 3)), replace=False))
            parts += [str(word[a:b]) for a, b in zip([0, *cuts], [*cuts, len(word)])]
        pairs = list(zip(parts, parts[1:]))
        if any(len(p) > toxicity.PART or toxicity.DOUBLED.search(p) for p in parts) or any(
            len(a) == len(b) == 1 for a, b in pairs
        ):
            continue
        joined = {w for w in cheapest_spacing(parts, costs) if w not in parts}
        readings = {toxicity.restore(w, costs) for w in joined} | set(parts)
        assert read_words(costs, " ".join(parts)) == readings, parts


def test_runs_of_single_characters_are_read_as_by_trying_all(costs):
    for text in ("s t", "x y", "a b", "t h", "i s", "st u p id", "ug l y", "l o ser"):
        parts = text.split()
        found = toxicity.respaced(parts, [len(p) == 1 for p in parts], costs)
        assert found == cheapest_spacing(parts, costs), text


# ------------------------------------------------------------------ quality, plainly


def plain_grades(text, model):
    """Expected grade and tail of a text, token by token from the definitions."""
    tokens = [t.decode() for t in (text or "").encode().split()]
    n, stats = len(tokens), [0.0] * 8
    letters = sum(c.isalpha() for t in tokens for c in t)
    if n:
        length = sum(map(len, tokens))
        digits = sum(c.isdigit() for t in tokens for c in t)
        stats = [
            min(1.0, math.log2(1 + n) / 16), sum(c.isupper() for t in tokens for c in t) / max(1, letters),
            digits / length, (length - letters - digits) / length,
            sum(a == b for a, b in zip(tokens, tokens[1:])) / (n - 1) if n > 1 else 0.0,
            len(set(tokens)) / n, min(1.0, length / n / 20), letters / length,
        ]
    s = sum(model.bins[k, int(x * 10)] for k, x in enumerate(stats))
    for t in tokens:
        shape = re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in t))
        for kind, part in ((b"w", t.lower()), (b"s", shape[:12])):
            s += model.words[zlib.crc32(kind + part.encode()) % (1 << 15)] / n
    tails = [1 / (1 + math.exp(min(30, max(-30, t - s)))) for t in model.thresholds]
    return sum(tails), tails[0]


def test_grades_equal_a_plain_computation(spark):
    rng = np.random.default_rng(6)
    model = quality.Model(rng.normal(0, 1, 1 << 15), rng.normal(0, 0.3, (8, 11)), np.array([-0.4, 0.7]))
    extra = [row(900, "STUPID!! Stupid!! 12 12 a"), row(901, "A-b C3PO x" * 30)]
    rows = [r for r in {r[0]: r for r in hard_rows() + extra}.values() if r[0] is not None]
    got = {r.doc_id: r for r in quality.grade_documents(spark.createDataFrame(rows, SCHEMA), model).collect()}
    for r in rows:
        expected, tail = plain_grades(r[1], model)
        assert got[r[0]].expected_grade == pytest.approx(expected, abs=1e-9), r[0]
        assert got[r[0]].tail == pytest.approx(tail, abs=1e-9)


def test_fit_climbs_the_likelihood(spark):
    """The fitted model's likelihood on its sample beats that of thresholds alone."""
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(["bad", "fine", "good"], 12, p=p)) for p in ([.7, .2, .1], [.2, .6, .2], [.1, .2, .7]) for _ in range(40)]
    grades = [g for g in range(3) for _ in range(40)]
    model = quality.fit(spark.createDataFrame(list(zip(texts, grades)), "text string, grade int"))
    assert (np.diff(model.thresholds) > 0).all()
    likelihood = 0.0
    for text, grade in zip(texts, grades):
        expected, tail = plain_grades(text, model)
        chances = [1 - tail, tail - (expected - tail), expected - tail]
        assert sum(chances) == pytest.approx(1)
        likelihood += math.log(max(chances[grade], 1e-12))
    assert likelihood > 0.5 * len(texts) * math.log(1 / 3)


# ------------------------------------------------------------------ toxicity, plainly


def test_scores_equal_a_plain_computation(spark, costs):
    """Features of a text looked up one by one, and summed."""
    rng = np.random.default_rng(9)
    rows = [r for r in {r[0]: r for r in hard_rows()}.values() if r[0] is not None and len(r[1] or "") < 50_000]
    words = toxicity.Words(lambda reading: reading, costs)
    features = {}
    for r in rows:
        readings = {words.values[n] for n in words.rows([(r[1] or "").encode()])[0]}
        features[r[0]] = {f for w in readings for f in toxicity.word_features(w)}
    every = sorted(set().union(*features.values()))
    weights = {f: float(w) for f, w in zip(every, rng.normal(0, 0.5, len(every))) if rng.random() < 0.3}
    model = toxicity.Model(costs, weights, -0.3)
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, SCHEMA), model).collect()}
    for doc_id, found in features.items():
        z = -0.3 + sum(weights.get(f, 0.0) for f in found)
        assert got[doc_id] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_features_by_definition():
    digest = lambda s: xxhash.xxh3_64_intdigest(s) >> 1
    assert toxicity.word_features("idiot") == [digest("=idiot"), digest("idi"), digest("idio")]
    assert set(toxicity.word_features("iddo")) == {digest(x) for x in ("=iddo", "idd", "=ido")}
    assert toxicity.word_features("") == []
