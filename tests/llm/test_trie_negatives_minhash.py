"""Prefix trie, hard negatives and MinHash classes, against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import SCHEMA, empty, hard, hard_rows, row, vocabulary
from trackmart.llm import minhash_dedup, negatives, prefix_trie

# ------------------------------------------------------------------ trie

TURNS = "conv_id long, turn long, role string, text string, depth string, k1 int, `a.b` int"


def sequences(rows):
    by_id = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            by_id[conv_id].append((turn is not None, turn or 0, role or "", digest, text or ""))
    return {c: [(t[2], t[4]) for t in sorted(own)] for c, own in by_id.items()}


def rebuilt_sequences(own):
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + seq[h:]
    return out


def plain_trie(own):
    members = defaultdict(list)
    for c, seq in own.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, at in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(at) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = Counter()
    for node, at in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in at if len(own[c]) == len(node)))
        up = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out[(min(at), len(node), up, len(at), kids[node], leaves[node], saved[node], digest)] += 1
    return out


def turn_rows():
    """Shared beginnings, nulls, ties, repeated rows, a deep conversation, a long turn."""
    rng = random.Random(3)
    rows = []
    for c in range(0, 60_000, 997):
        same = rng.randint(0, 6)
        turns = ["hello", "é and more", "", "go on", "yes", "no", "fine"][:same]
        turns += [f"{c % 7} {n}" for n in range(rng.randint(0, 5))]
        rows += [(c, n, "user" if n % 2 == 0 else "assistant", t) for n, t in enumerate(turns)]
    for c in (*range(-12, 25), 20_000, 40_000):
        rows += [(c, n, "user", t) for n, t in enumerate(["hello", "é and more", "tie"])]
        rows += [(c, n, None if n % 3 else "user", f"turn {n}") for n in range(3, 3 + (c % 11))]
    rows += [(90, n, "user", f"deep {n}") for n in range(70)] + [(91, n, "user", f"deep {n}") for n in range(68)]
    rows += [(90, 12, "user", "deep 12"), (90, 12, "user", "deep 12"), (90, 12, "assistant", "x"), (90, None, None, None)]
    rows += [(None, 0, "user", "nobody"), (92, 0, "user", "x" * 70_000), (93, None, "user", "b"), (93, None, "user", "a")]
    return rows


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], TURNS).repartition(5)


def nodes_of(frame):
    return Counter(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in frame.collect()
    )


def test_a_band_holds_two_depths_at_least(spark):
    with pytest.raises(ValueError):
        prefix_trie.conversation_trie(turn_frame(spark, []), 1)


@pytest.mark.parametrize("height", [3, 8])
def test_trie(spark, height):
    rows = turn_rows()
    assert nodes_of(prefix_trie.conversation_trie(turn_frame(spark, rows), height)) == plain_trie(sequences(rows))


def test_trie_of_rebuilt_conversations(spark):
    rows = [r for r in turn_rows() if r[0] is None or r[0] < 90 or r[0] > 95]
    placed = prefix_trie.turns(turn_frame(spark, rows))
    want = plain_trie(rebuilt_sequences(sequences(rows)))
    assert any(key[1] == 0 and key[3] > 1 for key in want)
    assert nodes_of(prefix_trie.trie(*prefix_trie.rebuilt(placed), height=2)) == want


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(turn_frame(spark, [])).count() == 0
    nobody = turn_frame(spark, [(None, 1, "user", "x")])
    assert prefix_trie.conversation_trie(nobody).count() == 0


def test_ids_of_one_node_are_joined_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, 0, "user", "the same") for c in range(-40, 200, 3)] + [(1000, 0, "user", "other")]
    assert nodes_of(prefix_trie.conversation_trie(turn_frame(spark, rows))) == plain_trie(sequences(rows))


def test_no_row_goes_to_more_ancestors_than_a_band_is_high(spark):
    rows = turn_rows()
    placed = prefix_trie.turns(turn_frame(spark, rows))
    paths = prefix_trie.paths(placed.select("conv_id").distinct(), placed).cache()
    nodes = paths.groupBy("k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"))
    for step in (1, 3):
        own = nodes.where(F.col("depth") % step == 0)
        found = prefix_trie.chains(paths, own, step, 3)
        assert found.count() == own.count()
        assert found.where("size(inside) <> level % 3 + 1").isEmpty()
        assert found.where("size(above) <> IF(level % 3 = 0 AND level > 0, 3, -1) AND above IS NOT NULL").isEmpty()
    paths.unpersist()


# ------------------------------------------------------------------ negatives

VECTORS = "vec_id long, embedding array<float>, label int, row string, v int, `a.b` int"


def plain_negatives(rows, every=4, k=5, percent=80):
    own = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = Counter()
    for a in own:
        if a[0] % every:
            continue
        scored = sorted((-dot(a[2], o[2]), o[0], o[1]) for o in own)
        positives = [s for s in scored if s[2] == a[1] and s[1] != a[0]][:k]
        for top, positive, _ in positives:
            fits = [s for s in scored if s[2] != a[1] and 80 * -top <= 100 * -s[0] <= 100 * -top]
            for rank, (score, other, _) in enumerate(fits[:k], 1):
                out[(a[0], positive, rank, other, -top, -score)] += 1
    return out


def vector_rows(n=400, dims=20, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, dims))
    rows = []
    for i in range(n):
        c = int(rng.integers(0, 6))
        rows.append((i, (0.7 * centres[c] + rng.normal(0, 0.4, dims)).astype(np.float32).tolist(), (c + (i % 5 == 0)) % 6))
    one = rows[8][1]
    rows += [(n + i, one, i % 3) for i in range(60)]  # one very common vector: ties
    rows += [(n + 100, None, 1), (n + 104, one, None), (None, one, 1), (n + 108, [], 1), (n + 112, one[:7], 2)]
    rows += [(n + 116, [float("nan"), *one[1:]], 1), (n + 120, [*one[:-1], float("inf")], 1), (n + 124, [None, *one[1:]], 1)]
    return [*rows, rows[3], rows[8], rows[8], rows[9]]


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], VECTORS).repartition(4)


def mined(spark, rows, **bounds):
    vectors = negatives.vectors(vector_frame(spark, rows), F.col("label"))
    found = negatives.hard_negatives(vectors, F.col("vec_id") % 4 == 0, **bounds)
    return Counter(tuple(r) for r in found.collect())


def test_negatives(spark, monkeypatch):
    rows = vector_rows()
    want = plain_negatives(rows)
    assert len(want) > 500
    assert mined(spark, rows) == want
    monkeypatch.setattr(negatives, "BLOCK", 37)
    monkeypatch.setattr(negatives, "QUERY_BLOCK", 16)
    assert mined(spark, rows) == want


def test_negatives_of_nothing(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(1, [1.0], 1), (2, [1.0], 2)])  # no query
    assert not mined(spark, [(4, [1.0], 1)])  # no positive
    assert not mined(spark, [(4, [1.0], 1), (5, [1.0], 1)])  # no negative
    assert mined(spark, [(4, [1e30], 1), (5, [1e30], 1), (6, [1e30], 2)])[(4, 5, 1, 6, 1 << 56, 1 << 56)] == 1


def test_scan_shrinks_the_bitmap():
    rng = np.random.default_rng(1)
    v = rng.integers(-100, 100, (500, 64)) // np.arange(1, 65)
    block = negatives.Block(np.arange(500), np.zeros(500, int), v)
    left = []

    def may_count(lower, upper):
        assert (lower <= upper).all()
        bar = negatives.kth_greatest(lower, 5)
        left.append(int((upper >= bar).sum()))
        return upper >= bar

    found, score = block.scan(v[7], np.arange(500), may_count)
    assert left == sorted(left, reverse=True) and left[-1] < 500 and left[0] < 500
    exact = v @ v[7]
    assert (score == exact[found]).all()
    assert set(np.argsort(-exact, kind="stable")[:5]) <= set(found)


# ------------------------------------------------------------------ MinHash


def plain_classes(rows, words, percent):
    sets = []
    for r in rows:
        own = (r[1] or "").encode().lower().split()
        n = max(1, len(own) - words + 1)
        sets.append({tuple(own[i : i + words]) for i in range(n)} if own else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if both and 100 * both >= percent * (len(one) + len(sets[j]) - both):
                label[root(i)] = root(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root(i)].append(r[0])
    out = Counter()
    for i, r in enumerate(rows):
        name = r[0] if not sets[i] else min(ids[root(i)], default=None)
        out[(r[0], len(sets[i]), name, r[0] == name)] += 1
    return out


def classes_of(frame):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


def near_rows():
    """Chains of edits, a large group of near copies, texts that share a long passage."""
    rng = random.Random(9)
    words = vocabulary(400, 3)
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    rows, base = [], prose(90)
    for n in range(60):
        own = list(base)
        own[rng.randrange(90)] = rng.choice(words)
        rows.append(row(1000 + n, " ".join(own)))
    chain = prose(150)
    for n in range(25):
        chain[(7 * n) % 150] = f"edit{n}"
        rows.append(row(2000 + n, " ".join(chain)))
    passage = prose(60)
    rows += [row(3000 + n, " ".join([*prose(15 + n % 9), *passage, *prose(10)])) for n in range(40)]
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_minhash_classes(spark, percent):
    rows = hard_rows() + near_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = classes_of(minhash_dedup.classes(docs, 5, percent))
    assert got == plain_classes(rows, 5, percent)


def test_minhash_classes_of_nothing(spark):
    assert minhash_dedup.classes(empty(spark)).count() == 0
    lone = spark.createDataFrame([row(1, None), row(2, ""), row(None, " ")], SCHEMA)
    assert classes_of(minhash_dedup.classes(lone)) == Counter([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)])


def test_minhash_keeps_extra_columns_out(spark):
    assert minhash_dedup.classes(hard(spark)).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_collections_agree_as_often_as_the_similarity_says():
    rng = np.random.default_rng(4)
    depth, collections = 4, 400
    family = minhash_dedup.hash_family(depth * collections)
    for similarity in (0.5, 0.85, 0.95):
        shared = rng.integers(0, 1 << 63, int(1000 * similarity), dtype=np.uint64) * np.uint64(2)
        rest = rng.integers(0, 1 << 63, 1000 - len(shared), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        a, b = np.append(shared, rest[::2]), np.append(shared, rest[1::2])
        one, other = (minhash_dedup.minhashes(x, family) for x in (a, b))
        assert abs((one == other).mean() - similarity) < 0.05
        agree = np.mean(np.array(minhash_dedup.collection_values(one, depth)) == minhash_dedup.collection_values(other, depth))
        assert abs(agree - similarity**depth) < 0.1


def test_collections_a_threshold_needs():
    assert minhash_dedup.collections_for(85) == 54
    assert minhash_dedup.missed(0.85, 8, 54) <= 1e-6 < minhash_dedup.missed(0.85, 8, 52)


def test_a_class_has_one_row_a_key_however_many_sets_it_has(spark):
    schema = "set_id long, n long, room long, grp long, nth int, value long"

    def keys(members):
        rows = [(m, 10, 10, 1, nth, nth) for m in range(1, members + 1) for nth in range(6)]
        rows += [(1000, 10, 10, 1000, nth, nth) for nth in range(4)]
        return minhash_dedup.class_keys(spark.createDataFrame(rows, schema)).count()

    assert keys(2) == keys(40) == 2 * math.comb(4, 2)


def test_candidates_are_the_pairs_that_meet_and_have_room(spark):
    rng = random.Random(3)
    percent, parts = 80, minhash_dedup.PARTS
    sets = {}
    for name in range(60):
        counts = [rng.choice([2, 3, 3, 3]) for _ in range(parts)]
        values = [rng.choice([0, 0, nth, name]) for nth in range(6)]
        sets[name] = (sum(counts) + rng.randrange(12), sum(counts), rng.choice([name, -1, -2]), counts, values)
    rows = [(a, n, room, grp, nth, v) for a, (n, room, grp, _, own) in sets.items() for nth, v in enumerate(own)]
    values = spark.createDataFrame(rows, "set_id long, n long, room long, grp long, nth int, value long")
    found = spark.createDataFrame([(a, x[3]) for a, x in sets.items()], "set_id long, parts array<int>")

    def candidate(x, y):
        (n, room, grp, one, own), (m, b_room, g, other, theirs) = x, y
        least = min(room, b_room, sum(map(min, one, other)))
        return (
            grp != g
            and sum(map(int.__eq__, own, theirs)) > 1
            and min(n, m) * 100 >= max(n, m) * percent
            and least * (100 + percent) >= (n + m) * percent
        )

    expected = {(a, b) for a in sets for b in range(a) if candidate(sets[a], sets[b])}
    got = [tuple(sorted(r, reverse=True)) for r in minhash_dedup.candidate_pairs(values, found, percent).collect()]
    assert len(got) == len(set(got)) and 0 < len(expected) < 1000
    assert set(got) == expected
