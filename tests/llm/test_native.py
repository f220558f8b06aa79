"""Exact dedup, mixing and personal data, against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import SCHEMA, empty, hard, hard_rows, row
from trackmart.llm import exact_dedup, mixing, pii

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Python|Pandas|Arrow", plan)


def copy_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(UPPER)].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            out[(i, keep, len(ids), i == keep, digest)] += 1
    return out


def test_copy_groups(spark):
    got = exact_dedup.copy_groups(hard(spark))
    assert not python_nodes(got)
    assert Counter(map(tuple, got.collect())) == copy_groups(hard_rows())


def test_frequent_groups_take_the_broadcast_path(spark):
    rows = [row(n, "Same") for n in range(500)] + [row(1000 + n, f"text {n}") for n in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    keyed = docs.select("doc_id", exact_dedup.text_digest(F.col("text")).alias("digest"))
    winners = exact_dedup.verified_winners(keyed).collect()
    assert [(w.keep_id, w.group_size) for w in winners] == [(499, 500)]
    assert Counter(map(tuple, exact_dedup.copy_groups(docs).collect())) == copy_groups(rows)
    left = exact_dedup.exact_dedup(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [499, *range(1000, 1500)]


def test_exact_dedup_returns_one_row_per_text(spark):
    docs = hard(spark)
    left = exact_dedup.exact_dedup(docs)
    assert left.columns == docs.columns
    texts = [(r.text or "").translate(UPPER) for r in left.collect()]
    assert Counter(texts) == Counter(set((r[1] or "").translate(UPPER) for r in hard_rows()))


def filled(sizes):
    """Targets by resharing until none is above its ceiling."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] >= 2 * sizes[s]}
        if not over:
            return out | {s: share * weights[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_source_plan(spark):
    rows = hard_rows()
    got = mixing.source_plan(hard(spark))
    assert not python_nodes(got)
    got = got.collect()
    assert len(got) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, targets = Counter(), Counter(), {}
    for r in rows:
        sizes[r[3]] += count(r[1])
    want = filled(dict(sizes))
    sources = {(r[0], count(r[1])): r[3] for r in rows}
    for r in got:
        source = sources[r.doc_id, r.size]
        assert r.source_size == sizes[source]
        taken[source] += r.taken
        targets[source] = r.target
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1
    for source, target in want.items():
        assert targets[source] == pytest.approx(target)
        assert abs(taken[source] - target) < 1
    again = mixing.source_plan(hard(spark).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_curriculum_inverts_cumulative_demand(spark):
    for tilt in mixing.TILTS:
        times = spark.range(11).select(
            (F.col("id") / 10).alias("u"),
            mixing.training_time(F.col("id") / 10, F.lit(tilt)).alias("t"),
        )
        for r in times.collect():
            assert r.t + tilt * r.t * (1 - r.t) == pytest.approx(r.u)


def test_mixed_repeats_whole_documents_in_order(spark):
    docs = hard(spark)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    plan = {r.doc_id: r for r in mixing.source_plan(docs).collect()}
    for doc_id, n in Counter(r.doc_id for r in got.collect()).items():
        if doc_id is not None and doc_id != 8:
            assert n <= 2 and abs(n * plan[doc_id].size - plan[doc_id].taken) <= plan[doc_id].size


def test_plan_is_in_training_order(spark):
    places = [r.position for r in mixing.source_plan(hard(spark)).collect()]
    assert None in places and places == sorted(places, key=lambda p: (p is None, p))


def test_every_pass_has_its_place_in_training_order(spark):
    docs = hard(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).localCheckpoint()
    plan = {r.doc_id: r for r in mixing.source_plan(docs).collect()}
    passes = mixing.training_order(docs).collect()
    assert [r.position for r in passes] == sorted(r.position for r in passes)
    by_doc = {}
    for r in passes:
        by_doc.setdefault(r.doc_id, {})[r["pass"]] = r
    assert any(len(own) == 2 for own in by_doc.values())
    assert set(by_doc) == {d for d, r in plan.items() if r.taken}
    for doc_id, own in by_doc.items():
        assert sum(r.words for r in own.values()) == plan[doc_id].taken
        assert own[0].position == plan[doc_id].position
        assert 1 not in own or own[0].position < own[1].position <= 1


def luhn(digits):
    values = [int(c) * 2 - 9 * (int(c) > 4) if n % 2 else int(c) for n, c in enumerate(reversed(digits))]
    return sum(values) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) < 256 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    )
    out = []
    for nth, (kind, pattern, check) in enumerate(rules):
        out += [(m.start(), nth, m.end(), kind) for m in re.finditer(pattern, text) if check(m)]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out))


TRICKY = [
    "a@b.c.d@e.f _d@x.yz a@b.c_d@e.f @a.b x@y x@-.- 🙂q@r.st",
    "1.2.3.4.5.6.7.8 256.1.1.1 000001.2.3.4 1.2.3 9.9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111112",
    "+1 (017) 555-7713 rest +1 (017) 555-7713 4111111111111111 +12 +1........2",
    "x12 41111111 4111 1111 1111 1111",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33, ssn 123-45-6789 / 123-45-6789",
    "éé +1 (132) 555-1352 1.1.1.1@a.b 1@1.1.1.1",
]


def test_personal_data(spark):
    rows = [row(5000 + n, t) for n, t in enumerate(TRICKY)] + hard_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = pii.find_spans(docs).select(
        "doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(F.col("added")).alias("added")
    )
    assert not python_nodes(found)
    result = found.collect()
    want = Counter((r[0], base_spans(r[1] or "")) for r in rows)
    assert Counter((r.doc_id, r.base) for r in result) == want
    added = {r.doc_id: r.added for r in result}
    assert "iban:5:32" in added[5005] and added[5005].count("iban") == 1
    assert "ssn:70:81" in added[5005]
    assert "card:" in added[5002]


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([row(1, "my card: 4111111111111111"), row(2, "so 4111111111111111")], SCHEMA)
    scores = {r.doc_id: r.base[0].score for r in pii.find_spans(docs).collect()}
    assert scores == {1: 1.0, 2: 0.8}


def test_long_runs_stay_linear(spark):
    texts = ["a" * 100_000, "1" * 100_000, "1 " * 50_000, "+" + "1-" * 50_000, "1." * 50_000, "a@" * 50_000]
    docs = spark.createDataFrame([row(n, t) for n, t in enumerate(texts)], SCHEMA)
    assert pii.find_spans(docs).where("size(base) > 1").count() <= len(texts)


def test_empty_tables(spark):
    docs = empty(spark)
    assert exact_dedup.copy_groups(docs).count() == 0
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert mixing.source_plan(docs).count() == 0
    assert mixing.mixed(docs).count() == 0
    assert pii.find_spans(docs).count() == 0
