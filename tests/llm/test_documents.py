"""Packing, line dedup, fingerprints, Jaccard join and the pipeline, against plain versions."""

import ctypes
import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.frames import SCHEMA, empty, hard, hard_rows, row, vocabulary
from tests.llm.test_native import filled
from trackmart.llm import chunking, jaccard_join, language, line_dedup, packing
from trackmart.llm.common import BATCH_BYTES, BATCH_SETTING, documents, folds, give_back, map_arrow

# ------------------------------------------------------------------ packing


def test_pieces_and_places(spark):
    rows = hard_rows()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[(r[0], piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    got = packing.pack(hard(spark)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    check_layout([(r.sequence_id, r.offset, r.length) for r in got], 4096)
    assert packing.pack(empty(spark)).count() == 0


def check_layout(places, capacity):
    by_sequence = defaultdict(list)
    for sequence, offset, length in places:
        by_sequence[sequence].append((offset, length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - length)
        else:
            gaps.append(capacity - length)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_supersteps_equal_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = 50
    lengths = rng.integers(1, rng.integers(3, capacity + 1), 200).tolist()
    counts = Counter(lengths)
    places = []
    for length, low, high, sequence, each, offset in packing.sweeps(counts, capacity):
        for r in range(high - low):
            places.append((sequence + r // each, offset + r % each * length, length))
    assert Counter(p[2] for p in places) == counts
    check_layout(places, capacity)
    used = Counter()
    for sequence, _, length in places:
        used[sequence] += length
    assert sorted(capacity - n for n in used.values()) == best_fit_decreasing(lengths, capacity)


def test_word_ids_equal_whole_text_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, ids = Tokenizer.from_file(path), packing.WordIds(path)
    texts = ["It's  12 éÀ́ <|endoftext|>x\n\t日本", "", "ΟΔΟΣ ΣΑΣ", "don't a b c\x1cd", "e ́x"]
    for text, got in zip(texts, ids([t.encode() for t in texts])):
        assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# ------------------------------------------------------------------ lines


def kept_lines(rows, min_docs):
    key = lambda line: line.encode().strip().lower()
    refs = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    out = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if not key(x) or refs[key(x)] < min_docs]
        out[(r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    return out


def line_rows():
    words = vocabulary(40, 5)
    return hard_rows() + [
        row(300 + n, "\n".join([" Shared\t", f"own {n}", words[n % 7], "", "SHARED", words[n % 11]])) for n in range(60)
    ]


def digests(frame):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in frame.collect())


def test_line_dedup(spark, monkeypatch):
    rows = line_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    index = line_dedup.insert(line_dedup.empty_index(spark, 5), docs)
    assert digests(line_dedup.drop_lines(docs, index)) == kept_lines(rows, 5)
    for keys, salts in ((50_000, 1), (8, 3)):  # one filter, or many small ones
        monkeypatch.setattr(line_dedup, "SALTS", salts)
        monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", keys)
        index = line_dedup.insert(line_dedup.empty_index(spark, 5), docs)
        assert digests(line_dedup.drop_lines(docs, index)) == kept_lines(rows, 5)
    assert index.shards > 1


def test_deleting_unknown_documents_is_refused(spark):
    known = spark.createDataFrame(line_rows()[:10], SCHEMA)
    index = line_dedup.insert(line_dedup.empty_index(spark, 2), known)
    with pytest.raises(line_dedup.NotInserted):
        line_dedup.delete(index, spark.createDataFrame([row(1, "never seen")], SCHEMA))
    assert digests(line_dedup.drop_lines(known, index)) == kept_lines(line_rows()[:10], 2)


def test_few_lines_pass_the_filters(spark):
    docs = spark.createDataFrame(line_rows(), SCHEMA)
    index = line_dedup.insert(line_dedup.empty_index(spark, 20), docs)
    read = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    lines = line_dedup._lines(read, 1)
    assert 0 < line_dedup._passed(lines, index).count() < lines.count() / 2


def test_deletion_undoes_insertion(spark):
    rows = line_rows()
    one = spark.createDataFrame(rows[:70], SCHEMA)
    two = spark.createDataFrame(rows[70:], SCHEMA)
    first = line_dedup.insert(line_dedup.empty_index(spark, 5), one)
    both = line_dedup.insert(first, two)
    assert digests(line_dedup.drop_lines(one.unionAll(two), both)) == kept_lines(rows, 5)
    back = line_dedup.delete(both, two)
    state = lambda i: Counter(map(tuple, i.counts.select("h1", "h2", "refs").collect()))
    assert state(back) == state(first)
    assert digests(line_dedup.drop_lines(one, back)) == kept_lines(rows[:70], 5)
    gone = line_dedup.delete(back, one)
    assert gone.counts.count() == 0
    assert all(not np.frombuffer(r.cells, np.uint16).any() for r in gone.filters.collect())


def test_cuckoo_filter_keeps_all_and_forgets():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), (1 << 63) - 1, (9000, 2))
    cuckoo = line_dedup.CuckooFilter(np.zeros(8192, np.uint16))
    cuckoo.insert(keys[:, 0], keys[:, 1])
    assert cuckoo.stash and cuckoo.contains(keys[:, 0], keys[:, 1]).all()
    cuckoo.delete(keys[:4000, 0], keys[:4000, 1])
    assert cuckoo.contains(keys[4000:, 0], keys[4000:, 1]).all()
    assert cuckoo.contains(keys[:4000, 0], keys[:4000, 1]).mean() < 0.01


def test_lines_of_an_empty_table(spark):
    index = line_dedup.insert(line_dedup.empty_index(spark), empty(spark))
    assert index.counts.count() == 0
    assert line_dedup.drop_lines(empty(spark), index).count() == 0
    assert line_dedup.drop_lines(hard(spark), index).where("n_dropped > 0").count() == 0


# ------------------------------------------------------------------ fingerprints


def test_gear_hash_equals_its_definition():
    data = np.frombuffer(hashlib.sha512(b"x").digest(), np.uint8)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(chunking.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert chunking.gear_hashes(data).tolist() == want


def test_fingerprints_do_not_depend_on_neighbours():
    texts = [t.encode() for t in (hard_rows()[7][1], "", "short", hard_rows()[12][1])]
    together = chunking.fingerprints(texts)
    assert together == [chunking.fingerprints([t])[0] for t in texts]
    assert chunking.containment(together[0], together[0]) == 1.0
    assert sum(together[0].values()) <= len(texts[0])


def plain_chunks(data: bytes) -> dict[int, int]:
    """Chunks found byte by byte, the gear hash computed from its definition at each of them."""
    out, start = {}, 0

    def marked(end, bits):
        window = data[end - 32 : end]
        h = sum(int(chunking.GEAR[b]) << n for n, b in enumerate(reversed(window))) & 0xFFFFFFFF
        return h >> (32 - bits) == 0

    while start < len(data):
        cut = None
        for end in range(start + 32, min(start + 256, len(data)) + 1):
            if marked(end, 8 if end < start + 64 else 4) or end == start + 64 and marked(end, 8):
                cut = end
                break
        cut = cut or min(start + 256, len(data))
        out[xxhash.xxh32_intdigest(data[start:cut])] = cut - start
        start = cut
    return out


def test_chunks_equal_those_found_byte_by_byte():
    rng = np.random.default_rng(3)
    texts = [(r[1] or "").encode()[:6000] for r in hard_rows()]
    texts += [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (31, 32, 33, 64, 65, 255, 256, 257, 4000)]
    for text, found in zip(texts, chunking.fingerprints(texts), strict=True):
        assert found == plain_chunks(text)
        for n, other in ((len(text) // 2, text), (len(text), texts[7])):
            mine, theirs = plain_chunks(text[:n]), plain_chunks(other)
            want = sum(w for d, w in mine.items() if d in theirs) / sum(mine.values()) if mine else float(not theirs)
            assert chunking.containment(*chunking.fingerprints([text[:n], other])) == pytest.approx(want)


def test_chunks_resist_shifts():
    text = hard_rows()[12][1]
    one, moved = chunking.fingerprints([text.encode(), ("inserted " + text).encode()])
    assert chunking.containment(one, moved) > 0.98


def test_edited_texts(spark):
    rows = [r for r in hard_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = {r.doc_id: r for r in chunking.edit_likeness(spark.createDataFrame(rows, SCHEMA)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for r, following in zip(order, order[1:] + order[:1], strict=True):
        text, after = r[1] or "", following[1] or ""
        changed = chunking.edited(text, after)
        mine, other, new = chunking.fingerprints([text.encode(), after.encode(), changed.encode()])
        g = got[r[0]]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (g.fingerprint, g.edited_fingerprint) == (chunking.written_out(mine), chunking.written_out(new))
        assert (g.near_edited, g.near_next) == (chunking.containment(mine, new), chunking.containment(mine, other))


def test_neighbours_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(chunking, "ROWS_PER_BUCKET", 7)
    test_edited_texts(spark)


def test_fingerprints_of_edge_tables(spark):
    assert chunking.edit_likeness(empty(spark)).count() == 0
    assert chunking.edit_likeness(hard(spark)).count() == len(hard_rows())
    only = chunking.edit_likeness(spark.createDataFrame([row(1, "abcdef")], SCHEMA)).first()
    assert only.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and only.near_next == 1.0


# ------------------------------------------------------------------ Jaccard join


def shingles(text, words):
    w = (text or "").encode().lower().split()
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[n : n + words]) for n in range(len(w) - words + 1))


def plain_classes(rows, words, percent):
    """(n_shingles, component_id) of each row by comparing all pairs."""
    sets = [shingles(r[1], words) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for n, r in enumerate(rows):
        ids[find(n)].append(r[0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return [(len(s), r[0] if not s else least[find(n)]) for n, (r, s) in enumerate(zip(rows, sets))]


def linked_rows(seed):
    """Chains of ever more edited copies, shared passages, and short texts."""
    rng = np.random.default_rng(seed)
    words = vocabulary(400, seed)
    passages = [list(rng.choice(words, 30)) for _ in range(3)]
    rows, n = hard_rows(), 1000
    for length in (3, 6, 12, 40, 100, 250):
        for _ in range(4):
            text = list(rng.choice(words, length))
            for step in range(6):
                rows.append(row(n, " ".join(text)))
                n += 1
                for _ in range(max(1, length // 60)):
                    text[rng.integers(length)] = str(rng.choice(words))
    for k in range(60):
        own = list(rng.choice(words, int(rng.integers(1, 40))))
        rows.append(row(n + k, " ".join(passages[k % 3] + own)))
    return rows


@pytest.mark.parametrize("words, percent, seed", [(4, 85, 1), (5, 80, 2)])
def test_classes_equal_all_pairs(spark, words, percent, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", 4)
    rows = linked_rows(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes(docs, words, percent).collect())
    assert got == Counter((r[0], *c) for r, c in zip(rows, plain_classes(rows, words, percent)))


def test_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(9)
    words = vocabulary(500, 9)
    base = list(rng.choice(words, 200))
    rows = []
    for n in range(400):
        text = list(base)
        for _ in range(int(rng.integers(0, 9))):
            text[rng.integers(200)] = str(rng.choice(words))
        rows.append(row(n, " ".join(text)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.classes(docs, 4, 85).collect()}
    assert got == {r[0]: c for r, c in zip(rows, plain_classes(rows, 4, 85))}


def test_one_per_class(spark):
    docs = hard(spark)
    kept = jaccard_join.one_per_class(docs)
    assert kept.columns == docs.columns
    want = Counter(
        r[0] for r, (n, c) in zip(hard_rows(), plain_classes(hard_rows(), 5, 80)) if r[0] is None or not n or r[0] == c
    )
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert jaccard_join.one_per_class(empty(spark)).count() == 0


def test_a_row_does_not_go_with_another_of_its_id(spark):
    words = vocabulary(200, 4)
    one, other = " ".join(words[:60]), " ".join(words[100:160])
    rows = [row(1, one), row(7, one + " end"), row(7, other), row(8, other + " end"), row(7, None)]
    kept = jaccard_join.one_per_class(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, one), (7, other), (7, None)])


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark):
    docs = hard(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema) if rows else docs.limit(0)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    check_layout([(r.sequence_id, r.offset, r.length) for r in packed], 4096)
    assert sum(r.piece == 0 for r in packed) == docs.count()
    left = {r.doc_id for r in docs.collect()}
    assert not left & {1, 2, 3, 13, 16}  # no letter
    assert not left & {9, 10} or 8 not in left


def test_code_switched_documents_stay(spark):
    rng = np.random.default_rng(3)
    own = {lang: ["".join(rng.choice(list(letters), 6)) for _ in range(60)]
           for lang, letters in (("aa", "abcde"), ("bb", "fghij"), ("cc", "klmno"), ("dd", "pqrst"))}
    text = lambda **n: " ".join(" ".join(rng.choice(own[lang], k)) for lang, k in n.items())
    rows = [row(n, text(**{lang: 60}), lang) for n, lang in enumerate(list(own) * 30)]
    rows += [
        row(1000, text(aa=40, bb=35, cc=25), None),
        row(1001, text(aa=49, bb=49, cc=2), None),
        row(1002, text(aa=25, bb=25, cc=25, dd=25), None),
        row(1003, "1 2 3", None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert set(left) == set(range(120)) | {1000, 1001, 1002}
    assert left[1000] == "aa" and left[1001] in ("aa", "bb") and left[7] == "dd"
    blank = language.Model(list(own), np.zeros((language.BUCKETS, 4)), np.zeros((4, 4)))
    doubtful = language.label_rows(docs.where("doc_id < 5"), blank, "found", "certainty").collect()
    assert [r.certainty for r in doubtful] == pytest.approx([0.25] * 5)


def confident(docs, model):
    """Documents whose words are labelled with a mean certainty of a half, one by one."""
    out = []
    for r in docs:
        words = (r.text or "").encode().split()
        scores = language.emissions(words, model.weights) if words else np.zeros((0, len(model.languages) + 1))
        read = scores[:, -1] > 0
        if read.any():
            chances = language.label_chains(scores[:, :-1], np.array([len(words)]), model.moves)[read]
            out += [r] * int(chances.max(1).mean() >= 0.5)
    return out


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def passes_taken(docs):
    """Times each document is taken, by running sums of words along each source."""
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    sizes, start, taken = Counter(), Counter(), Counter()
    for r in docs:
        sizes[r.source] += size[r.doc_id]
    target = filled(dict(sizes))
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    for r in sorted(docs, key=lambda r: digest(f"{r.doc_id}:{digest(r.text or '')}")):
        for n in range(2):
            middle = start[r.source] + n * sizes[r.source] + size[r.doc_id] / 2
            taken[r.doc_id] += size[r.doc_id] > 0 and middle <= target[r.source]
        start[r.source] += size[r.doc_id]
    return +taken


def test_stages_keep_what_plain_versions_keep(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    held_out = folds(F.col("doc_id"), 5) == 0
    model = language.fit(language.training_sample(docs, F.col("text"), F.col("lang"), ~held_out))
    rows = docs.collect()
    schema = docs.schema
    got = corpus_pipeline.identify_language(spark, docs, "").collect()
    want = confident(rows, model)
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in want)
    largest = {}
    for r in want:
        text = None if r.text is None else lower_az(r.text)
        largest[text] = max(r.doc_id, largest.get(text, r.doc_id))
    want = [r for r in want if r.doc_id in set(largest.values())]
    got = corpus_pipeline.drop_copies(spark, spark.createDataFrame(got, schema), "").collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in want)
    classes = plain_classes(want, 5, 80)
    want = [r for r, (n, c) in zip(want, classes) if not n or r.doc_id == c]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(got, schema), "").collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in want)
    got = corpus_pipeline.mix_sources(spark, spark.createDataFrame(got, schema), "").collect()
    assert Counter(r.doc_id for r in got) == passes_taken(want)


def test_pipeline_of_sample_tables(spark):
    """Against plain versions of what each stage may keep."""
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    packed = corpus_pipeline.run(spark, folder).collect()
    taken = Counter(r.doc_id for r in packed if r.piece == 0)
    assert max(taken.values()) <= 2
    texts = Counter((docs[i].text or "").lower() for i in taken)
    assert max(texts.values()) == 1
    classes = plain_classes([(i, docs[i].text) for i in taken], 5, 80)
    assert len({c for _, c in classes}) == len(taken)
    check_layout([(r.sequence_id, r.offset, r.length) for r in packed], 4096)


class Mallinfo(ctypes.Structure):
    _fields_ = [
        (name, ctypes.c_size_t)
        for name in "arena ordblks smblks hblks hblkhd usmblks fsmblks uordblks fordblks keepcost".split()
    ]


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "mallinfo2"), reason="needs the GNU C library")
def test_packing_tasks_leave_no_memory_behind():
    in_use = ctypes.CDLL(None).mallinfo2
    in_use.restype = Mallinfo
    letters = "bcdfghjklmnpqrstvwxz"
    text = " ".join(map("".join, itertools.islice(itertools.product(letters, repeat=5), 0, 400_000, 20))).encode()
    path = public_tokenizers.path("word_bpe_49k.json")

    def task():
        assert len(packing.WordIds(path)([text])[0]) > 20_000
        give_back()
        return in_use().uordblks

    first = [task() for _ in range(2)][-1]
    # The library's cache kept about 4 MB of each task.
    assert [task() for _ in range(4)][-1] - first < 4 << 20


def test_workers_get_small_batches(spark):
    rows = spark.range(6_000, numPartitions=1).select("id", F.repeat(F.lit("word "), 1_000).alias("text"))

    def sizes(batch, _):
        yield [[batch.num_rows], [batch.column(1).buffers()[2].size]]

    kept = spark.conf.get(BATCH_SETTING, None)
    try:
        spark.conf.unset(BATCH_SETTING)
        found = map_arrow(rows, sizes, "n long, bytes long").collect()
        assert sum(r["n"] for r in found) == 6_000
        assert max(r["bytes"] for r in found) <= 3 * BATCH_BYTES  # 30 MB in one batch before
        # What a session sets itself stays.
        spark.conf.set(BATCH_SETTING, str(16 << 20))
        map_arrow(rows, sizes, "n long, bytes long")
        assert spark.conf.get(BATCH_SETTING) == str(16 << 20)
    finally:
        spark.conf.unset(BATCH_SETTING) if kept is None else spark.conf.set(BATCH_SETTING, kept)
