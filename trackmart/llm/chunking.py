"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks possible boundaries. Chunk lengths are
normalised: before ``NORMAL`` bytes a boundary needs more zero bits, after it fewer,
within ``SHORTEST`` and ``LONGEST``. As boundaries depend on nearby bytes only, an
insertion shifts them with the text, and chunks further on keep their digests. A
fingerprint is the set of chunk digests with the chunk lengths as weights; the
containment of one in another is the share of its weight that the other has too.

Every document is compared with an edited text made from the next document in
descending id order. Documents are dealt to range buckets by id, sorted within them,
and read as a stream; the first document of each bucket is also sent to the end of the
bucket before it, so no neighbour is missed and the text is shuffled once.

Rules
-----
* Null text counts as empty; an empty text has an empty fingerprint, contained wholly in
  an empty one and not at all in another.
* The last document's next is the first; a single document is its own next.
* Equal ids are ordered by text; null ids come last; an empty table gives an empty result.
  Other columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_schema, documents, exact, portions

SHORTEST, NORMAL, LONGEST = 32, 64, 256
STRICT_BITS, LOOSE_BITS = 8, 4
WINDOW = 32
ROWS_PER_BUCKET = 4_000
LEAST_ID = -(1 << 63)

# One random 32-bit number for each byte.
GEAR = np.frombuffer(
    b"".join(hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)), "<u4"
)
Fingerprint = dict[int, int]


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: the sum of GEAR of the byte i places back, shifted left i.

    A sum over twice as many bytes is that over the last ones plus that over those before
    them, shifted; five doublings reach 32 bytes, beyond which nothing is left of a byte.
    """
    hashes, reach = GEAR[data], 1
    while reach < WINDOW and reach < len(hashes):
        longer = hashes.copy()
        longer[reach:] += hashes[:-reach] << np.uint32(reach)
        hashes, reach = longer, 2 * reach
    return hashes


def fingerprints(texts: list[bytes]) -> list[Fingerprint]:
    """Length of each distinct chunk by digest, for each text.

    The texts are hashed as one: no boundary lies within WINDOW bytes of a text's start,
    so no hash that counts has seen another text.
    """
    joined = b"".join(texts)
    hashes = gear_hashes(np.frombuffer(joined, np.uint8))
    strict = (np.flatnonzero(hashes >> np.uint32(32 - STRICT_BITS) == 0) + 1).tolist()
    loose = (np.flatnonzero(hashes >> np.uint32(32 - LOOSE_BITS) == 0) + 1).tolist()
    strict.append(len(joined) + LONGEST + 1)
    loose.append(len(joined) + LONGEST + 1)
    digest, out, start = xxhash.xxh32_intdigest, [], 0
    for text in texts:
        end, chunks = start + len(text), {}
        while start < end:
            cut = strict[bisect_left(strict, start + SHORTEST)]
            if cut > start + NORMAL:
                cut = loose[bisect_left(loose, start + NORMAL)]
            cut = min(cut, start + LONGEST, end)
            chunks[digest(joined[start:cut])] = cut - start
            start = cut
        out.append(chunks)
    return out


def containment(one: Fingerprint, other: Fingerprint) -> float:
    """Share of the weight of ``one`` that ``other`` has too."""
    if not one:
        return 0.0 if other else 1.0
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    shared = sum(one[d] for d in small if d in large)
    return shared / sum(one.values())


def written_out(chunks: Fingerprint) -> str:
    """Sorted chunks, ten hex digits each: digest, then length less one."""
    return "".join([f"{d:08x}{n - 1:02x}" for d, n in sorted(chunks.items())])


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches, schema: pa.Schema):
    """Each document with the next of its bucket; a carried document is only ever next."""
    held = None  # bucket, id, text, fingerprint of the last document
    for batch in batches:
        buckets, ids, texts, carried = (batch.column(n).to_pylist() for n in range(4))
        raw = [t.encode() for t in texts]
        rows = []
        for a, b in portions(raw):
            prints = fingerprints(raw[a:b])
            pairs = []
            for n in range(a, b):
                mine = (buckets[n], ids[n], texts[n], prints[n - a])
                if held is not None and held[0] == mine[0]:
                    pairs.append((held, mine, edited(held[2], mine[2])))
                held = None if carried[n] else mine
            changed = [e.encode() for _, _, e in pairs]
            for (old, new, _), raw_edit, chunks in zip(pairs, changed, fingerprints(changed), strict=True):
                rows.append(
                    (
                        old[1],
                        len(old[2]),
                        hashlib.sha256(raw_edit).hexdigest(),
                        written_out(old[3]),
                        written_out(chunks),
                        containment(old[3], chunks),
                        containment(old[3], new[3]),
                    )
                )
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and the likeness of its
    fingerprint to the edited text's and to the next document's."""
    spark = docs.sparkSession
    read = docs.select(
        exact(id_col).cast("long").alias("doc_id"),
        F.coalesce(exact(text_col), F.lit("")).alias("text"),
        F.coalesce(exact(id_col).cast("long"), F.lit(LEAST_ID)).alias("place"),
    )
    n = max(1, read.count() // ROWS_PER_BUCKET)
    # One row per partition: the ids that open the ranges Spark's sampling has found.
    ranges = (
        read.select("place")
        .repartitionByRange(n, F.desc("place"))
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.max("place").alias("top"))
        .collect()
    )
    tops = sorted({float(r["top"]) for r in ranges})  # distinct as doubles, as buckets are
    if len(tops) > 1:
        # A bucket reaches from its top down to the next lower top. The splitter's intervals
        # are closed below, so it works on negated ids.
        splits = [-float("inf"), *sorted(-t for t in tops[:-1]), float("inf")]
        numbered = Bucketizer(splits=splits, inputCol="turned", outputCol="bucket").transform(
            read.withColumn("turned", -F.col("place").cast("double"))
        )
    else:
        numbered = read.withColumn("bucket", F.lit(0.0))
    numbered = numbered.select(F.col("bucket").cast("long").alias("bucket"), "doc_id", "text", "place")
    heads = numbered.select("bucket", "place").groupBy("bucket").agg(F.max("place").alias("place")).collect()
    order = sorted(r["bucket"] for r in heads)
    before = {b: order[k - 1] for k, b in enumerate(order)}
    carry = spark.createDataFrame(
        [(r["place"], before[r["bucket"]]) for r in heads], "place long, bucket long"
    )
    carried = (
        read.join(F.broadcast(carry), "place")
        .groupBy("bucket", "place")
        .agg(F.min("text").alias("text"))
        .select("bucket", F.col("place").alias("doc_id"), "text", "place", F.lit(True).alias("carried"))
    )
    stream = (
        numbered.withColumn("carried", F.lit(False))
        .unionByName(carried)
        .repartition(max(1, len(order)), "bucket")
        .sortWithinPartitions("bucket", "carried", F.desc("place"), "text")
        .select("bucket", "doc_id", "text", "carried")
    )
    schema = arrow_schema(SCHEMA)
    return stream.mapInArrow(lambda batches: _compare(batches, schema), SCHEMA)


def op7_content_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edit_likeness(documents(spark, folder))
