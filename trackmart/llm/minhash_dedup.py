"""Near-duplicate classes by MinHash with tensored banding.

A document's set holds the hashes of its distinct word shingles. Small collections of
``DEPTH`` minhashes each are computed for it, and a table's key combines the values of two
collections. So 54 collections of 8 make 1,431 tables with keys of 16 minhashes from 432 of
them; bands of their own would need about 3,000 for the same recall. Sets meet in some table
when they agree in two collections or more. At a similarity of 0.85 a collection agrees with
a chance of 0.85 ** 8 = 0.27; ``collections_for`` takes so many collections that a pair at
the threshold is missed with a chance of ``MISSED`` at most (54 for 0.85, 92 for 0.8).

1. *Values.* Texts are read once for shingles, minhashes and collection values. Sets that
   agree with others in two collections or more are fetched, in a second reading.
2. *Room.* Shingles that no other fetched set has are in no overlap. A set that has too many
   of them links with none. What the others have left, counted by ``PARTS`` classes of shingles,
   bounds the overlap of any pair: the sum of the lesser counts. That settles most of a group
   whose members are alike, but not alike enough.
3. *First tables.* The collections are paired off, each even one with an odd one. In each
   table one set of a key is its leader. A set is checked exactly against the ``LEADERS`` of
   other classes that it meets most often, and verified links make classes. ``ROUNDS`` such
   rounds, with other pairs and other leaders, take in large groups of near copies with a few
   pairs for each member.
4. *All tables.* A collection's value that only one class has leads nowhere. Sets with two
   other values or more go to the tables of these, where a class has one row for each key of
   its sets. Classes that share a key are opened, unless the sizes, room and parts of their
   sets rule a link out. Sets of two opened classes that agree in two collections, hence share
   a key, are the candidates, each pair once, unless their own sizes, room and parts rule it out.
5. *Confirmation.* Candidates are counted out on full sets. Links of both steps make the
   classes; copies of a set are one node throughout.

Rules
-----
* Words are runs of anything but ASCII white space after lower-casing A-Z. With fewer
  words than a shingle has, the whole sequence is the one shingle. Null or wordless text
  has an empty set and is linked with nothing.
* Equal sets link, whatever their number. Repeated rows are documents of their own. A
  null id belongs to its class but cannot name it; where no member has an id, all are kept.
  An empty table gives an empty result.
* Other columns are not read and may have any name.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackmart.llm.common import documents, exact, map_arrow, portions, utf8, written
from trackmart.llm.components import components
from trackmart.llm.jaccard_join import set_id, sets_of, shingle_sets, verified, word_table
from trackmart.session import staged

WORDS, PERCENT = 5, 80  # the defaults of near-duplicate operators
DEPTH = 8  # minhashes of a collection
PARTS = 32  # classes of shingles that overlaps are bounded by
ROUNDS, LEADERS = 3, 3  # how large groups are taken in; any numbers give the same classes
MISSED = 1e-6  # the chance, at most, that a pair at the threshold shares no table
SEED = 20_240_601
ROWS_AT_ONCE = 512  # shingles hashed at a time: a block of them fits a core's cache


def missed(similarity: float, depth: int, collections: int) -> float:
    """The chance that two sets agree in fewer than two collections."""
    p = similarity**depth
    return (1 - p) ** collections + collections * p * (1 - p) ** (collections - 1)


def collections_for(percent: int, depth: int = DEPTH, chance: float = MISSED) -> int:
    """The least even number of collections that misses a pair at the threshold that rarely."""
    n = 2
    while missed(percent / 100, depth, n) > chance:
        n += 2
    return n


def hash_family(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Factors, odd, and offsets of ``n`` maps of 32-bit numbers onto themselves."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors, rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minhashes(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each map over a set's shingles, by their upper 32 bits."""
    factors, offsets = family
    own = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(own), ROWS_AT_ONCE):
        values = own[at : at + ROWS_AT_ONCE, None] * factors
        values += offsets
        np.minimum(least, values.min(axis=0), out=least)
    return least


def collection_values(least: np.ndarray, depth: int) -> list[int]:
    """One 64-bit number per collection of ``depth`` minhashes."""
    raw = np.ascontiguousarray(least).tobytes()
    width = 4 * depth
    return [xxhash.xxh3_64_intdigest(raw[n : n + width]) - (1 << 63) for n in range(0, len(raw), width)]


def described(docs: DataFrame, words: int, depth: int, collections: int) -> DataFrame:
    """Per document: kind 0, a = id, b = set id, c = size, d = hash of the text, and the values
    of its set's collections, with the first of equal sets in a task only."""

    def setup():
        return word_table(), hash_family(depth * collections), set()

    def per_batch(batch, state):
        table, family, done = state
        ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
        marks = batch.column(2).to_pylist()
        for a, b in portions(texts, 1 << 20):
            if len(done) > 200_000:
                done.clear()
            found = shingle_sets(texts[a:b], table, words)
            names = [set_id(shingles) for shingles in found]
            values = []
            for name, shingles in zip(names, found, strict=True):
                new = len(shingles) and name not in done
                values.append(collection_values(minhashes(shingles, family), depth) if new else None)
                done.add(name)
            yield [[0] * len(names), ids[a:b], names, [len(x) for x in found], marks[a:b], values]

    return map_arrow(docs, per_batch, "kind int, a long, b long, c long, d long, vals array<long>", setup)


def shared_values(values: DataFrame, by: str) -> DataFrame:
    """The rows of ``values`` (nth, value, ...) whose value several ``by`` have."""
    several = (
        values.groupBy("nth", "value")
        .agg(F.min(by).alias("least"), F.max(by).alias("most"))
        .where("least <> most")
        .select("nth", "value")
    )
    return values.join(several, ["nth", "value"], "left_semi")


def rooms(sets: DataFrame) -> DataFrame:
    """set_id, room: how many shingles of a set another one of ``sets`` has; and parts: the same
    for each of ``PARTS`` classes of shingles. Two sets have no more in common than the sum of
    the lesser parts."""
    rows = sets.select("set_id", F.explode("shingles").alias("shingle"))
    several = (
        rows.groupBy("shingle")
        .agg(F.min("set_id").alias("least"), F.max("set_id").alias("most"))
        .where("least <> most")
        .select("shingle")
    )
    part = F.pmod(F.col("shingle"), F.lit(PARTS))
    counts = [F.count_if(part == k).cast("int").alias(f"part{k}") for k in range(PARTS)]
    shared = rows.join(several, "shingle", "left_semi").groupBy("set_id").agg(F.count(F.lit(1)).alias("room"), *counts)
    return shared.select("set_id", "room", F.array(*[f"part{k}" for k in range(PARTS)]).alias("parts"))


def as_numbers(sets: DataFrame) -> DataFrame:
    """set_id and its shingles as an array of numbers."""

    def per_batch(batch, _):
        found = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
        lengths = np.array([len(x) for x in found], np.int64)
        flat = np.concatenate([*found, np.zeros(0, np.int64)])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        yield [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]

    return map_arrow(sets.select("set_id", "shingles"), per_batch, "set_id long, shingles array<long>")


def tables(values: DataFrame, pairs_of) -> DataFrame:
    """key, set_id, n, room, grp: the tables' rows of sets whose collection values are ``values``.

    ``pairs_of(list)`` gives the pairs of a set's values, at most as many as collections,
    that make a key.
    """
    lists = values.groupBy("set_id", "n", "room", "grp").agg(
        F.array_sort(F.collect_list(F.struct("nth", "value"))).alias("own")
    )
    keys = lists.where(F.size("own") > 1).select("set_id", "n", "room", "grp", F.explode(pairs_of("own")).alias("pair"))
    return keys.select(F.xxhash64("pair").alias("key"), "set_id", "n", "room", "grp")


def paired_off(collections: int, shift: int):
    """A collection of even number with an odd one, where a set has both."""

    def pairs_of(own: str) -> Column:
        def pair(x: Column) -> Column:
            partner = (x["nth"] + 1 + 2 * shift) % collections
            other = F.get(F.filter(own, lambda y: y["nth"] == partner), F.lit(0))
            return F.struct(x.alias("one"), other.alias("other"))

        return F.filter(F.transform(own, pair), lambda p: (p["one"]["nth"] % 2 == 0) & p["other"].isNotNull())

    return pairs_of


def all_pairs(own: str):
    """Every collection with every later one."""
    pairs = F.transform(
        own, lambda x, i: F.transform(F.slice(own, i + 2, F.size(own)), lambda y: F.struct(x.alias("one"), y.alias("other")))
    )
    return F.flatten(pairs)


def may_link(percent: int) -> Column:
    """Whether sizes n and m and the room of both sets leave enough for an overlap."""
    n, m, most = F.col("n"), F.col("m"), F.least("room", "b_room")
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (most * (100 + percent) >= (n + m) * percent)


def leader_pairs(values: DataFrame, percent: int, collections: int, turn: int) -> DataFrame:
    """For every set the leaders of other classes that it meets most often in the tables of this
    turn: a, b."""
    rows = written(tables(shared_values(values, "grp"), paired_off(collections, turn)), "first-tables")
    rank = F.xxhash64(F.lit(turn), "set_id")
    leaders = rows.groupBy("key").agg(F.min(F.struct(rank, "set_id", "n", "room", "grp")).alias("first"))
    first = leaders.select(
        "key",
        F.col("first.set_id").alias("b"),
        F.col("first.n").alias("m"),
        F.col("first.room").alias("b_room"),
        F.col("first.grp").alias("b_grp"),
    )
    met = (
        rows.join(first, "key")
        .where((F.col("grp") != F.col("b_grp")) & may_link(percent))
        .groupBy(F.col("set_id").alias("a"), "b")
        .agg(F.count(F.lit(1)).alias("met"))
    )
    most = Window.partitionBy("a").orderBy(F.desc("met"), "b")
    return met.withColumn("nth", F.row_number().over(most)).where(F.col("nth") <= LEADERS).select("a", "b")


def enough_parts(n: Column, m: Column, percent: int) -> Column:
    """Whether the classes of shingles of ``parts`` and ``b_parts`` leave enough for an overlap of
    sets of sizes n and m."""
    # Spelled out, as the sum is compiled then.
    lesser = [F.least(F.get("parts", F.lit(k)), F.get("b_parts", F.lit(k))) for k in range(PARTS)]
    return functools.reduce(Column.__add__, lesser) * (100 + percent) >= (n + m) * percent


def class_keys(unsettled: DataFrame) -> DataFrame:
    """key, grp: the keys of the tables that several classes have, once for each of these. A class
    has few keys more than a set, however many sets it has."""
    rows = written(tables(unsettled, all_pairs).select("key", "grp").distinct(), "tables")
    several = (
        rows.groupBy("key").agg(F.min("grp").alias("least"), F.max("grp").alias("most")).where("least <> most").select("key")
    )
    return rows.join(several, "key", "left_semi")


def open_classes(unsettled: DataFrame, open_sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes, the smaller first, that meet in a table and whose sizes, rooms and parts
    leave room for a link: grp, g."""
    groups = open_sets.groupBy("grp").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max("room").alias("room"),
        F.array(*[F.max(F.get("parts", F.lit(k))) for k in range(PARTS)]).alias("parts"),
    )
    rows = written(class_keys(unsettled).join(groups, "grp"), "open-tables")
    other = rows.select(
        "key",
        F.col("grp").alias("g"),
        F.col("members").alias("g_members"),
        F.col("least").alias("g_least"),
        F.col("most").alias("g_most"),
        F.col("room").alias("b_room"),
        F.col("parts").alias("b_parts"),
    )
    least, g_least = F.col("least"), F.col("g_least")
    sizes = (F.col("most") * 100 >= g_least * percent) & (F.col("g_most") * 100 >= least * percent)
    room = F.least("room", "b_room") * (100 + percent) >= (least + g_least) * percent
    return (
        rows.join(other, "key")
        .where(F.struct("members", "grp") < F.struct("g_members", "g"))
        .where(sizes & room & enough_parts(least, g_least, percent))
        .select("grp", "g")
        .distinct()
    )


def candidate_pairs(values: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different classes that meet in a table: a, b. ``found`` are their rooms.

    Classes meet first, and only members of those that may link are compared, by the
    collections in which they agree: two at least, as in a table.
    """
    unsettled = written(shared_values(values, "grp"), "unsettled")
    several = unsettled.groupBy("set_id", "n", "room", "grp").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    open_sets = written(several.drop("times").join(found.select("set_id", "parts"), "set_id"), "open-sets")
    opened = written(open_classes(unsettled, open_sets, percent), "open-classes")
    rows = unsettled.select("set_id", "nth", "value").join(open_sets, "set_id")
    queries = rows.withColumnRenamed("set_id", "a").join(opened, "grp").drop("grp")
    members = rows.select(
        "nth",
        "value",
        F.col("set_id").alias("b"),
        F.col("n").alias("m"),
        F.col("room").alias("b_room"),
        F.col("grp").alias("g"),
        F.col("parts").alias("b_parts"),
    )
    return (
        queries.join(members, ["g", "nth", "value"])
        .where(may_link(percent) & enough_parts(F.col("n"), F.col("m"), percent))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("agree"))
        .where("agree > 1")
        .select("a", "b")
    )


def classes(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    depth: int = DEPTH,
    collections: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    read = docs.select(
        exact(id_col).cast("long").alias("id"),
        exact(text_col).alias("text"),
        F.xxhash64(exact(text_col)).alias("mark"),
    )
    collections = collections or collections_for(percent, depth)
    rows = written(described(read, words, depth, collections), "minhashes")
    values = written(
        rows.where("vals IS NOT NULL")
        .select(F.col("b").alias("set_id"), F.col("c").alias("n"), F.posexplode("vals").alias("nth", "value"))
        .distinct(),
        "collection-values",
    )

    meeting = (
        shared_values(values, "set_id").groupBy("set_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    )
    wanted = written(meeting.select(F.col("set_id").alias("a"), F.col("set_id").alias("b")), "meeting-sets")
    with staged(sets_of(read, rows, wanted, words), "sets") as copies:
        # Tasks that read the same set each send it once.
        sets = written(copies.groupBy("set_id").agg(F.first("shingles").alias("shingles")), "sets")
    known = written(rooms(as_numbers(sets)), "rooms")
    # The union of two sets has n shingles at least.
    roomy = F.col("room") * 100 >= F.col("n") * percent
    able = written(values.join(known.select("set_id", "room"), "set_id").where(roomy), "able")

    def links(pairs: DataFrame) -> DataFrame:
        return written(verified(written(pairs, "pairs"), sets, percent), "links")

    def classed(found: DataFrame) -> DataFrame:
        named = components(found).select(F.col("node").alias("set_id"), F.col("label").alias("grp"))
        return able.join(named, "set_id", "left").withColumn("grp", F.coalesce("grp", "set_id"))

    grouped, found = able.withColumn("grp", F.col("set_id")), None
    for turn in range(ROUNDS):
        new = links(leader_pairs(grouped, percent, collections, turn))
        found = new if found is None else found.unionAll(new)
        grouped = classed(found)
    more = links(candidate_pairs(grouped, known, percent))
    labels = components(found.unionAll(more)).withColumnRenamed("node", "set_id")

    own = rows.select(F.col("a").alias("doc_id"), F.col("b").alias("set_id"), F.col("c").alias("n_shingles"))
    least_of_set = own.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    label = F.coalesce("label", "set_id")
    labelled = written(least_of_set.join(labels, "set_id", "left").withColumn("label", label), "labelled")
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    names = labelled.join(least, "label").select("set_id", "component_id")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        own.join(names, "set_id", "left")
        .withColumn("component_id", component)
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def op11_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return classes(documents(spark, folder), words=5, percent=85)


def class_sql(words: int, percent: int, columns: str) -> str:
    """Classes of documents by counting the shingles that every two of them share."""
    following = "".join(f" || ' ' || lead(word, {k}) OVER o" for k in range(1, words))
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS words
  FROM documents),
p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM w WHERE len(words) >= {words}),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5_number_lower(shingle) AS shingle
  FROM (SELECT doc_id, word{following} AS shingle FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY place)
        UNION ALL
        SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND {words - 1})
  WHERE shingle IS NOT NULL),
d AS MATERIALIZED (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
linked AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  JOIN d n ON n.doc_id = x.doc_id JOIN d m ON m.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, n.n, m.n
  HAVING 100 * count(*) >= {percent} * (n.n + m.n - count(*))),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other)
SELECT doc_id, n::BIGINT AS n_shingles, min(other) AS component_id{columns}
FROM reach JOIN d USING (doc_id) GROUP BY doc_id, n
"""


SQL = class_sql(5, 85, ", doc_id = min(other) AS kept")
