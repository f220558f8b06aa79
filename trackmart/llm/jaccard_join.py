"""N-gram Jaccard join with a token-group matrix, to classes of linked documents.

A document's set holds the hashes of its distinct word shingles. Two documents link when
their sets' Jaccard similarity reaches the threshold; the result is exact up to hash
collisions (64 bits, with the set size beside them).

1. *Order.* Shingles that many documents share are gathered as per-task counts and put
   last in a global order; all others are ordered by hash. The list of frequent
   shingles has at most ``MOST_FREQUENT`` rows. It only steers cost: any order is right.
2. *Postings.* A set posts a prefix of its shingles in that order. If sets of sizes n and
   m link, they share at least ``l`` posted shingles, l being that of the smaller set:
   each has ceil(t n) in common with any set it links to, so the first
   n - ceil(t n) + l shingles of both meet in l of them. Only shingles that two different
   sets post are kept, and of those only sets that have l of them. A posting also knows
   its place, and how many places before it nobody shares: no set that has this shingle
   in common has those, which bounds the overlap (``reach``) and hence the sizes of sets
   to link to.
3. *Groups.* For every posted shingle the most central sets of a size band (those whose
   posted shingles are shared most) are leaders. A set is checked exactly against the
   leader it shares most with; verified links make the groups of similar documents.
4. *Matrix.* The token-group matrix has the union of the posted shingles of each group's
   members of one size. A query set outside a group meets it in the matrix where its reach
   allows for that size; its overlap with the union bounds that with every member. Of two
   groups, the sets of the smaller one are queries.
5. *Opening.* Only groups whose bound reaches l are opened: the members that share l posted
   shingles with the query, within the reach of both, are checked exactly. Members of one
   group are never compared with each other, as they are in one class already.
6. Links make classes; copies of a set are one node throughout.

Rules
-----
* Words are runs of anything but ASCII white space after lower-casing A-Z. With fewer
  words than a shingle has, the whole sequence is the one shingle. Null or wordless text
  has an empty set and is linked with nothing.
* Equal sets link, whatever their number. Repeated rows are documents of their own. A
  null id belongs to its class but cannot name it. An empty table gives an empty result.
* Other columns are not read and may have any name.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackmart.llm.common import (
    Table,
    documents,
    exact,
    fresh,
    map_arrow,
    portions,
    ragged,
    utf8,
    written,
)
from trackmart.llm.components import components
from trackmart.session import staged

WORDS, PERCENT = 5, 80  # the defaults of near-duplicate operators
FREQUENT_FROM = 32
MOST_FREQUENT = 1 << 18
LEADERS = 3
BROADCAST_SETS = 200_000  # a list of so many sets, of 16 bytes each, is sent to all tasks
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def scrambled(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_table() -> Table:
    return Table(xxhash.xxh3_64_intdigest, 1, limit=100_000, dtype=np.uint64)


def shingle_sets(texts: list[bytes], table: Table, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    table.trim()
    split = [t.lower().split() for t in texts]
    lengths = [len(s) for s in split]
    rows = table.indices([w for s in split for w in s])
    hashes = table.rows[rows, 0]
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for n in range(words):
        rolled = rolled * MULTIPLIER + hashes[n : n + len(rolled)]
    rolled = scrambled(rolled)
    out, at = [], 0
    for n in lengths:
        if n >= words:
            out.append(np.unique(rolled[at : at + n - words + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for h in hashes[at : at + n]:
                whole = whole * MULTIPLIER + h
            out.append(scrambled(whole))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def least_overlap(n, percent: int):
    """What a set of ``n`` has in common, at least, with a set it links to."""
    return -(-percent * n // 100)


def least_shared(n, percent: int):
    """How many posted shingles two linked sets share at least, n being the smaller size."""
    return 1 + (n - least_overlap(n, percent)) // 4


def least_shared_column(n: Column, percent: int) -> Column:
    overlap = F.floor((n * percent + 99) / 100)
    return 1 + F.floor((n - overlap) / 4)


def described(docs: DataFrame, words: int) -> DataFrame:
    """Per document (kind 0): a = id, b = set id, c = size, d = hash of the text. Per portion
    of texts (kind 1): a = shingle, b = number of its distinct sets that have it, from two."""

    def per_batch(batch, table):
        ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
        marks = batch.column(2).to_pylist()
        for a, b in portions(texts, 3 << 20):
            found = shingle_sets(texts[a:b], table, words)
            names = [set_id(shingles) for shingles in found]
            sizes = [len(shingles) for shingles in found]
            yield [[0] * len(names), ids[a:b], names, sizes, marks[a:b]]
            distinct = list(dict(zip(names, found, strict=True)).values())
            del found
            tokens, counts = np.unique(np.concatenate(distinct), return_counts=True)
            tokens, counts = tokens[counts > 1], counts[counts > 1]
            zero = np.zeros(len(tokens), np.int64)
            yield [zero + 1, tokens.view(np.int64), counts, zero, zero]

    schema = "kind int, a long, b long, c long, d long"
    return map_arrow(docs, per_batch, schema, word_table)


def frequent_shingles(described_rows: DataFrame) -> np.ndarray:
    """The shingles to put last, the most frequent at the end: at most MOST_FREQUENT."""
    rows = (
        described_rows.where("kind = 1")
        .groupBy("a")
        .agg(F.sum("b").alias("n"))
        .where(F.col("n") >= FREQUENT_FROM)
        .orderBy(F.desc("n"), "a")
        .limit(MOST_FREQUENT)
        .toArrow()
    )
    return rows.column("a").to_numpy()[::-1].astype(np.int64)


def postings(docs: DataFrame, frequent: np.ndarray, words: int, percent: int) -> DataFrame:
    """token, set_id, n, place for the prefix of every set; copies within a task post once."""
    order = np.argsort(frequent)
    sent = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def setup():
        return word_table(), set()

    def per_batch(batch, state):
        table, posted = state
        listed, rank = sent.value
        texts = utf8(batch.column(1))
        for a, b in portions(texts):
            if len(posted) > 1_000_000:
                posted.clear()
            tokens, names, sizes = [], [], []
            for found in shingle_sets(texts[a:b], table, words):
                name = set_id(found)
                if not len(found) or name in posted:
                    continue
                posted.add(name)
                own, n = found.view(np.int64), len(found)
                length = n - least_overlap(n, percent) + least_shared(n, percent)
                if len(listed):
                    at = np.minimum(np.searchsorted(listed, own), len(listed) - 1)
                    late = np.where(listed[at] == own, rank[at] + 1, 0)
                    own = own[np.argsort(late, kind="stable")]
                tokens.append(own[:length])
                names.append(name)
                sizes.append(n)
            if tokens:
                lengths = [len(t) for t in tokens]
                places = ragged(np.zeros(len(tokens), np.int64), np.array(lengths))
                yield [
                    np.concatenate(tokens),
                    np.repeat(names, lengths),
                    np.repeat(sizes, lengths),
                    places,
                ]

    return map_arrow(docs, per_batch, "token long, set_id long, n long, place long", setup)


def shared_postings(posted: DataFrame) -> DataFrame:
    """Postings of tokens that at least two sets have, with how many rows have the token."""
    by_token = Window.partitionBy("token")
    return (
        posted.withColumn("least", F.min("set_id").over(by_token))
        .withColumn("most", F.max("set_id").over(by_token))
        .withColumn("df", F.count(F.lit(1)).over(by_token))
        .where("least <> most")
        .select("token", "set_id", "n", "place", "df")
        .distinct()
    )


def enough_shared(shared: DataFrame, percent: int) -> DataFrame:
    """The postings of sets that share enough to link at all, with how ``central`` a set is.

    ``reach`` bounds the overlap with a set for which this is the last posting in common:
    shared places up to here and all that follow. It never rises along a set, so it holds
    for every posting in common with that set.
    """
    by_set = Window.partitionBy("set_id")
    so_far = F.row_number().over(by_set.orderBy("place"))
    return (
        shared.withColumn("central", F.sum("df").over(by_set))
        .withColumn("posted", F.count(F.lit(1)).over(by_set))
        .withColumn("reach", so_far + F.col("n") - 1 - F.col("place"))
        .where(F.col("posted") >= least_shared_column(F.col("n"), percent))
        .select("token", "set_id", "n", "place", "central", "reach")
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("other"))

    def per_batch(batch, _):
        a, b, one, other = (batch.column(n).to_pylist() for n in range(4))
        keep = []
        for x, y in zip(one, other, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield [[v for v, k in zip(column, keep, strict=True) if k] for column in (a, b)]

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "one", "other")
    return map_arrow(both, per_batch, "a long, b long")


def sets_of(docs: DataFrame, described_rows: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """set_id and shingles of the sets in ``pairs``, from one document of each.

    Up to ``BROADCAST_SETS`` of them are looked for where documents are read; beyond that
    the documents are shuffled.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    holders = written(
        described_rows.where("kind = 0")
        .select(F.col("b").alias("set_id"), F.struct(F.col("a").alias("id"), F.col("d").alias("mark")).alias("doc"))
        .join(wanted, "set_id", "left_semi")
        .groupBy("set_id")
        .agg(F.min("doc").alias("doc"))
        .select(F.col("doc.id").alias("id"), F.col("doc.mark").alias("mark"))
        .distinct(),
        "holders",
    )
    hint = "broadcast" if holders.count() <= BROADCAST_SETS else "shuffle_hash"
    keyed = docs.alias("t").join(
        holders.hint(hint).alias("h"),
        F.expr("t.mark = h.mark AND t.id <=> h.id"),
        "left_semi",
    )

    def setup():
        return word_table(), set()

    def per_batch(batch, state):
        table, done = state
        texts = utf8(batch.column(1))
        for a, b in portions(texts):
            names, found = [], []
            for shingles in shingle_sets(texts[a:b], table, words):
                name = set_id(shingles)
                if name not in done:
                    done.add(name)
                    names.append(name)
                    found.append(shingles.tobytes())
            yield [names, found]

    return map_arrow(keyed, per_batch, "set_id long, shingles binary", setup)


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return (n * 100 >= m * percent) & (m * 100 >= n * percent)


def _reaches(reach: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether an overlap of ``reach`` is enough for sets of sizes n and m."""
    return reach * (100 + percent) >= (n + m) * percent


def _meets(n: Column, m: Column, percent: int) -> Column:
    """Whether a common posting counts for its pair of sets (n, place, reach; m, spot, far).

    The sizes must fit, the overlap must be within reach, and the posting within the
    prefixes that sets of just these sizes need to meet in l places.
    """
    overlap = F.ceil((n + m) * percent / (100 + percent))
    spare = least_shared_column(F.least(n, m), percent) - overlap
    return (
        _sizes_fit(n, m, percent)
        & _reaches(F.least("reach", "far"), n, m, percent)
        & (F.col("place") < n + spare)
        & (F.col("spot") < m + spare)
    )


def _may_link(met: DataFrame, percent: int) -> DataFrame:
    """Of pairs with one row per posting in common (a, b, n, m, place, spot), those that the
    number in common and what follows the last one do not rule out."""
    n, m = F.col("n"), F.col("m")
    rest = F.least(n - 1 - F.col("place"), m - 1 - F.col("spot"))
    return (
        met.groupBy("a", "b", "n", "m")
        .agg(F.count(F.lit(1)).alias("common"), F.max("place").alias("place"), F.max("spot").alias("spot"))
        .where(F.col("common") >= least_shared_column(F.least(n, m), percent))
        .where(_reaches(F.col("common") + rest, n, m, percent))
    )


def leader_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """For every set, the leader it shares most with: a, b."""
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent)))
    ranked = shared.withColumn("band", band)
    order = Window.partitionBy("token", "band").orderBy(F.desc("central"), "set_id")
    leaders = (
        ranked.withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= LEADERS)
        .select(
            "token",
            "band",
            F.col("set_id").alias("b"),
            F.col("n").alias("m"),
            F.col("place").alias("spot"),
            F.col("reach").alias("far"),
        )
    )
    n, m = F.col("n"), F.col("m")
    met = (
        ranked.select("token", "band", F.col("set_id").alias("a"), "n", "place", "reach")
        .join(leaders, ["token", "band"])
        .where(F.col("a") != F.col("b"))
        .where(_meets(n, m, percent))
    )
    best = Window.partitionBy("a").orderBy(F.desc("common"), "b")
    return _may_link(met, percent).withColumn("nth", F.row_number().over(best)).where("nth = 1").select("a", "b")


def opened_pairs(shared: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets from different groups that the matrix cannot rule out: a, b."""
    rows = shared.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "token", "set_id", "n", "place", "reach", F.coalesce("label", "set_id").alias("grp")
    )
    facts = (
        rows.select("grp", "set_id").distinct().groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    )
    rows = written(rows.join(facts, "grp"), "matrix-rows")
    # A token whose sets are all in one group has nothing more to say.
    by_token = Window.partitionBy("token")
    rows = (
        rows.withColumn("least", F.min("grp").over(by_token))
        .withColumn("most", F.max("grp").over(by_token))
        .where("least <> most")
        .drop("least", "most")
    )
    rows = written(rows, "matrix-rows")
    n, m = F.col("n"), F.col("m")
    matrix = rows.select(
        "token",
        F.col("grp").alias("g"),
        F.col("n").alias("m"),
        F.col("members").alias("g_members"),
    ).distinct()
    qualifying = (
        rows.join(matrix, "token")
        .where(
            (F.struct("members", "grp") < F.struct("g_members", "g"))
            & _sizes_fit(n, m, percent)
            & _reaches(F.col("reach"), n, m, percent)
        )
        .groupBy("set_id", "n", "g", "m")
        .agg(F.count(F.lit(1)).alias("bound"))
        .where(F.col("bound") >= least_shared_column(F.least("n", "m"), percent))
        .select(F.col("set_id").alias("a"), "g", "m")
    )
    queries = rows.select("token", F.col("set_id").alias("a"), "n", "place", "reach").join(
        written(qualifying, "qualifying"), "a"
    )
    members = rows.select(
        "token",
        F.col("set_id").alias("b"),
        F.col("n").alias("m"),
        F.col("grp").alias("g"),
        F.col("place").alias("spot"),
        F.col("reach").alias("far"),
    )
    met = queries.join(members, ["token", "g", "m"]).where(_meets(n, m, percent))
    return _may_link(met, percent).select("a", "b")


def classes(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, set_id, and mark, the hash of its text."""
    read = docs.select(
        exact(id_col).cast("long").alias("id"),
        exact(text_col).alias("text"),
        F.xxhash64(exact(text_col)).alias("mark"),
    )
    rows = written(described(read, words), "shingle-sets")
    posted = postings(read, frequent_shingles(rows), words, percent)
    with staged(shared_postings(posted), "postings") as all_shared:
        shared = written(enough_shared(all_shared, percent), "postings")

    def links(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs, "pairs")
        with staged(sets_of(read, rows, pairs, words), "sets") as sets:
            return written(verified(pairs, sets, percent), "links")

    first = links(leader_pairs(shared, percent))
    more = links(opened_pairs(shared, components(first), percent))
    labels = components(first.unionAll(more))

    own = rows.where("kind = 0").select(
        F.col("a").alias("doc_id"), F.col("b").alias("set_id"), F.col("c").alias("n_shingles"), F.col("d").alias("mark")
    )
    by_set = own.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    named = by_set.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "label", F.coalesce("label", "set_id")
    )
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    names = named.join(least, "label").select("set_id", "component_id")
    joined = own.join(names, "set_id", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "set_id",
        "mark",
    )


def one_per_class(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their class; unlinked rows all stay.

    A row goes by its id and the hash of its text, so a row of that id with another text
    does not go with it. Rows that share the least id all stay, and so do rows with a null id.
    """
    found = classes(docs, words, percent, id_col, text_col)
    drop, mark = fresh(docs, "drop"), fresh(docs, "mark")
    dropped = (
        found.where("n_shingles > 0 AND doc_id <> component_id")
        .select(F.col("doc_id").alias(drop), F.col("mark").alias(mark))
        .distinct()
    )
    same = (exact(id_col) == F.col(drop)) & (F.xxhash64(exact(text_col)) == F.col(mark))
    return docs.join(dropped, same, "left_anti")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return classes(documents(spark, folder), words=4, percent=85).select(
        "doc_id", "n_shingles", "component_id"
    )
