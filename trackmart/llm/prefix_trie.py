"""Conversation prefix trie, with totals of subtrees by depth-band rollup.

Conversations are sequences of turns. Each distinct sequence of first turns is a node of
the trie; a node's members are the conversations that start with it. Nodes are found by
digest: a turn's place, role and text give four numbers, and the running sums of these
along a conversation name its prefixes (about 124 bits), so no conversation is ever held
as a whole.

Totals over subtrees are rolled up in bands of ``height`` depths:

1. Within a band each node adds its values to its ancestors in that band, at most
   ``height`` of them, itself included.
2. The tops of the bands make a trie of their own, ``height`` times less deep, whose values
   are the totals within bands. It is rolled up in the same way.
3. A completed band top adds its total to the ancestors of its parent in the band above,
   ``height`` of them.

So a trie of depth D takes about log(D) rounds, and no node is exploded to more than
``height`` ancestors in any of them.

Rules
-----
* Turns are ordered by turn, null first; equal turns by role, then by the SHA-256 of the
  text. Null role or text counts as empty. Repeated rows are turns of their own.
* Rows with a null conversation id take no part. A conversation without turns belongs to
  the root alone. An empty table gives an empty result, without a root.
* Texts are only read for their digest and their length. Other columns are not read and
  may have any name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackmart.llm.common import exact, map_arrow, written

HEIGHT = 8
GROUP, HEADS = 5, 9  # the query's rebuilding: groups of 5 ids, heads of up to 8 turns
CHUNK = 4096  # ids that are joined to one text at a time
LANES = ["s0", "s1", "s2", "s3"]
KEY = ["k1", "k2"]


def turns(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, place (from 1), role, digest (of the text) and bytes (its length) of each turn."""
    text = F.coalesce(exact(text_col), F.lit(""))
    read = conversations.where(exact(id_col).isNotNull()).select(
        exact(id_col).cast("long").alias("conv_id"),
        exact(turn_col).alias("turn"),
        F.coalesce(exact(role_col), F.lit("")).alias("role"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return read.withColumn("place", F.row_number().over(order)).drop("turn")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's conversations: ids, and turns as :func:`turns` gives them.

    Conversation c begins with the first h turns of conversation c - c % 5 and goes on with
    its own after its first h. At most nine ids name the same other conversation.
    """
    sizes = placed.groupBy("conv_id").agg(F.max("place").alias("size"))
    ids = sizes.select(
        "conv_id",
        F.least("size", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("dropped"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("taken"),
        (F.col("conv_id") - F.col("conv_id") % GROUP).alias("head_id"),
    )
    heads = placed.where((F.col("place") < HEADS) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed(
        "conv_id", "head_id"
    )
    before = heads.groupBy("head_id").agg(F.max("place").alias("held"))
    ids = written(
        ids.join(before, "head_id", "left").withColumn(
            "taken", F.least("taken", F.coalesce("held", F.lit(0)))
        ),
        "rebuilt-ids",
    )
    first = ids.join(heads, "head_id").where("place <= taken")
    own = placed.join(ids, "conv_id").where("place > dropped").withColumn(
        "place", F.col("place") - F.col("dropped") + F.col("taken")
    )
    columns = ["conv_id", F.col("place").cast("long").alias("place"), "role", "digest", "bytes"]
    return ids.select("conv_id"), first.select(columns).unionAll(own.select(columns))


def paths(ids: DataFrame, placed: DataFrame) -> DataFrame:
    """Every conversation at every depth: conv_id, depth, key, parent's key, bytes, ends.

    ``ids`` holds each conversation once, ``placed`` its turns. A key is made of sums over
    the turns so far, each turn's number being a hash of its place, role and text.
    """

    def number(n: int):
        lane = F.xxhash64(F.lit(n // 2), F.col("place"), F.col("role"), F.col("digest"))
        return F.shiftright(lane, 31 * (n % 2)).bitwiseAND(F.lit((1 << 31) - 1))

    lanes = [number(n).alias(s) for n, s in enumerate(LANES)]
    roots = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), *[
        F.lit(0).cast("long").alias(s) for s in LANES
    ])
    rows = roots.unionAll(placed.select("conv_id", F.col("place").alias("depth"), "bytes", *lanes))
    order = Window.partitionBy("conv_id").orderBy("depth")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.select(
        "conv_id",
        "depth",
        "bytes",
        F.lead("depth").over(order).isNull().alias("ends"),
        *[F.sum(s).over(so_far).alias(s) for s in LANES],
    )
    keyed = summed.select(
        "conv_id",
        "depth",
        "bytes",
        "ends",
        *[F.xxhash64(F.lit(n), "depth", *LANES).alias(k) for n, k in enumerate(KEY)],
    )
    return keyed.select("*", *[F.lag(k).over(order).alias(f"p{k}") for k in KEY])


def chains(rows: DataFrame, nodes: DataFrame, step: int, height: int) -> DataFrame:
    """Per node whose depth is a multiple of ``step``: k1, k2, level, inside, above.

    ``inside`` are its ancestors down from the top of its band, itself included; for the top
    of a band below the first, ``above`` are those of the band above. They are read off the
    path of the node's first conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("depth")
    level = F.col("depth").cast("long") / step
    path = rows.where(F.col("depth") % step == 0).select(
        "conv_id",
        "depth",
        level.cast("long").alias("level"),
        F.collect_list(F.struct(*KEY)).over(order.rowsBetween(-height, 0)).alias("chain"),
    )
    at = (F.col("level") % height + 1).cast("int")
    top = (at == 1) & (F.col("level") > 0)
    return nodes.join(path, ["conv_id", "depth"]).select(
        *KEY,
        "level",
        F.slice("chain", -at, at).alias("inside"),
        F.when(top, F.slice("chain", 1, height)).alias("above"),
    )


def rolled_up(
    rows: DataFrame, nodes: DataFrame, values: DataFrame, names: list[str], deepest: int,
    height: int = HEIGHT, step: int = 1,
) -> DataFrame:
    """k1, k2 and the sums of ``names`` over all nodes below, itself included.

    ``values`` has a row for every node whose depth is a multiple of ``step``.
    """

    def added(keys: str, frame: DataFrame) -> DataFrame:
        spread = frame.select(F.explode(keys).alias("to"), *names)
        return spread.groupBy(F.col("to.k1").alias("k1"), F.col("to.k2").alias("k2")).agg(
            *[F.sum(n).alias(n) for n in names]
        )

    known = written(chains(rows, nodes, step, height).join(values, KEY), "chains")
    within = written(added("inside", known), "within-bands")
    if deepest < step * height:
        return within
    tops = known.where(F.col("level") % height == 0).select(*KEY, "above")
    below = rolled_up(
        rows, nodes, within.join(tops.select(KEY), KEY, "left_semi"), names, deepest, height, step * height
    )
    carried = added("above", below.join(tops.where("above IS NOT NULL"), KEY))
    both = within.unionByName(carried).groupBy(KEY).agg(*[F.sum(n).alias(n) for n in names])
    return written(both, "totals")


def ends_digests(rows: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of the nodes at which conversations end.

    Ids are joined to texts by blocks of ``CHUNK`` consecutive ids. A digest is fed block by
    block where a node's blocks arrive in order, so no list of ids is ever held as a whole.
    """
    block = F.floor(F.col("conv_id") / CHUNK)
    chunks = (
        rows.where("ends")
        .groupBy(*KEY, block.alias("block"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    )
    single = F.sha2(F.col("ids").cast("binary"), 256)
    counted = written(chunks, "end-ids")
    many = counted.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(KEY)
    in_order = (
        counted.join(many, KEY, "left_semi").repartition(*KEY).sortWithinPartitions(*KEY, "block")
    ).select(*KEY, "ids")

    def setup():
        return {"key": None}

    def per_batch(batch, state):
        out = []
        for key, ids in zip(zip(*(batch.column(n).to_pylist() for n in (0, 1))), batch.column(2).to_pylist()):
            if key == state["key"]:
                state["digest"].update(b"," + ids.encode())
            else:
                if state["key"]:
                    out.append((*state["key"], state["digest"].hexdigest()))
                state["key"], state["digest"] = key, hashlib.sha256(ids.encode())
        yield list(zip(*out)) if out else [[], [], []]

    def at_end(state):
        if state["key"]:
            yield [[v] for v in (*state["key"], state["digest"].hexdigest())]

    fed = map_arrow(in_order, per_batch, "k1 long, k2 long, ends_sha256 string", setup, at_end)
    alone = counted.join(many, KEY, "left_anti").select(*KEY, single.alias("ends_sha256"))
    return alone.unionAll(fed)


def trie(ids: DataFrame, placed: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. See :func:`paths` for the arguments."""
    if height < 2:
        raise ValueError("a band holds two depths at least")
    rows = written(paths(ids, placed), "paths")
    nodes = written(
        rows.groupBy(KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("n_convs"),
            *[F.max(f"p{k}").alias(f"p{k}") for k in KEY],
        ),
        "nodes",
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    children = (
        nodes.where("depth > 0")
        .groupBy(*[F.col(f"p{k}").alias(k) for k in KEY])
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    own = written(
        nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "own-values",
    )
    values = own.select(
        *KEY,
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = rolled_up(rows, nodes.select("conv_id", "depth", *KEY), values, ["n_leaves", "saved_tokens"], deepest, height)
    parents = nodes.select(*[F.col(k).alias(f"p{k}") for k in KEY], F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        own.join(totals, KEY)
        .join(ends_digests(rows), KEY, "left")
        .join(parents, [f"p{k}" for k in KEY], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The trie of conversations as they stand."""
    placed = written(turns(conversations), "turns")
    ids = placed.select("conv_id").distinct()
    return trie(ids, placed.withColumn("place", F.col("place").cast("long")), height)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    placed = written(turns(spark.read.parquet(f"{folder}/conversations.parquet")), "turns")
    return trie(*rebuilt(placed))


# crc32 is spelled out: the table of its 256 remainders, then one step per byte.
SQL = """
WITH RECURSIVE remainders AS (
  SELECT list(r ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                              lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
        FROM (SELECT unnest(range(256)) AS i))),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS head_id, size,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda h, b: xor(h >> 8, remainders.t[(xor(h, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT conv_id, count(*) AS size FROM t GROUP BY conv_id), remainders),
p AS (
  SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.head_id AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(o.size, 0)), t.role, t.text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h LEFT JOIN c o ON o.conv_id = c.head_id),
whole AS (
  SELECT c.conv_id, coalesce(list({'role': role, 'digest': sha256(text), 'bytes': strlen(text)} ORDER BY place)
                             FILTER (place IS NOT NULL), []) AS seq
  FROM c LEFT JOIN p ON p.conv_id = c.conv_id GROUP BY c.conv_id),
members AS (
  SELECT conv_id, depth, md5(list_slice(seq, 1, depth)::VARCHAR) || depth::VARCHAR AS node,
         CASE WHEN depth > 0 THEN md5(list_slice(seq, 1, depth - 1)::VARCHAR) || (depth - 1)::VARCHAR END AS up,
         CASE WHEN depth > 0 THEN seq[depth].bytes ELSE 0 END AS bytes, depth = len(seq) AS ends
  FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM whole)),
nodes AS (
  SELECT node, min(up) AS up, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, min(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node),
kids AS (SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT node AS top, node FROM nodes
  UNION ALL SELECT below.top, nodes.node FROM below JOIN nodes ON nodes.up = below.node),
totals AS (
  SELECT top, count(*) FILTER (kids.n IS NULL) AS n_leaves,
         sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM below JOIN nodes USING (node) LEFT JOIN kids USING (node) GROUP BY top)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
       totals.n_leaves, totals.saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes u ON u.node = n.up LEFT JOIN kids ON kids.node = n.node
JOIN totals ON totals.top = n.node
"""
