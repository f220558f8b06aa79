"""A forest of decision trees as a table of nodes: taken over, refitted, scored, weighed.

A row is one node: ``tree``, ``node`` (numbered from 0, the root, within its tree),
``feature`` (a place in the list of inputs; null for a leaf), ``threshold``, the children
``below`` (input <= threshold) and ``above``, and ``weights``, the weight of each class's
rows in the node. Everything else, shares, gains, importances and scores, follows from it.

The table of a model is small next to the tracks, but no constant: where rows walk the trees,
it goes to every task as one value, and :func:`walkable` refuses more than ``MOST_NODES``.
"""

from __future__ import annotations

import functools
import json
import sys
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart import schemas as S
from trackmart.functions import lookup, round_exact
from trackmart.session import scratch_path, staged

# What runs in tasks is shipped with them; executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_NODES = 500_000  # about 50 MB in every task
MOST_SPELLED_OUT = 200  # nodes: larger forests are walked, with the same results
# While fitting, a row takes 4 bytes a tree and about 130 more; every pass sends the trees so far.
TREES_A_FIT = 10
ROWS_A_TASK = 500_000
NODES = (
    "tree int, node int, feature int, threshold double, below int, above int, weights array<double>"
)
NODE = ["tree", "node"]
WALKED = ["node", "feature", "threshold", "below", "above", "shares"]
WALK_SCHEMA = "node: int, feature: int, threshold: double, below: int, above: int, shares: array<double>"


def nodes_of(model: PipelineModel, path: str) -> DataFrame:
    """The nodes of a fitted forest, read from where the last stage of ``model`` is written to."""
    model.stages[-1].write().overwrite().save(path)
    stored = SparkSession.active().read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    split = F.col("split")
    inner = F.col("leftChild") >= 0
    nodes = stored.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, split.featureIndex).alias("feature"),
        F.when(inner, F.get(split.leftCategoriesOrThreshold, F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("below"),
        F.when(inner, F.col("rightChild")).alias("above"),
        F.col("impurityStats").alias("weights"),
        split.numCategories.alias("categories"),
    )
    if not nodes.where("feature IS NOT NULL AND categories >= 0").isEmpty():
        raise ValueError("the forest splits by category; only thresholds are supported")
    return nodes.drop("categories")


def combined(parts: Sequence[str], path: str) -> RandomForestClassificationModel:
    """One forest of all trees of the forests stored at ``parts``, put together at ``path``."""
    spark = SparkSession.active()
    data, trees, before = [], [], 0
    for part in parts:
        facts = json.loads(spark.read.text(f"{part}/metadata").first()[0])
        for found, name in ((data, "data"), (trees, "treesMetadata")):
            rows = spark.read.parquet(f"{part}/{name}")
            tree = rows.columns[0]  # its number within the part
            found.append(rows.withColumn(tree, F.col(tree) + F.lit(before)))
        before += facts["numTrees"]
    for found, name in ((data, "data"), (trees, "treesMetadata")):
        functools.reduce(DataFrame.unionByName, found).write.parquet(f"{path}/{name}")
    facts["numTrees"] = facts["paramMap"]["numTrees"] = before
    text = spark.createDataFrame([(json.dumps(facts),)], "value string")
    text.coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)


def fit_in_parts(pipeline: Pipeline, rows: DataFrame, path: str, parts: int, key: str = "track_id") -> PipelineModel:
    """Fit a pipeline that ends in a forest on all ``rows``, its trees dealt to ``parts`` fits, or
    to more where a fit would have over ``TREES_A_FIT``.

    A deep tree over few rows has about as many nodes as rows, and a fit sends statistics of
    every node from every task, so that spreading few rows over all cores costs more than it
    saves. Trees are independent: each part grows its share of them, with a seed of its own,
    in as few tasks as hold the rows. As many parts run at the same time as have a core for
    every task; over many rows that is one after the other, each over all cores.
    """
    *stages, forest = pipeline.getStages()
    prepared = Pipeline(stages=stages).fit(rows)
    inputs = [c for c in (forest.getLabelCol(), forest.getFeaturesCol(), forest.getWeightCol()) if c]
    trees, cores = forest.getNumTrees(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(max(parts, -(-trees // TREES_A_FIT)), trees))
    tasks = max(1, cores // parts, -(-rows.count() // ROWS_A_TASK))
    # The same order at every run: bags are drawn row by row.
    dealt = prepared.transform(rows).select(key, *inputs).repartition(tasks, key)
    with staged(dealt.sortWithinPartitions(key, *inputs[::2]), "forest-inputs") as stored_rows:
        ready = stored_rows.coalesce(tasks)

        def grow(n: int) -> str:
            share = trees // parts + (n < trees % parts)
            grown = forest.copy({forest.numTrees: share, forest.seed: forest.getSeed() + n}).fit(ready)
            grown.write().save(f"{path}/part-{n}")
            return f"{path}/part-{n}"

        with ThreadPoolExecutor(max(1, min(parts, cores // tasks))) as pool:
            stored = list(pool.map(grow, range(parts)))
    return PipelineModel([*prepared.stages, combined(stored, f"{path}/forest")])


def model_scores(fitted: PipelineModel, rows: DataFrame) -> DataFrame:
    """What ``fitted.transform`` gives but for the raw votes: the same ``probability`` and
    ``prediction``, to the last bit.

    The library walks a row's trees node by node over objects spread through the heap. Here a
    batch of rows goes through one tree at a time, whose nodes are a few short arrays.
    """
    spark, forest = rows.sparkSession, fitted.stages[-1]
    ready = PipelineModel(fitted.stages[:-1]).transform(rows)
    inputs, chances, guess = forest.getFeaturesCol(), forest.getProbabilityCol(), forest.getPredictionCol()
    vectors = [f.name for f in ready.schema if f.dataType.typeName() == "vectorudt" and f.name != inputs]
    plain = ready.drop(*vectors).withColumn(inputs, vector_to_array(inputs))
    added = [T.StructField(chances, T.ArrayType(T.DoubleType())), T.StructField(guess, T.DoubleType())]
    place, classes = plain.columns.index(inputs), forest.numClasses
    sent = spark.sparkContext.broadcast(tree_arrays(nodes_of(fitted, scratch_path(spark, "scored-forest"))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = tree_votes(batch.column(place), sent.value, classes)
            total = functools.reduce(np.add, votes.T)[:, None]
            shares = np.divide(votes, total, out=np.zeros_like(votes), where=total != 0)
            ends = pa.array(np.arange(0, shares.size + 1, classes, dtype=np.int32))
            found = [pa.ListArray.from_arrays(ends, pa.array(shares.ravel())), pa.array(votes.argmax(1).astype(float))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, chances, guess])

    scored = plain.mapInArrow(score, T.StructType([*plain.schema, *added]))
    return scored.withColumns({c: array_to_vector(c) for c in (inputs, chances)})


def tree_arrays(nodes: DataFrame) -> list[tuple]:
    """Each tree as feature, threshold, children (above and below, node by node), class shares,
    and the steps to its deepest leaf. A leaf is its own child."""
    columns = ("tree", "node", "feature", "threshold", "below", "above")
    table = nodes.select(*columns, "weights").orderBy(*NODE).toArrow()
    inner = table["feature"].is_valid().to_numpy()
    tree, node, feature, threshold, below, above = (
        table[c].fill_null(0).to_numpy() for c in columns
    )
    weights = table["weights"].combine_chunks().flatten().to_numpy().reshape(len(tree), -1)
    total = functools.reduce(np.add, weights.T)[:, None]
    shares = np.divide(weights, total, out=np.zeros_like(weights), where=total > 0)
    links = (np.where(inner, side, node) for side in (above, below))
    children = np.stack(list(links), 1).astype(np.intp)
    _longest_path(tree, node, *(np.where(inner, side, -1) for side in (below, above)))
    trees = []
    starts = np.flatnonzero(np.diff(tree, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(tree)]):
        level, steps = np.zeros(1, np.intp), 0
        while len(level := level[inner[a:b][level]]):
            level, steps = children[a:b][level].ravel(), steps + 1
        trees.append((feature[a:b].astype(np.intp), threshold[a:b], children[a:b].ravel(), shares[a:b], steps))
    return trees


ROWS_AT_ONCE = 4096  # their inputs stay in a core's own cache


def tree_votes(inputs: pa.ListArray, trees: list[tuple], classes: int) -> np.ndarray:
    """Per row and class the sum over trees, in their order, of its leaves' shares. NaN is above
    every threshold."""
    votes = np.zeros((len(inputs), classes))
    values = inputs.flatten().to_numpy()
    width = len(values) // max(1, len(inputs))
    for a in range(0, len(inputs), ROWS_AT_ONCE):
        own = votes[a : a + ROWS_AT_ONCE]
        flat = values[a * width : (a + len(own)) * width]
        first = np.arange(len(own), dtype=np.intp) * width
        for feature, threshold, children, shares, steps in trees:
            at = np.zeros(len(own), np.intp)
            for _ in range(steps):
                is_below = flat.take(first + feature.take(at)) <= threshold.take(at)
                at = children.take(2 * at + is_below)
            own += shares.take(at, axis=0)
    return votes


def structure(spark: SparkSession, splits: Sequence[tuple], classes: int) -> DataFrame:
    """Nodes without rows from (tree, node, feature, threshold, below, above) of the inner
    nodes; children that split no further are leaves."""
    none = [0.0] * classes
    inner = [(*s, none) for s in splits]
    known = {(s[0], s[1]) for s in splits}
    children = {(s[0], child) for s in splits for child in s[4:6]}
    leaves = [(tree, node, None, None, None, None, none) for tree, node in sorted(children - known)]
    return spark.createDataFrame(inner + leaves, NODES)


def walkable(nodes: DataFrame) -> tuple[Column, int]:
    """All trees as one value, and how many steps reach every leaf.

    A node's place in its tree is its number, so numbers must run from 0 without a gap.
    """
    if (n := nodes.count()) > MOST_NODES:
        raise ValueError(f"{n} nodes; rows can walk {MOST_NODES} at most")
    total = total_weight(F.col("weights"))
    shares = F.transform("weights", lambda w: F.when(total > 0, w / total).otherwise(0.0))
    rows = nodes.select("tree", "node", "feature", "threshold", "below", "above", shares.alias("shares"))
    found = rows.orderBy(*NODE).collect()
    trees: dict[int, list[tuple]] = {}
    for tree, *node in found:
        trees.setdefault(tree, []).append(node)
    links = np.array([(r["tree"], r["node"], *(-1 if r[c] is None else r[c] for c in ("below", "above"))) for r in found])
    steps = _longest_path(*links.reshape(-1, 4).T)
    text = json.dumps([{"tree": t, "nodes": [dict(zip(WALKED, node)) for node in own]} for t, own in trees.items()])
    # A constant: it is parsed once, when the query is planned.
    return F.from_json(F.lit(text), f"array<struct<tree: int, nodes: array<struct<{WALK_SCHEMA}>>>>"), steps


def _longest_path(tree: np.ndarray, node: np.ndarray, below: np.ndarray, above: np.ndarray) -> int:
    """Steps from the roots to the deepest leaf; checks that the nodes make trees."""
    starts = np.flatnonzero(np.diff(tree, prepend=-1))
    first = np.repeat(starts, np.diff(np.append(starts, len(tree))))
    if (node != np.arange(len(node)) - first).any():
        raise ValueError("nodes of a tree must be numbered from 0 without gaps or repeats")
    level, steps, seen = starts, 0, len(starts)
    while len(level := level[below[level] >= 0]):
        level = np.concatenate([first[level] + below[level], first[level] + above[level]])
        steps, seen = steps + 1, seen + len(level)
        if seen > len(node):
            raise ValueError("a node has two parents")
    return steps


def _inputs(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def _next(node: Column, values: Column) -> Column:
    """The child a row goes to. NaN and null are above every threshold."""
    return F.when(F.get(values, node["feature"]) <= node["threshold"], node["below"]).otherwise(node["above"])


def _whole(nodes: DataFrame) -> list[dict[int, tuple]] | None:
    """The trees, node by number, where they are small enough to be one expression."""
    found = nodes.orderBy(*NODE).limit(MOST_SPELLED_OUT + 1).collect()
    if len(found) > MOST_SPELLED_OUT:
        return None
    trees: dict[int, dict[int, tuple]] = {}
    for r in found:
        trees.setdefault(r["tree"], {})[r["node"]] = r
    return list(trees.values())


def _spelled_out(tree: dict[int, tuple], columns: Sequence[str], ends: Callable[[list[tuple]], Column]) -> Column:
    """A tree as nested conditions, which compile to plain code; ``ends`` of the nodes on the
    way to the leaf. NaN and null are above every threshold."""

    def at(node: int, way: list[tuple]) -> Column:
        own = tree[node]
        way = [*way, own]
        if own["feature"] is None:
            return ends(way)
        is_below = F.col(columns[own["feature"]]).cast("double") <= F.lit(own["threshold"])
        return F.when(is_below, at(own["below"], way)).otherwise(at(own["above"], way))

    return at(0, [])


def leaf_shares(nodes: DataFrame, columns: Sequence[str], classes: int) -> Column:
    """Class shares of a row: the sum over trees of those of its leaf, divided by their total.
    Where all its leaves are empty every share is 0."""
    trees, steps = walkable(nodes)
    if (whole := _whole(nodes)) is not None:
        return _spelled_out_shares(whole, columns, classes)
    values = _inputs(columns)
    zero = F.array(*[F.lit(0.0)] * classes)

    def votes(inputs: Column) -> Column:
        def leaf(tree: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                node = F.get(tree["nodes"], at)
                return F.when(node["feature"].isNull(), at).otherwise(_next(node, inputs))

            at = F.aggregate(F.sequence(F.lit(1), F.lit(max(steps, 1))), F.lit(0), step)
            return F.get(tree["nodes"], at)["shares"]

        return F.aggregate(trees, zero, lambda sums, tree: F.zip_with(sums, leaf(tree), lambda a, b: a + b))

    def divided(added: Column) -> Column:
        total = F.aggregate(added, F.lit(0.0), lambda a, b: a + b)
        return F.transform(added, lambda s: F.when(total > 0, s / total).otherwise(0.0))

    # As variables of a lambda, inputs and votes are evaluated once a row.
    return _bound(_bound(values, votes), divided)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spelled_out_shares(trees: list[dict[int, tuple]], columns: Sequence[str], classes: int) -> Column:
    def shares(way: list[tuple]) -> Column:
        weights = way[-1]["weights"]
        total = functools.reduce(float.__add__, weights, 0.0)
        return F.array(*[F.lit(w / total if total > 0 else 0.0) for w in weights])

    leaves = [_spelled_out(tree, columns, shares) for tree in trees]
    added = [
        functools.reduce(Column.__add__, [F.get(leaf, F.lit(n)) for leaf in leaves], F.lit(0.0)) for n in range(classes)
    ]
    total = functools.reduce(Column.__add__, added, F.lit(0.0))
    return F.array(*[F.when(total > 0, a / total).otherwise(0.0) for a in added])


def visits(nodes: DataFrame, rows: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """How many rows of each label come by each node: tree, node, label, row_count.

    Counts combine map-side, so at most nodes times labels rows leave a task.
    """
    trees, steps = walkable(nodes)
    if (whole := _whole(nodes)) is not None:
        return _spelled_out_visits(whole, rows, columns, label)
    values = _inputs(columns)

    def path(tree: Column) -> Column:
        def step(so_far: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], F.element_at(so_far, -1))
            further = F.concat(so_far, F.array(_next(node, F.col("inputs"))))
            return F.when(node["feature"].isNull(), so_far).otherwise(further)

        return F.aggregate(F.sequence(F.lit(1), F.lit(max(steps, 1))), F.array(F.lit(0)), step)

    paths = F.transform(trees, lambda t: F.struct(t["tree"].alias("tree"), path(t).alias("path")))
    walked = rows.select(F.col(label).alias("label"), values.alias("inputs"))
    walked = walked.select("label", F.explode(paths).alias("walk"))
    spread = walked.select("walk.tree", F.explode("walk.path").alias("node"), "label")
    return spread.groupBy("tree", "node", "label").agg(F.count(F.lit(1)).alias("row_count"))


def _spelled_out_visits(
    trees: list[dict[int, tuple]], rows: DataFrame, columns: Sequence[str], label: str
) -> DataFrame:
    """Rows are counted by label and leaf; the few counts then spread over the way to the leaf."""
    leaf = [F.struct(F.lit(t[0]["tree"]).alias("tree"), _spelled_out(t, columns, lambda way: F.lit(way[-1]["node"])).alias("leaf")) for t in trees]
    ended = rows.select(F.col(label).alias("label"), F.inline(F.array(*leaf)))
    counted = ended.groupBy("tree", "leaf", "label").agg(F.count(F.lit(1)).alias("row_count"))

    def ways(tree: dict[int, tuple], node: int = 0, before: tuple = ()) -> Iterator[tuple]:
        own, way = tree[node], (*before, node)
        if own["feature"] is None:
            yield own["tree"], node, list(way)
        else:
            yield from ways(tree, own["below"], way)
            yield from ways(tree, own["above"], way)

    spark = rows.sparkSession
    every = spark.createDataFrame([w for t in trees for w in ways(t)], "tree int, leaf int, way array<int>")
    spread = counted.join(every, ["tree", "leaf"]).select("tree", F.explode("way").alias("node"), "label", "row_count")
    return spread.groupBy("tree", "node", "label").agg(F.sum("row_count").alias("row_count"))


def refit(
    nodes: DataFrame,
    rows: DataFrame,
    columns: Sequence[str],
    labels: Sequence[str],
    class_weights: dict[str, float],
    label: str = "popularity_tier",
) -> DataFrame:
    """The same splits with the class weights of ``rows``. Rows of other labels do not count;
    a node no row comes by has weight 0 in every class."""
    counted = visits(nodes, rows.where(F.col(label).isin(*labels)), columns, label)
    weight = [
        (F.coalesce(F.sum(F.when(F.col("label") == c, F.col("row_count"))), F.lit(0)) * F.lit(float(class_weights[c])))
        for c in labels
    ]
    fresh = counted.groupBy(*NODE).agg(F.array(*weight).alias("fresh"))
    none = F.array(*[F.lit(0.0)] * len(labels))
    return nodes.join(fresh, NODE, "left").select(
        *[c for c in nodes.columns if c != "weights"], F.coalesce("fresh", none).alias("weights")
    )


def total_weight(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)


def gini(weights: Column) -> Column:
    """Chance that two rows of a node differ in class; 0 for a node without rows."""
    total = total_weight(weights)
    squares = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w * w)
    return F.when(total > 0, 1 - squares / (total * total)).otherwise(0.0)


def gains(nodes: DataFrame) -> DataFrame:
    """Inner nodes with their ``weight`` and ``gain``, the fall in impurity their split brings."""

    def side(name: str) -> DataFrame:
        return nodes.select(
            "tree", F.col("node").alias(name),
            (gini(F.col("weights")) * total_weight(F.col("weights"))).alias(f"{name}_rest"),
        )

    inner = nodes.where("feature IS NOT NULL").withColumn("weight", total_weight(F.col("weights")))
    joined = inner.join(side("below"), ["tree", "below"]).join(side("above"), ["tree", "above"])
    rest = (F.col("below_rest") + F.col("above_rest")) / F.col("weight")
    gain = F.when(F.col("weight") > 0, gini(F.col("weights")) - rest).otherwise(0.0)
    return joined.select(*nodes.columns, "weight", gain.alias("gain"))


def importance(nodes: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Features by importance: gains times weights, as shares of each tree and then of all.

    Features no tree splits by have importance 0. Trees that gain nothing do not count.
    """
    per_tree = gains(nodes).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gained"))
    totals = per_tree.groupBy("tree").agg(F.sum("gained").alias("total")).where("total > 0")
    shares = per_tree.join(totals, "tree").withColumn("share", F.col("gained") / F.col("total"))
    summed = shares.groupBy("feature").agg((F.sum("share")).alias("share"))
    trees = totals.agg(F.count(F.lit(1)).alias("trees"))
    names = nodes.sparkSession.createDataFrame(list(enumerate(columns)), "feature int, name string")
    shared = F.col("share") / F.greatest(trees.scalar(), F.lit(1))
    found = names.join(summed, "feature", "left").select(
        F.col("name").alias("feature"),
        round_exact(F.coalesce(shared, F.lit(0.0)), digits).alias("importance"),
    )
    return found.orderBy(F.desc("importance"), "feature")


def predictions(
    nodes: DataFrame, rows: DataFrame, columns: Sequence[str], labels: Sequence[str], digits: int = 6
) -> DataFrame:
    """``rows`` with ``shares``, rounded, and ``prediction``, the first of the likeliest labels."""
    shares = F.transform(leaf_shares(nodes, columns, len(labels)), lambda s: round_exact(s, digits))
    scored = rows.withColumn("shares", shares)
    likeliest = F.array_position("shares", F.array_max("shares")) - 1
    return scored.withColumn("prediction", F.get(F.array(*map(F.lit, labels)), likeliest.cast("int")))


def tier_scores(nodes: DataFrame, requests: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """``requests`` with tier, confidence %, one share % per tier, and message.

    The inputs must be complete: see ``score_defaults`` and ``add_genre_code``.
    """
    scored = predictions(nodes, requests, columns, labels)

    def percent(share: Column) -> Column:
        return round_exact(share * 100, 1)

    tier = F.coalesce("prediction", F.lit(S.TIER_FALLBACK))
    return scored.select(
        *requests.columns,
        tier.alias("tier"),
        percent(F.array_max("shares")).alias("confidence"),
        *[percent(F.get("shares", F.lit(n))).alias(f"share_{t.lower()}") for n, t in enumerate(labels)],
        lookup(S.TIER_MESSAGES, tier, "").alias("message"),
    )
