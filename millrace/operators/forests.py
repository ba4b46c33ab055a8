"""Random forests for all groups of a table at once, as packed node arrays.

Growth is level by level and by histograms.  The rows are dealt to tasks by group and digest, so that a group of any size is
spread over many of them, and packed into blocks once.  Rows of a block with the same features pass through every tree
together: if there are many, only their bootstrap weights and weighted labels, summed up per tree, are kept, so that a level
costs by distinct feature rows.  A level is one job whatever the number of groups: every block meets
its group's trees, its rows walk to the open nodes, and what they add to the bins of each node's drawn features is summed up
by (group, node, feature, bin); the sums of a group then decide the best split of each of its open nodes.  Bootstrap weights
and drawn features are digests of row, tree and node: another partitioning or a repeated task gives the same forests.

A model is one row: for every node of all its trees the feature (-1 in a leaf), threshold, left and right child and value.
Scoring walks these arrays for a batch of rows at a time, in one scan of the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.network import _mix
from millrace.session import shared_dir

_NODE = "feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, tree array<int>, depth array<int>"
_NAMES = ["feature", "threshold", "left", "right", "value", "tree", "depth"]
#: Chances of 0, 1, 2, .. of a Poisson variable of mean 1, summed up: the bootstrap weights, looked up by 16 random bits.
_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])
_WEIGHT = np.searchsorted(_POISSON, (np.arange(1 << 16) + 0.5) / (1 << 16), side="right").astype(np.float64)
_BLOCK = "_g string, n long, x binary, y binary, draw binary, w binary, s binary, c binary, e binary"
_ROOM = 8  # merged rows may take as many times the room of the rows: they save the work of every level
_CELLS = 1 << 20  # cells between thresholds for which a forest keeps its predictions


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _group(key: str) -> Column:
    """The key as a text that is equal for equal keys, NULL too."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")).alias("_g")


def _bits(seed: int, *parts: np.ndarray) -> np.ndarray:
    out = np.uint64(seed)
    for p in parts:
        out = _mix((p.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ out)
    return out


def _drawn(seed: int, tree: np.ndarray, node: np.ndarray, n_features: int, take: int) -> np.ndarray:
    """(nodes, take): the features each node may split by."""
    order = _bits(seed, tree[:, None], node[:, None], np.arange(n_features)[None, :])
    return np.argsort(order, axis=1, kind="stable")[:, :take]


def _walk(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(rows, trees): the node each row ends at, from node ``at`` of each tree on."""
    at = np.broadcast_to(at, (len(x), len(at))).copy()
    rows = np.arange(len(x))[:, None]
    while True:
        f = feature[at]
        if (f < 0).all():
            return at
        low = x[rows, np.maximum(f, 0)] <= threshold[at]  # NaN goes right
        at = np.where(f < 0, at, np.where(low, left[at], right[at]))


def _weights(draw: np.ndarray, num_trees: int, seed: int) -> np.ndarray:
    """(rows, trees): how often each row is in each tree.  A drawn word serves four trees."""
    words = _bits(seed + 1, draw[:, None].view(np.uint64), np.arange(-(-num_trees // 4))[None, :])
    return _WEIGHT[words.view(np.uint16)[:, :num_trees]]


def _merged(x: np.ndarray, y: np.ndarray, draw: np.ndarray, num_trees: int, seed: int) -> list[np.ndarray] | None:
    """Distinct rows of x, their mean labels, sums of weights and of weighted labels per tree, counts and squared deviations;
    None if they are more than half the rows or take more than ``_ROOM`` times their room."""
    if not len(x) or not x.shape[1]:
        return None
    _, first, cell = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1])))[:, 0], return_index=True, return_inverse=True)
    n = len(first)
    if 2 * n > len(x) or n * (2 * num_trees + x.shape[1] + 3) > _ROOM * len(x) * (x.shape[1] + 2):
        return None
    order = np.argsort(cell, kind="stable")
    cell, y, draw = cell[order], y[order], draw[order]
    count = np.bincount(cell, minlength=n).astype(float)
    mean = np.bincount(cell, y, n) / count
    apart = np.bincount(cell, (y - mean[cell]) ** 2, n)
    w, s = np.zeros((n, num_trees)), np.zeros((n, num_trees))
    for a in range(0, len(y), 4096):
        part, here = cell[a : a + 4096], _weights(draw[a : a + 4096], num_trees, seed)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        w[part[starts]] += np.add.reduceat(here, starts, axis=0)
        here *= y[a : a + 4096, None]
        s[part[starts]] += np.add.reduceat(here, starts, axis=0)
    return [x[first], mean, w, s, count, apart]


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int, num_trees: int, seed: int, look: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, (_g, _draw, _y, features ..), to blocks of one group.

    ``look`` rows of a group are looked at together; if merging them by equal features makes them few enough, a block has (x, y, w, s, c, e) of
    ``_merged``, otherwise (x, y, draw) of its rows."""
    group, held, size = None, [], 0
    names = ["x", "y", "draw", "w", "s", "c", "e"]

    def block() -> Iterator[pa.RecordBatch]:
        cols = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(1, held[0].num_columns)]
        x = np.column_stack(cols[2:]).astype(float) if len(cols) > 2 else np.zeros((len(cols[0]), 0))
        y, draw = cols[1].astype(float), cols[0]
        made = _merged(x, y, draw, num_trees, seed)
        parts = dict(zip(("x", "y", "w", "s", "c", "e"), made)) if made else {"x": x, "y": y, "draw": draw}
        step = max(1, block_rows // num_trees) if made else block_rows
        for a in range(0, len(parts["y"]), step):
            some = {k: v[a : a + step] for k, v in parts.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([group]), pa.array([len(some["y"])], pa.int64()), *[pa.array([some[k].tobytes() if k in some else None], pa.binary()) for k in names]],
                names=["_g", "n", *names],
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_pylist()
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and (keys[a] != group or size >= look):
                yield from block()
                held, size = [], 0
            group = keys[a]
            held.append(batch.slice(a, b - a))
            size += b - a
    if held:
        yield from block()


def _arrays(batch: pa.RecordBatch, row: int) -> list[np.ndarray]:
    return [np.asarray(batch.column(n)[row].values) for n in _NAMES]


def _histograms(batches: Iterator[pa.RecordBatch], level: int, n_features: int, take: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Blocks with their group's trees to (_g, node, slot, bin, w, s): weights and weighted labels of open nodes."""
    group, cells = None, None

    def found() -> pa.RecordBatch:
        w, s, open_nodes, bins = cells
        at = np.flatnonzero(w)
        node, slot, bin_ = np.unravel_index(at, (len(open_nodes), take, bins))
        cols = [pa.array([group] * len(at), pa.string()), *[pa.array(c.astype(np.int32)) for c in (open_nodes[node], slot, bin_)], pa.array(w[at]), pa.array(s[at])]
        return pa.RecordBatch.from_arrays(cols, names=["_g", "node", "slot", "bin", "w", "s"])

    for batch in batches:
        for i in range(batch.num_rows):
            feature, threshold, left, right, _, tree, depth = _arrays(batch, i)
            edges = [np.asarray(e.values) for e in batch.column("edges")[i].values]
            if (own := batch.column("_g")[i].as_py()) != group:
                if cells is not None:
                    yield found()
                bins = max(len(e) for e in edges) + 1
                open_nodes = np.flatnonzero((depth == level) & (feature < 0))
                group, cells = own, (np.zeros(len(open_nodes) * take * bins), np.zeros(len(open_nodes) * take * bins), open_nodes, bins)
            w, s, open_nodes, bins = cells
            if not len(open_nodes):
                continue
            held = {c: np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("x", float), ("y", float), ("draw", np.int64), ("w", float), ("s", float)) if batch.column(c)[i].is_valid}
            x, roots = held["x"].reshape(-1, n_features), np.flatnonzero(depth == 0)
            place = np.full(len(feature), -1)
            place[open_nodes] = np.arange(len(open_nodes))
            drawn = _drawn(seed, tree[open_nodes], open_nodes, n_features, take)
            binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
            for a in range(0, len(x), 4096):
                rows = slice(a, a + 4096)
                here = place[_walk(x[rows], feature, threshold, left, right, roots)].ravel()
                if "w" in held:
                    weight, labelled = (held[c].reshape(-1, len(roots))[rows].ravel() for c in ("w", "s"))
                else:
                    weight = _weights(held["draw"][rows], len(roots), seed)
                    weight, labelled = weight.ravel(), (weight * held["y"][rows, None]).ravel()
                used = np.flatnonzero((here >= 0) & (weight > 0))
                node, row, weight, labelled = here[used], used // len(roots), weight[used], labelled[used]
                for slot in range(take):
                    cell = (node * take + slot) * bins + binned[rows][row, drawn[node, slot]]
                    w += np.bincount(cell, weight, len(w))
                    s += np.bincount(cell, labelled, len(s))
    if cells is not None:
        yield found()


def _split(model: pa.Table, sums: pa.Table, n_features: int, take: int, seed: int, least: float) -> pa.Table:
    """One group's trees and the sums of its open nodes to its trees with one level more."""
    if not sums.num_rows:
        return model
    feature, threshold, left, right, value, tree, depth = (np.asarray(model.column(n)[0].values) for n in _NAMES)
    edges = [np.asarray(e.values) for e in model.column("edges")[0].values]
    node, slot, bin_, w, s = (sums.column(n).to_numpy() for n in ("node", "slot", "bin", "w", "s"))
    open_nodes, place = np.unique(node, return_inverse=True)
    bins = max(len(e) for e in edges) + 1
    weight, total = np.zeros((len(open_nodes), take, bins)), np.zeros((len(open_nodes), take, bins))
    weight[place, slot, bin_], total[place, slot, bin_] = w, s
    low_w, low_s = weight.cumsum(axis=2), total.cumsum(axis=2)
    all_w, all_s = low_w[:, :1, -1:], low_s[:, :1, -1:]
    high_w, high_s = all_w - low_w, all_s - low_s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = low_s**2 / low_w + high_s**2 / high_w - all_s**2 / all_w
    gain[(low_w < least) | (high_w < least)] = -np.inf
    best = gain.reshape(len(open_nodes), -1).argmax(axis=1)
    best_slot, best_bin = np.divmod(best, bins)
    each = np.arange(len(open_nodes))
    scale = np.maximum(1e-12, all_s[:, 0, 0] ** 2 / all_w[:, 0, 0])
    yes = gain[each, best_slot, best_bin] > 1e-9 * scale
    split_by = _drawn(seed, tree[open_nodes], open_nodes, n_features, take)[each, best_slot]
    yes &= best_bin < np.array([len(e) for e in edges])[split_by]
    value = value.copy()
    value[open_nodes] = all_s[:, 0, 0] / all_w[:, 0, 0]
    at, f, b, sl = open_nodes[yes], split_by[yes], best_bin[yes], best_slot[yes]
    first = len(feature) + 2 * np.arange(len(at))
    feature, threshold, left, right = feature.copy(), threshold.copy(), left.copy(), right.copy()
    feature[at], left[at], right[at] = f, first, first + 1
    threshold[at] = [edges[i][j] for i, j in zip(f.tolist(), b.tolist())]
    inner = each[yes]
    means = np.column_stack([low_s[inner, sl, b] / low_w[inner, sl, b], high_s[inner, sl, b] / high_w[inner, sl, b]]).ravel()
    many = 2 * len(at)
    grown = {
        "feature": np.r_[feature, np.full(many, -1)].astype(np.int32), "threshold": np.r_[threshold, np.zeros(many)],
        "left": np.r_[left, np.full(many, -1)].astype(np.int32), "right": np.r_[right, np.full(many, -1)].astype(np.int32),
        "value": np.r_[value, means], "tree": np.r_[tree, np.repeat(tree[at], 2)].astype(np.int32), "depth": np.r_[depth, np.repeat(depth[at] + 1, 2)].astype(np.int32),
    }
    out = {n: model.column(n) for n in model.column_names} | {n: pa.array([v.tolist()], model.schema.field(n).type) for n, v in grown.items()}
    return pa.table(out)


def _errors(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[pa.RecordBatch]:
    """Blocks with their group's trees to (_g, n, squared error)."""
    for batch in batches:
        got = []
        for i in range(batch.num_rows):
            feature, threshold, left, right, value, _, depth = _arrays(batch, i)
            x = np.frombuffer(batch.column("x")[i].as_buffer(), float).reshape(-1, n_features)
            y = np.frombuffer(batch.column("y")[i].as_buffer(), float)
            made = _predicted(x, (feature, threshold, left, right, value, None, depth))
            count, error = len(x), (made - y) ** 2
            if batch.column("c")[i].is_valid:  # distinct rows with their mean labels
                many, apart = (np.frombuffer(batch.column(c)[i].as_buffer(), float) for c in ("c", "e"))
                count, error = int(many.sum()), many * error + apart
            got.append((batch.column("_g")[i].as_py(), count, float(error.sum())))
        cols = list(zip(*got)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.float64()))], names=["_g", "n", "error"])


def fit_group_forests(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    path: str,
    num_trees: int = 100,
    max_depth: int = 5,
    max_bins: int = 32,
    feature_fraction: float | None = None,
    min_instances: int = 1,
    seed: int = 42,
    block_rows: int = 1 << 14,
) -> DataFrame:
    """``(key, n_used, model_path, mse)``: a regression forest for every group, stored below ``path``.

    As many jobs for ten groups as for ten thousand: one to pack the rows, one per level, one for the errors.  Rows with a
    NULL feature or label are left out; NULL is a group.  A tree
    that drew no row of its group says the group's mean.  Thresholds are up to ``max_bins`` - 1 quantiles per group and
    feature.  A node may split by ``feature_fraction`` of the features, a third if not given.
    """
    spark, features = df.sparkSession, list(features)
    n, take = len(features), max(1, int(np.ceil((feature_fraction or (1 / 3 if num_trees > 1 else 1)) * len(features))))
    complete = df.dropna(subset=[*features, label])
    own = [F.col(c) for c, t in df.dtypes if "map" not in t]
    xs = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    slim = complete.select(_group(key), F.xxhash64(*own).alias("_draw"), F.col(label).cast("double").alias("_y"), *xs)
    blocks = slim.repartitionByRange("_g", "_draw").sortWithinPartitions("_g").mapInArrow(lambda b: _blocks(b, block_rows, num_trees, seed), _BLOCK)
    blocks = _stored(blocks, f"{path}/blocks")
    cuts = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    edges = [F.array_sort(F.array_distinct(F.percentile_approx(F.col(c).cast("double"), cuts, F.lit(10_000)))) for c in features]
    start = complete.groupBy(_group(key)).agg(F.first(key).alias(key), F.array(*edges).alias("edges"), F.avg(label).alias("mean"))
    none = lambda v: F.array_repeat(F.lit(v), num_trees)
    models = start.select(
        "_g", key, "edges", none(-1).alias("feature"), none(0.0).alias("threshold"), none(-1).alias("left"), none(-1).alias("right"),
        F.array_repeat("mean", num_trees).alias("value"), F.sequence(F.lit(0), F.lit(num_trees - 1)).alias("tree"), none(0).alias("depth"),
    )
    models = _stored(models, f"{path}/level-0")
    schema = f"_g string, `{key}` {df.schema[key].dataType.simpleString()}, edges array<array<double>>, {_NODE}"
    for level in range(max_depth):
        met = blocks.join(models.drop(key), "_g")
        partial = met.mapInArrow(lambda b, level=level: _histograms(b, level, n, take, seed), "_g string, node int, slot int, bin int, w double, s double")
        sums = partial.groupBy("_g", "node", "slot", "bin").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        grown = models.groupBy("_g").cogroup(sums.groupBy("_g")).applyInArrow(lambda m, s: _split(m, s, n, take, seed, float(min_instances)), schema)
        models = _stored(grown, f"{path}/level-{level + 1}")
    errors = blocks.join(models.drop(key), "_g").mapInArrow(lambda b: _errors(b, n), "_g string, n long, error double")
    errors = errors.groupBy("_g").agg(F.sum("n").alias("n_used"), (F.sum("error") / F.sum("n")).alias("mse"))
    named = F.array(*[F.lit(f) for f in features]).alias("features")
    _stored(models.join(errors, "_g").select("_g", key, "n_used", "mse", named, *_NAMES), f"{path}/models")
    return spark.read.parquet(f"{path}/models").select(key, "n_used", F.lit(f"{path}/models").alias("model_path"), "mse")


def pack_forest(model: PipelineModel | object, key: str, group, features: Sequence[str]) -> pd.DataFrame:
    """A Spark ML regression forest as one packed row, for the group ``group``.  Its size is that of the model."""
    forest = model.stages[-1] if isinstance(model, PipelineModel) else model
    cols: dict[str, list] = {n: [] for n in _NAMES}

    def add(node, tree: int, depth: int) -> int:
        at = len(cols["feature"])
        for name, v in zip(_NAMES, (-1, 0.0, -1, -1, float(node.prediction()), tree, depth)):
            cols[name].append(v)
        if node.subtreeDepth() > 0:
            split = node.split()
            cols["feature"][at], cols["threshold"][at] = split.featureIndex(), split.threshold()
            cols["left"][at] = add(node.leftChild(), tree, depth + 1)
            cols["right"][at] = add(node.rightChild(), tree, depth + 1)
        return at

    for t, tree in enumerate(forest.trees):
        add(tree._call_java("rootNode"), t, 0)
    return pd.DataFrame({key: [group], "features": [list(features)], **{n: [v] for n, v in cols.items()}})


def _predicted(x: np.ndarray, arrays: Sequence[np.ndarray]) -> np.ndarray:
    feature, threshold, left, right, value, _, depth = arrays
    roots = np.flatnonzero(depth == 0)
    parts = [value[_walk(x[a : a + 4096], feature, threshold, left, right, roots)].mean(axis=1) for a in range(0, len(x), 4096)]
    return np.concatenate(parts) if parts else np.zeros(0)


class _Scorer:
    """A packed forest that remembers what it predicts between its thresholds.

    Rows between the same thresholds of every feature end in the same leaves, so each such cell is walked once, if there are
    at most ``_CELLS`` of them."""

    def __init__(self, arrays: Sequence[np.ndarray], n_features: int):
        self.arrays = arrays
        self.edges = [np.unique(arrays[1][arrays[0] == j]) for j in range(n_features)]
        self.shape = tuple(len(e) + 1 for e in self.edges)
        self.made = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if np.prod([float(n) for n in self.shape]) > _CELLS:
            return _predicted(x, self.arrays)
        if self.made is None:
            self.made = np.full(int(np.prod(self.shape)), np.nan)
        cell = np.zeros(len(x), np.int64)
        for e, c in zip(self.edges, x.T):
            cell = cell * (len(e) + 1) + np.searchsorted(e, c, side="left")  # NaN comes last: it goes right
        new, first = np.unique(cell[np.isnan(self.made[cell])], return_index=True)
        if len(new):
            self.made[new] = _predicted(x[np.flatnonzero(np.isnan(self.made[cell]))[first]], self.arrays)
        return self.made[cell]


def predict_group_forests(df: DataFrame, models: DataFrame, key: str, out: str = "prediction", max_bytes: int = 64 << 20, salts: int = 64) -> DataFrame:
    """Every row scored by its own group's forest; NULL for a group without one.  NULL features go right at every split.

    ``models`` has a packed forest per group, or the ``model_path`` of such a table.  If the stored models are proven to take at
    most ``max_bytes`` they are sent to the tasks and no row moves.  Otherwise rows and models are dealt by group and one of
    ``salts`` digests, and each task holds one model at a time.  Either way the table is scanned once.
    """
    spark = df.sparkSession
    if "model_path" in models.columns:
        paths = [r[0] for r in models.select("model_path").distinct().limit(2).collect()]
        if len(paths) > 1:
            raise ValueError("the models are in more than one table")
        models = spark.read.parquet(paths[0]).join(models.select(_group(key)), "_g", "left_semi") if paths else None
    if models is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    stored = _stored(models.select(_group(key), "features", *_NAMES), shared_dir(spark, "packed-forests"))
    first = stored.select("features").first()
    if first is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    features = list(first[0])
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= max_bytes // 4:  # compressed on disk
        table = stored.toArrow()
        packed = {g: _Scorer([np.array(table.column(n)[i].values) for n in _NAMES], len(features)) for i, g in enumerate(table.column("_g").to_pylist())}
        shared = spark.sparkContext.broadcast(packed)

        @F.pandas_udf("double")
        def score(group: pd.Series, *cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in cols])
            made = pd.array(np.full(len(group), np.nan), dtype="Float64")
            made[:] = pd.NA
            codes, groups = pd.factorize(group)
            for n, g in enumerate(groups):
                if g in shared.value:
                    made[codes == n] = shared.value[g].predict(x[codes == n])
            return pd.Series(made)

        return df.withColumn(out, score(_group(key), *[F.col(f).cast("double") for f in features]))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    digest = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map" not in t]), F.lit(salts)).alias("_salt")
    rows = df.select(_group(key), digest, F.lit(True).alias("_is_row"), F.array(*[F.col(f).cast("double") for f in features]).alias("_x"), row)
    sent = stored.select("_g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_salt"), F.lit(False).alias("_is_row"), *_NAMES)
    dealt = rows.unionByName(sent, allowMissingColumns=True).repartition("_g", "_salt").sortWithinPartitions("_g", "_salt", "_is_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, model = None, None
        for batch in batches:
            made = np.full(batch.num_rows, np.nan)
            known = np.zeros(batch.num_rows, bool)
            is_row = batch.column("_is_row").to_numpy(zero_copy_only=False)
            keys = batch.column("_g").to_pylist()
            for i in np.flatnonzero(~is_row).tolist():
                keys[i] = f"model {i}"  # a run of its own
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if not is_row[a]:
                    group, model = batch.column("_g")[a].as_py(), _Scorer(_arrays(batch, a), len(features))
                elif keys[a] == group:
                    x = np.array(batch.column("_x").slice(a, b - a).to_pylist(), float)
                    made[a:b], known[a:b] = model.predict(x), True
            kept = pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(made, mask=~known)], names=["_row", "_made"])
            yield kept.filter(pa.array(is_row))

    schema = f"_row {df.schema.simpleString()}, _made double"
    return dealt.mapInArrow(run, schema).select("_row.*", F.col("_made").alias(out))
