"""Hard negatives from a multiway hyperplane tree over vectors, exact.

Vectors get one more component that gives all of them the same length, so a larger inner product with an anchor is a
smaller distance from it, and a window of scores is an annulus around the anchor. Every node of the tree has split points;
a vector belongs to the nearest one. For each split point the node keeps the least and largest distance to the vectors
below each of its siblings: where these distances and the anchor's own rule the annulus out, the sibling is passed over
with all below it. Split points come from a bounded sample; distance ranges and leaves cover all vectors, so nothing is
missed. Leaves are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stored

EVERY = 100
POSITIVES = 5
NEGATIVES = 10
# A negative's score in hundredths of the positive's.
WINDOW = (30, 90)
SCALE = 256
# Vectors the tree's split points are chosen from and first bounds are taken on, whatever the table's size.
SAMPLE = 4096
# Split points of a node; a node of fewer than LEAF sample vectors is a leaf.
SPLITS = 16
LEAF = 64
# Vectors and anchors of a leaf that one group holds, and anchors compared at once.
BLOCK = 2048
PIECE = 8192
ANCHORS = 256
# Inner products of vectors up to this squared length are exact in doubles.
LONGEST = float(1 << 53)
# Slack for rounding of distances, relative to the common length.
SLACK = 1e-9
NO_SCORE = -(1 << 62)


def usable(vectors: DataFrame, relabel_every: int | None = 7, labels: int = 10) -> DataFrame:
    """Rows (vec_id, label, vector, dim, square) that take part; see `hard_negatives`."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    plain = plain.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(finite)
    if relabel_every is not None:
        plain = plain.withColumn("label", F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
    whole = F.transform("vector", lambda x: F.floor(SCALE * x).cast("double"))
    large = F.exists("vector", lambda x: F.abs(x) >= LONGEST / SCALE)
    plain = plain.where(~large).withColumn("vector", whole)
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    plain = plain.withColumn("square", square).withColumn("dim", F.size("vector")).where(F.col("square") < LONGEST)
    return plain.dropDuplicates(["vec_id", "label", "vector"])


def _thin(rows: DataFrame) -> DataFrame:
    """Rows without those equal in vector and label to as many rows of smaller ids as any list could take from them."""
    # An anchor's own row may be among them.
    most = max(POSITIVES, NEGATIVES) + 1
    place = F.row_number().over(Window.partitionBy("dim", "label", "vector").orderBy("vec_id"))
    return rows.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), d)


def raised(vectors: np.ndarray, length: float) -> np.ndarray:
    """The vectors with a last component that brings their squared length to `length`."""
    rest = np.maximum(0.0, length - np.einsum("ij,ij->i", vectors, vectors))
    return np.hstack([vectors, np.sqrt(rest)[:, None]])


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", others, others)[None, :]
    return np.sqrt(np.maximum(0.0, squares - 2 * points @ others.T))


class Tree:
    """Split points by node; node 0 is the root. A child is another node (positive) or a leaf (negative, from -1 on)."""

    def __init__(self, sample: np.ndarray):
        self.points: list[np.ndarray] = []
        self.children: list[np.ndarray] = []
        self.leaves = 0
        # Per node, split point and sibling: the range of distances, set by `set_ranges`.
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        waiting = [(sample, None, 0)]
        while waiting:
            rows, parent, place = waiting.pop()
            points = self._choose(rows) if len(rows) > LEAF or parent is None else rows[:0]
            if len(points) < 2 and parent is not None:
                self.leaves += 1
                self.children[parent][place] = -self.leaves
                continue
            node = len(self.points)
            if parent is not None:
                self.children[parent][place] = node
            self.points.append(points)
            self.children.append(np.zeros(len(points), dtype=np.int64))
            nearest = distances(rows, points).argmin(axis=1)
            waiting.extend((rows[nearest == i], node, i) for i in range(len(points)))

    @staticmethod
    def _choose(rows: np.ndarray) -> np.ndarray:
        """Up to SPLITS different rows, each the farthest from those before it."""
        chosen, gap = [0], distances(rows, rows[:1])[:, 0]
        # Equal rows may seem apart by rounding.
        least = 1e-6 * np.linalg.norm(rows[0])
        while len(chosen) < SPLITS and gap.max() > least:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(rows, rows[chosen[-1:]])[:, 0])
        return rows[chosen]

    def route(self, rows: np.ndarray):
        """Per row its leaf; and (node, ranges) of the distances seen on the way."""
        leaf, seen = np.zeros(len(rows), dtype=np.int64), []
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, of = waiting.pop()
            gaps = distances(rows[of], self.points[node])
            nearest = gaps.argmin(axis=1)
            for child in np.unique(nearest).tolist():
                below, next_node = nearest == child, int(self.children[node][child])
                seen.append((node, child, gaps[below].min(axis=0), gaps[below].max(axis=0)))
                if next_node < 0:
                    leaf[of[below]] = -next_node
                else:
                    waiting.append((next_node, of[below]))
        return leaf, seen

    def set_ranges(self, ranges: list) -> None:
        self.low = [np.full((len(p), len(p)), np.inf) for p in self.points]
        self.high = [np.full((len(p), len(p)), -np.inf) for p in self.points]
        for node, child, low, high in ranges:
            self.low[node][:, child], self.high[node][:, child] = low, high

    def search(self, anchors: np.ndarray, near: np.ndarray, far: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, leaf) whose leaf may hold vectors between `near` and `far` from the anchor."""
        found = []
        waiting = [(0, np.arange(len(anchors)))]
        while waiting:
            node, of = waiting.pop()
            gaps = distances(anchors[of], self.points[node])[:, :, None]
            low, high = self.low[node][None], self.high[node][None]
            # What the triangles over each split point leave for the distances to a sibling's vectors.
            least = np.maximum(gaps - high, low - gaps).max(axis=1)
            most = (gaps + high).min(axis=1)
            alive = (least <= (far + slack)[of, None]) & (most >= (near - slack)[of, None])
            for child, next_node in enumerate(self.children[node].tolist()):
                rows = of[alive[:, child]]
                if not len(rows):
                    continue
                if next_node < 0:
                    found.append((rows, np.full(len(rows), -next_node)))
                else:
                    waiting.append((next_node, rows))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))


class Index:
    """Per dimension (a few): the common squared length, the sample (vectors, labels, ids) and the tree over it."""

    def __init__(self, rows: DataFrame):
        self.length, self.sample, self.tree = {}, {}, {}
        sizes = rows.groupBy("dim").agg(F.max("square"), F.count(F.lit(1))).collect()
        # A share of the hashes that holds about SAMPLE rows.
        share = F.lit(0.0)
        for d, _, n in sizes:
            share = F.when(F.col("dim") == d, min(1.0, SAMPLE / n)).otherwise(share)
        hashed = F.xxhash64("vec_id", "label", "vector")
        chosen = rows.where(F.pmod(hashed, F.lit(1 << 30)) < share * (1 << 30)).select("vec_id", "label", "vector", "dim", hashed.alias("hash"))
        chosen = chosen.toArrow().sort_by([("hash", "ascending"), ("vec_id", "ascending")])
        for d, longest, _ in sizes:
            of = chosen.filter(pc.equal(chosen["dim"], d))
            self.length[d] = longest
            self.sample[d] = (_matrix(of["vector"], d), of["label"].to_numpy(), of["vec_id"].to_numpy())
            self.tree[d] = Tree(raised(self.sample[d][0], longest))

    def slack(self, d: int) -> float:
        return SLACK * max(1.0, np.sqrt(self.length[d])) + np.sqrt(self.length[d]) * 1e-7


def _by_dim(batch):
    dims = batch["dim"].to_numpy()
    for d in np.unique(dims).tolist():
        yield d, batch.filter(pa.array(dims == d))


def _indexed(rows: DataFrame, index) -> DataFrame:
    """The rows with their leaf and a block within it, in rows of one kind; ranges in rows of another."""
    schema = "vec_id long, label long, vector array<double>, dim int, leaf int, node int, child int, low array<double>, high array<double>"
    names = [f.split()[0] for f in schema.split(", ")]

    def of(batches):
        ranges = {}
        for batch in batches:
            for d, part in _by_dim(batch):
                leaf, seen = index.tree[d].route(raised(_matrix(part["vector"], d), index.length[d]))
                for node, child, low, high in seen:
                    at = ranges.setdefault((d, node, child), [low, high])
                    at[0], at[1] = np.minimum(at[0], low), np.maximum(at[1], high)
                none = [pa.nulls(len(leaf), t) for t in (pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([part["vec_id"], part["label"], part["vector"], part["dim"], pa.array(leaf, pa.int32()), *none], names=names)
        if ranges:
            keys = list(ranges)
            nothing = pa.nulls(len(keys), pa.int64())
            yield pa.RecordBatch.from_arrays([
                nothing, nothing, pa.nulls(len(keys), pa.list_(pa.float64())), pa.array([k[0] for k in keys], pa.int32()), pa.nulls(len(keys), pa.int32()),
                pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()),
                pa.array([ranges[k][0].tolist() for k in keys], pa.list_(pa.float64())), pa.array([ranges[k][1].tolist() for k in keys], pa.list_(pa.float64())),
            ], names=names)

    return rows.select("vec_id", "label", "vector", "dim").mapInArrow(of, schema)


def _set_ranges(indexed: DataFrame, index: Index) -> None:
    """Give the trees their distance ranges; their number is bounded by the sample."""
    seen = indexed.where("node IS NOT NULL").select("dim", "node", "child", F.posexplode(F.arrays_zip("low", "high")).alias("at", "range"))
    merged = seen.groupBy("dim", "node", "child", "at").agg(F.min("range.low").alias("low"), F.max("range.high").alias("high"))
    merged = merged.groupBy("dim", "node", "child").agg(F.array_sort(F.collect_list(F.struct("at", "low", "high"))).alias("of"))
    by_dim: dict[int, list] = {d: [] for d in index.tree}
    for d, node, child, low, high in merged.select("dim", "node", "child", "of.low", "of.high").collect():
        by_dim[d].append((node, child, np.array(low), np.array(high)))
    for d, ranges in by_dim.items():
        index.tree[d].set_ranges(ranges)


# Per anchor and window: the positive's id (null while positives are searched), its score, the least and largest score taken.
ANCHOR = "vec_id long, label long, vector array<double>, dim int, windows array<struct<positive_id: long, positive_score: long, least: long, most: long>>"


def _kth(scores: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
    """Per row the k-th largest score among those that fit, NO_SCORE where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), NO_SCORE, dtype=np.int64)
    held = np.where(fits, scores, -np.inf)
    return np.nan_to_num(np.partition(held, -k, axis=1)[:, -k], neginf=NO_SCORE).astype(np.int64)


def _narrowed(anchors: DataFrame, index, positives: bool) -> DataFrame:
    """Anchors whose windows' least scores are raised to what the sample already offers enough rows for."""

    def of(batches):
        for batch in batches:
            for d, part in _by_dim(batch):
                for at in range(0, len(part), ANCHORS):
                    rows = part.slice(at, ANCHORS)
                    vectors, labels, ids = index.sample[d]
                    scores = _matrix(rows["vector"], d) @ vectors.T
                    same = rows["label"].to_numpy()[:, None] == labels[None, :]
                    windows = rows["windows"].to_pylist()
                    if positives:
                        best = _kth(scores, same & (rows["vec_id"].to_numpy()[:, None] != ids[None, :]), POSITIVES)
                        for own, least in zip(windows, best.tolist()):
                            own[0]["least"] = max(own[0]["least"], least)
                    else:
                        for i, own in enumerate(windows):
                            for w in own:
                                fits = ~same[i] & (scores[i] >= w["least"]) & (scores[i] <= w["most"])
                                w["least"] = max(w["least"], int(_kth(scores[i : i + 1], fits[None, :], NEGATIVES)[0]))
                    yield pa.RecordBatch.from_arrays([rows["vec_id"], rows["label"], rows["vector"], rows["dim"], pa.array(windows, rows.schema.field("windows").type)], names=rows.schema.names)

    return anchors.mapInArrow(of, ANCHOR)


def _routed(anchors: DataFrame, index) -> DataFrame:
    """A row per anchor and leaf that any of its windows may reach."""

    def of(batches):
        for batch in batches:
            for d, part in _by_dim(batch):
                for at in range(0, len(part), ANCHORS):
                    rows = part.slice(at, ANCHORS)
                    length = index.length[d]
                    vectors = _matrix(rows["vector"], d)
                    own = np.einsum("ij,ij->i", vectors, vectors)
                    windows = rows["windows"].to_pylist()
                    most = np.array([max((w["most"] for w in x), default=NO_SCORE) for x in windows], dtype=np.float64)
                    least = np.array([min((w["least"] for w in x), default=-NO_SCORE) for x in windows], dtype=np.float64)
                    # The union of an anchor's windows; a score s is the squared distance own + length - 2 s.
                    near, far = (np.sqrt(np.maximum(0.0, own + length - 2 * s)) for s in (most, least))
                    points = np.hstack([vectors, np.zeros((len(vectors), 1))])
                    who, leaf = index.tree[d].search(points, near, far, index.slack(d) + np.sqrt(own) * 1e-7)
                    taken = rows.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaf, pa.int32())], names=[*taken.schema.names, "leaf"])

    return anchors.mapInArrow(of, ANCHOR + ", leaf int")


def _searched(members: DataFrame, sizes: DataFrame, anchors: DataFrame, index, positives: bool) -> DataFrame:
    """Per anchor and window its best rows: (anchor_id, positive_id, positive_score, other_id, score, rank).

    A leaf's rows are dealt to blocks and its anchors to pieces, as many as they ask for; every two meet in one group.
    """
    most = POSITIVES if positives else NEGATIVES
    routed = stored(_routed(anchors, index), "negatives-routed")
    asked = routed.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    dealt = F.broadcast(stored(sizes.join(asked, ["dim", "leaf"]), "negatives-dealt"))

    def met(df: DataFrame, mine: str, other: str, key: Column) -> DataFrame:
        """The rows with their own part of the leaf, once per part of the other side."""
        df = df.join(dealt, ["dim", "leaf"]).withColumn(mine, F.pmod(F.xxhash64(key), mine + "s").cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1))).drop("blocks", "pieces")

    def compare(key, rows: pa.Table, asking: pa.Table) -> pa.Table:
        out = {n: [] for n in ("anchor_id", "positive_id", "positive_score", "other_id", "score")}
        d = int(key[0].as_py())
        if rows.num_rows and asking.num_rows:
            order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
            ids, labels, vectors = rows["vec_id"].to_numpy()[order], rows["label"].to_numpy()[order], _matrix(rows["vector"], d)[order]
            for at in range(0, asking.num_rows, ANCHORS):
                part = asking.slice(at, ANCHORS)
                scores = np.rint(_matrix(part["vector"], d) @ vectors.T).astype(np.int64)
                for i, (anchor, label, windows) in enumerate(zip(part["vec_id"].to_pylist(), part["label"].to_pylist(), part["windows"].to_pylist())):
                    fits = (labels == label) & (ids != anchor) if positives else labels != label
                    for w in windows:
                        held = np.flatnonzero(fits & (scores[i] >= w["least"]) & (scores[i] <= w["most"]))
                        # Rows are ordered by id, so the stable sort leaves ties to the smaller id.
                        held = held[np.argsort(-scores[i][held], kind="stable")[:most]]
                        out["anchor_id"].extend([anchor] * len(held))
                        out["positive_id"].extend([w["positive_id"]] * len(held))
                        out["positive_score"].extend([w["positive_score"]] * len(held))
                        out["other_id"].extend(ids[held].tolist())
                        out["score"].extend(scores[i][held].tolist())
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    keys = ["dim", "leaf", "block", "piece"]
    held = met(members, "block", "piece", F.struct("vec_id", "label", "vector")).groupBy(*keys)
    found = held.cogroup(met(routed, "piece", "block", F.col("vec_id")).groupBy(*keys)).applyInArrow(compare, "anchor_id long, positive_id long, positive_score long, other_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "other_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= most)


def _window(positive_id: Column, positive_score: Column, least: Column, most: Column) -> Column:
    return F.struct(positive_id.cast("long").alias("positive_id"), positive_score.cast("long").alias("positive_score"), least.cast("long").alias("least"), most.cast("long").alias("most"))


def _hundredths(value: Column) -> Column:
    """A long divided by 100, rounded down."""
    return F.floor((value - F.pmod(value, F.lit(100))) / 100).cast("long")


def hard_negatives(vectors: DataFrame, every: int = EVERY, window: tuple[int, int] = WINDOW, relabel_every: int | None = 7) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(256 x); a score is the integer inner product with the anchor. Anchors are the rows whose
    vec_id is divisible by `every`. An anchor's positives are the POSITIVES best other rows of its label; for each, the
    best NEGATIVES rows of other labels whose score is within `window` hundredths of the positive's are returned. Ties go
    to the smaller vec_id. Where vec_id is divisible by `relabel_every`, the label first becomes (label + 1) % 10.

    Rows with a null id, label or vector, or with null or non-finite components take no part, nor do vectors whose squared
    length after scaling is 2^53 or more, as their scores would not be exact. Vectors meet those of their own dimension
    only; an empty vector scores 0 with its like. Equal rows count once; different rows under one id are all searched, but
    are not each other's positives, and as anchors under one id they share lists. Other columns are ignored; an empty
    table gives no rows.
    """
    rows = stored(usable(vectors, relabel_every), "negatives-rows")
    index = Index(rows)
    indexed = stored(_indexed(_thin(rows), index), "negatives-leaves")
    _set_ranges(indexed, index)
    members = indexed.where("leaf IS NOT NULL").select("vec_id", "label", "vector", "dim", "leaf")
    # As many rows as the sample makes leaves.
    sizes = members.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    any_score = F.array(_window(F.lit(None), F.lit(None), F.lit(NO_SCORE), F.lit(-NO_SCORE)))
    anchors = rows.where(F.col("vec_id") % every == 0).select("vec_id", "label", "vector", "dim", any_score.alias("windows"))
    anchors = stored(anchors.repartition("vec_id"), "negatives-anchors")
    positives = _searched(members, sizes, _narrowed(anchors, index, True), index, True)
    # 100 s between low p and high p, in whole scores.
    low, high = -_hundredths(-window[0] * F.col("score")), _hundredths(window[1] * F.col("score"))
    windows = positives.where(low <= high).groupBy("anchor_id").agg(F.collect_list(_window(F.col("other_id"), F.col("score"), low, high)).alias("windows"))
    windows = stored(windows, "negatives-windows").withColumnRenamed("anchor_id", "vec_id")
    asking = stored(_narrowed(anchors.drop("windows").join(windows, "vec_id").select("vec_id", "label", "vector", "dim", "windows"), index, False), "negatives-asking")
    found = _searched(members, sizes, asking, index, False)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
