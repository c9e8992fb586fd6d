"""Near-duplicate vectors by collision counting on sorted one-dimensional projections.

Every vector has a place on many random lines (lists). Two vectors collide in a list if their
places are within a window of each other; pairs that collide in enough lists are candidates, and
their cosine is computed. Window, lists and the count come from the similarity asked for, so that a
pair at exactly that similarity is found with chance ``recall`` (binomial in the lists). To keep
lists short, each list is cut into cells by the signs of a few more projections of its own, which
count into the chance; the number of signs follows the largest group, so cells hold about ``cell``
vectors at any size.

Dense groups are never expanded into all their pairs. Equal vectors are one class with a weight.
Near ones are balls: the mean of a crowded cell is a pivot, vectors within ``radius`` degrees of it are its
ball, and as angles obey the triangle inequality, any two of a ball are links, and whole balls are
links of a vector or of another ball when the angles' sums allow no other outcome. Only where the
sums leave it open are members compared one by one.

Vectors are compared when their labels are equal and not null (and their lengths are equal).

Cases: vectors that are null, zero, or hold null or non-finite parts, and those without a label,
link with nothing and are components of their own; rows that repeat a key are one vector per
distinct content, and get the same component if the key is equal; an empty table gives no rows;
other columns are not read. Null keys are left out of links and returned as kept single rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.llm.graph import components

LEAST, RECALL, CELL, CROWD, RADIUS, SEED = 0.93, 0.9999, 20, 16, 9.5, 53


def _normal(x: float) -> float:
    """Chance that a standard normal number is within x of 0."""
    return math.erf(x / math.sqrt(2))


@dataclass
class Search:
    """Signs per cell, half window (for unit vectors times sqrt of their length), lists, and the
    count of collisions that makes a candidate."""

    signs: int
    window: float
    lists: int
    count: int


def calibrate(angle: float, signs: int, count: int, recall: float) -> Search:
    """The fewest lists in which a pair at ``angle`` (radians) collides ``count`` times with chance
    ``recall``. A place on a line differs by about a normal number with the chord as deviation; the
    window is one and a half of that."""
    chord = 2 * math.sin(angle / 2)
    p = (1 - angle / math.pi) ** signs * _normal(1.5)
    lists = count
    while sum(math.comb(lists, i) * p ** i * (1 - p) ** (lists - i) for i in range(count)) > 1 - recall:
        lists += 1
    return Search(signs, 1.5 * chord, lists, count)


def _unit(vector: np.ndarray) -> bytes | None:
    norm = math.sqrt(float(vector @ vector))
    if not np.isfinite(vector).all() or norm == 0 or not math.isfinite(norm):
        scale = np.abs(vector).max() if len(vector) and np.isfinite(vector).all() else 0.0
        if scale == 0:
            return None
        vector = vector / scale
        norm = math.sqrt(float(vector @ vector))
    return (vector / norm).tobytes()


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``id, grp, unit`` (doubles as bytes): label and length as group; unusable rows left out."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, groups, units = [], [], []
            for i, lab, v in zip(*(batch.column(j).to_pylist() for j in range(3))):
                if i is None or lab is None or not v or any(x is None for x in v):
                    continue
                with np.errstate(all="ignore"):
                    u = _unit(np.asarray(v, np.float64))
                if u is not None:
                    ids.append(i)
                    groups.append(f"{lab}:{len(v)}")
                    units.append(u)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(groups, pa.string()), pa.array(units, pa.binary())],
                                             ["id", "grp", "unit"])

    return vectors.select(F.col(key).cast("bigint"), F.col(label).cast("string"), F.col(vector).cast("array<double>")) \
        .mapInArrow(work, "id bigint, grp string, unit binary")


def _lines(size: int, lists: int, signs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The lists' lines (times sqrt of the length, so places differ by about the chord) and sign lines."""
    rng = np.random.default_rng([seed, size])
    lines = rng.standard_normal((lists, size))
    lines *= math.sqrt(size) / np.linalg.norm(lines, axis=1, keepdims=True)
    return lines, rng.standard_normal((lists, signs, size))


def places(points: DataFrame, near: Search, seed: int, both_sides: bool) -> DataFrame:
    """``grp, list, cell, bin, x, id, side``: each point in each list. A bin is as wide as the window, so
    the points within it of a query are in its own bin and the two beside it; with ``both_sides``
    a point is listed in all three, otherwise in its own bin and the one below (for unordered pairs)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, groups = np.asarray(part.column(0)), np.asarray(part.column(1).to_pylist(), object)
                units = part.column(2).to_pylist()
                for size in {len(u) for u in units}:
                    here = np.array([i for i, u in enumerate(units) if len(u) == size])
                    x = np.frombuffer(b"".join(units[i] for i in here), np.float64).reshape(len(here), -1)
                    if size not in made:
                        made[size] = _lines(x.shape[1], near.lists, near.signs, seed)
                    lines, sign_lines = made[size]
                    place = x @ lines.T
                    cell = np.zeros(place.shape, np.int64)
                    for s in range(near.signs):
                        cell = cell << 1 | (x @ sign_lines[:, s].T > 0)
                    who = np.repeat(here, near.lists)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(groups[who], pa.string()), pa.array(np.tile(np.arange(near.lists), len(here)), pa.int64()),
                         pa.array(cell.ravel()), pa.array(np.floor(place.ravel() / near.window).astype(np.int64)),
                         pa.array(place.ravel()), pa.array(ids[who])], ["grp", "list", "cell", "own_bin", "x", "id"])

    rows = points.select("id", "grp", "unit").mapInArrow(
        work, "grp string, list bigint, cell bigint, own_bin bigint, x double, id bigint")
    rows = rows.withColumn("bucket", F.xxhash64("grp", "list", "cell"))
    return rows.select("bucket", "own_bin", "x", "id", F.explode(
        F.array(F.lit(0), F.lit(-1), F.lit(1)) if both_sides else F.array(F.lit(0), F.lit(-1))).alias("shift")) \
        .withColumn("bin", F.col("own_bin") + F.col("shift"))


def colliding(left: DataFrame, right: DataFrame, window: float, count: int, unordered: bool) -> DataFrame:
    """Pairs ``a, b`` that are within the window in at least ``count`` lists; partial counts are made
    before the shuffle. ``unordered``: both sides are the same points and a < b."""
    left = left.where("shift = 0").select(F.col("bucket").alias("k"), F.col("bin").alias("n"), F.col("x").alias("lx"), F.col("id").alias("l"))
    met = left.join(right, (F.col("k") == F.col("bucket")) & (F.col("n") == F.col("bin")) & (F.abs(F.col("lx") - F.col("x")) <= window))
    if unordered:
        met = met.where((F.col("shift") != 0) & (F.col("l") != F.col("id")) | (F.col("shift") == 0) & (F.col("l") < F.col("id")))
        met = met.select(F.least("l", "id").alias("a"), F.greatest("l", "id").alias("b"))
    else:
        met = met.where("l <> id").select(F.col("l").alias("a"), F.col("id").alias("b"))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count).select("a", "b")


def angles(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """``pairs`` with the angle between ``a`` and ``b`` and their cosine."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = np.array([float(np.frombuffer(u) @ np.frombuffer(v)) for u, v in zip(
                batch.column("ua").to_pylist(), batch.column("ub").to_pylist())])
            rest = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(cos, pa.float64()), pa.array(np.arccos(np.clip(cos, -1, 1)), pa.float64())],
                                             [*kept, "cos", "angle"])

    kept = pairs.columns
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema.fields)
    both = pairs.join(points.select(F.col("id").alias("a"), F.col("unit").alias("ua")), "a") \
        .join(points.select(F.col("id").alias("b"), F.col("unit").alias("ub")), "b")
    return both.select(*kept, "ua", "ub").mapInArrow(work, f"{shape}, cos double, angle double")


def pivots(points: DataFrame, size: int, signs: int, seed: int) -> DataFrame:
    """``cell_key, unit``: the mean directions of cells with at least ``CROWD`` points in two lists of
    sign cells. Sums are made per task first, so a crowded cell is one row per task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sums = _cells(batch, signs, seed), {}
            for (row_keys, x) in keys:
                for k in row_keys:
                    n, s = sums.get(k, (0, 0.0))
                    sums[k] = (n + 1, s + x)
            for width in {len(s) for _, s in sums.values()}:
                own = [(k, n, s) for k, (n, s) in sums.items() if len(s) == width]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in own], pa.string()), pa.array([n for _, n, _ in own], pa.int64()),
                     pa.array([s.tolist() for _, _, s in own], pa.list_(pa.float64()))], ["cell_key", "n", "s"])

    parts = points.select("id", "grp", "unit").mapInArrow(work, "cell_key string, n bigint, s array<double>")
    # element-wise sums: the parts are as many as tasks times crowded cells
    cells = parts.groupBy("cell_key").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(size)])
    return cells.where(F.col("n") >= CROWD).select("cell_key", F.array(*[f"s{i}" for i in range(size)]).alias("s"))


def _cells(batch: pa.RecordBatch, signs: int, seed: int):
    """For each row its two cell keys and its unit vector."""
    made: dict[int, np.ndarray] = {}
    for grp, unit in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        x = np.frombuffer(unit)
        if len(x) not in made:
            made[len(x)] = np.random.default_rng([seed, 7, len(x)]).standard_normal((2, signs, len(x)))
        bits = made[len(x)] @ x > 0
        yield [f"{grp}:{j}:{''.join('1' if b else '0' for b in bits[j])}" for j in range(2)], x


def balls(points: DataFrame, size: int, signs: int, seed: int, radius: float) -> DataFrame:
    """``id, ball, theta, pivot``: the nearest pivot of a point's two cells, if within ``radius``.
    Pivots of the two cells are brought by a join on the cell; ball numbers are the smallest member."""
    found = pivots(points, size, signs, seed)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k for k, _ in _cells(batch, signs, seed)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.list_(pa.string()))], ["id", "unit", "keys"])

    rows = points.select("id", "grp", "unit").mapInArrow(keyed, "id bigint, unit binary, keys array<string>")
    rows = rows.select("id", "unit", F.explode("keys").alias("cell_key")).join(found, "cell_key")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            theta, units = [], []
            for unit, s in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                s = np.asarray([v for v in s if v is not None], float)
                norm = math.sqrt(float(s @ s))
                pivot = s / norm if norm > 0 else s
                units.append(pivot.tobytes())
                theta.append(math.acos(max(-1.0, min(1.0, float(np.frombuffer(unit) @ pivot)))) if norm > 0 else math.pi)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(theta, pa.float64()), pa.array(units, pa.binary())],
                                             ["id", "cell_key", "theta", "pivot"])

    near = rows.select("id", "unit", "cell_key", "s").mapInArrow(measure, "id bigint, cell_key string, theta double, pivot binary")
    near = near.where(F.col("theta") <= radius).groupBy("id").agg(F.min(F.struct("theta", "cell_key", "pivot")).alias("m"))
    return near.select("id", F.col("m.theta").alias("theta"), F.col("m.cell_key").alias("cell_key"), F.col("m.pivot").alias("pivot"))


def link(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST,
         recall: float = RECALL, radius: float = RADIUS, seed: int = SEED) -> DataFrame:
    """``key, n_links, component_id, kept`` per row of ``vectors``."""
    limit, wide, slack = math.acos(least), math.radians(radius), 1e-9
    if 2 * wide > limit:
        wide = limit / 2 - 1e-6
    good = stored(usable(vectors, key, vector, label).distinct(), "vec-units")
    # equal vectors of a group: one class
    classes = stored(good.groupBy("grp", "unit").agg(F.min("id").alias("id"), F.countDistinct("id").alias("weight")), "vec-classes")
    largest = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    size = (classes.agg(F.max(F.length("unit"))).first()[0] or 8) // 8
    signs = max(0, min(24, round(math.log2(max(1.0, largest / CELL)))))
    near = calibrate(limit, signs, 3, recall)
    member = stored(balls(classes, size, min(24, max(4, signs)), seed, wide), "vec-balls")
    crowd = member.groupBy("cell_key").agg(F.min("id").alias("ball"), F.max("theta").alias("r"), F.first("pivot").alias("unit"),
                                           F.count(F.lit(1)).alias("members")).where("members > 1")
    ball = stored(crowd, "vec-pivots")
    member = stored(member.join(ball.select("cell_key", "ball"), "cell_key").select("id", "ball", "theta"), "vec-members")
    single = stored(classes.join(member.select("id"), "id", "left_anti"), "vec-singles")

    # single vectors among each other
    listed = stored(places(single, near, seed, False), "vec-lists")
    pairs = angles(colliding(listed, listed, near.window, near.count, True), single)
    pairs = pairs.where(F.col("cos") >= least).select("a", "b")

    # pivots against single vectors and other pivots
    far = calibrate(limit + 2 * wide, max(0, signs - 3), 2, recall)
    grouped = classes.select(F.col("id").alias("ball"), "grp")
    centre = ball.select("ball", "unit").join(grouped, "ball").select((-F.col("ball") - 1).alias("id"), "grp", "unit")
    around = single.select("id", "grp", "unit").unionByName(centre)
    queries = places(centre, far, seed + 1, False)
    met = colliding(queries, places(around, far, seed + 1, True), far.window, far.count, False)
    met = stored(angles(met, around.unionByName(centre).distinct()), "vec-pivot-pairs")
    met = met.withColumn("a", -F.col("a") - 1).withColumn("other", F.when(F.col("b") < 0, -F.col("b") - 1).otherwise(F.col("b"))) \
        .withColumn("is_ball", F.col("b") < 0)
    radii = ball.select(F.col("ball").alias("bb"), F.col("r").alias("br"))
    met = met.join(ball.select(F.col("ball").alias("a"), F.col("r").alias("ar")), "a").join(
        radii, F.col("is_ball") & (F.col("other") == F.col("bb")), "left")
    met = met.where(~F.col("is_ball") | (F.col("a") < F.col("other")))
    reach = F.col("ar") + F.coalesce(F.col("br"), F.lit(0.0))
    met = met.where(F.col("angle") - reach <= limit + slack).withColumn("whole", F.col("angle") + reach <= limit - slack)
    met = stored(met.select("a", "other", "is_ball", "whole"), "vec-ball-pairs")
    # where the angles leave it open, members are compared one by one
    open_ = met.where("NOT whole").join(member.select(F.col("ball").alias("a"), F.col("id").alias("x")), "a")
    inner = member.select(F.col("ball").alias("o"), F.col("id").alias("y"))
    open_ = open_.join(inner, F.col("is_ball") & (F.col("other") == F.col("o")), "left").select(
        F.col("x").alias("a"), F.when(F.col("is_ball"), F.col("y")).otherwise(F.col("other")).alias("b"))
    open_ = angles(open_, classes).where(F.col("cos") >= least).select("a", "b")
    pairs = stored(pairs.unionByName(open_), "vec-pairs")

    # links of a class: its own other rows, its ball, whole balls, single partners
    weight = classes.select("id", "weight")
    ball_weight = stored(member.join(weight, "id").groupBy("ball").agg(F.sum("weight").alias("bw")), "vec-ball-weights")
    w = weight.select(F.col("id").alias("p"), F.col("weight").alias("pw"))
    parts = [weight.select("id", (F.col("weight") - 1).alias("n"))]
    parts.append(member.join(ball_weight, "ball").join(weight, "id").select("id", (F.col("bw") - F.col("weight")).alias("n")))
    for a, b in (("a", "b"), ("b", "a")):
        parts.append(pairs.select(F.col(a).alias("id"), F.col(b).alias("p")).join(w, "p").select("id", F.col("pw").alias("n")))
    whole = met.where("whole")
    per_ball = whole.where("is_ball").select(F.col("a").alias("ball"), F.col("other").alias("q")).unionByName(
        whole.where("is_ball").select(F.col("other").alias("ball"), F.col("a").alias("q"))).join(
        ball_weight.select(F.col("ball").alias("q"), "bw"), "q").select("ball", F.col("bw").alias("n"))
    per_ball = per_ball.unionByName(whole.where("NOT is_ball").select(F.col("a").alias("ball"), F.col("other").alias("p")).join(
        w, "p").select("ball", F.col("pw").alias("n"))).groupBy("ball").agg(F.sum("n").alias("n"))
    parts.append(member.join(per_ball, "ball").select("id", "n"))
    parts.append(whole.where("NOT is_ball").select(F.col("other").alias("id"), F.col("a").alias("ball")).join(ball_weight, "ball").select(
        "id", F.col("bw").alias("n")))
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    total = total.groupBy("id").agg(F.sum("n").alias("n_links"))

    edges = pairs.unionByName(member.select(F.col("id").alias("a"), F.col("ball").alias("b"))).unionByName(
        whole.select("a", F.col("other").alias("b")))
    found = components(edges).select(F.col("node").alias("id"), "component")
    settled = total.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = good.join(classes.select("grp", "unit", F.col("id").alias("c")), ["grp", "unit"]).join(
        settled.withColumnRenamed("id", "c"), "c").groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    out = vectors.select(F.col(key)).join(rows, F.col(key) == F.col("id"), "left")
    own = F.coalesce(F.col("component"), F.col(key).cast("bigint"))
    return out.select(F.col(key), F.coalesce(F.col("n_links"), F.lit(0)).cast("bigint").alias("n_links"),
                      own.alias("component_id"), F.coalesce(F.col(key) == own, F.lit(True)).alias("kept"))
