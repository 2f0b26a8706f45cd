"""Approximate nearest neighbours by shifted space-filling curves.

Distinct vectors are projected by several random rotations to a few axes, shifted, and ordered along a Hilbert curve. Each
ordering is range-partitioned and numbered; a query meets the rows whose numbers are near its own on every curve, and the
neighbours of all curves are merged and ranked by the exact inner product.

`reach` is the share of the table that a query meets on each side: with near-isotropic vectors, neighbours are barely
closer than others and recall follows the share of rows met; README has the measured recall. Rows are met in blocks of
bounded size, and queries pass a block in batches.

Vectors that are null, zero, or hold null or non-finite components take no part; neither do rows without id, nor vectors
of another length than most. Rows with one id and one vector count once. Equal vectors are one item that holds the
smallest ids needed, so ties go to the smaller id and a hot vector does not fill a window. An empty table gives an empty
result. Other columns are not read.
"""

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from gleaner.sources.staging import stage

AXES, BITS = 4, 10
BLOCK = 8192  # rows of a curve that are met together
CELLS = 1 << 18  # scores that a task holds at a time
SALTS = 64


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid point (n x axes, values below 2^bits) along the Hilbert curve.

    From the highest bit down, the curve's orientation is a reflection or exchange of axes that the bits so far decide;
    undoing it turns the bits of all axes into the Gray code of the place.
    """
    x, axes = points.astype(np.int64).T.copy(), points.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(axes):
            flip = (x[k] >> bit) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[k] ^= swap
    gray = np.zeros(points.shape[0], np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(axes):
            gray = gray << 1 | (x[k] >> bit) & 1
    shift = 1
    while shift < bits * axes:  # Gray code to number
        gray ^= gray >> shift
        shift *= 2
    return gray


def rotation(curve: int, size: int, axes: int) -> tuple[np.ndarray, np.ndarray]:
    """Projection (size x axes) and shift of a curve, the same in every task."""
    random = np.random.default_rng(1_000 + curve)
    return np.linalg.qr(random.normal(size=(size, max(axes, 1))))[0], random.random(axes)


def items(vectors: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """(item, vec, ids): the distinct vectors that take part, their smallest id and their `keep` smallest ids."""
    usable = (f"`{key}` is not null and size(vec) > 0 and "
              "forall(vec, x -> x is not null and x = x and abs(x) < double('infinity')) and exists(vec, x -> x <> 0)")
    rows = (vectors.select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias("vec"))
            .filter(F.coalesce(F.expr(usable), F.lit(False)))
            .withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))))  # -0 is 0
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vec") == (sizes["n"] if sizes else 0))
    salted = rows.groupBy("vec", F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("salt"), F.col(key).alias("id")).count()
    by_salt = W.partitionBy("vec", "salt").orderBy("id")
    by_vector = W.partitionBy("vec").orderBy("id")
    least = (salted.withColumn("r", F.row_number().over(by_salt)).filter(F.col("r") <= keep)
             .withColumn("r", F.row_number().over(by_vector)).filter(F.col("r") <= keep))
    return least.groupBy("vec").agg(F.min("id").alias("item"), F.sort_array(F.collect_list("id")).alias("ids"))


def ordered(found: DataFrame, size: int, curves: int, axes: int = AXES, bits: int = BITS) -> DataFrame:
    """(curve, number, item, vec): every item on every curve, numbered from 0 along it."""
    axes = min(axes, size)
    projections = [rotation(c, size, axes) for c in range(curves)]

    def project(batches):
        for batch in batches:
            data = batch.column(1).flatten().to_numpy().reshape(-1, size)  # all are of this length and without null
            scaled = data / np.linalg.norm(data, axis=1, keepdims=True)
            for curve, (turn, shift) in enumerate(projections):
                # Projections of unit vectors have a spread of 1 / sqrt(size): four of them fill half of the grid, and the
                # shift moves them inside the other half.
                unit = np.clip(scaled @ turn * np.sqrt(size) / 8 + 0.5, 0, 1 - 1e-9)
                grid = ((unit + shift) * (1 << (bits - 1))).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(data), curve, np.int32)), pa.array(hilbert(grid, bits)), batch.column(0),
                     pa.array([v.tobytes() for v in data], pa.binary())], names=["curve", "place", "item", "vec"])
    keyed = found.select("item", "vec").mapInArrow(project, "curve int, place bigint, item bigint, vec binary")
    sorted_rows = keyed.repartitionByRange("curve", "place", "item").sortWithinPartitions("curve", "place", "item")

    def number(batches):
        curve, n = None, 0
        for batch in batches:
            now = batch.column(0).to_numpy()
            at = np.empty(len(now), np.int64)
            for value in np.unique(now):
                same = np.flatnonzero(now == value)
                n = n if value == curve else 0
                at[same] = np.arange(n, n + len(same))
                curve, n = value, n + len(same)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "at"])

    counted = stage(sorted_rows.mapInArrow(number, "curve int, place bigint, item bigint, vec binary, at bigint")
                    .withColumn("part", F.spark_partition_id()), "curves")
    # One row per curve and partition.
    loads = counted.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = loads.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return counted.join(F.broadcast(starts), ["curve", "part"]).select(
        "curve", (F.col("start") + F.col("at")).alias("number"), "item", "vec")


def scored(asked_numbers, asked_items, asked, numbers, stored_items, data, window, keep):
    """(asked, item, score) of the `keep` best rows of a block for each query within `window` places, with all that tie with the last.

    The queries pass in batches of at most `CELLS` scores, so the memory needed does not grow with them.
    """
    place, at_once = min(keep, len(numbers)), max(1, CELLS // max(1, len(numbers)))
    for at in range(0, len(asked), at_once):
        end = at + at_once
        scores = asked[at:end] @ data.T
        near = asked_numbers[at:end, None]
        scores[(numbers < near - window) | (numbers > near + window)] = -np.inf
        cutoff = np.partition(scores, scores.shape[1] - place, axis=1)[:, scores.shape[1] - place, None]
        q, c = np.nonzero((scores >= cutoff) & (scores > -np.inf))
        yield pa.RecordBatch.from_arrays(
            [pa.array(asked_items[at:end][q], pa.int64()), pa.array(stored_items[c], pa.int64()), pa.array(scores[q, c], pa.float64())],
            names=["asked", "item", "score"])


def neighbours(vectors: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding",
               curves: int = 8, reach: float = 0.13, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the k best others found."""
    found = stage(items(vectors, key, vector, k + 1), "items")
    n = found.count()
    size = len(found.first()["vec"]) if n else 1
    window = int(Fraction(str(reach)) * n) + k
    rows = ordered(found, size, curves)
    many = vectors.select(F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vec")).filter(
        f"query_id % {every} = 0").distinct()
    queries = many.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))).join(found.select("vec", "item"), "vec")
    queries = stage(queries.select("query_id", "item"), "queries")
    # A vector is asked for once, however many of its ids are queries.
    searched = rows.join(queries.select("item").distinct(), "item", "left_semi")
    stored = rows.select("curve", F.floor(F.col("number") / block).alias("block"), F.lit(0).alias("kind"), "number", "item", "vec")
    last = max(n - 1, 0) // block
    reached = F.sequence(F.floor(F.greatest(F.col("number") - window, F.lit(0)) / block),
                         F.least(F.floor((F.col("number") + window) / block), F.lit(last).cast("long")))
    sought = searched.select("curve", F.explode(reached).alias("block"), F.lit(1).alias("kind"), "number", "item", "vec")

    def meet(batches):
        here, numbers, held, stored_items, data, open_block = None, [], [], None, None, False
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("curve", "block", "kind", "number", "item")]
            vecs = batch.column("vec")
            keys = np.stack(columns[:3], axis=1)
            cuts = np.flatnonzero(np.any(np.diff(keys, axis=0) != 0, axis=1)) + 1 if len(keys) else np.zeros(0, int)
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                curve, number_of_block, kind = keys[a]
                part = np.frombuffer(b"".join(v.as_py() for v in vecs.slice(a, b - a)), float).reshape(b - a, -1)
                if kind == 0:
                    if here != (curve, number_of_block):
                        here, held = (curve, number_of_block), []
                    held.append((columns[3][a:b], columns[4][a:b], part))
                    open_block = True
                    continue
                if open_block:
                    numbers, stored_items = (np.concatenate([h[j] for h in held]) for j in (0, 1))
                    data, held, open_block = np.concatenate([h[2] for h in held]), [], False
                yield from scored(columns[3][a:b], columns[4][a:b], part, numbers, stored_items, data, window, k + 1)

    dealt = stored.unionByName(sought).repartition("curve", "block").sortWithinPartitions("curve", "block", "kind", "number")
    met = dealt.mapInArrow(meet, "asked bigint, item bigint, score double")
    # Every query has about curves x blocks x (k + 1) rows here, whatever the data.
    merged = met.groupBy("asked", "item").agg(F.max("score").alias("score"))
    top = W.partitionBy("asked").orderBy(F.desc("score"), "item")
    ranked = merged.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k + 1)
    spelled = (queries.withColumnRenamed("item", "asked").join(ranked, "asked")
               .join(found.select("item", "ids"), "item")
               .select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (spelled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
