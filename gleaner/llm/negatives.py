"""Hard negatives by threshold joins in the manner of L2AP: an inverted index that norms cut short, and falling thresholds.

Rows are packed in blocks, anchors in batches, and each batch meets each block of vectors of its length inside a task. There
the dimensions are ordered by weight. A row enters the inverted index with its leading dimensions only: from the place on
where the norm of the rest, times the largest such norm among the anchors, is below the threshold, the rest can't lift a row
that shares nothing before. Partial scores are summed over the index; a pair is dropped as soon as its sum and the product
of the remaining norms stay below the anchor's threshold, and the dimensions that the index omits are added to the pairs
that are left. All pairs at or above the threshold are found, with exact integer scores.

A round looks for the rows of every window that has a threshold's worth of room: the anchor's own label for positives, any
other label between two shares of a positive's score for negatives. A window that holds enough rows above the threshold is
done; the others go on with a lower one, and the last one of a window is its own lower end. So every window ends full, or
holds all its rows, whatever the thresholds were. Each round is written out.

Rows without id, without label, without vector, or with a null or non-finite component take no part. Rows that agree in id,
label and vector are one row; rows that share an id alone are rows of their own, ranked by score, id, label and vector
number. Vectors of different lengths don't meet. Ties go to the smaller id. Zero and empty vectors score 0. An empty table,
or one without anchors, gives an empty result. Other columns are not read. Scores must fit 64-bit integers.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from gleaner.sources.staging import stage

BLOCK, BATCH = 8192, 256  # rows of a block, anchors of a batch
VALUES = 1 << 20  # components of either, where vectors are long
CHUNK = 8  # dimensions that are summed before pairs are pruned
SPARSE = 0.02  # share of pairs below which they are finished one by one
LEAST, MOST = -(1 << 62), 1 << 62
#: Thresholds for positives, as shares of the largest product of norms; for negatives, of the way down their window.
POSITIVE_STEPS, NEGATIVE_STEPS = (0.5, 0.25, 0.1), (0.75, 0.5, 0.2)
EXACT = 1 << 53


def rows_of(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(row, id, label, vec, size, norm): the distinct rows that take part, numbered and written out."""
    usable = ("id is not null and label is not null and vec is not null and "
              "forall(vec, x -> x is not null and x = x and abs(x) < double('infinity'))")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(vector).alias("vec")).filter(F.coalesce(F.expr(usable), F.lit(False)))
    norm = F.expr("sqrt(aggregate(vec, double(0), (t, x) -> t + double(x) * double(x)))")
    rows = (rows.withColumn("vec", F.transform("vec", lambda x: x.cast("long"))).distinct()
            .withColumns({"size": F.size("vec"), "norm": norm, "row": F.monotonically_increasing_id()}))
    return stage(rows.sortWithinPartitions("size"), "vectors")


def packed(rows: DataFrame, columns: list[str], n: int) -> DataFrame:
    """Up to n rows of one length as one: (pack, size, numbers, data), the whole-number columns and the vectors as bytes."""

    def pack(batches):
        part, count = TaskContext.get().partitionId(), 0
        size, held = None, []

        def flush():
            nonlocal count, held
            numbers, data = (np.concatenate(h) for h in zip(*held))
            held, count = [], count + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + count - 1], pa.int64()), pa.array([size], pa.int32()),
                 *[pa.array([m.tobytes()], pa.binary()) for m in (numbers, data)]], names=["pack", "size", "numbers", "data"])

        for batch in batches:
            sizes = batch.column("size").to_numpy()
            numbers = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
            flat, starts = batch.column("vec").flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            cuts = np.flatnonzero(np.diff(sizes)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(sizes)]):
                while a < b:
                    if held and size != sizes[a]:
                        yield flush()
                    size = int(sizes[a])
                    room = max(1, min(n, VALUES // max(size, 1))) - sum(len(h[0]) for h in held)
                    end = min(b, a + room)
                    held.append((numbers[a:end], flat[starts[a]:starts[end]]))
                    if end - a == room:
                        yield flush()
                    a = end
        if held:
            yield flush()

    return rows.select("size", "vec", *columns).sortWithinPartitions("size").mapInArrow(
        pack, "pack long, size int, numbers binary, data binary")


def _rest_norms(data, edges):
    """Norm of each row from each edge on."""
    squares = np.cumsum((data.astype(float) ** 2)[:, ::-1], axis=1)[:, ::-1]
    squares = np.concatenate([squares, np.zeros((len(data), 1))], axis=1)
    return np.sqrt(squares[:, edges])


def threshold_scores(asked, stored, least):
    """(scores, found): found[i, j] tells whether asked[i] . stored[j] >= least[i]; there, scores[i, j] is that product."""
    size, least = stored.shape[1], np.asarray(least, np.int64)
    if size == 0:
        return np.zeros((len(asked), len(stored)), np.int64), np.repeat((least <= 0)[:, None], len(stored), axis=1)
    largest = np.abs(asked).max(initial=0).astype(float) * np.abs(stored).max(initial=0) * size
    kind = np.float64 if largest < EXACT else np.int64  # whole numbers below 2^53 are exact as doubles
    order = np.argsort(-(stored.astype(float) ** 2).sum(axis=0), kind="stable")
    asked, stored = (np.ascontiguousarray(m[:, order], dtype=kind) for m in (asked, stored))
    edges = np.array([*range(0, size, CHUNK), size])
    ours, theirs = _rest_norms(asked, edges), _rest_norms(stored, edges) * (1 + 1e-9)
    # A row is indexed up to the first edge from which on it can't reach any anchor's threshold alone.
    indexed = (theirs[:, :-1] * ours.max(axis=0)[:-1] >= least.min()).sum(axis=1)
    scores = np.zeros((len(asked), len(stored)), kind)
    found = np.repeat((indexed > 0)[None, :], len(asked), axis=0)
    summed = np.zeros(len(stored), np.int64)  # the edge up to which a row's scores are complete
    few = False
    for c in range(len(edges) - 1):
        posting = np.flatnonzero((indexed > c) & found.any(axis=0))
        if few or not len(posting):
            break
        scores[:, posting] += asked[:, edges[c]:edges[c + 1]] @ stored[posting, edges[c]:edges[c + 1]].T
        summed[posting] = c + 1
        found[:, posting] &= scores[:, posting] + ours[:, c + 1, None] * theirs[None, posting, c + 1] >= least[:, None]
        few = found.mean() < SPARSE
    # What the index omits, and what is left when few pairs are: pair by pair if so, else for whole rows.
    if few:
        i, j = np.nonzero(found)
        for at in range(0, len(i), 1 << 14):
            p, q = i[at:at + (1 << 14)], j[at:at + (1 << 14)]
            rest = np.arange(size)[None, :] >= edges[summed[q]][:, None]
            scores[p, q] += (asked[p] * stored[q] * rest).sum(axis=1)
    else:
        for c in np.unique(summed[found.any(axis=0)]):
            rows = np.flatnonzero((summed == c) & found.any(axis=0))
            scores[:, rows] += asked[:, edges[c]:] @ stored[rows, edges[c]:].T
    return scores, found & (scores >= least[:, None])


def best(scores, ids, k):
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        place = np.flatnonzero(scores >= cut)
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((ids[place], -scores[place]))[:k]]


def search(wanted: DataFrame, blocks: DataFrame, windows: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, w, rank, row, id, score): the k best rows in each window at or above its anchor's threshold.

    wanted(row, id, label, vec, size, least, windows) holds an anchor's threshold and an array of its windows (w, lo, hi).
    """
    ends = [f"coalesce(get(windows, {w}).{c}, {none}) as {c}_{w}" for w in range(windows) for c, none in
            (("w", "bigint(0)"), ("lo", "bigint(1)"), ("hi", "bigint(0)"))]
    columns = ["row", "id", "label", "least", *[f"{c}_{w}" for w in range(windows) for c in ("w", "lo", "hi")]]
    batches = stage(packed(wanted.selectExpr("row", "id", "label", "vec", "size", "least", *ends), columns, BATCH), "anchors")
    lengths = blocks.groupBy("size").agg(F.max("number").alias("_last"))  # a row per length
    dealt = (batches.join(lengths, "size").withColumn("number", F.explode(F.sequence(F.lit(1), F.col("_last"))))
             .select("size", "number", F.col("numbers").alias("asked_numbers"), F.col("data").alias("asked_data")))
    parts = min(4 * max(blocks.count(), 1), 10_000)  # blocks of about a thousand vectors or more
    pairs = dealt.repartition(parts, "size", "number").join(blocks.repartition(parts, "size", "number"), ["size", "number"])

    def meet(arrow):
        for batch in arrow:
            for row in batch.to_pylist():
                asked, stored = (np.frombuffer(row[c], np.int64) for c in ("asked_numbers", "numbers"))
                asked, stored = asked.reshape(-1, len(columns)), stored.reshape(-1, 3)
                vectors = [np.frombuffer(row[c], np.int64).reshape(n, -1) for c, n in
                           (("asked_data", len(asked)), ("data", len(stored)))]
                scores, found = threshold_scores(*vectors, asked[:, 3])
                yield chosen(asked, stored, scores, found)

    def chosen(asked, stored, scores, found):
        out = []
        for i, (row, _, label, _, *ends) in enumerate(asked):
            place = np.flatnonzero(found[i] & ((stored[:, 2] == label) == same_label) & (stored[:, 0] != row))
            here, ids = scores[i, place].astype(np.int64), stored[place, 1]
            for w, lo, hi in np.reshape(ends, (-1, 3)):
                inside = np.flatnonzero((here >= lo) & (here <= hi))
                top = inside[best(here[inside], ids[inside], k)]
                out.append(np.stack([np.full(len(top), row), np.full(len(top), w), stored[place[top], 0], ids[top], here[top]], axis=1))
        out = np.concatenate([np.zeros((0, 5), np.int64), *out])
        return pa.RecordBatch.from_arrays([pa.array(out[:, c]) for c in range(5)], names=["anchor", "w", "row", "id", "score"])

    met = pairs.mapInArrow(meet, "anchor long, w long, row long, id long, score long")
    order = W.partitionBy("anchor", "w").orderBy(F.desc("score"), "id", "row")
    return (met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("anchor", "w", "rank", "row", "id", "score"))


def filled(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, thresholds, most: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, w, rank, row, id, score): the k best rows of each window(anchor, w, lo, hi), at most `most` an anchor.

    `thresholds` are SQL expressions on an anchor's columns and the ends `lo` and `hi` of its lowest window; `lo` itself is
    tried after them.
    """
    done = []
    windows = stage(windows, "windows")
    for least in [*thresholds, "lo"]:
        state = (windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", "lo", "hi"))).alias("windows"),
                                               F.min("lo").alias("lo"), F.min("hi").alias("hi"))
                 .withColumnRenamed("anchor", "row").join(anchors, "row")
                 .withColumn("least", F.expr(f"greatest(lo, cast({least} as bigint))")))
        found = stage(search(state, blocks, most, k, same_label), "found")
        # A window is done with k rows, or where the threshold was its lower end.
        size = found.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n"))
        told = stage(windows.join(state.select(F.col("row").alias("anchor"), "least"), "anchor").join(size, ["anchor", "w"], "left")
                     .withColumn("done", (F.coalesce("n", F.lit(0)) >= k) | (F.col("least") <= F.col("lo")))
                     .select("anchor", "w", "lo", "hi", "done"), "windows")
        done.append(found.join(told.filter("done").select("anchor", "w"), ["anchor", "w"], "left_semi"))
        windows = told.filter(~F.col("done")).drop("done")
        if windows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for whole-number vectors.

    Anchors are the rows whose id is divisible by `every`. Each has up to `positives` best other rows of its label, and each
    of these up to `negatives` best rows of other labels that score at least `low` and at most `high` percent of it. A
    positive without such rows has no row here.
    """
    rows = rows_of(vectors, key, vector, label)
    blocks = packed(rows, ["row", "id", "label"], BLOCK)
    blocks = stage(blocks, "packs")
    # A row per block of vectors.
    numbers = blocks.select("size", "pack").withColumn("number", F.row_number().over(W.partitionBy("size").orderBy("pack")))
    blocks = stage(blocks.join(numbers, ["size", "pack"]).select("size", "number", "numbers", "data"), "blocks")
    most = rows.groupBy("size").agg(F.max("norm").alias("most"))  # a row per length
    anchors = stage(rows.filter(F.col("id") % every == 0).join(most, "size"), "asked")
    whole = anchors.select(F.col("row").alias("anchor"), F.lit(0).cast("long").alias("w"), F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi"))
    own = stage(filled(anchors, whole, blocks, [f"{share} * norm * most" for share in POSITIVE_STEPS], 1, positives, True), "positives")
    windows = own.filter("score >= 0").select(
        "anchor", F.col("rank").cast("long").alias("w"), F.expr(f"({low} * score + 99) div 100").alias("lo"),
        F.expr(f"({high} * score) div 100").alias("hi")).filter("lo <= hi")
    found = filled(anchors, windows, blocks, [f"lo + {share} * (hi - lo)" for share in NEGATIVE_STEPS], positives, negatives, False)
    own = own.select("anchor", F.col("rank").cast("long").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (found.join(own, ["anchor", "w"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
