"""Near-duplicate embeddings by NN-descent: neighbour lists refined through the neighbours of neighbours.

Distinct vectors are nodes. Lists start from random sign orderings: nodes are sorted by the signs of random projections and
meet those next to them. A round deals every node to its neighbours and to the nodes that it is a neighbour of; all that meet
at one node are compared, and each keeps its best. A node that many others list is salted, so that no task meets more than a
bounded number of them. Rounds go on until few lists change. A list full of links is enlarged and descends on.

A list that is still full of links belongs to a crowd. Crowds are the components of the links of such lists, each with the
most distant link met so far, so that crowds that touch are one. Members of a crowd are packed in blocks, sorted by their
signs, and every block meets every other one of its crowd in a task: their links are counted there, and no pair is written,
only counts and, for each block pair, the smallest node that a member hangs together with. So lists stay short and yet no link
of a crowd is lost, whatever its size; the comparisons inside tasks grow with the square of a crowd.

Descent compares 8-bit sketches, whose error is known for each node: a list holds upper bounds of cosines, so a pair below the
threshold by its bound is no link, and one above it by its lower bound is. The pairs between are compared in doubles, as are
all members of crowds.

The lists are audited: the links of a bounded number of nodes, of all nodes and of those with links, are counted against
every node. Below the target, more orderings are added and the descent goes on.

Vectors that are null, zero, or hold null or non-finite components link with nothing and have a row of their own. Rows
without id have no row. Rows with one id and one vector are one row; an id with several vectors has a row for each. Vectors
of different lengths don't link. Equal vectors link, and count as often as they have ids. An empty table gives an empty
result. Other columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from gleaner.llm.components import components
from gleaner.sources.staging import stage

ROOM, LARGEST = 8, 32  # length of a list at first and at most
ORDERS, REACH, KEEP = 12, 8, 4  # orderings, places met on each side, neighbours kept of one ordering
BITS = 63  # projections of an ordering
SPAN = 256  # nodes that list one node and meet in one task
ROUNDS, SETTLED = 10, 0.02  # rounds at most, and the share of new entries that ends them
BLOCK = 1024  # members of a crowd's block
AUDITED, TARGET, TRIES = 512, 0.99, 3
ENTRY = "struct<score:float,nbr:bigint,sure:boolean,fresh:boolean>"


# Nodes and sketches

def nodes_of(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(id, vec), the distinct rows, with a null vector where it takes no part; and (node, first, n, vec), the distinct vectors."""
    usable = ("size(vec) > 0 and forall(vec, x -> x is not null and x = x and abs(x) < double('infinity')) "
              "and exists(vec, x -> x <> 0)")
    rows = (vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
            .filter("id is not null").withColumn("vec", F.expr(f"if(coalesce({usable}, false), transform(vec, x -> x + 0.0D), null)")))
    rows = stage(rows.distinct(), "rows")  # adding 0 makes -0 a 0
    distinct = (rows.filter("vec is not null").groupBy("vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                .withColumn("node", F.monotonically_increasing_id()))
    return rows, stage(distinct.select("node", "first", "n", "vec"), "nodes")


def units(vec: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, unit vectors) for each length in a column of vectors."""
    sizes = np.diff(vec.offsets.to_numpy())
    flat, starts = vec.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        data = flat[starts[places][:, None] + np.arange(size)]
        data = data / np.abs(data).max(axis=1, keepdims=True)
        out.append((places, data / np.linalg.norm(data, axis=1, keepdims=True)))
    return out


def sketches(data: np.ndarray) -> np.ndarray:
    """Bytes of each unit vector: scale, error (both 32-bit floats) and the components in 8 bits."""
    scale = (np.abs(data).max(axis=1) / 127).astype(np.float32)
    whole = np.clip(np.rint(data / scale[:, None].astype(float)), -127, 127).astype(np.int8)
    error = np.linalg.norm(data - whole * scale[:, None].astype(float), axis=1).astype(np.float32) * np.float32(1.0001)
    return np.concatenate([scale[:, None].view(np.uint8), error[:, None].view(np.uint8), whole.view(np.uint8)], axis=1)


def _unpacked(sketch: np.ndarray):
    """(components, scale, error) from rows of bytes; whole numbers, so products are exact in the type chosen."""
    scale, error = (np.ascontiguousarray(sketch[:, a:a + 4]).view(np.float32)[:, 0] for a in (0, 4))
    kind = np.float32 if (sketch.shape[1] - 8) * 127 * 127 < 1 << 24 else np.float64
    return sketch[:, 8:].view(np.int8).astype(kind), scale, error


def _bounds(dot, scale_a, scale_b, error_a, error_b):
    """Upper bound of the cosine and how far the lower one lies below it; the same for (a, b) and (b, a)."""
    error = error_a + error_b + 3 * (error_a * error_b) + np.float32(1e-5)
    return (dot * (scale_a * scale_b) + error).astype(np.float32), 2 * error


def _bytes_of(column: pa.Array) -> np.ndarray:
    """A column of byte strings of one length as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _entries(node, nbr, score, sure):
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(nbr, pa.int64()), pa.array(score, pa.float32()),
                                       pa.array(sure, pa.bool_())], names=["node", "nbr", "score", "sure"])


FOUND = "node long, nbr long, score float, sure boolean"


def _worth(score, allowed, bound, room, threshold):
    """Which scores a row keeps: its best above the bound, `room` at most, and its least link."""
    score = np.where(allowed, score, -2)
    wanted = score > bound[:, None]
    if score.shape[1] > room.min(initial=LARGEST):
        rank = np.argsort(np.argsort(-score, axis=1, kind="stable"), axis=1, kind="stable")
        wanted &= rank < room[:, None]
    links = np.where(score >= threshold, score, 3)
    if links.shape[1]:
        least = links.argmin(axis=1)
        wanted[np.arange(len(score)), least] |= links[np.arange(len(score)), least] < 3
    return wanted


# First lists

def orderings(sketched: DataFrame, orders: range, threshold: float) -> DataFrame:
    """(node, nbr, score, sure): the best of those that stand next to a node in each random ordering."""

    def place(batches):
        for batch in batches:
            for places, data in units(batch.column("vec")):
                for order in orders:
                    turn = np.random.default_rng([7, order, data.shape[1]]).normal(size=(data.shape[1], BITS))
                    signs = (data @ turn > 0) @ (1 << np.arange(BITS - 1, -1, -1))
                    some = pa.array(places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(places), order, np.int32)), pa.array(np.full(len(places), data.shape[1], np.int32)),
                         pa.array(signs), batch.column("node").take(some), batch.column("sketch").take(some)],
                        names=["ordering", "size", "place", "node", "sketch"])

    keyed = sketched.select("node", "vec", "sketch").mapInArrow(
        place, "ordering int, size int, place long, node long, sketch binary")
    order = ["ordering", "size", "place", "node"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def meet(batches):
        kept = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("ordering", "size")], axis=1)
            cuts = np.flatnonzero(np.any(np.diff(keys, axis=0) != 0, axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                now = tuple(keys[a])
                node, sketch = batch.column("node").to_numpy()[a:b], _bytes_of(batch.column("sketch").slice(a, b - a))
                before = 0
                if kept is not None and kept[0] == now:
                    before = len(kept[1])
                    node, sketch = np.concatenate([kept[1], node]), np.concatenate([kept[2], sketch])
                kept = now, node[-REACH:], sketch[-REACH:]
                yield beside(node, sketch, before)

    def beside(node, sketch, before):
        whole, scale, error = _unpacked(sketch)
        n = len(node)
        score, low = np.full((n, 2 * REACH), -2, np.float32), np.full((n, 2 * REACH), -2, np.float32)
        other = np.zeros((n, 2 * REACH), np.int64)
        for o in range(1, min(REACH, n - 1) + 1):
            dot = np.einsum("ij,ij->i", whole[:-o], whole[o:])
            up, width = _bounds(dot, scale[:-o], scale[o:], error[:-o], error[o:])
            up[:max(before - o, 0)] = -2  # both were here before
            for rows, at, them in ((slice(0, n - o), o - 1, node[o:]), (slice(o, n), REACH + o - 1, node[:-o])):
                score[rows, at], low[rows, at], other[rows, at] = up, up - width, them
        wanted = _worth(score, score > -2, np.full(n, -2.0), np.full(n, KEEP), threshold)
        i, j = np.nonzero(wanted)
        return _entries(node[i], other[i, j], score[i, j], low[i, j] >= threshold)

    return dealt.mapInArrow(meet, FOUND)


def merged(graph: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """The lists with what was found: graph(node, room, near, far), the best entries and the most distant link met."""
    more = found.groupBy("node").agg(F.collect_set(F.struct("score", "nbr", "sure")).alias("more"))  # at most a few hundred
    every = ("concat(transform(near, x -> named_struct('score', x.score, 'nbr', x.nbr, 'sure', x.sure, 'fresh', false)), "
             "transform(filter(coalesce(more, array()), y -> not array_contains(near.nbr, y.nbr)), "
             "y -> named_struct('score', y.score, 'nbr', y.nbr, 'sure', y.sure, 'fresh', true)))")
    rows = graph.join(more, "node", "left").withColumn("every", F.sort_array(F.expr(every), asc=False))
    far = f"array_min(filter(concat(array(far), transform(every, x -> named_struct('score', x.score, 'nbr', x.nbr))), x -> x.score >= float({threshold})))"
    return rows.select("node", "room", F.expr("slice(every, 1, room)").alias("near"), F.expr(far).alias("far"))


# Rounds

def _groups(batches, keys):
    """The rows of each key, in order, as one batch; rows come sorted by key."""
    held = []
    for batch in batches:
        marks = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
        cuts = np.flatnonzero(np.any(np.diff(marks, axis=0) != 0, axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(marks)]):
            if a == b:
                continue
            if held and held[0][0] != tuple(marks[a]):
                yield pa.Table.from_batches([h[1] for h in held]).combine_chunks()
                held = []
            held.append((tuple(marks[a]), batch.slice(a, b - a)))
    if held:
        yield pa.Table.from_batches([h[1] for h in held]).combine_chunks()


def descended(graph: DataFrame, sketched: DataFrame, threshold: float) -> DataFrame:
    """(node, nbr, score, sure): what nodes that meet at a common neighbour find of each other."""
    links = graph.select("node", F.inline("near")).select("node", "nbr", "fresh")
    # A node that more than SPAN others list meets them in several groups, with its own list in each.
    listed = stage(links.groupBy("nbr").agg(F.count(F.lit(1)).alias("by")).filter(F.col("by") > SPAN)
                   .select(F.col("nbr").alias("at"), F.ceil(F.col("by") / SPAN).cast("int").alias("salts")), "hubs")
    own = (links.select(F.col("node").alias("at"), F.col("nbr").alias("node"), "fresh").join(listed, "at", "left")
           .withColumn("salt", F.explode(F.expr("sequence(0, coalesce(salts, 1) - 1)"))))
    others = (links.select(F.col("nbr").alias("at"), "node", "fresh").join(listed, "at", "left")
              .withColumn("salt", F.pmod(F.xxhash64("node"), F.coalesce("salts", F.lit(1))).cast("int")))
    full = "if(size(near) = room, near[room - 1].score, float(-2))"
    known = graph.select("node", "room", F.expr(full).alias("bound")).join(sketched.select("node", "sketch"), "node")
    dealt = own.unionByName(others).select("at", "salt", "node", "fresh").join(known, "node")
    dealt = dealt.repartition("at", "salt").sortWithinPartitions("at", "salt", "node")

    def meet(batches):
        for group in _groups(batches, ("at", "salt")):
            fresh = group.column("fresh").to_numpy()
            if not fresh.any():
                continue
            node, first = np.unique(group.column("node").to_numpy(), return_index=True)
            new = np.logical_or.reduceat(fresh, first)  # in order of the node
            whole, scale, error = _unpacked(_bytes_of(group.column("sketch").take(pa.array(first)).combine_chunks()))
            score, width = _bounds(whole @ whole.T, scale[:, None], scale[None, :], error[:, None], error[None, :])
            allowed = (new[:, None] | new[None, :]) & ~np.eye(len(node), dtype=bool)
            bound, room = (group.column(c).to_numpy()[first] for c in ("bound", "room"))
            i, j = np.nonzero(_worth(score, allowed, bound, room, threshold))
            yield _entries(node[i], node[j], score[i, j], (score - width)[i, j] >= threshold)

    return dealt.mapInArrow(meet, FOUND)


def _saturated(threshold: float) -> str:
    return f"size(near) = room and near[room - 1].score >= float({threshold})"


def refined(graph: DataFrame, sketched: DataFrame, threshold: float) -> DataFrame:
    """Rounds until few entries are new and no list that may grow is full of links."""
    for _ in range(ROUNDS):
        graph = stage(merged(graph, descended(graph, sketched, threshold), threshold), "graph")
        grows = F.expr(f"{_saturated(threshold)} and room < {LARGEST}")
        told = graph.agg(F.sum(F.expr("size(filter(near, x -> x.fresh))")), F.sum(F.size("near")), F.count_if(grows)).first()
        if told[2]:
            again = F.when(grows, F.expr("transform(near, x -> named_struct('score', x.score, 'nbr', x.nbr, 'sure', x.sure, 'fresh', true))"))
            graph = graph.select("node", F.when(grows, LARGEST).otherwise(F.col("room")).alias("room"),
                                 again.otherwise(F.col("near")).alias("near"), "far")
        elif (told[0] or 0) <= SETTLED * (told[1] or 0):
            break
    return graph


# Links

def crowds(graph: DataFrame, threshold: float) -> DataFrame:
    """(node, crowd) of the nodes that hang together through lists full of links."""
    full = graph.filter(_saturated(threshold)).select("node", F.explode(F.expr("concat(near.nbr, array(far.nbr))")).alias("nbr"))
    found = components(full.select(F.col("node").alias("a"), F.col("nbr").alias("b")))
    return stage(found.select(F.col("id").alias("node"), F.col("root").alias("crowd")), "crowds")


def listed_links(graph: DataFrame, crowd: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: the links of lists that are not inside one crowd; doubtful ones are compared in doubles."""
    found = graph.select("node", F.inline("near")).select("node", "nbr", "score", "sure")
    found = found.filter(F.col("score") >= F.lit(threshold).cast("float"))
    pairs = (found.select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b"), "sure")
             .groupBy("a", "b").agg(F.max("sure").alias("sure")))
    for side in ("a", "b"):
        pairs = pairs.join(crowd.select(F.col("node").alias(side), F.col("crowd").alias(f"crowd_{side}")), side, "left")
    pairs = stage(pairs.filter("not coalesce(crowd_a = crowd_b, false)").select("a", "b", "sure"), "pairs")
    doubtful = pairs.filter(~F.col("sure")).select("a", "b")
    for side in ("a", "b"):
        doubtful = doubtful.join(nodes.select(F.col("node").alias(side), F.col("vec").alias(f"vec_{side}")), side)

    def compare(batches):
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            sides = [units(batch.column(c)) for c in ("vec_a", "vec_b")]
            other = {data.shape[1]: data for _, data in sides[1]}
            for places, data in sides[0]:  # linked pairs are of one length
                linked[places] = np.einsum("ij,ij->i", data, other[data.shape[1]]) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return pairs.filter("sure").select("a", "b").unionByName(
        doubtful.select("a", "b", "vec_a", "vec_b").mapInArrow(compare, "a long, b long"))


def crowd_links(crowd: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (a, b): how many vectors each member links with in its crowd, and which members hang together."""

    def sign(batches):
        for batch in batches:
            signs = np.zeros(batch.num_rows, np.int64)
            for places, data in units(batch.column("vec")):
                turn = np.random.default_rng([8, data.shape[1]]).normal(size=(data.shape[1], BITS))
                signs[places] = (data @ turn > 0) @ (1 << np.arange(BITS - 1, -1, -1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs)], names=[*batch.schema.names, "place"])

    members = nodes.join(crowd, "node").select("crowd", "node", "n", "vec").mapInArrow(
        sign, "crowd long, node long, n long, vec array<double>, place long")
    order = ["crowd", "place", "node"]

    def pack(batches):
        part, count = TaskContext.get().partitionId(), 0
        for group in _groups(batches, ("crowd",)):
            for at in range(0, group.num_rows, BLOCK):
                block = group.slice(at, BLOCK).combine_chunks()
                data = np.concatenate([d for _, d in units(block.column("vec").combine_chunks())])
                numbers = np.stack([block.column(c).to_numpy() for c in ("node", "n")], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [block.column("crowd").combine_chunks().slice(0, 1), pa.array([(part << 32) + count]),
                     *[pa.array([m.tobytes()], pa.binary()) for m in (numbers, data)]], names=["crowd", "pack", "numbers", "data"])
                count += 1

    blocks = stage(members.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pack, "crowd long, pack long, numbers binary, data binary"), "packs")
    numbered = blocks.select("crowd", "pack").withColumn("number", F.row_number().over(W.partitionBy("crowd").orderBy("pack")))
    blocks = stage(blocks.join(numbered, ["crowd", "pack"]).drop("pack"), "blocks")
    last = blocks.groupBy("crowd").agg(F.max("number").alias("last"))
    dealt = (blocks.select("crowd", F.col("number").alias("mine"), F.col("numbers").alias("our_numbers"), F.col("data").alias("our_data"))
             .join(last, "crowd").withColumn("number", F.explode(F.expr("sequence(mine, last)"))).drop("last"))
    pairs = dealt.join(blocks, ["crowd", "number"])

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (ours, our_data), (theirs, their_data) = (
                    (np.frombuffer(row[a], np.int64).reshape(-1, 2), np.frombuffer(row[b], float)) for a, b in
                    (("our_numbers", "our_data"), ("numbers", "data")))
                linked = our_data.reshape(len(ours), -1) @ their_data.reshape(len(theirs), -1).T >= threshold
                if row["mine"] == row["number"]:
                    linked |= linked.T
                    np.fill_diagonal(linked, True)
                    yield told(ours[:, 0], linked @ ours[:, 1] - ours[:, 1], least(linked, ours[:, 0], ours[:, 0])[0])
                    continue
                mine, others = least(linked, ours[:, 0], theirs[:, 0])
                yield told(ours[:, 0], linked @ theirs[:, 1], mine)
                yield told(theirs[:, 0], linked.T @ ours[:, 1], others)

    def least(linked, ours, theirs):
        """The smallest node that each of ours and theirs hangs together with."""
        mine, others = ours.copy(), theirs.copy()
        none = np.iinfo(np.int64).max
        while True:
            now = np.minimum(mine, np.where(linked, others[None, :], none).min(axis=1, initial=none))
            then = np.minimum(others, np.where(linked, now[:, None], none).min(axis=0, initial=none))
            if np.array_equal(now, mine) and np.array_equal(then, others):
                return mine, others
            mine, others = now, then

    def told(node, links, root):
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64)), pa.array(root)], names=["node", "links", "root"])

    counted = stage(pairs.mapInArrow(count, "node long, links long, root long"), "counted")
    return (counted.groupBy("node").agg(F.sum("links").alias("links")),
            counted.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))


def links_of(graph: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (a, b): the number of vectors each node links with, and links that hold its component together."""
    crowd = crowds(graph, threshold)
    listed = stage(listed_links(graph, crowd, nodes, threshold), "links")
    inside, together = crowd_links(crowd, nodes, threshold)
    both = listed.unionByName(listed.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = nodes.select(F.col("node").alias("b"), "n")
    counted = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    counts = counted.unionByName(inside).groupBy("node").agg(F.sum("links").alias("links"))
    return stage(counts, "counts"), listed.unionByName(together)


def recall(nodes: DataFrame, counts: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Mean share of links found, over nodes with links among at most `audited` of all and as many of those with a link found."""
    mixed = F.xxhash64("node")
    known = nodes.join(counts, "node", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    some = [part.orderBy(mixed, "node").limit(audited) for part in (known, known.filter("links > 0"))]
    rows = some[0].unionByName(some[1]).select("node", "links", "vec").distinct().collect()  # the bounded sample
    if not rows:
        return 1.0
    asked = [np.array(r.vec) / np.abs(r.vec).max() for r in rows]
    by_size = {}
    for place, v in enumerate(asked):
        by_size.setdefault(len(v), []).append((place, v / np.linalg.norm(v)))
    by_size = {size: (np.array([p for p, _ in of]), np.stack([v for _, v in of])) for size, of in by_size.items()}

    def count(batches):
        total = np.zeros(len(rows_numbers), np.int64)
        for batch in batches:
            weights = batch.column("n").to_numpy()
            for places, data in units(batch.column("vec")):
                if data.shape[1] in by_size:
                    at, vectors = by_size[data.shape[1]]
                    total[at] += (vectors @ data.T >= threshold) @ weights[places]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "links"])

    rows_numbers = [r.node for r in rows]
    own = {r.node: r.n for r in nodes.filter(F.col("node").isin(rows_numbers)).select("node", "n").collect()}
    truth = nodes.select("vec", "n").mapInArrow(count, "place long, links long").groupBy("place").agg(F.sum("links").alias("links")).collect()
    shares = [min(1.0, rows[t.place].links / (t.links - own[rows_numbers[t.place]])) for t in truth
              if t.links > own[rows_numbers[t.place]]]
    return float(np.mean(shares)) if shares else 1.0


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept): links of each vector, and the smallest id that it can reach through links."""
    rows, nodes = nodes_of(vectors, key, vector)

    def sketch(batches):
        for batch in batches:
            out = [None] * batch.num_rows
            for places, data in units(batch.column("vec")):
                for place, row in zip(places, sketches(data)):
                    out[place] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=["node", "vec", "sketch"])

    sketched = stage(nodes.select("node", "vec").mapInArrow(sketch, "node long, vec array<double>, sketch binary"), "sketches")
    graph = nodes.select("node", F.lit(ROOM).alias("room"), F.array().cast(f"array<{ENTRY}>").alias("near"),
                         F.lit(None).cast("struct<score:float,nbr:bigint>").alias("far"))
    first = 0
    for attempt in range(TRIES):
        orders = range(first, first + (ORDERS << attempt))
        first = orders.stop
        graph = stage(merged(graph, orderings(sketched, orders, threshold), threshold), "graph")
        graph = refined(graph, sketched, threshold)
        counts, held = links_of(graph, nodes, threshold)
        if recall(nodes, counts, threshold) >= TARGET:
            break
    roots = components(held).withColumnRenamed("id", "node")
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = stage(placed.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    placed = (placed.join(least, "root").join(counts, "node", "left")
              .select("vec", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    told = rows.join(stage(placed, "placed"), "vec", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return told.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                       (F.col("id") == F.col("component_id")).alias("kept"))
