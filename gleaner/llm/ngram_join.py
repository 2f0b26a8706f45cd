"""N-gram Jaccard join: texts whose sets of word 5-grams are alike, by MinHash values compared step by step.

Texts that agree in a band of MinHash values are neighbours. Neighbours, and neighbours of neighbours, form a family, and
a family is compared in blocks of bounded size: a pair's MinHash values are compared in steps, the pair is dropped
as soon as the posterior probability that its similarity reaches the threshold falls below a tolerance, and every pair
that is left is verified exactly on its whole sets. Only the number of links of each text and a spanning forest leave a
block, so a group of near copies never turns into rows of pairs.

At the default 32 bands of 4 values, a pair at a similarity of 0.8 shares no band with a probability of 5e-8; a pair at
the threshold is dropped with a probability near the tolerance, 1e-7.

A text of fewer than n words has one n-gram, all its words. Texts without words (null, empty) are alike to each other. A
row without id is alike to nothing, and its class is null. Texts with equal sets are one node, known by the set's digest;
rows that share an id are one document, so their texts' classes are joined, while each text is compared. An empty table gives an empty result. Other columns are not read.
"""

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.components import components
from gleaner.sources.staging import stage

VALUES, BAND, STEP = 128, 4, 32  # MinHash values, values of a band, values compared at a time
BLOCK = 1_000_000  # n-grams and MinHash values that a block may hold


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int, n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


BASE = np.uint64(0x100000001B3)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
TIMES, PLUS = _keys(1, VALUES), _keys(2, VALUES)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers of the polynomial hash's base and of its inverse, as far as the longest text so far needs them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", BACK)):
                power = np.full(2 * n, base)
                power[0] = 1
                setattr(self, name, np.multiply.accumulate(power))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def ngrams(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; words are runs of characters other than ASCII white space."""
    data = np.frombuffer(text.encode(), np.uint8)
    inside = ~SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = POWERS.to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    words = _mix((total[end] - total[start]) * down[start])
    width = min(n, len(words))
    place = _keys(3, width)
    grams = sum(words[k:len(words) - width + 1 + k] * place[k] for k in range(width))
    return np.unique(_mix(grams + np.uint64(width)))


def minhash(grams: np.ndarray) -> np.ndarray:
    """VALUES MinHash values of a set, 32 bits each."""
    least = np.full(VALUES, np.iinfo(np.uint64).max)
    for at in range(0, len(grams), 2048):
        part = grams[at:at + 2048]
        np.minimum(least, (part[None, :] * TIMES[:, None] + PLUS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band of MinHash values."""
    rows = values.reshape(-1, BAND).astype(np.uint64)
    folded = (rows * _keys(4, BAND)[None, :]).sum(axis=1, dtype=np.uint64)
    return _mix(folded + _keys(5, len(rows))).astype(np.int64)


def least_matches(threshold: float, tolerance: float, step: int = STEP) -> list[int]:
    """For each multiple of `step` values, the fewest equal ones at which a pair stays.

    With a uniform prior, m of n equal values leave Beta(m + 1, n - m + 1); its part above the threshold t is the
    probability of at most m successes among n + 1 draws of probability t.
    """
    def likely(m: int, n: int) -> float:
        return math.fsum(math.comb(n + 1, k) * threshold ** k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))
    return [next((m for m in range(n + 1) if likely(m, n) >= tolerance), n) for n in range(step, VALUES + 1, step)]


def _grams_of(batches, n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    # The text is the last column; a thousand texts at a time.
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            yield part, [ngrams(t.as_py() or "", n) for t in part.column(part.num_columns - 1)]


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
                       F.col(text).alias("text"))


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5) -> DataFrame:
    """(id, text_hash, set_key, n_grams, bands) of each row: a digest of the set, its size, and the bands, null without words."""
    def run(batches):
        for part, sets in _grams_of(batches, n):
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([bands(minhash(s)) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["id", "text_hash", "set_key", "n_grams", "bands"])
    return _texts(docs, key, text).mapInArrow(
        run, "id bigint, text_hash bigint, set_key binary, n_grams bigint, bands array<bigint>")


def _sorted_groups(batches, columns: list[str]):
    """Rows of sorted batches, as (key, list of rows) per value of `columns`, across batch borders."""
    held, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[c] for c in columns)
            if key != held:
                if rows:
                    yield held, rows
                held, rows = key, []
            rows.append(row)
    if rows:
        yield held, rows


def compare(rows: list[dict], crossed: bool, threshold: float, tolerance: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each row, counted in documents, and a spanning forest; `crossed`: only pairs between two blocks."""
    share, cutoffs = Fraction(str(threshold)), least_matches(threshold, tolerance)
    sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
    values = np.stack([np.frombuffer(r["minhash"], np.uint32) for r in rows])
    size = np.array([len(s) for s in sets])
    copies, block = np.array([r["copies"] for r in rows]), np.array([r["block"] for r in rows])
    distinct, place = np.unique(np.concatenate(sets), return_inverse=True)
    place = np.split(place, np.cumsum(size)[:-1])
    links, parent, forest = np.zeros(len(rows), np.int64), list(range(len(rows))), []
    marked = np.zeros(len(distinct), bool)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows) - 1):
        later = np.arange(i + 1, len(rows))
        least, most = np.minimum(size[later], size[i]), np.maximum(size[later], size[i])
        possible = least * share.denominator >= most * share.numerator
        if crossed:
            possible &= block[later] != block[i]
        later = later[possible]
        equal = np.zeros(len(later), np.int64)
        for at, cutoff in zip(range(0, VALUES, STEP), cutoffs):
            if not len(later):
                break
            equal += (values[later, at:at + STEP] == values[i, at:at + STEP]).sum(axis=1)
            stay = equal >= cutoff
            later, equal = later[stay], equal[stay]
        if not len(later):
            continue
        marked[place[i]] = True
        common = np.array([np.count_nonzero(marked[place[j]]) for j in later])
        marked[place[i]] = False
        found = later[common * (share.denominator + share.numerator) >= share.numerator * (size[later] + size[i])]
        links[i] += copies[found].sum()
        links[found] += copies[i]
        for j in found.tolist():
            if (a := root(i)) != (b := root(j)):
                parent[b] = a
                forest.append((i, j))
    return links, forest


def _verified(members: DataFrame, docs: DataFrame, key: str, text: str, n: int, threshold: float, tolerance: float):
    """Rows (set_key, a, b, links): links of a text counted in documents (a and b null), and links a-b, in ids, of a forest."""
    def sets(batches):
        for part, grams in _grams_of(batches, n):
            same = [len(g) > 0 and hashlib.blake2b(g.tobytes(), digest_size=16).digest() == k.as_py()
                    for g, k in zip(grams, part.column("set_key"))]
            kept = [g for g, s in zip(grams, same) if s]
            rest = part.filter(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*(rest.column(c) for c in ("id", "set_key", "root", "blocks", "copies")), pa.array([g.tobytes() for g in kept], pa.binary()),
                 pa.array([minhash(g).tobytes() for g in kept], pa.binary())],
                names=["id", "set_key", "root", "blocks", "copies", "grams", "minhash"])

    def run(batches):
        for (_, one, two), rows in _sorted_groups(batches, ["root", "one", "two"]):
            rows = list({r["set_key"]: r for r in rows}.values())  # a row that the table repeats
            links, forest = compare(rows, one != two, threshold, tolerance)
            ids = [r["id"] for r in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array([r["set_key"] for r in rows] + [None] * len(forest), pa.binary()),
                pa.array([None] * len(ids) + [ids[i] for i, _ in forest], pa.int64()),
                pa.array([None] * len(ids) + [ids[j] for _, j in forest], pa.int64()),
                pa.array(links.tolist() + [0] * len(forest), pa.int64())], names=["set_key", "a", "b", "links"])

    # By the text's hash too, so that an id of many texts brings each of its members one text.
    rows = members.join(_texts(docs, key, text), ["id", "text_hash"]).select(
        "id", "root", "blocks", "copies", "set_key", "text").mapInArrow(
        sets, "id bigint, set_key binary, root binary, blocks int, copies bigint, grams binary, minhash binary")
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    # Each block meets every block of its family once, itself included.
    pairs = (rows.withColumn("block", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}))
    dealt = pairs.drop("blocks", "other").repartition("root", "one", "two").sortWithinPartitions("root", "one", "two", "set_key")
    return dealt.mapInArrow(run, "set_key binary, a bigint, b bigint, links bigint")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, n: int = 5,
            tolerance: float = 1e-7) -> DataFrame:
    """One row per document: key, class_id, text_id, n_links.

    class_id is the smallest id that a document is linked to, directly or through others; text_id is the smallest id
    with the same set of n-grams; n_links is the number of other documents with a similarity of at least `threshold`.
    """
    rows = stage(signatures(docs, key, text, n), "signatures")
    named = rows.filter(F.col("id").isNotNull())
    texts = stage(named.groupBy("set_key").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.count(F.lit(1)).alias("copies"))
                  .select("set_key", F.col("first.id").alias("text_id"), F.col("first.text_hash").alias("first_hash"), "copies"), "texts")
    firsts = named.join(texts, "set_key").filter("id = text_id and text_hash = first_hash")

    banded = firsts.select("set_key", F.explode("bands").alias("band"))
    # The aggregated side of each join is written, so that adaptive execution can split a hot band, family, id or set.
    buckets = stage(banded.groupBy("band").agg(F.min("set_key").alias("first"), F.max("set_key").alias("last"))
                    .filter("first < last").select("band", "first"), "buckets")
    near = banded.join(buckets, "band").select(F.col("first").alias("a"), F.col("set_key").alias("b"))
    families = stage(components(near).withColumnRenamed("id", "set_key"), "families")

    sized = families.join(firsts.select("id", "text_hash", "set_key", "copies", "n_grams"), "set_key")
    loads = stage(sized.groupBy("root").agg(F.ceil(F.sum(F.col("n_grams") + VALUES) / BLOCK).cast("int").alias("blocks")), "loads")
    members = sized.join(loads, "root").drop("n_grams")
    found = stage(_verified(members, docs, key, text, n, threshold, tolerance), "verified")

    # An id with several texts is one document: its texts are linked.
    shared = named.join(texts, "set_key").filter("id <> text_id").groupBy("id", "text_id").count()
    twice = stage(named.groupBy("id").agg(F.countDistinct("set_key").alias("n")).filter("n > 1").select("id"), "twice")
    same_id = shared.join(twice, "id").select(F.col("id").alias("a"), F.col("text_id").alias("b"))
    roots = stage(components(found.filter("b is not null").select("a", "b").union(same_id)), "roots")
    links = found.filter("b is null").groupBy("set_key").agg(F.sum("links").alias("links"))
    marked = stage(texts.join(roots.withColumnRenamed("id", "text_id"), "text_id", "left")
                   .join(links, "set_key", "left")
                   .select("set_key", "text_id", F.coalesce("root", "text_id").alias("root"),
                           (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
                   .filter("n_links > 0 or root <> text_id"), "marked")
    linked = rows.select("id", F.when(F.col("id").isNotNull(), F.col("set_key")).alias("set_key")).join(marked, "set_key", "left")
    return linked.select(F.col("id").alias(key), F.coalesce("root", "id").alias("class_id"),
                         F.coalesce("text_id", "id").alias("text_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row of each class of similar texts, with all its columns; rows without id stay as they are.

    Rows are compared, not ids: an id with unrelated texts keeps a row of each, equal rows become one. The smallest id stays,
    then the smallest hash of the text and of the whole row, so the choice does not depend on how the rows are dealt.
    """
    row = "row_number"
    while row.lower() in map(str.lower, docs.columns):
        row += "_"
    # Written, so that every reader sees the same numbers.
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    named = rows.filter(F.col(key).isNotNull())
    found = classes(named.select(F.col(row).alias("row"), F.col(text).alias("text")), "row", "text", threshold)
    order = F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("text"), F.xxhash64(*docs.columns).alias("all"), F.col(row).alias("row"))
    # Classes of one row have nobody to leave.
    ranked = stage(found.select("row", "class_id").join(named.select(F.col(row).alias("row"), order.alias("order")), "row"), "ranked")
    firsts = stage(ranked.groupBy("class_id").agg(F.min("order").alias("first"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").select("class_id", F.col("first.row").alias("first")), "firsts")
    dropped = stage(ranked.join(firsts, "class_id").filter(F.col("row") != F.col("first")).select(F.col("row").alias(row)), "dropped")
    return rows.join(dropped, row, "left_anti").select(docs.columns)
