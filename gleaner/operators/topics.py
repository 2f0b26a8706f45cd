"""Topic models of several sizes at once, by expectation-maximisation on blocks of records.

The update is that of Spark ML's EM optimizer with its default priors: an occurrence of word w in record j belongs to topic t
in proportion to (N_wt + 0.1) (N_jt + 50 / k) / (N_t + 0.1 V). Models share the passes over the records in groups of at most
`WIDTH` topics: their topics stand side by side in one matrix, and each model's shares add up to 1. One group is fitted after
the other, as the counts of all models at once would take several times the space of the records.

A block holds the occurrences of its records and the counts of the words that no other block has. The counts of all other
words are summed by part of the vocabulary and sent to the blocks that hold the word, so no task holds the whole vocabulary and
none of it comes to the driver. Between passes only the sums are written, once for each word. The first shares are drawn by
hash of seed, record, word and topic, so they are the same however the rows lie. Counts travel in single precision; shares are
taken in it and summed in double precision.

Inside a block, occurrences stand in chunks, by word: the j-th occurrences of all words of a chunk that have as many follow
each other in the order of the words, so the words' rows are read and added to as they lie. Words with more than `HEAVY`
occurrences in a chunk come first, each with all of its own.
"""

from contextlib import ExitStack, contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from gleaner.sources.staging import scratch, stage

BLOCK, LEAST = 2_500_000, 1_000_000  # occurrences of a block, at most on average and at least where cores would be idle
WIDTH = 20  # topics that are fitted at a time, unless one model has more
CHUNK, TILE, HEAVY = 1 << 18, 1 << 12, 64
HEAD, LONGEST = 100_000, 64  # words that are looked up by broadcast, and their longest in bytes
ETA = 0.1
DOCS, LOCAL, SHARED, TOTALS = range(4)
INDEX, WORDS, EDGES = range(3)
STATIC = "block int, kind int, at int, slots binary, n binary, docs binary, words binary"
MOVING = "target int, kind int, source int, ids binary, counts binary"
STATE = "target int, kind int, ids binary, counts binary, to array<int>, places array<binary>"
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}  # rows hold up to a few MB
PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}  # shares and counts don't compress


@contextmanager
def _settings(spark, values):
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _table(rows, names, types):
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names=names)


def _static(rows):
    return _table(rows, ["block", "kind", "at", "slots", "n", "docs", "words"], [pa.int32()] * 3 + [pa.binary()] * 4)


def _moving(rows):
    return _table(rows, ["target", "kind", "source", "ids", "counts"], [pa.int32()] * 3 + [pa.binary()] * 2)


def _slices(ends, data):
    """A binary column of slices of an array, not copied, by where each of them ends and the next begins in bytes."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _state(rows):
    return _table(rows, ["target", "kind", "ids", "counts", "to", "places"],
                  [pa.int32()] * 2 + [pa.binary()] * 2 + [pa.list_(pa.int32()), pa.list_(pa.binary())])


def _bytes(row, column, kind):
    return np.frombuffer(row[column].as_buffer(), kind)


def _rows(table):
    """Rows as dicts of Arrow values, whose bytes are not copied."""
    names, columns = table.column_names, [c for c in table.columns]
    return [{name: c[i] for name, c in zip(names, columns)} for i in range(table.num_rows)]


def _runs(batches, count):
    """(place of the block, doc, entry, df) of at most `CHUNK` rows of one block, from batches (doc, entry, df) sorted by doc."""
    held, size, block = [], 0, None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        blocks = ((columns[0] >> 33) + (1 << 30)) * count >> 31
        for cut in np.split(np.arange(len(blocks)), np.flatnonzero(np.diff(blocks)) + 1):
            while len(cut):
                if held and (blocks[cut[0]] != block or size == CHUNK):
                    yield block, *map(np.concatenate, zip(*held))
                    held, size = [], 0
                block, some = int(blocks[cut[0]]), cut[:CHUNK - size]
                held.append([c[some[0]:some[-1] + 1] for c in columns])
                size, cut = size + len(some), cut[len(some):]
    if held:
        yield block, *map(np.concatenate, zip(*held))


def _narrow(n):
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if n.max() <= np.iinfo(k).max)
    return n.astype(kind).tobytes()


def _pack(keys):
    """A function of batches (doc, entry, df) sorted by doc: each block's chunks, their words, and an index of both."""
    def index(block, docs, chunks):
        words = np.unique(np.concatenate([c[0] for c in chunks]))
        found, df = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for own, counts, own_df in chunks:
            at = np.searchsorted(words, own)
            found[at] += counts
            df[at] = own_df
        # Shared words first, in order of their part; the order in which the parts' counts are put together.
        part = np.where(found == df, len(keys), words % len(keys)).astype(np.int64)
        order = np.argsort(part << 32 | words)
        cuts = np.searchsorted(part[order], np.arange(len(keys) + 2))
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        yield _static([(block, INDEX, 0, cuts.tobytes(), b"", np.array(docs, np.int64).tobytes(), words[order].astype(np.uint32).tobytes())])
        for at, (own, _, _) in enumerate(chunks):
            yield _static([(block, WORDS, at, b"", b"", b"", place[np.searchsorted(words, own)].tobytes())])

    def pack(batches):
        last, docs, chunks = None, [], []
        for place, doc, entry, df in _runs(batches, len(keys)):
            block, number, n = keys[place], entry >> 32, entry & 0xFFFFFFFF
            if block != last and chunks:
                for made in index(last, docs, chunks):
                    yield from made.to_batches()
                docs, chunks = [], []
            last = block
            starts = np.flatnonzero(np.diff(doc, prepend=~doc[0]))
            new = doc[starts[int(bool(docs) and docs[-1] == doc[0]):]].tolist()
            first = len(docs) + len(new) - len(starts)
            docs += new
            words, which, w, counts = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
            by_size = np.argsort(-counts, kind="stable")
            rank = np.empty_like(by_size)
            rank[by_size] = np.arange(len(words))
            w, words, df, counts = rank[w], words[by_size], df[which[by_size]], counts[by_size]
            by_word = np.argsort(w, kind="stable")
            heavy = int(np.searchsorted(-counts, -HEAVY))  # those with more than HEAVY
            turn = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts)  # 0 for the first occurrence of a word
            turn[:counts[:heavy].sum()] = -1
            order = by_word[np.argsort(turn.astype(np.int16), kind="stable")]
            slots = np.empty(len(w), np.int32)
            slots[order] = np.arange(len(w), dtype=np.int32)
            sizes = np.diff(starts, append=len(doc))
            lighter = np.searchsorted(-counts, -np.arange(HEAVY)) - heavy
            yield from _static([(block, EDGES, len(chunks), slots.tobytes(), _narrow(n),
                                 np.r_[first, sizes].astype(np.int32).tobytes(), np.r_[lighter, counts[:heavy]].astype(np.int32).tobytes())]).to_batches()
            chunks.append((words.astype(np.int64), counts, df.astype(np.int64)))
        if chunks:
            for made in index(last, docs, chunks):
                yield from made.to_batches()
    return pack


def _uniform(docs, numbers, topics, seed, first=0):
    """One draw from (0, 1] for each occurrence and topic from `first` on, by a 64-bit mix of both ids and the seed."""
    with np.errstate(over="ignore"):
        x = docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + numbers.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        x = x[:, None] + np.arange(first + 1, first + topics + 1, dtype=np.uint64) * np.uint64(0xABC98388FB8FAC03) + np.uint64(seed)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0 ** -54


def _matrix(row, topics):
    return _bytes(row, "counts", np.float32).reshape(-1, topics)


def _tiles(heavy, sizes):
    """(first slot, end, words) of pieces of a chunk's slots; a slice of words, if each has one slot there.

    `heavy` are the counts of the heavy words, `sizes` says how many of the others have more than 0, 1, ... occurrences.
    """
    words = np.repeat(np.arange(len(heavy)), heavy)
    tiles, at = [(a, min(a + TILE, len(words)), words[a:a + TILE]) for a in range(0, len(words), TILE)], len(words)
    for size in sizes.tolist():
        tiles += [(at + a, at + min(a + TILE, size), slice(len(heavy) + a, len(heavy) + min(a + TILE, size))) for a in range(0, size, TILE)]
        at += size
    return tiles


def _step(ks, blocks, seed, first, totals, size):
    """A function of one block's own rows and those sent to it: the next counts; without totals the first ones."""
    topics = sum(ks)
    model = np.zeros((topics, len(ks)), np.float32)  # which topics are of which model
    model[np.arange(topics), np.repeat(np.arange(len(ks)), ks)] = 1
    alpha = 50 / np.repeat(ks, ks)

    def whole_rows(matrix):  # one item a row, which is faster to put
        return matrix.view(np.dtype((np.void, matrix.itemsize * matrix.shape[1])))[:, 0]

    def step(own, sent):
        rows = {kind: sorted((r for r in _rows(own) if r["kind"].as_py() == kind), key=lambda r: r["at"].as_py()) for kind in range(3)}
        if not rows[INDEX]:
            return _moving([])
        index = rows[INDEX][0]
        block, cuts = index["block"].as_py(), _bytes(index, "slots", np.int64)
        numbers, docs = _bytes(index, "words", np.uint32), _bytes(index, "docs", np.int64)
        if totals is not None:
            # What the parts know of the shared words, in order of the parts, then the words of this block alone.
            sent = sorted(_rows(sent), key=lambda r: r["source"].as_py())
            words = np.concatenate([_matrix(r, topics) for kind in (SHARED, LOCAL) for r in sent if r["kind"].as_py() == kind])
            by_doc = (next(_matrix(r, topics) for r in sent if r["kind"].as_py() == DOCS).astype(float) + alpha).astype(np.float32)
        next_words, next_docs = np.zeros((len(numbers), topics)), np.zeros((len(docs), topics))
        tile = np.empty((TILE, topics), np.float32)
        for edges, held in zip(rows[EDGES], rows[WORDS]):
            slots, places = _bytes(edges, "slots", np.int32).astype(np.int64), _bytes(held, "words", np.int32)
            start, sizes = int(_bytes(edges, "docs", np.int32)[0]), _bytes(edges, "docs", np.int32)[1:]
            counts = _bytes(edges, "words", np.int32)
            n = np.frombuffer(b := edges["n"].as_buffer(), f"u{b.size // len(slots)}").astype(np.float32)
            tiles, record, d = _tiles(counts[HEAVY:], counts[:HEAVY]), np.repeat(np.arange(len(sizes)), sizes), np.empty(len(slots), np.int64)
            d[slots] = record
            word = np.concatenate([np.arange(w.start, w.stop) if isinstance(w, slice) else w for _, _, w in tiles])[slots]
            some, factors = docs[start:start + len(sizes)], np.empty((len(slots), len(ks)), np.float32)
            if totals is not None:
                some, own_words = by_doc[start:start + len(sizes)], ((np.take(words, places, axis=0) + ETA) / (totals + ETA * size)).astype(np.float32)
            starts = np.cumsum(sizes) - sizes
            for a in range(0, len(slots), TILE):  # in the order of the records
                b = min(a + TILE, len(slots))
                if totals is None:
                    shares = _uniform(some[record[a:b]], numbers[places[word[a:b]]], topics, seed, first).astype(np.float32)
                else:
                    shares = np.take(own_words, word[a:b], axis=0, out=tile[:b - a], mode="clip")
                    shares *= np.take(some, record[a:b], axis=0)
                factor = n[a:b, None] / (shares @ model)
                whole_rows(factors)[slots[a:b]] = whole_rows(factor)
                shares *= factor @ model.T
                one, end = record[a], record[b - 1] + 1
                next_docs[start + one:start + end] += np.add.reduceat(shares, np.maximum(starts[one:end] - a, 0), dtype=float)
            heavy = len(counts) - HEAVY
            sums, heavy_sums = np.zeros((len(places), topics), np.float32), np.zeros((heavy, topics))
            for a, b, w in tiles:  # in the order of the words
                if totals is None:
                    shares = _uniform(some[d[a:b]], numbers[places[w]], topics, seed, first).astype(np.float32)
                else:
                    shares = np.take(some, d[a:b], axis=0, out=tile[:b - a], mode="clip")
                shares *= factors[a:b] @ model.T
                if isinstance(w, slice):
                    sums[w] += shares
                else:
                    starts = np.flatnonzero(np.diff(w, prepend=-1))
                    heavy_sums[w[starts]] += np.add.reduceat(shares, starts, dtype=float)
            sums = sums.astype(float)  # of at most HEAVY each
            sums[:heavy] = heavy_sums
            if totals is not None:
                sums *= own_words
            sums += np.take(next_words, places, axis=0)
            whole_rows(next_words)[places] = whole_rows(sums)
        parts = np.flatnonzero(np.diff(cuts))
        # The counts of the parts lie one after the other as they are; they are not copied.
        targets = [(block, LOCAL) if p == len(blocks) else (blocks[p], SHARED) for p in parts.tolist()]
        ends = np.r_[cuts[parts], cuts[parts[-1] + 1]]
        next_words = next_words.astype(np.float32)
        counts = _slices(ends * next_words.itemsize * topics, next_words)
        to_words = pa.table([pa.array(c, pa.int32()) for c in zip(*targets)] + [pa.array([block] * len(targets), pa.int32()),
                            _slices(ends * numbers.itemsize, numbers), counts], names=["target", "kind", "source", "ids", "counts"])
        return pa.concat_tables([to_words, _moving([(block, DOCS, block, b"", next_docs.astype(np.float32).tobytes()),
                                                    (block, TOTALS, block, b"", next_docs.sum(0).tobytes())])])
    return step


def _sum_up(topics):
    """A function of what was sent to one target: its block's own counts, and the sums of its part with who needs which."""
    def sum_up(table):
        rows = sorted(_rows(table), key=lambda r: r["source"].as_py())
        target = rows[0]["target"].as_py()
        made = [(target, r["kind"].as_py(), r["ids"].as_buffer().to_pybytes(), r["counts"].as_buffer().to_pybytes(), [], [])
                for r in rows if r["kind"].as_py() != SHARED]
        rows = [r for r in rows if r["kind"].as_py() == SHARED]
        if rows:
            ids = [_bytes(r, "ids", np.uint32) for r in rows]
            words = np.unique(np.concatenate(ids))
            counts, places = np.zeros((len(words), topics)), [np.searchsorted(words, i).astype(np.int32) for i in ids]
            for at, row in zip(places, rows):
                counts[at] += _matrix(row, topics)
            made.append((target, SHARED, words.tobytes(), counts.astype(np.float32).tobytes(), [r["source"].as_py() for r in rows],
                         [p.tobytes() for p in places]))
        return _state(made)
    return sum_up


def _share_out(blocks, topics):
    """A function of batches of written rows: a part's sums go to each block that has the word, a block's own counts to itself."""
    number = {key: i for i, key in enumerate(blocks)}

    def share_out(batches):
        for batch in batches:
            for r in _rows(pa.Table.from_batches([batch])):
                target, kind = r["target"].as_py(), r["kind"].as_py()
                if kind != SHARED:
                    yield from _moving([(target, kind, target, b"", r["counts"].as_buffer().to_pybytes())]).to_batches()
                    continue
                counts = _matrix(r, topics)
                for to, places in zip(r["to"].as_py(), r["places"]):
                    found = np.take(counts, np.frombuffer(places.as_buffer(), np.int32), axis=0)
                    yield from _moving([(to, SHARED, number[target], b"", found.tobytes())]).to_batches()
    return share_out


def _strongest(topics, num_words):
    """A function of batches of written rows: the `num_words` largest counts of each topic in each row."""
    def strongest(batches):
        for batch in batches:
            for r in _rows(pa.Table.from_batches([batch])):
                words, counts = _bytes(r, "ids", np.uint32).astype(np.int64), _matrix(r, topics).astype(float)
                order = np.argsort(words)  # ties go to the smaller number
                words, counts = words[order], counts[order]
                best = np.argsort(-counts, axis=0, kind="stable")[:num_words]
                yield pa.record_batch([pa.array(np.tile(np.arange(topics, dtype=np.int32), len(best))), pa.array(words[best].ravel()),
                                       pa.array(np.take_along_axis(counts, best, 0).ravel())], names=["topic", "number", "count"])
    return strongest


def _edges(terms, numbers, key):
    """(doc, entry, df) of the rows of `terms` with a word; the most frequent words are looked up where the rows lie."""
    common = (F.col("number") < HEAD) & (F.octet_length("lemma") <= LONGEST)  # long ones are left to the shuffle
    columns = [F.xxhash64(key).alias("doc"), F.shiftleft("number", 32).bitwiseOR(F.col("n")).alias("entry"), "df"]
    words, rows = numbers.select("lemma", "number", "df"), terms.filter("lemma IS NOT NULL")
    head, rare = F.broadcast(words.filter(common)), words.filter(~common)
    found = rows.join(head, "lemma").select(*columns)
    if rare.isEmpty():
        return found
    return found.unionByName(rows.join(head, "lemma", "left_anti").join(rare, "lemma").select(*columns))


def _blocks(spark, occurrences):
    """Ids of the blocks, chosen so that a partition by hash holds one each; all cores have as many."""
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-occurrences // BLOCK), min(cores, occurrences // LEAST))
    blocks = blocks if blocks < cores else -(-blocks // cores) * cores
    ids = spark.range(64 * blocks).select(F.col("id").cast("int").alias("id"))
    found = ids.groupBy(F.pmod(F.hash("id"), F.lit(blocks)).alias("partition")).agg(F.min("id").alias("id")).orderBy("partition").collect()
    return [r.id for r in found]


def _fit(own, ks, first, blocks, size, passes, seed, num_words):
    """(k, topic, rank, number, weight) of the models for some ks, whose topics count from `first` in the draws; written out."""
    spark, topics = own.sparkSession, sum(ks)
    sent, totals = spark.createDataFrame([], MOVING), None
    with ExitStack() as last:
        for _ in range(passes + 1):
            now = ExitStack()
            step = _step(ks, blocks, seed, first, totals, size)
            made = own.groupBy("block").cogroup(sent.groupBy("target")).applyInArrow(step, MOVING)
            summed = made.repartition(len(blocks), "target").groupBy("target").applyInArrow(_sum_up(topics), STATE)
            state = now.enter_context(scratch(spark))(summed, "topic-counts", **PLAIN)
            last.close()  # the counts of the pass before are not read again
            last.enter_context(now)
            totals = sum((np.frombuffer(r.counts) for r in state.filter(f"kind = {TOTALS}").select("counts").collect()),
                         np.zeros(topics))  # one row of k numbers a block
            sent = state.filter(f"kind <> {TOTALS}").mapInArrow(_share_out(blocks, topics), MOVING)
        found = state.filter(f"kind IN ({SHARED}, {LOCAL})").mapInArrow(_strongest(topics, num_words), "topic int, number bigint, count double")
        places = [(i, k, t, float(totals[i])) for i, (k, t) in enumerate((k, t) for k in ks for t in range(k))]
        models = spark.createDataFrame(places, "at int, k int, topic int, total double")
        found = found.withColumnRenamed("topic", "at").join(F.broadcast(models), "at")
        # At most num_words of each topic from each block and part.
        order = W.partitionBy("k", "topic").orderBy(F.desc("count"), "number")
        ranked = found.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < num_words)
        return stage(ranked.select("k", "topic", "rank", "number", (F.col("count") / F.col("total")).alias("weight")), "topics")


def _groups(ks):
    """The ks in runs of at most `WIDTH` topics, each with the number of topics before it."""
    groups = []
    for at, k in enumerate(ks):
        if groups and sum(groups[-1][1]) + k <= WIDTH:
            groups[-1][1].append(k)
        else:
            groups.append((sum(ks[:at]), [k]))
    return groups


def sweep(terms: DataFrame, numbers: DataFrame, ks, num_words: int = 2, passes: int = 20, seed: int = 7,
          key: str = "doc_id", packed=lambda: None) -> DataFrame:
    """(k, topic, rank, number, weight): the strongest words of each topic of a model for each k, written out.

    From terms(key, lemma, n) and numbers(lemma, df, number). The weight is the word's share in the topic. `packed` is called
    when `terms` is not read any more.
    """
    spark, ks = terms.sparkSession, list(ks)
    size, occurrences = numbers.agg(F.count(F.lit(1)), F.coalesce(F.sum("df"), F.lit(0))).first()
    blocks = _blocks(spark, occurrences)
    with scratch(spark) as keep, _settings(spark, BATCH):
        # A block is a range of hashes: rows in the order of hashes are in the order of blocks.
        place = F.shiftright((F.shiftright("doc", 33) + (1 << 30)) * len(blocks), 31).cast("int")
        block = F.element_at(F.array(*[F.lit(b) for b in blocks]), place + 1)
        edges = _edges(terms, numbers, key).repartition(len(blocks), block).sortWithinPartitions("doc")
        own = keep(edges.mapInArrow(_pack(blocks), STATIC), "topic-blocks", **PLAIN)
        packed()
        own = own.repartition(len(blocks), "block").persist()
        try:
            found = [_fit(own, some, first, blocks, size, passes, seed, num_words) for first, some in _groups(ks)]
        finally:
            own.unpersist()
    return reduce(DataFrame.unionByName, found)
