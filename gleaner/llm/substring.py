"""Substring dedup: every run of `least_words` words that occurs earlier is cut out, the earliest occurrence stays.

Words are compared in lower case and without white space. They are runs of characters other than white space; Han
characters and kana, which are written without spaces, are words of their own. Three steps keep the rows few:

* Each window of `least_words` words is marked by the least hash of the half as long windows in it. A unit is the run of
  words of all windows with one mark, so units begin and end where the words say, wherever a line breaks, and about
  every sixth word starts one. Equal windows have equal marks: a mark that occurs once needs no further look.
* The other units are hashed whole and grouped by digest. Of equal units the first in order of id, text hash and offset
  stays, the later ones are cut.
* At the ends of a repeated passage units differ though some of their windows are equal. So where different units share a
  mark, the windows of the first unit of each digest are compared one by one in the same way.

What is cut in one text is merged, so a repeat goes from its first word to its last one. Shorter repeats stay.

Null text counts as empty and stays null. A null id ranks first. Rows with equal id and text rank the same and get equal
results. An empty table gives an empty result. All other columns are kept; where the table has a column named like the
operator's own, that one gets underscores. A text's words are held as arrays in the task that reads it, so a task needs
some 30 times the bytes of its longest text.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.names import free_name
from gleaner.llm.ngram_join import POWERS, _keys, _mix
from gleaner.sources.staging import scratch, stage

BLANK = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
UNSPACED = [(0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
RANK = ["doc", "text_hash", "span"]


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, 64-bit hashes) of the words in lower case, as character offsets."""
    # The only character that grows when lowered would move the offsets.
    data = np.frombuffer(text.replace("\u0130", "i").lower().encode("utf-32-le"), "<u4")
    inside, alone = ~BLANK[np.minimum(data, len(BLANK) - 1)], np.zeros(len(data), bool)
    if not text.isascii():
        for least, most in UNSPACED:
            alone |= (data >= least) & (data <= most)
    joined = inside[1:] & inside[:-1] & ~alone[1:] & ~alone[:-1]
    start = np.flatnonzero(inside & ~np.concatenate([[False], joined])[:len(data)])
    end = np.flatnonzero(inside & ~np.concatenate([joined, [False]])[:len(data)]) + 1
    up, down = POWERS.to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return start, end, _mix((total[end] - total[start]) * down[start])


def _windows(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of each run of n words."""
    place = _keys(seed, n)
    return _mix(sum(words[k:len(words) - n + 1 + k] * place[k] for k in range(n)))


def marks(words: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `least_words` words the place of its mark, and the hash that marks it."""
    short = (least_words + 1) // 2
    grams, width = _windows(words, short, 6), least_words - short + 1
    place = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(len(grams) - width + 1)
    return place, grams[place]


def paragraphs(text: str, least_words: int, among: list[int] | None = None):
    """(start, end, digest) of each window of `least_words` words, or of those with a mark at one of the places `among`.

    A window that overlaps the first equal one of its text starts where that one ends, so the first stays whole.
    """
    start, end, words = words_of(text)
    if len(words) < least_words:
        return
    chosen = np.arange(len(words) - least_words + 1)
    if among is not None:
        chosen = chosen[np.isin(marks(words, least_words)[0], among)]
    halves = [_windows(words, least_words, seed)[chosen].view(np.int64).tolist() for seed in (7, 8)]
    first_end: dict[tuple[int, int], int] = {}
    for a, b, digest in zip(start[chosen].tolist(), end[chosen + least_words - 1].tolist(), zip(*halves)):
        first = first_end.setdefault(digest, b)
        yield a if first == b else max(a, first), b, digest


def _runs(words: np.ndarray, first: np.ndarray, after: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the runs words[first:after]."""
    up, down = POWERS.to(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(_mix(words + _keys(seed, 1)) * up[:-1], out=total[1:])
    return _mix((total[after] - total[first]) * down[first] + (after - first).astype(np.uint64))


def units(text: str, least_words: int, among: list[int]):
    """Arrays (place, mark, start, end, digest's halves, again) of the units with a mark at one of the places `among`.

    again: the same text holds the unit before. A unit that overlaps the first equal one of its text starts where the first
    window of that one ends, so that window stays whole.
    """
    start, end, words = words_of(text)
    place, mark = marks(words, least_words)
    first = np.flatnonzero(np.diff(place, prepend=-1) > 0)
    after = np.append(first[1:], len(place)) - 1 + least_words
    chosen = np.isin(place[first], among)
    first, after = first[chosen], after[chosen]
    halves = np.stack([_runs(words, first, after, seed) for seed in (9, 10)])
    _, original, which = np.unique(halves, axis=1, return_index=True, return_inverse=True)
    original = original[which.reshape(-1)]
    again = original != np.arange(len(first))
    begin = np.where(again, np.maximum(start[first], end[first[original] + least_words - 1]), start[first])
    return place[first], mark[first], begin, end[after - 1], *halves, again


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
                       F.col(text).alias("text"))


def _at(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(doc, text_hash, text, places) of the texts that have places."""
    places = places.withColumnsRenamed({"doc": "_doc", "text_hash": "_hash"})
    same = texts["doc"].eqNullSafe(F.col("_doc")) & (texts["text_hash"] == F.col("_hash"))
    return texts.join(places, same).select("doc", "text_hash", "text", "places")


def _rows(batch: pa.RecordBatch, parts: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    """One batch of the arrays of each row of a batch, after the row's first two columns."""
    rows = pa.array(np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]))
    columns = [np.concatenate([p[k] for p in parts]) for k in range(len(types))]
    columns = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c).cast(t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *columns], names=["doc", "text_hash", *names])


def marked_places(texts: DataFrame, least_words: int) -> DataFrame:
    """(doc, text_hash, place, mark) of every unit of every whole text."""
    def one(text):
        words = words_of(text)[2]
        if len(words) < least_words:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        place, mark = marks(words, least_words)
        new = np.diff(place, prepend=-1) > 0
        return place[new], mark[new]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield _rows(part, [one(t.as_py() or "") for t in part.column(2)], ["place", "mark"], [pa.int32(), pa.int64()])

    return texts.mapInArrow(run, "doc bigint, text_hash bigint, place int, mark bigint")


def unit_digests(texts: DataFrame, places: DataFrame, least_words: int) -> DataFrame:
    """(doc, text_hash, place, mark, span, h1, h2, again) of the units at some places; span is start * 2^32 + end."""
    names = ["place", "mark", "span", "h1", "h2", "again"]
    types = [pa.int32(), *[pa.int64()] * 4, pa.bool_()]

    def one(text, among):
        place, mark, start, end, h1, h2, again = units(text, least_words, among)
        return place, mark, start.astype(np.int64) << 32 | end, h1, h2, again

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield _rows(part, [one(t.as_py(), p.as_py()) for t, p in zip(part.column(2), part.column(3))], names, types)

    return _at(texts, places).mapInArrow(run, "doc bigint, text_hash bigint, place int, mark bigint, span bigint, h1 bigint, "
                                              "h2 bigint, again boolean")


def window_digests(texts: DataFrame, places: DataFrame, least_words: int) -> DataFrame:
    """(doc, text_hash, span, h1, h2, again) of every window with a mark at one of some places."""
    names = ["doc", "text_hash", "span", "h1", "h2", "again"]
    types = [pa.int64()] * 5 + [pa.bool_()]

    def run(batches):
        for batch in batches:
            rows = []
            for doc, h, t, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                seen = set()
                for start, end, digest in paragraphs(t.as_py(), least_words, places.as_py()):
                    rows.append((doc, h, start << 32 | end, *digest, digest in seen))
                    seen.add(digest)
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=names)

    return _at(texts, places).mapInArrow(run, "doc bigint, text_hash bigint, span bigint, h1 bigint, h2 bigint, again boolean")


def _later(found: DataFrame, first: DataFrame) -> DataFrame:
    """(doc, text_hash, span) of the rows of `found` that come after the `first` of their digest.

    Both tables are written, so that both sides of the join are dealt out for it and the rows of one digest can be split.
    """
    rest = found.filter("not again").join(first.filter("n > 1").select("h1", "h2", "first"), ["h1", "h2"])
    rest = rest.filter(F.struct(*RANK) > F.struct(*[f"first.{c}" for c in RANK]))
    return rest.select("doc", "text_hash", "span").union(found.filter("again").select("doc", "text_hash", "span"))


def _places(found: DataFrame) -> DataFrame:
    # Places in one text, so an array is no longer than the text.
    return found.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("places"))


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 20) -> DataFrame:
    """(doc, text_hash, spans), written: where words stand that occur earlier too. What the steps write is deleted."""
    texts, spark = _texts(docs, key, text), docs.sparkSession
    rank, count = F.min(F.struct(*RANK)).alias("first"), F.count(F.lit(1)).alias("n")
    with scratch(spark) as keep:
        with scratch(spark) as brief:
            found = brief(marked_places(texts, least_words), "marks")
            common = brief(found.groupBy("mark").agg(count).filter("n > 1").select("mark"), "common")
            places = keep(_places(found.join(common, "mark")), "places")
        whole = keep(unit_digests(texts, places, least_words), "units")
        first = keep(whole.filter("not again").groupBy("mark", "h1", "h2")
                     .agg(F.min(F.struct(*RANK, "place")).alias("first"), count), "first-units")
        later = keep(_later(whole, first), "later-units")
        mixed = keep(first.groupBy("mark").agg(count).filter("n > 1").select("mark"), "mixed")
        ends = keep(_places(first.join(mixed, "mark").select("first.*")), "ends")
        windows = keep(window_digests(texts, ends, least_words), "windows")
        first = keep(windows.filter("not again").groupBy("h1", "h2").agg(rank, count).filter("n > 1"), "first-windows")
        every = later.union(_later(windows, first))
        # A document's own spans, so an array is no longer than its text.
        return stage(every.groupBy("doc", "text_hash").agg(F.collect_set("span").alias("spans")), "spans")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans."""
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start])
        at = end
    return "".join([*parts, text[at:]])


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 20,
          removed: str = "removed_spans") -> DataFrame:
    """The documents without what occurs earlier, and `removed`: array of (start, end) offsets in the original text.

    A table that has a column named `removed` keeps it, and the offsets get that name with underscores.
    """
    doc, digest, removed = (free_name(name, docs.columns) for name in ("_doc", "_hash", removed))
    gone = repeats(docs, key, text, least_words).select(
        F.col("doc").alias(doc), F.col("text_hash").alias(digest),
        F.transform("spans", lambda s: F.struct(F.shiftright(s, 32).cast("int").alias("start"),
                                                F.bitwise_not(F.lit(-1 << 32)).bitwiseAND(s).cast("int").alias("end"))).alias(removed))
    same = (F.col(key).cast("long").eqNullSafe(F.col(doc))
            & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(digest)))
    joined = docs.join(gone, same, "left").select(*docs.columns, removed)
    text_at, spans_at = docs.columns.index(text), len(docs.columns)

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                spans = [merged([(s["start"], s["end"]) for s in x or ()]) for x in part.column(spans_at).to_pylist()]
                texts = [cut(t, s) if s else t for t, s in zip(part.column(text_at).to_pylist(), spans)]
                columns = list(part.columns)
                columns[text_at] = pa.array(texts, pa.string())
                columns[spans_at] = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind)
                yield pa.RecordBatch.from_arrays(columns, names=names)
    names = joined.columns
    return joined.mapInArrow(run, joined.schema)
