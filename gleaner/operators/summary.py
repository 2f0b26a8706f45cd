"""Extractive summaries of records and of a whole corpus, and records rebuilt from their relevant sentences."""

import re

from pyspark.sql import DataFrame, Window, functions as F

from gleaner.functions import text as tx, vocab
from gleaner.sources.staging import stage

TITLE_WEIGHT = 1.5
LEAD_WEIGHT = 1.0
FINAL_TEXTS = 15
LARGEST_FAN_IN = 20


def _let(value: str, name: str, body: str) -> str:
    # Binds a value to a lambda variable, so that it is evaluated once and not wherever it is used.
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _runs(array: str, field: str, body: str) -> str:
    """SQL for `body` on each run of elements of a sorted array that agree in a field; b and e are its ends."""
    starts = f"filter(sequence(0, size({array}) - 1), i -> i = 0 or {array}[i].{field} <> {array}[greatest(i - 1, 0)].{field})"
    runs = _let(starts, "st", f"zip_with(st, concat(slice(st, 2, size(st)), array(size({array}))), (b, e) -> {body})")
    return f"if(size({array}) = 0, array(), {runs})"


def _scored(title: str, stop, body: str) -> str:
    """SQL for `body` on `p`, the sentences in the column `_parts`, and `sc`, the (score, sent_no) of those with content words.

    The words are sorted with the number of their sentence, so a run of equal words gives a word's count in the record, and
    sorted back, a run of equal numbers gives a sentence's words. All is one expression, which no filter can repeat.
    """
    stop = vocab.stop_words() if stop is None else stop
    title_words = sorted(set(re.findall(r"\w+", title.lower())))
    in_title = f"x.t IN ({', '.join(map(tx.quote, title_words))})" if title_words else "false"
    words = (f"sort_array(flatten(transform(p, (s, i) -> transform({tx.content_words_sql('s', stop)}, "
             "t -> named_struct('t', t, 'i', i)))))")
    # A title word counts once in a sentence: at its first place there.
    counted = _runs("w", "t", "transform(slice(w, b + 1, e - b), (x, k) -> named_struct('i', x.i, 'n', e - b, 'hit', "
                              f"if({in_title} and (k = 0 or w[greatest(b + k - 1, 0)].i <> x.i), 1, 0)))")
    sums = "aggregate(slice(c, b + 1, e - b), named_struct('n', bigint(0), 'hit', 0), (t, x) -> named_struct('n', t.n + x.n, 'hit', t.hit + x.hit))"
    score = (f"round(cast(a.n as double) / size(c) / sqrt(e - b) + {TITLE_WEIGHT}D * a.hit / {max(1, len(title_words))} "
             f"+ {LEAD_WEIGHT}D / (c[b].i + 1), 9)")
    scores = _runs("c", "i", _let(sums, "a", f"named_struct('score', {score}, 'sent_no', c[b].i)"))
    return _let("_parts", "p", _let(words, "w", _let(f"sort_array(flatten({counted}))", "c", _let(scores, "sc", body))))


def _parts(records: DataFrame, key: str) -> DataFrame:
    return records.select(key, tx.split_sentences(F.col("text")).alias("_parts"))


def sentence_scores(records: DataFrame, title: str = "", stop=None, key: str = "doc_id") -> DataFrame:
    """Score of each sentence with content words: (key, sent_no, score).

    Word weight is the word's share of the record; a sentence sums the weights over the root of its length, plus the
    share of the title's words it holds and a bonus for coming early. Everything stays inside the record's row.
    """
    # The outer form: for the inner one Spark adds a size filter that computes the scores a second time.
    return (_parts(records, key).select(key, F.inline_outer(F.expr(_scored(title, stop, "sc"))))
            .filter("score IS NOT NULL").select(key, "sent_no", "score"))


def doc_summary(records: DataFrame, title: str = "", top: int = 5, stop=None, key: str = "doc_id") -> DataFrame:
    """The `top` best sentences of each record, in text order: (key, summary). Records without words have none.

    One scan without a shuffle.
    """
    best = f"slice(sort_array(transform(sc, x -> named_struct('s', -x.score, 'i', x.sent_no))), 1, {int(top)}).i"
    chosen = f"if(size(sc) = 0, NULL, array_join(transform(sort_array({best}), i -> p[i]), ' '))"
    summary = F.explode_outer(F.array(F.expr(_scored(title, stop, chosen)))).alias("summary")
    return _parts(records, key).select(key, summary).filter("summary IS NOT NULL")


def _ranked(summaries: DataFrame, key: str):
    """Staged rows with a gap-free `rank` by key, and their number.

    Sorted ranges of keys are numbered inside each partition; the offsets come from one count per partition.
    """
    # Written out first: the sampling of the ranges would make every summary a second time.
    ordered = stage(summaries, "summaries").repartitionByRange(key).sortWithinPartitions(key)
    numbered = stage(ordered.withColumn("_id", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("_id", 33).cast("int"), F.col("_id").bitwiseAND((1 << 33) - 1)
    numbered = numbered.withColumn("_part", part).withColumn("_place", place)
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("size"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_offset"))
    ranked = numbered.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_offset") + F.col("_place"))
    return ranked.select("rank", "text"), numbered.count()


def next_level(level: DataFrame, title: str, fan_in: int, top: int = 5) -> DataFrame:
    """Summaries of each `fan_in` neighbouring texts of level(rank, text): (rank, text)."""
    group = F.floor(F.col("rank") / fan_in).alias("rank")
    joined = level.groupBy(group).agg(  # at most fan_in texts each
        F.array_join(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("r"), "text"))).getField("text"),
                     " ").alias("text"))
    return doc_summary(joined, title, top, key="rank").withColumnRenamed("summary", "text")


def corpus_summary(records: DataFrame, title: str, top: int = 5, key: str = "doc_id") -> DataFrame:
    """Summaries of neighbouring summaries until fewer than twice 15 are left: (rank, text).

    Each level joins `fan-in` = min(n / 15, 20) neighbours and summarises them against the title; a fan-in of one ends
    it. The number of levels grows with the logarithm of the corpus; each level is written out, so none is recomputed.
    """
    level, n = _ranked(doc_summary(records, "", top, key=key).select(key, F.col("summary").alias("text")), key)
    while n > FINAL_TEXTS:
        fan_in = min(n // FINAL_TEXTS, LARGEST_FAN_IN)
        if fan_in == 1:
            break
        level = stage(next_level(level, title, fan_in, top), "level")
        n = -(-n // fan_in)
    return level


def rebuild_records(sentences: DataFrame, min_sentences: int = 5, key: str = "doc_id") -> DataFrame:
    """Records put together again from their distinct sentences, in order: (key, url, text).

    Records with fewer than `min_sentences` are left out; the url column is kept when there is one.
    """
    # Copies of a sentence collapse before any record is brought together.
    first = [F.min("sent_no").alias("sent_no")] + [F.min(c).alias(c) for c in ("url",) if c in sentences.columns]
    once = sentences.groupBy(key, "text").agg(*first)
    urls = [F.min("url").alias("url")] if "url" in sentences.columns else []
    whole = once.groupBy(key).agg(*urls, F.array_sort(F.collect_list(F.struct("sent_no", "text"))).alias("_s"))
    whole = whole.filter(F.size("_s") >= min_sentences)
    return whole.withColumn("text", F.array_join(F.col("_s").getField("text"), " ")).drop("_s")
