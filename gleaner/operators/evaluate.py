"""Evaluation of summaries: ROUGE recall, its bootstrap interval, the best sentence pair, entity coverage."""

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gleaner.functions import text as tx, vocab
from gleaner.functions.joins import lookup_join
from gleaner.functions.sampling import POISSON_THRESHOLDS, poisson, poisson_digits
from gleaner.sources.staging import stage

SKIP_REACH = 5


def rouge_tokens(text: str, stem: bool = True, drop_stop: bool = True, length: int = None) -> Column:
    """Lowercase words of a text, optionally the first `length` only, without stop words, stemmed."""
    return tx.rouge_words(text, vocab.stop_words() if drop_stop else None, stem, length)


def _grams(tokens: Column, kind) -> Column:
    if kind == "su4":
        return F.concat(tokens, tx.skip_pairs(tokens, SKIP_REACH))
    return tx.ngrams(tokens, kind)


def rouge(predicted: DataFrame, golden: DataFrame, kind=1, by=(), key: str = "doc_id", **options) -> DataFrame:
    """ROUGE recall of each predicted text against its golden summary: (key, *by, score).

    `kind` is 1, 2, ... for n-grams, or 'su4' for skip-bigrams with gap up to four plus words. Golden rows that share
    `by` (all rows when it is empty) are parts of one golden summary. The join is on (by, n-gram), so predicted and
    golden texts are never paired one by one.
    """
    by, tokens, grams = list(by), rouge_tokens("text", **options), _grams(F.col("_tokens"), kind)
    gold = (golden.select(*by, tokens.alias("_tokens")).select(*by, F.explode(grams).alias("gram"))
            .groupBy(*by, "gram").agg(F.count(F.lit(1)).alias("gold_n")))
    # The outer form: for the inner one Spark adds a size filter that makes tokens and grams a second time.
    rows = (predicted.select(key, *by, tokens.alias("_tokens")).select(key, *by, F.explode_outer(grams).alias("gram"))
            .filter("gram IS NOT NULL"))
    matched = lookup_join(rows, gold, [*by, "gram"])
    shared = (matched.groupBy(key, *by, "gram", "gold_n").agg(F.count(F.lit(1)).alias("n"))
              .select(key, *by, F.least("n", "gold_n").alias("hits")))
    none = predicted.select(key, *by, F.lit(0).cast("bigint").alias("hits"))
    hits = shared.unionByName(none).groupBy(key, *by).agg(F.sum("hits").alias("hits"))
    if not by:
        total = gold.agg(F.sum("gold_n")).scalar()
        return hits.select(key, F.round(F.col("hits") / total, 9).alias("score"))
    totals = gold.groupBy(*by).agg(F.sum("gold_n").alias("total"))
    return hits.join(totals, by).select(key, *by, F.round(F.col("hits") / F.col("total"), 9).alias("score"))


@F.pandas_udf(T.IntegerType())
def _lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(list(x), list(y)) for x, y in zip(a, b)], dtype="int32")


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence, one row of bits per step."""
    places = {}
    for i, item in enumerate(a):
        places[item] = places.get(item, 0) | (1 << i)
    row = (1 << len(a)) - 1
    every = row
    for item in b:
        common = row & places.get(item, 0)
        row = ((row + common) | (row - common)) & every
    return len(a) - row.bit_count()


def rouge_l(predicted: DataFrame, golden: DataFrame, key, **options) -> DataFrame:
    """ROUGE-L recall of texts paired by key: longest common subsequence over the golden length, (*key, score).

    A predicted text whose golden one is missing or has no words keeps its row, with a null score. The subsequence is found with
    one row of bits per word, so the work of a pair grows with the product of its lengths over 64, repeated words or not.
    """
    key, none = [key] if isinstance(key, str) else list(key), F.array().cast("array<string>")
    tokens = F.coalesce(rouge_tokens("text", **options), none)
    pairs = (predicted.select(*key, tokens.alias("_p")).join(golden.select(*key, tokens.alias("_g")), key, "left")
             .withColumn("_g", F.coalesce("_g", none)))
    return pairs.select(*key, F.when(F.size("_g") > 0, F.round(_lcs("_p", "_g") / F.size("_g"), 9)).alias("score"))


def rouge_bootstrap(scores: DataFrame, replicates: int = 1000, key: str = "doc_id") -> DataFrame:
    """Mean score and the 95 % interval of its bootstrap distribution, one row.

    Resampling weights are Poisson(1) draws fixed by key and replicate, so every replicate is a weighted mean and the
    shuffle carries `replicates` rows per task. The draws, not the few bytes of a score, are the work, so the scores are dealt
    out to as many tasks as a shuffle has; sized by bytes, a task would hold tens of millions of draws.
    """
    tasks = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // 4))).alias("block")
    drawn = scores.select(key, "score").repartition(tasks).select(key, "score", blocks).select(
        "score", "block", F.posexplode(poisson_digits(F.col(key), F.col("block"))).alias("i", "digits"))
    # A draw of zero is known from its first threshold, before any weight is made.
    means = (drawn.filter(F.col("digits") >= POISSON_THRESHOLDS[0])
             .select((F.col("block") * 4 + F.col("i")).alias("replicate"), "score", poisson(F.col("digits")).alias("w"))
             .filter(F.col("replicate") < replicates)
             .groupBy("replicate").agg((F.sum(F.col("score") * F.col("w")) / F.sum("w")).alias("mean")))
    cuts = means.agg(F.percentile("mean", F.array(F.lit(0.025), F.lit(0.975))).alias("cuts"),
                     F.avg("mean").alias("mean"))
    return cuts.select(F.round("mean", 6).alias("mean"), F.round(F.col("cuts")[0], 6).alias("low"),
                       F.round(F.col("cuts")[1], 6).alias("high"))


def _bags(tokens: DataFrame, kind) -> DataFrame:
    """(key, bag, grams), written out: the gram occurrences of each sentence, and its different grams with their counts.

    The k-th occurrence of a gram is an item of its own, so that shared items count like shared occurrences. Sentences that
    are equal as bags become one row with the first key: copies cost nothing later.
    """
    # Exploded from an array of one, so that the filter can't repeat the sorting.
    sorted_grams = tokens.select("key", F.explode_outer(F.array(F.sort_array(_grams(F.col("tokens"), kind)))).alias("s")).filter(F.size("s") > 0)
    same = F.sha2(F.array_join("s", "\u0001"), 256)
    once = sorted_grams.groupBy(same.alias("digest")).agg(F.min(F.struct("key", "s")).alias("x")).select("x.key", "x.s")
    # Runs of equal grams in the sorted array, each from its start to the next one's.
    starts = "filter(sequence(0, size(s) - 1), i -> i = 0 or s[i] <> s[greatest(i - 1, 0)])"
    runs = (f"transform(array({starts}), a -> zip_with(a, concat(slice(a, 2, size(a)), array(size(s))), "
            "(i, j) -> named_struct('gram', s[i], 'n', j - i)))[0]")
    counted = once.select("key", F.expr(runs).alias("grams"))
    items = "flatten(transform(grams, g -> transform(sequence(1, g.n), k -> concat(g.gram, '#', cast(k as string)))))"
    return stage(counted.select("key", F.expr(items).alias("bag"), "grams"), "bags")


FIRST_CAP, WIDER = 16, 16  # sentences that hold a gram of the first round, and how many times as many in each later one


def _needed(score: float) -> Column:
    """Gram occurrences that a golden sentence of m must share for a score; a hair less, as scores are rounded quotients."""
    return F.ceil(F.lit(score) * F.col("m") - F.lit(1e-9))


def _best_pair(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """(score, p, g), one row: the pair with the highest share of the golden bag, the first one on ties."""
    wanted = gold.select(F.col("key").alias("g"), F.size("bag").alias("m"), F.inline("grams"))
    grams = wanted.select("gram").distinct()
    held = pred.select(F.col("key").alias("p"), F.size("bag").alias("length"), F.explode("grams.gram").alias("gram"))
    held = stage(held.join(grams, "gram", "left_semi"), "held")
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    # Grams that no predicted sentence holds come first: they take up room in a prefix, but join with nothing.
    rarest = Window.partitionBy("g").orderBy("df", "gram").rowsBetween(Window.unboundedPreceding, -1)
    ordered = (wanted.join(counts, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
               .withColumn("before", F.coalesce(F.sum("n").over(rarest), F.lit(0))))  # one sentence's grams
    ordered = stage(ordered.filter("df > 0").select("g", "m", "gram", "df", "before"), "ordered")

    def open_grams(least, above):
        # A pair that shares none of the grams before has at most m - before in common.
        return ordered.filter((F.col("df") > above) & (F.col("m") - F.col("before") >= F.greatest(F.lit(1), _needed(least))))

    best, least, cap = [], 0.0, 0
    while True:
        nearest = open_grams(least, cap).agg(F.min("df")).first()[0]
        if nearest is None:
            break
        above, cap = cap, max(nearest, WIDER * cap or FIRST_CAP)
        some = open_grams(least, above).filter(F.col("df") <= cap)
        pairs = stage(held.join(some, "gram").filter(F.col("length") >= _needed(least)).select("p", "g").distinct(), "pairs")
        with_bags = (pairs.join(pred.select(F.col("key").alias("p"), F.col("bag").alias("p_bag")), "p")
                     .join(gold.select(F.col("key").alias("g"), F.col("bag").alias("g_bag")), "g"))
        share = F.size(F.array_intersect("p_bag", "g_bag")) / F.size("g_bag")
        found = stage(with_bags.agg(F.min(F.struct((-share).alias("score"), "p", "g")).alias("best"))
                      .select((-F.col("best.score")).alias("score"), "best.p", "best.g").filter("p IS NOT NULL"), "best")
        best.append(found)
        least = max(least, found.agg(F.max("score")).first()[0] or 0.0)
    # Without any shared gram all pairs score 0 and the first one is returned.
    firsts = pred.select(F.col("key").alias("p")).unionByName(gold.select(F.col("key").alias("g")), True)
    best.append(firsts.agg(F.min("p").alias("p"), F.min("g").alias("g")).select(F.lit(0.0).alias("score"), "p", "g"))
    every = reduce(DataFrame.unionByName, best).agg(F.min(F.struct((-F.col("score")).alias("score"), "p", "g")).alias("best"))
    return every.select((-F.col("best.score")).alias("score"), "best.p", "best.g")


def rouge_best_pairs(predicted: DataFrame, golden: DataFrame, predicted_key, golden_key, kinds=(1, 2), **options) -> DataFrame:
    """For each kind of gram, the predicted and golden sentence with the highest ROUGE recall: (kind, score, keys, texts).

    The first pair by key wins on ties. Exact without pairing all sentences that share a word: the grams of each golden
    sentence are taken from the rarest on, in rounds. A round joins those that few enough predicted sentences hold, and its
    best score is the bound of the next: a pair of m golden grams that scores at least t shares one of the m - ceil(t m) + 1
    rarest of them, so what comes after these, and a gram in every sentence with it, is never joined. Tokens are made once
    for all kinds.
    """
    sides = []
    for sentences, key in ((predicted, list(predicted_key)), (golden, list(golden_key))):
        sides.append(stage(sentences.select(F.struct(*key).alias("key"), rouge_tokens("text", **options).alias("tokens")), "tokens"))
    best = [_best_pair(*[_bags(side, kind) for side in sides]).select(F.lit(str(kind)).alias("kind"), "*") for kind in kinds]
    best = stage(reduce(DataFrame.unionByName, best), "best")
    keys = best.select("p", "g").collect()  # a row for each kind
    out = best.select("kind", F.round("score", 9).alias("score"), *[F.col(f"p.{c}").alias(f"predicted_{c}") for c in predicted_key],
                      *[F.col(f"g.{c}").alias(f"golden_{c}") for c in golden_key])
    for side, name, key, at in ((predicted, "predicted", predicted_key, 0), (golden, "golden", golden_key, 1)):
        # The keys are literals, so the scan reads the records of the chosen sentences only.
        chosen = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(k[at][c])) for c in key]) for k in keys if k[at] is not None]
        texts = side.filter(reduce(Column.__or__, chosen, F.lit(False))).select(
            *[F.col(c).alias(f"{name}_{c}") for c in key], F.col("text").alias(f"{name}_text"))
        out = out.join(texts, [f"{name}_{c}" for c in key])
    return out


def rouge_best_pair(predicted: DataFrame, golden: DataFrame, predicted_key, golden_key, kind=1, **options) -> DataFrame:
    """The best pair for one kind of gram, without the kind."""
    return rouge_best_pairs(predicted, golden, predicted_key, golden_key, (kind,), **options).drop("kind")


def entity_coverage(predicted: DataFrame, golden: DataFrame) -> DataFrame:
    """Share of the distinct golden mentions that the predicted ones hold, one row; null without golden mentions."""
    sides = predicted.select("mention", F.lit(1).alias("p"), F.lit(0).alias("g")).unionByName(
        golden.select("mention", F.lit(0).alias("p"), F.lit(1).alias("g")))
    seen = sides.groupBy("mention").agg(F.max("p").alias("p"), F.max("g").alias("g"))
    both, wanted = F.count_if((F.col("p") == 1) & (F.col("g") == 1)), F.count_if(F.col("g") == 1)
    return seen.agg(both.alias("shared"), wanted.alias("golden"),
                    F.when(wanted > 0, F.round(both / wanted, 9)).alias("coverage"))
