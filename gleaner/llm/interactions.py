"""How filters interact: what each removes, alone and after others, and its Shapley share by the Hart-Mas-Colell potential.

A document fails a set of filters, a number with one bit per filter. Counting documents by part and that number gives the
removal game v of every coalition S of filters: v(S) documents fail at least one of S. Its potential is

    P(empty) = 0,   P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

and the Shapley share of filter i is P(all) - P(all without i). The potentials are taken times k!, so that they stay whole
numbers. A filter that follows the coalition S removes v(S and it) - v(S).

Only a digest and a few numbers of each document are shuffled. Copies of a text are counted by (text, part, labels) before
they meet, so a text that a third of all documents share is combined in every task; what is left of one text is a few rows
per part. From then on there is one row per part.

Null text counts as empty, a null part as the empty string. A document without id is no copy of another one, and none of it.
Rows with one id and one text are no copies of each other, as neither id is smaller. Labels that occur several times for an
id count as 1 where one row does. Documents without labels are neither good nor toxic. An empty table gives no rows. Other
columns are not read, whatever their names.
"""

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, Window as W, functions as F

from gleaner.sources.staging import stage

SPACE = r"[\\x20\\x09-\\x0D]+"
CAPITALS, SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[#$%&*|]"

#: Failure condition of each filter on the measures: n_words, n_distinct, n_capitals, n_chars, has_symbol. One filter has
#: none: it fails copies of a text with a smaller id.
FILTERS = {"A": "n_words < 200", "B": "100 * n_distinct < 50 * n_words", "C": "100 * n_capitals > 3 * n_chars",
           "D": "has_symbol", "E": None}
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(docs: DataFrame, filters=None, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, digest, fails): the filters that each text fails by itself, and the SHA-256 of the text."""
    filters = FILTERS if filters is None else filters
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    measures = ("transform(array(filter(split(t, '{space}'), w -> w <> '')), ws -> named_struct("
                "'n_words', cast(size(ws) as bigint), 'n_distinct', cast(size(array_distinct(ws)) as bigint), "
                "'n_capitals', cast(length(t) - length(translate(t, '{capitals}', '')) as bigint), "
                "'n_chars', cast(length(t) as bigint), 'has_symbol', t rlike '{symbols}'))")
    bits = [f"if({rule}, {1 << i}, 0)" for i, rule in enumerate(filters.values()) if rule is not None]
    return (rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"),
                        F.inline(F.expr(measures.format(space=SPACE, capitals=CAPITALS, symbols=SYMBOLS))))
            .select("id", "part", "digest", F.expr(" + ".join(bits or ["0"])).alias("fails")))


def _flags(labels: DataFrame, key: str) -> DataFrame:
    """(id, good, toxic): 0 or 1 for each labelled id."""
    mark = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0))
    return (labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id"))
            .agg(mark("quality").alias("good"), mark("toxic").alias("toxic")))


def coalition_counts(docs: DataFrame, labels: DataFrame, filters=None, key: str = "doc_id", text: str = "text",
                     part: str = "lang") -> DataFrame:
    """(part, n, good, toxic): arrays of 2^k counts, in which place s counts the documents that fail exactly the filters s."""
    filters = FILTERS if filters is None else filters
    copy_bit = sum(1 << i for i, rule in enumerate(filters.values()) if rule is None)
    # Written, so that a join too large to broadcast has two plain sides and a hot id can be split.
    flags = stage(_flags(labels, key), "flags")
    rows = (failures(docs, filters, key, text, part).join(flags, "id", "left")
            .withColumns({"good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))}))
    same = ["digest", "part", "fails", "good", "toxic"]
    by_id = rows.groupBy(*same, "id").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    copies = by_id.groupBy(*same).agg(F.sum("n").alias("n"), least.alias("least"),
                                      F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"))
    first = F.min("least.id").over(W.partitionBy("digest"))  # a few rows per part
    originals = F.col("without_id") + F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0)
    told = copies.select("part", "fails", "good", "toxic", "n", originals.alias("originals"))
    told = told.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("fails").alias("fails"), F.col("originals").alias("n")),
        F.struct((F.col("fails") + copy_bit).alias("fails"), (F.col("n") - F.col("originals")).alias("n")))))
    counts = told.groupBy("part", "fails").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                               F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    every = 1 << len(filters)
    # At most 2^k rows of a part.
    spread = lambda c: F.expr(f"transform(sequence(0, {every - 1}), s -> coalesce(m[s].{c}, bigint(0)))")
    return (counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("fails", F.struct("n", "good", "toxic")))).alias("m"))
            .select("part", *[spread(c).alias(c) for c in ("n", "good", "toxic")]))


def _game(counts: str, every: int) -> str:
    """SQL for the removal game: place S counts the documents that fail at least one filter of S."""
    return (f"transform(sequence(0, {every - 1}), s -> aggregate(sequence(1, {every - 1}), bigint(0), "
            f"(t, m) -> if(m & s = 0, t, t + {counts}[m])))")


def _potentials(game: str, k: int) -> str:
    """SQL for k! times the potential of every coalition; smaller numbers hold all subsets, so one pass is enough."""
    parts = " + ".join(f"if(s & {1 << i} = 0, bigint(0), p[s - if(s & {1 << i} = 0, 0, {1 << i})])" for i in range(k))
    return (f"aggregate(sequence(1, {(1 << k) - 1}), array(bigint(0)), "
            f"(p, s) -> concat(p, array(({factorial(k)} * {game}[s] + {parts}) div bit_count(s))))")


def shares(counted: DataFrame, k: int) -> DataFrame:
    """Adds `game`, `good_game`, `toxic_game` and `potential`, arrays by coalition, to the result of `coalition_counts`."""
    every = 1 << k
    games = counted.select("*", *[F.expr(_game(c, every)).alias(g) for c, g in
                                  (("n", "game"), ("good", "good_game"), ("toxic", "toxic_game"))])
    return games.withColumn("potential", F.expr(_potentials("game", k)))


def audit(docs: DataFrame, labels: DataFrame, filters=None, key: str = "doc_id", text: str = "text",
          part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order of the filters and step. `shapley` is the Shapley share times the number of orders: what the
    filter removes, summed over all orders.
    """
    filters = FILTERS if filters is None else filters
    names, k = "".join(filters), len(filters)
    every = (1 << k) - 1
    orders = ", ".join(f"'{''.join(p)}'" for p in permutations(names))
    bits = (f"transform(sequence(1, {k}), i -> shiftleft(1, instr('{names}', substring(filter_order, i, 1)) - 1))")
    steps = (f"transform(sequence(1, {k}), i -> named_struct('step', i, 'own', bits[i - 1], "
             "'before', aggregate(slice(bits, 1, i - 1), 0, (t, b) -> t + b)))")
    rows = (shares(coalition_counts(docs, labels, filters, key, text, part), k)
            .withColumn("filter_order", F.explode(F.expr(f"array({orders})")))
            .withColumn("bits", F.expr(bits)).select("*", F.inline(F.expr(steps))))
    after = "game[before + own]"
    columns = {
        "kept": f"n[0] + game[{every}] - {after}", "removed": f"{after} - game[before]",
        "redundant": f"game[own] - ({after} - game[before])", "unique_fails": "n[own]",
        "good_lost": "good_game[before + own] - good_game[before]",
        "toxic_lost": "toxic_game[before + own] - toxic_game[before]",
        "shapley": f"potential[{every}] - potential[{every} - own]"}
    return rows.select("part", "filter_order", "step", *[F.expr(f"cast({columns[c]} as bigint)").alias(c) for c in COUNTS])
