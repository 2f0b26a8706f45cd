"""Entity mentions from typed patterns and a gazetteer, and their counts."""

import json

from pyspark.sql import DataFrame, functions as F

from gleaner.functions import text as tx
from gleaner.functions.joins import fits, lookup_join
from gleaner.functions.numbers import DATE, LENGTH_UNITS, NUMBER, OTHER_UNITS, SPEED_UNITS
from gleaner.sources.staging import stage

NAME = r"[A-Z][a-z]+(?: [A-Z][a-z]+)*"
UNITS = [u for units in (*SPEED_UNITS.values(), *LENGTH_UNITS.values(), OTHER_UNITS) for u in units]
QUANTITY = rf"{NUMBER}[ -]?(?:{'|'.join(UNITS)})\b"
EVENT_PATTERNS = {"QUANTITY": QUANTITY, "DATE": DATE}
# A word or one mark, in texts and gazetteer alike, so a run that crosses a mark is found only where an entry has it.
PLACE_WORD = r"[\p{L}\p{N}_'-]+|[^\s\p{L}\p{N}_'-]"


def mentions(texts: DataFrame, patterns: dict, gazetteer: DataFrame = None, keep=("doc_id",)) -> DataFrame:
    """One row per mention: (*keep, type, ord, mention).

    `patterns` maps a type to a regular expression; entries of gazetteer(type, text) are looked up by their words. A place is
    given as the gazetteer writes it, the least of several ways. `ord` numbers the mentions of one pattern in a text, in
    order; for an entry it is the number of the word that it starts with.
    """
    def typed(kind, found):
        return F.transform(found, lambda m, i: F.struct(F.lit(kind).alias("type"), i.alias("ord"), m.alias("mention")))
    found = F.concat(*[typed(kind, tx.find_all(F.col("text"), p)) for kind, p in patterns.items()])
    if gazetteer is None:
        return _inlined(texts, found, keep)
    index = stage(place_index(gazetteer), "index")
    listed = listed_places(index)
    if listed is not None:
        # Null where the text is, as the patterns' matches are.
        return _inlined(texts, F.concat(found, F.transform(F.expr(listed), lambda x: F.struct(
            x["type"].alias("type"), x["ord"].alias("ord"), x["mention"].alias("mention")))), keep)
    if not fits(index):
        return _inlined(texts, found, keep).unionByName(_places_of_many(texts, index, keep))
    # Words are cells like the pattern's matches, so the text is read once; a cell without type is a word.
    words = typed(None, F.col("_words"))
    cells = F.concat(F.transform(found, lambda x: F.struct(x["type"].alias("_type"), x["ord"].alias("_at"), x["mention"].alias("_cell"))),
                     F.transform(words, lambda x: F.struct(x["type"].cast("string").alias("_type"), x["ord"].alias("_at"),
                                                           x["mention"].alias("_cell"))))
    rows = texts.withColumn("_words", place_words()).select(*keep, "_words", F.inline(cells))
    rows = rows.withColumn("_anchor", F.when(F.col("_type").isNull(), F.col("_cell")))
    rows = rows.join(F.broadcast(index), "_anchor", "left").filter(F.col("_type").isNotNull() | F.expr(STANDS))
    return rows.select(*keep, F.coalesce("_type", "type").alias("type"),
                       F.when(F.col("_type").isNull(), F.col("_at") - F.col("_offset")).otherwise(F.col("_at")).alias("ord"),
                       F.when(F.col("_type").isNull(), F.col("mention")).otherwise(F.col("_cell")).alias("mention"))


def _inlined(texts, cells, keep):
    # The outer form: for the inner one Spark adds a size filter that finds the cells a second time.
    return texts.select(*keep, F.inline_outer(cells)).filter("ord IS NOT NULL")


#: Whether the entry of a row stands in `_words` with its anchor at place `_at`.
STANDS = "_at >= _offset AND slice(_words, _at - _offset + 1, size(_entry)) = _entry"


def place_words(text: str = "text"):
    """The words and marks of a text."""
    return tx.find_all(F.col(text), PLACE_WORD)


def place_index(gazetteer: DataFrame) -> DataFrame:
    """(_anchor, _offset, _entry, type, mention): each entry under one of its words, the one that fewest entries hold.

    Of several the longest is taken, then the first. A text's word thus meets the entries that it anchors, however long they
    are, and the words around it decide.
    """
    entries = (gazetteer.groupBy("type", place_words().alias("_entry")).agg(F.min("text").alias("mention"))
               .filter(F.size("_entry") > 0))
    counts = (entries.select(F.explode(F.array_distinct("_entry")).alias("_anchor")).groupBy("_anchor")
              .agg(F.count(F.lit(1)).alias("_entries")))
    places = entries.select("*", F.posexplode("_entry").alias("_offset", "_anchor")).join(counts, "_anchor")
    best = F.min(F.struct("_entries", (-F.length("_anchor")).alias("_length"), "_offset", "_anchor"))
    return (places.groupBy("type", "_entry", "mention").agg(best.alias("_best"))
            .select("_best._anchor", "_best._offset", "_entry", "type", "mention"))


LISTED_PLACES = 1000  # rows of an index that an expression may list


def listed_places(index: DataFrame, text: str = "text") -> str | None:
    """SQL for the array of (type, ord, mention) of an index of at most `LISTED_PLACES` rows in a text; None for a larger one.

    Found inside the row: words that are anchors meet their entries, no other word leaves the row.
    """
    rows = index.limit(LISTED_PLACES + 1).collect()
    if not rows or len(rows) > LISTED_PLACES:
        return None
    entries = json.dumps([{"a": r["_anchor"], "o": r["_offset"], "e": r["_entry"], "t": r["type"], "m": r["mention"]} for r in rows])
    entries = f"from_json({tx.quote(entries)}, 'array<struct<a: string, o: int, e: array<string>, t: string, m: string>>')"
    anchors = ", ".join(tx.quote(a) for a in sorted({r["_anchor"] for r in rows}))
    at = f"filter(transform(ws, (w, i) -> if(w IN ({anchors}), named_struct('w', w, 'i', i), NULL)), x -> x IS NOT NULL)"
    stands = "e.a = x.w AND x.i >= e.o AND slice(ws, x.i - e.o + 1, size(e.e)) = e.e"
    found = (f"flatten(transform({at}, x -> transform(filter({entries}, e -> {stands}), "
             "e -> named_struct('type', e.t, 'ord', x.i - e.o, 'mention', e.m))))")
    return f"element_at(transform(array(regexp_extract_all({text}, {tx.quote(PLACE_WORD)}, 0)), ws -> {found}), 1)"


def _places_of_many(texts, index, keep):
    # An index too large for every task: words travel with their place alone, and meet the words around them by row.
    rows = stage(texts.select(*keep, place_words().alias("_words")).withColumn("_row", F.monotonically_increasing_id()), "words")
    index = stage(index, "index")
    said = rows.select("_row", F.posexplode("_words").alias("_at", "_anchor"))
    near = stage(said.join(index, "_anchor").filter("_at >= _offset"), "near")
    return (rows.join(near, "_row").filter(STANDS)
            .select(*keep, "type", (F.col("_at") - F.col("_offset")).alias("ord"), "mention"))


def place_mentions(texts: DataFrame, gazetteer: DataFrame, keep=("doc_id",)) -> DataFrame:
    """One row per mention of a gazetteer entry: (*keep, type, ord, mention)."""
    index = stage(place_index(gazetteer), "index")
    listed = listed_places(index)
    if listed is not None:
        return _inlined(texts, F.expr(listed), keep)
    if not fits(index):
        return _places_of_many(texts, index, keep)
    rows = texts.withColumn("_words", place_words()).select(*keep, "_words", F.posexplode("_words").alias("_at", "_anchor"))
    return (rows.join(F.broadcast(index), "_anchor").filter(STANDS)
            .select(*keep, "type", (F.col("_at") - F.col("_offset")).alias("ord"), "mention"))


def sentences_with_type(sentences: DataFrame, kind: str, patterns: dict) -> DataFrame:
    """Keep sentences that mention the given pattern type."""
    return sentences.filter(F.col("text").rlike(patterns[kind]))


def sentences_with_place(sentences: DataFrame, gazetteer: DataFrame, kind: str, key) -> DataFrame:
    """Keep sentences that mention a gazetteer entry of the given type; `key` names the sentence id columns."""
    chosen, key = gazetteer.filter(F.col("type") == kind), list(key)
    listed = listed_places(place_index(chosen)) if "text" in key else None
    if listed is not None:
        # A row's text is part of its key, so the row itself decides; a null key holds no mention, as in the join.
        return sentences.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in key)).filter(F.size(F.expr(listed)) > 0)
    return sentences.join(place_mentions(sentences, chosen, key).select(*key).distinct(), key, "left_semi")


RUN = r"(?:[Tt]he )?[A-Z][a-z]+(?: [A-Z][a-z]+)+"


def organisations(texts: DataFrame, keep=("doc_id",), min_share: float = 0.5, min_runs: int = 2) -> DataFrame:
    """One row per mention of an organisation: (*keep, type, ord, mention), by evidence of the whole corpus.

    A capitalised run of two words or more counts when its last word ends runs often enough: `min_runs` times, `min_share` of
    them after "the", as in "the Red Cross", "the Coast Guard". People, storms and most places go without the article. The
    texts are read twice, for the evidence and for the mentions.
    """
    runs = texts.select(*keep, F.posexplode(tx.find_all(F.col("text"), RUN)).alias("ord", "_run"))
    runs = runs.select(*keep, "ord", F.rlike("_run", F.lit("^[Tt]he ")).alias("_the"),
                       F.regexp_replace("_run", "^[Tt]he ", "").alias("mention"))
    runs = runs.withColumn("_head", F.element_at(F.split("mention", " "), -1)).filter("mention LIKE '% %'")
    heads = (runs.groupBy("_head").agg(F.count(F.lit(1)).alias("n"), F.count_if("_the").alias("after"))
             .filter((F.col("n") >= min_runs) & (F.col("after") >= min_share * F.col("n"))).select("_head"))
    return lookup_join(runs, heads, "_head").select(*keep, F.lit("ORG").alias("type"), "ord", "mention")


def mentions_of(mentions: DataFrame, kind: str) -> DataFrame:
    """Mentions of one type, everything but letters and digits replaced by spaces."""
    cleaned = F.regexp_replace("mention", "[^a-zA-Z0-9]", " ")
    return mentions.filter(F.col("type") == kind).withColumn("mention", cleaned)


def entity_count(mentions: DataFrame, by=()) -> DataFrame:
    """Occurrences of each mention text: (*by, mention, n)."""
    return mentions.groupBy(*by, "mention").agg(F.count(F.lit(1)).alias("n"))


def top_entities(mentions: DataFrame, k: int = 50) -> DataFrame:
    """The k most frequent mention texts, ties in order of the text."""
    return entity_count(mentions).orderBy(F.desc("n"), "mention").limit(k)
