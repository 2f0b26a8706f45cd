"""Text operators: tokens, sentences, tags, filters, lemmas, n-grams.

Without lookup tables every step stays inside the row (no shuffle). A lexicon or dictionary table turns the steps that
need it into lookup joins over the exploded tokens.
"""

from pyspark.sql import DataFrame, functions as F

from gleaner.functions import text as tx, vocab
from gleaner.functions.joins import lookup_join


def tokens(records: DataFrame, lowercase: bool = True, key: str = "doc_id") -> DataFrame:
    """One row per word token: (key, pos, token)."""
    return records.select(key, F.posexplode(tx.words("text", lowercase)).alias("pos", "token"))


def whitespace_tokens(records: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lowercase tokens split at white space; empty ones are dropped."""
    parts = F.split(F.lower("text"), r"\s")
    return records.select(key, F.posexplode(parts).alias("pos", "token")).filter("token <> ''")


def sentences(records: DataFrame, min_length: int = 20, key: str = "doc_id") -> DataFrame:
    """One row per sentence of at least `min_length` characters: (key, sent_no, text), plus the url when present."""
    carried = [key] + [c for c in ("url",) if c in records.columns]
    # The outer form: for the inner one Spark adds a size filter that splits the text a second time.
    return (records.select(*carried, F.posexplode_outer(tx.split_sentences(F.col("text"))).alias("sent_no", "text"))
            .filter("sent_no IS NOT NULL")
            .filter(F.length("text") >= min_length))


def tag_tokens(tokens: DataFrame, lexicon: DataFrame = None, suffix_tags=None) -> DataFrame:
    """Add a part-of-speech tag: from lexicon(token, tag, lemma) when it has the token, else by rule."""
    rule = tx.rule_tag("token", suffix_tags)
    if lexicon is None:
        return tokens.withColumn("tag", rule)
    known = lexicon.select("token", F.col("tag").alias("_tag"), F.col("lemma").alias("_lemma"))
    joined = lookup_join(tokens, known, "token", "left")
    return joined.withColumn("tag", F.coalesce("_tag", rule)).drop("_tag")


def drop_stop_words(tokens: DataFrame, stop=None) -> DataFrame:
    """Drop stop words, given as a list or as a table with a `token` column of lowercase words."""
    if isinstance(stop, DataFrame):
        lowered = tokens.withColumn("_lower", F.lower("token"))
        return lookup_join(lowered, stop.select(F.col("token").alias("_lower")), "_lower", "left_anti").drop("_lower")
    return tokens.filter(~tx.is_stop("token", vocab.stop_words() if stop is None else stop))


def keep_dictionary_words(tagged: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Keep words of dictionary(token), and proper nouns."""
    marked = _mark_dictionary(tagged, dictionary)
    return marked.filter(F.col("_known") | F.col("tag").isin(*vocab.PROPER_TAGS)).drop("_known")


def _mark_dictionary(tagged, dictionary):
    listed = dictionary.select("token").distinct().withColumn("_known", F.lit(True))
    return lookup_join(tagged, listed, "token", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))


def drop_numeric(tokens: DataFrame) -> DataFrame:
    """Drop tokens that are plain numbers."""
    return tokens.filter(~tx.is_numeric("token"))


def keep_word_tags(tagged: DataFrame) -> DataFrame:
    """Keep tokens with a known word tag (drops punctuation)."""
    return tagged.filter(F.col("tag").isin(*vocab.TAG_CLASSES))


def lemmatize(tagged: DataFrame, endings=None) -> DataFrame:
    """Add the lemma: the lexicon's one when the token was found there, else by rule from the tag's class."""
    rule = tx.rule_lemma("token", "tag", endings)
    if "_lemma" not in tagged.columns:
        return tagged.withColumn("lemma", rule)
    return tagged.withColumn("lemma", F.coalesce("_lemma", rule)).drop("_lemma")


def lemma_tokens(records: DataFrame, lexicon: DataFrame = None, dictionary: DataFrame = None, stop=None,
                 lowercase: bool = True, key: str = "doc_id") -> DataFrame:
    """The whole preprocessing chain as rows (key, pos, token, tag, lemma)."""
    df = tag_tokens(tokens(records, lowercase, key), lexicon)
    df = drop_numeric(drop_stop_words(df, stop))
    if dictionary is not None:
        df = keep_dictionary_words(df, dictionary)
    return lemmatize(keep_word_tags(df))


def lemma_lists(records: DataFrame, lexicon: DataFrame = None, dictionary: DataFrame = None, stop=None,
                lowercase: bool = True, key: str = "doc_id", keep=()) -> DataFrame:
    """The preprocessing chain as one row per record: (key, *keep, lemmas); records without lemmas stay."""
    stop = vocab.stop_words() if stop is None else stop
    if lexicon is None and dictionary is None and not isinstance(stop, DataFrame):
        return records.select(key, *keep, tx.content_lemmas("text", stop, lowercase).alias("lemmas"))
    # Kept positions are collected per record; the token rows of a record leave one task, so its list is built there
    # and only finished lists are shuffled.
    kept = lemma_tokens(records, lexicon, dictionary, stop, lowercase, key)
    rows = kept.select(key, "pos", "lemma").unionByName(records.select(key), allowMissingColumns=True)
    packed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.when(
        F.col("pos").isNotNull(), F.struct("pos", "lemma")))).getField("lemma").alias("lemmas"))
    return packed if not keep else records.select(key, *keep).join(packed, key)


def tagged_lists(records: DataFrame, stop=None, lowercase: bool = True, key: str = "doc_id") -> DataFrame:
    """One row per record with an array of (lemma, tag) of the surviving tokens, tagged by rule."""
    stop = vocab.stop_words() if stop is None else stop
    return records.select(key, tx.tagged_lemmas("text", stop, lowercase).alias("tagged"))


def bigrams(lists: DataFrame, key: str = "doc_id") -> DataFrame:
    """Neighbouring surviving lemmas: (key, pos, bigram)."""
    return lists.select(key, F.posexplode(tx.pairs(F.col("lemmas"))).alias("pos", "bigram"))


def regex_matches(texts: DataFrame, pattern: str, group: int = 1, keep=("doc_id",)) -> DataFrame:
    """One row per match of a pattern: (*keep, match)."""
    return texts.select(*keep, F.explode(tx.find_all(F.col("text"), pattern, group)).alias("match"))


def matching_sentences(sentences: DataFrame, pattern: str) -> DataFrame:
    """Keep sentences in which a pattern occurs."""
    return sentences.filter(F.col("text").rlike(pattern))


def relevant_sentences(sentences: DataFrame, keywords) -> DataFrame:
    """Keep sentences that contain any of the keywords, case-sensitively."""
    hit = F.lit(False)
    for word in keywords:
        hit = hit | F.contains(F.col("text"), F.lit(word))
    return sentences.filter(hit)
