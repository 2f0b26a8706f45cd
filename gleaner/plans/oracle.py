"""The registered queries in ANSI SQL over the same tables, for comparison."""

import re

from gleaner.functions import numbers as nb, sampling, text as tx, vocab
from gleaner.operators import mentions as mn, slots as sl
from gleaner.plans import tables as t

ORACLE = {}
PARTS = {}  # named subqueries; @name refers to another one


def lit(text):
    return "'" + text.replace("'", "''") + "'"


def among(words):
    return "(" + ", ".join(lit(w) for w in words) + ")"


def part(name, sql):
    PARTS[name] = sql


def oracle(name, sql, *needs):
    wanted, todo = set(), list(needs)
    while todo:
        n = todo.pop()
        if n not in wanted:
            wanted.add(n)
            todo += [m for m in re.findall(r"@(\w+)", PARTS[n]) if m in PARTS]
    order = [n for n in PARTS if n in wanted]
    body = ", ".join(f"{n} AS ({re.sub(r'@(?=[a-z])', '', PARTS[n])})" for n in order)
    ORACLE[name] = (f"WITH {body} " if order else "") + sql


def tag_sql(token):
    suffixes = " ".join(f"WHEN {token} LIKE '%{s}' THEN '{vocab.SUFFIX_TAGS[s]}'"
                        for s in sorted(vocab.SUFFIX_TAGS, key=lambda s: (-len(s), s)))
    return (f"CASE WHEN NOT regexp_matches({token}, '[\\p{{L}}\\p{{N}}]') THEN {token} "
            f"WHEN regexp_matches({token}, '^[0-9]') THEN 'CD' WHEN regexp_matches({token}, '^\\p{{Lu}}') THEN 'NNP' "
            f"{suffixes} ELSE '{vocab.DEFAULT_TAG}' END")


def lemma_sql(token, tag):
    verbs = among([g for g, c in vocab.TAG_CLASSES.items() if c == "v"])
    cases = " ".join(f"WHEN {token} LIKE '%{e}' AND length({token}) >= {len(e) + 2} AND {tag} IN {verbs} "
                     f"THEN left({token}, length({token}) - {len(e)})"
                     for e in sorted(vocab.VERB_ENDINGS, key=lambda s: (-len(s), s)))
    return f"CASE {cases} ELSE {token} END"


STOP = among(vocab.stop_words())
TAGS = among(vocab.TAG_CLASSES)


def words_sql(text, lowercase=True):
    plain = f"replace({text}, '’', '''')"
    return f"regexp_extract_all({f'lower({plain})' if lowercase else plain}, {lit(tx.WORD)})"


def unnest_tokens(source, key, lowercase=True):
    return (f"SELECT {key}, CAST(unnest(range(0, len(a))) AS INTEGER) AS pos, unnest(a) AS token "
            f"FROM (SELECT {key}, {words_sql('text', lowercase)} AS a FROM {source})")


def sentence_rows(source, keys):
    text = "text"
    for pattern, aside in tx.kept_marks():
        text = f"regexp_replace({text}, {lit(pattern)}, '\\1{aside}\\2', 'g')"
    return (f"SELECT {keys}, CAST(unnest(range(0, len(a))) AS INTEGER) AS sent_no, unnest(a) AS text FROM (SELECT "
            f"{keys}, list_transform(regexp_extract_all({text}, {lit(tx.SENTENCE)}), lambda s: trim(translate(s, "
            f"'{tx.ASIDE}', '{tx.MARKS}'))) AS a FROM {source})")


content = f"token NOT IN {STOP} AND NOT regexp_matches(token, {lit(tx.NUMERIC)}) AND tag IN {TAGS}"

part("docs", "SELECT doc_id, lang, source AS url, text, n_chars FROM documents WHERE length(text) > 99")
part("tok", unnest_tokens("@docs", "doc_id"))
part("cased", unnest_tokens("@docs", "doc_id", False))
part("tagged", f"SELECT *, {tag_sql('token')} AS tag FROM @tok")
part("lem", f"SELECT doc_id, pos, token, tag, {lemma_sql('token', 'tag')} AS lemma FROM @tagged WHERE {content}")
part("lemr", "SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS rn FROM @lem")
part("bg", "SELECT doc_id, rn AS pos, lemma || ' ' || nxt AS bigram FROM (SELECT *, lead(lemma) OVER (PARTITION BY "
           "doc_id ORDER BY rn) AS nxt FROM @lemr) WHERE nxt IS NOT NULL")
part("wc", "SELECT lemma, count(*) AS n FROM @lem GROUP BY lemma")
part("bgc", "SELECT bigram, count(*) AS n FROM @bg GROUP BY bigram")
part("dfs", "SELECT lemma, count(DISTINCT doc_id) AS df FROM @lem GROUP BY lemma")
part("size", "SELECT count(*) AS docs FROM @docs")
part("total", "SELECT CAST(sum(n) AS BIGINT) AS total FROM @wc")
part("weighed", "SELECT lemma, n, df, round(n / total * log10(docs / df), 12) AS score FROM @wc JOIN @dfs USING (lemma), "
                "@size, @total WHERE df > docs * CAST(0.1 AS DOUBLE)")
part("top20", "SELECT * FROM @weighed ORDER BY score DESC, lemma LIMIT 20")
part("dict", "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS token FROM benchmark")
part("lex", "SELECT token, CASE WHEN token LIKE '%er' THEN 'JJR' ELSE 'NNS' END AS tag, left(token, length(token) - 2) "
            "AS lemma FROM @dict WHERE length(token) >= 4 AND (token LIKE '%er' OR token LIKE '%es')")
part("lextag", "SELECT g.doc_id, g.pos, g.token, coalesce(x.tag, g.tag) AS tag, x.lemma AS known FROM @tagged g "
               "LEFT JOIN @lex x USING (token)")
part("lexlem", f"SELECT doc_id, pos, token, tag, coalesce(known, {lemma_sql('token', 'tag')}) AS lemma FROM @lextag "
               f"WHERE tag IN {TAGS}")
part("sents", f"SELECT * FROM ({sentence_rows('@docs', 'doc_id, url')})")
part("sents20", "SELECT * FROM @sents WHERE length(text) >= 20")

# Sources and sinks
oracle("scan_records", "SELECT doc_id, url, text FROM docs", "docs")
part("graded", "SELECT docs.*, coalesce(CAST(quality AS DOUBLE), -1.0) AS label FROM @docs LEFT JOIN labels USING (doc_id)")
oracle("load_labeled", "SELECT doc_id AS id, CAST(NULL AS BIGINT) AS record_id, url AS \"URL_s\", text AS record, label "
       "FROM graded WHERE label IN (0, 1)", "graded")
oracle("summary_text", "SELECT item_id, replace(text, chr(10), ' ') AS text FROM benchmark")
oracle("roundtrip_json", "SELECT url, text FROM docs", "docs")

# Text
oracle("tokens", "SELECT doc_id, pos, token FROM tok", "tok")
oracle("tokens_cased", "SELECT doc_id, pos, token FROM cased", "cased")
oracle("tokens_ws", "SELECT doc_id, token FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s')) AS token "
       "FROM docs) WHERE token <> ''", "docs")
oracle("sentences", "SELECT doc_id, url, sent_no, text FROM sents20", "sents20")
oracle("filter_stopwords", f"SELECT * FROM tok WHERE token NOT IN {STOP}", "tok")
oracle("filter_dictionary", f"SELECT doc_id, pos, token, tag FROM (SELECT *, {tag_sql('token')} AS tag FROM cased) WHERE "
       f"tag IN {among(vocab.PROPER_TAGS)} OR token IN (SELECT token FROM dict)", "cased", "dict")
oracle("filter_numeric", f"SELECT * FROM tok WHERE NOT regexp_matches(token, {lit(tx.NUMERIC)})", "tok")
oracle("filter_tags", f"SELECT * FROM tagged WHERE tag IN {TAGS}", "tagged")
oracle("pos_tag", "SELECT doc_id, pos, token, tag FROM lextag", "lextag")
oracle("lemmatize", "SELECT doc_id, pos, token, tag, lemma FROM lexlem", "lexlem")
oracle("preprocess", "SELECT doc_id, coalesce(lemmas, '') AS lemmas FROM docs LEFT JOIN (SELECT doc_id, string_agg(lemma, "
       f"' ' ORDER BY pos) AS lemmas FROM lexlem WHERE {content} AND (token IN (SELECT token FROM dict) OR tag IN "
       f"{among(vocab.PROPER_TAGS)}) GROUP BY doc_id) USING (doc_id)", "docs", "lexlem", "dict")
oracle("bigrams", "SELECT * FROM bg", "bg")
oracle("regex_matches", "SELECT doc_id, unnest(regexp_extract_all(text, '([A-Z][a-z]+) License', 1)) AS match FROM docs",
       "docs")
oracle("regex_sentences", "SELECT doc_id, sent_no, text FROM sents20 WHERE regexp_matches(text, '[0-9]{3}')", "sents20")
oracle("relevant_sentences", "SELECT doc_id, sent_no, text FROM sents20 WHERE contains(text, 'License') OR "
       "contains(text, 'license') OR contains(text, 'Copyright')", "sents20")

# Words
oracle("word_count", "SELECT * FROM wc", "wc")
oracle("top_words", "SELECT * FROM wc ORDER BY n DESC, lemma LIMIT 20", "wc")
oracle("bigram_count", "SELECT * FROM bgc", "bgc")
oracle("top_bigrams", "SELECT * FROM bgc ORDER BY n DESC, bigram LIMIT 10", "bgc")
oracle("cooccurrence", "SELECT bigram, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT lemma || ' ' || lead(lemma, {i}) OVER (PARTITION BY doc_id ORDER BY rn) AS bigram FROM lemr"
    for i in range(1, 5)) + ") WHERE bigram IS NOT NULL GROUP BY bigram", "lemr")
oracle("term_frequency", "SELECT lemma, n, round(n / total, 12) AS tf FROM wc, total", "wc", "total")
oracle("doc_frequency", "SELECT * FROM dfs", "dfs")
oracle("idf", "SELECT lemma, df, round(log10(docs / df), 9) AS idf FROM dfs, size WHERE df > docs * CAST(0.1 AS DOUBLE)",
       "dfs", "size")
oracle("tf_idf", "SELECT * FROM weighed", "weighed")
oracle("important_words", "SELECT * FROM top20", "top20")
CLASS = f"CASE WHEN tag IN {among(vocab.NOUN_TAGS)} THEN 'noun' WHEN tag IN {among(vocab.VERB_TAGS)} THEN 'verb' END"
part("classed", f"SELECT *, {CLASS} AS tag_class FROM @lem")
part("classes", "SELECT unnest(['noun', 'verb']) AS tag_class")
oracle("pos_words", "SELECT doc_id, tag_class, coalesce(words, '') AS words FROM (SELECT doc_id, tag_class FROM docs, "
       "classes) LEFT JOIN (SELECT doc_id, tag_class, string_agg(lemma, ' ' ORDER BY pos) AS words FROM classed GROUP BY "
       "ALL) USING (doc_id, tag_class)", "docs", "classes", "classed")
oracle("pos_tfidf", "SELECT tag_class, lemma, n, df, score FROM (SELECT *, row_number() OVER (PARTITION BY tag_class ORDER "
       "BY score DESC, lemma) AS r FROM (SELECT tag_class, lemma, n, df, docs, round(n / total * log10(docs / df), 12) AS "
       "score FROM (SELECT tag_class, lemma, count(*) AS n, count(DISTINCT doc_id) AS df FROM classed GROUP BY ALL) JOIN "
       "(SELECT tag_class, count(*) AS total FROM classed GROUP BY ALL) USING (tag_class), size WHERE tag_class IS NOT NULL "
       "AND df > docs * CAST(0.1 AS DOUBLE))) WHERE r <= (SELECT docs FROM size)", "classed", "size")
oracle("words_with_counts", "SELECT lemma, n FROM (SELECT lemma FROM top20) JOIN (SELECT * FROM wc ORDER BY n DESC, lemma "
       "LIMIT 200) USING (lemma)", "top20", "wc")
oracle("words_without_counts", "SELECT lemma FROM weighed WHERE lemma NOT IN (SELECT lemma FROM wc ORDER BY n DESC, lemma "
       "LIMIT 20)", "weighed", "wc")

# Synonyms and features
part("stems", "SELECT lemma, regexp_replace(lemma, '(tion|ing|ed|ly|ble)$', '') AS stem FROM @wc")
part("thes", "SELECT a.lemma AS word, b.lemma AS related FROM @stems a JOIN @stems b USING (stem) WHERE a.lemma <> b.lemma "
             "AND length(stem) >= 2")
part("rel", "SELECT word, related FROM @thes WHERE word IN (SELECT lemma FROM @wc) UNION SELECT lemma, lemma FROM @wc")
part("syn", "SELECT word, CAST(sum(n) AS BIGINT) AS total, string_agg(related, ' ' ORDER BY related) AS members FROM @rel "
            "JOIN @wc ON related = lemma GROUP BY word")
oracle("related_words", "SELECT * FROM rel", "rel")
oracle("synonym_groups", "SELECT * FROM syn", "syn")
oracle("top_synonym_groups", "SELECT * FROM syn WHERE total <> 0 ORDER BY total DESC, word LIMIT 20", "syn")


def merge_sql(bigrams, words):
    """Greedy merge of ranked bigrams(r, bigram) and words(r, lemma) as (position, kind, item)."""
    marked = "list_transform(list(bigram ORDER BY r), lambda b: '|' || replace(b, ' ', '|') || '|')"
    first, second = "'|' || split_part(x, '|', 2) || '|'", "'|' || split_part(x, '|', 3) || '|'"
    return (f"WITH listed AS (SELECT * FROM {bigrams} WHERE split_part(bigram, ' ', 1) <> split_part(bigram, ' ', 2) AND "
            f"split_part(bigram, ' ', 1) IN (SELECT lemma FROM {words}) AND split_part(bigram, ' ', 2) IN (SELECT lemma "
            f"FROM {words})), folded AS (SELECT list_reduce(list_concat([''], coalesce({marked}, [])), lambda acc, x: CASE "
            f"WHEN contains(acc, {first}) OR contains(acc, {second}) THEN acc ELSE acc || x END) AS s FROM listed), picked "
            f"AS (SELECT unnest(string_split(trim(s, '|'), '||')) AS p, unnest(range(0, len(string_split(trim(s, '|'), "
            f"'||')))) AS r FROM folded WHERE s <> ''), used AS (SELECT unnest(string_split(p, '|')) AS lemma FROM picked), "
            f"parts AS (SELECT 0 AS g, r, 'bigram' AS kind, replace(p, '|', ' ') AS item FROM picked UNION ALL SELECT 1, r, "
            f"'word', lemma FROM {words} WHERE lemma NOT IN (SELECT lemma FROM used)) SELECT CAST(row_number() OVER (ORDER "
            f"BY g, r) - 1 AS INTEGER) AS position, kind, item FROM parts")


part("bg20", "SELECT bigram, row_number() OVER (ORDER BY n DESC, bigram) AS r FROM @bgc QUALIFY r <= 20")
part("wc30", "SELECT lemma, row_number() OVER (ORDER BY n DESC, lemma) AS r FROM @wc QUALIFY r <= 30")
oracle("merge_collocations", f"SELECT * FROM ({merge_sql('bg20', 'wc30')})", "bg20", "wc30")
part("bg10", "SELECT bigram, row_number() OVER (ORDER BY n DESC, bigram) AS r FROM @bgc QUALIFY r <= 10")
part("iw20", "SELECT lemma, row_number() OVER (ORDER BY score DESC, lemma) AS r FROM @top20")
part("merged", merge_sql("@bg10", "@iw20"))
part("groups20", "SELECT word AS item, list(related ORDER BY related) AS members FROM (SELECT word, related FROM @thes "
                 "WHERE word IN (SELECT lemma FROM @iw20) AND related IN (SELECT lemma FROM @iw20) UNION SELECT lemma, "
                 "lemma FROM @iw20) GROUP BY word")
part("vocabulary", "SELECT position AS feature_id, CASE WHEN m.kind = 'word' AND len(members) > 1 THEN 'synset' ELSE m.kind "
                   "END AS kind, unnest(CASE WHEN m.kind = 'word' AND len(members) > 1 THEN members ELSE [m.item] END) AS "
                   "term FROM @merged m LEFT JOIN @groups20 g USING (item)")
part("fcounts", "SELECT doc_id, feature_id, CASE WHEN kind = 'synset' THEN count(DISTINCT term) ELSE count(*) END AS n FROM "
                "(SELECT doc_id, lemma AS term FROM @lem UNION ALL SELECT doc_id, bigram FROM @bg) JOIN @vocabulary USING "
                "(term) GROUP BY doc_id, feature_id, kind")
part("fdense", "SELECT doc_id, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY feature_id) AS counts, "
               "string_agg(CASE WHEN n > 0 THEN '1' ELSE '0' END, ',' ORDER BY feature_id) AS presence, CAST(count(n) AS "
               "DOUBLE) AS feature_count FROM (SELECT doc_id, feature_id FROM @docs, (SELECT DISTINCT feature_id FROM "
               "@vocabulary)) LEFT JOIN @fcounts USING (doc_id, feature_id) GROUP BY doc_id")
part("packed", "SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS lemmas FROM @lem GROUP BY doc_id")
oracle("feature_labels", "SELECT * FROM vocabulary", "vocabulary")
oracle("feature_counts", "SELECT * FROM fcounts", "fcounts")
oracle("feature_presence", "SELECT doc_id, presence FROM fdense", "fdense")
oracle("feature_dataset", "SELECT doc_id, url, text, coalesce(lemmas, '') AS lemmas, counts, presence FROM docs JOIN fdense "
       "USING (doc_id) LEFT JOIN packed USING (doc_id)", "docs", "fdense", "packed")

# Labels and samples
part("fstats", "SELECT avg(feature_count) AS mean, stddev_pop(feature_count) AS sd FROM @fdense")
part("auto", "SELECT doc_id, feature_count, CAST(CASE WHEN feature_count > mean + 2.0 * sd THEN 1 WHEN feature_count < 2 THEN "
             "0 ELSE -1 END AS DOUBLE) AS label FROM @fdense, @fstats")
oracle("feature_count", "SELECT doc_id, feature_count FROM fdense", "fdense")
oracle("feature_stats", "SELECT round(mean, 9) AS mean, round(sd, 9) AS sd FROM fstats", "fstats")
oracle("auto_label", "SELECT * FROM auto", "auto")
oracle("augment_records", f"SELECT doc_id, CASE WHEN contains(lower(text), '{t.PHRASE}') THEN label ELSE 0.0 END AS label "
       "FROM auto JOIN docs USING (doc_id)", "auto", "docs")
BAD = " OR ".join(f"contains(lower(text), {lit(b)})" for b in t.BOILERPLATE)
oracle("augment_sentences", f"SELECT doc_id, sent_no, CAST(CASE WHEN {BAD} OR length(lower(text)) < 20 OR length(lower(text)) "
       "> 400 THEN 0 ELSE -1 END AS DOUBLE) AS label, TRUE AS filtered FROM sents WHERE length(text) >= 1", "sents")
oracle("label_stats", "SELECT count(*) FILTER (label = 1) AS positive, count(*) FILTER (label = 0) AS negative, count(*) AS "
       "total FROM auto", "auto")


def uniform_sql(key, seed=""):
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '{seed}'), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


part("split", f"SELECT doc_id, label, CASE WHEN {uniform_sql('doc_id')} < CAST(0.7 AS DOUBLE) THEN 'train' ELSE 'test' END AS "
              "part FROM @graded WHERE label IN (0, 1)")
oracle("train_test_split", "SELECT * FROM split", "split")
oracle("undersample", "SELECT doc_id, label, CASE WHEN part = 'train' AND label = CASE WHEN pos > neg THEN 1 ELSE 0 END AND "
       f"{uniform_sql('doc_id', 'undersample')} >= least(pos, neg) / greatest(pos, neg, 1) THEN 'test' ELSE part END AS part "
       "FROM split, (SELECT count(*) FILTER (part = 'train' AND label = 1) AS pos, count(*) FILTER (part = 'train' AND label "
       "= 0) AS neg FROM split)", "split")
GUESS = f"CASE WHEN n_chars > {t.LONG_TEXT} THEN 1.0 ELSE 0.0 END"
part("judged", f"SELECT *, CAST(CASE WHEN label >= 0 THEN label ELSE {GUESS} END AS DOUBLE) AS final FROM @graded")
oracle("relevant_records", "SELECT doc_id, url, final AS label FROM judged WHERE final = 1", "judged")
oracle("accuracy", f"SELECT correct, total, round(correct / total, 9) AS accuracy FROM (SELECT count(*) FILTER (label = "
       f"{GUESS}) AS correct, count(*) AS total FROM graded WHERE label >= 0)", "graded")
oracle("prediction_profile", "SELECT final AS label, round(avg(feature_count), 9) AS mean, min(feature_count) AS min, "
       "max(feature_count) AS max FROM judged JOIN fdense USING (doc_id) GROUP BY final", "judged", "fdense")
oracle("chi2_features", "SELECT item, df, round(CASE WHEN (a + b) * (c + d) * (a + c) * (b + d) = 0 THEN 0 ELSE nn * pow(a * d "
       "- b * c, 2) / ((a + b) * (c + d) * (a + c) * (b + d)) END, 6) AS chi2 FROM (SELECT item, df, CAST(k AS DOUBLE) AS a, "
       "CAST(df - k AS DOUBLE) AS b, pp - CAST(k AS DOUBLE) AS c, nn - pp - CAST(df - k AS DOUBLE) AS d, nn FROM (SELECT "
       f"lemma AS item, count(*) AS df, count(*) FILTER (p = 1) AS k FROM (SELECT DISTINCT doc_id, lemma, {GUESS} AS p FROM "
       f"lem JOIN docs USING (doc_id)) GROUP BY lemma), (SELECT CAST(count(*) AS DOUBLE) AS nn, CAST(count(*) FILTER ({GUESS} "
       "= 1) AS DOUBLE) AS pp FROM docs)) ORDER BY chi2 DESC, item LIMIT 50", "lem", "docs")

# Clusters
oracle("count_vocab", "SELECT token AS term, count(*) AS n, count(DISTINCT doc_id) AS df FROM cased GROUP BY token HAVING "
       "count(DISTINCT doc_id) >= greatest(1, CAST(floor((SELECT docs FROM size) * CAST(0.1 AS DOUBLE)) AS BIGINT)) ORDER BY "
       "n DESC, term LIMIT 10000", "cased", "size")
part("termno", "SELECT lemma, n, df, row_number() OVER (ORDER BY n DESC, lemma) - 1 AS number FROM @wc JOIN @dfs USING (lemma)")
oracle("term_numbers", "SELECT * FROM termno", "termno")
VECTOR = ("SELECT doc_id, coalesce(string_agg(number, ',' ORDER BY number), '') AS numbers, coalesce(string_agg(c, ',' ORDER BY "
          "number), '') AS counts{} FROM docs LEFT JOIN (SELECT doc_id, number, count(*) AS c FROM {} GROUP BY ALL) "
          "USING (doc_id) GROUP BY doc_id")
oracle("term_vectors", VECTOR.format(", (SELECT count(*) FROM termno) AS size", "lem JOIN termno USING (lemma)"), "docs", "lem", "termno")
part("casedno", "SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS number FROM @cased GROUP BY token HAVING "
     "count(DISTINCT doc_id) >= greatest(1, CAST(floor((SELECT docs FROM @size) * CAST(0.1 AS DOUBLE)) AS BIGINT)) QUALIFY number < 10000")
oracle("count_vectors", VECTOR.format("", "cased JOIN casedno USING (token)"), "docs", "cased", "casedno")
oracle("cluster_sizes", "SELECT label AS cluster, count(*) AS size FROM embeddings GROUP BY label")
oracle("cluster_size_stats", "SELECT min(size) AS min, quantile_cont(size, 0.5) AS median, quantile_cont(size, 0.75) - "
       "quantile_cont(size, 0.25) AS iqr, max(size) AS max FROM (SELECT count(*) AS size FROM embeddings GROUP BY label)")

# Mentions
part("found", " UNION ALL ".join(
    f"SELECT doc_id, lang, '{kind}' AS type, CAST(unnest(range(0, len(a))) AS INTEGER) AS ord, unnest(a) AS mention FROM "
    f"(SELECT doc_id, lang, regexp_extract_all(text, {lit(p)}) AS a FROM @docs)" for kind, p in t.PATTERNS.items()))
oracle("mentions", "SELECT doc_id, type, ord, mention FROM found", "found")
oracle("mentions_clean", "SELECT doc_id, ord, regexp_replace(mention, '[^a-zA-Z0-9]', ' ', 'g') AS mention FROM found WHERE "
       "type = 'EMAIL'", "found")
oracle("entity_count", "SELECT mention, count(*) AS n FROM found GROUP BY mention", "found")
oracle("top_entities", "SELECT mention, count(*) AS n FROM found GROUP BY mention ORDER BY n DESC, mention LIMIT 50", "found")
oracle("entity_coverage", "SELECT shared, golden, CASE WHEN golden > 0 THEN round(shared / golden, 9) END AS coverage FROM "
       "(SELECT count(*) FILTER (mention IN (SELECT mention FROM found)) AS shared, count(*) AS golden FROM (" + " UNION ".join(
           f"SELECT unnest(regexp_extract_all(text, {lit(p)})) AS mention FROM benchmark" for p in t.PATTERNS.values()) + "))",
       "found")

MARKED = "' ' || array_to_string(regexp_extract_all(text, " + lit(mn.PLACE_WORD) + "), '  ') || ' '"
part("passages", f"SELECT min(text) AS mention, {MARKED} AS run FROM ({sentence_rows('benchmark', 'item_id')}) WHERE length(text) >= 20 "
     "GROUP BY run")
oracle("document_phrases", "SELECT doc_id, mention, CAST((length(t) - length(replace(t, run, ''))) / length(run) AS BIGINT) AS n FROM "
       f"(SELECT doc_id, {MARKED} AS t FROM docs) JOIN passages ON contains(t, run)", "docs", "passages")

# Event slots
part("reports", """SELECT event_key, CASE ln % 6
  WHEN 0 THEN concat('Hurricane ', nm, ' brought winds of ', q, ' miles per hour to ', n_name, ' on ', dt, '.')
  WHEN 1 THEN concat('Rain of ', q, ' inches fell on ', n_name, ' by ', dt, '.')
  WHEN 2 THEN concat('Hurricane ', nm, ' made landfall in ', n_name, ' as a Category ', ln, ' storm on ', dt, '.')
  WHEN 3 THEN concat('An evacuation moved ', q, '00 people out of ', n_name, '.')
  WHEN 4 THEN concat('Officials reported ', q, ' deaths after ', dt, '.')
  ELSE concat('The diameter of Tropical Storm ', nm, ' was ', q, '0 miles.') END AS text
FROM (SELECT r.r_name AS event_key, l.l_linenumber AS ln, n.n_name, CAST(CAST(l.l_quantity AS INT) AS VARCHAR) AS q,
  concat(upper(substr(r.r_name, 1, 1)), lower(substr(r.r_name, 2))) AS nm, strftime(o.o_orderdate, '%B %-d, %Y') AS dt
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)""")


def contains_sql(words):
    return "(" + " OR ".join(f"contains(text, {lit(w)})" for w in words) + ")"


WORDS = {**sl.KEYWORDS, **t.KEYWORDS}
MONTH_RE = f"(?:^|[^A-Za-z])({nb.MONTH})(?:[^A-Za-z]|$)"


def month_sql(text):
    cases = " ".join(f"WHEN starts_with(m, '{m[:3]}') THEN {i}" for i, m in enumerate(vocab.MONTHS, start=1))
    return f"(SELECT CASE {cases} END FROM (SELECT regexp_extract({text}, {lit(MONTH_RE)}, 1) AS m))"


def ints_sql(text, condition):
    return (f"list_filter(list_transform(regexp_extract_all({text}, '[0-9]+'), lambda x: TRY_CAST(x AS INTEGER)), lambda x: "
            f"{condition})")


YEARS, DAYS = "x > 1900", "x BETWEEN 1 AND 31"
part("quantities", f"SELECT event_key, text, unnest(regexp_extract_all(text, {lit(mn.QUANTITY)})) AS mention FROM @reports")
part("dates", f"SELECT event_key, text, unnest(regexp_extract_all(text, {lit(nb.DATE)})) AS value FROM @reports")
part("dated", f"SELECT event_key, text, value, {month_sql('value')} AS month, {ints_sql('value', DAYS)}[-1] AS day, "
              f"{ints_sql('value', YEARS)}[-1] AS year FROM @dates")
part("datedfull", "SELECT *, TRY_CAST(lpad(CAST(year AS VARCHAR), 4, '0') || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || "
                  "'-' || lpad(CAST(day AS VARCHAR), 2, '0') AS DATE) AS date FROM @dated")


def number_sql(text):
    return (f"(SELECT CASE WHEN len(a) > 0 THEN list_sum(list_transform(a, lambda x: CAST(replace(x, ',', '') AS DOUBLE))) / "
            f"len(a) ELSE 0.0 END FROM (SELECT regexp_extract_all({text}, {lit(nb.NUMBER)}) AS a))")


def convert_sql(text, units, first, second, formula):
    return (f"CASE WHEN regexp_matches({text}, {lit(nb.bounded(units[first]))}) THEN {number_sql(text)} WHEN "
            f"regexp_matches({text}, {lit(nb.bounded(units[second]))}) THEN {formula(number_sql(text))} ELSE -1.0 END")


MPH = convert_sql("mention", nb.SPEED_UNITS, "mph", "kph", lambda x: f"{x} * CAST({nb.KPH_TO_MPH} AS DOUBLE)")
INCHES = convert_sql("mention", nb.LENGTH_UNITS, "inch", "cm", lambda x: f"{x} / CAST({nb.CM_PER_INCH} AS DOUBLE)")
part("qcounts", "SELECT event_key, mention, count(*) AS n FROM @quantities GROUP BY ALL")
oracle("convert_mph", f"SELECT *, round({MPH}, 6) AS mph FROM qcounts", "qcounts")
oracle("convert_inches", f"SELECT *, round({INCHES}, 6) AS inches FROM qcounts", "qcounts")
oracle("date_parts", "SELECT event_key, value, month, day, year, date, count(*) AS n FROM datedfull GROUP BY ALL", "datedfull")
oracle("sentences_with_type", f"SELECT * FROM reports WHERE regexp_matches(text, {lit(mn.QUANTITY)})", "reports")


def matches_sql(slot, pattern, topic=None):
    where = f" WHERE {contains_sql(WORDS[topic])}" if topic else ""
    return (f"SELECT event_key, '{slot}' AS slot, unnest(regexp_extract_all(text, {lit(pattern)}, 1)) AS value FROM @reports"
            f"{where}")


def mode_sql(source, extra="slot, "):
    return (f"SELECT event_key, {extra}value, n FROM (SELECT *, row_number() OVER (PARTITION BY event_key, slot ORDER BY n "
            f"DESC, value) AS r FROM (SELECT event_key, slot, value, count(*) AS n FROM {source} GROUP BY ALL)) WHERE r = 1")


part("named", matches_sql("name", sl.EVENT_NAME) + " UNION ALL " + matches_sql("storm", sl.STORM_NAME) + " UNION ALL "
     + matches_sql("category", sl.CATEGORY))
oracle("slot_mode", mode_sql("named"), "named")
part("heads", matches_sql("headcount", "([0-9][0-9,]*) people", "evacuation"))
oracle("slot_headcount", mode_sql("heads", ""), "heads")
part("runs", "SELECT event_key, text, unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: w[i] || "
             "' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + "
             f"2])))) AS value FROM (SELECT event_key, text, regexp_extract_all(text, {lit(mn.PLACE_WORD)}) AS w FROM "
             "@reports)")
part("places", "SELECT event_key, text, value FROM @runs WHERE value IN (SELECT n_name FROM nation)")
oracle("sentences_with_place", "SELECT event_key, text, count(*) AS n FROM reports WHERE (event_key, text) IN (SELECT (event_key, "
       "text) FROM places) GROUP BY ALL", "reports", "places")
part("placed", " UNION ALL ".join(
    f"SELECT event_key, '{topic}_place' AS slot, {k} AS k, value FROM @places WHERE {contains_sql(WORDS[topic])}"
    for topic, k in (("landfall", 2), ("evacuation", 3))))
part("topplaces", "SELECT event_key, slot, CAST(r AS INTEGER) AS rank, value, n FROM (SELECT *, row_number() OVER (PARTITION "
     "BY event_key, slot ORDER BY n DESC, value) AS r FROM (SELECT event_key, slot, k, value, count(*) AS n FROM @placed GROUP "
     "BY ALL)) WHERE r <= k")
oracle("slot_top_places", "SELECT * FROM topplaces", "topplaces")
typed = ("SELECT event_key, text, 'QUANTITY' AS type, mention FROM quantities UNION ALL SELECT event_key, text, 'DATE', value "
         "FROM dates UNION ALL SELECT event_key, text, 'GPE', value FROM places")
ALLTYPES = ("SELECT event_key, type, mention, count(*) AS n FROM (" + typed + ") WHERE {} GROUP BY ALL")
oracle("mentions_places", ALLTYPES.format("TRUE"), "quantities", "dates", "places")
oracle("slot_mentions_by_type", ALLTYPES.format(contains_sql(WORDS["restoration"])), "quantities", "dates", "places")


def range_sql(values):
    return (f"SELECT event_key, CAST(trunc(m - s) AS INTEGER) AS low, CAST(trunc(m + s) AS INTEGER) AS high, CAST(trunc(m) AS "
            f"INTEGER) AS mean, CAST(trunc(s) AS INTEGER) AS sd FROM (SELECT event_key, avg(v) AS m, stddev_pop(v) AS s FROM "
            f"({values}) GROUP BY event_key)")


def unit_values(topic, convert, units, floor):
    return (f"SELECT event_key, {convert} AS v FROM @quantities WHERE {contains_sql(WORDS[topic])} AND "
            f"regexp_matches(mention, {lit(nb.bounded([u for g in units.values() for u in g]))}) AND {convert} > {floor}")


part("winds", range_sql(unit_values("wind", MPH, nb.SPEED_UNITS, 40)))
part("rains", range_sql(unit_values("rain", INCHES, nb.LENGTH_UNITS, -0.5)))
part("sizes", range_sql(
    "SELECT event_key, CASE WHEN contains(text, 'diameter') THEN 1 ELSE 2 END * TRY_CAST(replace(regexp_extract("
    f"mention, {lit(sl.MILES)}, 1), ',', '') AS DOUBLE) AS v FROM @quantities WHERE {contains_sql(WORDS['size'])} AND "
    f"regexp_matches(mention, {lit(sl.MILES)})"))
WORD_VALUES = " ".join(f"WHEN '{w}' THEN {n}" for w, n in vocab.NUMBER_WORDS.items())
part("tolls", range_sql(
    f"SELECT event_key, CAST(replace(unnest(regexp_extract_all(text, '({nb.NUMBER}) deaths', 1)), ',', '') AS DOUBLE) AS v "
    f"FROM @reports WHERE "
    f"{contains_sql(WORDS['deaths'])} UNION ALL SELECT event_key, v FROM (SELECT event_key, CASE w {WORD_VALUES} END AS v FROM "
    f"(SELECT event_key, unnest(regexp_extract_all(text, '([a-z]+) deaths', 1)) AS w FROM @reports WHERE "
    f"{contains_sql(WORDS['deaths'])})) WHERE v IS NOT NULL"))
oracle("slot_range", "SELECT event_key, low, high, mean FROM winds", "winds")
oracle("slot_range_len", "SELECT event_key, low, high, mean FROM rains", "rains")
oracle("slot_size", "SELECT event_key, mean, mean + sd AS high FROM sizes", "sizes")
oracle("slot_count_mean", "SELECT event_key, mean FROM tolls", "tolls")


def consensus_sql(where):
    return (f"WITH chosen AS (SELECT * FROM @dated WHERE month IS NOT NULL AND {where}), best AS (SELECT event_key, month FROM "
            "(SELECT event_key, month, row_number() OVER (PARTITION BY event_key ORDER BY count(*) DESC, month) AS r FROM "
            "chosen GROUP BY event_key, month) WHERE r = 1), inside AS (SELECT chosen.* FROM chosen JOIN best USING "
            "(event_key, month)), d AS (SELECT event_key, day FROM (SELECT event_key, day, row_number() OVER (PARTITION BY "
            "event_key ORDER BY count(*) DESC, day) AS r FROM inside GROUP BY event_key, day) WHERE r = 1), y AS (SELECT "
            "event_key, year FROM (SELECT event_key, year, row_number() OVER (PARTITION BY event_key ORDER BY count(*) DESC, "
            "year) AS r FROM inside GROUP BY event_key, year) WHERE r = 1), w AS (SELECT event_key, "
            f"[{', '.join(lit(m) for m in vocab.MONTHS)}][month] AS name, day, year FROM best JOIN d USING (event_key) JOIN y "
            "USING (event_key)) SELECT event_key, name || ' ' || day || ', ' || year AS date_text, name || ' ' || year AS "
            "month_year FROM w")


part("landed", consensus_sql(contains_sql(WORDS["landfall"])))
part("usual", consensus_sql("TRUE"))
oracle("slot_date_consensus", "SELECT event_key, date_text FROM landed", "landed")
oracle("slot_month_year", "SELECT event_key, month_year FROM usual", "usual")
part("modes", mode_sql("(SELECT * FROM @named UNION ALL SELECT * FROM @heads UNION ALL "
                       + matches_sql("landfall_category", sl.CATEGORY, "landfall") + ")"))
part("firsts", "SELECT event_key, min(date) AS first_date FROM @datedfull JOIN (SELECT event_key, value AS nm FROM @modes "
               "WHERE slot = 'name') USING (event_key) WHERE contains(text, nm) AND date IS NOT NULL GROUP BY event_key")
oracle("slot_first_date", "SELECT * FROM firsts", "firsts")
# Losses, help and times. Patterns and words are written out here, apart from those of the operators.
part("bulletins", """SELECT event_key, CASE (ok // 4) % 6
  WHEN 0 THEN concat('Damage of $', price, ' was reported in ', n_name, ' during ', mon, ' ', yr, '.')
  WHEN 1 THEN concat(k, ' people were injured in ', n_name, ' on ', d, '-', greatest(d, least(d + 2, 28)), ' ', mon, ' ', yr,
    ', and damages reached $', k, '.5 million.')
  WHEN 2 THEN concat('The toll rose to two deaths and ', k, ' injuries in ', yr, '.')
  WHEN 3 THEN concat('The Red Cross opened a shelter in ', n_name, ' with aid of ', k, ' million dollars on ', mon, ' ', d, ', ', yr, '.')
  WHEN 4 THEN concat('Damages of ', k, ' billion dollars and 1,', lpad(CAST(k AS VARCHAR), 3, '0'), ' injuries were counted by ', mon, '.')
  ELSE concat('Power was restored after three hundred injuries, said John ', list_aggregate(list_transform(string_split(n_name, ' '),
    lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' '), ' of the Coast Guard.') END AS text, ok
FROM (SELECT r.r_name AS event_key, o.o_orderkey AS ok, n.n_name, CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS VARCHAR) AS price,
  o.o_orderkey % 97 + 2 AS k, day(o.o_orderdate) AS d, strftime(o.o_orderdate, '%B') AS mon, strftime(o.o_orderdate, '%Y') AS yr
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)""")
MONTH_NAMES = "January|February|March|April|May|June|July|August|September|October|November|December"
TIMES = (f"\\b(?:[0-9]+-[0-9]+ (?:{MONTH_NAMES}) [0-9]{{4}}|(?:{MONTH_NAMES}) [0-9]+, [0-9]{{4}}|(?:{MONTH_NAMES}) [0-9]{{4}}"
         f"|by (?:{MONTH_NAMES})|in [0-9]{{4}})\\b")
# Words as rows: a number with the scale word after it, the nearest cue of its kind by distance, the later one on ties.
part("lossword", f"SELECT event_key, ok, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (SELECT event_key, ok, "
                 f"regexp_extract_all(lower(regexp_replace(text, '{TIMES}', '', 'g')), '[$]?[0-9][0-9,]*([.][0-9]+)?|[a-z_][a-z0-9_]*', 0) AS ws "
                 "FROM @bulletins)")
part("lossnext", "SELECT *, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM @lossword WINDOW o AS (PARTITION BY ok ORDER BY i)")
part("lossamount", "SELECT event_key, ok, i AS a, i + CASE WHEN s > 1 THEN 1 ELSE 0 END AS b, CAST(round(v * s) AS BIGINT) AS value, "
                   "starts_with(w, '$') OR (s > 1 AND w2 = 'dollars') AS money FROM (SELECT *, CASE w WHEN 'two' THEN 2 WHEN 'three' "
                   "THEN 3 ELSE TRY_CAST(replace(replace(w, '$', ''), ',', '') AS DOUBLE) END AS v, CASE w1 WHEN 'hundred' THEN 100 "
                   "WHEN 'million' THEN 1000000 WHEN 'billion' THEN 1000000000 ELSE 1 END AS s FROM @lossnext) WHERE v IS NOT NULL")
part("losscue", "SELECT ok, i, CASE WHEN w IN ('damage', 'damages') THEN 'damage' WHEN w IN ('injured', 'injuries') THEN 'injuries' "
                "ELSE 'deaths' END AS slot FROM @lossword WHERE w IN ('damage', 'damages', 'injured', 'injuries', 'death', 'deaths')")
part("losses", "SELECT event_key, slot, value, count(*) AS n FROM (SELECT m.*, slot, row_number() OVER (PARTITION BY ok, a ORDER BY CASE "
               "WHEN i > b THEN i - b ELSE a - i END, i < a) AS r FROM @lossamount m JOIN @losscue c USING (ok) WHERE (slot = 'damage') "
               "= money) WHERE r = 1 GROUP BY ALL")
oracle("slot_amounts", "SELECT * FROM losses", "losses")
for query, slot in (("slot_damage", "damage"), ("slot_injuries", "injuries")):
    oracle(query, "SELECT event_key, min(value) AS low, quantile_cont(CAST(value AS DOUBLE), 0.5) AS median, max(value) AS high, count(*) AS n FROM "
           f"(SELECT event_key, value, unnest(range(n)) FROM losses WHERE slot = '{slot}') GROUP BY event_key", "losses")
part("spans", "SELECT event_key, value, month, CASE WHEN year IS NULL THEN NULL WHEN month IS NULL THEN make_date(year, 1, 1) ELSE "
              "make_date(year, month, coalesce(d1, 1)) END AS first_day, CASE WHEN year IS NULL THEN NULL WHEN month IS NULL THEN "
              "make_date(year, 12, 31) WHEN d1 IS NULL THEN last_day(make_date(year, month, 1)) ELSE make_date(year, month, coalesce(d2, "
              "d1)) END AS last_day, n FROM (SELECT event_key, value, n, CAST(nullif(list_position(string_split('" + MONTH_NAMES + "', '|'), "
              "regexp_extract(value, '[A-Z][a-z]+')), 0) AS INTEGER) AS month, TRY_CAST(regexp_extract(value, '[0-9]{4}') AS INTEGER) AS "
              "year, TRY_CAST(nums[1] AS INTEGER) AS d1, TRY_CAST(nums[2] AS INTEGER) AS d2 FROM (SELECT event_key, value, count(*) AS n, "
              "regexp_extract_all(regexp_replace(value, '[0-9]{4}', ''), '[0-9]+') AS nums FROM (SELECT event_key, regexp_replace(unnest("
              f"regexp_extract_all(text, '{TIMES}')), '^(by|in) ', '') AS value FROM @bulletins) GROUP BY event_key, value))")
oracle("date_intervals", "SELECT * FROM spans", "spans")
oracle("slot_likely_period", "SELECT event_key, first_day, last_day, n FROM (SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY n "
       "DESC, first_day) AS r FROM (SELECT event_key, day AS first_day, CAST(lead(day) OVER o - INTERVAL 1 DAY AS DATE) AS last_day, "
       "CAST(sum(change) OVER o AS BIGINT) AS n FROM (SELECT event_key, day, sum(change) AS change FROM (SELECT event_key, first_day AS "
       "day, n AS change FROM spans WHERE first_day IS NOT NULL UNION ALL SELECT event_key, CAST(last_day + INTERVAL 1 DAY AS DATE), -n "
       "FROM spans WHERE first_day IS NOT NULL) GROUP BY ALL HAVING sum(change) <> 0) WINDOW o AS (PARTITION BY event_key ORDER BY day)) "
       "WHERE n > 0) WHERE r = 1", "spans")
# Months stand without year in no help sentence, and "Coast Guard" and "Red Cross" are the only runs after "the".
part("help", "SELECT event_key, text FROM @bulletins WHERE " + contains_sql(("restored", "restoration", "aid", "shelter")))
part("helpname", "SELECT event_key, unnest([x FOR x IN ['Red Cross', 'Coast Guard'] IF contains(text, 'he ' || x)]) AS mention FROM @help")
part("helptime", f"SELECT event_key, unnest(regexp_extract_all(text, '(?:{MONTH_NAMES}) [0-9]+, [0-9]{{4}}')) AS mention FROM @help")
part("helpplace", "SELECT event_key, n_name AS mention FROM @help JOIN nation ON regexp_matches(text, '\\b' || n_name || '\\b')")
oracle("slot_restoration", "SELECT event_key, type, mention, count(*) AS n FROM (SELECT event_key, 'ORG' AS type, mention FROM helpname "
       "UNION ALL SELECT event_key, 'DATE', mention FROM helptime UNION ALL SELECT event_key, 'GPE', mention FROM helpplace) GROUP BY ALL",
       "helpname", "helptime", "helpplace")
part("filled", """SELECT event_key, m.name, m.storm, m.category, m.landfall_category, m.headcount,
  p.landfall_place_1, p.landfall_place_2, p.evacuation_place_1, p.evacuation_place_2, p.evacuation_place_3,
  winds.low AS wind_low, winds.high AS wind_high, winds.mean AS wind_mean,
  rains.low AS rain_low, rains.high AS rain_high, rains.mean AS rain_mean,
  sizes.mean AS size_mean, sizes.mean + sizes.sd AS size_high,
  landed.date_text AS landfall_date, usual.month_year, strftime(firsts.first_date, '%B %-d, %Y') AS first_date
FROM (SELECT DISTINCT event_key FROM @reports)
  LEFT JOIN (SELECT event_key, """ + ", ".join(
    f"max(value) FILTER (slot = '{s}') AS {s}" for s in sl.MODAL) + """ FROM @modes GROUP BY 1) m USING (event_key)
  LEFT JOIN (SELECT event_key, """ + ", ".join(
    f"max(value) FILTER (slot = '{s}' AND rank = {i}) AS {s}_{i}" for s, k in (("landfall_place", 2), ("evacuation_place", 3))
    for i in range(1, k + 1)) + """ FROM @topplaces GROUP BY 1) p USING (event_key)
  LEFT JOIN @winds winds USING (event_key) LEFT JOIN @rains rains USING (event_key) LEFT JOIN @sizes sizes USING (event_key)
  LEFT JOIN @landed landed USING (event_key) LEFT JOIN @usual usual USING (event_key) LEFT JOIN @firsts firsts
  USING (event_key)""")


def outline_sql(text):
    pieces = [f"CAST({p[1:-1]} AS VARCHAR)" if p.startswith("{") else lit(p) for p in re.split(r"({\w+})", text) if p]
    return "trim(" + " || ".join(pieces) + ")"


oracle("slot_report", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT event_key, {i} AS sentence_no, '{name}' AS outline, {outline_sql(text)} AS text FROM filled"
    for i, (name, text) in enumerate(vocab.OUTLINES.items())) + ") WHERE text IS NOT NULL", "filled")

# Summaries
oracle("rebuild_records", "SELECT doc_id, url, string_agg(text, ' ' ORDER BY sent_no) AS text FROM (SELECT doc_id, url, text, "
       "min(sent_no) AS sent_no FROM sents20 GROUP BY ALL) GROUP BY doc_id, url HAVING count(*) >= 5", "sents20")
TITLE_WORDS = sorted(set(t.TITLE.split()))


def summary_parts(name, source, key, title):
    """<name>score: the score of each sentence of a source(key, sent_no, text); <name>summary: the five best of each record."""
    hits = f"count(*) FILTER (token IN {among(title)})" if title else "0"
    part(f"{name}tok", f"SELECT {key}, sent_no, token, count(*) AS n FROM (SELECT {key}, sent_no, token, {tag_sql('token')} AS tag "
                       f"FROM (SELECT {key}, sent_no, unnest({words_sql('text')}) AS token FROM {source})) WHERE {content} GROUP BY ALL")
    part(f"{name}score", f"SELECT {key}, sent_no, round(CAST(weight AS DOUBLE) / total / sqrt(length) + 1.5::DOUBLE * hits / "
         f"{max(1, len(title))} + 1.0::DOUBLE / (sent_no + 1), 9) AS score FROM (SELECT {key}, sent_no, CAST(sum(n * record_n) AS "
         f"BIGINT) AS weight, CAST(sum(n) AS BIGINT) AS length, {hits} AS hits, "
         f"CAST(sum(sum(n)) OVER (PARTITION BY {key}) AS BIGINT) AS total FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY {key}, "
         f"token) AS BIGINT) AS record_n FROM @{name}tok) GROUP BY {key}, sent_no)")
    part(f"{name}summary", f"SELECT {key}, string_agg(text, ' ' ORDER BY sent_no) AS summary FROM (SELECT {key}, sent_no, "
         f"row_number() OVER (PARTITION BY {key} ORDER BY score DESC, sent_no) AS r FROM @{name}score) JOIN {source} USING ({key}, "
         f"sent_no) WHERE r <= 5 GROUP BY {key}")


summary_parts("titled", "@sents", "doc_id", TITLE_WORDS)
oracle("sentence_scores", "SELECT doc_id, sent_no, score FROM titledscore", "titledscore")
oracle("doc_summary", "SELECT * FROM titledsummary", "titledsummary")
summary_parts("plain", "@sents", "doc_id", [])
part("leveltext", "SELECT rank, string_agg(text, ' ' ORDER BY r) AS text FROM (SELECT r // 20 AS rank, r, summary AS text FROM (SELECT "
     "summary, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM @plainsummary)) GROUP BY rank")
part("levelsents", f"SELECT * FROM ({sentence_rows('@leveltext', 'rank')})")
summary_parts("level", "@levelsents", "rank", TITLE_WORDS)
oracle("corpus_level", "SELECT rank, summary AS text FROM levelsummary", "levelsummary")

# Evaluation
KEPT = f"token NOT IN {STOP} AND regexp_matches(token, '[\\p{{L}}\\p{{N}}]')"


def gram_rows(name, source, key):
    """Stemmed tokens of a source as <name>t, and its 1-, 2- and skip-grams as <name>1, <name>2, <name>s."""
    part(f"{name}t", f"SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY pos) AS i, {lemma_sql('token', 'tag')} AS w "
                     f"FROM (SELECT *, {tag_sql('token')} AS tag FROM ({unnest_tokens(source, key)})) WHERE {KEPT}")
    part(f"{name}1", f"SELECT {key}, w AS gram FROM @{name}t")

    def ahead(k):
        return (f"SELECT {key}, gram FROM (SELECT {key}, w || ' ' || lead(w, {k}) OVER (PARTITION BY {key} ORDER BY i) AS gram "
                f"FROM @{name}t) WHERE gram IS NOT NULL")
    part(f"{name}2", ahead(1))
    part(f"{name}s", f"SELECT * FROM @{name}1 UNION ALL " + " UNION ALL ".join(ahead(k) for k in range(1, 6)))


gram_rows("pd", "@docs", "doc_id")
gram_rows("gd", "benchmark", "item_id")


def rouge_sql(kind):
    return (f"SELECT doc_id, round(CAST(sum(hits) AS BIGINT) / (SELECT count(*) FROM gd{kind}), 9) AS score FROM (SELECT "
            f"doc_id, least(p.n, g.n) AS hits FROM (SELECT doc_id, gram, count(*) AS n FROM pd{kind} GROUP BY ALL) p JOIN "
            f"(SELECT gram, count(*) AS n FROM gd{kind} GROUP BY ALL) g USING (gram) UNION ALL SELECT doc_id, 0 FROM docs) "
            f"GROUP BY doc_id")


for query, kind in (("rouge_1", "1"), ("rouge_2", "2"), ("rouge_su4", "s")):
    oracle(query, rouge_sql(kind), f"pd{kind}", f"gd{kind}", "docs")
gram_rows("reply", "(SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant')", "conv_id, turn")
gram_rows("prompt", "(SELECT conv_id, turn + 1 AS turn, text FROM conversations WHERE role = 'user')", "conv_id, turn")
# A fold over the places where both texts hold the same word, the last one first for each word of the reply: s holds the least end of
# a common subsequence of each length.
SUBSEQUENCE = ("len(list_reduce(list_concat([CAST([] AS BIGINT[])], list_transform(places, lambda x: [x])), lambda s, x: list_concat("
               "list_concat(list_filter(s, lambda v: v < x[1]), x), s[len(list_filter(s, lambda v: v < x[1])) + 2:])))")
oracle("rouge_l", f"SELECT conv_id, turn, CASE WHEN n > 0 THEN round(coalesce({SUBSEQUENCE}, 0) / n, 9) END AS score FROM (SELECT conv_id, "
       "turn FROM conversations WHERE role = 'assistant') LEFT JOIN (SELECT conv_id, turn, count(*) AS n FROM promptt GROUP BY ALL) USING "
       "(conv_id, turn) LEFT JOIN (SELECT conv_id, turn, list(g.i ORDER BY p.i, g.i DESC) AS places FROM replyt p JOIN promptt g USING "
       "(conv_id, turn, w) GROUP BY ALL) USING (conv_id, turn)", "replyt", "promptt")
DIGITS = "substr(md5(CAST(doc_id AS VARCHAR) || '/' || CAST(r // 4 AS VARCHAR)), CAST(8 * (r % 4) + 1 AS INTEGER), 8)"
DRAW = " + ".join(f"CASE WHEN h >= '{cut}' THEN 1 ELSE 0 END" for cut in sampling.POISSON_THRESHOLDS)
oracle("rouge_bootstrap", "SELECT round(avg(m), 6) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, "
       f"0.975), 6) AS high FROM (SELECT r, sum(score * w) / sum(w) AS m FROM (SELECT r, score, {DRAW} AS w FROM (SELECT r, "
       f"score, {DIGITS} AS h FROM ({rouge_sql('1')}), (SELECT unnest(range(0, 1000)) AS r))) GROUP BY r)",
       "pd1", "gd1", "docs")
part("psent", "SELECT doc_id * 1000000 + sent_no AS k, text FROM @sents20")
part("gsent", "SELECT item_id * 1000000 + sent_no AS k, text FROM (" + sentence_rows("benchmark", "item_id")
     + ") WHERE length(text) >= 20")
gram_rows("ps", "@psent", "k")
gram_rows("gs", "@gsent", "k")


def best_sql(kind):
    return (f"SELECT 'rouge_{kind}' AS metric, round(score, 9) AS score, pk // 1000000 AS predicted_doc_id, CAST(pk % 1000000 "
            f"AS INTEGER) AS predicted_sent_no, gk // 1000000 AS golden_item_id, CAST(gk % 1000000 AS INTEGER) AS "
            f"golden_sent_no, (SELECT text FROM psent WHERE k = pk) AS predicted_text, (SELECT text FROM gsent WHERE k = gk) AS "
            f"golden_text FROM (SELECT p.k AS pk, g.k AS gk, CAST(sum(least(p.n, g.n)) AS BIGINT) / any_value(m) AS score "
            f"FROM (SELECT k, gram, count(*) AS n FROM ps{kind} GROUP BY ALL) p JOIN (SELECT k, gram, count(*) AS n, "
            f"CAST(sum(count(*)) OVER (PARTITION BY k) AS BIGINT) AS m FROM gs{kind} GROUP BY k, gram) g USING (gram) GROUP BY "
            f"p.k, g.k ORDER BY score DESC, pk, gk LIMIT 1)")


oracle("rouge_best_pair", f"SELECT * FROM ({best_sql('1')}) UNION ALL SELECT * FROM ({best_sql('2')})", "ps1", "gs1", "ps2",
       "gs2", "psent", "gsent")
