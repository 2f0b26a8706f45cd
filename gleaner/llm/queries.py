"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

import public_tokenizers
from pyspark.sql import functions as F

from gleaner.llm import (ann, bpe, descent, interactions, lengths, licenses, lines, negatives, ngram_join, packing, quality,
                         shards, substring)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark, sf, name="documents"):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_ngram_join(spark, sf):
    """Class and number of links of every document."""
    return ngram_join.classes(_table(spark, sf))


def op2_substring_dedup(spark, sf):
    """Every text without passages that occur earlier, and where they stood."""
    found = substring.dedup(_table(spark, sf).select("doc_id", "text"))
    size = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("removed_chars", size)


def op3_hilbert_neighbours(spark, sf):
    """The 20 nearest others of every 20th vector."""
    return ann.neighbours(_table(spark, sf, "embeddings"))


def op4_power_packing(spark, sf):
    """Pieces of binary length, each a sequence of its own."""
    found = packing.pack(_table(spark, sf), WORD_BPE)
    return found.select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens",
                        "sequence_id", "offset", "bucket")


def op5_lexicon_bpe(spark, sf):
    """Digests of every document's ids and of the text that they decode to."""
    docs = _table(spark, sf)
    image = bpe.compiled(bpe.frequent_words(docs, BYTE_BPE), BYTE_BPE)
    found = bpe.decode(bpe.encode(docs, BYTE_BPE, image), BYTE_BPE)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def op6_sampled_splitters(spark, sf):
    """Shards of near equal size in order of doc_id."""
    found = shards.shard(_table(spark, sf))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op7_line_windows(spark, sf):
    """Every text without the lines that later three-line windows cover, and their numbers."""
    found = lines.dedup_lines(_table(spark, sf).select("doc_id", "text"))
    return found.withColumn("removed_lines", F.array_join(F.col("removed_lines").cast("array<string>"), ","))


def op8_length_histogram(spark, sf):
    """What holds at every context limit, over all documents."""
    return lengths.suffix_sums(lengths.histogram(lengths.encoded_lengths(_table(spark, sf), BYTE_BPE)))


def op9_license_join(spark, sf):
    """Phrases and license notices of every document."""
    return licenses.scan(_table(spark, sf))


def op10_weak_supervision(spark, sf):
    """Base counts and verdict of every document."""
    return quality.assess(_table(spark, sf)).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "posterior", *[f"vote_{r}" for r in quality.RULES])


def op11_nn_descent(spark, sf):
    """Links, component and whether it stays, of every vector."""
    return descent.near_duplicates(_table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_threshold_negatives(spark, sf):
    """Up to ten hard negatives for each of the five positives of every 100th vector."""
    rows = _table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(256 * x))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite).select("vec_id", moved.alias("label"), whole.alias("embedding"))
    return negatives.hard_negatives(rows)


def op13_filter_potentials(spark, sf):
    """What five filters remove in every order, and their Shapley shares, per language."""
    return interactions.audit(_table(spark, sf), _table(spark, sf, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_substring_dedup, op3_hilbert_neighbours, op4_power_packing, op5_lexicon_bpe, op6_sampled_splitters,
    op7_line_windows, op8_length_histogram, op9_license_join, op10_weak_supervision,
    op11_nn_descent, op12_threshold_negatives, op13_filter_potentials)}

ORACLE = {
    "op1_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
            FROM documents),
        g AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS s
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
              GROUP BY a.doc_id, b.doc_id),
        e AS (SELECT x, y, c = nx.n AND c = ny.n AS same FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
              WHERE 9 * c >= 4 * (nx.n + ny.n)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
        SELECT n.doc_id, (SELECT min(r.y) FROM r WHERE r.x = n.doc_id) AS class_id,
               least(n.doc_id, coalesce((SELECT min(e.y) FROM e WHERE e.x = n.doc_id AND e.same), n.doc_id)) AS text_id,
               (SELECT count(*) FROM e WHERE e.x = n.doc_id) AS n_links
        FROM n""",
    "op7_line_windows": r"""
        WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM cut),
        f AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        w AS (SELECT doc_id, i, lead(i, 1) OVER d AS i2, lead(i, 2) OVER d AS i3, line AS a, lead(line, 1) OVER d AS b,
                     lead(line, 2) OVER d AS c
              FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        q AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS r FROM w WHERE i3 IS NOT NULL),
        gone AS (SELECT DISTINCT doc_id, unnest([i, i2, i3]) AS i FROM q WHERE r > 1),
        m AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL) AS rest,
                     list_sort(list(l.i) FILTER (WHERE gone.i IS NOT NULL)) AS removed
              FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
        SELECT documents.doc_id, CASE WHEN m.removed IS NULL OR len(m.removed) = 0 THEN documents.text
                                      ELSE coalesce(m.rest, '') END AS text,
               coalesce(array_to_string(m.removed, ','), '') AS removed_lines
        FROM documents JOIN m ON documents.doc_id = m.doc_id""",
    "op11_nn_descent": r"""
        WITH RECURSIVE v AS (SELECT DISTINCT vec_id AS id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings WHERE vec_id IS NOT NULL),
        u AS (SELECT *, sqrt(list_inner_product(e, e)) AS n FROM v
              WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
                AND len([x FOR x IN e IF x <> 0]) > 0),
        k AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.id <> b.id AND len(a.e) = len(b.e)
              WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
        r AS (SELECT id AS a, id AS b FROM v UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a)
        SELECT id AS vec_id, (SELECT count(*) FROM k WHERE k.a = v.id) AS n_links,
               (SELECT min(r.b) FROM r WHERE r.a = v.id) AS component_id,
               (SELECT min(r.b) FROM r WHERE r.a = v.id) = id AS kept
        FROM v""",
    "op12_threshold_negatives": r"""
        WITH v AS (
            SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
            FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)),
        p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score,
                   row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r
            FROM s WHERE same QUALIFY r <= 5),
        n AS (
            SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, r ORDER BY score DESC, id)::INTEGER AS rank,
                   id AS negative_id, positive_score, score AS negative_score
            FROM p JOIN s USING (anchor_id)
            WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT * FROM n WHERE rank <= 10""",
    "op13_filter_potentials": r"""
        WITH l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
                   coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS again
            FROM documents),
        f AS (
            SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
                          100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                          regexp_matches(t, '[#$%&*|]'), again] AS fails,
                   coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
            FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
        c AS (SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY ALL),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        o AS (SELECT p.l || q.l || r.l || s.l || t.l AS filter_order FROM x p, x q, x r, x s, x t
              WHERE len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5),
        k AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM o),
        m AS (
            SELECT part, filter_order, step, substr(filter_order, step, 1) AS own, n, good, toxic,
                   fails[ascii(substr(filter_order, step, 1)) - 64] AS here,
                   len([i FOR i IN range(1, step) IF fails[ascii(substr(filter_order, i, 1)) - 64]]) > 0 AS gone,
                   len([b FOR b IN fails IF b]) = 1 AS alone
            FROM c, k),
        a AS (
            SELECT part, filter_order, step, own,
                   (sum(n) FILTER (WHERE NOT here AND NOT gone)) AS kept, sum(n) FILTER (WHERE here AND NOT gone) AS removed,
                   sum(n) FILTER (WHERE here AND gone) AS redundant, sum(n) FILTER (WHERE here AND alone) AS unique_fails,
                   sum(good) FILTER (WHERE here AND NOT gone) AS good_lost,
                   sum(toxic) FILTER (WHERE here AND NOT gone) AS toxic_lost
            FROM m GROUP BY ALL)
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
        FROM a""",
}
