"""The operators of gleaner.llm against brute force, on small tables with every odd case."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from compare import connect, differences
from gleaner.llm import ann, bpe, components, lengths, lexicon, licenses, lines, ngram_join, packing, quality, queries, shards, substring, tokens
from gleaner.llm.merges import packed
from gleaner.llm.tokens import Encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n, per_line=8):
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(["", "s", "ing", "ed", "ly"]) for _ in range(n)]
    out = [" ".join(words[i:i + per_line]).capitalize() + "." for i in range(0, n, per_line)]
    return "\n".join(out)


def odd_rows():
    base = prose(1, 120)
    rows = [(k, prose(k, 60)) for k in range(10, 30)]
    rows += [(1, base), (2, base), (2, base), (3, base + " tail words here"), (4, base.replace("Alpha", "Omega", 1)),
             (5, None), (6, ""), (7, " \n\t\n"), (None, base), (None, None), (8, "one two"), (9, "one  two"), (40, "the " * 60),
             (41, prose(41, 3000)), (42, "é" * 400), (43, "a <|endoftext|> b\x85c \U0001f600"), (44, prose(77, 40) + " " + prose(99, 70)),
             (45, prose(78, 40).replace("\n", " ") + " and so " + prose(99, 70).replace("\n", " ") + " after all that"),
             (2, prose(55, 30)), (46, "!!! ### $$$ %%% &&& *** <<< >>> ||| ### $$$ %%%"), (47, "GNU General Public\nLicense. CC-BY mit license MIT License")]
    return [(i, t, "en", "src0", None if t is None else len(t), "clash", "clash") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_same_as_sql(spark, sf, con, name):
    assert differences(con, queries.QUERIES[name](spark, sf), queries.ORACLE[name]) == []


# 1: n-gram Jaccard join

def grams(text, n=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    return frozenset([" ".join(w)] if len(w) < n else (" ".join(w[i:i + n]) for i in range(len(w) - n + 1)))


def brute_links(rows):
    """(doc_id, class_id, n_links) by comparing all pairs."""
    rows = [(i, grams(t)) for i, t in rows if i is not None]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            (i, x), (j, y) = rows[a], rows[b]
            alike = len(x & y) * 5 >= 4 * len(x | y)
            if alike:
                links[a] += 1
                links[b] += 1
            if alike or i == j:
                root[find(a)] = find(b)
    return sorted((i, min(rows[b][0] for b in range(len(rows)) if find(b) == find(a)), links[a]) for a, (i, _) in enumerate(rows))


def test_join_equals_brute_force(docs):
    found = ngram_join.classes(docs)
    assert found.columns == ["doc_id", "class_id", "text_id", "n_links"]
    rows = found.collect()
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in rows if r.doc_id is not None)
    assert got == brute_links([r[:2] for r in odd_rows()])
    assert [(r.class_id, r.n_links) for r in rows if r.doc_id is None] == [(None, 0)] * 2


def variants(n, seed, words=100):
    r, base = random.Random(seed), [f"w{k}" for k in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(words)] = f"x{r.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [1_000_000, 3_000])
def test_join_of_a_family_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = list(enumerate(variants(60, 5)))
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found.collect()) == brute_links(rows)


def test_join_of_an_id_with_several_texts(spark):
    texts = [prose(200 + k, 90) for k in range(4)]
    near = [t + " tail words here" for t in texts]
    rows = [(2, texts[0]), (2, texts[1]), (5, near[0]), (6, near[1]), (9, texts[2]), (9, near[2]), (9, texts[3]), (12, near[3])]
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found) == brute_links(rows)
    assert {r.doc_id: r.class_id for r in found} == {2: 2, 5: 2, 6: 2, 9: 9, 12: 9}


def test_pruning_keeps_probable_pairs():
    cutoffs = ngram_join.least_matches(0.8, 1e-7)
    for n, m in zip(range(32, 129, 32), cutoffs):
        below = sum(math.comb(n, k) * 0.8 ** k * 0.2 ** (n - k) for k in range(m))
        assert below < 1e-6 and m > 0.3 * n


def test_one_of_each(docs, empty):
    """A row of each class of texts stays: the one with the smallest id."""
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [r[:2] for r in odd_rows() if r[0] is not None]
    root = list(range(len(rows)))
    sets = [grams(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    expected = sorted(min(rows[k][0] for k in range(len(rows)) if root[k] == c) for c in set(root))
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == expected and ids.count(None) == 2
    assert ngram_join.one_of_each(empty).count() == 0 and ngram_join.classes(empty).count() == 0


def test_an_id_keeps_its_unrelated_texts_in_any_partitioning(spark):
    a, b = prose(201, 60), prose(202, 60)
    rows = [(1, a, "x"), (1, b, "y"), (2, a + " end", "z"), (3, b + " end", "z"), (3, prose(203, 60), "z"), (1, a, "x"), (4, a, None), (None, a, "n")]
    results = []
    for parts in (1, 3, 8):
        docs = spark.createDataFrame(rows, "doc_id long, text string, dropped_id string").withColumn("row_number", F.lit(5)).repartition(parts)
        results.append(sorted(map(tuple, ngram_join.one_of_each(docs).collect()), key=repr))
    assert results[0] == results[1] == results[2]
    assert results[0] == sorted([(1, a, "x", 5), (1, b, "y", 5), (3, rows[4][1], "z", 5), (None, a, "n", 5)], key=repr)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 50), (50, 60), (7, 7), (None, 3)]
    found = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 1 for k in range(1, 41)} | {100: 50, 50: 50, 60: 50}


# 2: substring dedup

def brute_spans(rows, least=20):
    found = [(i, h, s, e, d) for i, t, h in rows for s, e, d in substring.paragraphs(t or "", least)]
    first = {}
    order = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    for x in sorted(found, key=order):
        first.setdefault(x[4], order(x))
    spans = collections.defaultdict(set)
    for x in found:
        if order(x) > first[x[4]]:
            spans[x[0], x[1]].add((x[2], x[3]))
    return {k: substring.merged(list(v)) for k, v in spans.items()}


def test_substring_equals_brute_force(docs):
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    want = brute_spans([(r.doc_id, r.text, r.h) for r in hashed])
    hashes = {(r.doc_id, r.text): r.h for r in hashed}
    found = substring.dedup(docs)
    assert found.columns == [*docs.columns, "removed_spans"]
    for r in found.collect():
        spans = [(s.start, s.end) for s in r.removed_spans]
        original = next(t for (i, t), h in hashes.items() if i == r.doc_id and want.get((i, h), []) == spans
                        and (None if t is None else substring.cut(t, spans)) == r.text)
        assert want.get((r.doc_id, hashes[r.doc_id, original]), []) == spans
    assert want[45, hashes[45, next(t for i, t in hashes if i == 45)]]


def test_passage_inside_a_line_is_cut(spark):
    passage = prose(99, 70).replace("\n", " ")
    rows = [(1, prose(1, 30)), (2, f"so it was that {passage} then more words"), (3, f"Another one here {passage} and the end")]
    found = {r.doc_id: r for r in substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].text == rows[0][1] and found[2].text == rows[1][1]
    assert found[3].text == "Another one here  and the end"
    assert [(s.start, s.end) for s in found[3].removed_spans] == [(17, 17 + len(passage))]


def test_substring_of_an_empty_table(empty):
    assert substring.dedup(empty).count() == 0


def test_repeats_of_any_place_case_and_script_are_cut(spark):
    r = random.Random(21)
    plain = " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(20))
    arabic = " ".join("".join(r.choices("\u0627\u0628\u062a\u062b\u062c\u062d", k=5)) for _ in range(25))
    han = "".join(r.choices([chr(c) for c in range(0x4E00, 0x4F00)], k=30))
    rows = [(10 * k + i, f"one{k}{i} two{k}{i} {passage} three{k}{i} four{k}{i}") for k, passage in enumerate((plain, arabic, han))
            for i in (1, 2)]
    rows += [(50, "it " * 60), (51, "IT " * 60), (60, plain.rsplit(" ", 1)[0] + " other")]
    found = {r.doc_id: r.text for r in substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    for k in range(3):
        assert found[10 * k + 1] == texts[10 * k + 1]
        assert found[10 * k + 2] == f"one{k}2 two{k}2  three{k}2 four{k}2"
    assert found[50].split() == ["it"] * 20 and found[51].split() == [] and found[60] == texts[60]


# 3: neighbours

def test_hilbert_visits_neighbours():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    place = ann.hilbert(grid, 3)
    assert sorted(place.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def vectors(spark, n=600, size=16):
    r = np.random.default_rng(3)
    x = r.normal(size=(n, size))
    x[100:160] = x[99]  # a hot vector
    rows = [(k, x[k].tolist()) for k in range(n)]
    rows += [(9001, None), (9002, [0.0] * size), (9003, [None] + [1.0] * (size - 1)), (9004, [float("nan")] * size),
             (9020, [float("inf")] * size), (9005, [1.0, 2.0]), (None, [1.0] * size), (40, x[40].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return frame.withColumns({"score": F.lit("clash"), "item": F.lit("clash")}), x


def brute_neighbours(x, q, k=20):
    s = x @ x[q]
    order = sorted((j for j in range(len(x)) if j != q), key=lambda j: (-round(s[j], 12), j))
    return order[:k], s


def test_neighbours_against_brute_force(spark):
    frame, x = vectors(spark)
    rows = collections.defaultdict(list)
    for r in ann.neighbours(frame).collect():
        rows[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(rows) == list(range(0, 600, 20))
    hit = 0
    for q, got in rows.items():
        want, s = brute_neighbours(x, q)
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(math.isclose(g[2], s[g[1]], abs_tol=1e-9) for g in got)
        assert all((-round(a[2], 12), a[1]) < (-round(b[2], 12), b[1]) for a, b in zip(got, got[1:]))
        hit += len(set(want) & {g[1] for g in got})
    assert hit / (20 * len(rows)) >= 0.9
    assert [g[1] for g in sorted(rows[120])] == [j for j in range(99, 121) if j != 120][:20]


def test_whole_reach_is_exact_in_blocks(spark):
    frame, x = vectors(spark)
    found = collections.defaultdict(list)
    for r in ann.neighbours(frame, reach=1.0, curves=1, block=64).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert all(found[q] == brute_neighbours(x, q)[0] for q in found)


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id) for r in ann.neighbours(few).orderBy("query_id", "rank").collect()] == [
        (0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    assert ann.neighbours(few.limit(0)).count() == 0


# 4, 5, 8: tokens

def library(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path", [queries.WORD_BPE, queries.BYTE_BPE])
def test_ids_equal_the_library(path):
    r, tool, own = random.Random(2), library(path), Encoder(path)
    letters = [chr(c) for c in range(0x250)] + list("—’€　中́İΣ\U0001f600")
    texts = ["".join(r.choices(letters, k=r.randint(0, 50))) for _ in range(800)]
    texts += ["".join(r.choices("ab 12.'st\n\t<|endoftext|>", k=r.randint(1, 40))) for _ in range(300)]
    texts += ["a<|endoftext|> b", "<|startoftext|>", "I'LL can't 'S", "é" * 500, "ab" * 2000, prose(5, 500)]
    assert own.encode_all(texts) == [packed(tool.encode(t, add_special_tokens=False).ids) for t in texts]


def test_lexicon_finds_its_words_only():
    r = random.Random(4)
    words = {("".join(r.choices("abc", k=r.randint(1, 8)))).encode(): packed([r.randrange(9)] * r.randint(1, 3)) for _ in range(300)}
    words["é".encode()] = packed([7])
    found = lexicon.Lexicon(lexicon.compile_words(words))
    others = [("".join(r.choices("abcd", k=r.randint(0, 9)))).encode() for _ in range(500)]
    sought = [*words, *others]
    assert found.find(sought) == [words.get(w) for w in sought]
    assert len(found.final) < sum(map(len, words)) / 2
    assert lexicon.Lexicon(lexicon.compile_words({})).find([b"a"]) == [None]


def test_special_tokens_keep_the_words_of_their_chunk(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 12)
    texts = ["one two three four five", "six seven<|endoftext|> eight nine ten", "<|endoftext|>", "eleven one two twelve"]
    want = [packed(library(queries.BYTE_BPE).encode(t, add_special_tokens=False).ids) for t in texts]
    coder = bpe.LexiconEncoder(queries.BYTE_BPE)
    assert coder.encode_all(texts) == want and coder.encode_all(texts[::-1]) == want[::-1]


def test_encode_and_decode(docs, empty):
    path, tool = queries.BYTE_BPE, library(queries.BYTE_BPE)
    words = bpe.frequent_words(docs, path, size=50)
    assert len(words) == 50
    image = bpe.compiled(words, path)
    found = bpe.decode(bpe.encode(docs, path, image), path).collect()
    want = collections.Counter()
    for i, t, *_ in odd_rows():
        ids = tool.encode(t or "", add_special_tokens=False).ids
        want[i, packed(ids), len(ids), tool.decode(ids, skip_special_tokens=False)] += 1
    assert collections.Counter((r.doc_id, bytes(r.ids), r.n_tokens, r.text) for r in found) == want
    assert bpe.frequent_words(empty, path) == []
    assert bpe.encode(empty, path, bpe.compiled([], path)).count() == 0


def test_packing(docs, empty):
    tool = library(queries.WORD_BPE)
    found = packing.pack(docs, queries.WORD_BPE, longest=64).collect()
    assert len({r.sequence_id for r in found}) == len(found) and {r.offset for r in found} == {0}
    assert all(r.length == 1 << r.bucket <= 64 and len(r.ids) == 4 * r.length for r in found)
    want = collections.Counter((i, packed(tool.encode(t or "", add_special_tokens=False).ids + [2])) for i, t, *_ in odd_rows())
    pieces = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r.sequence_id)):
        pieces[r.doc_id, r.doc_tokens].append(r)
    whole = collections.Counter()
    for (i, total), rows in pieces.items():
        rows.sort(key=lambda r: r.start)
        if sum(r.length for r in rows) == total:
            whole[i, b"".join(r.ids for r in rows)] += 1
        else:  # rows that share id and length: start after start they take part equally
            n = sum(r.length for r in rows) // total
            assert sum(r.length for r in rows) == n * total
            for k in range(n):
                whole[i, b"".join(r.ids for r in sorted(rows, key=lambda r: (r.start, r.sequence_id))[k::n])] += 1
    assert whole == want
    assert packing.pack(empty, queries.WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(docs, queries.WORD_BPE, longest=100)


def test_length_histogram(docs, empty, monkeypatch):
    monkeypatch.setattr(lengths, "BLOCK", 16)
    tool = library(queries.BYTE_BPE)
    n = sorted(len(tool.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in odd_rows())
    sums = lengths.suffix_sums(lengths.histogram(lengths.encoded_lengths(docs, queries.BYTE_BPE))).cache()
    rows = {r.n_tokens: r for r in sums.collect()}
    assert sorted(rows) == sorted(set(n))
    for limit, r in rows.items():
        over = [x for x in n if x >= limit]
        assert (r.n_docs, r.docs_over, r.tokens_over, r.docs_under) == (n.count(limit), len(over), sum(over), len(n) - len(over))
        assert (r.total_docs, r.total_tokens, r.truncated_tokens) == (len(n), sum(n), sum(min(x, limit) for x in n))
    for share in (0.1, 0.5, 0.9, 1.0):
        assert lengths.quantile(sums, share).first().n_tokens == n[math.ceil(share * len(n)) - 1]
    assert lengths.truncated_total(sums, 33).first().tokens == sum(min(x, 33) for x in n)
    by = lengths.suffix_sums(lengths.histogram(lengths.encoded_lengths(docs, queries.BYTE_BPE, kept=("lang",)), ("lang",)), ("lang",))
    assert by.count() == len(rows)
    assert lengths.suffix_sums(lengths.histogram(lengths.encoded_lengths(empty, queries.BYTE_BPE))).count() == 0


# 6: shards

def check_shards(rows, found, n):
    sizes = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == sizes
    loads, slots = collections.Counter(), collections.defaultdict(list)
    for r in found:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(0 <= s < n and sorted(v) == list(range(len(v))) for s, v in slots.items())
    mean, largest = sum(loads.values()) / n, max(r["size"] for r in found)
    assert all(abs(loads[s] - mean) <= largest for s in range(n))


def test_shards(docs, empty):
    check_shards(odd_rows(), shards.shard(docs, 4).collect(), 4)
    assert shards.shard(empty, 4).count() == 0


def test_shards_of_a_hot_key(spark):
    rows = [(7 if k % 3 else k, "x" * (k % 50)) for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check_shards(rows, shards.shard(frame, 8, rows_per_range=100).collect(), 8)


def test_ranges_are_bounded_by_bytes(spark):
    """Few rows with long texts make as many ranges as their bytes need."""
    rows = [(k, "y" * (2000 if k % 5 else 40_000)) for k in range(300)]
    placed = shards.place(spark.createDataFrame(rows, "doc_id long, text string"), 3, bytes_per_range=100_000)
    check_shards(rows, shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 3, bytes_per_range=100_000).collect(), 3)
    assert sorted((r.doc_id, r.text) for r in placed.collect()) == rows


def test_whole_records_reach_their_shards(spark, docs, tmp_path):
    placed = shards.place(docs, 4)
    assert placed.columns == [*docs.columns, "shard", "slot"]
    shards.save(placed, str(tmp_path / "shards"))
    saved = spark.read.parquet(str(tmp_path / "shards")).select(placed.columns).collect()
    assert collections.Counter(r[:-2] for r in saved) == collections.Counter(tuple(r) for r in docs.collect())
    want = collections.Counter(tuple(r) for r in shards.shard(docs, 4).collect())
    assert collections.Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()), r.shard, r.slot)
                               for r in saved) == want
    assert {f.name for f in (tmp_path / "shards").glob("shard=*")} == {f"shard={k}" for k in {r.shard for r in saved}}


# 7: lines

def brute_lines(rows):
    """Removed line numbers of each (id, text hash)."""
    found = []
    for i, t, h in set(rows):
        kept = [k for k, l in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", l)]
        ls = (t or "").split("\n")
        found += [((i is not None, i or 0, h, kept[k]), i, h, kept[k:k + 3], tuple(ls[j] for j in kept[k:k + 3]))
                  for k in range(len(kept) - 2)]
    first, out = {}, collections.defaultdict(set)
    for order, i, h, numbers, window in sorted(found, key=lambda x: x[0]):
        if first.setdefault(window, order) != order:
            out[i, h].update(numbers)
    return out


def test_lines_equal_brute_force(docs):
    hashed = [(r.doc_id, r.text, r.h) for r in
              docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()]
    removed = brute_lines(hashed)
    want = collections.Counter()
    for i, t, h in hashed:
        gone = removed.get((i, h), set())
        rest = t if not gone else "\n".join(l for k, l in enumerate(t.split("\n")) if k not in gone)
        want[i, rest, tuple(sorted(gone))] += 1
    found = lines.dedup_lines(docs)
    assert found.columns == [*docs.columns, "removed_lines"]
    assert collections.Counter((r.doc_id, r.text, tuple(r.removed_lines)) for r in found.collect()) == want


def test_repeats_inside_a_text_and_an_empty_table(spark, empty):
    rows = [(1, "a\nb\n\nc\na\nb\nc\nd")]
    found = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert found.text == "a\nb\n\nc\nd" and found.removed_lines == [4, 5, 6]
    assert lines.dedup_lines(empty).count() == 0


# 9: licenses

def test_license_phrases(docs, empty):
    found = {(r.doc_id, r.n_words): r for r in licenses.scan(docs).collect()}
    for i, t, *_ in odd_rows():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        r = found[i, len(w)]
        assert (r.n_base, r.first_word, r.last_word) == (len(at), at[0][0] if at else None, at[-1][0] if at else None)
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert (found[47, 10].n_base, found[47, 10].first_word, found[47, 10].last_word) == (4, 0, 8)
    assert licenses.scan(empty).count() == 0


def test_license_join_equals_brute_force(spark):
    r, vocabulary = random.Random(6), "this work is licensed under the gnu mit public license version copy file granted x y z".split()
    rows = [(k, "\n".join(" ".join(r.choices(vocabulary, k=r.randint(1, 25))) for _ in range(4))) for k in range(200)]
    rows += [(900, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                   "documentation files, to deal in the software without restriction.")]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.6).collect()}
    total = 0
    for i, t in rows:
        want = []
        for k, line in enumerate(t.lower().split("\n")):
            have = set(re.findall(r"[a-z0-9]+", line))
            for label, template in sorted(licenses.TEMPLATES.items()):
                sought = set(template.split())
                if 5 * len(sought & have) >= 3 * len(sought):
                    want.append((k, label, len(sought & have) / len(sought)))
        assert [tuple(b) for b in found[i].blocks] == want
        total += len(want)
    assert total > 20 and found[900].labels == "text-mit"


def test_notices_across_lines(spark):
    wrapped = {label: t.split() for label, t in licenses.TEMPLATES.items() if label.startswith("text")}
    rows = [(k, "some code\n" + "\n".join(f" * {' '.join(w[i:i + 10])}" for i in range(0, len(w), 10)) + "\nmore of it")
            for k, w in enumerate(wrapped.values())]
    filler = " ".join(f"w{k}" for k in range(40))
    rows += [(100, f"it was released {filler} under {filler} the driving license {filler} mit")]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, label in enumerate(wrapped):
        assert label in found[k].labels.split(",") and [(n.word, n.label, n.share) for n in found[k].notices] == [(2, label, 1.0)]
    assert (found[100].labels, found[100].score) == ("", 0)


def test_notices_of_other_licenses(spark):
    filler = " ".join(f"w{k}" for k in range(40))
    others = ["Released under the Apache License", "Released under the BSD License", "Licensed under the MIT License, Version 2.0",
              f"mit {filler} license released under the", "Released under the driving license; MIT",
              "This work is licensed under the GNU Lesser General Public License version 3", "This work is licensed under CC BY-SA 4.0"]
    rows = [(100 + k, t) for k, t in enumerate(others)]
    own = ["Released under the\nMIT open source License", "Licensed under the Apache\nLicense, Version 2.0",
           "This work is licensed under the\nGNU General Public License, version 3", "This work is licensed\nunder CC BY 4.0"]
    rows += [(200 + k, t) for k, t in enumerate(own)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[100 + k].labels for k in range(len(others))] == ["apache", "", "mit,notice-mit", "", "", "", "cc-by"]
    assert found[101].score == found[103].score == found[104].score == found[105].score == 0
    assert [[n.label for n in found[200 + k].notices] for k in range(4)] == [["notice-mit"], ["notice-apache"], ["notice-gpl"], ["notice-cc-by"]]


# 10: quality

def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    ls = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(ls) - len(set(ls)), len(covered)


def test_quality_counts(docs, empty):
    found = quality.assess(docs).collect()
    got = collections.Counter((r.doc_id, *(r[c] for c in quality.COUNTS), r.base_failed) for r in found)
    want = collections.Counter()
    for i, t, *_ in odd_rows():
        n = brute_counts(t)
        want[i, *n, n[0] < 10 or 100 * n[4] > 20 * n[0]] += 1
    assert got == want
    assert not any(r.kept for r in found if r.base_failed)
    by_id = {r.doc_id: r.kept for r in found}
    assert all(by_id[k] for k in range(10, 30)) and not by_id[46]
    assert quality.assess(empty).count() == 0 and quality.keep(empty).count() == 0


def test_keep_agrees_with_assess(docs):
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    want = collections.Counter(r.doc_id for r in quality.assess(docs).collect() if r.kept)
    assert collections.Counter(r.doc_id for r in kept.collect()) == want


def brute_em(patterns, rounds=20, start=0.9, smoothing=10.0, low=0.55, high=0.99):
    rules = list(quality.RULES)
    acc = dict.fromkeys(rules, start)
    for _ in range(rounds):
        right, votes = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0.0)
        for p, n in patterns.items():
            odds = sum(v * math.log(acc[r] / (1 - acc[r])) for r, v in zip(rules, p))
            q = 1 / (1 + math.exp(-odds))
            for r, v in zip(rules, p):
                votes[r] += n * abs(v)
                right[r] += n * (q if v == 1 else 1 - q if v == -1 else 0)
        acc = {r: min(high, max(low, (right[r] + smoothing * start) / (votes[r] + smoothing))) for r in rules}
    return acc


def test_em_equals_brute_force(docs):
    votes = [f"vote_{r}" for r in quality.RULES]
    patterns = collections.Counter(tuple(r[v] for v in votes) for r in quality.assess(docs).collect())
    model, want = quality.fit(quality.measures(docs)), brute_em(patterns)
    assert all(math.isclose(model.accuracy[r], want[r], rel_tol=1e-9) for r in want)


# the pipeline

def test_pipeline_stages(spark, sf):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    kept = source
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, kept, sf).cache()
        assert after.columns == source.columns and after.count() <= kept.count()
        kept = after
    texts = [r.text for r in kept.select("text").collect()]
    tool = library(queries.WORD_BPE)
    want = sum(len(tool.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    assert corpus_pipeline.run(spark, sf).agg(F.sum("length")).first()[0] == want


def test_pipeline_on_odd_rows(spark, docs, empty):
    for rows in (docs, empty):
        kept = rows.select("doc_id", "text", "lang", "source", "n_chars")
        for _, function in corpus_pipeline.STAGES:
            kept = function(spark, kept, "").cache()
            kept.count()


def test_user_columns_named_like_the_operators_own(spark):
    passage = prose(99, 70)
    rows = [(1, passage), (2, passage + "\nand more"), (2, passage + "\nand more")]
    names = ["removed_spans", "removed_lines", "_doc", "_hash", "_gone", "_gone_doc", "_gone_hash", "spans", "place", "lines"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(n) for n in names})
    for found, own, left in ((substring.dedup(docs), "removed_spans_", "\nand more"), (lines.dedup_lines(docs), "removed_lines_", "and more")):
        assert found.columns == [*docs.columns, own]
        kept = found.collect()
        assert all(r[n] == n for r in kept for n in names)
        assert sorted((r.doc_id, r.text, bool(r[own])) for r in kept) == [(1, passage, False), (2, left, True), (2, left, True)]


def plain_repeats(rows, least):
    """The characters of each text that lie in a run of `least` words with an earlier equal run; strings only."""
    seen, out = {}, {}
    for i, t in sorted(rows):
        at = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\S+", t)]
        gone = set()
        for k in range(len(at) - least + 1):
            run, end = tuple(w for _, _, w in at[k:k + least]), at[k + least - 1][1]
            first = seen.setdefault(run, (i, k, end))
            if first[:2] != (i, k):
                gone.update(range(max(at[k][0], first[2] if first[0] == i else 0), end))
        out[i] = gone
    return out


@pytest.mark.parametrize("seed", range(3))
def test_units_equal_plain_runs_of_words(spark, seed):
    """Passages cut at any word, nested, overlapping, periodic and mixed into other text."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=r.choice([1, 3, 6])))
    pool = [[word() for _ in range(r.randint(8, 90))] for _ in range(12)] + [["x", "y"] * 30, ["z"] * 50]
    rows = []
    for i in range(120):
        words = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(pool)
            a = r.randrange(len(p))
            words += p[a:r.randint(a, len(p))] + [word() for _ in range(r.randint(0, 12))]
        rows.append((i, "".join(w.upper() + r.choice([" ", "\n", "  "]) if r.random() < .1 else w + " " for w in words)))
    for least in (20, 7):
        want = plain_repeats(rows, least)
        found = substring.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), least_words=least).collect()
        assert any(want.values())
        assert {x.doc_id: {c for s in x.removed_spans for c in range(s.start, s.end)} for x in found} == want
