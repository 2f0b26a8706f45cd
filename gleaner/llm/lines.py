"""Line dedup by overlapping three-line windows: later occurrences go, and the positions that they cover are merged.

Lines are cut at \\n; lines without a character other than ASCII white space are neither hashed nor removed. A window is
three consecutive other lines. Of equal windows the first one in order of id, text hash and line stays whole; all lines
of later ones are removed, also inside one document. Texts with fewer than three such lines stay as they are.

Null text counts as empty. A null id ranks first. Rows with equal id and text rank the same and get equal results.
An empty table gives an empty result. All other columns are kept; where the table has a column named like the operator's
own, that one gets underscores.
"""

from pyspark.sql import DataFrame, functions as F

from gleaner.llm.names import free_name
from gleaner.sources.staging import stage

WIDTH = 3
FILLED = r"[^\\x20\\x09-\\x0D]"
RANK = ["doc", "text_hash", "line"]


def windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text_hash, line, lines, h1, h2): the 128-bit hash of each window and the numbers of its lines."""
    filled = f"filter(transform(split(t, '\\\\n'), (l, i) -> struct(l as l, i as i)), x -> x.l rlike '{FILLED}')"
    parts = ", ".join(f"a[k + {j}].l" for j in range(WIDTH))
    numbers = ", ".join(f"a[k + {j}].i" for j in range(WIDTH))
    found = (f"flatten(transform(array({filled}), a -> if(size(a) < {WIDTH}, array(), "
             f"transform(sequence(0, size(a) - {WIDTH}), k -> struct(a[k].i as line, array({numbers}) as lines, "
             f"xxhash64({parts}) as h1, xxhash64('second', {parts}) as h2)))))")
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return (rows.select("doc", F.xxhash64("t").alias("text_hash"), F.explode(F.expr(found)).alias("w"))
            .select("doc", "text_hash", "w.*"))


def covered(found: DataFrame) -> DataFrame:
    """(doc, text_hash, removed): the sorted line numbers that later windows cover."""
    first = (found.groupBy("h1", "h2").agg(F.min(F.struct(*RANK)).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("h1", "h2", "first"))
    # Written, so that both sides of the join are dealt out for it and the rows of one window can be split.
    later = found.join(stage(first, "first"), ["h1", "h2"]).filter(F.struct(*RANK) > F.col("first"))
    # A document's own lines, so an array is no longer than its text.
    return later.select("doc", "text_hash", F.explode("lines").alias("line")).groupBy("doc", "text_hash").agg(
        F.sort_array(F.collect_set("line")).alias("removed"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "removed_lines") -> DataFrame:
    """The documents without their covered lines, and `removed`: the line numbers, from 0, in the original text.

    A table that has a column named `removed` keeps it, and the numbers get that name with underscores.
    """
    doc, digest, found, removed = (free_name(name, docs.columns) for name in ("_gone_doc", "_gone_hash", "_gone", removed))
    gone = covered(stage(windows(docs, key, text), "windows"))
    gone = gone.select(F.col("doc").alias(doc), F.col("text_hash").alias(digest), F.col("removed").alias(found))
    same = F.col(key).eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(digest))
    rest = (f"array_join(flatten(transform(array(split(`{text}`, '\\\\n')), a -> "
            f"transform(array_except(sequence(0, size(a) - 1), `{found}`), i -> a[i]))), '\\n')")
    joined = docs.join(gone, same, "left")
    whole = F.when(F.col(found).isNull(), F.col(text)).otherwise(F.expr(rest))
    kept = [whole.alias(c) if c == text else F.col(c) for c in docs.columns]
    return joined.select(*kept, F.coalesce(found, F.array().cast("array<int>")).alias(removed))
