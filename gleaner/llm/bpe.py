"""BPE encoding and decoding with a compiled lexicon of frequent words; other words are merged exactly.

Words are counted over all documents, the most frequent ones are compiled into a minimal acyclic transducer, and every
task maps it into memory. A word that it does not hold goes through the ranked merges.

Null text counts as empty and gives no ids. Texts with special tokens get their ids, as the library gives them. Equal
rows and null ids are encoded one by one, an empty table gives an empty result; other columns are not read.
"""

import functools
import json
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.lexicon import Lexicon, compile_words
from gleaner.llm.merges import byte_letters, packed
from gleaner.llm.tokens import Encoder, chunks

LONGEST = 64  # bytes of a word in the lexicon, so its size is bounded by its number of words


@functools.lru_cache(1)
def lexicon_encoder(path: str, image: bytes) -> "LexiconEncoder":
    """The encoder of a file and a lexicon, kept by the Python worker for its later tasks."""
    return LexiconEncoder(path, image)


class LexiconEncoder(Encoder):
    """Encodes byte-level pieces by the lexicon, then by exact merges."""

    def __init__(self, path: str, image: bytes = b""):
        super().__init__(path)
        if self.kind != "byte":
            raise ValueError(f"not a byte-level vocabulary: {path}")
        self.lexicon = Lexicon(image) if image else None
        self.bytes_of = {c: b for b, c in self.merger.letters.items()}

    def pieces(self, text: str) -> list[str]:
        found = super().pieces(text)
        if found is None:  # cut by the library, whose pieces stand in letters
            cut = self.library.pre_tokenizer.pre_tokenize_str(text)
            found = [bytes(map(self.bytes_of.__getitem__, piece)).decode() for piece, _ in cut]
        return found

    def unseen(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        known = self.lexicon.find(raw) if self.lexicon else [None] * len(raw)
        rest = iter(self.merger.merge_all([w for w, ids in zip(raw, known) if ids is None]))
        return [next(rest) if ids is None else ids for ids in known]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; all words are learnt before the first text is encoded, which may empty the cache."""
        cut = []
        for text in texts:
            parts, at = [], 0
            for mark in self.mark.finditer(text):
                parts += [(self.pieces(text[at:mark.start()]), packed([self.special[mark[0]]]))]
                at = mark.end()
            cut.append([*parts, (self.pieces(text[at:]), b"")])
        self.learn({p for parts in cut for pieces, _ in parts for p in pieces})
        known = self.words.__getitem__
        return [b"".join(b"".join(map(known, pieces)) + special for pieces, special in parts) for parts in cut]


def frequent_words(docs: DataFrame, tokenizer: str, text: str = "text", size: int = 50_000) -> list[str]:
    """The `size` most frequent pieces of up to LONGEST bytes, counted over all whole texts; ties in order of the piece."""
    def count(batches):
        encoder, seen = lexicon_encoder(tokenizer, b""), Counter()
        for batch in batches:
            for held in chunks(x.as_py() for x in batch.column(0)):
                for t in held:
                    seen.update(p for at in encoder.mark.split(t) for p in encoder.pieces(at))
                if len(seen) > 100_000:
                    yield emit(seen)
                    seen = Counter()
        yield emit(seen)

    def emit(seen):
        kept = {w: n for w, n in seen.items() if len(w.encode()) <= LONGEST}
        return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())],
                                          names=["word", "n"])

    counts = docs.select(F.col(text)).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    # Dealt out by rank, so that the driver takes the first partitions' rows only, not the top of every partition.
    ranked = counts.repartitionByRange(F.desc("n"), F.asc("word")).sortWithinPartitions(F.desc("n"), F.asc("word"))
    return [r["word"] for r in ranked.limit(size).collect()]


def compiled(words: list[str], tokenizer: str) -> bytes:
    """The automaton of the words with their ids."""
    raw = [w.encode() for w in words]
    return compile_words(dict(zip(raw, LexiconEncoder(tokenizer).merger.merge_all(raw))))


def encode(docs: DataFrame, tokenizer: str, image: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids as packed little-endian 32-bit integers, n_tokens) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(image)  # at most `size` words of LONGEST bytes

    def run(batches):
        encoder = lexicon_encoder(tokenizer, shared.value)
        for batch in batches:
            at = 0
            for held in chunks(x.as_py() for x in batch.column(1)):
                ids = encoder.encode_all(held)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(held)), pa.array(ids, pa.binary()),
                     pa.array([len(i) // 4 for i in ids], pa.int64())], names=["key", "ids", "n_tokens"])
                at += len(held)
    out = docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "key bigint, ids binary, n_tokens bigint")
    return out.withColumnRenamed("key", key)


@functools.lru_cache(1)
def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes of each id, from the vocabulary file alone."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {c: b for b, c in byte_letters().items()}
    table = {i: bytes(map(byte_of.__getitem__, t)) for t, i in spec["model"]["vocab"].items() if byte_of.keys() >= set(t)}
    return table | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """Add `text`, the decoded ids; null ids give null, bytes that aren't UTF-8 become replacement characters."""
    def run(batches):
        table = token_bytes(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [None if not x.is_valid else
                         b"".join(map(table.__getitem__, np.frombuffer(x.as_py(), "<u4").tolist())).decode("utf-8", "replace")
                         for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=names)

    kept = encoded.select(key, "ids", "n_tokens")
    names = [key, "ids", "n_tokens", "text"]
    return kept.mapInArrow(run, f"`{key}` bigint, ids binary, n_tokens bigint, text string")
