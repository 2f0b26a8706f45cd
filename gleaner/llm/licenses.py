"""License scans: phrases, and an exact set-similarity join of text blocks with license notices.

A notice is a window of consecutive words, across line ends, that is about as long as a template: the template may make
up no less than `threshold` of it, and it holds at least that share of the template's words and, where the template names
a license, the name, so the notice of another license doesn't count. Labels and score come from phrases and notices.

A block is a line of any length; blocks are where a template's words stand in one line, and label nothing. Of each
template, the words' set is ordered by how many blocks of the whole table hold a word, rarest first. A block can hold the share `threshold` of a template's words only if it has enough words (length filter), holds one
of the template's rarest words, few enough that the rest alone could not reach the share (prefix filter), and if the words
from the first one found on still suffice (positional filter). What is left is counted exactly. A text goes through the
prefix and length filters as a whole before its windows are counted.

Words are runs of digits, letters a-z after A-Z are lowered, and characters beyond ASCII. Null text counts as empty and
has no words, places or labels. Rows are scanned one by one: equal rows and null ids get equal results. An empty table
gives an empty result. Other columns are not read.
"""

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Phrases with their labels, and notices with the labels of the join.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = {
    "notice-gpl": "this work is licensed under the gnu general public license version 3",
    "notice-apache": "licensed under the apache license version 2 0",
    "notice-mit": "released under the mit license",
    "notice-cc-by": "this work is licensed under cc by 4 0",
    "text-mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                "documentation files to deal in the software without restriction",
    "text-gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation",
    "text-apache": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "text-bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
                "the following conditions are met",
}
# How a notice names its license, in words with a space after each.
GPL = re.compile(rb"\b(?<!lesser )(?<!library )(?<!affero )(?:general public license|gpl) ")
NAMES = {
    "notice-gpl": GPL, "text-gpl": GPL, "notice-apache": re.compile(rb"\bapache (?:\S+ ){0,2}license "),
    "notice-mit": re.compile(rb"\bmit (?:\S+ ){0,2}license "), "notice-cc-by": re.compile(rb"\b(?:cc|commons) by (?!(?:sa|nc|nd) )"),
}
SPLIT = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text."""
    return text.lower().translate(SPLIT).split()


def block_counts(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many blocks of all texts each word of the vocabulary occurs."""
    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                for line in (value.as_py() or "").encode().split(b"\n"):
                    seen.update(vocabulary.intersection(words_of(line)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "n"])
    rows = docs.select(F.col(text)).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}  # one row per word of the templates


class Join:
    """The templates, ordered and indexed by their prefixes."""

    def __init__(self, templates: dict[str, str], counts: dict[bytes, int], threshold: float):
        vocabulary = {w for t in templates.values() for w in t.encode().split()}
        self.rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self.labels, self.words, self.need, self.longest = [], [], [], []
        self.prefix: dict[bytes, list[int]] = defaultdict(list)
        for label, template in sorted(templates.items()):
            ordered = sorted(set(template.encode().split()), key=self.rank.__getitem__)
            need = math.ceil(threshold * len(ordered) - 1e-9)
            for word in ordered[:len(ordered) - need + 1]:
                self.prefix[word].append(len(self.labels))
            self.labels.append(label)
            self.words.append(ordered)
            self.need.append(need)
            self.longest.append(math.floor(len(template.split()) / threshold + 1e-9))
        self.starts = frozenset(self.prefix)

    def matches(self, block: set[bytes]) -> dict[str, float]:
        """Labels with the share of their words that the block holds, where it reaches the threshold."""
        out: dict[str, float] = {}
        checked = set()
        for word in sorted(self.starts & block, key=self.rank.__getitem__):
            # The first common word of a template: the block's words before it are in the template no more.
            ahead = sum(self.rank.get(w, self.rank[word]) < self.rank[word] for w in block)
            for t in self.prefix[word]:
                if t in checked:
                    continue
                checked.add(t)
                if len(block) - ahead < self.need[t]:
                    continue
                common = sum(w in block for w in self.words[t])
                if common >= self.need[t]:
                    out[self.labels[t]] = common / len(self.words[t])
        return out


    def notices(self, words: list[bytes], held: set[bytes]) -> list[tuple[int, str, float]]:
        """(index of the first word, label, share) of each notice; of windows that overlap, the first with the largest share."""
        out = []
        for t in sorted({t for word in self.starts & held for t in self.prefix[word]}):
            label, sought, need, longest = self.labels[t], set(self.words[t]), self.need[t], self.longest[t]
            name = NAMES.get(label)
            if len(sought & held) < need or name and not name.search(b" ".join(words) + b" "):
                continue
            found = [i for i, w in enumerate(words) if w in sought]
            inside: Counter = Counter()
            first, best = 0, (0, 0, 0)  # words in common, start and end of the best window that is still open
            for i in found:
                inside[words[i]] += 1
                while found[first] <= i - longest:
                    gone = words[found[first]]
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
                    first += 1
                start = found[first]
                if best[0] and start >= best[2]:
                    out.append((best[1], label, best[0] / len(sought)))
                    best = (0, 0, 0)
                if len(inside) >= max(need, best[0] + 1) and (not name or name.search(b" ".join(words[start:start + longest]) + b" ")):
                    best = (len(inside), start, i + 1)
            if best[0]:
                out.append((best[1], label, best[0] / len(sought)))
        return sorted(out)


def places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(index of the first word, label) of each place where a phrase's words stand one after another."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        sought = b" " + phrase.encode() + b" "
        at, index, last = line.find(sought), 0, 0
        while at >= 0:
            index += line.count(b" ", last, at)
            out.append((index, label))
            last = at
            at = line.find(sought, at + 1)
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8,
         templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks, notices.

    `blocks` lists (line, label, share) of the join of lines, `notices` (word, label, share) of windows; `score` is 1 with
    a phrase, else the largest share of a notice, else 0.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    vocabulary = {w for t in templates.values() for w in t.encode().split()}
    join = Join(templates, block_counts(docs, vocabulary, text), threshold)
    endings = {p.split()[-1].encode() for p in phrases}
    kinds = {"key": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(),
             "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
             "blocks": pa.list_(pa.struct([("line", pa.int64()), ("label", pa.string()), ("share", pa.float64())])),
             "notices": pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))}

    def one(text: str):
        data = text.encode()
        words = words_of(data)
        held = set(words)
        found = places(words, phrases) if endings & held else []
        blocks, notices = [], []
        if join.starts & held:
            for number, line in enumerate(data.split(b"\n")):
                shares = join.matches(set(words_of(line)))
                blocks += [{"line": number, "label": label, "share": share} for label, share in sorted(shares.items())]
            notices = [{"word": at, "label": label, "share": share} for at, label, share in join.notices(words, held)]
        starts, base = [i for i, _ in found], {label for _, label in found}
        every = base | {x["label"] for x in notices}
        score = 1.0 if found else max((x["share"] for x in notices), default=0.0)
        return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(every)), score, blocks, notices)

    def run(batches):
        for batch in batches:
            rows = [one(t.as_py() or "") for t in batch.column(1)]
            columns = [batch.column(0), *(list(c) for c in zip(*rows))] if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

    found = docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(
        run, "key bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
             "labels string, score double, blocks array<struct<line: bigint, label: string, share: double>>, "
             "notices array<struct<word: bigint, label: string, share: double>>")
    return found.withColumnRenamed("key", key)
