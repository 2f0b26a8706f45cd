"""Token ids of whole texts by the vocabulary file of a public tokenizer, through a cache of encoded words.

A text is cut into the pieces that the file's pre-tokenizer makes, and every distinct piece is encoded once per task;
BPE never merges across pieces, so the joined ids are those of the whole text. Characters outside a stable range, and
texts that hold a special token, go through the library itself.
"""

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

from gleaner.llm.merges import Merger, packed

LIMIT = 0x180  # up to here classes, case and composition are the same in every Unicode version
CACHE = 200_000  # words that a task keeps
CHUNK = 1 << 19  # characters that are encoded together

# White space of the files' patterns below LIMIT, and English contractions.
SPACE = "\t\n\x0b\x0c\r \x85\xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _class(kind: str) -> str:
    found = [c for c in map(chr, range(LIMIT)) if unicodedata.category(c)[0] == kind]
    return "".join(map(re.escape, found))


L, N, S = _class("L"), _class("N"), re.escape(SPACE)
UNSAFE = re.compile(f"[^\\x00-{chr(LIMIT - 1)}‐-‧€]")
BYTE_PIECES = re.compile(f" ?[{L}]+|{CONTRACTIONS}| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+")
WORD_PIECES = re.compile(f"[{L}]+|{CONTRACTIONS}|[{N}]|[^{S}{L}{N}]+")


class Encoder:
    """Encodes whole texts to packed ids, equal to the library's encode(text, add_special_tokens=False)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.mark = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        normal, pre = spec["normalizer"], spec["pre_tokenizer"]
        self.kind = "byte" if normal is None and pre["type"] == "ByteLevel" and pre["use_regex"] else "word"
        steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
        if self.kind == "word" and steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"no pieces are defined for the normalizer of {path}")
        self.merger = Merger(spec["model"])
        self.words: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str] | None:
        """Pieces of a text without special tokens; None when only the library can tell."""
        if UNSAFE.search(text):
            return None
        return BYTE_PIECES.findall(text) if self.kind == "byte" else WORD_PIECES.findall(text.lower())

    def whole(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def unseen(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct pieces."""
        return self.merger.merge_all([w.encode() for w in words])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        cut = [None if self.mark.search(t) else self.pieces(t) for t in texts]
        self.learn(set().union(*filter(None, cut)))
        known = self.words.__getitem__
        return [self.whole(t) if pieces is None else b"".join(map(known, pieces)) for t, pieces in zip(texts, cut)]

    def learn(self, words: set[str]) -> None:
        """Put pieces into the cache; it is emptied first when it would outgrow its bound."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = words
        if new := list(new):
            self.words.update(zip(new, self.unseen(new)))


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """The encoder of a file, kept by the Python worker for its later tasks."""
    return Encoder(path)


def chunks(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Texts in lists of about CHUNK characters; null counts as empty."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1]) + 64
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held
