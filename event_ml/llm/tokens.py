"""Token ids of whole texts by a public tokenizer's vocabulary file."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Sequence

import numpy as np
import regex

from event_ml.llm.common import kept_in_worker


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Recent:
    """A table of what was looked up of late, in two generations.

    Entries go to the younger one; when that has ``size`` entries it becomes
    the older one, which is let go.  An entry that is used again moves on, so
    entries used once don't fill the table.
    """

    def __init__(self, size: int = 200_000):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        """The key's entry, None if there is none."""
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        self.young[key] = value
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young


#: Suffix of a vocabulary's entries that end a word, and the byte that stands for it: no text in UTF-8 has this byte.
WORD_END, END_BYTE = "</w>", b"\xff"


class ChunkEncoder:
    """Encodes texts chunk by chunk, each distinct chunk of late only once.

    A chunk is a run without ASCII white space, in lower case.  The vocabulary's
    normaliser lowers case, and it and the pre-tokenizer drop white space and
    never look across it, so a text's ids are those of its chunks in order.  A
    new chunk is cut into the pre-tokenizer's words (letters, single digits,
    other characters, contractions), and a new word is merged by the
    vocabulary's ranks.  Chunks with characters beyond Latin, whose case and
    composition have rules of their own, and very long words are left to the
    tokenizer itself.

    With ``special`` a text that holds a special token's string is encoded by
    the tokenizer as a whole, so it gives the special id; else such strings are
    ordinary text.
    """

    ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    LATIN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\x85\xa0\p{L}\p{N}]+")
    #: Characters below it are composed already, and their case has one form.
    BEYOND = "\u0250"

    def __init__(self, vocabulary: str, dtype: str = "<u4", special: bool = False, max_entries: int = 400_000, longest: int = 1000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = not special
        with open(vocabulary, encoding="utf-8") as f:
            file = json.load(f)
        names = {t["content"] for t in file["added_tokens"]}
        self.special = sorted(names) if special else []
        self.ranks = self._ranks(file["model"]["vocab"], names)
        self.merge = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=self.ranks, special_tokens={})._core_bpe.encode_single_piece
        self.dtype, self.longest = np.dtype(dtype), longest
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        if not self.dtype.isnative:
            raise ValueError("ids have the machine's byte order")
        self.known = Recent(max_entries)

    @staticmethod
    def _ranks(vocabulary: dict[str, int], special: set[str]) -> dict[bytes, int]:
        """The vocabulary's entries as bytes.  Its ids are the merges' order."""
        # the byte-level alphabet: printable bytes are themselves, the others follow from 256 on
        same = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        other = [b for b in range(256) if b not in same]
        byte = {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(other)}
        out = {}
        for entry, i in vocabulary.items():
            if entry not in special:
                end = entry.endswith(WORD_END)
                out[bytes(byte[c] for c in entry.removesuffix(WORD_END)) + END_BYTE * end] = i
        return out

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """One id array a text; null and blank texts give an empty one."""
        out = []
        for text in texts:
            text = text or ""
            if any(s in text for s in self.special):
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype))
                continue
            chunks = text.encode("utf-8", "replace").lower().split()
            ids = list(map(self.known.young.get, chunks))
            if None in ids:
                ids = [self._chunk(c) if i is None else i for c, i in zip(chunks, ids)]
            out.append(np.frombuffer(b"".join(ids), self.dtype))
        return out

    def _words(self, chunk: bytes) -> list[bytes] | None:
        """The pre-tokenizer's words of a chunk; None where they are left to the tokenizer."""
        if chunk.isascii():
            return self.ASCII.findall(chunk)
        text = chunk.decode("utf-8").lower()
        if max(text) >= self.BEYOND:
            return None
        return [w.encode() for w in self.LATIN.findall(text)]

    def _chunk(self, chunk: bytes) -> bytes:
        """Ids of a chunk that isn't among the latest."""
        ids = self.known.get(chunk)
        if ids is None:
            words = [chunk] if chunk.isalpha() else self._words(chunk)  # ASCII letters: one word
            if words is None:
                ids = self._whole(chunk)
            elif len(words) == 1:
                ids = self._word(words[0])
            else:
                ids = b"".join([self.known.get(w) or self._word(w) for w in words])
            if len(chunk) <= 64:
                self.known.put(chunk, ids)
        return ids

    def _word(self, word: bytes) -> bytes:
        if len(word) > self.longest:
            return self._whole(word)
        ids = array(self.code, self.merge(word + END_BYTE)).tobytes()
        if len(word) <= 64:
            self.known.put(word, ids)
        return ids

    def _whole(self, chunk: bytes) -> bytes:
        return array(self.code, self.tokenizer.encode(chunk.decode("utf-8"), add_special_tokens=False).ids).tobytes()


def encoder(vocabulary: str, dtype: str = "<u4", special: bool = False) -> ChunkEncoder:
    """The Python worker's encoder."""
    return kept_in_worker(("encoder", vocabulary, dtype, special), lambda: ChunkEncoder(vocabulary, dtype, special))
