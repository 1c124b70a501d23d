"""Token ids of whole texts by a public tokenizer, with each word encoded once.

The tokenizer drops white space and never joins characters across it, so a text's ids are those
of its words one after another. Words are cut at spaces and line feeds only; any other white
space stays inside a word and is left to the tokenizer. Words of plain ASCII and Latin-1 letters
need no normalising beyond small letters: they are cut into the tokenizer's runs (letters, single
digits, marks) and each run goes straight to its model. Every other word takes the whole way.
"""

from __future__ import annotations

import functools
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that are composed already and whose small letters are single characters.
PLAIN = re.compile(r"[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
RUN = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, others for U+0100 and up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Remembered(dict):
    """Values made on demand; the older half is forgotten when `limit` are held."""

    def __init__(self, make, limit: int, longest: int):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit // 2:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


class WordEncoder:
    """Encodes texts; words and runs are remembered up to `limit` each, long ones never."""

    def __init__(self, path: str, end_id: int, limit: int = 600_000, longest: int = 64):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = packed([end_id])
        self.letters = byte_letters()
        self.runs = Remembered(self._run, limit, longest)
        self.words = Remembered(self._word, limit, longest)

    def _run(self, run: str) -> bytes:
        if not run.isascii():
            run = run.encode().decode("latin-1").translate(self.letters)
        return packed([t.id for t in self.model.tokenize(run)])

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if PLAIN.fullmatch(word) and "<|" not in word:
            found = RUN.findall(word.lower())
            if len(found) == 1:
                return self.runs[found[0]]
            return b"".join([self.runs[r] for r in found])
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, the end id last."""
        words = (text or "").replace("\n", " ").split(" ")
        return b"".join(map(self.words.__getitem__, words)) + self.end


    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text of a column (null: empty), the end id last: counts, and all ids.

        Words are cut and made distinct by Arrow, so each is looked up once a column, and the ids
        of all words are gathered at once.
        """
        lines = pc.replace_substring(texts.fill_null(""), pattern="\n", replacement=" ")
        lists = pc.split_pattern(lines, pattern=" ")
        coded = lists.values.dictionary_encode()
        pieces = [self.words[w] for w in coded.dictionary.to_pylist()]
        pieces.append(self.end)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) >> 2
        known = np.frombuffer(b"".join(pieces), dtype="<u4")
        ends = lists.offsets.to_numpy()[1:]
        word = np.insert(coded.indices.to_numpy(), ends, len(pieces) - 1)
        n = size[word]
        stop = np.cumsum(n)
        first = (np.cumsum(size) - size)[word] - (stop - n)
        ids = known[np.repeat(first, n) + np.arange(stop[-1] if len(stop) else 0)]
        return np.diff(stop[ends + np.arange(len(ends))], prepend=0), ids


@functools.lru_cache(maxsize=2)
def worker_encoder(path: str, end_id: int) -> WordEncoder:
    """One per Python worker: later tasks in it find the words of earlier ones."""
    return WordEncoder(path, end_id)
