"""BPE encoding and decoding: merge ranks in a priority queue over a doubly linked symbol list."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millpond.llm.arrowtext import slices

#: Distinct strings in each of a worker's two tables of known results; more cost time, not results.
REMEMBERED = 500_000
#: Unicode white space; str.split() also splits at the four separators below, which this pattern does not.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = re.compile(f"[{_SPACE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + sum(x not in plain for x in range(b))))
    return [letters[b] for b in range(256)]


class Bpe:
    """Encoder and decoder for one vocabulary file (tokenizers JSON, word-end BPE over bytes)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in {**self.vocab, **self.special}.items()}
        #: by rank: left, right and merged id; and the rank of a pair, its two ids in one number
        self.rules: list[tuple[int, int, int]] = []
        self.ranks: dict[int, int] = {}
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = self.vocab[left], self.vocab[right]
            self.ranks[a << 32 | b] = len(self.rules)
            self.rules.append((a, b, self.vocab[left + right]))
        letters = _byte_letters()
        self.inner = [self.vocab.get(c) for c in letters]
        self.last = [self.vocab.get(c + self.end) for c in letters]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace("\\s", _SPACE))
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def recalled(self, text: str) -> tuple[bytes, str] | None:
        """The known result for a string that is not in the newer table."""
        found = self.older.get(text)
        if found is not None:
            self.remember(text, found)
        return found

    def remember(self, text: str, coded: tuple[bytes, str]) -> tuple[bytes, str]:
        """Note a result; a full table becomes the older one, whose strings are dropped unless used again."""
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, {}
        self.known[text] = coded
        return coded

    def packed(self, ids: list[int]) -> tuple[bytes, str]:
        return array("I", ids).tobytes(), self.decode(ids)

    def piece(self, text: str) -> tuple[bytes, str]:
        """Packed ids and decoded string of one piece of text (a word, a digit, a run of marks)."""
        found = self.known.get(text) or self.recalled(text)
        if found is not None:
            return found
        data = text.encode()
        symbols = [*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]]
        if None in symbols:  # a vocabulary without this byte
            symbols = [s for s in symbols if s is not None]
        return self.remember(text, self.packed(self.merged(symbols)))

    def merged(self, symbols: list[int]) -> list[int]:
        """Apply merges by rank, then from the left. A queue entry is stale once its pair has changed."""
        get, rules, n = self.ranks.get, self.rules, len(symbols)
        queue = []  # rank and position in one number
        for i, (left, right) in enumerate(zip(symbols, symbols[1:])):
            rank = get(left << 32 | right)
            if rank is not None:
                queue.append(rank << 32 | i)
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        symbols.append(-2)  # what the last symbol is linked to
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            left, right, new = rules[entry >> 32]
            j = after[i]
            if symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = get(new << 32 | symbols[k])
                if rank is not None:
                    heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = get(symbols[h] << 32 | new)
                if rank is not None:
                    heappush(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def chunk(self, text: str) -> tuple[bytes, str]:
        """Packed ids and decoded string of text without white space."""
        found = self.recalled(text)
        if found is not None:
            return found
        coded = []
        for part in self.specials.split(text) if "<" in text else (text,):
            if part in self.special:
                coded.append(self.packed([self.special[part]]))
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            # letter by letter where a context-dependent lower case exists (final sigma)
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            coded += map(self.piece, [part] if part.isalpha() else self.pieces.findall(part))
        if len(coded) == 1:
            return self.remember(text, coded[0])
        return self.remember(text, (b"".join([c[0] for c in coded]), " ".join([c[1] for c in coded if c[1]])))

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the string they decode to."""
        chunks = [c for c in _SPACES.split(text) if c] if _SEPARATORS.search(text) else text.split()
        known, chunk = self.known.get, self.chunk
        parts = [known(c) or chunk(c) for c in chunks]
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[1]])

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings of the ids; this vocabulary has no decoder, so its library joins them by blanks."""
        return " ".join([self.strings[i] for i in ids])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) per row: packed ids (binary, 4 bytes little-endian each) and the decoded text.

    White space ends every piece, so a text is encoded chunk by chunk and equal
    chunks of a worker are encoded once. Null and empty texts give empty ids and
    an empty string; repeated rows stay; null ids stay; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        for rows, texts in slices(batches, text_col):
            coded = [bpe.encode(t) for t in texts.to_pylist()]
            yield pa.record_batch(
                [rows.column(id_col), pa.array([c[0] for c in coded], pa.binary()), pa.array([c[1] for c in coded])],
                ["id", "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    coded = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids binary, decoded string")
    return coded.withColumnRenamed("id", id_col)
