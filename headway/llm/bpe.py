"""Byte-pair encoding by backtracking over longest token matches, and decoding by offsets.

A word's tokens are found from left to right: an Aho-Corasick automaton gives every token
that starts at a place, the longest is tried first, and it is taken if it may follow the
token before it. Two tokens may follow each other when merging their joined symbols gives
just these two; this pair table is filled as pairs are met. A valid split of a prefix is
unique, so a place that was left is never tried again and the work is linear in the word.
The result is exactly that of applying merges by rank.

Decoding gathers bytes from one buffer of all tokens through a table of offsets.

Normalising and splitting follow the vocabulary's rules; for text beyond U+052F, where
Unicode tables of different age disagree, the public library that owns the format does both.

The vocabulary file is read once per Python worker. Words are encoded once per worker and
remembered up to a fixed number; memory does not grow with the input.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import inf

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from headway.llm.text import packed
from headway.llm.workers import give_back

# White space as the vocabulary's patterns see it. Python's own splitting also
# takes U+001C to U+001F for white space, so texts with those are split by pattern.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_ODD = re.compile("[\x1c-\x1f]")
_END = " "
_WORDS_HELD = 1 << 19
_LONGEST_HELD = 100
_PAIRS_HELD = 1 << 20
_SLICE = 512


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where Latin-1 prints it,
    otherwise the next unused one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _edge(token: int, made_by: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, float]]:
    found: list[tuple[int, float]] = []
    end = inf
    while True:
        found.append((token, end))
        if token not in made_by:
            return found
        end, token = made_by[token][0], made_by[token][side]


class Vocabulary:
    """Tokens, merges and tables of a vocabulary file with word ends and lower-casing."""

    def __init__(self, path: str):
        self.path = path
        self.rules: Tokenizer | None = None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        parts = [n["type"] for n in spec["normalizer"]["normalizers"]]
        plain = not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        if (
            parts != ["NFC", "Replace", "Lowercase"]
            or not plain
            or spec["decoder"] is not None
            or not model["end_of_word_suffix"]
            or model["continuing_subword_prefix"]
        ):
            raise ValueError(f"{path}: not a lower-casing vocabulary with word ends")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pieces = regex.compile(split["pattern"]["Regex"])
        suffix = model["end_of_word_suffix"]
        ids: dict[str, int] = {}
        for token, i in model["vocab"].items():
            ids[token[: -len(suffix)] + _END if token.endswith(suffix) else token] = i
        self.names = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.at_special = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")")
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            left, right = (t[: -len(suffix)] + _END if t.endswith(suffix) else t for t in (left, right))
            self.ranks.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        made_by = {new: (rank, *pair) for pair, (rank, new) in self.ranks.items()}
        if any(made_by.get(part, (-1,))[0] >= rank for rank, *parts in made_by.values() for part in parts):
            raise ValueError(f"{path}: a merge comes before the merges of its parts")
        self.ids = ids
        self.symbols = byte_symbols()
        self.pairs: dict[int, bool] = {}
        self.made_by = made_by
        # Tokens that merging never yields, not even from their own text, take no part.
        stable: dict[int, bool] = {}
        for token, i in sorted(ids.items(), key=lambda item: made_by.get(item[1], (-1,))[0]):
            rank, left, right = made_by.get(i, (None, None, None))
            stable[i] = rank is None or (stable[left] and stable[right] and not self._crossed(left, right, rank))
        self.whole = {t: i for t, i in ids.items() if stable[i]}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.whole.items():
            if len(token) > 1:
                self.automaton.add_word(token, (len(token), i))
        self.single = {t: i for t, i in self.whole.items() if len(t) == 1}
        self.automaton.make_automaton()
        names = [self.names.get(i, "").encode() + b" " for i in range(max(self.names) + 1)]
        self.bytes = np.frombuffer(b"".join(names), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(n) for n in names])))

    def merged(self, word: str) -> list[int]:
        """Merges by rank, leftmost first: the definition that the fast way must agree with."""
        ends = len(word) > 1 and word.endswith(_END)
        symbols = [self.ids[c] for c in (word[:-2] if ends else word)] + ([self.ids[word[-2:]]] if ends else [])
        while len(symbols) > 1:
            options = [self.ranks.get(pair) for pair in zip(symbols, symbols[1:])]
            found = [(o[0], i) for i, o in enumerate(options) if o]
            if not found:
                break
            _, i = min(found)
            symbols[i : i + 2] = [options[i][1]]
        return symbols

    def _crossed(self, left: int, right: int, before: float = inf) -> bool:
        """Whether a merge of a rank below ``before`` joins symbols of both tokens.

        A merge comes after those of its parts, so ranks are times: symbols at the border are
        merged across it if that comes before each is merged within its own token. At equal
        ranks the leftmost merge is first.
        """
        ranks = self.ranks
        starts = _edge(right, self.made_by, 1)
        for a, end_a in _edge(left, self.made_by, 2):
            for b, end_b in starts:
                found = ranks.get((a, b))
                if found and found[0] < before and found[0] < end_a and found[0] <= end_b:
                    return True
        return False

    @staticmethod
    @lru_cache(maxsize=256)
    def packer(n: int):
        return struct.Struct(f"<{n}I").pack

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens gives just these two."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= _PAIRS_HELD:
                self.pairs.clear()
            known = self.pairs[key] = not self._crossed(left, right)
        return known

    def word(self, piece: str) -> bytes:
        """Ids of one piece of text, packed as 32-bit numbers."""
        symbols = self.symbols
        return self.symbol_word("".join([symbols[b] for b in piece.encode()]) + _END)

    def symbol_word(self, word: str) -> bytes:
        known = self.whole.get(word)
        if known is not None:
            return known.to_bytes(4, "little")
        # Matches come by their end, so the longest at a place is the last; single characters
        # are not in the automaton but are always there as the last resort.
        starting: dict[int, list[tuple[int, int]]] = {}
        for end, (length, i) in self.automaton.iter(word):
            place = end + 1 - length
            if place in starting:
                starting[place].append((end + 1, i))
            else:
                starting[place] = [(end + 1, i)]
        size = len(word)
        path: list[int] = []
        places = [0]
        place, before, left = 0, -1, set()
        single, pairs, compatible = self.single, self.pairs, self.compatible
        while place < size:
            options = starting.get(place)
            while options is not False:
                if options:
                    end, i = options.pop()
                else:
                    end, i = place + 1, single.get(word[place], -1)
                    options = starting[place] = False
                # A place that was left has nothing valid going on from it.
                if i < 0 or end in left:
                    continue
                if before >= 0:
                    fits = pairs.get(before << 32 | i)
                    if not (compatible(before, i) if fits is None else fits):
                        continue
                path.append(i)
                places.append(end)
                place, before = end, i
                break
            else:
                left.add(places.pop())
                path.pop()
                place, before = places[-1], path[-1] if path else -1
        return self.packer(len(path))(*path)

    def chunk(self, chunk: str, known: Pieces) -> bytes:
        """Ids of text without white space."""
        if chunk.isascii():
            return b"".join([known[piece] for piece in self.pieces.findall(chunk.lower())])
        if max(chunk) > "\u052f":
            # Unicode tables differ between Python and the library, which decides here.
            rules = self.library()
            pieces = rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(chunk))
            return b"".join([self.symbol_word(symbols + _END) for symbols, _ in pieces])
        # Letter by letter: Python alone gives a final sigma its own form.
        chunk = unicodedata.normalize("NFC", chunk).replace("\u03a3", "\u03c3").lower()
        return b"".join([known[piece] for piece in self.pieces.findall(chunk)])

    def library(self) -> Tokenizer:
        if self.rules is None:
            self.rules = Tokenizer.from_file(self.path)
        return self.rules

    def encode(self, text: str, known: Chunks) -> bytes:
        if "<|" in text:
            parts = self.at_special.split(text)
        else:
            parts = [text]
        out = []
        for part in parts:
            if part in self.special and len(parts) > 1:
                out.append(np.uint32(self.special[part]).tobytes())
                continue
            chunks = part.split() if not _ODD.search(part) else filter(None, _SPACE.split(part))
            out.extend(map(known.__getitem__, chunks))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts joined by spaces, as UTF-8."""
        if not len(ids):
            return b""
        first = self.offsets[ids]
        lengths = self.offsets[ids + 1] - first
        shift = np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
        return self.bytes[shift + np.arange(len(shift))][:-1].tobytes()


class Pieces(dict):
    """Encoded pieces; forgets them all when it holds too many."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def encoded(self, text: str) -> bytes:
        return self.vocabulary.word(text)

    def __missing__(self, text: str) -> bytes:
        if len(self) >= _WORDS_HELD:
            self.clear()
        found = self.encoded(text)
        if len(text) <= _LONGEST_HELD:
            self[text] = found
        return found


class Chunks(Pieces):
    """Encoded runs of text without white space, from encoded pieces."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.pieces = Pieces(vocabulary)

    def encoded(self, text: str) -> bytes:
        return self.vocabulary.chunk(text, self.pieces)

    def forget(self) -> None:
        """Gives back what was learnt from texts; the vocabulary stays."""
        self.clear()
        self.pieces.clear()
        self.vocabulary.pairs.clear()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[Vocabulary, Chunks]:
    loaded = Vocabulary(path)
    return loaded, Chunks(loaded)


def _texts(column: pa.Array) -> Iterator[str]:
    for text in column:
        yield text.as_py() or ""


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids of each whole text, as
    little-endian 32-bit numbers, and of the text that they decode to.

    A null text counts as empty and has no tokens; texts of any length are encoded whole.
    Repeated rows give repeated results, an empty table none; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, known = vocabulary(path)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in _texts(batch.column(1)):
                packed_ids = tokens.encode(text, known)
                ids = np.frombuffer(packed_ids, "<u4").astype(np.int64)
                counts.append(len(ids))
                digests.append(hashlib.sha256(packed_ids).hexdigest())
                decoded.append(hashlib.sha256(tokens.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema)


def _encoder(path: str):
    @F.pandas_udf("array<int>")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens, known = vocabulary(path)
        try:
            for texts in parts:
                # Slices, so that the ids of one are freed while the next is encoded.
                for first in range(0, len(texts), _SLICE):
                    part = texts.iloc[first : first + _SLICE]
                    yield part.map(lambda t: np.frombuffer(tokens.encode(t or "", known), "<u4").astype(np.int32))
                texts = part = None
        finally:
            known.forget()  # workers outlive their task, and stages without texts follow in them
            give_back()

    return encoded


def _decoder(path: str):
    @F.pandas_udf("string")
    def decoded(ids):
        tokens, _ = vocabulary(path)
        return ids.map(lambda i: None if i is None else tokens.decode(np.asarray(i, np.int64)).decode("utf-8"))

    return decoded


def encode(text: Column, path: str) -> Column:
    """Token ids of a text column; null counts as empty."""
    return _encoder(path)(text.cast("string"))


def decode(ids: Column, path: str) -> Column:
    """Text of a column of token ids; null stays null."""
    return _decoder(path)(ids)


def with_tokens(docs: DataFrame, path: str, text_col: str = "text", name: str = "token_ids") -> DataFrame:
    """All columns and the token ids; an input column of that name is replaced."""
    rows = packed(docs.drop(name), ids=encode(F.col(text_col), path))
    return rows.select("row.*", F.col("ids").alias(name))
