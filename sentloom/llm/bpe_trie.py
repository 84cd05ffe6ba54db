"""Byte-level byte pairs: encoding by a walk over the trie of distinct words, and decoding.

The encoding of a word is fixed by the last token of each of its prefixes: cut that
token off, and what is left is a shorter prefix whose last token is known. A token t
that ends a prefix is its last one if and only if no merge ever crosses the border
between t and the last token before it, which the two tokens alone decide. So the
state of a node of the trie of all words is one token, it follows from the states on
the path above it, and prefixes that words share are computed once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import slices

# Bytes of text whose words share one trie.
SLICE = 4 << 20
# Pieces of text, and pairs of tokens, that a worker remembers; it starts anew beyond them.
KNOWN_CHUNKS, KNOWN_PAIRS = 300_000, 500_000


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file, by its published rule.

    Printable characters of Latin-1 stand for themselves; all other bytes, in order, are
    the characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def character_classes(path: str) -> tuple[str, str, str]:
    """Letters, numbers and white space, as the file's own library splits at them.

    Libraries follow different editions of Unicode, so the classes are asked of the
    library: a block of characters that goes on with a letter (digit, mark) in one token
    is all letters (numbers, other marks); a mixed block is halved.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    ranges: dict[str, list[str]] = {mark: [] for mark in "a1! "}
    blocks = [(low, min(low + 4096, 0x110000)) for low in range(0, 0x110000, 4096) if not 0xD800 <= low < 0xE000][::-1]
    while blocks:
        low, high = blocks.pop()
        if low < 0xD800 < high:
            high = 0xD800
        text = "".join(map(chr, range(low, high)))
        mark = next((m for m in "a1!" if len(split(m + text)) == 1), " " if high - low == 1 else None)
        if mark:
            ranges[mark].append(f"\\U{low:08x}-\\U{high - 1:08x}")
        else:
            middle = (low + high) // 2
            blocks += [(middle, high), (low, middle)]
    return "".join(ranges["a"]), "".join(ranges["1"]), "".join(ranges[" "])


@dataclass(frozen=True)
class Vocabulary:
    """Contents of a vocabulary file and the character classes it splits words by."""

    spec: str
    classes: tuple[str, str, str]

    @cached_property
    def tables(self) -> Tables:
        return Tables(json.loads(self.spec), self.classes)

    def __getstate__(self):
        return {"spec": self.spec, "classes": self.classes}

    def __setstate__(self, state):
        self.__dict__.update(state)


def read_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level vocabulary file; truncation and padding are not used.

    A file that asks for what this module does not do is an error.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not plain or spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError("not a plain byte-level vocabulary")
    if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that look at their surroundings")
    kept = {"vocab": model["vocab"], "merges": model["merges"], "added": {t["content"]: t["id"] for t in spec["added_tokens"]}}
    return Vocabulary(json.dumps(kept), character_classes(path))


class Tables:
    """What a worker needs to encode and decode."""

    def __init__(self, spec: dict, classes: tuple[str, str, str]):
        letters, numbers, space = classes
        self.words = re.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
        ).findall
        # A space between two other characters always begins a word of its own.
        self.cut = re.compile(rf"(?<=[^{space}]) (?=[^{space}])").split
        self.odd = re.compile(rf"^ | $| [{space}]|[{space}] ").search
        self.added = spec["added"]
        specials = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, specials)) + ")").split if specials else lambda text: [text]
        byte = byte_alphabet()
        ids = {bytes(byte[c] for c in piece): i for piece, i in spec["vocab"].items() if all(c in byte for c in piece)}
        if any(bytes([b]) not in ids for b in range(256)):
            raise ValueError("a byte has no piece")
        self.ids = ids
        self.bytes = {i: piece for piece, i in ids.items()} | {i: t.encode() for t, i in self.added.items()}
        # The merge of two tokens as (rank, token), and the two tokens each came from.
        self.merge: dict[tuple[int, int], int] = {}
        self.rank, self.parts = dict.fromkeys(range(max(self.bytes) + 1), -1), {}
        for rank, pair in enumerate(spec["merges"]):
            a, b = (ids[bytes(byte[c] for c in p)] for p in (pair.split(" ") if isinstance(pair, str) else pair))
            made = ids[self.bytes[a] + self.bytes[b]]
            if made in self.parts or self.rank[a] < 0 < len(self.bytes[a]) - 1 or self.rank[b] < 0 < len(self.bytes[b]) - 1:
                raise ValueError("a piece made twice, or before its parts")
            self.merge[a, b] = rank
            self.rank[made], self.parts[made] = rank, (a, b)
        # Automaton of all tokens, made as far as it is used: a state is the longest start of
        # a token that ends at a place, and has the tokens that end there, the longest first.
        self.starts = {piece[:i] for piece in ids for i in range(1, len(piece) + 1)}
        self.states, self.number, self.step = [b""], {b"": 0}, {}
        self.ending: list[list[tuple[int, int]]] = [[]]
        self.packed = [np.array([i], "<u4").tobytes() for i in range(max(self.bytes) + 1)]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.own: dict[int, bool] = {}
        largest = max(self.bytes)
        self.by_id = pa.array([self.bytes.get(i, b"") for i in range(largest + 1)], pa.binary())

    def apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of tokens a and b, each made of its own bytes.

        Their making is gone back through in time: of the two tokens at the border the one
        made later (at equal rank the right one, as merges go from left to right) falls into
        its parts. Had the two been merged before that, the border would not be there.
        """
        merge, rank, parts = self.merge, self.rank, self.parts
        crossing = merge.get((a, b))
        if crossing is not None:
            return False
        while True:
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if rb >= ra:
                b = parts[b][0]
                crossing = merge.get((a, b))
                if crossing is not None and crossing <= rb:
                    return False
            else:
                a = parts[a][1]
                crossing = merge.get((a, b))
                if crossing is not None and crossing < ra:
                    return False

    def own_encoding(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        known = self.own.get(token)
        if known is None:
            known = True
            if token in self.parts:
                a, b = self.parts[token]
                known = self.own_encoding(a) and self.own_encoding(b) and self._until(a, b)
            elif len(self.bytes[token]) > 1:
                known = False  # a piece that no merge makes
            self.own[token] = known
        return known

    def _until(self, a: int, b: int) -> bool:
        """As :meth:`apart`, of a pair that is merged itself: nothing crosses the border before that."""
        pair = self.merge.pop((a, b))
        try:
            return self.apart(a, b)
        finally:
            self.merge[a, b] = pair

    def _next(self, state: int, byte: int) -> int:
        """The automaton's state one byte further."""
        seen = self.states[state] + bytes([byte])
        while seen and seen not in self.starts:
            seen = seen[1:]
        state = self.number.get(seen)
        if state is None:
            state = self.number[seen] = len(self.states)
            self.states.append(seen)
            self.ending.append([(self.ids[seen[i:]], len(seen) - i) for i in range(len(seen)) if seen[i:] in self.ids])
        return state

    def _follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may come next after ``before``; remembered."""
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        free = self.pairs[before << 32 | token] = self.own_encoding(token) and self.apart(before, token)
        return free

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """The packed ids of distinct words.

        Sorted, the words are the depth-first order of their trie (of their bytes, too): a
        word branches off the path to the word before it at the depth up to which the two
        agree. ``last`` and ``size`` hold the last token of each prefix on the present path
        and its bytes, ``states`` the automaton's state.
        """
        step, ending, packed, known, follows = self.step.get, self.ending, self.packed, self.pairs.get, self._follows
        out, before, last, size, states = {}, b"", [-1], [0], [0]
        for name in sorted(words):
            word = name.encode()
            shared, most = 0, min(len(before), len(word))
            if word[:most] == before[:most]:
                shared = most
            else:
                while word[shared] == before[shared]:
                    shared += 1
            del last[shared + 1:], size[shared + 1:], states[shared + 1:]
            state = states[shared]
            for depth, byte in enumerate(word[shared:], shared + 1):
                key = state << 8 | byte
                state = step(key)
                if state is None:
                    state = self.step[key] = self._next(key >> 8, byte)
                # One of the tokens that end here is the last one; it is mostly the longest.
                for token, n in ending[state]:
                    if n == depth:
                        if self.own_encoding(token):
                            break
                    else:
                        free = known(last[depth - n] << 32 | token)
                        if free or (free is None and follows(last[depth - n], token)):
                            break
                states.append(state)
                last.append(token)
                size.append(n)
            ids, at = [], len(word)
            while at:
                ids.append(packed[last[at]])
                at -= size[at]
            ids.reverse()
            out[name] = b"".join(ids)
            before = word
        return out

    def encode(self, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Packed ids of batches of texts; a NULL text is empty."""
        # Ids of what begins a text, and of what follows a space: a key has no space beside it.
        first: dict[str, bytes] = {}
        later: dict[str, bytes] = {}
        for batch in batches:
            packed = []
            for part in slices(pa.RecordBatch.from_arrays([batch], ["t"]), 0, SLICE):
                if len(first) + len(later) > KNOWN_CHUNKS:
                    first.clear()
                    later.clear()
                rows = [self._chunks(text or "") for text in part.column(0).to_pylist()]
                heads, tails = set(), set()
                for row in rows:
                    for chunks in row:
                        if isinstance(chunks, list):
                            heads.add(chunks[0])
                            tails.update(chunks[1:])
                self._learn(heads, tails, first, later)
                packed += [
                    b"".join([
                        first[c[0]] + b"".join([later[w] for w in c[1:]]) if isinstance(c, list) else c for c in row
                    ]) for row in rows
                ]
            yield pa.array(packed, pa.binary())

    def _chunks(self, text: str) -> list[list[str] | bytes]:
        """A text cut at its added tokens (as packed ids) and the rest at single spaces."""
        out: list[list[str] | bytes] = []
        for i, part in enumerate(self.split_added(text)):
            if i % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                out.append(self.cut(part) if self.odd(part) else part.split(" "))
        return out

    def _learn(self, heads: set[str], tails: set[str], first: dict[str, bytes], later: dict[str, bytes]) -> None:
        """Encode the distinct words of the chunks not met before."""
        split = self.words
        todo = [(first, c, split(c)) for c in heads if c not in first] + [(later, c, split(" " + c)) for c in tails if c not in later]
        distinct: set[str] = set()
        for _, _, words in todo:
            distinct.update(words)
        known = self.encode_words(distinct)
        for memory, chunk, words in todo:
            memory[chunk] = known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])

    def decode(self, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Texts of batches of packed ids; bytes that are no UTF-8 become U+FFFD, ids without a piece nothing."""
        for batch in batches:
            texts = []
            for ids in batch:
                if not ids.is_valid:
                    texts.append(None)
                    continue
                numbers = np.frombuffer(ids.as_py(), "<u4")
                pieces = self.by_id.take(pa.array(numbers[numbers < len(self.by_id)]))
                offsets, data = np.frombuffer(pieces.buffers()[1], np.int32), pieces.buffers()[2]
                blob = bytes(data)[offsets[0]:offsets[len(pieces)]] if data is not None else b""
                texts.append(blob.decode("utf-8", "replace"))
            yield pa.array(texts, pa.string())


def encode_column(df: DataFrame, vocabulary: Vocabulary, text: Column) -> Column:
    """Ids of a text column, packed as little-endian unsigned 32-bit integers; a NULL text has none.

    Added tokens in a text get their own ids. A text is never cut, whatever its length.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from shared.value.tables.encode(batches)

    return encode(text)


def decode_column(df: DataFrame, vocabulary: Vocabulary, ids: Column) -> Column:
    """The text of packed ids; NULL for NULL."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from shared.value.tables.decode(batches)

    return decode(ids)


def unpacked(ids: Column) -> Column:
    """Packed ids as an array of numbers."""

    @F.arrow_udf("array<long>")
    def numbers(packed: pa.Array) -> pa.Array:
        return pa.array([None if p is None else np.frombuffer(p, "<u4").astype(np.int64) for p in packed.to_pylist()], pa.list_(pa.int64()))

    return numbers(ids)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (packed) and ``decoded``, the text that the ids give back.

    Rows are not moved: each task encodes the distinct words of its texts, a few megabytes
    of text at a time. A NULL or empty text has no ids and an empty decoded text. Repeated
    rows, NULL ids and other columns stay as they are; columns named ``ids`` or ``decoded``
    (in any case) are replaced. An empty table gives no rows.
    """
    vocabulary = read_vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    # Both in one worker: a worker each would hold the batches and the tables twice.
    @F.arrow_udf("ids binary, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = shared.value.tables
        for ids in tables.encode(batches):
            yield pa.StructArray.from_arrays([ids, next(tables.decode(iter([ids])))], ["ids", "decoded"])

    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("ids", "decoded")]
    encoded = docs.select(*own, both(F.col("text")).alias("__both"))
    return encoded.select(*own, F.col("__both.ids").alias("ids"), F.col("__both.decoded").alias("decoded"))
