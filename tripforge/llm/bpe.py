"""BPE encoding and decoding with a given tokenizer file, as the file's own library does it.

Method: each short word is a contiguous array of parts (their boundaries) with the merge rank of
every adjacent pair beside it. The smallest rank is found by a scan, the boundary it stands at is
deleted, and the ranks of the two neighbouring pairs are refreshed, until no pair has a rank. The new words of a batch
are rows of one such array of parts and one of ranks, and take their steps together. A word
of more than ``LONG_PARTS`` parts takes its smallest ranks from a heap instead, which gives the same
parts without the quadratic scans.

White space only separates, so the white-space-free pieces of a text are encoded on their own and
kept in a bounded table. The tokenizer is read by the driver and broadcast (its size is that of
the file). Documents are never shuffled, and a text is worked on in pieces, whatever its length.

Defined results: a null or empty text has no tokens and decodes to the empty text; special tokens'
strings in a text become those tokens, as in the library. Null ids decode to the empty text. Repeated
rows are encoded each. Columns are taken by place, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, map_texts

LONG_PARTS = 64
#: Pieces and words kept by a worker, and the longest that is kept.
TABLE_SIZE, TABLE_LENGTH = 250_000, 40
#: Characters of a long text that are split at once, or of several texts.
STRETCH = 1 << 20
#: Words whose merges are made together.
MERGED_WORDS = 8192

_NO_RANK = 1 << 60
# The characters that the tokenizer's pattern takes as white space.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPACE = re.compile(f"[{_SPACES}]+")
# str.split() also splits at these.
_NOT_SPACE = re.compile("[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves; the others take the characters from
    U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """A tokenizer file with word ends: NFC, lower case, split by pattern, byte-level merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.pattern = split["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.inner = np.array([vocab.get(c, -1) for c in byte_characters()], np.int32)
        self.last = np.array([vocab.get(c + end, -1) for c in byte_characters()], np.int32)
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(model["merges"])}
        self.made = [vocab[a + b] for a, b in model["merges"]]
        self.tokens = [""] * (1 + max(*vocab.values(), *self.special.values()))
        for token, number in chain(vocab.items(), self.special.items()):
            self.tokens[number] = token

        # Ranks by pair, as sorted keys, for many pairs at once.
        self.base = len(self.tokens)
        pairs = np.array([a * self.base + b for a, b in self.ranks], np.int64)
        self.by_key = np.argsort(pairs)
        self.keys = pairs[self.by_key]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.base + right
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(keys.shape, _NO_RANK)
        return np.where((self.keys[place] == keys) & (left >= 0) & (right >= 0), self.by_key[place], _NO_RANK)

    def merge_short(self, parts: np.ndarray) -> list[list[int]]:
        """The tokens of short words, a row each; -1 fills a row beyond its word."""
        ranks = self.pair_ranks(parts[:, :-1], parts[:, 1:])
        made = np.array(self.made, np.int32)
        found: list[list[int]] = [[]] * len(parts)
        rows = np.arange(len(parts))
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            least = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NO_RANK)
            done = least == _NO_RANK
            for row, own in zip(rows[done].tolist(), parts[done].tolist()):
                found[row] = [p for p in own if p >= 0]
            if done.all():
                return found
            rows, parts, ranks, at, least = (x[~done] for x in (rows, parts, ranks, at, least))
            each, width = np.arange(len(rows)), parts.shape[1]
            # The boundary at the smallest rank goes: what is right of it moves up.
            moved = np.arange(width - 1) > at[:, None]
            parts = np.where(moved, parts[:, 1:], parts[:, :-1])
            parts[each, at] = made[least]
            ranks = np.where(moved[:, : width - 2] | (np.arange(width - 2) == at[:, None]), ranks[:, 1:], ranks[:, :-1])
            # The two pairs that the new part is in.
            right = at < width - 2
            ranks[each[right], at[right]] = self.pair_ranks(parts[each[right], at[right]], parts[each[right], at[right] + 1])
            left = at > 0
            ranks[each[left], at[left] - 1] = self.pair_ranks(parts[each[left], at[left] - 1], parts[each[left], at[left]])

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same parts for a long word: the next part of each is linked, ranks lie in a heap."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(left: int) -> None:
            right = after[left]
            if right < n and (rank := self.ranks.get((parts[left], parts[right]))) is not None:
                heapq.heappush(heap, (rank, left, right, parts[left], parts[right]))

        for i in range(n - 1):
            push(i)
        while heap:
            rank, left, right, a, b = heapq.heappop(heap)
            if parts[left] != a or after[left] != right or parts[right] != b:
                continue  # one of the two has been merged since
            parts[left], parts[right] = self.made[rank], -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            push(left)
            if before[left] >= 0:
                push(before[left])
        return [p for p in parts if p >= 0]

    def words(self, words: list[str]) -> list[list[int]]:
        """The tokens of each word."""
        raw = [word.encode() for word in words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        parts = self.inner[data]
        parts[ends - 1] = self.last[data[ends - 1]]
        if (parts < 0).any():  # bytes that the vocabulary lacks are left out
            sizes = np.add.reduceat(parts >= 0, ends - sizes)
            parts, ends = parts[parts >= 0], np.cumsum(sizes)
        found: list[list[int]] = [[]] * len(raw)
        for place in np.flatnonzero(sizes > LONG_PARTS).tolist():
            found[place] = self.merge_long(parts[ends[place] - sizes[place] : ends[place]].tolist())
        # Rows of about one length lie together.
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] <= LONG_PARTS]
        for at in range(0, len(order), MERGED_WORDS):
            some = order[at : at + MERGED_WORDS]
            rows = np.full((len(some), max(int(sizes[some[-1]]), 1)), -1, np.int32)
            filled = np.arange(rows.shape[1]) < sizes[some, None]
            places = (ends[some] - sizes[some])[:, None] + np.arange(rows.shape[1])
            rows[filled] = parts[places[filled]]
            for place, tokens in zip(some.tolist(), self.merge_short(rows)):
                found[place] = tokens
        return found


class _Pieces(dict):
    """Token ids of white-space-free pieces of text, and of the words in them.

    Full tables keep what they have: frequent words came first.
    """

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe = bpe
        self.words: dict[str, list[int]] = {}
        self.split = regex.compile(bpe.pattern)
        self.special = re.compile("|".join(map(re.escape, bpe.special))) if bpe.special else None

    def units(self, piece: str) -> list[str | int]:
        """The words of a piece, and the ids of the special tokens that it spells."""
        if piece.isascii() and piece.isalpha():
            return [piece.lower()]
        found, at = [], 0
        for special in self.special.finditer(piece) if self.special else ():
            found += self.plain(piece[at : special.start()])
            found.append(self.bpe.special[special.group()])
            at = special.end()
        return found + self.plain(piece[at:])

    def plain(self, text: str) -> list[str]:
        # Every sigma by itself: str.lower() alone would look at its place in the word.
        return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def known(self, pieces: list[str]) -> dict[str, list[int]]:
        """The ids of all these pieces: the table, or a copy with what it has no room for."""
        new = set(pieces).difference(self)
        if not new:
            return self
        units = {piece: self.units(piece) for piece in new}
        words = self.words
        listed = sorted({u for own in units.values() for u in own if u.__class__ is str and u not in words})
        ids = dict(zip(listed, self.bpe.words(listed)))
        for word in listed:
            if len(words) < TABLE_SIZE and len(word) <= TABLE_LENGTH:
                words[word] = ids[word]
        room, rest = TABLE_SIZE - len(self), {}
        for piece, own in units.items():
            if len(own) == 1 and own[0].__class__ is str:
                made = ids[own[0]] if own[0] in ids else words[own[0]]
            else:
                made = []
                for unit in own:
                    made += [unit] if unit.__class__ is int else ids[unit] if unit in ids else words[unit]
            if room > 0 and len(piece) <= TABLE_LENGTH:
                self[piece] = made
                room -= 1
            else:
                rest[piece] = made
        return {**self, **rest} if rest else self

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and len + 1 offsets; some texts at a time."""
        found, sizes, at = [], [], 0
        while at < len(texts):
            last, size = at, 0
            while last < len(texts) and (last == at or size + len(texts[last]) <= STRETCH):
                size += len(texts[last])
                last += 1
            if last == at + 1:  # a long text may go in stretches of its own
                parts = [self._encode([split_pieces(stretch)])[0] for stretch in stretches(texts[at])]
                found += parts
                sizes.append(sum(map(len, parts)))
            else:
                ids, own = self._encode([split_pieces(text) for text in texts[at:last]])
                found.append(ids)
                sizes += own
            at = last
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        return ids, np.cumsum([0, *sizes], dtype=np.int32)

    def _encode(self, pieces: list[list[str]]) -> tuple[np.ndarray, list[int]]:
        """The ids of some texts, given as pieces, and how many each has."""
        flat = list(chain.from_iterable(pieces))
        lists = list(map(self.known(flat).__getitem__, flat))
        ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        ids = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]) if len(ends) else 0)
        ends = np.concatenate([[0], ends])[np.cumsum([0, *map(len, pieces)])]
        return ids, np.diff(ends).tolist()

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def split_pieces(text: str) -> list[str]:
    """The text between white space."""
    return [p for p in _SPACE.split(text) if p] if _NOT_SPACE.search(text) else text.split()


def stretches(text: str) -> Iterator[str]:
    """The text in stretches of about ``STRETCH`` characters, cut at white space."""
    at = 0
    while len(text) - at > STRETCH:
        found = _SPACE.search(text, at + STRETCH)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


_tables: dict[int, _Pieces] = {}


def _pieces(shared) -> _Pieces:
    """One table in each worker and tokenizer."""
    key = id(shared.value)
    if key not in _tables:
        _tables.clear()
        _tables[key] = _Pieces(shared.value)
    return _tables[key]


def _encoded(pieces: _Pieces, texts: pa.Array) -> pa.ListArray:
    ids, ends = pieces.encode_all([t or "" for t in texts.to_pylist()])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))


def _decoded(tokens: pa.Array, ids: pa.ListArray) -> pa.Array:
    """The tokens of each list joined as the library's decode() joins them; a null list gives the empty text.

    The file names no decoder, so the library puts one space between tokens.
    """
    first = ids.offsets[0].as_py()
    offsets = pc.subtract(ids.offsets, pa.scalar(first, pa.int32()))
    words = pa.ListArray.from_arrays(offsets, tokens.take(ids.flatten()))
    return pc.binary_join(words, pa.scalar(" ", words.type.value_type))


def _token_table(own: WordBpe) -> pa.Array:
    return pa.array(own.tokens, pa.large_string())


def encode(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row with token_ids, an array of int."""
    shared = df.sparkSession.sparkContext.broadcast(WordBpe(path))

    def compute(texts: pa.Array) -> list[pa.Array]:
        return [_encoded(_pieces(shared), texts)]

    return map_texts(df, keep, text, [T.StructField("token_ids", T.ArrayType(T.IntegerType()))], compute)


def round_trip(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row with token_ids and decoded; the ids are decoded where they were made."""
    shared = df.sparkSession.sparkContext.broadcast(WordBpe(path))

    def compute(texts: pa.Array) -> list[pa.Array]:
        ids = _encoded(_pieces(shared), texts)
        return [ids, _decoded(_token_table(shared.value), ids).cast(pa.string())]

    fields = [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
    return map_texts(df, keep, text, fields, compute)


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """All columns, and ``text``: the tokens of ``ids`` joined as the library's decode() joins them."""
    shared = df.sparkSession.sparkContext.broadcast(WordBpe(path))
    own = F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>"))
    source = bound_batches(df).select("*", own.alias("ids_"))
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])
    names = schema.names

    def run(batches):
        for batch in batches:
            made = _decoded(_token_table(shared.value), batch.column(batch.num_columns - 1)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=names)

    return source.mapInArrow(run, schema)
