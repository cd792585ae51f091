"""Byte-level BPE without merge loops: longest matches from an Aho-Corasick automaton, with backtracking.

A token sequence is the one the merges produce exactly when every two neighbours, merged alone, stay these two tokens.
So each piece is covered by longest matches first; where a token does not go with the one before it, a shorter match is
tried, and a position that leads nowhere is never entered again. Work grows linearly with the piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from public_tokenizers import PATTERN, path

from logquarry.llm.common import give_back, thrifty

VOCABULARY = "byte_bpe_50k.tiktoken"
# Bytes of each memo of a task, about; a full one is emptied, so memory is bounded and results are the same.
MEMO_BYTES = 64 * 1024 * 1024
# What an entry takes besides the content of texts and packed ids; numbers and booleans need no more objects than one.
ENTRY_BYTES = 160
NUMBER_BYTES = 110
# Tokens of the rows that leave a task together.
TOKENS = 200_000
# Longer runs are encoded anew each time.
LONGEST_REMEMBERED = 64
# Texts below this code point are split by a pattern of plain character ranges, which `re` runs faster.
PLAIN_BELOW = 0x250


def read_ranks(file: str | None = None) -> bytes:
    """Content of a rank file; by default the public 50k vocabulary."""
    with open(file or path(VOCABULARY), "rb") as f:
        return f.read()


def _ranges(matching: str) -> str:
    """A character class body of the code points below PLAIN_BELOW that match a `regex` class."""
    found = [i for i in range(PLAIN_BELOW) if regex.match(matching, chr(i))]
    return "".join(f"\\x{i:02x}" if i < 256 else f"\\u{i:04x}" for i in found)


def plain_pattern(pattern: str) -> re.Pattern:
    """`pattern` for texts below PLAIN_BELOW, with its character properties spelled out."""
    letters, numbers, spaces = _ranges(r"\p{L}"), _ranges(r"\p{N}"), _ranges(r"\s")
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    inside = inside.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return re.compile(inside.replace(r"\s", f"[{spaces}]").replace(r"\S", f"[^{spaces}]"))


class Memo(dict):
    """Remembers a function's results; emptied when full, so its size is bounded. Long keys are not kept."""

    def __init__(self, function, limit: int):
        super().__init__()
        self.function, self.limit = function, limit
        self.held = 0

    def __missing__(self, key):
        found = self.function(key)
        size = len(key) + len(found) + ENTRY_BYTES if isinstance(key, str) else NUMBER_BYTES
        if size <= 8 * LONGEST_REMEMBERED:
            self.held += size
            if self.held > self.limit:
                self.clear()
                self.held = size
            self[key] = found
        return found


def packed(tokens) -> bytes:
    """Token ids as 32-bit numbers one after another."""
    return array("i", tokens).tobytes()


def parse_ranks(ranks: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def last_merges(ranks: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """The two tokens whose merge completes each token; single bytes, which no merge makes, are absent."""
    found = {}
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            i = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], len(ranks)))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            found[rank] = (ranks[parts[0]], ranks[parts[1]])
    return found


class BytePairEncoder:
    """Encodes and decodes by the ranks of a `.tiktoken` file; ordinary text only, no special tokens.

    `merges` are the ranks' `last_merges`, which take a second to find and can be handed over. Each of three memos holds
    `memo_bytes` at most (MEMO_BYTES if None); smaller ones cost time only.
    """

    def __init__(self, ranks: bytes, merges: dict[int, tuple[int, int]] | None = None, pattern: str = PATTERN, memo_bytes: int | None = None):
        memo_bytes = MEMO_BYTES if memo_bytes is None else memo_bytes
        self.ranks = parse_ranks(ranks)
        self.merges = last_merges(self.ranks) if merges is None else merges
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.plain_split = plain_pattern(pattern).findall
        self.beyond_plain = re.compile(f"[^\\x00-\\u{PLAIN_BELOW - 1:04x}]").search
        # Every pattern here cuts before a space that a non-space follows; any other spacing is left to the pattern.
        self.odd_space = re.compile(r" (?:\s|\Z)").search
        self.automaton = ahocorasick.Automaton()
        self.whole = {}
        for token, rank in self.ranks.items():
            text = token.decode("latin-1")
            self.whole[text] = rank
            self.automaton.add_word(text, rank)
        self.automaton.make_automaton()
        self.length = {rank: len(token) for token, rank in self.ranks.items()}
        self.longest = max(self.length.values())
        self.shorter = {rank: self.prefix_token(token.decode("latin-1"), len(token) - 1) for token, rank in self.ranks.items()}
        # Keyed by both ranks in one number.
        self.together = Memo(lambda pair: self.stay_apart(pair >> 32, pair & 0xFFFFFFFF), memo_bytes)
        self.pieces = Memo(self.encode_piece, memo_bytes)
        # Keyed without the space in front.
        self.chunks = Memo(lambda chunk: self.encode_long(" " + chunk), memo_bytes)

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens next to each other survive the merges.

        Merges are undone from the last one on; at each step the tokens that face each other across the border must
        not form one that would have been merged before what was just undone. Of equal merges the left one goes first.
        """
        limit = len(self.ranks) + 1
        while True:
            if self.ranks.get(self.tokens[left] + self.tokens[right], limit) < limit:
                return False
            undo_left, undo_right = left in self.merges, right in self.merges
            if undo_left and (left > right or not undo_right):
                limit = left
                left = self.merges[left][1]
            elif undo_right:
                limit = right + 1
                right = self.merges[right][0]
            else:
                return True

    def encode_piece(self, piece: str) -> bytes:
        """Packed tokens of one match of the pattern."""
        text = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        rank = self.whole.get(text)
        if rank is not None:
            return packed((rank,))
        together = self.together
        chosen = [token for _, token in self.automaton.iter_long(text)]
        if all([together[a << 32 | b] for a, b in zip(chosen, chosen[1:])]):
            return packed(chosen)
        return packed(self.backtrack(text))

    def backtrack(self, text: str) -> list[int]:
        """Where longest matches one after another don't go together, shorter ones are tried from the left."""
        length, together, shorter, n = self.length, self.together, self.shorter, len(text)
        alive = bytearray(b"\1") * (n + 1)
        chosen: list[int] = []
        at, token = 0, self.longest_match(text, 0)
        while True:
            while token is not None:
                end = at + length[token]
                if alive[end] and (not chosen or together[chosen[-1] << 32 | token]):
                    break
                token = shorter[token]
            if token is None:
                alive[at] = 0
                token = chosen.pop()
                at -= length[token]
                continue
            chosen.append(token)
            if end == n:
                return chosen
            at, token = end, self.longest_match(text, end)

    def longest_match(self, text: str, at: int) -> int:
        """Longest token that starts at a position: the automaton says how far its paths go, tokens end on the way."""
        ahead = text[at : at + self.longest]
        return self.prefix_token(ahead, self.automaton.longest_prefix(ahead))

    def prefix_token(self, text: str, most: int) -> int | None:
        """Longest token of at most `most` bytes that `text` starts with."""
        for size in range(most, 0, -1):
            found = self.whole.get(text[:size])
            if found is not None:
                return found
        return None

    def encode_long(self, text: str) -> bytes:
        """A text split by the pattern as a whole."""
        if not text:
            return b""
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self.encode_piece(text)  # a run of letters is one match
        pieces = (self.split if self.beyond_plain(text) else self.plain_split)(text)
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode_packed(self, text: str | None) -> bytes:
        """Token ids of a whole text as 32-bit numbers; null and empty texts have none."""
        if not text:
            return b""
        if self.odd_space(text):
            return self.encode_long(text)
        first, *rest = text.split(" ")
        return self.encode_long(first) + b"".join(map(self.chunks.__getitem__, rest))

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a whole text; null and empty texts have none."""
        return array("i", self.encode_packed(text)).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _shared(docs: DataFrame, ranks: bytes | None):
    """Ranks and last merges as a broadcast; their size is that of the vocabulary file."""
    ranks = ranks or read_ranks()
    return docs.sparkSession.sparkContext.broadcast((ranks, last_merges(parse_ranks(ranks))))


def encoded(docs: DataFrame, text: str = "text", out: str = "ids", ranks: bytes | None = None) -> DataFrame:
    """Add the token ids of every whole text as an array; null and empty texts give an empty one."""
    shared = _shared(docs, ranks)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = BytePairEncoder(*shared.value)
        for texts in batches:
            yield pd.Series([encoder.encode(x) for x in texts], dtype=object)
        del encoder
        give_back()

    return docs.withColumn(out, F.pandas_udf(of, "array<int>")(F.col(text)))


def decoded(ids: Column, docs: DataFrame, ranks: bytes | None = None) -> Column:
    """Column of the bytes that arrays of token ids stand for."""
    shared = _shared(docs, ranks)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = {rank: token for token, rank in parse_ranks(shared.value[0]).items()}.__getitem__
        for arrays in batches:
            yield pd.Series([b"".join(map(tokens, x)) for x in arrays], dtype=object)

    return F.pandas_udf(of, "binary")(ids)


def round_trip(docs: DataFrame, ranks: bytes | None = None, keep_ids: bool = False, memo_bytes: int | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, digest of the ids in decimal joined by one space, digest of the decoded bytes, and
    the ids themselves if asked for.

    Encodes every whole text and decodes its ids again in the same task. Null texts are empty; repeated rows and null
    doc_ids are kept; other columns are ignored; an empty table gives no rows. `memo_bytes` bounds a task's memos, as in
    BytePairEncoder.
    """
    shared = _shared(docs, ranks)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BytePairEncoder(*shared.value, memo_bytes=memo_bytes)
        decimal = {i: str(i) for i in encoder.tokens}.__getitem__

        def rows(doc_ids: pa.Array, kept: list[bytes], digests: list[tuple[str, str]]) -> pa.RecordBatch:
            ends = [0, *accumulate(len(x) // 4 for x in kept)]
            columns = {
                "doc_id": doc_ids, "n_tokens": pa.array([len(x) // 4 for x in kept], pa.int64()),
                "ids_sha256": pa.array([x for x, _ in digests], pa.string()), "decoded_sha256": pa.array([x for _, x in digests], pa.string()),
            }
            if keep_ids:
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(kept))])
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            doc_ids, start, held = batch["doc_id"], 0, 0
            kept: list[bytes] = []
            digests: list[tuple[str, str]] = []
            for at, text in enumerate(batch["text"]):
                ids = encoder.encode_packed(text.as_py())
                numbers = array("i", ids).tolist()
                digests.append((hashlib.sha256(" ".join(map(decimal, numbers)).encode()).hexdigest(), hashlib.sha256(encoder.decode(numbers)).hexdigest()))
                kept.append(ids)
                held += len(numbers)
                if held >= TOKENS:
                    yield rows(doc_ids.slice(start, len(kept)), kept, digests)
                    start, held, kept, digests = at + 1, 0, [], []
            if kept:
                yield rows(doc_ids.slice(start, len(kept)), kept, digests)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(thrifty(of), schema)
