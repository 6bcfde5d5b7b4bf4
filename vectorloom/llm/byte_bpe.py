"""Byte-level BPE by tree reduction.

Encoding is a reduction with an associative join. A text is halved until its parts are
short; parts are split into pieces by the pattern, long pieces are halved again and short
byte strings are merged by rank. Neighbours are joined by doing the work anew in a window
around the border, which grows until what lies outside is proven to stay:

* pieces: a match depends on the characters behind it only through the next three, and
  not on those before its start. So pieces that end four characters before the border
  stay, and as soon as a piece starts where one of the right part does, the rest stays.
* tokens: a row of tokens is the encoding of its bytes exactly if each two neighbours
  are the encoding of theirs. (The first merge across a border between tokens would
  also be the first one in the merge of these two alone.) So when the border pairs of
  the window hold, the tokens outside stay.

Decoding joins the bytes of halves in the same way.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vectorloom.llm.common import id_and_text, map_rows, until_others
from vectorloom.llm.pretokens import WordIds, split

LEAF_CHARS = 1 << 16
LEAF_BYTES = 48
LEAF_IDS = 1 << 12
SETTLED = 4  # characters: pieces that end this far before a border don't depend on what follows
KEPT_PAIRS = 1 << 17
TEXT_BYTES = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, from lines of a base64 word and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}


def split_tree(text: str, leaf: int = LEAF_CHARS) -> list[str]:
    """The pieces of a text, by halves."""
    if len(text) <= leaf:
        return split([text])[0]
    middle = len(text) // 2
    return join_pieces(split_tree(text[:middle], leaf), split_tree(text[middle:], leaf))


def join_pieces(left: list[str], right: list[str]) -> list[str]:
    """The pieces of two neighbouring parts together."""
    reach = 4
    while True:
        # from the left as many pieces as have the unsettled characters and some more
        a, chars = len(left), 0
        while a and (chars < SETTLED or len(left) - a < reach):
            a -= 1
            chars += len(left[a])
        b = min(len(right), reach)
        whole = b == len(right)
        window = "".join([*left[a:], *right[:b]])
        again = split([window])[0]
        if whole:
            return [*left[:a], *again]
        limit = len(window) - SETTLED  # what ends behind it may change with more text
        starts, at = {}, chars
        for i in range(b):
            starts[at] = i
            at += len(right[i])
        at = 0
        for i, piece in enumerate(again):
            if chars <= at <= limit and at in starts:
                return [*left[:a], *again[:i], *right[starts[at] :]]
            at += len(piece)
        reach *= 2


class TreeBpe:
    """Encodes and decodes by ranks; ``leaf`` is the longest byte string merged directly."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF_BYTES):
        self.ranks, self.leaf = ranks, leaf
        self.bytes_of = {rank: word for word, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Join the adjacent parts of least rank, the leftmost first, until none are left."""
        if len(data) > 2 * self.leaf:
            return self._merge_long(data)
        ranks, none = self.ranks, 1 << 62
        parts = [data[i : i + 1] for i in range(len(data))]
        joint = [ranks.get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while joint:
            least = min(joint)
            if least == none:
                break
            i = joint.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joint[i]
            if i:
                joint[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            if i < len(joint):
                joint[i] = ranks.get(parts[i] + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same for windows that had to grow large, with a heap."""
        n, ranks = len(data), self.ranks
        ends, before = list(range(1, n + 1)), list(range(-1, n))  # part i is data[i:ends[i]]
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01" * n)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or ends[i] == n or ends[ends[i]] != end or not alive[ends[i]]:
                continue
            alive[ends[i]] = 0
            ends[i] = end
            if end < n:
                before[end] = i
                if (rank := ranks.get(data[i : ends[end]])) is not None:
                    heapq.heappush(heap, (rank, i, ends[end]))
            if (p := before[i]) >= 0 and (rank := ranks.get(data[p:end])) is not None:
                heapq.heappush(heap, (rank, p, end))
        result, at = [], 0
        while at < n:
            result.append(ranks[data[at : ends[at]]])
            at = ends[at]
        return result

    def _stays(self, one: int, other: int) -> bool:
        pair = (one, other)
        if pair not in self.pairs:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[pair] = self.merge(self.bytes_of[one] + self.bytes_of[other]) == [one, other]
        return self.pairs[pair]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring byte strings of one piece together."""
        reach = 1
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            window = self.merge(b"".join([self.bytes_of[t] for t in [*left[a:], *right[:b]]]))
            if (a == 0 or self._stays(left[a - 1], window[0])) and (
                b == len(right) or self._stays(window[-1], right[b])
            ):
                return [*left[:a], *window, *right[b:]]
            reach *= 2

    def tokens(self, data: bytes) -> list[int]:
        """The merges of one piece, by halves."""
        if len(data) <= self.leaf:
            return self.merge(data)
        middle = len(data) // 2
        return self.join(self.tokens(data[:middle]), self.tokens(data[middle:]))

    def piece(self, piece: str) -> list[int]:
        """Ids of a piece; one that is a token as a whole is that token, whatever its merges."""
        data = piece.encode()
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tokens(data)

    def encode(self, text: str, leaf: int = LEAF_CHARS) -> list[int]:
        return [t for piece in split_tree(text, leaf) for t in self.piece(piece)]

    def decode(self, ids: Sequence[int], leaf: int = LEAF_IDS) -> bytes:
        if len(ids) <= leaf:
            return b"".join([self.bytes_of[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)


@cache
def _coder(path: str) -> tuple[TreeBpe, WordIds]:
    """One per Python worker, until a task of another module comes."""
    until_others(_coder.cache_clear)
    ranks = read_ranks(path)
    bpe = TreeBpe(ranks)
    return bpe, WordIds(lambda words: [bpe.piece(w) for w in words], np.uint32)


def _round_trip(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe, words = _coder(path)
    for batch in batches:
        step = max(1, batch.num_rows * TEXT_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            texts = part.column("text").to_pylist()
            short = [t for t in texts if len(t) <= LEAF_CHARS]
            done = iter(split(short))
            pieces = [next(done) if len(t) <= LEAF_CHARS else split_tree(t) for t in texts]
            ids = words.ids(pieces)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
                    "decoded_sha256": pa.array(
                        [hashlib.sha256(bpe.decode(i.tolist())).hexdigest() for i in ids], pa.string()
                    ),
                }
            )


def round_trip(docs: DataFrame, ranks_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Encode every whole text, decode the ids; digests of both.

    Null texts are empty, and empty texts have no ids. Null identifiers and repeated rows
    pass through; other columns are not read. The file of ranks must be readable at the
    same path on every executor.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(id_and_text(docs, id_col, text_col), _round_trip, schema, ranks_path)
