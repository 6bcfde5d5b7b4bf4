"""Splitting texts into the pieces that byte-level BPE merges within, for whole batches.

The pattern is that of public_tokenizers.PATTERN. Instead of matching piece by piece, the
code points of all texts of a batch are classed by a table and the starts of pieces
follow from the borders of runs of one class, with array operations:

* runs of letters, numbers and other signs are pieces; a single space before one joins it;
* a run of white space before another character gives up its last character: a space
  joins what follows, any other sign is a piece of its own;
* an apostrophe at the start of a piece takes a short ending (s t m d re ve ll) along.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex

from vectorloom.llm.common import until_others

OTHER, LETTER, NUMBER, SPACE = range(4)
# Code points with the Unicode property White_Space, as first and last.
SPACES = ((9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
LONG_WORD = 64  # longer pieces are rare and not kept


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    low, high = 0xD800, 0xE000  # not characters
    for shift, part in ((0, range(low)), (high, range(high, 0x110000))):
        text = "".join(map(chr, part))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for match in regex.finditer(pattern, text):
                table[shift + match.start() : shift + match.end()] = kind
    for first, last in SPACES:
        table[first : last + 1] = SPACE
    return table


def _is(codes: np.ndarray, letters: str) -> np.ndarray:
    return np.isin(codes, [ord(c) for c in letters])


def piece_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Places where pieces start; ``text_starts`` are places below ``len(codes)`` where texts do."""
    n = len(codes)
    kind = classes()[codes]
    first = np.zeros(n + 3, bool)  # some room behind the end
    first[text_starts] = True
    opens = first.copy()  # starts of texts
    first[1:n] |= kind[1:] != kind[:-1]

    runs = np.flatnonzero(first[:n])
    spaces = np.flatnonzero(kind[runs] == SPACE)
    spaces = spaces[spaces + 1 < len(runs)]
    behind = runs[spaces + 1]
    behind = behind[~opens[behind]]  # something of the same text follows
    first[behind - 1] = True
    first[behind[codes[behind - 1] == 32]] = False

    marks = np.flatnonzero(codes[: n - 1] == 39) if n else runs
    marks = marks[first[marks] & (kind[marks + 1] == LETTER) & ~opens[marks + 1]]
    one = _is(codes[marks + 1], "stmd")
    first[marks[one] + 1] = False
    first[marks[one] + 2] = True
    rest = marks[~one]
    rest = rest[(rest + 2 < n)]
    rest = rest[~opens[rest + 2]]
    a, b = codes[rest + 1], codes[rest + 2]
    two = rest[(_is(a, "rv") & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))]
    first[two + 1] = False
    first[two + 3] = True
    return np.flatnonzero(first[:n])


def split(texts: Sequence[str]) -> list[list[str]]:
    """The pieces of each text."""
    joined = "".join(texts)
    if not joined:
        return [[] for _ in texts]
    ends = np.cumsum([len(t) for t in texts])
    begins = np.concatenate([[0], ends[:-1]])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = piece_starts(codes, begins[begins < ends])
    at = starts.tolist()
    words = [joined[a:b] for a, b in zip(at, [*at[1:], len(joined)])]
    first = np.searchsorted(starts, begins).tolist()
    last = np.searchsorted(starts, ends).tolist()
    return [words[a:b] for a, b in zip(first, last)]


class WordIds:
    """Token ids of pieces as bytes; each distinct piece is encoded once while it is kept.

    ``encode`` gives the ids of each of a list of pieces. At most ``most`` pieces are kept.
    """

    def __init__(self, encode: Callable[[list[str]], list[Sequence[int]]], dtype: np.dtype, most: int = 300_000):
        self.encode, self.dtype, self.most = encode, np.dtype(dtype), most
        self.known: dict[str | bytes, bytes] = {}

    def ids(self, pieces: Sequence[list[str]]) -> list[np.ndarray]:
        """The ids of each text, given as its pieces."""
        distinct = set().union(*pieces) if pieces else set()
        if len(self.known) > self.most:
            self.known = {}
        known = self.known
        missing = [w for w in distinct if w not in known]
        for word, ids in zip(missing, self.encode(missing) if missing else []):
            known[word] = np.array(ids, self.dtype).tobytes()
        result = [np.frombuffer(b"".join([known[w] for w in words]), self.dtype) for words in pieces]
        for word in missing:
            if len(word) > LONG_WORD:
                del known[word]
        return result


    def of_texts(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text: pieces are told apart by Arrow, and only the distinct ones are met in Python."""
        joined = "".join(texts)
        ends = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if texts else ends
        if not joined:
            return [np.zeros(0, self.dtype) for _ in texts]
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = piece_starts(codes, begins[begins < ends])
        wide = np.ones(len(codes), np.int32)
        for least in (0x80, 0x800, 0x10000):
            wide += codes >= least
        byte = np.concatenate([[0], np.cumsum(wide)])
        buffers = [None, pa.py_buffer(byte[np.append(starts, len(codes))].astype(np.int32)), pa.py_buffer(joined.encode())]
        coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > self.most:
            self.known = {}
        known = self.known
        missing = [w for w in distinct if w not in known]
        for word, ids in zip(missing, self.encode([w.decode() for w in missing]) if missing else []):
            known[word] = np.asarray(ids, self.dtype).tobytes()
        parts = [known[w] for w in distinct]
        for word in missing:
            if len(word) > LONG_WORD:
                del known[word]
        flat = np.frombuffer(b"".join(parts), self.dtype)
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        which = coded.indices.to_numpy()
        count = size[which]
        until = np.concatenate([[0], np.cumsum(count)])
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - until[:-1], count) + np.arange(until[-1])]
        first, last = until[np.searchsorted(starts, begins)], until[np.searchsorted(starts, ends)]
        return [ids[a:b] for a, b in zip(first.tolist(), last.tolist())]


def _byte_signs() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones
    of Latin-1 stand for themselves, the others are numbered from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(own))
    return {byte: byte for byte in own} | {byte: 256 + i for i, byte in enumerate(others)}


@cache
def library_words(path: str, most: int = 300_000) -> WordIds:
    """Ids by the tokenizers library for a vocabulary file; one per Python worker, until a task of another module comes."""
    until_others(library_words.cache_clear)
    tokenizer, _ = _added(path)
    model, signs = tokenizer.model, _byte_signs()

    def encode(words: list[str]):
        # a word is one piece already: the library's model does its merges without the steps around them
        return [[t.id for t in model.tokenize(w.encode().decode("latin-1").translate(signs))] for w in words]

    small = tokenizer.get_vocab_size() <= 1 << 16
    return WordIds(encode, np.uint16 if small else np.uint32, most)


@cache
def _added(path: str):
    """The library's tokenizer of a vocabulary file, and the tokens added to its vocabulary."""
    import os

    until_others(_added.cache_clear)
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, [token.content for token in tokenizer.get_added_tokens_decoder().values()]


def library_ids(path: str, texts: Sequence[str]) -> list[np.ndarray]:
    """The ids of each text as the library's ``encode`` gives them, without ids around the text.

    Texts that hold an added token go to the library whole; it cuts them there first.
    """
    words = library_words(path)
    tokenizer, added = _added(path)
    whole = [i for i, text in enumerate(texts) if any(token in text for token in added)]
    if not whole:
        return words.of_texts(texts)
    held = set(whole)
    ids = words.of_texts(["" if i in held else text for i, text in enumerate(texts)])
    for i in whole:
        ids[i] = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, words.dtype)
    return ids
