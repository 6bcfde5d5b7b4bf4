"""Toxicity by a subsequence string kernel and a support vector machine.

Texts are read as sentences of units: words reduced to their letters, with runs of single
letters joined ("s t u p i d"), and windows of words that are very long. Two units are
alike by the subsequence kernel: common subsequences of four letters, or letters and ends
of words, count, the less the more they are stretched, so letters put in between lower the likeness but don't end it.
Nystroem features against a few landmark strings make the kernel linear. The machine
learns on labelled sentences: units of clean documents' sentences are negative; the
positive units are those that stand in far more toxic documents than chance allows (all labelled
documents are counted, copies once), also with letters put in. A sentence's margin is the highest of its units, a document's
that of its worst sentence; a logistic curve over it and the next margins gives the
score, fitted on labelled documents as they are and with letters put in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.functions.batches import slices
from vectorloom.llm.common import id_and_text, map_rows, stored, worker_cache
from vectorloom.llm.exact_dedup import maybe_in
from vectorloom.llm.quality import fold, sample_ids, sigmoid

NOT_LETTERS = re.compile(r"[\W\d_]+")
SENTENCE_END = re.compile(r"(?<=[.!?\n])\s+|\n")
LETTERS = 3  # of the shortest unit
ORDER = 4  # letters of a subsequence, with the marks of a word's ends
START, END = "^", "$"
UNIT = 20  # letters of the longest unit; longer words are read in windows
STEP = 10
POWER = 2  # of the normalised kernel: a product of kernels is one, and near strings stand out
WORST = 4  # units of a document whose margins count beside the highest
KEPT_UNITS = 400_000
PART_BYTES = 4 << 20  # of texts looked at together
WORDS_AT_ONCE = 32_768
PRODUCTS_AT_ONCE = 8_192
PATTERN = 20  # letters and marks of words told apart by the places of equal letters: 20! is below 2**63
# Odd factors that mix hashes, one per unit of a window.
MIX = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
WINDOW = len(MIX)


@dataclass(frozen=True)
class ToxicitySettings:
    """Bounds of what is fitted on: labelled documents of either label, and units of either kind."""

    most_rows: int = 10_000
    most_positive: int = 600
    most_negative: int = 6_000
    most_searched: int = 40_000
    landmarks: int = 48
    decay: float = 0.6
    inserted: int = 4
    regular: float = 1e-4
    surprise: float = 8.0  # least evidence for a telling unit, as a log-likelihood ratio
    lift: float = 8.0  # and least ratio of its shares of toxic and clean documents
    seed: int = 11


def units(text: str) -> list[str]:
    """Units of a sentence or text, repeated ones too."""
    found, singles = [], []
    for word in text.lower().split():
        if not word.isalpha():
            word = NOT_LETTERS.sub("", word)
        if len(word) == 1:
            singles.append(word)
            continue
        if singles and word:
            if len(singles) >= LETTERS:
                found += _windows("".join(singles))
            singles = []
        if len(word) <= UNIT:
            found.append(word)
        else:
            found += _windows(word)
    if len(singles) >= LETTERS:
        found += _windows("".join(singles))
    return found


def _windows(word: str) -> list[str]:
    return [word[a : a + UNIT] for a in range(0, max(1, len(word) - UNIT + STEP), STEP)]


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE_END.split(text) if s]


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points, between marks."""
    joined = "".join([START + w + END for w in words]).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32).reshape(len(words), -1)


def _run_up(counts: np.ndarray) -> np.ndarray:
    """Running sums over the letters of the partner, in place: a few long additions."""
    for at in range(1, counts.shape[-2]):
        counts[..., at, :] += counts[..., at - 1, :]
    return counts


def kernel(rows: np.ndarray, others: np.ndarray, decay: float) -> np.ndarray:
    """Subsequence kernel of each row with each other's columns.

    ``rows`` is (n, length); ``others`` is (width, n) for one partner per row, or
    (width, 1) for one partner of all. A subsequence weighs decay to the power of the
    letters it spans in both. The weight of a span is that of its end over that of its
    start, so it is counted at the first and the last letter, and sums do between.
    """
    n, width = len(rows), len(others)
    spans = (decay ** np.arange(width)).astype(np.float32)[:, None]
    # counts[i][j]: subsequences of i + 1 letters in the rows so far and letters up to j of the partner
    counts = [np.zeros((width, n), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(n, np.float32)
    for a in range(rows.shape[1]):
        match = others == rows[:, a][None, :]
        last = counts[-1][:-1] * match[1:]
        last *= spans[1:]
        total += np.float32(decay ** (a + 2)) * last.sum(0)
        for i in range(ORDER - 2, 0, -1):
            longer = counts[i - 1][:-1] * match[1:]
            counts[i][1:] += _run_up(longer)
        first = match * (np.float32(decay**-a) / spans)
        counts[0] += _run_up(first)
    return total


class Prefixes:
    """The distinct prefixes of sorted words between marks, level by level.

    A level has the last letter of each prefix, as its place in ``letters``, and the place of
    its parent in the level before; ``ends`` and ``places`` tell where each word ends.
    """

    def __init__(self, words: list[str], start: str = START, end: str = END):
        marked = [start + w + end for w in words]
        self.ends = np.array([len(w) - 1 for w in marked])
        width = int(self.ends.max()) + 1
        padded = "".join([w.ljust(width, "\0") for w in marked]).encode("utf-32-le", "surrogatepass")
        padded = np.frombuffer(padded, np.uint32)
        self.letters = np.unique(padded)
        rows = np.searchsorted(self.letters, padded).reshape(len(words), width)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.places = np.zeros(len(words), np.int64)
        new = np.zeros(len(words), bool)
        new[0] = True
        above = np.zeros(len(words), np.int64)
        for at in range(width):
            new[1:] |= rows[1:, at] != rows[:-1, at]
            inside = self.ends >= at
            first = new & inside
            # words that end before this level lie between those that go on: a prefix starts at its first word
            place = np.cumsum(first) - 1
            self.levels.append((rows[first, at], above[first]))
            here = self.ends == at
            self.places[here] = place[here]
            above = place


def _walk(prefixes: Prefixes, column: np.ndarray, decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``total, counts, at``: of each word with one partner ``kernel``'s sum and its counts, at the places ``at``.

    ``counts[i, j]`` is of i + 1 letters, the last of which meets letter j of the partner. What
    words share at their start is summed once, and a letter that the partner does not have
    changes no sum: such a prefix stands where its parent does.
    """
    width = len(column)
    spans = (decay ** np.arange(width)).astype(np.float32)[:, None]
    held = np.isin(prefixes.letters, column)
    matched = [np.flatnonzero(held[letters]) for letters, _ in prefixes.levels]
    size = 1 + sum(map(len, matched))
    counts = np.zeros((ORDER - 1, width, size), np.float32)
    total = np.zeros(size, np.float32)
    at = np.zeros(len(prefixes.ends), np.int64)
    stands, used = np.zeros(1, np.int64), 1
    for a, ((letters, parents), new) in enumerate(zip(prefixes.levels, matched)):
        stands = stands[parents]
        if len(new):
            before, own = stands[new], slice(used, used + len(new))
            match = (column == prefixes.letters[letters[new]][None, :]).astype(np.float32)
            state = np.take(counts, before, axis=2)
            longer = _run_up(state.copy())[:, :-1]
            longer *= match[1:]
            state[1:, 1:] += longer[:-1]
            state[0] += match * (np.float32(decay**-a) / spans)
            counts[:, :, own] = state
            longer[-1] *= spans[1:]
            total[own] = total[before] + np.float32(decay ** (a + 2)) * longer[-1].sum(0)
            stands[new] = np.arange(used, used + len(new))
            used += len(new)
        here = prefixes.ends == a
        at[here] = stands[prefixes.places[here]]
    return total, counts, at


def prefix_kernel(prefixes: Prefixes, column: np.ndarray, decay: float) -> np.ndarray:
    """``kernel`` of each word with one partner, ``(width, 1)``."""
    total, _, at = _walk(prefixes, column, decay)
    return total[at]


class Halves:
    """Words as a head and a tail each: the distinct heads, and the distinct tails read from their ends.

    A subsequence lies in the head, in the tail, or has its first letters in the one and the
    rest in the other. Words have far fewer heads and tails than there are words, so the
    sums are made for these, and a word takes one product of what its two halves have counted.
    """

    def __init__(self, words: list[str]):
        middles = [len(w) // 2 for w in words]
        self.heads, self.head = self._distinct([w[:m] for w, m in zip(words, middles)], START)
        self.tails, self.tail = self._distinct([w[m:][::-1] for w, m in zip(words, middles)], END)
        self.lengths = np.array([len(w) + 2 for w in words])

    @staticmethod
    def _distinct(halves: list[str], mark: str) -> tuple[Prefixes, np.ndarray]:
        found = sorted(set(halves))
        place = {half: i for i, half in enumerate(found)}
        return Prefixes(found, mark, ""), np.fromiter(map(place.__getitem__, halves), np.int64, len(halves))

    def kernel(self, column: np.ndarray, decay: float) -> np.ndarray:
        """``kernel`` of each word with one partner, ``(width, 1)``."""
        total, counts, at = _walk(self.heads, column, decay)
        total_, counts_, at_ = _walk(self.tails, column[::-1], decay)
        # i + 1 letters that end before letter j of the partner, and the others from letter j on, where both can be
        _run_up(counts)
        last = len(column) - ORDER + 1
        met = np.vstack([counts[i, i : i + last] for i in range(ORDER - 1)]).T.copy()
        meets = np.vstack([counts_[ORDER - 2 - i, ::-1][i + 1 : i + 1 + last] for i in range(ORDER - 1)]).T.copy()
        head, tail = at[self.head], at_[self.tail]
        result = total[head] + total_[tail]
        most, most_ = ((c.any(1)).sum(0, np.int8) for c in (counts, counts_))  # letters in common, one less than ORDER at most
        both = np.flatnonzero(most[head] + most_[tail] >= ORDER)
        weight = (decay ** (self.lengths + len(column))).astype(np.float32)
        for part in range(0, len(both), PRODUCTS_AT_ONCE):
            some = both[part : part + PRODUCTS_AT_ONCE]
            result[some] += weight[some] * np.einsum("ij,ij->i", met[head[some]], meets[tail[some]])
        return result


class Kernel:
    """Normalised kernel values of words with landmarks."""

    def __init__(self, landmarks: list[str], decay: float):
        self.landmarks, self.decay = landmarks, decay
        self.columns = [codes([w]).T for w in landmarks]
        self.norms = [max(1e-12, float(kernel(c.T, c, decay)[0])) ** 0.5 for c in self.columns]

    def _lengths(self, words: list[str]) -> np.ndarray:
        """The root of each word's kernel with itself, which only depends on which of its letters are the same."""
        result = np.zeros(len(words), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for places in by_length.values():
            rows, kinds = codes([words[i] for i in places]), slice(None)
            letters = np.ascontiguousarray(rows.T)
            if len(letters) <= PATTERN:
                # the place of the next same letter, counted back from each letter's own, read as one number
                key = np.zeros(len(rows), np.int64)
                for a in range(1, len(letters)):
                    back = np.zeros(len(rows), np.int64)
                    for b in range(a):
                        np.putmask(back, letters[b] == letters[a], a - b)
                    key *= a + 1
                    key += back
                _, first, kinds = np.unique(key, return_index=True, return_inverse=True)
                letters = np.ascontiguousarray(letters[:, first])
            own = kernel(letters.T, letters, self.decay)
            result[places] = np.sqrt(np.maximum(own, 1e-12))[kinds]
        return result

    def values(self, words: list[str]) -> np.ndarray:
        result = np.zeros((len(words), len(self.landmarks)), np.float32)
        order = [i for i, word in enumerate(words) if len(word) >= LETTERS]
        for at in range(0, len(order), WORDS_AT_ONCE):
            part = order[at : at + WORDS_AT_ONCE]
            some = [words[i] for i in part]
            halves = Halves(some)
            found = np.empty((len(self.landmarks), len(some)), np.float32)
            for row, column, norm in zip(found, self.columns, self.norms):
                np.divide(halves.kernel(column, self.decay), norm, out=row)
            found /= self._lengths(some)
            found **= POWER
            result[part] = found.T
        return result


class _Margins:
    """Margins of the units met lately: ``most`` at least are kept, and twice as many at most after a call.

    What has not been asked for while as many others came goes first, so common units stay.
    """

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def of(self, wanted: set[str], compute) -> dict[str, float]:
        """A dictionary that has at least the units in ``wanted``."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = []
        for unit in wanted:
            if unit not in young:
                if unit in old:
                    young[unit] = old[unit]
                else:
                    missing.append(unit)
        if missing:
            young.update(zip(missing, compute(missing).tolist()))
        return young


class _Words:
    """The words of texts: the letters of each distinct one, and of each occurrence the place there and the text."""

    def __init__(self, texts: list[str]):
        split = pc.utf8_split_whitespace(pa.array([t.lower() for t in texts], pa.string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.letters = [w if w.isalpha() else NOT_LETTERS.sub("", w) for w in words]
        self.sizes = np.fromiter(map(len, self.letters), np.int64)
        self.empty = np.fromiter(map(len, words), np.int64) == 0  # beside white space at an end of a text
        self.places = coded.indices.to_numpy()
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(split).to_numpy())

    def units(self, place: int) -> list[str]:
        word = self.letters[place]
        return [] if len(word) == 1 or self.empty[place] else [word] if len(word) <= UNIT else _windows(word)

    def spelled(self) -> list[int]:
        """Texts where single letters, enough for a unit, follow each other; words without letters don't part them."""
        held = (self.sizes > 0)[self.places]
        single, text = (self.sizes == 1)[self.places[held]], self.text[held]
        starts = max(0, len(text) - LETTERS + 1)
        run = text[:starts] == text[LETTERS - 1 :]
        for a in range(LETTERS):
            run &= single[a : a + starts]
        return np.unique(text[:starts][run]).tolist()


class ToxicityModel:
    def __init__(self, kernel_: Kernel | None, weights: np.ndarray, bias: float, slope: np.ndarray, shift: float):
        self.kernel, self.weights, self.bias, self.slope, self.shift = kernel_, weights, bias, slope, shift

    def margins(self, words: list[str]) -> np.ndarray:
        parts = (words[at : at + WORDS_AT_ONCE] for at in range(0, len(words), WORDS_AT_ONCE))
        return np.concatenate([np.zeros(0), *(self.kernel.values(part) @ self.weights + self.bias for part in parts)])

    def known(self, wanted: set[str]) -> dict[str, float]:
        """Margins of at least these units. A worker keeps those of its last model, until ``_parts`` ends its task."""
        key = (*self.kernel.landmarks, self.kernel.decay, self.weights.tobytes(), self.bias)
        kept = worker_cache(__name__)
        if key not in kept:
            kept.clear()
            kept[key] = _Margins(KEPT_UNITS // 2)
        return kept[key].of(wanted, self.margins)

    def found(self, texts: list[str]) -> tuple[np.ndarray, list[set[str]]]:
        """Of each text the highest margin of a unit (minus infinity without one), and the units with margins above zero.

        A word that comes again, in any of the texts, is looked at once; texts that spell words out are read unit by unit.
        """
        words = _Words(texts)
        spelled = {i: set(units(texts[i])) for i in words.spelled()}
        plain = (words.sizes != 1) & (words.sizes <= UNIT) & ~words.empty
        usual = np.flatnonzero(plain).tolist()
        others = {place: words.units(place) for place in np.flatnonzero(~plain).tolist()}
        known = self.known({words.letters[place] for place in usual}.union(*others.values(), *spelled.values()))
        margins = np.full(len(plain), -np.inf)
        margins[usual] = [known[words.letters[place]] for place in usual]
        for place, own in others.items():
            margins[place] = max(map(known.__getitem__, own), default=-np.inf)
        margins, text = margins[words.places], words.text
        tops, above = np.full(len(texts), -np.inf), [set() for _ in texts]
        if len(text):
            first = np.flatnonzero(np.diff(text, prepend=-1))
            tops[text[first]] = np.maximum.reduceat(margins, first)
        for at in np.flatnonzero(margins > 0).tolist():
            above[text[at]].update(u for u in words.units(words.places[at]) if known[u] > 0)
        for i, bag in spelled.items():
            tops[i] = max(map(known.__getitem__, bag), default=-np.inf)
            above[i] = {u for u in bag if known[u] > 0}
        return tops, above

    def worst(self, texts: list[str]) -> np.ndarray:
        """Of each text the highest margin of a unit, and the sum of the next ones above zero."""
        if self.kernel is None:
            return np.zeros((len(texts), 2))
        result = np.full((len(texts), 2), [min(self.bias, -1.0), 0.0])
        tops, above = self.found(texts)
        result[:, 0] = np.where(tops == -np.inf, result[:, 0], np.maximum(tops, -1.0))
        known = self.known(set().union(*above))
        for row, bag in zip(result, above):
            row[1] = sum(nlargest(1 + WORST, map(known.__getitem__, bag))[1:])
        return result

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.worst(texts) @ self.slope + self.shift)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of a task's texts. After the last one, no margins are kept: many workers may wait for their next task."""
    try:
        yield from slices(batches, PART_BYTES)
    finally:
        worker_cache(__name__).clear()


class _Hashes(dict):
    """The 64-bit hash of each unit, taken once."""

    def __missing__(self, unit: str) -> int:
        self[unit] = value = xxhash.xxh64_intdigest(unit)
        return value


def _group(own: list[str], hashes: _Hashes) -> int:
    """The least hash of a text's windows of three units: equal texts share it, near copies nearly always."""
    values = np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own))
    if len(own) >= WINDOW:
        values = sum(values[i : len(own) - WINDOW + 1 + i] * MIX[i] for i in range(WINDOW))
    values = (values ^ (values >> np.uint64(32))) * MIX[0]
    return int((values ^ (values >> np.uint64(29))).min() >> np.uint64(1))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct units of each group of documents and label, as one text per slice; units have no blanks."""
    for batch in batches:
        found: dict[tuple[int, int], set[str]] = {}
        hashes = _Hashes()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = [unit for sentence in sentences(text) for unit in units(sentence)]
            if own:
                long = {unit for unit in own if len(unit) >= LETTERS}
                found.setdefault((toxic, _group(own, hashes)), set()).update(long)
        rows = [(toxic, group, " ".join(held)) for (toxic, group), held in found.items() if held]
        kinds = (pa.int32(), pa.int64(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [(), (), ()], kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["toxic", "document", "units"])


def unit_counts(texts: DataFrame) -> DataFrame:
    """``unit, a, b``: groups of documents that hold a unit, of toxic and of clean ones.

    A group's units travel as one text and are counted where they meet, so pairs of unit and
    document don't move.
    """
    held = map_rows(texts, _documents, "toxic int, document bigint, units string").groupBy("toxic", "document")
    joined = F.concat_ws(" ", F.collect_list("units"))
    held = held.agg(F.array_distinct(F.split(joined, " ")).alias("units")).select("toxic", F.explode("units").alias("unit"))
    return held.groupBy("unit").agg(
        F.sum("toxic").cast("bigint").alias("a"), F.sum(1 - F.col("toxic")).cast("bigint").alias("b")
    )


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of each document and label; only texts that may have one are moved.

    Labels grow with the documents, so the join is by a shuffle also where they are few.
    """
    own_label = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
    found = maybe_in(id_and_text(docs), own_label, "doc_id")
    return found.join(own_label.hint("merge"), "doc_id").select("text", "toxic")


def _with_inserted(words: list[str], times: int, random: np.random.Generator) -> list[str]:
    result = []
    for word in words:
        for _ in range(times):
            at = int(random.integers(1, max(2, len(word))))
            result.append(word[:at] + chr(int(random.integers(97, 123))) + word[at:])
    return [w[:UNIT] for w in result]


def _spread(words: list[str], count: int, decay: float) -> list[str]:
    """Words far from each other: each next one is the least like those chosen."""
    if len(words) <= count:
        return words
    chosen, likest = [words[0]], Kernel([words[0]], decay).values(words)[:, 0]
    while len(chosen) < count:
        chosen.append(words[int(np.argmin(likest))])
        likest = np.maximum(likest, Kernel(chosen[-1:], decay).values(words)[:, 0])
    return chosen


def _machine(rows: np.ndarray, signs: np.ndarray, times: np.ndarray, regular: float) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, both labels weighing the same; Newton steps."""
    design = np.hstack([rows, np.ones((len(rows), 1))]).astype(np.float64)
    weigh = times * np.where(signs > 0, 0.5 / (signs > 0).sum(), 0.5 / (signs < 0).sum())
    ridge = regular * np.eye(design.shape[1])
    ridge[-1, -1] = 1e-9
    at = np.zeros(design.shape[1])
    for _ in range(30):
        short = np.maximum(0, 1 - signs * (design @ at))
        inside = design[short > 0]
        slope = ridge @ at - inside.T @ (weigh * signs * short)[short > 0]
        curve = ridge + (inside * weigh[short > 0][:, None]).T @ inside
        step = np.linalg.solve(curve, slope)
        at -= step
        if np.abs(step).max() < 1e-7:
            break
    return at[:-1], float(at[-1])


def _logistic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and shift of a logistic curve, a little regular so that parted labels keep it finite."""
    design, at = np.column_stack([values, np.ones(len(values))]), np.zeros(values.shape[1] + 1)
    ridge = 0.02 * np.array([1.0] * values.shape[1] + [0.0])
    for _ in range(60):
        p = sigmoid(design @ at)
        slope = design.T @ (p - labels) + ridge * at
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(ridge + 1e-6)
        step = np.linalg.solve(curve, slope)
        at -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return np.maximum(at[:-1], 0.0), float(at[-1])


def _altered(text: str) -> str:
    """The text with a letter put into each word, at a place that its hash gives."""
    result = []
    for word in text.split():
        draw = crc32(word.encode())
        at = 1 + draw % max(1, len(word) - 1)
        result.append(f"{word[:at]}{chr(97 + (draw >> 8) % 26)}{word[at:]}")
    return " ".join(result)


def _worst(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    """Margins of the texts, and of their altered forms."""
    for batch in _parts(batches):
        texts = batch.column("text").to_pylist()
        for form in (str, _altered):
            margins = model.worst(list(map(form, texts)))
            columns = [batch.column("toxic"), pa.array(margins[:, 0]), pa.array(margins[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "worst", "next"])


def _mistaken(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        texts = [t for t, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()) if not toxic]
        found = [unit for bag in model.found(texts)[1] for unit in bag]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["unit"])


def fit(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings | None = None) -> ToxicityModel:
    """Learn from the texts of ``docs`` labelled in ``labels`` (``doc_id``, ``toxic`` 0 or 1).

    Units are counted in all labelled documents; at most ``most_rows`` of each label, chosen
    by hash, are fitted on. Without
    telling units (no or too few toxic texts) all scores are 0.
    """
    settings = settings or ToxicitySettings()
    random = np.random.default_rng(settings.seed)
    parts = [
        sample_ids(labels.where(F.col("toxic") == v), settings.most_rows).withColumn("toxic", F.lit(v)) for v in (0, 1)
    ]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    # a bounded number of texts, read three times: few large tasks meet a unit fewer times than many small ones
    texts = id_and_text(docs).join(chosen, "doc_id").select("text", "toxic")
    texts = stored(texts.repartition(docs.sparkSession.sparkContext.defaultParallelism), "toxic-texts")

    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    none = ToxicityModel(None, np.zeros(0), 0.0, np.zeros(2), -40.0)
    if not toxic or not clean:
        return none
    # documents are counted, groups of copies once, and over all labels: the bar stays when the sample is capped
    counted = stored(unit_counts(labelled_texts(docs, labels)), "toxic-units")
    total = counted.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total["a"] or not total["b"]:
        return none
    # surprise: log-likelihood ratio of the unit's own share of toxic documents against the common one
    share, n = total["a"] / (total["a"] + total["b"]), F.col("a") + F.col("b")
    own = F.col("a") / n
    told = F.col("a") * F.log(own / share) + F.when(F.col("b") > 0, F.col("b") * F.log((1 - own) / (1 - share))).otherwise(0)
    often = F.col("a") / total["a"] >= settings.lift * (F.col("b") + 0.5) / total["b"]
    telling = counted.where(often & (told > settings.surprise))
    telling = telling.orderBy(F.desc(told), "unit").limit(settings.most_positive)
    positive = [r["unit"] for r in telling.select("unit").collect()]
    if not positive:
        return none
    harmless = counted.where((F.col("b") > 0) & ~often).orderBy(F.xxhash64("unit"), "unit")
    searched = [r["unit"] for r in harmless.limit(settings.most_searched).select("unit").collect()]

    negative = searched[: settings.most_negative // 2]
    changed = _with_inserted(positive, settings.inserted, random)
    marks = _spread(positive, settings.landmarks * 2 // 3, settings.decay)
    marks += _spread(negative, settings.landmarks - len(marks), settings.decay) if negative else []
    kernel_ = Kernel(marks, settings.decay)
    own_values = kernel_.values(marks).astype(np.float64)
    values, vectors = np.linalg.eigh((own_values + own_values.T) / 2 + 1e-3 * np.eye(len(marks)))
    root = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T

    near = kernel_.values(searched)[:, : min(len(positive), settings.landmarks * 2 // 3)].max(1) if searched else []
    hard = [searched[i] for i in np.argsort(near)[::-1][: settings.most_negative // 2]]
    negative = list(dict.fromkeys([*negative, *hard])) or ["aaa"]

    def machine(extra: list[tuple[str, int]]) -> ToxicityModel:
        words = [*positive, *changed, *negative, *(w for w, _ in extra)]
        rows = kernel_.values(words) @ root
        signs = np.array([1.0] * (len(positive) + len(changed)) + [-1.0] * (len(words) - len(positive) - len(changed)))
        times = np.array([1.0] * (len(words) - len(extra)) + [float(n) for _, n in extra])
        weights, bias = _machine(rows, signs, times, settings.regular)
        return ToxicityModel(kernel_, root @ weights, bias, np.zeros(2), 0.0)

    # units of clean sentences that the first machine takes for insults count as often as they occur
    mistaken = map_rows(texts, _mistaken, "unit string", machine([])).groupBy("unit").agg(F.count("*").alias("n"))
    mistaken = mistaken.orderBy(F.desc("n"), "unit").limit(settings.most_negative).collect()
    model = machine([(r["unit"], r["n"]) for r in mistaken if r["unit"] not in set(positive)])

    margins = map_rows(texts, _worst, "toxic int, worst double, next double", model).toPandas()
    margins = margins.sort_values(["toxic", "worst", "next"])  # sums don't depend on the order of tasks
    model.slope, model.shift = _logistic(margins[["worst", "next"]].to_numpy(), margins["toxic"].to_numpy(np.float64))
    return model


def _score(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        scores = model.scores(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])


def score(docs: DataFrame, model: ToxicityModel, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, score`` of every row, from its whole text.

    Null and empty texts have the score of a text without units. Null identifiers and
    repeated rows pass through; equal texts have equal scores; other columns are not read.
    """
    return map_rows(id_and_text(docs, id_col, text_col), _score, "doc_id bigint, score double", model)


def learned(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1) -> ToxicityModel:
    """The model from the rows outside of the held-out fold."""
    return fit(docs, labels.where(fold(F.col("doc_id"), parts) != held))


def score_documents(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1, threshold: float = 0.7):
    """``doc_id, held_out, score, predicted`` of every row, learned from the rows outside of the held-out fold.

    Null and empty texts are scored as texts without units; a null identifier is in no
    fold (``held_out`` is null). Repeated rows and other columns are as in ``score``. Without toxic or without
    clean labels, or without a unit that tells them apart, all scores are all but 0.
    """
    return score(docs, learned(docs, labels, parts, held)).select(
        "doc_id",
        (fold(F.col("doc_id"), parts) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _keep(batches: Iterator[pa.RecordBatch], column: int, model: ToxicityModel, threshold: float):
    for batch in _parts(batches):
        texts = [t or "" for t in batch.column(column).to_pylist()]
        yield batch.filter(pa.array(model.scores(texts) < threshold))


def keep_civil(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col="text") -> DataFrame:
    """The rows, with all columns, whose score is below the threshold."""
    return map_rows(docs, _keep, docs.schema, docs.columns.index(text_col), model, threshold)
