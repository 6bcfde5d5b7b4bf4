"""Ranked lexical search for many items at once, with the work they share done once.

The items of a block are mined for term sets that several of them hold. Terms held by
the same items form one leaf; then the pair of nodes that most items share is made a
node of its own, again and again, until no two items share a pair. The nodes form a
graph in which a partial sum of a document is computed once and used by every item
above it. Scores are whole numbers, so the order of the sums changes nothing.

Documents are read once per block: a task counts the block's terms in its texts and
writes only these counts. The corpus figures come from the counts; a second step reads
them, fills the nodes for some documents at a time and keeps ``k`` rows per item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, map_rows, stored
from vectorloom.operators.positions import top_per_group

# A block ends before these are passed; one item alone may be larger.
BLOCK_TERMS = 1 << 16
BLOCK_PAIRS = 1 << 23
CELLS = 1 << 21  # nodes times documents filled at once

# Bytes of terms: digits, letters (lower-cased) and all beyond ASCII; the rest separates.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())

COUNTS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
HITS = "item int, item_id bigint, doc_id bigint, score bigint"


def split_terms(text: str | None) -> list[bytes]:
    """Terms of a text in order: runs of ASCII letters and digits and of characters beyond ASCII; A-Z lower-cased."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


class SharingPlan:
    """Items as sums over nodes; a node is a set of terms or the sum of two earlier nodes."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]]):
        self.item_ids = [item_id for item_id, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        holders: dict[tuple[int, int], list[int]] = defaultdict(list)
        for place, (_, terms) in enumerate(items):
            for term, times in Counter(terms).items():
                number = self.vocabulary.setdefault(term, len(self.vocabulary))
                for layer in range(times):  # the second occurrence is held by fewer items than the first
                    holders[number, layer].append(place)
        leaves: dict[tuple[int, ...], int] = {}
        self.term_leaves: list[list[int]] = [[] for _ in self.vocabulary]
        for (number, _), held in sorted(holders.items()):
            self.term_leaves[number].append(leaves.setdefault(tuple(held), len(leaves)))
        self.leaves = len(leaves)
        self.pairs: list[tuple[int, int]] = []
        self.item_nodes: list[set[int]] = [set() for _ in items]
        for held, leaf in leaves.items():
            for place in held:
                self.item_nodes[place].add(leaf)
        self._mine({leaf: set(held) for held, leaf in leaves.items()})

    @property
    def nodes(self) -> int:
        return self.leaves + len(self.pairs)

    def _mine(self, holders: dict[int, set[int]]) -> None:
        """Replace the pair of nodes that most items share by a node, while two items share one."""
        shared = [sorted(n for n in nodes if len(holders[n]) > 1) for nodes in self.item_nodes]
        counts = Counter((a, b) for nodes in shared for at, a in enumerate(nodes) for b in nodes[at + 1 :])
        heap = [(-times, pair) for pair, times in counts.items() if times > 1]
        heapq.heapify(heap)
        while heap:
            times, (a, b) = heapq.heappop(heap)
            both = holders[a] & holders[b]
            if len(both) < -times:  # an older count: taken up again with the present one
                if len(both) > 1:
                    heapq.heappush(heap, (-len(both), (a, b)))
                continue
            new = self.nodes
            self.pairs.append((a, b))
            holders[a] -= both
            holders[b] -= both
            holders[new] = both
            partners: Counter[int] = Counter()
            for place in both:
                nodes = self.item_nodes[place]
                nodes -= {a, b}
                partners.update(n for n in nodes if len(holders[n]) > 1)
                nodes.add(new)
            for other, together in partners.items():
                if together > 1:
                    heapq.heappush(heap, (-together, (other, new)))

    def arrays(self) -> tuple:
        """Leaves per term, and nodes per item, each as one flat list with offsets."""
        return (*_flat(self.term_leaves), *_flat([sorted(nodes) for nodes in self.item_nodes]))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([0] + [len(entry) for entry in lists])
    return np.array([n for entry in lists for n in entry], np.int64), ends


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items in blocks whose terms and pairs of terms are bounded; items without terms are left out."""
    block, terms, pairs = [], 0, 0
    for row in items.select(F.col(id_col).cast("bigint"), text_col).toLocalIterator():
        found = split_terms(row[1])
        if not found:
            continue
        distinct = len(set(found))
        if block and (terms + len(found) > BLOCK_TERMS or pairs + distinct**2 > BLOCK_PAIRS):
            yield block
            block, terms, pairs = [], 0, 0
        block.append((row[0], found))
        terms, pairs = terms + len(found), pairs + distinct**2
    if block:
        yield block


def _count(slices: Iterable[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    known = vocabulary.get
    for batch in slices:
        ids, lengths, terms, counts, ends = [], [], [], [], [0]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = split_terms(text)
            if not found:
                continue
            held = Counter(n for n in map(known, found) if n is not None)
            ids.append(doc_id)
            lengths.append(len(found))
            terms.extend(held)
            counts.extend(held.values())
            ends.append(len(terms))
        ends = pa.array(ends, pa.int32())
        columns = [
            pa.array(ids, pa.int64()),
            pa.array(lengths, pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
            pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _score(slices: Iterable[pa.RecordBatch], plan: SharingPlan, weights: np.ndarray, corpus: tuple[int, int], k: int):
    """Fill the nodes for some documents, sum them up for the items, keep the best ``k`` of each item."""
    term_leaves, leaf_ends, item_nodes, item_ends = plan.arrays()
    documents, tokens = corpus
    best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [_nothing() for _ in plan.item_ids]
    step = max(1, CELLS // max(1, plan.nodes))
    for batch in slices:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            rows = part.num_rows
            terms, counts = part.column("terms").flatten(), part.column("counts").flatten().to_numpy().astype(np.int64)
            terms = terms.to_numpy()
            row = np.repeat(np.arange(rows), part.column("terms").value_lengths().to_numpy())
            length = 75 + 25 * part.column("n").to_numpy() * documents // tokens
            gain = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 12 * length[row]))
            copies = leaf_ends[terms + 1] - leaf_ends[terms]
            first = np.repeat(leaf_ends[terms] - np.cumsum(copies) + copies, copies)
            leaf = term_leaves[first + np.arange(len(first))]
            sums = np.zeros((plan.nodes, rows), np.int64)
            np.add.at(sums, (leaf, np.repeat(row, copies)), np.repeat(gain, copies))
            for place, (a, b) in enumerate(plan.pairs):
                np.add(sums[a], sums[b], out=sums[plan.leaves + place])
            ids = part.column("doc_id")
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for item in range(len(best)):
                score = sums[item_nodes[item_ends[item] : item_ends[item + 1]]].sum(axis=0)
                least = best[item][0][-1] if len(best[item][0]) == k else 1
                hit = np.flatnonzero(score >= max(1, least))
                if len(hit):
                    best[item] = _best(best[item], (score[hit], missing[hit], ids[hit]), k)
    for item, (score, missing, ids) in enumerate(best):
        if len(score):
            size = len(score)
            columns = [
                pa.array([item] * size, pa.int32()),
                pa.array([plan.item_ids[item]] * size, pa.int64()),
                pa.array(ids, pa.int64(), mask=missing),
                pa.array(score, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "doc_id", "score"])


def _nothing() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)


def _best(one: tuple, two: tuple, k: int) -> tuple:
    score, missing, ids = (np.concatenate(pair) for pair in zip(one, two, strict=True))
    order = np.lexsort((ids, missing, -score))[:k]
    return score[order], missing[order], ids[order]


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every item with a score above 0.

    Equal scores rank by ascending identifier, null identifiers last. Null and empty
    texts have no term: such items get no row, such documents no place. Every row of
    ``items`` is an item of its own and every row of ``docs`` a document, also where
    identifiers repeat or are null. Other columns are not read.

    Items are taken in blocks (``BLOCK_TERMS`` terms, ``BLOCK_PAIRS`` pairs, or one item);
    each block reads the texts once and writes its terms' counts to the shared folder.
    """
    texts = id_and_text(docs, id_col, text_col)
    results, corpus = [], None
    for block in _blocks(items, item_col, item_text_col):
        plan = SharingPlan(block)
        counted = stored(map_rows(texts, _count, COUNTS, plan.vocabulary), "term-counts")
        if corpus is None:
            corpus = tuple(counted.agg(F.count("*"), F.sum("n")).first())
        # at most one row per term of the block
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(plan.vocabulary), np.int64)
        for term, holding in held:
            weights[term] = term_weight(corpus[0], holding)
        hits = map_rows(counted, _score, HITS, plan, weights, corpus, k)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        top = top_per_group(hits, ["item"], order, k)
        results.append(top.select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    if not results:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, results)
