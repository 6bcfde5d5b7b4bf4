"""Elias-Fano sequences and the bigram model against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorloom.llm import ngram_lm
from vectorloom.llm.elias_fano import EliasFano


@pytest.mark.parametrize(("count", "last"), [(0, 9), (1, 1), (1, 2**63), (7, 10), (3000, 50), (1000, 2**64 - 1), (20_000, 2**40)])
def test_elias_fano_finds_what_searchsorted_finds(count, last):
    pick = np.random.default_rng(count)
    values = np.sort(pick.integers(0, last, count, dtype=np.uint64, endpoint=True))
    sequence = EliasFano(EliasFano.pack(values))
    assert (sequence.get(np.arange(count)) == values).all()
    others = pick.integers(0, last, 300, dtype=np.uint64, endpoint=True)
    wanted = np.concatenate([values, others, values[values > 0] - np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    assert (sequence.successor(wanted) == np.searchsorted(values, wanted)).all()


def test_elias_fano_is_smaller_than_its_numbers():
    values = np.sort(np.random.default_rng(1).integers(0, 2**40, 100_000, dtype=np.uint64))
    assert len(EliasFano.pack(values)) < 0.55 * values.nbytes


def test_packets_come_back():
    columns = [np.sort(np.array([9, 2**64 - 1, 9, 0], np.uint64)), np.array([1, 2, 3, 2**40], np.uint64), np.zeros(4, np.uint64)]
    assert all((a == b).all() for a, b in zip(ngram_lm.unpack(ngram_lm.pack(columns), 3), columns, strict=True))


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def quantised(p):
    return -min(round(-math.log10(p) * ngram_lm.STEP), 65535) / ngram_lm.STEP


class PlainModel:
    def __init__(self, texts, hot_share):
        self.pairs, self.counts = Counter(), Counter()
        for text in texts:
            words = words_of(text)
            self.counts.update(words)
            self.pairs.update(zip([None, *words], words, strict=False))
        self.total, self.size = sum(self.counts.values()), sum(self.counts.values()) + len(self.counts) + 1
        hot = {w for w, n in self.counts.items() if n * hot_share >= self.total} | {None}
        kinds = Counter(self.pairs.values())
        n = [max(1, kinds[k]) for k in range(1, 5)]
        share = n[0] / (n[0] + 2 * n[1])
        self.discounts = [min(max(k - (k + 1) * share * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]
        left, seen = defaultdict(float), defaultdict(float)
        for (v, w), c in self.pairs.items():
            left[v] += self.discounts[min(c, 3) - 1]
            seen[v] += (self.counts[w] + 1) / self.size if w in hot else 0
        self.weights = {v: quantised(min(left[v] / self.counts[v] / max(1 - seen[v], 1e-6), 1)) for v in left}

    def unigram(self, w):
        return math.log10((self.counts[w] + 1) / self.size)

    def bigram(self, v, w):
        c = self.pairs[v, w]
        if c:
            return quantised((c - self.discounts[min(c, 3) - 1]) / self.counts[v])
        return self.weights.get(v, 0) + self.unigram(w)

    def figures(self, text):
        words = words_of(text)
        known = sum(self.counts[w] > 0 for w in words)
        score = sum(self.bigram(v, w) for v, w in zip([None, *words], words, strict=False))
        return len(words), known, self.total, sum(map(self.unigram, words)), score


def check(rows, plain, texts):
    assert len(rows) == len(texts)
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    ours = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows), key=key)
    theirs = [(i, *plain.figures(t)) for i, t in texts]
    theirs = sorted(((i, n, k, total, round(b, 6), round(s, 6)) for i, n, k, total, b, s in theirs), key=key)
    for mine, other in zip(ours, theirs, strict=True):
        assert mine[:4] == other[:4]
        assert mine[4:] == pytest.approx(other[4:], abs=2e-3)


def corpus(size=300, seed=2):
    pick = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    shares = [1 / (n + 1) for n in range(400)]
    return [(i, " ".join(pick.choices(vocabulary, shares, k=pick.randint(0, 60))) + (f" Rare{i}" if i % 3 else "")) for i in range(size)]


@pytest.mark.parametrize(("shard_tokens", "hot_share"), [(1 << 21, 1 << 14), (500, 30), (300, 1)])
def test_scores_match_a_plain_model(spark, frame, shard_tokens, hot_share):
    texts = corpus()
    docs = frame(texts)
    train = F.col("doc_id") % 4 != 0
    model = ngram_lm.fit(docs.where(train), shard_tokens=shard_tokens, hot_share=hot_share)
    plain = PlainModel([t for i, t in texts if i % 4], hot_share)
    assert (model.shards > 1) == (shard_tokens < 1000)
    assert model.discounts == pytest.approx(plain.discounts)
    check(ngram_lm.score(docs, ngram_lm.Model.load(model.folder)).collect(), plain, texts)


def test_documents_over_several_blocks(frame, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BLOCK_BITS", 4)  # seen by this process: the packets' numbering is checked here
    starts = [(f, n, ngram_lm._block_starts(f, n)) for f in (0, 5, 16, 31, 32) for n in (1, 11, 16, 40)]
    for first, size, found in starts:
        assert found == sorted({0, *[n - first for n in range(first, first + size) if n % 16 == 0]})


def test_many_documents_of_one_slice(frame):
    texts = [(i, f"w{i % 7} w{i % 3}") for i in range(20_000)]
    model = ngram_lm.fit(frame(texts))
    check(ngram_lm.score(frame(texts).coalesce(1), model).collect(), PlainModel([t for _, t in texts], ngram_lm.HOT_SHARE), texts)


def test_probabilities_of_all_next_words_stay_below_one():
    texts = [t for _, t in corpus()]
    plain = PlainModel(texts, 30)
    for context in [None, "w0", "w1", "w17", "rare4"]:
        total = sum(10 ** plain.bigram(context, w) for w in plain.counts) + 10 ** plain.bigram(context, "never seen")
        assert 0.5 < total < 1.001


def test_awkward_rows_and_the_query_form(frame, awkward):
    rows = ngram_lm.score_documents(frame(awkward)).collect()
    held = {i for i, _ in awkward if i is not None and zlib.crc32(str(i).encode()) % 7 == 2}
    assert {r.doc_id for r in rows if r.held_out} == held
    check(rows, PlainModel([t for i, t in awkward if i not in held], ngram_lm.HOT_SHARE), awkward)


def test_empty_tables(frame):
    model = ngram_lm.fit(frame([]))
    assert ngram_lm.score(frame([]), model).collect() == []
    row = ngram_lm.score(frame([(1, "a b")]), model).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0, 0)


def test_one_bigram_in_a_third_of_all_tokens(frame):
    texts = [(i, "the " * 50) for i in range(40)] + corpus(40)
    model = ngram_lm.fit(frame(texts), shard_tokens=400)
    check(ngram_lm.score(frame(texts), model).collect(), PlainModel([t for _, t in texts], ngram_lm.HOT_SHARE), texts)
