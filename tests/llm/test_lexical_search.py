"""Ranked lexical search and the sharing plan against plain versions."""

import math
import random
import re
from collections import Counter

import pytest

from vectorloom.llm import lexical_search
from vectorloom.llm.lexical_search import SharingPlan, rank_documents, split_terms


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_ranks(docs, items, k):
    terms = [(i, Counter(plain_terms(t)), len(plain_terms(t))) for i, t in docs]
    terms = [d for d in terms if d[2]]
    documents, tokens = len(terms), sum(n for _, _, n in terms)
    holding = Counter(t for _, counts, _ in terms for t in counts)
    rows = []
    for item, text in items:
        scored = []
        for doc, counts, n in terms:
            m = 75 + (25 * n * documents) // tokens
            score = 0
            for term, times in Counter(plain_terms(text)).items():
                if tf := counts[term]:
                    weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[term] + 1)))
                    score += times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        rows += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(rows, key=repr)


def corpus(seed=1, docs=120, items=25):
    pick = random.Random(seed)
    words = [f"w{n}" for n in range(60)]
    shares = [1 / (n + 1) for n in range(60)]
    make = lambda most: " ".join(pick.choices(words, shares, k=pick.randint(1, most)))
    return [(i, make(40)) for i in range(docs)], [(i, make(25)) for i in range(items)]


def ranked(frame, docs, items, **settings):
    rows = rank_documents(frame(docs), frame(items), item_col="doc_id", **settings).collect()
    return sorted((tuple(row) for row in rows), key=repr)


def test_terms():
    text = "Ab_9 ÄB-c d\x7fe [x]{y}`z 漢字1"
    assert [t.decode() for t in split_terms(text)] == plain_terms(text)
    assert split_terms(None) == split_terms(" -\t") == []


def test_plan_covers_every_item_and_shares_its_nodes():
    _, items = corpus()
    plan = SharingPlan([(i, split_terms(t)) for i, t in items])
    leaves = [Counter() for _ in range(plan.leaves)]
    for term, number in plan.vocabulary.items():
        for leaf in plan.term_leaves[number]:
            leaves[leaf][term] += 1
    nodes = leaves
    for a, b in plan.pairs:
        nodes = [*nodes, nodes[a] + nodes[b]]
    for (_, text), own in zip(items, plan.item_nodes, strict=True):
        assert sum((nodes[n] for n in own), Counter()) == Counter(split_terms(text))
    # additions with shared nodes against one per term of every item
    assert len(plan.pairs) + sum(map(len, plan.item_nodes)) < sum(len(set(split_terms(t))) for _, t in items)
    for one in range(len(items)):  # no two items share a pair any more
        assert all(len(plan.item_nodes[one] & plan.item_nodes[other]) < 2 for other in range(one))


@pytest.mark.parametrize("k", [1, 20])
def test_ranks_match_plain_version(frame, k):
    docs, items = corpus()
    assert ranked(frame, docs, items, k=k) == plain_ranks(docs, items, k)


def test_blocks_of_items_give_the_same(frame, monkeypatch):
    docs, items = corpus(seed=5)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 80)
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    assert ranked(frame, docs, items) == plain_ranks(docs, items, 20)


def test_awkward_rows(frame, awkward):
    items = [(1, None), (2, ""), (3, "one two text"), (3, "TEXT the end 漢字"), (None, "identifier same w5x5"), (6, "absent"), (7, "w1x1 " * 50)]
    docs = [*awkward, *[(20, "one two")] * 3, (19, "two one"), *[(i, "text " * 3) for i in range(30, 60)]]
    assert ranked(frame, docs, items) == plain_ranks(docs, items, 20)


def test_empty_tables(frame):
    docs, items = corpus()
    assert ranked(frame, [], items) == ranked(frame, docs, []) == ranked(frame, [(1, None)], items) == []
