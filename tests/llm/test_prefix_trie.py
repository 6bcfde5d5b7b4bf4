"""Prefix trie of conversations against a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from vectorloom.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, conv string, weight int, top_conv int"


@pytest.fixture
def conversations(spark):
    """Conversations from (conv_id, turn, role, text), with more columns whose names the operator uses inside."""

    def make(rows):
        return spark.createDataFrame([(*row, 1, "x", 2, 3) for row in rows], SCHEMA)

    return make


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [turn[1:] for turn in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        origin = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt = own.get(origin, [])[:h] + own[c][h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        below = [totals[child] for child in children[node]]
        totals[node] = (sum(n for n, _ in below) if below else 1, saved + sum(s for _, s in below))
    return sorted(
        (
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children[node]), *totals[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def built(frame, **settings):
    return sorted(tuple(row) for row in prefix_trie.build(frame, **settings).collect())


def sample(seed=3, convs=60):
    pick = random.Random(seed)
    rows = []
    for c in [*range(convs), 107, 115, -3, -104, 1200]:
        turns = [("user", pick.choice("ab") * pick.randint(1, 3)) for _ in range(pick.randint(1, 8))]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    return rows


def test_matches_plain_version_at_every_component_size(conversations):
    rows = sample() + [(77, t, "user", f"deep {t}") for t in range(40)]
    expected = plain_trie(rows)
    assert built(conversations(rows)) == expected
    assert built(conversations(rows), most=40) == expected


def test_nulls_ties_repeats_and_long_texts(conversations):
    long = "é😀 " * 40_000
    rows = [
        (5, None, None, None), (5, 0, "b", "x"), (5, 0, "a", "x"), (5, 0, "a", "x"), (5, None, "a", ""), (None, 1, "a", "x"),
        (7, 3, "user", long), (8, 3, "user", long), (7, 4, "", long), (101, 1, "user", "only"), (0, 2, "user", long),
        *[(c, t, "user", "same") for c in range(300, 340) for t in range(4)],
    ]
    assert built(conversations(rows)) == plain_trie(rows)


def test_empty_table_has_no_root(conversations):
    assert built(conversations([])) == []


def test_turnless_conversation_is_a_member_of_the_root(conversations):
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)
    assert built(conversations([(turnless, 0, "user", "x")])) == plain_trie([(turnless, 0, "user", "x")])


@pytest.mark.parametrize("seed", range(5))
def test_settle_sums_random_trees(seed):
    pick = random.Random(seed)
    size = 200
    parents = [0] + [pick.randrange(max(0, n - (3 if seed % 2 else n)), n) for n in range(1, size)]
    depth = [0] * size
    for n in range(1, size):
        depth[n] = depth[parents[n]] + 1
    order = sorted(range(size), key=lambda n: depth[n])
    place = {n: at for at, n in enumerate(order)}
    parents = [place[parents[n]] for n in order]
    values = [(pick.randint(0, 9), 1) for _ in range(size)]
    expected = [list(v) for v in values]
    for n in range(size - 1, 0, -1):
        expected[parents[n]] = [a + b for a, b in zip(expected[parents[n]], expected[n])]
    weights = [total for _, total in expected]
    assert prefix_trie.settle(parents, weights, values) == [tuple(v) for v in expected]


def test_a_third_of_all_turns_in_one_conversation(conversations, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 7)
    rows = sample(4, 12) + [(50, t, "user", f"turn {t % 3}") for t in range(60)]
    assert built(conversations(rows), most=100) == plain_trie(rows)
