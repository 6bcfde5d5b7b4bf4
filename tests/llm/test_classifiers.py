"""Kernel, machine and prior against plain versions; held-out accuracy of both classifiers."""

import itertools
import pickle
import random

import numpy as np
import pyarrow as pa
import pytest

from vectorloom.llm import common, quality, toxicity


def plain_kernel(one, other, decay, order):
    total = 0.0
    for a in itertools.combinations(range(len(one)), order):
        for b in itertools.combinations(range(len(other)), order):
            if all(one[i] == other[j] for i, j in zip(a, b)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_is_the_sum_over_subsequences():
    draw = random.Random(1)
    words = ["".join(draw.choice("abc") for _ in range(5)) for _ in range(12)]
    partner = "abcab"
    rows, column = toxicity.codes(words), toxicity.codes([partner]).T
    got = toxicity.kernel(rows, column, 0.6)
    marked = [f"^{w}$" for w in words]
    want = [plain_kernel(w, f"^{partner}$", 0.6, toxicity.ORDER) for w in marked]
    assert np.allclose(got, want, rtol=1e-4)
    own = toxicity.kernel(rows, np.ascontiguousarray(rows.T), 0.6)
    assert np.allclose(own, [plain_kernel(w, w, 0.6, toxicity.ORDER) for w in marked], rtol=1e-4)


def test_kernel_over_shared_prefixes_is_the_same():
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 9))) for _ in range(400)})
    prefixes = toxicity.Prefixes(words)
    assert sum(len(letters) for letters, _ in prefixes.levels) < sum(len(w) + 2 for w in words)
    for partner in ("abcab", "zzz", "é", "bad"):
        column = toxicity.codes([partner]).T
        want = [float(toxicity.kernel(toxicity.codes([w]), column, 0.6)[0]) for w in words]
        assert np.allclose(toxicity.prefix_kernel(prefixes, column, 0.6), want, rtol=1e-5, atol=1e-9)


def test_kernel_over_halves_is_the_same():
    """Heads and tails are walked once each, and words take products of them; own kernels go by the pattern of letters."""
    draw = random.Random(6)
    words = list({"".join(draw.choice("abcé") for _ in range(draw.randint(3, 8))) for _ in range(1500)}) + ["abc" * 8, "zzz", "日本語文"]
    halves = toxicity.Halves(words)
    assert len(halves.heads.ends) + len(halves.tails.ends) < len(words)
    for partner in ("abcab", "zzz", "é", "abcdeabcde"):
        column = toxicity.codes([partner]).T
        want = [float(toxicity.kernel(toxicity.codes([w]), column, 0.6)[0]) for w in words]
        assert np.allclose(halves.kernel(column, 0.6), want, rtol=1e-5, atol=1e-9)
    want = [float(toxicity.kernel(toxicity.codes([w]), toxicity.codes([w]).T, 0.6)[0]) ** 0.5 for w in words]
    assert np.allclose(toxicity.Kernel(["abc"], 0.6)._lengths(words), want, rtol=1e-5)


def test_words_are_read_as_units_are(monkeypatch):
    """Margins from words that are looked at once are those of a text's units, whatever parts the words."""
    draw = random.Random(9)
    some = ["a", "b.", "-", "", "é", "9", "s", "t", "idiot", "id-iot", "Idiot!", "of", "...", "ßİΣ", "\t", "\u2003 x", "loser" * 9]
    texts = [" ".join(draw.choice([*some, "x" * draw.randint(1, 60)]) for _ in range(draw.randint(0, 12))) for _ in range(600)]
    model = toxicity.ToxicityModel(toxicity.Kernel(["insult"], 0.6), np.ones(1), -0.5, np.zeros(2), 0.0)
    monkeypatch.setattr(toxicity.ToxicityModel, "margins", lambda self, words: np.array([len(set(w)) % 5 - 2.5 for w in words]))
    tops, above = model.found(texts)
    bags = [set(toxicity.units(t)) for t in texts]
    margin = lambda unit: len(set(unit)) % 5 - 2.5
    assert tops.tolist() == [max(map(margin, bag), default=-np.inf) for bag in bags]
    assert above == [{u for u in bag if margin(u) > 0} for bag in bags]
    assert model.found([])[1] == [] and model.found([""])[0].tolist() == [-np.inf]


def test_a_task_leaves_no_margins(monkeypatch):
    """Texts are looked at in small slices, and a worker that waits for its next task keeps no margins."""
    texts = [f"some words {i} idiot" for i in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts, "toxic": [0] * 60})
    model = toxicity.ToxicityModel(toxicity.Kernel(["idiot"], 0.6), np.ones(1), -0.5, np.ones(2), 0.0)
    want, seen = model.scores(texts), []
    read = toxicity.ToxicityModel.found
    monkeypatch.setattr(toxicity, "PART_BYTES", 500)
    monkeypatch.setattr(toxicity.ToxicityModel, "found", lambda self, texts: seen.append(len(texts)) or read(self, texts))
    got = np.concatenate([b.column("score").to_numpy() for b in toxicity._score(iter([batch]), model)])
    assert np.allclose(got, want) and len(seen) > 3 and sum(seen) == 60
    assert not common.worker_cache(toxicity.__name__)
    for step in (toxicity._worst, toxicity._mistaken):
        list(step(iter([batch]), model))
        assert not common.worker_cache(toxicity.__name__)


def test_normalised_values():
    kernel = toxicity.Kernel(["insult", "word"], 0.6)
    values = kernel.values(["insult", "in", "insxult", "word"])
    assert values[0, 0] == pytest.approx(1) and values[3, 1] == pytest.approx(1)
    assert not values[1].any() and 0.05 < values[2, 0] < 1 and values[0, 1] < 0.05


def test_units():
    assert toxicity.units("You are s t u p i d, re-ally!") == ["you", "are", "stupid", "really"]
    assert toxicity.units("") == [] and toxicity.units("a b") == []
    long = toxicity.units("x" * 45)
    assert all(len(u) <= toxicity.UNIT for u in long) and len(long) == 4


def corpus(seed, n):
    draw = random.Random(seed)
    syllables = "an re the or in st ed ou".split()
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 3)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(draw.randint(10, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(draw.randint(1, 3)):
                words.insert(draw.randrange(len(words)), draw.choice(["flumbag", "grizzot", "mopwit"]))
        junk = i % 5 == 1
        text = " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words) + "."
        rows.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def labelled():
    return corpus(2, 1200)


def test_toxicity_held_out(spark, frame, labelled):
    rows, labels = labelled
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = frame([*rows, (9000, None), (9001, ""), (9002, "flumbag " + "the " * 20_000), (None, "the flumbag")])
    model = toxicity.learned(docs, table)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    truth = {i: t for i, _, t in labels}
    right = sum((scores[i] >= 0.7) == bool(t) for i, t in truth.items()) / len(truth)
    assert right > 0.97
    assert scores[9000] == scores[9001] < 0.7 <= scores[9002] and scores[None] >= 0.7
    tries = ["the flumbbag or", "the f l u m b a g or", "the grizz-ot or", "the or in"]
    assert (model.scores(tries) >= 0.5).tolist() == [True, True, True, False]
    kept = toxicity.keep_civil(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s < 0.7}


def test_one_insult_sentence_is_learned(spark, frame):
    """The insult always follows the same word; what surrounds the sentence differs."""
    rows, labels = corpus(7, 600)
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("bdklprstvaeiou") for _ in range(6))
    plain = lambda: " ".join(word() for _ in range(20)) + "."
    rows = [(i, f"{plain()} You utter flumbag. {plain()}" if toxic else plain()) for i, _, toxic in labels]
    model = toxicity.learned(frame(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    scores = model.scores([t for _, t in rows])
    assert ((scores >= 0.7) == [bool(t) for _, _, t in labels]).mean() > 0.97


def test_copies_count_as_one_document():
    hashes = toxicity._Hashes()
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    groups = {toxicity._group(words[:k] + words[k + 1 :], hashes) for k in range(0, 400, 8)}
    assert len(groups) <= 3
    others = {toxicity._group(draw.sample(words, 60), hashes) for _ in range(50)}
    assert len(others) == 50


def test_units_are_counted_once_a_group(spark):
    """Counts agree with plain sets, and a slice gives a row per document, not one per unit."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 4)))
    rows = [(" ".join(word() for _ in range(draw.randint(0, 40))), draw.randint(0, 1)) for _ in range(120)]
    rows += [rows[0]] * 30 + [(rows[1][0], 1 - rows[1][1])] + [("a b", 0), ("", 1)]
    hashes, want = toxicity._Hashes(), set()
    for text, toxic in rows:
        if own := toxicity.units(text):
            want |= {(unit, toxic, toxicity._group(own, hashes)) for unit in own if len(unit) >= toxicity.LETTERS}
    plain = {}
    for unit, toxic, _ in want:
        plain.setdefault(unit, [0, 0])[1 - toxic] += 1
    texts = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    got = toxicity.unit_counts(texts).collect()
    assert {r["unit"]: [r["a"], r["b"]] for r in got} == plain and len(got) == len(plain)
    batch = pa.RecordBatch.from_pylist([{"text": t, "toxic": x} for t, x in rows])
    assert sum(b.num_rows for b in toxicity._documents(iter([batch]))) <= len(rows)


def test_a_worker_computes_a_unit_once(monkeypatch):
    """Tasks of one model share margins, copies of the model too; what is kept is bounded and common units stay."""
    computed, other = [], common.worker_cache("other")
    monkeypatch.setattr(toxicity.ToxicityModel, "margins", lambda self, words: computed.extend(words) or np.ones(len(words)))
    model = toxicity.ToxicityModel(toxicity.Kernel(["insult"], 0.6), np.ones(1), -1.0, np.zeros(2), 0.0)
    for _ in range(2):
        pickle.loads(pickle.dumps(model)).worst(["one two", "two three"])
    assert sorted(computed) == ["one", "three", "two"]
    toxicity.ToxicityModel(model.kernel, 2 * model.weights, -1.0, np.zeros(2), 0.0).worst(["one"])
    assert len(computed) == 4 and len(common.worker_cache(toxicity.__name__)) == 1
    kept = toxicity._Margins(10)
    for i in range(100):
        found = kept.of({"common", f"rare{i}"}, lambda words: computed.extend(words) or np.ones(len(words)))
        assert found["common"] == found[f"rare{i}"] == 1 and len(kept.young) + len(kept.old) <= 24
    assert computed.count("common") == 1 and other is common.worker_cache("other")


def test_only_labelled_texts_move(spark, frame):
    """The join does not turn into another one as labels grow, and texts without a label stay behind."""
    docs = frame([(i, f"text {i}") for i in range(300)] + [(None, "none"), (7, "again")])
    labels = spark.createDataFrame([(7, 0, 1), (8, 0, 0), (8, 0, 0), (9, 0, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    found = toxicity.labelled_texts(docs, labels)
    assert sorted(map(tuple, found.collect())) == [("again", 1), ("text 7", 1), ("text 8", 0), ("text 8", 0)]
    plan = found._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "bitmap_construct_agg" in plan


def test_nothing_to_learn(spark, frame):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = frame([(1, "a b c"), (2, None)])
    assert {r["score"] for r in toxicity.score(docs, toxicity.learned(docs, none)).collect()} == {toxicity.sigmoid(np.array(-40.0)).item()}
    assert {r["score"] for r in quality.score_documents(docs, none).collect()} == {0.5}
    assert toxicity.score_documents(frame([]), none).count() == 0
    assert quality.score_documents(frame([]), none).count() == 0


def test_quality_held_out(spark, frame, labelled):
    rows, labels = labelled
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = frame([*rows, (9000, None), (9001, ""), (None, "the or in")])
    got = quality.score_documents(docs, table).collect()
    assert len(got) == len(rows) + 3
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert held and sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[9000] == scores[9001]


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.85])
def test_prior_is_estimated(prior):
    draw = np.random.default_rng(3)
    positive = draw.normal(2, 1, 6000)
    mixed = np.where(draw.random(6000) < prior, draw.normal(2, 1, 6000), draw.normal(-2, 1, 6000))
    assert abs(quality.estimate_prior(positive, mixed, 1.0) - prior) < 0.06


def test_slopes_of_the_scorer():
    """A step lowers the loss it is given the slope of."""
    draw = np.random.default_rng(4)
    rows = draw.normal(0, 1, (200, 6)).astype(np.float32)
    signs = np.sign(rows[:, 0] * rows[:, 1])
    scorer = quality.Scorer(6, 16, 1)
    scorer.standard(rows)
    loss = lambda: np.logaddexp(0, -signs * scorer.margin(rows)).mean()
    before = loss()
    for _ in range(400):
        scorer.step(rows, -signs * quality.sigmoid(-signs * scorer.margin(rows)) / len(rows), 0.01, 0)
    assert loss() < 0.3 * before
