"""Vector functions, search, approximate search, statistics and ranking, against NumPy."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vectorloom.functions import vectors as V
from vectorloom.operators import ann as N
from vectorloom.operators import embed as E
from vectorloom.operators import hybrid as H
from vectorloom.operators import passes as P
from vectorloom.operators import search as S
from vectorloom.operators import stats as A

RNG = np.random.default_rng(5)
POINTS = RNG.standard_normal((400, 12)).astype(np.float32)
QUERIES = RNG.standard_normal((9, 12)).astype(np.float32)


def frame(spark, matrix, key="bibcode", prefix="b", extra=()):
    rows = [(f"{prefix}{i:04d}", [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame([*rows, *extra], f"{key} string, embedding array<float>").repartition(5)


def unit(matrix):
    matrix = matrix.astype(np.float64)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def nearest(points, queries, k):
    scores = np.round(unit(points) @ unit(queries).T, V.SCORE_DECIMALS)
    out = []
    for q in range(len(queries)):
        order = sorted(range(len(points)), key=lambda i: (-scores[i, q], i))[:k]
        out += [(f"q{q:04d}", r + 1, f"b{i:04d}") for r, i in enumerate(order)]
    return out


def hits(found):
    return sorted((r["query_id"], r["rank"], r["bibcode"]) for r in found.collect())


def test_vector_functions(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0]), ([1.0], [1.0, 0.0]), ([], [])]
    data = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = data.select(V.norm("a").alias("n"), V.unit("a").alias("u"), V.cosine("a", "b").alias("c")).collect()
    assert got[0]["n"] == 5.0 and got[0]["u"] == [0.6, 0.8] and got[0]["c"] == pytest.approx(0.96)
    assert (got[1]["n"], got[1]["u"], got[1]["c"]) == (0.0, None, None)
    assert [tuple(r) for r in got[2:]] == [(None, None, None), (1.0, [1.0], None), (None, None, None)]


def test_half_precision_matches_numpy(spark):
    values = [0.1, -2.5e-8, 65504.0, 1e-5, 0.33333, -1.0009766]
    got = spark.createDataFrame([(values,)], "v array<float>").select(V.half_precision("v").alias("h")).first()["h"]
    assert got == [float(x) for x in np.array(values, np.float32).astype(np.float16).astype(np.float32)]


def test_statistics(spark):
    data = frame(spark, POINTS)
    rows = {r["bibcode"]: r for r in A.vector_stats(data).collect()}
    exact = POINTS.astype(np.float64)
    for i in (0, 7, 399):
        row = rows[f"b{i:04d}"]
        expected = (12, np.linalg.norm(exact[i]), exact[i].mean(), exact[i].std())
        assert (row["dim"], row["norm"], row["mean"], row["std"]) == pytest.approx(expected)
    whole = A.corpus_vector_stats(data).first()
    assert whole["vectors"] == 400 and whole["component_std"] == pytest.approx(exact.std())
    assert whole["mean_norm"] == pytest.approx(np.linalg.norm(exact, axis=1).mean())


def test_topk_and_fewer_rows_than_k(spark):
    extra = [("zero", [0.0] * 12), ("none", None), ("short", [1.0])]
    found = S.topk(frame(spark, POINTS, extra=extra), [float(x) for x in QUERIES[0]], 15).collect()
    assert [("q0000", r["rank"], r["bibcode"]) for r in found] == nearest(POINTS, QUERIES[:1], 15)
    few = S.topk(frame(spark, POINTS[:3], extra=extra), [float(x) for x in QUERIES[0]], 10)
    assert few.count() == 3
    far = S.topk(frame(spark, POINTS), [float(x) for x in QUERIES[0]], 5, metric="l2").collect()
    cosine = {r["bibcode"]: r["score"] for r in found}
    assert [r["bibcode"] for r in far] == [r["bibcode"] for r in found][:5]
    for row in far:
        assert row["score"] ** 2 == pytest.approx(2 - 2 * cosine[row["bibcode"]], abs=1e-6)


@pytest.mark.parametrize("passes", [False, True])
def test_knn_join_against_brute_force(spark, passes):
    corpus = frame(spark, POINTS, extra=[("zero", [0.0] * 12), ("none", None)])
    found = S.knn_join(corpus, frame(spark, QUERIES, "query_id", "q"), 7, force_passes=passes)
    assert hits(found) == sorted(nearest(POINTS, QUERIES, 7))


def test_knn_join_in_several_passes_moves_no_corpus(spark, monkeypatch):
    corpus = frame(spark, POINTS)
    queries = frame(spark, QUERIES, "query_id", "q", [("empty", []), ("none", None), ("zero", [0.0] * 12)])
    tables = [t.num_rows for t in P.query_passes(queries, "query_id", 2, 1 << 20)]
    assert sum(tables) == 10 and max(tables) <= 2
    found = P.nearest_by_passes(corpus, queries, 6, "bibcode", "query_id", pass_queries=2)
    assert hits(found) == sorted(nearest(POINTS, QUERIES, 6))
    blocks = P.blocks_by_length(np.array(["a"], object), pa.array([[1.0] * 12]))
    schema = P.hit_schema(corpus, queries, "bibcode", "query_id")
    plan = P.nearest_in_place(frame(spark, POINTS).coalesce(2), blocks, 3, "bibcode", "query_id", schema)
    assert "Generate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_passes_merge_the_hits_of_a_repeated_query_key(spark):
    corpus = frame(spark, POINTS)
    both = [("q", [float(x) for x in row]) for row in QUERIES[:2]]
    asked = spark.createDataFrame(both, "query_id string, embedding array<float>").repartition(2)
    found = P.nearest_by_passes(corpus, asked, 5, "bibcode", "query_id", pass_queries=1).collect()
    scores = np.round(unit(POINTS) @ unit(QUERIES[:2]).T, V.SCORE_DECIMALS).ravel()
    assert [r["score"] for r in sorted(found, key=lambda r: r["rank"])] == pytest.approx(sorted(scores)[::-1][:5])


def test_knn_join_switches_when_queries_do_not_fit(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_QUERIES", 4)
    queries = frame(spark, QUERIES, "query_id", "q")
    assert S.read_queries(queries, "query_id") is None
    assert hits(S.knn_join(frame(spark, POINTS), queries, 3)) == sorted(nearest(POINTS, QUERIES, 3))


@pytest.mark.parametrize("passes", [False, True])
def test_many_equal_vectors_rank_by_id(spark, passes):
    """A third of all rows is the same vector: ties go to the lower id, none is lost."""
    points = POINTS[:300].copy()
    points[::3] = QUERIES[0]
    found = S.knn_join(frame(spark, points), frame(spark, QUERIES[:2], "query_id", "q"), 20, force_passes=passes)
    assert hits(found) == sorted(nearest(points, QUERIES[:2], 20))


def test_no_queries_and_no_corpus(spark):
    empty = frame(spark, POINTS).where("1 = 0")
    queries = frame(spark, QUERIES, "query_id", "q")
    assert S.knn_join(empty, queries, 3).count() == 0
    assert S.knn_join(frame(spark, POINTS), queries.where("1 = 0"), 3).count() == 0


def test_similarity_matrix_in_one_and_in_many_blocks(spark, monkeypatch):
    points = POINTS[:40]
    expected = unit(points) @ unit(points).T
    whole = {r["bibcode"]: r for r in S.similarity_matrix(frame(spark, points)).collect()}
    assert len(whole) == 40
    for i in range(40):
        row = whole[f"b{i:04d}"]
        assert row["columns"] == [f"b{j:04d}" for j in range(40)]
        assert row["cosines"] == pytest.approx(list(expected[i]), abs=1e-6)
    monkeypatch.setattr(S, "BLOCK_QUERIES", 16)
    seen = {}
    for row in S.similarity_matrix(frame(spark, points), columns_per_block=16).collect():
        for column, cosine in zip(row["columns"], row["cosines"]):
            seen[row["bibcode"], column] = cosine
    assert len(seen) == 1600
    assert all(seen[f"b{i:04d}", f"b{j:04d}"] == pytest.approx(expected[i, j], abs=1e-6) for i in range(40) for j in range(40))


@pytest.mark.parametrize("per_block", [64, 3])
def test_similarity_matrix_has_one_form(spark, per_block):
    """Null, empty and zero vectors are columns at every size; vectors meet those of their length."""
    given = [[1.0, 0.0], [1.0, 1.0], [1.0, 2.0, 2.0], None, [], [0.0, 0.0], [2.0, 1.0, 2.0], [0.0, 3.0]]
    table = spark.createDataFrame([(f"b{i}", v) for i, v in enumerate(given)], "bibcode string, embedding array<float>")
    seen, places = {}, set()
    for row in S.similarity_matrix(table, columns_per_block=per_block).collect():
        assert row["columns"] == sorted(row["columns"]) and (row["bibcode"], row["block"]) not in places
        places.add((row["bibcode"], row["block"]))
        seen |= {(row["bibcode"], c): x for c, x in zip(row["columns"], row["cosines"], strict=True)}
    assert len(seen) == 64
    for i, one in enumerate(given):
        for j, other in enumerate(given):
            if one and other and len(one) == len(other) and any(one) and any(other):
                want = np.dot(one, other) / np.linalg.norm(one) / np.linalg.norm(other)
                assert seen[f"b{i}", f"b{j}"] == pytest.approx(want, abs=1e-6)
            else:
                assert seen[f"b{i}", f"b{j}"] is None


def clustered(count=1200, dim=12, groups=8):
    centres = RNG.standard_normal((groups, dim)) * 3
    return (centres[np.arange(count) % groups] + 0.3 * RNG.standard_normal((count, dim))).astype(np.float32)


@pytest.mark.parametrize("kind", ["centroids", "planes"])
def test_approximate_search(spark, kind, tmp_path):
    both = clustered(1220)  # queries come from the same clusters as the corpus
    points, queries = both[20:], both[:20]
    corpus = frame(spark, points)
    asked = frame(spark, queries, "query_id", "q")
    quantizer = N.Centroids.fit(corpus, 8, seed=2) if kind == "centroids" else N.Hyperplanes(12, 4, seed=2)
    N.write_index(N.assign_cells(corpus, quantizer), str(tmp_path / "index"))
    index = N.read_index(spark, str(tmp_path / "index"))
    assert index.count() == len(points)
    exact = S.knn_join(corpus, asked, 10)
    found = N.approximate_knn(index, quantizer, asked, 10, probes=4)
    assert N.recall(found, exact).first()["recall"] >= 0.8
    everything = N.approximate_knn(index, quantizer, asked, 10, probes=16)
    assert hits(everything) == hits(exact)
    few = N.approximate_knn(index, quantizer, asked.limit(1), 10, probes=1)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cell#" in plan


def test_nearest_flips_are_those_of_a_full_listing():
    for seed, bits in ((1, 1), (2, 5), (3, 12)):
        margins = np.random.default_rng(seed).random(bits)
        masks = np.arange(1 << bits)
        cost = (((masks[:, None] >> np.arange(bits)) & 1) * margins).sum(axis=1)
        count = min(200, 1 << bits)
        assert N.nearest_flips(margins, count) == masks[np.argsort(cost, kind="stable")][:count].tolist()
        assert sorted(N.nearest_flips(margins, 1 << bits)) == masks.tolist()


def test_twenty_planes(spark):
    planes = N.Hyperplanes(12, 20, seed=2)
    assert planes.probes(QUERIES.astype(float), 50).shape == (9, 50)
    corpus = frame(spark, np.concatenate([POINTS, QUERIES]))
    filed = N.assign_cells(corpus, planes)
    assert filed.schema["cell"].dataType.simpleString() == "bigint"
    found = N.approximate_knn(filed, planes, frame(spark, QUERIES, "query_id", "q"), 1, probes=3).collect()
    assert {(r["query_id"], r["bibcode"]) for r in found} == {(f"q{i:04d}", f"b{400 + i:04d}") for i in range(9)}


@pytest.mark.parametrize("kind", ["centroids", "planes"])
def test_routed_queries_give_the_same_and_read_only_their_cells(spark, kind, tmp_path):
    both = clustered(640)
    corpus = frame(spark, both[40:], extra=[(f"b{n:04d}", [float(x) for x in both[40]]) for n in range(700, 750)])
    asked = frame(spark, both[:40], "query_id", "q", [("empty", []), ("short", [1.0])])
    quantizer = N.Centroids.fit(corpus, 8, seed=2) if kind == "centroids" else N.Hyperplanes(12, 4, seed=2)
    N.write_index(N.assign_cells(corpus, quantizer), str(tmp_path / "index"))
    filed = N.read_index(spark, str(tmp_path / "index"))
    fitting = frame(spark, both[:40], "query_id", "q")
    within = hits(N.approximate_knn(filed, quantizer, fitting, 10, probes=2))
    assert hits(N.approximate_knn(filed, quantizer, asked, 10, probes=2, force_routes=True)) == within
    # hot cells and many queries in parts
    chosen = lambda matrix: quantizer.probes(matrix, 2)
    parted = P.nearest_in_cells(filed, asked, chosen, 12, 10, "bibcode", "query_id", part_rows=16, part_queries=3)
    assert hits(parted) == within
    one = P.nearest_in_cells(filed, fitting.limit(1), lambda m: quantizer.probes(m, 1), 12, 3, "bibcode", "query_id")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan


def test_probes_hold_beyond_one_block(spark, monkeypatch):
    """More queries than fit a block give the rows that blocks of them give."""
    both = clustered(640)
    corpus, asked = frame(spark, both[40:]), frame(spark, both[:40], "query_id", "q")
    quantizer = N.Hyperplanes(12, 4, seed=2)
    filed = N.assign_cells(corpus, quantizer)
    within = hits(N.approximate_knn(filed, quantizer, asked, 10, probes=1))
    monkeypatch.setattr(S, "BLOCK_QUERIES", 7)
    assert hits(N.approximate_knn(filed, quantizer, asked, 10, probes=1)) == within
    assert within != hits(S.knn_join(corpus, asked, 10))


def test_queries_of_several_lengths(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 1.0, 0.0])]
    corpus = spark.createDataFrame(rows, "bibcode string, embedding array<float>")
    asked = spark.createDataFrame(rows, "query_id string, embedding array<float>")
    found = S.knn_join(corpus, asked, 1).select("query_id", "bibcode").collect()
    assert sorted(map(tuple, found)) == [("a", "a"), ("b", "b")]


def test_pca_is_centred(spark):
    data = frame(spark, POINTS + 5)
    rows = A.pca_projection(data).collect()
    exact = POINTS.astype(np.float64) - POINTS.astype(np.float64).mean(axis=0)
    singular = np.linalg.svd(exact, compute_uv=False)
    assert rows[0]["explained_variance"] == pytest.approx((singular[:2] ** 2).sum() / (singular**2).sum(), abs=1e-6)
    first = np.array([r["pc1"] for r in rows])
    assert abs(first.mean()) < 1e-6 and (first**2).sum() == pytest.approx(singular[0] ** 2, rel=1e-4)


# ---------------------------------------------------------------- keyword and hybrid

DOCS = [
    ("d1", "Exoplanet transit", "the exoplanet transit of a small star"),
    ("d2", "Dark matter", "dark matter halo, dark energy, and the dark sky"),
    ("d3", "Mixed", "exoplanet in the dark"),
    ("d4", "", ""),
    ("d5", "Nothing", "unrelated words only"),
]


def bm25(docs, terms, at):
    import math
    import re

    split = [[w for w in re.split(r"[\W_]+", d[at].lower()) if w] for d in docs]
    mean = sum(map(len, split)) / len(split)
    out = []
    for words in split:
        score = 0.0
        for term in terms:
            df = sum(term in w for w in split)
            tf = words.count(term)
            idf = math.log(1 + (len(split) - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
        out.append(score)
    return out


def test_bm25_against_the_formula(spark):
    docs = spark.createDataFrame(DOCS, "bibcode string, title string, text string")
    expected = bm25(DOCS, ["dark", "exoplanet"], 2)
    got = {r["bibcode"]: r["score"] for r in H.with_bm25(docs, "Dark exoplanet, DARK!", out="score").collect()}
    assert [got[d[0]] for d in DOCS] == pytest.approx(expected, abs=1e-8)
    top = H.bm25_topk(docs, "dark exoplanet", 10).collect()
    order = sorted(range(len(DOCS)), key=lambda i: -expected[i])[:3]
    assert [(r["rank"], r["bibcode"]) for r in top] == [(n + 1, DOCS[i][0]) for n, i in enumerate(order)]
    assert H.bm25_topk(docs, "", 10).count() == 0
    both = {r["bibcode"]: r["score"] for r in H.with_bm25(docs, "dark", ["title", "text"], "score").collect()}
    assert [both[d[0]] for d in DOCS] == pytest.approx([a + b for a, b in zip(bm25(DOCS, ["dark"], 1), bm25(DOCS, ["dark"], 2))])


def test_hybrid_weights(spark):
    vectors = {"d1": [1.0, 0.0], "d2": [0.0, 1.0], "d3": [0.7, 0.7], "d5": [-1.0, 0.0]}
    data = [(*d, vectors.get(d[0])) for d in DOCS]
    docs = spark.createDataFrame(data, "bibcode string, title string, text string, embedding array<float>")
    rows = H.hybrid_topk(docs, "dark", {"embedding": [1.0, 0.0]}, (1.4, 0.6), 10).collect()
    by_id = {r["bibcode"]: r for r in rows}
    assert by_id["d1"]["semantic"] == 2.0 and by_id["d1"]["score"] == pytest.approx(1.4)
    assert by_id["d2"]["semantic"] == pytest.approx(1.0) and by_id["d2"]["keyword"] > 0
    assert set(by_id) == {"d1", "d2", "d3"}
    assert H.normalise_weights(0, 0) == (0, 0) and H.weight_label(0.5, 0.5) == "balanced"
    swept = H.weight_sweep(docs, "dark", {"embedding": [1.0, 0.0]}, k=2).collect()
    assert {r["kind"] for r in swept} == {"semantic", "keyword", "balanced"} and len(swept) == 6


def test_models_with_different_dimensions(spark):
    texts = spark.createDataFrame([("a", "one two"), ("b", "three")], "bibcode string, text string")
    models = ["hash://8", "hash://16"]
    embedded = E.embed_with_models(texts, models)
    pairs = A.model_pair_similarity(embedded, models).collect()
    assert len(pairs) == 2 and all(r["cosine"] is None for r in pairs)
    same = A.model_pair_similarity(embedded.unionByName(embedded.where("model = 'hash://8'").withColumn("model", F.lit("copy"))), ["hash://8", "copy"])
    assert [r["cosine"] for r in same.collect()] == pytest.approx([1.0, 1.0])
    assert {r["model"]: r["dim"] for r in A.model_summary(embedded).collect()} == {"8": 8, "16": 16}


def plain_comparison(rows, models):
    """Per pair of models the texts with a cosine and its mean: over all pairs of vectors of a key, then over keys."""
    units = {}
    for key, model, vector in rows:
        values = np.array([np.nan if x is None else x for x in vector or []], dtype=np.float64)
        if key is not None and np.isfinite(np.linalg.norm(values)) and values.any():
            units.setdefault((key, model), []).append(values / np.linalg.norm(values))
    keys = sorted({key for key, _ in units})
    out = {}
    for i, one in enumerate(models):
        for two in models[i + 1 :]:
            both = [[a @ b for a in units.get((k, one), []) for b in units.get((k, two), []) if len(a) == len(b)] for k in keys]
            means = [np.mean(cosines) for cosines in both if cosines]
            out[one.split("/")[-1], two.split("/")[-1]] = (len(means), np.mean(means) if means else None)
    return out


@pytest.mark.parametrize("batch", [1, 2, 7, 10_000])
def test_model_comparison_pairs_every_text(spark, batch):
    rng = np.random.default_rng(batch)
    models = ["a://x/one", "b://two", "b://y/three", "c://y/wide"]
    rows = []
    for model in reversed(models):
        for key in range(40):
            dims = [4, 8] if model == "b://two" and key % 5 == 0 else [8 if model == "c://y/wide" else 4]
            copies = 3 if key % 7 == 0 else 1
            rows += [(f"t{key}", model, rng.normal(size=dim).tolist()) for dim in dims for _ in range(copies)]
    rows = [r for r in rows if not (r[1] == "b://two" and r[0] in ("t1", "t2"))]
    rows += [("hot", m, rng.normal(size=4).tolist()) for m in models for _ in range(30)]
    rows += [(None, m, [1.0, 2.0, 3.0, 4.0]) for m in models]
    odd = [None, [], [0.0] * 4, [float("nan"), 1.0, 1.0, 1.0], [float("inf"), 1.0, 1.0, 1.0], [None, 1.0, 1.0, 1.0]]
    rows += [(key, m, vector) for m in models[:3] for key in ("t3", "only odd") for vector in odd]
    rows += [("t4", "not asked", [1.0, 2.0, 3.0, 4.0])]
    embedded = spark.createDataFrame(rows, "bibcode string, model string, embedding array<double>")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = A.model_comparison(embedded, [*models, "gone://away"]).collect()
        single = sorted(A.model_summary(embedded).drop("mean_norm", "mean_component", "mean_std").collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    expected = plain_comparison(rows, models)
    pairs = {(r["model"], r["other_model"]): r for r in got if r["other_model"] is not None}
    assert set(pairs) == set(expected) and len(got) == len(expected) + 5
    for pair, (texts, mean) in expected.items():
        assert pairs[pair]["texts"] == texts and pairs[pair]["mean_cosine"] == pytest.approx(mean)
        assert pairs[pair]["dim"] is None and pairs[pair]["mean_norm"] is None
    assert sorted((r["model"], r["texts"], r["dim"]) for r in got if r["other_model"] is None) == [tuple(r) for r in single]


def test_model_comparison_keeps_models_of_one_short_name(spark):
    rows = [("t", "a://x/m", [1.0, 0.0]), ("t", "b://y/m", [1.0, 1.0]), ("u", "b://y/m", [0.0, 3.0])]
    embedded = spark.createDataFrame(rows, "bibcode string, model string, embedding array<float>")
    summary = sorted((r["texts"], r["model"], round(r["mean_norm"], 3)) for r in A.model_summary(embedded).collect())
    assert summary == [(1, "m", 1.0), (2, "m", 2.207)]
    pair = A.model_comparison(embedded, ["a://x/m", "b://y/m"]).where("other_model IS NOT NULL").collect()
    assert [(r["model"], r["other_model"], r["texts"], round(r["mean_cosine"], 6)) for r in pair] == [("m", "m", 1, 0.707107)]
    alone = A.model_comparison(embedded, ["a://x/m"]).collect()
    assert len(alone) == 2 and all(r["other_model"] is None for r in alone)
    assert A.model_comparison(embedded.limit(0), ["a://x/m", "b://y/m"]).count() == 0


def test_model_compare_query_has_the_pairs(spark, tmp_path):
    from vectorloom.plans.queries_vectors import model_compare

    texts = {1: "dark matter halo", 2: "two stars", 3: "a planet", 4: "no vector of this"}
    docs = [(k, "en", "s", t) for k, t in texts.items()]
    spark.createDataFrame(docs, "doc_id bigint, lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stored = {k: np.sin(np.arange(64) * k + 1).astype(np.float32) for k in (1, 2, 3, 9)}
    rows = [(k, 0, v.tolist()) for k, v in stored.items()]
    spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r["model"], r["other_model"]): r for r in model_compare(spark, str(tmp_path)).collect()}
    assert {k: r["texts"] for k, r in got.items()} == {
        ("64", None): 4, ("32", None): 4, ("embeddings", None): 4,
        ("64", "32"): 0, ("64", "embeddings"): 3, ("32", "embeddings"): 0,
    }
    cosines = [np.dot(E.embed_one(texts[k], "hash://64"), stored[k]) / np.linalg.norm(stored[k]) for k in (1, 2, 3)]
    assert got["64", "embeddings"]["mean_cosine"] == pytest.approx(np.mean(cosines), abs=2e-6)
    assert got["64", "32"]["mean_cosine"] is None and got["32", "embeddings"]["mean_cosine"] is None
