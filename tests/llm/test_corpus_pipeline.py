"""The pipeline's rows against the same stages done plainly on the driver."""

import zlib
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from test_documents import plain_components, plain_copies
from vectorloom.llm import packing, secret_scan, toxicity
from vectorloom.llm.common import documents
from vectorloom.llm.queries import vocabulary

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test data")


def test_run(spark):
    from tokenizers import Tokenizer

    docs = documents(spark, FOLDER)
    model = toxicity.learned(docs, documents(spark, FOLDER, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = model.scores([t or "" for _, t in rows])
    rows = [r for r, s in zip(rows, scores) if s < 0.7]
    kept = {keep for _, keep, _, _ in plain_copies(rows)}
    rows = [r for r in rows if r[0] in kept]
    component = plain_components(rows)
    rows = [r for r in rows if component[r[0]][1] == r[0]]
    scan = secret_scan.EntropyScan(secret_scan.EntropySettings())
    rows = [(i, secret_scan.mask(t or "", scan, "[secret]")) for i, t in rows]
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        for k, (start, n) in enumerate(packing.pieces(len(ids), 1024)):
            want.append((i, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))

    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    filled = {}
    for r in got:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert max(filled.values()) <= 1024


def test_stages_keep_the_columns(spark, frame, awkward):
    docs = frame(awkward)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        empty = stage(spark, frame([]), FOLDER)
        assert empty.columns == docs.columns and empty.count() == 0, name
