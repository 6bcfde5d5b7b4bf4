"""What Arrow functions of Python workers hold on to."""

import pickle

import pyarrow as pa
import pytest
from pyspark.serializers import CloudPickleSerializer

from vectorloom.functions import batches
from vectorloom.llm import byte_bpe, common, packing, pretokens, token_files, toxicity


def test_free_memory_goes_back_after_the_last_batch(monkeypatch):
    given = []
    monkeypatch.setattr(batches, "_trim", lambda: given.append)
    rows = [pa.record_batch({"a": [i]}) for i in range(3)]
    out = batches.released(iter(rows))
    assert next(out) is rows[0] and not given
    assert list(out) == rows[1:] and given == [0]

    def failing():
        yield rows[0]
        raise ValueError("text")

    with pytest.raises(ValueError, match="text"):
        list(batches.released(failing()))
    assert given == [0, 0]


def test_a_vocabulary_is_loaded_once(monkeypatch):
    import public_tokenizers
    import tokenizers

    loaded = []

    class Tokenizer:
        @staticmethod
        def from_file(path):
            loaded.append(path)
            return own(path)

    own = tokenizers.Tokenizer.from_file
    monkeypatch.setattr(tokenizers, "Tokenizer", Tokenizer)
    path = public_tokenizers.path("byte_bpe_50k.json")
    pretokens.library_words.cache_clear()
    pretokens._added.cache_clear()
    assert len(pretokens.library_ids(path, ["some text", "more"])) == 2 and loaded == [path]


def test_a_task_of_another_module_drops_vocabularies(spark, monkeypatch):
    """A worker keeps a vocabulary for the tasks of one module; the shipped function does so where it runs."""
    import public_tokenizers

    class Frame:
        sparkSession = spark

        def mapInArrow(self, run, schema):
            return pickle.loads(CloudPickleSerializer().dumps(run))

    given = []
    monkeypatch.setattr(batches, "_trim", lambda: given.append)
    packed = common.map_rows(Frame(), packing._pack_again, "", 1, 8, 2)
    scored = common.map_rows(Frame(), toxicity._documents, "")
    for caches in (pretokens.library_words, pretokens._added, byte_bpe._coder):
        caches.cache_clear()
    assert not list(packed(iter([])))
    pretokens.library_ids(public_tokenizers.path("byte_bpe_50k.json"), ["some text"])
    byte_bpe._coder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = common.worker_cache(packing.__name__)
    assert not list(packed(iter([])))
    held = [c.cache_info().currsize for c in (pretokens.library_words, pretokens._added, byte_bpe._coder)]
    assert held == [1, 1, 1] and own is common.worker_cache(packing.__name__)
    before = len(given)
    assert not list(scored(iter([]))) and len(given) == before + 2
    held = [c.cache_info().currsize for c in (pretokens.library_words, pretokens._added, byte_bpe._coder)]
    assert held == [0, 0, 0] and own is not common.worker_cache(packing.__name__)


def test_texts_are_encoded_a_megabyte_at_a_time(monkeypatch):
    batch = pa.record_batch({"doc_id": list(range(400)), "text": ["some words " * 1000] * 400})
    seen = []
    monkeypatch.setattr(token_files, "library_ids", lambda path, texts: seen.append(sum(map(len, texts))) or [])
    list(token_files.encoded(iter([batch]), "a vocabulary"))
    assert max(seen) <= 1 << 20 and sum(seen) == 400 * 11_000
