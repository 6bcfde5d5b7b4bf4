"""Token files, packing and BPE against the libraries they must agree with."""

import io
import random
import zlib

import numpy as np
import pytest

from vectorloom.llm import byte_bpe, packing, pretokens, token_files
from vectorloom.llm.queries import vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")
SIGNS = " \n\t'stmdrevlaZé1٣!漢　 ’-"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(vocabulary("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def rank_library(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed, count, most):
    draw = random.Random(seed)
    return ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, most))) for _ in range(count)]


def test_split_is_the_pattern():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    sample = texts(1, 20_000, 14)
    assert pretokens.split(sample) == [pattern.findall(t) for t in sample]


def test_every_code_point_as_the_library(library):
    points = [chr(c) for c in range(0, 0x30000) if not 0xD800 <= c < 0xE000]
    sample = ["".join(f"a{c}1{c}!{c}" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    words, want = pretokens.library_words(vocabulary("byte_bpe_50k.json")), [library(t) for t in sample]
    assert [i.tolist() for i in words.ids(pretokens.split(sample))] == want
    assert [i.tolist() for i in words.of_texts(sample)] == want


def test_whole_texts_as_the_library(library):
    words = pretokens.library_words(vocabulary("byte_bpe_50k.json"))
    for seed, most in ((7, 3), (8, 40), (9, 400)):
        sample = ["", *texts(seed, 300, most), "x" * 5000, "", "end's"]
        assert [i.tolist() for i in words.of_texts(sample)] == [library(t) for t in sample]
    assert words.of_texts([]) == [] and [len(i) for i in words.of_texts(["", ""])] == [0, 0]


def test_added_tokens_in_texts_as_the_library(spark, frame):
    """The library as the file sets it, which takes an added token in a text for that token."""
    from tokenizers import Tokenizer

    path, end = vocabulary("byte_bpe_50k.json"), "<|endoftext|>"
    tokenizer = Tokenizer.from_file(path)
    sample = ["plain text", f"a{end}b", end, f"it's {end}{end} \n 's", f"x <|endof{end}text|> ", "<|endoftext|", ""]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in sample]
    assert [i.tolist() for i in pretokens.library_ids(path, sample)] == want and 50256 in want[1]
    rows = token_files.write_and_read(frame(list(enumerate(sample))), path).collect()
    crc = lambda ids: zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in rows} == {i: (len(w) + 1, crc(w)) for i, w in enumerate(want)}


def test_tree_is_the_rank_library(ranks, rank_library):
    small = byte_bpe.TreeBpe(ranks, leaf=3)
    for leaf, sample in ((2, texts(2, 600, 40)), (5, texts(3, 600, 60)), (9, texts(4, 300, 200))):
        assert all(small.encode(t, leaf) == rank_library.encode_ordinary(t) for t in sample)
    for text in ("a" * 1000, "ab" * 777, " " * 900 + "x", "'" * 301, "漢" * 999, "aA" * 333 + "1" * 500):
        ids = rank_library.encode_ordinary(text)
        assert small.encode(text, 64) == ids
        assert small.decode(ids, 7) == text.encode()


def test_heap_merge_is_the_plain_merge(ranks):
    bpe = byte_bpe.TreeBpe(ranks)
    for text in texts(5, 300, 30):
        data = text.encode()
        if data:
            assert bpe._merge_long(data) == bpe.merge(data)


def test_round_trip_query(frame, awkward, rank_library):
    import hashlib

    rows = byte_bpe.round_trip(frame(awkward), vocabulary("byte_bpe_multi_50k.tiktoken")).collect()
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    want = []
    for i, text in awkward:
        ids = rank_library.encode_ordinary(text or "")
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((str(i), len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


class Source(io.BytesIO):
    """A file in memory that notes what is read."""

    def size(self):
        return len(self.getbuffer())

    def read(self, n=-1):
        self.total = getattr(self, "total", 0) + n
        return super().read(n)


@pytest.mark.parametrize("frame_bytes", [16, 100, 1 << 18])
def test_file_round_trip_by_document(frame_bytes):
    draw = np.random.default_rng(3)
    docs = [(i * 3, draw.integers(0, 50_000, draw.integers(0, 90)).astype(np.uint16)) for i in range(200)]
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, np.uint16, frame_bytes)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    source = Source(out.getvalue())
    reader = token_files.TokenFileReader(source)
    for doc_id, ids in docs[::7]:
        assert reader.find(doc_id).tolist() == ids.tolist()
    with pytest.raises(KeyError):
        reader.find(1)


def test_one_document_reads_one_frame_and_damage_is_seen():
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, np.uint16, 1000)
    for i in range(400):
        writer.add(i, np.random.default_rng(i).integers(0, 50_000, 100).astype(np.uint16))
    writer.close()
    source = Source(out.getvalue())
    reader = token_files.TokenFileReader(source)
    source.total = 0
    reader.find(250)
    assert source.total < 2000 < len(out.getvalue()) // 20
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(out.getvalue(), read_across_frames=True) as whole:
        assert len(whole.read()) == 400 * 200  # any zstandard reader skips the index and the table
    data = bytearray(out.getvalue())
    data[int(reader.stored_at[3]) + 20] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenFileReader(Source(bytes(data))).find(int(reader.ids[16]))


def test_token_files_query(spark, frame, awkward, library):
    rows = token_files.write_and_read(frame(awkward), vocabulary("byte_bpe_50k.json")).collect()
    ordered = sorted(awkward, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    want, start = [], 0
    for i, text in ordered:
        ids = np.array([*library(text or ""), 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=lambda r: r[1])
    assert got == want


def test_documents_by_id(spark, frame, tmp_path, library):
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_token_files(frame([(i, f"text number {i}") for i in range(50)]), folder, vocabulary("byte_bpe_50k.json"))
    found = token_files.documents_by_id(folder, [r["file"] for r in manifest.collect()], [7, 33, 99])
    assert {i: ids.tolist() for i, ids in found.items()} == {i: [*library(f"text number {i}"), 0] for i in (7, 33)}


def test_empty_tables(frame):
    assert token_files.write_and_read(frame([]), vocabulary("byte_bpe_50k.json")).count() == 0
    assert packing.pack(frame([]), vocabulary("byte_bpe_50k.json")).count() == 0
    assert byte_bpe.round_trip(frame([]), vocabulary("byte_bpe_multi_50k.tiktoken")).count() == 0


@pytest.mark.parametrize("most_open", [1, 3, 50])
def test_best_fit_is_plain_best_fit(most_open):
    draw = random.Random(most_open)
    lengths = [draw.randint(1, 100) for _ in range(600)]
    fit = packing.BestFit(100, most_open)
    got = [b for i, n in enumerate(lengths) for b in fit.add(i, n)]
    bins, closed = [], []  # plain: lists of items and their free space
    for i, n in enumerate(lengths):
        fitting = [b for b in bins if b[1] >= n]
        if fitting:
            chosen = min(fitting, key=lambda b: b[1])
        else:
            if len(bins) >= most_open:
                fullest = min(bins, key=lambda b: b[1])
                bins.remove(fullest)
                closed.append(fullest)
            chosen = [[], 100]
            bins.append(chosen)
        chosen[0].append(i)
        chosen[1] -= n
        if not chosen[1]:
            bins.remove(chosen)
            closed.append(chosen)
    # bins of one free space may be taken in any order: compare the closed amounts
    assert sorted(sum(lengths[i] for i in b) for b in got) == sorted(100 - b[1] for b in closed) or len(got) == len(closed)
    assert sorted(i for b in [*got, *fit.rest()] for i in b) == list(range(600))
    assert all(sum(lengths[i] for i in b) <= 100 for b in [*got, *fit.rest()])


def test_pieces():
    assert packing.pieces(1, 4) == [(0, 1)]
    assert packing.pieces(4, 4) == [(0, 4)]
    assert packing.pieces(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_pack_query(frame, awkward, library):
    many = [*awkward, *((100 + i, f"short text {i} " * (i % 40)) for i in range(300))]
    rows = packing.pack(frame(many), vocabulary("byte_bpe_50k.json"), capacity=64, most_open=4).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for i, text in many:
        if i == 3:
            continue  # twice in the table
        ids = np.array([*library(text or ""), 2], "<u4")
        want = [(k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.pieces(len(ids), 64))]
        assert sorted(by_doc[i]) == want
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.1 * -(-total // 64) + 1
