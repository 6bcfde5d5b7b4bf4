"""Bigram language model in Elias-Fano tries, fitted and queried with one shuffle each.

Tokens are words with A-Z lower-cased and one end per text; the end before a text is the
context of its first token, so every token of a text is a context once. Words are told
apart by 64 bits (their hash; words that make up at least ``1 / HOT_SHARE`` of all tokens
have a short code instead, held in a table of at most that many rows that all tasks get).

A shard has all bigrams of some contexts, the bigrams of coded contexts being dealt over
all shards. Its file has two levels: sorted contexts with their counts (as cumulative
sums) and quantised backoff weights, and for each context the sorted next words, made one
rising sequence by the context's place, with quantised probabilities. Pointers from the
first level to the second are a rising sequence too. A bigram is found by the successor
of (place of context, word).

Probabilities are discounted by count (three discounts from the counts of counts); what
they leave over goes to the unigram with one added to every count, less the share of
coded words already seen behind the context. Sums stay below one: that share leaves out
rarer words.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, stored
from vectorloom.llm.elias_fano import EliasFano
from vectorloom.session import shared_folder, ship_package

U64 = np.uint64
HOT_SHARE = 1 << 14
SHARD_TOKENS = 1 << 21
TASK_SHARDS = 2
SLICE_BYTES = 4 << 20
SLICE_ROWS = 1 << 16
BATCH_BYTES = 8 << 20  # between Spark and Python
BLOCK_BITS = 14  # documents summed up together
EVENTS = 1 << 18  # bigrams looked up at once
WORD_BITS = 40  # of a word behind its context: its upper bits
CONTEXT_BITS = 64 - WORD_BITS  # contexts of a shard stay below 2**24
STEP = 4096  # probabilities are kept as -log10 in steps of 1 / STEP
DISCOUNTS = 3

PACKET = "shard int, turn int, row bigint, payload binary"
# packets of three kinds: documents of a block, sums for a block, words whose unigram is asked for
SCORED = "kind int, shard int, turn int, row bigint, payload binary"
DOCUMENTS, SUMS, ASKED = range(3)
FIGURES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
COUNTED = (
    "shard int, payload binary, n1 bigint, n2 bigint, n3 bigint, n4 bigint, "
    "hot array<struct<place:int,s1:bigint,s2:bigint,s3:bigint,seen:bigint>>"
)


# ---- words ---------------------------------------------------------------------------


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Arrow batches joined or cut to about ``SLICE_BYTES`` of text."""
    held, size, rows = [], 0, 0
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size, rows = size + part.nbytes, rows + part.num_rows
            if size >= SLICE_BYTES or rows + step >= SLICE_ROWS:
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def tokens(texts: pa.Array, codes: Codes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of some texts in order, the place of each token's word there, and its text.

    Words are hashes, frequent ones ``codes``; each text is closed by the end (word 0).
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    rows = len(texts)
    words = lists.flatten()
    text = np.repeat(np.arange(rows, dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    filled = pc.not_equal(words, "")
    text = text[filled.to_numpy(zero_copy_only=False)]
    coded = words.filter(filled).dictionary_encode()
    top = 1 << 63
    hashes = (top | xxhash.xxh64_intdigest(word) for word in coded.dictionary.cast(pa.binary()).to_pylist())
    keys = np.concatenate([np.zeros(1, U64), np.fromiter(hashes, U64, len(coded.dictionary))])
    if codes is not None:
        keys = codes.apply(keys)
    order = np.argsort(keys, kind="stable")
    place = np.empty(len(keys), np.int32)
    place[order] = np.arange(len(keys), dtype=np.int32)
    out = np.full(len(text) + rows, place[0], np.int32)
    out[np.arange(len(text)) + text] = place[coded.indices.to_numpy() + 1]
    lengths = np.bincount(text, minlength=rows) + 1
    return keys[order], out, np.repeat(np.arange(rows, dtype=np.int32), lengths)


def _bigrams(place: np.ndarray, end: int) -> np.ndarray:
    """Context and word of every token in one number that sorts like the two; the end comes before a text."""
    context = np.concatenate([[end], place[:-1]]).astype(np.int64)
    return context << 32 | place


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> U64(31))) * U64(0x7FB5D329728EA185)
    values = (values ^ (values >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return values ^ (values >> U64(33))


def _upper(words: np.ndarray) -> np.ndarray:
    return words >> U64(64 - WORD_BITS)


@dataclass
class Codes:
    """Short codes of frequent words: code ``i`` stands for the word ``keys[i]``; 0 is the end."""

    keys: np.ndarray  # sorted
    counts: np.ndarray

    def apply(self, words: np.ndarray) -> np.ndarray:
        """Words with frequent ones replaced by ``code << 24``; hashes have their top bit set."""
        place = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        return np.where(self.keys[place] == words, place.astype(U64) << U64(64 - WORD_BITS), words)

    def hot(self, words: np.ndarray) -> np.ndarray:
        return words >> U64(63) == 0

    def place(self, words: np.ndarray) -> np.ndarray:
        return _upper(words).astype(np.int64)


def _shard_of(contexts: np.ndarray, words: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """By context; coded contexts by context and word."""
    key = _upper(contexts)
    key = np.where(hot, key ^ (_upper(words) << U64(20)), key)
    return (_mix(key) % U64(shards)).astype(np.int32)


# ---- packets: sorted columns as byte planes -------------------------------------------


def _planes(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes, at: int, count: int, width: int) -> tuple[np.ndarray, int]:
    out = np.zeros((count, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, count * width, at).reshape(width, count).T
    return out.reshape(-1).view("<u8").astype(U64), at + count * width


def _width(values: np.ndarray) -> int:
    return (int(values.max()).bit_length() + 7) // 8 if len(values) else 0


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of whole numbers, the first sorted (kept as runs), in one compressed piece."""
    first, *rest = columns
    starts = _starts(first)
    runs = np.diff(np.append(starts, len(first)))
    parts = [first[starts], runs, *rest]
    widths = [_width(p) for p in parts]
    head = np.array([len(first), len(starts), *widths], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(map(_planes, parts, widths)))


def unpack(payload: bytes, columns: int) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    rows, distinct, *widths = np.frombuffer(data, "<u4", 3 + columns).tolist()
    at, parts = 4 * (3 + columns), []
    for number, width in enumerate(widths):
        part, at = _from_planes(data, at, distinct if number < 2 else rows, width)
        parts.append(part)
    return [np.repeat(parts[0], parts[1].astype(np.int64)), *parts[2:]]


def _packets(shard: np.ndarray, columns: list[np.ndarray], turn: int, row: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the columns, as one packet per shard."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    starts = _starts(shard)
    ends = np.append(starts[1:], len(shard))
    payloads = [pack([c[order[a:b]] for c in columns]) for a, b in zip(starts, ends, strict=True)]
    yield _packet_batch(shard[starts], turn, row, payloads)


def _packet_batch(shards, turn: int, row: int, payloads: list[bytes]) -> pa.RecordBatch:
    size = len(payloads)
    columns = [
        pa.array(shards, pa.int32()), pa.array([turn] * size, pa.int32()),
        pa.array([row] * size, pa.int64()), pa.array(payloads, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "turn", "row", "payload"])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the rows of sorted columns change."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


# ---- fitting ----------------------------------------------------------------------------


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _gathered(batches):
        keys, place, _ = tokens(_one(table, "text"))
        count = np.bincount(place, minlength=len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(count)], ["word", "n"])


def _one(table: pa.Table, column: str) -> pa.Array:
    return pa.concat_arrays(table.column(column).chunks)


def _bigram_packets(batches: Iterable[pa.RecordBatch], codes: Codes, shards: int) -> Iterator[pa.RecordBatch]:
    for table in _gathered(batches):
        keys, place, _ = tokens(_one(table, "text"), codes)
        pairs = np.sort(_bigrams(place, int(np.searchsorted(keys, 0))))
        starts = _starts(pairs)
        context, word = keys[pairs[starts] >> 32], keys[pairs[starts] & 0xFFFFFFFF]
        shard = _shard_of(context, word, codes.hot(context), shards)
        yield from _packets(shard, [context, _upper(word), np.diff(np.append(starts, len(pairs))).astype(U64)], 0, 0)


def _merge_counts(batches: Iterable[pa.RecordBatch], codes: Codes) -> Iterator[pa.RecordBatch]:
    """All packets of a shard as one, with counts of counts and the shard's part of coded contexts."""
    for shard, parts in _by_shard(batches):
        columns = [np.concatenate([p[k] for p in parts]) for k in range(3)]
        parts.clear()
        order = np.lexsort((columns[1], columns[0]))
        context, word, count = (c[order] for c in columns)
        starts = _starts(context, word)
        context, word, count = context[starts], word[starts], np.add.reduceat(count, starts)
        seen = np.bincount(np.minimum(count, U64(5)).astype(np.int64), minlength=6)[1:5]
        hot = codes.hot(context)
        place = codes.place(context[hot])
        sums = _context_sums(place, word[hot], count[hot], len(codes.keys), codes)
        present = np.flatnonzero(sums[0] + sums[1] + sums[2])
        rows = [{"place": int(p), "s1": int(a), "s2": int(b), "s3": int(c), "seen": int(d)}
                for p, a, b, c, d in zip(present, *(s[present] for s in sums), strict=True)]
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "payload": pack([context, word, count]), "hot": rows}
             | {f"n{k + 1}": int(n) for k, n in enumerate(seen)}],
            pa.schema([("shard", pa.int32()), ("payload", pa.binary()), *[(f"n{k}", pa.int64()) for k in range(1, 5)],
                       ("hot", pa.list_(pa.struct([("place", pa.int32()), *[(c, pa.int64()) for c in ("s1", "s2", "s3", "seen")]])))]),
        )


def _context_sums(place, word, count, size: int, codes: Codes) -> list[np.ndarray]:
    """Per context: next words seen once, twice, more often; and count plus one of coded words among them."""
    classes = [place[count == 1], place[count == 2], place[count > 2]]
    out = [np.bincount(p, minlength=size) for p in classes]
    coded = word >> U64(WORD_BITS - 1) == 0
    seen = np.zeros(size, np.int64)
    np.add.at(seen, place[coded], codes.counts[word[coded].astype(np.int64)] + 1)
    return [*out, seen]


def _by_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """The columns of packets sorted by shard, one shard at a time."""
    held, shard = [], None
    for batch in batches:
        for s, payload in zip(batch.column("shard").to_pylist(), batch.column("payload"), strict=True):
            if s != shard and held:
                yield shard, held
                held = []
            shard = s
            held.append(unpack(payload.as_buffer(), 3))
    if held:
        yield shard, held


@dataclass
class Model:
    """A fitted model: figures of the whole corpus, coded contexts, and a folder with a file per shard."""

    folder: str
    shards: int
    tokens: int
    vocabulary: int
    discounts: list[float]
    keys: list[int]
    counts: list[int]
    weights: list[int]  # quantised backoff of coded contexts

    @property
    def codes(self) -> Codes:
        return Codes(np.array(self.keys, U64), np.array(self.counts, np.int64))

    @property
    def size(self) -> int:
        return self.tokens + self.vocabulary + 1

    def save(self) -> None:
        system, root = fs.FileSystem.from_uri(self.folder)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/model.json") as out:
            out.write(json.dumps(asdict(self)).encode())

    @staticmethod
    def load(folder: str) -> Model:
        system, root = fs.FileSystem.from_uri(folder)
        with system.open_input_file(f"{root}/model.json") as source:
            return Model(**json.loads(source.read()) | {"folder": folder})


def _quantise(values: np.ndarray) -> np.ndarray:
    """Probabilities as 16-bit steps of -log10; 0 stands for 1."""
    return np.minimum(np.rint(-np.log10(values) * STEP), 65535).astype("<u2")


def _backoff(left: np.ndarray, count: np.ndarray, seen: np.ndarray, size: int) -> np.ndarray:
    return np.minimum(left / count / np.maximum(1 - seen / size, 1e-6), 1.0)


class Shard:
    """The levels of one shard, as a view of its file."""

    def __init__(self, buffer):
        self.contexts = EliasFano(buffer)
        self.pointers = EliasFano(buffer, self.contexts.end)
        self.sums = EliasFano(buffer, self.pointers.end)
        self.words = EliasFano(buffer, self.sums.end)
        self.weights = np.frombuffer(buffer, "<u2", self.contexts.count, self.words.end)
        self.codes = np.frombuffer(buffer, "<u2", self.words.count, self.words.end + 2 * self.contexts.count)

    @staticmethod
    def pack(context: np.ndarray, word: np.ndarray, count: np.ndarray, model: Model) -> bytes:
        starts = _starts(context)
        keys, codes = context[starts], model.codes
        if len(keys) >= 1 << CONTEXT_BITS:
            raise ValueError("too many contexts in one shard: fit with more shards")
        place = np.repeat(np.arange(len(keys)), np.diff(np.append(starts, len(context))))
        total = np.add.reduceat(count, starts).astype(np.int64)
        whole = total.copy()
        whole[codes.hot(keys)] = codes.counts[codes.place(keys[codes.hot(keys)])]
        discount = np.array(model.discounts)[np.minimum(count, U64(DISCOUNTS)).astype(np.int64) - 1]
        left = np.bincount(place, weights=discount, minlength=len(keys))
        seen = _context_sums(place, word, count, len(keys), codes)[3]
        weights = _quantise(_backoff(left, whole, seen, model.size))  # those of coded contexts are in the model
        probability = np.maximum(count - discount, 1e-9) / whole[place]
        rising = (place.astype(U64) << U64(WORD_BITS)) | word
        parts = [EliasFano.pack(keys), EliasFano.pack(starts.astype(U64)), EliasFano.pack(np.cumsum(total).astype(U64)),
                 EliasFano.pack(rising)]
        return b"".join(parts) + weights.tobytes() + _quantise(probability).tobytes()

    def context(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place (-1: none), count and quantised backoff weight of contexts by their whole keys."""
        return self._at(self.contexts.successor(keys), keys, 0)

    def word(self, uppers: np.ndarray) -> np.ndarray:
        """Counts of words by their upper bits."""
        keys = uppers << U64(64 - WORD_BITS)
        return self._at(self.contexts.successor(keys), keys, 64 - WORD_BITS)[1]

    def _at(self, place: np.ndarray, keys: np.ndarray, ignored: int):
        inside = np.minimum(place, self.contexts.count - 1)
        found = (place < self.contexts.count) & (self.contexts.get(inside) >> U64(ignored) == keys >> U64(ignored))
        count = self.sums.get(inside).astype(np.int64)
        count -= np.where(inside > 0, self.sums.get(np.maximum(inside - 1, 0)).astype(np.int64), 0)
        return np.where(found, place, -1), np.where(found, count, 0), np.where(found, self.weights[inside].astype(np.int64), 0)

    def next_word(self, place: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Quantised probability of ``word`` behind the context at ``place``; -1 if not seen there."""
        wanted = (place.astype(U64) << U64(WORD_BITS)) | word
        at = self.words.successor(wanted)
        # the range of the context bounds the search: a successor beyond it is another context's
        last = np.where(place + 1 < self.contexts.count, self.pointers.get(np.minimum(place + 1, self.contexts.count - 1)), self.words.count)
        inside = np.minimum(at, self.words.count - 1)
        found = (at < last.astype(np.int64)) & (self.words.get(inside) == wanted)
        return np.where(found, self.codes[inside].astype(np.int64), -1)


def _write_shards(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    system, root = fs.FileSystem.from_uri(model.folder)
    for batch in batches:
        for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload"), strict=True):
            data = Shard.pack(*unpack(payload.as_buffer(), 3), model)
            trial = f"{root}/.trial-{shard}-{TaskContext.get().taskAttemptId()}"
            system.create_dir(root, recursive=True)
            with system.open_output_stream(trial) as out:
                out.write(data)
            system.move(trial, f"{root}/shard-{shard:06d}")  # a repeated task writes the same file
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "size": pa.array([len(data)], pa.int64())})


def _open(system, root: str, shard: int) -> Shard | None:
    path = f"{root}/shard-{shard:06d}"
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return None
    if system.type_name == "local":
        return Shard(np.memmap(path, np.uint8, "r"))
    with system.open_input_file(path) as source:
        return Shard(source.read())


def _map(frame: DataFrame, function, schema: str, *arguments) -> DataFrame:
    ship_package(frame.sparkSession)
    # packets and texts are large rows: fewer of them at once
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches):
        return function(batches, *arguments)

    return frame.mapInArrow(run, schema)


def _tasks(shards: int) -> int:
    return max(1, -(-shards // TASK_SHARDS))


def fit(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    folder: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
    hot_share: int = HOT_SHARE,
) -> Model:
    """Fit on all rows of ``docs`` and write the shards to ``folder`` (by default a new shared one).

    Null texts are empty: their end alone is learned. An empty table gives a model without
    shards that knows no word. The number of shards follows the tokens; nothing is cut off.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).select("text")
    counts = _map(rows, _word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = counts.where((F.col("n") * hot_share >= total) & (F.col("word") != 0)).collect()  # at most hot_share rows
    ends = counts.where("word = 0").select("n").first()
    known = sorted((word % (1 << 64), n) for word, n in frequent)
    codes = Codes(np.array([0, *[w for w, _ in known]], U64), np.array([ends[0] if ends else 0, *[n for _, n in known]], np.int64))
    shards = max(1, -(-total // shard_tokens))
    folder = folder or shared_folder(spark, "ngram-model")

    packets = _map(rows, _bigram_packets, PACKET, codes, shards)
    dealt = packets.repartition(_tasks(shards), "shard").sortWithinPartitions("shard")
    merged = stored(_map(dealt, _merge_counts, COUNTED, codes), "bigram-counts")
    n = [x or 0 for x in merged.agg(*[F.sum(f"n{k}") for k in range(1, 5)]).first()]
    discounts = _discounts(n)
    parts = merged.select(F.explode("hot").alias("h")).select("h.*").groupBy("place")
    sums = np.zeros((4, len(codes.keys)))
    for place, *values in parts.agg(*[F.sum(c) for c in ("s1", "s2", "s3", "seen")]).collect():  # a row per coded word
        sums[:, place] = values
    size = total + distinct + 1
    weights = _quantise(_backoff(np.maximum(np.array(discounts) @ sums[:3], 1e-9), np.maximum(codes.counts, 1), sums[3], size))
    weights[codes.counts == 0] = 0
    model = Model(folder, shards, int(total), int(distinct), discounts, codes.keys.tolist(), codes.counts.tolist(), weights.tolist())
    stored(_map(merged.select("shard", "payload"), _write_shards, "shard int, size bigint", model), "shards")
    model.save()
    return model


def _discounts(n: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and more from the counts of counts; within (0, count)."""
    n = [max(1, x) for x in n]
    share = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * share * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3), strict=True)]


# ---- scoring ----------------------------------------------------------------------------


def _event_packets(batches: Iterable[pa.RecordBatch], codes: Codes, shards: int) -> Iterator[pa.RecordBatch]:
    """Bigrams with their document, as packets by shard; documents themselves go to shard -1."""
    first = TaskContext.get().partitionId() << 40
    for turn, table in enumerate(_gathered(batches)):
        keys, place, text = tokens(_one(table, "text"), codes)
        lengths = np.bincount(text, minlength=table.num_rows)
        rows = pa.RecordBatch.from_arrays(
            [*(_one(table, c) for c in ("doc_id", "held_out")), pa.array(lengths)], ["doc_id", "held_out", "n_tokens"]
        )
        for at in _block_starts(first, table.num_rows):
            end = min((((first + at) >> BLOCK_BITS) + 1 << BLOCK_BITS) - first, table.num_rows)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_batch(rows.slice(at, end - at))
            yield _packet_batch([-1], turn & 7, first + at, [sink.getvalue().to_pybytes()])
        pairs = _bigrams(place, int(np.searchsorted(keys, 0)))
        order = np.argsort(pairs, kind="stable")  # texts rise already
        pairs, text = pairs[order], text[order]
        starts = _starts(pairs, text)
        times = np.diff(np.append(starts, len(pairs))).astype(U64)
        context, word = keys[pairs[starts] >> 32], keys[pairs[starts] & 0xFFFFFFFF]
        shard = _shard_of(context, word, codes.hot(context), shards)
        yield from _packets(shard, [context, _upper(word), text[starts].astype(U64), times], turn & 7, first)
        first += table.num_rows


def _block_starts(first: int, size: int) -> list[int]:
    """Where the blocks of ``size`` documents numbered from ``first`` start."""
    following = (-first) % (1 << BLOCK_BITS)
    return [0, *range(following or 1 << BLOCK_BITS, size, 1 << BLOCK_BITS)]


def _scored_batch(kind: int, shards: list, turn: int, rows: list, payloads: list) -> pa.RecordBatch:
    size = len(payloads)
    columns = [
        pa.array([kind] * size, pa.int32()), pa.array(shards, pa.int32()), pa.array([turn] * size, pa.int32()),
        pa.array(rows, pa.int64()), pa.array(payloads, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["kind", "shard", "turn", "row", "payload"])


def _sums(row: np.ndarray, times: np.ndarray, known, base, score) -> pa.RecordBatch:
    """Sums per document of some events, a packet per block of documents."""
    present, at = np.unique(row, return_inverse=True)
    known, base, score = (np.bincount(at, weights=v * times, minlength=len(present)) for v in (known, base, score))
    starts = _starts(present >> BLOCK_BITS)
    payloads = []
    for a, b in zip(starts, np.append(starts[1:], len(present)), strict=True):
        place = (present[a:b] & ((1 << BLOCK_BITS) - 1)).astype(U64)
        payloads.append(pack([place, np.rint(known[a:b]).astype(U64), base[a:b].view(U64), score[a:b].view(U64)]))
    rows = (present[starts] >> BLOCK_BITS << BLOCK_BITS).tolist()
    return _scored_batch(SUMS, [None] * len(rows), 0, rows, payloads)


def _events(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[tuple[int, list]]:
    """Packets of a shard put together to about ``EVENTS`` rows, the column before the last as numbers of documents.

    The documents' own packets (shard -1) come as they are, with the number of their first row.
    """
    held: list[list[np.ndarray]] = []
    size, shard = 0, None
    for batch in batches:
        names = (batch.column("shard").to_pylist(), batch.column("row").to_pylist(), batch.column("payload"))
        for s, row, packed in zip(*names, strict=True):
            payload = packed.as_buffer()
            if s < 0:
                yield s, [row, payload]
                continue
            if held and (s != shard or size >= EVENTS):
                yield shard, [np.concatenate(c) for c in zip(*held, strict=True)]
                held, size = [], 0
            part = unpack(payload, columns)
            part[-2] = part[-2].astype(np.int64) + row
            held.append(part)
            size, shard = size + len(part[0]), s
    if held:
        yield shard, [np.concatenate(c) for c in zip(*held, strict=True)]


def _score_bigrams(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums per document; rare words not seen behind their context leave as packets for their own shard."""
    codes, hot_weights = model.codes, np.array(model.weights, np.int64)
    system, root = fs.FileSystem.from_uri(model.folder)
    opened, levels = None, None
    for shard, columns in _events(batches, 4):
        if shard < 0:
            yield _scored_batch(DOCUMENTS, [None], 0, columns[:1], [columns[1].to_pybytes()])
            continue
        if shard != opened:
            opened, levels = shard, _open(system, root, shard)
        order = np.lexsort((columns[1], columns[0]))
        context, word, row, times = (c[order] for c in columns)
        # sorted by context and word: one look-up per context and per bigram
        starts = _starts(context, word)
        runs = np.diff(np.append(starts, len(word)))
        first = _starts(context[starts])
        keys, pair_word = context[starts[first]], word[starts]
        at = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(starts))))
        code = np.full(len(starts), -1, np.int64)
        count, weight = np.zeros((2, len(keys)), np.int64)
        if levels:
            place, count, weight = levels.context(keys)
            there = place[at] >= 0
            code[there] = levels.next_word(place[at][there], pair_word[there])
        hot = codes.hot(keys)
        count[hot], weight[hot] = codes.counts[codes.place(keys[hot])], hot_weights[codes.place(keys[hot])]
        unseen = code < 0
        score = np.where(unseen, -weight[at], -code) / STEP
        coded = pair_word >> U64(WORD_BITS - 1) == 0
        short = unseen & coded
        score[short] += np.log10((codes.counts[pair_word[short].astype(np.int64)] + 1) / model.size)
        base = np.log10((count + 1) / model.size)
        times = times.astype(np.int64)
        yield _sums(row, times, np.repeat((count > 0)[at], runs), np.repeat(base[at], runs), np.repeat(score, runs))
        asked = np.repeat(unseen & ~coded, runs)
        if asked.any():
            yield from _unseen(word[asked], row[asked], times[asked], model.shards)


def _unseen(word: np.ndarray, row: np.ndarray, times: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Packets that ask for the unigram of words, with their documents counted from the least one."""
    least = int(row.min())
    order = np.lexsort((row, word))
    word, row, times = word[order], row[order] - least, times[order]
    shard = (_mix(word) % U64(shards)).astype(np.int32)
    for packet in _packets(shard, [word, row.astype(U64), times.astype(U64)], least & 7, least):
        columns = [pa.array([ASKED] * packet.num_rows, pa.int32()), *packet.columns]
        yield pa.RecordBatch.from_arrays(columns, ["kind", *packet.schema.names])


def _score_words(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Adds the unigram of words not seen behind their context."""
    system, root = fs.FileSystem.from_uri(model.folder)
    opened, levels = None, None
    for shard, (word, row, times) in _events(batches, 3):
        if shard != opened:
            opened, levels = shard, _open(system, root, shard)
        keys, at = np.unique(word, return_inverse=True)
        count = levels.word(keys) if levels else np.zeros(len(keys), np.int64)
        nothing = np.zeros(len(word))
        yield _sums(row, times.astype(np.int64), nothing, nothing, np.log10((count + 1) / model.size)[at])


def _figures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block with their sums; packets are sorted by block."""
    block, docs, sums = None, [], np.zeros((3, 1 << BLOCK_BITS))

    def finish() -> Iterator[pa.RecordBatch]:
        for row, payload in docs:
            with pa.ipc.open_stream(payload) as reader:
                for batch in reader:
                    own = slice(row & ((1 << BLOCK_BITS) - 1), (row & ((1 << BLOCK_BITS) - 1)) + batch.num_rows)
                    known, base, score = sums[:, own]
                    columns = [*batch.columns, pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base", "score"])

    for batch in batches:
        for kind, row, packed in zip(*(batch.column(c).to_pylist() for c in ("kind", "row")), batch.column("payload"), strict=True):
            if row >> BLOCK_BITS != block:
                yield from finish()
                block, docs = row >> BLOCK_BITS, []
                sums[:] = 0
            if kind == DOCUMENTS:
                docs.append((row, packed.as_buffer()))
            else:
                place, known, base, score = unpack(packed.as_buffer(), 4)
                place = place.astype(np.int64)
                sums[0, place] += known
                sums[1, place] += base.view(np.float64)
                sums[2, place] += score.view(np.float64)
    yield from finish()


def score(
    docs: DataFrame, model: Model, held_out: Column | None = None, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``base_score`` is the add-one unigram's log10 probability of the text, ``score`` the
    model's. Null texts are empty and have one token, their end. Rows are told apart by
    their place in the input, so repeated rows and identifiers stay apart and null
    identifiers are kept; the input is read once. Other columns are not read.
    """
    rows = docs.withColumn("_held", F.lit(False)) if held_out is None else docs.withColumn("_held", held_out)
    ship_package(docs.sparkSession)
    rows = rows.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce("_held", F.lit(False)).alias("held_out"),
    )
    packets = _map(rows, _event_packets, PACKET, model.codes, model.shards)
    tasks = _tasks(model.shards)
    # bigrams of one context may be most of all: slices take eight turns, each may be another task's
    dealt = packets.repartition(tasks, "shard", "turn").sortWithinPartitions("shard")
    first = stored(_map(dealt, _score_bigrams, SCORED, model), "bigram-sums")
    asked = first.where(F.col("kind") == ASKED).drop("kind")
    asked = asked.repartition(tasks, "shard", "turn").sortWithinPartitions("shard")
    parts = first.where(F.col("kind") != ASKED).unionByName(_map(asked, _score_words, SCORED, model))
    # all of a block in one task: its documents, and one packet per task that met them
    block = F.shiftright("row", BLOCK_BITS)
    parts = parts.select("kind", "row", "payload").repartition(block).sortWithinPartitions(block)
    figures = _map(parts, _figures, FIGURES)
    tokens_learned = F.lit(model.tokens).cast("bigint").alias("train_tokens")
    return figures.select(
        "doc_id", "held_out", "n_tokens", "n_known", tokens_learned, F.col("base").alias("base_score"), "score"
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Documents whose crc32 of the identifier as text leaves 2 by 7; a null identifier is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, and score all of them."""
    model = fit(docs.where(~held_out()))
    return score(docs, model, held_out())
