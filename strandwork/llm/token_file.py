"""Token ids in a binary file format: static range asymmetric numeral systems (rANS).

One frequency table, counted over all ids and shared by every block, is stored once. A block holds whole documents in order and
decodes alone. Its ids are dealt to LANES interleaved coders that write 32-bit words into one stream; every CHECKPOINT steps
the coder states and the place in the stream are noted, so the spans between checkpoints decode in parallel (here: as rows of
one wide numpy array). A crc32 guards each block.

The blocks are rows of a Parquet table (part, ids before the block in its part, ids in the block, payload), which any store that
Spark writes to can hold; parts are ranges of doc_id in ascending order.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwork.llm.common import ASCII_LOWER, new_path, release, shuffle_parts, text_buffer, text_slices, words, written

END_ID = 1
MAGIC = b"SRNS"
SCALE = 20
LANES = 1024
CHECKPOINT = 256
#: A block closes at the first document that takes it to so many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 19
_LOW = np.uint64(1 << 31)
_U = np.uint64


# --- rANS ------------------------------------------------------------------------------------------------------------


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least 1 for every id that occurs."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint32)
    if int((counts > 0).sum()) > 1 << SCALE:
        raise ValueError("more different ids than the table has slots")
    f = np.where(counts > 0, np.maximum(1, counts.astype(object) * (1 << SCALE) // total).astype(np.int64), 0)
    over = int(f.sum()) - (1 << SCALE)
    for k in np.argsort(-f, kind="stable"):
        if not over:
            break
        change = min(over, int(f[k]) - 1) if over > 0 else over
        f[k] -= change
        over -= change
    return f.astype(np.uint32)


class Coder:
    """Encodes and decodes id arrays with one shared frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> bytes:
        """Lane states, checkpoints and words; the number of ids is not part of it."""
        n = len(ids)
        lanes = min(LANES, max(1, n // 64))
        steps = -(-n // lanes)
        f, c = self.freq[ids], self.start[ids]
        state = np.full(lanes, _LOW)
        out: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []  # (words so far, states), from the last one back
        sent = 0
        for t in range(steps - 1, -1, -1):
            a = t * lanes
            b = min(n, a + lanes)
            x, fs = state[: b - a], f[a:b]
            full = x >= (fs << _U(63 - SCALE))
            if full.any():
                out.append((x[full] & _U(0xFFFFFFFF)).astype("<u4"))
                sent += len(out[-1])
                x = np.where(full, x >> _U(32), x)
            div = x // fs
            state[: b - a] = (div << _U(SCALE)) + (x - div * fs) + c[a:b]
            if t and t % CHECKPOINT == 0:
                marks.append((sent, state.copy()))
        stream = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
        head = struct.pack("<HIQ", lanes, len(marks), len(stream))
        spots = b"".join(struct.pack("<Q", sent - at) + s.astype("<u8").tobytes() for at, s in reversed(marks))
        return head + state.astype("<u8").tobytes() + spots + stream.tobytes()

    def decode(self, data: bytes, n: int) -> np.ndarray:
        """The n ids of encode(); the spans between checkpoints advance side by side."""
        lanes, n_marks, n_words = struct.unpack_from("<HIQ", data)
        at = struct.calcsize("<HIQ")
        state = [np.frombuffer(data, "<u8", lanes, at)]
        at += 8 * lanes
        place = [0]
        for _ in range(n_marks):
            place.append(struct.unpack_from("<Q", data, at)[0])
            state.append(np.frombuffer(data, "<u8", lanes, at + 8))
            at += 8 + 8 * lanes
        stream = np.concatenate([np.frombuffer(data, "<u4", n_words, at), np.zeros(1, "<u4")]).astype(np.uint64)
        x, p = np.array(state, np.uint64), np.array(place, np.int64)
        spans, mask = len(place), _U((1 << SCALE) - 1)
        out = np.zeros((spans, CHECKPOINT, lanes), np.uint32)
        steps = -(-n // lanes)
        for t in range(min(CHECKPOINT, steps)):
            live = spans if t + (spans - 1) * CHECKPOINT < steps else spans - 1
            xs = x[:live]
            slot = xs & mask
            sym = self.symbol[slot.astype(np.int64)]
            out[:live, t] = sym
            xs = self.freq[sym] * (xs >> _U(SCALE)) + slot - self.start[sym]
            need = xs < _LOW
            if live == spans and (spans - 1) * CHECKPOINT + t == steps - 1:  # the last step may not fill all lanes
                need[-1, n - (steps - 1) * lanes :] = False
            rank = np.cumsum(need, 1)
            word = stream[np.minimum(p[:live, None] + rank - 1, n_words) * need]
            x[:live] = np.where(need, (xs << _U(32)) | word, xs)
            p[:live] += rank[:, -1]
        return out.reshape(-1)[:n] if n else np.zeros(0, np.uint32)


def pack_block(coder: Coder, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    body = MAGIC + struct.pack("<IQ", len(doc_ids), len(ids)) + known.tobytes() + keys.tobytes() + lengths.astype("<u8").tobytes() + coder.encode(ids)
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(coder: Coder, block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, lengths, ids); raises ValueError for a block that was damaged."""
    if block[:4] != MAGIC or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block")
    docs, n = struct.unpack_from("<IQ", block, 4)
    at = 4 + struct.calcsize("<IQ")
    known = np.frombuffer(block, np.uint8, docs, at)
    keys = np.frombuffer(block, "<i8", docs, at + docs)
    lengths = np.frombuffer(block, "<u8", docs, at + 9 * docs).astype(np.int64)
    return [int(k) if o else None for k, o in zip(keys, known, strict=True)], lengths, coder.decode(block[at + 17 * docs : -4], n)


# --- tokenizing ------------------------------------------------------------------------------------------------------


_ALNUM, _PUNCT = np.zeros(256, bool), np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_PUNCT[[c for c in range(33, 127) if not _ALNUM[c] and c != 39]] = True
_LETTERS = np.zeros(256, bool)  # bytes of words that are one run of letters, or that count as such until checked
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


# How a tokenizer reads texts whose words can be encoded apart.
_BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def reads_by_word(spec: dict) -> bool:
    """Whether a tokenizer (its file as a dict) is one whose words can be encoded apart; others get whole texts."""
    model = spec["model"]
    plain = not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    return plain and all(spec[k] == v for k, v in _BY_WORD.items()) and model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not model["dropout"] and not spec["truncation"] and not spec["padding"]


class WordIds:
    """Ids of texts: the tokenizer runs once for each different word that the cache does not hold.

    For tokenizers that lower-case, drop white space, part letters from punctuation and end every run with an id that is
    marked as a word end (reads_by_word). Texts are cut at ASCII white space and between an ASCII letter or digit and ASCII
    punctuation (but for the apostrophe), and ASCII letters count as their lower case: nothing that such a tokenizer would join.
    Where a special token's text occurs, words stay as they are. Any other tokenizer encodes whole texts.
    """

    MOST = 700_000
    TOGETHER = 64

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = reads_by_word(json.loads(self.tokenizer.to_str()))
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocab = max(vocab.values()) + 1
        self.ends = np.zeros(self.vocab, bool)
        self.ends[[k for t, k in vocab.items() if t.endswith("</w>")]] = True
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.n, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, raw: list[bytes]) -> None:
        """keys: sorted and new. Words of letters go to the tokenizer many at a time and are told apart by their word ends.

        Each gives one run at least, so as many ends as words mean one each; a word of white space alone, which gives none,
        and others that are not all letters go alone.
        """
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        begin = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(raw) else size
        joined = np.frombuffer(b"".join(raw), np.uint8)
        plain = np.logical_and.reduceat(_LETTERS[joined], begin) & (size < 256)
        for k in np.flatnonzero(plain & np.logical_or.reduceat(joined > 127, begin)):
            plain[k] = raw[k].decode().isalpha()
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        many = np.flatnonzero(plain)
        n = np.zeros(len(raw), np.int64)
        flat: list[np.ndarray] = []
        groups = [many[i : i + self.TOGETHER] for i in range(0, len(many), self.TOGETHER)]
        for group, ids in zip(groups, self._ids([b" ".join([raw[k] for k in g]).decode() for g in groups]), strict=True):
            got = np.array(ids, np.uint32)
            stop = np.flatnonzero(self.ends[got]) + 1
            if len(stop) == len(group) and (not len(stop) or stop[-1] == len(got)):
                n[group] = np.diff(stop, prepend=0)
                flat.append(got)
            else:  # a word of several runs: this group word by word
                each = self._ids([raw[k].decode() for k in group])
                n[group] = [len(x) for x in each]
                flat += [np.array(x, np.uint32) for x in each]
        rest = np.flatnonzero(~plain)
        each = self._ids([raw[k].decode() for k in rest])
        n[rest] = [len(x) for x in each]
        flat += [np.array(x, np.uint32) for x in each]
        at = np.empty(len(raw), np.int64)
        stop = np.cumsum(n[order])
        at[order] = len(self.ids) + stop - n[order]
        self.ids = np.concatenate([self.ids, *flat])
        every = np.concatenate([self.keys, keys])
        order = np.argsort(every, kind="stable")
        self.keys, self.at, self.n = every[order], np.concatenate([self.at, at])[order], np.concatenate([self.n, n.astype(np.int32)])[order]

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text (null: none)."""
        if not self.by_word:
            return [np.array(x, np.uint32) for x in self._ids([t or "" for t in column.to_pylist()])]
        buf, starts = text_buffer(column)
        lower = ASCII_LOWER[buf]
        cuts = None
        if any(t in lower.tobytes() for t in self.special):
            self._clear()  # words as they are must not meet cached parts
        elif len(buf):
            alnum, punct = _ALNUM[buf], _PUNCT[buf]
            cuts = np.zeros(len(buf), bool)
            cuts[1:] = (alnum[1:] & punct[:-1]) | (punct[1:] & alnum[:-1])
            buf = lower
        h, begin, end, doc = words(buf, starts, cuts)
        keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[place] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            if len(self.keys) + int(new.sum()) > self.MOST:
                self._clear()
                new[:] = True
            raw = buf.tobytes()
            self._learn(keys[new], [raw[begin[k] : end[k]] for k in first[new]])
            place = np.searchsorted(self.keys, keys)
        n = self.n[place][inverse] if len(keys) else np.zeros(0, np.int64)
        stop = np.cumsum(n, dtype=np.int64)
        flat = self.ids[np.repeat(self.at[place][inverse] - (stop - n), n) + np.arange(int(stop[-1]))] if len(n) else np.zeros(0, np.uint32)
        if cuts is None:
            self._clear()
        edge = np.concatenate([[0], stop])[np.searchsorted(doc, np.arange(len(starts)))]
        return [flat[edge[i] : edge[i + 1]] for i in range(len(starts) - 1)]


_LOADED: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


# --- the operator ----------------------------------------------------------------------------------------------------


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids (little-endian, ``width`` bytes each, zstandard) of every whole text; null texts are empty; end_id closes each.

    Each task adds one row of ``width`` 0: how often each id occurred in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coder, press = _word_ids(tokenizer_path), zstandard.ZstdCompressor(level=3)
        small = np.uint16 if max(coder.vocab, end_id + 1) <= 1 << 16 else np.uint32
        total = np.zeros(max(coder.vocab, end_id + 1), np.int64)
        end = np.array([end_id], small)
        for batch in batches:
            text, key = batch.column("text"), batch.column("doc_id")
            for i, j in text_slices(text, 2 << 20):
                found = coder.encode(text.slice(i, j - i))
                total[end_id] += len(found)
                total += np.bincount(np.concatenate(found), minlength=len(total))
                out = [press.compress(np.concatenate([x.astype(small), end]).tobytes()) for x in found]
                yield pa.RecordBatch.from_arrays([key.slice(i, j - i), pa.array([small().itemsize] * len(out), pa.int32()), pa.array(out, pa.binary())], ["doc_id", "width", "ids"])
            release()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([0], pa.int32()), pa.array([press.compress(total.astype("<i8").tobytes())], pa.binary())], ["doc_id", "width", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, width int, ids binary")


def _ids_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    import zstandard

    open_ = zstandard.ZstdDecompressor()
    for width, packed in zip(batch.column("width").to_pylist(), batch.column("ids"), strict=True):
        yield np.frombuffer(open_.decompress(packed.as_buffer()), "<u2" if width == 2 else "<u4").astype(np.uint32)


def _counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents: the tasks' counts, summed by id; as many rows as the vocabulary has."""

    def run(batches):
        import zstandard

        total = None
        for batch in batches:
            for packed in batch.column("ids"):
                more = np.frombuffer(zstandard.decompress(packed.as_buffer()), "<i8")
                total = more if total is None else total + more
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["id", "n"])

    rows = tokens.where("width = 0").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    out[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Tokenizes ``docs`` (doc_id, text, any more columns) and writes path/table and path/blocks in ascending doc_id order.

    Null doc_ids come first; rows of equal doc_id in the order of their stored bytes. An empty table writes no blocks.
    """
    spark = docs.sparkSession
    tokens = written(tokenized(docs, tokenizer_path, end_id), "token-ids")
    freq = quantised(_counts(tokens))
    used = np.flatnonzero(freq)
    spark.createDataFrame([(int(k), int(freq[k])) for k in used], "id int, freq int").coalesce(1).write.parquet(f"{path}/table")

    def encode(batches):
        coder = Coder(freq)
        part, before = TaskContext.get().partitionId(), 0
        keys: list = []
        held: list[np.ndarray] = []
        n = 0

        def block():
            payload = pack_block(coder, keys, np.array([len(x) for x in held], np.int64), np.concatenate(held))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "before": pa.array([before], pa.int64()), "n_ids": pa.array([n], pa.int64()), "payload": pa.array([payload], pa.binary())})

        for batch in batches:
            for key, ids in zip(batch.column("doc_id").to_pylist(), _ids_of(batch), strict=True):
                keys.append(key)
                held.append(ids)
                n += len(ids)
                if n >= BLOCK_IDS:
                    yield block()
                    before += n
                    keys, held, n = [], [], 0
        if keys:
            yield block()
        release()

    ranged = tokens.where("width > 0").repartitionByRange(shuffle_parts(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    ranged.mapInArrow(encode, "part int, before long, n_ids long, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of a written file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked, ids.

    The driver holds one number for each part (as many as shuffle partitions) and the frequency table.
    """
    table = spark.read.schema("id int, freq int").parquet(f"{path}/table").collect()
    freq = np.zeros(max((r["id"] for r in table), default=-1) + 1, np.uint32)
    for r in table:
        freq[r["id"]] = r["freq"]
    blocks = spark.read.schema("part int, before long, n_ids long, payload binary").parquet(f"{path}/blocks")
    base, total = {}, 0
    for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        base[r["part"]] = total
        total += r["n"]

    def decode(batches):
        coder = Coder(freq)
        for batch in batches:
            for part, before, payload in zip(batch.column("part").to_pylist(), batch.column("before").to_pylist(), batch.column("payload"), strict=True):
                keys, lengths, ids = unpack_block(coder, payload.as_buffer().to_pybytes())
                stop = np.cumsum(lengths)
                raw = ids.astype("<u4")
                each = [raw[e - k : e] for k, e in zip(lengths.tolist(), stop.tolist(), strict=True)]
                rows = {
                    "doc_id": pa.array(keys, pa.int64()),
                    "start": pa.array(base[part] + before + stop - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()),
                }
                if with_ids:
                    rows["ids"] = pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(rows)
            release()

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def encoded(docs: DataFrame, tokenizer_path: str, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """write(), then read()."""
    spark = docs.sparkSession
    path = path or new_path(spark, "token-file")
    write(docs, path, tokenizer_path)
    return read(spark, path, with_ids)
