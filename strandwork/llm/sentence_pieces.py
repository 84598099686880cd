"""SentencePiece encoding that keeps offsets, and decoding.

A text is first normalised: at each place the longest key of the model's compiled character map (a double-array trie, or a
symbol of the user's) is replaced by its text, and every byte that results records the source byte that it came from. The normalised text is
cut into pieces, and each piece is projected back to the span of original UTF-8 bytes.

* Spaces are handled as the model's normaliser says: a prefix or suffix, runs folded, U+2581 written for a space.
* In a model whose pieces never go on past a word (checked from its vocabulary) a text is cut by parts that end with a word, so the
  cutter's queue stays small however long the text; other models get the normalised text whole.
* Of a letter written as byte pieces the last one has the letter's span, those before it are empty spans at its begin.

Nothing is shuffled: texts are read where they are, a slice of them at a time. The model's bytes (half a megabyte) go with the function.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import release, text_slices

SPACE_MARK = "▁"
_MARK = SPACE_MARK.encode()
_REPLACEMENT = "�".encode()
#: Texts are cut into pieces by parts of about so many letters, where the model allows it.
PART_LETTERS = 1 << 16
#: Where a word ends and the next begins.
_PAST = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}")
ENCODED = "ids array<int>, begins array<int>, ends array<int>"


class CharMap:
    """The compiled map: its keys in a double array, their texts behind one another, each ended by a zero byte.

    The blob begins with the array's size in bytes. A unit holds a label in its lowest byte, a flag for a key's end in bit 8, and the
    distance to its children above; a key's value is the place of its text.
    """

    def __init__(self, blob: bytes, symbols: tuple[bytes, ...] = ()):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units, self.texts = np.frombuffer(blob[4 : 4 + size], "<u4"), blob[4 + size :]
        self.symbols = {s[:1]: sorted((x for x in symbols if x[:1] == s[:1]), key=len, reverse=True) for s in symbols}
        self.begins = self._begins()

    @staticmethod
    def _below(unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    def _children(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each node: which bytes lead on, and to where (one row each)."""
        to = at[:, None] ^ np.arange(256)
        inside = to < len(self.units)
        unit = self.units[np.where(inside, to, 0)].astype(np.int64)
        return inside & ((unit & 0x800000FF) == np.arange(256)), to

    def _begins(self) -> np.ndarray:
        """[first byte, second byte]: may a key begin so? Few places of a text need a walk."""
        may = np.zeros((256, 256), bool)
        if len(self.units):
            ok, to = self._children(np.array([self._below(int(self.units[0]))], np.int64))
            for b in np.flatnonzero(ok[0]):
                unit = int(self.units[to[0, b]])
                may[b] = bool(unit >> 8 & 1) | self._children(np.array([to[0, b] ^ self._below(unit)], np.int64))[0][0]
        for s in (s for group in self.symbols.values() for s in group):
            may[s[0], s[1] if len(s) > 1 else slice(None)] = True
        return may

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, text) of the longest key at a place; symbols go before keys and stay as they are."""
        for s in self.symbols.get(text[at : at + 1], ()):
            if text.startswith(s, at):
                return len(s), s
        if not len(self.units):
            return None
        node, found = self._below(int(self.units[0])), None
        for k in range(at, len(text)):
            node ^= text[k]
            unit = int(self.units[node]) if node < len(self.units) else 0
            if unit & 0x800000FF != text[k]:
                break
            node ^= self._below(unit)
            if unit >> 8 & 1:
                found = k + 1 - at, int(self.units[node]) & 0x7FFFFFFF
        return found and (found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])])

    def replacements(self, text: bytes) -> list[tuple[int, int, bytes]]:
        """(begin, length, text) in order, none inside another; bytes that are no UTF-8 are each read as U+FFFD."""
        data = np.frombuffer(text, np.uint8)
        places = np.flatnonzero(self.begins[data, np.append(data[1:], 0)]) if self.begins.any() and len(data) else np.zeros(0, np.int64)
        bad = _invalid(text)
        out, until = [], 0
        for p in np.union1d(places, bad).tolist() if len(bad) else places.tolist():
            if p < until:
                continue
            found = self.longest(text, p) or ((1, _REPLACEMENT) if len(bad) and p in bad else None)
            if found:
                out.append((p, *found))
                until = p + found[0]
        return out


def _invalid(text: bytes) -> np.ndarray:
    """Places of bytes that are no UTF-8."""
    try:
        text.decode()
    except UnicodeDecodeError:
        letters = text.decode("utf-8", "surrogateescape")
        wide = np.array([1 if 0xDC80 <= ord(c) <= 0xDCFF else len(c.encode()) for c in letters])
        return (np.cumsum(wide) - wide)[[0xDC80 <= ord(c) <= 0xDCFF for c in letters]]
    return np.zeros(0, np.int64)


class PieceModel:
    def __init__(self, blob: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        kind = proto.SentencePiece
        self.rules = type(proto.normalizer_spec)()
        self.rules.CopyFrom(proto.normalizer_spec)
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        symbols = tuple(p.piece.encode() for p in proto.pieces if p.type == kind.USER_DEFINED)
        self.map = CharMap(self.rules.precompiled_charsmap, symbols)
        bare = kind.UNKNOWN, kind.CONTROL
        self.width = np.array([-1 if p.type == kind.UNKNOWN else 0 if p.type in bare else 1 if p.type == kind.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int32)
        self.is_byte = np.array([p.type == kind.BYTE for p in proto.pieces])
        self.by_word = proto.trainer_spec.model_type == proto.trainer_spec.BPE and proto.trainer_spec.byte_fallback and not symbols and not any(_PAST.search(p.piece) for p in proto.pieces)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.end_id = self.whole.eos_id()
        spec = proto.normalizer_spec
        spec.Clear()
        spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = "identity", False, False, False
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and of each byte of it and of its end the source byte where what it came from begins."""
        data = np.frombuffer(text, np.uint8)
        found = self.map.replacements(text)
        source, first = np.arange(len(data), dtype=np.int32), np.ones(len(data), bool)
        if found:
            parts, sources, firsts, at = [], [], [], 0
            for p, n, new in found:
                parts += [data[at:p], np.frombuffer(new, np.uint8)]
                sources += [source[at:p], np.full(len(new), p, np.int32)]
                firsts += [first[at:p], np.arange(len(new)) == 0]
                at = p + n
            data, source, first = np.concatenate([*parts, data[at:]]), np.concatenate([*sources, source[at:]]), np.concatenate([*firsts, first[at:]])
        end, lead, space = len(text), 0, data == 32
        mark = _MARK if self.rules.escape_whitespaces else b" "
        if self.rules.remove_extra_whitespaces:
            gone = space & first & np.append(True, space[:-1])[: len(data)]
            for k in np.flatnonzero(space & ~first):  # a key whose text begins with several spaces
                gone[k] = gone[k - 1]
            other = [*source[~space][:1].tolist(), *[p for p, _, new in found if not new][:1]]
            if not other:  # nothing but spaces
                return b"", np.zeros(1, np.int32)
            lead, kept = min(other), np.flatnonzero(~gone)
            data, source = data[kept], source[kept]
            bare = data.tobytes()
            while bare and bare.endswith((b" ", mark)):
                bare = bare[: -len(mark) if bare.endswith(mark) else -1]
            if len(bare) < len(data):
                end = int(source[len(bare)])
            if not bare and self.rules.add_dummy_prefix and not self.suffix:
                return b"", np.zeros(1, np.int32)
            data, source = data[: len(bare)], source[: len(bare)]
            space = data == 32
        elif not text:
            return b"", np.zeros(1, np.int32)
        escape = self.rules.escape_whitespaces
        out = data.tobytes().replace(b" ", _MARK) if escape else data.tobytes()
        source = np.repeat(source, np.where(space, 3, 1)) if escape else source
        if self.rules.add_dummy_prefix:
            more = np.full(len(mark), end if self.suffix else lead, np.int32)
            out, source = (out + mark, np.append(source, more)) if self.suffix else (mark + out, np.append(more, source))
        return out, np.append(source, np.int32(end))

    def _parts(self, normal: str):
        """The text, cut where a word begins after PART_LETTERS letters: no piece reaches over such a place."""
        at = 0
        while self.by_word and len(normal) - at > PART_LETTERS and (cut := _PAST.search(normal, at + PART_LETTERS - 1)):
            yield normal[at : cut.start() + 1]
            at = cut.start() + 1
        yield normal[at:] if at else normal

    def pieces(self, normal: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a normalised text's pieces and the normalised bytes that each takes."""
        ids = np.concatenate([np.zeros(0, np.int32), *(self.cutter.encode(part, return_type="numpy") for part in self._parts(normal))]).astype(np.int32)
        wide = self.width[ids]
        if wide.min(initial=0) < 0:  # letters that the model doesn't know; such a model gets texts whole
            wide = np.array([len(p.piece.encode()) if p.id == self.cutter.unk_id() else self.width[p.id] for p in self.cutter.encode(normal, return_type="proto").pieces], np.int32)
        return ids, wide

    def encode(self, text: bytes, end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends) of a text; the end id has an empty span behind it."""
        normal, source = self.normalised(text)
        ids, wide = self.pieces(normal.decode())
        to = np.cumsum(wide)
        at = to - wide
        begins, ends = source[at], source[to]
        part = np.flatnonzero(self.is_byte[ids])
        if len(part):
            data = np.append(np.frombuffer(normal, np.uint8), np.uint8(0))
            inside = (data & 0xC0) == 0x80
            lead = at[part]
            for _ in range(3):
                lead = lead - inside[lead]
            begins[part] = source[lead]
            ends[part] = np.where(inside[to[part]], begins[part], ends[part])
        if end:
            ids, begins, ends = np.append(ids, np.int32(self.end_id)), np.append(begins, np.int32(len(text))), np.append(ends, np.int32(len(text)))
        return ids, begins, ends


@functools.lru_cache(2)
def _model(blob: bytes) -> PieceModel:
    return PieceModel(blob)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)))


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """Every row's key with ids, begins and ends of its pieces: spans of bytes of the UTF-8 text, whole texts whatever their length.

    A null text is empty; an empty one has no pieces but the end id. Keys are of any type, null and repeated ones too: rows are
    encoded one by one. Other columns are not read. No rows in, no rows out. model: the path of a model's file.
    """
    with open(model, "rb") as f:
        blob = f.read()

    def run(batches):
        own = _model(blob)
        for batch in batches:
            for i, j in text_slices(batch.column("text")):
                done = [own.encode(t.as_py() or b"", end) for t in batch.column("text").slice(i, j - i)]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), *[_lists([d[k] for d in done]) for k in range(3)]], ["key", "ids", "begins", "ends"])
            release()

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {ENCODED}").withColumnRenamed("key", key)


def decoded(ids: str | Column, model: str) -> Column:
    """The text of a column of ids, as the model's decoder gives it; null ids have none."""
    with open(model, "rb") as f:
        blob = f.read()

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        own = _model(blob).whole
        out = pa.array([None if x is None else own.decode(x) for x in (v.as_py() for v in column)], pa.string())
        release()
        return out

    return run(ids)
