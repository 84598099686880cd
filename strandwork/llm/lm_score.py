"""Language-model scores: a log-bilinear model, trained in numpy by noise-contrastive estimation.

From the CONTEXT words before, the model predicts a vector: the sum of those words' vectors times a diagonal for each place.
It meets output vectors on two levels. First the next word's class: one of the groups that the MODEL_WORDS most frequent words (the
end of a text is one of them) are dealt to by rank, or one of RARE classes of all others, by their last letter. Then, in a group, the word.
Batches of matrix products give all scores of a level, so probabilities are normalised exactly. A word of a rare class
has that class's probability times its own smoothed share (c + 1/2) / (C + (V + 1) / 2) within it; unseen words are one such
share of each class, so the probabilities of all known words and of the unseen ones sum to 1. Training texts hold no unseen
words: each class's bias is raised by the logarithm of (C + (V + 1) / 2) / C for them.

How the corpus is used:

1.  Texts become blocks of bounded size: a sorted lexicon of 64-bit word hashes, training counts, and local word numbers.
2.  Training counts are summed by word, first within tasks. The model's words and their counts go to all blocks; of the others, an
    entry of a block's lexicon is sent to meet its count, and what differs from the block's own goes back to it. So frequent words
    are never rows of a join, and only distinct words of blocks are shuffled, never all tokens.
3.  Training runs in ROUNDS. In each, every block takes another share of the positions of its training texts, every ROUNDS-th
    one, and tasks descend from the same parameters, block by block. Each vector becomes the mean of the tasks' results, weighted by how
    often they used it; it is summed in PIECES of rows, so no task holds more than its piece. Together the rounds take every training
    position once, whatever the size of the table, so the work grows with the corpus.
4.  Every block is scored with its counts.

SIZE, CONTEXT, BATCH, NOISE, GROUP_NOISE and RATE were chosen by what a seventh of the learning rows of a small table scored when the
others trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import ASCII_LOWER, remainder, shuffle_parts, text_buffer, text_slices, words, written

MODEL_WORDS = 12_288
GROUP_WORDS = 128
RARE = 32
SIZE = 16
CONTEXT = 3
ROUNDS = 3
BATCH = 2048
#: Noise of a batch for classes, of each word for its group, and the shares of a group's noise in so many slots.
NOISE, GROUP_NOISE, SLOTS = 32, 3, 1024
RATE = 0.25
PIECES = 32
BLOCK_BYTES = 6 << 20
#: The hash that stands for the end of a text.
END = np.uint64(0x5DEECE66D1234567)


# --- the model -------------------------------------------------------------------------------------------------------


class Vocabulary:
    """The model's words, by rank: word r is in group r mod groups. Classes are the groups, then the RARE classes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, rare_tokens: np.ndarray, rare_kinds: np.ndarray):
        self.size = len(hashes)
        self.counts = counts.astype(np.int64)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        self.groups = max(1, -(-self.size // GROUP_WORDS))
        self.rare_tokens, self.rare_kinds = rare_tokens, rare_kinds
        self.nothing = self.size + RARE  # what lies before a text
        self.class_of = np.concatenate([np.arange(self.size) % self.groups, self.groups + np.arange(RARE)]).astype(np.int32)
        of_group = np.maximum(np.bincount(self.class_of[: self.size], counts, self.groups), 1e-9)
        share = np.concatenate([of_group, np.maximum(rare_tokens, 0.5)])
        self.class_share = share / share.sum()
        self.share = counts / of_group[self.class_of[: self.size]]
        #: Noise words by slot, so that drawing one is one look-up; every word has a slot.
        self.slot = np.zeros((self.groups, SLOTS), np.int32)
        self.log_noise = np.zeros(self.size, np.float32)
        for g in range(self.groups):
            own = np.arange(g, self.size, self.groups)
            if len(own):
                n = np.maximum(1, np.floor(self.share[own] * SLOTS)).astype(np.int64)
                for k in np.argsort(-n, kind="stable"):  # the largest take what is over or missing
                    n[k] = max(1, n[k] + SLOTS - n.sum())
                    if n.sum() == SLOTS:
                        break
                self.slot[g] = np.repeat(own, n)
                self.log_noise[own] = np.log(n / SLOTS)

    def ids(self, lexicon: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Model numbers of a block's words: ranks, or the size and their rare class."""
        if not self.size:
            return kind.astype(np.int32)
        at = np.minimum(np.searchsorted(self.hashes, lexicon), self.size - 1)
        return np.where(self.hashes[at] == lexicon, self.number[at], self.size + kind.astype(np.int64)).astype(np.int32)


@dataclass
class Parameters:
    """Vectors of context words (the rare classes and, last, of what lies before a text), of words and classes with their bias, place diagonals."""

    context: np.ndarray
    word: np.ndarray
    klass: np.ndarray
    place: np.ndarray

    @classmethod
    def start(cls, v: Vocabulary) -> Parameters:
        rng = np.random.default_rng(3)

        def near_zero(n: int, bias: np.ndarray | None = None) -> np.ndarray:
            x = (rng.normal(size=(n, SIZE)) * 0.1).astype(np.float32)
            return x if bias is None else np.hstack([x, np.log(bias)[:, None].astype(np.float32)])

        return cls(near_zero(v.nothing + 1), near_zero(v.size, v.share), near_zero(v.groups + RARE, v.class_share), np.full((CONTEXT, SIZE), 0.5, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.word, self.klass, self.place]

    def rows(self) -> np.ndarray:
        """All vectors as one matrix of SIZE + 1 columns."""
        return np.concatenate([np.pad(x, ((0, 0), (0, SIZE + 1 - x.shape[1]))) for x in self.parts()])

    @classmethod
    def of(cls, rows: np.ndarray, v: Vocabulary) -> Parameters:
        a, b, c, d = np.split(rows.astype(np.float32), np.cumsum([v.nothing + 1, v.size, v.groups + RARE]))
        return cls(a[:, :SIZE].copy(), b, c, d[:, :SIZE].copy())

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """The predicted vectors, and 1 for the bias."""
        out = np.ones((len(before), SIZE + 1), np.float32)
        np.multiply(self.context[before[:, 0]], self.place[0], out=out[:, :SIZE])
        for k in range(1, CONTEXT):
            out[:, :SIZE] += self.context[before[:, k]] * self.place[k]
        return out


def _log_softmax(h: np.ndarray, outputs: np.ndarray, own: np.ndarray) -> np.ndarray:
    """ln of the normalised probability of each row's own output; outputs are columns."""
    score = h @ outputs
    mine = score[np.arange(len(own)), own].astype(np.float64)
    if float(score.max()) > 60 or float(mine.min()) < -60:  # shifted only where exp() could overflow
        top = score.max(1)
        score -= top[:, None]
        mine -= top
    np.exp(score, out=score)
    return mine - np.log((score @ np.ones(score.shape[1], np.float32)).astype(np.float64))


class Scorer:
    """Normalised log-probabilities with one set of parameters."""

    def __init__(self, p: Parameters, v: Vocabulary):
        self.p, self.v = p, v
        self.classes = np.ascontiguousarray(p.klass.T)
        self.words = [np.ascontiguousarray(p.word[g :: v.groups].T) for g in range(v.groups)]

    def log_probabilities(self, before: np.ndarray, word: np.ndarray, step: int = 4096) -> np.ndarray:
        """ln P(word | before) of the model's words, of a rare word that of its class."""
        v = self.v
        out = np.empty(len(word))
        h = self.p.predicted(before)
        of = v.class_of[word]
        for i in range(0, len(word), step):
            out[i : i + step] = _log_softmax(h[i : i + step], self.classes, of[i : i + step])
        order = np.argsort(of.astype(np.uint16), kind="stable")
        cut = np.searchsorted(of[order], np.arange(v.groups + 1))
        for g in range(v.groups):
            for i in range(cut[g], cut[g + 1], step):
                at = order[i : min(i + step, cut[g + 1])]
                out[at] += _log_softmax(h[at], self.words[g], word[at] // v.groups)
        return out


def contexts(ids: np.ndarray, at: np.ndarray, first: np.ndarray, nothing: int) -> np.ndarray:
    """The CONTEXT ids before each of the places ``at``, nearest first; ``first``: where the text of each begins."""
    near = at[:, None] - 1 - np.arange(CONTEXT)
    return np.where(near >= first[:, None], ids[np.maximum(near, 0)], nothing).astype(np.int32)


def share_of(usable: np.ndarray, turn: int) -> np.ndarray:
    """The training positions of one round: disjoint from those of the others, all of them together."""
    return usable[turn::ROUNDS]


def _summed(rows: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different rows, sums of the vectors x by row, how many each has)."""
    order = np.argsort(rows.astype(np.uint16) if len(rows) and rows.max() < 1 << 16 else rows, kind="stable")
    sorted_ = rows[order]
    cut = np.flatnonzero(np.diff(sorted_, prepend=-1))
    return sorted_[cut], np.add.reduceat(x[order], cut, axis=0) if len(cut) else x[:0], np.diff(np.append(cut, len(rows)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Descent:
    """Noise-contrastive steps (Adagrad) from given parameters; counts how often each vector was used."""

    def __init__(self, p: Parameters, v: Vocabulary):
        self.v, self.p = v, Parameters(*(x.copy() for x in p.parts()))
        self.grown = [np.full(x.shape, 1e-3, np.float32) for x in p.parts()]
        self.used = [np.zeros(len(x), np.float32) for x in p.parts()]
        self.cdf = np.cumsum(v.class_share)
        self.class_noise = (np.log(v.class_share) + np.log(NOISE)).astype(np.float32)
        self.word_noise = v.log_noise + np.float32(np.log(GROUP_NOISE))

    def learn(self, before: np.ndarray, word: np.ndarray, seed: int) -> None:
        """Every given position once, in a shuffled order: its class is told from NOISE drawn classes, its word from GROUP_NOISE words of the group."""
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(word))
        before, word = before[order], word[order]
        for i in range(0, len(word), BATCH):
            self._batch(before[i : i + BATCH], word[i : i + BATCH], rng)

    def _batch(self, ctx: np.ndarray, word: np.ndarray, rng: np.random.Generator) -> None:
        p, v = self.p, self.v
        vectors = p.context[ctx]
        h = np.ones((len(word), SIZE + 1), np.float32)
        np.sum(vectors * p.place, 1, out=h[:, :SIZE])
        # Classes: the noise is shared by the batch.
        own = v.class_of[word]
        noise = np.minimum(np.searchsorted(self.cdf, rng.random(NOISE)), len(self.cdf) - 1)
        q, z = p.klass[own], p.klass[noise]
        up = _logistic(self.class_noise[own] - (h * q).sum(1))
        down = -_logistic(h @ z.T - self.class_noise[noise])
        back = up[:, None] * q + down @ z
        rows, sums, n = _summed(np.concatenate([own, noise]), np.concatenate([up[:, None] * h, down.T @ h]))
        steps = [(2, rows, sums, n)]
        # Words: each has noise of its own group.
        some = np.flatnonzero(word < v.size)
        if len(some):
            both = np.empty((len(some), GROUP_NOISE + 1), np.int32)
            both[:, 0] = word[some]
            both[:, 1:] = v.slot[own[some][:, None], rng.integers(0, SLOTS, (len(some), GROUP_NOISE), dtype=np.int32)]
            hs, outputs = h[some], p.word[both]
            off = -_logistic((outputs @ hs[:, :, None])[:, :, 0] - self.word_noise[both])
            off[:, 0] += 1
            back[some] += (off[:, None, :] @ outputs)[:, 0]
            steps.append((1, *_summed(both.ravel(), (off[:, :, None] * hs[:, None, :]).reshape(-1, SIZE + 1))))
        back = back[:, :SIZE]
        steps.append((0, *_summed(ctx.ravel(), (back[:, None, :] * p.place).reshape(-1, SIZE))))
        steps.append((3, np.arange(CONTEXT), (vectors * back[:, None, :]).sum(0), len(word)))
        scale = np.float32(len(word) ** -0.5)
        for k, rows, g, n in steps:
            x, grown = p.parts()[k], self.grown[k]
            g = g * scale
            total = grown[rows] + g * g
            grown[rows] = total
            x[rows] += np.float32(RATE) * g / np.sqrt(total)
            self.used[k][rows] += n


# --- blocks ----------------------------------------------------------------------------------------------------------


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _open(x: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x.as_buffer()), kind)


_CLASS = np.zeros(256, np.uint8)  # of a last letter: 0 for none
_CLASS[48:58] = 1
_CLASS[97:123] = np.arange(2, 28)
_CLASS[128:] = 28 + np.arange(128) % 4


def _classes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The class of each (lower-case) word: by its last letter, up to three signs may follow it."""
    at, out = end - 1, np.zeros(len(end), np.uint8)
    for _ in range(4):
        inside = at >= begin
        out = np.where((out == 0) & inside, _CLASS[buf[np.maximum(at, 0)]], out)
        at = at - 1
    return out


_BLOCK = "block long, doc_id array<long>, train array<boolean>, length array<int>, lexicon binary, class binary, seen binary, words binary"


def _blocks(docs: DataFrame) -> DataFrame:
    """lexicon: the block's words by hash, the end among them; seen: training counts; words: lexicon numbers, all texts in a row."""

    def run(batches):
        count = 0
        for batch in batches:
            text = batch.column("text")
            for i, j in text_slices(text, BLOCK_BYTES):
                buf, starts = text_buffer(text.slice(i, j - i))
                lower = ASCII_LOWER[buf]
                h, begin, end, doc = words(lower, starts)
                n = j - i
                at = np.searchsorted(doc, np.arange(1, n + 1))  # an end after each text
                h, kind = np.insert(h, at, END), np.insert(_classes(lower, begin, end) if len(h) else np.zeros(0, np.uint8), at, 0)
                length = np.diff(np.append(0, at)) + 1
                lexicon, one, local = np.unique(h, return_index=True, return_inverse=True)
                train = batch.column("train").slice(i, n).to_numpy(zero_copy_only=False).astype(bool)
                seen = np.bincount(local[np.repeat(train, length)], minlength=len(lexicon))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(TaskContext.get().partitionId() << 32) + count]), pa.array([batch.column("doc_id").slice(i, n).to_pylist()], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())), pa.array([length.astype(np.int32)], pa.list_(pa.int32()))]
                    + [pa.array([_pack(x)], pa.binary()) for x in (lexicon, kind[one], seen.astype("<u4"), local.astype("<u4"))],
                    ["block", "doc_id", "train", "length", "lexicon", "class", "seen", "words"],
                )
                count += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(remainder("doc_id", 5) != 1, F.lit(True)).alias("train"))
    return written(rows.mapInArrow(run, _BLOCK), "blocks")


def _counts(blocks: DataFrame) -> DataFrame:
    """word (hash), class and c (its count over all training texts) of every training word; tasks add up their blocks first."""

    def run(batches):
        held, n = [], 0

        def merged():
            word, kind, seen = (np.concatenate(x) for x in zip(*held, strict=True))
            every, one, at = np.unique(word, return_index=True, return_inverse=True)
            total = np.bincount(at, seen, len(every)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(kind[one].astype(np.int8)), pa.array(total)], ["word", "class", "seen"])

        for batch in batches:
            for k in range(len(batch)):
                word, kind, seen = (_open(batch.column(c)[k], t) for c, t in (("lexicon", "<u8"), ("class", "u1"), ("seen", "<u4")))
                some = seen > 0
                held.append((word[some], kind[some], seen[some]))
                n += int(some.sum())
                if n > 2_000_000:
                    yield merged()
                    held, n = [], 0
        if n:
            yield merged()

    rows = blocks.select("lexicon", "class", "seen").mapInArrow(run, "word long, class tinyint, seen long")
    return written(rows.groupBy("word").agg(F.min("class").alias("class"), F.sum("seen").alias("c")), "counts")


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int, int]:
    """(the most frequent words with the sums of the others, all training tokens, different words). The driver holds those words."""
    sums = counts.groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    rare, kinds = np.zeros(RARE, np.int64), np.zeros(RARE, np.int64)
    for r in sums:
        rare[r["class"]], kinds[r["class"]] = r["n"], r["v"]
    tokens, different = int(rare.sum()), int(kinds.sum())
    # Few words pass the least count that any of the chosen can have: eighths of powers of two, counted first.
    step = F.floor(F.log2("c") * 8)
    least, n = 0, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        least, n = r["step"], n + r["count"]
        if n >= MODEL_WORDS:
            break
    best = counts.where(step >= least).orderBy(F.desc("c"), "word").limit(MODEL_WORDS).collect()
    for r in best:
        rare[r["class"]] -= r["c"]
        kinds[r["class"]] -= 1
    return Vocabulary(np.array([r["word"] for r in best], np.int64).view(np.uint64), np.array([r["c"] for r in best], np.int64), rare, kinds), tokens, different


def _averaged(results: DataFrame, start: np.ndarray) -> np.ndarray:
    """start, moved by the mean of the tasks' changes, each row weighted by its uses; pieces of rows are summed apart."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        uses: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, change, used in zip(batch.column("piece").to_pylist(), batch.column("change"), batch.column("used"), strict=True):
                n = _open(used, "<f4").astype(np.float64)
                x = _open(change, "<f2").reshape(len(n), -1).astype(np.float64) * n[:, None]
                total[k], uses[k] = total.get(k, 0) + x, uses.get(k, 0) + n
        for k, x in total.items():
            mean = x / np.maximum(uses[k], 1)[:, None]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_pack(mean.astype("<f4"))], pa.binary())], ["piece", "mean"])

    rows = results.repartition(PIECES, "piece").mapInArrow(run, "piece int, mean binary").collect()
    out = start.copy()
    for r, at in ((r, np.array_split(np.arange(len(start)), PIECES)[r["piece"]]) for r in rows):
        out[at] += np.frombuffer(zstandard.decompress(bytes(r["mean"])), "<f4").reshape(len(at), -1)
    return out


def fit(blocks: DataFrame, v: Vocabulary) -> np.ndarray:
    """Trains on all blocks; returns the parameters' rows. The driver holds one set of parameters."""
    spark = blocks.sparkSession
    now = Parameters.start(v).rows()
    for turn in range(ROUNDS if v.size else 0):
        held = spark.sparkContext.broadcast((v, now, turn))

        def run(batches, held=held):
            v, rows, turn = held.value
            descent = Descent(Parameters.of(rows, v), v)
            for batch in batches:
                for k in range(len(batch)):
                    ids = v.ids(_open(batch.column("lexicon")[k], "<u8"), _open(batch.column("class")[k], "u1"))[_open(batch.column("words")[k], "<u4")]
                    length = np.array(batch.column("length")[k].as_py(), np.int64)
                    usable = np.flatnonzero(np.repeat(np.array(batch.column("train")[k].as_py(), bool), length))
                    pick = share_of(usable, turn)
                    first = np.repeat(np.cumsum(length) - length, length)[pick]
                    descent.learn(contexts(ids, pick, first, v.nothing), ids[pick], turn)
            used = np.concatenate(descent.used)
            if used.any():
                change = descent.p.rows() - rows
                pieces = [(_pack(change[at].astype("<f2")), _pack(used[at].astype("<f4"))) for at in np.array_split(np.arange(len(rows)), PIECES)]
                yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array([c for c, _ in pieces], pa.binary()), pa.array([n for _, n in pieces], pa.binary())], ["piece", "change", "used"])

        now = _averaged(blocks.select("train", "length", "lexicon", "class", "words").mapInArrow(run, "piece int, change binary, used binary"), now)
        held.unpersist()
    return now


def _sent_back(blocks: DataFrame, counts: DataFrame, held) -> DataFrame:
    """of (a block), at and c: the counts of lexicon entries that are no model words and differ from the block's own."""

    def entries(batches):
        v = held.value[0]
        for batch in batches:
            for k, block in enumerate(batch.column("block").to_pylist()):
                lexicon, own = _open(batch.column("lexicon")[k], "<u8"), _open(batch.column("seen")[k], "<u4")
                at = np.flatnonzero(v.ids(lexicon, np.zeros(len(lexicon), np.uint8)) >= v.size)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(at.astype(np.int32)), pa.array(lexicon[at].view(np.int64)), pa.array(own[at].astype(np.int64))], ["block", "at", "word", "own"])

    def packed(batches):
        now, held_at, held_c = None, [], []

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([_pack(np.concatenate(held_at))], pa.binary()), pa.array([_pack(np.concatenate(held_c).astype("<i8"))], pa.binary())], ["of", "at", "c"])

        for batch in batches:
            block, at, c = (batch.column(x).to_numpy() for x in ("block", "at", "c"))
            cut = np.flatnonzero(np.diff(block)) + 1 if len(block) else []
            for i, j in zip(np.append(0, cut).astype(int), np.append(cut, len(block)).astype(int), strict=True):
                if i < j:
                    if held_at and block[i] != now:
                        yield row()
                        held_at, held_c = [], []
                    now = int(block[i])
                    held_at.append(at[i:j])
                    held_c.append(c[i:j])
        if held_at:
            yield row()

    rows = blocks.select("block", "lexicon", "seen").mapInArrow(entries, "block long, at int, word long, own long")
    other = rows.hint("merge").join(counts.select("word", "c"), "word").where("c != own").select("block", "at", "c")
    dealt = other.repartition(shuffle_parts(blocks.sparkSession), "block").sortWithinPartitions("block", "at")
    return dealt.mapInArrow(packed, "of long, at binary, c binary")


def _numbered(blocks: DataFrame, held) -> DataFrame:
    """blocks with the model's numbers of their words in place of the hashes, which would be much of what is sent."""

    def run(batches):
        v = held.value[0]
        for batch in batches:
            numbers = [_pack(v.ids(_open(x, "<u8"), _open(c, "u1"))) for x, c in zip(batch.column("lexicon"), batch.column("class"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(numbers, pa.binary())], [*keep, "numbers"])

    keep = ["block", "doc_id", "train", "length", "seen", "words"]
    return blocks.select(*keep, "lexicon", "class").mapInArrow(run, "block long, doc_id array<long>, train array<boolean>, length array<int>, seen binary, words binary, numbers binary")


def score(docs: DataFrame) -> DataFrame:
    """Scores every whole text of ``docs`` (doc_id, text, any more columns; null texts are empty).

    Learns from documents whose crc32(doc_id) mod 5 is not 1 (a null doc_id is one of them). Returns doc_id, held_out,
    n_tokens (words and the end), n_known (seen in training), train_tokens, base_score (the smoothed word-count model's log10
    probability) and score (this model's). Equal texts score alike; repeated rows are learned from as often as they occur. An
    empty table gives an empty one; without training documents every word is unseen.
    """
    blocks = _blocks(docs)
    counts = _counts(blocks)
    v, tokens, kinds = vocabulary(counts)
    rows = fit(blocks, v)
    held = docs.sparkSession.sparkContext.broadcast((v, rows, tokens, kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, rows, tokens, kinds = held.value
        scorer = Scorer(for_scoring(Parameters.of(rows, v), v), v)
        total = v.rare_tokens + 0.5 * (v.rare_kinds + 1)
        for batch in batches:
            for k in range(len(batch)):
                number, local = _open(batch.column("numbers")[k], "<i4"), _open(batch.column("words")[k], "<u4")
                c = _open(batch.column("seen")[k], "<u4").astype(np.int64)
                if batch.column("at")[k].is_valid:
                    c[_open(batch.column("at")[k], "<i4")] = _open(batch.column("c")[k], "<i8")
                plain = number < v.size
                c[plain] = v.counts[number[plain]]
                base = np.log10((c + 0.5) / (tokens + 0.5 * (kinds + 1)))
                within = np.where(plain, 0.0, np.log10((c + 0.5) / total[np.where(plain, 0, number - v.size)]))
                length = np.array(batch.column("length")[k].as_py(), np.int64)
                stop = np.cumsum(length)
                start = stop - length
                ids, first = number[local], np.repeat(start, length)
                value = within[local]
                for i in range(0, len(ids), 1 << 18):  # bounded memory for a very long text
                    at = np.arange(i, min(len(ids), i + (1 << 18)))
                    value[at] += scorer.log_probabilities(contexts(ids, at, first[at], v.nothing), ids[at]) / np.log(10)
                train = np.array(batch.column("train")[k].as_py(), bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("doc_id")[k].as_py(), pa.int64()), pa.array(~train), pa.array(length), pa.array(np.add.reduceat((c > 0)[local].astype(np.int64), start)), pa.array(np.full(len(length), tokens, np.int64)), pa.array(np.add.reduceat(base[local], start)), pa.array(np.add.reduceat(value, start))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    numbered = _numbered(blocks, held)
    found = numbered.hint("merge").join(_sent_back(blocks, counts, held), F.col("block") == F.col("of"), "left")
    rows_ = found.select("doc_id", "train", "length", "seen", "words", "numbers", "at", "c")
    return rows_.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def for_scoring(p: Parameters, v: Vocabulary) -> Parameters:
    """p with room for unseen words: the bias of each rare class is raised by their share of it."""
    p.klass[v.groups :, SIZE] += np.log((v.rare_tokens + 0.5 * (v.rare_kinds + 1)) / np.maximum(v.rare_tokens, 0.5)).astype(np.float32)
    return p
