"""Hidden Markov language model.

Latent states emit classes of words (``CLASSES`` of them, by the hash of the
word) and a class emits its words by their share of its training tokens; what
the words that occur once make up of all tokens goes to unknown words
(Good-Turing).  Baum-Welch: every task runs forward and backward over its
blocks and sums the expected counts; Spark adds the sums up, in two steps, so
that the driver gets one row per state.  Texts are scored by the scaled forward
recursion over the whole text, all documents of a block side by side.

Texts are encoded once into blocks (token numbers, and the ascending hashes of
the block's words with their training counts), bucketed by block.  Counts of
the whole corpus are made range by range of the hashes and come back to the
blocks that have the words; no dictionary of the corpus is sent anywhere.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import (
    Scratch, batch, prepare, release, shards, sorted_ranges, text_column, texts,
)
from docengine.llm.near_duplicates import Shingler

STATES = 8
CLASSES = 1 << 14
ITERATIONS = 6
SEGMENT = 512            # training runs over segments of so many tokens, scoring over whole texts
BLOCK = 4 << 20          # bytes of text in a block, but for longer documents
WORDS_A_RANGE = 1 << 20
STICKY = 0.9             # first chance to stay in a state
SMOOTHING = 50.0         # tokens' worth of the corpus' class shares in every state's emissions

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b""               # no word is empty


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("held", pa.list_(pa.bool_())), ("codes", pa.binary()), ("words", pa.binary()),
                    ("train", pa.binary()), ("n_words", pa.int64())])
BLOCKS = ("block long, doc_ids array<long>, lengths array<long>, held array<boolean>, codes binary, words binary, "
          "train binary, n_words long")


def encode_blocks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks of encoded documents; where a document goes is where it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, shingler = TaskContext.get().partitionId() << 32, Shingler()
        ids, tokens, held = [], [], 0

        def block():
            values = np.concatenate(tokens)
            lengths = np.array([len(t) for t in tokens])
            words, codes = np.unique(values, return_inverse=True)
            out = np.array([held_out(i) for i in ids])
            train = np.bincount(codes[~np.repeat(out, lengths)], minlength=len(words))
            return batch({"block": [number], "doc_ids": [ids], "lengths": [lengths], "held": [out],
                          "codes": [codes.astype("<u4").tobytes()], "words": [words.astype("<u8").tobytes()],
                          "train": [train.astype("<u4").tobytes()], "n_words": [len(words)]}, _BLOCK)

        for b in batches:
            for doc_id, text in zip(text_column(b, "doc_id"), text_column(b)):
                if held >= BLOCK:
                    yield block()
                    number, ids, tokens, held = number + 1, [], [], 0
                body = text.encode("utf-8", "surrogatepass")
                ids.append(doc_id)
                tokens.append(shingler.word_values([*body.translate(_LOWER).split(), _END]))
                held += len(body)
        if ids:
            yield block()

    return scratch.bucketed(texts(docs).mapInArrow(run, BLOCKS), "blocks", "block", shards(docs.sparkSession))


@dataclass
class Block:
    doc_ids: list
    lengths: np.ndarray
    held: np.ndarray
    codes: np.ndarray
    words: np.ndarray
    train: np.ndarray

    @property
    def classes(self) -> np.ndarray:
        """Class of each of the block's words."""
        return (self.words & np.uint64(CLASSES - 1)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for b in batches:
        for i in range(b.num_rows):
            r = {f.name: b.column(k)[i].as_py() for k, f in enumerate(b.schema)}
            yield r, Block(r["doc_ids"], np.array(r["lengths"], np.int64), np.array(r["held"], bool),
                           np.frombuffer(r["codes"], "<u4"), np.frombuffer(r["words"], "<u8"),
                           np.frombuffer(r["train"], "<u4"))


_SENT = pa.schema([("range", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("train", pa.binary())])
COUNTS = "range long, block long, counts binary, distinct long, once long"


def corpus_counts(blocks: DataFrame, bits: int) -> DataFrame:
    """(range, block, counts): training tokens of the corpus for each word of a block, by range of hashes.

    distinct and once are the range's words with training tokens, and with one.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                words, train = (np.frombuffer(b.column(c)[k].as_py(), d) for c, d in ((1, "<u8"), (2, "<u4")))
                cut = list(sorted_ranges(words, 64 - bits))
                yield batch({"range": [r for r, _, _ in cut], "block": [b.column(0)[k].as_py()] * len(cut),
                             "words": [words[a:z].tobytes() for _, a, z in cut],
                             "train": [train[a:z].tobytes() for _, a, z in cut]}, _SENT)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        arrays = [np.frombuffer(w, "<u8") for w in pdf["words"]]
        train = np.concatenate([np.frombuffer(t, "<u4") for t in pdf["train"]])
        words, back = np.unique(np.concatenate(arrays), return_inverse=True)
        total = np.bincount(back, train, len(words)).astype("<i8")
        parts = np.split(total[back], np.cumsum([len(a) for a in arrays])[:-1])
        first = np.arange(len(pdf)) == 0
        return pd.DataFrame({"range": pdf["range"].to_numpy(), "block": pdf["block"].to_numpy(),
                             "counts": [p.tobytes() for p in parts],
                             "distinct": np.where(first, (total > 0).sum(), 0),
                             "once": np.where(first, (total == 1).sum(), 0)})

    sent = blocks.select("block", "words", "train").mapInArrow(
        send, "range long, block long, words binary, train binary")
    return sent.groupBy("range").applyInPandas(add, COUNTS)


@dataclass
class Model:
    start: np.ndarray       # states
    move: np.ndarray        # states x states
    emit: np.ndarray        # (classes + 1) x states; the last row, of unknown words, holds ones
    class_tokens: np.ndarray


def first_model(class_tokens: np.ndarray, states: int) -> Model:
    """Class shares of the corpus, shaken so that states can part."""
    draw = np.random.Generator(np.random.PCG64(9))
    emit = (class_tokens[:, None] + 1e-9) * (0.25 + draw.random((len(class_tokens), states)))
    move = np.full((states, states), (1 - STICKY) / max(states - 1, 1))
    np.fill_diagonal(move, STICKY if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, _with_unknown(emit / emit.sum(axis=0)), class_tokens)


def _with_unknown(emit: np.ndarray) -> np.ndarray:
    return np.vstack([emit, np.ones(emit.shape[1])])


class Lockstep:
    """Sequences of a block side by side, longest first: step t holds token t of those that have one."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        self.starts, lengths = starts[self.order], lengths[self.order]
        steps = int(lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])

    def forward(self, model: Model, codes: np.ndarray, keep: bool = False):
        """Logarithms (base 10) of the scales' products by sequence; with ``keep`` also all states' shares, scales and emissions."""
        total = np.zeros(len(self.starts))
        size = self.offsets[-1] if keep else 0
        shares = np.empty((size, len(model.start)))
        scales, seen = np.empty(size), np.empty((size, len(model.start)))
        now = None
        for t, n in enumerate(self.active):
            emitted = model.emit[codes[self.starts[:n] + t]]
            now = emitted * (model.start if t == 0 else now[:n] @ model.move)
            scale = np.maximum(now.sum(axis=1), 1e-300)
            now /= scale[:, None]
            total[:n] += np.log10(scale)
            if keep:
                at = slice(self.offsets[t], self.offsets[t + 1])
                shares[at], scales[at], seen[at] = now, scale, emitted
        return total, shares, scales, seen

    def expected(self, model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected first states, moves and emissions (classes x states), and the log10 likelihood."""
        total, shares, scales, seen = self.forward(model, codes, keep=True)
        states = len(model.start)
        moves = np.zeros((states, states))
        back = None
        for t in range(len(self.active) - 1, -1, -1):
            at = slice(self.offsets[t], self.offsets[t + 1])
            n = self.active[t]
            own = np.ones((n, states))
            if back is not None:
                m = len(back)
                moves += shares[at][:m].T @ back
                own[:m] = back @ model.move.T
            # What the next step back needs: emission and what follows, over the scale.
            back = seen[at] * own / scales[at][:, None]
            shares[at] *= own  # from here on the chances of the states given the whole sequence
        tokens = np.concatenate([codes[self.starts[:n] + t] for t, n in enumerate(self.active)]) if len(self.active) else codes[:0]
        emitted = np.stack([np.bincount(tokens, shares[:, k], CLASSES + 1)[:CLASSES] for k in range(states)], axis=1)
        first = shares[:self.offsets[1]].sum(axis=0) if len(self.active) else np.zeros(states)
        return first, moves * model.move, emitted, float(total.sum())


def _segments(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the training segments of a block."""
    ends = np.cumsum(block.lengths)
    starts, lengths = [], []
    for end, n in zip(ends[~block.held], block.lengths[~block.held]):
        at = np.arange(end - n, end, SEGMENT)
        starts.append(at)
        lengths.append(np.minimum(SEGMENT, end - at))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(lengths)


_SUMS = pa.schema([("state", pa.int32()), ("salt", pa.int32()), ("values", pa.binary())])


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(v, "<f8") for v in pdf["values"]], axis=0)
    return pd.DataFrame({"state": pdf["state"].iloc[:1].to_numpy(), "salt": pdf["salt"].iloc[:1].to_numpy(),
                         "values": [total.tobytes()]})


def summed(partial: DataFrame) -> dict[int, np.ndarray]:
    """Sums by state: within salts, then over them; a row per state comes to the driver."""
    kind = "state int, salt int, values binary"
    once = partial.groupBy("state", "salt").applyInPandas(_added, kind)
    rows = once.withColumn("salt", F.lit(0)).groupBy("state").applyInPandas(_added, kind).collect()
    return {r["state"]: np.frombuffer(r["values"], "<f8") for r in rows}


def class_tokens(blocks: DataFrame, salts: int) -> np.ndarray:
    """Training tokens of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(CLASSES)
        for b in batches:
            for k in range(b.num_rows):
                words, train = (np.frombuffer(b.column(c)[k].as_py(), d) for c, d in ((0, "<u8"), (1, "<u4")))
                total += np.bincount((words & np.uint64(CLASSES - 1)).astype(np.int64), train, CLASSES)
        yield batch({"state": [0], "salt": [TaskContext.get().partitionId() % salts],
                     "values": [total.tobytes()]}, _SUMS)

    found = summed(blocks.select("words", "train").mapInArrow(run, "state int, salt int, values binary"))
    return found.get(0, np.zeros(CLASSES))


def trained(blocks: DataFrame, tokens: np.ndarray, states: int, iterations: int, salts: int) -> Model:
    """Baum-Welch over the training documents of the blocks."""
    model = first_model(tokens, states)
    shares = tokens / max(tokens.sum(), 1.0)
    for _ in range(iterations):
        current = model

        def run(batches: Iterator[pa.RecordBatch], current: Model = current) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            first, moves = np.zeros(states), np.zeros((states, states))
            emitted, likely = np.zeros((CLASSES, states)), 0.0
            for _, block in _blocks(batches):
                starts, lengths = _segments(block)
                found = Lockstep(starts, lengths).expected(current, block.classes[block.codes])
                first += found[0]
                moves += found[1]
                emitted += found[2]
                likely += found[3]
            salt = TaskContext.get().partitionId() % salts
            yield batch({"state": range(states), "salt": [salt] * states,
                         "values": [np.concatenate([[first[k]], moves[k], [likely], emitted[:, k]]).tobytes()
                                    for k in range(states)]}, _SUMS)

        sums = summed(blocks.select("doc_ids", "lengths", "held", "codes", "words", "train").mapInArrow(
            run, "state int, salt int, values binary"))
        if not sums or not tokens.sum():
            break
        rows = np.stack([sums[k] for k in range(states)])
        start = (rows[:, 0] + 1) / (rows[:, 0] + 1).sum()
        move = rows[:, 1:1 + states] + 1
        emit = (rows[:, 2 + states:] + SMOOTHING * shares).T
        model = Model(start, move / move.sum(axis=1, keepdims=True),
                      _with_unknown(emit / np.maximum(emit.sum(axis=0), 1e-300)), tokens)
    return model


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def scored(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows that are not held out; a null id is the empty
    string there.  A null or empty text is its end alone; repeated rows are
    learned from and scored each.  Without training tokens every token is
    unknown and has chance 1, as in the base score.
    """
    spark = prepare(docs.sparkSession)
    salts = shards(spark)
    scratch = Scratch(spark, "language-model")
    blocks = encode_blocks(docs, scratch)
    words = blocks.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    bits = (words // WORDS_A_RANGE).bit_length()
    counts = scratch.write(corpus_counts(blocks, bits), "counts")
    release(spark)
    kinds = counts.agg(F.sum("distinct").alias("v"), F.sum("once").alias("once")).first()
    distinct, once = kinds["v"] or 0, kinds["once"] or 0
    tokens = class_tokens(blocks, salts)
    total = int(tokens.sum())
    model = trained(blocks, tokens, states, iterations, salts)
    unknown = (once + 1) / (total + distinct + 1)  # of all tokens; the rest is shared by known words
    known = counts.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("range", "counts"))).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, block in _blocks(batches):
            count = np.concatenate([np.frombuffer(c["counts"], "<i8") for c in r["counts"]])
            classes = np.where(count > 0, block.classes, CLASSES)
            share = np.where(count > 0, (1 - unknown) * count / np.maximum(model.class_tokens[block.classes], 1), unknown)
            by_word = np.log10(np.maximum(share, 1e-300))
            base = np.log10((count + 1) / (total + distinct + 1))
            starts = np.cumsum(block.lengths) - block.lengths
            each = [np.add.reduceat(x[block.codes], starts) for x in (by_word, base, (count > 0).astype(np.int64))]
            steps = Lockstep(starts, block.lengths)
            score = np.empty(len(starts))
            score[steps.order] = steps.forward(model, classes[block.codes])[0]
            yield batch({"doc_id": r["doc_ids"], "held_out": r["held"], "n_tokens": block.lengths, "n_known": each[2],
                         "train_tokens": [total] * len(starts), "base_score": each[1], "score": score + each[0]}, _SCORES)

    return blocks.join(known.hint("shuffle_hash"), "block").mapInArrow(run, SCORES)
