"""SentencePiece encoding with sampled segmentations, and lossless decoding."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landrank.llm.common import small_batches

#: The public vocabulary, its smoothing, and the seed of the segmentations.
MODEL, SMOOTHING, SEED = "/opt/tokenizers/piece_bpe_32k.model", 1.0, 9
#: Words up to this many characters are sampled together; a longer one is sampled by itself.
TOGETHER = 40
#: Weight of a character that the vocabulary lacks.
LACKING = 1e-6
SPACE, ESCAPED = 0x2581, 0x110000
#: Probabilities are multiples of 1 / ONE, so that they add up exactly in any order.
ONE = float(1 << 30)
#: States of lattices that a worker keeps from batch to batch, and characters that it segments at a time, about.
KEPT, AT_ONCE = 400_000, 700_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a SentencePiece model for look-up by rolling hash, with Zipf weights by their place in the model."""

    def __init__(self, path: str, smoothing: float = SMOOTHING) -> None:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.bytes0 = next(i for i in range(n) if m.is_byte(i))
        self.piece = [b""] * n
        ids = []
        for i in range(n):
            if m.is_byte(i):
                self.piece[i] = bytes([int(m.id_to_piece(i)[3:5], 16)])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                self.piece[i] = m.id_to_piece(i).replace(chr(SPACE), " ").encode()
                ids.append(i)
        rank = np.arange(len(ids)) + 100.0
        weight = rank ** -smoothing
        self.weight = dict(zip(ids, (weight / weight.sum()).tolist(), strict=True))
        self.by_text = {m.id_to_piece(i): i for i in ids}
        self.longest = max(map(len, self.by_text))
        self.tables, self.filter = {}, np.zeros(1 << 20, bool)
        for size in range(1, self.longest + 1):
            own = [(t, i) for t, i in self.by_text.items() if len(t) == size]
            if own:
                h = self.hashes(np.array([[ord(c) for c in t] for t, _ in own], np.uint64))
                order = np.argsort(h)
                self.filter[(h >> _U(44)).astype(np.int64)] = True
                self.tables[size] = (h[order], np.array([i for _, i in own], np.int32)[order], np.array([self.weight[i] for _, i in own])[order])

    @staticmethod
    def hashes(codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), _U)
        for k in range(codes.shape[1]):
            out = out * _BASE + (codes[:, k] + _U(1))
        return out

    def lacking(self, code: int) -> list[int]:
        text = chr(SPACE if code == ESCAPED else code).encode("utf-8", "surrogatepass")
        return [self.bytes0 + b for b in text]


def codes_of(word: str) -> list[int]:
    """The word's characters behind a space mark; a space mark of its own is set apart, and later spelled by bytes."""
    return [SPACE, *(ESCAPED if c == "▁" else ord(c) for c in word)]


def all_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """codes_of() of all words, one after the other, and their lengths."""
    length = np.fromiter(map(len, words), np.int64, len(words)) + 1
    flat = np.frombuffer(("▁" + "▁".join(words)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    mark = flat == SPACE
    mark[np.cumsum(length) - length] = False
    flat[mark] = ESCAPED
    return flat, length


def uniforms(key: np.ndarray, step: np.ndarray) -> np.ndarray:
    """A number in [0, 1), a multiple of 1 / ONE, for each pair of a key and a step."""
    x = key + (step.astype(_U) + _U(1)) * _BASE
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return ((x ^ (x >> _U(31))) >> _U(34)).astype(np.float64) / ONE


def lattices(flat: np.ndarray, length: np.ndarray, v: Vocabulary) -> tuple:
    """The lattices of all words, as one table of states (word, end) and arcs.

    Returns the first state of each word and, sorted by state + cumulated probability, each arc's key, piece (negative:
    a character that is spelled by bytes) and state before; and the first arc of each state.
    """
    n = len(flat)
    length = length.astype(np.int32)
    base = np.cumsum(length + 1, dtype=np.int32) - (length + 1)
    word = np.repeat(np.arange(len(length), dtype=np.int32), length)
    left = np.cumsum(length, dtype=np.int32)[word] - np.arange(n, dtype=np.int32)  # characters from here to the word's end
    at, h = np.arange(n, dtype=np.int32), np.zeros(n, _U)
    single = np.zeros(n, bool)
    places, sizes, pieces, weights = [], [], [], []
    for size in range(1, v.longest + 1):
        if size > 1:
            more = left[at] >= size
            at, h = at[more], h[more]
        if not len(at):
            break
        h = h * _BASE + (flat[at + size - 1].astype(_U) + _U(1))
        if size not in v.tables:
            continue
        keys, ids, weight = v.tables[size]
        may = np.nonzero(v.filter[(h >> _U(44)).astype(np.int64)])[0]
        k = np.minimum(np.searchsorted(keys, h[may]), len(keys) - 1)
        hit = keys[k] == h[may]
        spot = at[may[hit]]
        if size == 1:
            single[spot] = True
        places.append(spot)
        sizes.append(np.full(len(spot), size, np.int32))
        pieces.append(ids[k[hit]])
        weights.append(weight[k[hit]])
    spot = np.nonzero(~single)[0].astype(np.int32)
    places.append(spot)
    sizes.append(np.ones(len(spot), np.int32))
    # an ASCII character is one byte and so one piece
    pieces.append(np.where(flat[spot] < 128, v.bytes0 + flat[spot], -flat[spot] - 1).astype(np.int32))
    weights.append(np.full(len(spot), LACKING))
    place, size, piece, w = (np.concatenate(x) for x in (places, sizes, pieces, weights))
    before = place + word[place]  # a word has a state more than characters
    state = before + size
    order = np.argsort(state, kind="stable")
    state, before, piece, w = state[order], before[order], piece[order], w[order]
    first = np.searchsorted(state, np.arange(n + len(length) + 1))
    forward = np.zeros(n + len(length))
    forward[base] = 1
    end = (state - base[word[place[order]]]).astype(np.int16)
    by_end = np.argsort(end, kind="stable").astype(np.int32)
    cuts = np.searchsorted(end[by_end], np.arange(1, int(end.max()) + 2))
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        mine = by_end[s:e]
        w[mine] *= forward[before[mine]]
        own = state[mine]
        lead = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        forward[own[lead]] = np.add.reduceat(w[mine], lead)
    total = np.cumsum((w / forward[state] * ONE).astype(np.int64))
    start = np.concatenate([[0], total])[first[state]]
    return base, state + np.minimum(total - start, int(ONE) - 1) / ONE, piece, before, first.astype(np.int32)


class Lattices:
    """Lattices of words that a worker has met, kept as far as there is room."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.tables: list[tuple] = []

    def of(self, words: list[str], v: Vocabulary) -> list[tuple]:
        """Tables (numbers of the words in them or -1, first states, lengths and what lattices() returns) for all words."""
        held = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        fresh = np.nonzero(held < 0)[0]
        out = []
        for k, table in enumerate(self.tables):
            out.append((np.where(held >> 32 == k, held & 0xFFFFFFFF, -1), *table))
        if len(fresh):
            new = [words[i] for i in fresh.tolist()]
            codes, length = all_codes(new)
            base, *rest = lattices(codes, length, v)
            local = np.full(len(words), -1, np.int64)
            local[fresh] = np.arange(len(fresh))
            out.append((local, base, length, *rest))
            if sum(len(t[-1]) for t in self.tables) < KEPT and len(self.tables) < 4:
                mark = len(self.tables) << 32
                self.number.update(zip(new, range(mark, mark + len(new)), strict=True))
                self.tables.append((base, length, *rest))
        return out


def alone(codes: list[int], v: Vocabulary, key: int) -> list[int]:
    """One segmentation of a long word, by logarithms; memory is linear in its length."""
    text = "".join(chr(c) if c < ESCAPED else "\x00" for c in codes)
    n, score = len(codes), [0.0] + [-math.inf] * len(codes)
    arcs: list[list[tuple[float, int, int]]] = [[] for _ in range(n + 1)]
    for end in range(1, n + 1):
        for size in range(1, min(end, v.longest) + 1):
            i = v.by_text.get(text[end - size:end]) if codes[end - 1] != ESCAPED else None
            if i is not None:
                arcs[end].append((score[end - size] + math.log(v.weight[i]), size, i))
        if not any(size == 1 for _, size, _ in arcs[end]):
            arcs[end].append((score[end - 1] + math.log(LACKING), 1, -1))
        top = max(a[0] for a in arcs[end])
        score[end] = top + math.log(sum(math.exp(a[0] - top) for a in arcs[end]))
    out: list[list[int]] = []
    at = n
    u = uniforms(np.full(n, key, _U), np.arange(n))
    while at:
        x = u[len(out)]
        for s, size, i in arcs[at]:
            x -= math.exp(s - score[at])
            if x < 0:
                break
        out.append([i] if i >= 0 else v.lacking(codes[at - 1]))
        at -= size
    return [i for part in reversed(out) for i in part]


def sampled(texts: list, keys: list[int], v: Vocabulary, kept: Lattices | None = None) -> list[np.ndarray]:
    """Piece ids of each text: forward filtering over each different word's lattice, backward sampling for each word.

    The draws of the j-th word of a text depend on the text's key and j alone.
    """
    kept = kept or Lattices()
    split = [text.split(" ") if text else [] for text in texts]
    flat = [w for own in split for w in own]
    if not flat:
        return [np.empty(0, np.int32) for _ in texts]
    words = list(dict.fromkeys(flat))
    number = dict(zip(words, range(len(words)), strict=True))
    word = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    n_words = np.fromiter(map(len, split), np.int64, len(split))
    doc = np.repeat(np.arange(len(texts)), n_words)
    place = np.arange(len(flat)) - (np.cumsum(n_words) - n_words)[doc]
    key = np.array(keys, _U)[doc] + place.astype(_U) * _U(0xD1B54A32D192ED03)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    found_at, found_rank, found_id = [], [], []
    some = np.nonzero(size <= TOGETHER + 1)[0]
    order = np.argsort(word, kind="stable")  # equal words follow each other, so that look-ups stay close
    for held, base, length, cum, piece, before, first in kept.of([words[i] for i in some.tolist()] if len(some) < len(words) else words, v):
        local = np.full(len(words), -1)
        local[some] = held
        mine = local[word[order]]
        occ, mine = order[mine >= 0], mine[mine >= 0]
        start = base[mine]
        state, step = start + length[mine], 0
        while len(occ):
            arc = np.searchsorted(cum, state + uniforms(key[occ], np.full(len(occ), step)), side="right")
            arc = np.clip(arc, first[state], first[state + 1] - 1)
            found_at.append(occ)
            found_rank.append(np.full(len(occ), step, np.int16))
            found_id.append(piece[arc].astype(np.int64))
            state = before[arc]
            go = state > start
            occ, state, start = occ[go], state[go], start[go]
            step += 1
    longer: dict[int, list[int]] = {}
    for i in np.nonzero(size[word] > TOGETHER + 1)[0].tolist():
        longer[i] = alone(codes_of(words[word[i]]), v, int(key[i]))
        n = len(longer[i])
        found_at.append(np.full(n, i))
        found_rank.append(np.arange(n)[::-1])
        found_id.append(np.array(longer[i], np.int64))
    at, rank, ids = np.concatenate(found_at), np.concatenate(found_rank), np.concatenate(found_id)
    order = np.argsort(at * (int(rank.max()) + 1) - rank.astype(np.int64), kind="stable")
    at, ids = at[order], ids[order]
    ends = np.searchsorted(doc[at], np.arange(len(texts)), side="right")
    out = []
    for s, e in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
        own = ids[s:e]
        if len(own) and own.min() < 0:
            own = np.array([x for i in own.tolist() for x in ([i] if i >= 0 else v.lacking(-i - 1))], np.int64)
        out.append(own.astype(np.int32))
    return out


def decoded(ids, v: Vocabulary) -> str:
    """The text of piece ids: every word was given a space in front, so the first is dropped."""
    return b"".join(map(v.piece.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


_held: dict = {}


def vocabulary(path: str, smoothing: float) -> Vocabulary:
    """One for each Python worker, from the file as Spark has sent it or, outside of tasks, from its own place."""
    if (path, smoothing) not in _held:
        from pyspark import SparkFiles, TaskContext

        _held[path, smoothing] = Vocabulary(SparkFiles.get(os.path.basename(path)) if TaskContext.get() else path, smoothing)
    return _held[path, smoothing]


def sent(spark: SparkSession, path: str) -> None:
    """Has Spark send the model's file to the executors, which may not have it."""
    spark.sparkContext.addFile(path)


def encode(docs: DataFrame, model: str = MODEL, smoothing: float = SMOOTHING, seed: int = SEED) -> DataFrame:
    """docs with `ids`, a sampled segmentation of the whole text; the same seed and doc_id give the same one again.

    A text is cut at its spaces; each part gets a space in front and is segmented by itself with probability
    proportional to the product of its pieces' weights.  Characters that the vocabulary lacks, and space marks of the
    text's own, are spelled in byte pieces.  Null and empty texts have no ids; very long ones are segmented whole; a null doc_id is a key like any other;
    rows that repeat get the same ids; an `ids` column of docs is replaced; no rows give no rows.
    """
    small_batches(docs.sparkSession, 400)
    sent(docs.sparkSession, model)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def segmented(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        v, kept = vocabulary(model, smoothing), Lattices()
        for doc_ids, texts in batches:
            keys = [xxhash.xxh64_intdigest(d, seed=seed) for d in doc_ids]
            block = (texts.str.len().fillna(0).cumsum() // AT_ONCE).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)] if len(texts) else [0]
            texts, out = list(texts), []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                out += sampled(texts[s:e], keys[s:e], v, kept)
            yield pd.Series(out, dtype=object)

    return docs.drop("ids").withColumn("ids", segmented(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text"))


def decode(coded: DataFrame, model: str = MODEL) -> DataFrame:
    """coded with `decoded`, the text that its ids spell: the text that was encoded, or empty if that was null.

    A `decoded` column of coded is replaced; no rows give no rows.
    """
    sent(coded.sparkSession, model)

    @F.pandas_udf(T.StringType())
    def spelled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(model, SMOOTHING)
        for ids in batches:
            yield pd.Series([decoded(x.tolist(), v) for x in ids], dtype=object)

    return coded.drop("decoded").withColumn("decoded", spelled("ids"))
