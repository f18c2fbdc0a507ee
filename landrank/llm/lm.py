"""Language-model scores by online logistic context mixing over the bits of a two-level code of words."""

from __future__ import annotations

import heapq
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import small_batches, written
from landrank.llm.toxicity import fold

#: Words with a code of their own: SYMBOLS at least, one to WORDS_A_SYMBOL of the vocabulary, MOST_SYMBOLS at most; all
#: others are spelled, by a model that grows with the vocabulary.
SYMBOLS, WORDS_A_SYMBOL, MOST_SYMBOLS = 254, 64, 16_384
#: Latent classes of texts; words whose co-occurrence in all training documents makes them.
CLASSES, INDICATORS = 8, 254
#: Slots of the tables of word contexts as powers of 2: of the class, and of the words before, which get more with the
#: vocabulary up to the last; and of the tables of letter contexts.
CLASS_BITS, WORD_BITS, SPELL_BITS = 15, (20, 21), (18, 20, 20)
#: Tokens after which a text's own mixing weights are moved.
STEP = 128
#: Texts that are scored side by side.
TOGETHER = 32
#: Words that a task spells at a time, about; words whose counts and costs every task knows; slots of a block of a table.
SPELLED, COMMON, BLOCK_BITS = 20_000, 100_000, 16
#: Groups in which tasks' weights are added up.
GROUPS = 256
#: Steps of a stored logit to 1; prior count of each bit; rates of weights and of the maps; depths, places and levels of the gates; points of a map.
FINE, PRIOR, RATE, MAP_RATE, DEPTHS, PLACES, LEVELS, APM = 12, 0.4, 0.02, 0.02, 12, 12, 3, 17
#: Characters of the beginnings by which spelled words are put together, in turn as long as very many words share one.
BEGINNINGS = (3, 10, 24)

_U, _H = np.uint64, np.uint32
_B = _U(0x9E3779B97F4A7C15)
_SPREAD, _STIR = _H(0x9E3779B1), _H(0x85EBCA77)


def _at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """table[places], for places that are known to be in it."""
    return np.take(table, places, mode="clip")


def _logit(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))


def _whole(logit: np.ndarray) -> np.ndarray:
    """Logits in steps of 1 / FINE as bytes, so that tables stay in a core's cache."""
    return np.clip(np.round(logit * FINE), -127, 127).astype(np.int8)


def _logits(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    out = table[slots.astype(np.intp)].astype(np.float32)
    out *= np.float32(1 / FINE)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Code:
    """A Huffman code: the steps (node and bit) of all symbols one after the other."""

    def __init__(self, counts: np.ndarray) -> None:
        n = len(counts)
        heap = [(float(c), i, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        up: dict[int, tuple[int, int]] = {}
        for k in range(n - 1):
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            up[x], up[y] = (k, 0), (k, 1)
            heapq.heappush(heap, (a + b, n + k, n + k))
        paths = []
        for i in range(n):
            path, at = [], i
            while at in up:
                k, bit = up[at]
                path.append((k, bit))
                at = n + k
            paths.append(path[::-1])
        self.length = np.array(list(map(len, paths)), np.int32)
        self.start = (np.cumsum(self.length) - self.length).astype(np.int32)
        steps = np.array([s for p in paths for s in p], np.int64).reshape(-1, 2)
        self.node, self.bit = steps[:, 0].astype(_H) * _SPREAD, steps[:, 1].astype(np.float32)
        self.gate = np.minimum(np.arange(len(steps)) - np.repeat(self.start, self.length), DEPTHS - 1).astype(np.intp) * LEVELS

    def steps(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of steps of each symbol, and where they are in node, bit and depth."""
        n = _at(self.length, symbols)
        ends = np.cumsum(n, dtype=np.int32)
        at = np.arange(ends[-1] if len(n) else 0, dtype=np.int32)
        at += np.repeat(_at(self.start, symbols) - (ends - n), n)
        return n, at


def tokens(texts: list | pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all of them as bytes one after the other; A-Z lower-cased, null without words."""
    if isinstance(texts, pa.Array):
        whole = pc.fill_null(texts.cast(pa.large_string()), "")
    else:
        whole = pa.array([b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts], pa.large_binary()).view(pa.large_string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(whole))
    words, n = split.flatten(), np.diff(split.offsets.to_numpy())
    some = pc.greater(pc.binary_length(words), 0)  # before the first and after the last white space there is none
    doc = np.repeat(np.arange(len(texts)), n)[some.to_numpy(zero_copy_only=False)]
    return np.bincount(doc, minlength=len(texts)), words.filter(some).view(pa.large_binary())


class Lexicon(dict):
    """Numbers of words in the order in which a task meets them, and what a model knows of each.

    Words that the model or the task's rows know come first, so that of others only the hash is to be told.  The last entry
    of the arrays is the end of a text, whose number is -1.  Forgets all others when asked to, once they are many.
    """

    def __init__(self, model: Model, rows: dict | None = None) -> None:
        rows = rows or {}
        self.first = {w: i for i, w in enumerate(dict.fromkeys([*model.symbol, *model.indicator, *rows]))}
        self.other, self.end = (model.escape, len(model.indicator), 0, -1), (model.end, len(model.indicator), 0, -1)
        facts = [(model.symbol.get(w, model.escape), model.indicator.get(w, len(model.indicator)), xxhash.xxh64_intdigest(w), rows.get(w, -1)) for w in self.first]
        self.known = [np.array(x, k) for x, k in zip(zip(*facts, self.end), ("i4", "i4", "u8", "i4"), strict=True)]
        self.forget(0)

    def others(self) -> int:
        return len(self) - len(self.first)

    def forget(self, most: int = 200_000) -> None:
        if self.others() >= most or not most:
            self.clear()
            self.update(self.first)
            self.words: list[bytes] = list(self.first)
            self.arrays, self.told = self.known, len(self.words)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def settled(self) -> list[np.ndarray]:
        """Symbols, indicators, hashes and rows in what a task was told (-1: none) of all words so far."""
        n, told = len(self.words), self.told
        if n > told:
            if n >= len(self.arrays[0]):
                self.arrays = [np.concatenate([x, np.empty(n, x.dtype)]) for x in self.arrays]
            for x, other, end in zip(self.arrays, self.other, self.end, strict=True):
                x[told:n], x[n] = other, end
            self.arrays[2][told:n] = np.fromiter(map(xxhash.xxh64_intdigest, self.words[told:]), np.uint64, n - told)
            self.told = n
        return [x[:n + 1] for x in self.arrays]


class Text:
    """A batch of texts as numbers: for each token its word's, -1 being the end, and its text and place in it."""

    def __init__(self, texts: list, lexicon: Lexicon) -> None:
        n, words = tokens(texts)
        words = words.dictionary_encode()
        met = words.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(lexicon.__getitem__, met.tolist()), np.int32, len(met))
        self.size = n + 1
        self.start = np.cumsum(self.size) - self.size
        inner = np.ones(int(self.size.sum()), bool)
        inner[self.start + n] = False
        self.token = np.full(len(inner), -1, np.int32)
        self.token[inner] = number[words.indices.to_numpy()]
        self.symbol, self.sign, self.hash, self.row = (x[self.token] for x in lexicon.settled())
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.size)
        self.place = np.arange(len(self.doc), dtype=np.int32) - self.start[self.doc].astype(np.int32)


def n_symbols(vocabulary: int) -> int:
    """Words with a code of their own for a vocabulary of so many."""
    return min(MOST_SYMBOLS, max(SYMBOLS, vocabulary // WORDS_A_SYMBOL))


def table_bits(vocabulary: int) -> tuple[int, ...]:
    """Powers of 2 of the word contexts' tables; hashed contexts of more words than slots share them."""
    own = min(WORD_BITS[1], max(WORD_BITS[0], vocabulary.bit_length()))
    return CLASS_BITS, own, own, own


def classes_of(together: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Log shares (classes, indicators + 1) in 65536ths, from how often indicators occur in the same documents.

    Indicators are clustered by their profiles, the farthest first; a class's shares are its members' co-occurrences.
    In whole numbers, so that sums do not depend on what else is in a batch; the last column, of other words, is 0.
    """
    n = len(together)
    if not n:
        return np.zeros((classes, 1), np.int32)
    profile = np.sqrt((together + 1e-9) / (together + 1e-9).sum(1, keepdims=True))
    centres = [profile[int(together.sum(1).argmax())]]
    while len(centres) < min(classes, n):
        centres.append(profile[int((profile @ np.stack(centres).T).max(1).argmin())])
    centres = np.stack(centres)
    for _ in range(20):
        own = (profile @ centres.T).argmax(1)
        centres = np.stack([profile[own == k].mean(0) if (own == k).any() else centres[k] for k in range(len(centres))])
    share = np.stack([together[own == k].sum(0) for k in range(len(centres))] + [np.zeros(n)] * (classes - len(centres)))
    share += 0.1 * (together.sum(0) + 1) / (together.sum() + n) * max(1.0, share.sum() / classes)
    return np.concatenate([np.round(65536 * np.log(share / share.sum(1, keepdims=True))), np.zeros((classes, 1))], axis=1).astype(np.int32)


class Mix:
    """Weights of each gate, and the map that refines what they give."""

    def __init__(self, gates: int, inputs: int) -> None:
        self.w = np.full((inputs + 1, gates), 1.0 / inputs, np.float32)
        self.w[-1] = 0
        self.map = np.tile((1 / (1 + np.exp(-np.linspace(-8, 8, APM)))).astype(np.float32), (gates, 1))

    def copies(self, n: int) -> Mix:
        """One for each of n texts, their gates one after the other."""
        out = Mix.__new__(Mix)
        out.w, out.map = np.tile(self.w, (1, n)), np.tile(self.map, (n, 1))
        return out

    def mixed(self, x: list[np.ndarray], key: np.ndarray) -> np.ndarray:
        z = self.w[-1][key]
        for w, own in zip(self.w, x, strict=False):
            part = w[key]
            part *= own
            z += part
        return z

    def refined(self, z: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """The probability of a one: the mean of the mixed one and of what the map makes of it; and the mixed one itself."""
        z = np.minimum(np.maximum(z, np.float32(-8)), np.float32(8))
        f = z + np.float32(8)
        f *= np.float32((APM - 1) / 16)
        at = f.astype(np.intp)
        np.minimum(at, APM - 2, out=at)
        f -= at.astype(np.float32)
        at += key * APM
        flat = self.map.ravel()
        under = flat[at]
        own = flat[1:][at]
        own -= under
        own *= f
        own += under
        p = np.exp(np.negative(z, out=z), out=z)
        p += 1
        np.reciprocal(p, out=p)
        mean = own + p
        mean *= np.float32(0.5)
        return mean, p, (at, f, own)

    def learn(self, x: list[np.ndarray], key: np.ndarray, err: np.ndarray, rate: float) -> None:
        """A gradient step of the weights, of one size however many bits of a gate there are."""
        n = np.bincount(key)
        step = (rate / np.sqrt(n + 1.0)).astype(np.float32)
        for w, v in zip(self.w, x, strict=False):
            w[:len(n)] += step * np.bincount(key, err * v)
        self.w[-1][:len(n)] += step * np.bincount(key, err)

    def adapt(self, spot: tuple, bit: np.ndarray, rate: float) -> None:
        """Moves the map at the nearer of each bit's two points towards the bit."""
        at, f, own = spot
        at = at + (f > 0.5)
        n = np.bincount(at)
        flat = self.map.ravel()
        change = np.bincount(at, bit - own)
        some = np.flatnonzero(n)
        flat[some] = np.clip(flat[some] + rate * change[some] / np.sqrt(n[some]), 1e-4, 1 - 1e-4)


class Model:
    """Codes, classes and weights; the logits of the tables come later."""

    def __init__(self, top: list[tuple[bytes, int]], escapes: int, ends: int, letters: np.ndarray, vocabulary: int,
                 indicators: list[bytes], together: np.ndarray) -> None:
        self.bits = table_bits(vocabulary)
        self.symbol = {w: i for i, (w, _) in enumerate(top)}
        self.escape, self.end = len(top), len(top) + 1
        self.code = Code(np.array([*(c for _, c in top), escapes, ends], np.float64) + 0.5)
        self.letters = Code(letters + 0.5)
        self.indicator = {w: i for i, w in enumerate(indicators)}
        self.share = classes_of(together)
        self.mix = Mix(DEPTHS * LEVELS, len(self.bits))
        self.tables: list[np.ndarray] = []
        self.spell_tables: list[np.ndarray] = []

    def classes(self, t: Text) -> np.ndarray:
        """Of each token the class that what stands before it in its text makes likeliest."""
        best, most = np.zeros(len(t.sign), np.int32), None
        for k in range(CLASSES):
            own = self.share[k][t.sign]
            total = np.cumsum(own, dtype=np.int64) - own
            total -= np.repeat(total[t.start], t.size)
            if most is None:
                most = total
            else:
                better = total > most
                best[better] = k
                np.maximum(most, total, out=most)
        return best

    def bases(self, t: Text, c: np.ndarray) -> list[np.ndarray]:
        """Of each token a number for each word context: class; class and word before; two before; class and two before."""
        one = np.where(t.place > 0, np.roll(t.hash, 1), _U(1))
        two = one + np.where(t.place > 1, np.roll(t.hash, 2), _U(2)) * _U(0xA24BAED4963EE407)
        own = c.astype(_U) + _U(1)
        contexts = [own, one + own, two, two + own * _U(0x9FB21C651E98DF25)]
        return [(_mixed(x * _B + _U(k)) >> _U(32)).astype(_H) for k, x in enumerate(contexts)]

    def slots(self, bases: list[np.ndarray], of: np.ndarray, n: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Of each step of the tokens `of` the slot in each table."""
        node, out = _at(self.code.node, at), []
        for b, bits in zip(bases, self.bits, strict=True):
            own = np.repeat(b[of], n)
            own += node
            own *= _STIR
            own >>= _H(32 - bits)
            out.append(own)
        return out

    def gate(self, at: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
        """By depth in the code, and by whether one and two words before are known."""
        out = _at(self.code.gate, at)
        out += x[1] != 0
        out += x[3] != 0
        return out

    def scores(self, texts: list, lexicon: Lexicon) -> tuple[np.ndarray, Text, np.ndarray]:
        """log2 probability of each text's code, without what is spelled; and the text's numbers and classes.

        Weights and maps start alike in each text and follow it: they move every STEP tokens, by what was seen up to
        there; what comes later never bears on what comes before.
        """
        t = Text(texts, lexicon)
        c = self.classes(t)
        bases = self.bases(t, c)
        # the longest first, a few at a time: those that go on are always the first ones, and what is looked at stays near
        longest, gates = np.argsort(-t.size, kind="stable"), DEPTHS * LEVELS
        out = np.zeros(len(texts))
        for first in range(0, len(texts), TOGETHER):
            docs = longest[first:first + TOGETHER]
            own, size, start = self.mix.copies(len(docs)), t.size[docs], t.start[docs]
            for b in range(0, int(size[0]), STEP):
                left = np.minimum(size[:np.count_nonzero(size > b)] - b, STEP)
                ends = np.cumsum(left)
                of = np.repeat(start[:len(left)] + b - (ends - left), left) + np.arange(ends[-1])
                n, at = self.code.steps(t.symbol[of])
                x = list(map(_logits, self.tables, self.slots(bases, of, n, at)))
                bits = np.add.reduceat(n, ends - left)  # of each text, one after the other
                bit, key = _at(self.code.bit, at), self.gate(at, x)
                key += np.repeat(np.arange(len(left)) * gates, bits)
                p, plain, spot = own.refined(own.mixed(x, key), key)
                p -= 1
                p += bit
                out[docs[:len(left)]] += np.add.reduceat(np.log(np.abs(p, out=p), out=p), np.cumsum(bits) - bits, dtype=np.float64)
                more = int(bits[:np.count_nonzero(size > b + STEP)].sum())  # texts that end here need no new weights
                if more:
                    err, key = bit[:more] - plain[:more], key[:more]
                    own.learn([v[:more] for v in x], key, err, RATE)
                    own.adapt(tuple(v[:more] for v in spot), bit[:more], MAP_RATE)
        return out / np.log(2.0), t, c

    # -- spelling ----------------------------------------------------------------------------------------------------

    def spelled(self, words: list[bytes], c: np.ndarray, beginnings: bool = True) -> tuple:
        """Of each bit of the words' letters: word, place in it, position among the code's steps, slots in the tables of
        letter contexts, and, if asked for, hashes of the word's beginning, without and with the class."""
        text = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int32)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        start = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        place = np.arange(len(text), dtype=np.int32) - start[word].astype(np.int32)
        back = [np.where(place >= k, np.roll(text, k), 0) for k in (1, 2, 3)]
        own = c[word].astype(_U)
        short = [back[0], back[0] + 256 * back[1], back[0] + 256 * back[1] + 65536 * back[2]]
        n, at = self.letters.steps(text)
        node = self.letters.node[at]
        slots = []
        for k, (x, bits) in enumerate(zip(short, SPELL_BITS, strict=True)):
            base = (_mixed((x.astype(_U) * _U(CLASSES) + own) * _B + _U(k + 16)) >> _U(32)).astype(_H)
            slots.append(((np.repeat(base, n) + node) * _STIR) >> _H(32 - bits))
        word_of, place_of = np.repeat(word, n), np.repeat(place, n)
        if not beginnings:
            return word_of, place_of, at, slots, []
        power = np.cumprod(np.full(len(text), _B)) * _U(pow(int(_B), -1, 1 << 64))
        total = np.concatenate([np.zeros(1, _U), np.cumsum((text.astype(_U) + _U(1)) * power)])
        inverse = np.cumprod(np.full(len(text), _U(pow(int(_B), -1, 1 << 64)))) * _B
        prefix = (total[:-1] - total[start][word]) * inverse[start][word] + place.astype(_U)
        far = node.astype(_U) * _U(0x9FB21C651E98DF25)
        starts = [_mixed(np.repeat(x, n) * _B + far) for x in (prefix, prefix + (own + _U(1)) * _U(0xA24BAED4963EE407))]
        return word_of, place_of, at, slots, starts

    def costs(self, words: list[bytes], c: np.ndarray, n: np.ndarray, silent: np.ndarray) -> np.ndarray:
        """log2 probabilities of spelled words (in class c, n times in training texts), by what spelling them in turn teaches.

        The words' beginnings are counted exactly, over the words given, from the silent-th letter on; before that the
        letter contexts speak alone.  Weights and map move online, by inputs as they would be had a word been seen once
        less, so that rare words teach how new ones are spelled.
        """
        word, place, at, slots, starts = self.spelled(words, c)
        bit, counted = self.letters.bit[at], []
        del at
        while starts:  # of each beginning and step its number, and its counts; a hash goes as soon as it is numbered
            k, own = pd.factorize(starts.pop(0))
            times = n[word].astype(np.float64)
            total = np.bincount(k, times, len(own)).astype(np.float32)
            times *= bit
            counted.append((k.astype(np.int32), np.bincount(k, times, len(own)).astype(np.float32), total))
            del k, times
        out, mix = np.zeros(len(words)), Mix(PLACES * LEVELS, len(slots) + len(counted))
        cuts = np.searchsorted(word, np.arange(0, len(words) + 512, 512))
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):  # inputs are made for these words alone, as there are many to a bit
            if s == e:
                continue
            b, heard, times = bit[s:e], place[s:e] >= silent[word[s:e]], n[word[s:e]].astype(np.float64)
            full = [_logits(t, x[s:e]) for t, x in zip(self.spell_tables, slots, strict=True)]
            less, known, known_less = list(full), [], []
            for k, ones, total in counted:
                one = ones[k[s:e]]
                zero = total[k[s:e]] - one
                full.append(np.where(heard, _logit(zero, one), np.float32(0)))
                less.append(np.where(heard, _logit(np.maximum(zero - (1 - b), 0), np.maximum(one - b, 0)), np.float32(0)))
                known.append(full[-1] != 0)
                known_less.append(less[-1] != 0)
            depth = np.minimum(place[s:e], PLACES - 1) * LEVELS
            key = depth + known[0] + known[1]
            p, _, _ = mix.refined(mix.mixed(full, key), key)
            first = int(word[s])
            got = np.bincount(word[s:e] - first, np.log(np.abs(p - (1 - b))))
            out[first:first + len(got)] += got
            seen = times > 0
            if seen.any():
                x, k, b = [v[seen] for v in less], (depth + known_less[0] + known_less[1])[seen], b[seen]
                _, plain, spot = mix.refined(mix.mixed(x, k), k)
                mix.learn(x, k, b - plain, RATE)
                mix.adapt(spot, b, MAP_RATE)
        return out / np.log(2.0)


# -- counting over Spark ---------------------------------------------------------------------------------------------

COUNTED = "word string, class int, n_train long, n_all long, block int, zeros binary, ones binary"
BLOCKS = "block int, zeros binary, ones binary"


def packed(n: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, compressed."""
    kind = next(k for k in ("u1", "u2", "u4", "u8") if not len(n) or n.max() <= np.iinfo(k).max)
    return kind.encode() + zlib.compress(n.astype(f"<{kind}").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[2:]), f"<{bytes(data[:2]).decode()}").astype(np.float64)


class Tables:
    """A task's counts of zeros and ones, for tables that follow each other; logits are made of them by the millions of events."""

    def __init__(self, bits: tuple[int, ...]) -> None:
        self.base = np.concatenate([[0], np.cumsum([1 << b for b in bits])])
        self.flat = np.zeros(2 * int(self.base[-1]), np.uint32)  # zeros and ones of a slot are neighbours
        self.n = self.flat.reshape(-1, 2).T
        self.said = np.zeros(self.n.shape[1], np.int8)
        self.events = 0

    def add(self, slots: list[np.ndarray], bit: np.ndarray) -> None:
        one = bit.astype(np.intp)
        for a, s in zip(self.base.tolist(), slots, strict=False):
            at = s.astype(np.intp)
            at += a
            at <<= 1
            at |= one
            np.add.at(self.flat, at, np.uint32(1))
        self.events += len(bit)
        if self.events > 3_000_000:  # tables are gone through as a whole each time
            self.settle()

    def settle(self) -> None:
        if self.events:
            for a, b in zip(self.base[:-1].tolist(), self.base[1:].tolist(), strict=True):
                self.said[a:b] = _whole(_logit(*self.n[:, a:b].astype(np.float32)))
        self.events = 0

    def weighted(self, slots: list[np.ndarray], bit: np.ndarray, weight: np.ndarray) -> None:
        for k, s in enumerate(slots):
            a, b = int(self.base[k]), int(self.base[k + 1])
            self.n[:, a:b] += np.bincount(s << _H(1) | bit.astype(_H), weight, 2 * (b - a)).reshape(-1, 2).T.astype(np.uint32)

    def logits(self, slots: list[np.ndarray]) -> list[np.ndarray]:
        """What has been settled so far says, in the steps in which tables are stored."""
        return [_logits(self.said[a:], s) for a, s in zip(self.base.tolist(), slots, strict=False)]

    def rows(self) -> Iterator[tuple]:
        self.settle()
        for block in range((self.n.shape[1] + (1 << BLOCK_BITS) - 1) >> BLOCK_BITS):
            part = self.n[:, block << BLOCK_BITS:(block + 1) << BLOCK_BITS]
            if part.any():
                yield block, packed(part[0]), packed(part[1])


def summed(blocks: DataFrame, bits: tuple[int, ...]) -> list[np.ndarray]:
    """Blocks of counts added up, as logits; the tables are bounded, and so is what the driver gets."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        zeros, ones = (sum(map(unpacked, pdf[c])) for c in ("zeros", "ones"))
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "logit": [zlib.compress(_whole(_logit(zeros, ones)).tobytes(), 1)]})

    base = np.concatenate([[0], np.cumsum([1 << b for b in bits])])
    out = np.zeros(int(base[-1]), np.int8)
    for r in blocks.select(*[c.split()[0] for c in BLOCKS.split(", ")]).groupBy("block").applyInPandas(add, "block int, logit binary").toLocalIterator():
        own = np.frombuffer(zlib.decompress(r["logit"]), np.int8)
        out[r["block"] << BLOCK_BITS:(r["block"] << BLOCK_BITS) + len(own)] = own
    return [out[a:b].copy() for a, b in zip(base[:-1], base[1:], strict=True)]


def most_frequent(df: DataFrame, n: str, key: list[str], k: int) -> DataFrame:
    """The k rows with the greatest n, ties by key.

    Counts of rows by n tell where the k-th is, and of its ties a hash draws some, so that not every partition sends k
    rows to be sorted.
    """
    def last(sizes: dict, want: int) -> tuple:
        above = 0
        for x in sorted(sizes, reverse=True):
            if above + sizes[x] >= want or x == min(sizes):
                return x, above
            above += sizes[x]
        return 0, 0

    level = F.floor(F.log2(F.col(n) + 1) * 16)
    cut, above = last({r["x"]: r["count"] for r in df.groupBy(level.alias("x")).count().collect()}, k)
    sizes = {r["x"]: r["count"] for r in df.filter(level == cut).groupBy(F.col(n).alias("x")).count().collect()}
    least, more = last(sizes, k - above)
    need = k - above - more
    some = F.pmod(F.xxhash64(*key), F.lit(1 << 20)) < int((1 << 20) * min(1.0, (4 * need + 1000) / max(1, sizes.get(least, 1))))
    return df.filter((F.col(n) > least) | ((F.col(n) == least) & some)).orderBy(F.col(n).desc(), *key).limit(k)


def words_of(docs: DataFrame) -> DataFrame:
    """Distinct words of all texts as their bytes: n, how often they occur, and held, by how many texts they are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[pa.Table] = []

        def added() -> pa.Table:
            out = pa.concat_tables(met).group_by("word", use_threads=False).aggregate([("n", "sum"), ("held", "sum")])
            met[:] = [out.rename_columns({"n_sum": "n", "held_sum": "held"})]
            return met[0]

        def rows() -> Iterator[pa.RecordBatch]:
            yield from added().cast(pa.schema({"word": pa.binary(), "n": pa.int64(), "held": pa.int64()})).to_batches(max_chunksize=65_536)
            met.clear()

        for b in batches:
            size, words = tokens(b.column("text"))
            words = words.dictionary_encode()
            k, own = len(words.dictionary), words.indices.to_numpy().astype(np.int64)
            pair = np.repeat(np.arange(len(size), dtype=np.int64) << 32, size) | own
            pair.sort()
            once = pair[np.diff(pair, prepend=-1) != 0] & 0xFFFFFFFF
            met.append(pa.table({"word": words.dictionary, "n": np.bincount(own, minlength=k), "held": np.bincount(once, minlength=k)}))
            if sum(map(len, met)) > 1_000_000 and len(added()) > 500_000:
                yield from rows()
        if met:
            yield from rows()

    return docs.select("text").mapInArrow(run, "word binary, n long, held long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))


def indicators_of(docs: DataFrame, words: DataFrame | None = None) -> list[bytes]:
    """Words that most of the documents hold, all of them counted (in words, if they are): those whose co-occurrence is counted next."""
    words = words_of(docs) if words is None else words
    return [bytes(r["word"]) for r in words.orderBy(F.col("held").desc(), "word").select("word").limit(INDICATORS).collect()]


def meetings(docs: DataFrame, indicators: list[bytes]) -> np.ndarray:
    """How many texts hold both of two indicators."""
    k = len(indicators)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = pa.array(indicators, pa.large_binary()), np.zeros((k, k), np.float64)
        for b in batches:
            size, words = tokens(b.column("text"))
            at = pc.fill_null(pc.index_in(words, known), k).to_numpy()
            has = np.zeros((len(size), k + 1), np.float32)
            has[np.repeat(np.arange(len(size)), size), at] = 1
            total += has[:, :k].T @ has[:, :k]
        yield pa.RecordBatch.from_pydict({"i": np.arange(k), "together": [zlib.compress(x.tobytes(), 1) for x in total]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), np.float64) for x in pdf["together"])
        return pd.DataFrame({"i": [int(pdf["i"].iloc[0])], "together": [total.tobytes()]})

    out = np.zeros((k, k))
    if k:
        rows = docs.select("text").mapInArrow(run, "i long, together binary").groupBy("i").applyInPandas(add, "i long, together binary")
        for r in rows.collect():  # one for each indicator
            out[r["i"]] = np.frombuffer(r["together"], np.float64)
    return out


def fitted_counts(docs: DataFrame, indicators: list[bytes] = (), words: DataFrame | None = None) -> tuple:
    """What Model takes, of docs (text): codes' and classes' counts, over all of them; and the number of words.

    words is what words_of() gives of docs, if it is known.
    """
    spark = docs.sparkSession
    words = written(words_of(docs), "all-words") if words is None else words
    sums = words.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).first()
    top = [(bytes(r["word"]), r["n"]) for r in most_frequent(words, "n", ["word"], n_symbols(sums["v"])).collect()]
    own = spark.sparkContext.broadcast({w for w, _ in top})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(256)
        for b in batches:
            rest = [(w, c) for w, c in zip(map(bytes, b["word"]), b["n"].tolist(), strict=True) if w not in own.value]
            if rest:
                letters = np.frombuffer(b" ".join(w for w, _ in rest) + b" ", np.uint8)
                out += np.bincount(letters, np.repeat([c for _, c in rest], [len(w) + 1 for w, _ in rest]), 256)
        yield pd.DataFrame({"letter": np.arange(256), "n": out})

    letters = np.zeros(256)
    for r in words.mapInPandas(run, "letter int, n double").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        letters[r["letter"]] = r["n"]
    own.destroy()
    return top, (sums["n"] or 0) - sum(c for _, c in top), docs.count(), letters, sums["v"], list(indicators), meetings(docs, indicators)


def taught(rows: DataFrame) -> tuple:
    """Weights and maps that tasks have learned, added up by how many bits each has seen, and the number of bits."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = list(map(pickle.loads, pdf["zeros"]))
        return pd.DataFrame({"sums": [pickle.dumps(tuple(sum(p[k] for p in parts) for k in range(3)))]})

    parts = [pickle.loads(r["sums"]) for r in rows.select("block", "zeros").groupBy("block").applyInPandas(add, "sums binary").collect()]  # GROUPS rows at most
    return tuple(sum(p[k] for p in parts) for k in range(3)) if parts else (None, None, 0)


def counted(docs: DataFrame, model) -> DataFrame:
    """Spelled words by class; blocks of the word contexts' counts; and, as blocks below 0, weights: the latter two of
    training documents only.

    Weights are learned online: bits are predicted from what the task has counted before, by logits as they are stored, and
    each moves them; what contexts a part's bits have is made once, to learn from and to count.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = pickle.loads(zlib.decompress(model.value))
        lexicon, tables, mix, learned = Lexicon(m), Tables(m.bits), Mix(DEPTHS * LEVELS, len(m.bits)), 0
        names = [x.split()[0] for x in COUNTED.split(", ")]
        held: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            """Spelled words by class; held has them as numbers, with 1 in the last bit if in a training text."""
            pair, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.int64), np.empty(0, np.int64))
            held.clear()
            group, at = np.unique(pair >> 1, return_inverse=True)
            out = pd.DataFrame({"word": pd.Series([lexicon.words[i].decode("utf-8", "replace") for i in (group // CLASSES).tolist()], dtype=object), "class": (group % CLASSES).astype(np.int32),
                                "n_train": np.bincount(at, n * (pair & 1), len(group)).astype(np.int64), "n_all": np.bincount(at, n, len(group)).astype(np.int64)})
            return out.assign(block=pd.array([None] * len(out), "Int32"), zeros=None, ones=None)[names]

        for batch in batches:
            t = Text(list(batch["text"]), lexicon)
            c = m.classes(t)
            train = ~batch["held_out"].to_numpy(bool)
            bases = m.bases(t, c)
            tokens = np.flatnonzero(np.repeat(train, t.size))
            for first in range(0, len(tokens), 1 << 16):
                part = tokens[first:first + (1 << 16)]
                n, at = m.code.steps(t.symbol[part])
                slots, bits = m.slots(bases, part, n, at), _at(m.code.bit, at)
                cuts = [*(np.cumsum(n) - n)[::1024].tolist(), len(at)]
                for s, e in zip(cuts, cuts[1:]):
                    x, bit = tables.logits([own[s:e] for own in slots]), bits[s:e]
                    key = m.gate(at[s:e], x)
                    _, plain, spot = mix.refined(mix.mixed(x, key), key)
                    mix.learn(x, key, bit - plain, RATE)
                    mix.adapt(spot, bit, MAP_RATE)
                learned += len(at)
                tables.add(slots, bits)
            rare = np.flatnonzero(t.symbol == m.escape)
            held.append((t.token[rare].astype(np.int64) * CLASSES + c[rare]) << 1 | train[t.doc[rare]])
            if lexicon.others() >= 200_000 or sum(map(len, held)) > 3_000_000:
                yield flush()
                lexicon.forget()
        yield flush()
        rows = [(None, None, None, None, *r) for r in tables.rows()]
        group = TaskContext.get().partitionId() % GROUPS
        rows.append((None, None, None, None, -1 - group, pickle.dumps((mix.w * learned, mix.map * learned, learned)), None))
        out = pd.DataFrame(rows, columns=names)
        for k in ("class", "n_train", "n_all"):
            out[k] = pd.array([None] * len(out), "Int64")
        yield out

    return docs.select("text", "held_out").mapInPandas(run, COUNTED)


def spellings(words: DataFrame, model) -> DataFrame:
    """Blocks of the letter contexts' counts over (word, class, n) of training words that have no code of their own."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, tables, held = pickle.loads(zlib.decompress(model.value)), Tables(SPELL_BITS), []

        def settle() -> None:
            b = pd.concat(held)
            held.clear()
            word, _, steps, slots, _ = m.spelled([w.encode() for w in b["word"]], b["class"].to_numpy(), beginnings=False)
            tables.weighted(slots, _at(m.letters.bit, steps), _at(b["n_train"].to_numpy(np.float64), word))

        for b in batches:
            held.append(b)
            if sum(map(len, held)) >= SPELLED:  # as tables are gone through as a whole each time
                settle()
        if held:
            settle()
        rows = list(tables.rows())
        if rows:
            yield pd.DataFrame(rows, columns=["block", "zeros", "ones"])

    return words.mapInPandas(run, BLOCKS)


def together(words: DataFrame, total: int) -> DataFrame:
    """words with bucket, of about SPELLED rows, such that words of the same beginning meet, and silent, its bytes.

    A beginning that more words share than a bucket should hold gives way to a longer one; in the end each word goes by
    itself.  Such beginnings are fewer than rows / SPELLED.
    """
    out = words.withColumns({"key": F.lit(None).cast("string"), "silent": F.lit(None).cast("int")})
    for length in (*BEGINNINGS, 1 << 20):
        start = F.substring("word", 1, length)
        many = out.filter("key is null").groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 4 * SPELLED).select("start").collect()
        free = F.col("key").isNull() & ~start.isin([r["start"] for r in many]) if many else F.col("key").isNull()
        out = out.withColumns({"key": F.when(free, F.concat(F.lit(f"{length}:"), start)).otherwise(F.col("key")),
                               "silent": F.when(free, F.octet_length(start)).otherwise(F.col("silent"))})
        if not many:
            break
    return out.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(max(1, -(-total // SPELLED)))).cast("int")).drop("key")


def priced(words: DataFrame, total: int, model) -> DataFrame:
    """word, class, n_all, c (the word's count in training texts) and cost, the log10 probability of its spelling."""
    def price(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pickle.loads(zlib.decompress(model.value))
        order = np.argsort([xxhash.xxh64_intdigest(f"{k}:{w}") for w, k in zip(pdf["word"], pdf["class"], strict=True)], kind="stable")
        pdf = pdf.iloc[order]
        cost = m.costs([w.encode() for w in pdf["word"]], pdf["class"].to_numpy(), pdf["n_train"].to_numpy(), pdf["silent"].to_numpy())
        return pd.DataFrame({"word": pdf["word"], "class": pdf["class"], "n_all": pdf["n_all"], "c": pdf.groupby("word")["n_train"].transform("sum"), "cost": cost * np.log10(2.0)})

    return together(words, total).groupBy("bucket").applyInPandas(price, "word string, class int, n_all long, c long, cost double")


SCORED = ("node long, doc_id string, held_out boolean, n_tokens long, known long, base double, score double, n_bytes long, "
          "word string, class int, n long")


def mixing_scores(docs: DataFrame) -> DataFrame:
    """Scores of every row of docs (doc_id, text) by a model of those whose fold of 10 is not 0.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) and bits_per_byte.  A token is
    coded by a Huffman code of the commonest words, an escape and the end; after an escape its bytes and a space are
    spelled in another.  Each bit is predicted from hashed contexts (latent class of the text so far and words before;
    class, bytes before and the word's beginning), whose logits are mixed by weights that a gate chooses and refined by a
    map; both are learned online.  Counts are of all training documents; word and letter contexts are hashed to tables
    of a bounded size that every task knows, beginnings of words are counted exactly over the whole vocabulary.

    Texts are lower-cased (A-Z) and scored whole, very long ones too; null and empty texts have the end alone; a null
    doc_id is a key of its own; rows that repeat are kept; without a training document scores are those of the untrained
    model; no rows give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    sent = lambda x: spark.sparkContext.broadcast(zlib.compress(pickle.dumps(x), 1))
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", (fold(F.col("doc_id"), 10) == 0).alias("held_out"))
    training = docs.filter(~F.col("held_out"))
    met = written(words_of(training), "all-words")
    top, escapes, ends, letters, vocabulary, indicators, meet = fitted_counts(training, indicators_of(training, met), met)
    n_train = escapes + sum(c for _, c in top) + ends
    below = n_train + 0.1 * (vocabulary + (1 if ends else 0) + 1)
    m = Model(top, escapes, ends, letters, vocabulary, indicators, meet)
    model = sent(m)
    counts = written(counted(docs, model), "counts")
    m.tables = summed(counts.filter("block >= 0"), m.bits)
    w, maps, seen = taught(counts.filter("block < 0"))
    if seen:
        m.mix.w, m.mix.map = w / np.float32(seen), maps / np.float32(seen)
    words = written(counts.filter("word is not null").groupBy("word", "class").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")), "words")
    m.spell_tables = summed(spellings(words.filter("n_train > 0"), model), SPELL_BITS)
    model.destroy()
    model = sent(m)
    prices = written(priced(words, words.count(), model), "prices")
    rows = most_frequent(prices, "n_all", ["word", "class"], COMMON).toPandas()
    # of each word that tasks are told of: its number, its count, and its price in each class (NaN: not told)
    told = {w: i for i, w in enumerate([*dict(top), *sorted(set(map(str.encode, rows["word"])))])}
    count, price = np.full(len(told) + 1, -1, np.int64), np.full((len(told) + 1, CLASSES), np.nan)
    count[:len(top)] = [c for _, c in top]
    at = np.fromiter((told[w.encode()] for w in rows["word"]), np.int64, len(rows))
    count[at], price[at, rows["class"].to_numpy(np.int64)] = rows["c"], rows["cost"]
    known = sent((told, count, price))
    end_log = float(np.log10(ends + 0.1) - np.log10(below))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = pickle.loads(zlib.decompress(model.value))
        told, count, prices = pickle.loads(zlib.decompress(known.value))
        lexicon = Lexicon(m, told)
        names = [x.split()[0] for x in SCORED.split(", ")]
        node = TaskContext.get().partitionId() << 40
        for b in batches:
            texts = list(b["text"])
            lexicon.forget()
            bits, t, k = m.scores(texts, lexicon)
            n, words, size = len(texts), lexicon.words, len(lexicon.words)
            score = bits * np.log10(2.0)
            spelled = np.flatnonzero(t.symbol == m.escape)
            price = prices[t.row[spelled], k[spelled]]
            rare = np.isnan(price)  # what a task does not know comes by a join
            score += np.bincount(t.doc[spelled[~rare]], price[~rare], n)
            spelled = spelled[rare]
            unknown = np.zeros(len(t.token), bool)
            unknown[spelled] = True
            pair, times = np.unique((t.doc[spelled].astype(np.int64) * size + t.token[spelled]) * CLASSES + k[spelled], return_counts=True)
            doc = pair // CLASSES // max(1, size)
            at = np.where(t.token < 0, ends, count[t.row])
            log = np.where(unknown, 0.0, np.log10(np.maximum(at, 0) + 0.1) - np.log10(below))
            log[t.token < 0] = end_log
            out = pd.DataFrame({"node": node + np.arange(n), "doc_id": b["doc_id"], "held_out": b["held_out"], "n_tokens": t.size,
                                "known": np.bincount(t.doc, (at > 0) & ~unknown, n).astype(np.int64), "base": np.bincount(t.doc, log, n), "score": score,
                                "n_bytes": [0 if x is None else len(x.encode("utf-8", "surrogatepass")) for x in texts]})
            yield out.assign(word=None, n=pd.array([None] * n, "Int64"), **{"class": pd.array([None] * n, "Int32")})[names]
            for first in range(0, len(pair), 100_000):
                part = slice(first, first + 100_000)
                p = pair[part]
                none = pd.array([None] * len(p), "Int64")
                out = pd.DataFrame({"node": node + doc[part], "class": (p % CLASSES).astype(np.int32), "n": times[part],
                                    "word": pd.Series([words[i].decode("utf-8", "replace") for i in (p // CLASSES % size).tolist()], dtype=object)})
                yield out.assign(doc_id=None, held_out=None, n_tokens=none, known=none, base=np.nan, score=np.nan, n_bytes=none)[names]
            node += n

    held = written(docs.mapInPandas(run, SCORED), "scored")
    log = F.log10(F.col("c") + 0.1) - float(np.log10(below))
    rare = held.filter("word is not null").select("node", "word", "class", "n").join(prices, ["word", "class"])
    rare = rare.groupBy("node").agg(F.sum(F.col("n") * log).alias("rare"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
                                    F.sum(F.col("n") * F.col("cost")).alias("rare_score"))
    out = held.filter("n_tokens is not null").join(rare, "node", "left")
    score = F.col("score") + F.coalesce("rare_score", F.lit(0.0))
    return out.select(F.col("doc_id").cast("long"), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                      F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare", F.lit(0.0))).alias("base_score"), score.alias("score"),
                      F.try_divide(-score / float(np.log10(2.0)), F.col("n_bytes")).alias("bits_per_byte"))
