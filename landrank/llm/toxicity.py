"""Toxicity: a convolutional text classifier over hashed words, trained in numpy, with thresholds by language."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import attach, small_batches, written

#: Labelled rows that the classifier is fitted on, at most about: of label 1 and of label 0.  A fifth is left out of it.
SAMPLE = (3000, 6000)
#: Bytes of text that it is fitted on, at most about; where the rows have more, fewer are drawn.
SAMPLE_BYTES = 64 << 20
BITS, DIM, FILTERS, WIDTHS = 18, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.1, 3
#: A bucket seen in fewer documents of the sample is embedded at zero, as nothing can be learned of it.
LEAST_DOCS = 3
#: The score at which a document counts as toxic, wherever the language has no threshold of its own.
DECISION = 0.7
#: Score bins to one unit of the logit, in which labelled rows are counted before the exact pass.
BINS = 64
#: Rows and toxic rows of a language below which it gets no threshold of its own.
LEAST_ROWS = (100, 20)

_PAD = max(WIDTHS) - 1
#: Blocks of scripts that are written without spaces (Thai to Myanmar, Khmer, kana, Han and its extensions).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


class Buckets(dict):
    """Words' two hash buckets as one number; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        mask = (1 << BITS) - 1
        out = self[word] = (zlib.crc32(word) & mask) << BITS | zlib.adler32(word[::-1], zlib.crc32(word, 7)) * 2654435761 >> 7 & mask
        return out


def tokens(texts: list, buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words as bucket numbers, -1 between texts, and where each text starts.

    Words are runs of ASCII letters and digits and of all characters above, in lower case; characters of scripts without
    spaces are words of their own, so that filters see runs of characters there.  Null is empty.
    """
    parts, starts, n = [], [], 0
    for text in texts:
        text = text or ""
        if not text.isascii():
            text = _UNSPACED.sub(r" \g<0> ", text)
        words = text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()
        ids = np.full(len(words) + _PAD + 1, -1, np.int64)
        ids[:len(words)] = list(map(buckets.__getitem__, words))
        parts.append(ids)
        starts.append(n)
        n += len(ids)
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), np.array(starts, np.int64)


class Net:
    """Embedding (sum of two hashed vectors), filters of several widths, ReLU, maximum over the text, logistic output."""

    def __init__(self, rng: np.random.Generator) -> None:
        n = 1 << BITS
        self.e = [rng.normal(0, 0.1, (n, DIM)).astype(np.float32) for _ in range(2)]
        self.known = [np.zeros(n, np.float32) for _ in range(2)]
        self.w = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(0)
        self.scale, self.shift = 1.0, 0.0
        self.thresholds: dict = {}

    def forget(self) -> None:
        """Clears what embeddings of unknown buckets were drawn, which nothing reads, so that the net is small to send."""
        for e, known in zip(self.e, self.known, strict=True):
            e[known == 0] = 0

    def embedded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = ids >> BITS & (1 << BITS) - 1, ids & (1 << BITS) - 1
        use = (self.known[0][a] * self.known[1][b] * (ids >= 0))[:, None]
        return (self.e[0][a] + self.e[1][b]) * use, a, b, use

    def convolved(self, x: np.ndarray) -> list[np.ndarray]:
        """For each width a row for each start; the last of a text see only what lies between texts."""
        out = []
        for w, bias in zip(self.w, self.b, strict=True):
            y = x @ w[0]
            for o in range(1, len(w)):
                y[:-o] += x[o:] @ w[o]
            out.append(np.maximum(y + bias, 0, out=y))
        return out

    def logits(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.empty(0)
        x, *_ = self.embedded(ids)
        pooled = np.concatenate([np.maximum.reduceat(y, starts, axis=0) for y in self.convolved(x)], axis=1)
        return (pooled @ self.out + self.bias).astype(np.float64)

    def raw(self, texts: list, buckets: Buckets, block: int = 200_000) -> np.ndarray:
        """Each whole text's logit; texts are put together up to about `block` characters, longer ones go alone."""
        out, held, size = [], [], 0
        for text in [*texts, None]:
            n = len(text) if text is not None else 0
            if held and (size + n > block or len(held) == 512):
                out.append(self.logits(*tokens(held, buckets)))
                held, size = [], 0
            held.append(text)
            size += n
        out.append(self.logits(*tokens(held, buckets)))
        return np.concatenate(out)[:len(texts)]

    def scores(self, texts: list, buckets: Buckets) -> np.ndarray:
        """Each whole text's score."""
        return self.squashed(self.raw(texts, buckets))

    def squashed(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> None:
        for side, shift in ((0, BITS), (1, 0)):
            seen = np.zeros(1 << BITS, np.int64)
            for ids in docs:
                seen[np.unique(ids[ids >= 0] >> shift & (1 << BITS) - 1)] += 1
            self.known[side] = (seen >= LEAST_DOCS).astype(np.float32)
        weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9)) if 0 < labels.mean() < 1 else np.ones(len(labels))
        moments: dict = {}

        def step(name: str, value: np.ndarray, grad: np.ndarray) -> None:  # Adagrad
            m = moments.setdefault(name, np.full_like(value, 1e-3))
            m += grad * grad
            value -= RATE * grad / np.sqrt(m)

        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                batch = order[at:at + BATCH]
                ids = np.concatenate([docs[i] for i in batch])
                ids = np.where(rng.random(len(ids)) < 0.1, -1, ids)  # words left out, so that no single one is relied on
                ends = np.cumsum([len(docs[i]) for i in batch])
                starts = ends - [len(docs[i]) for i in batch]
                x, a, b, use = self.embedded(ids)
                ys = self.convolved(x)
                best = [np.stack([s + y[s:e].argmax(0) for s, e in zip(starts, ends, strict=True)]) for y in ys]
                pooled = np.concatenate([np.take_along_axis(y, k, 0) for y, k in zip(ys, best, strict=True)], axis=1)
                p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.bias, -30, 30)))
                g = ((p - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
                gp = g[:, None] * self.out
                step("out", self.out, pooled.T @ g)
                self.bias -= np.float32(RATE * 0.1 * g.sum())
                spots, grads = [], []
                for k, w in enumerate(self.w):
                    gy = gp[:, k * FILTERS:(k + 1) * FILTERS] * (np.take_along_axis(ys[k], best[k], 0) > 0)
                    gw = np.zeros_like(w)
                    for o in range(len(w)):
                        at_o = np.minimum(best[k] + o, len(ids) - 1)
                        gw[o] = np.einsum("nfd,nf->df", x[at_o], gy)
                        spots.append(at_o.ravel())
                        grads.append((gy[:, :, None] * w[o].T[None]).reshape(-1, DIM))
                    step(f"b{k}", self.b[k], gy.sum(0))
                    step(f"w{k}", self.w[k], gw)
                spots, grads = np.concatenate(spots), np.concatenate(grads)
                grads *= use[spots]
                for side, rows in ((0, a[spots]), (1, b[spots])):
                    some, back = np.unique(rows, return_inverse=True)
                    total = np.zeros((len(some), DIM), np.float32)
                    np.add.at(total, back, grads)
                    m = moments.setdefault(f"e{side}", np.full_like(self.e[side], 1e-3))
                    m[some] += total * total
                    self.e[side][some] -= RATE * total / np.sqrt(m[some])


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap at which F1 is greatest; infinite without labels of 1."""
    if not labels.any():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2 if k + 1 < len(s) else s[k] - 1e-6)


def best_cut(spans: pd.DataFrame) -> tuple[float, np.ndarray]:
    """Where the F1 of weighted counts is greatest, and the spans inside which a cut might do better.

    spans: high, low (the greatest and the least logit in them), ones, zeros; they do not overlap.  The cut is the
    middle of the gap below a span; infinite without labels of 1.
    """
    high, low, ones, zeros = (spans[c].to_numpy(np.float64) for c in ("high", "low", "ones", "zeros"))
    if not ones.sum() > 0:
        return float("inf"), np.zeros(len(spans), bool)
    order = np.argsort(-high, kind="stable")
    hits, rows = np.cumsum(ones[order]), np.cumsum((ones + zeros)[order])
    f1 = 2 * hits / (rows + ones.sum())
    k = int(f1.argmax())
    # at best, all toxic rows of a span come first
    most = 2 * hits / (rows - zeros[order] + ones.sum())
    inside = np.zeros(len(spans), bool)
    inside[order] = (most >= f1[k] - 1e-12) & (high > low)[order]
    last = low[order[k]]
    return float((last + high[order[k + 1]]) / 2 if k + 1 < len(order) else last - 1e-6), inside


def cuts(scored: DataFrame) -> tuple[float, dict]:
    """The cut over all languages, and those of languages with enough rows, of scored (lang, z, toxic, fit, n).

    Rows that the net was not fitted on count, with weights that give each language and label its share of all labelled
    rows.  They are counted in bins; only bins that a better cut might lie in are looked at row by row.
    """
    mass = scored.groupBy("lang", "toxic").agg(F.sum("n").alias("all"), F.sum(F.when(~F.col("fit"), F.col("n")).otherwise(0)).alias("own")).toPandas()
    weight = {(r.lang, r.toxic): r.all / r.own for r in mass.itertuples() if r.own}
    own = {(r.lang, r.toxic): r.own for r in mass.itertuples()}
    count = lambda y: F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0))
    free = scored.filter(~F.col("fit")).withColumn("bin", F.floor(F.col("z") * BINS))

    def spans(rows: DataFrame, *key: str) -> pd.DataFrame:
        out = rows.groupBy("lang", *key).agg(F.first("bin").alias("in_bin"), F.max("z").alias("high"), F.min("z").alias("low"), count(1).alias("ones"), count(0).alias("zeros")).toPandas()
        for y, c in ((1, "ones"), (0, "zeros")):
            out[c] = out[c] * np.array([weight.get((x, y), 0.0) for x in out["lang"]], np.float64)
        return out

    def merged(rows: pd.DataFrame, key: str) -> pd.DataFrame:
        return rows.groupby(key, as_index=False).agg({"in_bin": "first", "high": "max", "low": "min", "ones": "sum", "zeros": "sum"})

    bins = spans(free, "bin")
    enough = [x for x in set(bins["lang"]) if own.get((x, 0), 0) + own.get((x, 1), 0) >= LEAST_ROWS[0] and own.get((x, 1), 0) >= LEAST_ROWS[1]]
    groups = {None: bins, **{x: bins[bins["lang"] == x] for x in enough}}
    some: dict = {}
    for x, rows in groups.items():
        rows = merged(rows, "in_bin") if len(rows) else rows
        some[x] = set(rows["in_bin"][best_cut(rows)[1]].tolist()) if len(rows) else set()
    wanted = sorted(set().union(*some.values()))
    exact = spans(free.filter(F.col("bin").isin(wanted)), "z") if wanted else bins[:0]
    found = {}
    for x, rows in groups.items():
        fine = exact if x is None else exact[exact["lang"] == x]
        rest = rows[~rows["in_bin"].isin(some[x])]
        fine = fine[fine["in_bin"].isin(some[x])]
        parts = [merged(part, key) for part, key in ((rest, "in_bin"), (fine, "high")) if len(part)]
        found[x] = best_cut(pd.concat(parts))[0] if parts else float("inf")
    return found.pop(None), found


def train(texts: list, labels: list, langs: list, seed: int = SEED) -> Net:
    """A net fitted on four fifths of the rows; the rest sets the score 0.7 and the thresholds by language."""
    rng = np.random.default_rng(seed)
    net, buckets, y = Net(rng), Buckets(), np.array(labels, np.float64)
    docs = [tokens([t], buckets)[0] for t in texts]
    hold = np.arange(len(docs)) % 5 == 4
    if not y[~hold].any() or y[~hold].all():
        net.thresholds, net.shift = {}, -30.0 if not y.any() else 30.0
        return net
    net.fit([d for d, h in zip(docs, hold, strict=True) if not h], y[~hold], rng)
    kept, held_y = [t for t, h in zip(texts, hold, strict=True) if h], y[hold]
    net.scale, net.shift = 1.0, 0.0
    z = np.concatenate([net.logits(*tokens([t], buckets)) for t in kept]) if kept else np.empty(0)
    cut = best_threshold(z, held_y) if len(z) else 0.0
    cut = 0.0 if not np.isfinite(cut) else cut
    # the score is monotone in the logit and is DECISION at the best threshold over all languages
    net.shift = float(np.log(DECISION / (1 - DECISION)) - net.scale * cut)
    s = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -30, 30)))
    held_langs = np.array([x if x is not None else "" for x, h in zip(langs, hold, strict=True) if h], object)
    for lang in set(held_langs):
        mine = held_langs == lang
        if mine.sum() >= LEAST_ROWS[0] and held_y[mine].sum() >= LEAST_ROWS[1]:
            net.thresholds[lang] = best_threshold(s[mine], held_y[mine])
    return net


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null is an id of its own."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))), F.lit(n))


def drawn(docs: DataFrame, y: DataFrame, sample: tuple, sample_bytes: int, seed: int) -> DataFrame:
    """y (doc_id, toxic) with fit: whether the row is drawn for the fit, a bounded number of rows and bytes.

    Ids of the rows that might be drawn, some thousands by parameter, are broadcast to add up their texts' bytes.
    """
    n = {r["toxic"]: r["count"] for r in y.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    spared = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(5)) == 4
    part = {k: min(1.0, sample[1 - k] / max(1, n.get(k, 0))) for k in (0, 1)}
    fit = lambda share: ~spared & (draw < F.when(F.col("toxic") == 1, share * part[1]).otherwise(share * part[0]))
    some = y.filter(fit(1.0)).select("doc_id")
    held = docs.select("doc_id", F.octet_length("text").cast("long").alias("bytes")).join(F.broadcast(some), "doc_id")
    size = held.groupBy("doc_id").agg(F.max("bytes").alias("bytes")).agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    return y.withColumn("fit", fit(min(1.0, sample_bytes / max(1, size))))


def untaught() -> Net:
    """A net that rejects nothing."""
    net = Net(np.random.default_rng(SEED))
    net.shift = -30.0
    return net


def fitted(docs: DataFrame, labels: DataFrame, sample: tuple = SAMPLE, seed: int = SEED, sample_bytes: int = SAMPLE_BYTES) -> Net:
    """Trains on a bounded sample of labelled documents whose fold of 3 is not 1, and sets thresholds on all the others.

    labels: doc_id, toxic; a document that is labelled twice counts as toxic if once so, and of rows that repeat a doc_id
    one text is learned from.  The sample is bounded by rows and bytes, so that one task fits the net; the driver gets
    the net alone.
    """
    y = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
    y = y.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    y = written(drawn(docs, y, sample, sample_bytes, seed), "drawn")
    texts = docs.select("doc_id", "text").join(F.broadcast(y.filter("fit").select("doc_id", "toxic")), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.max(F.struct("text", "toxic")).alias("t")).select(F.col("doc_id").cast("string").alias("doc_id"), "t.*")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng, buckets = np.random.default_rng(seed), Buckets()
        rows = [(d, tokens([t], buckets)[0], int(v)) for b in batches for d, t, v in zip(b["doc_id"], b["text"], b["toxic"], strict=True)]
        rows.sort(key=lambda r: r[0])
        rows = [rows[i] for i in rng.permutation(len(rows))]
        net, known = Net(rng), np.array([r[2] for r in rows], np.float64)
        if known.any() and not known.all():
            net.fit([r[1] for r in rows], known, rng)
            net.forget()
        else:
            net.shift = 30.0 if known.any() else -30.0
        yield pd.DataFrame({"net": [zlib.compress(pickle.dumps(net), 1)]})

    held = texts.coalesce(1).mapInPandas(fit, "net binary").first()
    net = pickle.loads(zlib.decompress(held["net"])) if held else untaught()
    if abs(net.shift) == 30.0:
        return net
    cut, by_lang = cuts(logits_of(docs, y, net))
    # the score is monotone in the logit and is DECISION at the best cut over all languages
    net.shift = float(np.log(DECISION / (1 - DECISION)) - net.scale * (cut if np.isfinite(cut) else 0.0))
    net.thresholds = {x: float(net.squashed(np.float64(c))) for x, c in by_lang.items() if np.isfinite(c)}
    return net


def logits_of(docs: DataFrame, y: DataFrame, net: Net) -> DataFrame:
    """Counts n of docs by lang, z (the logit), toxic and fit, of the documents in y (doc_id, toxic, fit).

    Texts are not shuffled, so all are scored; rows of a doc_id that many share are spread.
    """
    sent = docs.sparkSession.sparkContext.broadcast(zlib.compress(pickle.dumps(net), 1))

    @F.pandas_udf("double")
    def logit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets, model = Buckets(), pickle.loads(zlib.decompress(sent.value))
        for texts in batches:
            yield pd.Series(model.raw(list(texts), buckets))

    cells = docs.filter("doc_id is not null").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), logit("text").alias("z"))
    cells = written(cells.groupBy("doc_id", "lang", "z").agg(F.count(F.lit(1)).alias("n")), "logits")
    facts = written(y.join(cells.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")), "doc_id"), "labelled")
    sent.destroy()
    held = attach(cells, facts, "doc_id", "z", cells.count(), "rows").filter("toxic is not null")
    return written(held.groupBy("lang", "z", "toxic", "fit").agg(F.sum("n").alias("n")), "calibration")


def classify(docs: DataFrame, net: Net) -> DataFrame:
    """docs with score (0 to 1), threshold (its language's, else 0.7) and rejected (score at the threshold or above).

    Whole texts are scored, by their words alone; null and empty texts score as texts without a word.  Rows that repeat
    are kept, no rows give no rows, and columns of docs with these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(zlib.compress(pickle.dumps(net), 1))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets, model = Buckets(), pickle.loads(zlib.decompress(sent.value))
        for texts in batches:
            yield pd.Series(model.scores(list(texts), buckets))

    out = docs.drop("score", "threshold", "rejected").withColumn("score", scored("text"))
    threshold = F.lit(DECISION)
    for lang, t in sorted(net.thresholds.items()):
        threshold = F.when(F.coalesce("lang", F.lit("")) == lang, F.lit(float(t))).otherwise(threshold)
    out = out.withColumn("threshold", threshold)
    return out.withColumn("rejected", F.col("score") >= F.col("threshold"))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """classify() by a net fitted on the labelled rows."""
    small_batches(docs.sparkSession)
    return classify(docs, fitted(docs, labels, **options))
