"""Jaccard join of documents as sets of word n-grams: cells, pivots with Voronoi regions, and windows between them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landrank.llm.common import attach, dropped, freed, removed, scratch, small_batches, written
from landrank.llm.components import components
from landrank.llm.vectors import Forest

#: Ratio of the largest to the smallest set of a size band, classes over those that are needed and often empty, and
#: classes for each that is needed, at least.
BAND, SPARE, ROOM = 1.5, 2, 1.15
#: Documents in which frequent shingles are sought, about, in how many of them one must occur, and how many are kept.
SAMPLE, FREQUENT, MOST_FREQUENT = 8000, 4, 100_000
#: Text bytes for each bucket of cells, and buckets at least and at most.  A tie is repeated in each bucket in which two
#: documents share a cell, so with buckets as many as a document has cells from the start, ties grow as documents do.
BUCKET_BYTES, LEAST_BUCKETS, BUCKETS = 20 << 20, 128, 1 << 20
#: Shingles that one task joins, and what a set counts besides its own: a cluster above is split into regions, small ones
#: go together.
TASK_SHINGLES, SET_WEIGHT = 2_000_000, 50
#: Documents sketched at a time; fewer than two bytes count.
AT_ONCE = 1000
#: Pivots of a region, members below which all pairs are looked at, and splits of a cluster over tasks.
PIVOTS, LEAF, SPLITS = 8, 64, 3
#: A cluster is split by pivots if no part has more than SHRUNK of its shingles and all have no more than GROWN times those.
SHRUNK, GROWN = 0.7, 1.5
#: Cells of a table of members and the shingles that they share, at most, its shingles for each that a member has on
#: average, and its rows that are multiplied at a time.
TABLE, WIDE, ROWS = 1 << 24, 16, 256
#: Shingles that are told apart at a time.
APART = 200_000

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words(dict):
    """64-bit hashes of words; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def shingles(text: str | None, size: int, words: Words) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; fewer words than `size` make one shingle, none make none."""
    if not text:
        return np.empty(0, _U)
    split = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not split:
        return np.empty(0, _U)
    w = np.array(list(map(words.__getitem__, split)), _U)
    n = len(w) - size + 1
    if n < 1:
        size, n = len(w), 1
    h = np.full(n, _U(size))
    for i in range(size):
        h = mixed(h + w[i:i + n])
    return np.unique(h)


def differing(total: int, threshold: float) -> int:
    """Most shingles in one of two linked sets alone, given the sum of their sizes."""
    return int(total * (1 - threshold) / (1 + threshold) + 1e-9)


def least_shared(n: np.ndarray, threshold: float) -> np.ndarray:
    """Shingles that sets of n share with any partner, at least."""
    return -(-n * round(100 * threshold) // 100)


def bands(n: int, threshold: float) -> list[tuple[int, int, int]]:
    """(band, largest size, classes) of the bands in which a set of n shingles looks for partners: its own, and the
    next above if a partner may be there."""
    band = int(np.floor(np.log(n) / np.log(BAND) + 1e-12))
    out = [band]
    if n >= threshold * BAND ** (band + 1) - 1e-6:
        out.append(band + 1)
    found = []
    for b in out:
        most = int(BAND ** (b + 1))
        classes = differing(2 * most, threshold) + 1
        empty = classes * np.exp(-most / classes)  # classes that are empty in a set of the largest size, on average
        found.append((b, most, max(classes + int(np.ceil(empty + 4 * np.sqrt(empty))) + SPARE, int(np.ceil(ROOM * classes)))))
    return found


def cells(hashes: np.ndarray, threshold: float, frequent: np.ndarray | None = None) -> np.ndarray:
    """Keys such that two linked, different sets share one.

    Frequent shingles are left out first, from all sets the same ones: sets then differ by no more than before, and
    passages that many documents quote don't bring those together.  The hash range is cut into more classes than linked
    sets of the band have differing shingles, so at least the rest hold the same shingles in both.  A key is band, class and the class's shingles.

    Classes of few shingles fall together by chance, in numbers that grow with the square of the documents, so each set
    leaves out the classes of up to j shingles, for the largest j with fewer of those than classes that it must share
    with any partner.  Of two linked sets, the one with the larger j then has a shared class above it, and a shared class
    is as large in the other, so both have its key.
    """
    n, out = len(hashes), []
    if not n or differing(n + int(n / threshold), threshold) < 1:
        return np.empty(0, _U)  # linked sets are equal
    if frequent is not None and len(frequent):
        hashes = hashes[frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] != hashes]
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mixed(hashes ^ _U(0x9E3779B97F4A7C15)))])
    for band, most, classes in bands(n, threshold):
        edges = (np.arange(1, classes, dtype=np.float64) * (2.0 ** 64 / classes)).astype(_U)
        at = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
        keys = mixed(mixed(sums[at[1:]] - sums[at[:-1]]) + _U(band * 1_000_003) + np.arange(classes, dtype=_U) * _U(0x9E3779B97F4A7C15))
        held = np.diff(at)
        same = classes - differing(n + min(most, int(n / threshold)), threshold)
        out.append(keys[held >= np.searchsorted(np.cumsum(np.bincount(held)), same)])
    return np.concatenate(out)


def digest(hashes: np.ndarray) -> str:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest()


# -- the join within a region ----------------------------------------------------------------------------------------

class Region:
    """Sets that are joined in one task: their shingles one after the other, as numbers from 0."""

    def __init__(self, sets: list[np.ndarray], threshold: float) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        _, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.mark = np.zeros(int(self.flat.max()) + 1, bool)
        self.threshold, self.root = threshold, np.arange(len(sets))

    def clusters(self) -> list[np.ndarray]:
        """Members of which linked ones are together: those that hang together by shingles that are rare here.

        With shingles put in order, the rarest first, two linked sets share one of the first n less the least number that
        a set of n shares with a partner, and one more.
        """
        n_sets, held = len(self.sizes), np.bincount(self.flat)
        rank = np.empty(len(held), np.int64)
        rank[np.argsort(held, kind="stable")] = np.arange(len(held))
        own = np.repeat(np.arange(n_sets), self.sizes)
        at = np.sort(own * len(held) + rank[self.flat]) - own * len(held)
        early = np.arange(len(at)) - self.starts[own] <= (self.sizes - least_shared(self.sizes, self.threshold))[own]
        early &= np.sort(held)[at] > 1
        at, own = at[early], own[early]
        order = np.argsort(at, kind="stable")
        at, own = at[order], own[order]
        first = np.concatenate([[True], at[1:] != at[:-1]])[:len(at)]
        lead = own[first][np.cumsum(first) - 1]
        forest = Forest(n_sets)
        for tie in np.unique(own * n_sets + lead).tolist():
            forest.join(*divmod(tie, n_sets))
        root = np.array([forest.root(i) for i in range(n_sets)], np.int64)
        order = np.argsort(root, kind="stable")
        return [x for x in np.split(order, np.flatnonzero(np.diff(root[order])) + 1) if len(x) > 1]

    def shared(self, one: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of one set with others."""
        own = self.flat[self.starts[one]:self.starts[one + 1]]
        self.mark[own] = True
        n = self.sizes[others]
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        spots = np.arange(int(n.sum())) - np.repeat(begin, n) + np.repeat(self.starts[others], n)
        out = np.add.reduceat(self.mark[self.flat[spots]].astype(np.int64), begin)
        self.mark[own] = False
        return out

    def meet(self, one: int, others: np.ndarray) -> np.ndarray:
        """Distances of one set from others; those that reach the threshold are joined to it."""
        both = self.shared(one, others)
        union = self.sizes[one] + self.sizes[others] - both
        # in whole numbers, as the threshold is given in hundredths
        near = others[100 * both >= round(100 * self.threshold) * union]
        self.tie(np.full(len(near), one), near)
        return 1 - both / union

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        """Puts a[i] and b[i] together, for every i; the least of what hangs together is its root."""
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            up = np.arange(len(self.root))
            np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
            while (up[up] != up).any():
                up = up[up]
            self.root = up[self.root]

    def table(self, members: np.ndarray) -> np.ndarray | None:
        """Members by the shingles that several of them hold, 1 where one does; none if that is too large."""
        n = self.sizes[members]
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        spots = np.arange(int(n.sum())) - np.repeat(begin - self.starts[members], n)
        _, at, held = np.unique(self.flat[spots], return_inverse=True, return_counts=True)
        wide = int((held > 1).sum())
        if wide * len(members) > TABLE or wide > WIDE * n.mean():
            return None
        use = (held > 1)[at]
        out = np.zeros((len(members), wide), np.float32)
        out[np.repeat(np.arange(len(members)), n)[use], (np.cumsum(held > 1) - 1)[at[use]]] = 1
        return out

    def pairs(self, members: np.ndarray, core: np.ndarray, apart: np.ndarray | None = None) -> None:
        """Looks at each core member against all members that may be near it and don't hang together with it yet."""
        if (whole := self.table(members)) is not None:
            n, every = self.sizes[members], np.flatnonzero(core)
            for rows in np.split(every, range(ROWS, len(every), ROWS)) if len(every) else []:
                first = int(rows[0]) if len(every) == len(members) else 0
                both = np.rint(whole[rows] @ whole[first:].T).astype(np.int64)
                i, j = np.nonzero(100 * both >= round(100 * self.threshold) * (n[rows][:, None] + n[first:] - both))
                self.tie(members[rows[i]], members[first + j])
            return
        eps = 1 - self.threshold + 1e-9
        for k in np.nonzero(core)[0]:
            one = int(members[k])
            n = self.sizes[members]
            may = (n >= self.threshold * self.sizes[one] - 1e-6) & (n * self.threshold <= self.sizes[one] + 1e-6)
            may &= ~core | (np.arange(len(members)) > k)
            if apart is not None:
                may &= (np.abs(apart - apart[k]) <= eps).all(1)
            others = members[may]
            if len(others):
                others = others[self.root[others] != self.root[one]]
            if len(others):
                self.meet(one, others)

    def join(self, members: np.ndarray, core: np.ndarray, depth: int = 0) -> None:
        """Joins all linked pairs of which one is in core and both are members.

        Pivots drawn from the members cut them into Voronoi regions.  If x is nearest to pivot p and y is linked with
        x, then d(y, p) <= d(y, q) + 2 eps for every pivot q, and d(x, q) and d(y, q) differ by eps at most: so much of
        the other regions is replicated into p's, and the region is joined in the same way.  Where that does not shrink
        all regions, the pairs that the windows leave are looked at.
        """
        if (self.root[members] == self.root[members[0]]).all():
            return None
        if len(members) <= LEAF:
            return self.pairs(members, core)
        eps = 1 - self.threshold + 1e-9
        pivots = members[np.random.default_rng(depth).choice(len(members), PIVOTS, replace=False)]
        d = np.stack([self.meet(int(p), members) for p in pivots], axis=1)
        nearest, home = d.min(1), d.argmin(1)
        parts = []
        for k in range(PIVOTS):
            mine = home == k
            if not mine.any():
                continue
            low, high = d[mine].min(0) - eps, d[mine].max(0) + eps
            window = ~mine & (d[:, k] <= nearest + 2 * eps) & ((d >= low) & (d <= high)).all(1)
            # pairs of a core member here with any member of the window, and of a core member there with one here, are
            # both met if the window's core members are looked at from here
            keep = mine | window
            if (keep & core).any() and keep.sum() > 1:
                parts.append(keep)
        if depth == 12 or any(keep.sum() > 0.7 * len(members) for keep in parts):
            return self.pairs(members, core, d)
        for keep in parts:
            self.join(members[keep], core[keep], depth + 1)


def region_links(ids: np.ndarray, sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """(id, least id it hangs together with) for those that differ."""
    if len(sets) < 2:
        return []
    order = np.argsort(ids, kind="stable")
    region = Region([sets[i] for i in order], threshold)
    for members in region.clusters() if len(sets) > LEAF else [np.arange(len(sets))]:
        region.join(members, np.ones(len(members), bool))
    ids = ids[order]
    return [(int(ids[i]), int(ids[r])) for i, r in enumerate(region.root.tolist()) if i != r]


# -- the join over tasks ---------------------------------------------------------------------------------------------

#: Bytes of a cell key within its bucket: two cells that fall together only put more documents into a cluster.
KEY_BYTES = 5

HELD = "node long, doc_id long, h long, n long, digest string, bucket int, keys binary, nodes binary, a long, b long, part int"


def frequent_shingles(docs: DataFrame, size: int, total: int, seed: int = 8) -> np.ndarray:
    """Sorted hashes of shingles that many of a sample of documents hold; whatever they are, results are the same."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for b in batches:
            own = [shingles(t, size, words) for t in b["text"]]
            if own:
                yield pd.DataFrame({"h": np.concatenate(own).view(np.int64)})

    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(1, total)))
    texts = docs.filter(draw & F.col("text").isNotNull()).select("text").distinct()
    n = texts.mapInPandas(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FREQUENT)
    rows = n.orderBy(F.col("n").desc(), "h").limit(MOST_FREQUENT).select("h").toPandas()["h"]
    return np.sort(rows.to_numpy(np.int64).view(_U))


def sketched(docs: DataFrame, size: int, threshold: float, buckets: int, frequent: np.ndarray) -> DataFrame:
    """A row for each document (node, doc_id, n, digest), packs of cell keys by bucket, and edges found on the way.

    A key that several documents of a batch share is sent on once, and they are tied to each other at once, so a cell
    that a large part of all rows share sends one key a batch.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        words, base = Words(), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        names = [x.split()[0] for x in HELD.split(", ")]
        none = [None] * 4
        for b in (whole.iloc[at:at + AT_ONCE] for whole in batches for at in range(0, len(whole), AT_ONCE)):
            rows, keys, owners = [], [], []
            for k, (doc_id, text, own) in enumerate(zip(b["doc_id"], b["text"], b["h"], strict=True)):
                h = shingles(text, size, words)
                known = doc_id is not None
                rows.append((base + k, int(doc_id) if known else None, own, len(h), digest(h) if len(h) and known else None, *none, None, 0))
                if known and len(h):
                    mine = cells(h, threshold, frequent)
                    keys.append(mine)
                    owners.append(np.full(len(mine), base + k, np.int64))
            if keys and sum(map(len, keys)):
                key, owner = np.concatenate(keys), np.concatenate(owners)
                order = np.argsort(key, kind="stable")
                key, owner = key[order], owner[order]
                first = np.concatenate([[True], key[1:] != key[:-1]])
                lead = owner[first][np.cumsum(first) - 1]
                ties = np.unique(np.stack([owner[~first], lead[~first]], axis=1), axis=0)
                rows += [(*none, None, None, None, None, int(x), int(y), 1) for x, y in ties if x != y]
                key, owner = key[first], owner[first]
                bucket = (key >> _U(8 * KEY_BYTES)) % _U(buckets)
                order = np.argsort(bucket, kind="stable")
                key, owner, bucket = key[order], owner[order], bucket[order].astype(np.int64)
                cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                for s, e in zip(cut, [*cut[1:], len(key)], strict=True):
                    # a node is sent as its distance from the batch's first, which two bytes hold
                    own = np.ascontiguousarray(key[s:e]).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
                    rows.append((base, *none, int(bucket[s]), own.tobytes(), (owner[s:e] - base).astype(np.uint16).tobytes(), None, None, 2))
            base += len(b)
            out = pd.DataFrame(rows, columns=names)
            for c in ("node", "n", "bucket", "a", "b"):
                out[c] = out[c].astype("Int64")
            for k, c in ((1, "doc_id"), (2, "h")):  # of 64 bits, so not by way of doubles
                out[c] = pd.array([r[k] for r in rows], "Int64")
            yield out

    return docs.select(F.col("doc_id").cast("string"), "text", F.xxhash64("text").alias("h")).mapInPandas(run, HELD)


def cell_edges(packs: DataFrame) -> DataFrame:
    """Ties the documents that share a cell: each to the least of them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")  # then the first of equal keys is the least node's
        raw = np.frombuffer(b"".join(pdf["keys"]), np.uint8).reshape(-1, KEY_BYTES)
        key = np.zeros((len(raw), 8), np.uint8)
        key[:, :KEY_BYTES] = raw
        del raw
        key = key.view(_U).ravel()
        order = np.argsort(key, kind="stable").astype(np.int32)
        key = key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        del key
        lead = np.flatnonzero(first)[np.cumsum(first)[~first] - 1]
        pack = np.repeat(np.arange(len(pdf), dtype=np.int32), [len(x) // 2 for x in pdf["nodes"]])
        away = np.frombuffer(b"".join(pdf["nodes"]), np.uint16)
        node = lambda at: pdf["node"].to_numpy(np.int64)[pack[at]] + away[at]
        ties = np.unique(np.stack([node(order[~first]), node(order[lead])], axis=1), axis=0)
        return pd.DataFrame({"a": ties[:, 0], "b": ties[:, 1]})

    return packs.select("bucket", "node", "keys", "nodes").groupBy("bucket").applyInPandas(run, "a long, b long")


def linked_regions(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """region_links() of each region in pdf (region, cid, shingles)."""
    out = []
    for _, part in pdf.groupby("region", sort=False):
        part = part.drop_duplicates("cid")
        out += region_links(part["cid"].to_numpy(), [np.frombuffer(x, _U) for x in part["shingles"]], threshold)
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def joined(sets: DataFrame, threshold: float) -> DataFrame:
    """Links of sets (region, cid, n, digest, shingles binary) within each region, as ties (a, b) of cids.

    Small regions go together to tasks.  One of more than TASK_SHINGLES is first cut by rare shingles, see parted(), then
    by pivots into Voronoi regions with windows, as in Region.join(), where that makes it smaller, up to SPLITS - 1 times;
    of what is larger still, blocks meet pairwise.
    """
    sets = written(sets, "sets")
    ties = None
    for level in range(SPLITS + 1):
        size = sets.groupBy("region").agg(F.sum(F.col("n") + SET_WEIGHT).alias("weight"), F.count(F.lit(1)).alias("n_all"))
        size = written(size, "sizes")
        total = size.agg(F.sum("weight").alias("w"), F.max("weight").alias("m"), F.sum("n_all").alias("n")).first()

        def sized(facts: DataFrame, sets: DataFrame = sets, n: int = total["n"] or 1) -> DataFrame:
            return attach(sets, facts.withColumn("n", F.col("n_all")), "region", "cid", n, n="n").drop("n_all")

        rows = sized(size)
        few = rows.filter(F.col("weight") <= TASK_SHINGLES)
        tasks = max(1, -(-(total["w"] or 0) // TASK_SHINGLES)) * 4
        few = few.withColumn("task", F.pmod(F.xxhash64("region"), F.lit(tasks)))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return linked_regions(pdf, threshold)

        met = few.select("task", "region", "cid", "shingles").groupBy("task").applyInPandas(run, "a long, b long")
        many = rows.filter(F.col("weight") > TASK_SHINGLES)
        large, after = (total["m"] or 0) > TASK_SHINGLES, None
        if large and level == 0:
            after = parted(many, threshold)
        elif large:
            cut = None
            if level < SPLITS:
                placed = written(voronoi(many, threshold, level), "placed")
                part = placed.groupBy("region", "to").agg(F.sum(F.col("n") + SET_WEIGHT).alias("w"))
                part = part.groupBy("region").agg(F.max("w").alias("most"), F.sum("w").alias("all"))
                cut = size.join(part, "region").filter((F.col("most") <= SHRUNK * F.col("weight")) & (F.col("all") <= GROWN * F.col("weight")))
                cut = written(cut.select("region", "n_all", F.lit(True).alias("cut")), "cut")
                after = sets.join(placed.select("region", "cid", "to"), ["region", "cid"]).join(cut.select("region"), "region", "left_semi")
                after = after.select(F.col("to").alias("region"), "cid", "n", "digest", "shingles")
                many = sized(size.join(cut.drop("n_all"), "region", "left")).filter((F.col("weight") > TASK_SHINGLES) & F.col("cut").isNull())
            # blocks by hash; a pair of blocks is a region of its own
            many = many.withColumn("blocks", F.ceil(2 * F.col("weight") / F.lit(TASK_SHINGLES)))
            many = many.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
            many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            pair = F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other"))
            blocks = many.withColumn("task", pair).withColumn("region", pair).select("task", "region", "cid", "shingles")
            met = met.unionByName(blocks.groupBy("task").applyInPandas(run, "a long, b long"))
        met = written(met, "ties")
        ties = met if ties is None else ties.unionByName(met)
        if after is None:
            break
        after = written(after, "sets")
        dropped(sets)
        freed(sets.sparkSession)
        sets = after
    return ties


def parted(many: DataFrame, threshold: float) -> DataFrame:
    """Cuts regions into what hangs together by rare shingles, as Region.clusters() does: linked sets stay together.

    Sets that share no such shingle have no links and are left out.
    """
    def apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held, got = [], 0
            for k, (region, cid, shingles) in enumerate(zip(b["region"], b["cid"], b["shingles"], strict=True)):
                h = mixed(np.frombuffer(shingles, _U) ^ mixed(np.array([region], np.int64).view(_U)))
                held.append((cid, h))
                got += len(h)
                if got >= APART or k == len(b) - 1:
                    n = np.array([len(h) for _, h in held])
                    yield pd.DataFrame({"cid": np.repeat(np.array([c for c, _ in held], np.int64), n), "n": np.repeat(n, n), "h": np.concatenate([h for _, h in held]).view(np.int64)})
                    held, got = [], 0

    rows = many.select("region", "cid", "shingles").mapInPandas(apart, "cid long, n long, h long")
    shared = rows.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("h"))).filter("held > 1")
    own = Window.partitionBy("cid")
    shared = shared.withColumn("shared", F.count(F.lit(1)).over(own)).withColumn("nth", F.row_number().over(own.orderBy("held", "h")))
    # those that no other set holds come first, so they are left out of both counts
    least = F.ceil(F.col("n") * round(100 * threshold) / 100)
    early = shared.filter(F.col("nth") <= F.col("shared") - least + 1).select("cid", "h")
    ties = early.select(F.col("cid").alias("a"), F.min("cid").over(Window.partitionBy("h")).alias("b"))
    parts = components(ties.filter("a <> b").distinct()).select(F.col("node").alias("cid"), F.col("component").alias("part"))
    return many.join(parts, "cid").select(F.col("part").alias("region"), "cid", "n", "digest", "shingles")


def voronoi(many: DataFrame, threshold: float, level: int) -> DataFrame:
    """Places sets by pivots: (region, cid, n, to) for its nearest pivot's region and for those of whose window it is part."""
    order = F.xxhash64(F.lit(level), "cid")
    chunk = many.withColumn("chunk", F.pmod(F.xxhash64("cid"), F.greatest(F.lit(1), F.ceil(4 * F.col("weight") / F.lit(TASK_SHINGLES)))))
    # pivots: of each of PIVOTS hash classes the set with the least hash
    pivots = many.withColumn("k", F.pmod(F.xxhash64(F.lit(-level), "cid"), F.lit(PIVOTS))).groupBy("region", "k").agg(
        F.min_by(F.struct("cid", "shingles"), order).alias("p"))
    chunks = chunk.select("region", "chunk").distinct()
    pivots = chunks.join(pivots, "region").select(F.col("region").alias("p_region"), F.col("chunk").alias("p_chunk"), "k", "p.shingles")
    eps2 = 2 * (1 - threshold) + 1e-9

    def cut(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(pivots):
            return pd.DataFrame({c: [] for c in ("region", "cid", "n", "to")})
        pivots = pivots.sort_values("k")
        own = [np.frombuffer(x, _U) for x in members["shingles"]]
        d = np.ones((len(own), len(pivots)))
        for j, x in enumerate(pivots["shingles"]):
            p = np.frombuffer(x, _U)
            both = np.array([np.isin(s, p, assume_unique=True).sum() for s in own])
            d[:, j] = 1 - both / (np.array([len(s) for s in own]) + len(p) - both)
        i, j = np.nonzero(d <= d.min(1, keepdims=True) + eps2)
        out = members.iloc[i][["region", "cid", "n"]].reset_index(drop=True)
        salt = int(xxhash.xxh64_intdigest(str(members["region"].iloc[0]).encode(), seed=level)) >> 1
        out["to"] = [(salt + int(k) * 0x9E3779B97F4A7C15) & (1 << 63) - 1 for k in pivots["k"].to_numpy()[j]]
        return out

    return chunk.groupBy("region", "chunk").cogroup(pivots.groupBy("p_region", "p_chunk")).applyInPandas(cut, "region long, cid long, n long, to long")


def jaccard_groups(docs: DataFrame, size: int = 3, threshold: float = 0.9) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash, kept of every row of docs (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets of `size`-word shingles is at least `threshold`
    (hundredths).  Unrelated documents are all at distance 1 from each other and from any pivot, so documents are first
    put into cells (see cells()) of which linked ones share at least one; what hangs together by cells is a cluster, and
    clusters are joined by pivots, Voronoi regions and windows.  Both steps are exact; of equal sets one stands for all.
    kept marks the rows with the least doc_id and text_hash (xxhash64) of their component: one, unless rows repeat.

    Null and empty texts have no shingles and link with nothing; very long ones are whole sets; a null doc_id links with
    nothing and has a null component; rows that repeat a doc_id are documents that its other rows may link with; no rows
    give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    whole = docs.select(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    volume, frequent = whole["bytes"] or 0, frequent_shingles(docs, size, whole["n"])
    path = scratch(spark, "sketches")
    held = sketched(docs, size, threshold, min(BUCKETS, max(LEAST_BUCKETS, volume // BUCKET_BYTES)), frequent)
    held.write.partitionBy("part").parquet(path)
    held = spark.read.schema(held.schema).parquet(path)
    rows = held.filter("part = 0").select("node", "doc_id", "h", "n", F.coalesce("digest", F.concat(F.lit("none:"), "node")).alias("digest"))
    # written, so that no task has workers for cells and for components at a time
    met = written(cell_edges(held.filter("part = 2")), "cell-ties")
    clusters = components(held.filter("part = 1").select("a", "b").unionByName(met))
    removed(spark, f"{path}/part=2")
    freed(spark)
    classes = rows.groupBy("digest").agg(F.min("node").alias("cid"), F.min(F.struct("doc_id", "h")).alias("rep"), F.count(F.lit(1)).alias("n"), F.max("n").alias("n_shingles"))
    classes = written(classes, "classes")
    members = classes.drop("n").join(clusters.withColumnRenamed("node", "cid"), "cid").withColumnRenamed("component", "region")
    members = written(members, "members")
    weight = F.sum(F.col("n_shingles") + SET_WEIGHT)
    count = members.groupBy("region").agg(F.count(F.lit(1)).alias("n"), weight.alias("weight")).withColumn("classes", F.col("n"))
    members = written(attach(members, count, "region", "cid", max(1, members.count())).filter("classes > 1"), "clusters")
    total = members.agg(weight.alias("w"), F.max("weight").alias("m")).first()
    tasks = 4 * max(1, -(-(total["w"] or 0) // TASK_SHINGLES))
    members = members.withColumn("task", F.when(F.col("weight") <= TASK_SHINGLES, F.pmod(F.xxhash64("region"), F.lit(tasks))))
    # a class's text is that of its representative; rows that repeat it are put together, partly before the shuffle
    wanted = members.select(F.col("rep.doc_id").alias("rep"), F.col("rep.h").alias("rep_h"), "cid", "digest", "region", "task")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.xxhash64("text").alias("rep_h"), "text").join(wanted, ["rep", "rep_h"])

    def sets(b: pd.DataFrame) -> pd.DataFrame:
        words = Words()
        own = [shingles(t, size, words) for t in b["text"]]
        right = np.array([digest(h) == g for h, g in zip(own, b["digest"], strict=True)], bool)
        return pd.DataFrame({"region": b["region"], "cid": b["cid"], "n": [len(h) for h in own], "digest": b["digest"],
                             "shingles": [h.tobytes() for h in own]})[right]

    def few(pdf: pd.DataFrame) -> pd.DataFrame:
        return linked_regions(sets(pdf), threshold)

    if not rows.filter("doc_id is not null").groupBy("doc_id", "h").count().filter("count > 1").isEmpty():
        texts = texts.groupBy("cid", "digest", "region", "task").agg(F.first("text").alias("text"))
    links = written(texts.filter("task is not null").groupBy("task").applyInPandas(few, "a long, b long"), "links")
    if (total["m"] or 0) > TASK_SHINGLES:
        many = texts.filter("task is null").mapInPandas(lambda batches: map(sets, batches), "region long, cid long, n long, digest string, shingles binary")
        links = links.unionByName(joined(many, threshold))
    parts = components(links)
    facts = classes.join(parts.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = facts.groupBy("component").agg(F.min("rep").alias("first"))
    facts = facts.join(least, "component").select("digest", "n", "first")
    out = attach(rows, written(facts, "facts"), "digest", "node", max(1, rows.count()))
    kept = F.struct("doc_id", "h").eqNullSafe(F.col("first"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), F.col("h").alias("text_hash"), kept.alias("kept"))
