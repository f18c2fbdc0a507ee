"""Near duplicates among embeddings: PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import attach, dropped, small_batches, written
from landrank.llm.components import components

#: Least cosine of a link.
THRESHOLD = 0.9
#: Vectors that the bases are fitted on, about, and their bytes at most, and vectors of a length below which it gets none;
#: bases decide how fast pairs are ruled out, not which are linked.
SAMPLE, SAMPLE_BYTES, LEAST_SAMPLE = 20_000, 32 << 20, 100
#: Leading axes by which vectors are put into boxes, and boxes at most; larger ones hold several blocks.
AXES, BOXES = 12, 512
#: Vectors of a block (two blocks meet in a task), of a tile, and leading dimensions of the first and the next steps.
BLOCK, TILE, FIRST, STEP = 8192, 1024, 16, 16
#: Cosines this close to the threshold are computed again from the vectors as given.
CLOSE = 1e-9


class Forest:
    """Union-find over the vectors of a task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float) -> np.ndarray | tuple:
    """Where rows of a and b (unit, rotated) reach the threshold: a matrix of booleans, or rows and columns if few do.

    Leading dimensions are summed first.  By Cauchy-Schwarz what is left adds at most the product of the suffix norms;
    pairs that cannot reach the threshold any more are given up, and when few are left only those go on.
    """
    d = a.shape[1]
    suffix = lambda x, k: np.sqrt(np.maximum(0, (x[:, k:] ** 2).sum(1)))
    k = min(FIRST, d)
    got = a[:, :k] @ b[:, :k].T
    while True:
        alive = got + np.outer(suffix(a, k), suffix(b, k)) >= threshold - CLOSE
        n = int(np.count_nonzero(alive))
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if k == d or n * 20 < alive.size:
            break
        more = min(k + STEP, d)
        got += a[:, k:more] @ b[:, k:more].T
        k = more
    if k == d and n * 20 >= alive.size:
        near = np.abs(got - threshold) <= CLOSE
        out = got >= threshold
        if near.any():
            i, j = np.nonzero(near)
            out[i, j] = (raw_a[i] * raw_b[j]).sum(1) >= threshold
        return out
    i, j = np.nonzero(alive)
    sums = got[i, j]
    while k < d and len(i):
        more = min(k + STEP, d)
        sums = sums + np.einsum("nd,nd->n", a[i, k:more], b[j, k:more])
        k = more
        alive = sums + suffix(a, k)[i] * suffix(b, k)[j] >= threshold - CLOSE
        i, j, sums = i[alive], j[alive], sums[alive]
    near = np.abs(sums - threshold) <= CLOSE
    if near.any():
        sums[near] = (raw_a[i[near]] * raw_b[j[near]]).sum(1)
    return i[sums >= threshold], j[sums >= threshold]


def joined_tile(hit: np.ndarray, rows: int, cols: int, forest: Forest) -> None:
    """Joins what a matrix of links connects, without a look at each link."""
    free = np.ones(hit.shape[0], bool)
    for r in range(hit.shape[0]):
        if not free[r] or not hit[r].any():
            continue
        got_r, got_c = np.zeros(hit.shape[0], bool), np.zeros(hit.shape[1], bool)
        got_r[r] = True
        while True:
            c = hit[got_r].any(0)
            more = hit[:, c].any(1)
            if (c == got_c).all() and (more == got_r).all():
                break
            got_c, got_r = c, more
        free &= ~got_r
        for i in np.nonzero(got_r)[0]:
            forest.join(rows + int(i), rows + r)
        for j in np.nonzero(got_c)[0]:
            forest.join(cols + int(j), rows + r)


def compared(ids: np.ndarray, counts: np.ndarray, raw: np.ndarray, first: int, basis: np.ndarray | None, threshold: float) -> tuple:
    """Links of the first block (rows up to `first`) with the second or, if that is empty, with itself.

    Returns for each row the vectors it links with, counted, and the row with the least id of those it hangs together with.
    """
    x = unit(raw)
    z, n = x if basis is None else x @ basis, len(raw)
    links, forest = np.zeros(n), Forest(n)
    own = first == n
    for i in range(0, first, TILE):
        ie = min(i + TILE, first)
        for j in range(i if own else first, n, TILE):
            je = min(j + TILE, n)
            hit = linked(z[i:ie], z[j:je], x[i:ie], x[j:je], threshold)
            if isinstance(hit, tuple):
                r, c = hit[0] + i, hit[1] + j
                if own and i == j:
                    r, c = r[r < c], c[r < c]
                links += np.bincount(r, counts[c], n) + np.bincount(c, counts[r], n)
                for p, q in zip(r.tolist(), c.tolist(), strict=True):
                    forest.join(p, q)
            else:
                if own and i == j:
                    hit = np.triu(hit, 1)
                links[i:ie] += hit @ counts[j:je]
                links[j:je] += counts[i:ie] @ hit
                joined_tile(hit, i, j, forest)
    return links, np.array([forest.root(i) for i in range(n)], np.int64)


class Boxes:
    """A tree of cuts, each on the axis that is widest in its part of the sample, at the widest gap of its middle third."""

    def __init__(self, points: np.ndarray, leaves: int) -> None:
        self.axis, self.cut, self.down = [0], [0.0], [(0, 0)]
        parts = {0: np.arange(len(points))}
        while len(parts) < leaves:
            node = max(parts, key=lambda k: len(parts[k]))
            rows = parts[node]
            if len(rows) < 2:
                break
            axis = int(np.argmax(points[rows].std(0)))
            own = np.sort(points[rows, axis])
            first = (len(own) - 1) // 3
            k = first + int(np.argmax(np.diff(own[first:len(own) - first])))
            cut = float((own[k] + own[k + 1]) / 2)
            low = points[rows, axis] < cut
            if low.all() or not low.any():
                break
            del parts[node]
            self.axis[node], self.cut[node], self.down[node] = axis, cut, (len(self.axis), len(self.axis) + 1)
            for side in (low, ~low):
                parts[len(self.axis)] = rows[side]
                self.axis.append(0)
                self.cut.append(0.0)
                self.down.append((0, 0))
        self.leaf = {node: k for k, node in enumerate(sorted(parts))}

    def of(self, points: np.ndarray) -> np.ndarray:
        """The number of each point's leaf."""
        out, todo = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node in self.leaf:
                out[rows] = self.leaf[node]
            elif len(rows):
                low = points[rows, self.axis[node]] < self.cut[node]
                todo += [(self.down[node][0], rows[low]), (self.down[node][1], rows[~low])]
        return out


def leading(x: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    """The leading coordinates of unit vectors and the length of what is left: no farther apart than the vectors are."""
    z = x[:, :AXES] if basis is None else x @ basis[:, :AXES]
    out = np.zeros((len(x), AXES + 1))
    out[:, :z.shape[1]] = z
    out[:, AXES] = np.sqrt(np.maximum(0, 1 - (z * z).sum(1)))
    return out


def near_boxes(lows: np.ndarray, highs: np.ndarray, reach: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each box those whose points may be within reach of its own."""
    for i in range(len(lows)):
        gap = np.maximum(0, np.maximum(lows - highs[i], lows[i] - highs))
        yield i, np.flatnonzero((gap * gap).sum(1) <= reach * reach)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, seed: int = 4) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (vec_id, embedding).

    Equal vectors are compared once, as one with a count.  Distinct ones are put into boxes by their leading principal
    axes and the length that these leave, and boxes are cut into blocks; two blocks meet in a task unless their boxes are
    too far apart, and no pair leaves a task, only sums and each vector's least neighbour by way of links.  Vectors that
    are null or zero, or hold null or non-finite components, link with nothing; others link within their length, each
    length with boxes and a basis of its own.  Rows that repeat a vec_id count as vectors of their own; a null vec_id
    links nothing and is its own component; very long vectors are compared whole; no rows give no rows; other columns are
    not read.
    """
    small_batches(vectors.sparkSession, 4096)
    spark, total = vectors.sparkSession, vectors.count()
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda e: e != 0)
    v = v.withColumn("key", F.when(F.coalesce(good, F.lit(False)), F.md5(F.concat_ws(",", F.col("embedding").cast("array<string>")))))
    v = written(v, "vectors")
    distinct = written(v.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("embedding").alias("embedding")), "distinct")
    size = F.size("embedding")
    lengths = {r["d"]: r["count"] for r in distinct.groupBy(size.alias("d")).count().orderBy("d").collect()}
    if not lengths:  # nothing can link
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    # lengths are drawn from alike, but each gets an equal share of a sample at least
    rows = sum(lengths.values())
    most = max(1, min(SAMPLE, SAMPLE_BYTES * rows // (8 * sum(d * n for d, n in lengths.items()))))
    shares = {d: min(1.0, max(most / rows, min(most, SAMPLE_BYTES // (8 * d)) / len(lengths) / n)) for d, n in lengths.items()}
    rate = F.element_at(F.create_map(*[F.lit(x) for d in shares for x in (d, int((1 << 30) * shares[d]))]), size)
    draw = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) < rate
    held: dict[int, list] = {d: [] for d in lengths}
    for x in distinct.filter(draw).select("embedding").toPandas()["embedding"]:
        held[len(x)].append(x)
    trees, bases, n_boxes = {}, {}, 0
    for d, n in lengths.items():
        u = unit(np.array(held.pop(d), np.float64).reshape(-1, d))
        if len(u) >= LEAST_SAMPLE:
            bases[d] = np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()
        tree = Boxes(leading(u, bases.get(d)), max(1, min(-(-n // block), BOXES * n // rows)))
        trees[d] = n_boxes, tree
        n_boxes += len(tree.leaf)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, part in b.groupby(b["embedding"].map(len)):
                at, (first, tree) = leading(unit(np.stack(part["embedding"].to_numpy())), bases.get(d)), trees[d]
                yield part.assign(at=list(at), box=(first + tree.of(at)).astype(np.int32))

    reps = written(distinct.mapInPandas(placed, "key string, rep long, n long, embedding array<double>, at array<double>, box int"), "reps")
    dropped(distinct)
    ends = [f(F.col("at")[k]).alias(f"{name}{k}") for k in range(AXES + 1) for name, f in (("low", F.min), ("high", F.max))]
    boxes = reps.groupBy("box").agg(F.count(F.lit(1)).alias("rows"), F.first(size).alias("d"), *ends).orderBy("box").toPandas()  # BOXES rows, or one a length
    lows, highs = (boxes[[f"{x}{k}" for k in range(AXES + 1)]].to_numpy() for x in ("low", "high"))
    blocks = np.maximum(1, -(-boxes["rows"].to_numpy() // block))
    # unit vectors of cosine t differ by sqrt(2 - 2t)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    number, length = boxes["box"].to_numpy(), boxes["d"].to_numpy()
    near = [(int(number[i]), int(number[j]), int(blocks[i]), int(blocks[j])) for i, others in near_boxes(lows, highs, reach) for j in others.tolist() if length[i] == length[j]]
    near = spark.createDataFrame(pd.DataFrame(near, columns=["box", "other", "own_blocks", "blocks"]))
    # BOXES squared rows at most (or those of each length with itself)
    sides = reps.select("rep", "n", "embedding", "box").join(F.broadcast(near), "box")
    one = F.struct("box", F.pmod(F.xxhash64("rep"), F.col("own_blocks")).alias("block"))
    sides = sides.withColumn("one", one).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = sides.withColumn("two", F.struct(F.col("other").alias("box"), F.col("block").cast("long").alias("block")))
    both = sides.select("rep", "n", "embedding", F.least("one", "two").alias("i"), F.greatest("one", "two").alias("j"), (F.col("one") > F.col("two")).cast("int").alias("side"))
    both = both.select("rep", "n", "embedding", "side", F.col("i.box").alias("i"), F.col("i.block").alias("ib"), F.col("j.box").alias("j"), F.col("j.block").alias("jb"))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "rep"], kind="stable")
        ids, counts = pdf["rep"].to_numpy(), pdf["n"].to_numpy(np.float64)
        first = int((pdf["side"] == 0).sum())
        own = pdf["i"].iloc[0] == pdf["j"].iloc[0] and pdf["ib"].iloc[0] == pdf["jb"].iloc[0]
        if not own and first in (0, len(pdf)):
            return pd.DataFrame({"rep": [], "links": [], "least": []})
        links, root = compared(ids, counts, np.stack(pdf["embedding"].to_numpy()), len(pdf) if own else first, bases.get(len(pdf["embedding"].iloc[0])), threshold)
        least = pd.Series(ids).groupby(root).transform("min").to_numpy()
        some = links > 0
        return pd.DataFrame({"rep": ids[some], "links": links[some].astype(np.int64), "least": least[some]})

    met = written(both.groupBy("i", "ib", "j", "jb").applyInPandas(meet, "rep long, links long, least long"), "met")
    parts = components(met.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    sums = met.groupBy("rep").agg(F.sum("links").alias("links"))
    facts = reps.select("key", "rep", "n").join(sums, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    facts = facts.select("key", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = attach(v.select("vec_id", "key"), written(facts, "facts"), "key", "vec_id", total)
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "vec_id").alias("component_id"),
                      F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))
