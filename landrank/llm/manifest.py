"""Merkle manifests of datasets: levels stored as parent-linked node rows, and a recursive query that climbs them for each leaf.

Every three consecutive nodes are hashed to their parent.  A stored row spans STRIDE such levels: it has a node's siblings
on the way to its ancestor there, so the recursive query takes a step for STRIDE levels, and the number of joins and
shuffles falls likewise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import dropped, starts, written

#: Nodes in a run, and levels that a stored row spans; so many nodes at most are hashed at once.
FAN, STRIDE = 3, 5
SPAN = FAN ** STRIDE
#: Columns that a leaf is the hash of, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<l: binary, r: binary>>"


def leaf_hash(columns: list[Column]) -> Column:
    """H of the values: "-" for null, else the UTF-8 byte count, a colon and the value."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), 256)


def folded(path: Column, start: Column) -> Column:
    """The hash (binary) that a node's ancestor has if the node's is start, by the siblings on the path."""
    text = lambda x: F.lower(F.hex(x))
    return F.aggregate(path, start, lambda a, p: F.unhex(F.sha2(F.concat(text(p["l"]), text(a), text(p["r"])), 256)))


def siblings(path: Column) -> Column:
    """All siblings on the path, one after the other (binary)."""
    return F.aggregate(path, F.lit(b""), lambda a, p: F.concat(a, p["l"], p["r"]))


def depth(n: Column) -> Column:
    """Levels over n nodes until one is left."""
    return F.size(F.filter(F.array(*[F.lit(FAN ** k) for k in range(39)]), lambda p: p < n))


def stride(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """nodes (tree, i, n, hash, keep...), n of a tree numbered from 0, in groups of SPAN: (tree, n, group, top, rows).

    rows has (i, hash, path, keep...) for each node, path the siblings on its way to top, STRIDE levels up or the tree's root.
    """
    g = nodes.groupBy("tree", "n", F.expr(f"i div {SPAN}").alias("group")).agg(F.sort_array(F.collect_list(F.struct("i", "hash", *keep))).alias("held"))
    g = g.withColumns({"up": F.least(F.lit(STRIDE), depth(F.col("n"))), "l0": F.col("held.hash")})
    for t in range(STRIDE):
        level = F.col(f"l{t}")
        above = F.transform(F.sequence(F.lit(0), F.expr(f"(size(l{t}) - 1) div {FAN}")), lambda k: F.sha2(F.array_join(F.slice(level, k * FAN + 1, FAN), ""), 256))  # noqa: B023
        g = g.withColumn(f"l{t + 1}", F.when(F.col("up") > t, above).otherwise(level))
    levels, spans = F.array(*[F.col(f"l{t}") for t in range(STRIDE)]), F.array(*[F.lit(FAN ** t) for t in range(STRIDE)])

    def path(j: Column) -> Column:
        def step(t: Column) -> Column:
            at = F.floor(j / F.get(spans, t)).cast("int")  # exact, as both are small
            own, part = at % FAN, lambda a, k: F.unhex(F.array_join(F.slice(F.get(levels, t), a, k), ""))
            return F.struct(part(at - own + 1, own).alias("l"), part(at + 2, FAN - 1 - own).alias("r"))
        return F.when(F.col("up") > 0, F.transform(F.sequence(F.lit(0), F.col("up") - 1), step)).otherwise(F.expr(f"cast(array() as {_PATH})"))

    rows = F.transform("held", lambda x, j: F.struct(x["i"].alias("i"), x["hash"].alias("hash"), path(j).alias("path"), *[x[c].alias(c) for c in keep]))
    return g.select("tree", "n", "group", F.get(f"l{STRIDE}", F.lit(0)).alias("top"), rows.alias("rows"))


def exploded(groups: DataFrame, keep: list[str]) -> DataFrame:
    """The rows of stride(): tree, n, i, hash, path, keep...  (explode_outer(), as explode() would first compute rows for a filter)"""
    return groups.select("tree", "n", F.explode_outer("rows").alias("x")).select("tree", "n", "x.i", "x.hash", "x.path", *[f"x.{c}" for c in keep])


def replicated(rows: DataFrame, station: int, leaves: Column) -> DataFrame:
    """Rows of nodes at a station, a copy for each block of SPAN leaves below (column block), so that few leaves meet each.

    leaves: how many the tree has.  Copies are made SPAN at a time, with a shuffle in between.
    """
    out = rows.withColumn("block", F.col("i"))
    for s in range(station - 1, 0, -1):
        last = F.expr("ceil(__leaves / {})".format(SPAN ** s)) - 1
        out = out.withColumn("__leaves", leaves).withColumn("block", F.explode_outer(F.sequence(F.col("block") * SPAN, F.least(F.col("block") * SPAN + SPAN - 1, last)))).drop("__leaves")
        if s > 1:
            out = out.repartition("tree", "block")
    return out


def built(leaves: DataFrame, keep: list[str], most: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored rows of all stations over leaves (tree, i, n, hash, keep...), and (tree, top) with each tree's root.

    most: leaves of the largest tree.  Station s has the nodes of level s * STRIDE; `leaves` tells a tree's leaves.
    """
    stations, tops, nodes, s = [], None, leaves.withColumn("leaves", F.col("n")), 0
    while True:
        kept = ["leaves", *(keep if s == 0 else [])]
        groups = written(stride(nodes, kept), f"level-{s * STRIDE}")
        stations.append(groups)
        done = groups.filter(F.col("n") <= SPAN).select("tree", "top", F.get("rows", F.lit(0))["leaves"].alias("leaves"))
        tops = done if tops is None else tops.unionByName(done)
        if most <= SPAN:
            return stations, tops
        nodes = groups.filter(F.col("n") > SPAN).select("tree", F.col("group").alias("i"), F.expr(f"ceil(n / {SPAN})").alias("n"), F.col("top").alias("hash"), F.get("rows", F.lit(0))["leaves"].alias("leaves"))
        most, s = -(-most // SPAN), s + 1


#: A step joins each leaf's node with its stored row, appends the siblings and folds the hash.
CLIMB = """WITH RECURSIVE c(tree, block, station, doc_id, leaf, fold, sibs, subroot, done) AS (
SELECT tree, block, station, doc_id, leaf, fold, sibs, cast(null AS string), false FROM {leaves} UNION ALL
SELECT c.tree, c.block, c.station + 1, c.doc_id, c.leaf,
  aggregate(h.path, c.fold, (a, p) -> unhex(sha2(concat(lower(hex(p.l)), lower(hex(a)), lower(hex(p.r))), 256))), concat(c.sibs, h.sibs), h.subroot, h.last
FROM c JOIN {hops} h ON h.tree = c.tree AND h.block = c.block AND h.station = c.station)
SELECT doc_id, lower(hex(leaf)) AS leaf, subroot, {root} AS root, sha2(lower(hex(sibs)), 256) AS proof_sha256, lower(hex(fold)) AS folded_root, lower(hex(fold)) = {root} AS verified FROM c WHERE done"""


def numbered(docs: DataFrame, columns: tuple) -> tuple[DataFrame, DataFrame]:
    """Leaves (tree, i, n, hash, doc_id, fold) of all rows, and sources (tree, n); tree numbers sources in their order.

    Rows are sorted by range, so many of one source lie in many tasks; a row's number comes from its place in its
    partition and the sizes of those before.  Rows alike in source, doc_id and hash are told apart by where they were read.
    """
    text, value = columns[-1], [F.col(f"`{c}`") for c in columns]
    broken = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, leaf_hash([*value[:-1], F.replace(F.col(f"`{text}`"), F.lit("\n"), F.lit(""))]))
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(value).alias("hash"), broken.alias("fold"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "hash", "tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = written(rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "leaves")
    runs = written(rows.groupBy("part", "source").agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("first")), "runs")
    parts = runs.groupBy("part").agg(F.sum("m").alias("m"), F.min("first").alias("zero"))
    runs = runs.drop("m").join(starts(parts, "part", "m", "start").join(parts.drop("m"), "part"), "part").withColumn("g", F.col("start") + F.col("first") - F.col("zero"))
    sources = runs.groupBy("source").agg(F.min("g").alias("g0"), F.sum("m").alias("unused")).drop("unused")
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    sources = sources.withColumnRenamed("source", "s").join(counts, F.col("s").eqNullSafe(F.col("source"))).select("s", "g0", "n")
    placed = sources.repartitionByRange("g0").sortWithinPartitions("g0").select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = written(placed, "sources")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("zero"))
    placed = placed.join(starts(sizes, "part", "m", "start").join(sizes.drop("m"), "part"), "part").select("s", "g0", "n", (F.col("start") + F.col("at") - F.col("zero")).alias("tree"))
    where = runs.join(placed, F.col("s").eqNullSafe(F.col("source"))).select(F.col("part").alias("p"), "s", "first", F.col("g"), "g0", "n", "tree")
    leaves = rows.join(where, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    return leaves.select("tree", (F.col("g") + F.col("at") - F.col("first") - F.col("g0")).alias("i"), "n", "hash", "doc_id", "fold"), placed.select("tree", "n")


def manifest(docs: DataFrame, columns: tuple = COLUMNS) -> DataFrame:
    """A Merkle tree over docs: for each row doc_id, leaf, subroot (its source's), root, proof_sha256, folded_root, verified.

    Leaves ascend by doc_id (null first; ties by hash) in their source, sources by their bytes (null first).  Where
    crc32(doc_id) is even the text loses its line feeds before the proof is checked; rows without doc_id are never
    tampered with.  Nulls are leaves of their own kind ("-"); empty and very long texts count whole; rows that repeat are
    leaves of their own; further columns, whatever their names, are not read; no rows give no rows.

    No task holds more than SPAN nodes of a tree, and a stored row of an upper level is there once for every SPAN leaves,
    so a source with most of the rows, and the root itself, are met by many tasks.
    """
    spark = docs.sparkSession
    leaves, sources = numbered(docs, columns)
    sources = written(sources, "trees")
    n_sources, most = sources.agg(F.count(F.lit(1)), F.max("n")).first()
    stations, tops = built(leaves, ["doc_id", "fold"], most or 1)
    subroots = written(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("i"), F.lit(n_sources).cast("long").alias("n"), F.col("top").alias("hash"), F.col("leaves").alias("docs")), "subroots")
    forest, last = built(subroots, ["docs"], n_sources)
    root = (last.first() or ["", ""])[1]
    up = exploded(forest[0], ["docs"]).select("tree", "i", "path", "docs", F.col("hash").alias("subroot"))
    for s, f in enumerate(forest[1:], 1):
        hop = replicated(exploded(f, ["leaves"]), s, F.col("leaves")).select(F.col("block").alias("b"), F.col("path").alias("further"))
        up = up.join(hop, F.expr(f"i div {SPAN}") == F.col("b")).withColumn("path", F.concat("path", "further")).drop("b", "further")
    first, base = exploded(stations[0], ["doc_id", "fold"]), lambda c: F.unhex(F.col(c))
    anchor = first.select("tree", F.expr(f"i div {SPAN}").alias("block"), F.lit(1).alias("station"), "doc_id", base("hash").alias("leaf"),
                          folded(F.col("path"), F.unhex(F.coalesce("fold", "hash"))).alias("fold"), siblings(F.col("path")).alias("sibs"))
    none, hop = F.lit(None).cast("string"), ["tree", "block", "station", "path", "sibs", "subroot", "last"]
    hops = up.select(F.col("i").alias("tree"), F.explode_outer(F.sequence(F.lit(0).cast("long"), F.expr(f"(docs - 1) div {SPAN * SPAN}"))).alias("far"), "docs", "path", "subroot").repartition("tree", "far")
    hops = hops.withColumn("block", F.explode_outer(F.sequence(F.col("far") * SPAN, F.least(F.col("far") * SPAN + SPAN - 1, F.expr(f"(docs - 1) div {SPAN}")))))
    hops = hops.select("tree", "block", F.greatest(F.lit(1), F.ceil(depth(F.col("docs")) / STRIDE)).cast("int").alias("station"), "path", siblings(F.col("path")).alias("sibs"), "subroot", F.lit(True).alias("last"))
    for s, g in enumerate(stations[1:], 1):
        rows = replicated(exploded(g, ["leaves"]), s, F.col("leaves"))
        hops = hops.unionByName(rows.select("tree", "block", F.lit(s).alias("station"), "path", siblings(F.col("path")).alias("sibs"), none.alias("subroot"), F.lit(False).alias("last")))
    hops = written(hops.select(*hop), "hops")
    anchor = written(anchor, "anchor")
    limit = "spark.sql.cteRecursionRowLimit"
    held = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")  # the query runs here, so no other one sees this
    try:
        out = written(spark.sql(CLIMB, leaves=anchor, hops=hops, root=root), "manifest")
    finally:
        spark.conf.set(limit, held) if held is not None else spark.conf.unset(limit)
    for t in (anchor, hops, subroots, sources, *stations, *forest):
        dropped(t)
    return out
