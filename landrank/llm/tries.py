"""Prefix tries of conversations, from the order of their sequences of turns.

Distinct sequences are sorted by range.  In a partition, neighbours are joined by edges that know how long a prefix both
share; union-find over the edges, deepest first, merges the sequences below each node of the trie, so every merge is a
branching node.  All nodes but those on a partition's first and last sequence are complete then; these two go on, with
what hangs on them summed up, to a contracted trie that is built in the same way, until one task holds what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import dropped, written

#: Turns of distinct sequences that a task holds, about; sequences that one task takes whatever their length.
HELD, FEW = 1 << 15, 8
#: Conversation ids that are joined to one string at a time.
CHUNK = 1 << 16
#: Of this many conversations each, one starts the others; so many turns at most are taken from it.
FAMILY, MOST_TAKEN = 5, 8
NONE = hashlib.sha256(b"").hexdigest()

SEQUENCE = pa.schema([("q", pa.int64()), ("codes", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())), ("own", pa.list_(pa.struct([
    ("depth", pa.int32()), ("n", pa.int64()), ("least", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])))])
#: node: a complete node; link: where the node (q, depth) of an open sequence went, to conv_id or to the sequence up_q; open: a sequence that goes on.
BUILT = pa.schema([("kind", pa.string()), *[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                   ("ends_sha256", pa.string()), ("up_q", pa.int64()), *SEQUENCE])
_ARRAYS = "codes array<binary>, sizes array<bigint>, own array<struct<depth: int, n: bigint, least: bigint, kids: bigint, leaves: bigint, saved: bigint, ends: string>>"
_BUILT = f"kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, up_q long, q long, {_ARRAYS}"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# -- conversations as sequences --------------------------------------------------------------------------------------

def taken(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string")) % (MOST_TAKEN + 1)).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, codes, sizes): each conversation's turns after it took its first ones from its family's first.

    A code is a digest of role and text, a size the text's bytes, so texts stay where they are.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    code = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", code.alias("code"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    held = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    heads = held.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.slice("own", 1, MOST_TAKEN).alias("head"))
    h = taken(F.col("conv_id"))
    both = held.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "family", "left")
    rest = F.slice("own", h + 1, F.greatest(F.lit(0), F.size("own") - h))
    both = both.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.slice("own", 1, 0)), rest).alias("turns"))
    return both.select("conv_id", F.col("turns.code").alias("codes"), F.col("turns.size").alias("sizes"))


def joined_hashes(rows: DataFrame) -> DataFrame:
    """rows (s, conv_id), ids different, to (s, ends): SHA-256 of the ids in order, joined by commas.

    Ids are sorted by range, so many of one s lie in many tasks, which join them to strings; these are hashed in a stream.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for b in batches:
            out = []
            for s, c in zip(b["s"].to_pylist(), b["conv_id"].to_pylist(), strict=True):
                if ids and (s != key or len(ids) == CHUNK):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = s
                ids.append(c)
            yield table(out)
        yield table([(key, ids[0], ",".join(map(str, ids)))] if ids else [])

    def table(out: list) -> pa.RecordBatch:
        s, first, text = zip(*out, strict=True) if out else ((), (), ())
        return pa.record_batch([pa.array(s, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.string())], ["s", "first", "text"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = lambda out: pa.record_batch([pa.array([s for s, _ in out], pa.binary()), pa.array([h.hexdigest() for _, h in out], pa.string())], ["s", "ends"])
        held: list = []  # the digest that is not complete yet
        for b in batches:
            for s, text in zip(b["s"].to_pylist(), b["text"].to_pylist(), strict=True):
                if held and held[-1][0] == s:
                    held[-1][1].update(b"," + text.encode())
                else:
                    held.append((s, hashlib.sha256(text.encode())))
            yield done(held[:-1])
            held = held[-1:]
        yield done(held)

    parts = rows.select("s", "conv_id").repartitionByRange("s", "conv_id").sortWithinPartitions("s", "conv_id").mapInArrow(chunks, "s binary, first long, text string")
    return parts.repartition("s").sortWithinPartitions("s", "first").mapInArrow(hashes, "s binary, ends string")


def sequences(conversations: DataFrame) -> DataFrame:
    """Distinct rebuilt sequences (q, codes, sizes, n, ends): q the least conversation that is the sequence, n how many are."""
    r = rebuilt(conversations)
    r = written(r.withColumn("s", F.unhex(F.sha2(F.array_join(F.transform("codes", F.hex), ""), 256))), "rebuilt")
    each = r.groupBy("s").agg(F.min("conv_id").alias("q"), F.count(F.lit(1)).alias("n"), F.any_value("codes").alias("codes"), F.any_value("sizes").alias("sizes"))
    out = written(each.join(joined_hashes(r), "s").drop("s"), "sequences")
    dropped(r)
    return out


# -- a forest in a task ----------------------------------------------------------------------------------------------

class Forest:
    """The trie of sorted, distinct sequences; unless `whole`, nodes on the first and the last one stay open.

    own[i] says what is known of nodes on sequence i: by depth [n, least, kids, leaves, saved, ends] of what ends there
    or hangs there and is complete.  A component of the union-find has one entry for the shared prefixes of its members.
    """

    def __init__(self, rows: list[dict], whole: bool):
        self.rows, self.codes, self.sizes = rows, [r["codes"] for r in rows], [r["sizes"] for r in rows]
        self.own = [{c["depth"]: [c["n"], c["least"], c["kids"], c["leaves"], c["saved"], c["ends"]] for c in r["own"]} for r in rows]
        #: depths at which complete nodes of lower levels wait to hear of their parent, with the sequences that they know
        self.waiting = [{t: [r["q"]] for t, c in own.items() if c[2]} for r, own in zip(rows, self.own, strict=True)]
        self.top = [len(c) for c in self.codes]
        self.below: list[list[int]] = [[] for _ in rows]  # nodes whose parent is the component's node at depth top
        self.up = list(range(len(rows)))
        self.open = set() if whole or not rows else {0, len(rows) - 1}
        self.nodes: list[list] = []  # conv_id, depth, parent node, n, kids, leaves, saved, ends, waits for sequence
        self.links: list[tuple] = []  # q, depth, node or None, sequence or None
        edges = sorted(((self.shared(i), i) for i in range(len(rows) - 1)), key=lambda e: (-e[0], e[1]))
        for d, i in edges:
            self.merge(self.root(i), self.root(i + 1), d)
        if whole and rows:
            c = self.root(0)
            self.climb(c, 0)
            self.form(c)

    def shared(self, i: int) -> int:
        n = 0
        for a, b in zip(self.codes[i], self.codes[i + 1], strict=False):
            if a != b:
                break
            n += 1
        return n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def form(self, c: int) -> list:
        """The node at the component's top: what its parent gets of it."""
        t = self.top[c]
        n, least, kids, leaves, saved, ends = self.own[c].pop(t)
        leaves, saved = leaves if kids else 1, saved + ((n - 1) * self.sizes[c][t - 1] if t else 0)
        at = len(self.nodes)
        self.nodes.append([least, t, None, n, kids, leaves, saved, ends, None])
        for x in self.below[c]:
            self.nodes[x][2] = at
        self.below[c] = [at]
        self.links += [(q, t, at, None) for q in self.waiting[c].pop(t, ())]
        return [n, least, 1, leaves, saved, None]

    def climb(self, c: int, depth: int) -> None:
        while self.top[c] > depth:
            got = self.form(c)
            self.top[c] -= 1
            self.add(c, self.top[c], got)

    def add(self, c: int, t: int, got: list) -> None:
        if (had := self.own[c].get(t)) is None:
            self.own[c][t] = got
        else:
            self.own[c][t] = [had[0] + got[0], min(had[1], got[1]), had[2] + got[2], had[3] + got[3], had[4] + got[4], had[5] or got[5]]

    def merge(self, a: int, b: int, d: int) -> None:
        """Two components whose sequences share d turns and no more become one."""
        if a in self.open and b in self.open:
            self.up[b] = a  # both stay as they are; the next level puts them together
            return
        if b in self.open or (a not in self.open and len(self.own[b]) + len(self.below[b]) > len(self.own[a]) + len(self.below[a])):
            a, b = b, a
        if a not in self.open:
            self.climb(a, d)
        self.climb(b, d)
        for t, cell in self.own[b].items():
            self.add(a, t, cell)
        if a in self.open:
            q = self.rows[a]["q"]
            for x in self.below[b]:
                self.nodes[x][8] = q
            self.links += [(x, t, None, q) for t, qs in self.waiting[b].items() for x in qs]
        else:
            self.below[a] += self.below[b]
            for t, qs in self.waiting[b].items():
                self.waiting[a].setdefault(t, []).extend(qs)
        self.up[b] = a
        self.own[b], self.below[b], self.waiting[b] = {}, [], {}

    def built(self, step: int = 20_000) -> Iterator[pa.RecordBatch]:
        def batch(kind: str, n: int, **columns) -> pa.RecordBatch:
            columns["kind"] = [kind] * n
            return pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in BUILT], schema=BUILT)

        for k in range(0, len(self.nodes), step):
            conv, depth, parent, n, kids, leaves, saved, ends, wait = zip(*self.nodes[k:k + step], strict=True)
            yield batch("node", len(conv), conv_id=conv, depth=depth, parent_conv_id=[None if p is None else self.nodes[p][0] for p in parent], n_convs=n, n_children=kids,
                        n_leaves=leaves, saved_tokens=saved, ends_sha256=[e or NONE for e in ends], up_q=wait)
        if self.links:
            q, depth, node, wait = zip(*self.links, strict=True)
            yield batch("link", len(q), q=q, depth=depth, conv_id=[None if x is None else self.nodes[x][0] for x in node], up_q=wait)
        for i in sorted(self.open):
            names = ("n", "least", "kids", "leaves", "saved", "ends")
            own = [{"depth": t, **dict(zip(names, c, strict=True))} for t, c in self.own[i].items()]
            yield batch("open", 1, q=[self.rows[i]["q"]], codes=[self.codes[i]], sizes=[self.sizes[i]], own=[own])


def forests(rows: DataFrame, parts: int) -> DataFrame:
    """The forests of the rows (SEQUENCE) in each of so many ranges; of one range, the whole trie."""
    whole = parts == 1
    placed = rows.repartition(1) if whole else rows.repartitionByRange(parts, "codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from Forest([r for b in batches for r in b.to_pylist()], whole).built()

    return placed.sortWithinPartitions("codes").mapInArrow(run, _BUILT)


# -- the trie --------------------------------------------------------------------------------------------------------

def prefix_trie(conversations: DataFrame, held: int = HELD) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), rebuilt by taken(): a row for each node, see NODE.

    Turns are ordered by turn (nulls first, ties by a digest of role and text); null roles and texts are empty ones; a null
    conv_id is no conversation's, so its rows are left out; rows that repeat are turns of their own; very long texts are
    digested whole; other columns, whatever their names, are not read; no rows give no node, not even a root.

    Copies are one sequence, counted before it is sorted; a first turn that very many share is in as many partitions as
    its sequences fill.  A task holds the digests of about `held` turns, and of one conversation whatever its length.
    """
    seqs = sequences(conversations)
    own = F.array(F.struct(F.size("codes").alias("depth"), "n", F.col("q").alias("least"), *[F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")], "ends"))
    rows, levels = seqs.select("q", "codes", "sizes", own.alias("own")), []
    while True:
        n, turns = rows.agg(F.count(F.lit(1)), F.sum(F.size("codes") + 1)).first()
        parts = 1 if n <= FEW or turns <= held else max(2, min(-(-turns // held), n // 4))
        levels.append(written(forests(rows, parts), "forest"))
        if parts == 1:
            break
        rows = levels[-1].filter("kind = 'open'").select(*SEQUENCE.names)
    nodes = lambda b: b.filter("kind = 'node' and up_q is null").select(*NODE)
    links = lambda b: b.filter("kind = 'link'").select("q", "depth", "conv_id", "up_q")
    out, known = nodes(levels[-1]), links(levels[-1]).select("q", "depth", "conv_id")
    for b in levels[-2::-1]:  # what waited below an open sequence hears of its parent from the levels above
        parent = known.select(F.col("q").alias("up_q"), F.col("depth").alias("up_depth"), F.col("conv_id").alias("up_conv_id"))
        late = b.filter("kind = 'node' and up_q is not null").withColumn("up_depth", F.col("depth") - 1).join(parent, ["up_q", "up_depth"])
        out = out.unionByName(nodes(b)).unionByName(late.withColumn("parent_conv_id", F.col("up_conv_id")).select(*NODE))
        here = links(b)
        moved = here.filter("up_q is not null").drop("conv_id").withColumn("up_depth", F.col("depth")).join(parent, ["up_q", "up_depth"])
        known = known.unionByName(here.filter("up_q is null").drop("up_q")).unionByName(moved.select("q", "depth", F.col("up_conv_id").alias("conv_id")))
    return out
