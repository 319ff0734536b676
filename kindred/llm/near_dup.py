"""MinHash near-duplicate detection with tensored banding.

A document is its set of distinct word shingles. ``BASES`` base keys, each of ``WIDTH`` minhashes, stand for it; a table
key is a pair of base keys, so BASES * WIDTH minhashes feed BASES * (BASES - 1) / 2 tables of 2 * WIDTH. Two documents
meet if two of their base keys agree: at a similarity of 0.8 they miss with a probability near 1e-5. A base key
that one text alone has cannot match and goes before pairs are formed, which loses nothing.

Documents with one set are one node. Nodes that meet are compared on their full sets, without all pairs of a bucket. In
a few rounds each node is compared with one other that it meets in another component: first with the copy that has
the fewest shingles of its own, then with members drawn by a hash. What then still lies apart in a common bucket, and
shares enough shingles with others to link at all, is compared in full, in blocks of sets: the nodes outside a
cluster's largest component with all of the cluster. So any two that met are compared, connected, or too far apart by
an exact bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import cut, text_of, with_rows, without_rows

BASES, WIDTH = 20, 3
#: Rounds that compare each node with one other, and nodes in a block of the last comparison.
DRAWS, BLOCK = 2, 64
#: Shingles that two blocks are compared over at once.
CODES = 8192
#: Tables of a row a node are broadcast up to so many nodes, counted first; beyond, joins shuffle.
BROADCAST_ROWS = 500_000
#: Links that one partition holds while components are sought.
PART_ROWS = 1_000_000
MASK = (1 << 64) - 1


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``words`` words; A-Z are lower-cased, words end at ASCII white
    space, and a shorter text is one shingle. Empty for a text without words."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return np.empty(0, np.uint64)
    if n < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, n)
    out = np.zeros(n - words + 1, np.uint64)
    for i in range(words):
        out = (out ^ h[i : n - words + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    return r.integers(0, 1 << 32, count, np.uint32)[:, None], (r.integers(0, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


def base_keys(found: np.ndarray, bases: int = BASES, width: int = WIDTH) -> np.ndarray:
    """``bases`` 64-bit keys, each of ``width`` minhashes over the set."""
    flip, factor = coefficients(bases * width)
    x = (found >> np.uint64(32)).astype(np.uint32)
    low = np.full(bases * width, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), 512):
        low = np.minimum(low, ((x[at : at + 512] ^ flip) * factor).min(axis=1))
    low = low.astype(np.uint64).reshape(bases, width)
    key = np.arange(1, bases + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(width):
        key = (key ^ low[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches in parts, so that a worker holds few texts as Python's own at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _signatures(words: int, bases: int, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            sizes, marks, keys = [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text, words)
                sizes.append(len(s))
                marks.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(base_keys(s, bases, width).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), b.column("digest"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "row", "digest", "n", "mark", "keys"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([shingles(t, words).view(np.int64) for t in b.column("text").to_pylist()], pa.list_(pa.int64()))], ["node", "found"]
            )

    return run


def _compare(similar: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y")):
                out = list(_links(x.values, y.values, similar))
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    return run


def _links(x: pa.StructArray, y: pa.StructArray, similar: int) -> Iterator[tuple[int, int]]:
    """Links between nodes of two blocks, one for each two components that have any. Intersections are counted for all
    pairs at once, as products of 0/1 matrices over the shingles that both blocks have, so many at a time."""
    nodes, comps = ([b.field(c).to_numpy() for b in (x, y)] for c in ("node", "comp"))
    sizes = [np.diff(b.field("s").offsets.to_numpy()) for b in (x, y)]
    found = [b.field("s").flatten().to_numpy() for b in (x, y)]
    shared = np.intersect1d(*map(np.unique, found), assume_unique=True)
    if not len(shared):
        return
    places = []
    for values, n in zip(found, sizes):
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        held = shared[at] == values
        rows, at = np.repeat(np.arange(len(n)), n)[held], at[held]
        order = np.argsort(at, kind="stable")
        places.append((rows[order], at[order]))
    both = np.zeros((len(sizes[0]), len(sizes[1])), np.int64)
    for low in range(0, len(shared), CODES):
        part = []
        for (rows, at), n in zip(places, sizes):
            first, last = np.searchsorted(at, (low, low + CODES))
            m = np.zeros((len(n), min(CODES, len(shared) - low)), np.float32)
            m[rows[first:last], at[first:last] - low] = 1
            part.append(m)
        both += (part[0] @ part[1].T).astype(np.int64)  # exact: at most CODES ones
    i, j = np.nonzero((100 * both >= similar * (sizes[0][:, None] + sizes[1] - both)) & (comps[0][:, None] != comps[1]))
    _, first = np.unique(np.stack([comps[0][i], comps[1][j]]), axis=1, return_index=True)
    for a, b in zip(nodes[0][i[first]].tolist(), nodes[1][j[first]].tolist()):
        yield max(a, b), min(a, b)


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links`` (a, b), comp the least node reachable: alternating large and small stars,
    each over aggregated minima, written at each step. Links are counted first and lie in as few partitions as hold
    PART_ROWS each, so that a step over few of them needs no exchange."""
    edges = cut(links.where("a <> b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), "stars")
    held = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while held[0]:
        edges = edges.coalesce(-(-held[0] // PART_ROWS))
        # large star: u's link to v becomes one to the least of v and its lesser neighbours
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        large = edges.join(low.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        # small star: u and its lesser neighbours link to the least of them, a link each
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = cut(small.distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == held:
            break
        held = now
    both = edges.coalesce(max(1, -(-held[0] // PART_ROWS))).select(F.expr("inline(array(struct(u as x, v as y), struct(v as x, v as y)))"))
    return both.toDF("node", "comp").distinct()


class _Linker:
    """Nodes, their buckets, and links confirmed on full sets."""

    def __init__(self, docs: DataFrame, words: int, similar: int, bases: int, width: int) -> None:
        """``docs``: doc_id, text, row."""
        self.docs, self.words, self.similar = docs.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))), words, similar
        sig = cut(self.docs.mapInArrow(_signatures(words, bases, width), "doc_id bigint, row bigint, digest binary, n bigint, mark binary, keys array<bigint>"), "signatures")
        self.rows = sig.select("doc_id", "row", "n", "mark")
        # one node a set, by the first row that has it
        classes = sig.where("mark is not null").groupBy("mark").agg(F.min(F.struct("row", "digest", "n", "keys")).alias("f"))
        self.nodes = cut(classes.select("mark", "f.*", F.monotonically_increasing_id().alias("node")), "nodes")
        base = self.nodes.select("node", F.explode("keys").alias("key"))
        shared = base.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
        held = base.join(shared, "key").groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("k")).where("size(k) > 1")
        pair = F.expr("flatten(transform(k, (x, i) -> transform(slice(k, i + 2, size(k)), y -> xxhash64(x, y))))")
        tables = cut(held.select("node", F.explode(pair).alias("t")), "tables")
        hubs = tables.groupBy("t").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("t")
        self.buckets = cut(tables.join(hubs, "t"), "buckets")
        need = cut(self.buckets.select("node").distinct().join(self.nodes.select("node", "row", "digest", "n"), "node"), "needed")
        count = need.count()
        self.sets, self.known = None, need.select("node", "n")
        if count:
            self.few = count <= BROADCAST_ROWS
            wanted = need.select("node", F.col("row").alias("its_row"), F.col("digest").alias("its"))
            picked = self.docs.join(self.by_node(wanted), (F.col("digest") == F.col("its")) & (F.col("row") == F.col("its_row")))
            self.sets = cut(picked.select("node", "text").mapInArrow(_sets(words), "node bigint, found array<bigint>"), "sets")

    def by_node(self, table: DataFrame) -> DataFrame:
        """A table of a row a node at most, to be joined: broadcast only if the nodes were counted to be few."""
        return F.broadcast(table) if self.few else table.hint("merge")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links, each compared on both full sets."""
        sized = pairs.join(self.by_node(self.known.toDF("a", "na")), "a").join(self.by_node(self.known.toDF("b", "nb")), "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.similar)
        left, right = self.sets.toDF("a", "sa"), self.sets.toDF("b", "sb")
        both = sized.select("a", "b").join(left, "a").join(right, "b")
        return both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("s")).where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * self.similar).select("a", "b")

    def opened(self, buckets: DataFrame, comps: DataFrame) -> DataFrame:
        """(t, node, rank, comp) of those buckets alone that span several components."""
        named = buckets.select("t", "node", "rank").join(self.by_node(comps), "node", "left").select("t", "node", "rank", F.coalesce("comp", "node").alias("comp"))
        named = cut(named, "labelled")
        open_ = named.groupBy("t").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("t")
        return named.join(open_, "t")

    def draw(self, open_: DataFrame, order: Column) -> DataFrame:
        """For each node one of its buckets' first members by ``order`` that lies in another component."""
        hubs = open_.groupBy("t").agg(F.min(F.struct(order.alias("o"), F.col("node").alias("hub"), F.col("comp").alias("c"))).alias("h")).select("t", "h.*")
        best = open_.join(hubs, "t").where("comp <> c").groupBy("node").agg(F.min(F.struct("o", "hub")).alias("h"))
        return best.select(F.greatest("node", "h.hub").alias("a"), F.least("node", "h.hub").alias("b")).distinct()

    def own_counts(self) -> DataFrame:
        """(node, n, common): ``common`` counts a node's shingles that any other node here has; an intersection is no
        larger, so that it bounds a link exactly."""
        alone = self.sets.select("node", F.explode("found").alias("x")).groupBy("x").agg(F.min("node").alias("node"), F.max("node").alias("last"))
        alone = alone.where("node = last").groupBy("node").agg(F.count("*").alias("own"))
        return cut(self.known.join(self.by_node(alone), "node", "left").select("node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common")), "common")

    def solve(self) -> DataFrame:
        """(node, comp) for nodes with links."""
        sized = self.own_counts()
        # a node that shares too little with all others cannot link; the fewer changes a copy has, the earlier it ranks
        low = self.buckets.join(self.by_node(sized), "node").groupBy("t").agg(F.min("n").alias("low"))
        other = F.greatest(F.col("low"), F.col("n") * self.similar / 100)
        can = self.buckets.join(self.by_node(sized), "node").join(low, "t").where(F.col("common") * (100 + self.similar) >= (F.col("n") + other) * self.similar)
        can = cut(can.select("t", "node", (1 - F.col("common") / F.col("n")).alias("rank")), "can")
        links, comps = None, can.selectExpr("node", "node as comp").limit(0)
        for turn in range(DRAWS):
            open_ = self.opened(can, comps)
            order = F.col("rank") if not turn else F.xxhash64("t", "node", F.lit(turn)).cast("double")
            found = cut(self.confirm(self.draw(open_, order)), "links")
            if found.take(1):
                links = found if links is None else links.union(found)
                comps = cut(components(links), "components")
        found = cut(self.blocks(self.opened(can, comps), sized), "links")
        if found.take(1):
            comps = cut(components(found if links is None else links.union(found)), "components")
        return comps

    def blocks(self, open_: DataFrame, sized: DataFrame) -> DataFrame:
        """Links between components that still share a bucket. What buckets connect is a cluster of components, whose
        nodes are connected already; in each cluster, the nodes outside its largest component meet all others, block by
        block."""
        spans = cut(open_.select("t", "comp").distinct(), "spans")
        lows = spans.groupBy("t").agg(F.min("comp").alias("low"))
        edges = spans.join(lows, "t").select(F.col("comp").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        clusters = components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("q"))
        nodes = open_.select("node", "comp").distinct().join(self.by_node(clusters), "comp")
        nodes = cut(nodes.join(self.by_node(sized), "node").select("q", "comp", "node", "common"), "clustered")
        parts = nodes.groupBy("q", "comp").agg(F.count("*").alias("c")).groupBy("q").agg(F.max(F.struct("c", "comp")).alias("m"), F.sum("c").alias("c"))
        placed = nodes.join(parts, "q").select(
            "*", (F.col("comp") != F.col("m.comp")).alias("outside"), F.ceil(F.col("c") / BLOCK).alias("all"), F.ceil((F.col("c") - F.col("m.c")) / BLOCK).alias("few")
        )
        placed = placed.join(self.sets, "node")
        row = F.struct("node", "comp", "common", F.col("found").alias("s")).alias("r")
        few = cut(placed.where("outside").select("q", F.pmod(F.xxhash64("node"), "few").alias("i"), row).groupBy("q", "i").agg(F.collect_list("r").alias("x")), "few")
        all_ = cut(placed.select("q", F.pmod(F.xxhash64("node"), "all").alias("j"), row).groupBy("q", "j").agg(F.collect_list("r").alias("y")), "all")
        ids = few.select("q", "i").join(all_.select("q", "j"), "q")
        return ids.join(few, ["q", "i"]).join(all_, ["q", "j"]).select("x", "y").mapInArrow(_compare(self.similar), "a bigint, b bigint").distinct()

    def result(self) -> DataFrame:
        """(doc_id, row, n, first): ``first`` the least doc_id reachable, null for a row without words."""
        marks = self.nodes.select("mark", "node")
        if self.sets is not None:
            marks = marks.join(self.solve(), "node", "left").select("mark", F.coalesce("comp", "node").alias("comp"))
        else:
            marks = marks.withColumnRenamed("node", "comp")
        lows = self.rows.where("mark is not null").groupBy("mark").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("low"))
        named = cut(lows.join(marks, "mark"), "named")
        least = named.groupBy("comp").agg(F.min("low").alias("first"))
        return self.rows.join(named.join(least, "comp").select("mark", "first"), "mark", "left")


def _linker(tagged: DataFrame, words: int, similar: int, bases: int, width: int) -> DataFrame:
    return _Linker(tagged, words, similar, bases, width).result()


def near_duplicates(docs: DataFrame, words: int = 5, similar: int = 80, id_col: str = "doc_id", text_col: str = "text", bases: int = BASES, width: int = WIDTH) -> DataFrame:
    """One row for each input row: doc_id, n_shingles, component_id, kept.

    Documents link if 100 * intersection >= similar * union of their shingle sets; component_id is the least doc_id
    reachable, itself included. A text without words (null, empty, white space) has no shingles, links with nothing and
    is its own component. Rows with equal sets are one component; null ids come after all others, so component_id is
    null only if no row of the component has an id. kept tells doc_id = component_id, also of rows that repeat that
    id; a row without id is kept if its component has no id. An empty table gives an empty result; other columns,
    whatever their names, are not read."""
    tagged = cut(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("row")), "rows")
    found = _linker(tagged, words, similar, bases, width)
    at = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), at.alias("component_id"), F.col("doc_id").eqNullSafe(at).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, similar: int = 80, id_col: str = "doc_id", text_col: str = "text", bases: int = BASES, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, with all their columns: one of each component (the least doc_id's first row), and every
    row without words."""
    tagged = with_rows(docs)
    plain = tagged.select(F.col(f"r.{id_col}").cast("bigint").alias("doc_id"), text_of(f"r.{text_col}").alias("text"), "row")
    found = _linker(plain, words, similar, bases, width)
    return without_rows(tagged, found.where("first is not null and row <> first.row").select("row"))
