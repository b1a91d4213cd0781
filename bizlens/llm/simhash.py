"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank (neighbours in that order differ in few bits) and
cut into blocks of about equal size.  Inside a block, runs of ``FAN`` neighbours form a node, runs
of nodes the next node, and so on; a node keeps the bits that all below it share and that its
parent doesn't keep already (a masked pattern).  A search goes down from the top, adds up the
bits in which the query differs from the patterns it passes, and leaves a whole group as soon as
the sum is over the limit.  Blocks are joined pair by pair, except pairs whose shared patterns
differ in too many bits; a task holds two blocks and sends on a spanning forest of the links it
found, at most one edge for each of its fingerprints.  Components of the forests are components
of all links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import id_type, materialize, ship_package, table, text_or_empty
from bizlens.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
FAN = 8
BLOCK_CODES = 1 << 17  # aimed at; blocks grow beyond it when MAX_BLOCKS is reached
MIN_BLOCKS, MAX_BLOCKS = 16, 4096  # the planned patterns are at most MAX_BLOCKS rows
FRONT = 1 << 21  # (query, node) pairs looked at together
SIGN = -(1 << 63)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text: XXH64 (seed 42) of its word shingles, repeats included, with A-Z
    lower-cased; a bit is set if over half the hashes have it.  No word: 0."""
    import xxhash

    tokens = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not tokens:
        return 0
    joined, digest = b" ".join(tokens), xxhash.xxh64_digest
    if len(tokens) <= words:
        return int.from_bytes(digest(joined, SEED), "big")
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    stops = (ends[words - 1:] - 1).tolist()
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)]), np.uint8).reshape(-1, 8)
    counts = sum(np.unpackbits(hashes[i:i + 65536], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), 65536))
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _fingerprints(words: int, id_col: str):
    def run(parts):
        import pyarrow as pa

        for part in parts:
            codes = np.array([fingerprint(t, words) for t in part.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(codes.view(np.int64))], [id_col, "text_hash", "code"])

    return run


def gray_order(code: Column) -> Column:
    """The Gray rank of a 64-bit code, moved so that signed order is rank order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(SIGN))


def _ranks(codes: np.ndarray) -> np.ndarray:
    r = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(shift)
    return r


class GrayIndex:
    """Levels of (pattern, mask), top first; the last level is the codes themselves."""

    def __init__(self, codes: np.ndarray):
        """``codes``: distinct, in Gray order."""
        self.codes = codes
        all_and, all_or = [codes], [codes]
        while len(all_and[0]) > FAN:
            cut = np.arange(0, len(all_and[0]), FAN)
            all_and.insert(0, np.bitwise_and.reduceat(all_and[0], cut))
            all_or.insert(0, np.bitwise_or.reduceat(all_or[0], cut))
        self.levels = []
        above = None
        for low, high in zip(all_and, all_or):
            mask = ~(low ^ high)
            own = mask if above is None else mask & ~np.repeat(above, FAN)[:len(mask)]
            self.levels.append((low & own, own))
            above = mask

    def links(self, queries: np.ndarray, limit: int, after: np.ndarray | None = None):
        """Yields (query number, code number) arrays of pairs that differ in at most ``limit``
        bits; with ``after``, only code numbers over it."""
        top = len(self.levels[0][0])
        step = max(1, FRONT // (top * FAN * FAN))
        for i in range(0, len(queries), step):
            q = np.arange(i, min(i + step, len(queries)))
            yield from self._down(0, queries, np.repeat(q, top), np.tile(np.arange(top), len(q)),
                                  np.zeros(len(q) * top, np.uint8), limit, after)

    def _down(self, level, queries, q, node, sums, limit, after):
        if len(q) > FRONT:
            for i in range(0, len(q), FRONT):
                s = slice(i, i + FRONT)
                yield from self._down(level, queries, q[s], node[s], sums[s], limit, after)
            return
        pattern, mask = self.levels[level]
        sums = sums + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
        keep = sums <= limit
        last = level == len(self.levels) - 1
        if after is not None:
            width = FAN ** (len(self.levels) - 1 - level)
            keep &= (node + 1) * width - 1 > after[q]
        q, node, sums = q[keep], node[keep], sums[keep]
        if not len(q):
            return
        if last:
            yield q, node
            return
        n = len(self.levels[level + 1][0])
        child = (node[:, None] * FAN + np.arange(FAN)).ravel()
        real = child < n
        yield from self._down(level + 1, queries, np.repeat(q, FAN)[real], child[real], np.repeat(sums, FAN)[real], limit, after)


class Forest:
    """Union-find over 0..n-1 with whole arrays of links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        nodes = np.arange(len(self.parent))
        root = self.roots(nodes)
        child = np.flatnonzero(root != nodes)
        return child, root[child]


def join_blocks(left: np.ndarray, right: np.ndarray | None, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (as codes) of a spanning forest of all links inside ``left``, or between the two."""
    index = GrayIndex(left if right is None else right)
    codes = left if right is None else np.concatenate([left, right])
    forest, shift = Forest(len(codes)), 0 if right is None else len(left)
    for q, c in index.links(left, limit, np.arange(len(left)) if right is None else None):
        forest.link(q, c + shift)
    child, root = forest.edges()
    return codes[child], codes[root]


def _blocks(bounds: list[int]):
    def run(parts):
        import pyarrow as pa

        edges = np.array(bounds, np.int64)
        for part in parts:
            code, order = part.column(0), part.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([code, pa.array(np.searchsorted(edges, order), pa.int64())], ["code", "block"])

    return run


def _gather(key, rows):
    import pandas as pd

    codes = rows["code"].to_numpy(np.int64).view(np.uint64)
    codes = codes[np.argsort(_ranks(codes), kind="stable")]
    low, high = np.bitwise_and.reduce(codes), np.bitwise_or.reduce(codes)
    shared = ~(low ^ high)
    signed = lambda x: int(np.uint64(x).view(np.int64))
    return pd.DataFrame({"block": [key[0]], "codes": [codes.tobytes()], "pattern": [signed(low & shared)], "mask": [signed(shared)]})


def near_blocks(patterns: np.ndarray, own: int, own_mask: int, limit: int) -> np.ndarray:
    """Which of ``patterns`` (rows of block, pattern, mask) share no more than ``limit`` differing bits with a block."""
    pattern, mask = (patterns[:, i].view(np.uint64) for i in (1, 2))
    apart = np.bitwise_count((pattern ^ np.int64(own).view(np.uint64)) & mask & np.int64(own_mask).view(np.uint64))
    return patterns[apart <= limit, 0]


def _meet(patterns: np.ndarray, limit: int):
    """Sends each block to all pairs that it is in, (own, own) included."""
    def run(frames):
        import pandas as pd

        for frame in frames:
            for block, codes, own, own_mask in frame[["block", "codes", "pattern", "mask"]].itertuples(index=False):
                for other in near_blocks(patterns, own, own_mask, limit).tolist():
                    yield pd.DataFrame({"a": [min(block, other)], "b": [max(block, other)], "block": [block], "codes": [codes]})

    return run


def _join(limit: int):
    def run(key, rows):
        import pandas as pd

        by = {b: np.frombuffer(c, np.uint64) for b, c in zip(rows["block"], rows["codes"])}
        a, b = int(key[0]), int(key[1])
        u, v = join_blocks(by[a], None if a == b else by[b], limit)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return run


def fingerprint_components(codes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(code, root): the component of each code of ``codes`` (distinct codes, one long column
    ``code``) that links to another one; codes that link to none are left out."""
    n = codes.count()
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-n // BLOCK_CODES)))
    ordered = codes.select("code", gray_order(F.col("code")).alias("place"))
    shares = [i / blocks for i in range(1, blocks)]
    bounds = ordered.agg(F.percentile_approx("place", shares, max(10_000, 20 * blocks)).alias("b")).first().b or []
    packed = (ordered.mapInArrow(_blocks(sorted(set(bounds))), "code long, block long").groupBy("block")
              .applyInPandas(_gather, "block long, codes binary, pattern long, mask long"))
    packed = materialize(packed, "blocks")
    patterns = np.array([tuple(r) for r in packed.select("block", "pattern", "mask").collect()], np.int64).reshape(-1, 3)
    pairs = packed.mapInPandas(_meet(patterns, max_bits), "a long, b long, block long, codes binary")
    # a pair is little data and much work: each gets a task, which a partitioning of a given width keeps
    tasks = sum(len(near_blocks(patterns, own, mask, max_bits)) + 1 for _, own, mask in patterns.tolist()) // 2
    edges = pairs.repartition(max(1, tasks), "a", "b").groupBy("a", "b").applyInPandas(_join(max_bits), "u long, v long")
    return connected_components(edges).select(F.col("node").alias("code"), "root")


def document_classes(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, code) of every row, and (code, root, component_id) of every distinct code; the
    root is a code that stands for the component, component_id its least id."""
    ship_package(docs.sparkSession)
    schema = f"`{id_col}` {id_type(docs, id_col)}, text_hash long, code long"
    texts = docs.select(F.col(id_col), F.xxhash64(text_or_empty(text_col)).alias("_hash"), text_or_empty(text_col).alias("_text"))
    codes = materialize(texts.mapInArrow(_fingerprints(words, id_col), schema), "fingerprints")
    distinct = materialize(codes.groupBy("code").agg(F.min(id_col).alias("least")), "distinct")
    linked = materialize(fingerprint_components(distinct.select("code"), max_bits), "linked")
    least = linked.join(distinct, "code").groupBy("root").agg(F.min("least").alias("component_id"))
    found = linked.join(least, "root").select("code", "root", "component_id")
    found = distinct.join(found, "code", "left").select("code", F.coalesce("root", "code").alias("root"),
                                                        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    return codes, materialize(found, "components")  # both sides of a join are scans then, so that a hot fingerprint can be split


def simhash_components(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (least id reachable).

    Null and empty texts have fingerprint zero and link like any other.  Rows with a null id take
    part; a component of such rows only has component_id null.  Repeated rows each get a row; ids
    that occur twice count in each of their components; other columns are ignored; an empty table
    gives an empty result.
    """
    codes, found = document_classes(docs, words, max_bits, id_col, text_col)
    return codes.join(found, "code").select(
        id_col, F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, less near-copies: of each component one row with the least id
    stays, and of its texts with that id, should it stand on several, the one whose hash is least.

    A row is known by its id and its text's hash, so an id that stands on different texts keeps each that
    is no near-copy.  Rows with a null id stay: nothing can name them.  Null texts count as empty and
    stay null; of a row that is repeated one stays; an empty table stays empty.  Most documents are kept,
    so the list grows with the corpus: it is never broadcast, the texts meet it in a merge join at
    every size.
    """
    codes, found = document_classes(docs, words, max_bits, id_col, text_col)
    rows, key, digest = "__bizlens_rows", "__bizlens_id", "__bizlens_hash"
    named = codes.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"), "text_hash", "code").agg(F.count("*").alias("n"))
    first = named.join(found.select("code", "root"), "code").groupBy("root").agg(F.min(F.struct("id", "text_hash", "n")).alias("first"))
    kept = materialize(first.select(F.col("first.id").alias(key), F.col("first.text_hash").alias(digest), F.col("first.n").alias(rows)), "kept")
    same = (F.col(id_col) == F.col(key)) & (F.xxhash64(text_or_empty(text_col)) == F.col(digest))
    out = docs.join(kept.hint("merge"), same, "left").where(F.col(rows).isNotNull() | F.col(id_col).isNull())
    if not kept.where(F.col(rows) > 1).isEmpty():
        once = F.coalesce(F.col(rows), F.lit(1)) == 1
        out = out.where(once).unionByName(out.where(~once).dropDuplicates([key, digest]))
    return out.select(*docs.columns)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_components(table(spark, sf_dir, "documents"))
