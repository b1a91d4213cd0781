"""Embedding near-duplicates by dual traversal of cover trees: exact threshold pairs.

Unit vectors lie at the distance ``sqrt(2 - 2 cos)``, so a cosine threshold is a distance limit.
A cover tree has nested levels with halving radii: each node's children are a greedy net of its
vectors (no two closer than the level's radius, every vector within it of its child's centre), the
first child has its parent's centre, and a node knows its covering radius, the largest distance
from its centre to a vector below it.  A dual traversal goes down two trees at once.  A pair of nodes
whose centres lie farther apart than the limit and both radii is dropped; a pair whose centres and
radii fit within the limit is linked whole, without looking at its vectors; other pairs are
opened.  Single vectors that stay in doubt are decided by their cosine in double precision.

On Spark, vectors go to the nearest of some pivots (a net of a bounded sample; every vector is
assigned), cells larger than ``BLOCK_ROWS`` are dealt into parts, and a part is a block: one tree, built in
one task.  Blocks whose covering balls lie farther apart than the limit never meet; every other pair of
blocks is a task of its own.  A task gives a number of links for each of its vectors that has any and a
spanning forest of them, never the pairs themselves, so a group of copies that holds a third of all
rows costs its rows a few times over.  How many pairs of blocks meet depends on the data: where vectors have no
neighbours at any scale (random directions in many dimensions), no ball excludes another one, and the
bounds only save the work inside tasks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import id_type, materialize, ship_package, table
from bizlens.llm.components import connected_components
from bizlens.llm.simhash import Forest

THRESHOLD = 0.95
BLOCK_ROWS = 1 << 14
MIN_BLOCKS, MAX_BLOCKS = 4, 4096  # blocks grow when MAX_BLOCKS is reached: the driver plans with one ball a block
SAMPLE_ROWS = 1 << 13  # of vectors from which pivots are taken
LEAF = 32
SMALLEST = 1e-4  # nodes of a smaller radius are not divided further
TILE = 1 << 22  # cosines looked at together
COARSE = 1e-4  # error of a cosine in single precision, at most
SAFE = 1e-6  # margin of the bounds


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; rows that are zero or hold a component that isn't finite become NaN."""
    with np.errstate(all="ignore"):
        x = np.asarray(vectors, np.float64)
        largest = np.abs(x).max(axis=1, initial=0.0)
        x = x / np.where((largest > 0) & np.isfinite(largest), largest, np.nan)[:, None]  # squares neither overflow nor vanish
        return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def greedy_net(vectors: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres (positions, in order; the first vector is one) no two of which are closer than
    ``radius``, and for each vector the number of a centre within it."""
    limit, n = 1 - radius * radius / 2, len(vectors)
    centre_of, centres, left = np.full(n, -1), [], np.arange(n)
    while len(left):
        some = left[:256]  # candidates: each one that no earlier one covers is a centre
        near = vectors[some] @ vectors[some].T >= limit
        taken = np.zeros(len(some), bool)
        for i in range(len(some)):
            taken[i] = not near[i, :i][taken[:i]].any()
        fresh = some[taken]
        for at in range(0, len(left), max(1, TILE // len(fresh))):
            part = left[at:at + max(1, TILE // len(fresh))]
            cos = vectors[part] @ vectors[fresh].T
            best = cos.argmax(axis=1)
            ok = cos[np.arange(len(part)), best] >= limit
            centre_of[part[ok]] = best[ok] + len(centres)
        centre_of[fresh] = np.arange(len(centres), len(centres) + len(fresh))
        centres += fresh.tolist()
        left = left[centre_of[left] < 0]
    return np.array(centres, np.int64), centre_of


class CoverTree:
    """The vectors in the order of the tree.  A node is a range of two vectors or more whose first one is
    its centre; it divides into the ranges that its children begin, or, without children, into its vectors."""

    def __init__(self, vectors: np.ndarray):
        """``vectors``: one or more rows of length one."""
        n = len(vectors)
        order, nodes, child_begin, child_node = np.arange(n), [], [], []  # a node: begin, end, radius, children from, to
        open_ = [(0, n, 2.0, None)] if n > 1 else []
        while open_:
            start, stop, level, place = open_.pop()
            own = vectors[order[start:stop]]
            radius = float(np.sqrt(max(0.0, 2 - 2 * (own @ own[0]).min()))) + SAFE
            if place is not None:
                child_node[place] = len(nodes)
            if stop - start <= LEAF or radius < SMALLEST:
                nodes.append((start, stop, radius, 0, 0))
                continue
            level, centres = min(level, radius), []
            while len(centres) < 2:  # a level of one node would repeat its parent
                level /= 2
                centres, centre_of = greedy_net(own, level)
            later = np.ones(stop - start, bool)
            later[centres] = False  # a range begins with its centre
            order[start:stop] = order[start:stop][np.lexsort((later, centre_of))]
            cuts = start + np.concatenate([[0], np.cumsum(np.bincount(centre_of, minlength=len(centres)))])
            nodes.append((start, stop, radius, len(child_begin), len(child_begin) + len(centres)))
            open_ += [(int(cuts[i]), int(cuts[i + 1]), level, len(child_begin) + i) for i in np.flatnonzero(np.diff(cuts) > 1).tolist()]
            child_begin += cuts[:-1].tolist()
            child_node += [-1] * len(centres)
        self.order = order
        table_of = list(zip(*nodes)) or [()] * 5
        self._set(vectors[order], *(np.array(x, kind) for x, kind in zip((*table_of, child_begin, child_node), ("<i8", "<i8", "<f8", "<i8", "<i8", "<i4", "<i4"))))

    def _set(self, vectors, *arrays) -> None:
        self.vectors, self.coarse, self.arrays = vectors, vectors.astype(np.float32), arrays
        self.begin, self.end, self.radius, self.first, self.last, self.child_begin, self.child_node = arrays

    def to_bytes(self) -> bytes:
        """All but the vectors."""
        return b"".join([np.array([len(self.begin), len(self.child_begin)], "<i8").tobytes(), *(x.tobytes() for x in self.arrays)])

    @classmethod
    def from_bytes(cls, data: bytes, vectors: np.ndarray) -> CoverTree:
        """A tree from ``to_bytes`` and its vectors in its order."""
        self, (nodes, children), at, arrays = cls.__new__(cls), np.frombuffer(data, "<i8", 2).tolist(), 16, []
        for kind, n in (("<i8", nodes), ("<i8", nodes), ("<f8", nodes), ("<i8", nodes), ("<i8", nodes), ("<i4", children), ("<i4", children)):
            arrays.append(np.frombuffer(data, kind, n, at))
            at += arrays[-1].nbytes
        self.order = np.arange(len(vectors))
        self._set(vectors, *arrays)
        return self

    def root(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``one``, of the whole tree."""
        return self.one(0) if len(self.vectors) > 1 else (np.array([0]), np.array([1]), np.zeros(1), np.array([-1]))

    def one(self, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A node by itself, in the form of ``parts``."""
        return self.begin[[node]], self.end[[node]], self.radius[[node]], np.array([node])

    def parts(self, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begins, ends, radii and node numbers (-1: a single vector) of what a node divides into."""
        some = slice(self.first[node], self.last[node])
        if some.start == some.stop:
            places = np.arange(self.begin[node], self.end[node])
            return places, places + 1, np.zeros(len(places)), np.full(len(places), -1)
        begins, nodes = self.child_begin[some].astype(np.int64), self.child_node[some]
        return begins, np.append(begins[1:], self.end[node]), np.where(nodes >= 0, self.radius[nodes], 0.0), nodes


class DualTraversal:
    """Numbers of links and their forest, between two trees or inside one."""

    def __init__(self, left: CoverTree, right: CoverTree | None, threshold: float):
        self.a, self.b, self.same, self.threshold = left, right or left, right is None, threshold
        self.limit = math.sqrt(max(0.0, 2 - 2 * threshold))
        self.shift = 0 if self.same else len(left.vectors)
        n = self.shift + len(self.b.vectors)
        self.steps = np.zeros(n + 1, np.int64)  # differences of the numbers of links
        self.forest, self.whole, self.open = Forest(n), set(), []
        if not self.same:
            self._meet(self.a.root(), self.b.root(), False)
        elif n > 1:
            self.open.append((0, 0))
        while self.open:
            self._open(*self.open.pop())
        for first, last in self.whole:  # all in such a range are linked to one of its partners
            self.forest.link(np.arange(first + 1, last), np.full(last - first - 1, first))

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of each vector, and the edges of a spanning forest; positions are those of the trees,
        the right one's after the left one's."""
        return np.cumsum(self.steps)[:-1], *self.forest.edges()

    def _open(self, a: int, b: int) -> None:
        if self.same and a == b:
            first, last = int(self.a.begin[a]), int(self.a.end[a])
            if 2 * self.a.radius[a] + SAFE <= self.limit:  # any two are linked
                self.steps[first] += last - first - 1
                self.steps[last] -= last - first - 1
                self.whole.add((first, last))
                return
            parts = self.a.parts(a)
            self._meet(parts, parts, True)
            self.open += [(n, n) for n in parts[3].tolist() if n >= 0]
            return
        ra, rb = self.a.radius[a], self.b.radius[b]  # the wider one is divided, or both
        self._meet(self.a.parts(a) if 2 * ra >= rb else self.a.one(a), self.b.parts(b) if 2 * rb >= ra else self.b.one(b), False)

    def _meet(self, left, right, upper: bool) -> None:
        """All pairs of some nodes by their bounds; those in doubt are opened.  ``upper``: each pair once."""
        x, ra = self.a.coarse[left[0]], left[2]
        for columns in (np.flatnonzero(right[2] == 0), np.flatnonzero(right[2] > 0)):
            if not len(columns):
                continue
            # in single precision, with room for its error, and by the widest node of the right side
            reach = np.minimum(ra + right[2][columns].max() + self.limit + SAFE, 2.0)
            lowest = (1 - reach * reach / 2 - COARSE).astype(np.float32)
            step = max(1, TILE // len(columns))
            y = self.b.coarse[right[0][columns]]
            for at in range(0, len(x), step):
                skip = int(np.searchsorted(columns, at)) if upper else 0
                i, j = np.nonzero(x[at:at + step] @ y[skip:].T >= lowest[at:at + step, None])
                i, j = i + at, columns[j + skip]
                if upper:
                    i, j = i[i < j], j[i < j]
                for s in range(0, len(i), 1 << 17):
                    self._decide(left, right, i[s:s + (1 << 17)], j[s:s + (1 << 17)])

    def _decide(self, left, right, i, j) -> None:
        (a0, a1, ra, na), (b0, b1, rb, nb) = left, right
        cos = np.einsum("ij,ij->i", self.a.vectors[a0[i]], self.b.vectors[b0[j]])
        apart, reach = np.sqrt(np.maximum(0.0, 2 - 2 * cos)), ra[i] + rb[j]
        singles = (na[i] < 0) & (nb[j] < 0)
        linked = np.where(singles, cos >= self.threshold, apart + reach + SAFE <= self.limit)
        self._link(a0[i[linked]], a1[i[linked]], b0[j[linked]] + self.shift, b1[j[linked]] + self.shift)
        doubt = ~singles & ~linked & (apart - reach - SAFE <= self.limit)
        for p, q in zip(i[doubt].tolist(), j[doubt].tolist()):
            if na[p] >= 0 and nb[q] >= 0:
                self.open.append((int(na[p]), int(nb[q])))
            elif na[p] >= 0:
                self._meet(self.a.parts(int(na[p])), tuple(x[q:q + 1] for x in right), False)
            else:
                self._meet(tuple(x[p:p + 1] for x in left), self.b.parts(int(nb[q])), False)

    def _link(self, a0, a1, b0, b1) -> None:
        """Every vector of a0:a1 with every one of b0:b1, for arrays of ranges."""
        for first, last, n in ((a0, a1, b1 - b0), (b0, b1, a1 - a0)):
            np.add.at(self.steps, first, n)
            np.add.at(self.steps, last, -n)
            wide = last - first > 1
            self.whole.update(zip(first[wide].tolist(), last[wide].tolist()))
        self.forest.link(a0, b0)


def _vectors(single: bool):
    """Each row with its width and the bytes of its vector; width 0 if that has no direction."""
    def run(parts):
        import pyarrow as pa
        import pyarrow.compute as pc

        kind, number = (pa.float32(), "<f4") if single else (pa.float64(), "<f8")
        for part in parts:
            lists = part.column(2)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            width, data = np.zeros(len(part), np.int32), [b""] * len(part)
            for size in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == size)
                raw = lists.take(pa.array(at)).flatten().cast(kind).fill_null(math.nan).to_numpy(zero_copy_only=False).reshape(-1, size).astype(number)
                good = np.isfinite(unit_rows(raw)).all(axis=1)
                width[at[good]] = size
                for k, row in zip(at[good].tolist(), raw[good]):
                    data[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(width), pa.array(data, pa.binary())], ["row", "id", "width", "vector"])

    return run


def _units(vectors: list[bytes], width: int, single: bool) -> np.ndarray:
    return unit_rows(np.frombuffer(b"".join(vectors), "<f4" if single else "<f8").reshape(-1, width))


def pivots_of(units: np.ndarray, blocks: int) -> np.ndarray:
    """At most ``blocks`` pivots: the widest net that has so many centres, cut after the last one."""
    for k in range(12):
        centres, _ = greedy_net(units, 2.0 / 2 ** k)
        if len(centres) >= blocks:
            break
    return units[centres[:blocks]]


def _cells(pivots: dict[int, np.ndarray], parts_of: dict[tuple[int, int], int], single: bool):
    """The nearest pivot of each vector, and, once the cells' sizes are known, its part of the cell."""
    def run(parts):
        import pyarrow as pa

        for part in parts:
            row, widths = part.column(0).to_numpy(), part.column(1).to_numpy()
            cell, piece, vectors = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), part.column(2).to_pylist()
            mixed = (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                if width in pivots:
                    cell[at] = (_units([vectors[i] for i in at.tolist()], width, single) @ pivots[width].T).argmax(axis=1)
                for c in np.unique(cell[at]).tolist():
                    some = at[cell[at] == c]
                    piece[some] = mixed[some] % np.uint64(parts_of.get((width, c), 1))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cell), pa.array(piece), part.column(2)], ["row", "width", "cell", "part", "vector"])

    return run


BLOCK = "width int, cell long, part long, rows binary, vectors binary, tree binary, centre binary, radius double"


def _gather(single: bool):
    """A block: its tree, its vectors and rows in the tree's order, and its ball."""
    def run(key, held):
        import pyarrow as pa

        width, cell, piece = (k.as_py() for k in key)
        units = _units(held.column("vector").to_pylist(), width, single)
        tree = CoverTree(units)
        centre = units.mean(axis=0)
        centre = centre / np.sqrt(centre @ centre) if centre @ centre > 1e-9 else units[0]
        radius = float(np.sqrt(np.maximum(0.0, 2 - 2 * (units @ centre))).max()) + SAFE
        held = held.take(pa.array(tree.order))
        values = [width, cell, piece, held.column("row").to_numpy().astype("<i8").tobytes(), b"".join(held.column("vector").to_pylist()), tree.to_bytes(), centre.tobytes(), radius]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64()]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in BLOCK.split(", ")])

    return run


class Balls:
    """Which blocks meet: a ball is (block, width, centre, radius)."""

    def __init__(self, balls: list[tuple[int, int, bytes, float]], limit: float):
        self.limit, self.of, self.by_width = limit, {b[0]: b for b in balls}, {}
        for width in sorted({b[1] for b in balls}):
            own = sorted(b for b in balls if b[1] == width)
            self.by_width[width] = np.array([b[0] for b in own]), np.frombuffer(b"".join(b[2] for b in own)).reshape(-1, width), np.array([b[3] for b in own])

    def meets(self, block: int) -> list[int]:
        """The other blocks that ``block`` meets."""
        _, width, centre, radius = self.of[block]
        ids, centres, radii = self.by_width[width]
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * (centres @ np.frombuffer(centre))))
        return ids[(apart <= radii + radius + self.limit + SAFE) & (ids != block)].tolist()


def _send(balls: Balls):
    """Each block to all pairs that it is in.  Its links inside itself are found in the first of them."""
    def run(parts):
        import pyarrow as pa

        for part in parts:
            for i, block in enumerate(part.column("block").to_pylist()):
                row = part.slice(i, 1)
                for k, other in enumerate(balls.meets(block) or [block]):
                    yield pa.RecordBatch.from_arrays([pa.array([min(block, other)]), pa.array([max(block, other)]), pa.array([k == 0]), *row.columns],
                                                     ["a", "b", "own", *row.schema.names])

    return run


def _compare(threshold: float, single: bool):
    def run(key, held):
        import pyarrow as pa

        trees, found = [], []
        for row in held.sort_by("block").to_pylist():
            rows = np.frombuffer(row["rows"], "<i8")
            trees.append((rows, CoverTree.from_bytes(row["tree"], _units([row["vectors"]], row["width"], single))))
            if row["own"]:
                found.append((rows, *DualTraversal(trees[-1][1], None, threshold).result()))
        if len(trees) == 2:
            found.append((np.concatenate([trees[0][0], trees[1][0]]), *DualTraversal(trees[0][1], trees[1][1], threshold).result()))
        out = []
        for rows, links, child, root in found:
            to = np.arange(len(rows))
            to[child] = root
            some = np.flatnonzero(links)
            out.append(pa.table({"u": rows[some], "links": links[some], "v": rows[to[some]]}))
        schema = pa.schema([("u", pa.int64()), ("links", pa.int64()), ("v", pa.int64())])
        return pa.concat_tables(out).cast(schema) if out else schema.empty_table()

    return run


def embedding_links(vectors: DataFrame, threshold: float, block_rows: int, single: bool) -> DataFrame:
    """(u, links, v) of ``vectors`` (row, width, vector): for each traversal and each row u with links
    in it, their number, and a row v that it reaches by them (u itself at the forest's roots)."""
    used = vectors.where("width > 0").select("row", "width", "vector")
    n = used.count()
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-n // block_rows)))
    sample = used.orderBy(F.xxhash64("row"), "row").select("width", "vector").limit(SAMPLE_ROWS).collect()
    pivots = {w: pivots_of(_units([r.vector for r in sample if r.width == w], w, single), blocks) for w in sorted({r.width for r in sample})}
    celled = lambda parts: used.mapInArrow(_cells(pivots, parts, single), "row long, width int, cell long, part long, vector binary")
    sizes = celled({}).groupBy("width", "cell").agg(F.count("*").alias("n")).collect()  # a row a pivot
    most = max(block_rows, -(-n // MAX_BLOCKS))
    packed = celled({(r.width, r.cell): -(-r.n // most) for r in sizes}).groupBy("width", "cell", "part").applyInArrow(_gather(single), BLOCK)
    packed = materialize(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    balls = Balls([tuple(r) for r in packed.select("block", "width", "centre", "radius").collect()], math.sqrt(max(0.0, 2 - 2 * threshold)))
    tasks = sum(max(1, len(balls.meets(b))) for b in balls.of)
    sent = packed.select("block", "width", "rows", "vectors", "tree").mapInArrow(
        _send(balls), "a long, b long, own boolean, block long, width int, rows binary, vectors binary, tree binary")
    found = sent.repartition(max(1, tasks), "a", "b").groupBy("a", "b").applyInArrow(_compare(threshold, single), "u long, links long, v long")
    return materialize(found, "links")


def embedding_components(embeddings: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS,
                         id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links (other rows whose cosine is at least ``threshold``),
    component_id (least id reachable by links, its own included), kept (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    so do vectors of different lengths.  Rows with a null id take part; a component of such rows only
    has component_id null, and its rows are kept.  Repeated rows are vectors of their own, which link
    with each other; rows that share an id share nothing else.  Other columns are ignored; an
    empty table gives an empty result.  ``threshold`` has to be over 0.
    """
    ship_package(embeddings.sparkSession)
    single, kind = embeddings.schema[vec_col].dataType.elementType.simpleString() == "float", id_type(embeddings, id_col)
    rows = embeddings.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    rows = materialize(rows.mapInArrow(_vectors(single), f"row long, id {kind}, width int, vector binary"), "vectors")
    found = embedding_links(rows, threshold, block_rows, single)
    n_links = found.groupBy("u").agg(F.sum("links").alias("n"))
    linked = materialize(connected_components(found.select("u", "v")), "linked")
    ids = rows.select("row", "id")
    least = linked.join(ids, linked.node == ids.row).groupBy("root").agg(F.min("id").alias("least"))
    classes = linked.join(least, "root").join(n_links, F.col("node") == F.col("u")).select(F.col("node").alias("row"), "n", "least")
    out = ids.join(classes, "row", "left")
    component = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.cast(kind).alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_components(table(spark, sf_dir, "embeddings"))


#: All pairs by cosine in double precision, each direction's reachable vectors by recursion.
ORACLE_OP11 = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors AS a JOIN vectors AS b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM vectors LEFT JOIN degree ON vec_id = degree.a LEFT JOIN least ON vec_id = least.a
"""
