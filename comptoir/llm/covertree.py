"""Exact near-duplicate embeddings by cells that hang below a cover tree, met in pairs (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.llm.common import components, query, stored, table

COSINE = 0.95
PIVOTS = 512
BLOCK = 4096
_ROWS = 1024
_SALT = 16
#: Vectors that PIVOTS cells are meant for; with more vectors the cells grow as the root of their number, up to _PIVOT_BYTES.
_FEW = 8192
_PIVOT_BYTES = 32 << 20
#: Blocks of one dimension, if none takes more than _BLOCK_BYTES: a vector is copied once for each.
_SIDES = 4
_BLOCK_BYTES = 48 << 20
#: Blocks with which a vector meets in one round, of whose copies the disks must hold all at once.
_AT_ONCE = 6
#: Members of a cell that are compared at once, vectors they are compared with, pairs compared one by one, vectors of which visitors are
#: sought, so many that a core's cache holds them, and cells for which they are.
_RING = 32
_TILE = 8192
_PAIRS = 1 << 14
_VISITORS = 1 << 15
_TOGETHER = 64
#: Axes kept of long vectors, by which most pairs are told apart.
_AXES = 15
#: Cosines with pivots at once, and links held before they are counted.
_COSINES = 1 << 21
_HELD = 1 << 20
#: Distances come from cosines; near 0 they are good to eight digits.
_SLACK = 1e-7


class CoverTree:
    """Nested nets over unit vectors: the centres of a level are centres of the next, whose radius is half as large.

    A node is a centre at a level; its descendants lie within ``reach`` of it, the covering radius, which is measured.
    ``children[node]`` lists its nodes of the next level that has more than one; leaves are single vectors. Below TINY the
    members of a node are its children, so equal directions end there too.
    """

    TINY = 1e-5

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre: list[int] = []
        self.reach: list[float] = []
        self.children: list[np.ndarray | None] = []
        todo = [(self._node(0), np.arange(len(x)), 2.0)] if len(x) else []
        while todo:
            node, members, radius = todo.pop()
            if len(members) == 1:
                continue
            apart = np.sqrt(np.maximum(2 - 2 * (x[members] @ x[self.centre[node]]), 0))
            self.reach[node] = float(apart.max())
            while radius / 2 >= self.reach[node] > self.TINY:
                radius /= 2
            if self.reach[node] <= self.TINY:
                self.children[node] = np.array([self._node(int(m)) for m in members])
                continue
            centres, owner = self._net(members, self.centre[node], radius / 2)
            order = np.argsort(owner, kind="stable")
            parts = np.split(members[order], np.cumsum(np.bincount(owner))[:-1])
            kids = [self._node(c) for c in centres]
            self.children[node] = np.array(kids)
            todo += [(kid, part, radius / 2) for kid, part in zip(kids, parts)]

    def _node(self, centre: int) -> int:
        self.centre.append(centre)
        self.reach.append(0.0)
        self.children.append(None)
        return len(self.centre) - 1

    def _net(self, members: np.ndarray, centre: int, radius: float) -> tuple[list[int], np.ndarray]:
        """Centres further than ``radius`` apart that cover all members, the given one first, and each member's centre."""
        x, least = self.x[members], 1 - radius * radius / 2
        owner, centres = np.full(len(members), -1), []
        order = np.concatenate([np.flatnonzero(members == centre), np.flatnonzero(members != centre)])
        for lo in range(0, len(order), 256):
            open_ = order[lo:lo + 256]
            open_ = open_[owner[open_] < 0]
            dots = x[open_] @ x.T
            for k, row in zip(open_.tolist(), dots):
                if owner[k] < 0:
                    owner[(row >= least) & (owner < 0)] = len(centres)
                    owner[k] = len(centres)
                    centres.append(int(members[k]))
        return centres, owner


def _slack(dim: int) -> float:
    """More than a cosine of single-precision unit vectors can be off."""
    return (dim + 16) * 2.0 ** -23


def _widened(cosine: np.ndarray | float, angle: float, slack: float) -> np.ndarray:
    """The cosine of ``angle`` more than the angle of ``cosine``, a little less to be safe; all there are if none is further."""
    wide = np.arccos(np.clip(np.asarray(cosine, np.float64) - slack, -1, 1)) + angle
    return np.where(wide < np.pi, np.cos(np.minimum(wide, np.pi)) - slack, -2.0)


class Links:
    """Counts and components of the links found in a task; pairs are not kept."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.count, self.label = weight, np.zeros(len(weight), np.int64), np.arange(len(weight))
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between places a[i] and b[i]."""
        self.held.append((a, b))
        self.waiting += len(a)
        if self.waiting >= _HELD:
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        a, b = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.waiting = [], 0
        self.count += np.bincount(a, self.weight[b], len(self.count)).astype(np.int64) + np.bincount(b, self.weight[a], len(self.count)).astype(np.int64)
        while True:  # smallest label of either side, until nothing changes
            la, lb = self.label[a], self.label[b]
            if (la == lb).all():
                return
            low = np.minimum(la, lb)
            np.minimum.at(self.label, la, low)
            np.minimum.at(self.label, lb, low)
            self.label = self.label[self.label]
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


def _vectors(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The vectors of a column that holds their bytes, all of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset:][:len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Vectors scaled to length 1; first by a power of two, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def _single(x: np.ndarray) -> np.ndarray:
    """The same in single precision, a piece at a time."""
    out = np.empty(x.shape, np.float32)
    for lo in range(0, len(x), _ROWS):
        out[lo:lo + _ROWS] = _unit(x[lo:lo + _ROWS])
    return out


class Cells:
    """Pivots of one dimension with how far their members reach, cut into blocks of about ``block`` vectors."""

    def __init__(self, pivots: np.ndarray):
        tree = CoverTree(pivots)
        order, todo = [], [0]
        while todo:  # depth first, so that cells of one block are close
            node = todo.pop()
            if tree.children[node] is None:
                order.append(tree.centre[node])
            else:
                todo += reversed(tree.children[node].tolist())
        self.pivots = pivots[order].astype(np.float32)
        self.slack = _slack(pivots.shape[1])
        self.low = np.full(len(order), 2.0)  # the least cosine of a member; 2 without members
        self.first = np.zeros(len(order), np.int64)
        self.chunks = np.ones(len(order), np.int64)
        self.start = self.blocks = self.pair = 0
        self.axes = None
        if pivots.shape[1] > 2 * _AXES:  # orthonormal, near those along which the pivots differ most
            axes = np.random.default_rng(1).normal(size=(pivots.shape[1], _AXES))
            for _ in range(4):
                axes = np.linalg.qr(pivots.T @ (pivots @ axes))[0] if len(pivots) >= _AXES else np.linalg.qr(axes)[0]
            self.axes = axes.astype(np.float32)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cosines with all pivots and the nearest."""
        dots = x @ self.pivots.T
        return dots, dots.argmax(1)

    def divide(self, sizes: np.ndarray, block: int, start: int, pair: int) -> tuple[int, int]:
        """Number the blocks from ``start``: small cells share one, a large cell has several. Pairs of blocks from ``pair``. Returns the next numbers."""
        self.start, filled = start, 0
        for c, n in enumerate(sizes.tolist()):
            if n > block:
                start += filled > 0
                self.first[c], self.chunks[c], filled = start, -(-n // block), 0
                start += int(self.chunks[c])
            else:
                if filled + n > block:
                    start, filled = start + 1, 0
                self.first[c] = start
                filled += n
        start += filled > 0
        self.blocks, self.pair = start - self.start, pair
        self.first = np.minimum(self.first, max(start - 1, 0))  # cells without members may lie behind the last block
        return start, pair + self.blocks * (self.blocks + 1) // 2

    def pairs(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Numbers of the pairs of two blocks each; those of a block with itself are shorter and come last."""
        low, high, n = np.minimum(one, two) - self.start, np.maximum(one, two) - self.start, self.blocks
        return self.pair + np.where(low == high, n * (n - 1) // 2 + low, low * (n - 1) - low * (low - 1) // 2 + high - low - 1)

    def of_one(self, pair: int) -> bool:
        """Whether it is the pair of a block with itself."""
        return pair >= self.pair + self.blocks * (self.blocks - 1) // 2

    def reduced(self, x: np.ndarray) -> np.ndarray | None:
        """Unit vectors of fewer dimensions whose cosines are never smaller: the axes, and what is left as one length."""
        if self.axes is None:
            return None
        y = x @ self.axes
        rest = np.sqrt(np.maximum(1 - (y * y).sum(1), 0) + np.float32(8 * self.slack))
        return np.concatenate([y, rest[:, None]], axis=1)


class Block:
    """The vectors that a task has of one block, furthest from their pivots first, and where each cell has its own."""

    def __init__(self, cells: Cells, raw: np.ndarray, cell: np.ndarray, near: np.ndarray, place: np.ndarray):
        order = np.argsort(near, kind="stable")
        self.raw, self.near, self.place = raw[order], near[order], place[order]
        self.x = _single(self.raw)
        self.less = cells.reduced(self.x)
        self.rank = np.arange(len(order), dtype=np.int32)
        self.cells, self.cell, sizes = np.unique(cell[order], return_inverse=True, return_counts=True)
        self.members = np.split(np.argsort(self.cell, kind="stable"), np.cumsum(sizes)[:-1])
        self.low = np.array([self.near[m[0]] for m in self.members if len(m)], np.float64)


def _true(mask: np.ndarray) -> np.ndarray:
    """Where a contiguous mask, read as one row, is true; many places at a time, as few are."""
    flat = mask.reshape(-1)
    whole = len(flat) // 64 * 64
    bytes_ = flat[:whole].view(np.uint64) != 0
    words = np.flatnonzero(bytes_.view(np.uint64) != 0)
    at = np.flatnonzero(bytes_.reshape(-1, 8).take(words, 0))
    eights = words[at >> 3] * 8 + (at & 7)
    at = np.flatnonzero(flat[:whole].reshape(-1, 8).take(eights, 0))
    found = eights[at >> 3] * 8 + (at & 7)
    return found if whole == len(flat) else np.concatenate([found, np.flatnonzero(flat[whole:]) + whole])


class Candidates:
    """Pairs that may be links, held until there are enough to compare at once."""

    def __init__(self, one: Block, two: Block, links: Links, cosine: float, slack: float):
        self.one, self.two, self.links, self.cosine, self.slack = one, two, links, cosine, slack
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def meet(self, p: np.ndarray, q: np.ndarray) -> None:
        """Find those between vectors ``p`` of one and vectors ``q`` of two."""
        one, two = self.one, self.two
        less = None if one.less is None else np.ascontiguousarray(one.less.take(p, 0).T)
        for lo in range(0, len(q), _TILE):
            some = q[lo:lo + _TILE]
            if less is not None:
                at = _true(two.less.take(some, 0) @ less >= np.float32(self.cosine - 8 * self.slack))
            if less is None or len(at) > len(some) * len(p) // 32:
                at = _true(two.x.take(some, 0) @ one.x.take(p, 0).T >= np.float32(self.cosine - self.slack))
            if len(at):
                j, i = np.divmod(at, len(p))
                self.held.append((p.take(i), some.take(j)))
                self.waiting += len(at)
                if self.waiting >= _PAIRS:
                    self.settle()

    def settle(self) -> None:
        """Count the links among them, of which the vectors of one have the higher rank."""
        if not self.waiting:
            return
        one, two = self.one, self.two
        i, j = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.waiting = [], 0
        higher = np.flatnonzero(one.rank.take(i) > two.rank.take(j))
        i, j = i[higher], j[higher]
        for lo in range(0, len(i), _PAIRS):
            k, m = i[lo:lo + _PAIRS], j[lo:lo + _PAIRS]
            dots = np.einsum("ij,ij->i", one.x.take(k, 0), two.x.take(m, 0))
            near = np.flatnonzero(dots >= np.float32(self.cosine - self.slack))
            k, m, keep = k[near], m[near], dots[near] >= np.float32(self.cosine + self.slack)
            doubt = np.flatnonzero(~keep)  # what single precision cannot tell
            if len(doubt):
                keep[doubt] = (_unit(one.raw[k[doubt]]) * _unit(two.raw[m[doubt]])).sum(1) >= self.cosine
            self.links.add(one.place[k[keep]], two.place[m[keep]])


def traverse(cells: Cells, one: Block, two: Block, links: Links, cosine: float) -> None:
    """Add the links between members of one and the vectors of two that have a lower rank: that lie further from their own pivots.

    Cells whose pivots are further apart than the threshold and both covering radii hold no link and are left. A vector visits a ring of
    another cell, members of like distance from their pivot, only if its own distance from that pivot is within the threshold of theirs.
    """
    if not len(one.x) or not len(two.x):
        return
    slack, angle = cells.slack, float(np.arccos(np.clip(cosine, -1, 1))) + 1e-9
    pairs = Candidates(one, two, links, cosine, slack)
    reach = [np.arccos(np.clip(b.low - slack, -1, 1)) for b in (one, two)]
    least = (_widened(one.near, angle, slack) - slack).astype(np.float32)
    for lo in range(0, len(one.cells), _TOGETHER):
        pivots = cells.pivots[one.cells[lo:lo + _TOGETHER]]
        apart = np.arccos(np.clip(pivots @ cells.pivots[two.cells].T + np.float32(slack), -1, 1))
        open_ = (apart <= reach[0][lo:lo + _TOGETHER, None] + reach[1][None, :] + angle + _SLACK).any(0)
        rows = None if open_.all() else np.flatnonzero(open_[two.cell])
        for start in range(0, len(two.x) if rows is None else len(rows), _VISITORS):
            some = slice(start, start + _VISITORS)
            x, rank = (v[some] if rows is None else v.take(rows[some], 0) for v in (two.x, two.rank))
            dots = pivots @ x.T
            for members, cosines in zip(one.members[lo:lo + _TOGETHER], dots):
                for p in range(0, len(members), _RING):
                    ring = members[p:p + _RING]
                    below = rank.searchsorted(one.rank[ring[-1]])
                    q = np.flatnonzero(cosines[:below] >= least[ring[0]]) if below else ring[:0]
                    if len(q):
                        pairs.meet(ring, q + start if rows is None else rows[some].take(q))
    pairs.settle()


def _placed(spark: SparkSession, n: int) -> list[int]:
    """Numbers that hash partitioning into ``n`` deals to each partition in turn, so that no two tasks meet in one."""
    found: dict[int, int] = {}
    drawn = spark.range(0, int(n * (np.log(n + 1) + 8)), 1, 1)
    for r in drawn.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("to")).agg(F.min("id").alias("id")).collect():
        found[r["to"]] = r["id"]
    return [found.get(k, k) for k in range(n)]


def near_embeddings(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE,
                    pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Vectors linked by a cosine of ``cosine`` or more, in double precision, compared exactly whatever their labels.

    1. Equal vectors become one with a weight and a number of its own, which links refer to; ids only name the results.
    2. A cover tree over ``pivots`` vectors, drawn by a hash, more as the root of the table, gives cells; each vector belongs to its nearest
       pivot, and each cell has a measured covering radius. Neighbouring cells form blocks of at least ``block``; a large cell is cut into several.
    3. A vector goes to its own block and to every pair of its block with another in which some cell lies within the threshold and its
       covering radius: all others cannot hold a link. So a task has at most two blocks, however hot a cell is, and there are
       few blocks, as each is another copy of the table. Where there are many, their pairs meet in rounds, whose copies go one after the other.
    4. In a task the cells of both blocks are traversed together: of two vectors the one further from its own pivot visits the other's cell,
       if triangles of angles allow it. Those that meet are told apart by a few axes, then by all in single precision, and in double precision
       where that is in doubt. The task returns counts and a spanning label per vector, never pairs. Where data do not
       cluster, all blocks meet and the work grows with the square of the table, though much less is done for a pair.

    Returns one row per row of ``vectors``: vec_id, n_links, component_id, kept. Vectors that are NULL, zero, or hold NULL or
    non-finite components link with nothing, nor do vectors of different length. Rows of equal vectors link with each other. Rows that
    share an id, or have none, are separate vectors; a component is named by its smallest id, NULL only where it has no other.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e"))
    single = source.schema["e"].dataType == T.ArrayType(T.FloatType()) or source.schema["e"].dataType == T.ArrayType(T.FloatType(), False)
    kind, width = ("<f4", 4) if single else ("<f8", 8)

    @F.arrow_udf(T.BinaryType())
    def packed(e: pa.Array) -> pa.Array:
        """The bytes of a vector, 0 for -0; NULL if it links with nothing."""
        n = pc.fill_null(pc.list_value_length(e), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = e.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)
        at = np.concatenate([[0], np.cumsum(n)])
        odd, some = (np.concatenate([[0], np.cumsum(x)])[at] for x in (~np.isfinite(flat), flat != 0))
        sound = (np.diff(odd) == 0) & (np.diff(some) > 0)
        return pa.Array.from_buffers(pa.binary(), len(e), [pa.py_buffer(np.packbits(sound, bitorder="little")), pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(flat)])

    # marked so that no filter evaluates it again
    source = source.select("vec_id", packed.asNondeterministic()(F.col("e") if single else F.col("e").cast("array<double>")).alias("k"))
    distinct = stored(source.where("k IS NOT NULL").groupBy("k").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
                      .withColumn("id", F.monotonically_increasing_id()))
    dims = {r["dim"]: r["n"] for r in distinct.groupBy((F.octet_length("k") / width).cast("int").alias("dim")).agg(F.count("*").alias("n")).collect()}
    wanted = {d: max(pivots, min(int(pivots * (n / _FEW) ** 0.5), _PIVOT_BYTES // (4 * d))) for d, n in dims.items()}
    rate = F.element_at(F.create_map(*[F.lit(x) for d, n in dims.items() for x in (width * d, min(1.0, wanted[d] / n))]), F.octet_length("k")) if dims else F.lit(0.0)
    drawn = distinct.where(F.pmod(F.xxhash64("k"), F.lit(1_000_003)) < rate * 1_000_003).select("k").toArrow().column("k")
    cells = {}
    for d in sorted(dims):
        own = drawn.filter(pc.equal(pc.binary_length(drawn), width * d))
        cells[d] = Cells(_unit(_vectors(own, kind)) if len(own) else np.eye(1, d))
    shared = spark.sparkContext.broadcast(cells)

    def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        sizes = pc.binary_length(batch.column("k")).to_numpy(zero_copy_only=False) // width
        for d in np.unique(sizes).tolist():
            part = batch if (sizes == d).all() else batch.take(pa.array(np.flatnonzero(sizes == d)))
            rows = max(16, min(_ROWS, _COSINES // len(shared.value[d].pivots)))
            for lo in range(0, len(part), rows):
                yield d, part.slice(lo, rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = {d: np.full(len(c.pivots), 2, np.float32) for d, c in shared.value.items()}
        sizes = {d: np.zeros(len(c.pivots), np.int64) for d, c in shared.value.items()}
        for batch in batches:
            for d, part in by_dim(batch):
                dots, cell = shared.value[d].nearest(_single(_vectors(part.column("k"), kind)))
                # nearly as near counts too: sums may come out in another order next time
                i, j = np.divmod(_true(dots >= (dots[np.arange(len(cell)), cell] - np.float32(4 * shared.value[d].slack))[:, None]), dots.shape[1])
                np.minimum.at(low[d], j, dots[i, j])
                sizes[d] += np.bincount(cell, minlength=len(sizes[d]))
        for d, least in low.items():
            seen = np.flatnonzero(least < 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), d, np.int32)), pa.array(seen.astype(np.int32)), pa.array(least[seen].astype(np.float64)), pa.array(sizes[d][seen])], names=["dim", "cell", "low", "n"])

    measured = distinct.select("k").mapInArrow(measure, "dim int, cell int, low double, n long").groupBy("dim", "cell").agg(F.min("low").alias("low"), F.sum("n").alias("n")).collect()
    sizes = {d: np.zeros(len(c.pivots), np.int64) for d, c in cells.items()}
    for r in measured:
        sizes[r["dim"]][r["cell"]], cells[r["dim"]].low[r["cell"]] = r["n"], r["low"]
    start = pair = 0
    for d, c in cells.items():
        most = max(1, _BLOCK_BYTES // (width * d))
        share = -(-dims[d] // _SIDES)
        over = int(sizes[d][sizes[d] <= share].max(initial=0))  # so much of a block may stay free
        start, pair = c.divide(sizes[d], max(block, min(share + over, most)), start, pair)
    tasks, rounds = min(max(pair, 1), 1 << 14), max([1, *(-(-c.blocks // _AT_ONCE) for c in cells.values())])
    to = np.array(_placed(spark, tasks), np.int64)
    placed = spark.sparkContext.broadcast(cells)
    angle = float(np.arccos(np.clip(cosine, -1, 1))) + 1e-9
    number = distinct.schema["id"].dataType

    schema = T.StructType().add("task", "long").add("pair", "long").add("high", "boolean").add("id", number).add("weight", "long").add("cell", "long").add("near", "float").add("k", T.BinaryType())

    def send(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        borders = {d: np.flatnonzero(np.diff(c.first, prepend=-1)) for d, c in placed.value.items()}  # cells where another block begins
        least = {d: (_widened(np.minimum(c.low, 1), angle, c.slack) - c.slack).astype(np.float32) for d, c in placed.value.items()}
        for d, c in placed.value.items():
            least[d][c.low == 2] = 3  # nothing to visit
        for batch in batches:
            for d, part in by_dim(batch):
                c = placed.value[d]
                dots, cell = c.nearest(_single(_vectors(part.column("k"), kind)))
                near = dots[np.arange(len(cell)), cell]
                own = c.first[cell] + _vectors(part.column("k"), "<u4").sum(1, dtype=np.int64) % c.chunks[cell]
                met = np.logical_or.reduceat(dots >= least[d], borders[d], axis=1)
                met[np.arange(len(cell)), np.searchsorted(borders[d], cell, "right") - 1] = True
                i, j = np.nonzero(met)
                first, n = c.first[borders[d]][j], np.maximum.reduceat(c.chunks, borders[d])[j]
                other = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                i = np.repeat(i, n)
                now = np.flatnonzero((own[i] + other) % rounds == turn)
                i, other = i[now], other[now]
                pairs = c.pairs(own[i], other)
                columns = [to[pairs % tasks], pairs, own[i] > other, None, None, cell[i], near[i]]
                for lo in range(0, len(i), 8 * _ROWS):
                    cut = slice(lo, lo + 8 * _ROWS)
                    take = pa.array(i[cut])
                    yield pa.RecordBatch.from_arrays([pa.array(x[cut]) if x is not None else part.column(name).take(take) for name, x in zip(schema.names, [*columns, None])], names=schema.names)

    found = T.StructType().add("u", number).add("v", number).add("n", "long")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            all_ = batch.column("pair").to_numpy()
            for p in np.unique(all_).tolist():
                parts.setdefault(p, []).append(batch if (all_ == p).all() else batch.filter(pa.array(all_ == p)))
        for p in sorted(parts):
            group = pa.Table.from_batches(parts.pop(p))
            ids, high = group.column("id").to_numpy(), group.column("high").to_numpy()
            links = Links(group.column("weight").to_numpy())
            raw, cell, near = _vectors(group.column("k"), kind), group.column("cell").to_numpy(), group.column("near").to_numpy()
            c = placed.value[raw.shape[1]]
            blocks = [Block(c, raw[at], cell[at], near[at], at) for at in (np.flatnonzero(~high), np.flatnonzero(high))]
            order = np.argsort(np.concatenate([b.near for b in blocks]), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            blocks[0].rank, blocks[1].rank = np.split(rank, [len(blocks[0].x)])
            if high.any():
                traverse(c, *blocks, links, cosine)
                traverse(c, *blocks[::-1], links, cosine)
            elif c.of_one(p):
                traverse(c, blocks[0], blocks[0], links, cosine)
            links.settle()
            some = np.flatnonzero(links.count)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[links.label[some]]), pa.array(links.count[some])], names=found.names)

    turns = [distinct.select("id", "weight", "k").mapInArrow(lambda batches, turn=turn: send(batches, turn), schema) for turn in range(rounds)]
    counted = reduce(DataFrame.unionByName, [stored(sent.repartition(tasks, "task").mapInArrow(meet, found)) for sent in turns])
    others = counted.groupBy("u").agg(F.sum("n").alias("n"))
    parts = components(counted.select("u", "v")).join(distinct.select(F.col("id").alias("node"), "least"), "node")
    # one component may hold a third of all vectors: its name is copied for each of _SALT shares of them
    names = parts.groupBy("component").agg(F.min("least").alias("name")).withColumn("salt", F.explode(F.array(*map(F.lit, range(_SALT)))))
    named = parts.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(_SALT)).cast("int")).join(names, ["component", "salt"]).select("node", "name")
    labels = (
        distinct.join(others, F.col("id") == F.col("u"), "left").join(named, F.col("id") == F.col("node"), "left")
        .where("weight > 1 OR n IS NOT NULL")  # all others have no link and name themselves
        .select(F.col("k").alias("same"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("name", "least").alias("component_id"))
    )
    # rows without a vector to compare get 21 bytes that no vector has, so that they do not meet in one task
    rows = source.withColumn("k", F.coalesce("k", F.encode(F.lpad(F.monotonically_increasing_id().cast("string"), 21, "0"), "utf-8")))
    return rows.join(labels, F.col("k") == F.col("same"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op1_covertree")
def op1_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))
