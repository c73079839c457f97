"""Near-duplicate embeddings by product quantisation.

Coarse k-means cells hold inverted lists; a vector's residual to its cell's
centre is coded by one of 256 codes in each of 8 subspaces.  Every vector visits
each cell that may hold a vector of cosine ``min_cosine`` or more to it: the
triangle inequality with the cell's stored least and largest member distance, and
the distance to the plane between its own centre and the cell's, rule out only
cells that can't.  There, lookups in its table of products with the codes (one for
all cells, as a residual's product needs no centre) give its product with the coded
members.  A member knows the least product that a link leaves it with, given its own
coding error; what passes is settled by the exact cosine in double precision.  So no
link is lost; vectors without structure visit every cell, and the search is all pairs.

Equal vectors are one class from the start.  Of two cells the one of the larger
number visits the other.  Cells are taken in groups, whose members and visitors
are cut into blocks, so no group is gathered in one task and a vector is shipped
once per group; a block's links leave it as counts per vector and a spanning
forest, never as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from routekpi.llm import words as W
from routekpi.llm.components import components
from routekpi.llm.near_dedup import grouped
from routekpi.llm.scratch import save, ship

MIN_COSINE = 0.9
#: Vectors per cell, about, up to MAX_CELLS; larger cells are cut into blocks.
CELL_SIZE = 128
MAX_CELLS = 2048
#: Cells that are searched together.
GROUP = 32
SUBSPACES, CODES = 8, 256
#: The index is fitted on at most so many vectors; every vector is indexed.
SAMPLE = 16_384
ROUNDS = 8
MEMBERS, VISITORS = 4096, 2048  # of one block
#: Visitors and members whose products are looked up at once.
STEP = 256
#: Slack of the bounds for rounding.
SLACK = 1e-6


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, dim, h1, h2, vec): vec null where a vector can't link."""
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        n = batch.num_rows
        lists = batch.column(1)
        dim = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        flat = lists.flatten().cast(pa.float64())
        values = np.asarray(flat.fill_null(np.nan)) + 0.0  # -0.0 becomes 0.0
        at = np.concatenate([[0], np.cumsum(dim)])
        vecs, h1, h2 = [None] * n, np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(n):
            v = values[at[i] : at[i + 1]]
            if len(v) and np.isfinite(v).all() and v.any():
                vecs[i] = v.tobytes()
                bits = v.view(np.uint64) ^ W.mix64(np.arange(len(v), dtype=np.uint64))
                h1[i] = W.mix64(bits).sum().view(np.int64)
                h2[i] = W.mix64(bits + np.uint64(0x632BE59BD9B4E019)).sum().view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(row, row + n)), batch.column(0), pa.array(dim), pa.array(h1), pa.array(h2), pa.array(vecs, pa.binary())],
            ["row", "id", "dim", "h1", "h2", "vec"])
        row += n


def _matrix(column) -> np.ndarray:
    """Raw vectors, one row each."""
    items = column.to_pylist()
    return np.frombuffer(b"".join(items), np.float64).reshape(len(items), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """The vectors times powers of two: largest components of 0.5 to 1, so no square overflows and no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def least_product(along: np.ndarray, across: np.ndarray, min_cosine: float) -> np.ndarray:
    """The least product with a coded vector that a unit vector of the cosine to the vector itself can have.

    ``along`` is the code's product with its vector, ``across`` the length of what the
    code has beside it.  At cosine c the product is at least c * along -
    sqrt(1 - c * c) * across, which is convex in c.
    """
    length = np.hypot(along, across)
    c = np.clip(-along / np.where(length > 0, length, 1.0), min_cosine, 1.0)
    return c * along - np.sqrt(1.0 - c * c) * across


def _nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest centres, nearest first; ties to the smaller index."""
    score = (centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)
    if k < len(centres):
        some = np.sort(np.argpartition(score, k - 1, axis=1)[:, :k], axis=1)
    else:
        some = np.broadcast_to(np.arange(len(centres)), score.shape)
    return np.take_along_axis(some, np.argsort(np.take_along_axis(score, some, axis=1), axis=1, kind="stable"), axis=1)


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Centres of at most k cells; cells that run empty keep their centre."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = np.concatenate([_nearest(x[i : i + 2048], centres, 1)[:, 0] for i in range(0, len(x), 2048)])
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


class Index:
    """Coarse centres and residual codebooks, zero-padded to whole subspaces."""

    def __init__(self, sample: np.ndarray, cells: int):
        x = _unit(sample)
        self.centres = kmeans(x, cells)
        rest = self.split(x - self.centres[_nearest(x, self.centres, 1)[:, 0]])
        self.books = [kmeans(rest[:, s], min(CODES, len(rest)), seed=s) for s in range(SUBSPACES)]

    @staticmethod
    def split(x: np.ndarray) -> np.ndarray:
        width = -(-x.shape[1] // SUBSPACES)
        padded = np.zeros((len(x), SUBSPACES * width))
        padded[:, : x.shape[1]] = x
        return padded.reshape(len(x), SUBSPACES, width)

    def encode(self, x: np.ndarray, cell: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the least product with the coded vector that a link can have."""
        rest = self.split(x - self.centres[cell])
        codes = np.zeros((len(x), SUBSPACES), np.uint8)
        near = np.zeros_like(rest)
        for s, book in enumerate(self.books):
            codes[:, s] = _nearest(rest[:, s], book, 1)[:, 0]
            near[:, s] = book[codes[:, s]]
        coded = self.centres[cell] + near.reshape(len(x), -1)[:, : x.shape[1]]
        along = (x * coded).sum(axis=1)
        across = np.sqrt(((coded - along[:, None] * x) ** 2).sum(axis=1))
        return codes, least_product(along, across, min_cosine)

    def tables(self, x: np.ndarray) -> list[np.ndarray]:
        """Per subspace the products of each code (rows) with each vector."""
        parts = self.split(x).astype(np.float32)
        return [book.astype(np.float32) @ parts[:, s].T for s, book in enumerate(self.books)]

    def slack(self) -> float:
        """More than the rounding of products that are looked up in single precision."""
        return SLACK + 4 * (self.books[0].shape[1] + 16) * float(np.finfo(np.float32).eps)


def looked_up(tables: list[np.ndarray], codes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Products of coded members (rows) with the tables' vectors: ``start`` of each vector plus the codes' products."""
    out = np.take(tables[0], codes[:, 0], axis=0)
    out += start.astype(np.float32)
    more = np.empty_like(out)
    for s in range(1, SUBSPACES):
        out += np.take(tables[s], codes[:, s], axis=0, out=more, mode="clip")
    return out


class Indexes:
    """One index per dimension; cells and groups are numbered through, no group spans two."""

    def __init__(self, samples: dict[int, np.ndarray], cells: dict[int, int], group: int = GROUP):
        self.group, self.base, self.of, top = group, {}, {}, 0
        for dim in sorted(samples):
            self.base[dim], self.of[dim] = top, Index(samples[dim], cells[dim])
            top += -(-len(self.of[dim].centres) // group) * group
        self.least, self.most = np.full(top, np.inf), np.full(top, -np.inf)

    def measure(self, cell: np.ndarray, least: np.ndarray, most: np.ndarray) -> None:
        """Least and largest distance of the members to their centre; other cells are empty."""
        self.least[cell], self.most[cell] = least, most

    def may_link(self, x: np.ndarray, home: np.ndarray, cells: np.ndarray, reach: float) -> np.ndarray:
        """Whether each cell, up to the vector's own, may hold a member within ``reach`` of the unit vector."""
        dim = x.shape[1]
        centres, base = self.of[dim].centres, self.base[dim]
        own, there = centres[home - base], centres[cells - base]
        size = (x * x).sum(axis=1)
        apart = np.maximum(size[:, None] + (there * there).sum(axis=1)[None, :] - 2 * (x @ there.T), 0.0)
        near = ((x - own) ** 2).sum(axis=1)
        between = (own * own).sum(axis=1)[:, None] + (there * there).sum(axis=1)[None, :] - 2 * (own @ there.T)
        far = np.sqrt(apart)
        limit = reach + SLACK
        may = (far <= self.most[cells][None, :] + limit) & (far >= self.least[cells][None, :] - limit)
        # a member is no nearer to the vector's own centre than to its cell's
        may &= apart - near[:, None] <= 2 * np.sqrt(np.maximum(between, 0.0)) * limit + SLACK
        return (may & (cells[None, :] < home[:, None])) | (cells[None, :] == home[:, None])


def _by_dim(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.asarray(batch["dim"])
    for dim in np.unique(dims):
        rows = batch.filter(pa.array(dims == dim))
        for at in range(0, rows.num_rows, size):
            yield int(dim), rows.slice(at, size)


def _encode(indexes: Broadcast, min_cosine: float):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch, 1024):
                x = _unit(_matrix(part["vec"]))
                index = indexes.value.of[dim]
                cell = _nearest(x, index.centres, 1)[:, 0]
                codes, need = index.encode(x, cell, min_cosine)
                away = np.sqrt(((x - index.centres[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [part["rep"], part["weight"], part["dim"], part["vec"], pa.array((cell + indexes.value.base[dim]).astype(np.int32)),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(need), pa.array(away)],
                    ["rep", "weight", "dim", "vec", "cell", "code", "need", "away"])

    return encode


def _visit(indexes: Broadcast, min_cosine: float):
    """Adds the groups with cells that may hold a link's other end."""
    reach = np.sqrt(2 - 2 * min_cosine)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rep", "weight", "dim", "vec", "cell", "code", "need"]
        for batch in batches:
            for dim, part in _by_dim(batch, 1024):
                index = indexes.value
                cells = index.base[dim] + np.arange(len(index.of[dim].centres))
                may = index.may_link(_unit(_matrix(part["vec"])), np.asarray(part["cell"]), cells, reach)
                groups = np.logical_or.reduceat(may, np.arange(0, len(cells), index.group), axis=1)
                row, group = np.nonzero(groups)
                begin = np.concatenate([[0], np.cumsum(groups.sum(axis=1))])
                visits = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array((group + index.base[dim] // index.group).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in names), visits], [*names, "visits"])

    return visit


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of each node's component, for links a[i]-b[i] over 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _search(indexes: Broadcast, min_cosine: float):
    """Sorted (group, mblock, vblock) rows to counts and forest links of their vectors."""
    reach = np.sqrt(2 - 2 * min_cosine)

    def linked(exact, norm, v, m):
        """Which of the pairs (v, m) are links."""
        keep = np.zeros(len(v), bool)
        for i in range(0, len(v), 8192):
            a, b = v[i : i + 8192], m[i : i + 8192]
            keep[i : i + 8192] = (exact[a] * exact[b]).sum(axis=1) / (norm[a] * norm[b]) >= min_cosine
        return keep

    def block(rep, weight, vec, member, code, need, home):
        m, v = np.flatnonzero(member), np.flatnonzero(~member)
        if not len(m) or not len(v):
            return
        exact, x = _scaled(vec), _unit(vec[v])
        norm = np.sqrt((exact * exact).sum(axis=1))
        cells = np.unique(home[m])
        may = indexes.value.may_link(x, home[v], cells, reach)
        index = indexes.value.of[vec.shape[1]]
        starts = index.centres[cells - indexes.value.base[vec.shape[1]]] @ x.T
        need = (need - index.slack()).astype(np.float32)
        links = np.zeros(len(rep), np.int64)
        nodes, at = np.unique(rep, return_inverse=True)
        root = np.arange(len(nodes))
        for j in range(0, len(v), STEP):
            tables, pairs = index.tables(x[j : j + STEP]), []
            for i, cell in enumerate(cells):
                asked = may[j : j + STEP, i]
                come = np.flatnonzero(asked)
                if not len(come):
                    continue
                if 4 * len(come) > len(asked):  # cheaper to look all up than to copy columns
                    some, come = tables, np.arange(len(asked))
                else:
                    some = [np.take(t, come, axis=1) for t in tables]
                held = m[home[m] == cell]
                for k in range(0, len(held), STEP):
                    q = held[k : k + STEP]
                    b, a = np.nonzero((looked_up(some, code[q], starts[i, j + come]) >= need[q, None]) & asked[come])
                    p, q = v[j + come[a]], q[b]
                    pairs.append((p[rep[p] != rep[q]], q[rep[p] != rep[q]]))
            if pairs:
                p, q = (np.concatenate(z) for z in zip(*pairs))
                keep = linked(exact, norm, p, q)
                p, q = p[keep], q[keep]
            if pairs and len(p):
                np.add.at(links, p, weight[q])
                # of one cell, the member visits too and counts for itself
                other = home[p] != home[q]
                np.add.at(links, q[other], weight[p[other]])
                own = np.arange(len(nodes))
                root = forest(np.concatenate([own, at[p]]), np.concatenate([root, at[q]]), len(nodes))
        root = nodes[root[at]]
        some = (links > 0) | (root != rep)
        yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some]), pa.array(root[some])], ["rep", "links", "root"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in grouped(batches, ["group", "mblock", "vblock"]):
            for begin, end in zip(at, np.append(at[1:], table.num_rows)):
                t = table.slice(int(begin), int(end - begin))
                yield from block(
                    np.asarray(t["rep"]), np.asarray(t["weight"]), _matrix(t["vec"]), np.asarray(t["member"]),
                    np.frombuffer(b"".join(t["code"].to_pylist()), np.uint8).reshape(-1, SUBSPACES), np.asarray(t["need"]), np.asarray(t["home"]))

    return search


def near_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", min_cosine: float = MIN_COSINE, cell_size: int = CELL_SIZE) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Rows link when their cosine, in double precision, is ``min_cosine`` or more.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id that links reach.  Vectors of different dimensions don't link.
    Vectors that are null, empty, all zero or hold a null or non-finite component
    link with nothing.  Rows that repeat an id are rows of their own.
    """
    spark = table.sparkSession
    ship(spark)
    narrow = table.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    kind = narrow.schema["id"].dataType.simpleString()
    rows = save(narrow.mapInArrow(_rows, f"row long, id {kind}, dim long, h1 long, h2 long, vec binary"), "vectors")
    fit = rows.where(F.col("vec").isNotNull())
    classes = save(fit.groupBy("dim", "h1", "h2").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("weight")), "classes")
    named = save(fit.select("row", "id", "dim", "h1", "h2").join(classes, ["dim", "h1", "h2"]).select("row", "id", "rep", "weight"), "named")
    unfit = rows.join(named.select("row"), "row", "left_anti")
    nothing = unfit.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    counts = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # few dimensions occur
    out = nothing
    if counts:
        reps = rows.drop("dim").join(classes.select(F.col("rep").alias("row"), "rep", "weight", "dim"), "row").select("rep", "weight", "dim", "vec")
        sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("dim", "vec").toPandas()
        lacking = [d for d in counts if d not in set(sample["dim"])]  # rare dimensions: one vector starts their index
        if lacking:
            heads = classes.where(F.col("dim").isin(lacking)).groupBy("dim").agg(F.min("rep").alias("rep")).select("rep")
            sample = pd.concat([sample, reps.join(heads, "rep").select("dim", "vec").toPandas()])
        samples = {int(d): np.frombuffer(b"".join(v), np.float64).reshape(len(v), -1) for d, v in sample.groupby("dim")["vec"]}
        cells = {d: max(1, min(MAX_CELLS, counts[d] // cell_size, len(x) // 4)) for d, x in samples.items()}
        plain = Indexes(samples, cells)
        index = spark.sparkContext.broadcast(plain)
        coded = save(reps.mapInArrow(_encode(index, min_cosine), "rep long, weight long, dim long, vec binary, cell int, code binary, need double, away double"), "coded")
        spans = coded.groupBy("cell").agg(F.min("away").alias("least"), F.max("away").alias("most")).toPandas()  # a row per cell
        plain.measure(spans["cell"].to_numpy(), spans["least"].to_numpy(), spans["most"].to_numpy())
        index = spark.sparkContext.broadcast(plain)
        coded = save(coded.mapInArrow(_visit(index, min_cosine), "rep long, weight long, dim long, vec binary, cell int, code binary, need double, visits array<int>"), "visits")

        coded = coded.withColumnRenamed("cell", "home").withColumn("own", F.floor(F.col("home") / plain.group).cast("int"))
        sizes = coded.groupBy("own").agg(F.count(F.lit(1)).alias("m")).select(F.col("own").alias("at"), F.ceil(F.col("m") / MEMBERS).alias("mblocks"))
        loads = coded.select(F.explode("visits").alias("at")).groupBy("at").agg(F.ceil(F.count(F.lit(1)) / VISITORS).alias("vblocks"))
        plan = save(sizes.join(loads, "at"), "blocks")
        columns = ["at", "mblock", "vblock", "rep", "weight", "vec", "code", "need", "home", "member"]
        spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        members = coded.join(F.broadcast(plan), F.col("own") == F.col("at"))  # a row per group
        members = members.withColumn("mblock", F.pmod(F.xxhash64("rep"), F.col("mblocks"))).withColumn("vblock", spread("vblocks")).withColumn("member", F.lit(True))
        visitors = coded.withColumn("to", F.explode("visits")).join(F.broadcast(plan), F.col("to") == F.col("at"))
        visitors = visitors.withColumn("vblock", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("vblocks"))).withColumn("mblock", spread("mblocks"))
        visitors = visitors.withColumn("member", F.lit(False))
        blocks = members.select(columns).unionByName(visitors.select(columns)).withColumnRenamed("at", "group")
        blocks = blocks.repartition("group", "mblock", "vblock").sortWithinPartitions("group", "mblock", "vblock")
        found = save(blocks.mapInArrow(_search(index, min_cosine), "rep long, links long, root long"), "found")
        links = found.groupBy("rep").agg(F.sum("links").alias("links"))
        roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
        full = named.join(save(links, "links"), "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        firsts = save(full.groupBy("root").agg(F.min("id").alias("component_id")), "firsts")
        full = full.join(firsts, "root").withColumn("n_links", F.col("weight") - 1 + F.coalesce("links", F.lit(0)))
        out = full.select("id", "n_links", "component_id").unionByName(nothing)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
