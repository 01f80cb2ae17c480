"""Near duplicates of vectors by an inverted multi-index.

Each half of a unit vector is quantised by its own codebook, and a pair of codes is a cell of the product grid.
From each vector the cells are visited nearest first (multi-sequence order of the two sorted distance lists) until
those visited held a partner of sampled vectors often enough; members of visited cells are then verified by cosine.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut

#: Rows that the codebooks and the number of visited cells are fitted on, and of each length; rows of a block.
SAMPLE, LEAST, BLOCK = 4_000, 64, 512
#: Vectors that a cell is to hold on average, and recall on the sample: as many cells are visited as that takes.
PER_CELL, RECALL = 32, 0.995


def unit(vector) -> np.ndarray | None:
    """The vector at length 1 in double precision; None if it is null, zero or not finite throughout."""
    if vector is None or any(x is None for x in vector):
        return None
    x = np.asarray(vector, float)
    most = float(np.abs(x).max(initial=0.0))
    if not 0 < most < np.inf:  # nor is it NaN
        return None
    x = x / most  # squares stay within range
    return x / np.sqrt(x @ x)


def _codes(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of rows by Lloyd's method from a seeded start."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.permutation(len(rows))[: min(k, len(rows))]].copy()
    for _ in range(rounds):
        at = _squares(rows, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, rows)
        n = np.bincount(at, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def traversal(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """The n cells with the least a[i] + b[j], nearest first, as i * len(b) + j (multi-sequence algorithm)."""
    p, q = a.argsort(kind="stable"), b.argsort(kind="stable")
    heap, seen, out = [(a[p[0]] + b[q[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < n:
        _, i, j = heapq.heappop(heap)
        out.append(int(p[i]) * len(b) + int(q[j]))
        for s, t in ((i + 1, j), (i, j + 1)):
            if s < len(p) and t < len(q) and (s, t) not in seen:
                seen.add((s, t))
                heapq.heappush(heap, (a[p[s]] + b[q[t]], s, t))
    return out


class Index:
    """Two codebooks and how many cells a search visits."""

    def __init__(self, sample: np.ndarray, rows: int, limit: float):
        self.half = sample.shape[1] // 2
        k = int(np.clip(np.sqrt(rows / PER_CELL), 1, max(1, len(sample) // 4)))
        self.books = [_codes(x, k, s) for s, x in enumerate(self.halves(sample))]
        self.visits = 1
        cells = self.cells(sample)
        close = sample @ sample.T >= limit
        np.fill_diagonal(close, False)
        has = np.flatnonzero(close.any(1))[:500]
        # Copies of the sample with noise up to the limit stand in where it holds few pairs.
        rng = np.random.default_rng(7)
        noise = rng.normal(size=sample[:500].shape)
        noise -= (noise * sample[:500]).sum(1)[:, None] * sample[:500]
        noise /= np.linalg.norm(noise, axis=1)[:, None] + 1e-300
        far = limit * sample[:500] + np.sqrt(max(0.0, 1 - limit * limit)) * noise
        wanted = [(sample[i], set(cells[close[i]].tolist())) for i in has] + [(x, {int(c)}) for x, c in zip(far, cells[:500], strict=True)]
        places = []
        for x, goal in wanted:  # cells that are as near or nearer
            da, db = (_squares(h, b)[0] for h, b in zip(self.halves(x[None]), self.books, strict=True))
            sums = (da[:, None] + db).ravel()
            places += [int((sums <= sums[c]).sum()) for c in goal]
        if places:
            self.visits = max(1, int(np.quantile(places, RECALL, method="higher")))

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    def cells(self, x: np.ndarray) -> np.ndarray:
        i, j = (_squares(h, b).argmin(1) for h, b in zip(self.halves(x), self.books, strict=True))
        return i * len(self.books[1]) + j

    def visit(self, x: np.ndarray) -> list[list[int]]:
        da, db = (_squares(h, b) for h, b in zip(self.halves(x), self.books, strict=True))
        return [traversal(a, b, self.visits) for a, b in zip(da, db, strict=True)]


def _raw(kind: str):
    """Usable vectors as bytes of the given type, others as null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["embedding"].to_pylist()
            raw = [None if unit(v) is None else np.asarray(v, kind).tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(raw, pa.binary())], names=["vec_id", "raw"])
    return run


def _units(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).astype(float).reshape(len(raw), -1)
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _placed(indexes: dict[int, tuple[int, Index]], kind: str):
    """Each vector once as a member, at its cell, and once as a visitor for each first code among the cells it visits.

    indexes has an index for each length in bytes, and the number that its first codes start at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["raw"].to_pylist()
            at, first, seconds, visitor = [], [], [], []
            for size in sorted({len(r) for r in raw}):
                rows = [r for r, x in enumerate(raw) if len(x) == size]
                start, index = indexes[size]
                wide, x = len(index.books[1]), _units([raw[r] for r in rows], kind)
                for r, own, visits in zip(rows, index.cells(x).tolist(), index.visit(x), strict=True):
                    by: dict[int, list[int]] = {}
                    for c in visits:
                        by.setdefault(c // wide, []).append(c % wide)
                    for i, js, v in [(own // wide, [own % wide], False), *((i, js, True) for i, js in by.items())]:
                        at.append(r)
                        first.append(start + i)
                        seconds.append(js)
                        visitor.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch["cid"].take(pa.array(at)), batch["raw"].take(pa.array(at)), pa.array(first, pa.int32()), pa.array(seconds, pa.list_(pa.int32())), pa.array(visitor)],
                names=["cid", "raw", "first", "seconds", "visitor"])
    return run


def _links(limit: float, kind: str):
    """Pairs at the limit or above, from (first, block) groups that stand together, members before visitors."""
    def found(x: np.ndarray, own: np.ndarray, seconds: list, cells: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        by: dict[int, list[int]] = {}
        for r, js in enumerate(seconds):
            for j in js:
                if j in cells:
                    by.setdefault(j, []).append(r)
        for j, rows in by.items():
            ids, y = cells[j]
            s, t = np.nonzero(x[rows] @ y.T >= limit)
            a, b = own[rows][s], ids[t]
            yield np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, cells = None, [], None
        for batch in batches:
            first, block, visitor = (batch[c].to_numpy(zero_copy_only=False) for c in ("first", "block", "visitor"))
            edges = np.flatnonzero((np.diff(first) != 0) | (np.diff(block) != 0) | (np.diff(visitor.astype(np.int8)) != 0)) + 1
            out = []
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if s == e:
                    continue
                part = batch.slice(s, e - s)
                if (first[s], block[s]) != key:
                    key, members, cells = (first[s], block[s]), [], None
                x, own, seconds = _units(part["raw"].to_pylist(), kind), part["cid"].to_numpy(), part["seconds"].to_pylist()
                if not visitor[s]:
                    members.append((own, x, np.array([j[0] for j in seconds])))
                    continue
                if cells is None:
                    ids, y, js = (np.concatenate(z) for z in zip(*members, strict=True)) if members else (own[:0], x[:0], own[:0])
                    cells = {int(j): (ids[js == j], y[js == j]) for j in np.unique(js)}
                out += found(x, own, seconds, cells)
            a, b = ([np.concatenate([o[k] for o in out])] if out else [np.empty(0, np.int64)] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a[0], pa.int64()), pa.array(b[0], pa.int64())], names=["a", "b"])
    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", limit: float = 0.95) -> DataFrame:
    """A row for each row of vectors: vec_id, n_links, component_id, kept.

    Vectors whose cosine is at least limit are linked if the search finds them. n_links counts other rows, equal
    vectors included; component_id is the smallest vec_id reachable. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. Vectors of each length have an index of their own and are compared
    among themselves; equal vectors are one class, compared once. Rows that share a vec_id are rows of their own. The
    indexes are fitted on about SAMPLE classes altogether, chosen by a hash, but on LEAST of each length that has so
    many; every vector is in one. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)[embedding] == "array<float>" else "<f8"
    rows = cut(vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding")).mapInArrow(_raw(kind), f"vec_id {dict(vectors.dtypes)[vec_id]}, raw binary"))
    classes = cut(rows.where("raw is not null").groupBy("raw").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))).withColumn("cid", F.monotonically_increasing_id())
    size = F.octet_length("raw")
    counts = {r[0]: r[1] for r in classes.groupBy(size.alias("size")).count().collect()}  # a row for each length
    whole = sum(counts.values())
    most = lambda n: min(n, max(LEAST, SAMPLE * n // whole))
    wanted = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, int(1e6 * most(n) / n)))) if counts else F.lit(None)
    sample: dict[int, list[bytes]] = {}
    for r in classes.where(F.pmod(F.xxhash64("raw"), F.lit(1_000_000)) < F.try_element_at(wanted, size)).select("raw").collect() if counts else []:
        sample.setdefault(len(r[0]), []).append(bytes(r[0]))
    if missing := [k for k in counts if k not in sample]:  # by the hash's chance
        for r in classes.where(size.isin(missing)).groupBy(size).agg(F.min("raw")).collect():
            sample[r[0]] = [bytes(r[1])]
    indexes: dict[int, tuple[int, Index]] = {}
    codes = 0
    for k in sorted(sample):
        index = Index(_units(sample[k], kind), counts[k], limit)
        indexes[k] = (codes, index)
        codes += len(index.books[0])
    placed = cut(classes.select("cid", "raw").mapInArrow(_placed(indexes, kind), "cid long, raw binary, first int, seconds array<int>, visitor boolean"))
    held = placed.where("not visitor").groupBy("first").agg(F.ceil(F.count(F.lit(1)) / (8 * BLOCK)).cast("int").alias("blocks"))
    dealt = placed.join(F.broadcast(held), "first")  # a row for each code of one codebook
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("block", F.explode(F.when(F.col("visitor"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("cid", "raw", "first", "seconds", "visitor", "block").repartition(n, "first", "block").sortWithinPartitions("first", "block", "visitor")
    pairs = cut(dealt.mapInArrow(_links(limit, kind), "a long, b long").distinct())
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(classes.select(F.col("cid").alias("b"), "n"), "b").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    label = components(pairs).withColumnRenamed("id", "cid")
    whole = classes.join(linked, "cid", "left").join(label, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    return _named(rows, whole.join(least, "component").select("raw", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))


def _named(rows: DataFrame, named: DataFrame) -> DataFrame:
    joined = rows.join(named, "raw", "left")
    component = F.when(F.col("raw").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
