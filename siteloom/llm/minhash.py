"""Near duplicates by bottom-k sketches from one hash function.

The SKETCH smallest hash values of a document's set of shingles, runs of so many words, are retained. Two sets with
similarity of 0.8 or more share at least SHARED of them but for a chance of 4e-10 at 0.8, and far less above it, or
0.8 of them if the sets are smaller than that. A document is therefore listed only under its rarest values, so many
that two documents which share that much meet in a list (prefix filtering); values that no document of a fitting size
shares don't count.

Candidates are pairs of a list whose sizes allow 0.8, with enough overlap and a union sketch that says so. A list gives
only the components of them, as stars, so its rows grow with its length and not with its square. The components of all
these hold every link; within one, the exact Jaccard similarity of the full sets decides, again in blocks that give
stars. Before that, lists longer than LONG are compared, by full sets, with a few of their members
(hubs): a large group of copies is one component then, and only pairs of different components go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, small_batches, stored, thinned

SKETCH, SHARED = 32, 10
#: Share of the union sketch that must be common for a pair to be verified; 0.8 is the limit for links.
ESTIMATE = SHARED / SKETCH
#: Lists longer than LONG are compared with HUBS of their members first, ROUNDS times at most.
LONG, HUBS, ROUNDS = 512, 4, 2
#: Members of a list in a block of sketches, and of a component of candidates in a block of full sets.
BLOCK, WHOLE = 1024, 1024
#: Sets whose overlaps are counted at once, and values.
TILE, COLUMNS = 256, 8192
#: Words whose hash a worker remembers.
REMEMBERED = 300_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def split_words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case: bytes split and lower only in ASCII."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], hashes: dict, width: int = 2) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of width words, ascending; of the whole sequence, if it has fewer words."""
    if not words:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    run = min(width, len(a))
    x = a[: len(a) - run + 1]
    for k in range(1, run):
        b = a[k : len(a) - run + 1 + k]
        x = x * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(30)
    return np.unique(x) if run == width else x ^ np.uint64(0xA0761D6478BD642F)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            sets = [shingle_hashes(split_words(t), hashes, width) for t in batch["text"].to_pylist()]
            kept = [s[:SKETCH].view(np.int64) for s in sets]
            offsets = np.cumsum([0, *map(len, kept)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*kept, np.empty(0, np.int64)])))],
                names=["doc_id", "text_hash", "n", "digest", "vs"],
            )
    return run


class _Forest(dict):
    """Components of ids that come in pairs: the id that each one leads to."""

    def root(self, x: int) -> int:
        while (to := self.setdefault(x, x)) != x:
            self[x] = x = self.setdefault(to, to)
        return x

    def new(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The pairs that join what none before them has joined."""
        out = []
        for a, b in pairs:
            x, y = self.root(a), self.root(b)
            if x != y:
                self[max(x, y)] = min(x, y)
                out.append((a, b))
        return out


class _Joined:
    """Components of rows 0 to n - 1, known by their least row."""

    def __init__(self, n: int, label: list | None = None):
        first: dict = {}
        self.of = list(range(n)) if label is None else [first.setdefault(x, i) for i, x in enumerate(label)]

    def root(self, i: int) -> int:
        of = self.of
        while of[i] != i:
            of[i] = i = of[of[i]]
        return i

    def roots(self) -> np.ndarray:
        return np.fromiter(map(self.root, range(len(self.of))), np.int64, len(self.of))

    def join(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            x, y = self.root(a), self.root(b)
            self.of[max(x, y)] = min(x, y)

    def stars(self, before: np.ndarray, cid: tuple) -> list[tuple[int, int]]:
        """What has been joined since the given roots: of each component its least id with each of its parts.

        Groups with much the same rows give much the same pairs, so these are few beside the rows.
        """
        parts: dict[int, list[int]] = {}
        for r in np.unique(before).tolist():
            parts.setdefault(self.root(r), []).append(cid[r])
        return [(low, x) for own in parts.values() if len(own) > 1 for low in [min(own)] for x in own if x != low]


def _overlaps(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """How many values each of rows has in common with each of columns; values are distinct within each."""
    values, at = np.unique(np.concatenate([*rows, *columns]), return_inverse=True)
    split = sum(map(len, rows))
    which = [np.repeat(np.arange(len(x)), list(map(len, x))) for x in (rows, columns)]
    at = [at[:split], at[split:]]
    both = np.flatnonzero((np.bincount(at[0], minlength=len(values)) > 0) & (np.bincount(at[1], minlength=len(values)) > 0))
    place = np.full(len(values), -1)
    place[both] = np.arange(len(both))
    out = np.zeros((len(rows), len(columns)), np.float32)
    at = [place[x] for x in at]
    for k in range(0, len(both), COLUMNS):
        tiles = []
        for x, w, n in zip(at, which, (len(rows), len(columns)), strict=True):
            own = (x >= k) & (x < k + COLUMNS)
            tile = np.zeros((n, min(COLUMNS, len(both) - k)), np.float32)
            tile[w[own], x[own] - k] = 1
            tiles.append(tile)
        out += tiles[0] @ tiles[1].T
    return out


def _estimates(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Whether each union sketch of a and b has enough in common. Sketches hold 32 bits of each value."""
    padded = np.full((2, len(a), SKETCH), np.inf)
    for k, side in enumerate((a, b)):
        sizes = np.array([len(x) for x in side])
        padded[k][np.arange(SKETCH) < sizes[:, None]] = np.concatenate(side)
    both = np.sort(np.concatenate(list(padded), axis=1), axis=1)
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & np.isfinite(both[:, 1:])
    distinct = np.cumsum(~again & np.isfinite(both), axis=1)
    whole = np.array([max(len(x), len(y)) < SKETCH for x, y in zip(a, b, strict=True)])
    union = np.where(whole, distinct[:, -1], np.minimum(distinct[:, -1], SKETCH))
    common = (again & (distinct <= union[:, None])).sum(axis=1)
    return common >= np.where(whole, 0.8 - 1e-9, ESTIMATE) * union


def _candidates(rows: list[tuple]) -> list[tuple[int, int]]:
    """Components of the candidates among (cid, label, n, sketch, side), which are alike, of different labels, and of
    different sides if there are two; as stars."""
    cid, label, n, sketch, side = zip(*rows, strict=True)
    if len(set(label)) < 2:
        return []
    n, side, label = np.array(n), np.array(side), np.array(label)
    sketch = [np.frombuffer(x, ">u4").astype(np.uint32) for x in sketch]
    two, joined = len(set(side.tolist())) > 1, _Joined(len(rows))
    before = joined.roots()
    for i in range(0, len(rows), TILE):
        for j in range(i, len(rows), TILE):
            p, q = slice(i, i + TILE), slice(j, j + TILE)
            small, large = np.minimum(n[p, None], n[None, q]), np.maximum(n[p, None], n[None, q])
            may = (10 * small >= 8 * large) & (label[p, None] != label[None, q])
            if two:
                may &= side[p, None] != side[None, q]
            if i == j:
                may = np.triu(may, 1)
            if not may.any():
                continue
            enough = np.where(large < SKETCH, np.ceil(0.8 * large - 1e-9), SHARED)
            pairs = np.argwhere(may & (_overlaps(sketch[p], sketch[q]) >= np.minimum(enough, small))) + (i, j)
            for k in range(0, len(pairs), 4096):
                root = joined.roots()
                some = pairs[k : k + 4096]
                some = some[root[some[:, 0]] != root[some[:, 1]]]
                if len(some):
                    joined.join(some[_estimates([sketch[x] for x in some[:, 0]], [sketch[x] for x in some[:, 1]])])
    return joined.stars(before, cid)


def _linked_sets(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Components by links among (cid, label, set, side), of different sides if there are two, as stars; rows of one
    label are joined already."""
    rows.sort(key=lambda r: (len(r[2]), r[0]))
    cid, label, sets, side = zip(*rows, strict=True)
    n, side, joined = np.array(list(map(len, sets))), np.array(side), _Joined(len(rows), label)
    before = joined.roots()
    two = len(set(side.tolist())) > 1
    for i in range(0, len(rows), TILE):
        for j in range(i, len(rows), TILE):
            p, q = slice(i, i + TILE), slice(j, j + TILE)
            if 100 * n[p][-1] < percent * n[j]:
                break  # sizes ascend: the rest is too large for all of these
            root = joined.roots()
            may = (100 * n[p, None] >= percent * n[None, q]) & (root[p, None] != root[None, q])
            if two:
                may &= side[p, None] != side[None, q]
            if i == j:
                may = np.triu(may, 1)
            a, b = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
            if not len(a):
                continue
            common = _overlaps([sets[i + x] for x in a], [sets[j + x] for x in b]).astype(np.int64)
            ok = may[np.ix_(a, b)] & (100 * common >= percent * (n[i + a][:, None] + n[j + b][None, :] - common))
            pairs = np.argwhere(ok)
            joined.join(np.stack([i + a[pairs[:, 0]], j + b[pairs[:, 1]]], axis=1))
    return joined.stars(before, cid)


def _grouped(columns: tuple[str, ...], rows_of, pairs_of):
    """Pairs (a, b) from groups (v, i, j) of rows, which stand together.

    A pair is left out if the task's pairs before it join its ends: many groups hold the same rows, as lists or as pairs
    of blocks of one list, and give the same components. So a task gives fewer pairs than it has different rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, forest = None, [], _Forest()
        for batch in batches:
            found = []
            for v, i, j, row in zip(*(batch[c].to_pylist() for c in ("v", "i", "j")), rows_of(*(batch[c].to_pylist() for c in columns)), strict=True):
                if (v, i, j) != key:
                    found += forest.new(pairs_of(held)) if len(held) > 1 else []
                    key, held = (v, i, j), []
                held.append(row)
            yield _pairs(found)
        yield _pairs(forest.new(pairs_of(held)) if len(held) > 1 else [])
    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _in_blocks(rows: DataFrame, key: str, size: str, most: int) -> DataFrame:
    """rows, once for each pair of blocks (i, j) of their group that they belong to, as v, i, j and side.

    A group of at most so many rows is one block. Rows of one block are compared by the pair of the block with itself.
    """
    blocks = F.ceil(F.col(size) / most).cast("int")
    rows = rows.withColumns({"_blocks": blocks, "_own": F.pmod(F.xxhash64("cid"), blocks).cast("int")})
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return rows.withColumns({"v": F.col(key), "i": F.least("_own", "_other"), "j": F.greatest("_own", "_other"), "side": F.col("_own")}).drop("_blocks", "_own", "_other")


def _together(rows: DataFrame, run) -> DataFrame:
    """The pairs that run makes of rows by group (v, i, j)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "v", "i", "j").sortWithinPartitions("v", "i", "j").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, width: int = 2) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * common >= percent * union of their sets of shingles of width words (percent of 80 or
    more: the prefixes are made for that). component_id is the smallest doc_id reachable over links. Texts without words,
    null or empty, have no shingles and stay alone. Rows with equal sets are one class, whatever their number;
    rows that share a doc_id are rows of their own; a null doc_id never names a component that has another one.
    An empty table gives no rows; other columns are ignored.
    """
    made, whole = _linked(docs, doc_id, text, percent, width)
    least = whole.groupBy("label").agg(F.min("first").alias("component_id"))
    named = whole.join(least, "label").select("digest", "component_id")
    return made.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | F.col("component_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, width: int = 2) -> DataFrame:
    """The rows of docs, all columns, but one row only of each component of linked documents.

    That is the row of the smallest id, nulls last, and of the smallest text hash within it; of rows that share both,
    the least by all columns. Rows of texts without words, null or empty, are never repeats and all stay.
    """
    made, whole = _linked(docs, doc_id, text, percent, width)
    best = whole.groupBy("label").agg(F.min("source").alias("source")).select(F.col("source.doc_id").alias("_id"), F.col("source.text_hash").alias("_hash"))
    times = made.groupBy(F.col("doc_id").alias("_id2"), F.col("text_hash").alias("_hash2")).agg(F.count(F.lit(1)).alias("_times"))
    best = best.join(times, best["_id"].eqNullSafe(times["_id2"]) & (best["_hash"] == times["_hash2"])).select("_id", "_hash", "_times")
    whole_text = F.coalesce(F.col(text), F.lit(""))
    worded = whole_text.rlike(r"[^ \t-\r]")
    rows = docs.where(worded).select(F.struct(*docs.columns).alias("_row"), F.col(doc_id).cast("long").alias("_own"), F.xxhash64(whole_text).alias("_own_hash"))
    found = rows.join(best, rows["_own"].eqNullSafe(best["_id"]) & (rows["_own_hash"] == best["_hash"])).select("_row", "_id", "_hash", "_times")
    repeated = found.where("_times > 1").groupBy("_id", "_hash").agg(F.min("_row").alias("_row"))
    return found.where("_times = 1").select("_row.*").unionByName(repeated.select("_row.*")).unionByName(docs.where(~worded))


def _linked(docs: DataFrame, doc_id: str, text: str, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Each row of docs as (doc_id, text_hash, n, digest, ...), and of each digest of a set with shingles (digest, first,
    source, label): its smallest id, its first row as (none, doc_id, text_hash), and its component."""
    if percent < 80:
        raise ValueError("the inverted lists are complete from 80 percent on")
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    made = stored(rows.mapInArrow(_sketches(width), "doc_id long, text_hash long, n long, digest binary, vs array<long>"))
    classes = stored(
        made.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("source"), F.first("n").alias("n"), F.first("vs").alias("vs"))
        .withColumn("cid", F.monotonically_increasing_id())
    )

    # Lists: only values that another class of a size that allows a link retains too, of each class its rarest.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = classes.select("cid", "n", F.explode("vs").alias("v")).repartition(parts, "v")
    by_size = Window.partitionBy("v").orderBy("n")
    values = values.withColumns({"df": F.count(F.lit(1)).over(Window.partitionBy("v")), "below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
    shared = values.where((100 * F.col("below") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("above")))
    need = F.when(F.col("n") < 0.8 * SKETCH, F.ceil(0.8 * F.col("n"))).otherwise(SHARED)
    rarest = shared.groupBy("cid", "n").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"))
    listed = stored(rarest.withColumn("some", (F.size("vs") - need + 1).cast("int")).where("some > 0").select("cid", "n", F.explode(F.slice("vs", F.lit(1), F.col("some"))["v"]).alias("v")))

    def texts_of(ends: DataFrame) -> DataFrame:
        """(cid, text) of some classes."""
        used = cut(classes.join(ends, "cid").select("cid", "source.doc_id", "source.text_hash"))
        near = thinned(rows, F.struct("doc_id", "text_hash"), used, F.struct("doc_id", "text_hash"))
        same = used["doc_id"].eqNullSafe(near["doc_id"]) & (used["text_hash"] == near["text_hash"])
        return near.join(used, same).select("cid", "text").dropDuplicates(["cid"])

    hashes = _Hashes()  # each task has its own

    def sets(cid: list, label: list, text: list, side: list) -> Iterator[tuple]:
        return ((c, x, shingle_hashes(split_words(t), hashes, width), y) for c, x, t, y in zip(cid, label, text, side, strict=True))

    links = _grouped(("cid", "label", "text", "side"), sets, lambda held: _linked_sets(held, percent))
    forest = _grouped(("cid", "label", "n", "sketch", "side"), lambda *columns: zip(*columns, strict=True), _candidates)
    labels = classes.select("cid", F.col("cid").alias("label"))

    def merged(pairs: DataFrame) -> DataFrame:
        """labels after more links."""
        ends = pairs.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b").select("x", "y")
        now = components(ends, "x", "y").withColumnRenamed("id", "label")
        return cut(labels.join(now, "label", "left").select("cid", F.coalesce("component", "label").alias("label")))

    def mixed(rows: DataFrame, key: str) -> DataFrame:
        """Groups that hold more than one component."""
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").drop("low", "high")

    for turn in range(ROUNDS):
        marked = listed.join(labels, "cid")
        longest = cut(marked.join(mixed(marked, "v").where(F.col("size") > LONG), "v").groupBy("cid", "label").agg(F.max(F.struct("size", "v")).alias("at")).select("cid", "label", "at.v", "at.size"))
        if longest.isEmpty():
            break
        # Hubs by label first, so that small components have theirs as well.
        hub = lambda k: F.min(F.struct(F.xxhash64("label", F.lit(turn), F.lit(k)), F.xxhash64("cid", F.lit(k)), F.col("cid"), F.col("label")))
        hubs = longest.groupBy("v").agg(F.max("size").alias("size"), F.array_distinct(F.array(*(hub(k) for k in range(HUBS)))).alias("hubs"))
        blocks = F.ceil(F.col("size") / WHOLE).cast("int")
        members = longest.select("v", F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("i"), "cid", "label", F.lit(0).alias("side"))
        hubs = hubs.select("v", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"), "hubs").select("v", "i", F.explode("hubs").alias("hub")).select("v", "i", "hub.cid", "hub.label", F.lit(1).alias("side"))
        whole = members.unionByName(hubs).withColumn("j", F.lit(0)).join(texts_of(longest.select("cid")), "cid")
        labels = merged(cut(_together(whole, links)))

    # Lists with the same members, by two 64-bit hashes of them, are one: those of a lone pair are as many as it shares values.
    marked = listed.join(labels, "cid")
    members = [F.bit_xor(F.xxhash64("cid", F.lit(k))).alias(f"members{k}") for k in (0, 1)]
    lists = marked.groupBy("v").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"), *members).where("low < high")
    # The upper 32 bits of each value, as bytes.
    sketch = F.unhex(F.array_join(F.transform("vs", lambda x: F.lpad(F.hex(F.shiftrightunsigned(x, 32)), 8, "0")), ""))
    open_ = marked.join(lists.groupBy("size", "members0", "members1").agg(F.min("v").alias("v")).select("v", "size"), "v")
    sketched = _in_blocks(open_, "v", "size", BLOCK).join(classes.select("cid", sketch.alias("sketch")), "cid")
    near = components(cut(_together(sketched, forest).distinct()))
    marked = cut(near.withColumnRenamed("id", "cid").join(labels, "cid"))
    open_ = marked.join(mixed(marked, "component"), "component")
    whole = _in_blocks(open_, "component", "size", WHOLE).join(texts_of(open_.select("cid")), "cid")
    labels = merged(cut(_together(whole, links)))
    return made, classes.join(labels, "cid").select("digest", "first", "source", "label")
