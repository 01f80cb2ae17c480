"""Repeated passages by a hash-compared suffix sort.

Of texts that are equal throughout only the first goes on. Each string of LENGTH bytes belongs to one anchor: the
leftmost least hash of ANCHOR bytes in it, which depends on the string alone. So equal strings have equal anchors at
the same place in them. The neighbouring strings of an anchor are its context, told by the anchor's and the context's
64-bit hashes: of equal contexts the earliest goes on, the others are covered whole. Anchors with different contexts
bring their bytes; the strings in them are suffixes, which a mergesort puts in order within each anchor and place.
Its comparisons find the common extension of two suffixes by binary search over prefix polynomial hashes, and
neighbours that agree over LENGTH are compared byte by byte. All but the earliest of those are covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import maybe, small_batches, stored, thinned

LENGTH, ANCHOR = 100, 32
REACH = LENGTH - ANCHOR  # bytes before an anchor that a string over it can start at
#: Different contexts of an anchor in one group; more of them are several groups, whose earliest strings meet again
#: by 128-bit hash.
GROUP = 2048
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class _Powers:
    """Powers of a number modulo 2**64, as many as needed."""

    def __init__(self, base: np.uint64):
        self.base, self.of = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.of) < n:
            with np.errstate(over="ignore"):
                self.of = np.concatenate([self.of, self.of * self.of[-1] * self.base])
        return self.of[:n]


UP, DOWN = _Powers(BASE), _Powers(INVERSE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, modulo 2**64, of bytes that a table makes wide."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(WIDE[data] * UP.upto(len(data)), out=out[1:])
    return out


WIDE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _extreme(x: np.ndarray, n: int, f) -> np.ndarray:
    """f over each n neighbours, by doubling."""
    span = 1
    while 2 * span <= n:
        x = f(x[:-span], x[span:])
        span *= 2
    return f(x[: len(x) - (n - span)], x[n - span :]) if n > span else x


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For bytes that hold a string of LENGTH: places of anchors, their hashes, the bytes of their contexts before the
    place, how many strings are in each, and the contexts' hashes."""
    h = prefix_hashes(data)
    n, starts = len(data) - ANCHOR + 1, len(data) - LENGTH + 1
    down = DOWN.upto(len(data) + 1)
    own = _mixed((h[ANCHOR:] - h[:n]) * down[:n])
    least = _extreme(own, REACH + 1, np.minimum)
    # A place may be an anchor if it is the least of some stretch: the highest of those stretches' minima.
    pad = np.zeros(REACH, np.uint64)
    may = _extreme(np.concatenate([pad, least, pad]), REACH + 1, np.maximum) == own
    at = np.flatnonzero(may)
    # Of each string the leftmost place with its least value.
    which = (np.cumsum(may) - may)[:starts]
    off = np.flatnonzero(own[at[which]] != least)
    while len(off):
        which[off] += 1
        off = off[own[at[which[off]]] != least[off]]
    first = np.flatnonzero(np.diff(which, prepend=-1))
    count = np.diff(first, append=starts)
    place = at[which[first]]
    end = first + count + LENGTH - 1
    return place, own[place], place - first, count, _mixed((h[end] - h[first]) * down[first] + count.astype(np.uint64))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, context, doc, tie, place, again) of the anchors of all texts; place also holds the bytes before it and the
    number of strings, in its upper bits. Of equal contexts in a batch only the earliest goes on as such; the others are spans by
    now, so they have `again` and any number for a hash, and don't gather where the hash of a hot string does."""
    for batch in batches:
        made, texts = [], batch["text"]
        doc, tie = (batch[c].to_numpy() for c in ("doc", "tie"))
        for i in np.lexsort((tie, doc)).tolist():
            data = np.frombuffer(texts[i].as_buffer(), np.uint8)
            if len(data) >= LENGTH:
                place, h, before, count, context = anchors(data)
                made.append((h, context, np.full(len(h), doc[i]), np.full(len(h), tie[i]), (before << 48) | (count << 40) | place))
        if not made:
            continue
        h, context, doc, tie, where = (np.concatenate(x) for x in zip(*made, strict=True))
        kind = where >> 40
        order = np.argsort(_mixed(h ^ context * BASE ^ kind.astype(np.uint64)), kind="stable")
        a, b = order[:-1], order[1:]
        again = np.zeros(len(order), bool)
        again[b] = (h[a] == h[b]) & (context[a] == context[b]) & (kind[a] == kind[b])
        h = np.where(again, _mixed(doc.astype(np.uint64) * BASE ^ where.astype(np.uint64)), h)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h.view(np.int64), context.view(np.int64), doc, tie, where, again)], names=["h", "context", "doc", "tie", "place", "again"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tie, h, part, place) of anchors that stand in the order of hash, context and row.

    Those whose context was found before are spans: their part is -1. Of the others only those are given whose hash has
    different contexts; they are numbered into groups of GROUP.
    """
    last, number, pending = None, 0, None  # the row before, its context's number, and the first of a hash if it is not given
    for batch in batches:
        columns = [batch[c].to_numpy() for c in ("h", "context", "doc", "tie", "place")]
        again = batch["again"].to_numpy(zero_copy_only=False)
        given = [[c[again] for c in columns] + [np.full(int(again.sum()), -1)]]
        columns = [c[~again] for c in columns]
        h, context, *_, where = columns
        if len(h):
            same_h, same = np.zeros(len(h), bool), np.zeros(len(h), bool)
            same_h[1:] = h[1:] == h[:-1]
            same[1:] = same_h[1:] & (context[1:] == context[:-1]) & (where[1:] >> 40 == where[:-1] >> 40)
            if last is not None:
                same_h[0] = h[0] == last[0]
                same[0] = same_h[0] and context[0] == last[1] and where[0] >> 40 == last[2]
            given.append([c[same] for c in columns] + [np.full(int(same.sum()), -1)])
            first = np.flatnonzero(~same)
            if len(first):
                k = np.arange(len(first))
                start = np.maximum.accumulate(np.where(same_h[first], -1, k))
                own = np.where(start >= 0, k - start, number + 1 + k)
                if own[0] == 1 and pending is not None:
                    given.append(pending)
                give = own > 0
                give[:-1] |= own[1:] == 1
                some = first[give]
                given.append([c[some] for c in columns] + [own[give] // GROUP])
                number = int(own[-1])
                pending = [c[first[-1:]] for c in columns] + [np.zeros(1, np.int64)] if number == 0 else None
            last = (h[-1], context[-1], where[-1] >> 40)
        h, _, doc, tie, where, part = (np.concatenate(x) for x in zip(*given, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, tie, h, part, where)], names=["doc", "tie", "h", "part", "place"])


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans, joined where they meet, in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:], len(end)) - 1] if len(end) else end


def _packed(start: np.ndarray, end: np.ndarray) -> bytes:
    return np.stack([start, end], axis=1).astype(np.int64).tobytes()


def _unpacked(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(raw or b"", np.int64).reshape(-1, 2).T)


def _by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tie, spans, asked) from the anchors of each row: merged spans, and packed (h, part, place) to compare."""
    for batch in batches:
        spans, asked = [], []
        offsets, flat = batch["rows"].offsets.to_numpy(), batch["rows"].values
        h, part, where = (flat.field(k).to_numpy() for k in range(3))
        place, before, count = where & ((1 << 40) - 1), where >> 48, (where >> 40) & 255
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = slice(a, b)
            found = part[own] < 0
            start = (place - before)[own]
            spans.append(_packed(*_merged(start[found], (start + count[own] + LENGTH - 1)[found])))
            asked.append(np.stack([h[own][~found], part[own][~found], where[own][~found]], axis=1).tobytes() if not found.all() else None)
        yield pa.RecordBatch.from_arrays([batch["doc"], batch["tie"], pa.array(spans, pa.binary()), pa.array(asked, pa.binary())], names=["doc", "tie", "spans", "asked"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made, context = [], []
        for doc, tie, text, asked in zip(*(batch[c].to_pylist() for c in ("doc", "tie")), batch["text"], batch["asked"].to_pylist(), strict=True):
            data = text.as_py().encode()
            h, part, where = np.frombuffer(asked, np.int64).reshape(-1, 3).T
            place, before, count = where & ((1 << 40) - 1), where >> 48, (where >> 40) & 255
            made.append((h, np.full(len(h), doc), np.full(len(h), tie), place, part, before))
            context += [data[s:e] for s, e in zip((place - before).tolist(), (place - before + count + LENGTH - 1).tolist(), strict=True)]
        columns = [pa.array(np.concatenate(x)) for x in zip(*made, strict=True)] if made else [pa.array([], pa.int64())] * 6
        yield pa.RecordBatch.from_arrays([*columns, pa.array(context, pa.binary())], names=["h", "doc", "tie", "place", "part", "before", "context"])


class Suffixes:
    """Strings in one buffer, with prefix hashes that compare any two stretches in constant time."""

    def __init__(self, raw: bytes, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = np.frombuffer(raw, np.uint8), start, size
        self.hash = prefix_hashes(self.data)
        self.down = DOWN.upto(len(self.data) + 1)

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        h, d = self.hash, self.down
        return (h[a + n] - h[a]) * d[a] == (h[b + n] - h[b]) * d[b]

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes that agree from a and from b on, at most so many, by binary search."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(a, b, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether string i stands before string j; equal ones don't."""
        a, b = self.start[i], self.start[j]
        most = np.minimum(self.size[i], self.size[j])
        n = self.ahead(a, b, most)
        end = n == most
        k = np.where(end, 0, n)
        return np.where(end, self.size[i] < self.size[j], self.data[np.minimum(a + k, len(self.data) - 1)] < self.data[np.minimum(b + k, len(self.data) - 1)])

    def sorted(self, group: np.ndarray) -> np.ndarray:
        """The strings in order within each group (ascending numbers), equal ones in their order: a mergesort of all groups at once."""
        n = len(group)
        order = np.arange(n)
        first = np.searchsorted(group, group, "left")
        count = np.searchsorted(group, group, "right") - first
        place, width = np.arange(n) - first, 1
        while (count > width).any():
            # Each element's new place: its rank in the own run and in the sibling run, found by binary search.
            busy = np.flatnonzero(count > width)
            run = place[busy] // width
            sibling = run ^ 1
            low = np.minimum(sibling * width, count[busy])
            high = np.minimum(low + width, count[busy])
            base, right = low.copy(), (run & 1).astype(bool)
            me = order[busy]
            while (low < high).any():
                mid = (low + high) // 2
                act = low < high
                other = order[np.minimum(first[busy] + mid, n - 1)]
                # From the right run equal elements of the left one count as before, from the left run not.
                before = np.zeros(len(busy), bool)
                r, s = act & right, act & ~right
                before[r] = ~self.less(me[r], other[r])
                before[s] = self.less(other[s], me[s])
                low, high = np.where(act & before, mid + 1, low), np.where(act & ~before, mid, high)
            to = first[busy] + (run & ~1) * width + (place[busy] - run * width) + (low - base)
            new = order.copy()
            new[to] = me
            order = new
            width *= 2
        return order


def covered(group: np.ndarray, row: tuple[np.ndarray, ...], before: np.ndarray, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings in contexts by ascending group: (context, start in it, whether it is the earliest of its kind).

    Contexts of a group have their anchor after so many bytes; row has keys that tell which one is earlier.
    """
    size = np.array([len(c) for c in contexts], np.int64)
    count = size - LENGTH + 1
    which = np.repeat(np.arange(len(contexts)), count)
    at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    # By group and place of the anchor in the string: only such strings can be equal.
    key = group[which] * LENGTH + (before[which] - at)
    by_key = np.argsort(key, kind="stable")
    which, at, key = which[by_key], at[by_key], key[by_key]
    s = Suffixes(b"".join(contexts), (np.cumsum(size) - size)[which] + at, np.full(len(which), LENGTH))
    order = s.sorted(key)
    new = np.ones(len(order), bool)
    a, b = order[:-1], order[1:]
    maybe = np.flatnonzero(key[a] == key[b])
    maybe = maybe[s.same(s.start[a[maybe]], s.start[b[maybe]], np.full(len(maybe), LENGTH))]
    for k in range(0, len(maybe), 1 << 14):  # not only their hashes
        x = maybe[k : k + (1 << 14)]
        span = np.arange(LENGTH)
        new[x[(s.data[s.start[a[x], None] + span] == s.data[s.start[b[x], None] + span]).all(axis=1)] + 1] = False
    block = np.cumsum(new) - 1
    by = np.lexsort((*(r[which[order]] for r in reversed(row)), block))
    earliest = np.zeros(len(order), bool)
    earliest[order[by[np.flatnonzero(np.diff(block[by], prepend=-1))]]] = True
    return which, at, earliest


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """covered() over whole (h, part) groups, which stand together: spans, and of the earliest strings in groups that
    are a part of their hash's contexts (rest) the bytes."""
    held: list[pa.RecordBatch] = []

    def done(t: pa.Table) -> pa.RecordBatch:
        h, part, doc, tie, place, before = (t[c].to_numpy() for c in ("h", "part", "doc", "tie", "place", "before"))
        group = np.cumsum((np.diff(h, prepend=h[:1]) != 0) | (np.diff(part, prepend=part[:1]) != 0))
        contexts = t["context"].to_pylist()
        which, at, earliest = covered(group, (doc, tie, place), before, contexts)
        order = np.lexsort((at, which))
        which, at, earliest = which[order], at[order], earliest[order]
        # Strings side by side are one span.
        gone = ~earliest
        start = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | (which[1:] != which[:-1])]))
        end = np.flatnonzero(gone & np.concatenate([~gone[1:] | (which[1:] != which[:-1]), [True]]))
        zero = (place - before)[which]
        many = t["many"].to_numpy()
        rest = np.flatnonzero(earliest & many[which])
        rows = np.concatenate([start, rest])
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[which[rows]]), pa.array(tie[which[rows]]), pa.array((zero + at)[rows]), pa.array(np.concatenate([(zero + at)[end] + LENGTH, (zero + at)[rest]])), pa.array([None] * len(start) + [contexts[w][a : a + LENGTH] for w, a in zip(which[rest].tolist(), at[rest].tolist(), strict=True)], pa.binary())],
            names=["doc", "tie", "start", "end", "string"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < 4 * GROUP:
            continue
        t = pa.Table.from_batches(held)
        h, part = t["h"].to_numpy(), t["part"].to_numpy()
        last = int(np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (part[1:] != part[:-1])]))[-1])
        if last:
            yield done(t.slice(0, last))
            held = t.slice(last).to_batches()
    if held:
        yield done(pa.Table.from_batches(held))


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that have more than one group."""
    for batch in batches:
        asked = np.frombuffer(b"".join(batch["asked"].to_pylist()), np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(asked[asked[:, 1] > 0, 0]))], names=["h"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for batch in batches:
        out = []
        for text, first, more in zip(batch["text"], batch["spans"].to_pylist(), batch["more"].to_pylist(), strict=True):
            data = text.as_py().encode()
            found = [_unpacked(first), (np.array([x["start"] for x in more or []], np.int64), np.array([x["end"] for x in more or []], np.int64))]
            start, end = _merged(*(np.concatenate(x) for x in zip(*found, strict=True)))
            left = hashlib.sha256()
            for a, b in zip([0, *end.tolist()], [*start.tolist(), len(data)], strict=True):
                left.update(data[a:b])
            out.append((int((end - start).sum()), len(start), left.hexdigest()))
        yield pa.RecordBatch.from_arrays([batch["doc"], batch["tie"], *(pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string())))], names=["doc", "tie", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte goes that a string of LENGTH bytes covers which also starts earlier: in an earlier row, or before in the
    same one. Rows come by doc_id, a null one last, and with equal ids by a hash of the text; of rows that share id and
    text one is the first. Null texts are empty. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(F.col(doc_id).alias("doc_id"), doc.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    # Rows by id and text. A text goes on once, as its earliest row; tie tells apart rows that share an id.
    code = F.xxhash64("text")
    known = stored(rows.select("doc_id", "doc", code.alias("code"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole")).groupBy("doc_id", "doc", "code", "n_bytes", "whole").agg(F.count(F.lit(1)).alias("times")))
    shared = known.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc", F.lit(True).alias("shared"))
    first = known.groupBy("whole").agg(F.min(F.struct("doc", F.col("doc_id").isNull().alias("none"))).alias("first"))
    known = stored(known.join(shared, "doc", "left").join(first, "whole").select(
        "doc_id", "doc", "code", "n_bytes", "whole", "times", F.when(F.col("shared"), F.col("code")).otherwise(F.lit(0)).cast("long").alias("tie"),
        (F.struct("doc", F.col("doc_id").isNull().alias("none")) == F.col("first")).alias("is_first")))
    odd = known.where(~F.col("is_first") | (F.col("tie") != 0) | (F.col("times") > 1)).select("doc_id", "doc", "code", "tie", "is_first")
    marked = maybe(rows.where(F.octet_length("text") >= LENGTH).withColumn("code", code), F.struct("doc", "code"), odd, F.struct("doc", "code"))
    told = marked.where("_maybe").join(odd, marked["doc_id"].eqNullSafe(odd["doc_id"]) & (marked["code"] == odd["code"]), "left").where(F.coalesce("is_first", F.lit(True)))
    told = told.select(marked["doc"], F.coalesce("tie", F.lit(0).cast("long")).alias("tie"), "text", "is_first")
    texts = marked.where("not _maybe").select("doc", F.lit(0).cast("long").alias("tie"), "text").unionByName(
        told.where("is_first is null").drop("is_first")).unionByName(told.where("is_first").drop("is_first").dropDuplicates(["doc", "tie"]))

    found = texts.mapInArrow(_anchored, "h long, context long, doc long, tie long, place long, again boolean")
    # Equal contexts have the same upper bits of place; the lower ones are the place itself.
    kind = F.shiftright("place", 40)
    ordered = found.repartition(n, "h").sortWithinPartitions("h", "context", kind, "doc", "tie", "place")
    asked = ordered.mapInArrow(_compared, "doc long, tie long, h long, part long, place long")
    by_row = stored(asked.groupBy("doc", "tie").agg(F.collect_list(F.struct("h", "part", "place")).alias("rows")).mapInArrow(_by_row, "doc long, tie long, spans binary, asked binary"))

    # Different contexts of one hash, by their bytes.
    row = F.struct("doc", "tie")
    some = by_row.where("asked is not null")
    contexts = thinned(texts, row, some, row).join(some, ["doc", "tie"]).select("doc", "tie", "text", "asked").mapInArrow(_contexts, "h long, doc long, tie long, place long, part long, before long, context binary")
    many = some.mapInArrow(_parted, "h long").distinct().withColumn("many", F.lit(True))
    contexts = contexts.join(many, "h", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    done = stored(contexts.repartition(n, "h", "part").sortWithinPartitions("h", "part").mapInArrow(_groups, "doc long, tie long, start long, end long, string binary"))
    spans = done.where("string is null").select("doc", "tie", "start", "end")
    rest = done.where("string is not null").withColumn("string", F.unhex(F.substring(F.sha2("string", 256), 1, 32)))
    earliest = rest.groupBy("string").agg(F.min(F.struct("doc", "tie", "start")).alias("earliest"))
    spans = spans.unionByName(rest.join(earliest, "string").where(F.struct("doc", "tie", "start") != F.col("earliest")).select("doc", "tie", "start", "end"))

    more = spans.groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "end")).alias("more"))
    gone = stored(by_row.select("doc", "tie", "spans").where(F.length("spans") > 0).join(more, ["doc", "tie"], "full_outer"))
    cleaned = thinned(texts, row, gone, row).join(gone, ["doc", "tie"]).select("doc", "tie", "text", "spans", "more").mapInArrow(_kept, "doc long, tie long, n_removed long, n_spans long, kept string")
    joined = known.join(cleaned, ["doc", "tie"], "left").withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    copy = (F.col("n_bytes") >= LENGTH) & (~F.col("is_first") | (F.col("_row") > 1))
    found = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(found("n_removed")).alias("n_removed"), F.when(copy, 1).otherwise(found("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"))
