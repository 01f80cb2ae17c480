"""SentencePiece encoding and decoding: distinct sampled segmentations by Gumbel top-k without replacement.

A text is cut where no piece can cross (before a run of spaces, at characters of no piece), so its lattice is a
chain of small ones. Going through a chunk's lattice from its end, a piece is chosen with the share of all
segmentations that go on with it; that is the tree in which a search with perturbed bounds works. The best
segmentation is the walk from the root with the root's Gumbel value. What a walk didn't
take at its steps is open: its best perturbed value is a Gumbel value of the open mass, truncated at the value
before; the search takes the walk with the highest such value next, chooses the step and the piece by their shares
of that mass and walks on. So exactly the segmentations with the
k highest perturbed log-probabilities come out, in order, and no other is ever expanded. A text whose chunks are more
than is remembered is walked group by group of chunks, with the same outcome.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count as counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

SPACE = "▁"
#: What stands for a "▁" of the text itself, which is given as bytes: no text holds a lone surrogate.
OWN_SPACE = "\ud800"
#: Lattice nodes that a worker remembers, besides the last chunk's, and characters whose lattices are built at once.
REMEMBERED, BUILT_AT_ONCE = 1_500_000, 60_000
#: Texts that are sampled at once, fewer if their chunks don't fit in what is remembered, and steps that are made ids or bytes at once.
AT_ONCE, STEPS_AT_ONCE = 32, 200_000
#: What a score of a byte-pair vocabulary, minus the rank of the piece, is taken as: the log of a Zipf share.
ZIPF = 1.0


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces of a SentencePiece model with log-probabilities, bytes for characters that no piece holds."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        usable = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = np.full(256, -1, np.int64)
        self.ids: dict[str, int] = {}
        for i in usable:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.bytes_of[i] = i, bytes([value])
            else:
                self.ids[piece], self.bytes_of[i] = i, piece.replace(SPACE, " ").encode()
        if scores[usable].min() < -1000:  # ranks
            scores = -ZIPF * np.log(2.0 - np.minimum(scores, 0))
        self.score = scores - np.log(np.exp(scores[usable]).sum())
        self.longest = max(map(len, self.ids), default=1)
        self.trie = Trie(self.ids)
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        lone = "".join(sorted(c for c in ("\n", "\t", "\r", *map(chr, range(0x20))) if c not in inside))
        self.chunk = re.compile(f"[{re.escape(lone)}]| *[^ {re.escape(lone)}]+| +", re.S)
        # The bytes of all pieces, one piece after the other.
        self.size = np.fromiter(map(len, self.bytes_of), np.int64, n)
        self.at, self.flat = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def chunks(self, text: str) -> list[str]:
        """The text, with a space put in front, in parts that no piece crosses; none of an empty text."""
        return self.chunk.findall(" " + text.replace(SPACE, OWN_SPACE)) if text else []

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of pieces, one after the other."""
        size = self.size[ids]
        to = np.cumsum(size)
        return self.flat[np.repeat(self.at[ids] - to + size, size) + np.arange(int(size.sum()))].tobytes()

    def in_bytes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of characters: how many bytes each has, their ids one after the other, and each one's log-probability."""
        raw = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        ids, first = self.byte_id[raw], np.flatnonzero((raw & 0xC0) != 0x80)
        return np.diff(first, append=len(raw)), ids, np.add.reduceat(self.score[ids], first) if len(first) else np.empty(0)


class Trie:
    """The pieces as a trie, walked for many places at once; its steps are in an open hash table."""

    ROOM = 1 << 20

    def __init__(self, ids: dict[str, int]):
        nodes: dict[tuple[int, str], int] = {}
        piece = [-1]
        for p, i in ids.items():
            at = 0
            for c in p:
                to = nodes.setdefault((at, c), len(piece))
                if to == len(piece):
                    piece.append(-1)
                at = to
            piece[at] = i
        self.piece = np.array(piece, np.int64)
        self.bits = max(self.ROOM, 1 << (8 * len(nodes)).bit_length()).bit_length() - 1
        self.key, self.to = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        keys = self._keys(np.array([a for a, _ in nodes], np.int64), np.array([ord(c) for _, c in nodes], np.int64))
        for k, slot, to in zip(keys.tolist(), self._slots(keys).tolist(), nodes.values(), strict=True):
            while self.key[slot] >= 0:
                slot = (slot + 1) % len(self.key)
            self.key[slot], self.to[slot] = k, to

    @staticmethod
    def _keys(node: np.ndarray, code: np.ndarray) -> np.ndarray:
        return (node << 21) | code

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The node after one more character, -1 where no piece goes on."""
        keys = self._keys(node, code)
        slots = self._slots(keys)
        found = self.key[slots]
        out = self.to[slots]
        out[found != keys] = -1
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.key)
            found = self.key[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.to[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """The lattices of chunks as flat arrays: each (chunk, position) is a node with choices of the last piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        # Room for what is remembered, which takes no memory before it is used; what is longer gets more.
        nodes, choices = REMEMBERED + BUILT_AT_ONCE, 4 * (REMEMBERED + BUILT_AT_ONCE)
        self.mass = np.zeros(nodes)  # log of all segmentations up to a node
        self.first = np.zeros(nodes + 1, np.int64)  # choices of a node: first[node] to first[node + 1]
        self.cdf = np.zeros(choices)  # share of a node's choices up to this one, without end at the last
        self.to = np.zeros(choices, np.int32)  # the node that a choice goes on at; -1 at the start
        self.log_share = np.zeros(choices)
        self.piece = np.zeros(choices, np.int32)  # a piece, or minus 1 minus a character to be given as bytes
        self.clear()

    def clear(self) -> None:
        self.number = defaultdict(counter().__next__)  # of each chunk, by first appearance
        self.root = np.zeros(1024, np.int64)  # the node at each chunk's end
        self.nodes = self.choices = 0

    def _room(self, nodes: int, choices: int) -> None:
        for name, need in (*((n, self.nodes + nodes + 1) for n in ("mass", "first")), *((n, self.choices + choices) for n in ("cdf", "to", "log_share", "piece"))):
            old = getattr(self, name)
            if len(old) < need:
                new = np.zeros(need + need // 2, old.dtype)
                new[: len(old)] = old
                setattr(self, name, new)

    def find(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The end nodes of each text's chunks, built where they are new; OverflowError if that is too much to remember."""
        number, known = self.number, len(self.number)
        found = [np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks)) for chunks in texts]
        new, at = list(islice(reversed(number), len(number) - known))[::-1], 0
        if len(number) > len(self.root):
            self.root = np.concatenate([self.root[:known], np.zeros(2 * len(number) - known, np.int64)])
        size = np.fromiter(map(len, new), np.int64, len(new))
        past = np.cumsum(size)
        while at < len(new):
            if self.nodes > REMEMBERED:
                raise OverflowError
            end = max(at + 1, int(np.searchsorted(past, past[at] - size[at] + BUILT_AT_ONCE, "right")))
            self.root[known + at : known + end] = self._build(new[at:end], size[at:end])
            at = end
        return [self.root[f] for f in found]

    def _edges(self, code: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(start, piece) of every piece in the chunks and of every character that is none, by ascending length."""
        trie, at, state, found = self.v.trie, np.arange(len(code)), np.zeros(len(code), np.int64), []
        for n in range(1, self.v.longest + 1):
            state = trie.step(state, code[at + n - 1])
            piece = trie.piece[state]
            piece[state < 0] = -1
            has = piece >= 0
            found.append((at[has], piece[has]) if n > 1 else (at, np.where(has, piece, -1 - code)))
            on = (state >= 0) & (at + n < end[at])
            at, state = at[on], state[on]
            if not len(at):
                break
        return found

    def _build(self, chunks: list[str], sizes: np.ndarray) -> np.ndarray:
        """The end nodes of new chunks, given with their lengths."""
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        code[code == ord(" ")] = ord(SPACE)
        n, ends = len(code), np.cumsum(sizes)
        offset = np.arange(n) - np.repeat(ends - sizes, sizes)
        found = self._edges(code, np.repeat(ends, sizes))
        # By the node that they end at; longer ones first, as they are mostly the likelier.
        count = np.zeros(n, np.int64)
        for k, (at, _) in enumerate(found):
            count[at + k] += 1
        first = np.cumsum(count) - count
        start, piece, last = np.empty(int(count.sum()), np.int64), np.empty(int(count.sum()), np.int64), first + count
        for k, (at, which) in enumerate(found):
            last[at + k] -= 1
            own = last[at + k]
            start[own], piece[own] = at, which
        piece[piece == -1 - ord(OWN_SPACE)] = -1 - ord(SPACE)
        cost = self.v.score[np.maximum(piece, 0)]
        lone = np.flatnonzero(piece < 0)
        if len(lone):
            cost[lone] = self.v.in_bytes(-1 - piece[lone])[2]
        before = np.where(offset[start] > 0, start - 1, n)
        # Masses from offset to offset, all chunks at once.
        by_offset = np.argsort(narrow(offset), kind="stable")
        counts = count[by_offset]
        starts = np.cumsum(counts) - counts
        edges = np.repeat(first[by_offset] - starts, counts) + np.arange(len(piece))
        before_, cost_, value = before[edges], cost[edges], np.empty(len(edges))
        mass = np.zeros(n + 1)
        level = np.concatenate([[0], np.cumsum(np.bincount(offset))])
        edge_level = np.append(starts, len(edges))[level]
        for a, b, x, y in zip(level[:-1].tolist(), level[1:].tolist(), edge_level[:-1].tolist(), edge_level[1:].tolist(), strict=True):
            v = mass[before_[x:y]] + cost_[x:y]
            own = starts[a:b] - x
            top = np.maximum.reduceat(v, own)
            mass[by_offset[a:b]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, counts[a:b])), own))
            value[x:y] = v
        share = np.empty(len(edges))
        share[edges] = value
        share = np.minimum(share - np.repeat(mass[:n], count), 0.0)
        run = np.exp(share)
        more = np.flatnonzero(count > 1)
        for k in range(1, int(count.max(initial=0))):
            run[first[more] + k] += run[first[more] + k - 1]
            more = more[count[more] > k + 1]
        run[first + count - 1] = np.inf
        self._room(n, len(edges))
        base, m = self.nodes, slice(self.choices, self.choices + len(edges))
        self.mass[base : base + n], self.first[base + 1 : base + n + 1] = mass[:n], self.choices + first + count
        self.cdf[m], self.log_share[m], self.piece[m] = run, share, piece
        self.to[m] = np.where(before < n, base + before, -1)
        self.nodes, self.choices = base + n, m.stop
        return base + ends - 1

    def pick(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The choice of each node whose part of (0, 1) holds u."""
        choice = self.first[nodes]
        past = np.flatnonzero(self.cdf[choice] < u)
        while len(past):
            choice[past] += 1
            past = past[self.cdf[choice[past]] < u[past]]
        return choice


def narrow(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in few bytes, so that sorting them is cheap."""
    return x.astype(np.uint16) if len(x) and x.max() < 1 << 16 else x


MASK = (1 << 64) - 1


def stream(*keys: int) -> int:
    """A 64-bit number from whole-number keys."""
    x = 0x9E3779B97F4A7C15
    for k in keys:
        x = (x ^ (k & MASK)) * 0xBF58476D1CE4E5B9 & MASK
        x = (x ^ (x >> 29)) * 0x94D049BB133111EB & MASK
        x ^= x >> 32
    return x


def uniforms(streams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1), one of each stream at its place."""
    x = (streams ^ at.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def uniform(*keys: int) -> float:
    """A number in (0, 1) from whole-number keys; equal keys give equal numbers."""
    return ((stream(*keys) >> 11) + 0.5) / float(1 << 53)


def truncated(location: float, top: float, u: float) -> float:
    """A Gumbel value at a location, given that it is below top."""
    return -float(np.logaddexp(-top, math.log(-math.log(u)) - location))


class _Open:
    """What a walk left open: at each step from one on, the choices that no walk took.

    The highest perturbed value in it is a Gumbel value of all its mass, truncated at the value before; the step
    that it belongs to has the step's share of that mass, so only the one that is taken is ever told apart.
    """

    def __init__(self, since: int, share: np.ndarray):
        self.since, self.taken = since, {}
        self.before = float(share[:since].sum())
        own = share[since:]
        ahead = np.cumsum(own) - own
        # Masses beside that of the first step; what lies 700 below has none that a number could hold.
        n = int(np.searchsorted(-ahead, 700.0))
        self.mass = np.exp(ahead[:n]) * -np.expm1(own[:n])
        self.ahead, self.top = ahead, -math.inf

    def draw(self, below: float, u: float) -> None:
        """The highest value that is left, given that it is below another."""
        left = float(self.mass.sum())
        self.top = truncated(self.before + math.log(left), below, u) if left > 1e-300 else -math.inf


class _Search:
    """One text's search: the walks so far, and what each left open."""

    def __init__(self, key: int, roots: np.ndarray, seed: int, lattices: Lattices):
        self.key, self.roots, self.seed, self.lat = key, roots, seed, lattices
        self.walks: list[tuple[np.ndarray, np.ndarray, float]] = []  # chunk and choice of each step, perturbed value
        self.open: list[_Open] = []

    def load(self, chunk: int) -> None:
        """Make the choices of a chunk's steps those of the lattices; here they always are."""

    def u(self, use: int) -> float:
        return uniform(self.key, self.seed, len(self.walks), use)

    def record(self, chunk: np.ndarray, choice: np.ndarray, value: float, since: int, share: np.ndarray) -> None:
        """share: log-share of each step's choice."""
        left = _Open(since, share)
        left.draw(value, self.u(2))
        self.walks.append((chunk, choice, value))
        self.open.append(left)

    def bound(self) -> tuple[float, int]:
        """The highest perturbed value that is open, and in which walk's steps."""
        return max(((o.top, n) for n, o in enumerate(self.open)), default=(-math.inf, -1))

    def turn(self, n: int) -> tuple[int, int, int, np.ndarray, np.ndarray]:
        """Take the highest value that a walk left open: (walk, step, choice), and the nodes and chunks that are walked next."""
        step, pick, c, node = self.branch(n)
        after = np.arange(c if node >= 0 else c + 1, len(self.roots))
        nodes = self.roots[after]
        if node >= 0:
            nodes[0] = node
        return n, step, pick, nodes, after

    def branch(self, n: int) -> tuple[int, int, int, int]:
        """Take the highest value that a walk left open: (step, choice, chunk), and the node in it that comes next, or -1."""
        lat, left = self.lat, self.open[n]
        run = np.cumsum(left.mass)
        j = min(int(np.searchsorted(run, self.u(5) * run[-1])), len(run) - 1)
        step = left.since + j
        chunk, choice, _ = self.walks[n]
        c = int(chunk[step])
        self.load(c)
        node = int(np.searchsorted(lat.first[: lat.nodes + 1], choice[step], "right")) - 1
        own = left.taken.setdefault(j, {int(choice[step])})
        others = np.array([c for c in range(lat.first[node], lat.first[node + 1]) if c not in own])
        share = np.exp(lat.log_share[others])
        pick = int(others[min(int(np.searchsorted(np.cumsum(share), self.u(3) * share.sum())), len(others) - 1)])
        own.add(pick)
        still = float(share.sum() - np.exp(lat.log_share[pick]))
        left.mass[j] = math.exp(left.ahead[j]) * still if len(others) > 1 and still > 1e-15 else 0.0
        left.draw(left.top, self.u(4))
        return step, pick, c, int(lat.to[pick])


class _LongSearch(_Search):
    """The same of a text whose lattices aren't held together; nodes and choices are numbered within their chunk."""

    def __init__(self, key: int, chunks: list[str], seed: int, lattices: Lattices):
        super().__init__(key, np.empty(0, np.int64), seed, lattices)
        self.chunks = chunks

    def load(self, chunk: int) -> None:
        self.lat.clear()
        self.lat.find([[self.chunks[chunk]]])

    def groups(self, start: int, ahead: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Chunks from start on whose lattices are held together: (place, node, first choice of its chunk) of each.

        Nodes are the chunks' ends, but for the first one's if ahead is a node.
        """
        lat, at = self.lat, start
        while at < len(self.chunks):
            lat.clear()
            end, new, size = at, set(), 0
            while end < len(self.chunks) and (end == at or size + len(self.chunks[end]) <= REMEMBERED):
                if self.chunks[end] not in new:
                    new.add(self.chunks[end])
                    size += len(self.chunks[end])
                end += 1
            node = lat.find([self.chunks[at:end]])[0]
            first = node - np.array([len(c) for c in self.chunks[at:end]], np.int64) + 1
            if at == start and ahead >= 0:
                node[0] = first[0] + ahead
            yield np.arange(at, end), node, lat.first[first]
            at = end


class Sampler:
    """Segmentations of texts, seeded by each text's key."""

    def __init__(self, path: str, k: int, seed: int):
        self.lattices, self.k, self.seed = Lattices(vocabulary(path)), k, seed

    def walk(self, nodes: np.ndarray, streams: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Choices from each node to the start of its chunk: (which of nodes, choice), by node, then step."""
        lat = self.lattices
        which, now, got = np.arange(len(nodes)), nodes, []
        step = 0
        while len(now):
            choice = lat.pick(now, uniforms(streams[which], (place[which] << 24) + step))
            got.append((which, choice))
            now = lat.to[choice].astype(np.int64)
            on = now >= 0
            which, now, step = which[on], now[on], step + 1
        if not got:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        which, choice = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.argsort(narrow(which), kind="stable")
        return which[order], choice[order]

    def sample(self, texts: list[str], keys: list[int]) -> list[list[tuple[list[int], float, float, float]]]:
        """For each text its k best (ids, log-probability, perturbed value, inclusion score), or all if it has fewer."""
        lat = self.lattices
        chunks = list(map(lat.v.chunks, texts))
        try:
            roots = lat.find(chunks)
        except OverflowError:
            lat.clear()
            try:
                roots = lat.find(chunks)
            except OverflowError:  # one batch holds more than is remembered
                lat.clear()
                if len(texts) == 1:
                    return [self._long(texts[0], keys[0])]
                half = len(texts) // 2
                return self.sample(texts[:half], keys[:half]) + self.sample(texts[half:], keys[half:])
        searches = [_Search(k, r, self.seed, lat) for k, r in zip(keys, roots, strict=True)]
        none = np.empty(0, np.int64)
        todo = [(i, (none, none), 0, self._start(k), r, np.arange(len(r))) for i, (k, r) in enumerate(zip(keys, roots, strict=True))]
        for turn in range(self.k):
            sizes = [len(t[4]) for t in todo]
            at = np.repeat(np.arange(len(todo)), sizes)
            streams = np.array([stream(keys[t[0]], self.seed, turn, 1) for t in todo], np.uint64)
            place = np.concatenate([*(t[5] for t in todo), none])
            which, choice = self.walk(np.concatenate([*(t[4] for t in todo), none]), streams[at], place)
            edges = np.searchsorted(at[which], np.arange(len(todo) + 1))
            following = []
            for n, (i, (chunk0, choice0), since, value, _, _) in enumerate(todo):
                own = slice(edges[n], edges[n + 1])
                search = searches[i]
                taken = np.concatenate([choice0, choice[own]])
                search.record(np.concatenate([chunk0, place[which[own]]]), taken, value, since, lat.log_share[taken])
                value, open_ = search.bound()
                if turn < self.k - 1 and value > -np.inf:
                    walk, step, pick, nodes, chunks = search.turn(open_)
                    chunk, taken, _ = search.walks[walk]
                    following.append((i, (chunk[: step + 1], np.append(taken[:step], pick)), step + 1, value, nodes, chunks))
            todo = following
        return self._results(searches)

    def _start(self, key: int) -> float:
        """The perturbed value of the best segmentation: a Gumbel value of the whole lattice."""
        return -math.log(-math.log(uniform(key, self.seed, 0, 0)))

    def _long(self, text: str, key: int) -> list[tuple[list[int], float, float, float]]:
        """What sample() gives for a text whose chunks don't fit in what is remembered."""
        lat = self.lattices
        search = _LongSearch(key, lat.v.chunks(text), self.seed, lat)
        value = self._start(key)
        before = [np.empty(0, t) for t in (np.int64, np.int64, float, np.int32)]
        steps, log_z, since, start, ahead = [], 0.0, 0, 0, -1  # steps: chunk, choice, log-share and piece of each
        for turn in range(self.k):
            parts = [before]
            for place, nodes, first in search.groups(start, ahead):
                which, choice = self.walk(nodes, np.full(len(nodes), stream(key, self.seed, turn, 1), np.uint64), place)
                parts.append([place[which], choice - first[which], lat.log_share[choice], lat.piece[choice]])
                if turn == 0:
                    log_z += float(lat.mass[nodes].sum())
            steps.append([np.concatenate(x) for x in zip(*parts, strict=True)])
            search.record(steps[-1][0], steps[-1][1], value, since, steps[-1][2])
            value, walk = search.bound()
            if turn == self.k - 1 or value == -np.inf:
                break
            step, pick, start, ahead = search.branch(walk)
            before = [np.append(x[:step], x_) for x, x_ in zip(steps[walk], (start, pick, lat.log_share[pick], lat.piece[pick]), strict=True)]
            since, start = step + 1, start if ahead >= 0 else start + 1
        threshold = search.bound()[0]
        made = self._made((chunk, piece) for chunk, _, _, piece in steps)
        return [self._result(m, value, log_z, threshold) for m, (*_, value) in zip(made, search.walks, strict=True)]

    def _results(self, searches: list[_Search]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        lat = self.lattices
        made = self._made((chunk, lat.piece[choice]) for s in searches for chunk, choice, _ in s.walks)
        out = []
        for s in searches:
            log_z, threshold = float(lat.mass[s.roots].sum()) if len(s.roots) else 0.0, s.bound()[0]
            out.append([self._result(next(made), value, log_z, threshold) for *_, value in s.walks])
        return out

    def _result(self, made: tuple[np.ndarray, float], value: float, log_z: float, threshold: float) -> tuple[np.ndarray, float, float, float]:
        ids, log_p = made[0], made[1] - log_z
        inclusion = 1.0 if threshold == -np.inf else float(-np.expm1(-np.exp(min(log_p - threshold, 50.0))))
        return ids, log_p, value, inclusion

    def _made(self, walks: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, float]]:
        """Of each walk, given as chunk and piece of its steps: its ids in the text's order, and the sum of their log-probabilities."""
        some, size = [], 0
        for walk in walks:
            if some and size + len(walk[0]) > STEPS_AT_ONCE:
                yield from self._made_at_once(some)
                some, size = [], 0
            some.append(walk)
            size += len(walk[0])
        if some:
            yield from self._made_at_once(some)

    def _made_at_once(self, walks: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, float]]:
        v, ends = self.lattices.v, np.cumsum([len(c) for c, _ in walks], dtype=np.int64)
        chunk, piece = (np.concatenate(x) for x in zip(*walks, strict=True))
        # Chunks stand in order but were walked from their ends: their steps are turned round.
        new = np.ones(len(chunk), bool)
        new[1:] = chunk[1:] != chunk[:-1]
        new[ends[ends < len(chunk)]] = True
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(chunk)) - 1
        order = np.repeat(first + last, last - first + 1)
        order -= np.arange(len(order))
        ids, cost, past = piece[order], v.score[np.maximum(piece, 0)], ends
        lone = np.flatnonzero(ids < 0)
        if len(lone):  # characters that are no piece are given as their bytes
            size = np.ones(len(ids), np.int64)
            size[lone], raw, cost[order[lone]] = v.in_bytes(-1 - ids[lone])
            past = np.append(0, np.cumsum(size))[ends]
            ids = np.repeat(ids, size)
            ids[ids < 0] = raw
        ids, past, ends = ids.astype("<i4", copy=False), past.tolist(), ends.tolist()
        return [(ids[a:b], float(cost[x:y].sum())) for a, b, x, y in zip([0, *past[:-1]], past, [0, *ends[:-1]], ends, strict=True)]


def round_trips(found: list[np.ndarray], raw: list[bytes], v: Vocabulary) -> list[bool]:
    """Whether the bytes of each segmentation, without the space put in front, are those of its text."""
    ids = np.concatenate([*found, np.empty(0, np.int32)])
    flat = b"".join(v.joined(ids[s : s + STEPS_AT_ONCE]) for s in range(0, len(ids), STEPS_AT_ONCE))
    past = np.cumsum([0, *(v.size[f].sum() for f in found)]).tolist()
    return [flat[a + 1 : b] == r for a, b, r in zip(past[:-1], past[1:], raw, strict=True)]


def decoded(ids, v: Vocabulary) -> bytes:
    """The UTF-8 bytes of a segmentation: pieces and bytes joined, without the space put in front."""
    return b"".join(map(v.bytes_of.__getitem__, ids))[1:]


def decode(ids, v: Vocabulary) -> str:
    """The text of a segmentation."""
    return decoded(ids, v).decode("utf-8", "replace")


def _encoded(path: str, k: int, seed: int, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(path, k, seed)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            keys = [int.from_bytes(hashlib.blake2b(repr(x).encode(), digest_size=8).digest(), "little") for x in batch["key"].to_pylist()]
            raw, found, back = [t.encode() for t in texts], [], []
            for s in range(0, len(texts), AT_ONCE):
                some = sampler.sample(texts[s : s + AT_ONCE], keys[s : s + AT_ONCE])
                found += some
                back += round_trips([x[0] for f in some for x in f], [r for f, r in zip(some, raw[s : s + AT_ONCE], strict=True) for _ in f], sampler.lattices.v)
            at = pa.array([i for i, f in enumerate(found) for _ in f])
            flat = [x for f in found for x in f]
            ids = pa.array([x[0].tobytes() for x in flat], pa.binary()) if packed else pa.array([x[0].tolist() for x in flat], pa.list_(pa.int32()))
            rest = [n for n in batch.schema.names if n not in ("key", "text")]
            yield pa.RecordBatch.from_arrays(
                [batch[n].take(at) for n in rest] + [pa.array([r for f in found for r in range(len(f))], pa.int32()), ids, pa.array([len(x[0]) for x in flat], pa.int64()),
                 *(pa.array([x[j] for x in flat], pa.float64()) for j in (1, 2, 3)), pa.array(back, pa.bool_())],
                names=[*rest, "rank", "ids", "n_pieces", "log_prob", "perturbed", "inclusion", "round_trip"])
    return run


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 2, seed: int = 0, path: str | None = None, packed: bool = False) -> DataFrame:
    """k distinct segmentations of each row's whole text, one a row: key, rank, ids, n_pieces, log_prob, perturbed, inclusion, round_trip.

    They are the k highest of all segmentations when Gumbel noise is added to their log-probabilities, so rank 0 is
    a sample and all k are one without replacement; inclusion is the chance to be above the (k+1)-th value. The
    noise comes from the row's key and the seed: repeated rows get the same ones, in any partitioning. A text with
    fewer segmentations gives as many rows; null and empty texts have the empty one. round_trip tells whether the
    ids decode to the text. No length is too long, but a chunk, a run of text without a space or line break, has its
    lattice in memory as a whole. packed gives ids as little-endian 32-bit numbers. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("out"), F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["out"].dataType.simpleString()
    ids = "binary" if packed else "array<int>"
    return rows.mapInArrow(
        _encoded(path or default_vocabulary(), k, seed, packed),
        f"out {kind}, rank int, ids {ids}, n_pieces long, log_prob double, perturbed double, inclusion double, round_trip boolean",
    ).withColumnRenamed("out", key)
