"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts are normalised: A-Z and Latin-1 capitals lower-cased, every run of bytes
other than letters and digits one blank. Every word of a document and of an item
begins a window. The length of a window's walk goes by the item's length, in
CLASSES, and is never longer than the item: over a whole long item 20 % edits
would leave no table a chance, while of its many windows some have few edits.

A window is embedded by the random walk of Chakraborty, Goldenberg and Koucky:
at step t the current character is written out, and a random bit that depends on
t and the character says whether to move on. Few edits then become few unequal
places, and walks fall into step again after an edit. Tables sample some places
each; windows that agree with an item's window on all places of a table, and on
most of all places, are candidates. The number of tables follows from the recall
wanted at ``unequal`` unequal places (``tables_for``). The shortest items are
looked up besides by the hashes of all runs of their number of words, so that
exact copies of them are always found. Candidates that a lower bound of the edit
distance leaves are verified by Myers' bit-vector edit distance of the whole item
against the text around the window.

Items are read in blocks of bounded size and each block's index is broadcast;
documents are scanned once per block and nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import ready
from tidemark.llm.textblocks import mix, slices, words

#: Items of fewer characters than the first number have walks of so many steps, of which a table samples so many places.
CLASSES = ((40, 16, 5), (96, 32, 8), (1 << 62, 48, 10))
PAD = max(steps for _, steps, _ in CLASSES)
WALKS = 2
#: Share of unequal places in the best of a passage's windows that tables are made for; set by the recall that came of it at 20 % edits.
UNEQUAL = 0.2
CHUNK = 1 << 14
#: Windows that agree in a table are no candidates if a larger share of all places is unequal.
FAR = 0.25
#: Characters of an item in one bit vector, and characters that the lower bound scans at once, over all vectors.
PIECE = 64
SCANNED = 1 << 21
#: Characters to scan, over all vectors, for which looks are held back.
HELD = 1 << 21
#: What a table's filter holds where different bytes meet.
ANY = 255
BLOCK_ITEMS = 10_000
BLOCK_CHARS = 8 << 20

#: Letters of written European text per thousand, a to z, rounded.
LETTERS = (80, 15, 30, 40, 130, 18, 18, 30, 75, 3, 6, 40, 27, 72, 70, 25, 4, 65, 68, 75, 35, 12, 12, 3, 12, 5)

_FOLD = np.full(256, 0x20, np.uint8)
for _a, _b in ((ord("0"), ord("9")), (ord("a"), ord("z")), (0x80, 0xFF)):
    _FOLD[_a : _b + 1] = np.arange(_a, _b + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def tables_for(recall: float, unequal: float, sampled: int) -> int:
    """Tables so that one window pair with that share of unequal places is met with that probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - (1 - unequal) ** sampled)))


def normalise(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes (zero-padded by PAD), the raw index of each, and each text's end among them."""
    folded = _FOLD[raw]
    capital = np.zeros(len(raw), bool)
    capital[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    folded[capital] += 0x20
    blank = folded == 0x20
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    starts = offsets[:-1][offsets[:-1] < len(raw)]
    kept[starts] = True  # a text never runs into the next
    folded[starts[blank[starts]]] = 0x20
    index = np.flatnonzero(kept)
    ends = np.searchsorted(index, offsets)
    return np.concatenate([folded[index], np.zeros(PAD, np.uint8)]), index, ends


def word_starts(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    body = text[: len(text) - PAD]
    inside = body != 0x20
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(body)]
    begins[first] = inside[first]
    return np.flatnonzero(begins)


def word_runs(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words within one text, and where they start."""
    hashed, first = words(text[: len(text) - PAD], ends)
    n = max(0, len(hashed) - length + 1)
    run = np.zeros(n, np.uint64)
    for k in range(length):
        run = mix(run * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + n])
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(first))
    whole = owner[:n] == owner[length - 1 : length - 1 + n]
    return run[whole], starts[:n][whole]


@dataclass(frozen=True)
class Walks:
    """Random bits of the walks, and the places that each table samples."""

    tables: int
    steps: int
    sampled: int
    seed: int = 7

    @cache
    def sampled_places(self, walk: int) -> list[list[int]]:
        """For each table of a walk its places, one from each of as many equal stretches (places that cluster would meet any text)."""
        rng = np.random.default_rng((self.seed, self.steps, walk))
        out = []
        for _ in range(walk, self.tables, WALKS):
            out.append(((rng.random(self.sampled) + np.arange(self.sampled)) * self.steps / self.sampled).astype(int).tolist())
            # so much was drawn between tables when their recall was measured
            rng.integers(0, 1 << 31, self.sampled, dtype=np.uint32)
        return out

    def keys(self, walk: int, written: np.ndarray) -> Iterator[np.ndarray]:
        """For each table of a walk a 32-bit hash of the sampled places of every window, in an array that the next one overwrites.

        Its high bits see all bits of the characters, its lowest only their lowest.
        """
        key = np.empty(written.shape[1], np.uint32)
        for where in self.sampled_places(walk):
            key[:] = written[where[0]]
            for t in where[1:]:
                key += written[t]
            yield key


def walked(text: np.ndarray, starts: np.ndarray, walk: int, steps: int, seed: int = 7) -> np.ndarray:
    """What a walk writes from each start, a row per step; shorter walks are its beginning.

    A character is written as its product with the step's odd factor, so that hashes are plain sums.
    Whether a step moves on is the top bit of a random function of the character, in eight-bit arithmetic.
    """
    moves, factors = _moves(walk, seed), _factors(walk, seed)
    written = np.empty((steps, len(starts)), np.uint32)
    place, char = starts.copy(), np.empty(len(starts), np.uint8)
    for t in range(steps):
        text.take(place, out=char, mode="clip")
        np.multiply(char, factors[t], out=written[t])
        place += _bit(char, *moves[t])
    return written


@cache
def _factors(walk: int, seed: int) -> np.ndarray:
    return 2 * np.random.default_rng((seed, walk, PAD)).integers(0, 1 << 31, PAD, dtype=np.uint32) + 1


def _bit(char: np.ndarray, term: np.uint8, first: np.uint8, second: np.uint8) -> np.ndarray:
    char += term
    char *= first
    char ^= char >> 4
    char *= second
    char >>= 7
    return char


@cache
def _moves(walk: int, seed: int) -> list[tuple[np.uint8, np.uint8, np.uint8]]:
    """Random functions, one a step, each drawn until about half of the characters of plain text move on: a walk that stands still meets any text."""
    rng = np.random.default_rng((seed, walk))
    letters = np.array([0x20, *range(ord("a"), ord("z") + 1)], np.uint8)
    often = np.array([sum(LETTERS) / 5, *LETTERS])
    often /= often.sum()
    out = []
    while len(out) < PAD:
        term, first, second = rng.integers(0, 256, 3, dtype=np.uint8) | np.array([0, 1, 1], np.uint8)
        if 0.46 <= float(often[_bit(letters.copy(), term, first, second) == 1].sum()) <= 0.54:
            out.append((term, first, second))
    return out


def distance_within(item: str, text: str, most: int | None = None) -> tuple[int, int, int]:
    """Least edit distance of the item to any stretch of the text, and that stretch (none beyond ``most`` edits)."""

    def scan(pattern: str, chars: str, anchored: int) -> tuple[int, int]:
        m = len(pattern)
        full, top = (1 << m) - 1, 1 << (m - 1)
        where: dict[str, int] = {}
        for k, c in enumerate(pattern):
            where[c] = where.get(c, 0) | 1 << k
        up, down, score, best, end = full, 0, m, m, 0
        for k, c in enumerate(chars):
            eq = where.get(c, 0)
            x = eq | down
            h = (((eq & up) + up) ^ up) | eq
            plus = down | (full & ~(h | up))
            minus = up & h
            score += bool(plus & top) - bool(minus & top)
            plus = (plus << 1 | anchored) & full
            minus = minus << 1 & full
            up = minus | (full & ~(x | plus))
            down = plus & x
            if score < best:
                best, end = score, k + 1
        return best, end

    best, end = scan(item, text, 0)
    if best == len(item) or most is not None and best > most:
        return best, 0, 0
    _, back = scan(item[::-1], text[:end][::-1], 1)
    return best, end - back, end


def edits_at_least(items: list[str], texts: list[str]) -> np.ndarray:
    """For each item a lower bound of its edit distance to any stretch of its text.

    An item is cut into pieces of PIECE characters at most; the least distances of
    its pieces to stretches of the text, wherever those are, sum to no more than
    its own. All pieces are scanned in step, a bit vector each. Characters count
    by their last eight bits, which can only bring texts nearer.
    """
    out = np.zeros(len(items), np.int64)
    order = sorted(range(len(items)), key=lambda k: len(texts[k]))
    start = 0
    while start < len(order):
        stop, lanes = start, 0
        while stop < len(order) and (stop == start or (lanes + -(-len(items[order[stop]]) // PIECE)) * max(1, len(texts[order[stop]])) <= SCANNED):
            lanes += -(-len(items[order[stop]]) // PIECE)
            stop += 1
        some = order[start:stop]
        out[some] = _bounds([items[k] for k in some], [texts[k] for k in some])
        start = stop
    return out


def _codes(text: str) -> np.ndarray:
    return (np.frombuffer(text.encode("utf-32-le", errors="replace"), np.uint32) & 0xFF).astype(np.uint8)


def _bounds(items: list[str], texts: list[str]) -> np.ndarray:
    pieces: dict[bytes, int] = {}
    number, owner, length = [], [], []
    cut: dict[str, list[bytes]] = {}
    for k, item in enumerate(items):
        if item not in cut:
            codes = _codes(item)
            cut[item] = [piece.tobytes() for piece in np.array_split(codes, -(-len(codes) // PIECE))] if len(codes) else []
        for piece in cut[item]:
            number.append(pieces.setdefault(piece, len(pieces)))
            owner.append(k)
            length.append(len(piece))
    number, owner, length = np.array(number, np.int64), np.array(owner, np.int64), np.array(length, np.int64)
    # a piece has the high bits of its vector; the bits below match anything and cost nothing
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    free = (64 - sizes).astype(np.uint64)
    one = np.uint64(1)
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    # characters by their number among those of the pieces, 0 for all others, so that the vectors of a piece lie close together
    used = np.unique(joined)
    spare = int(len(used) < 256)
    rank = np.zeros(256, np.uint8)
    rank[used] = np.arange(len(used)) + spare
    where = np.repeat(((one << free) - one)[:, None], len(used) + spare, axis=1)
    bits = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    np.bitwise_or.at(where, (np.repeat(np.arange(len(sizes)), sizes), rank[joined]), one << (np.repeat(free, sizes) + bits.astype(np.uint64)))
    width = max(map(len, texts))
    grid = np.zeros((len(texts), width), np.uint8)
    for k, text in enumerate(texts):
        grid[k, : len(text)] = _codes(text)
    columns, where = rank.take(np.ascontiguousarray(grid.T)), where.reshape(-1)
    up = ~np.uint64(0) << (64 - length).astype(np.uint64)
    down = np.zeros(len(number), np.uint64)
    # no score is beyond PIECE
    score = length.astype(np.int8)
    best, base = score.copy(), number * (len(used) + spare)
    eq, across, plus, minus = (np.empty_like(up) for _ in range(4))
    at, char, grows = np.empty_like(base), np.empty(len(number), np.uint8), np.empty(len(number), bool)
    for column in columns:
        column.take(owner, out=char, mode="clip")
        np.add(base, char, out=at)
        where.take(at, out=eq, mode="clip")
        # across = (((eq & up) + up) ^ up) | eq | down
        np.bitwise_and(eq, up, out=across)
        across += up
        across ^= up
        across |= eq
        across |= down
        # plus = down | ~(across | up), minus = up & across
        np.bitwise_or(across, up, out=plus)
        np.invert(plus, out=plus)
        plus |= down
        np.bitwise_and(up, across, out=minus)
        np.less(plus.view(np.int64), 0, out=grows)
        score += grows.view(np.int8)
        np.less(minus.view(np.int64), 0, out=grows)
        score -= grows.view(np.int8)
        np.minimum(best, score, out=best)
        plus <<= one
        minus <<= one
        # up = minus | ~(across | plus), down = plus & across
        np.bitwise_or(across, plus, out=up)
        np.invert(up, out=up)
        up |= minus
        np.bitwise_and(plus, across, out=down)
    return np.bincount(owner, best, len(items)).astype(np.int64)


def out_of_reach(item: str, text: str, edits: int) -> bool:
    """Whether the lower bound already shows that no stretch of the text is within the edits."""
    return bool(edits_at_least([item], [text])[0] > edits)


@dataclass(frozen=True)
class Index:
    """Windows of a block of items by table, and of short items the hash of all their words by number of words.

    ``begin`` counts the bytes of the item before each window, ``sizes`` those of an item.
    A table has its distinct ``keys`` and for each its first place in ``order`` (a row per
    table), where the windows of a key stand together. ``may`` is a table's filter: by the
    high bits of a key its low byte, small enough to stay in the processor's cache.
    """

    items: tuple[tuple[int, str], ...]
    walks: Walks
    owner: np.ndarray
    begin: np.ndarray
    keys: tuple[np.ndarray, ...]
    first: tuple[np.ndarray, ...]
    order: np.ndarray
    may: tuple[np.ndarray, ...]
    walked: tuple[np.ndarray, ...]
    sizes: tuple[int, ...]
    whole: tuple[tuple[int, np.ndarray, np.ndarray], ...]

    @staticmethod
    def build(items: list[tuple[int, str]], walks: Walks, least: int, below: int, whole_runs: bool) -> Index:
        """Of the items of so many characters; with the hashes of their whole word runs if asked for."""
        kept, texts, starts, owner = [], [], [], []
        whole: dict[int, list[tuple[int, int]]] = {}
        base = 0
        for item_id, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            norm, _, ends = normalise(raw, np.array([0, len(raw)]))
            plain = norm[: len(norm) - PAD].tobytes().decode(errors="replace").strip()
            if not plain or not least <= len(plain) < below:
                continue
            own = word_starts(norm, ends)
            if whole_runs:
                run, _ = word_runs(norm, own, ends, len(own))
                whole.setdefault(len(own), []).append((int(run[0]), len(kept)))
            own = own[(own <= len(norm) - PAD - walks.steps // 4)]
            texts.append(norm)
            starts.append(own)
            owner.append(np.full(len(own), len(kept)))
            kept.append((item_id, plain, base, norm))
            base += len(norm)
        if not kept:
            return Index((), walks, *(np.zeros(0, np.int64),) * 2, (), (), np.zeros((0, 0), np.int32), (), (), (), ())
        text = np.concatenate(texts)
        at = np.concatenate([s + k[2] for s, k in zip(starts, kept)])
        begin = np.concatenate([s - int(k[3][0] == 0x20) for s, k in zip(starts, kept)])
        keys, first, order, may, wrote = [], [], [], [], []
        for walk in range(WALKS):
            written = walked(text, at, walk, walks.steps)
            # the low byte of a product with an odd number tells characters apart
            wrote.append(written.astype(np.uint8))
            for key in walks.keys(walk, written):
                distinct, counts = np.unique(key, return_counts=True)
                keys.append(distinct)
                first.append(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                order.append(np.argsort(key, kind="stable").astype(np.int32))
                high = max(13, (8 * len(distinct)).bit_length())
                slot, low = distinct >> np.uint32(32 - high), distinct.astype(np.uint8)
                held = np.zeros(1 << high, np.uint8)
                held[slot] = low
                held[slot[held[slot] != low]] = ANY
                may.append(held)
        runs = []
        for length, pairs in sorted(whole.items()):
            pairs.sort()
            runs.append((length, np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs])))
        return Index(tuple((k[0], k[1]) for k in kept), walks, np.concatenate(owner), begin, tuple(keys), tuple(first), np.stack(order), tuple(may), tuple(wrote), tuple(len(k[1].encode()) for k in kept), tuple(runs))

    def candidates(self, walk: int, written: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of starts and of an item's windows, pair by pair, that agree in some table of a walk, as far as they are not FAR."""
        written, windows = written[: self.walks.steps], len(self.owner)
        near: list[np.ndarray] = []
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        pairs = 0
        n = written.shape[1]
        slot, low, held, passed, several = np.empty(n, np.int64), np.empty(n, np.uint8), np.empty(n, np.uint8), np.empty(n, bool), np.empty(n, bool)
        before = sum(len(range(w, self.walks.tables, WALKS)) for w in range(walk))
        for k, key in enumerate(self.walks.keys(walk, written) if windows else (), before):
            keys, first, may = self.keys[k], self.first[k], self.may[k]
            np.right_shift(key, np.uint32(33 - len(may).bit_length()), out=slot)
            may.take(slot, out=held, mode="clip")
            low[:] = key
            np.equal(held, low, out=passed)
            np.equal(held, ANY, out=several)
            passed |= several
            who = passed.nonzero()[0]
            asked = key[who]
            a = keys.searchsorted(asked)
            hit = (keys.take(a, mode="clip") == asked).nonzero()[0]
            if not len(hit):
                continue
            a = a[hit]
            many = first[a + 1] - first[a]
            met.append((who[hit], first[a] + np.int64(k * windows), many))
            pairs += int(many.sum())
            if pairs >= CHUNK:
                near.append(self._near(walk, written, met))
                met, pairs = [], 0
        if met:
            near.append(self._near(walk, written, met))
        return np.divmod(np.concatenate(near) if near else np.zeros(0, np.int64), max(1, windows))

    def _near(self, walk: int, written: np.ndarray, met: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Numbers of the pairs that are not FAR, of starts with so many windows each from a place of ``order``."""
        who, first, many = (np.concatenate(x) for x in zip(*met))
        ends = np.cumsum(many)
        pairs = np.repeat(who, many) * len(self.owner) + self.order.take(np.arange(ends[-1]) + np.repeat(first - ends + many, many))
        out = []
        for part in range(0, len(pairs), CHUNK):
            # a near pair agrees in many tables
            some = np.unique(pairs[part : part + CHUNK])
            w, o = np.divmod(some, len(self.owner))
            unequal = np.count_nonzero(written.take(w, axis=1).astype(np.uint8) != self.walked[walk].take(o, axis=1), axis=0)
            out.append(some[unequal <= FAR * self.walks.steps])
        return np.concatenate(out)

    def copies(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place, number of an item) of all runs of words that are a short item."""
        for length, hashes, owner in self.whole:
            run, at = word_runs(text, starts, ends, length)
            a, b = np.searchsorted(hashes, run), np.searchsorted(hashes, run, "right")
            for k in np.flatnonzero(b > a).tolist():
                yield from ((int(at[k]), int(o)) for o in owner[a[k] : b[k]])


@dataclass(slots=True)
class Look:
    """A stretch of a text to hold against an item.

    ``number`` is the item's among all of its block. ``points`` has for each byte of the
    stretch how many code points of the original stand before it, ``base`` of them in earlier texts.
    """

    doc: int
    number: tuple[int, int]
    item: tuple[int, str]
    most: int
    near: str
    points: np.ndarray
    base: int

    @property
    def scanned(self) -> int:
        return -(-len(self.item[1]) // PIECE) * len(self.near)


def find_in(indexes: list[Index], raw: np.ndarray, offsets: np.ndarray, similarity: float) -> Iterator[tuple[int, tuple[int, str], int, int, int]]:
    """(text number, item, distance, start, end) of the best occurrence of each item in each text."""
    return verified(list(looks_in(indexes, raw, offsets, similarity)), similarity)


def looks_in(indexes: list[Index], raw: np.ndarray, offsets: np.ndarray, similarity: float) -> Iterator[Look]:
    """Where in each text an item may occur; looks at one text for one item follow each other."""
    text, back, ends = normalise(raw, offsets)
    starts = word_starts(text, ends)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in indexes]
    longest = max((index.walks.steps for index in indexes), default=0)
    # so many windows at a time stay in the processor's cache; a walk serves the tables of all lengths
    for first in range(0, len(starts), CHUNK):
        for walk in range(WALKS):
            written = walked(text, starts[first : first + CHUNK], walk, longest)
            for index, pairs in zip(indexes, found):
                who, window = index.candidates(walk, written)
                pairs.append((starts[first + who], window))
    # code points of the original text before each of its bytes
    points = np.zeros(len(raw) + 1, np.int32 if len(raw) < 1 << 31 else np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    bases, points = points[offsets].tolist(), points[back]
    for index, pairs in zip(indexes, found):
        yield from _looks(index, pairs, text, ends, starts, points, bases, similarity)


def _looks(index: Index, pairs: list[tuple[np.ndarray, np.ndarray]], text: np.ndarray, ends: np.ndarray, starts: np.ndarray, points: np.ndarray, bases: list[int], similarity: float) -> Iterator[Look]:
    copies = np.array(list(index.copies(text, starts, ends)), np.int64).reshape(-1, 2)
    at = np.concatenate([s for s, _ in pairs] + [copies[:, 0]])
    window = np.concatenate([w for _, w in pairs] + [np.zeros(0, np.int64)])
    docs, items = np.searchsorted(ends, at, "right") - 1, np.concatenate([index.owner[window], copies[:, 1]])
    # where the item would begin
    begins = at - np.concatenate([index.begin[window], np.zeros(len(copies), np.int64)])
    order = np.lexsort((begins, items, docs))
    docs, items, begins = docs[order], items[order], begins[order]
    other = np.ones(len(order), bool)
    other[1:] = (docs[1:] != docs[:-1]) | (items[1:] != items[:-1])
    new = other.copy()
    new[1:] |= begins[1:] != begins[:-1]
    limits = ends.tolist()
    for doc, item, begin, fresh in zip(docs[new].tolist(), items[new].tolist(), begins[new].tolist(), other[new].tolist()):
        if fresh:
            known, size = index.items[item], index.sizes[item]
            most = int((1 - similarity) * len(known[1]) + 1e-6)
            slack = most + 2
        elif begin <= done + slack // 2:
            continue
        done = begin
        # an edit may be a letter of two bytes
        lo, hi = max(limits[doc], begin - 2 * slack), min(limits[doc + 1], begin + size + 3 * slack)
        part = text[lo:hi].tobytes()
        skip = 0
        while skip < len(part) and part[skip] & 0xC0 == 0x80:
            skip += 1
        yield Look(doc, (index.walks.steps, item), known, most, part[skip:].decode(errors="replace"), points[lo + skip : hi].copy(), bases[doc])


def verified(looks: list[Look], similarity: float) -> Iterator[tuple[int, tuple[int, str], int, int, int]]:
    """What of the looks is within the edits, the best of each text and item."""
    least = edits_at_least([look.item[1] for look in looks], [look.near for look in looks])
    best: dict[tuple[int, tuple[int, int]], tuple[int, tuple[int, str], int, int, int]] = {}
    for look, bound in zip(looks, least.tolist()):
        if bound > look.most:
            continue
        distance, start, end = distance_within(look.item[1], look.near, look.most)
        place = look.doc, look.number
        if distance <= look.most and len(look.item[1]) - distance >= similarity * len(look.item[1]) and (place not in best or distance < best[place][2]):
            first, last = len(look.near[:start].encode()), len(look.near[: end - 1].encode())
            best[place] = look.doc, look.item, distance, int(look.points[first]) - look.base, int(look.points[last]) + 1 - look.base
    yield from best.values()


def search_batches(indexes: list[Index], batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """What ``contaminated`` returns, of batches of doc_id and text.

    Looks are held back over slices, up to HELD, so that many are bounded in step.
    """
    looks: list[Look] = []
    ids: list[int | None] = []
    scanned = 0
    for batch in batches:
        for part, raw, offsets in slices(batch, "text"):
            row, number = -1, (0, 0)
            for look in looks_in(indexes, raw, offsets, similarity) if len(raw) else ():
                if (look.doc, look.number) != (row, number):
                    row, number = look.doc, look.number
                    if scanned >= HELD:
                        yield from _judged(looks, ids, similarity)
                        looks, ids, scanned = [], [], 0
                    ids.append(part.column("doc_id")[row].as_py())
                look.doc = len(ids) - 1
                looks.append(look)
                scanned += look.scanned
    yield from _judged(looks, ids, similarity)


def _judged(looks: list[Look], ids: list[int | None], similarity: float) -> Iterator[pa.RecordBatch]:
    """Findings of looks that count in ``doc`` the pairs of a text and an item, whose texts have these ids."""
    rows = list(verified(looks, similarity))
    if rows:
        doc, item, distance, start, stop = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[d] for d in doc], pa.int64()), pa.array([i for i, _ in item], pa.int64()), pa.array(distance, pa.int64()), pa.array([1 - d / len(t) for d, (_, t) in zip(distance, item)]), pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
            names=["doc_id", "item_id", "distance", "similarity", "start", "stop"],
        )


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.95, unequal: float = UNEQUAL) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, similarity, start, stop.

    An item is found if some stretch of the document is within
    ``(1 - similarity) x length`` edits of it after normalising; start and stop
    are code points of the original text. Documents without a finding have no
    row. Defined cases: null and empty texts hold nothing; null ids are reported
    as null; repeated rows and repeated items report each; items without a letter
    or digit are never found; an empty table on either side gives no rows; other
    columns are ignored.
    """
    ready(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = "doc_id long, item_id long, distance long, similarity double, start long, stop long"
    parts: list[DataFrame] = []
    kinds, least = [], 0
    for below, steps, sampled in CLASSES:
        kinds.append((Walks(tables_for(recall, unequal, sampled), steps, sampled), least, below, least == 0))
        least = below

    def scan(items: list[tuple[int, str]]) -> None:
        indexes = [x for x in (Index.build(items, *kind) for kind in kinds) if x.items]
        if not indexes:
            return
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from search_batches(shared.value, batches, similarity)

        parts.append(texts.mapInArrow(search, schema))

    block, chars = [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL").toLocalIterator():
        block.append((item_id, text))
        chars += len(text)
        if len(block) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
            scan(block)
            block, chars = [], 0
    scan(block)
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
