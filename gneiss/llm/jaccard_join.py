"""Exact Jaccard self-join of documents on word shingles, in metric space.

The Jaccard distance is a metric, but unrelated documents all lie at distance
1 from one another, so cells about document pivots can't part them: every
document would be within the window of every cell. The join therefore works
on two levels.

1. Coarse cells. The symmetric difference of shingle sets is a metric too,
   and restricting sets to a hash class of shingles never enlarges it. Sizes
   (distances from the empty pivot) are cut into bands; a document is
   replicated into a lower band when the triangle inequality lets a partner
   lie there. In a band whose linked pairs differ in at most D shingles,
   shingles fall into D + 1 + spare classes; by the pigeonhole principle a
   linked pair agrees wholly on more than `spare` classes. A class and its
   content are a pivot whose cell of radius 0 holds the documents that agree
   with it. Weak contents, of no or few shingles, are left out of documents
   with at most `spare` of them, which still leaves a pair a cell in common.
   Inside a cell, documents are joined where counts of shingles by class (a
   contraction of the metric) don't rule a link out; documents so joined, over
   all cells, are a candidate region.
2. Voronoi regions. Inside a region distances spread. Pivots are drawn,
   documents go to their nearest pivot's cell and, where d(x, p) - d(x, nearest)
   is at most twice the threshold distance, into p's cell as well; cells are
   cut again until they are small or stop shrinking, and leaves compare their
   documents by exact set products, block by block: links are counted and
   components joined as blocks go by, and no pair is kept. Where cells stop
   shrinking, documents within half the threshold distance of a pivot are
   linked by the triangle inequality, without comparison. A region that is
   too large for a task is cut this way by distributed rounds first, and what
   they can't cut is dealt in parts of which each two meet; a document's links
   are counted in the cell of its nearest pivot, where all its partners are.

Equal sets are one document with a multiplicity, so copies are never paired.
Shingles are 64-bit hashes of the lower-cased words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.text import Texts, mix, slices, small_batches, trim
from gneiss.operators.components import connected_components
from gneiss.operators.lineage import BROADCAST_BYTES, cut, small

LEAF = 192
#: Documents on either side of one block of comparisons.
BLOCK = 512
BAND = 1.4
#: A region of more documents or more bytes of shingles is cut or dealt in parts before a task holds it.
REGION_ROWS, REGION_BYTES = 8000, 24 << 20


def distinct_sets(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text, one after the other, and their pointer."""
    h, ptr = texts.lower().words().shingles(n)
    which = np.repeat(np.arange(len(texts)), np.diff(ptr))
    order = np.lexsort((h, which))
    h, which = h[order], which[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (which[1:] != which[:-1])
    h, which = h[new], which[new]
    return h, np.searchsorted(which, np.arange(len(texts) + 1))


def bands(most: int) -> np.ndarray:
    """Lower bounds of the size bands, the last one beyond `most`."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return np.array(out)


def classes(upper: int, percent: int) -> tuple[int, int, int]:
    """(number of classes, spare, weak) of the band whose largest size is `upper`.

    Contents of fewer than `weak` shingles are weak. The largest such bound is
    taken that nearly all of the band's documents can afford, with at most half
    as many classes again; small sets can't afford any.
    """
    d = (upper + upper * 100 // percent) * (100 - percent) // (100 + percent)
    for weak in (2, 1):
        spare = 0
        for _ in range(12):
            m = d + 1 + spare
            load = upper / BAND / m
            mean = m * np.exp(-load) * (1 if weak == 1 else 1 + load)
            before, spare = spare, int(np.ceil(mean + 3.5 * np.sqrt(mean)))
            if spare == before:
                break
        if spare == before and spare <= (d + 1) // 2:
            return d + 1 + spare, spare, weak
    return d + 1, 0, 0


def _summary(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                h, ptr = distinct_sets(texts, n)
                sums = []
                for seed in (0, 0x5851F42D4C957F2D):
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(mix(h ^ np.uint64(seed)), out=total[1:])
                    sums.append((total[ptr[1:]] - total[ptr[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(ptr)), *map(pa.array, sums)], ["doc_id", "n_shingles", "f0", "f1"])

    return run


def cell_keys(h: np.ndarray, ptr: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, cell key) of every coarse cell that each text's set lies in."""
    sizes = np.diff(ptr)
    edges = bands(int(sizes.max(initial=0)))
    home = np.searchsorted(edges, sizes, side="right") - 1
    low = np.searchsorted(edges, (sizes * percent + 99) // 100, side="right") - 1
    which, keys = [], []
    spread = mix(h ^ np.uint64(0xD1B54A32D192ED03))
    content = mix(h ^ np.uint64(0x2545F4914F6CDD1D))
    for b in np.unique(np.concatenate([home, low])) if len(sizes) else ():
        rows = np.flatnonzero((sizes > 0) & (low <= b) & (home >= b))
        if b < 0 or not len(rows):
            continue
        m, spare, least = classes(int(edges[b + 1]) - 1, percent)
        if m - spare == 1:  # only equal sets can link
            continue
        k = sizes[rows]
        at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k - ptr[:-1][rows], k)
        cell = np.repeat(np.arange(len(rows)) * m, k) + ((spread[at] >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        filled = np.bincount(cell, minlength=len(rows) * m).reshape(len(rows), m)
        order = np.argsort(cell, kind="stable")
        total = np.zeros(len(at) + 1, np.uint64)
        np.cumsum(content[at][order], out=total[1:])
        ends = np.cumsum(filled.ravel())
        sums = (total[ends] - total[ends - filled.ravel()]).reshape(len(rows), m)
        weak = filled < least
        wanted = ~weak | (weak.sum(1) > spare)[:, None]
        r, c = np.nonzero(wanted)
        which.append(rows[r])
        keys.append(mix(sums[r, c] + mix((np.uint64(b) << np.uint64(32)) + c.astype(np.uint64))))
    if not which:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(which), np.concatenate(keys)


#: Bits a key of the filter of shared keys, and the most bits of it in all; with fewer a key it lets more through.
KEY_BITS, MOST_BITS, BIT_PARTS = 16, 1 << 28, 64


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return mix(keys.view(np.uint64) + np.uint64(11)) & np.uint64(bits - 1)


def key_filter(keys: DataFrame, count: int) -> np.ndarray:
    """A bit for each slot of a power of two, set where one of the `count` keys has its slot; no key of them is ever missed."""
    bits = 1 << min(max(count * KEY_BITS, 8 * BIT_PARTS).bit_length(), MOST_BITS.bit_length() - 1)
    size = bits // BIT_PARTS

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(_slots(batch.column("key").to_numpy(), bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot // size), pa.array(slot % size)], ["part", "slot"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            part, slot = batch.column("part").to_numpy(), batch.column("slot").to_numpy()
            for k in np.unique(part).tolist():
                seen.setdefault(k, np.zeros(size, bool))[slot[part == k]] = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array([np.packbits(x).tobytes() for x in seen.values()], pa.binary())], ["part", "bits"])

    out = np.zeros((BIT_PARTS, size // 8), np.uint8)
    found = keys.select("key").mapInArrow(find, "part long, slot long").repartition(BIT_PARTS, "part").mapInArrow(mark, "part long, bits binary")
    for row in found.toLocalIterator():
        out[row.part] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def may_have(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be one of the filter's; true for all that are."""
    slot = _slots(keys, 8 * len(bits)).astype(np.int64)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0


def _cells(n: int, percent: int, bits=None):
    """(doc_id, key) of each document's cells; bits: a shared key_filter that keys have to pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                which, keys = cell_keys(*distinct_sets(texts, n), percent)
                if bits is not None:
                    own = may_have(bits.value, keys)
                    which, keys = which[own], keys[own]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(which)), pa.array(keys.view(np.int64))], ["doc_id", "key"])

    return run


def distinct_cells(met: DataFrame) -> DataFrame:
    """The rows of met(doc_id, key) with one cell, that of the smallest key, for all cells of the same documents.

    Documents that nearly agree have dozens of cells in common, and the same
    documents have the same edges in each. A set of documents is known by its
    least one and 64 bits of all.
    """
    sets = met.groupBy("key").agg(F.min("doc_id").alias("low"), F.expr("bit_xor(xxhash64(doc_id))").alias("docs"))
    kept = cut(sets.groupBy("low", "docs").agg(F.min("key").alias("key")).select("key"))
    return met.join(small(kept, 64), "key", "left_semi").select("doc_id", "key")


#: Classes of the smallest sketch; a set has twice as many until a class has at most SKETCH_LOAD of its shingles, as
#: with fewer classes the counts of unrelated large sets are too much alike to tell them apart.
SKETCH, SKETCH_LOAD = 64, 12
#: Cells of up to so many documents give all their possible pairs, larger ones a spanning forest of them.
FEW = 12
#: A cell of more documents isn't held in a task; its documents are joined without a look at their sketches.
MOST_HELD = 100_000


def sketch_classes(sizes: np.ndarray) -> np.ndarray:
    """The number of classes in each set's sketch, SKETCH times a power of two."""
    return SKETCH << np.ceil(np.log2(np.maximum(sizes / (SKETCH * SKETCH_LOAD), 1))).astype(np.int64)


def _sketches(n: int):
    """Counts of each set's shingles in classes, at most 255; L1 distances of them never exceed the sets' difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                h, ptr = distinct_sets(texts, n)
                k = sketch_classes(np.diff(ptr))
                first = np.cumsum(k) - k
                high = (mix(h ^ np.uint64(0x94D049BB133111EB)) >> np.uint64(40)).astype(np.int64)  # a class is the first bits, so that two neighbours make one of half the resolution
                at = np.repeat(first, np.diff(ptr)) + (high * np.repeat(k, np.diff(ptr)) >> 24)
                counts = np.minimum(np.bincount(at, minlength=k.sum()), 255).astype(np.uint8).tobytes()
                rows = pa.array([counts[a : a + w] for a, w in zip(first.tolist(), k.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(ptr)), rows], ["doc_id", "size", "sketch"])

    return run


def folded(sketches: list[bytes], classes: int) -> np.ndarray:
    """The sketches with `classes` classes each, at most what each of them has."""
    if all(len(x) == classes for x in sketches):
        return np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, classes)
    return np.array([np.minimum(np.frombuffer(x, np.uint8).reshape(classes, -1).sum(1, dtype=np.int64), 255) for x in sketches], np.uint8)


def possible(sketch: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sketches of rows i and j leave a link possible."""
    out = np.zeros(len(i), bool)
    step = (1 << 22) // sketch.shape[1] + 1
    for a in range(0, len(i), step):
        x, y = i[a : a + step], j[a : a + step]
        apart = np.abs(sketch[x].astype(np.int16) - sketch[y]).sum(1, dtype=np.int64)
        out[a : a + step] = apart * (100 + percent) <= (size[x] + size[y]) * (100 - percent)
    return out


def forest(sketch: np.ndarray, size: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that join all documents of one cell between which links are possible, directly or by others."""
    edges, left = [], np.arange(len(size))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            met = possible(sketch, size, np.full(len(left), at), left, percent)
            edges += [(at, x) for x in left[met]]
            queue += left[met].tolist()
            left = left[~met]
    return edges


def _possible_edges(percent: int, most_held: int = MOST_HELD):
    """Edges within the cells of a partition that is sorted by key; a cell may go on over batches."""

    def edges(key: np.ndarray, doc: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> Iterator[pa.RecordBatch]:
        """By the resolution of the cells: that of the coarsest sketch in each."""
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        least = np.minimum.reduceat([len(x) for x in sketch], start) if len(key) else start
        classes = np.repeat(least, np.diff(np.concatenate([start, [len(key)]])))
        for k in np.unique(classes).tolist():
            own = classes == k
            yield alike(key[own], doc[own], size[own], folded(sketch[own].tolist(), k))

    def alike(key: np.ndarray, doc: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.concatenate([start, [len(key)]]))
        a, b = [], []
        rank = np.arange(len(key)) - np.repeat(start, n)
        ahead = np.where(np.repeat(n, n) <= FEW, np.repeat(n, n) - rank - 1, 0)
        for shift in range(1, FEW):
            i = np.flatnonzero(ahead >= shift)
            i = i[possible(sketch, size, i, i + shift, percent)]
            a.append(i)
            b.append(i + shift)
        for k in np.flatnonzero(n > FEW):
            s = slice(start[k], start[k] + n[k])
            found = np.array(forest(sketch[s], size[s], percent), np.int64).reshape(-1, 2) + start[k]
            a.append(found[:, 0])
            b.append(found[:, 1])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        pairs = np.unique(np.stack([np.minimum(doc[a], doc[b]), np.maximum(doc[a], doc[b])], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["first", "doc_id"])

    def star(key: np.ndarray, doc: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([np.minimum(doc[0], doc[1:]), np.maximum(doc[0], doc[1:])], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["first", "doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, flat = None, False  # flat: the first cell was too large to hold, all its documents are joined with its first
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc_id", "size")]
            rows.append(np.array(batch.column("sketch").to_pylist(), object))
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if flat and held[0][0] != held[0][-1]:
                end = int(np.searchsorted(held[0], held[0][0], side="right"))
                yield star(*(x[:end] for x in held))
                held, flat = [x[end:] for x in held], False
            cut_at = int(np.searchsorted(held[0], held[0][-1]))
            if cut_at:
                yield from edges(*(x[:cut_at] for x in held))
                held = [x[cut_at:] for x in held]
            if len(held[0]) > most_held:
                yield star(*held)
                held, flat = [x[:1] for x in held], True
        if held is not None:
            yield from [star(*held)] if flat else edges(*held)

    return run


def _with_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                h, ptr = distinct_sets(texts, n)
                sets = pa.array([h[a:b].tobytes() for a, b in zip(ptr, ptr[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("region", "doc_id", "copies")), sets], ["region", "doc_id", "copies", "shingles"])

    return run


class Sets:
    """Shingle sets in one region, as rows of shared-token numbers."""

    def __init__(self, blobs: list[bytes]):
        sets = [np.frombuffer(x, np.uint64) for x in blobs]
        self.sizes = np.array([len(x) for x in sets], np.int64)
        all_ = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        all_.sort()
        shared = np.unique(all_[1:][all_[1:] == all_[:-1]])
        del all_
        self.tokens = []
        for x in sets:
            at = np.searchsorted(shared, x)
            at[at == len(shared)] = 0
            self.tokens.append((at[shared[at] == x] if len(shared) else at[:0]).astype(np.int32))

    def common(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of rows with cols, by blocks of bounded width."""
        used = np.unique(np.concatenate([self.tokens[i] for i in rows]))
        out = np.zeros((len(rows), len(cols)), np.float32)
        width = max(256, (1 << 23) // (len(rows) + len(cols)))
        for a in range(0, len(used), width):
            span = used[a : a + width]
            left, right = (self._dense(x, span) for x in (rows, cols))
            out += left @ right.T
        return out.astype(np.int64)

    def _dense(self, rows: np.ndarray, span: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), len(span)), np.float32)
        for k, i in enumerate(rows):
            t = self.tokens[i]
            at = np.searchsorted(span, t)
            ok = at < len(span)
            ok[ok] = span[at[ok]] == t[ok]
            out[k, at[ok]] = 1
        return out

    def distances(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        c = self.common(rows, cols)
        return 1 - c / np.maximum(self.sizes[rows][:, None] + self.sizes[cols] - c, 1)


class Links:
    """Link counts and components of one region's documents, gathered block by block; no pair is ever kept.

    A document's links are counted only where it is at home: in the cell of its
    nearest pivot, which holds all its partners.
    """

    def __init__(self, sets: Sets, copies: np.ndarray, percent: int):
        self.sets, self.copies, self.percent, self.reach = sets, copies, percent, 1 - percent / 100
        self.linked, self.first = np.zeros(len(copies), np.int64), np.arange(len(copies))

    def hook(self, i: np.ndarray, j: np.ndarray) -> None:
        """Joins the components of i[k] and j[k]; first[x] is always the smallest node of x's component."""
        while True:
            a, b = self.first[i], self.first[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = (x[apart] for x in (i, j, a, b))
            np.minimum.at(self.first, np.maximum(a, b), np.minimum(a, b))
            while ((up := self.first[self.first]) != self.first).any():
                self.first = up

    def blocks(self, x: np.ndarray, y: np.ndarray, home: np.ndarray) -> None:
        """Compares the documents x with y, which is x itself or disjoint from it."""
        same = x is y
        for a in range(0, len(x), BLOCK):
            for b in range(a if same else 0, len(y), BLOCK):
                i, j = x[a : a + BLOCK], y[b : b + BLOCK]
                c = self.sets.common(i, j)
                met = 100 * c >= self.percent * (self.sets.sizes[i][:, None] + self.sets.sizes[j] - c)
                inner = same and a == b
                if inner:
                    np.fill_diagonal(met, False)
                self.linked[i] += np.where(home[i], met @ self.copies[j], 0)
                if not inner:
                    self.linked[j] += np.where(home[j], self.copies[i] @ met, 0)
                r, s = np.nonzero(np.triu(met) if inner else met)
                self.hook(i[r], j[s])

    def between(self, x: np.ndarray, y: np.ndarray, home: np.ndarray) -> None:
        """As blocks(), but without pairs of two documents that are at home elsewhere."""
        hx, ox = x[home[x]], x[~home[x]]
        if x is y:
            self.blocks(hx, hx, home)
            return self.blocks(hx, ox, home)
        self.blocks(hx, y, home)
        self.blocks(ox, y[home[y]], home)

    def all_linked(self, x: np.ndarray, y: np.ndarray, home: np.ndarray) -> None:
        """Counts every pair of x and y as linked, without a comparison."""
        own = self.copies[x] if x is y else 0
        self.linked[x] += np.where(home[x], self.copies[y].sum() - own, 0)
        if x is not y:
            self.linked[y] += np.where(home[y], self.copies[x].sum(), 0)
        self.hook(np.full(len(x) + len(y), x[0]), np.concatenate([x, y]))

    def spheres(self, rows: np.ndarray, home: np.ndarray, d: np.ndarray, pivots: np.ndarray) -> None:
        """Compares all of `rows`, whose distances d from the pivots don't part them into cells.

        Documents within half the reach of a pivot are all linked, by the
        triangle inequality, as are two such spheres that are close enough;
        spheres far enough apart have no link. Other pairs are compared.
        """
        left, groups = np.ones(len(rows), bool), []
        within = d <= self.reach / 2 - 1e-9
        while True:
            count = (within & left[:, None]).sum(0)
            k = int(count.argmax())
            if count[k] < 2:
                break
            own = within[:, k] & left
            groups.append((rows[own], int(pivots[k]), float(d[own, k].max())))
            left &= ~own
        centres = np.array([p for _, p, _ in groups], np.int64)
        far = self.sets.distances(centres, centres) if len(centres) else np.zeros((0, 0))
        loose = rows[left]
        for a, (x, _, rx) in enumerate(groups):
            self.all_linked(x, x, home)
            for b in range(a + 1, len(groups)):
                y, _, ry = groups[b]
                if far[a, b] + rx + ry <= self.reach - 1e-9:
                    self.all_linked(x, y, home)
                elif far[a, b] - rx - ry <= self.reach + 1e-9:
                    self.between(x, y, home)
            self.between(x, loose, home)
        self.between(loose, loose, home)

    def cells(self, rows: np.ndarray, home: np.ndarray, leaf: int, depth: int = 0) -> None:
        """Recursive Voronoi cells with triangle-inequality windows; home: whether a row is in the cell of its nearest pivot."""
        if not home[rows].any():
            return
        if len(rows) <= leaf:
            return self.between(rows, rows, home)
        pivots = rows[np.argsort(mix(rows.astype(np.uint64) + np.uint64(depth << 40)))[: max(4, int(len(rows) ** 0.5) // 4)]]
        d = np.vstack([self.sets.distances(rows[a : a + BLOCK], pivots) for a in range(0, len(rows), BLOCK)])
        inside = d - d.min(1, keepdims=True) <= 2 * self.reach + 1e-9
        if inside.sum() > 1.5 * len(rows) or inside.sum(0).max() > 0.8 * len(rows):
            return self.spheres(rows, home, d, pivots)
        nearest = d.argmin(1)
        for k in range(len(pivots)):
            at = home.copy()
            at[rows] &= nearest == k
            self.cells(rows[inside[:, k]], at, leaf, depth + 1)


def region_links(sets: Sets, percent: int, copies: np.ndarray | None = None, home: np.ndarray | None = None, side: np.ndarray | None = None, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(weight of links, first of the component) of each document of a region.

    copies: the documents' weights; home: those whose links are counted here;
    side: documents of side 1 are compared with those of side 2 alone, those of side 0 with one another.
    """
    n = len(sets.sizes)
    links = Links(sets, np.ones(n, np.int64) if copies is None else copies, percent)
    home = np.ones(n, bool) if home is None else home
    if side is not None and side.any():
        links.between(np.flatnonzero(side == 1), np.flatnonzero(side == 2), home)
    elif n:
        links.cells(np.arange(n), home, leaf)
    return links.linked, links.first


def join_region(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """(doc_id, first, linked) of one region's documents: the first of each component, and the weight of the links counted here."""
    rows = rows.sort_by("doc_id")
    doc, copies = rows.column("doc_id").to_numpy(), rows.column("copies").to_numpy()
    home, side = rows.column("home").to_numpy().astype(bool), rows.column("side").to_numpy() if "side" in rows.column_names else None
    linked, first = region_links(Sets([x.as_buffer() for c in rows.column("shingles").chunks for x in c]), percent, copies, home, side)
    out = (linked > 0) | (doc[first] != doc)
    return pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(doc[first][out]), pa.array(linked[out])], ["doc_id", "first", "linked"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of one region and part as compressed tables, of a batch's rows at most."""
    for batch in batches:
        region, part = batch.column("region").to_numpy(), batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero((region[1:] != region[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                rows, sink = batch.slice(a, b - a).select(["doc_id", "copies", "shingles", "home"]), pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, 1) for c in ("region", "part", "parts")), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["region", "part", "parts", "pack"])
    trim()


def _join_packs(percent: int):
    """As _join_regions, of packed parts in a partition that is sorted by region."""

    def join(packs: list[tuple[int, bytes]]) -> pa.RecordBatch:
        tables = [(side, pa.ipc.open_stream(x).read_all()) for side, x in packs]
        out = join_region(pa.concat_tables([t.append_column("side", pa.array(np.full(len(t), side))) for side, t in tables]), percent)
        trim()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for region, side, pack in zip(*(batch.column(c).to_pylist() for c in ("region", "side", "pack"))):
                if region != last and held:
                    yield join(held)
                    held = []
                last = region
                held.append((side, pack))
        if held:
            yield join(held)

    return run


def _join_regions(percent: int):
    """Regions of a partition that is sorted by region, one at a time; a region may go on over batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            region = batch.column("region").to_numpy()
            cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist(), len(region)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                if held and part.num_rows and held[-1].column("region")[0] != part.column("region")[0]:
                    yield join_region(pa.Table.from_batches(held), percent)
                    held = []
                if part.num_rows:
                    held.append(part)
            trim()
        if held:
            yield join_region(pa.Table.from_batches(held), percent)
        held = []
        trim()

    return run


def _nearest(percent: int):
    """(region, doc_id, cell, nearest): the Voronoi cells, by number, of the pivots that came with each document's region."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for region, part in rows.groupby("region"):
                pivots = part.pivots.iloc[0]
                sets, n = Sets([*part.shingles, *pivots]), len(part)
                d = sets.distances(np.arange(n), n + np.arange(len(pivots)))
                i, k = np.nonzero(d - d.min(1, keepdims=True) <= 2 * (1 - percent / 100) + 1e-9)
                yield pd.DataFrame({"region": region, "doc_id": part.doc_id.to_numpy()[i], "cell": k, "nearest": d.argmin(1)[i] == k})

    return run


def _too_large(members: DataFrame, rows: int, size: int) -> DataFrame:
    n = members.groupBy("region").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    return n.where((F.col("n") > rows) | (F.col("bytes") > size)).select("region", "n", F.greatest(F.ceil(2 * F.col("n") / rows), F.ceil(2 * F.col("bytes") / size)).cast("int").alias("parts"))


def cut_regions(members: DataFrame, percent: int, rows: int = REGION_ROWS, size: int = REGION_BYTES, pivots: int = 16, rounds: int = 8) -> tuple[DataFrame, DataFrame | None, bool]:
    """Distributed Voronoi rounds until no region has more than `rows` documents or `size` bytes of shingles, or cells stop shrinking.

    (members, pairs, whether any region was cut). home: the cell is that of the
    document's nearest pivot, in every round. What stays too large (more
    documents within reach of one another than a task should hold) is dealt
    into parts by hash, and pairs has each two of them as a region with two
    sides. Parts travel packed: documents within reach of one another have most
    shingles in common, so that their sets compress well together.
    """
    members, whole, divided = members.withColumn("home", F.lit(True)), None, False
    for _ in range(rounds):
        over = _too_large(members, rows, size)
        over = small(cut(over if whole is None else over.join(whole, "region", "left_anti")).select("region", "n"), 64)
        if not over.limit(1).count():
            break
        big = members.join(over, "region")
        h = F.xxhash64("doc_id")
        few = big.groupBy("region", F.pmod(h, F.lit(8 * pivots)).alias("draw")).agg(F.min(h).alias("h"), F.min_by("shingles", h).alias("shingles"))
        drawn = few.groupBy("region").agg(F.expr(f"transform(slice(array_sort(collect_list(struct(h, shingles))), 1, {pivots}), x -> x.shingles)").alias("pivots"))
        near = big.select("region", "doc_id", "shingles").join(drawn, "region").mapInPandas(_nearest(percent), "region long, doc_id long, cell long, nearest boolean")
        near = cut(near)
        # distances that don't spread would only multiply the documents: such a region stays whole
        cells = near.groupBy("region", "cell").agg(F.count("*").alias("k")).groupBy("region").agg(F.sum("k").alias("k"), F.max("k").alias("most")).join(over, "region")
        stays = cut(cells.where("k > 1.5 * n or most > 0.8 * n").select("region"))
        whole = stays if whole is None else whole.unionByName(stays)
        parted = big.drop("n").join(near.join(small(stays, 64), "region", "left_anti"), ["region", "doc_id"])
        parted = parted.select(F.xxhash64("region", "cell").alias("region"), "doc_id", "copies", "shingles", (F.col("home") & F.col("nearest")).alias("home"))
        cut_now = over.join(small(stays, 64), "region", "left_anti")
        if not cut_now.limit(1).count():
            break
        members, divided = cut(members.join(cut_now, "region", "left_anti").unionByName(parted)), True
    over = cut(_too_large(members, rows, size).select("region", "parts"))
    if not over.limit(1).count():
        return members, None, divided
    over = small(over, 64)
    dealt = members.join(over, "region").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("parts")).cast("int"))
    packs = cut(dealt.repartition("region", "part").sortWithinPartitions("region", "part").mapInArrow(_pack, "region long, part int, parts int, pack binary"))
    pairs = packs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    region = F.xxhash64("region", F.least("part", "other"), F.greatest("part", "other"))
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
    return members.join(over, "region", "left_anti"), pairs.select(region.alias("region"), side.alias("side"), "pack"), True


def jaccard_join(docs: DataFrame, shingle: int = 5, percent: int = 80, region_rows: int = REGION_ROWS, region_bytes: int = REGION_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row of docs(doc_id, text).

    Two rows link when 100 * |A & B| >= percent * |A | B| for their sets of
    distinct word shingles (lower-cased; fewer words than a shingle: the whole
    sequence). component_id is the smallest doc_id reachable by links, n_links
    the number of other rows linked, copies included. Null, empty and blank
    texts have no shingles, link with nothing and are their own component.
    Rows with a null doc_id are left out. Where rows repeat a doc_id, the
    smallest of their texts is the document's, and it has one row. An empty
    table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    sums = cut(docs.mapInArrow(_summary(shingle), "doc_id long, n_shingles long, f0 long, f1 long"))
    kinds = ["f0", "f1", "n_shingles"]
    full = sums.where("n_shingles > 0")
    groups = cut(full.groupBy(*kinds).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    reps = small(groups.select(F.col("rep").alias("doc_id")), 16)
    ones = docs.join(reps, "doc_id", "left_semi")
    cells = ones.mapInArrow(_cells(shingle, percent), "doc_id long, key long")
    # keys that two documents have, as a document has none twice: counted before the shuffle, so that a crowded key is one row of each task
    shared = cut(cells.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    if shared.count() * 64 > BROADCAST_BYTES:  # both sides of the join are shuffled: few keys that only one document has travel
        bits = docs.sparkSession.sparkContext.broadcast(key_filter(shared, shared.count()))
        cells = ones.mapInArrow(_cells(shingle, percent, bits), "doc_id long, key long")
    met = cut(cells.join(small(shared, 64), "key", "left_semi").select("doc_id", "key"))
    met = cut(distinct_cells(met))
    asked = small(cut(met.select("doc_id").distinct()), 8)
    sketches = cut(docs.join(asked, "doc_id", "left_semi").mapInArrow(_sketches(shingle), "doc_id long, size long, sketch binary"))
    dealt = met.join(small(sketches, 256), "doc_id").repartition("key").sortWithinPartitions("key")
    edges = dealt.mapInArrow(_possible_edges(percent), "first long, doc_id long").distinct()
    regions = cut(connected_components(edges, "first", "doc_id"))
    wanted = regions.join(groups.select(F.col("rep").alias("node"), "copies"), "node").select(F.col("node").alias("doc_id"), F.col("component").alias("region"), "copies")
    wanted = small(cut(wanted), 32)
    members = docs.join(wanted, "doc_id").mapInArrow(_with_sets(shingle), "region long, doc_id long, copies long, shingles binary")
    members, pairs, divided = cut_regions(cut(members), percent, region_rows, region_bytes)
    schema = "doc_id long, first long, linked long"
    found = members.repartition("region").sortWithinPartitions("region").mapInArrow(_join_regions(percent), schema)
    if pairs is not None:
        found = found.unionByName(pairs.repartition("region").sortWithinPartitions("region").mapInArrow(_join_packs(percent), schema))
    found = cut(found)
    counts = found.groupBy(F.col("doc_id").alias("rep")).agg(F.sum("linked").alias("linked"))
    if divided:
        parts = connected_components(found, "doc_id", "first").withColumnRenamed("node", "rep")
    else:
        parts = found.select(F.col("doc_id").alias("rep"), F.col("first").alias("component"))
    named = groups.join(parts, "rep", "left").join(counts, "rep", "left")
    named = cut(named.select(*kinds, F.coalesce("component", "rep").alias("component_id"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = sums.join(small(named, 48), kinds, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
