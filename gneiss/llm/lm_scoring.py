"""Language-model scores: a small causal self-attention model over subword ids, and corpus word counts.

The model predicts CLASSES classes of subword pieces: the most frequent pieces
alone, the others in clusters of pieces that follow alike, with counted shares
inside a class. Classes are in GROUPS groups, and a class's probability is its
group's times its own in the group: two short softmaxes. Logits are those of one attention layer and one
feed-forward layer in numpy, added to two tables counted over the whole
training fold: what follows a frequent piece, directly and with one piece
between. The weights learn by Adam from
all windows of the whole fold, each token of it once: the windows stay in the partitions of their texts, which train side
by side as shards, and the weights are averaged after each of ROUNDS rounds, so that no task holds the fold.

A text is scored in windows of WINDOW inputs, each CONTEXT inputs over the one
before: queries of the new inputs attend to all inputs before them in the
window, so each token is scored once.

A token's probability mixes the model's, the product over its pieces, with
its share (c + 1) / (1.25 N + 1) of the N training tokens, counted over the
whole training fold. Documents are dealt into buckets; each sends the distinct words of its
bucket once, counts are added up by word and come back to the buckets that
have it, where its documents are scored. No word table is ever broadcast.
"""

from __future__ import annotations

import copy
import itertools
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.language_id import fold
from gneiss.llm.text import Texts, Words, mix, slices, small_batches, sum_by
from gneiss.operators.lineage import cut

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
WINDOW, CONTEXT, WIDTH, HIDDEN, GROUPS, MEMBERS, CLUSTERS = 32, 8, 24, 32, 32, 32, 32
CLASSES = GROUPS * MEMBERS
STEP = WINDOW - CONTEXT
#: A vector, the one beside it and zeros; rows that are multiplied at once, weights that are moved at once; the place of each embedding's numbers.
WIDE, CHUNK, AT_ONCE = WIDTH + 8, 512, 1 << 14
_CELLS = np.arange((CLASSES + 1) * WIDTH).reshape(CLASSES + 1, WIDTH)
#: Rounds, windows a step, and in each round a shard sees its part once, or up to MOST_PASSES times to make LEAST_STEPS steps.
ROUNDS, BATCH, LEAST_STEPS, MOST_PASSES = 2, 64, 400, 4
#: Windows of a shard at least, unless there are fewer in all.
SHARD_WINDOWS = 32_768
#: Most sets of weights that the driver gets at once, and cells of a counted table in a row.
MOST_WEIGHTS, ROW_CELLS = 128, 1 << 16
#: Rows of the counted tables: frequent pieces, one for all others, one for what is before a text.
OTHER, BEFORE = 256, 257
#: Windows that are scored at once: their logits, 200 KB, stay in the processor's cache.
TOGETHER = 64
#: Bytes of text in a bucket, and lists of its words that are added up at a time.
BUCKET_BYTES, MERGED = 24 << 20, 8
#: The hash of the end token among words.
END_HASH = np.uint64(0x656E64)
#: The attention model's part of the mixture, and what the mixture's word shares leave to new words, per training token.
SHARE, NEW_WORDS = 0.5, 0.25
#: Slots of a worker's word cache, a power of two, and ids after which it begins anew.
CACHE, MOST_IDS = 1 << 21, 20_000_000


@dataclass
class Vocabulary:
    """Each piece's class, the natural log of its share in the class, and its row in the counted tables; the last id is the end."""

    cls: np.ndarray
    log_share: np.ndarray
    row: np.ndarray

    @classmethod
    def of(cls_, counts: np.ndarray, follows: np.ndarray, rounds: int = 8) -> Vocabulary:
        """follows: how often each piece has each table row before it, as rows of counts beside one another."""
        n = counts + 0.1
        order = np.argsort(-n, kind="stable")
        cls = np.empty(len(n), np.int64)
        singles = CLASSES - CLUSTERS
        cls[order[:singles]] = np.arange(singles)
        tail = order[singles:]
        x = _profile(follows[tail])
        centre = x[:CLUSTERS].copy()
        for _ in range(rounds):
            near = (2 * x @ centre.T - (centre**2).sum(1)).argmax(1)
            for k in np.unique(near):
                own = near == k
                centre[k] = (x[own] * n[tail][own, None]).sum(0) / n[tail][own].sum()
        cls[tail] = singles + near
        # classes that follow alike are neighbours in their first principal component, and groups are neighbours
        by_class = np.zeros((CLASSES, follows.shape[1]))
        np.add.at(by_class, cls, follows)
        x = _profile(by_class)
        u = np.linalg.svd(x - x.mean(0), full_matrices=False)[0][:, 0]
        place = np.empty(CLASSES, np.int64)
        place[np.argsort(u, kind="stable")] = np.arange(CLASSES)
        cls = place[cls]
        return cls_(cls, np.log(n / np.bincount(cls, n, CLASSES)[cls]), table_rows(counts))


def _profile(follows: np.ndarray) -> np.ndarray:
    return np.sqrt(follows / np.maximum(follows.sum(1, keepdims=True), 1)).astype(np.float32)


def table_rows(counts: np.ndarray) -> np.ndarray:
    """The row of each piece in the counted tables."""
    out = np.full(len(counts), OTHER)
    out[np.argsort(-counts - 0.1, kind="stable")[:OTHER]] = np.arange(OTHER)
    return out


def _smoothed(n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shares of counts along the last axis, discounted and filled up by `share`."""
    return (np.maximum(n - 0.75, 0) + (0.75 * (n > 0).sum(-1, keepdims=True) + 1) * share) / (n.sum(-1, keepdims=True) + 1)


class Attention:
    """The model's weights and counted tables; class CLASSES is the start of a text.

    next1 and next2 count how often each class follows a table row, directly and
    with one piece between; row gives the table row of each class.
    """

    def __init__(self, next1: np.ndarray | None = None, next2: np.ndarray | None = None, row: np.ndarray | None = None, seed: int = 1):
        r = np.random.default_rng(seed)
        shape = {"e": (CLASSES + 1, WIDTH), "pos": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH), "w1": (WIDTH, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, WIDTH), "ug": (WIDTH, GROUPS), "uc": (GROUPS, WIDTH, MEMBERS), "bg": (GROUPS,), "bc": (CLASSES,)}
        scale = {"e": 0.3, "pos": 0.3, "ug": 0.1 / np.sqrt(WIDTH), "uc": 0.1 / np.sqrt(WIDTH)}
        self.w = {k: (r.normal(0, scale.get(k, 0.5 / np.sqrt(s[0])), s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
        self.w["bc"] = self.w["bc"].reshape(GROUPS, MEMBERS)
        self.w |= {"a1": np.ones(1, np.float32), "a2": np.full(1, 0.3, np.float32)}
        next1, next2 = (np.zeros((BEFORE + 1, CLASSES)) if n is None else n.astype(float) for n in (next1, next2))
        share = (next1.sum(0) + 0.5).reshape(GROUPS, MEMBERS)
        in_all, in_group = share.sum(1) / share.sum(), share / share.sum(1, keepdims=True)
        parts = [n.reshape(-1, GROUPS, MEMBERS) for n in (next1, next2)]
        self.group = [np.log(_smoothed(parts[0].sum(2), in_all)), np.log(_smoothed(parts[1].sum(2), in_all) / in_all)]
        self.member = [np.log(_smoothed(parts[0], in_group)), np.log(_smoothed(parts[1], in_group) / in_group)]
        self.member = [x.transpose(1, 0, 2) for x in self.member]  # rows of one group are neighbours, as they are looked up group by group
        self.group, self.member = ([np.ascontiguousarray(x, np.float32) for x in y] for y in (self.group, self.member))
        self.row = np.append(np.full(CLASSES, OTHER) if row is None else row, BEFORE)
        self.mask = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)

    def train(self, windows: np.ndarray, steps: int, batch: int = BATCH, rate: float = 0.01, seed: int = 2) -> float:
        """Adam on rows of WINDOW + 2 classes, see training_windows; the last step's mean loss in nats."""
        w = np.concatenate([v.ravel() for v in self.w.values()])  # all weights are views of one array, a copy of what they were
        ends = np.cumsum([v.size for v in self.w.values()]).tolist()
        self.w = {k: w[b - v.size : b].reshape(v.shape) for (k, v), b in zip(self.w.items(), ends)}
        m, s, g = (np.zeros_like(w) for _ in range(3))  # ten times and a hundred times the means of gradients and squares
        loss, r, queue = 0.0, np.random.default_rng(seed), np.zeros(0, np.int64)
        for step in range(1, steps + 1 if len(windows) else 1):
            while len(queue) < batch:
                queue = np.concatenate([queue, r.permutation(len(windows))])
            x, queue = windows[queue[:batch]].astype(np.int64), queue[batch:]
            loss, grad = self._gradients(x[:, :-1], x[:, 2:])
            now = rate * min(1, step / 50) * (1 - step / (steps + 1)) ** 0.5
            np.concatenate([grad[k].ravel() for k in self.w], out=g, casting="same_kind")
            spread = math.sqrt(0.01 / (1 - 0.99**step))
            for a in range(0, len(w), AT_ONCE):  # a part stays in the processor's cache
                w_, m_, s_, g_ = (x[a : a + AT_ONCE] for x in (w, m, s, g))
                m_ *= 0.9
                m_ += g_
                s_ *= 0.99
                s_ += np.multiply(g_, g_, out=g_)
                np.sqrt(s_, out=g_)
                g_ += 1e-8 / spread
                np.divide(m_, g_, out=g_)
                g_ *= 0.1 * now / (1 - 0.9**step) / spread
                w_ -= g_
        return float(loss)

    def _wide(self) -> dict[str, np.ndarray]:
        """The weights for vectors of WIDE numbers: the WIDTH of a vector, a one that takes the biases, zeros.

        One head as wide as the vectors needs its four matrices as two products alone.
        """
        w = self.w
        wide = {"e": _padded(w["e"], len(w["e"])), "pos": _padded(w["pos"], WINDOW), "qk": _padded(w["q"] @ w["k"].T * w["q"].dtype.type(WIDTH**-0.5)), "vo": _padded(w["v"] @ w["o"]), "w2": _padded(w["w2"], HIDDEN)}
        wide["e"][:, WIDTH] = 1
        return wide | {c: _padded(w[c], WIDE, w[c].shape[-1], w[b]) for c, b in (("w1", "b1"), ("ug", "bg"), ("uc", "bc"))}

    def _gradients(self, before: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of the classes y; `before` are the inputs, with one more in front. Classes beyond CLASSES are not there."""
        w, m, kind, size = self.w, self._wide(), self.w["e"].dtype, y.shape[1]
        turned = {c: np.ascontiguousarray(np.swapaxes(m[c], -1, -2)) for c in ("qk", "vo", "w1", "w2", "ug", "uc")}
        flat = lambda x: x.reshape(-1, x.shape[-1])
        tables = [[flat(t).astype(kind, copy=False) for t in x] for x in (self.group, self.member)]
        both, g_both = np.concatenate([w["a1"], w["a2"]]), np.zeros(2)
        before, y = np.minimum(before, CLASSES), y.ravel()
        x, row = np.ascontiguousarray(before[:, 1:]), self.row[before]
        r1, r2 = row[:, 1:].ravel(), row[:, :-1].ravel()
        known = y < CLASSES
        n = max(int(known.sum()), 1)
        part = known.astype(kind) / kind.type(n)
        group, member = np.divmod(np.minimum(y, CLASSES - 1), MEMBERS)
        # beside one another: queries and, on the way back, what comes to a mean; and the slopes of the logits and exp of them
        sides, exps = np.empty((len(x), 2 * size, WIDE), kind), np.empty((len(x), 2 * size, size), kind)
        e = m["e"].take(x, 0)
        e += m["pos"]
        keys = np.ascontiguousarray(e.transpose(0, 2, 1))
        np.matmul(e, m["qk"], out=sides[:, :size])
        c, total = _attended(sides[:, :size] @ keys, self.mask, e, exps[:, size:])
        h = _times(c, m["vo"])
        h += flat(e)
        z = _times(h, m["w1"])
        np.maximum(z, 0, out=z)
        f = _times(z, m["w2"])
        f += h
        dg, share = _slopes(_times(f, m["ug"]), tables[0], (r1, r2), both, group, part, g_both)
        loss = np.log(share[known] + 1e-12).sum()
        at = np.flatnonzero(known)
        order, parts = _sorted(group[at])
        at = at[order]  # the known classes, group by group
        fk, own, first = f.take(at, 0), np.empty((len(at), MEMBERS), kind), group[at] * (BEFORE + 1)
        for j, rows in parts:
            np.matmul(fk[rows], m["uc"][j], out=own[rows])
        dm, share = _slopes(own, tables[1], (first + r1[at], first + r2[at]), both, member[at], part[at], g_both)
        loss += np.log(share + 1e-12).sum()
        g_uc, dk = np.zeros_like(m["uc"]), np.zeros((len(at) + 1, WIDE), kind)
        for j, rows in parts:
            np.matmul(fk[rows].T, dm[rows], out=g_uc[j])
            np.matmul(dm[rows], turned["uc"][j], out=dk[rows])
        back = np.full(len(y), len(at))
        back[at] = np.arange(len(at))
        dh = _times(dg, turned["ug"])
        dh += dk.take(back, 0)
        dz = _times(dh, turned["w2"])
        dz *= z > 0
        g_w2, g_w1, g_ug = _crossed(z, dh), _crossed(h, dz), _crossed(f, dg)
        dh += _times(dz, turned["w1"])
        dc = sides[:, size:]
        np.divide(_times(dh, turned["vo"]).reshape(e.shape), total.reshape(len(x), size, 1), out=dc)
        dc[:, :, WIDTH] = -np.einsum("bij,bij->bi", dc, c.reshape(e.shape))  # times the ones of the keys: the mean slope
        np.multiply(dc @ keys, exps[:, size:], out=exps[:, :size])
        du = flat(exps[:, :size] @ e)
        de = exps.transpose(0, 2, 1) @ sides
        de += _times(du, turned["qk"]).reshape(e.shape)
        de += dh.reshape(e.shape)
        de = de[:, :, :WIDTH]
        g_qk, g_vo = _crossed(flat(e), du)[:WIDTH, :WIDTH] * kind.type(WIDTH**-0.5), _crossed(c, dh)[:WIDTH, :WIDTH]
        g = {"q": g_qk @ w["k"], "k": g_qk.T @ w["q"], "v": g_vo @ w["o"].T, "o": w["v"].T @ g_vo, "w2": g_w2[:, :WIDTH], "a1": g_both[:1], "a2": g_both[1:], "pos": de.sum(0)}
        for c_, b, both_ in (("w1", "b1", g_w1), ("ug", "bg", g_ug), ("uc", "bc", g_uc)):
            g[c_], g[b] = both_[..., :WIDTH, :], both_[..., WIDTH, :]
        g["e"] = np.bincount(_CELLS.take(x, 0).ravel(), de.ravel(), _CELLS.size).reshape(_CELLS.shape)
        return -float(loss) / n, g

    def log_probs(self, stream: np.ndarray, ptr: np.ndarray) -> np.ndarray:
        """Natural logs of the probability of each class of the texts stream[ptr[i]:ptr[i + 1]]."""
        # inputs are each text's start and all classes but its last; the new inputs of windows follow one another
        n, w = np.diff(ptr), self.w
        scaled = lambda tables: [w[c] * t.reshape(-1, t.shape[-1]) for c, t in zip(("a1", "a2"), tables)]
        self.once = self._wide() | {"group": scaled(self.group), "member": scaled(self.member)}
        blocks = -(-n // STEP)
        owner = np.repeat(np.arange(len(n)), blocks)
        number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        out = np.zeros(len(stream), np.float32)
        for a in range(0, len(owner), TOGETHER):
            o, k = owner[a : a + TOGETHER], number[a : a + TOGETHER]
            at = (k * STEP - CONTEXT)[:, None] + np.arange(WINDOW)  # place of each input in its text; -1 of it is the class before
            place = ptr[o][:, None] + at
            x = np.where(at > 0, stream[np.clip(place - 1, 0, len(stream) - 1)], CLASSES)
            target = place[:, CONTEXT:]
            inside = at[:, CONTEXT:] < n[o][:, None]
            y = stream[np.minimum(target, len(stream) - 1)]
            out[target[inside]] = self._scores(x, y, at < 0)[inside]
        return out

    def _scores(self, x: np.ndarray, y: np.ndarray, absent: np.ndarray) -> np.ndarray:
        """Masked attention of each window's new inputs over all of it; absent inputs are never attended to."""
        once = self.once
        e = once["e"].take(x, 0)
        e += once["pos"]
        late = e[:, CONTEXT:].reshape(-1, WIDE)
        s = _times(late, once["qk"]).reshape(len(x), STEP, WIDE) @ np.ascontiguousarray(e.transpose(0, 2, 1))
        begin = np.flatnonzero(absent[:, 0])  # only a text's first window reaches before it
        s[begin] += np.where(absent[begin], np.float32(-1e9), np.float32(0))[:, None, :]
        h = _times(_attended(s, self.mask[CONTEXT:], e)[0], once["vo"])
        h += late
        z = _times(h, once["w1"])
        f = _times(np.maximum(z, 0, out=z), once["w2"])
        f += h
        r1, r2 = self.row[x[:, CONTEXT:].ravel()], self.row[x[:, CONTEXT - 1 : -1].ravel()]
        group, member = np.divmod(y.ravel(), MEMBERS)
        order, parts = _sorted(group)
        rows, own = f.take(order, 0), np.empty((len(f), MEMBERS), f.dtype)
        for k, part in parts:
            np.matmul(rows[part], once["uc"][k], out=own[part])
        at = group[order] * (BEFORE + 1)
        out = np.empty(len(f), np.float32)
        out[order] = self._log_share(own, once["member"], (at + r1[order], at + r2[order]), member[order])
        out += self._log_share(_times(f, once["ug"]), once["group"], (r1, r2), group)
        return out.reshape(len(x), STEP)

    @staticmethod
    def _log_share(logits: np.ndarray, tables: list[np.ndarray], rows: tuple[np.ndarray, np.ndarray], right: np.ndarray) -> np.ndarray:
        for table, row in zip(tables, rows):
            logits += table.take(row, 0)
        _, total, top = _exp(logits)
        return logits[np.arange(len(right)), right] - top - np.log(total)


def _sorted(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The rows in the order of their groups, and where each group that occurs is in it."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=GROUPS))]).tolist()
    return order, [(k, slice(a, b)) for k, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp of x, its row sums, and the row maxima that were taken off before: none unless a sum would overflow or vanish."""
    out = np.exp(x)
    total = out @ np.ones(x.shape[-1], x.dtype)
    if _in_range(total):
        return out, total, 0.0
    top = x.max(-1)
    out = np.exp(x - top[..., None])
    return out, out.sum(-1), top


def _in_range(total: np.ndarray) -> bool:
    return total.max(initial=1) < 1e30 and total.min(initial=1) > 1e-30  # false as well if one is NaN


def _attended(s: np.ndarray, mask: np.ndarray, e: np.ndarray, exps: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Means of the rows e by exp of the logits s, and the sums of those, which the rows' ones give; exps gets exp."""
    s += mask
    exps = np.exp(s, out=exps)
    c = (exps @ e).reshape(-1, WIDE)
    if not _in_range(c[:, WIDTH]):
        c = (np.exp(s - s.max(-1, keepdims=True), out=exps) @ e).reshape(-1, WIDE)
    total = c[:, WIDTH].copy()
    c /= total[:, None]
    return c, total


def _slopes(logits: np.ndarray, tables: list[np.ndarray], rows: tuple[np.ndarray, np.ndarray], both: np.ndarray, right: np.ndarray, part: np.ndarray, g_both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The loss's slopes by logits that get the tables' rows times `both`, whose own slopes g_both gets; and the right ones' shares.

    part: of the loss that is each row's.
    """
    counted = np.empty((2, *logits.shape), logits.dtype)
    for table, row, out in zip(tables, rows, counted):
        table.take(row, 0, out=out, mode="clip")
    counted = counted.reshape(2, -1)
    logits += (both @ counted).reshape(logits.shape)
    d, total, _ = _exp(logits)
    flat, at = d.reshape(-1), np.arange(0, d.size, d.shape[1]) + right
    share = flat[at] / total
    d *= (part / total)[:, None]
    flat[at] -= part
    g_both += counted @ flat
    return d, share


def _padded(x: np.ndarray, rows: int = WIDE, columns: int = WIDE, bias: np.ndarray | None = None) -> np.ndarray:
    """Matrices with zeros below and beside them, and the bias in the row that meets the vectors' one."""
    out = np.zeros((*x.shape[:-2], rows, columns), x.dtype)
    out[..., : x.shape[-2], : x.shape[-1]] = x
    if bias is not None:
        out[..., WIDTH, :] = bias
    return out


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w in parts of CHUNK rows, which the library multiplies without copying them first."""
    out, m = np.empty((len(x), w.shape[1]), x.dtype), len(x) // CHUNK * CHUNK
    np.matmul(x[:m].reshape(-1, CHUNK, x.shape[1]), w, out=out[:m].reshape(-1, CHUNK, w.shape[1]))
    np.matmul(x[m:], w, out=out[m:])
    return out


def _crossed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x.T @ y, likewise."""
    m = len(x) // CHUNK * CHUNK
    out = (x[:m].reshape(-1, CHUNK, x.shape[1]).transpose(0, 2, 1) @ y[:m].reshape(-1, CHUNK, y.shape[1])).sum(0)
    return out + x[m:].T @ y[m:] if m < len(x) else out


class Subwords:
    """Piece ids of words. Each slot of the cache has the last word of its hash; others are encoded again."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end = self.model.get_piece_size()
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.start, self.n = np.zeros(CACHE, np.uint64), np.zeros(CACHE, np.int32), np.zeros(CACHE, np.int32)
        self.ids, self.used = np.zeros(1 << 20, np.int32), 0

    def of_words(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and each word's number of ids."""
        slot = (hashes & np.uint64(CACHE - 1)).astype(np.int64)
        start, k = self.start[slot], self.n[slot]
        miss = np.flatnonzero((self.hashes[slot] != hashes) | (k == 0))
        if len(miss):
            keys, first, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            raw, at = words.texts.data.tobytes(), miss[first]
            found = self.model.encode([raw[a:b].decode() for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())])
            n = np.array([len(x) for x in found], np.int32)
            if self.used + n.sum() > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), int(n.sum())), np.int32)])
            begin = (self.used + np.cumsum(n) - n).astype(np.int32)
            self.ids[self.used : self.used + n.sum()] = np.fromiter((i for x in found for i in x), np.int32, n.sum())
            self.used += int(n.sum())
            start[miss], k[miss] = begin[back], n[back]
            at = (keys & np.uint64(CACHE - 1)).astype(np.int64)
            self.hashes[at], self.start[at], self.n[at] = keys, begin, n
        k = k.astype(np.int64)
        ids = self.ids[np.repeat(start - (np.cumsum(k) - k), k) + np.arange(k.sum())].astype(np.int64)
        if self.used > MOST_IDS:
            self._clear()
        return ids, k


#: A worker's tokenizer and cache, kept over its tasks.
_kept: dict[int, Subwords] = {}


def kept_subwords(model: bytes) -> Subwords:
    key = hash(model)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Subwords(model)
    return _kept[key]


def token_stream(words: Words, hashes: np.ndarray, subwords: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text's words and its end; and the pointer of the texts' tokens (words, then the end) into them."""
    ids, k = subwords.of_words(words, hashes)
    token_ptr = words.ptr + np.arange(len(words.ptr))  # texts' pointer into tokens
    sizes = np.ones(token_ptr[-1], np.int64)
    is_word = np.ones(token_ptr[-1], bool)
    is_word[token_ptr[1:] - 1] = False
    sizes[is_word] = k
    ptr = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(ptr[-1], subwords.end, np.int64)
    out[np.repeat(is_word, sizes)] = ids
    return out, ptr


@dataclass
class Model:
    """All that scoring a bucket needs besides its words' counts."""

    tokenizer: bytes
    vocabulary: Vocabulary
    attention: Attention
    train_tokens: int

    def score(self, texts: Texts, subwords: Subwords, known: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Token counts, sums of log10(c + 1) and log10 probabilities of each text; known: sorted hashes, counts: theirs."""
        words = texts.lower().words()
        hashes = words.hashes()
        ids, ptr = token_stream(words, hashes, subwords)
        token_ptr = words.ptr + np.arange(len(words.ptr))
        all_ = np.full(token_ptr[-1], END_HASH)
        is_word = np.ones(len(all_), bool)
        is_word[token_ptr[1:] - 1] = False
        all_[is_word] = hashes
        at = np.minimum(np.searchsorted(known, all_), max(len(known) - 1, 0))
        c = np.where(known[at] == all_, counts[at], 0) if len(known) else np.zeros(len(all_), np.int64)
        text_ptr = ptr[token_ptr]
        neural = self.attention.log_probs(self.vocabulary.cls[ids], text_ptr).astype(np.float64) + self.vocabulary.log_share[ids]
        by_token = sum_by(ptr, neural)
        both = np.logaddexp(np.log(SHARE) + by_token, np.log((1 - SHARE) * (c + 1) / ((1 + NEW_WORDS) * self.train_tokens + 1)))
        return {
            "n_tokens": np.diff(token_ptr),
            "n_known": sum_by(token_ptr, (c > 0).astype(np.int64)),
            "log_counts": sum_by(token_ptr, np.log10(c + 1.0)),
            "model_score": sum_by(token_ptr, by_token / np.log(10)),
            "score": sum_by(token_ptr, both / np.log(10)),
        }


def training_windows(ids: np.ndarray, ptr: np.ndarray, turn: np.ndarray, every: int, outside: int) -> np.ndarray:
    """Rows of WINDOW + 2 ids of the texts ids[ptr[i]:ptr[i + 1]]: a window's inputs, one before them and one after.

    Of a text's windows one in `every` is taken, from its turn on. What lies before a text is `outside`, after it one more.
    """
    n = np.diff(ptr)
    blocks = -(-n // WINDOW)
    owner = np.repeat(np.arange(len(n)), blocks)
    number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    taken = (number + turn[owner]) % every == 0
    owner, number = owner[taken], number[taken]
    at = (number * WINDOW - 2)[:, None] + np.arange(WINDOW + 2)
    out = ids[np.clip(ptr[owner][:, None] + at, 0, max(len(ids) - 1, 0))] if len(ids) else np.zeros(at.shape, np.int64)
    return np.where(at < 0, outside, np.where(at >= n[owner][:, None], outside + 1, out)).astype(np.uint16)


def _streams(batches: Iterator[pa.RecordBatch], subwords: Subwords) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """(words, piece ids, pointer of the texts into them) of the training texts, slice by slice."""
    for batch in batches:
        for _, texts in slices(batch.filter(batch.column("train"))):
            words = texts.lower().words()
            ids, ptr = token_stream(words, words.hashes(), subwords)
            yield words, ids, ptr[words.ptr + np.arange(len(words.ptr))]


def _count_pieces(model):
    """(piece, n): how often the training texts have each piece; -1: their tokens. Each distinct word of a slice is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = kept_subwords(model.value)
        counts, tokens = np.zeros(subwords.end + 1), 0
        for batch in batches:
            for _, texts in slices(batch.filter(batch.column("train"))):
                words = texts.lower().words()
                keys, first, times = np.unique(words.hashes(), return_index=True, return_counts=True)
                ids, k = subwords.of_words(Words(words.texts, words.starts[first], words.ends[first], words.ptr), keys)
                counts += np.bincount(ids, np.repeat(times, k), len(counts))
                counts[subwords.end] += len(texts)
                tokens += len(words.starts) + len(texts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, at)), pa.array(np.append(tokens, counts[at].astype(np.int64)))], ["piece", "n"])

    return run


_FOLLOWS = "kind int, key long, n long, windows binary, cells array<int>, times array<int>"


def _count_follows(model, table_row):
    """Rows of _FOLLOWS: kinds 1 and 2 count pieces after a table row by cell, kind 0 are n training windows of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = kept_subwords(model.value)
        pieces = subwords.end + 1
        tables = [np.zeros((BEFORE + 1) * pieces, np.int32) for _ in range(2)]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        row_of = lambda *values: pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, kinds)], ["kind", "key", "n", "windows", "cells", "times"])
        for _, ids, ptr in _streams(batches, subwords):
            row = table_row.value[ids]
            for back, table in enumerate(tables, 1):
                before = np.full(len(ids), BEFORE)
                before[back:] = row[:-back]
                for k in range(back):
                    first = ptr[:-1] + k
                    before[first[first < ptr[1:]]] = BEFORE
                cells, n = np.unique((before * pieces + ids).astype(np.uint32), return_counts=True)
                table[cells] += n.astype(np.int32)
            windows = training_windows(ids, ptr, np.zeros(len(ptr) - 1, np.int64), 1, subwords.end + 1)
            if len(windows):
                key = int(mix(np.array([np.bitwise_xor.reduce(windows.astype(np.uint64).ravel() * np.arange(1, windows.size + 1, dtype=np.uint64))]))[0] >> np.uint64(1))
                yield row_of(0, key, len(windows), windows.tobytes(), None, None)
        for kind, table in enumerate(tables, 1):
            at = np.flatnonzero(table)
            for a in range(0, len(at), ROW_CELLS):
                part = at[a : a + ROW_CELLS]
                yield row_of(kind, a, len(part), None, part.astype(np.int32), table[part])

    return run


def _train_shard(attention, classes, round_: int):
    """(n, weights): the weights after the round's part of a shard's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.append(classes.value, [CLASSES, CLASSES + 1]).astype(np.uint16)
        found = {}  # key and windows; the keys put them in an order that reruns have too
        for batch in batches:
            for key, blob in zip(batch.column("key").to_pylist(), batch.column("windows")):
                rows = np.frombuffer(blob.as_buffer(), np.uint16).reshape(-1, WINDOW + 2)
                found.setdefault((key, len(rows)), []).append(known[rows[(round_ + key) % ROUNDS :: ROUNDS]])
        rows = [x for _, same in sorted(found.items()) for x in same]
        if sum(map(len, rows)):
            found.clear()
            rows = np.concatenate(rows)
            model = copy.copy(attention.value)  # a worker keeps the value for its next shard, which begins where this one did
            once = -(-len(rows) // BATCH)
            model.train(rows, max(once, min(LEAST_STEPS, MOST_PASSES * once)), seed=round_)
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64()), pa.array([pickle.dumps(model.w)], pa.binary())], ["n", "weights"])

    return run


def _mean_weights(parts: list[tuple[bytes, int]]) -> dict[str, np.ndarray]:
    """The mean of pickled weights by their numbers of windows, whatever their order."""
    total, mean = sum(m for _, m in parts), {}
    for blob, m in sorted(parts):
        for c, x in pickle.loads(blob).items():
            mean[c] = mean.get(c, 0.0) + x.astype(np.float64) * (m / total)
    return mean


def _add_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [x for batch in batches for x in zip(batch.column("weights").to_pylist(), batch.column("n").to_pylist())]
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([sum(m for _, m in parts)], pa.int64()), pa.array([pickle.dumps(_mean_weights(parts))], pa.binary())], ["n", "weights"])


def fit(rows: DataFrame, counts: np.ndarray, model) -> tuple[Vocabulary, Attention]:
    """Classes and attention model of the training texts of rows(text, train), whose pieces have these counts.

    Each window of each training text is learned from in one of the rounds. The
    driver gets the two tables, at most 2 * (BEFORE + 1) cells a piece, and at
    most MOST_WEIGHTS sets of weights a round.
    """
    sc, pieces = rows.sparkSession.sparkContext, len(counts)
    found = cut(rows.mapInArrow(_count_follows(model, sc.broadcast(table_rows(counts))), _FOLLOWS))
    tables = np.zeros((2, (BEFORE + 1) * pieces), np.float32)
    for kind in (1, 2):
        cells = found.where(F.col("kind") == kind).select(F.explode(F.arrays_zip("cells", "times")).alias("x")).groupBy("x.cells").agg(F.sum("x.times").alias("n")).toArrow()
        tables[kind - 1, cells.column("cells").to_numpy()] = cells.column("n").to_numpy()
    tables = tables.reshape(2, BEFORE + 1, pieces)
    vocabulary = Vocabulary.of(counts, np.concatenate(tables).T)
    by_class = np.zeros((2, BEFORE + 1, CLASSES))
    for k, row in itertools.product(range(2), range(BEFORE + 1)):
        by_class[k, row] = np.bincount(vocabulary.cls, tables[k, row], CLASSES)
    row = np.full(CLASSES, OTHER)
    row[vocabulary.cls[vocabulary.row < OTHER]] = vocabulary.row[vocabulary.row < OTHER]  # such pieces are classes of their own
    attention, classes = Attention(*by_class, row), sc.broadcast(vocabulary.cls)
    windows = found.where("kind = 0").select("key", "n", "windows")
    n = windows.agg(F.sum("n")).head()[0] or 0
    parts, shards = windows.rdd.getNumPartitions(), max(n // SHARD_WINDOWS, 1)
    if shards < parts:  # partitions of few windows are put together, the others train where they are
        windows, parts = windows.repartition(shards, "key"), shards
    for k in range(ROUNDS if n else 0):
        trained = windows.select("key", "windows").mapInArrow(_train_shard(sc.broadcast(attention), classes, k), "n long, weights binary")
        if parts > MOST_WEIGHTS:
            trained = trained.repartition(MOST_WEIGHTS, F.xxhash64("weights")).mapInArrow(_add_weights, "n long, weights binary")
        weights = _mean_weights([(r.weights, r.n) for r in trained.collect()])
        attention.w = {c: x.astype(np.float32) for c, x in weights.items()} or attention.w
    return vocabulary, attention


def _added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of lists of them, with the sums of their numbers."""
    keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in found])).astype(np.int64)


def _bucket_words():
    """(bucket, hash, n): the distinct words of each bucket with their number in training texts, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for part, texts in slices(batch):
                words = texts.lower().words()
                train = part.column("train").to_numpy(zero_copy_only=False)
                owner = np.concatenate([words.text_of(), np.arange(len(texts))])
                h = np.concatenate([words.hashes(), np.full(len(texts), END_HASH)])
                bucket = part.column("bucket").to_numpy()
                for b in np.unique(bucket):
                    own = (bucket == b)[owner]
                    keys, back = np.unique(h[own], return_inverse=True)
                    n = np.bincount(back, train[owner[own]], len(keys)).astype(np.int64)
                    seen.setdefault(b, []).append((keys, n))
                    if len(seen[b]) == MERGED:
                        seen[b] = [_added(seen[b])]
        for b, found in seen.items():
            keys, n = _added(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), b, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], ["bucket", "hash", "n"])

    return run


def lm_scores(docs: DataFrame, folds: int = 7, held: int = 2, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, model_score and score of every row of docs(doc_id, text).

    Tokens are lower-cased words and one end; a null or blank text has its end
    alone. Counts and model come from rows outside of the held fold; null
    doc_ids are not held out. base_score: the sum of log10((c + 1) / (N + V + 1))
    over tokens; model_score: the attention model's log10 probability of the
    text alone; score: that of the mixture. Equal rows get equal scores. Other
    columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    held_out = fold(F.col("doc_id"), folds) == held
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (~held_out).alias("train"))
    with open(tokenizer, "rb") as f:
        subword_model = f.read()
    shared = spark.sparkContext.broadcast(subword_model)
    pieces = {r.piece: r.n for r in rows.mapInArrow(_count_pieces(shared), "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    train_tokens = pieces.pop(-1, 0)
    counts = np.zeros(Subwords(subword_model).end + 1)
    counts[list(pieces)] = list(pieces.values())
    vocabulary, attention = fit(rows, counts, shared)
    model = spark.sparkContext.broadcast(Model(subword_model, vocabulary, attention, train_tokens))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    # three partitions a bucket keep most buckets apart; both sides of the cogroup are dealt alike
    deal = lambda df: df.repartition(3 * buckets, "bucket")
    dealt = deal(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")))
    words = dealt.mapInArrow(_bucket_words(), "bucket int, hash long, n long")
    # a word has one row for each bucket at most
    counted = deal(words.selectExpr("bucket", "hash", "sum(n) over (partition by hash) as c", "row_number() over (partition by hash order by bucket) = 1 as first"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        m: Model = model.value
        subwords = kept_subwords(m.tokenizer)
        hashes, c = right.column("hash").to_numpy().view(np.uint64), right.column("c").to_numpy()
        new = int((right.column("first").to_numpy() & (c > 0)).sum())
        order = np.argsort(hashes)
        hashes, c = hashes[order], c[order]
        out = []
        for batch in left.to_batches():
            for part, texts in slices(batch):
                s = m.score(texts, subwords, hashes, c)
                types = np.zeros(len(texts), np.int64)
                types[:1], new = new, 0
                out.append(pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("train"), *map(pa.array, s.values()), pa.array(types)], ["doc_id", "train", *s, "types"]))
        return pa.Table.from_batches(out)

    scored = dealt.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(run, f"doc_id {kind}, train boolean, n_tokens long, n_known long, log_counts double, model_score double, score double, types long")
    scored = cut(scored)
    types = scored.agg(F.sum("types")).head()[0] or 0
    base = F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(train_tokens + types + 1)))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "model_score", "score")
