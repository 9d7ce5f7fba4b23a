"""Interpolated modified Kneser-Ney models over hashed symbols, several models in one set of sorted arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from plover.llm.common import mix

START, END, RARE = np.uint64(1), np.uint64(2), np.uint64(3)  # RARE: all words outside a bounded vocabulary
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
SYMBOL_BITS = 21  # of a numbered symbol: three of them are one long


def padded(symbol: np.ndarray, row: np.ndarray, rows: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' symbols in one sequence, each row with ``order - 1`` starts before and an end after; owner row (-1: start)."""
    count = np.bincount(row, minlength=rows)
    size = count + order
    base = np.cumsum(size) - size
    seq = np.full(int(size.sum()), START, np.uint64)
    owner = np.repeat(np.arange(rows), size)
    first = np.cumsum(count) - count
    seq[base[row] + order - 1 + np.arange(len(row)) - first[row]] = symbol
    seq[base + size - 1] = END
    inside = np.arange(len(seq)) - np.repeat(base, size)
    owner[inside < order - 1] = -1
    return seq, owner


def gram_hashes(seq: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each place, for n = 1 .. order (a gram's prefix is the shorter gram one place before)."""
    own = mix(seq * _STEP + np.uint64(7))
    out = [own]
    for _ in range(1, order):
        before = np.zeros(len(seq), np.uint64)
        before[1:] = out[-1][:-1]
        out.append(mix(before * _STEP + own))
    return out


def _shift(h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), np.uint64)
    out[1:] = h[:-1]
    return out


def gram_counts(seq: np.ndarray, owner: np.ndarray, order: int) -> list[tuple]:
    """Per n: distinct grams as (key, context key, suffix key, raw count); starts are contexts only."""
    hashes = gram_hashes(seq, order)
    real = owner >= 0
    zero = np.zeros(len(seq), np.uint64)
    out = []
    for n in range(order):
        key, at, count = np.unique(hashes[n][real], return_index=True, return_counts=True)
        context = (_shift(hashes[n - 1]) if n else zero)[real][at]
        suffix = (hashes[n - 1] if n else zero)[real][at]
        out.append((key, context, suffix, count))
    return out


SHARD = 1 << 16  # keys of one shard of a table: what a cache holds


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted hash in the sorted keys, and whether it is there.

    Large tables are joined shard by shard: the wanted hashes are sorted once and
    each run of them meets only its own range of keys.
    """
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    if len(keys) <= SHARD or len(wanted) < SHARD:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted
    order = np.argsort(wanted)
    ordered, place = wanted[order], np.empty(len(wanted), np.int64)
    edges = np.searchsorted(ordered, keys[SHARD::SHARD])
    for s, (lo, hi) in enumerate(zip([0, *edges], [*edges, len(ordered)], strict=True)):
        place[lo:hi] = np.searchsorted(keys[s * SHARD:(s + 1) * SHARD], ordered[lo:hi]) + s * SHARD
    at = np.empty(len(wanted), np.int64)
    at[order] = np.minimum(place, len(keys) - 1)
    return at, keys[at] == wanted


def _discounts(count: np.ndarray) -> np.ndarray:
    return discounts([int((count == k).sum()) for k in range(1, 5)])


def discounts(times: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more, from the numbers of grams counted 1, 2, 3, 4 times;
    safe when some are missing."""
    n = [max(x, 1) for x in times]
    y = n[0] / (n[0] + 2 * n[1])
    d = [0.0, *(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))]
    return np.array([0.0, *(min(max(x, 0.1), k - 0.1) for k, x in zip((1, 2, 3), d[1:], strict=True))])


class KneserNey:
    """Several models (columns) over the union of their grams; ``counts`` has one ``gram_counts`` result per model.

    Order n holds sorted keys, probabilities of the gram and back-off weights of the
    gram as a context.
    """

    def __init__(self, counts: list[list[tuple]], order: int):
        self.order, self.models = order, len(counts)
        tables = []
        for grams in counts:
            levels = []
            for n in range(order):
                key, context, suffix, count = grams[n]
                if n + 1 < order:  # lower orders count the distinct symbols before a gram
                    above = np.sort(grams[n + 1][2])
                    seen = np.searchsorted(above, key, "right") - np.searchsorted(above, key, "left")
                    count = np.maximum(seen, 1)
                d = _discounts(count)
                by, inverse = np.unique(context, return_inverse=True)
                total = np.bincount(inverse, weights=count)
                taken = np.bincount(inverse, weights=d[np.minimum(count, 3)])
                levels.append((key, context, suffix, (count - d[np.minimum(count, 3)]) / total[inverse], by, taken / total))
            tables.append(levels)
        self.keys, self.seen, self.prob, self.back = [], [], [], []
        self.root = np.ones(self.models)
        for m, levels in enumerate(tables):
            if len(levels[0][5]):
                self.root[m] = levels[0][5][0]
        vocabulary = np.unique(np.concatenate([t[0][0] for t in tables])) if tables else np.zeros(0, np.uint64)
        self.floor = self.root / (len(vocabulary) + 1)
        for n in range(order):
            grams = [t[n] for t in tables]
            contexts = [t[n + 1][4] for t in tables] if n + 1 < order else []
            keys = np.unique(np.concatenate([g[0] for g in grams] + contexts))
            seen, part = np.zeros(len(keys), bool), np.zeros((len(keys), self.models))
            back = np.ones((len(keys), self.models))
            context, suffix = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
            for m, (key, ctx, suf, alpha, _, _) in enumerate(grams):
                at = np.searchsorted(keys, key)
                seen[at], part[at, m], context[at], suffix[at] = True, alpha, ctx, suf
                if n + 1 < order:
                    at = np.searchsorted(keys, tables[m][n + 1][4])
                    back[at, m] = tables[m][n + 1][5]
            if n == 0:
                prob = part + self.floor
            else:
                c, has = _find(self.keys[-1], context)
                s, _ = _find(self.keys[-1], suffix)
                weight = np.where(has[:, None], self.back[-1][c], 1.0) if len(keys) else part
                prob = part + weight * self.prob[-1][s] if len(keys) else part
            self.keys.append(keys)
            self.seen.append(seen)
            self.prob.append(prob)
            self.back.append(back)
        self.log_prob = [np.log(np.maximum(p, 1e-300)).astype(np.float32) for p in self.prob]
        self.log_back = [np.log(np.maximum(b, 1e-300)).astype(np.float32) for b in self.back]
        del self.prob, self.back

    @classmethod
    def pruned(cls, symbols: np.ndarray, one: np.ndarray, two: tuple, three: tuple, total: np.ndarray, texts: int,
               least: tuple[int, int], discount: list[np.ndarray]) -> KneserNey:
        """One trigram model whose grams are numbered symbols, packed by ``SYMBOL_BITS``, with only the grams counted often enough.

        ``one``: count of each symbol (distinct symbols before it); ``two``: packed bigrams, their counts (distinct symbols
        before them) and occurrences; ``three``: packed bigrams, the symbols before them, occurrences; ``total``: sum of the
        counts of all bigrams that start with a symbol, those that were left out included.  Bigrams counted under ``least[0]``
        stand for themselves as a context or suffix only.  ``discount`` comes from the counts of all grams, and what the left
        out ones held goes to the back-off weight, so the model still sums to one.
        """
        mask = (1 << SYMBOL_BITS) - 1
        own = mix(symbols * _STEP + np.uint64(7))
        d = [discount[n][np.minimum(c, 3)] for n, c in enumerate((one, two[1], three[2]))]
        seen = one > 0
        root = d[0].sum() / max(one.sum(), 1) if seen.any() else 1.0
        floor = root / (seen.sum() + (0 if seen[int(RARE)] else 1))
        prob1 = np.where(seen, (one - d[0]) / max(one.sum(), 1), 0.0) + floor
        order = np.argsort(two[0])
        pair, count, times, taken = (x[order] for x in (*two, d[1]))
        v, w = pair >> SYMBOL_BITS, pair & mask
        alpha = np.where(count >= least[0], (count - taken) / total[v], 0.0)
        back1 = 1 - np.bincount(v, weights=alpha, minlength=len(symbols))
        prob2 = alpha + back1[v] * prob1[w]
        start = int(START) << SYMBOL_BITS | int(START)  # a context only; sorts before every bigram
        pair, times = np.concatenate([[start], pair]), np.concatenate([[texts], times])
        prob2, v, w = np.concatenate([[1.0], prob2]), np.concatenate([[int(START)], v]), np.concatenate([[int(START)], w])
        suffix = np.searchsorted(pair, three[0])
        context = np.searchsorted(pair, three[1] << SYMBOL_BITS | three[0] >> SYMBOL_BITS)
        alpha = (three[2] - d[2]) / times[context]
        back2 = 1 - np.bincount(context, weights=alpha, minlength=len(pair))
        prob3 = alpha + back2[context] * prob2[suffix]
        key2 = mix(own[v] * _STEP + own[w])
        key3 = mix(key2[context] * _STEP + own[three[0] & mask])
        out = cls.__new__(cls)
        out.order, out.models, out.root, out.floor = 3, 1, np.array([root]), np.array([floor])
        out.keys, out.seen, out.log_prob, out.log_back = [], [], [], []
        for key, known, prob, back in ((own, seen, prob1, back1), (key2, pair != start, prob2, back2),
                                       (key3, np.ones(len(key3), bool), prob3, np.ones(len(key3)))):
            order = np.argsort(key)
            out.keys.append(key[order])
            out.seen.append(known[order])
            for to, x in ((out.log_prob, prob), (out.log_back, back)):
                to.append(np.log(np.maximum(x[order], 1e-300)).astype(np.float32)[:, None])
        return out

    def knows(self, symbol: np.ndarray) -> np.ndarray:
        """Whether each symbol is in the vocabulary."""
        at, hit = _find(self.keys[0], mix(symbol * _STEP + np.uint64(7)))
        return hit & self.seen[0][at] if len(self.keys[0]) else hit

    def parts(self) -> Iterator[tuple[str, int, bytes]]:
        """The arrays as (name, order, bytes); ``from_parts`` puts them together again."""
        yield "root", 0, self.root.tobytes()
        yield "floor", 0, self.floor.tobytes()
        for n in range(self.order):
            for name in ("keys", "seen", "log_prob", "log_back"):
                yield name, n, getattr(self, name)[n].tobytes()

    @classmethod
    def from_parts(cls, parts: dict[tuple[str, int], bytes], order: int) -> KneserNey:
        out = cls.__new__(cls)
        out.root, out.floor = (np.frombuffer(parts[name, 0], np.float64) for name in ("root", "floor"))
        out.order, out.models = order, len(out.root)
        out.keys = [np.frombuffer(parts["keys", n], np.uint64) for n in range(order)]
        out.seen = [np.frombuffer(parts["seen", n], bool) for n in range(order)]
        out.log_prob, out.log_back = ([np.frombuffer(parts[name, n], np.float32).reshape(-1, out.models) for n in range(order)]
                                      for name in ("log_prob", "log_back"))
        return out

    def log_probabilities(self, seq: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Natural log probability of every real symbol (rows) under every model (columns)."""
        hashes = gram_hashes(seq, self.order)
        real = np.flatnonzero(owner >= 0)
        out = np.zeros((len(real), self.models), np.float32)
        todo = np.arange(len(real))
        for n in range(self.order - 1, -1, -1):
            at, hit = _find(self.keys[n], hashes[n][real[todo]])
            hit &= self.seen[n][at] if len(self.keys[n]) else hit
            out[todo[hit]] += self.log_prob[n][at[hit]]
            todo = todo[~hit]
            if n and len(todo):
                at, has = _find(self.keys[n - 1], hashes[n - 1][real[todo] - 1])
                out[todo[has]] += self.log_back[n - 1][at[has]]
        out[todo] += np.log(self.floor).astype(np.float32)
        return out

    def row_sums(self, seq: np.ndarray, owner: np.ndarray, rows: int, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log probabilities per row and model, and the number of symbols; works through the sequence in pieces."""
        total, count = np.zeros((rows, self.models)), np.zeros(rows, np.int64)
        for s in range(0, len(seq), piece):
            lead = min(s, self.order - 1)
            cut, who = seq[s - lead:s + piece], owner[s - lead:s + piece].copy()
            who[:lead] = -1
            real = who[who >= 0]
            values = self.log_probabilities(cut, who)
            if not len(real):
                continue
            first = np.flatnonzero(np.diff(real, prepend=-1))
            total[real[first]] += np.add.reduceat(values.astype(np.float64), first, axis=0)
            count += np.bincount(real, minlength=rows)
        return total, count
