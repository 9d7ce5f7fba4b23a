"""LM scoring: exact corpus counts for the unigram base, and a log-bilinear model trained by noise-contrastive estimation.

Documents are turned into written blocks: the distinct word hashes of a chunk of
texts and the place of every token in them.  Words of the training rows are
counted over the whole corpus; the commonest go to all tasks (``COMMON``, fixed),
counts of the others are joined by (word, block) pairs, so a word crosses the
shuffle once per block and not once per token.

The vocabulary of the model grows with the corpus: all words with at least
``least_count`` training tokens (about the root of the corpus size).  The model
predicts a word from the two words before it in two levels, the class given the
context and the word given class and context, both log-bilinear and normalised by
the full sum.  The ``VOCABULARY`` commonest words are classes of their own, the others share classes
by frequency; only words below the count are one rest class with a smoothed share inside.
It is trained on the training tokens of the blocks, written once as places in the
vocabulary: parts run numpy minibatches, their parameters are averaged on Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import ASCII_LOWER, SPACED_WORD, materialise, row_chunks, text_bytes, words
from plover.llm.langid import held_out
from plover.session import written

CHUNK_BYTES = 1 << 20
COMMON = 1 << 16
VOCABULARY = 510
REST, START = 0, 1  # classes; the vocabulary follows
FEWEST, GROWTH = 10, 100  # a word of the vocabulary has FEWEST training tokens, and sqrt(all training tokens) / GROWTH
SIZE, NOISE, INNER_NOISE, BATCH, STEPS, PARTS, ROUNDS, RATE = 16, 64, 4, 1024, 400, 8, 4, 0.03
MOST_PASSES = 40  # over a corpus that is small against PARTS * ROUNDS * STEPS batches
PART_TOKENS = 1 << 26  # training tokens of a part at most, where the blocks' files allow
PIECE = 1 << 18  # parameters that cross a shuffle in one row
END = np.uint64(2)  # hash of the end token
SCORED = 1 << 18  # tokens of a task that are scored together: frequent words and contexts are worked out once for them
CLASSES = 64  # classes whose exponentials are held for all words of the scored tokens
PAIRS = 1024  # contexts whose products are summed at a time: what a cache holds
STEEP = 40  # exponents of either word of a context at most, else their product may leave single precision


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per chunk of (doc_id, held_out, text): its distinct hashes, commonest first, with training counts, and its tokens as places in them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        part, serial = TaskContext.get().partitionId(), 0
        for b in row_chunks(batches, "text", CHUNK_BYTES):
            data, offsets = text_bytes(b.column("text"))
            h, row, _ = words(ASCII_LOWER[data], offsets, SPACED_WORD)
            count = np.bincount(row, minlength=b.num_rows) + 1
            token = np.full(len(h) + b.num_rows, END, np.uint64)
            token[np.arange(len(h)) + row] = h
            learn = ~np.repeat(b.column("held_out").to_numpy(zero_copy_only=False), count)
            hashes, place, times = np.unique(token, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")  # common words get small numbers, which pack well
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            hashes, place = hashes[order], rank[place]
            seen = np.bincount(place[learn], minlength=len(hashes)).astype(np.uint32)
            ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("doc_id"))
            held = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("held_out"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | serial]), ids, held, pa.array([count.tolist()], pa.list_(pa.int64())),
                 pa.array([hashes.tobytes()]), pa.array([_pack(seen)]), pa.array([_pack(place)])],
                ["block", "ids", "held", "sizes", "hashes", "seen", "tokens"])
            serial += 1

    return docs.mapInArrow(run, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, hashes binary, "
                                "seen binary, tokens binary")


def _block_rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(c)[i].as_py() for c in b.schema.names}


def _pack(values: np.ndarray) -> bytes:
    return pa.Codec("zstd").compress(values.astype(np.uint32).tobytes(), asbytes=True)


def _unpack(raw: bytes | pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(raw, 4 * n), np.uint32) if n else np.zeros(0, np.uint32)


def _word_counts(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for r in _block_rows(batches):
            seen = _unpack(r["seen"], len(r["hashes"]) // 8)
            some = seen > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["hashes"], np.int64)[some]),
                                              pa.array(seen[some].astype(np.int64))], ["h", "n"])

    pairs = blocks.select("hashes", "seen").mapInArrow(run, "h long, n long")
    return pairs.groupBy("h").agg(F.sum("n").alias("c"))


def least_count(tokens: int) -> int:
    return max(FEWEST, int(tokens ** 0.5 / GROWTH))


class Words:
    """Totals of the training tokens, counts of the commonest words, and the vocabulary in the order of its counts."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.tokens, self.distinct = int(total[0]), int(total[1])
        frequent = counts.filter(F.col("c") >= least_count(self.tokens)).count()  # about the root of the tokens
        top = counts.orderBy(F.desc("c"), "h").limit(max(COMMON, frequent)).toArrow()
        h, c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy().astype(np.int64)
        chosen = np.arange(min(max(VOCABULARY, frequent), len(h)))
        end = np.flatnonzero(h == END)
        if len(end) and end[0] not in chosen:
            chosen[-1] = end[0]
        word = np.full(len(h), REST, np.int64)
        word[chosen] = np.arange(len(chosen)) + 2
        order = np.argsort(h)
        self.hashes, self.counts, self.word = h[order], c[order], word[order]
        rest = self.tokens - int(c[chosen].sum())
        self.rest_tokens, self.rest_distinct = rest, self.distinct - len(chosen)
        weight = np.concatenate([[rest + 1, 0], c[chosen]]).astype(float)
        self.share = weight / weight.sum()  # of the words; nothing is ever predicted to be a start

    def _at(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def count_of(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of the commonest words, -1 for the others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at, found = self._at(hashes)
        return np.where(found, self.counts[at], -1)

    def word_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), REST)
        at, found = self._at(hashes)
        return np.where(found, self.word[at], REST)


def _contexts(word: np.ndarray, sizes: np.ndarray, wide: int) -> np.ndarray:
    """Code of the two words before each token (starts before a text)."""
    first = np.cumsum(sizes) - sizes
    before = np.concatenate([[START, START], word])
    one, two = before[1:-1].copy(), before[:-2].copy()
    one[first] = START
    two[first] = START
    second = first[sizes > 1] + 1
    two[second] = START
    return two * wide + one


def class_edges(words_: int) -> np.ndarray:
    """First word of every class, and the number of words: single words, then runs of about the root of their number."""
    single = min(words_, VOCABULARY + 2)
    run = max(64, int((words_ - single) ** 0.5))
    return np.concatenate([np.arange(single), np.arange(single, words_, run), [words_]]).astype(np.int64)


class LogBilinear:
    """Scores (q, 1) . out of the classes and (q, 1) . inner of the words of a class (the last column is a bias), with
    q = near * r[one before] + far * r[two before]."""

    NAMES = ("r", "out", "near", "far", "inner")

    def __init__(self, share: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = len(share)
        self.wide = max(n, VOCABULARY + 2)
        self.edges = class_edges(n)
        self.cls = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))
        self.share, self.upto = share, np.concatenate([[0.0], np.cumsum(share)])
        self.class_share = np.diff(self.upto[self.edges])
        self.r = rng.normal(0, 1, (n, SIZE)).astype(np.float32) / np.float32(SIZE ** 0.5)
        self.out = rng.normal(0, 0.02, (len(self.class_share), SIZE + 1)).astype(np.float32)
        self.out[:, SIZE] = np.log(np.maximum(self.class_share, 1e-12))
        self.near, self.far = np.ones(SIZE, np.float32), np.full(SIZE, 0.5, np.float32)
        self.inner = np.zeros((n, SIZE + 1), np.float32)
        self.own = np.log(np.maximum(share / np.maximum(self.class_share, 1e-12)[self.cls], 1e-12)).astype(np.float32)
        self.inner[:, SIZE] = self.own
        self.rows = self.past = self.last = None

    def query(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self._query(self.r[one], self.r[two])

    def _query(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        q = np.ones((len(near), SIZE + 1), np.float32)
        q[:, :SIZE] = self.near * near + self.far * far
        return q

    def _step(self, name: str, at: np.ndarray, held: np.ndarray, grad: np.ndarray) -> None:
        """AdaGrad on the rows ``at`` only (``held``: what the table has there), repeated rows summed; overwrites ``grad``."""
        own, last, wide = np.arange(len(at)), self.last[name], grad.shape[1]
        last[at] = own
        to = last.take(at)  # the last of the places that hold the same row
        first, again = np.flatnonzero(to == own), np.flatnonzero(to != own)
        np.add.at(grad.reshape(-1), (to.take(again)[:, None] * wide + np.arange(wide)).reshape(-1), grad.take(again, axis=0).reshape(-1))
        g, held = grad.take(first, axis=0), held.take(first, axis=0)
        g /= np.float32(BATCH)
        past = held[:, wide:]
        past += g * g
        g *= np.float32(RATE)
        g /= np.sqrt(past)
        held[:, :wide] += g
        self.rows[name][at.take(first)] = held

    def train(self, context: np.ndarray, word: np.ndarray, seed, times: int = 1) -> int:
        """Every token ``times`` times in minibatches, in random order, by noise-contrastive estimation with AdaGrad: its class against
        noise classes drawn by share (shared by the batch), and its word against words of its class drawn by share."""
        rng = np.random.default_rng(seed)
        if self.rows is None:  # a row and its past squares lie side by side
            self.past = {k: np.full_like(getattr(self, k), 1e-7) for k in self.NAMES}
            self.rows = {k: np.concatenate([getattr(self, k), self.past.pop(k)], axis=1) for k in ("r", "out", "inner")}
            self.r, self.out, self.inner = (self.rows[k][:, :self.rows[k].shape[1] // 2] for k in ("r", "out", "inner"))
            self.last = {k: np.zeros(len(x), np.int64) for k, x in self.rows.items()}
        wide = SIZE + 1
        class_upto = np.cumsum(self.class_share)
        log_noise = np.log(np.maximum(self.class_share, 1e-12) * NOISE).astype(np.float32)
        log_inner = self.own + np.float32(np.log(INNER_NOISE))
        find = _Places(self.upto)
        size = np.diff(self.edges)
        mixed = np.concatenate([rng.permutation(len(word)) for _ in range(times)])
        all_two, all_one = np.divmod(context, self.wide)
        all_word, all_one, all_two = word[mixed], all_one[mixed], all_two[mixed]
        all_class = self.cls[all_word]
        for i in range(0, len(mixed), BATCH):
            w, one, two, c = (x[i:i + BATCH] for x in (all_word, all_one, all_two, all_class))
            n = len(w)
            noise = np.minimum(np.searchsorted(class_upto, rng.random(NOISE) * class_upto[-1], "right"), len(class_upto) - 1)
            near_far, classes = np.concatenate([one, two]), np.concatenate([c, noise])
            r, out = self.rows["r"].take(near_far, axis=0), self.rows["out"].take(classes, axis=0)
            r1, r2, v, other = r[:n, :SIZE], r[n:, :SIZE], out[:n, :wide], np.ascontiguousarray(out[n:, :wide])
            q = self._query(r1, r2)
            up = _sigmoid(log_noise[c] - np.einsum("ij,ij->i", q, v))
            other[:, SIZE] -= log_noise[noise]  # the bias gets no part of a query's gradient
            down = -_sigmoid(q @ other.T)
            grad_q = up[:, None] * v + down @ other
            deep = np.flatnonzero(size[c] > 1)
            if len(deep):
                cd = c[deep]
                first, last = self.edges[cd], self.edges[cd + 1]
                low, high = self.upto[first], self.upto[last]
                drawn = find(low[:, None] + rng.random((len(deep), INNER_NOISE)) * (high - low)[:, None])
                drawn = np.minimum(np.maximum(drawn, first[:, None]), last[:, None] - 1)
                at = np.concatenate([w[deep][:, None], drawn], axis=1)  # the word, then its noise
                held, qd = self.rows["inner"].take(at.reshape(-1), axis=0), q.take(deep, axis=0)
                inner = held.reshape(*at.shape, 2 * wide)[:, :, :wide]
                pull = -_sigmoid(np.einsum("ijk,ik->ij", inner, qd) - log_inner.take(at))
                pull[:, 0] += 1
                grad_q[deep] += np.einsum("ij,ijk->ik", pull, inner)
                self._step("inner", at.reshape(-1), held, (pull[:, :, None] * qd[:, None]).reshape(-1, wide))
            self._step("out", classes, out, np.concatenate([up[:, None] * q, down.T @ q]))
            grad_q = np.ascontiguousarray(grad_q[:, :SIZE])
            self._step("r", near_far, r, np.concatenate([grad_q * self.near, grad_q * self.far]))
            for k, x in (("near", r1), ("far", r2)):
                g = np.einsum("ij,ij->j", grad_q, x) / np.float32(BATCH)
                self.past[k] += g * g
                setattr(self, k, getattr(self, k) + np.float32(RATE) * g / np.sqrt(self.past[k]))
        return len(mixed)

    def pack(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).reshape(-1) for k in self.NAMES])

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        self.rows = self.past = None

    def log_probabilities(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Normalised natural log probability of each word after its context; batched products."""
        codes, place = np.unique(context, return_inverse=True)
        place = place.astype(np.int32)
        two, one = (x.astype(np.int32) for x in np.divmod(codes, self.wide))
        del codes
        norm = self._class_norms(one, two)
        cls = self.cls[word]
        r, value = np.ascontiguousarray(self.r), np.empty(len(word), np.float32)
        query = lambda at: self._query(r.take(one.take(at), axis=0), r.take(two.take(at), axis=0))
        for i in range(0, len(word), 4096):
            at, c = place[i:i + 4096], cls[i:i + 4096]
            value[i:i + 4096] = np.einsum("ij,ij->i", query(at), self.out[c]) - norm[at]
        deep = np.flatnonzero(np.diff(self.edges)[cls] > 1)
        deep = deep[_sorted(cls[deep])]
        for own in np.split(deep, np.flatnonzero(np.diff(cls[deep])) + 1) if len(deep) else []:
            first, last = self.edges[cls[own[0]]:cls[own[0]] + 2]
            for i in range(0, len(own), 512):
                some = own[i:i + 512]
                at = place[some]
                s = query(at) @ self.inner[first:last].T
                value[some] += s[np.arange(len(some)), word[some] - first]
                value[some] -= _log_sum(s)
        return value

    def _class_norms(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Logarithm of the sum over all classes for each context.  A score is a sum of a part of each word, so its exponential
        is a product: exponentials are taken once per word and class, and a context is a sum of products."""
        (ones, i), (twos, j) = (_distinct(x, len(self.r)) for x in (one, two))
        near, far = self.near * self.r[ones], self.far * self.r[twos]
        kept = np.flatnonzero(np.arange(len(self.out)) != START)
        out, weight = self.out[kept, :SIZE], np.exp(self.out[kept, SIZE])
        total = np.zeros(len(one), np.float32)
        a, b = (np.empty((len(x), CLASSES), np.float32) for x in (ones, twos))
        c, d = np.empty((2, PAIRS, CLASSES), np.float32)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            for s in range(0, len(kept), CLASSES):
                part = np.zeros((CLASSES, SIZE), np.float32)
                part[:len(kept) - s] = out[s:s + CLASSES]
                scale = np.zeros(CLASSES, np.float32)
                scale[:len(kept) - s] = weight[s:s + CLASSES]
                for x, to in ((near, a), (far, b)):
                    for k in range(0, len(x), PAIRS):
                        some = np.matmul(x[k:k + PAIRS], part.T, out=to[k:k + PAIRS])
                        np.exp(some, out=some)
                        if to is a:
                            some *= scale
                for k in range(0, len(one), PAIRS):
                    n = min(PAIRS, len(one) - k)
                    a.take(i[k:k + n], axis=0, out=c[:n], mode="clip")
                    b.take(j[k:k + n], axis=0, out=d[:n], mode="clip")
                    total[k:k + n] += np.einsum("ij,ij->i", c[:n], d[:n])
            norm = np.log(total)
            longest = np.sqrt((out * out).sum(axis=1).max(initial=0))
            steep = [np.sqrt((x * x).sum(axis=1)) * longest > STEEP for x in (near, far)]
        # products that single precision may not hold are summed by their logarithms
        odd = np.flatnonzero(steep[0][i] | steep[1][j] | ~((total > 1e-30) & (total < 1e30)))
        for k in range(0, len(odd), 512):
            some = odd[k:k + 512]
            norm[some] = _log_sum(self.query(one[some], two[some]) @ self.out[kept].T)
        return norm


def _distinct(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the place of each value in them."""
    there = np.zeros(below, bool)
    there[values] = True
    place = np.cumsum(there, dtype=np.int32) - np.int32(1)
    return np.flatnonzero(there), place[values]


class _Places:
    """``searchsorted(upto, x, "right") - 1`` for x from 0 to the last value: a table of even steps, then single steps."""

    def __init__(self, upto: np.ndarray):
        self.steps = 1 << int(2 * len(upto)).bit_length()
        self.table = np.searchsorted(upto, np.arange(self.steps + 1) / self.steps, "right") - 1
        self.above = np.append(upto[1:], [np.inf, np.inf])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        flat = x.reshape(-1)
        out = self.table.take(np.minimum(flat * self.steps, self.steps).astype(np.int64))
        todo = np.flatnonzero(self.above.take(out) <= flat)
        while len(todo):
            out[todo] += 1
            todo = todo[self.above.take(out[todo]) <= flat[todo]]
        return out.reshape(x.shape)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)) in the place of ``x``."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sorted(at: np.ndarray) -> np.ndarray:
    """Stable order of places below 2**32, by their 16-bit halves (numpy sorts those by radix)."""
    order = np.argsort(at.astype(np.uint16), kind="stable")
    high = at >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def _log_sum(s: np.ndarray) -> np.ndarray:
    """Logarithm of the rows' sums of exponentials; overwrites ``s``."""
    top = s.max(axis=1)
    s -= top[:, None]
    return top + np.log(np.exp(s, out=s) @ np.ones(s.shape[1], s.dtype))


def _groups(rows, size, least: int):
    """Lists of rows, in order, of at least ``least`` together (the last may be smaller)."""
    some, total = [], 0
    for r in rows:
        some.append(r)
        total += size(r)
        if total >= least:
            yield some
            some, total = [], 0
    if some:
        yield some


def passes(tokens: int) -> int:
    """Whole passes over the training tokens: one, and up to MOST_PASSES where it is less than PARTS * ROUNDS * STEPS batches."""
    return min(MOST_PASSES, max(1, -(-PARTS * ROUNDS * STEPS * BATCH // max(tokens, 1))))


def _learning(blocks: DataFrame, shared) -> DataFrame:
    """One row per block with training tokens: their words as places in the vocabulary, and the tokens of each text, packed."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                learn = ~b.column("held")[i].values.to_numpy(zero_copy_only=False)
                sizes = b.column("sizes")[i].values.to_numpy()
                some = np.repeat(learn, sizes)
                if not some.any():
                    continue
                word = shared.value.word_of(np.frombuffer(b.column("hashes")[i].as_buffer(), np.uint64))
                token = _unpack(b.column("tokens")[i].as_buffer(), len(some))[some]
                yield pa.RecordBatch.from_arrays(
                    [b.column("block").slice(i, 1), pa.array([int(learn.sum())]), pa.array([len(token)]),
                     pa.array([_pack(sizes[learn])]), pa.array([_pack(word[token])])], ["block", "texts", "n", "sizes", "words"])

    return blocks.select("block", "held", "sizes", "hashes", "tokens").mapInArrow(
        run, "block long, texts long, n long, sizes binary, words binary")


def _average(table: pa.Table) -> pa.Table:
    """One piece of the changes: the mean of the rows, weighted by the tokens that they have visited."""
    weight = table.column("visited").to_pylist()
    total = np.zeros(len(table.column("part")[0].as_buffer()) // 2)
    for n, raw in zip(weight, table.column("part"), strict=True):
        total += np.frombuffer(raw.as_buffer(), np.float16) * (n / sum(weight))
    return pa.table({"at": table.column("at").slice(0, 1), "visited": pa.array([sum(weight)], pa.int64()),
                     "part": pa.array([total.astype(np.float16).tobytes()], pa.binary())})


def _fit(learning: DataFrame, vocab: Words, shared) -> LogBilinear:
    """A pass is dealt over the rounds: each takes every ROUNDS-th training token of every block, and the parts (runs of files)
    start from the model of the round before.  Their changes cross the shuffle in half precision and are averaged, weighted by
    their tokens, over groups of parts and then over the groups."""
    model = LogBilinear(vocab.share)
    context = learning.sparkSession.sparkContext
    wanted = max(PARTS, -(-vocab.tokens // PART_TOKENS))
    parts, groups = learning.coalesce(wanted), round(wanted ** 0.5)
    times = passes(vocab.tokens)

    def trained(round_: int, now):
        def run(batches):
            own, visited = LogBilinear(shared.value.share), 0
            own.unpack(now.value)
            for b in batches:
                for i in range(b.num_rows):
                    sizes = _unpack(b.column("sizes")[i].as_buffer(), b.column("texts")[i].as_py()).astype(np.int64)
                    word = _unpack(b.column("words")[i].as_buffer(), b.column("n")[i].as_py()).astype(np.int64)
                    before = _contexts(word, sizes, own.wide)[round_::ROUNDS]
                    visited += own.train(before, word[round_::ROUNDS], [b.column("block")[i].as_py(), round_], times)
            if visited:
                flat, group = (own.pack() - now.value).astype(np.float16), TaskContext.get().partitionId() % groups
                for at in range(0, len(flat), PIECE):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([at]), pa.array([group]), pa.array([visited]), pa.array([flat[at:at + PIECE].tobytes()])],
                        ["at", "group", "visited", "part"])

        return run

    kind = "at long, visited long, part binary"
    for round_ in range(ROUNDS):
        now = context.broadcast(model.pack())
        got = (parts.mapInArrow(trained(round_, now), "at long, group long, visited long, part binary")
               .groupBy("at", "group").applyInArrow(_average, kind)
               .groupBy("at").applyInArrow(_average, kind).collect())  # one model
        if got:
            moved = np.concatenate([np.frombuffer(r["part"], np.float16) for r in sorted(got, key=lambda r: r["at"])])
            model.unpack(model.pack() + moved.astype(np.float32))
        now.unpersist()
    return model


def lm_scores(docs: DataFrame, folds: int = 7, fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: fold, tokens, known tokens, training tokens, unigram base score and model score (log10).

    Null or empty text is its end token.  Rows with a null id are held out.  Repeated
    rows are scored, and counted, each.  With no training row all counts are zero and
    every word is unknown.  Other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col, folds, fold).alias("held_out"), F.col(text_col).alias("text"))
    blocks = materialise(_blocks(base), "blocks")
    counts = materialise(_word_counts(blocks), "word-counts")
    vocab = Words(counts)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocab)
    with written(_learning(blocks, shared), "learning") as learning:
        model = spark.sparkContext.broadcast(_fit(learning, vocab, shared))

    def rare(batches):
        for r in _block_rows(batches):
            hashes = np.frombuffer(r["hashes"], np.uint64)
            at = np.flatnonzero(shared.value.count_of(hashes) < 0)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[at].view(np.int64)), pa.array(np.full(len(at), r["block"])),
                                              pa.array(at.astype(np.int32))], ["h", "block", "at"])

    def known(batches):
        """What the words of a block are to the model, in place of their hashes: their places in the vocabulary and common counts, packed."""
        for b in batches:
            for i in range(b.num_rows):
                hashes = np.frombuffer(b.column("hashes")[i].as_py(), np.uint64)
                count, word = shared.value.count_of(hashes), shared.value.word_of(hashes)
                low, high = (count & 0xFFFFFFFF).astype(np.uint32), (count >> 32).astype(np.int32).view(np.uint32)
                kept = [b.column(c).slice(i, 1) for c in ("block", "ids", "held", "sizes", "tokens")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([len(hashes)]), pa.array([_pack(low)]), pa.array([_pack(high)]), pa.array([_pack(word)])],
                    ["block", "ids", "held", "sizes", "tokens", "n", "low", "high", "word"])

    pairs = blocks.select("block", "hashes").mapInArrow(rare, "h long, block long, at int")
    found = pairs.join(counts, "h").groupBy("block").agg(F.collect_list(F.struct("at", F.col("c"))).alias("rare"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def ready_blocks(batches):
        """Per block: its documents' ids, folds and sizes, the count and the place in the vocabulary of its words, and its tokens."""
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in ("n", "low", "high", "word", "tokens", "sizes")}
                low, high, word = (_unpack(r[x], r["n"]) for x in ("low", "high", "word"))
                c = np.maximum(high.view(np.int32).astype(np.int64) << 32 | low, 0)
                more = b.column("rare")[i]
                if more.is_valid:
                    pairs_ = more.values
                    c[pairs_.field("at").to_numpy()] = pairs_.field("c").to_numpy()
                yield b.column("ids")[i].values, b.column("held")[i].values, np.array(r["sizes"]), c, word.astype(np.int64), _unpack(r["tokens"], sum(r["sizes"]))

    def score(batches):
        words_, lbl = shared.value, model.value
        for some in _groups(ready_blocks(batches), lambda x: len(x[5]), SCORED):
            target = np.concatenate([word[token] for *_, word, token in some])
            before = _contexts(target, np.concatenate([x[2] for x in some]), lbl.wide)
            values = lbl.log_probabilities(before, target) / np.log(10)
            del target, before
            values = np.split(values, np.cumsum([len(x[5]) for x in some])[:-1])
            for (ids, held, sizes, c, word, token), value in zip(some, values, strict=True):
                row = np.repeat(np.arange(len(sizes)), sizes)
                plain = np.log10((c + 1) / (words_.tokens + words_.distinct + 1))
                inside = np.where(word == REST, np.log10((c + 1) / (words_.rest_tokens + words_.rest_distinct + 1)), 0.0)
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [ids, held, pa.array(sizes), pa.array(np.bincount(row[c[token] > 0], minlength=n)),
                     pa.array(np.full(n, words_.tokens)), pa.array(np.bincount(row, weights=plain[token], minlength=n)),
                     pa.array(np.bincount(row, weights=value + inside[token], minlength=n))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    ready = (blocks.select("block", "ids", "held", "sizes", "hashes", "tokens")
             .mapInArrow(known, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, tokens binary, "
                                "n long, low binary, high binary, word binary").join(found, "block", "left"))
    return ready.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                   "base_score double, score double")
