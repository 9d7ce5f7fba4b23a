"""Word-trigram modified Kneser-Ney model of any size: its counts stay on Spark, in shards, and no gram is left out.

Words are numbered by count.  A bigram and the symbols before it are in one shard, and so are the counts of what
follows it as a context.  Texts become chunks of numbers; a chunk asks each shard once for its distinct trigrams, gets
counts back (small numbers, which pack to little) and works out the probabilities of its rows.  So texts pass no shuffle
but as packed numbers, and a task holds one shard and one chunk; ``SLICES`` of the texts, one after the other, bound the disk.  Only the words are in every task: hash and number
while texts are read, three short floats while they are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from plover.llm.common import SPACED_WORD, materialise, mix, row_chunks, text_bytes, words
from plover.llm.ngrams import RARE, START, _find, discounts, padded
from plover.session import free_shuffles

ORDER = 3
CHUNK_BYTES = 1 << 20
FIRST_WORD = 4  # number of the first word of the vocabulary, after START, END and RARE
CHUNK_TOKENS = 1 << 20  # tokens that are counted or scored at once
SHARD_TOKENS = 1 << 21  # tokens whose trigrams a shard holds, as they come
ASKED_BYTES = 100 << 20  # of the texts that are scored, for one shard
PART_WORDS = 1 << 20  # words of one part of the sums by word
SLICES = 3  # texts are scored in so many parts, and what one has shuffled leaves the disk before the next
HOT = 4096  # commonest words, whose bigrams are dealt by both words
LOW = (1 << 32) - 1
TEACH, CONTEXT, ASK = 0, 1, 2

RECORD = "shard long, kind int, chunk long, two long, three long, v binary, w binary, size binary, u binary, more binary"
_RECORD = pa.schema([*((k, pa.int64()) for k in ("shard",)), ("kind", pa.int32()), *((k, pa.int64()) for k in ("chunk", "two", "three")),
                     *((k, pa.binary()) for k in ("v", "w", "size", "u", "more"))])


def pack(values: np.ndarray) -> bytes:
    """The numbers by their bytes, the lowest of all first: what small numbers leave empty packs to nothing."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unpack(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw, 8 * n), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.int64)[:, 0]


def pack_runs(values: np.ndarray, fresh: np.ndarray) -> bytes:
    """Numbers that rise inside runs, by their steps; ``fresh``: where a run begins."""
    return pack(np.where(fresh, values, np.diff(values, prepend=0)))


def unpack_runs(raw: bytes, fresh: np.ndarray) -> np.ndarray:
    step = unpack(raw, len(fresh))
    total, first = np.cumsum(step), np.flatnonzero(fresh)
    return total - np.repeat((total - step)[first], np.diff(first, append=len(step)))


def _begins(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def dealt(pair: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each bigram: by its first word, and by both where that is common."""
    v = pair >> 32
    return (mix(np.where(v < FIRST_WORD + HOT, pair, v).view(np.uint64)) % np.uint64(shards)).astype(np.int64)


class Grams:
    """Distinct trigrams by their last two symbols: bigrams ``pairs``, the place ``of`` the bigram of each trigram, the symbol
    ``u`` before it."""

    def __init__(self, pairs: np.ndarray, of: np.ndarray, u: np.ndarray):
        self.pairs, self.of, self.u = pairs, of, u

    def record(self, shard: int, kind: int, chunk: int = 0, more: np.ndarray | None = None) -> dict:
        v, w = self.pairs >> 32, self.pairs & LOW
        fresh = _begins(v)
        return {"shard": shard, "kind": kind, "chunk": chunk, "two": len(v), "three": len(self.u), "v": pack(np.diff(v, prepend=0)),
                "w": pack_runs(w, fresh), "size": pack(np.bincount(self.of, minlength=len(v))), "u": pack_runs(self.u, _begins(self.of)),
                "more": pack(more.ravel()) if more is not None else b""}

    @staticmethod
    def of_record(r: dict) -> Grams:
        v = np.cumsum(unpack(r["v"], r["two"]))
        pairs = v << 32 | unpack_runs(r["w"], _begins(v))
        of = np.repeat(np.arange(r["two"]), unpack(r["size"], r["two"]))
        return Grams(pairs, of, unpack_runs(r["u"], _begins(of)))

    def split(self, shards: int):
        """(shard, places of its bigrams, places of its trigrams)."""
        to = dealt(self.pairs, shards)
        two, three = np.argsort(to, kind="stable"), np.argsort(to[self.of], kind="stable")
        held = np.arange(shards + 1)
        at2, at3 = np.searchsorted(to[two], held), np.searchsorted(to[self.of][three], held)
        for s in np.unique(to).tolist():
            yield s, two[at2[s]:at2[s + 1]], three[at3[s]:at3[s + 1]]

    def part(self, two: np.ndarray, three: np.ndarray) -> Grams:
        return Grams(self.pairs[two], np.searchsorted(two, self.of[three]), self.u[three])


def _distinct(pair: np.ndarray, u: np.ndarray, count: np.ndarray | None = None) -> tuple[Grams, np.ndarray]:
    """The trigrams once each, and how often they came."""
    pairs, of = np.unique(pair, return_inverse=True)
    key, at = np.unique(of << 32 | u, return_inverse=True)
    return Grams(pairs, key >> 32, key & LOW), np.bincount(at, count, len(key)).astype(np.int64)


def _tokens(number: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bigram that ends at each word and at the end of each row, and the symbol before it."""
    seq, owner = padded(number.astype(np.uint64), np.repeat(np.arange(len(size)), size), len(size), ORDER)
    seq, real = seq.astype(np.int64), np.flatnonzero(owner >= 0)
    return seq[real - 1] << 32 | seq[real], seq[real - 2]


class Vocabulary:
    """Number of each word by its hash; the words are numbered by count."""

    def __init__(self, hashes: np.ndarray, count: np.ndarray):
        order = np.lexsort((hashes, -count))
        number = np.empty(len(hashes), np.uint32)
        number[order] = np.arange(FIRST_WORD, FIRST_WORD + len(hashes), dtype=np.uint32)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], number[order]

    def numbers(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of the texts (RARE: not in the vocabulary), and how many each text has."""
        symbol, row, _ = words(*text_bytes(column), SPACED_WORD)
        at, hit = _find(self.hashes, symbol)
        number = np.where(hit, self.number[at], np.uint32(RARE)) if len(self.hashes) else np.full(len(symbol), RARE)
        return number.astype(np.int64), np.bincount(row, minlength=len(column))


def _held(batches, vocabulary: Vocabulary):
    """(numbers, sizes, batches) of at least CHUNK_TOKENS tokens, the last of fewer."""
    held, tokens = [], 0
    for b in row_chunks(batches, "text", CHUNK_BYTES):
        held.append((*vocabulary.numbers(b.column("text")), b))
        tokens += len(held[-1][0]) + b.num_rows
        if tokens >= CHUNK_TOKENS:
            yield tuple(map(np.concatenate, list(zip(*held, strict=True))[:2])) + ([b for *_, b in held],)
            held, tokens = [], 0
    if held:
        yield tuple(map(np.concatenate, list(zip(*held, strict=True))[:2])) + ([b for *_, b in held],)


def _merge(table: pa.Table) -> pa.Table:
    """The trigrams of a shard, counted."""
    pair, u, count = [], [], []
    for r in table.to_pylist():
        g = Grams.of_record(r)
        pair.append(g.pairs[g.of])
        u.append(g.u)
        count.append(unpack(r["more"], r["three"]))
    g, count = _distinct(*map(np.concatenate, (pair, u, count)))
    before = np.bincount(g.of)
    often = [[int((c == k).sum()) for k in range(1, 5)] for c in (before, count)]
    out = g.record(table.column("shard")[0].as_py(), TEACH, 0, count) | {"often2": often[0], "often3": often[1]}
    return pa.Table.from_pylist([out], pa.schema([*_RECORD, *((k, pa.list_(pa.int64())) for k in ("often2", "often3"))]))


def _contexts(shards: int):
    """Of what follows each context in a shard: occurrences, and how many symbols came once, twice, more often."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                g = Grams.of_record(r)
                count = unpack(r["more"], r["three"])
                pair, at = np.unique(g.u << 32 | g.pairs[g.of] >> 32, return_inverse=True)
                more = np.stack([np.bincount(at, count, len(pair)), *(np.bincount(at[own], minlength=len(pair)) for own in
                                                                      (count == 1, count == 2, count > 2))]).astype(np.int64)
                to = dealt(pair, shards)
                for s in np.unique(to).tolist():
                    own = np.flatnonzero(to == s)
                    none = np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_pylist([Grams(pair[own], none, none).record(s, CONTEXT, 0, more[:, own])], _RECORD)

    return run


_SUMS = "part long, n long, symbol binary, more binary"


def _symbol_sums(grams: DataFrame, parts: int) -> DataFrame:
    """By word, in packed parts: sum of the counts of the bigrams that it begins, how many of them have the count 1, 2, more, and
    how many bigrams it ends; the parts are dealt by number."""
    names = ["part", "n", "symbol", "more"]

    def row(part, symbol, more):
        return [pa.array([x]) for x in (part, len(symbol), pack_runs(symbol, np.arange(len(symbol)) == 0), pack(more.ravel()))]

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                g = Grams.of_record(r)
                c, v, w = np.bincount(g.of, minlength=len(g.pairs)), g.pairs >> 32, g.pairs & LOW
                symbol, at = np.unique(np.concatenate([v, w]), return_inverse=True)
                first, last = at[:len(v)], at[len(v):]
                more = np.stack([np.bincount(first, c, len(symbol)), *(np.bincount(first[own], minlength=len(symbol)) for own in
                                                                       (c == 1, c == 2, c > 2)), np.bincount(last, minlength=len(symbol))]).astype(np.int64)
                for p in np.unique(symbol % parts).tolist():
                    own = symbol % parts == p
                    yield pa.RecordBatch.from_arrays(row(p, symbol[own], more[:, own]), names)

    def merge(table):
        symbol, more = [], []
        for r in table.to_pylist():
            symbol.append(unpack_runs(r["symbol"], np.arange(r["n"]) == 0))
            more.append(unpack(r["more"], 5 * r["n"]).reshape(5, -1))
        symbol, at = np.unique(np.concatenate(symbol), return_inverse=True)
        more = np.concatenate(more, axis=1)
        more = np.stack([np.bincount(at, x, len(symbol)) for x in more]).astype(np.int64)
        often = [int((more[4] == k).sum()) for k in range(1, 5)] + [int((more[4] > 2).sum()), int((more[4] > 0).sum())]
        return pa.Table.from_arrays([*row(table.column("part")[0].as_py(), symbol, more), pa.array([often])], [*names, "often"])

    each = grams.mapInArrow(run, _SUMS)
    return materialise(each.groupBy("part").applyInArrow(merge, f"{_SUMS}, often array<long>"), "word-sums")


class Rates:
    """What scoring needs besides the counts of grams: discounts, and for each symbol the sum of the counts of its bigrams,
    its back-off weight and its own probability."""

    def __init__(self, d2: np.ndarray, d3: np.ndarray, total: np.ndarray, back: np.ndarray, prob: np.ndarray):
        self.d2, self.d3, self.total, self.back, self.prob = d2, d3, total, back, prob

    def logs(self, number: np.ndarray, size: np.ndarray, asked: Asked) -> np.ndarray:
        """Sum of the log probabilities of each row."""
        c2, total, *n = asked.counts2.astype(np.float64)
        v, w = asked.pair >> 32, asked.pair & LOW
        share2 = np.where(c2 > 0, c2 - self.d2[np.minimum(c2, 3).astype(np.int64)], 0.0)
        back2 = np.where(total > 0, sum(x * d for x, d in zip(n, self.d3[1:], strict=True)) / np.maximum(total, 1), 1.0)
        p = asked.of_pair(share2, 0.0) / self.total[v] + self.back[v] * self.prob[w].astype(np.float64)
        first = np.cumsum(size + 1) - size - 1
        context = np.concatenate([[-1], asked.place2[:-1]])
        context[first] = asked.start
        weight, held = (np.where(context >= 0, x[context], other) for x, other in ((back2, 1.0), (total, 1.0)))
        c3 = np.where(asked.place3 >= 0, asked.counts3[asked.place3], 0) if len(asked.counts3) else np.zeros(len(p), np.int64)
        p = p * weight + np.where(c3 > 0, c3 - self.d3[np.minimum(c3, 3)], 0.0) / np.maximum(held, 1.0)
        return np.add.reduceat(np.log(p), first)


class Asked:
    """What a chunk asks for: its distinct bigrams and trigrams of known words, and the context of a row's first word."""

    def __init__(self, number: np.ndarray, size: np.ndarray):
        self.pair, u = _tokens(number, size)
        rare = int(RARE)
        known = (self.pair >> 32 != rare) & (self.pair & LOW != rare)
        start = int(START) << 32 | int(START)
        pairs, at = np.unique(np.concatenate([[start], self.pair[known]]), return_inverse=True)
        self.place2, self.start = np.full(len(self.pair), -1), at[0]
        self.place2[known] = at[1:]
        known &= u != rare
        key, at = np.unique(self.place2[known] << 32 | u[known], return_inverse=True)
        self.place3 = np.full(len(self.pair), -1)
        self.place3[known] = at
        self.grams = Grams(pairs, key >> 32, key & LOW)
        self.counts2, self.counts3 = np.zeros((5, len(pairs)), np.int64), np.zeros(len(key), np.int64)

    def of_pair(self, values: np.ndarray, other: float) -> np.ndarray:
        return np.where(self.place2 >= 0, values[self.place2], other)


_REPLY = "chunk long, shard long, two long, three long, counts2 binary, counts3 binary"


def _answer(table: pa.Table) -> pa.Table:
    """A shard's counts for all that was asked of it: of a bigram the distinct symbols before it, and the sums of what follows it."""
    rows = {k: table.filter(pc.equal(table.column("kind"), k)) for k in (TEACH, CONTEXT)}
    none = np.zeros(0, np.int64)
    model, count, context, sums = Grams(none, none, none), none, [none], [np.zeros((4, 0), np.int64)]
    for r in rows[TEACH].to_pylist():
        model, count = Grams.of_record(r), unpack(r["more"], r["three"])
    for r in rows[CONTEXT].to_pylist():
        context.append(Grams.of_record(r).pairs)
        sums.append(unpack(r["more"], 4 * r["two"]).reshape(4, -1))
    context, at = np.unique(np.concatenate(context), return_inverse=True)
    sums = np.stack([np.bincount(at, x, len(context)) for x in np.concatenate(sums, axis=1)]).astype(np.int64)
    before, key = np.bincount(model.of, minlength=len(model.pairs)), model.of << 32 | model.u

    def find(keys, wanted, values):
        if not len(keys):
            return np.zeros(values.shape[:-1] + wanted.shape, np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[..., at], 0)

    out = []
    asks = table.filter(pc.equal(table.column("kind"), ASK))
    for i in range(len(asks)):
        r = asks.slice(i, 1).to_pylist()[0]
        g = Grams.of_record(r)
        place = find(model.pairs, g.pairs, np.arange(1, len(model.pairs) + 1)) - 1
        counts2 = np.concatenate([find(model.pairs, g.pairs, before)[None], find(context, g.pairs, sums)])
        at = place[g.of]
        counts3 = np.where(at >= 0, find(key, np.maximum(at, 0) << 32 | g.u, count), 0)
        out.append({k: r[k] for k in ("chunk", "shard", "two", "three")} | {"counts2": pack(counts2.ravel()), "counts3": pack(counts3)})
    return pa.Table.from_pylist(out, pa.schema([*((k, pa.int64()) for k in ("chunk", "shard", "two", "three")), ("counts2", pa.binary()),
                                                ("counts3", pa.binary())]))


class GramShards:
    """The model: ``grams``, its counted trigrams by shard, and what every task needs, broadcast."""

    def __init__(self, grams: DataFrame, shards: int, vocabulary, rates):
        self.grams, self.shards, self.vocabulary, self.rates = grams, shards, vocabulary, rates

    @staticmethod
    def learn(taught: DataFrame, counts: DataFrame, tokens: int, asked_bytes: int) -> GramShards:
        """``taught``: the texts; ``counts``: (h, c) of all their words; ``tokens``: words and ends."""
        context = taught.sparkSession.sparkContext
        each = counts.select("h", "c").toArrow()
        shared = context.broadcast(Vocabulary(each.column("h").to_numpy().view(np.uint64), each.column("c").to_numpy()))
        n, shards = FIRST_WORD + each.num_rows, max(1, -(-tokens // SHARD_TOKENS), -(-asked_bytes // ASKED_BYTES))

        def run(batches):
            for number, size, _ in _held(batches, shared.value):
                g, count = _distinct(*_tokens(number, size))
                for s, two, three in g.split(shards):
                    yield pa.RecordBatch.from_pylist([g.part(two, three).record(s, TEACH, 0, count[three])], _RECORD)

        grams = taught.mapInArrow(run, RECORD).groupBy("shard").applyInArrow(_merge, f"{RECORD}, often2 array<long>, often3 array<long>")
        grams = materialise(grams, "grams")
        often = grams.select("often2", "often3", "two").collect()
        d2, d3 = (discounts(np.sum([r[k] for r in often], axis=0).tolist()) for k in ("often2", "often3"))
        sums = _symbol_sums(grams.drop("often2", "often3"), -(-n // PART_WORDS))
        often1 = np.sum([r["often"] for r in sums.select("often").collect()], axis=0).tolist()
        d1 = discounts(often1[:4])
        pairs = sum(r["two"] for r in often)
        root = (often1[0] * d1[1] + often1[1] * d1[2] + often1[4] * d1[3]) / pairs
        floor = root / (often1[5] + 1)
        total, back, prob = np.ones(n, np.float32), np.ones(n, np.float32), np.full(n, floor, np.float32)
        for r in sums.select("n", "symbol", "more").toLocalIterator():
            symbol = unpack_runs(bytes(r["symbol"]), np.arange(r["n"]) == 0)
            begun, *few, ended = unpack(bytes(r["more"]), 5 * r["n"]).reshape(5, -1)
            total[symbol] = np.maximum(begun, 1)
            back[symbol] = np.where(begun > 0, sum(x * d for x, d in zip(few, d2[1:], strict=True)) / np.maximum(begun, 1), 1.0)
            prob[symbol] = np.where(ended > 0, ended - d1[np.minimum(ended, 3)], 0.0) / pairs + floor
        return GramShards(grams.drop("often2", "often3"), shards, shared, context.broadcast(Rates(d2, d3, total, back, prob)))

    def scores(self, base: DataFrame) -> DataFrame:
        """``base`` (id, text, lang, u) without its texts, with the perplexity ``ppl`` of each row."""
        out = None
        for k in range(SLICES):
            free_shuffles(base.sparkSession)
            own = self._scores(base.filter(F.pmod(F.xxhash64("id", "u"), F.lit(SLICES)) == k))
            out = own if out is None else out.unionByName(own)
        free_shuffles(base.sparkSession)
        return out

    def _scores(self, base: DataFrame) -> DataFrame:
        names = [k for k in base.columns if k != "text"]
        fields = [base.schema[k] for k in names]
        lists = StructType().add("chunk", "long").add("rows", "long").add("tokens", "long").add("size", "binary").add("number", "binary")
        for f in fields:
            lists = lists.add(f.name, ArrayType(f.dataType))
        shared, rates, shards = self.vocabulary, self.rates, self.shards

        def chunks(batches):
            task = TaskContext.get().partitionId()
            for k, (number, size, held) in enumerate(_held(batches, shared.value)):
                out = [pa.array([x]) for x in (task << 32 | k, len(size), len(number), pack(size), pack(number))]
                for f in names:
                    column = pa.concat_arrays([b.column(f) for b in held])
                    out.append(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column))
                yield pa.RecordBatch.from_arrays(out, lists.names)

        def read(r):
            return unpack(r["number"], r["tokens"]), unpack(r["size"], r["rows"])

        def ask(batches):
            for b in batches:
                for r in b.select(["chunk", "rows", "tokens", "size", "number"]).to_pylist():
                    g = Asked(*read(r)).grams
                    for s, two, three in g.split(shards):
                        yield pa.RecordBatch.from_pylist([g.part(two, three).record(s, ASK, r["chunk"])], _RECORD)

        def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
            own = texts.combine_chunks()
            r = own.select(["chunk", "rows", "tokens", "size", "number"]).to_pylist()[0]
            number, size = read(r)
            asked = Asked(number, size)
            places = {s: x for s, *x in asked.grams.split(shards)}
            for a in replies.to_pylist():
                two, three = places[a["shard"]]
                asked.counts2[:, two] = unpack(a["counts2"], 5 * a["two"]).reshape(5, -1)
                asked.counts3[three] = unpack(a["counts3"], a["three"])
            ppl = np.exp(np.minimum(-rates.value.logs(number, size, asked) / (size + 1), 700.0))
            return pa.Table.from_arrays([*(own.column(f).chunk(0).flatten() for f in names), pa.array(ppl)], [*names, "ppl"])

        # the texts' numbers pass one shuffle: both what they ask and what they get meets them there (a reused exchange)
        texts = base.mapInArrow(chunks, lists).repartition(max(shards, base.sparkSession.sparkContext.defaultParallelism), "chunk")
        rows = self.grams.unionByName(self.grams.mapInArrow(_contexts(shards), RECORD)).unionByName(texts.mapInArrow(ask, RECORD))
        replies = rows.groupBy("shard").applyInArrow(_answer, _REPLY)
        out = StructType([*fields]).add("ppl", "double")
        return materialise(texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(score, out), "scores")
