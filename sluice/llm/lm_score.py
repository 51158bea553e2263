"""LM scoring by context-tree weighting over bytes, with a unigram base score.

Text is modelled as its lower-cased words joined by one space, then one end byte. Each byte is
eight binary decisions; each decision (the bits of the byte so far) has its own tree over the
bytes before it, ``DEPTH`` deep. A node holds the Krichevsky-Trofimov block probability of its
counts; its weighted probability is half that plus half the product of its children's. The
shares that result mix the estimates of all depths: a bit's probability is
``s0 k0 + (1 - s0)(s1 k1 + (1 - s1)(...))`` along its context, a node never met counting 1/2.

Training counts are ``DEPTH + 1``-grams of bytes, pre-aggregated in the workers and summed by
shuffle (grams met only in held-out texts take part with count 0). All trees below a pair of
nearest context bytes are weighted in one task; what lies above is a small table. Every gram
thus gets its log probability where its trees are, and scoring a text is looking up its grams:
the table lies in the shared folder in shards of at most ``SHARD`` grams (more only if grams with
the same three nearest context bytes are more), which workers read there, one pass per shard. Word
counts reach them up to ``HEAD`` entries; counts of all rarer words are joined.
"""

from __future__ import annotations

import collections
import functools
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, held_out, slices
from sluice.session import scratch_path

DEPTH = 5
SHARD = 6 << 20
HEAD = 1 << 20
END = b"\n"
CHUNK = 3 << 20
WORD, GRAM, DOC = 0, 1, 2
MEMO_BITS = 20


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def word_key(word: bytes) -> int:
    """64-bit hash of a word, as a signed integer."""
    n = xxhash.xxh3_64_intdigest(word)
    return n - (1 << 64) if n >> 63 else n


def gram_codes(seqs: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``depth + 1`` bytes ending at each position of the padded sequences, which positions are
    no padding, and where each sequence begins."""
    pad = END * depth
    data = np.frombuffer(b"".join([p for s in seqs for p in (pad, s)]), np.uint8)
    sizes = np.fromiter((len(s) + depth for s in seqs), np.int64, len(seqs))
    begins = np.cumsum(sizes) - sizes
    codes = np.zeros(len(data), np.int64)
    for back in range(depth, -1, -1):
        codes <<= 8
        codes[back:] |= data[:len(data) - back]
    real = np.ones(len(data), bool)
    for k in range(depth):
        real[begins + k] = False
    return codes, real, begins


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts; sorts in place."""
    codes.sort()
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[at], np.diff(np.r_[at, len(codes)])


def count(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``kind, key, n`` of rows ``text, held_out``: counts of words (by hash), of byte grams,
    and of texts (the ends). Held-out rows only add their grams, with count 0."""

    def batch(kind: int, keys, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int8)), pa.array(np.asarray(keys, np.int64)),
             pa.array(np.asarray(n, np.int64))], ["kind", "key", "n"])

    def run(batches):
        met: collections.Counter = collections.Counter()
        for b in slices(batches, 0, CHUNK):
            out = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            split = [tokens(t) for t in b.column(0).to_pylist()]
            for part in (False, True):
                mine = [ws for ws, o in zip(split, out) if o == part]
                if not mine:
                    continue
                codes, real, _ = gram_codes([b" ".join(ws) + END for ws in mine], depth)
                codes, n = _counted(codes[real])
                yield batch(GRAM, codes, n * (not part))
                if not part:
                    yield batch(DOC, [0], [len(mine)])
                    for ws in mine:
                        met.update(ws)
            if len(met) > 200_000:
                yield batch(WORD, list(map(word_key, met)), list(met.values()))
                met.clear()
        if met:
            yield batch(WORD, list(map(word_key, met)), list(met.values()))

    return docs.select("text", "held_out").mapInArrow(run, "kind byte, key long, n long") \
        .groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after seven steps up."""
    up = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    y = x + 7
    return ((y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi)
            + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - np.log(up))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a block with these counts."""
    a, b = zeros.astype(float), ones.astype(float)
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1)


def weigh(zeros, ones, below) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A node's estimate of a one, its share against deeper nodes, and the log of its weighted
    probability; ``below`` is the log product of its children's, None at full depth."""
    own = log_kt(zeros, ones)
    guess = (ones + 0.5) / (zeros + ones + 1)
    if below is None:
        return guess, np.ones(len(own)), own
    both = np.logaddexp(own, below) - math.log(2)
    return guess, np.exp(own - math.log(2) - both), both


def bit_nodes(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zeros and ones seen at each decision: key = context bytes, then the bits so far behind
    a leading one."""
    symbol, context = codes & 255, codes & ~np.int64(255)
    keys = np.concatenate([context | (1 << i) | (symbol >> (8 - i)) for i in range(8)])
    bits = np.concatenate([(symbol >> (7 - i)) & 1 for i in range(8)])
    node, at = np.unique(keys, return_inverse=True)
    n = np.tile(n, 8).astype(float)
    ones = np.bincount(at, n * bits, len(node))
    return node, np.bincount(at, n, len(node)) - ones, ones


def shorten(keys: np.ndarray, depth: int) -> np.ndarray:
    """Node keys of context length ``depth``."""
    return keys & ((np.int64(1) << 8 * (depth + 1)) - 1)


def tree(codes: np.ndarray, n: np.ndarray, depth: int, top: int):
    """``(depth, key, guess, share, zeros, ones, logw)`` of all nodes from ``depth`` up to
    ``top``, deepest first; the grams hold whole subtrees of depth ``top``."""
    below = None
    for d in range(depth, top - 1, -1):
        key, zeros, ones = bit_nodes(shorten(codes, d), n)
        inner = None
        if below is not None:
            parent = np.searchsorted(key, shorten(below[0], d))
            inner = np.bincount(parent, below[1], len(key))
        guess, share, logw = weigh(zeros, ones, inner)
        yield d, key, guess, share, zeros, ones, logw
        below = key, logw


def mixed(nodes: list[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Top-down: from ``(key, guess, share)`` per depth to ``(key, probability of a one)``, the
    probability that holds where no deeper node was met."""
    out, above = [], None
    for d, (key, guess, share) in enumerate(nodes):
        if above is None:
            held, rest = np.zeros(len(key)), np.ones(len(key))
        else:
            at = np.searchsorted(above[0], shorten(key, d - 1))
            held, rest = above[1][at], above[2][at]
        held, rest = held + rest * share * guess, rest * (1 - share)
        above = key, held, rest
        out.append((key, held + rest / 2))
    return out


def gram_scores(levels: list[tuple[np.ndarray, np.ndarray]], codes: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's last byte, from the deepest node met per bit."""
    out = np.zeros(len(codes))
    symbol, context = codes & 255, codes & ~np.int64(255)
    for i in range(8):
        key = context | (1 << i) | (symbol >> (8 - i))
        one = np.full(len(codes), 0.5)
        left = np.arange(len(codes))
        for d in range(len(levels) - 1, -1, -1):
            keys, p = levels[d]
            if not len(keys) or not len(left):
                continue
            want = shorten(key[left], d)
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            met = keys[at] == want
            one[left[met]] = p[at[met]]
            left = left[~met]
        out += np.log10(np.where((symbol >> (7 - i)) & 1, one, 1 - one))
    return out


def _partition(batches) -> tuple[np.ndarray, np.ndarray] | None:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else None


def by_pair(grams: DataFrame) -> DataFrame:
    """Grams dealt by their pair of nearest context bytes: whole trees from depth 2 on."""
    pair = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    return grams.select("key", "n").repartition(pair)


def roots(grams: DataFrame, depth: int = DEPTH) -> list[tuple]:
    """``(key, guess, share)`` of depths 0 and 1: 65,536 nodes at most."""
    names = ["k", "zeros", "ones", "logw"]

    def run(batches):
        if (got := _partition(batches)) is None:
            return
        codes, n = got
        *_, (_, key, _, _, zeros, ones, logw) = tree(codes, n, depth, 2)
        k, at = np.unique(shorten(key, 1), return_inverse=True)
        sums = [np.bincount(at, x, len(k)) for x in (zeros, ones, logw)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (k, *sums)], names)

    low = by_pair(grams.filter("n > 0")).mapInArrow(
        run, "k long, zeros double, ones double, logw double") \
        .groupBy("k").agg(*[F.sum(c) for c in names[1:]])
    k1, zeros, ones, below = _arrays(low)
    order = np.argsort(k1)
    k1, zeros, ones, below = (x[order] for x in (k1, zeros, ones, below))
    g1, s1, w1 = weigh(zeros, ones, below)
    k0, at = np.unique(shorten(k1, 0), return_inverse=True)
    g0, s0, _ = weigh(*(np.bincount(at, x, len(k0)) for x in (zeros, ones, w1)))
    return [(k0, g0, s0), (k1, g1, s1)]


def near_context(codes):
    """The pair of nearest context bytes and the one before it as an integer below 2^24; of
    numbers or a column."""
    if isinstance(codes, np.ndarray):
        return (codes >> 8 & 0xFFFF) << 8 | codes >> 24 & 0xFF
    pair = F.shiftright(codes, 8).bitwiseAND(F.lit(0xFFFF))
    return F.shiftleft(pair, 8).bitwiseOR(F.shiftright(codes, 24).bitwiseAND(F.lit(0xFF)))


def shard_bounds(grams: DataFrame, limit: int) -> list[int]:
    """Where shards of ``limit`` grams begin (``near_context``), the first one's 0 left out. A
    pair of nearest bytes with more grams than that is split by the byte before it."""
    sizes = grams.select(near_context(F.col("key")).alias("at"))
    pair = F.shiftright("at", 8)
    by = sizes.groupBy(pair.alias("pair")).count().collect()  # 65,536 at most
    parts = [(r["pair"] << 8, r["count"]) for r in by if r["count"] <= limit]
    if hot := [r["pair"] for r in by if r["count"] > limit]:
        parts += [tuple(r) for r in sizes.filter(pair.isin(hot)).groupBy("at").count().collect()]
    bounds, used = [], 0
    for at, size in sorted(parts):
        if used and used + size > limit:
            bounds.append(at)
            used = 0
        used += size
    return bounds


def score_grams(grams: DataFrame, depth: int = DEPTH, bounds: list[int] = ()) -> DataFrame:
    """``shard, key, score``: log10 probability of every gram's last byte."""
    top = grams.sparkSession.sparkContext.broadcast(roots(grams, depth))

    def run(batches):
        if (got := _partition(batches)) is None:
            return
        codes, n = got
        deep = [x[1:4] for x in tree(codes[n > 0], n[n > 0], depth, 2)] if n.any() else \
            [tuple(np.zeros(0, t) for t in (np.int64, float, float))] * (depth - 1)
        score = gram_scores(mixed([*top.value, *reversed(deep)]), codes)
        shard = np.searchsorted(np.array(bounds, np.int64), near_context(codes), side="right") \
            .astype(np.int32)
        for i in range(0, len(codes), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[i:i + 100_000]) for c in (shard, codes, score)],
                ["shard", "key", "score"])

    return by_pair(grams).mapInArrow(run, "shard int, key long, score double")


def shard_arrays(folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order, and scores of a shard; none if nothing was written."""
    fs, path = pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
    found = fs.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
    files = [pq.ParquetFile(fs.open_input_file(f.path)) for f in found
             if f.path.endswith(".parquet")]
    n, at = sum(f.metadata.num_rows for f in files), 0
    keys, scores = np.empty(n, np.int64), np.empty(n)
    for f in files:
        got = f.read(["key", "score"])
        keys[at:at + len(got)], scores[at:at + len(got)] = (c.to_numpy() for c in got.columns)
        at += len(got)
        f.close(force=True)
    order = np.argsort(keys, kind="stable")  # files are sorted: this merges them
    return keys[order], scores[order]


class Scorer:
    """Sums the scores of a text's grams, those of one shard."""

    def __init__(self, folder: str, nth: int, bounds: tuple[int, ...], depth: int):
        self.keys, self.scores = shard_arrays(f"{folder}/shard={nth}")
        self.depth, self.split = depth, bool(bounds)
        self.first, self.end = [0, *bounds][nth], [*bounds, 1 << 24][nth]
        self.memo = np.full(1 << MEMO_BITS, -1, np.int64), np.zeros(1 << MEMO_BITS)

    def __call__(self, seqs: list[bytes]) -> np.ndarray:
        codes, real, begins = gram_codes(seqs, self.depth)
        if self.split:
            at = near_context(codes)
            real &= (at >= self.first) & (at < self.end)
        keys, values = self.memo
        slot = ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                >> np.uint64(64 - MEMO_BITS)).view(np.int64)
        found = values[slot]
        new = np.flatnonzero((keys[slot] != codes) & real)
        if len(new):
            met, at = np.unique(codes[new], return_inverse=True)
            place = np.searchsorted(self.keys, met)
            if len(self.keys) <= place.max() or (self.keys[place] != met).any():
                raise ValueError("a text was not there when grams were counted")
            found[new] = self.scores[place][at]
            keys[slot[new]], values[slot[new]] = codes[new], found[new]
        found[~real] = 0
        return np.add.reduceat(found, begins) if len(begins) else np.zeros(0)


@functools.lru_cache(maxsize=1)
def _scorer(*shard) -> Scorer:
    return Scorer(*shard)


class Base:
    """Unigram terms of the frequent words; None for a word that has to be joined."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, z: float):
        self.keys, self.counts, self.z = keys, counts, z
        self.cache: dict[bytes, float | None] = {}

    def terms(self, ws: list[bytes]) -> tuple[float, int, list[int]]:
        """Sum of terms, how many words they are, and the hashes of the others."""
        cache = self.cache
        new = [w for w in set(ws) if w not in cache]
        if new:
            if len(cache) > 200_000:
                cache.clear()
                new = list(set(ws))
            h = np.array(list(map(word_key, new)), np.int64)
            at = np.minimum(np.searchsorted(self.keys, h), max(len(self.keys) - 1, 0))
            met = self.keys[at] == h if len(self.keys) else np.zeros(len(h), bool)
            for w, i, ok in zip(new, at.tolist(), met.tolist()):
                cache[w] = math.log10((self.counts[i] + 0.5) / self.z) if ok else None
        found = [cache[w] for w in ws]
        rare = [word_key(w) for w, t in zip(ws, found) if t is None] if None in found else []
        known = [t for t in found if t is not None] if rare else found
        return math.fsum(known), len(known), rare


@functools.lru_cache(maxsize=1)
def _base(held) -> Base:
    return Base(*held.value)


def _arrays(df: DataFrame) -> list[np.ndarray]:
    got = df.toArrow()
    return [c.to_numpy() for c in got.columns]


def evaluate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
             fold: int = 1, depth: int = DEPTH, shard_size: int = SHARD,
             head_size: int = HEAD) -> DataFrame:
    """Learns from the rows outside the held-out fold, scores every row:
    ``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    A null or empty text is the end alone. A null id is never held out, repeated rows are
    learned and scored each, and an empty table gives an empty result. If nothing was learned,
    ``base_score`` is null and every bit of the model counts 1/2.
    """
    spark = docs.sparkSession
    out = held_out(F.col("key"), folds, fold)
    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    counts = cut(count(src.select("text", out.alias("held_out")), depth), "lm-counts")

    # model: gram scores, in shards by nearest context bytes
    grams = counts.filter(F.col("kind") == GRAM)
    bounds = tuple(shard_bounds(grams, shard_size))
    model = scratch_path(spark, "lm-grams")
    score_grams(grams, depth, bounds).sortWithinPartitions("shard", "key") \
        .write.partitionBy("shard").parquet(model)

    # base: totals, and the counts of the words frequent enough to travel
    total = counts.groupBy("kind", F.floor(F.log2("n")).alias("b")) \
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    n_docs = sum(r["n"] for r in total if r["kind"] == DOC)
    n_train = n_docs + sum(r["n"] for r in total if r["kind"] == WORD)
    z = n_train + 0.5 * (sum(r["v"] for r in total if r["kind"] == WORD) + (n_docs > 0) + 1)
    least, fits = 1 << 62, 0
    for r in sorted((r for r in total if r["kind"] == WORD), key=lambda r: -r["b"]):
        fits += r["v"]
        if fits > head_size:
            break
        least = 1 << r["b"]
    word_counts = counts.filter(F.col("kind") == WORD)
    keys, n = _arrays(word_counts.filter(F.col("n") >= F.lit(least)).select("key", "n"))
    order = np.argsort(keys)
    base = spark.sparkContext.broadcast((keys[order], n[order], z))
    end = math.log10((n_docs + 0.5) / z)

    def scorer(nth, own):
        def run(batches):
            score_of = _scorer(model, nth, bounds, depth)
            for b in slices(batches, 1, CHUNK // 2):
                split = [tokens(t) for t in b.column(1).to_pylist()]
                seqs = [b" ".join(ws) + END for ws in split]
                score = pa.array(score_of(seqs), pa.float64())
                if not own:
                    yield pa.RecordBatch.from_arrays([b.column(0), score], ["key", "score"])
                    continue
                uni = _base(base)
                terms = [uni.terms(ws) for ws in split]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), score, pa.array([len(s) for s in seqs], pa.int64()),
                     pa.array([len(ws) + 1 for ws in split], pa.int64()),
                     pa.array([t[1] for t in terms], pa.int64()),
                     pa.array([t[0] for t in terms], pa.float64()),
                     pa.array([t[2] for t in terms], pa.list_(pa.int64()))],
                    ["key", "print", "score", "n_bytes", "n_tokens", "n_known", "base", "rare"])
        return run

    # a print of the text ties the passes of several shards together
    kind = src.schema["key"].dataType.simpleString()
    mark = F.md5("text") if bounds else F.lit("")
    rows = src.select("key", "text", mark.alias("print")).mapInArrow(
        scorer(0, True), f"key {kind}, print string, score double, n_bytes long, "
        "n_tokens long, n_known long, base double, rare array<long>")
    rows = cut(rows.withColumn("rid", F.monotonically_increasing_id()), "lm-rows")
    result = rows
    for nth in range(1, len(bounds) + 1):
        more = src.select(F.md5("text").alias("key"), "text").dropDuplicates(["key"]).mapInArrow(
            scorer(nth, False), "key string, score double")
        more = more.select(F.col("key").alias("of"), F.col("score").alias("more"))
        result = result.join(more, F.col("print").eqNullSafe(F.col("of")), "left") \
            .withColumn("score", F.col("score") + F.col("more")).drop("of", "more")
    seldom = word_counts.filter(F.col("n") < F.lit(least)).select(F.col("key").alias("h"), "n")
    rare = (rows.select("rid", F.explode("rare").alias("h")).join(seldom, "h", "left")
            .groupBy(F.col("rid").alias("of"))
            .agg(F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(z))).alias("more"),
                 F.count("n").alias("met")))
    result = result.join(rare, F.col("rid") == F.col("of"), "left")
    learned = F.lit(n_docs > 0)
    return result.select(
        F.col("key").alias(id_col), out.alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("met", F.lit(0)) + F.lit(int(n_docs > 0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        F.when(learned, F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(end))
        .alias("base_score"),
        "score", (-F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
