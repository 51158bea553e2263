"""MinHash near-dedup with odd sketches.

1. A pass over the texts makes each document's shingle set (64-bit hashes), a 128-bit print of
   the set, ``BANDS`` band keys of ``ROWS`` MinHash samples and an odd sketch: a bitmap in
   which each sample flips one bit. Documents with equal sets form a class; all later steps
   work on one representative per class.
2. Classes that share a band key are candidates. In each bucket every member meets one hub
   only. The population count of two sketches' XOR estimates the similarity of the samples;
   pairs clearly below the threshold are dropped, the others are confirmed on their full sets.
3. Confirmed links give components. Where a bucket still holds several, small buckets pair
   their members across components; in crowded ones only pairs that can reach the threshold
   are made, from the members' exact overlap with the hub (``across``).

Full sets are made again from the texts, only for documents that a bitmap of fixed size admits.
A linked pair is missed if no band key agrees: (1 - 0.75^4)^32 = 5e-6 at the threshold, less
above it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, fresh, slices
from sluice.llm.graph import components

SHINGLE = 5
BANDS, ROWS = 32, 4
SKETCH = 1024
SPLIT = 64
FILTER_BITS = 26
BLOCK_BITS = 18
CACHE_SIZE = 150_000
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """Word to 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_SIZE:
            self[word] = h
        return h


_words = _Words()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; fewer words are one shingle."""
    ws = (text or "").encode("utf-8", "replace").lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, ws), np.uint64, len(ws))
    if len(ws) < size:
        x = np.array([len(ws)], np.uint64)
        for w in h:
            x = _mix(x * _MUL + w)
        return x
    n = len(h) - size + 1
    x = h[:n]
    for i in range(1, size):
        x = x * _MUL + h[i:n + i]
    return np.unique(_mix(x))


class Sampler:
    """MinHash samples, band keys and odd sketch of a shingle set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = bands * rows
        self.bands, self.rows, self.bits = bands, rows, bits
        self.flip = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        self.factor = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.of_band = _mix(np.arange(1, bands + 1, dtype=np.uint64))
        self.of_sample = _mix(np.arange(1, n + 1, dtype=np.uint64) << np.uint64(32))

    def samples(self, shingled: np.ndarray) -> np.ndarray:
        x = (shingled >> np.uint64(32)).astype(np.uint32)[:, None]
        least = None
        for i in range(0, len(x), 512):
            part = ((x[i:i + 512] ^ self.flip) * self.factor).min(axis=0)
            least = part if least is None else np.minimum(least, part)
        return least

    def keys(self, samples: np.ndarray) -> np.ndarray:
        key = self.of_band.copy()
        for column in samples.reshape(self.bands, self.rows).T:
            key = _mix(key * _MUL + column)
        return key.view(np.int64)

    def sketch(self, samples: np.ndarray) -> bytes:
        at = _mix(samples.astype(np.uint64) + self.of_sample) % np.uint64(self.bits)
        odd = np.bincount(at.astype(np.int64), minlength=self.bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()


def flips_allowed(threshold: float, samples: int = BANDS * ROWS, bits: int = SKETCH) -> int:
    """XOR population count that a pair at the threshold exceeds about once in a million: 5
    deviations above the mean. Each of ``differ`` differing samples flips two bits at random, so
    both their number and their chance meetings spread the count."""
    p = 1 - threshold
    differ = samples * p
    keep = (1 - 2 / bits) ** (2 * differ)
    mean = bits * (1 - keep) / 2
    of_samples = 2 * keep * (samples * p * (1 - p)) ** 0.5
    of_meetings = (bits * (1 - keep ** 2) / 4 - 2 * differ * keep ** 2) ** 0.5
    return int(mean + 5 * (of_samples ** 2 + of_meetings ** 2) ** 0.5)


def estimate(flips: int, samples: int = BANDS * ROWS, bits: int = SKETCH) -> float:
    """Similarity estimated from the XOR population count of two sketches."""
    left = 1 - 2 * min(flips, bits / 2 - 0.5) / bits
    return max(0.0, 1 + bits * float(np.log(left)) / (4 * samples))


def signatures(src: DataFrame, sampler: Sampler) -> DataFrame:
    """``id, mark, n_shingles, print, bands, sketch`` of rows ``id, text, mark``."""
    def run(batches):
        for b in slices(batches, 1):
            rows = []
            for text in b.column(1).to_pylist():
                s = shingles(text)
                if len(s):
                    m = sampler.samples(s)
                    rows.append((len(s), hashlib.md5(s.tobytes()).digest(), sampler.keys(m),
                                 sampler.sketch(m)))
                else:
                    rows.append((0, None, None, None))
            n, mark, bands, sketch = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(mark, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["id", "mark", "n_shingles", "print", "bands", "sketch"])

    kind = src.schema["id"].dataType.simpleString()
    return src.select("id", "text", "mark").mapInArrow(
        run, f"id {kind}, mark long, n_shingles long, print binary, bands array<long>, "
             "sketch binary")


def _admitted(wanted: DataFrame) -> np.ndarray:
    """Bitmap of ``2^FILTER_BITS`` bits with a bit set for the hash of every wanted id."""
    slot = F.shiftrightunsigned(F.xxhash64("id"), 64 - FILTER_BITS)
    bits = wanted.select(slot.alias("slot")).selectExpr(
        "shiftright(slot, 6) AS w", "shiftleft(1L, CAST(slot & 63 AS int)) AS b")
    got = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << FILTER_BITS - 6, np.int64)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy()
    return out


def full_sets(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid, shingles`` (64-bit hashes, sorted, as bytes) of the wanted classes
    (``cid, id, print``), from the texts of their representatives."""
    context = src.sparkSession.sparkContext
    bits = context.broadcast(_admitted(wanted))  # 2^FILTER_BITS bits, whatever the input
    slot = F.shiftrightunsigned(F.xxhash64("id"), 64 - FILTER_BITS).alias("slot")

    def run(batches):
        table = bits.value
        for b in batches:
            at = b.column(2).to_numpy()
            b = b.filter(pa.array((table[at >> 6] >> (at & 63)) & 1 == 1))
            for part in slices([b], 1):
                made = [shingles(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([hashlib.md5(s.tobytes()).digest() for s in made],
                                              pa.binary()),
                     pa.array([s.tobytes() for s in made], pa.binary())],
                    ["id", "print", "shingles"])

    kind = src.schema["id"].dataType.simpleString()
    made = src.select("id", "text", slot).mapInArrow(
        run, f"id {kind}, print binary, shingles binary")
    made = made.toDF("id2", "print2", "shingles")
    keep = (F.col("id").eqNullSafe(F.col("id2"))) & (F.col("print") == F.col("print2"))
    return made.join(wanted, keep).select("cid", "shingles").dropDuplicates(["cid"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with 100 * intersection >= percent * union of their full sets."""
    def run(batches):
        for b in batches:
            for part in slices([b], 2, 4 << 20):
                ok = []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * same >= percent * (len(x) + len(y) - same))
                yield pa.RecordBatch.from_arrays(part.columns[:2], ["a", "b"]).filter(pa.array(ok))

    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y") \
        .mapInArrow(run, "a long, b long")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int, flips: int) -> DataFrame:
    """Candidate pairs whose set sizes allow the threshold and whose sketches don't rule it
    out."""
    words = [F.conv(F.hex(F.substring("sketch", 8 * i + 1, 8)), 16, -10).cast("long")
             for i in range(SKETCH // 64)]
    small = classes.select("cid", "n_shingles", F.array(*words).alias("bits"))
    pairs = (pairs.join(small.toDF("a", "na", "xa"), "a").join(small.toDF("b", "nb", "xb"), "b")
             .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    apart = sum((F.bit_count(F.col("xa")[i].bitwiseXOR(F.col("xb")[i]))
                 for i in range(SKETCH // 64)), F.lit(0))
    return pairs.filter(apart <= flips).select("a", "b")


def link(src: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures, classes and confirmed links (``a, b``: class ids) of rows ``id, text``."""
    flips = flips_allowed(percent / 100)
    sig = cut(signatures(src, Sampler()), "minhash-signatures")
    first = sig.filter("n_shingles > 0").groupBy("print").agg(
        F.min("id").alias("id"), F.min_by("n_shingles", "n_shingles").alias("n_shingles"))
    # bands and sketch depend on the print alone: any row of the class has them
    one = sig.select(F.col("id").alias("id2"), F.col("print").alias("print2"), "bands", "sketch")
    classes = first.join(one, (F.col("print") == F.col("print2"))
                         & F.col("id").eqNullSafe(F.col("id2")))
    classes = cut(classes.select("id", "print", "n_shingles", "bands", "sketch")
                  .withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")
    member = classes.select("cid", F.explode("bands").alias("bucket"))
    sizes = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(member.join(sizes, "bucket"), "minhash-buckets")
    # the hub of a bucket: the class with the most company in all its buckets (the origin of a
    # group of edited copies has more than any copy)
    company = shared.groupBy("cid").agg(F.sum("n").alias("company"))
    hubs = shared.join(company, "cid").groupBy("bucket").agg(
        F.max(F.struct("company", "cid"))["cid"].alias("hub"))
    shared = cut(shared.join(hubs, "bucket"), "minhash-hubs")

    def tested(pairs: DataFrame) -> DataFrame:
        pairs = pairs.filter("a != b").select(F.least("a", "b").alias("a"),
                                              F.greatest("a", "b").alias("b")).distinct()
        pairs = cut(_plausible(pairs, classes, percent, flips), "minhash-pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct() \
            .join(classes.select("cid", "id", "print"), "cid")
        sets = cut(full_sets(src, cut(wanted, "minhash-wanted")), "minhash-sets")
        return cut(confirm(pairs, sets, percent), "minhash-links")

    links = tested(shared.select(F.col("hub").alias("a"), F.col("cid").alias("b")))
    # buckets that hold several components
    roots = cut(components(links), "minhash-roots").toDF("cid", "root")
    placed = shared.select("bucket", "cid", "hub").join(roots, "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    mixed = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all"),
                               F.max("n").alias("most")) \
        .filter("parts > 1") \
        .select("bucket", (F.col("all") * (F.col("all") - F.col("most")) <= SPLIT).alias("few"))
    placed = cut(placed.join(mixed, "bucket"), "minhash-mixed")
    x = placed.filter("few").select("bucket", F.col("cid").alias("a"), F.col("root").alias("ra"))
    pairs = x.join(x.toDF("bucket", "b", "rb"), "bucket").filter("a < b and ra != rb")
    group = cut(headed(placed.filter("not few").select("hub", "cid", "root").distinct(), links,
                       company, roots), "minhash-groups")
    wanted = cut(group.select(F.explode(F.array("cid", "hub")).alias("cid")).distinct()
                 .join(classes.select("cid", "id", "print"), "cid"), "minhash-wanted")
    pairs = pairs.select("a", "b").union(
        across(group, cut(full_sets(src, wanted), "minhash-sets"), percent))
    return sig, classes, links.union(tested(pairs))


def headed(group: DataFrame, links: DataFrame, company: DataFrame, roots: DataFrame) -> DataFrame:
    """The crowds (``hub, cid, root``), each at its hub's head: the linked hub with the most
    company, where that is more than the hub's own. A head is a member of its crowd."""
    hubs = group.select("hub").distinct().join(company.toDF("hub", "company"), "hub")
    ends = links.union(links.select("b", "a")).toDF("hub", "head")
    best = ends.join(hubs, "hub").join(hubs.toDF("head", "more"), "head") \
        .filter(F.struct("more", "head") > F.struct("company", "hub")) \
        .groupBy("hub").agg(F.max(F.struct("more", "head"))["head"].alias("head"))
    moved = group.join(best, "hub", "left").select(
        F.coalesce("head", "hub").alias("hub"), "cid", "root")
    own = moved.select("hub").distinct().join(roots.toDF("hub", "root"), "hub", "left") \
        .select("hub", F.col("hub").alias("cid"), F.coalesce("root", "hub").alias("root"))
    return moved.union(own).distinct()


def across(group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components that can reach the threshold among the members
    (``hub, cid, root``) of crowded buckets, without pairing all members.

    Of x and y, both compared to their hub h, a common shingle lies in h or in the rests of
    both outside h. Either x and y share a shingle outside h: these pairs come from a join on
    such shingles. Or their intersection is at most min(|x & h|, |y & h|): then each one's
    overlap with h caps the other's size, and these pairs come from a join on sizes, from the
    members outside the hub's component (inside it nothing has to be linked).
    """
    share = percent / (100 + percent)  # intersection >= share * (sum of sizes)

    def rest(batches):
        for b in batches:
            for part in slices([b], 3, 4 << 20):
                sizes, common, tokens = [], [], []
                for x, h in zip(part.column(3).to_pylist(), part.column(4).to_pylist()):
                    x, h = np.frombuffer(x, np.uint64), np.frombuffer(h, np.uint64)
                    inside = np.isin(x, h, assume_unique=True)
                    sizes.append(len(x))
                    common.append(int(inside.sum()))
                    tokens.append(x[~inside].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(sizes, pa.int64()), pa.array(common, pa.int64()),
                     pa.array(tokens, pa.list_(pa.int64()))],
                    ["hub", "cid", "root", "n", "o", "rest"])

    known = group.join(sets, "cid").join(sets.toDF("hub", "of_hub"), "hub") \
        .select("hub", "cid", "root", "shingles", "of_hub").mapInArrow(
            rest, "hub long, cid long, root long, n long, o long, rest array<long>")
    # the largest size that a partner without shared rest can have
    known = cut(known.withColumn("cap", F.floor(F.col("o") / F.lit(share) + 1e-6) - F.col("n")),
                "minhash-rest")
    token = _foreign_tokens(cut(_shared(known), "minhash-shared"))
    several = token.groupBy("hub", "token").agg(F.min("root").alias("r1"),
                                                F.max("root").alias("r2"),
                                                F.count(F.lit(1)).alias("df")) \
        .filter("r1 != r2").select("hub", "token", "df")
    # with any partner, x has to share so many shingles outside the hub that one of its rarest
    # (those of a single component first) is among them, and among the partner's rarest
    need = F.greatest(F.lit(1), F.ceil(F.col("n") * percent / 100 - F.col("o") - 1e-6))
    own = Window.partitionBy("hub", "cid")
    token = token.join(several, ["hub", "token"]) \
        .withColumn("held", F.count(F.lit(1)).over(own)) \
        .withColumn("nth", F.row_number().over(own.orderBy("df", "token"))) \
        .filter(F.col("r") - F.col("held") + F.col("nth") <= F.col("r") - need + 1)
    # shingles outside the hub from this one on, in that order
    token = token.withColumn("left", F.col("held") - F.col("nth") + 1)
    token = cut(token.select("hub", "token", "cid", "root", "n", "o", "left"), "minhash-tokens")
    x = token.toDF("hub", "token", "a", "ra", "na", "oa", "la")
    y = token.toDF("hub", "token", "b", "rb", "nb", "ob", "lb")
    # what both can share inside the hub, and outside from their first common shingle on, has
    # to reach the threshold
    most = F.least("oa", "ob") + F.least("la", "lb")
    outside = x.join(y, ["hub", "token"]).filter(
        "a < b and ra != rb").filter(most + 1e-6 >= share * (F.col("na") + F.col("nb"))) \
        .select("a", "b").distinct()
    main = known.filter("hub = cid").select("hub", F.col("root").alias("main"))
    least = F.ceil(F.col("n") * percent / 100).cast("long")
    x = known.join(main, "hub").filter((F.col("root") != F.col("main")) & (F.col("cap") >= least))
    x = x.select("hub", F.col("cid").alias("a"), F.col("root").alias("ra"),
                 F.col("n").alias("na"), F.explode(F.sequence(least, F.col("cap"))).alias("n"))
    y = known.select("hub", "n", F.col("cid").alias("b"), F.col("root").alias("rb"), "cap")
    inside = x.join(y, ["hub", "n"]).filter("ra != rb and na <= cap").select("a", "b")
    return outside.union(inside)


def _slots(hub: np.ndarray, token: np.ndarray, words: int) -> np.ndarray:
    """A slot below ``64 * words`` (a power of two) for each hub and shingle."""
    x = _mix(_mix(hub.view(np.uint64)) * _MUL + token.view(np.uint64))
    return (x & np.uint64(64 * words - 1)).astype(np.int64)


def _slotted(hub: pa.Array, rest: pa.Array, words: int) -> tuple[np.ndarray, ...]:
    """Slot and shingle of every element of the lists ``rest``, and the lists' bounds in them."""
    ends = np.r_[0, np.cumsum(pc.list_value_length(rest).to_numpy())]
    token = rest.flatten().to_numpy()
    return _slots(np.repeat(hub.to_numpy(), np.diff(ends)), token, words), token, ends


def _thinned(token: np.ndarray, ends: np.ndarray, ok: np.ndarray) -> pa.Array:
    """The lists with only the elements that are ``ok``."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(ok)][ends], pa.int32()),
                                    pa.array(token[ok]))


def _extent(at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each slot once, in order, with its least ``lo`` and greatest ``hi``."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first)


def _shared(known: DataFrame, words: int = 1 << FILTER_BITS - 6) -> DataFrame:
    """``hub, cid, root, n, o, rest`` of all members, without the shingles that only one
    component of the hub's crowd has (a few of them stay): edits of a single copy are neither
    rows nor counted.

    Hub and shingle have a slot in a bitmap of ``words`` (a power of two) words of 64 bits, set
    where members of two components meet. Blocks of slots are dealt to tasks as arrays.
    """
    size = min(1 << BLOCK_BITS, 64 * words)

    def parts(batches):
        for b in batches:
            step = max(1, b.num_rows * (4 << 20) // max(1, b.column(5).nbytes))
            for i in range(0, b.num_rows, step):
                yield b.slice(i, step)

    def seen(batches):
        for b in parts(batches):
            at, _, ends = _slotted(b.column(0), b.column(5), words)
            if not len(at):
                continue
            root = np.repeat(b.column(2).to_numpy(), np.diff(ends))
            at, lo, hi = _extent(at, root, root)
            block = at // size
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            ends = pa.array(np.r_[first, len(at)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[first]), *(pa.ListArray.from_arrays(ends, pa.array(x))
                                           for x in (at, lo, hi))], ["block", "at", "lo", "hi"])

    def meet(group):
        at, lo, hi = _extent(*(pc.list_flatten(group.column(c)).to_numpy()
                               for c in ("at", "lo", "hi")))
        bits = np.zeros(size, np.uint8)
        bits[at[lo != hi] % size] = 1
        return pa.table({"block": group.column("block").slice(0, 1), "bits": pa.array(
            [np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    cols = ["hub", "cid", "root", "n", "o", "rest"]
    met = known.select(cols).mapInArrow(
        seen, "block long, at array<long>, lo array<long>, hi array<long>") \
        .groupBy("block").applyInArrow(meet, "block long, bits binary").toArrow()  # fixed size
    table = np.zeros(8 * words, np.uint8)
    for block, bits in zip(met.column("block").to_pylist(), met.column("bits").to_pylist()):
        table[block * size // 8:(block + 1) * size // 8] = np.frombuffer(bits, np.uint8)
    table = known.sparkSession.sparkContext.broadcast(table)

    def thin(batches):
        for b in parts(batches):
            at, token, ends = _slotted(b.column(0), b.column(5), words)
            ok = table.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], _thinned(token, ends, ok)], cols)

    return known.select(cols).mapInArrow(
        thin, "hub long, cid long, root long, n long, o long, rest array<long>")


def _foreign_tokens(known: DataFrame, words: int = 1 << FILTER_BITS - 6) -> DataFrame:
    """Shingles outside the hub that a pair of different components can share, one row per
    member: all of those outside the hub's largest component, and of that one's members only
    the shingles that some other component has, so a large group of copies does not become rows.

    The others' shingles meet the largest component as a bitmap of ``words`` (a power of two)
    words of 64 bits, then exactly: no member meets the shingles of a whole crowd.
    """
    cols = ["hub", "cid", "root", "n", "o", F.size("rest").alias("r")]
    largest = known.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("members")) \
        .groupBy("hub").agg(F.max(F.struct("members", "root"))["root"].alias("largest"))
    placed = known.join(largest, "hub")
    other = placed.filter("root != largest").select(*cols, F.explode("rest").alias("token"))
    other = cut(other, "minhash-foreign")

    def slot(batches):
        for b in batches:
            at = _slots(b.column(0).to_numpy(), b.column(1).to_numpy(), words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], ["w", "b"])

    bits = other.select("hub", "token").mapInArrow(slot, "w long, b long") \
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # fixed size, whatever the input
    table = np.zeros(words, np.int64)
    table[bits.column("w").to_numpy()] = bits.column("b").to_numpy()
    table = known.sparkSession.sparkContext.broadcast(table)

    def meet(batches):
        for b in batches:
            at, token, ends = _slotted(b.column(0), b.column(6), words)
            ok = (table.value[at >> 6] >> (at & 63)) & 1 == 1
            yield pa.RecordBatch.from_arrays([*b.columns[:6], _thinned(token, ends, ok)], names)

    names = ["hub", "cid", "root", "n", "o", "r", "met"]
    met = placed.filter("root = largest").select(
        *(F.col(c).cast("long").alias(c) for c in names[:5]), F.size("rest").cast("long").alias("r"),
        "rest").mapInArrow(meet, "hub long, cid long, root long, n long, o long, r long, "
                                 "met array<long>") \
        .select("hub", "cid", "root", "n", "o", F.col("r").cast("int").alias("r"),
                F.explode("met").alias("token"))
    met = met.join(other.select("hub", "token").distinct(), ["hub", "token"], "left_semi")
    return other.unionByName(met)


def _named(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """``id, mark, n_shingles, component`` of every row; ``mark`` is a hash of the text."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sig, classes, links = link(src.withColumn("mark", F.xxhash64("text")), percent)
    roots = cut(components(links), "minhash-roots").toDF("cid", "root")
    named = classes.select("cid", "id", "print").join(roots, "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    named = cut(named.select("print", "root", "id"), "minhash-named")
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    named = named.drop("id").join(least, "root").select(F.col("print").alias("of"), "component")
    rows = sig.select("id", "mark", "n_shingles", "print") \
        .join(named, F.col("print") == F.col("of"), "left")
    part = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component"))
    return rows.select("id", "mark", "n_shingles", part.alias("component"))


def near_dups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              percent: int = 75) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row.

    Documents with 100 * intersection >= ``percent`` * union of their sets of 5-word shingles
    are linked; ``component_id`` is the smallest id of those reachable. A text without words
    (or null) has no shingles and is linked with nothing. Equal texts under one id are rows of
    one document; null ids take part but never name a component that has another id. An empty
    table gives an empty result; other columns are not read.
    """
    return _named(docs, id_col, text_col, percent).select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          percent: int = 75) -> DataFrame:
    """The kept rows of ``docs``, all columns unchanged, whatever their names; of rows that
    repeat an id and its text one stays.

    Texts without words (null ones too) stay, each id once per text. A row of null id stays
    only where its whole group has null ids. An empty table gives an empty result."""
    mark, key, of = fresh(docs, "mark", "key", "of")
    kept = _named(docs, id_col, text_col, percent) \
        .filter(F.col("id").eqNullSafe(F.col("component"))) \
        .select(F.col("id").alias(key), F.col("mark").alias(of))
    rows = docs.withColumn(mark, F.xxhash64(F.col(text_col).cast("string")))
    rows = rows.join(kept, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(mark) == F.col(of)),
                     "left_semi")
    return rows.dropDuplicates([id_col, mark]).drop(mark)
