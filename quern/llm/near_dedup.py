"""MinHash near-duplicate documents with odd-sketch candidate checks and exact verification.

1. Each text becomes its set of k-word shingles (64-bit hashes); equal sets collapse to one class (map-side partial minimum).
2. A class has ``bands * rows`` MinHash samples. Bands deal out candidates; the samples, tagged with their position, are folded
   into an odd sketch: a bitmap in which each sample flips one bit. The population count of two sketches' XOR estimates how many
   samples differ, most precisely at high similarity.
3. First each class is tried against the best leader of its bands only, which joins large groups with one comparison a member; in
   another round, against the best of new leaders from the largest component of each band. Then all pairs that share a band and
   still lie in different components are compared inside a join, each at the first band that it shares. The sketch drops pairs four standard deviations below the
   threshold. Of the rest, a bitmap of the full sets, in which each shingle flips one bit, drops most that are not linked and none that
   are; what remains is decided on full shingle sets, and only confirmed links leave the join.
4. Components are found by star contraction on the confirmed links.

Full sets are made only for texts in a candidate pair; a fixed-size Bloom bitmap of their ids keeps other texts out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import BROADCAST_BYTES, WordHashes, binary, cut, mix, shingle_set, stored
from quern.llm.components import components

BANDS, ROWS = 48, 6  # a pair at similarity 0.8 shares no band with probability (1 - 0.8**6)**48 < 1e-6
SKETCH_BITS = 512
FINE_BITS = 1024  # of the bitmap of a full set
STAR_ROUNDS = 1  # rounds of new leaders before the remaining pairs are tried
BLOOM_ROWS = 4_000_000  # texts of which a bitmap (8 MB) is broadcast


def _parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_601)
    return rng.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minhashes(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set, in blocks so that long texts stay within memory."""
    x = (items >> np.uint64(32)).astype(np.uint32) ^ items.astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 512):
        part = (x[at : at + 512, None] ^ b) * a
        np.minimum(low, part.min(axis=0), out=low)
    return low


def band_keys(sample: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.arange(1, bands + 1, dtype=np.uint64)
    for column in sample.astype(np.uint64).reshape(bands, rows).T:
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + column)
    return acc


def odd_sketch(sample: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap of the samples: sample i with value x flips bit hash(i, x)."""
    at = mix(sample.astype(np.uint64) | (np.arange(1, len(sample) + 1, dtype=np.uint64) << np.uint64(32))) % np.uint64(bits)
    odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_differing(threshold: float, samples: int, bits: int) -> int:
    """The largest XOR count kept: what pairs show whose samples differ four standard deviations more than at the threshold, and four more."""
    m = 2 * (samples * (1 - threshold) + 4 * (samples * threshold * (1 - threshold)) ** 0.5)
    one, two = (1 - 2 / bits) ** m, (1 - 4 / bits) ** m  # mean sign of one bit, and of two bits together
    variance = (bits + bits * (bits - 1) * two - (bits * one) ** 2) / 4
    return int(bits * (1 - one) / 2 + 4 * variance**0.5) + 1


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, hash t of the text, n_shingles, set hash (h1, h2), band keys and odd sketch of each row, made map-side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, (a, b) = WordHashes(), _parameters(bands * rows)
        for batch in batches:
            made = []
            for text in binary(batch.column(1)):
                items = shingle_set(cache, text, shingle)
                if not len(items):
                    made.append((0, None, None, None, None))
                    continue
                low = minhashes(items, a, b)
                h1 = int(np.bitwise_xor.reduce(mix(items + np.uint64(1))).view(np.int64))
                h2 = int(np.add.reduce(mix(items ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64))
                made.append((len(items), h1, h2, band_keys(low, bands, rows).view(np.int64), odd_sketch(low, SKETCH_BITS)))
            n, h1, h2, keys, sketch = zip(*made, strict=True) if made else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
                names=["id", "t", "n", "h1", "h2", "bands", "sketch"],
            )

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("t")).mapInArrow(run, "id long, t long, n long, h1 long, h2 long, bands array<long>, sketch array<long>")


def _bits(rows: int) -> int:
    """64-bit words of a Bloom bitmap with sixteen bits a row."""
    return 1 << max(8, (rows // 4).bit_length())


def _bloom(hashes: DataFrame, words: int) -> np.ndarray:
    """Bitmap of the column t; at most ``words`` rows reach the driver."""
    positions = F.explode(F.array(*[F.pmod(F.xxhash64("t", F.lit(i)), F.lit(words * 64)) for i in range(3)])).alias("p")
    word = hashes.select(positions).groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    got = word.toPandas()
    out = np.zeros(words, dtype=np.uint64)
    out[got["w"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def fine_sketches(sets: list[np.ndarray], bits: int = FINE_BITS) -> np.ndarray:
    """A row of 64-bit words for each set: the parity bitmap of its hashes. Two sets differ in at least as many hashes as their bitmaps in bits."""
    out = np.empty((len(sets), bits // 64), dtype=np.int64)
    for at, items in enumerate(sets):
        odd = np.bincount((items.view(np.uint64) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        out[at] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return out


def full_sets(docs: DataFrame, text_col: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(id, items, fine) for each row of ``wanted`` (id, t): the sorted set of shingle hashes of the texts with hash t, and its bitmap.

    Up to BLOOM_ROWS rows a broadcast bitmap keeps other texts out of Python and the shuffle; beyond, a semi join on the hash does.
    """
    text = F.col(text_col).cast("string")
    lean = docs.select(text.alias("text"), F.xxhash64(text).alias("t"))
    rows = wanted.count()
    bits = None
    if rows <= BLOOM_ROWS:
        words = _bits(rows)
        bits = docs.sparkSession.sparkContext.broadcast(_bloom(wanted, words))
        lean = lean.withColumn("p", F.array(*[F.pmod(F.xxhash64("t", F.lit(i)), F.lit(words * 64)) for i in range(3)]))
    else:
        lean = lean.join(wanted.select("t").distinct(), "t", "left_semi").select("text", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            if not batch.num_rows:
                continue
            if bits is not None:
                p = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 3)
                batch = batch.filter(pa.array(((bits.value[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)))
            sets = [shingle_set(cache, t, shingle).view(np.int64) for t in binary(batch.column(0))]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            items = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)))
            fine = pa.FixedSizeListArray.from_arrays(pa.array(fine_sketches(sets).ravel()), FINE_BITS // 64).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), items, fine], names=["t", "items", "fine"])

    made = lean.mapInArrow(run, "t long, items array<long>, fine array<long>")
    made = stored(made.join(wanted, "t").dropDuplicates(["t"]).select("id", "items", "fine"), "near-sets")  # a class has one t: dealt once
    if bits is not None:
        bits.destroy()
    return made


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), by sets with one row an id, with 100 * intersection >= percent * union on their full sets."""

    def lists(column) -> list[np.ndarray]:
        ends, items = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
        return [items[i:j] for i, j in zip(ends, ends[1:], strict=False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for p, q in zip(lists(batch.column(2)), lists(batch.column(3)), strict=True):
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                same = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(q) else 0
                hit.append(100 * same >= percent * (len(p) + len(q) - same) and same > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(hit, pa.bool_()))

    sets = sets.select("id", "items")
    full = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return full.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _close(a: str, b: str, percent: int, samples: int) -> F.Column:
    """Sizes that allow the threshold, and sketches near enough; stays in JVM code."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (_differing(a, b) <= most_differing(percent / 100, samples, SKETCH_BITS))


def _differing(a: str, b: str, column: str = "sketch", bits: int = SKETCH_BITS) -> F.Column:
    return sum((F.bit_count(F.col(f"{a}.{column}")[i].bitwiseXOR(F.col(f"{b}.{column}")[i])) for i in range(bits // 64)), F.lit(0))


def _possible(a: str, b: str, percent: int) -> F.Column:
    """Whether two sets may be linked by their bitmaps; never false for sets that are."""
    return _differing(a, b, "fine", FINE_BITS) * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent)


def _first(a: str, b: str) -> F.Column:
    """Whether no band before this one is shared, so that a pair of many common bands is decided once; band keys of 31 bits tell."""
    return ~F.arrays_overlap(F.slice(f"{a}.bands", F.lit(1), F.col(f"{a}.pos")), F.slice(f"{b}.bands", F.lit(1), F.col(f"{b}.pos")))


def _with_sets(live: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows with their full sets. Sets of at most BROADCAST_BYTES join the rows after these are dealt by key, so that no copy of a set is shuffled."""
    size = sets.agg(F.sum(F.size("items") * 8 + 64)).first()[0] or 0
    return live.repartition("key").join(F.broadcast(sets), "id") if size <= BROADCAST_BYTES else live.join(sets, "id")


def _near(pairs: DataFrame, lean: DataFrame, percent: int, samples: int) -> DataFrame:
    """The (id, leader) pairs whose sketches are near enough, with the number d of differing bits."""
    met = pairs.alias("t").join(lean.alias("x"), F.col("t.id") == F.col("x.id")).join(lean.alias("y"), F.col("t.leader") == F.col("y.id"))
    return met.filter(_close("x", "y", percent, samples)).select("t.id", "t.leader", _differing("x", "y").alias("d"))


def _best(close: DataFrame) -> DataFrame:
    """For each id the nearest leader, as (a, b)."""
    return close.groupBy(F.col("id").alias("a")).agg(F.min(F.struct("d", "leader")).alias("m")).select("a", F.col("m.leader").alias("b"))


def _ends(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.col(a).alias("id")).union(pairs.select(F.col(b).alias("id"))).distinct()


def _placed(dealt: DataFrame, joined: DataFrame) -> DataFrame:
    """(id, pos, key, comp): each id with its component so far."""
    return dealt.join(joined, "id", "left").select("id", "pos", "key", F.coalesce("component", "id").alias("comp"))


def _new_leaders(placed: DataFrame, again: int) -> DataFrame:
    """Per band a member of its largest component, by another hash each round, paired with the members of other components."""
    groups = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("id", "key", F.lit(again)).alias("h"), "id")).alias("m"))
    top = groups.groupBy("key").agg(F.max(F.struct("n", F.col("comp").alias("top"), F.col("m.id").alias("leader"))).alias("t"), F.count(F.lit(1)).alias("comps")).filter("comps > 1").select("key", "t.top", "t.leader")
    return placed.join(top, "key").filter(F.col("comp") != F.col("top")).select("id", "leader").distinct()


class _Sets:
    """Full sets of the classes asked for so far; only those not made yet cost another pass over the texts."""

    def __init__(self, docs: DataFrame, text_col: str, shingle: int, texts: DataFrame):
        self.source, self.texts, self.made, self.held = (docs, text_col, shingle), texts, None, None

    def add(self, ids: DataFrame) -> None:
        new = ids if self.held is None else ids.join(self.held, "id", "left_anti")
        new = cut(self.texts.join(new, "id", "left_semi"))
        if self.made is None or new.take(1):
            got = full_sets(*self.source, new)
            self.made = got if self.made is None else self.made.union(got)
            new = new.select("id")
            self.held = new if self.held is None else self.held.union(new)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept, text_hash (xxhash64 of the text, which tells rows of one id apart).

    component_id is the smallest id reachable over links between texts whose shingle sets have a Jaccard similarity of at least
    ``percent`` / 100; kept is true for that smallest id. Repeated rows share a class; rows of one id with different texts are
    different documents. A null or blank text has an empty set, is
    linked with nothing and kept under its own id. A null id takes part in no link: component_id is null, kept true.
    Other columns are ignored. An empty table gives an empty result.
    """
    sig = stored(signatures(docs, id_col, text_col, shingle, bands, rows), "near-sig")
    live = sig.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    # a class, one for each set, has a number of its own beside its smallest document, for a document's rows may differ
    reps = live.groupBy("h1", "h2").agg(F.min("id").alias("doc"), F.min("t").alias("t"), F.first(F.struct("n", "bands", "sketch")).alias("s"))
    reps = cut(reps.select(F.xxhash64("h1", "h2").alias("id"), "doc", "t", "s.n", "s.bands", "s.sketch"))
    lean = reps.select("id", "n", "sketch")
    samples = bands * rows

    # one leader a band; each class is compared with the leader whose sketch is nearest
    dealt = reps.select("id", F.posexplode("bands").alias("pos", "key"))
    leaders = dealt.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("key", "leader")
    close = cut(_near(dealt.join(leaders, "key").filter(F.col("id") != F.col("leader")).select("id", "leader").distinct(), lean, percent, samples))
    sets = _Sets(docs, text_col, shingle, reps.select("id", "t"))
    sets.add(_ends(close, "id", "leader"))
    links = cut(verify(_best(close), sets.made, percent))
    joined = cut(components(links, "a", "b"))

    # what still lies apart within a band
    dealt = _placed(dealt, joined)
    apart = dealt.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    rest = cut(dealt.join(apart, "key", "left_semi").select("id", "pos", "key"))
    for again in range(STAR_ROUNDS):
        pairs = _best(_near(_new_leaders(_placed(rest, joined), again), lean, percent, samples))
        pairs = cut(pairs)
        if not pairs.take(1):
            break
        sets.add(_ends(pairs, "a", "b"))
        more = cut(verify(pairs, sets.made, percent))
        if not more.take(1):
            break
        links = links.union(more)
        joined = cut(components(links, "a", "b"))
    # classes with a near partner in another component, then pair by pair on full sets inside a join that only confirmed links leave
    members = _placed(rest, joined)
    apart = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    short = reps.select("id", "n", "sketch", F.transform("bands", lambda k: k.bitwiseAND(0x7FFFFFFF).cast("int")).alias("bands"))
    members = stored(members.join(apart, "key", "left_semi").join(short, "id"), "near-members")
    x, y = members.alias("x"), members.alias("y")
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & _close("x", "y", percent, samples) & _first("x", "y")
    live, final = stored(x.join(y, near, "left_semi"), "near-live"), joined
    if live.take(1):
        ids = cut(live.select("id").distinct())
        sets.add(ids)
        x = live.join(sets.made.join(ids, "id", "left_semi").select("id", "fine"), "id")
        x, y = x.alias("x"), x.alias("y")
        live = stored(x.join(y, near & _possible("x", "y", percent), "left_semi").drop("fine"), "near-live")
        ids = cut(live.select("id").distinct())
        full = _with_sets(live, sets.made.join(ids, "id", "left_semi").select("id", "items"))
        x, y = full.alias("x"), full.alias("y")
        same = F.size(F.array_intersect("x.items", "y.items"))
        exact = same * 100 >= (F.col("x.n") + F.col("y.n") - same) * percent
        more = cut(x.join(y, (F.col("x.id") < F.col("y.id")) & near & exact).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
        final = components(links.union(more), "a", "b") if more.take(1) else joined

    classes = reps.join(final, "id", "left").select("id", "doc", F.coalesce("component", "id").alias("group"))
    least = classes.groupBy("group").agg(F.min("doc").alias("component"))
    classes = classes.join(least, "group").select(F.col("id").alias("class"), "component")
    out = sig.select("id", "t", "n", F.when(F.col("n") > 0, F.xxhash64("h1", "h2")).alias("class")).join(classes, "class", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), F.col("t").alias("text_hash"))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    from quern.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2).drop("text_hash")
