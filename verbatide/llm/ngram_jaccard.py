"""N-gram Jaccard join by parity sketches.

A text is the set of its word n-grams. Two sets link when their intersection is at least
``threshold`` (a fraction, taken exactly) of their union; a linked pair whose smaller set has ``a``
members differs in at most ``D = floor(a (1 - t) / t)`` members.

* Sets of one size band share a scheme: members are dealt to ``D + 2 + s`` segments by their hash, and a segment's
  sketch is the XOR of its members. A linked pair has at least ``2 + s`` equal segments. So every set may give up its ``s``
  most frequent keys (those of a phrase that very many texts hold): in any one order of all keys, the two rarest segments that a
  pair shares have ``s`` others above them and are given up by neither. Equal segments
  with members meet by their key; for those without, each
  set also emits a key per pair of its empty segments, which is never given up. Bands with ``D = 1`` take the XOR of the whole set and
  the XORs that lack one member. Bands with ``D = 0`` need no key: equal sets are one set throughout.
* A further parity sketch has one bit toggled per member: its Hamming distance is a lower bound of the
  symmetric difference and rejects most chance meetings before sets are compared. It has about as many bits as
  the set has members, or a chance meeting of large sets would pass; the longer of two is folded to the shorter by XOR.
* Meetings are verified on the sets. First every set is compared with the one set it meets most
  often among the smallest of its buckets. Then come the pairs that meet in small buckets and are still apart. Since a linked pair
  has two equal segments, a pair goes on only if it meets twice, or has an empty segment in common, or may meet in
  large buckets too; its sketches are read once. Large buckets with one smallest set have nearly the same members, so they are
  taken together as a *bundle*: a member and its sketch are in it once, not once for every key. Bundles whose members are then in
  one component are done. In the others the *minor* members, those outside the bundle's largest component, are compared
  with all members of other components, in blocks: first the nearest pairs, a forest over each
  block's components, then, of bundles that still are mixed, all that still are apart. So copies and dense groups
  cost in proportion to their size, and every link that could join two components is tested.
* A key that holds very many sets is found on a sample, which only decides how rows are dealt: its
  rows go to many tasks, whose smallest sets are brought together afterwards.

Sets are told apart by 64-bit hashes of their members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch, free_names
from verbatide.llm.components import components
from verbatide.operators.skew import lookup_join

SPARE = 16  # one in so many segments is spare
BAND = 1.25  # sizes of one band differ by at most this factor, or by 1 / threshold if that is more
SKETCH_BITS, MOST_BITS = 1024, 1 << 16  # smallest and largest parity sketch
SMALL = 8  # members of a bucket whose pairs are listed
CACHED_WORDS = 400_000  # word hashes kept by a task
SEEN_SETS = 1_000_000  # sets that a task remembers to have sketched
BLOCK, WIDE = 512, 8192  # minor members of a bundle, and members of any kind, that are compared at a time
BROADCAST_IDS = 2_000_000  # ids of 8 bytes; a longer list is joined by a shuffle
SHARES = 6  # rounds in which the keys are met: only one share of them lies on the disks at a time
SAMPLE = 32  # one in so many sets is looked at to find crowded keys
CROWDED = 500  # a key is crowded when it holds more than 1/500 of the sampled sets

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX2
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Distinct n-gram hashes of texts; words are hashed once per task."""

    def __init__(self, n: int):
        self.n = n
        self.words: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        known = self.words
        try:
            hashes = [known[w] for w in words]
        except KeyError:
            if len(known) > CACHED_WORDS:
                known.clear()
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w)
            hashes = [known[w] for w in words]
        h = np.array(hashes, np.uint64)
        with np.errstate(over="ignore"):
            take = min(self.n, len(h))
            if not take:
                return h
            x = np.full(len(h) - take + 1, take, np.uint64)
            for i in range(take):
                x = _mix(x * _STEP + h[i : len(h) - take + 1 + i])
        return np.unique(x)


class Bands:
    """Which keys a set emits, by its size."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        self.ratio = max(Fraction(BAND).limit_denominator(100), 1 / threshold)
        self.first = math.ceil(threshold / (1 - threshold)) if threshold < 1 else None

    def distance(self, size: int) -> int:
        return math.floor(size * (1 - self.t) / self.t)

    @staticmethod
    def spare(distance: int) -> int:
        """Keys that a set may give up in a scheme."""
        return distance // SPARE + 1 if distance > 1 else 0

    def band(self, size: int) -> tuple[int, int]:
        """(smallest, largest) size of the band that holds ``size``; bands with one D stay whole."""
        low = self.first
        while True:
            high = max(low, math.ceil(low * self.ratio) - 1)
            if self.distance(low) == 1:
                while self.distance(high + 1) == 1:
                    high += 1
                while self.distance(high) > 1:
                    high -= 1
            if size <= high:
                return low, high
            low = high + 1

    def schemes(self, size: int) -> list[tuple[int, int]]:
        """The bands in which a set of ``size`` may meet a smaller or equal or a larger one."""
        if self.first is None or size < self.first:
            return []
        low, high = self.band(size)
        found = [(low, self.distance(high))]
        at = low
        while at > self.first:  # partners at least t times as large
            low_, high_ = self.band(at - 1)
            if high_ < size * self.t:
                break
            found.append((low_, self.distance(high_)))
            at = low_
        return found


def _tagged(keys: np.ndarray, tag: int) -> np.ndarray:
    """Keys with the tag of their scheme as the last byte; 0 for those that are never given up."""
    return (keys & ~np.uint64(255)) | np.uint64(tag)


def segments(members: np.ndarray, low: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, empty segments) of one set in the band that starts at ``low``."""
    with np.errstate(over="ignore"):
        tag = _mix(np.uint64([low]) * _STEP)
        if distance == 1:
            whole = np.bitwise_xor.reduce(members)
            return _tagged(_mix(np.append(members ^ whole, whole) + tag), 0), np.zeros(0, np.int64)
        count = distance + 2 + Bands.spare(distance)
        segment = ((members >> np.uint64(20)) % np.uint64(count)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        segment, xs = segment[order], members[order]
        starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        places = segment[starts].astype(np.uint64)
        keys = _tagged(_mix(_mix(np.bitwise_xor.reduceat(xs, starts) + places * _STEP) + tag), 1 + low % 251)
        empty = np.setdiff1d(np.arange(count, dtype=np.uint64), places, assume_unique=True)
        if len(empty) > 1:
            i, j = np.triu_indices(len(empty), 1)
            pairs = _tagged(_mix(_mix(empty[i] * np.uint64(count) + empty[j]) + ~tag), 0)
            keys = np.concatenate([keys, pairs])
        return keys, (low << 32) + empty.astype(np.int64)


def parity_sketch(members: np.ndarray) -> bytes:
    bits = SKETCH_BITS
    while bits < len(members) and bits < MOST_BITS:
        bits *= 2
    odd = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the shortest."""
    width = min(map(len, sketches)) // 8
    rows = np.empty((len(sketches), width), np.uint64)
    for at, sketch in enumerate(sketches):
        words = np.frombuffer(sketch, np.uint64)
        rows[at] = words if len(words) == width else np.bitwise_xor.reduce(words.reshape(-1, width), axis=0)
    return rows


def _name(members: bytes) -> int:
    """A set's 64-bit id."""
    return xxhash.xxh3_64_intdigest(members) - (1 << 63)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _sketch(docs: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """Per row of ``docs(doc_id, th, text)`` its set size, set id, parity sketch, keys and
    empty segments (null where the task has given them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, bands, seen, schemes = Shingler(n), Bands(threshold), set(), {}
        for batch in batches:
            sizes, ids, sketches, keys, empty, spare = [], [], [], [], [], []
            for value in batch.column(2):
                members = shingle(value.as_py())
                size = len(members)
                name = _name(members.tobytes()) if size else None
                sizes.append(size)
                ids.append(name)
                if name is None or name in seen:
                    sketches.append(None)
                    keys.append(None)
                    empty.append(None)
                    spare.append(None)
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(name)
                if size not in schemes:
                    schemes[size] = bands.schemes(size)
                found = [segments(members, low, d) for low, d in schemes[size]]
                sketches.append(parity_sketch(members) if found else None)
                keys.append(_signed(np.unique(np.concatenate([k for k, _ in found]))) if found else None)
                empty.append(np.concatenate([e for _, e in found]) if found else None)
                spare.append(min((bands.spare(d) for _, d in schemes[size]), default=0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(sketches, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(empty, pa.list_(pa.int64())),
                    pa.array(spare, pa.int32()),
                ],
                ["doc_id", "th", "size", "id", "sketch", "keys", "empty", "spare"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, th long, size long, id long, sketch binary, keys array<long>, empty array<long>, spare int")


def _buckets(sketched: DataFrame, share: int = 0, shares: int = 1) -> DataFrame:
    """(key, id, rep, crowd, n): members of keys that more than one set has; ``rep`` is the smallest, ``n`` the key's rows.
    Of ``shares`` shares of all keys only one.

    In a crowded key ``rep`` is the smallest member of a share of it, ``crowd`` is true and ``n`` the largest number.
    """
    rows = sketched.where(F.col("keys").isNotNull()).select("id", F.explode("keys").alias("key"))
    rows = rows.where(F.pmod(F.xxhash64("key"), F.lit(shares)) == share) if shares > 1 else rows
    seen = sketched.where(F.col("keys").isNotNull() & (F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0))
    seen = seen.select("id", "keys").dropDuplicates(["id"])
    least = max(16, seen.count() // CROWDED)
    # At most CROWDED keys for each key that a set has on average.
    crowded = seen.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    crowded = crowded.where(F.col("n") > least).select("key", F.ceil(F.col("n") * 2 / least).cast("int").alias("salts"))
    dealt = rows.join(F.broadcast(crowded), "key", "left")
    dealt = dealt.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(0)))
    key = Window.partitionBy("key", "salt")
    crowd = F.col("salts").isNotNull()
    n = F.when(crowd, F.lit((1 << 63) - 1)).otherwise(F.count("*").over(key))
    ranked = dealt.withColumns({"rep": F.min("id").over(key), "top": F.max("id").over(key), "n": n})
    shared = ranked.where(crowd | (F.col("rep") != F.col("top"))).select("key", "salt", "id", "rep", crowd.alias("crowd"), "n")
    # Repeated rows lie side by side: the window has dealt them by key and salt, and a set has one salt in a key.
    return shared.groupBy("key", "salt", "id", "rep", "crowd", "n").agg(F.lit(1)).select("key", "id", "rep", "crowd", "n")


def _given_up(buckets: DataFrame, spares: DataFrame) -> DataFrame:
    """``buckets`` without each set's ``spare`` most frequent keys of each scheme. Keys are ordered by (n, key), alike for
    all sets; a set has no more rows than keys, so its window is small."""
    scheme = F.col("key").bitwiseAND(F.lit(255))
    order = Window.partitionBy("id", "scheme").orderBy(F.desc("n"), F.desc("key"))
    ranked = buckets.join(spares, "id").withColumn("scheme", scheme).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("scheme") == 0) | (F.col("rank") > F.col("spare"))).select("key", "id", "rep", "crowd")


def _near(pairs: DataFrame, facts: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link."""
    part, whole = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = []
            for pair in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                one, two = folded(list(pair))
                apart.append(int(np.bitwise_count(one ^ two).sum()))
            apart = np.array(apart, np.int64)
            small = batch.column("small").to_numpy()
            good = apart <= small * (whole - part) // part
            yield batch.select(["a", "b"]).filter(pa.array(good))

    one = facts.select(F.col("id").alias("a"), F.col("size").alias("n"), F.col("sketch").alias("left"))
    two = facts.select(F.col("id").alias("b"), F.col("size").alias("m"), F.col("sketch").alias("right"))
    both = pairs.join(one, "a").join(two, "b")
    return both.select("a", "b", F.least("n", "m").alias("small"), "left", "right").mapInArrow(run, "a long, b long")


def _verified(
    pairs: DataFrame, rows: DataFrame, chosen: DataFrame, n: int, threshold: Fraction, scratch: Scratch
) -> DataFrame:
    """The pairs (a, b) whose sets link. Only the texts of sets in ``pairs`` are cut again."""
    part, whole = threshold.numerator, threshold.denominator
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = scratch.store(chosen.join(ids, "id", "left_semi").select("id", "doc_id"), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    found = rows.join(F.broadcast(wanted) if few else wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]))
    sets = scratch.store(_member_sets(found.select("id", "text"), n), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (one, two))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(whole * both >= part * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("id").alias("a"), F.col("members").alias("left"))
    two = sets.select(F.col("id").alias("b"), F.col("members").alias("right"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
    links = scratch.store(joined.mapInArrow(run, "a long, b long"), "links")
    scratch.drop(wanted, sets)
    return links


def _forest(a: np.ndarray, b: np.ndarray, apart: np.ndarray, root: dict[int, int]) -> list[int]:
    """Places of the pairs, nearest first, that join two components; ``root`` maps sets to components."""

    def find(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    above: dict[int, int] = {}
    chosen = []
    for place in np.argsort(apart, kind="stable").tolist():
        x, y = find(root[a[place]]), find(root[b[place]])
        if x != y:
            above[x] = y
            chosen.append(place)
    return chosen


def _cross_pairs(rows: DataFrame, threshold: Fraction, forest: bool) -> DataFrame:
    """Pairs of one (rep, i, j) block pair that are in different components and may link.

    ``rows(rep, i, j, minor, left, id, component, size, sketch)`` are dealt and sorted by block pair: minor members on the left,
    members of any kind on the right. With ``forest`` only the nearest pairs that would join the block's components, fewer than its sets.
    """
    part, whole = threshold.numerator, threshold.denominator
    names = ("rep", "i", "j", "minor", "left", "id", "component", "size")

    def pairs(group: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        right = np.flatnonzero(~group["left"])
        words = folded(group["sketch"].tolist())
        # Two minor members meet on both sides; the pair is taken where the smaller one is on the left.
        others, limit = words[right], np.where(group["minor"][right], group["id"][right], np.iinfo(np.int64).max)
        ids, component, size = (group[name][right] for name in ("id", "component", "size"))
        found_a, found_b, found_apart = [], [], []
        for at in np.flatnonzero(group["left"]):
            apart = np.bitwise_count(others ^ words[at]).sum(axis=1)
            most = np.minimum(size, group["size"][at]) * (whole - part) // part
            good = (apart <= most) & (component != group["component"][at]) & (group["id"][at] < limit)
            found_a.append(np.full(int(good.sum()), group["id"][at]))
            found_b.append(ids[good])
            found_apart.append(apart[good])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if forest and len(a) > 1:
            root = dict(zip(group["id"].tolist(), group["component"].tolist()))
            chosen = _forest(a, b, np.concatenate(found_apart), root)
            a, b = a[chosen], b[chosen]
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def finish(data: dict[str, np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = [], []
            for start, end in zip(starts, np.append(starts[1:], len(data["rep"]))):
                group = {k: v[start:end] for k, v in data.items()}
                if group["left"].any() and not group["left"].all():
                    x, y = pairs(group)
                    a.append(np.maximum(x, y))
                    b.append(np.minimum(x, y))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        for batch in batches:
            data = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in names}
            data["sketch"] = np.empty(len(batch), object)
            data["sketch"][:] = batch.column("sketch").to_pylist()
            if held is not None:
                data = {k: np.concatenate([held[k], v]) for k, v in data.items()}
            new = np.zeros(len(data["rep"]), bool)
            new[:1] = True
            for name in ("rep", "i", "j"):
                new[1:] |= data[name][1:] != data[name][:-1]
            starts = np.flatnonzero(new)
            if not len(starts):
                continue
            last = starts[-1]
            yield from finish({k: v[:last] for k, v in data.items()}, starts[:-1])
            held = {k: v[last:] for k, v in data.items()}
        if held is not None:
            yield from finish(held, np.array([0]))

    return rows.mapInArrow(run, "a long, b long")


def _small_pairs(small: DataFrame, joined: DataFrame, facts: DataFrame, threshold: Fraction) -> DataFrame:
    """(a, b) of different components that meet in buckets of at most ``SMALL`` sets and may have two equal segments.

    ``facts(id, size, empty, large)`` tell a set's empty segments and whether it is in large buckets too.
    """
    member = F.struct("id", F.coalesce("component", "id").alias("component"))
    lists = small.join(joined, "id", "left").groupBy("key").agg(F.collect_set(member).alias("m"))

    def below(x: Column) -> Column:
        others = F.filter("m", lambda y: (y["id"] < x["id"]) & (y["component"] != x["component"]))
        return F.transform(others, lambda y: F.struct(x["id"].alias("a"), y["id"].alias("b")))

    met = lists.select(F.inline(F.flatten(F.transform("m", below)))).groupBy("a", "b").agg(F.count("*").alias("n"))
    once = met.where(F.col("n") == 1)
    for side in ("a", "b"):
        once = once.join(facts.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("size", "empty", "large")]), side)
    # Sets that may differ in one member have one key in common.
    one = F.least("size_a", "size_b") < math.ceil(2 * threshold / (1 - threshold))
    both = F.col("large_a") & F.col("large_b")
    twice = F.arrays_overlap("empty_a", "empty_b")
    return met.where(F.col("n") > 1).select("a", "b").unionByName(once.where(one | both | twice).select("a", "b"))


def _bundles(buckets: DataFrame, tops: DataFrame) -> DataFrame:
    """(rep, id): the distinct members of the buckets with one smallest set; a crowded key's shares are one bucket."""
    plain = buckets.where(~F.col("crowd")).select("rep", "id")
    crowded = buckets.where("crowd").join(F.broadcast(tops), "key").select(F.col("top").alias("rep"), "id")
    return plain.unionByName(crowded).distinct()


def _mixed(bundles: DataFrame, joined: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of bundles that hold several components, and these as block pairs, dealt and sorted.

    A minor member is on the left of as many block pairs as the bundle has blocks of ``WIDE`` members, and every member on
    the right of as many as it has blocks of ``BLOCK`` minor members: once, where few are minor.
    """
    component = F.coalesce("component", "id").alias("component")
    members = bundles.join(joined, "id", "left").select("rep", "id", component)
    parts = members.groupBy("rep", "component").agg(F.count("*").alias("n"))
    parts = parts.groupBy("rep").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("major"))
    parts = parts.where(F.col("n") > F.col("major.n"))
    blocks = lambda n, size: F.ceil(n / size).cast("int")
    parts = parts.select(
        "rep",
        F.col("major.component").alias("major"),
        blocks(F.col("n") - F.col("major.n"), BLOCK).alias("narrow"),
        blocks(F.col("n"), WIDE).alias("wide"),
    )
    rows = members.join(parts, "rep").withColumn("minor", F.col("component") != F.col("major"))
    own = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = rows.where("minor").withColumns({"i": own("narrow"), "j": every("wide"), "left": F.lit(True)})
    right = rows.withColumns({"i": every("narrow"), "j": own("wide"), "left": F.lit(False)})
    placed = left.unionByName(right).select("rep", "i", "j", "minor", "left", "id", "component")
    placed = placed.join(facts.select("id", "size", "sketch"), "id")
    return rows.select("rep", "id"), placed.repartition("rep", "i", "j").sortWithinPartitions("rep", "i", "j")


def _row_classes(docs: DataFrame, n: int, threshold: Fraction, doc_id: str, text: str) -> DataFrame:
    """(doc_id, th, n_shingles, component, component_id) of every row; ``th`` is a hash of the text, ``component`` is
    one number per component, null where the text has no n-gram."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).cast("binary").alias("text"))
    sketched = scratch.store(_sketch(rows, n, threshold), "sketches")
    # The largest shuffle: a share of the keys at a time, so that never all of them lie on the disks.
    parts = []
    for share in range(SHARES):
        parts.append(scratch.store(_buckets(sketched, share, SHARES), "meetings"))
        scratch.release()
    meetings = reduce(DataFrame.unionByName, parts)
    plain = scratch.store(sketched.select("doc_id", "th", F.col("size").alias("n_shingles"), "id"), "rows")

    # The sets that meet another, with one document each to read their text from.
    met = meetings.select("id").distinct()
    chosen = sketched.where(F.col("keys").isNotNull()).join(met, "id", "left_semi")
    chosen = chosen.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.max("sketch").alias("sketch"), F.max("empty").alias("empty"), F.max("spare").alias("spare"))
    chosen = scratch.store(chosen, "chosen")
    scratch.drop(sketched)
    scratch.release()
    buckets = scratch.store(_given_up(meetings, chosen.select("id", "spare")), "buckets")
    scratch.drop(*parts)

    # First round: each set with the set it meets most often; shares of a crowded key with each other.
    ties = buckets.where(F.col("id") != F.col("rep")).groupBy("id", "rep").agg(F.count("*").alias("n"))
    best = ties.groupBy("id").agg(F.max_by("rep", F.struct("n", "rep")).alias("rep"))
    crowd = buckets.where("crowd").groupBy("key", "rep").agg(F.lit(1).alias("one"))
    tops = scratch.store(crowd.groupBy("key").agg(F.min("rep").alias("top")), "tops")  # fewer than CROWDED keys a set's key
    across = crowd.join(tops, "key").where(F.col("rep") != F.col("top")).select(F.col("rep").alias("id"), F.col("top").alias("rep"))
    first = best.select("id", "rep").unionByName(across).select(F.greatest("id", "rep").alias("a"), F.least("id", "rep").alias("b"))
    near = scratch.store(_near(first.distinct(), chosen, threshold), "pairs")
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"), F.bool_or("crowd").alias("crowd"))
    large = scratch.store(sizes.where((F.col("n") > SMALL) | F.col("crowd")).select("key"), "large")
    bundles = scratch.store(_bundles(buckets.join(large, "key", "left_semi"), tops), "bundles")
    links: list[DataFrame] = []

    def join_up(pairs: DataFrame) -> DataFrame:
        """Components over all links found so far, with those among ``pairs``."""
        links.append(_verified(pairs, rows, chosen, n, threshold, scratch))
        found = scratch.store(components(reduce(DataFrame.unionByName, links), scratch), "components")
        scratch.drop(pairs)
        scratch.release()
        return found

    joined = join_up(near)

    # Second round: the pairs of small buckets.
    in_large = bundles.select("id").distinct().withColumn("large", F.lit(True))
    facts = chosen.select("id", "size", "empty").join(in_large, "id", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    small = buckets.join(large, "key", "left_anti").select("key", "id")
    met = _small_pairs(small, joined, facts, threshold) if threshold < 1 else near.limit(0)
    pairs, before = scratch.store(_near(met, chosen, threshold), "pairs"), joined
    scratch.drop(buckets, tops, large)
    joined = join_up(pairs)
    scratch.drop(before)

    # Third round: in each mixed bundle the nearest pairs that would join its components. Fourth: all pairs
    # of sets that are still in different components.
    for forest in (True, False):
        mixed, placed = _mixed(bundles, joined, chosen)
        pairs, before = scratch.store(_cross_pairs(placed, threshold, forest).distinct(), "pairs"), joined
        if forest:
            still = scratch.store(mixed, "bundles")
            scratch.drop(bundles)
            bundles = still
        joined = join_up(pairs)
        scratch.drop(before)
    scratch.drop(bundles, chosen, *links)

    # Set to smallest document, component to smallest document, back to all documents.
    per_set = plain.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    per_set = scratch.store(per_set.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id")), "classes")
    scratch.drop(joined)
    least = per_set.groupBy("component").agg(F.min("least").alias("component_id"))
    named = per_set.join(least, "component").select("id", "component", "component_id")
    with_set = lookup_join(plain.where(F.col("id").isNotNull()), named, "id", counts=per_set.select("id", "n"))
    alone = plain.where(F.col("id").isNull()).withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    columns = ("doc_id", "th", "n_shingles", "component", "component_id")
    return with_set.select(*columns).unionByName(alone.select(*columns))


def link_classes(
    docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Words are runs of anything but ASCII white space, lower-cased in A-Z. A text with fewer than
    ``n`` words is one n-gram; null texts and texts without words have no n-gram, link with nothing
    and are their own component. Equal sets are linked, repeated rows too. ``component_id`` is the
    smallest id reachable by links; null ids count only where a component has no other. An empty table gives
    an empty result. Other columns are not read.
    """
    return _row_classes(docs, n, threshold, doc_id, text).select("doc_id", "n_shingles", "component_id")


def _member_sets(docs: DataFrame, n: int) -> DataFrame:
    """(id, members): the sorted n-gram hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            sets = [shingle(v.as_py()).tobytes() for v in batch.column(1)]
            # An id may belong to several rows; only those with the set's own text count.
            own = [_name(s) == i for s, i in zip(sets, batch.column(0).to_pylist())]
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "members"])
            yield made.filter(pa.array(own, pa.bool_()))

    return docs.mapInArrow(run, "id long, members binary")


def keep_one_per_class(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of ``link_classes``, with all its columns.

    It is the row with the smallest id (null ids last), of several texts under that id the one with the smallest hash, and of
    rows equal in id and text any one. Rows whose text is null or has no word link with nothing and all stay, repeated
    ones too. An empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "kept")
    classes = _row_classes(docs, n, threshold, doc_id, text)
    counts = scratch.store(classes.groupBy("component", "doc_id", "th").agg(F.count("*").alias("n")), "counts")
    best = F.min_by(F.struct("doc_id", "th", "n"), F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("best")
    chosen = counts.where(F.col("component").isNotNull()).groupBy("component").agg(best).select("best.*")
    bare = counts.where(F.col("component").isNull()).select("doc_id", "th", F.lit(1).cast("long").alias("n"))
    kept_id, kept_text, copies = free_names(docs.columns, "id text copies")
    chosen = chosen.unionByName(bare)
    chosen = scratch.store(chosen.select(F.col("doc_id").alias(kept_id), F.col("th").alias(kept_text), F.col("n").alias(copies)), "chosen")
    scratch.drop(counts)

    def among(wanted: DataFrame) -> DataFrame:
        same = docs[doc_id].eqNullSafe(wanted[kept_id]) & (F.xxhash64(docs[text]) == wanted[kept_text])
        return docs.join(wanted, same, "left_semi")

    repeated, single = chosen.where(F.col(copies) > 1), chosen.where(F.col(copies) == 1)
    if repeated.isEmpty():
        return among(single)
    # Rows equal in id and text are met in the tasks first, so a row that is a third of the table is no hot key.
    return among(single).unionByName(among(repeated).dropDuplicates([doc_id, text]))
