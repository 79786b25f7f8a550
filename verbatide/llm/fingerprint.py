"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words, each weighted by its number of occurrences. For every word and each of
``samples`` independent draws, a hash of the word gives two gamma(2, 1) variates r and c and a uniform
shift b. With t = floor(ln w / r + b), y = exp(r (t - b)) and a = c / (y exp(r)), the word of the smallest
a, with its t, is the sample. Two texts agree in a sample with the probability of their generalised Jaccard similarity,
the sum of the smaller weights over the sum of the larger.

SQL functions only. Words are counted and sampled in the partition that holds their text, so only
texts move, once; a third of all texts being equal is harmless, since equal rows are one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch
from verbatide.operators.ordering import dense_index

SAMPLES = 32
SPLIT = 4  # partitions of the word counts per shuffle partition


def _bits(value: Column, shift: int, width: int) -> Column:
    """A uniform number inside (0, 1) from ``width`` bits of a 64-bit hash."""
    part = F.shiftrightunsigned(value, shift) if shift else value
    return (part.bitwiseAND(F.lit((1 << width) - 1)).cast("double") + 0.5) / float(1 << width)


def cws_sample(term: Column, log_weight: Column, k: int) -> Column:
    """``ln a`` of draw ``k``, ordered in the upper 32 bits of a long; the sample's hash in the lower."""
    one, two = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.ln(_bits(one, 0, 26) * _bits(one, 26, 26))
    log_c = F.ln(-F.ln(_bits(two, 0, 24) * _bits(two, 24, 24)))
    shift = _bits(two, 48, 16)
    t = F.floor(log_weight / r + shift)
    log_a = log_c - r * (t - shift) - r
    # ln a lies between -90 and 4 for weights below 2^50.
    place = F.shiftleft(((log_a + 128.0) * float(1 << 23)).cast("long"), 32)
    return place.bitwiseOR(F.xxhash64(term, t).bitwiseAND(F.lit(0xFFFFFFFF)))


def signatures(rows: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``signature`` (array of int), for rows with at least one word; ``keys`` are unique."""
    words = F.explode_outer(F.split(F.col(text), "[\\x20\\x09-\\x0D]+")).alias("word")
    terms = rows.select(*keys, words).where((F.col("word") != "") & F.col("word").isNotNull())
    terms = terms.select(*keys, F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("w"))
    terms = terms.withColumn("log_w", F.ln(F.col("w").cast("double")))
    lowest = [F.min(cws_sample(F.col("term"), F.col("log_w"), k)).alias(f"s{k}") for k in range(samples)]
    made = terms.groupBy(*keys).agg(*lowest)
    return made.select(*keys, F.array(*[F.hash(f"s{k}") for k in range(samples)]).alias("signature"))


def likeness(one: Column, two: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples; two texts without words are alike, one with and one without are not."""
    same = F.zip_with(one, two, lambda x, y: (x == y).cast("int"))
    share = F.aggregate(same, F.lit(0), lambda a, x: a + x) / float(samples)
    return F.when(one.isNull() | two.isNull(), (one.isNull() & two.isNull()).cast("double")).otherwise(share)


def as_string(signature: Column) -> Column:
    """Eight hex digits per sample; empty for a text without words."""
    parts = F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.coalesce(F.concat_ws("", parts), F.lit(""))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) of every row; null text is empty and has the empty fingerprint.

    Rows of one id and text share their fingerprint; null ids are ids like others; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("same", F.xxhash64("text"))
    made = signatures(rows.dropDuplicates(["doc_id", "same"]), ["doc_id", "same"], "text", samples)
    found = rows.select("doc_id", "same").alias("a").join(
        made.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.same") == F.col("b.same")), "left"
    )
    return found.select("a.doc_id", as_string(F.col("signature")).alias("fingerprint"))


def fingerprints_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Every row's fingerprint and that of its edited text, with their likeness and the next row's.

    The edited text has its last half (rounded down, in code points) replaced by the first as many code points,
    or all, of the next row's text; rows are ordered by id, nulls first, then by a hash of the text, and the
    first follows the last. Rows equal in id and text follow each other. Null text is empty. Columns:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "fingerprints")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # A null id takes a flag and a number, so that all joins are on plain equality.
    rows = rows.select(
        F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("same"), "text"
    )
    key = ["none", "id", "same"]
    groups = rows.groupBy(*key).agg(F.count("*").alias("copies"), F.max(F.char_length("text")).cast("long").alias("n_chars"))
    order = [F.col("none").desc(), F.col("id"), F.col("same")]
    placed = scratch.store(dense_index(groups, order, "place"), "places")
    total = max(placed.count(), 1)
    after = placed.select(*[F.col(c).alias(f"next_{c}") for c in key], ((F.col("place") + total - 1) % total).alias("place"))
    placed = scratch.store(placed.join(after, "place").drop("place"), "order")

    parts = SPLIT * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.dropDuplicates(key) if _repeats(placed) else rows
    texts = texts.repartition(parts, *key)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    heads = texts.select(*[F.col(c).alias(f"next_{c}") for c in key], "text").join(placed, [f"next_{c}" for c in key])
    heads = heads.select(*key, F.left("text", half).alias("head")).repartition(parts, *key)
    both = texts.join(placed, key).join(heads, key)

    def edit(head: Column) -> Column:
        kept = (F.col("n_chars") - half).cast("int")
        return F.concat(F.left("text", kept), head)

    # Variant 1 is followed by the next row, variant 2 by an equal row.
    edited = {1: edit(F.col("head")), 2: F.when(F.col("copies") > 1, edit(F.left("text", half)))}
    variants = F.array(*[F.struct(F.lit(v).alias("v"), t.alias("t")) for v, t in {0: F.col("text"), **edited}.items()])
    each = both.select(*key, F.explode(variants).alias("x")).select(*key, "x.v", "x.t")
    each = signatures(each, [*key, "v"], "t", samples).groupBy(*key)
    each = each.agg(*[F.max(F.when(F.col("v") == v, F.col("signature"))).alias(f"signature{v}") for v in (0, 1, 2)])
    digests = both.select(*placed.columns, *[F.sha2(t, 256).alias(f"sha{v}") for v, t in edited.items()])
    wide = scratch.store(digests.join(each, key, "left"), "signatures")
    following = wide.select(*[F.col(c).alias(f"next_{c}") for c in key], F.col("signature0").alias("next_signature"))
    wide = wide.join(following, [f"next_{c}" for c in key])
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    out = wide.select("*", copy)
    last = F.col("copy") == F.col("copies")
    changed = F.when(last, F.col("signature1")).otherwise(F.col("signature2"))
    mine = F.col("signature0")
    return out.select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"),
        "n_chars",
        F.when(last, F.col("sha1")).otherwise(F.col("sha2")).alias("edited_sha256"),
        as_string(mine).alias("fingerprint"),
        as_string(changed).alias("edited_fingerprint"),
        likeness(mine, changed, samples).alias("near_edited"),
        F.when(last, likeness(mine, F.col("next_signature"), samples)).otherwise(F.lit(1.0)).alias("near_next"),
    )


def _repeats(placed: DataFrame) -> bool:
    return placed.where(F.col("copies") > 1).limit(1).count() > 0

