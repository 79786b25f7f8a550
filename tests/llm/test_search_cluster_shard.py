"""Ranked search, centroid clustering and sharding against brute force, on small tables with nulls, empty
and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_llm_operators import ODD, docs_of, prose

from verbatide.llm import centroids, lexical_search, sharding
from verbatide.llm.common import Scratch, free_names
from verbatide.llm.queries import QUERIES

ITEMS = "item_id long, text string"


# 11 ----------------------------------------------------------------------------------------------


def terms(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute_search(docs, items, top):
    cut = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    cut = [c for c in cut if c[2]]
    documents, tokens = len(cut), sum(c[2] for c in cut)
    df = Counter(t for _, c, _ in cut for t in c)
    rows = []
    for item, text in items:
        scored = []
        for i, tf, n in cut:
            m = 75 + (25 * n * documents) // tokens
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
                for t in terms(text)
                if t in tf
            )
            if score > 0:
                scored.append((-score, i is not None, -1 if i is None else i, i))
        rows += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(rows, key=str)


def search_rows(found):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()), key=str)


@pytest.mark.parametrize(("shard_bytes", "top"), [(1 << 20, 20), (700, 3)])
def test_search_by_brute_force(spark, shard_bytes, top):
    rng = np.random.default_rng(3)
    texts = [prose(rng, int(n), 300) for n in rng.zipf(1.4, 400).clip(1, 600)]
    texts += ODD + ["w1 w2 w3"] * 40 + [texts[0]] * 3 + ["w5 " * 3000]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "w1 w2"), (None, None), (7, texts[7])]
    items = [(k, prose(rng, 12, 300)) for k in range(25)] + [(90, None), (91, "?!"), (92, "w1 w1 W1 w2"), (93, "é café hello unseen")]
    found = lexical_search.search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), top, shard_bytes=shard_bytes, query_terms=150
    )
    assert search_rows(found) == brute_search(docs, items, top)


def test_search_of_empty_tables_and_other_types(spark):
    none, items = docs_of(spark, []), spark.createDataFrame([(1, "a b")], ITEMS)
    assert lexical_search.search(none, items).collect() == []
    assert lexical_search.search(docs_of(spark, ["a", None]), items.limit(0)).collect() == []
    named = spark.createDataFrame([("x", "a b", 1), ("y", "a", 2), (None, "a", 3)], "key string, body string, score int")
    asked = spark.createDataFrame([("q", "a"), ("q", "b"), (None, "a")], "name string, words string")
    found = lexical_search.search(named, asked, 2, "key", "body", "name", "words")
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("item_id", "string"), ("rank", "int"), ("doc_id", "string"), ("score", "bigint")
    ]
    rows = {(r["item_id"], r["rank"]): r["doc_id"] for r in found.collect()}
    assert rows[("q", 1)] == "x" and rows[(None, 1)] is None and rows[(None, 2)] == "y" and len(rows) == 4


def test_lists_are_read_back_and_bounds_hold():
    rng = np.random.default_rng(5)
    texts = [b"a " * int(n) + b"b c" for n in rng.integers(0, 900, 300)] + [b"", b"  ", b"z"]
    head, *batches = lexical_search.build_shard(4, pa.array(range(len(texts))), texts)
    ids = head.to_pylist()[0]["ids"]
    sizes = np.frombuffer(head.to_pylist()[0]["data"], "<i8")
    assert len(ids) == 301 and (np.diff(sizes) >= 0).all() and sizes.sum() == sum(len(t.split()) for t in texts)
    norms = lexical_search.length_norm(sizes, 301, int(sizes.sum()))
    for row in (r for b in batches for r in b.to_pylist()):
        postings = lexical_search.PostingList(row, 7, norms)
        docs, scores = postings.postings()
        tf = np.array([texts[ids[d]].split().count(row["term"]) for d in docs])
        assert (tf > 0).all() and row["df"] == sum(row["term"] in t.split() for t in texts)
        assert (scores == 7 * lexical_search.saturation(tf, norms[docs])).all() and (np.diff(docs) > 0).all()
        blocks = np.arange(0, len(postings.firsts), 2)
        some, part = lexical_search.PostingList(row, 7, norms)._decode(blocks)
        wanted = np.isin(postings.blocks_of(docs), blocks)
        assert (some == docs[wanted]).all() and (part == scores[wanted]).all()
        assert (scores <= postings.block_bounds[postings.blocks_of(docs)]).all()


def test_blocks_without_candidates_stay_compressed(monkeypatch):
    texts = [b"rare " + b"common " * 3] * 20 + [b"common " + b"x%d " % i for i in range(4000)]
    head, *batches = lexical_search.build_shard(0, pa.array(range(len(texts))), texts)
    sizes = np.frombuffer(head.to_pylist()[0]["data"], "<i8")
    norms = lexical_search.length_norm(sizes, len(texts), int(sizes.sum()))
    rows = {r["term"]: r for b in batches for r in b.to_pylist() if r["term"] in (b"rare", b"common")}
    lists = [(lexical_search.PostingList(rows[t], lexical_search.term_weight(len(texts), rows[t]["df"]), norms), 1) for t in rows]
    read = []
    decode = lexical_search.PostingList._decode
    monkeypatch.setattr(lexical_search.PostingList, "_decode", lambda self, blocks: read.append((self.df, len(blocks))) or decode(self, blocks))
    docs, scores = lexical_search.search_shard(lists, len(sizes), 10, 0)
    assert len(docs) == 20 and len(set(scores.tolist())) == 1
    assert sum(n for df, n in read if df == len(texts)) < len(texts) / lexical_search.BLOCK / 4


# 12 ----------------------------------------------------------------------------------------------


def brute_clusters(rows, clusters, rounds, scale, width, seed):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    means = [v for _, v in order[:clusters]]

    def assign():
        return [min((sum((x - c) ** 2 for x, c in zip(v, m)), k) for k, m in enumerate(means)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for k in range(len(means)):
            mine = [v for (_, v), (_, c) in zip(kept, near) if c == k]
            if mine:
                means[k] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assign()
    return sorted([(i, c, d) for (i, _), (d, c) in zip(kept, near)], key=str), means


@pytest.mark.parametrize(("clusters", "rounds", "width"), [(4, 3, 5), (1, 1, 2), (7, 0, 3)])
def test_clusters_by_brute_force(spark, clusters, rounds, width):
    rng = np.random.default_rng(clusters)
    rows = [(i, [float(x) for x in rng.normal(0, 1 + i % 3, width)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(3, rows[3][1])] * 2 + [(None, rows[5][1]), (200, None), (201, [])]
    rows += [(202, [1.0] * (width - 1) + [None]), (203, [1.0] * (width - 1) + [float("nan")]), (204, [float("-inf")] * width)]
    rows += [(205, [0.5] * (width + 1)), (206, [-0.0] * width), (207, [-1e-30] * width)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash"))
    assigned, found = centroids.cluster_vectors(df, clusters, rounds, 64, width, 1)
    want, means = brute_clusters(rows, clusters, rounds, 64, width, 1)
    assert sorted([(r["vec_id"], r["cluster"], r["distance"]) for r in assigned.collect()], key=str) == want
    assert found.vectors == means
    report = centroids.cluster_report(assigned, found).collect()
    per = Counter()
    for _, c, d in want:
        per[c] += d
    for r in report:
        assert r["cluster_inertia"] == per[r["cluster"]] and r["inertia"] == sum(per.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, means[r["cluster"]])).encode()).hexdigest()


def test_few_vectors_empty_tables_and_large_components(spark):
    schema = "vec_id long, embedding array<float>"
    assigned, found = centroids.cluster_vectors(spark.createDataFrame([(1, [1.0, 2.0])], schema), 16, 3, 64, 2)
    assert [tuple(r) for r in assigned.collect()] == [(1, 0, 0)] and found.vectors == [[64, 128]]
    assigned, found = centroids.cluster_vectors(spark.createDataFrame([], schema), 16, 3, 64, 2)
    report = centroids.cluster_report(assigned, found)
    assert report.collect() == [] and found.vectors == []
    assert dict(report.dtypes) == {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"
    }
    with pytest.raises(ValueError, match="too large"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [3e38, 0.0])], schema), 2, 1, 64, 2)


# 13 ----------------------------------------------------------------------------------------------


def check_slots(rows, shards):
    for s in range(shards):
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 900])
def test_rows_law_places_every_row_once(spark, bucket_bytes):
    rng = np.random.default_rng(2)
    texts = [prose(rng, int(n)) for n in rng.integers(1, 60, 300)] + ODD + ["same text"] * 150
    docs = docs_of(spark, texts).withColumns({"shard": F.lit("clash"), "_tie": F.col("doc_id") * 2, "Bucket": F.lit(1)})
    docs = docs.unionByName(docs.where("doc_id < 3")).unionByName(docs.where("doc_id < 2").withColumn("doc_id", F.lit(None).cast("long")))
    placed = sharding.shard_texts(docs, 7, "rows", bucket_bytes=bucket_bytes)
    assert placed.columns == ["doc_id", "text", "_tie", "Bucket", "size", "grown_shard", "shard", "slot"]
    rows = placed.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert all(r["size"] == len((r["text"] or "").encode()) + 16 and r["grown_shard"] is None for r in rows)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    check_slots(rows, 7)
    copies = Counter(r["shard"] for r in rows if r["text"] == "same text")
    assert len(copies) == 7 and max(copies.values()) < 50
    # Neither input order nor text order is left: neighbours are unrelated.
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])) if r["doc_id"] is not None]
    assert abs(np.corrcoef(range(len(ids)), ids)[0, 1]) < 0.2
    assert sum(b - a == 1 for a, b in zip(ids, ids[1:])) < 15


def test_one_seed_gives_one_order(spark):
    docs = docs_of(spark, [f"text {i}" for i in range(200)])
    places = lambda df, **k: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_texts(df, 5, bucket_bytes=500, **k).collect()}
    one = places(docs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert places(docs.repartition(6)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    other = places(docs, seed=21)
    assert sum(other[i] == one[i] for i in one) < 40


def test_key_law_moves_rows_only_into_the_new_shard(spark):
    docs = docs_of(spark, [f"t{i % 9}" for i in range(400)] + [None])
    rows = sharding.shard_texts(docs, 6, "key", bucket_bytes=700).collect()
    grown = {r["doc_id"]: r["shard"] for r in sharding.shard_texts(docs.where("doc_id % 2 = 0"), 7, "key").collect()}
    assert len(rows) == 401 and all(r["grown_shard"] in (r["shard"], 6) for r in rows)
    assert all(grown[r["doc_id"]] == r["grown_shard"] for r in rows if r["doc_id"] % 2 == 0)
    assert min(Counter(r["shard"] for r in rows).values()) > 40 and 30 < sum(r["grown_shard"] == 6 for r in rows) < 90
    check_slots(rows, 6)


def test_shards_are_files_in_slot_order(spark, tmp_path):
    docs = docs_of(spark, [f"text {i}" for i in range(300)])
    sharding.shard_texts(docs, 3, path=str(tmp_path / "out"))
    for s in range(3):
        files = list((tmp_path / "out" / f"shard={s}").glob("*.parquet"))
        slots = [pq.read_table(f).column("slot").to_pylist() for f in files]
        assert all(x == sorted(x) for x in slots) and sorted(sum(slots, [])) == list(range(100))


def test_sharding_of_empty_tables_and_wrong_arguments(spark):
    for law in sharding.LAWS:
        assert sharding.shard_texts(docs_of(spark, []), 4, law).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_texts(docs_of(spark, ["a"]), 4, "size")
    with pytest.raises(ValueError):
        sharding.shard_texts(docs_of(spark, ["a"]), 0)


def test_first_places_sum_all_earlier_buckets(spark):
    rows = [(p, p * 5000 + b, (b * 7 + p) % 11 + 1) for p in range(2) for b in range(0, 4000, 3)]
    found = sharding._first_places(spark.createDataFrame(rows, "part int, bucket long, n long")).collect()
    want, sums = {}, Counter()
    for p, b, n in sorted(rows):
        want[b] = sums[p]
        sums[p] += n
    assert {r["bucket"]: r["first"] for r in found} == want


def test_sharding_query_by_its_law(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op13_sharding"].run(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in source.collect()}
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["law"] == "rows" for r in rows)
    counts = Counter(r["shard"] for r in rows)
    assert len(counts) == 40 and max(counts.values()) - min(counts.values()) <= 1
    check_slots(rows, 40)


def test_sharding_needs_no_python(spark, monkeypatch):
    """Every plan that is written on the way is native."""
    plans, store = [], Scratch.store

    def seen(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(self, df, name)

    monkeypatch.setattr(Scratch, "store", seen)
    placed = sharding.shard_texts(docs_of(spark, ["a", "b"]).withColumn("text", F.upper("text")), 2)
    plans.append(placed._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("MapInArrow" in p or "PythonUDF" in p or "CartesianProduct" in p for p in plans)


def test_free_names_avoid_taken_ones():
    assert free_names(["_TIE", "_tie_"], "tie at at") == ["_tie__", "_at", "_at_"]
