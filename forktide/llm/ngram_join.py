"""Links between texts whose n-gram sets have a Jaccard similarity of at least a threshold.

1. Every text becomes its set of five-word shingles (64-bit hashes). Texts with the same set are one
   node, so copies are never compared with each other.
2. MinHash: ``bands`` bands of ``rows`` smallest hashes, chosen for a target recall at the threshold.
   Nodes are shuffled on band hashes; buckets of one node are dropped.
3. In a bucket, nodes are paired if their sizes allow the similarity and their signatures do not rule
   it out (``MARGIN`` below the threshold). Small buckets are joined with themselves; a bucket of
   more than ``SMALL`` nodes is cut into blocks of some ``BLOCK`` nodes, and each pair of blocks goes
   to one task, which returns a spanning forest instead of all pairs.
4. Nodes linked so form families. Every node's whole set is sent to its family once (once per pair of
   blocks, if the family is large), and there all pairs are verified exactly. A task returns the
   number of links of each node and a spanning forest, never pairs.

Result: one row per input row with its class (the smallest key among those linked, directly or
through others) and its number of links, which are all other rows at or above the threshold, copies
included.

Defined results: NULL counts as the empty text; all empty texts are copies of each other; a text of
fewer than five words has one shingle, all its words; rows without key are handled like others, and a
class that only holds such rows has a NULL class; repeated rows are copies; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.llm.common import free_names, give_back, stored
from forktide.llm.components import components
from forktide.llm.fingerprints import with_shingle_hashes

THRESHOLD = 0.8
RECALL = 0.9995
ROWS = 5
SMALL = 24
BLOCK = 1_024
# Signatures may underestimate by this much; with 100 hashes it is five standard deviations.
MARGIN = 0.2
BROADCAST_ROWS = 500_000
VOCABULARY_SLICE = 2_048


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands needed so that a pair at the threshold shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    odd = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, r.integers(0, 1 << 63, n, dtype=np.uint64)


def features(docs: DataFrame, key: str, text: str, bands: int, rows: int) -> DataFrame:
    """Per row: key, hash of the text, ``node`` (digest of its set), set size, signature, band hashes."""
    odd, add = _hash_functions(bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column("_set")
            values = sets.values.to_numpy(zero_copy_only=False).view(np.uint64)
            offsets = sets.offsets.to_numpy()
            nodes, sizes, signatures, bucket = [], [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = np.unique(values[a:b])
                least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
                for i in range(0, len(own), 4096):
                    mixed = own[i : i + 4096, None] * odd
                    mixed ^= mixed >> np.uint64(32)
                    mixed += add
                    mixed *= np.uint64(0x9E3779B97F4A7C15)
                    least = np.minimum(least, mixed.min(0))
                nodes.append(hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest())
                sizes.append(len(own))
                signatures.append((least >> np.uint64(40)).astype(np.uint8).tobytes())
                turned = least.reshape(bands, rows).copy()
                mix = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                for r in range(rows):
                    mix = (mix ^ turned[:, r]) * np.uint64(0xFF51AFD7ED558CCD)
                    mix ^= mix >> np.uint64(33)
                bucket.append(mix.view(np.int64))
            del sets, values
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    batch.column("_row"),
                    pa.array(nodes, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(bucket, pa.list_(pa.int64())),
                ],
                names=["_key", "_row", "node", "size", "signature", "buckets"],
            )
            give_back()

    plain = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.xxhash64(text).alias("_row")
    )
    sets = with_shingle_hashes(plain, "_text", "_set").select("_key", "_row", "_set")
    kind = docs.schema[key].dataType.simpleString()
    return sets.mapInArrow(
        run, f"_key {kind}, _row bigint, node string, size bigint, signature binary, buckets array<bigint>"
    )


class _Forest:
    """Union by smallest, for a spanning forest inside one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _in_blocks(members: DataFrame, group: str, total: str, node: str) -> DataFrame:
    """Members of each group, sent to every pair of blocks their own block is in (``_i <= _j``)."""
    blocks = F.ceil(F.col(total) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(node), F.col("_blocks")).cast("int")
    return (
        members.withColumn("_blocks", blocks)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_blocks", "_other")
    )


def _similar_in_block(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        signs = np.frombuffer(b"".join(pdf["signature"]), np.uint8).reshape(len(pdf), -1)
        sizes = pdf["size"].to_numpy()
        nodes = pdf["node"].to_numpy()
        forest = _Forest(len(pdf))
        for x in range(len(pdf) - 1):
            same = (signs[x + 1 :] == signs[x]).mean(1)
            low, high = np.minimum(sizes[x + 1 :], sizes[x]), np.maximum(sizes[x + 1 :], sizes[x])
            for y in np.flatnonzero((same >= threshold - MARGIN) & (low >= threshold * high)):
                forest.join(x, x + 1 + int(y))
        roots = [forest.find(x) for x in range(len(pdf))]
        return pd.DataFrame({"a": nodes, "b": nodes[roots]})

    return run


def _verified_in_block(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node")
        own, nodes, copies = pdf["_own"].to_numpy(), pdf["node"].to_numpy(), pdf["copies"].to_numpy()
        i, j = int(pdf["_i"].iloc[0]), int(pdf["_j"].iloc[0])
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        sets = [np.unique(np.asarray(s, np.int64)) for s in pdf["_set"]]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, word, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[word] > 1  # shingles of one text only are in no intersection
        numbers = np.cumsum(times > 1) - 1
        owner, word = owner[shared], numbers[word[shared]]
        order = np.argsort(word, kind="stable")
        owner, word = owner[order], word[order]
        common = np.zeros((len(left), len(right)), np.float64)
        at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
        at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
        for start in range(0, int(times[times > 1].size), VOCABULARY_SLICE):
            a, b = np.searchsorted(word, [start, start + VOCABULARY_SLICE])
            some, column = owner[a:b], word[a:b] - start
            x = np.zeros((len(left), VOCABULARY_SLICE), np.float32)
            y = np.zeros((len(right), VOCABULARY_SLICE), np.float32)
            inside = at_left[some] >= 0
            x[at_left[some[inside]], column[inside]] = 1
            inside = at_right[some] >= 0
            y[at_right[some[inside]], column[inside]] = 1
            common += x @ y.T
        union = sizes[left][:, None] + sizes[right][None] - common
        linked = common >= threshold * union - 1e-9
        forest = _Forest(len(sets))
        links = np.zeros(len(sets), np.int64)
        if i == j:
            np.fill_diagonal(linked, False)
            links[left] += (linked * copies[right][None]).sum(1)
        else:
            links[left] += (linked * copies[right][None]).sum(1)
            links[right] += (linked * copies[left][:, None]).sum(0)
        for x, y in zip(*np.nonzero(linked)):
            forest.join(int(left[x]), int(right[y]))
        roots = [forest.find(x) for x in range(len(sets))]
        return pd.DataFrame({"a": nodes, "b": nodes[roots], "links": links})

    return run


def links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """Per row: key, ``_row`` (hash of its text), ``class_id``, ``n_links``, ``n_copies`` (rows with its set)."""
    spark = docs.sparkSession
    bands = bands_for(threshold, recall, ROWS)
    rows = stored(spark, features(docs, key, text, bands, ROWS), "features")
    nodes = rows.groupBy("node").agg(
        F.min(F.struct(F.col("_key").isNull(), "_key", "_row")).alias("r"),
        F.count(F.lit(1)).alias("copies"),
        F.min("size").alias("size"),
        F.min("signature").alias("signature"),
        F.min("buckets").alias("buckets"),
    )
    nodes = stored(spark, nodes.select("node", "copies", "size", "signature", "buckets", "r._key", "r._row"), "nodes")
    placed = nodes.select("node", F.explode("buckets").alias("bucket"))
    full = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("total")).filter("total > 1")
    members = placed.join(full, "bucket").join(nodes.select("node", "size", "signature"), "node")
    members = stored(spark, members, "members")
    small, large = members.filter(F.col("total") <= SMALL), members.filter(F.col("total") > SMALL)
    other = small.select("bucket", *[F.col(c).alias(f"o_{c}") for c in ("node", "size", "signature")])
    fits = F.least("size", "o_size") >= threshold * F.greatest("size", "o_size")
    near = small.join(other, "bucket").filter((F.col("node") < F.col("o_node")) & fits)
    width = bands * ROWS
    same = F.size(
        F.filter(
            F.sequence(F.lit(1), F.lit(width)),
            lambda i: F.substring("signature", i, F.lit(1)) == F.substring("o_signature", i, F.lit(1)),
        )
    )
    near = near.dropDuplicates(["node", "o_node"]).filter(same >= F.lit((threshold - MARGIN) * width))
    edges = near.select(F.col("node").alias("a"), F.col("o_node").alias("b"))
    if large.limit(1).count():
        blocks = _in_blocks(large.select("bucket", "total", "node", "size", "signature"), "bucket", "total", "node")
        edges = edges.union(
            blocks.groupBy("bucket", "_i", "_j").applyInPandas(_similar_in_block(threshold), "a string, b string")
        )
    families = components(edges, "a", "b")
    sizes = families.groupBy("root").agg(F.count(F.lit(1)).alias("total"))
    wanted = stored(
        spark,
        families.join(sizes, "root").join(nodes.select("node", "copies", "_key", "_row"), "node"),
        "wanted",
    )
    few = wanted.count() <= BROADCAST_ROWS
    texts = docs.select(F.col(key).alias("_k"), F.xxhash64(text).alias("_r"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    same_row = F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_r") == F.col("_row"))
    found = texts.join(F.broadcast(wanted) if few else wanted, same_row)
    sets = with_shingle_hashes(found.select("root", "total", "node", "copies", "_text"), "_text", "_set").drop("_text")
    verified = stored(
        spark,
        _in_blocks(sets, "root", "total", "node")
        .groupBy("root", "_i", "_j")
        .applyInPandas(_verified_in_block(threshold), "a string, b string, links bigint"),
        "verified",
    )
    classes = components(verified.filter("a <> b"), "a", "b")
    counted = verified.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = (
        nodes.select("node", "copies", "_key")
        .join(classes, "node", "left")
        .join(counted, "node", "left")
        .select(
            "node", "copies", "_key", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")
        )
    )
    least = named.groupBy("root").agg(F.min("_key").alias("class_id"))
    named = named.join(least, "root").select("node", "root", "class_id", "links", "copies")
    return (
        rows.select("_key", "_row", "node")
        .join(named, "node")
        .select(
            F.col("_key").alias(key),
            "_row",
            "class_id",
            (F.col("links") + F.col("copies") - 1).alias("n_links"),
            F.col("copies").alias("n_copies"),
            F.col("root").alias("_class"),
        )
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each class: the one with the smallest key (then hash of its text)."""
    found = links(docs, key, text)
    kept = found.groupBy("_class").agg(F.min(F.struct(F.col(key).isNull(), key, "_row")).alias("k"))
    none, name, own = free_names(docs, n=3)
    # Joined and freed of repeated rows by the same columns, so texts are shuffled and sorted once.
    ids = [none, name, own]

    def named(key: Column, row: Column) -> list[Column]:
        return [key.isNull().alias(none), F.coalesce(key.cast("string"), F.lit("")).alias(name), row.alias(own)]

    kept = kept.select(*named(F.col(f"k.{key}"), F.col("k._row")))
    rows = docs.select("*", *named(F.col(key), F.xxhash64(text)))
    return rows.join(kept, ids, "left_semi").dropDuplicates(ids).select(*docs.columns)
