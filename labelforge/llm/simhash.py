"""Operator 10: SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most ``d`` bits apart share a point that is at most d/2
bits from each.  So every distinct fingerprint emits all variants within d/2 bits,
variants meet at a shuffle, and any two fingerprints under one variant are linked.

The 2,081 variants (d = 4) of a fingerprint are not shipped one by one.  The shuffle
key is the leading ``bits`` bits of the variant, and a fingerprint is sent once to each
prefix that one of its variants has (56 rows at 10 bits); the receiving task expands
the variants under its own prefix, sorts them, drops repeated pairs and verifies each
remaining pair by its bit distance.  Prefixes that many fingerprints fall into (a large
group of near copies) are cut again by 8 more bits until they are small, down to single
variants, which at most 2,081 different fingerprints can share.  Texts with equal
fingerprints are folded into one before all that.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import raw_texts, read, release_memory, unused, written
from labelforge.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
# Rows per prefix that are aimed at: a 500th of all, within these bounds (few rows give more
# tasks, many rows shorter prefixes and so fewer copies of each); and where a prefix is cut
# further (8 MB of fingerprints).
LEAST_ROWS, MOST_ROWS, SPLIT_ROWS, REFINE_BITS = 8_000, 250_000, 1_000_000, 8
# Variants sorted at once inside a task (32 MB), and shingles counted at once.
SORT_VARIANTS, COUNT_SHINGLES = 1 << 22, 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of one text: A-Z lower-cased, words between ASCII white space,
    ``shingle``-word shingles with repeats (a shorter text is one shingle), XXH64 of each
    with seed 42; a bit is 1 if set in over half the hashes.  No word: 0."""
    words = text.lower().split() if text else ()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest, total = xxhash.xxh64_digest, len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, COUNT_SHINGLES):
        stop = min(total, at + COUNT_SHINGLES)
        block = b"".join([digest(joined[a:b - 1], SEED) for a, b in
                          zip(starts[at:stop], ends[at + shingle - 1:stop + shingle - 1])])
        bits = np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, text_hash, fp)``; ``fp`` is the signed image."""
    def batches(it):
        for batch in it:
            values = [fingerprint(t, shingle) for t in raw_texts(batch.column(2))]
            fps = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)],
                                             names=["doc_id", "text_hash", "fp"])
        release_memory()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text") \
        .mapInArrow(batches, f"doc_id {id_type}, text_hash long, fp long")


def _masks(width: int, radius: int) -> np.ndarray:
    """All masks of ``width`` bits with at most ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for r in range(min(radius, width) + 1)
                     for c in itertools.combinations(range(width), r)], np.uint64)


def _collisions(fps: np.ndarray, index: np.ndarray, prefix: int, bits: int, radius: int,
                cache: dict, out: list) -> None:
    """Index pairs of fingerprints that share a variant starting with ``prefix``."""
    rest = 64 - bits
    low = fps & np.uint64((1 << rest) - 1)
    left = radius - np.bitwise_count((fps >> np.uint64(rest)) ^ np.uint64(prefix)).astype(np.int64)
    keep = left >= 0
    low, left, fps, index = low[keep], left[keep], fps[keep], index[keep]
    if len(fps) < 2:
        return
    size = sum(int((left == r).sum()) * sum(math.comb(rest, i) for i in range(r + 1))
               for r in range(radius + 1))
    if len(fps) > 1 << min(bits, 40) or (size > SORT_VARIANTS and rest > 4):
        for sub in range(16):
            _collisions(fps, index, prefix << 4 | sub, bits + 4, radius, cache, out)
        return
    parts = []
    for r in range(radius + 1):
        at = np.flatnonzero(left == r)
        if len(at):
            masks = cache.setdefault((rest, r), _masks(rest, r))
            variants = (low[at][:, None] ^ masks[None, :]) << np.uint64(bits)
            parts.append((variants | at.astype(np.uint64)[:, None]).ravel())
    keys = np.sort(np.concatenate(parts))
    same = np.flatnonzero((keys[1:] >> np.uint64(bits)) == (keys[:-1] >> np.uint64(bits)))
    if len(same):
        owner = np.uint64((1 << bits) - 1)
        a, b = (keys[same] & owner).astype(np.int64), (keys[same + 1] & owner).astype(np.int64)
        pairs = np.unique(np.minimum(a, b) * len(fps) + np.maximum(a, b))
        out.append(np.stack([index[pairs // len(fps)], index[pairs % len(fps)]]))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(jump := root[root], root):
            root = jump
        if np.array_equal(root[a], root[b]):
            return root


def _prefix_rows(fps: DataFrame, bits: int, radius: int) -> DataFrame:
    masks = F.array(*[F.lit(int(m)).cast("long") for m in _masks(bits, radius)])
    top = F.shiftrightunsigned("fp", 64 - bits)
    return fps.select("fp", F.explode(masks).alias("m")) \
        .select(F.lit(bits).alias("bits"), top.bitwiseXOR(F.col("m")).alias("prefix"), "fp")


def _refined(rows: DataFrame, hot: DataFrame, bits: int, radius: int) -> DataFrame:
    """Rows of the ``hot`` prefixes (all ``bits`` long), sent on to longer prefixes."""
    more = min(REFINE_BITS, 64 - bits)
    masks = F.array(*[F.lit(int(m)).cast("long") for m in _masks(more, radius)])
    own = F.shiftrightunsigned("fp", 64 - bits - more)
    body = F.lit((1 << more) - 1).cast("long")
    spread = rows.join(hot.select("prefix"), "prefix", "left_semi") \
        .select("prefix", "fp", F.explode(masks).alias("m")) \
        .select(F.lit(bits + more).alias("bits"), "fp",
                F.shiftleft("prefix", more).bitwiseOR(own.bitwiseAND(body).bitwiseXOR(F.col("m")))
                .alias("prefix"))
    return spread.where(F.bit_count(own.bitwiseXOR(F.col("prefix"))) <= radius) \
        .select("bits", "prefix", "fp")


def near_links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Distinct ``fps(fp)`` -> ``(u, v)``: edges that join exactly the fingerprints reachable
    from each other by links of at most ``max_distance`` (even) differing bits.

    Inside a task only verified links count; they leave it as stars of the task's own
    connected groups, so a group of g near copies gives at most g - 1 rows per prefix."""
    if max_distance % 2:
        raise ValueError("max_distance must be even: all fingerprints under one variant are links")
    radius, n = max_distance // 2, max(1, fps.count())
    aim = min(MOST_ROWS, max(LEAST_ROWS, n // 500))
    bits = next(b for b in range(4, 41) if b == 40 or n * sum(
        math.comb(b, i) for i in range(radius + 1)) / 2 ** b <= aim)

    def stars(table):
        at, prefix = table.column("bits")[0].as_py(), table.column("prefix")[0].as_py()
        values = np.unique(table.column("fp").to_numpy().view(np.uint64))
        found: list[np.ndarray] = []
        if at == 64:
            near = np.flatnonzero(np.bitwise_count(values ^ np.uint64(prefix % (1 << 64))) <= radius)
            found.append(np.stack([near[:-1], near[1:]]))
        else:
            _collisions(values, np.arange(len(values)), prefix, at, radius, {}, found)
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        near = np.bitwise_count(values[a] ^ values[b]) <= max_distance
        root = _forest(a[near], b[near], len(values))
        members = np.flatnonzero(root != np.arange(len(values)))
        return pa.table({"u": values[members].view(np.int64),
                         "v": values[root[members]].view(np.int64)})

    ready, rows = [], _prefix_rows(fps, bits, radius)
    while True:
        if bits == 64:
            ready.append(rows)
            break
        hot = written(rows.groupBy("prefix").count().where(F.col("count") > SPLIT_ROWS), "hot")
        if hot.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(hot, "prefix", "left_anti").select("bits", "prefix", "fp"))
        rows, bits = _refined(rows, hot, bits, radius), min(64, bits + REFINE_BITS)
    edges = None
    for part in ready:
        linked = part.groupBy("bits", "prefix").applyInArrow(stars, "u long, v long")
        edges = linked if edges is None else edges.union(linked)
    return edges.distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                       max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, text_hash, fingerprint, component_id,
    component_fp)``, one row per input row.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_distance`` differing bits; ``component_fp`` names the component.  Null and
    blank texts have fingerprint zero and link like any other; a null doc_id is returned,
    but is never the smallest (a component of null ids alone has a null id).  Repeated
    rows are kept; other columns are ignored.  An empty table gives an empty result.
    """
    found = written(fingerprints(docs.select("doc_id", "text"), shingle), "fp")
    groups = written(found.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")),
                     "fp-groups")
    parts = connected_components(near_links(groups.select("fp"), max_distance))
    rooted = written(groups.join(parts, groups["fp"] == parts["node"], "left")
                     .where("root is not null or n > 1")
                     .select("fp", F.coalesce("root", "fp").alias("root"), "low"), "fp-roots")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    shared = rooted.select("fp", "root").join(lows, "root")
    # a fingerprint may belong to a third of all documents: its rows meet the map salted
    salts = 16
    salted = shared.select("root", "component_id", F.col("fp").alias("_fp"),
                           F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"))
    rows = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(salts)).cast("int"))
    out = rows.join(salted, (rows["fp"] == salted["_fp"]) & (rows["_salt"] == salted["_s"]), "left")
    alone = F.col("root").isNull()
    return out.select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("root", "fp").alias("component_fp"))


def keep_one_per_component(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                           max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` without near copies: of each component the row with the smallest doc_id (of
    repeated rows one; of a component of null ids one) stays, with all its columns."""
    marked = simhash_components(docs, shingle, max_distance)
    first = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("component_fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("w")) \
        .select("w.doc_id", "w.text_hash")
    mark, first_id, first_hash = (unused(n, docs.columns) for n in ("_key", "_first_id", "_first_hash"))
    keys = first.select(F.col("doc_id").alias(first_id), F.col("text_hash").alias(first_hash))
    cond = docs["doc_id"].eqNullSafe(keys[first_id]) & (F.xxhash64(docs["text"]) == keys[first_hash])
    # repeated rows agree in their id and in the hash
    kept = docs.join(keys, cond, "left_semi").withColumn(mark, F.xxhash64("text")) \
        .dropDuplicates(["doc_id", mark])
    return kept.select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: fingerprint and component of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return simhash_components(docs).select("doc_id", "fingerprint", "component_id")
