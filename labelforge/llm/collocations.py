"""Operator 13: collocations, counted by Rabin-Karp fingerprints.

1. Documents are numbered, written once and dealt into blocks of a few MB by their numbers, in
   whose order a block's texts stand: a place in a block names the same word in every step,
   however the rows arrive.  A block's words in a row are the terms of prefix polynomials
   modulo two primes; the difference of two prefixes is the fingerprint of the words between
   them.
2. Each block sends the fingerprints of its words and pairs to shards, once each, with their
   number and a pointer to an occurrence.  Shards add up and return to each block the
   pointers of those that may be frequent.
3. A triple can only be frequent if both of its pairs are: blocks send the fingerprints of
   such triples and get their pointers back in the same way.
4. Only what a pointer came back for becomes text.  A block compares all occurrences of the
   fingerprint with the words the pointer shows (colliding ones are phrases of their own)
   and sends each phrase's text with its number to its shard, the phrases of a language in
   order and packed; sums by text make the counts exact.  A fingerprint never decides a
   result, it only leaves out what is rare and names a shard.
5. Scores and the comparison with longer phrases are joins of the frequent phrases.  Each
   number is shuffled once per look-up; parts that begin or end very many phrases are left to
   Spark's treatment of skewed joins.

Blocks and shards are of a fixed size in bytes; a block sends a shard one row (of texts, one a
language).  On very large
inputs that is one row per few fingerprints, as a plain shuffle of fingerprints would be.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelforge.llm.common import discard, fresh_path, partitions, read, release_memory, written

LEAST, TOP, SHARE, SCALE = 10, 2000, 50, 1_000_000
NO_LANG = "und"
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 32 << 20
# Bytes that go to the shards for a byte of text, at most: two entries of nine bytes for a
# word and the sign behind it (only for the number of shards).
SENT_PER_BYTE = 9
PRIMES, BASES = (2147483647, 2147483629), (1_000_003, 998_244_353)
BLANK, CUT = 1, 2
# Between packed phrases: it ends a piece, so no word has it.
BETWEEN = b"\n"
# Bytes after lower-casing A-Z, and what they are: part of a word, between words, between pieces.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = BLANK
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = CUT


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo ``prime``, doubling the length each time."""
    out = np.ones(max(1, n), np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, prime)) % np.uint64(prime)
        have += more
    return out


class Block:
    """The words of a block in a row: ``codes`` into ``dictionary``, the piece each lies in,
    its language, and prefix polynomials."""

    def __init__(self, texts: pa.ChunkedArray, langs: pa.ChunkedArray):
        texts = texts.fill_null("").combine_chunks().cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        data = _LOWER[data]
        kind = _KIND[data]
        word = kind == 0
        edge = np.zeros(len(word), bool)  # where a run of word bytes or a text begins
        edge[1:] = word[1:] != word[:-1]
        edge[:1] = True
        edge[ends[:-1][ends[:-1] < len(word)]] = True
        starts = np.flatnonzero(edge)
        stops = np.append(starts[1:], len(word))
        own = word[starts] if len(starts) else np.zeros(0, bool)
        starts, stops = starts[own], stops[own]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(stops - starts, out=offsets[1:])
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[word])])
        coded = packed.dictionary_encode()
        # codes ascend with the words, so that phrases in the order of their codes pack well
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.codes = rank[coded.indices.to_numpy()]
        self.dictionary = coded.dictionary.take(pa.array(order))
        self.text = np.searchsorted(ends, starts, "right") - 1
        cuts = np.flatnonzero(kind == CUT)
        piece = np.searchsorted(cuts, starts)
        # a piece ends at a cut and at the end of its text
        change = (np.diff(piece) != 0) | (np.diff(self.text) != 0)
        self.piece = np.zeros(len(starts), np.int64)
        np.cumsum(change, out=self.piece[1:])
        lang = langs.fill_null(NO_LANG).combine_chunks().dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        self.lang = lang.indices.to_numpy()[self.text].astype(np.int64) if len(starts) else np.zeros(0, np.int64)
        self._prefixes()

    def _prefixes(self) -> None:
        words = self.dictionary.to_pylist()
        digest = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
        self.prefix, self.inverse = [], []
        for prime, base in zip(PRIMES, BASES):
            p = np.uint64(prime)
            terms = (digest % p)[self.codes] * _powers(base, prime, len(self.codes))[:len(self.codes)] % p
            prefix = np.zeros(len(terms) + 1, np.uint64)
            np.cumsum(terms, out=prefix[1:])
            self.prefix.append(prefix % p)
            self.inverse.append(_powers(pow(base, -1, prime), prime, len(self.codes)))
        self.seed = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs], np.uint64)

    def starts(self, width: int) -> np.ndarray:
        """Words at which ``width`` words of one piece start."""
        last = len(self.codes) - width + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[width - 1:])

    def fingerprints(self, at: np.ndarray, width: int) -> np.ndarray:
        """Of the ``width`` words from each place on, with their language."""
        out = np.zeros(len(at), np.uint64)
        for prefix, inverse, prime in zip(self.prefix, self.inverse, PRIMES):
            p = np.uint64(prime)
            part = (prefix[at + width] + (p - prefix[at])) % p * inverse[at] % p
            out = out << np.uint64(31) | part
        out += self.seed[self.lang[at]] + np.uint64(width * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return out ^ (out >> np.uint64(31))

    def phrases(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """(languages, fingerprints, texts, numbers) of the ``width`` words at each place, told apart
        by the words themselves; in the order of languages and words."""
        keys = [self.codes[at + k] for k in range(width - 1, -1, -1)] + [self.lang[at]]
        order = np.lexsort(keys)
        new = np.zeros(len(at), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(at)))
        first = at[order[first]]
        words = [self.dictionary.take(pa.array(self.codes[first + k])) for k in range(width)]
        text = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if width > 1 else words[0]
        return self.lang[first], self.fingerprints(first, width), text, n


def _block(table: pa.Table) -> Block:
    """The block of rows that come in any order; places count along the rows' numbers."""
    table = table.sort_by("row")
    return Block(table.column("text"), table.column("lang"))


def _entries(prints: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct fingerprints, their numbers, a place of each)."""
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else order[:0]
    return prints[first], np.diff(np.append(first, len(prints))), at[order[first]]


def _shard(prints: np.ndarray, shards: int) -> np.ndarray:
    """Shards of fingerprints; they ascend with them."""
    return (prints >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)


def _sent(block: int, prints: np.ndarray, n: np.ndarray, at: np.ndarray, shards: int) -> pa.Table:
    """One row per shard: the shard sees 32 bits of each fingerprint, its number and its place.

    A number beyond ``LEAST`` says no more than ``LEAST`` here: exact numbers come with the texts."""
    shard = _shard(prints, shards)
    cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cuts))
    low = prints.astype(np.uint32)
    small = np.minimum(n, LEAST).astype(np.min_scalar_type(LEAST))

    def packed(values):
        return pa.array([values[a:b].tobytes() for a, b in zip(cuts[some], cuts[some + 1])], pa.binary())
    return pa.table({"shard": pa.array(some.astype(np.int32)), "block": pa.array(np.full(len(some), block, np.int32)),
                     "prints": packed(low), "ns": packed(small), "places": packed(at.astype(np.uint32))})


SENT = "shard int, block int, prints binary, ns binary, places binary"


def _send_short(shards: int):
    def send(table):
        block = _block(table)
        prints, at = [], []
        for width in (1, 2):
            at.append(block.starts(width))
            prints.append(block.fingerprints(at[-1], width))
        # a place is that of its first word, twice the number for a word, one more for a pair
        place = np.append(2 * at[0], 2 * at[1] + 1)
        out = _sent(table.column("block")[0].as_py(), *_entries(np.concatenate(prints), place), shards)
        release_memory()
        return out
    return send


def _frequent(table):
    """Per block: the places it sent to this shard whose fingerprints add up to ``LEAST``."""
    rows = [np.frombuffer(x, np.uint32) for x in table.column("prints").to_pylist()]
    sizes = np.array([len(x) for x in rows])
    ns = np.frombuffer(b"".join(table.column("ns").to_pylist()), np.min_scalar_type(LEAST)).astype(np.int64)
    prints = np.concatenate(rows)
    order = np.argsort(prints, kind="stable")
    first = np.flatnonzero(np.append(True, prints[order][1:] != prints[order][:-1]))
    total = np.add.reduceat(ns[order], first)
    often = np.empty(len(prints), bool)
    often[order] = np.repeat(total >= LEAST, np.diff(np.append(first, len(prints))))
    ends = np.cumsum(sizes)
    places = [np.frombuffer(x, np.uint32)[often[e - k:e]].tobytes()
              for x, e, k in zip(table.column("places").to_pylist(), ends, sizes)]
    return pa.table({"block": table.column("block"), "places": pa.array(places, pa.binary())})


def _places(replies: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(replies.column("places").to_pylist()), np.uint32).astype(np.int64)


def _member(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    wanted = np.sort(wanted)
    if not len(wanted):
        return np.zeros(len(values), bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _frequent_pairs(block: Block, places: np.ndarray) -> np.ndarray:
    """Per word: whether a pair that may be frequent starts there."""
    at, shown = block.starts(2), places[places % 2 == 1] // 2
    out = np.zeros(len(block.codes) + 1, bool)
    out[at[_member(block.fingerprints(at, 2), block.fingerprints(shown, 2))]] = True
    return out


def _triples(block: Block, pairs: np.ndarray) -> np.ndarray:
    at = block.starts(3)
    return at[pairs[at] & pairs[at + 1]]


def _send_triples(shards: int):
    def send(left, right):
        if not left.num_rows:
            return pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()),
                             **{c: pa.array([], pa.binary()) for c in ("prints", "ns", "places")}})
        block = _block(left)
        at = _triples(block, _frequent_pairs(block, _places(right)))
        out = _sent(left.column("block")[0].as_py(), *_entries(block.fingerprints(at, 3), at), shards)
        release_memory()
        return out
    return send


PACKED = "shard int, lang string, phrases binary, ns binary"


def _packed(block: Block, found: dict[int, np.ndarray], shards: int) -> pa.Table:
    """One row per shard and language: its phrases at the places found per width, and their
    numbers; the empty phrase stands for all words of a language."""
    every = np.bincount(block.lang, minlength=len(block.langs))
    parts = [(np.arange(len(every)), block.seed, pa.array([b""] * len(every), pa.large_binary()), every)]
    parts += [block.phrases(at, width) for width, at in found.items() if len(at)]
    lang, prints, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3))
    text = pa.concat_arrays([p[2] for p in parts])
    group = _shard(prints, shards).astype(np.int64) * max(1, len(block.langs)) + lang
    order = np.argsort(group, kind="stable")
    group, n = group[order], n[order]
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else group
    ends = np.append(cuts, len(group))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), text.take(pa.array(order))),
                            pa.scalar(BETWEEN, pa.large_binary()))
    numbers = [n[a:b].astype(np.uint8 if n[a:b].max() < 256 else np.int64).tobytes() for a, b in zip(ends, ends[1:])]
    shard, lang = np.divmod(group[cuts], max(1, len(block.langs)))
    return pa.table({"shard": pa.array(shard.astype(np.int32)),
                     "lang": pa.array(block.langs, pa.string()).take(pa.array(lang)),
                     "phrases": pa.array([zlib.compress(x.as_py(), 1) for x in joined], pa.binary()),
                     "ns": pa.array([zlib.compress(x, 1) for x in numbers], pa.binary())})


def _materialise(shards: int):
    """Texts and numbers of a block's phrases that may be frequent, packed for their shards."""
    def send(left, right):
        if not left.num_rows:
            return pa.table({"shard": pa.array([], pa.int32()), "lang": pa.array([], pa.string()),
                             **{c: pa.array([], pa.binary()) for c in ("phrases", "ns")}})
        block = _block(left)
        third = right.column("third").to_numpy()
        short, long = (_places(right.filter(pa.array(third == k))) for k in (0, 1))
        pairs = _frequent_pairs(block, short)
        singles = block.starts(1)
        shown = short[short % 2 == 0] // 2
        found = {1: singles[_member(block.fingerprints(singles, 1), block.fingerprints(shown, 1))],
                 2: np.flatnonzero(pairs)}
        triples = _triples(block, pairs)
        found[3] = triples[_member(block.fingerprints(triples, 3), block.fingerprints(long, 3))]
        out = _packed(block, found, shards)
        release_memory()
        return out
    return send


def _summed(table):
    """lang, width, phrase, n of a shard: the exact numbers of its texts over all blocks, without
    those that are rare after all; width 0: all words."""
    texts = pc.split_pattern(pa.array([zlib.decompress(x) for x in table.column("phrases").to_pylist()],
                                      pa.large_binary()), BETWEEN)
    sizes = pc.list_value_length(texts).to_numpy()
    ns = np.concatenate([np.frombuffer(x, np.uint8 if len(x) == k else np.int64).astype(np.int64) for x, k in
                         zip(map(zlib.decompress, table.column("ns").to_pylist()), sizes)])
    lang = table.column("lang").combine_chunks().dictionary_encode()
    rows = pa.table({"lang": np.repeat(lang.indices.to_numpy(), sizes), "phrase": texts.flatten(), "n": ns})
    del texts
    sums = rows.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
    sums = sums.filter(pc.or_(pc.greater_equal(sums["n_sum"], LEAST), pc.equal(pc.binary_length(sums["phrase"]), 0)))
    width = pc.if_else(pc.equal(pc.binary_length(sums["phrase"]), 0), 0,
                       pc.add(pc.count_substring(sums["phrase"], b" "), 1))
    out = pa.table({"lang": lang.dictionary.take(sums["lang"]), "width": width.cast(pa.int32()),
                    "phrase": sums["phrase"].cast(pa.binary()).cast(pa.string()), "n": sums["n_sum"]})
    del rows, sums
    release_memory()
    return out


def phrase_counts(docs: DataFrame, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs(text, lang, ...)`` -> lang, width, phrase, n of all phrases of one to three words
    that occur ``LEAST`` times or more; width 0: all word occurrences of a language."""
    spark = docs.sparkSession
    paths = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        """Written until the counts are there."""
        paths.append(fresh_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    # three steps read the texts: a second evaluation of ``docs`` might number its rows otherwise
    docs = kept(docs.select("text", F.col("lang").cast("string").alias("lang"),
                            F.monotonically_increasing_id().alias("row")), "collocations-texts")
    size = docs.agg(F.sum(F.octet_length("text") + 1).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    shards = max(1, -(-size * SENT_PER_BYTE // (4 * shard_bytes)))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")) \
        .repartition(max(partitions(spark), min(blocks, 4 * partitions(spark))), "block")
    parts = max(partitions(spark), min(shards, 4 * partitions(spark)))

    def replied(sent: DataFrame, third: int, name: str) -> DataFrame:
        return kept(sent.repartition(parts, "shard").groupBy("shard").applyInArrow(
            _frequent, "block int, places binary").withColumn("third", F.lit(third)), name)

    short = replied(dealt.groupBy("block").applyInArrow(_send_short(shards), SENT), 0, "collocations-short")
    long = replied(dealt.groupBy("block").cogroup(short.groupBy("block")).applyInArrow(
        _send_triples(shards), SENT), 1, "collocations-long")
    texts = dealt.groupBy("block").cogroup(short.unionByName(long).groupBy("block")).applyInArrow(
        _materialise(shards), PACKED)
    counts = written(texts.repartition(parts, "shard").groupBy("shard").applyInArrow(
        _summed, "lang string, width int, phrase string, n long"), "collocations-counts")
    for path in paths:
        discard(spark, path)
    return counts


def score_column() -> Column:
    """floor(SCALE * a * a / (l * r)); the counts are decimals small enough for their products to
    keep all digits."""
    a, l, r = (f"cast({x} as decimal(14,0))" for x in ("a", "l", "r"))  # noqa: E741
    return F.expr(f"({SCALE}bd * {a} * {a}) div ({l} * {r})")


def collocations(docs: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs(text, lang, ...)`` -> lang, rank, phrase, a, l, r, n, score: each language's first
    ``top`` phrases of two or three words.

    Null texts have no words; a null lang is ``und``, together with one written so.  Repeated
    rows count each by itself; texts of any length are taken whole, other columns are ignored;
    an empty table gives an empty result.  Counts up to 10 ** 14 are exact."""
    counts = phrase_counts(docs, block_bytes, shard_bytes)
    number = counts.where("width > 0")
    words = F.split("phrase", " ")
    phrases = counts.where("width > 1").select("lang", "width", "phrase", F.col("n").alias("a"))

    def cut(k: int):
        return F.struct(F.lit(k).alias("k"), F.array_join(F.slice(words, 1, k), " ").alias("first"),
                        F.array_join(F.slice(words, k + 1, F.size(words) - k), " ").alias("rest"))

    def looked_up(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.join(number.select("lang", F.col("phrase").alias(column), F.col("n").alias(name)), ["lang", column])

    cuts = phrases.select("lang", "phrase", "a", F.explode(F.when(F.col("width") == 2, F.array(cut(1)))
                                                          .otherwise(F.array(cut(1), cut(2)))).alias("c")) \
        .select("lang", "phrase", "a", "c.*")
    scored = looked_up(looked_up(cuts, "first", "l"), "rest", "r") \
        .withColumn("score", score_column()) \
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")) \
        .select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    # the longest phrases are triples, so only pairs lie inside another
    inside = phrases.where("width = 3").select("lang", F.explode(F.array(
        F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " "))).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left") \
        .where(F.coalesce(100 * F.col("longer") < SHARE * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = counts.where("width = 0").select("lang", "n")
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                         "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: the first 2000 collocations of each language."""
    return collocations(read(spark, sf_dir, "documents", "text", "lang"))


ORACLE = """
WITH p AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
      FROM w, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
         FROM c, (SELECT unnest([1, 2]) AS j) WHERE j < k),
s AS (SELECT cuts.lang, cuts.phrase, a, j, l.f AS l, r.f AS r,
             (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
      FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x AND l.k = j
      JOIN f r ON r.lang = cuts.lang AND r.phrase = y AND r.k = cuts.k - j),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s),
i AS (SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3 UNION ALL
        SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
q AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase
      WHERE o = 1 AND (longer IS NULL OR 100 * longer < 50 * a))
SELECT q.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM q JOIN n ON n.lang = q.lang WHERE rank <= 2000
"""
