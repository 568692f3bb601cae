"""Operator 6: benchmark decontamination with suffix arrays of the training text.

The documents are read once, in shards of a few MB (whole documents, no shuffle).  Each
shard's words become a suffix array: word numbers sorted by prefix doubling, only groups
that are still tied being sorted again, down to the length of the longest benchmark
item, beyond which no search can tell suffixes apart.  Words that occur in no benchmark
item end a suffix.  Every suffix of every item is binary-searched in every shard: its two
neighbours give its longest verbatim match and the place of that, and the range of
suffixes that start with one of its windows gives all occurrences of the window.

The benchmark is the query set.  It is dealt into blocks of a few MB, measured before;
each block is broadcast and searched against all documents, and results are merged.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.llm.common import raw_texts, read, release_memory, written

WINDOW = 13
# Text of one suffix array, and benchmark text that is broadcast at once.
SHARD_BYTES, BLOCK_BYTES = 3 << 20, 4 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_STEP = 8
STATS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()), T.StructField("longest_item", T.StringType()),
    T.StructField("longest_item_word", T.LongType()), T.StructField("longest_doc_word", T.LongType())])


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of digits, letters and non-ASCII bytes."""
    return _WORD.findall(text.lower()) if text else []


@dataclass
class ItemBlock:
    """Words, suffixes and windows of some benchmark items."""

    names: list[str | None]
    vocabulary: dict[bytes, int]
    ids: np.ndarray          # item words, each item closed by -1
    suffix: np.ndarray       # places in ids where a suffix starts
    item: np.ndarray         # its item
    window: np.ndarray       # words of the window that starts there, 0: none
    first: np.ndarray        # where the suffix's item starts in ids
    depth: int

    @classmethod
    def build(cls, rows: list[tuple[str | None, bytes | None]], window: int) -> ItemBlock:
        vocabulary: dict[bytes, int] = {}
        ids, suffix, item, windows, first, depth = [], [], [], [], [], 1
        for k, (_, text) in enumerate(rows):
            own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            n, at = len(own), len(ids)
            width = min(window, n)
            suffix += range(at, at + n)
            item += [k] * n
            first += [at] * n
            windows += [width] * (n - width + 1) + [0] * (width - 1) if n else []
            ids += own + [-1]
            depth = max(depth, n)
        as_array = [np.array(x, np.int64) for x in (suffix, item, windows, first)]
        return cls([r[0] for r in rows], vocabulary, np.array(ids + [-1] * _STEP, np.int64),
                   as_array[0], as_array[1], as_array[2], as_array[3], depth)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``ids`` that hold a number above 0, sorted by the ``depth`` numbers that
    start there (a 0 ends a suffix).  ``ids`` ends with 0."""
    places = np.flatnonzero(ids)
    sa = places[np.argsort(ids[places], kind="stable")]
    rank = np.zeros(len(ids), np.int64)
    tied = np.arange(len(sa))
    keys, width = ids[sa], 1
    while len(tied):
        new = np.empty(len(tied), bool)
        new[0], new[1:] = True, keys[1:] != keys[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(tied)))
        rank[sa[tied]] = np.repeat(tied[starts] + 1, sizes)
        more = np.repeat(sizes > 1, sizes)
        if width >= depth:
            break
        tied = tied[more]
        place = sa[tied]
        after = place + width
        follow = np.where(after < len(ids), rank[np.minimum(after, len(ids) - 1)], 0)
        keys = rank[place] << 32 | follow
        order = np.argsort(keys)
        keys, sa[tied] = keys[order], place[order]
        width *= 2
        if len(tied):
            ended = (keys & 0xFFFFFFFF) == 0  # nothing follows: equal for good
            if ended.any():
                group = np.cumsum(np.append(True, keys[1:] != keys[:-1]))
                first_of = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                rank[sa[tied[ended]]] = tied[first_of][group[ended] - 1] + 1
                tied, keys = tied[~ended], keys[~ended]
    return sa


def _match(block: ItemBlock, ids: np.ndarray, q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Number of equal words from places ``q`` of the items and ``d`` of the shard on."""
    n, active, step = np.zeros(len(q), np.int64), np.arange(len(q)), np.arange(_STEP)
    while len(active):
        same = block.ids[(q[active] + n[active])[:, None] + step] \
            == ids[(d[active] + n[active])[:, None] + step]
        whole = same.all(axis=1)
        n[active] += np.where(whole, _STEP, same.argmin(axis=1))
        active = active[whole]
    return n


def _bound(block: ItemBlock, ids, sa, q, width=None, upper=False) -> np.ndarray:
    """Per suffix ``q``: how many suffixes of the shard sort before it; with ``width`` only
    its first words count, and ``upper`` also counts those that start with them."""
    low, high = np.zeros(len(q), np.int64), np.full(len(q), len(sa))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        d = sa[mid]
        n = _match(block, ids, q[open_], d)
        before = ids[d + n] < block.ids[q[open_] + n]
        if width is not None:
            starts = n >= width[open_]
            before = (before & ~starts) | (starts & upper)
        low[open_[before]] = mid[before] + 1
        high[open_[~before]] = mid[~before]


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def search_shard(texts: list[bytes | None], block: ItemBlock) -> list[dict]:
    """Hits of the block's items in each text (see ``STATS``)."""
    get, zero = block.vocabulary.get, itertools.repeat(0)
    parts, starts, at = [], [], 0
    for text in texts:
        own = words_of(text)
        starts.append(at)
        parts.append(np.fromiter(map(get, own, zero), np.int64, len(own)))
        parts.append(np.zeros(1, np.int64))
        at += len(own) + 1
    ids = np.concatenate([*parts, np.zeros(_STEP + 1, np.int64)])
    first, ends = np.array(starts), np.array([*starts[1:], at]) - 1
    out = [{"n_words": int(b - a), "n_hit": 0, "hit_spans": [], "items": [], "longest": 0,
            "longest_item": None, "longest_item_word": None, "longest_doc_word": None}
           for a, b in zip(starts, ends)]
    sa = suffix_array(ids, block.depth)
    if not len(sa) or not len(block.suffix):
        return out
    place = _bound(block, ids, sa, block.suffix)
    left, right = sa[np.maximum(place - 1, 0)], sa[np.minimum(place, len(sa) - 1)]
    n_left, n_right = (_match(block, ids, block.suffix, x) for x in (left, right))
    longest = np.maximum(n_left, n_right)
    where = np.where(n_left > n_right, left, right)
    docs = np.searchsorted(first, where, "right") - 1
    for j in np.argsort(longest, kind="stable"):  # the last one written is the longest
        if longest[j]:
            k = docs[j]
            out[k].update(longest=int(longest[j]), longest_item=block.names[block.item[j]],
                          longest_item_word=int(block.suffix[j] - block.first[j]),
                          longest_doc_word=int(where[j] - first[k]))
    hit = np.flatnonzero((block.window > 0) & (longest >= block.window))
    if not len(hit):
        return out
    width = block.window[hit]
    low = _bound(block, ids, sa, block.suffix[hit], width)
    high = _bound(block, ids, sa, block.suffix[hit], width, upper=True)
    items, owners = {}, {}
    for lo, hi, w, j in zip(low.tolist(), high.tolist(), width.tolist(), hit):
        owners.setdefault((lo, hi, w), set()).add(block.names[block.item[j]])
    cover = np.zeros(len(ids) + 1, np.int64)
    for (lo, hi, w), names in owners.items():
        found = sa[lo:hi]
        np.add.at(cover, found, 1)
        np.add.at(cover, found + w, -1)
        for k in np.unique(np.searchsorted(first, found, "right") - 1).tolist():
            items.setdefault(k, set()).update(names)
    covered = np.cumsum(cover) > 0
    for k, names in items.items():
        inside = np.diff(covered[starts[k]:ends[k]].astype(np.int8), prepend=0, append=0)
        out[k].update(hit_spans=np.flatnonzero(inside).tolist(), n_hit=int(inside[:-1].cumsum().sum()),
                      items=sorted(x for x in names if x is not None))
    return out


def _joined(a: dict, b: dict) -> dict:
    """Results of two item blocks for one document."""
    spans = _merged([*zip(a["hit_spans"][::2], a["hit_spans"][1::2]),
                     *zip(b["hit_spans"][::2], b["hit_spans"][1::2])])
    return (a if a["longest"] >= b["longest"] else b) | {
        "hit_spans": spans, "n_hit": sum(spans[1::2]) - sum(spans[::2]),
        "items": sorted({*a["items"], *b["items"]})}


def item_blocks(items: DataFrame, window: int, block_bytes: int):
    """The benchmark in blocks of about ``block_bytes``, one at a time."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) \
            .select(F.col("item_id").cast("string"), F.col("text").cast("binary")).collect()
        yield ItemBlock.build([(r[0], bytes(r[1]) if r[1] is not None else None) for r in rows], window), \
            k + 1 == blocks


def scan_benchmark(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                   out: str = "decontamination", keep: list[str] | None = None,
                   shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs(text, ...)`` with a struct column ``out`` (see ``STATS``) about the windows of
    ``items(item_id, text)`` found in each text: its words, the words inside any occurrence
    of a window, their spans (word from, word to, ...), the ids of the items, and the
    longest verbatim match that a benchmark suffix has in its shard, with both places.

    A window is ``window`` consecutive item words, or a shorter item as a whole.  Null and
    empty texts have no words; an empty benchmark hits nothing; an item without an id hits
    but isn't listed.  Repeated rows are searched each for themselves, texts of any length as a
    whole.  ``keep``: the columns of ``docs`` to return (all without it); one named ``out`` is
    replaced.  Of equally long matches the last suffix's is reported."""
    keep = keep or docs.columns
    current = docs if "text" in keep else docs.select(*keep, "text")
    for block, last in item_blocks(items, window, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(dict(vars(block)))
        columns = current.columns
        returned = [c for c in columns if c in keep and c != out] if last \
            else [c for c in columns if c != out]
        schema = T.StructType([current.schema[c] for c in returned] + [T.StructField(out, STATS)])
        stats_type = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                                ("hit_spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
                                ("longest", pa.int64()), ("longest_item", pa.string()),
                                ("longest_item_word", pa.int64()), ("longest_doc_word", pa.int64())])

        def shards(it, shared=shared, columns=columns, returned=returned, stats_type=stats_type):
            held, texts, size = [], [], 0
            block = ItemBlock(**shared.value)

            def flush():
                stats = search_shard(texts, block)
                table = pa.Table.from_batches(held)
                if out in columns:
                    stats = [_joined(a, b) for a, b in zip(table.column(out).to_pylist(), stats)]
                done = table.select(returned).append_column(out, pa.array(stats, stats_type))
                return done.to_batches(max_chunksize=1000)

            for batch in it:
                own = raw_texts(batch.column(columns.index("text")))
                for a in range(0, len(own), 500):
                    held.append(batch.slice(a, 500))
                    texts += own[a:a + 500]
                    size += sum(len(t or b"") for t in own[a:a + 500])
                    if size >= shard_bytes:
                        yield from flush()
                        held, texts, size = [], [], 0
            if held:
                yield from flush()
            held, texts, batch, own, block = [], [], None, None, None
            release_memory()

        current = current.mapInArrow(shards, schema)
        if not last:
            current = written(current, "decontam")
    return current


def contaminated(stats: str = "decontamination"):
    """The contamination rule: any hit, and at least a twentieth of the words hit."""
    s = F.col(stats)
    return (s["n_hit"] > 0) & (20 * s["n_hit"] >= s["n_words"])


def query(spark, sf_dir: str) -> DataFrame:
    """op6: what each document holds of the benchmark."""
    found = scan_benchmark(read(spark, sf_dir, "documents", "doc_id", "text"),
                           read(spark, sf_dir, "benchmark", "item_id", "text"), keep=["doc_id"])
    s = F.col("decontamination")
    return found.select("doc_id", s["n_words"].alias("n_words"), s["n_hit"].alias("n_hit"),
                        F.size(s["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(s["items"], ","), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"))


ORACLE = """
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, w[i:i + least(13, len(w)) - 1] AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
grams AS (SELECT DISTINCT n, g FROM win),
occ AS (SELECT d.doc_id, d.i, d.n, d.g
        FROM (SELECT doc_id, n, i, w[i:i + n - 1] AS g
              FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                    FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)) d
        JOIN grams USING (n, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
         (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids
        FROM occ JOIN win USING (n, g) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""
