"""Operator 5: removal of repeated passages, found with Aho-Corasick automata.

A passage repeats where a window of 13 words also starts in a document with a smaller id.

1. Documents are dealt into blocks of a few MB.  A block names each window by an anchor,
   the smallest hash among the five-word phrases in it: equal windows have equal anchors,
   and neighbouring windows mostly share theirs, so about a fifth of the positions is sent.
2. Shards of anchors report which occur in more than one document.
3. Blocks send the windows behind those anchors, once each (96-bit hashes and the smallest
   doc_id in the block).  Shards confirm the recurring ones and tell the blocks that hold
   more than the first occurrence which document owns them, the one with the smallest id.
4. Each block joins confirmed windows with one owner into passages, compiles them into an
   automaton of its own and streams all its documents through it; every occurrence in a
   document other than the owner is removed.

What a shard receives of an anchor or a window grows with the blocks, not with the
documents that hold it; a block holds only its own documents.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import partitions, read

WINDOW, ANCHOR = 13, 5
BLOCK_BYTES = 6 << 20
NO_ID = np.iinfo(np.int64).max  # a null doc_id comes after all others


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(n: int, seed: int) -> np.ndarray:
    """Odd pseudo-random multipliers."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                  + np.uint64(seed)) | np.uint64(1)


class Words:
    """The words of a column of texts in a row: numbers into their dictionary, the text of
    each, and the two halves of a 128-bit hash."""

    def __init__(self, texts: pa.ChunkedArray):
        texts = texts.combine_chunks()
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        self.dictionary = coded.dictionary.cast(pa.binary())
        words = self.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        text = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
        real = codes != (words.index(b"") if b"" in words else -1)  # from blanks at the ends
        self.codes, self.text = codes[real], text[real]
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
        self.hashes = [np.ascontiguousarray(digests[:, k])[self.codes] for k in (0, 1)]

    def runs(self, width: int, which: int) -> np.ndarray:
        """Hash of the ``width`` words from each word on (over text borders as well)."""
        own, n = self.hashes[which], max(0, len(self.codes) - width + 1)
        total = np.zeros(n, np.uint64)
        for k, f in enumerate(_factors(width, 1000 * which + width)):
            total += own[k:k + n] * f
        return _mixed(total)

    def windows(self) -> np.ndarray:
        """Words at which a window of one text starts."""
        last = len(self.codes) - WINDOW + 1
        return np.flatnonzero(self.text[:last] == self.text[WINDOW - 1:]) if last > 0 else np.zeros(0, np.int64)

    def anchors(self, windows: np.ndarray) -> np.ndarray:
        phrase = self.runs(ANCHOR, 0)
        low = phrase[windows]
        for k in range(1, WINDOW - ANCHOR + 1):
            low = np.minimum(low, phrase[windows + k])
        return low


def _ids(column) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy()


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, smallest value, largest value)."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if not len(at):
        return keys, values, values
    return keys[at], np.minimum.reduceat(values, at), np.maximum.reduceat(values, at)


def _sent(block: int, shard: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row per shard that gets anything, the values packed as bytes; ``shard`` is sorted."""
    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(shard))
    out = {"shard": pa.array(shard[at].astype(np.int32)), "block": pa.array(np.full(len(at), block, np.int32))}
    for name, values in columns.items():
        out[name] = pa.array([_packed(values[a:b]) for a, b in zip(at, ends)], pa.binary())
    return pa.table(out)


def _packed(values: np.ndarray) -> bytes:
    """The values' bytes after one that names their kind; ids take four bytes where they fit."""
    if values.dtype == np.int64 and len(values) and values.min() >= 0 and values.max() < 1 << 32:
        values = values.astype(np.uint32)
    return values.dtype.char.encode() + values.tobytes()


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)  # sorted as the hashes are


def _unpacked(table: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows in a row, the row of each)."""
    parts = [np.frombuffer(x, chr(x[0]), offset=1).astype(kind) for x in table.column(name).to_pylist()]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), row


def _cut(values: np.ndarray, row: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """The chosen values of each row, packed."""
    ends = np.searchsorted(row, np.arange(rows + 1))
    return pa.array([_packed(values[a:b][chosen[a:b]]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())


def _send_anchors(shards: int):
    def send(table):
        words = Words(table.column("text"))
        windows = words.windows()
        ids = _ids(table.column("doc_id"))[words.text[windows]]
        keys, low, high = _grouped(words.anchors(windows), ids)
        return _sent(table.column("block")[0].as_py(), _shard_of(keys, shards),
                     {"keys": keys, "low": low, "many": low != high})
    return send


def _recurring(table):
    """Per block: the anchors of this shard that more than one document has."""
    keys, row = _unpacked(table, "keys", np.uint64)
    low, _ = _unpacked(table, "low", np.int64)
    many, _ = _unpacked(table, "many", np.bool_)
    order = np.argsort(keys)
    at = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
    size = np.diff(np.append(at, len(keys)))
    most, least = np.maximum.reduceat(low[order], at), np.minimum.reduceat(low[order], at)
    recurs = np.empty(len(keys), bool)
    recurs[order] = np.repeat((most != least) | np.logical_or.reduceat(many[order], at), size)
    return pa.table({"block": table.column("block"), "keys": _cut(keys, row, recurs, table.num_rows)})


def _send_windows(shards: int):
    def send(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()),
                             **{n: pa.array([], pa.binary()) for n in ("h1", "h2", "low", "many")}})
        words = Words(left.column("text"))
        windows = words.windows()
        hot = np.sort(_unpacked(right, "keys", np.uint64)[0])
        windows = windows[_member(words.anchors(windows), hot)]
        h1, h2 = words.runs(WINDOW, 0)[windows], _short(words.runs(WINDOW, 1)[windows])
        ids = _ids(left.column("doc_id"))[words.text[windows]]
        order = np.lexsort((ids, h2, h1))
        h1, h2, ids = h1[order], h2[order], ids[order]
        at = np.flatnonzero(_changes(h1, h2))
        ends = np.append(at[1:], len(ids)) - 1
        h1, h2, low, high = h1[at], h2[at], ids[at], ids[ends[:len(at)]]  # ids ascend per window
        return _sent(left.column("block")[0].as_py(), _shard_of(h1, shards),
                     {"h1": h1, "h2": h2, "low": low, "many": low != high})
    return send


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _short(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(32)).astype(np.uint32)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where one of the sorted columns has a new value."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _owners(table):
    """Per block: its windows of this shard that start in documents other than the one with
    the smallest doc_id, and that doc_id."""
    h1, row = _unpacked(table, "h1", np.uint64)
    h2, low = _unpacked(table, "h2", np.uint32)[0], _unpacked(table, "low", np.int64)[0]
    many = _unpacked(table, "many", np.bool_)[0]
    order = np.lexsort((h2, h1))
    at = np.flatnonzero(_changes(h1[order], h2[order]))
    owner = np.empty(len(h1), np.int64)
    owner[order] = np.repeat(np.minimum.reduceat(low[order], at), np.diff(np.append(at, len(h1))))
    repeats = many | (low != owner)
    cut = lambda x: _cut(x, row, repeats, table.num_rows)
    return pa.table({"block": table.column("block"), "h1": cut(h1), "h2": cut(h2), "owner": cut(owner)})


def _passages(words: Words, ids: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int]]:
    """(first word, words, owner): neighbouring windows of one text with one smaller owner."""
    wanted = owner < ids[words.text[:len(owner)]]
    at = np.flatnonzero(wanted)
    if not len(at):
        return []
    split = (np.diff(at) > 1) | (np.diff(owner[at]) != 0) | (np.diff(words.text[at]) != 0)
    begin = at[np.append(True, split)]
    end = at[np.append(split, True)]
    return list(zip(begin.tolist(), (end - begin + WINDOW).tolist(), owner[begin].tolist()))


def _covered(words: Words, ids: np.ndarray, passages: list[tuple[int, int, int]]) -> np.ndarray:
    """Words inside an occurrence of a passage in a document with a larger id than its owner."""
    covered = np.zeros(len(words.codes) + 1, np.int64)
    if not passages:
        return covered[:-1] > 0
    # a word is its number in the block's dictionary, written with a few signs, 64 for each
    # digit of its own: so a match can only start and end with a word
    signs = max(1, -(-len(words.dictionary).bit_length() // 6))
    coded = np.empty((len(words.codes), signs), np.uint8)
    for k in range(signs):
        coded[:, k] = (words.codes >> (6 * (signs - 1 - k)) & 63) + 64 * k
    coded = coded.tobytes().decode("latin-1")
    automaton = ahocorasick.Automaton()
    smallest: dict[str, tuple[int, int]] = {}
    for begin, n, owner in passages:
        key = coded[signs * begin:signs * (begin + n)]
        smallest[key] = (n, min(owner, smallest.get(key, (n, owner))[1]))
    for key, value in smallest.items():
        automaton.add_word(key, value)
    automaton.make_automaton()
    for k, doc in enumerate(ids.tolist()):
        begin, end = int(words.first[k]), int(words.first[k + 1])
        for at, (n, owner) in automaton.iter(coded[signs * begin:signs * end]):
            if owner < doc:
                last = begin + (at + 1) // signs
                covered[last - n] += 1
                covered[last] -= 1
    return np.cumsum(covered[:-1]) > 0


def _remove(left, right):
    """Streams the block's documents through the automaton of its passages."""
    if not left.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                         "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
    words = Words(left.column("text"))
    ids = _ids(left.column("doc_id"))
    gone = np.zeros(len(words.codes), bool)
    if right.num_rows:
        h1, h2, owner = (_unpacked(right, n, k)[0] for n, k in
                         (("h1", np.uint64), ("h2", np.uint32), ("owner", np.int64)))
        order = np.lexsort((h2, h1))
        h1, h2, owner = h1[order], h2[order], owner[order]
        windows, whose = words.windows(), np.full(len(words.codes), NO_ID)
        a, b = words.runs(WINDOW, 0)[windows], _short(words.runs(WINDOW, 1)[windows])
        maybe = np.flatnonzero(_member(a, h1))
        windows, a, b = windows[maybe], a[maybe], b[maybe]
        place = np.searchsorted(h1, a)
        while len(a):  # equal first halves are next to each other
            here = np.minimum(place, len(h1) - 1)
            later = (place < len(h1)) & (h1[here] == a) & (h2[here] != b)
            if not later.any():
                same = (place < len(h1)) & (h1[here] == a)
                whose[windows[same]] = owner[here[same]]
                break
            place = place + later
        gone = _covered(words, ids, _passages(words, ids, whose))
    kept = ~gone
    rest = np.searchsorted(words.text[kept], np.arange(left.num_rows + 1))
    lists = pa.ListArray.from_arrays(pa.array(rest, pa.int32()),
                                     words.dictionary.take(pa.array(words.codes[kept])))
    joined = pc.binary_join(lists, pa.scalar(b" ", pa.binary())).cast(pa.string())
    n_words = np.diff(words.first)
    return pa.table({"doc_id": left.column("doc_id"), "n_words": pa.array(n_words),
                     "n_removed": pa.array(n_words - np.diff(rest)), "kept": joined})


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, n_words, n_removed, kept (the words that stay,
    joined by blanks), one row per input row.

    Words are runs between ASCII white space.  Null text has none.  A null doc_id counts as
    larger than any other; rows with one doc_id are one document to each other and remove
    nothing there.  Texts of any length are taken whole, other columns are ignored.  An empty
    table gives an empty result."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text") + 1).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(
        F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block")) \
        .repartition(max(partitions(spark), min(blocks, 4 * partitions(spark))), "block")
    sent = dealt.groupBy("block").applyInArrow(
        _send_anchors(blocks), "shard int, block int, keys binary, low binary, many binary")
    hot = sent.groupBy("shard").applyInArrow(_recurring, "block int, keys binary")
    seen = dealt.groupBy("block").cogroup(hot.groupBy("block")).applyInArrow(
        _send_windows(blocks), "shard int, block int, h1 binary, h2 binary, low binary, many binary")
    owned = seen.groupBy("shard").applyInArrow(_owners, "block int, h1 binary, h2 binary, owner binary")
    return dealt.groupBy("block").cogroup(owned.groupBy("block")).applyInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: what stays of every document."""
    out = remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, w[i:i + 12] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
o AS (SELECT g, min(doc_id) AS owner FROM g GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN o USING (g) WHERE owner < doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t
         FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d)
         ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
