"""Operator 2: best-fit packing with swap-based local search.

Documents are tokenized where they lie and cut into pieces of at most one sequence.
Full pieces are sequences of their own.  The other pieces are dealt by a hash of the row
into groups of bounded size; each group is packed best-fit (longest first), and then
local search empties its emptiest sequences: a piece moves to a fuller sequence, or one
or two pieces are exchanged for one of a fuller sequence, whenever that raises the sum of
squared fills.  It ends when the group uses as few sequences as its tokens can fill, or
no exchange is left.  Sequences that stay well underfull and have room for the smallest such
piece are opened again and packed with those of other groups, round after round, as long
as their tokens would fill fewer sequences and a round makes them fewer.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.llm.common import read, release_memory, unused, written

SEQUENCE_TOKENS, END_ID = 4096, 1
TOKENIZER = "word_bpe_49k.json"
# Stands between words that are encoded together.
MARK = "\x01"
# Pieces in one packing group; text tokenized at once.
GROUP_PIECES, CHUNK_BYTES = 20_000, 8 << 20
# From this fill on a sequence is not opened again.
FULL = 0.98
# Words of letters that normalization leaves alone, perhaps with one stop.
_SIMPLE = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([.,]?)")


class WordTokens:
    """Token ids of texts, by white-space separated words (A-Z lower-cased, as the tokenizer
    does); each distinct word of a chunk is encoded once.

    The tokenizer normalizes and splits inside such words alone, so a text's ids are those
    of its words in a row.  Words of plain letters need no normalization and no splitting:
    a bare copy of the tokenizer encodes them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.mark, = self.tokenizer.encode(MARK, add_special_tokens=False).ids

    def _runs(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words`` in a row and their number per word; words go together, a mark
        after each."""
        parts = [np.zeros(0, np.uint32)]
        for k in range(0, len(words), 4000):
            texts = [f" {MARK} ".join([*words[j:j + 200], ""])
                     for j in range(k, min(k + 4000, len(words)), 200)]
            parts += [np.array(e.ids, np.uint32) for e in
                      tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(parts)
        marks = ids == self.mark
        return ids[~marks], np.diff(np.flatnonzero(marks), prepend=-1) - 1

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, place, number) of each word's ids."""
        cores: dict[str, int] = {}
        core, stop, odd = np.empty(len(words), np.int64), np.zeros(len(words), np.int64), []
        stops = {"": 0, ".": 1, ",": 2}
        for k, w in enumerate(words):
            if m := _SIMPLE.fullmatch(w):
                core[k], stop[k] = cores.setdefault(m[1], len(cores)), stops[m[2]]
            else:
                odd.append(k)
        marked = [k for k in odd if MARK in words[k]]
        odd = [k for k in odd if MARK not in words[k]]
        endings = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in (".", ",")]
        ids, number = self._runs(self.bare, list(cores))
        tail = np.array([e[0] for e in endings], np.uint32)
        simple = np.ones(len(words), bool)
        simple[odd + marked] = False
        at, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at[simple] = (np.cumsum(number) - number)[core[simple]]
        size[simple] = number[core[simple]]
        full, base = [ids], len(ids)
        for value in (1, 2):
            own = np.flatnonzero(simple & (stop == value))
            total = int(size[own].sum()) + len(own)
            out = np.empty(total, np.uint32)
            ends = np.cumsum(size[own] + 1)
            out[ends - 1] = tail[value - 1]
            inner = np.ones(total, bool)
            inner[ends - 1] = False
            out[inner] = _gather(ids, at[own], size[own])
            size[own] += 1
            at[own] = base + ends - size[own]
            full.append(out)
            base += total
        more, number = self._runs(self.tokenizer, [words[k] for k in odd])
        at[odd], size[odd] = base + np.cumsum(number) - number, number
        full.append(more)
        base += len(more)
        for k in marked:
            own = np.array(self.tokenizer.encode(words[k], add_special_tokens=False).ids, np.uint32)
            at[k], size[k] = base, len(own)
            full.append(own)
            base += len(own)
        return np.concatenate(full), at, size

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        coded = split.flatten().dictionary_encode()
        ids, at, size = self._encode_words(coded.dictionary.to_pylist())
        word, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
        return [_gather(ids, at[k], size[k]) for k in
                (word[a:b] for a, b in zip(ends[:-1], ends[1:]))]


def _gather(ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``ids[at:at + size]`` in a row."""
    shift = at - np.cumsum(size) + size
    return ids[np.repeat(shift, size) + np.arange(size.sum())]


def token_pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE_TOKENS,
                 end_id: int = END_ID, with_ids: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: doc_id, piece, start, length, ids_crc32,
    and the token ids themselves with ``with_ids``.  A document is its ids and then
    ``end_id``; null or empty text is ``end_id`` alone, a long one is cut into several pieces.
    Repeated rows and null ids give pieces of their own, other columns are ignored, an empty
    table gives none.  ``chunk_bytes``: text tokenized at once; less of it holds less memory and
    meets the same words more often."""
    id_field = docs.schema["doc_id"]
    schema = T.StructType([id_field, T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())]
                          + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))

    def pieces(it):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        words = WordTokens(tokenizer_path)
        end = np.array([end_id], "<u4")
        for batch in it:
            texts, ids, lo = batch.column(1), batch.column(0), 0
            sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
            while lo < len(texts):
                done = sizes[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(sizes, done + chunk_bytes)))
                rows: list[tuple] = []
                for k, own in enumerate(words.encode(texts.slice(lo, hi - lo)), lo):
                    own = np.concatenate([own, end]).astype("<u4")
                    for p, at in enumerate(range(0, len(own), sequence)):
                        part = own[at:at + sequence]
                        rows.append((k, p, at, len(part), zlib.crc32(part.tobytes()),
                                     part.astype(np.int32) if with_ids else None))
                cols = list(zip(*rows))
                arrays = [ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                          *(pa.array(c, pa.int64()) for c in cols[2:5])]
                if with_ids:
                    arrays.append(pa.array(cols[5], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])
                lo = hi
        del words
        release_memory()
    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each length, longest first, into the fullest bin that has room."""
    bins = np.empty(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, 0  # bit f: some bin has f free
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        fits = mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask &= ~(1 << free)
        else:
            free, b, used = capacity, used, used + 1
        bins[k] = b
        by_free[free - n].append(b)
        mask |= 1 << (free - n)
    return bins


def _best_exchange(give: np.ndarray, lengths: np.ndarray, room: np.ndarray) -> tuple[int, int, int]:
    """The exchange of one of ``give`` (sorted token counts) for one of ``lengths`` that
    gains most tokens within its ``room``: (gain, place in give, place in lengths)."""
    k = np.searchsorted(give, lengths + room, "right") - 1
    gain = np.where(k >= 0, give[np.maximum(k, 0)] - lengths, 0)
    j = int(gain.argmax())
    return int(gain[j]), int(k[j]), j


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Empties underfull bins by moves, one-for-one and two-for-one exchanges with fuller
    bins, each of which raises the sum of squared fills, until the bins number as few as
    the tokens can fill or no exchange is left: bins that had none are looked at again as long
    as others change."""
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    least, used = -(-int(lengths.sum()) // capacity), int((fill > 0).sum())
    stuck, changed = np.zeros(len(fill), bool), False
    while used > least:
        candidates = np.flatnonzero((fill > 0) & (fill < capacity) & ~stuck)
        if not len(candidates):
            if not changed:
                break
            stuck[:], changed = False, False
            continue
        source = candidates[fill[candidates].argmin()]
        own = np.flatnonzero(bins == source)
        own = own[np.argsort(lengths[own], kind="stable")]
        fuller = (fill < capacity) & (fill >= fill[source])
        fuller[source] = False
        out, back, target = None, [], None
        targets = np.flatnonzero(fuller & (fill + lengths[own[0]] <= capacity))
        if len(targets):  # a move: the longest piece that fits the fullest such bin
            target = targets[fill[targets].argmax()]
            fits = np.searchsorted(lengths[own], capacity - fill[target], "right") - 1
            out = [own[fits]]
        else:
            other = np.flatnonzero(fuller[bins])
            if len(other):
                room = capacity - fill[bins[other]]
                gain, k, j = _best_exchange(lengths[own], lengths[other], room)
                if gain > 0:
                    out, back = [own[k]], [other[j]]
                a, b = np.triu_indices(len(own), 1)
                if len(a):
                    total = lengths[own[a]] + lengths[own[b]]
                    by = np.argsort(total, kind="stable")
                    more, k, j = _best_exchange(total[by], lengths[other], room)
                    if more > max(gain, 0):
                        out, back = [own[a[by[k]]], own[b[by[k]]]], [other[j]]
                if back:
                    target = bins[back[0]]
        if out is None:
            stuck[source] = True
            continue
        changed = True
        shift = int(lengths[out].sum() - lengths[back].sum()) if back else int(lengths[out].sum())
        bins[out] = target
        bins[back] = source
        fill[target] += shift
        fill[source] -= shift
        used -= int(fill[source] == 0)
    return bins


def _packer(sequence: int, base: int, groups: int):
    """Packs the pieces of one group; its sequences are numbered ``base + group + groups * k``."""
    def packed(table):
        table = table.sort_by("key")
        lengths = table.column("length").to_numpy().astype(np.int64)
        if (lengths <= 0).any() or (lengths > sequence).any():
            raise ValueError("a piece must have 1 to `sequence` tokens")
        bins = local_search(lengths, best_fit(lengths, sequence), sequence)
        order = np.lexsort((np.arange(len(bins)), bins))
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.flatnonzero(np.append(True, np.diff(bins[order]) > 0))
        offset = np.empty(len(bins), np.int64)
        offset[order] = before - np.repeat(before[first], np.diff(np.append(first, len(bins))))
        room = sequence - np.bincount(bins, weights=lengths).astype(np.int64)
        group = table.column("group")[0].as_py()
        return pa.table({"key": table.column("key"), "length": table.column("length"),
                         "sequence_id": base + group + groups * bins, "offset": offset, "room": room[bins]})
    return packed


def pack(pieces: DataFrame, sequence: int = SEQUENCE_TOKENS,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces(length, ...)`` with ``sequence_id`` and the gapless ``offset`` of each piece.

    Every row is packed, repeated rows each for themselves; null or negative lengths are an
    error.  Same input layout, same result.  Columns named sequence_id or offset are
    replaced, all others stay, whatever their names; an empty frame gives an empty one."""
    pieces = pieces.drop("sequence_id", "offset")
    columns, key = pieces.columns, unused("_piece_key", pieces.columns)
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType())])
    state = written(pieces.withColumn(key, F.monotonically_increasing_id()), "pieces")
    full = state.where(F.col("length") == sequence) \
        .select(*columns, (-1 - F.col(key)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = state.where((F.col("length") != sequence) | F.col("length").isNull())
    done, base, before = [], 0, None
    todo = rest.select(F.col(key).alias("key"), F.col("length").cast("long").alias("length"))
    n = todo.count()
    while True:
        groups = max(1, -(-n // group_pieces))
        dealt = todo.withColumn("group", F.pmod(F.xxhash64("key", F.lit(base)), F.lit(groups)))
        placed = written(dealt.groupBy("group").applyInArrow(
            _packer(sequence, base, groups), "key long, length long, sequence_id long, offset long, room long"), "packed")
        underfull = F.col("room") > (1 - FULL) * sequence
        told = placed.agg(F.sum((F.col("offset") == 0).cast("long")).alias("used"),
                          F.min(F.when(underfull, F.col("length"))).alias("smallest")).first()
        reopened = underfull & (F.col("room") >= F.lit(told["smallest"]))
        left = placed.where(reopened).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens"),
                                          F.sum((F.col("offset") == 0).cast("long")).alias("used")).first()
        # one group has searched all there is; else another round must be able to save a sequence
        # and the last one must have saved one
        if groups == 1 or not left["n"] or left["used"] <= -(-left["tokens"] // sequence) \
                or (before is not None and told["used"] >= before):
            done.append(placed)
            break
        done.append(placed.where(~reopened))
        base += groups * (n + 1)
        todo, n, before = placed.where(reopened).select("key", "length"), left["n"], left["used"]
    places = done[0]
    for more in done[1:]:
        places = places.union(more)
    joined = rest.join(places.select(F.col("key").alias(key), "sequence_id", "offset"), key) \
        .select(*columns, "sequence_id", "offset")
    return full.union(joined).select(*[F.col(f"`{f.name}`") for f in out])


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces that carry ``ids`` -> one row per sequence: its ids and documents."""
    part = F.struct("offset", "doc_id", "ids")
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pieces of ``docs(doc_id, text, ...)`` with their places."""
    import public_tokenizers
    return pack(token_pieces(docs, tokenizer_path or public_tokenizers.path(TOKENIZER), chunk_bytes=chunk_bytes))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document packed into sequences of 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents", "doc_id", "text"))
