"""Operator 11: spelling variants of words, found with blocked Gram matrices.

1. Tasks count the words of their texts; the counts meet in one aggregate.
2. A word's letters fall into ``CLASSES`` classes; its letter counts per class (they add up
   to its length) name its block.  One edit moves a word to its own block, to one of the
   same length with a letter more in one class and less in another, or to one of the
   adjacent length: every block is met with those neighbours and no others.
3. A task takes the letter counts of a block and of its neighbours as matrices; one NumPy
   product gives the squared distances of all pairs.  Two words that differ by one edit are
   at most two apart; the pairs that are pass on to an exact comparison of their letters.
4. Each task adds up the near words of a word and keeps the most frequent; the partial
   results meet in one aggregate.  Roots are found by doubling the reach of the forms.

Blocks of more than ``CHUNK`` words are cut by word hashes and met piece by piece, so that a
task's matrices are bounded however many words one block holds.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import read, release_memory, written
from labelforge.operators.sizing import sized_join

LETTERS_AT_LEAST, LEAST_COUNT, FORM_RATIO, ERRORS = 6, 5, 5, 199
CLASSES = 6
CHUNK = 1 << 15
# Rows a task compares in one call, and entries of one product.
TASK_ROWS, TILE = 300_000, 1 << 21
# Distinct words a task counts before it hands them on; letters it looks at in one go.
HELD_WORDS, STRETCH = 200_000, 1 << 20

# What a row is in a meeting of a block (or a chunk of it) with others.
HOME, HOME_ONCE, OWN, ALIKE, LONGER = range(5)

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LETTERS_AT_LEAST)
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = bytes.maketrans(_UPPER.encode(), _UPPER.lower().encode())


def runs(text: str):
    """Lists of the letter runs of a text that can become words, a stretch at a time."""
    at = 0
    while at < len(text):
        stop = _BREAK.search(text, min(at + STRETCH, len(text)))
        end = stop.start() if stop else len(text)
        yield _RUN.findall(text, at, end)
        at = end


def word_of(run: bytes, start: int) -> bytes:
    """A lower-cased run (Latin-1) after the contract's deletion; ``start``: the checksum of
    what stands before the run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % ERRORS == 0:
        k = h % len(run)
        return run[:k] + run[k + 1:]
    return run


def count_words(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``docs(doc_id, text)`` -> word, n: how often each word of six letters or more occurs."""

    def count(it):
        held: Counter = Counter()

        def counted():
            out = pa.RecordBatch.from_pydict({
                "word": pa.array([w.decode("latin-1") for w in held], pa.string()),
                "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return out

        for batch in it:
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                doc = doc.as_py()
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for found in runs(text):
                    if not found:
                        continue
                    low = " ".join(found).encode("latin-1").translate(_LOWER)
                    for run, n in Counter(low.split(b" ")).items():
                        word = word_of(run, start)
                        if len(word) >= LETTERS_AT_LEAST:
                            held[word] += n
                    if len(held) > HELD_WORDS:
                        yield counted()
        yield counted()
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _class_letters(classes: int) -> list[str]:
    """All letters that words consist of, dealt to the classes in turn."""
    letters = _UPPER.lower() + "".join(map(chr, range(0xC0, 0x100)))
    return [letters[k::classes] for k in range(classes)]


def _blocked(words: DataFrame, classes: int) -> DataFrame:
    """``words`` with ``block``: how many letters of each class a word has."""
    own = [F.length("word") - F.length(F.translate("word", x, "")) for x in _class_letters(classes)]
    return words.withColumn("block", F.array(*own))


def _homes(classes: int):
    """(block, role) of the blocks whose words a block is met with: shorter ones by a letter of
    any class, and those with a letter more of a later class instead of one of an earlier (the
    others meet this block from their side)."""
    at = [F.col("block")[k] for k in range(classes)]

    def moved(less: int, more: int | None):
        new = [v - 1 if k == less else v + 1 if k == more else v for k, v in enumerate(at)]
        role = LONGER if more is None else ALIKE
        return F.when(at[less] > 0, F.struct(F.array(*new).alias("home"), F.lit(role).alias("role")))
    return F.array_compact(F.array(F.struct(F.col("block").alias("home"), F.lit(OWN).alias("role")),
                                   *[moved(i, None) for i in range(classes)],
                                   *[moved(i, j) for i in range(classes) for j in range(i + 1, classes)]))


def _routes(blocks: DataFrame, classes: int) -> DataFrame:
    """``blocks(block, rows, chunks)`` -> where the words of a block go: block, rows, chunks, and
    an array ``homes`` of (home, role, chunks of the home block, into how many parts all that
    is met with it falls)."""
    links = blocks.select("block", "rows", "chunks", F.explode(_homes(classes)).alias("h")) \
        .select("block", "rows", "chunks", "h.home", "h.role")
    homes = blocks.select(F.col("block").alias("home"), F.col("chunks").alias("home_chunks"))
    links = links.join(homes, "home")
    parts = links.groupBy("home").agg(F.max("chunks").alias("parts"))
    return links.join(parts, "home").groupBy("block", "rows", "chunks") \
        .agg(F.collect_list(F.struct("home", "role", "home_chunks", "parts")).alias("homes"))


def _meetings(own):
    """The meetings (home, its chunk, part) that a word of chunk ``chunk`` goes to over one route,
    and its role there."""
    chunk, home, role = F.col("chunk"), own["home"], own["role"]

    def at(h, part, role):
        return F.struct(F.concat_ws(",", home.cast("array<string>"), h.cast("string"), part.cast("string"))
                        .alias("meeting"), role.cast("int").alias("role"))
    first = F.transform(F.sequence(F.lit(0), own["parts"] - 1), lambda s: at(
        chunk, s, F.when(s == chunk, F.lit(HOME_ONCE)).otherwise(F.lit(HOME))))
    # chunks of one block meet in the part of the later one
    before = F.transform(F.when(chunk > 0, F.sequence(F.lit(0), chunk - 1)).otherwise(
        F.array().cast("array<int>")), lambda h: at(h, chunk, F.lit(OWN)))
    there = F.transform(F.sequence(F.lit(0), own["home_chunks"] - 1), lambda h: at(h, chunk, role))
    return F.when(role == OWN, F.concat(first, before)).otherwise(there)


def _matrix(words: np.ndarray, letters: np.ndarray, kind) -> np.ndarray:
    """Letter counts of words of equal length (rows of bytes)."""
    n = len(words)
    place = np.zeros(256, np.int64)
    place[letters] = np.arange(len(letters))
    flat = np.repeat(np.arange(n) * len(letters), words.shape[1]) + place[words.ravel()]
    return np.bincount(flat, minlength=n * len(letters)).reshape(n, -1).astype(kind)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` become those of ``b`` by one replacement or, where ``b`` is longer by
    one, by one insertion."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    head = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


def near_pairs(a: list[bytes], b: list[bytes], same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``a``, in ``b``) of the words one edit apart.  Words of ``a`` are of one length,
    those of ``b`` of the same or one more; ``same``: both are one list, each pair comes once."""
    none = np.zeros(0, np.int64)
    if not a or not b:
        return none, none
    la, lb = len(a[0]), len(b[0])
    ra = np.frombuffer(b"".join(a), np.uint8).reshape(-1, la)
    rb = ra if same else np.frombuffer(b"".join(b), np.uint8).reshape(-1, lb)
    letters = np.flatnonzero(np.bincount(ra.ravel(), minlength=256) + np.bincount(rb.ravel(), minlength=256))
    kind = np.float32 if lb < 2000 else np.float64  # both are exact for such squares
    ma = _matrix(ra, letters, kind)
    mb = ma if same else _matrix(rb, letters, kind)
    # |x|^2 + |y|^2 - 2 x y as one product
    left = np.column_stack([-2 * ma, (ma * ma).sum(axis=1), np.ones(len(a), kind)])
    right = np.column_stack([mb, np.ones(len(b), kind), (mb * mb).sum(axis=1)])
    rows, found_a, found_b = max(1, TILE // min(len(b), 4096)), [], []
    for i in range(0, len(a), rows):
        for j in range(0, len(b), 4096):
            if same and j + 4096 <= i:
                continue
            x, y = np.nonzero(left[i:i + rows] @ right[j:j + 4096].T < 2.5)
            x, y = x + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), max(1, TILE // lb)):
                p, q = x[k:k + max(1, TILE // lb)], y[k:k + max(1, TILE // lb)]
                near = _one_edit(ra[p], rb[q])
                found_a.append(p[near])
                found_b.append(q[near])
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (none, none)


def _compare(table: pa.Table) -> pa.Table:
    """What the meetings of a task tell about each word: how many near words, and the best."""
    meeting = table.column("meeting").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((table.column("role").to_numpy(), meeting))
    meeting = meeting[order]
    role, n = table.column("role").to_numpy()[order], table.column("n").to_numpy()[order]
    words = [w.encode("latin-1") for w in table.column("word").take(pa.array(order)).to_pylist()]
    cuts = np.append(np.flatnonzero(np.append(True, meeting[1:] != meeting[:-1])), len(meeting))
    one, other = [], []
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        ends = (lo + np.searchsorted(role[lo:hi], range(6))).tolist()
        home = words[ends[HOME]:ends[OWN]]  # all have one of the first two roles
        for k in (HOME_ONCE, OWN, ALIKE, LONGER):
            if k == HOME_ONCE:
                met, at = (home, lo) if ends[OWN] > ends[HOME_ONCE] else ([], lo)
            else:
                met, at = words[ends[k]:ends[k + 1]], ends[k]
            p, q = near_pairs(home, met, k == HOME_ONCE)
            one.append(p + lo)
            other.append(q + at)
    return _best(words, n, np.concatenate(one), np.concatenate(other))


def _best(words: list[bytes], n: np.ndarray, one: np.ndarray, other: np.ndarray) -> pa.Table:
    """Per word of the pairs: word, n_near, and the near word of largest n (the first of them)."""
    a, b = np.append(one, other), np.append(other, one)
    numbers: dict[bytes, int] = {}
    number = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    names = list(numbers)
    rank = np.empty(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    a_, n_b, r_b = number[a], n[b], rank[number[b]]
    order = np.lexsort((r_b, -n_b, a_))
    a_, b = a_[order], b[order]
    at = np.flatnonzero(np.append(True, a_[1:] != a_[:-1])) if len(a_) else np.zeros(0, np.int64)
    return pa.table({"word": pa.array([names[k].decode("latin-1") for k in a_[at]], pa.string()),
                     "n_near": pa.array(np.diff(np.append(at, len(a_))), pa.int64()),
                     "form": pa.array([words[k].decode("latin-1") for k in b[at]], pa.string()),
                     "form_n": pa.array(n[b[at]], pa.int64())})


def near_words(words: DataFrame, classes: int = CLASSES, chunk: int = CHUNK,
               task_rows: int = TASK_ROWS) -> DataFrame:
    """``words(word, n)`` (distinct) -> word, n_near, best: the number of words one edit away and
    (form_n, form) of the most frequent one; words without any are left out."""
    words = _blocked(words.select("word", "n"), classes)
    blocks = words.groupBy("block").agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("chunks", F.ceil(F.col("rows") / chunk).cast("int"))
    routes = written(_routes(blocks, classes), "variants-routes")
    sent = F.aggregate("homes", F.lit(0).cast("long"), lambda n, h: n + F.when(
        h["role"] == OWN, h["parts"] + F.col("chunks")).otherwise(h["home_chunks"]))
    size = routes.agg(F.sum(F.col("rows") * sent).alias("n")).first()["n"] or 0
    tasks = max(1, -(-size // task_rows))
    to = routes.select(F.col("block").alias("from"), "chunks", "homes")
    met = sized_join(words, to, lambda a, b: a["block"] == b["from"], "inner", ["word"]) \
        .withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")) \
        .select("word", "n", F.explode(F.flatten(F.transform("homes", _meetings))).alias("m")) \
        .select("word", "n", "m.meeting", "m.role") \
        .withColumn("task", F.pmod(F.xxhash64("meeting"), F.lit(tasks)))
    found = met.groupBy("task").applyInArrow(_compare, "word string, n_near long, form string, form_n long")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(
        F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``forms(word, form)`` -> word, root.  A form is at least ``FORM_RATIO`` times as frequent as
    its word: that bounds the length of a chain, and its reach doubles in each round."""
    longest = max(1, int(math.log(max(most, LEAST_COUNT) / LEAST_COUNT, FORM_RATIO)) + 1)
    reach = written(forms.select("word", F.col("form").alias("root")), "variants-forms")
    for _ in range(longest.bit_length()):
        ahead = reach.select(F.col("word").alias("at"), F.col("root").alias("further"))
        reach = written(sized_join(reach, ahead, lambda a, b: a["root"] == b["at"], "left", ["word"])
                        .select("word", F.coalesce("further", "root").alias("root")), "variants-roots")
    return reach


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> word, form, root, n, n_near, form_n, one row per word.

    A word is a maximal run of Latin letters, A-Z lower-cased, changed by the contract's
    deletions, of six letters or more that occurs five times or more.  Two words are near if
    one insertion, deletion or replacement makes them equal.  ``form``: the near word of
    largest n (ties: the first in code-point order), if it is five times as frequent or more;
    ``root``: where the forms lead in the end, or the word itself.

    Null and empty texts have no words; a null doc_id counts as empty text in the deletions;
    rows with one doc_id and repeated rows count each by itself.  Texts and words of any
    length are taken whole, other columns are ignored, an empty table gives an empty result."""
    words = written(count_words(docs), "variants-words")
    near = near_words(words)
    enough = F.col("form_n") >= FORM_RATIO * F.col("n")
    out = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less")) \
        .select("word", F.when(enough, F.col("best.form")).alias("form"), "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("form_n")).alias("form_n"))
    out = written(out, "variants-near")
    most = out.agg(F.max("n").alias("n")).first()["n"] or 0
    roots = _roots(out.where("form is not null"), most)
    return out.join(roots, "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every word with its near words."""
    return spelling_variants(read(spark, sf_dir, "documents", "doc_id", "text"))
