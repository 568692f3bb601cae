"""Operator 4: toxicity of texts restored by a noisy-channel decoder.

A character language model (letter trigrams with word ends) is counted over all
documents.  A token that may be disguised (leetspeak, separators or white space between
letters, a letter twice or more in a row) becomes a lattice: each seen character offers the
letters it may stand for, or nothing, or a word end, at a channel cost; Viterbi decoding
under the language model picks the likeliest reading.  Neighbouring tokens that begin a
weighted word together ('id iot') are one lattice, in which the tokens as shown compete.
Tokens without any letter and a '!' at a word's end are read as shown.
The score comes from the restored words:
words and word beginnings that labelled toxic documents use far more often than clean
ones carry weights, and a logistic curve, fitted on weights learned from the other half
of the rows, turns their maximum and sum into a probability.

Only the label table, bounded by ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` rows, is sampled; the
language model and the scores cover every text as a whole.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import read, release_memory

# Labelled rows that weights are learned from, at most (those with the smallest hashes).
TRAIN_TOXIC, TRAIN_CLEAN = 10_000, 20_000
# A word or beginning counts as evidence from this log-likelihood ratio on.
LEAST_EVIDENCE = 12.0
PREFIX = range(3, 7)
CACHE_TOKENS, HELD_FEATURES, BEAM, CHUNK_BYTES = 50_000, 200_000, 12, 1 << 20
# Letters the language model tells apart; all others share one symbol.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
END, OTHER = "^", "?"
# What a sign may stand for (fixed values of the channel).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
        "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
COST_LEET, COST_NO_LETTER, COST_REPEAT, COST_SEPARATOR, COST_BLANK = 1.0, 7.0, 1.5, 1.0, 2.0

_WORD = re.compile(r"[^\W\d_]+")
_PLAIN = re.compile(r"[^\w$@!|+€]*[^\W\d_]+[^\w$@|+€]*|[\W\d_]*")
_EDGE_RUN = re.compile(r"^([\W_])\1{2,}|([\W_])\2{2,}$")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_REPEATS = re.compile(r"(.)\1+")
_SEPARATOR = re.compile(r"[^\w$@!|+€]|_")
# Signs that may stand for one another; i and l share theirs.
_ALIKE = str.maketrans({k: v[0] for k, v in LEET.items()} | {"l": "i"})


def letter_counts(docs: DataFrame) -> dict[str, int]:
    """Trigram counts over all words of all texts (two word ends before each word, one after
    it); at most len(LETTERS + 2) ** 3 rows reach the driver, whatever the corpus."""
    signs = END + OTHER + LETTERS

    def count(it):
        table, told = np.zeros(0x110000, np.uint8), np.zeros(0x110000, bool)
        grams = np.zeros(1 << 18, np.int64)
        for batch in it:
            texts = batch.column(0)
            for lo, hi in _chunks(texts, CHUNK_BYTES // 2):
                low = pc.utf8_lower(texts.slice(lo, hi - lo).fill_null(""))
                text = "\n".join(low.to_pylist()).encode("utf-32-le", "replace")
                signs_seen = np.frombuffer(text, np.uint32)
                for k in np.unique(signs_seen[~told[signs_seen]]).tolist():
                    table[k], told[k] = signs.find(c) if (c := chr(k)) in LETTERS else int(c.isalpha()), True
                seen = table[signs_seen]
                inside = seen > 0
                word = np.cumsum(np.diff(inside.astype(np.int8), prepend=0) == 1)[inside]
                if not len(word):
                    continue
                line = np.zeros(len(word) + 2 * int(word[-1]) + 1, np.int32)
                line[np.arange(len(word)) + 2 * word] = seen[inside]
                gram = line[:-2] << 12 | line[1:-1] << 6 | line[2:]
                grams += np.bincount(gram, minlength=1 << 18)
        found = np.flatnonzero(grams)
        found = found[(found & 0xFFF) > 0]  # two word ends in a row end no word
        names = ["".join(signs[g >> k & 63] for k in (12, 6, 0)) for g in found.tolist()]
        release_memory()
        yield pa.RecordBatch.from_pydict({"gram": pa.array(names, pa.string()), "n": pa.array(grams[found])})
    rows = docs.select("text").mapInArrow(count, "gram string, n long") \
        .groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"]: r["n"] for r in rows}


def _chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> list[tuple[int, int]]:
    """Stretches of a batch with about ``size`` bytes of text each."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    cuts, lo = [], 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + size)))
        cuts.append((lo, hi))
        lo = hi
    return cuts


def language_model(counts: dict[str, int]) -> dict[str, float]:
    """Log probability of a trigram's last sign; pairs and single signs to fall back to."""
    pair, sign, total = Counter(), Counter(), 0
    before = Counter()
    for g, n in counts.items():
        before[g[:2]] += n
        pair[g[1:]] += n
        sign[g[2]] += n
        total += n
    lead = Counter()
    for p, n in pair.items():
        lead[p[0]] += n
    size = len(LETTERS) + 2
    p1 = {c: (sign[c] + 1) / (total + size) for c in LETTERS + END + OTHER}
    out = {c: math.log(p) - 4 for c, p in p1.items()}
    p2 = {p: (n + 5 * p1[p[1]]) / (lead[p[0]] + 5) for p, n in pair.items()}
    out |= {p: math.log(q) - 2 for p, q in p2.items()}
    out |= {g: math.log((n + 5 * p2[g[1:]]) / (before[g[:2]] + 5)) for g, n in counts.items()}
    return out


def restore(token: str, model: dict[str, float], blank: float = COST_BLANK) -> str:
    """The likeliest words behind a (lower-case) token, separated by blanks; ``blank``: the
    cost of a separator as a word end."""
    get, floor = model.get, model["^"] - 6
    def step(state: str, sign: str) -> float:
        return get(state + sign) or get(state[1] + sign) or get(sign) or floor
    beams: dict[str, tuple] = {END + END: (0.0, None)}
    seen = ""
    for ch in token:
        if ch.isalpha():
            options = [(ch, 0.0)]
        elif ch in LEET:
            options = [(c, COST_LEET) for c in LEET[ch]] + [(" ", COST_NO_LETTER)]
        else:
            options = [("", COST_SEPARATOR), (" ", blank)]
        if ch == seen and (ch.isalpha() or ch in LEET):
            options.append(("", COST_REPEAT))
        seen = ch
        new: dict[str, tuple] = {}
        for state, (score, path) in beams.items():
            for out, cost in options:
                if out == "":
                    after, s, way = state, score - cost, path
                elif out == " ":
                    s = score - cost + (step(state, END) if state != END + END else 0.0)
                    after, way = END + END, (path, " ")
                else:
                    sign = out if out in LETTERS else OTHER
                    after, s, way = state[1] + sign, score - cost + step(state, sign), (path, out)
                if after not in new or s > new[after][0]:
                    new[after] = (s, way)
        beams = dict(sorted(new.items(), key=lambda x: -x[1][0])[:BEAM]) if len(new) > BEAM else new
    way = max(((s + (step(st, END) if st != END + END else 0.0), k) for k, (st, (s, _)) in
               enumerate(beams.items())))[1]
    path, out = list(beams.values())[way][1], []
    while path:
        path, ch = path
        out.append(ch)
    return " ".join("".join(reversed(out)).split())


def _core(token: str) -> str:
    """A token without the punctuation around it."""
    return _EDGE_RUN.sub("", _EDGE_RUN.sub("", token)).strip(".,;:?\"'()[]{}<>#%&*").rstrip("!")


def readings(token: str, model: dict[str, float], heads: frozenset | None = None) -> set[str]:
    """Words of a lower-case token: those it shows and, if it may be disguised, those behind it.

    With ``heads`` (see ``beginnings``) repeated letters are only decoded where the reading
    can begin with one of them, whichever of the letters fall away."""
    doubled = _DOUBLED.search(token)
    if token.isalpha() and not doubled:
        return {token}
    words = set(_WORD.findall(token))
    core = _core(token)
    if doubled and core.isalpha():
        if heads is None or begins(skeleton(core), heads):
            words.update(restore(core, model).split())
    elif not core.isalpha() and any(c.isalpha() for c in core) and (doubled or not _PLAIN.fullmatch(token)):
        found = restore(core, model).split()
        if len(close := _SEPARATOR.sub("", core)) < len(core):
            found += restore(close, model).split()
        # a sign read as the letter beside it doubles that letter
        words.update(found, *[restore(w, model).split() for w in found if _DOUBLED.search(w)])
    return words


def skeleton(token: str) -> str:
    """What all readings of a token as one word share: its signs as letters, i and l alike,
    without repeats and separators."""
    return _REPEATS.sub(r"\1", _SEPARATOR.sub("", token).translate(_ALIKE))


def beginnings(weights: dict[str, float]) -> tuple[frozenset, frozenset, frozenset]:
    """Skeletons of the weighted features, of those that are whole words, and all proper
    beginnings of the latter."""
    heads = frozenset(skeleton(f.rstrip("$")) for f in weights)
    whole = frozenset(skeleton(f[:-1]) for f in weights if f.endswith("$"))
    return heads, whole, frozenset(h[:k] for h in whole for k in range(1, len(h)))


def begins(shape: str, heads: frozenset, after: int = 0) -> bool:
    """Whether a skeleton begins with one of ``heads`` that has more than ``after`` letters."""
    for k in range(after + 1, len(shape) + 1):
        if shape[:k] in heads:
            return True
    return False


def joined(first: str, second: str) -> str:
    """The skeleton of two tokens written as one."""
    return first + (second[1:] if first[-1:] == second[:1] else second)


def split_windows(shapes: Iterable[str], whole: frozenset, proper: frozenset) -> list[int]:
    """How many of the first tokens (by their skeletons) may be pieces of one weighted word,
    with or without an ending; no more skeletons are taken than that needs."""
    shapes = iter(shapes)
    shape, out = next(shapes), []
    for k, s in enumerate(shapes, 2):
        if not s:
            continue
        if begins(longer := joined(shape, s), whole, len(shape)):
            out.append(k)
        if (shape := longer) not in proper:
            break
    return out


def restored_words(text: str, model: dict[str, float], known: dict[str, tuple]) -> set[str]:
    """All words of a text, shown or restored token by token or from runs of single signs;
    ``known`` remembers tokens."""
    if len(known) > HELD_FEATURES // 2:
        known.clear()
    tokens = text.lower().split()
    out: set[str] = set()
    for t in set(tokens):
        if (w := known.get(t)) is None:
            w = known[t] = tuple(readings(t, model)), is_small(t)
        out.update(w[0])
    small = [t if known[t][1] else None for t in tokens]
    for some, run in itertools.groupby(small, lambda t: t is not None):
        if some and (run := spaced_run(list(run))):
            out.update(run_readings(run, model))
    return out


def is_small(token: str) -> bool:
    """At most one sign beside punctuation."""
    if len(token) > 1 and token[:2].isalnum():
        return False
    return len(token) == 1 or len(_SEPARATOR.sub("", token)) < 2


def spaced_run(tokens: list[str]) -> str | None:
    """Neighbouring small tokens as one run, if they hold three or more signs and at least two
    letters; whichever white space and punctuation stands between them."""
    if len(tokens) < 3:
        return None
    run = " ".join(tokens)
    return run if len(_SEPARATOR.sub("", run)) > 2 and len({c for c in run if c.isalpha()}) > 1 else None


def run_readings(run: str, model: dict[str, float]) -> set[str]:
    """Words behind a run of single signs: with blanks as word ends, and closed up."""
    return {*restore(run, model).split(), *restore(_SEPARATOR.sub("", run), model).split()}


def features(word: str) -> list[str]:
    out = [word + "$"]
    for k in PREFIX[:max(0, len(word) - PREFIX[0] + 1)]:
        out.append(word[:k])
    return out


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Texts of the labelled rows to learn from, (text, toxic, half), and how many times rarer
    the toxic ones are among all such rows than in the sample."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    usable = labels.where("toxic in (0, 1) and doc_id is not null").where(F.crc32(key.cast("binary")) % 5 != 0) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    order = F.xxhash64("doc_id")
    some = usable.where("toxic = 1").orderBy(order, "doc_id").limit(TRAIN_TOXIC) \
        .union(usable.where("toxic = 0").orderBy(order, "doc_id").limit(TRAIN_CLEAN))
    rarer = (min(toxic, TRAIN_TOXIC) / max(toxic, 1)) / max(min(clean, TRAIN_CLEAN) / max(clean, 1), 1e-12)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id") \
        .select("text", "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half"))
    return rows, rarer


def _weights(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Log odds of the features that toxic documents use significantly more often.

    A beginning that nearly always goes on with the same letter says no more than the longer
    one, and would only catch unrelated words."""
    out, longer = {}, Counter()
    for f, (a, _) in counts.items():
        if not f.endswith("$"):
            longer[f[:-1]] = max(longer[f[:-1]], a)
    for f, (a, b) in counts.items():
        share = (a + b) / (toxic + clean)
        if a < 3 or a / toxic <= b / clean or longer[f] >= 0.8 * a:
            continue
        g = 2 * (a * math.log(a / toxic / share) + (b * math.log(b / clean / share) if b else 0.0))
        if g >= LEAST_EVIDENCE:
            out[f] = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
    return out


def evidence(words: set[str], weights: dict[str, float]) -> tuple[float, float]:
    """Largest word weight and logarithm of their sum; a word weighs as much as its heaviest
    feature."""
    best = [max([weights.get(f, 0.0) for f in features(w)]) for w in words]
    return max(best, default=0.0), math.log1p(sum(best))


def _curve(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Intercept and slopes; more evidence never lowers the score: a negative slope is left out."""
    slopes = _logistic(x, y)
    if (slopes[1:] < 0).any():
        kept = int(slopes[2] >= slopes[1])
        base, slope = _logistic(x[:, [kept]], y)
        slopes = np.zeros(3)
        slopes[0], slopes[1 + kept] = base, max(0.0, slope)
    return slopes.tolist()


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The scoring model.  Without usable labels of both classes every score is 0."""
    from pyspark import StorageLevel
    model = {"letters": language_model(letter_counts(docs)), "weights": {}, "curve": None}
    spark = docs.sparkSession
    letters = spark.sparkContext.broadcast(model["letters"])

    def read_words(it):
        known: dict[str, tuple] = {}
        for batch in it:
            texts, toxic, half = (batch.column(k).to_pylist() for k in range(3))
            rows = [sorted(restored_words(t or "", letters.value, known)) for t in texts]
            yield pa.RecordBatch.from_pydict({"words": pa.array(rows, pa.list_(pa.string())),
                                              "toxic": pa.array(toxic, pa.int32()),
                                              "half": pa.array(half, pa.int32())})
        known.clear()
        release_memory()

    sample, rarer = _sample(docs, labels)
    words = sample.select("text", F.col("toxic").cast("int"), "half") \
        .mapInArrow(read_words, "words array<string>, toxic int, half int") \
        .persist(StorageLevel.DISK_ONLY)
    sizes = {(r["half"], r["toxic"]): r["n"] for r in
             words.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = (sum(n for (_, t), n in sizes.items() if t == k) for k in (1, 0))
    if not toxic or not clean:
        words.unpersist()
        return model

    def count(it):
        found: dict[str, list[int]] = {}

        def counted():
            return pa.RecordBatch.from_pydict({"f": pa.array(list(found), pa.string()), **{
                f"n{k}": pa.array([v[k] for v in found.values()], pa.int64()) for k in range(4)}})

        for batch in it:
            for own, t, h in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for f in {f for w in own for f in features(w)}:
                    if (n := found.get(f)) is None:
                        n = found[f] = [0, 0, 0, 0]
                    n[2 * h + t] += 1
                if len(found) > HELD_FEATURES:
                    yield counted()
                    found.clear()
        yield counted()
        found.clear()
        release_memory()

    n = [F.sum(f"n{k}").alias(f"n{k}") for k in range(4)]
    # a feature needs three toxic documents: that bounds what comes to the driver
    odds = F.col("n1") + F.col("n3")
    rows = words.mapInArrow(count, "f string, n0 long, n1 long, n2 long, n3 long") \
        .groupBy("f").agg(*n).where((odds >= 3) & (odds * clean > 2 * (F.col("n0") + F.col("n2")) * toxic)) \
        .collect()
    by_half = {}
    for h in (0, 1):
        counts = {r["f"]: (r[f"n{2 * h + 1}"], r[f"n{2 * h}"]) for r in rows}
        by_half[h] = _weights(counts, max(1, sizes.get((h, 1), 0)), max(1, sizes.get((h, 0), 0)))
    model["weights"] = _weights({r["f"]: (r["n1"] + r["n3"], r["n0"] + r["n2"]) for r in rows}, toxic, clean)
    halves = spark.sparkContext.broadcast(by_half)

    def cross(it):  # each half is judged by the weights of the other
        for batch in it:
            found = [evidence(set(own), halves.value[1 - h]) for own, h in
                     zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1),
                                              "top": pa.array([x[0] for x in found], pa.float64()),
                                              "total": pa.array([x[1] for x in found], pa.float64())})

    table = words.mapInArrow(cross, "toxic int, top double, total double").collect()
    x = np.array([[r["top"], r["total"]] for r in table])
    model["curve"] = _curve(x, np.array([r["toxic"] for r in table], float))
    model["curve"][0] -= math.log(rarer) if rarer > 0 else 0.0
    words.unpersist()
    for used in (letters, halves):
        used.destroy()
    return model


# Punctuation around a word, as ``_core`` takes it off; a '!' only at the end.
_AROUND = ".,;:?\"'()[]{}<>#%&*"


def _doubled(words: pa.Array) -> np.ndarray:
    """Which words hold the same sign twice in a row."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    found = np.zeros(len(data) + 1, np.int64)
    for size, lead in ((1, data < 0x80), (2, (data >= 0xC0) & (data < 0xE0)), (3, (data >= 0xE0) & (data < 0xF0)),
                       (4, data >= 0xF0)):
        n = len(data) - 2 * size + 1
        if n > 0:
            same = lead[:n].copy()
            for k in range(size):
                same &= data[k:k + n] == data[k + size:k + size + n]
            # counted at the second sign's first byte
            found[1 + size:1 + size + n] += same
    total = np.cumsum(found)
    # a pair across two words ends in a later word's first sign
    return total[ends[1:]] - total[np.minimum(ends[:-1] + 1, ends[1:])] > 0


class PlainWords:
    """Tokens that show one word of two letters or more, none of them doubled, with or without
    punctuation around it.  There is nothing to restore in them: their evidence and skeletons
    are those of the word, found for all tokens at once."""

    def __init__(self, weights: dict[str, float], proper: frozenset):
        by_size: dict[int, dict[str, float]] = {k: {} for k in [*PREFIX, 0]}
        for f, w in weights.items():
            by_size[0 if f.endswith("$") else len(f)][f.rstrip("$")] = w
        self.sets = {k: (pa.array(list(own), pa.string()), np.array([*own.values(), 0.0]))
                     for k, own in by_size.items()}
        self.proper = pa.array(sorted(proper), pa.string())

    def weigh(self, words: pa.Array) -> np.ndarray:
        """Weight of each word, 0 without any."""
        best = np.zeros(len(words))
        for k, (names, weights) in self.sets.items():
            begun = pc.utf8_slice_codeunits(words, 0, k) if k else words
            best = np.maximum(best, weights[pc.index_in(begun, names).fill_null(len(names)).to_numpy()])
        return best

    def read(self, tokens: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, pa.Array, np.ndarray]:
        """(which tokens are plain; then for all, with values for plain ones only: their words, the
        words' weights, the skeletons, and which of these begin a weighted word)."""
        words = pc.utf8_rtrim(pc.utf8_ltrim(tokens, _AROUND), _AROUND + "!")
        plain = pc.and_(pc.utf8_is_alpha(words), pc.greater(pc.utf8_length(words), 1)) \
            .to_numpy(zero_copy_only=False) & ~_doubled(words)
        shapes = pc.replace_substring_regex(pc.replace_substring(words, "l", "i"), "ii+", "i")
        opening = pc.is_in(shapes, self.proper).to_numpy(zero_copy_only=False)
        return plain, words, np.where(plain, self.weigh(words), 0.0), shapes, plain & opening


class Continuations:
    """Which signs can follow a proper beginning of a weighted word: nearly all pairs of
    neighbouring tokens are ruled out by the first ``DEPTH`` of them at once."""

    DEPTH = 4

    def __init__(self, whole: frozenset, proper: frozenset):
        self.number = {h: k for k, h in enumerate(sorted(proper))}
        # a sign is a byte; those beyond 254 kinds share one, which rules out less
        kinds = sorted({c for h in whole for c in h})
        self.sign = {c: min(k, 254) for k, c in enumerate(kinds, 1)}
        self.known: dict[str, int] = {}  # first signs as one number
        self.after: list[np.ndarray] = []  # by number of signs: what may follow
        self.ends: list[np.ndarray] = []  # by number of signs: what ends a weighted word
        for n in range(1, self.DEPTH + 1):
            some = {(h[:k], h[k:k + n], len(h) == k + n) for h in whole for k in range(1, len(h) - n + 1)}
            self.after.append(np.array(sorted({self._key(f, x) for f, x, _ in some}), np.int64))
            self.ends.append(np.array(sorted({self._key(f, x) for f, x, e in some if e}), np.int64))

    def _key(self, first: str, signs: str) -> int:
        out = self.number[first]
        for k in range(self.DEPTH):
            out = out << 8 | (self.sign.get(signs[k], 255) if k < len(signs) else 0)
        return out

    @staticmethod
    def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
        if not len(ordered):
            return np.zeros(len(values), bool)
        return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values

    def may_follow(self, shapes: dict[int, str], first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """For pairs of places in ``shapes``, the first a proper beginning: False where the two
        joined neither are a beginning nor hold a whole word."""
        depth, get = self.DEPTH, self.sign.get
        if len(self.known) > CACHE_TOKENS:
            self.known.clear()
        # the signs of a second piece, one a byte, the first highest
        distinct, at = np.unique(second, return_inverse=True)
        packed = np.zeros(len(distinct), np.int64)
        for n, k in enumerate(distinct.tolist()):
            some = shapes[k][:depth + 1]
            if (value := self.known.get(some)) is None:
                value = 0
                for j in range(depth + 1):
                    value = value << 8 | (get(some[j], 255) if j < len(some) else 0)
                self.known[some] = value
            packed[n] = value
        signs = (packed[:, None] >> 8 * np.arange(depth, -1, -1)) & 255
        distinct, begin = np.unique(first, return_inverse=True)
        begun = np.array([get(shapes[k][-1], 255) for k in distinct.tolist()], np.int64)[begin]
        numbers = np.array([self.number[shapes[k]] for k in distinct.tolist()], np.int64)[begin]
        own = signs[at]
        empty = own[:, 0] == 0
        same = own[:, 0] == begun  # written once where the two meet
        own = np.where(same[:, None], own[:, 1:], own[:, :-1])
        out = empty | (own[:, 0] == 0)
        key = numbers
        for n in range(depth):
            key = key << 8 | own[:, n]
            whole_key = key << 8 * (depth - 1 - n)
            # a word ends after these signs; or the piece does, or there is more to compare than depth
            last = (own[:, n + 1] == 0) if n + 1 < depth else np.ones(len(own), bool)
            out |= self._among(whole_key, self.ends[n]) | (last & self._among(whole_key, self.after[n]))
        return out


def score(docs: DataFrame, model: dict, out: str = "toxicity", keep: list[str] | None = None) -> DataFrame:
    """``docs(text, ...)`` with a column ``out``: the probability of label 1, from the text
    alone, whole texts of any length.  Null and empty texts are scored as texts without
    evidence.  Repeated rows get equal scores, other columns stay, one named ``out`` is
    replaced; an empty table gives an empty result."""
    keep = keep or docs.columns
    returned = [c for c in keep if c != out]
    columns = list(dict.fromkeys([*returned, "text"]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*returned).schema.add(out, "double")

    def scored(it):
        letters, weights, curve = (shared.value[k] for k in ("letters", "weights", "curve"))
        heads, whole, proper = beginnings(weights)
        plain_words, continuations = PlainWords(weights, proper), Continuations(whole, proper)
        known: dict[str, tuple] = {}
        joins: dict[tuple[str, str], tuple] = {}
        splits: dict[tuple, tuple] = {}

        def weighed(words) -> tuple:
            return tuple((w, b) for w in words if (b := max(weights.get(f, 0.0) for f in features(w))) > 0)

        def token_evidence(token: str) -> tuple:
            """Evidence of a token, its skeleton, and whether it is small."""
            if (found := known.get(token)) is None:
                found = known[token] = (weighed(readings(token, letters, heads)), skeleton(_core(token)),
                                        is_small(token))
            return found

        def word_evidence(word: str) -> tuple:
            """The same of a token that shows one word, with doubled letters."""
            if (found := known.get(word)) is None:
                form = skeleton(word)
                read = {word, *restore(word, letters).split()} if begins(form, heads) else {word}
                found = known[word] = (weighed(read), form, False)
            return found

        def step(state: str, piece: str) -> tuple[str | None, bool]:
            """What a beginning of weighted words becomes with the next skeleton (None: no beginning
            any more), and whether the two begin with a weighted word.  Only as many signs as the
            longest such word has can tell."""
            key = state, piece[:longest]
            if (done := joins.get(key)) is None:
                longer = joined(state, piece)
                done = joins[key] = longer if longer in proper else None, begins(longer, whole, len(state))
            return done

        def split_evidence(cores: tuple[str, ...]) -> tuple:
            """Evidence of a word in these pieces.  It begins with a whole weighted word: a shorter
            beginning is soon made up by two unrelated words."""
            if (own := splits.get(cores)) is None:
                read = restore(" ".join(cores), letters, 0.0).split()
                own = splits[cores] = weighed(w for w in set(read) if any(
                    w[:k] + "$" in weights for k in range(1, len(w) + 1)))
            return own

        longest = max(map(len, whole), default=0) + 1

        def probability(found: dict[str, float]) -> float:
            top, total = max(found.values(), default=0.0), math.log1p(sum(found.values()))
            z = curve[0] + curve[1] * top + curve[2] * total
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        def chunk(texts: pa.Array) -> list[float]:
            if curve is None:
                return [0.0] * len(texts)
            for memory in (known, joins, splits):
                if len(memory) > CACHE_TOKENS:
                    memory.clear()
            split = pc.utf8_split_whitespace(pc.utf8_lower(texts.fill_null("")))
            coded = split.flatten().dictionary_encode()
            tokens = coded.dictionary
            token, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
            del split, coded
            plain, words, weight, shapes, opening = plain_words.read(tokens)
            single = np.zeros(len(tokens), bool)
            shown: dict[int, tuple] = {k: ((words[k].as_py(), weight[k]),) for k in np.flatnonzero(weight > 0).tolist()}
            rest = np.flatnonzero(~plain)
            shape: dict[int, str] = {}
            letters_only = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
            for k, t, core in zip(rest.tolist(), tokens.take(pa.array(rest)).to_pylist(),
                                  words.take(pa.array(rest)).to_pylist()):
                own, shape[k], single[k] = word_evidence(core) if letters_only[k] and len(core) > 1 \
                    else token_evidence(t)
                opening[k] = shape[k] in proper
                if own:
                    shown[k] = own
            found: dict[int, dict] = {}

            def add(at: np.ndarray, evidence) -> None:
                for k, x in zip((np.searchsorted(ends, at, "right") - 1).tolist(), at.tolist()):
                    if new := evidence(x, int(ends[k + 1])):
                        found.setdefault(k, {}).update(new)

            telling = np.zeros(len(tokens), bool)
            telling[list(shown)] = True
            add(np.flatnonzero(telling[token]), lambda x, _: shown[int(token[x])])
            single = single[token]
            starts = single.copy()
            starts[1:] &= ~single[:-1]
            starts[ends[:-1][ends[:-1] < len(token)]] = True
            starts[:-2] &= single[:-2] & single[1:-1] & single[2:]
            starts[-2:] = False

            def run_evidence(x: int, end: int) -> tuple:
                stop = x + int((~single[x:end]).argmax()) if not single[x:end].all() else end
                run = spaced_run(tokens.take(pa.array(token[x:stop])).to_pylist())
                return weighed(run_readings(run, letters)) if run else ()

            add(np.flatnonzero(starts), run_evidence)
            opening = opening[token]
            opening[-1:] = False
            at = np.flatnonzero(opening)
            # each pair of neighbours is judged once
            pairs, pair = np.unique(token[at].astype(np.int64) * len(tokens) + token[at + 1], return_inverse=True)
            first, second = pairs // max(1, len(tokens)), pairs % max(1, len(tokens))
            listed: dict[int, str] = shape
            needed = np.unique(np.concatenate([first, second]))
            needed = needed[plain[needed]]
            listed.update(zip(needed.tolist(), shapes.take(pa.array(needed)).to_pylist()))
            joint = continuations.may_follow(listed, first, second)
            # what a pair tells by itself; only beginnings go on to the tokens behind it
            told, open_ = np.zeros(len(pairs), bool), np.zeros(len(pairs), bool)
            evidence_of: dict[int, tuple] = {}
            for k in np.flatnonzero(joint).tolist():
                if not (piece := listed[int(second[k])]):
                    open_[k] = True
                    continue
                state, whole_word = step(listed[int(first[k])], piece)
                open_[k] = state is not None
                if whole_word and not open_[k]:
                    cores = _core(tokens[int(first[k])].as_py()), _core(tokens[int(second[k])].as_py())
                    if own := split_evidence(cores):
                        told[k], evidence_of[k] = True, own

            def joined_evidence(x: int, end: int) -> dict:
                state, out = listed[int(token[x])], {}
                for y in range(x + 1, end):
                    if (piece := listed.get(k := int(token[y]))) is None:
                        piece = listed[k] = shapes[k].as_py()
                    if not piece:
                        continue
                    state, whole_word = step(state, piece)
                    if whole_word:
                        out |= dict(split_evidence(tuple(_core(tokens[int(t)].as_py()) for t in token[x:y + 1])))
                    if state is None:
                        break
                return out

            add(at[open_[pair]], joined_evidence)
            # a pair counts within one text only
            ended = np.flatnonzero(told[pair])
            ended = ended[np.searchsorted(ends, at[ended], "right") == np.searchsorted(ends, at[ended] + 1, "right")]
            of_pair = dict(zip(at[ended].tolist(), pair[ended].tolist()))
            add(at[ended], lambda x, _: evidence_of[of_pair[x]])
            nothing = probability({})
            return [probability(found[k]) if k in found else nothing for k in range(len(texts))]

        for batch in it:
            texts = batch.column(columns.index("text"))
            values = [v for lo, hi in _chunks(texts) for v in chunk(texts.slice(lo, hi - lo))]
            arrays = [batch.column(columns.index(c)) for c in returned] + [pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*returned, out])
            del batch, texts, values, arrays
            release_memory()
        for memory in (known, joins, splits):
            memory.clear()
        release_memory()

    return docs.select(*columns).mapInArrow(scored, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: toxicity of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return score(docs, model, "score", ["doc_id"]) \
        .select("doc_id", (F.crc32(key) % 5 == 0).alias("held_out"), "score",
                (F.col("score") >= 0.5).cast("int").alias("predicted"))
