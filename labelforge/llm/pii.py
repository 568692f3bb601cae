"""Operator 12: personal data, found by generators and judged by boosted trees.

1. Certain matches (``base_spans``) are what four fixed formats name: emails, addresses of
   hosts, card numbers and telephone numbers.  They are always kept.
2. Generators propose every other span that may be meant: each stretch of number groups that
   has the right number of digits, each four parts of a dotted chain, numbers without a
   country sign, addresses written with blanks or in words.  Proposals overlap freely.
3. Labels come from the certain matches: a span that is one is personal data; spans that cut
   one short or run over its end, lie inside a word or fail their checksum are not; others
   have no label.  Telephone numbers also teach what they look like without their country
   sign.  Gradient-boosted trees learn from the format of a span and the signs and words
   around it.
4. One half of the labelled spans calibrates what the trees learned from the other (isotonic
   regression per kind); a kind's threshold is the least score from which on the calibrated
   probability is ``CONFIDENCE``.  Among overlapping spans above it the best one is selected;
   spans that overlap a certain match are not.

Scoring is one pass over the texts without a shuffle.  Trees, curves and thresholds come from
all labelled spans of all texts: spans with equal features are one row with their number as its
weight, the trees get bins enough for every row to name its cuts, and the curves are built from
numbers per step of the score, which are few.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from labelforge.llm.common import read, release_memory, unused, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
CONFIDENCE, TREES, DEPTH = 0.9, 20, 4
# Steps of a score in one unit of margin, a power of two.
STEPS = 4096
# The library's bins are an int whose square is one; by default it has 32.
LEAST_BINS, MOST_BINS = 32, 46_340
# Spans that are scored in one go.
SCORED = 20_000

# The certain formats, written so that no text takes more than a pass: what stands before an
# '@' is looked up backwards, number runs are entered at their first digit only.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_GROUP = re.compile("[0-9]++")

# The proposals: chains of number groups, and addresses with blanks or words for their signs.
_CHAIN = re.compile(r"(?<![0-9])[0-9]++(?:[\x20 .()/_-]{1,3}[0-9]++)*+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]{1,3}+(?:\s?\[?(?:\.|dot)\]?\s?[0-9]{1,3}+){3,}+")
_AT = re.compile(r"(?:\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20|\x20?@\x20?)(?=[A-Za-z0-9])", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20|\x20?\.)[A-Za-z0-9-]++)++", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_CUES = {EMAIL: {"mail", "email", "e-mail", "contact", "write", "address"}, IP: {"ip", "host", "server", "addr"},
         CARD: {"card", "visa", "credit", "debit", "mastercard", "amex"},
         PHONE: {"tel", "phone", "call", "fax", "mobile", "telephone", "cell", "telefon"}}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the certain matches, by start, then kind."""
    out, end = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            at = m.start()
            while at > end and text[at - 1] in _LOCAL:
                at -= 1
            if at < m.start():
                out.append((EMAIL, at, m.end()))
                end = m.end()
    if _DIGIT.search(text):
        out += [(IP, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((CARD, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((PHONE, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def proposals(text: str):
    """(kind, start, end) that may be personal data; each once, overlapping.

    A chain of number groups gives at most 19 stretches from each group on."""
    seen = _DIGIT.search(text)
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end())
        at = m.start()
        while at > 0 and text[at - 1] in _LOCAL:
            at -= 1
        # '@' with nothing around it is a sign of its own; ' at ' needs a ' dot ' as well
        plain = m.group().lower() == " at "
        if host and at < m.start() and (not plain or "dot" in host.group().lower()):
            yield EMAIL, at, host.end()
    if not seen:
        return
    for m in _DOTTED.finditer(text):
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, m.start(), m.end())]
        for k in range(len(groups) - 3):
            if all(_small(text[a:b]) for a, b in groups[k:k + 4]):
                yield IP, groups[k][0], groups[k + 3][1]
    for m in _CHAIN.finditer(text):
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, m.start(), m.end())]
        for k, (start, _) in enumerate(groups):
            digits, plus = 0, start > 0 and text[start - 1] == "+"
            paren = start > 0 and text[start - 1] == "("
            for a, b in groups[k:k + 19]:
                digits += b - a
                if digits > 19:
                    break
                if digits >= 12:
                    yield CARD, start, b
                if 7 <= digits <= 15 and (plus or b - start > digits):  # a bare number is no telephone number
                    yield PHONE, start - (plus or paren), b


FEATURES = ["is_email", "is_ip", "is_card", "is_phone", "digits", "groups", "first", "last", "longest", "shortest",
            "signs", "blanks", "hyphens", "dots", "parens", "balanced", "checksum", "plus", "letters", "local",
            "host_parts", "top", "before", "after", "number_before", "number_after", "cue", "other_cue", "length"]


def _side(text: str, at: int) -> int:
    """Kind of the sign at a place: none or blank, letter, digit, sentence sign, other."""
    if not 0 <= at < len(text) or text[at].isspace():
        return 0
    c = text[at]
    return 1 if c.isalpha() else 2 if c.isdigit() else 3 if c in ".,;:!?\"')]}" else 4


def describe(text: str, kind: int, start: int, end: int, bare: bool = False) -> list[float]:
    """Features of a span; ``bare``: without the country sign in front."""
    before = start
    if bare:
        shown = text[start:end]
        start += len(shown) - len(shown.split(" ", 1)[-1])
    span = text[start:end]
    groups = [len(g) for g in _GROUP.findall(span)]
    digits = _NOT_DIGIT.sub("", span)
    rest = _GROUP.sub("", span)
    host = re.split(r"@|\bat\b", span, maxsplit=1, flags=re.I)[-1] if kind == EMAIL else ""
    parts = _WORD.findall(host)
    word = _WORD.findall(text[max(0, before - 40):before].lower())[-2:]
    cues = {k for k, own in _CUES.items() if own & set(word)}
    blank_before = before > 0 and text[before - 1] in "  -./"
    blank_after = end < len(text) and text[end] in "  -./"
    return [*(float(kind == k) for k in range(4)), len(digits), len(groups), groups[0] if groups else 0,
            groups[-1] if groups else 0, max(groups, default=0), min(groups, default=0), len(rest),
            sum(c.isspace() for c in rest), rest.count("-"), rest.count("."), rest.count("(") + rest.count(")"),
            float(rest.count("(") == rest.count(")")), float(kind == CARD and luhn(digits)), float("+" in rest),
            sum(c.isalpha() for c in span), span.find("@") if "@" in span else 0, len(parts),
            len(parts[-1]) if parts else 0, _side(text, before - 1), _side(text, end),
            float(blank_before and before > 1 and text[before - 2].isdigit()),
            float(blank_after and end + 1 < len(text) and text[end + 1].isdigit()),
            float(kind in cues), float(bool(cues - {kind})), end - start]


def label(text: str, span: tuple[int, int, int], base: list[tuple[int, int, int]]) -> int | None:
    """1 for a certain match, 0 for what cannot be one, None for all between."""
    kind, start, end = span
    if span in base:
        return 1
    if _side(text, start - 1) in (1, 2) or _side(text, end) in (1, 2):
        return 0
    if kind == CARD and not luhn(_NOT_DIGIT.sub("", text[start:end])):
        return 0
    k = bisect.bisect_left(base, start, key=lambda s: s[1])
    # certain matches of one kind do not overlap: one of the few around here would
    around = base[max(0, k - 4):k + 4]
    return 0 if any(a < end and start < b for _, a, b in around) else None


def _labelled(docs: DataFrame) -> DataFrame:
    """kind, label, features and a hash of every proposed span that has a label."""
    def rows(it):
        for batch in it:
            out: list[tuple] = []

            def done():
                kinds, labels, marks, values = zip(*out) if out else ((), (), (), ())
                return pa.RecordBatch.from_pydict({
                    "kind": pa.array(kinds, pa.int32()), "label": pa.array(labels, pa.float64()),
                    "mark": pa.array(marks, pa.int64()), "x": pa.array(values, pa.list_(pa.float64()))})
            for text in batch.column(0):
                text = text.as_py()
                if not text or not ("@" in text or _DIGIT.search(text) or " at " in text):
                    continue
                base, own = base_spans(text), 0
                for span in proposals(text):
                    if (y := label(text, span, base)) is None:
                        continue
                    own = own or zlib.crc32(text.encode())
                    mark = zlib.crc32(b"%d %d %d" % span, own)
                    out.append((span[0], y, mark, describe(text, *span)))
                    if y and span[0] == PHONE:
                        out.append((PHONE, y, mark, describe(text, *span, bare=True)))
                if len(out) > SCORED:
                    yield done()
                    out.clear()
            yield done()
        release_memory()
    return docs.select("text").mapInArrow(rows, "kind int, label double, mark long, x array<double>")


def _trees(model) -> list[dict]:
    """The trees of a fitted model as arrays."""
    def node(n, out):
        k = len(out["feature"])
        leaf = n.subtreeDepth() == 0
        for name, value in (("feature", 0 if leaf else n.split().featureIndex()),
                            ("threshold", 0.0 if leaf else n.split().threshold()),
                            ("value", n.prediction()), ("left", k), ("right", k)):
            out[name].append(value)
        if not leaf:
            out["left"][k] = node(n.leftChild(), out)
            out["right"][k] = node(n.rightChild(), out)
        return k
    found = []
    for tree, weight in zip(model.trees, model.treeWeights):
        out: dict[str, list] = {c: [] for c in ("feature", "threshold", "value", "left", "right")}
        node(tree._java_obj.rootNode(), out)
        found.append({c: np.array(v) for c, v in out.items()} | {"weight": weight})
    return found


def margin(trees: list[dict], x: np.ndarray) -> np.ndarray:
    out, rows = np.zeros(len(x)), np.arange(len(x))
    for t in trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = np.where(x[rows, t["feature"][at]] <= t["threshold"][at], t["left"][at], t["right"][at])
        out += t["weight"] * t["value"][at]
    return out


def isotonic(score: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(least score, probability) of the steps of the closest ascending curve; with ``n``: ``y`` of
    the ``n`` spans of each score are 1."""
    n = np.ones(len(score)) if n is None else n
    order = np.argsort(score, kind="stable")
    steps: list[list[float]] = []  # least score, sum, number
    for s, v, m in zip(score[order].tolist(), y[order].tolist(), n[order].tolist()):
        if steps and steps[-1][0] == s:
            steps[-1][1] += v
            steps[-1][2] += m
        else:
            steps.append([s, v, m])
    curve: list[list[float]] = []
    for step in steps:
        curve.append(step)
        while len(curve) > 1 and curve[-2][1] * curve[-1][2] >= curve[-1][1] * curve[-2][2]:
            _, a, m = curve.pop()
            curve[-1][1] += a
            curve[-1][2] += m
    return np.array([c[0] for c in curve]), np.array([c[1] / c[2] for c in curve])


def _scored(rows: DataFrame, trees: list[dict]) -> DataFrame:
    """kind, step of the score, spans ``n`` and those of label 1 ``y``: one row per kind and step."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    width = len(FEATURES)

    def steps(it):
        for batch in it:
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            step = np.floor(margin(shared.value, x) * STEPS).astype(np.int64)
            n = batch.column(2).to_numpy()
            y = (n * batch.column(1).to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(step), batch.column(2), pa.array(y)],
                                             names=["kind", "step", "n", "y"])
    return rows.select("kind", "label", "n", "x").mapInArrow(steps, "kind int, step long, n long, y long") \
        .groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))


def train(docs: DataFrame) -> dict | None:
    """Trees, calibration and thresholds from the texts themselves, from all labelled spans; None
    without spans of both labels."""
    half = F.pmod(F.xxhash64("mark", F.lit(1)), F.lit(2)).cast("int").alias("half")
    rows = written(_labelled(docs).groupBy("kind", "label", half, "x").agg(F.count(F.lit(1)).alias("n")),
                   "pii-labelled")
    learned, other = rows.where("half = 0"), rows.where("half = 1")
    sizes = {r["label"]: r["n"] for r in learned.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    # with fewer bins than that the library would choose the places of its cuts from a sample
    bins = min(MOST_BINS, max(LEAST_BINS, math.isqrt(sum(sizes.values())) + 1))
    model = GBTClassifier(featuresCol="v", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH,
                          maxBins=bins, seed=1) \
        .fit(learned.select("label", F.col("n").cast("double").alias("n"), array_to_vector("x").alias("v")))
    trees = _trees(model)
    curves, thresholds, held_out = _scored(other, trees).toArrow(), {}, {}
    kind, step, n, y = (curves.column(c).to_numpy() for c in ("kind", "step", "n", "y"))
    for k in range(4):
        own = kind == k
        score = step[own] / STEPS
        least, p = isotonic(score, y[own], n[own])
        sure = np.flatnonzero(p >= CONFIDENCE)
        if len(sure):
            thresholds[k] = float(least[sure[0]])
            held_out[KINDS[k]] = _quality(score >= thresholds[k], y[own], n[own])
    return {"trees": trees, "thresholds": thresholds, "held_out": held_out}


def _quality(chosen: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float, int]:
    """(precision, recall, spans) on the spans that were not learned from."""
    right = float(y[chosen].sum())
    return right / max(1, n[chosen].sum()), right / max(1.0, y.sum()), int(n.sum())


def select(text: str, base: list[tuple[int, int, int]], model: dict | None) -> list[tuple[int, int, int]]:
    """The spans that are added to the certain ones: above their kind's threshold, free of
    other spans, better ones first (then longer, earlier ones)."""
    if model is None:
        return []
    known, found, waiting = set(base), [], []

    def judge():
        spans = list(dict.fromkeys(waiting))
        waiting.clear()
        if spans:
            scores = margin(model["trees"], np.array([describe(text, *s) for s in spans]))
            found.extend((v, s) for v, s in zip(scores.tolist(), spans)
                         if v >= model["thresholds"].get(s[0], np.inf))
    for span in proposals(text):
        if span not in known:
            waiting.append(span)
            if len(waiting) >= SCORED:
                judge()
    judge()
    if not found:
        return []
    # certain spans may overlap one another; together they are closed stretches
    starts, ends = [], []
    for _, a, b in base:
        if ends and a < ends[-1]:
            ends[-1] = max(b, ends[-1])
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for _, (kind, a, b) in sorted(found, key=lambda x: (-x[0], x[1][1] - x[1][2], x[1][1], x[1][0])):
        k = bisect.bisect_left(starts, b)
        if k and ends[k - 1] > a:
            continue
        starts.insert(k, a)
        ends.insert(k, b)
        out.append((kind, a, b))
    return out


SPANS = ArrayType(StructType().add("kind", "string").add("start", "long").add("end", "long").add("certain", "boolean"))


def find(docs: DataFrame, model: dict | None, out: str = "spans", redacted: str | None = None) -> DataFrame:
    """``docs(text, ...)`` with a column ``out``: all spans by start, then kind, in code points,
    end exclusive; ``redacted``: a column for the text with ``[kind]`` for each span (what
    overlaps is one).  Other columns stay, one named ``out`` is replaced.

    Null is an empty text without spans.  Texts of any length are taken whole; repeated rows
    get equal results; an empty table gives an empty result."""
    kept = [c for c in docs.columns if c not in (out, redacted)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*kept).schema.add(out, SPANS)
    text_name = unused("_text", kept)
    if redacted:
        schema = schema.add(redacted, "string")
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                    ("certain", pa.bool_())]))

    def spans(it):
        for batch in it:
            values, texts = [], []
            for text in batch.column(len(kept)):
                text = text.as_py() or ""
                own = []
                if "@" in text or " at " in text or _DIGIT.search(text) or _AT.search(text):
                    base = base_spans(text)
                    own = sorted([(a, k, b, True) for k, a, b in base] +
                                 [(a, k, b, False) for k, a, b in select(text, base, shared.value)])
                values.append([{"kind": KINDS[k], "start": a, "end": b, "certain": c} for a, k, b, c in own])
                if redacted:
                    texts.append(_redacted(text, own))
            arrays = [batch.column(k) for k in range(len(kept))] + [pa.array(values, kind_type)]
            if redacted:
                arrays.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
            del values, texts, arrays
            release_memory()

    return docs.select(*kept, F.col("text").alias(text_name)).mapInArrow(spans, schema)


def _redacted(text: str, own: list[tuple]) -> str:
    out, at = [], 0
    for a, k, b, _ in own:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def query(spark, sf_dir: str) -> DataFrame:
    """op12: personal data of every document; counts and the checksum are of the certain spans."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = find(docs, train(docs)).drop("text")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    certain = F.filter("spans", lambda s: s["certain"])

    def number(kind):
        return F.size(F.filter(certain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, KINDS),
                        F.sha2(listed(certain), 256).alias("base_sha256"), listed("spans").alias("spans"))
