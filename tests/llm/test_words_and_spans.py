"""Operators on words and spans of texts against brute force and on edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelforge.llm import collocations, pii, variants
from labelforge.llm.common import read

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, word string, n int, block int, phrase string"


def docs_of(spark, rows):
    """Documents with columns whose names the operators use as well."""
    return spark.createDataFrame([(i, t, g, "w", 9, 1, "p") for i, t, g in rows], DOCS)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- spelling variants
def slow_variants(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    letters = sorted(set("".join(words)))
    near = {}
    for w in words:
        edits = {w[:k] + c + w[k + cut:] for k in range(len(w) + 1) for c in [*letters, ""]
                 for cut in (0, 1) if k + cut <= len(w)}
        near[w] = [x for x in edits - {w} if x in words]
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def variant_texts(seed, n):
    """Words that are edits of one another, with counts that make chains of forms."""
    rnd = random.Random(seed)
    letters = "abcéÉßz"
    words = ["".join(rnd.choices(letters, k=rnd.randrange(6, 10))) for _ in range(30)]
    for w in words[:20]:
        for _ in range(6):
            k, c = rnd.randrange(len(w)), rnd.choice(letters)
            words.append(rnd.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:], w[::-1]]))
            w = words[-1]
    rows = []
    for k in range(n):
        some = rnd.choices(words, weights=[1 / (i % 37 + 1) ** 2 for i in range(len(words))], k=60)
        rows.append((k, rnd.choice([" ", ", ", "-", "1"]).join(w.upper() if rnd.random() < .1 and w.isascii() else w
                                                              for w in some)))
    return rows


def test_variants_equal_all_pairs(spark):
    rows = variant_texts(3, 60) + [(None, "abcabc abcabc " * 4), (5, "abcabd " * 7), (5, "abcabd " * 7),
                                     (6, "rstuvwx " * 150 + "rstuvwy " * 30 + "rstuzwy " * 6)]
    got = tuples(variants.spelling_variants(docs_of(spark, [(i, t, "en") for i, t in rows])))
    want = slow_variants(rows)
    assert got == want
    assert any(r[1] is not None and r[1] != r[2] for r in want)


@pytest.mark.parametrize("classes, chunk, task_rows", [(1, 7, 50), (3, 4, 1000), (6, 1 << 15, 10)])
def test_blocks_that_are_cut_lose_no_pair(spark, classes, chunk, task_rows):
    rnd = random.Random(classes)
    words = {"".join(rnd.choices("abcdÿ", k=rnd.choice([6, 6, 7, 8]))) for _ in range(150)}
    frame = spark.createDataFrame([(w, rnd.randrange(5, 99)) for w in words], "word string, n long")
    got = {r["word"]: r["n_near"] for r in variants.near_words(frame, classes, chunk, task_rows).collect()}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    want = {w: n for w in words if (n := sum(near(w, x) for x in words))}
    assert got == want


def test_variants_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b c 123"), (4, " ".join(["abcdef"] * 20)), (5, "x" * 70 + " " + "y" * 70)]
    assert tuples(variants.spelling_variants(docs_of(spark, [(i, t, None) for i, t in rows]))) == slow_variants(rows)
    long = "x" * 100_000  # documents 0 and 1 delete nothing of these words
    rows = [(k, f"{long} {long[:-1]} {long[:-2]} " * 5, None) for k in (0, 1)]
    got = {len(r[0]): r[3:5] for r in tuples(variants.spelling_variants(docs_of(spark, rows)))}
    assert got == {100_000: (10, 1), 99_999: (10, 2), 99_998: (10, 1)}
    empty = docs_of(spark, rows=[(1, "abcdef " * 9, "en")]).where("false")
    assert variants.spelling_variants(empty).collect() == []


def test_variants_of_a_given_table(spark):
    rows = [tuple(r) for r in read(spark, SF, "documents", "doc_id", "text").collect()]
    assert tuples(variants.query(spark, SF)) == slow_variants(rows)


def test_runs_of_a_long_text_are_whole(monkeypatch):
    monkeypatch.setattr(variants, "STRETCH", 10)
    text = "abcdefghijklmnop, qrstuv wxyzabc é" * 3
    assert [w for found in variants.runs(text) for w in found] == re.findall("[A-Za-zÀ-ÿ]{6,}", text)


# ---------------------------------------------------------------- collocations
def slow_collocations(rows, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    kept = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= 10:
            cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            if not any(x[0] == lang and len(x[1]) == 3 and w in (x[1][:2], x[1][1:]) and b >= 10 and 100 * b >= 50 * a
                       for x, b in (f.items() if len(w) == 2 else ())):
                kept.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(((g, k + 1, p.decode(), -a, left, right, n[g], -s) for g, own in kept.items()
                   for k, (s, a, p, left, right) in enumerate(sorted(own)[:top])), key=repr)


def phrase_texts(seed, n):
    rnd = random.Random(seed)
    words = "a b c of The the É x\u00a0y z- #".split(" ")
    rows = []
    for k in range(n):
        text = "".join(rnd.choices(words, weights=range(len(words), 0, -1))[0] +
                       rnd.choices([" ", "\t ", ", ", ".", "\n", "?", "\x0b"], [60, 5, 3, 2, 1, 1, 1])[0]
                       for _ in range(rnd.randrange(60)))
        rows.append((k, text, rnd.choice(["en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20), (700, 300)])
def test_collocations_equal_plain_counting(spark, sizes):
    rows = phrase_texts(1, 90) + [(1, None, "en"), (2, "", "fr"), (3, " \t.,", "de"), (4, "lone", None),
                                  (5, "very long " * 9000, "fr"), (5, "very long " * 9000, "fr")]
    got = tuples(collocations.collocations(docs_of(spark, rows), 40, *sizes))
    assert got == slow_collocations(rows, 40)


def test_colliding_fingerprints_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PRIMES", (5, 7))
    rows = phrase_texts(2, 60)
    frame = docs_of(spark, rows)
    texts = frame.select("text", "lang").toArrow()
    block = collocations.Block(texts.column(0), texts.column(1))
    at = block.starts(2)
    pairs = {(block.lang[k], *block.codes[k:k + 2]) for k in at.tolist()}
    assert len(set(block.fingerprints(at, 2).tolist())) < len(pairs)
    assert tuples(collocations.collocations(frame, block_bytes=900)) == slow_collocations(rows)


def test_collocations_of_rows_in_a_new_order_at_each_reading(spark):
    rows = phrase_texts(3, 120)

    def mixed(it):
        for batch in it:
            yield batch.take(np.random.default_rng().permutation(batch.num_rows))
    frame = docs_of(spark, rows).coalesce(1)
    unsteady = frame.mapInArrow(mixed, frame.schema)
    assert tuples(collocations.collocations(unsteady, 40, 700, 300)) == slow_collocations(rows, 40)


def test_places_of_a_block_do_not_depend_on_the_order_of_arrival():
    rows = phrase_texts(5, 50)
    table = pa.table({"text": [t for _, t, _ in rows], "lang": pa.array([g for _, _, g in rows], pa.string()),
                      "row": list(range(50)), "block": pa.array([0] * 50, pa.int32())})
    other = table.take(np.random.default_rng(1).permutation(50))
    sent = collocations._send_short(3)
    assert sent(table).equals(sent(other))
    short = pa.table({"block": pa.array([0], pa.int32()),
                      "places": pa.array([np.concatenate([np.frombuffer(x, np.uint32) for x in
                                                          sent(table).column("places").to_pylist()]).tobytes()])})
    triples = collocations._send_triples(3)
    assert triples(table, short).num_rows and triples(table, short).equals(triples(other, short))


def frequent_words(rows):
    """A block of ``rows`` and the places of its words, pairs and triples."""
    block = collocations.Block(pa.chunked_array([pa.array([t for _, t, _ in rows], pa.string())]),
                               pa.chunked_array([pa.array([g for _, _, g in rows], pa.string())]))
    return block, {width: block.starts(width) for width in (1, 2, 3)}


def test_numbers_on_the_way_to_a_shard_are_a_byte_however_frequent_a_word():
    block, found = frequent_words([(1, "often " * 3000 + "seldom", "en")])
    sent = collocations._sent(0, *collocations._entries(block.fingerprints(found[1], 1), found[1]), 1)
    assert len(sent.column("ns")[0].as_py()) == 2
    again = pa.concat_tables([sent] * 2)
    assert sorted(len(x) for x in collocations._frequent(again).column("places").to_pylist()) == [4, 4]


def test_texts_reach_the_shards_packed_and_are_summed_exactly():
    rows = [(k, t, g) for k, t, g in phrase_texts(6, 400)] + [(1, "so often " * 400, "en"), (2, "\n.", "de")]
    sent, plain, want, n = [], 0, Counter(), Counter()
    for part in (rows[::2], rows[1::2], rows[1::2]):
        block, found = frequent_words(part)
        sent.append(collocations._packed(block, found, 3))
        assert sent[-1].num_rows <= 3 * len(block.langs)
        for width, at in found.items():
            lang, _, text, numbers = block.phrases(at, width)
            for g, t, k in zip(lang.tolist(), text.to_pylist(), numbers.tolist()):
                plain += len(t) + 8
                want[block.langs[g], width, t.decode()] += k
        n.update(block.langs[g] for g in block.lang.tolist())
        n.update({g: 0 for g in block.langs})
    table = pa.concat_tables(sent)
    assert 3 * sum(len(x) for c in ("phrases", "ns") for x in table.column(c).to_pylist()) < plain
    got = {}
    for shard in set(table.column("shard").to_pylist()):
        one = collocations._summed(table.filter(pa.array([x == shard for x in table.column("shard").to_pylist()])))
        got.update({(r["lang"], r["width"], r["phrase"]): r["n"] for r in one.to_pylist()})
    assert got == {k: v for k, v in want.items() if v >= 10} | {(g, 0, ""): k for g, k in n.items()}


def test_numbers_are_looked_up_without_repeating_them_and_texts_do_not_stay(spark):
    frame = docs_of(spark, phrase_texts(7, 60))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = collocations.collocations(frame)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in plan and "salt" not in plan and "SortMergeJoin" in plan
    files = collocations.phrase_counts(frame).inputFiles()
    root = Path(files[0].removeprefix("file:")).parents[1]
    assert not [p for k in ("texts", "short", "long") for p in root.glob(f"collocations-{k}-*")]


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(docs_of(spark, phrase_texts(1, 2)).where("false")).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10**12 + 7, 10**12 + 9, 10**12 + 11), (99_999_999_999_999, 99_999_999_999_999, 99_999_999_999_999), (10, 33, 10)]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    got = {r["a"]: r["s"] for r in frame.select("a", collocations.score_column().alias("s")).collect()}
    assert got == {a: 10**6 * a * a // (l * r) for a, l, r in rows}  # noqa: E741


# ---------------------------------------------------------------- personal data
def slow_base(text):
    out = []
    for kind, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                                    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2:
                doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_certain_spans_equal_their_patterns():
    rnd, n = random.Random(4), 0
    for _ in range(30_000):
        text = "".join(rnd.choices(rnd.choice(["a@.-1 ", "12.+() -", "0123456789 -", "1.25", "+1 .()-23a@é"]),
                                   k=rnd.randrange(60)))
        want = slow_base(text)
        assert pii.base_spans(text) == want, text
        n += len(want)
    assert n > 2000


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1(" * 100_000, "1 " * 150_000,
                                  "a@" * 150_000, " at " * 80_000, "a@a." * 80_000])
def test_very_long_texts_take_one_pass(text):
    assert pii.base_spans(text) is not None
    assert sum(1 for _ in pii.proposals(text)) < 20 * len(text)


def personal_texts(n):
    rnd = random.Random(9)

    def digits(k):
        return "".join(rnd.choices("0123456789", k=k))

    def card():
        start = digits(15)
        return next(c for d in "0123456789" if pii.luhn(c := start + d))
    makers = [lambda: f"{rnd.choice(['ann', 'bo.li'])}{digits(2)}@mail{digits(1)}.example.com", card,
              lambda: ".".join(str(rnd.randrange(256)) for _ in range(4)),
              lambda: f"+{rnd.choice([1, 44])} ({digits(3)}) {digits(3)}-{digits(4)}", lambda: digits(16),
              lambda: f"v{digits(1)}.{digits(1)}.{digits(1)}", lambda: f"x{digits(18)}f", lambda: "and so on, at that"]
    rows = []
    for k in range(n):
        parts = [rnd.choice(makers)() if rnd.random() < .4 else "of the" for _ in range(rnd.randrange(12))]
        rows.append((k, " ".join(parts), None))
    return rows


@pytest.fixture(scope="module")
def personal(spark):
    docs = docs_of(spark, personal_texts(400))
    return docs, pii.train(docs)


def test_boosted_trees_judge_what_they_did_not_learn_from(personal):
    _, model = personal
    for precision, recall, _ in model["held_out"].values():
        assert precision >= 0.95 and recall >= 0.8
    cases = {"call (017) 555-7713 today": ["(017) 555-7713"],
             "of the +1 (826) 555-4081 190.137.223.204 of": ["+1 (826) 555-4081"],
             "version 4.0 of 2020-2021, 555-7713": [], "at that point in time": [],
             "deadbeef12345678901234567890": []}
    for text, want in cases.items():
        added = pii.select(text, pii.base_spans(text), model)
        assert [text[a:b] for _, a, b in added] == want, text


def test_certain_spans_stay_and_others_are_apart(spark, personal):
    docs, model = personal
    for r in pii.find(docs, model, redacted="clean").collect():
        text = r["text"]
        certain = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["certain"]]
        assert certain == [(pii.KINDS[k], a, b) for k, a, b in slow_base(text)]
        for s in r["spans"]:
            if not s["certain"]:
                assert not any(s["start"] < b and a < s["end"] for _, a, b in certain)
        for s in r["spans"]:
            assert text[s["start"]:s["end"]] not in r["clean"]


def test_margin_of_trees_is_that_of_the_library(spark, personal):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors
    rnd = np.random.default_rng(1)
    x = rnd.random((300, 4))
    y = ((x[:, 0] > .5) ^ (x[:, 1] > .3)).astype(float)
    frame = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["v", "y"])
    model = GBTClassifier(featuresCol="v", labelCol="y", maxIter=5, maxDepth=pii.DEPTH, seed=1).fit(frame)
    want = [r["rawPrediction"][1] for r in model.transform(frame).collect()]
    assert np.allclose(pii.margin(pii._trees(model), x), want)


def test_isotonic_steps_ascend():
    least, p = pii.isotonic(np.array([1., 2, 2, 3, 4, 5]), np.array([0., 1, 0, 0, 1, 1]))
    assert least.tolist() == [1, 2, 4] and np.allclose(p, [0, 1 / 3, 1])


def test_isotonic_of_numbers_is_that_of_single_spans():
    rnd = np.random.default_rng(3)
    score, n = np.arange(40.), rnd.integers(1, 9, 40)
    y = rnd.binomial(n, np.linspace(0, 1, 40))
    single = np.concatenate([[1.] * b + [0.] * (a - b) for a, b in zip(n, y)])
    for got, want in zip(pii.isotonic(score, y, n), pii.isotonic(np.repeat(score, n), single)):
        assert np.allclose(got, want)


def test_every_labelled_span_is_learned_from(spark):
    rnd = random.Random(2)
    rows = [(k, " and ".join([".".join(str(rnd.randrange(256)) for _ in range(4)) for _ in range(120)] +
                             [f"x{rnd.randrange(10**13, 10**14)}"] * 3), None) for k in range(300)]
    docs = docs_of(spark, rows)
    labelled = pii._labelled(docs).toPandas()
    assert ((labelled["kind"] == pii.IP) & (labelled["label"] == 1)).sum() == 36_000
    halves = {r["half"]: r["n"] for r in pii._labelled(docs).where(f"kind = {pii.IP}").selectExpr(
        "pmod(xxhash64(mark, 1), 2) AS half").groupBy("half").agg(F.count("*").alias("n")).collect()}
    assert pii.train(docs)["held_out"]["ip"][2] == halves[1]


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", None), (3, "no numbers", "en"), (3, "no numbers", "en"), (None, "x 1.2.3.4é", "de"),
            (4, "é a@b.cd " + "word " * 60_000, "fr")]
    docs = docs_of(spark, rows).withColumnRenamed("phrase", "_text").withColumnRenamed("word", "spans")
    assert pii.train(docs.where("doc_id < 4")) is None
    got = {(r["doc_id"], r["text"]): [tuple(s) for s in r["spans"]] for r in pii.find(docs, None).collect()}
    assert got[1, None] == got[2, ""] == got[3, "no numbers"] == []
    assert got[None, "x 1.2.3.4é"] == [("ip", 2, 9, True)] and got[4, rows[5][1]] == [("email", 2, 8, True)]
    assert pii.find(docs.where("false"), None).collect() == [] and pii.train(docs.where("false")) is None


def test_personal_data_of_a_given_table(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in read(spark, SF, "documents", "doc_id", "text").collect()}
    rows = pii.query(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = slow_base(texts[r["doc_id"]])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in range(4)]
        assert set(listed.split(",")) <= set(r["spans"].split(","))
