"""Operator 9: secret scan with a random forest against false positives.

Candidates are words that look like a credential (long with digits or mixed case), and
those of any kind that follow or are assigned to a telling name; the values inside compact
JSON, query strings and URLs are candidates beside the word as a whole.  A random forest decides which are secrets,
from the candidate's length, the shares of transitions between kinds of characters, how much
of it dictionary words cover, path signs, and which words stand beside it (hashed).  It learns from labelled findings; where nobody labelled any,
``rule_labels`` labels those whose format leaves no doubt, so that the forest judges the
rest.  Everything runs as DataFrame expressions and Spark ML in the JVM.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import read, unused, written

# Labelled findings the forest learns from, at most (those with the smallest hashes).
TRAIN_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 17
LEAST_LENGTH = 8
# Names that announce a credential (fixed values).
TELLING = ("(?i:passw(?:or)?d|passwd|pwd|secret|token|api_?key|access_?key|private_?key|(?<![A-Za-z])auth|credential)"
           "[sS]?(?![a-z])")
# Formats that leave no doubt (fixed values): issued credentials, and things that are none.
ISSUED = ("^(AKIA|ASIA)[A-Z0-9]{16}$", "^gh[pousr]_[A-Za-z0-9]{36}$", "^xox[abprs]-[A-Za-z0-9-]{10,}$",
          "^sk_live_[A-Za-z0-9]{16,}$", "^AIza[A-Za-z0-9_-]{35}$")
PLACEHOLDER = "(?i)your|example|changeme|change_me|placeholder|dummy|redacted|x{6,}|(.)\\1{7,}"
HARMLESS = ("^[0-9.,:+()/-]+$", "^[^@ ]+@[^@ ]+\\.[a-z]+$", "^https?://[^@]+$",
            "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", "^v?[0-9]+(\\.[0-9]+)+$")
# Kinds of characters; their transitions are features of their own.
KINDS = "Ul9-"
TRANSITIONS = [f"step_{a}{b}".replace("-", "_") for a in KINDS for b in KINDS]
FEATURES = ["length", "digits", "uppers", "lowers", "signs", "distinct", "hexadecimal", "coverage", "path_signs",
            "at_sign", "telling", "assigned", "word_before", "word_after", *TRANSITIONS]
# Places that the words before and after a candidate are hashed to.
WORD_PLACES = 64
_VALUE = "^[\"'(\\[{<]*(?:([A-Za-z_][A-Za-z0-9_-]*)(?:=|:(?!//)))?[\"']?(.*?)[\"')\\]}>,;.!?#$%&*]*$"
# Assignments inside a word, and the password of a URL.
# A word in quotes is a value as a whole, whatever signs end it.
_QUOTED = "^[(\\[{<]*(?:([A-Za-z_][A-Za-z0-9_-]*)(?:=|:))?([\"'])(.+)\\2[^A-Za-z0-9\"']*$"
# Signs behind an unquoted value may be a part of it: they go with it when it is redacted.
_TAIL = "([!?#$%&*]+)[\"')\\]}>,;.]*$"
_PAIR = "([A-Za-z_][A-Za-z0-9_-]*)[\"']?(?:=>|=|:(?!//))[\"']?([^\"'&,;?{}\\[\\]()<>=]+)"
_LOGIN = "://[^:/@]*:([^@/]+)@"


def _clean(word: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(word, F.lit("")), "[^A-Za-z_]", ""))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per suspicious word: doc_id, word_index (words between
    white space, from 0), value, tail (signs behind it that may be a part of it), name (what it
    is assigned to, else the word before), assigned, before, after.  Null and blank texts have
    none."""
    words = docs.select("doc_id", F.split("text", "\\s+").alias("w"))
    w = F.col("w")
    def parts(x: Column) -> Column:
        pairs = F.transform(F.regexp_extract_all(x, F.lit(_PAIR), F.lit(0)),
                            lambda p: F.regexp_replace(p, _PAIR, "$1=$2"))
        logins = F.transform(F.regexp_extract_all(x, F.lit(_LOGIN), F.lit(1)), lambda p: F.concat(F.lit("password="), p))
        return F.when(x.rlike("[=:]"), F.concat(F.array(x), pairs, logins)).otherwise(F.array(x))

    def seen(x: Column, i: Column) -> Column:
        b, bb = F.coalesce(F.get(w, i - 1), F.lit("")), F.coalesce(F.get(w, i - 2), F.lit(""))
        # not the sign of an assignment itself
        after = x.rlike("[A-Za-z0-9]") & (b.rlike(TELLING) | (b.rlike("^(=|:|:=|=>)$") & bb.rlike(TELLING)))

        def one(y: Column) -> Column:
            told = after | y.rlike(TELLING + "[A-Za-z_]*[=:].")
            fits = told | ((F.length(y) >= LEAST_LENGTH) & (y.rlike("[0-9]") | y.rlike("[a-z][A-Z]")))
            quoted = y.rlike(_QUOTED)
            return F.when(fits, F.struct(
                i.alias("i"), F.regexp_extract(y, _VALUE, 1).alias("own"),
                F.when(quoted, F.regexp_extract(y, _QUOTED, 3)).otherwise(F.regexp_extract(y, _VALUE, 2)).alias("value"),
                F.when(quoted, "").otherwise(F.regexp_extract(y, _TAIL, 1)).alias("tail"), told.alias("told"),
                b.alias("b"), bb.alias("bb"), F.get(w, i + 1).alias("a")))
        return F.array_distinct(F.filter(F.transform(parts(x), one), lambda s: s.isNotNull()))
    found = words.select("doc_id", F.explode(F.flatten(F.transform(w, seen))).alias("c"))
    sign, own = F.col("c.b").rlike("^(=|:|:=|=>)$"), F.col("c.own")
    name = F.when(own != "", F.lower(own)).when(sign, _clean(F.col("c.bb"))).otherwise(_clean(F.col("c.b")))
    return found.select("doc_id", F.col("c.i").alias("word_index"), F.col("c.value").alias("value"), F.col("c.tail").alias("tail"),
                        name.alias("name"), ((own != "") | sign | F.col("c.b").rlike("[A-Za-z0-9_\"'](=|:|:=|=>)$")).alias("assigned"),
                        _clean(F.col("c.b")).alias("before"), _clean(F.col("c.a")).alias("after")) \
        .where((F.length("value") >= LEAST_LENGTH) | (F.col("c.told") & (F.col("value") != "")))


def dictionary(texts: DataFrame, least: int = 2) -> DataFrame:
    """Words of three or more letters that ``texts(text)`` holds at least ``least`` times."""
    return texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word")) \
        .groupBy("word").count().where(F.col("count") >= least).select("word")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The columns in ``FEATURES`` for every candidate."""
    v, n = F.col("value"), F.length("value")
    share = lambda pattern: 1 - F.length(F.regexp_replace(v, pattern, "")) / n
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        v, "[^A-Za-z0-9]", "-"), "[A-Z]", "U"), "[a-z]", "l"), "[0-9]", "9")
    # each pair of neighbours, those at odd places beside those at even ones
    pairs = F.concat_ws(" ", *[F.regexp_replace(F.substring(kinds, at, 1 << 30), "(..)", "$1 ") for at in (1, 2)])
    steps = [(F.size(F.split(pairs, f"(?<=^| ){a}{b} ")) - 1) / F.greatest(n - 1, F.lit(1))
             for a in KINDS for b in KINDS]
    parts = found.select("value").distinct() \
        .select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    cover = parts.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    # one value may be in a third of all findings: the small side is repeated per salt
    salts = 8
    cover = cover.select(F.col("value").alias("_value"), "covered",
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"))
    rows = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "word_index"), F.lit(salts)).cast("int"))
    joined = rows.join(cover, (rows["value"] == cover["_value"]) & (rows["_salt"] == cover["_s"]), "left") \
        .drop("_value", "_salt", "_s")
    flag = lambda c: c.cast("double")
    return joined.select(
        *found.columns, n.cast("double").alias("length"), share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"), share("[a-z]").alias("lowers"),
        share("[^A-Za-z0-9]").alias("signs"), *[x.alias(c) for x, c in zip(steps, TRANSITIONS)],
        (F.size(F.array_distinct(F.split("value", ""))) / n).alias("distinct"),
        flag(v.rlike("^[0-9a-fA-F]+$")).alias("hexadecimal"),
        (F.coalesce("covered", F.lit(0)) / n).alias("coverage"),
        F.length(F.regexp_replace(v, "[^/.\\\\]", "")).cast("double").alias("path_signs"),
        flag(F.instr("value", "@") > 0).alias("at_sign"), flag(F.col("name").rlike(TELLING)).alias("telling"),
        flag(F.col("assigned")).alias("assigned_"), F.length("before").cast("double").alias("word_before"),
        F.length("after").cast("double").alias("word_after"))


def rule_labels(found: DataFrame) -> DataFrame:
    """Labelled findings by format: 1 for issued credentials and long mixed values assigned
    to a telling name, 0 for numbers, addresses, versions and the like; others unlabelled."""
    v = F.col("value")
    any_of = lambda patterns: v.rlike("|".join(f"(?:{p})" for p in patterns))
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.length("value") >= 16)
    return found.withColumn("label", F.when(any_of(ISSUED), 1.0).when(any_of(HARMLESS), 0.0)
                            .when(v.rlike(PLACEHOLDER), 0.0)
                            .when(F.col("name").rlike(TELLING) & F.col("assigned") & mixed, 1.0)) \
        .where(F.col("label").isNotNull())


def forest(labelled: DataFrame, most: int = TRAIN_FINDINGS):
    """A forest fitted on at most ``most`` labelled findings (``FEATURES`` and ``label``), or
    None where they don't hold both labels."""
    columns = [f if f != "assigned" else "assigned_" for f in FEATURES]
    columns += [c for c in ("before", "after") if c in labelled.columns]
    some = labelled.select("label", *columns).distinct() \
        .orderBy(F.xxhash64("label", *columns), *columns).limit(most)
    some = written(some, "labelled-findings")
    if some.select("label").distinct().count() < 2:
        return None
    trees = RandomForestClassifier(labelCol="label", featuresCol="_features", numTrees=TREES,
                                   maxDepth=DEPTH, seed=SEED)
    words = [c for c in ("before", "after") if c in columns]
    hashed = [FeatureHasher(inputCols=words, outputCol="_words", numFeatures=WORD_PLACES)] if words else []
    inputs = [c for c in columns if c not in words] + ["_words"] * bool(words)
    return Pipeline(stages=[*hashed, VectorAssembler(inputCols=inputs, outputCol="_features"), trees]).fit(some)


def held_out_quality(found: DataFrame) -> DataFrame:
    """Precision and recall of a forest on a fifth of the labelled findings ``found`` (``FEATURES``,
    before, after, label) that it does not learn from, split by value: findings, precision, recall."""
    fold = F.pmod(F.xxhash64("value"), F.lit(5))
    model = forest(found.where(fold != 0))
    if model is None:
        return found.sparkSession.createDataFrame([], "findings long, precision double, recall double")
    yes = F.col("prediction") == 1.0
    right = F.sum((yes & (F.col("label") == 1.0)).cast("long"))
    return model.transform(found.where(fold == 0)).agg(
        F.count(F.lit(1)).alias("findings"), (right / F.sum(yes.cast("long"))).alias("precision"),
        (right / F.sum((F.col("label") == 1.0).cast("long"))).alias("recall"))


def scan(docs: DataFrame, words: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of ``docs(doc_id, text)`` with its ``probability`` and ``is_secret``.

    ``labelled``: findings with ``FEATURES`` and ``label`` to learn from; without it those
    of ``docs`` that ``rule_labels`` can label.  Where they hold one label only, the rule
    decides.  Repeated rows are scanned each for themselves, texts of any length as a whole;
    null texts and empty tables give none; other columns are ignored."""
    # the documents are read once: values are looked up in the dictionary from the written candidates
    found = written(with_features(written(candidates(docs), "candidates"), words), "findings")
    model = forest(labelled if labelled is not None else rule_labels(found))
    if model is None:
        known = rule_labels(found).select("value", "name", "assigned", "label").distinct()
        on = ["value", "name", "assigned"]
        return found.join(known, on, "left").withColumn("probability", F.coalesce("label", F.lit(0.0))) \
            .withColumn("is_secret", F.col("probability") >= 0.5)
    scored = model.transform(found)
    return scored.withColumn("probability", vector_to_array("probability")[1]) \
        .withColumn("is_secret", F.col("probability") >= 0.5)


def redact(docs: DataFrame, words: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in a text replaced by ``mark``.  All rows and columns stay;
    null and empty texts stay as they are.  Rows that share a doc_id share its secrets."""
    values, owner = unused("_secrets", docs.columns), unused("_secret_doc", docs.columns)
    bad = scan(docs.select("doc_id", "text"), words).where("is_secret") \
        .select(F.col("doc_id").alias(owner), F.explode(F.array_distinct(F.array(
            F.concat("value", "tail"), "value"))).alias("value")).groupBy(owner) \
        .agg(F.array_sort(F.collect_set("value"), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
                          .when(a < b, -1).when(a > b, 1).otherwise(0)).alias(values))

    def blank(t: Column, s: Column) -> Column:
        """A short value is no part of longer words."""
        quoted = F.concat(F.lit("(?<![A-Za-z0-9])\\Q"), F.replace(s, F.lit("\\E"), F.lit("\\E\\\\E\\Q")),
                          F.lit("\\E(?![A-Za-z0-9])"))
        literal = mark.replace("\\", "\\\\").replace("$", "\\$")
        return F.when(F.length(s) < LEAST_LENGTH, F.regexp_replace(t, quoted, F.lit(literal))) \
            .otherwise(F.replace(t, s, F.lit(mark)))
    joined = docs.join(bad, docs["doc_id"].eqNullSafe(bad[owner]), "left")
    text = F.when(F.col(values).isNull(), docs["text"]).otherwise(F.aggregate(
        values, docs["text"], blank))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op9: every candidate of every document with the forest's verdict (values as hashes)."""
    found = scan(read(spark, sf_dir, "documents", "doc_id", "text"),
                 dictionary(read(spark, sf_dir, "conversations", "text")))
    return found.select("doc_id", F.col("word_index").cast("long").alias("word_index"),
                        F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("long").alias("length"),
                        "name", "probability", "is_secret")
