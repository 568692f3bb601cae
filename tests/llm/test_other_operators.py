"""Tool calls, nearest neighbours and the pipeline."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelforge.llm import chat, neighbours, packing, queries, simhash, toxicity
from labelforge.llm.common import written

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- tool calls
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, level int"


def test_calls_are_linked_ordered_and_validated(spark):
    ok = '{"query": "x", "limit": 3}'
    rows = [(1, 0, "a", "search", ok, [], 5), (1, 0, "b", "search", ok, ["a"], 5), (1, 0, "c", "search", ok, ["a", "b"], 5),
            (1, 0, "d", "search", ok, ["nowhere", "z"], 5), (1, 1, "z", "lookup", '{"query": "q", "limit": 3}', ["c"], 5),
            (1, 2, "p", "search", ok, ["q"], 5), (1, 2, "q", "search", ok, ["p"], 5), (1, 2, "r", "search", ok, ["q"], 5),
            (2, 0, "a", "search", "not json", None, 5), (2, 0, "a", "search", "not json", None, 5),
            (2, 0, "e", "nobody", "{}", [], 5), (2, 0, "f", "search", '{"limit": 50, "x": 1, "x": 2}', [], 5),
            (2, 0, "g", "search", '{"limit": 50, "other": 1.0}', [], 5), (2, 0, "h", "translate", None, [], 5),
            (None, 0, "a", "search", ok, [], 5), (3, 0, None, "search", ok, [], 5)]
    calls = spark.createDataFrame(rows, CALLS)
    results = spark.createDataFrame([(1, "a", "r2", 1), (1, "a", "r1", 1), (2, "a", None, 1), (2, "zz", "lost", 1),
                                     (None, "a", "x", 1)], "conv_id long, call_id string, content string, turn int")
    every = chat.link_tool_calls(calls, results, chat.SCHEMAS).collect()
    got = {(r["conv_id"], r["call_id"]): r for r in every if r["status"] != "duplicate"}
    assert len(got) == 14
    again = sorted((r["conv_id"], r["call_id"], r["name"], r["canonical"]) for r in every if r["status"] == "duplicate"
                   and r["name"] is None)
    assert again == [(1, "a", None, '{"id":"a","result":"r2"}')]
    assert [(r["conv_id"], r["call_id"]) for r in every if r["status"] == "duplicate" and r["name"]] == [(2, "a")]
    assert [got[1, c]["level"] for c in "abcdzpqr"] == [0, 1, 2, 0, 0, None, None, None]
    assert got[1, "d"]["n_missing"] == 2 and got[1, "z"]["n_missing"] == 0
    assert got[1, "a"]["status"] == got[2, "a"]["status"] == "linked" and got[2, "zz"]["status"] == "orphan"
    assert got[1, "b"]["status"] == "unanswered" and got[1, "a"]["valid"]
    assert json.loads(got[1, "a"]["canonical"])["result"] == "r1"
    assert got[1, "a"]["canonical"].startswith('{"arguments":{"limit":3,"query":"x"},"id":"a"')
    assert [got[2, c]["errors"] for c in "aefg"] == [
        "$: no JSON", "$: unknown tool", "$: repeated key", "$.limit: maximum; $.other: unknown; $.query: required"]
    assert got[2, "h"]["errors"] == "$: no JSON" and got[1, "z"]["errors"] == "$.limit: enum"
    none = chat.link_tool_calls(calls.where("false"), results.where("false"), chat.SCHEMAS)
    assert none.count() == 0


def slow_links(calls, results):
    """(conv, turn, id, name, status, result) of every row, call by call."""
    out, made = [], {}
    for c, t, i, n, a, d in sorted(calls, key=lambda r: (r[0], r[1], r[2], r[3], r[4], r[5])):
        if (c, t, i) in made:
            out.append((c, t, i, n, "duplicate", None))
        else:
            made[c, t, i] = [n, None, d]
    for c, i, x, t in sorted(results, key=lambda r: (r[3] is None, r[3] or 0, r[2])):
        turns = [k[1] for k in made if k[0] == c and k[2] == i and (t is None or k[1] <= t)]
        if not turns:
            out.append((c, t, i, None, "orphan", x))
        elif made[c, max(turns), i][1] is None:
            made[c, max(turns), i][1] = x
        else:
            out.append((c, max(turns), i, None, "duplicate", x))
    for (c, t, i), (n, x, d) in made.items():
        missing = {p for p in d if not any(k[0] == c and k[2] == p and k[1] <= t for k in made)}
        out.append((c, t, i, n, "unanswered" if x is None else "linked", x, len(missing)))
    return sorted((r if len(r) > 6 else (*r, 0) for r in out), key=repr)


def test_no_call_and_no_result_is_lost_where_ids_repeat(spark):
    rnd = random.Random(11)
    calls = [(rnd.randrange(3), rnd.randrange(6), f"i{rnd.randrange(4)}", rnd.choice(["search", "lookup"]),
              f'{{"query":"{rnd.randrange(3)}"}}', [f"i{rnd.randrange(5)}"]) for _ in range(70)]
    results = [(rnd.randrange(4), f"i{rnd.randrange(5)}", f"r{rnd.randrange(4)}", rnd.choice([None, 0, 1, 2, 3, 4, 5, 6]))
               for _ in range(60)]
    got = chat.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>"),
        spark.createDataFrame(results, "conv_id long, call_id string, content string, turn long"), chat.SCHEMAS).collect()
    told = sorted(((r["conv_id"], r["turn"], r["call_id"], r["name"], r["status"], json.loads(r["canonical"])["result"],
                    r["n_missing"]) for r in got), key=repr)
    assert told == slow_links(calls, results)
    assert len(got) == len(calls) + len(results) - sum(r["status"] == "linked" for r in got)


def test_schema_keywords_are_checked_or_refused():
    cases = [({"pattern": "^a+$"}, "aa", "ab", "pattern"), ({"const": 1}, 1.0, 2, "const"),
             ({"exclusiveMinimum": 3}, 4, 3, "exclusiveMinimum"), ({"exclusiveMaximum": 3}, 2, 3, "exclusiveMaximum"),
             ({"multipleOf": 0.1}, 0.3, 0.35, "multipleOf"), ({"uniqueItems": True}, [1, "1"], [1, 1.0], "uniqueItems"),
             ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, 7, 3, "anyOf"), ({"not": {"type": "null"}}, 1, None, "not"),
             ({"oneOf": [{"minimum": 1}, {"maximum": 3}]}, 0, 2, "oneOf"), ({"maxProperties": 1}, {"a": 1}, {"a": 1, "b": 2},
                                                                            "maxProperties"),
             ({"additionalProperties": {"type": "string"}}, {"a": "x"}, {"a": 1}, "type"),
             ({"allOf": [{"minimum": 2}, {"maximum": 4}]}, 3, 5, "maximum")]
    for schema, good, bad, what in cases:
        chat.check_schema(schema)
        assert chat.violations(good, schema) == []
        assert len(found := chat.violations(bad, schema)) == 1 and found[0].endswith(what)
    for schema in ({"$ref": "#/x"}, {"properties": {"a": {"patternProperties": {}}}}, {"anyOf": [{"format": "date"}]}):
        with pytest.raises(ValueError, match="not supported"):
            chat.check_schema(schema)


def slow_levels(edges, nodes):
    level = dict.fromkeys(nodes)
    for _ in nodes:
        for n in nodes:
            parents = [level[p] for c, p in edges if c == n]
            if level[n] is None and None not in parents:
                level[n] = max(parents, default=-1) + 1
    return level


def test_levels_equal_longest_paths(spark):
    rnd = random.Random(8)
    nodes = [f"n{k}" for k in range(40)]
    edges = sorted({(nodes[b], nodes[rnd.randrange(b)]) for b in range(1, 40) for _ in range(2)} | {("n3", "n5"), ("n5", "n3")})
    calls = spark.createDataFrame([(1, 0, n) for n in nodes], "conv_id long, turn long, call_id string")
    depends = spark.createDataFrame([(1, 0, c, p) for c, p in edges], "conv_id long, turn long, call_id string, parent string")
    got = {r["call_id"]: r["level"] for r in chat.levels(calls, depends).collect()}
    assert got == slow_levels(edges, nodes)


def test_canonical_json():
    assert chat.canonical({"b": [1.0, 1.5, 1e30, 1e-7, -0.0], "a": {"z": None, "\u00e9": True}}) == \
        '{"a":{"z":null,"\u00e9":true},"b":[1,1.5,1e+30,1e-7,0]}'
    for text in ("[NaN]", "{", '{"a":1,"a":2}', ""):
        with pytest.raises(chat.BadJson):
            chat.parse(text)


def test_tool_query_covers_every_assistant_sentence(spark):
    said = spark.read.parquet(f"{SF}/conversations.parquet").where("role = 'assistant'")
    n = said.select(F.explode(F.filter(F.split("text", "[.\\n]\\s*"), lambda s: s != ""))).count()
    got = chat.query(spark, SF)
    assert got.where("status <> 'orphan'").count() == n
    assert got.where("level is null and status <> 'orphan'").count() == 0


# ---------------------------------------------------------------- neighbours
def slow_nearest(rows, top):
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            scored = sorted((-float((np.array(x, float) * np.array(y, float)).sum()), v) for v, y in rows if v != q)
            out[q] = [(v, -s) for s, v in scored[:top]]
    return out


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, vid int, score int")


def test_neighbours_of_few_vectors_are_exact_with_ties_and_copies(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.integers(-3, 4, 6).astype(float).tolist() or [1.0]) for i in range(60)]
    rows = [(i, v if any(v) else [1.0] * 6) for i, v in rows]
    rows += [(100 + i, [2.0, 1.0, 0.0, 0.0, 0.0, 1.0]) for i in range(45)]  # one common vector
    bad = [(200, None), (220, [0.0] * 6), (240, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (260, [float("nan")] * 6),
           (280, [float("inf")] * 6), (300, [1.0]), (None, [1.0] * 6), (320, [])]
    got = neighbours.nearest(vectors_of(spark, rows + bad + rows[:1]), F.col("vec_id") % 20 == 0).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found == slow_nearest(rows, 20)
    few = neighbours.nearest(vectors_of(spark, rows[:3]), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]
    assert neighbours.nearest(vectors_of(spark, bad), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(vectors_of(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(vectors_of(spark, rows[:1]), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_over_many_lists(spark):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(4000, 24)) * rnd.uniform(0.5, 2, (4000, 1))  # norms differ
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    got = neighbours.nearest(vectors_of(spark, rows), F.col("vec_id") % 20 == 0).collect()
    y = np.array([v for _, v in rows], np.float64)
    hit = 0
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert abs(r["score"] - float((y[r["query_id"]] * y[r["vec_id"]]).sum())) < 1e-12
    for q in range(0, 4000, 20):
        s = y @ y[q]
        s[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-s)[:20].tolist()))
        assert len(found[q]) == 20
    assert hit / (200 * 20) >= 0.9


def test_graph_search_finds_the_nearest_centroids():
    rnd = np.random.default_rng(6)
    c = neighbours.balanced_centroids(rnd.normal(size=(3000, 8)), 200)
    graph, starts = neighbours.neighbour_graph(c)
    x = rnd.normal(size=(100, 8))
    ids, d = neighbours.search_graph(x, c, graph, starts, 20)
    true = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (ids[:, 0] == true.argmin(axis=1)).mean() > 0.97
    assert np.allclose(d, np.take_along_axis(true, ids, 1))


def test_recall_of_the_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    y = np.array([r["embedding"] for r in rows], np.float64)
    ids = np.array([r["vec_id"] for r in rows])
    found = {}
    for r in neighbours.query(spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = n = 0
    for k in np.flatnonzero(ids % 20 == 0):
        s = y @ y[k]
        s[k] = -np.inf
        hit, n = hit + len(found[ids[k]] & set(ids[np.argsort(-s)[:20]].tolist())), n + 20
    assert hit / n >= 0.9


# ---------------------------------------------------------------- pipeline
def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        seen[name] = docs
    assert [n for n, _ in corpus_pipeline.STAGES] == \
        ["toxicity", "simhash_near_dedup", "decontamination", "secret_scan", "packing"]
    before = list(seen.values())
    for a, b in zip(before[:-2], before[1:-1]):
        assert a.columns == b.columns and 0 < b.count() <= a.count()
    # near duplicates against brute force: one, the smallest id, of each group
    ids = {r["doc_id"]: simhash.fingerprint(r["text"].encode()) for r in seen["toxicity"].collect()}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in ids:
        for j in ids:
            if i < j and (ids[i] ^ ids[j]).bit_count() <= 4 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert sorted(r["doc_id"] for r in seen["simhash_near_dedup"].collect()) == sorted(i for i in ids if find(i) == i)
    assert seen["secret_scan"].count() == seen["decontamination"].count()
    total = seen["packing"].agg(F.sum("length")).first()[0]
    used = seen["packing"].select("sequence_id").distinct().count()
    assert used <= 1.02 * -(-total // packing.SEQUENCE_TOKENS) + 1
    assert corpus_pipeline.run(spark, SF).count() == seen["packing"].count()


def test_stages_on_odd_rows_and_clashing_columns(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long, _toxicity int, _benchmark int, fp int, _secrets int"
    rows = [(1, None, None, None, None, 1, 2, 3, 4), (2, "", "en", "s", 0, 1, 2, 3, 4), (2, "", "en", "s", 0, 1, 2, 3, 4),
            (None, "a few words here", "en", "s", 0, 1, 2, 3, 4), (4, "token = \"" + "ab1" * 13 + "\" x", "en", "s", 0, 1, 2, 3, 4)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, columns)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, docs, SF), name)
            assert out.columns == docs.columns
            docs = out
        assert docs.count() == (3 if data else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_every_operator_has_one_query():
    import re
    numbers = sorted(int(re.match(r"op([0-9]+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES) and toxicity.TRAIN_TOXIC > 0
