"""Tool calls: links, order, schemas and canonical JSON."""

import json
import random

from rowrelay.llm import toolcalls

SCHEMAS = {
    "get": {"properties": {"a": {"type": "integer"}, "b": {"type": "string"}, "c": {"type": "array"}, "d": {"type": "number"}, "e": {"type": "boolean"}, "f": {"type": "object"}, "g": {}}, "required": ["a"]},
    "none": {},
}


def calls(spark, rows):
    return spark.createDataFrame(rows, "conv string, id string, after string, name string, arguments string, level string")


def results(spark, rows):
    return spark.createDataFrame(rows, "conv string, id string, content string, n_results string")


def test_order_against_plain_search(spark):
    rng = random.Random(6)
    rows = []
    for conv in "pqr":
        for i in range(60):
            rows.append((conv, f"i{i}", rng.choice([None, "gone", f"i{rng.randrange(60)}", f"i{max(0, i - 1)}", f"i{i + 1}"]), "get", "{}", ""))
    rows += [("long", f"{i}", f"{i - 1}", "get", "{}", "") for i in range(300)]
    after = {(c, i): a for c, i, a, *_ in rows}

    def level(conv, node):
        seen = set()
        while (conv, node) in after:
            if node in seen:
                return None
            seen.add(node)
            node = after[conv, node]
        return len(seen) - 1

    found = toolcalls.ordered(calls(spark, rows).select("conv", "id", "after")).collect()
    assert {(r.conv, r.id): (r.level, r.cyclic) for r in found} == {k: (level(*k), level(*k) is None) for k in after}


def test_faults(spark):
    cases = {
        '{"a":1}': "", '{"b":"x"}': "missing a", '{"a":"1"}': "type of a", '{"a":1.5}': "type of a", '{"a":null}': "type of a",
        '{"a":1,"b":"s","c":[1],"d":1.5,"e":true,"f":{"x":1},"g":null}': "", '{"a":1,"d":2,"z":0}': "unknown z",
        '{"a":1,"b":1,"c":{},"e":"t","f":[]}': "type of b; type of c; type of e; type of f", "[1]": "no object", "oops": "no object", "": "no object",
    }
    rows = [("c", str(i), None, "get", text, "") for i, text in enumerate(cases)] + [("c", "n", None, "get", None, ""), ("c", "u", None, "other", "{}", ""), ("c", "0n", None, "none", "{}", ""), ("c", "1n", None, "none", '{"q":1}', ""), ("c", "x", None, None, "{}", "")]
    found = {r.id: r for r in toolcalls.linked(calls(spark, rows), results(spark, []), SCHEMAS).collect()}
    assert {text: found[str(i)].faults for i, text in enumerate(cases)} == cases
    assert [found[k].faults for k in ("n", "u", "0n", "1n", "x")] == ["no object", "unknown tool", "", "unknown q", "unknown tool"]
    assert all(r.valid == (r.faults == "") and r.status == "unanswered" for r in found.values())


def test_links_and_json(spark):
    rows = [("c", "1", None, "get", '{"b":"é \\" /","a": 1, "c":[3, {"y":1,"x":2}]}', ""), ("c", "2", "1", "get", "bad", ""), ("c", "2", "1", "get", "bad", ""), (None, "1", "1", "get", '{"a":2}', ""), ("c", None, None, "get", '{"a":2}', "")]
    answers = [("c", "1", "later", ""), ("c", "1", "first", ""), ("c", "9", None, ""), (None, "1", "null's", ""), ("c", None, "lost", ""), ("d", "1", "other", "")]
    found = sorted(((r.conv or "", r.id or "", r.status, r.level, r.n_results, r.json) for r in toolcalls.linked(calls(spark, rows), results(spark, answers), SCHEMAS).collect()), key=str)
    assert [x[:5] for x in found] == sorted([("c", "1", "linked", 0, 2), ("c", "2", "unanswered", 1, 0), ("c", "2", "unanswered", 1, 0), ("", "1", "linked", None, 1), ("c", "", "unanswered", None, 0), ("c", "9", "orphan", None, 1), ("d", "1", "orphan", None, 1)], key=str)
    texts = {x[:3]: x[5] for x in found}
    assert texts["c", "1", "linked"] == '{"after":null,"arguments":{"a":1,"b":"é \\" /","c":[3,{"x":2,"y":1}]},"conversation":"c","id":"1","level":0,"name":"get","result":"first"}'
    assert json.loads(texts["c", "2", "unanswered"])["arguments"] == "bad"
    none = toolcalls.linked(calls(spark, []), results(spark, []), SCHEMAS)
    assert none.count() == 0


def test_long_texts(spark):
    text = json.dumps({"a": 1, "b": "x" * 300_000})
    row = toolcalls.linked(calls(spark, [("c", "1", "1", "get", text, "")]), results(spark, [("c", "1", "y" * 300_000, "")]), SCHEMAS).first()
    assert (row.cyclic, row.valid, len(row.json) > 600_000) == (True, False, True)


def test_a_call_behind_all_it_waits_for(spark):
    """Random graphs against a plain search of longest paths; cycles through any edge are seen."""
    rng = random.Random(9)
    after = {("d", "z"): ["a", "d"], ("d", "a"): [], ("d", "b"): None, ("d", "c"): ["b"], ("d", "d"): ["c", None, "gone"], ("d", "late"): ["z"]}
    for conv in "pq":  # few cycles
        for i in range(80):
            after[conv, f"{i}"] = [f"{rng.randrange(i) if i and rng.random() < 0.98 else rng.randrange(80)}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))]
    for i in range(120):  # a long chain with a joint at every tenth call
        after["long", f"{i}"] = [f"{i - 1}"] + ([f"{i - 7}"] if i % 10 == 9 else [])

    def levels(conv):
        own = {i: {u for u in ups or () if (conv, u) in after} for (c, i), ups in after.items() if c == conv}
        found = {}
        while ready := [i for i in own if i not in found and own[i] <= found.keys()]:
            found |= {i: max((found[u] + 1 for u in own[i]), default=0) for i in ready}
        return {(conv, i): found.get(i) for i in own}

    wanted = {k: v for conv in ("d", "p", "q", "long") for k, v in levels(conv).items()}
    assert wanted["d", "z"] == 3 and wanted["long", "119"] == 119 and None in wanted.values()
    given = spark.createDataFrame([(c, i, a) for (c, i), a in after.items()], "conv string, id string, after array<string>")
    found = {(r.conv, r.id): (r.level, r.cyclic) for r in toolcalls.ordered(given).collect()}
    assert found == {k: (v, v is None) for k, v in wanted.items()}


def test_rows_of_an_id_wait_together(spark):
    rows = [("c", "x", None, "get", '{"a":1}', ""), ("c", "y", "x", "get", '{"a":1}', ""), ("c", "w", None, "get", '{"a":1}', ""), ("c", "z", "w", "get", '{"a":1}', ""), ("c", "z", "y", "get", '{"a":1}', "")]
    found = toolcalls.linked(calls(spark, rows), results(spark, []), SCHEMAS).collect()
    assert sorted((r.id, r.level, json.loads(r.json)["after"]) for r in found if r.id == "z") == [("z", 2, "w"), ("z", 2, "y")]
    many = spark.createDataFrame([("c", "z", ["w", "y"], "get", '{"a":1}'), ("c", "w", [], "get", "{}"), ("c", "y", None, "get", "{}")], "conv string, id string, after array<string>, name string, arguments string")
    found = {r.id: r for r in toolcalls.linked(many, results(spark, []), SCHEMAS).collect()}
    assert found["z"].level == 1 and '"after":["w","y"]' in found["z"].json


def test_every_result_has_a_row(spark):
    rows = [("c", "1", None, "get", "{}", ""), (None, "1", None, "get", "{}", "")]
    given = [("c", "1", "b", ""), ("c", "1", "a", ""), ("c", "1", "a", ""), ("c", None, "lost", ""), ("c", "2", None, ""), (None, "1", "n", ""), ("", "1", "e", "")]
    found = sorted(map(tuple, toolcalls.answers(calls(spark, rows), results(spark, given)).collect()), key=str)
    wanted = [("c", "1", "b", "linked"), ("c", "1", "a", "linked"), ("c", "1", "a", "linked"), ("c", None, "lost", "unnamed"), ("c", "2", None, "orphan"), (None, "1", "n", "linked"), ("", "1", "e", "linked")]
    assert found == sorted(wanted, key=str)
    assert toolcalls.answers(calls(spark, []), results(spark, [])).count() == 0
