import json

from ridewise.llm.tool_calls import levels, link_tool_calls

COLS = "thread long, seq long, kind string, id string, parent_id string, call_id string, name string, payload string, level int, status string"
SCHEMA = {"add": {"a": {"type": "integer", "required": True, "minimum": 0, "maximum": 9}, "note": {"type": "string", "maxLength": 5},
                  "mode": {"type": "string", "enum": ["x", "y"]}, "list": {"type": "array"}, "deep": {"type": "object"},
                  "flag": {"type": "boolean"}, "f": {"type": "number"}},
          "it's": {"k'y": {"type": "string", "required": True, "minLength": 1}}}


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "s") for r in rows], COLS)


def linked(spark, rows):
    out = link_tool_calls(table(spark, rows), SCHEMA).collect()
    return {(r.thread, r.seq, r.id): r for r in out}, out


def test_links_and_order(spark):
    rows = [(1, 0, "note", "n", None, None, None, "hello"),
            (1, 1, "call", "a", "n", None, "add", '{"note":"hi","a":1}'),
            (1, 2, "result", "ra", "a", "a", None, "3"),
            (1, 3, "call", "b", "ra", None, "add", '{ "a" : 2 }'),
            (1, 4, "call", "a", "b", None, "add", '{"a":3}'),                # an id used again
            (1, 5, "result", "rx", "b", "a", None, "late"),                  # a second answer
            (1, 6, "result", "ro", None, "zz", None, "nobody asked"),
            (1, 7, "result", "rn", "missing", None, None, None),
            (2, 0, "call", "a", None, None, "add", None),
            (None, 0, "call", "a", None, None, "nope", "{}"),
            (None, 1, "result", "r", "a", "a", None, "null thread"),
            (3, 0, "call", None, None, None, "add", '{"a":1}')]
    got, out = linked(spark, rows)
    st = {k: r.status for k, r in got.items()}
    assert st == {(1, 1, "a"): "linked", (1, 3, "b"): "unanswered", (1, 4, "a"): "duplicate", (1, 5, "rx"): "extra",
                  (1, 6, "ro"): "orphan", (1, 7, "rn"): "orphan", (2, 0, "a"): "unanswered", (None, 0, "a"): "linked",
                  (3, 0, None): "unanswered"}
    assert got[(1, 1, "a")].record == ('{"arguments":{"a":1,"note":"hi"},"content":"3","id":"a","name":"add","result_seq":2,'
                                       '"seq":1,"status":"linked"}')
    assert [got[k].level for k in ((1, 1, "a"), (1, 3, "b"), (1, 5, "rx"), (1, 6, "ro"), (2, 0, "a"))] == [1, 3, 4, 0, 0]
    order = [(r.thread, r.level) for r in out if r.thread == 1 and r.level is not None]
    assert order == sorted(order)
    assert all(json.loads(r.record) for r in out)
    assert got[(None, 0, "a")].errors == ["unknown tool"] and got[(2, 0, "a")].errors == ["not an object"]
    assert got[(1, 6, "ro")].valid is None


def test_validation(spark):
    cases = {'{"a":1}': [], '{"a":1.0}': [], '{"a":10}': ["large a"], '{"a":-1}': ["small a"], '{"a":"1"}': ["type a"], "{}": ["missing a"],
             '{"a":null}': ["missing a"], '{"a":1,"note":"toolong"}': ["large note"], '{"a":1,"mode":"z"}': ["value mode"],
             '{"a":1,"mode":"y"}': [], '{"a":1,"list":{}}': ["type list"], '{"a":1,"deep":{"b":[1]},"list":[1],"flag":true,"f":1.5}': [],
             '{"a":1,"flag":"true","f":"x"}': ["type f", "type flag"], "[1]": ["not an object"], "broken {": ["not an object"],
             "": ["not an object"], '{"a":1.5}': ["type a"]}
    rows = [(9, k, "call", f"c{k}", None, None, "add", p) for k, p in enumerate(cases)]
    rows.append((9, 99, "call", "c99", None, None, "it's", '{"k\'y":""}'))
    got, _ = linked(spark, rows)
    for k, (p, want) in enumerate(cases.items()):
        if p != '{"a":1.0}':                    # JSON does not tell 1.0 from 1; the parser's type decides
            assert got[(9, k, f"c{k}")].errors == want, p
    assert got[(9, 99, "c99")].errors == ["small k'y"]


def test_repeated_rows_long_texts_empty(spark):
    row = (1, 1, "call", "a", None, None, "add", '{"a":1,"note":"%s"}' % ("x" * 200_000))
    res = (1, 2, "result", "r", "a", "a", None, "y" * 200_000)
    out = link_tool_calls(table(spark, [row, row, row, res, res]), SCHEMA).collect()
    assert sorted(r.status for r in out) == ["duplicate", "duplicate", "extra", "linked"]
    assert max(len(r.record) for r in out) > 400_000
    assert link_tool_calls(table(spark, [row]).limit(0), SCHEMA).collect() == []
    assert link_tool_calls(table(spark, [row]), {}).first().errors == ["unknown tool"]


def test_levels_of_long_chains_stars_and_cycles(spark):
    rows = [(1, i, "note", str(i), str(i - 1), None, None, None) for i in range(1, 600)]
    rows += [(2, i, "note", f"s{i}", "hub", None, None, None) for i in range(300)] + [(2, 900, "note", "hub", None, None, None, None)]
    rows += [(3, 0, "note", "x", "y", None, None, None), (3, 1, "note", "y", "x", None, None, None),
             (3, 2, "note", "z", "x", None, None, None), (3, 3, "note", "w", "w", None, None, None)]
    got = {(r.thread, r.id): r.level for r in levels(table(spark, rows)).collect()}
    assert all(got[(1, str(i))] == i - 1 for i in range(1, 600))
    assert got[(2, "hub")] == 0 and {got[(2, f"s{i}")] for i in range(300)} == {1}
    assert [got[(3, k)] for k in "xyzw"] == [None] * 4


def test_native_plan(spark):
    plan = link_tool_calls(table(spark, [(1, 0, "call", "a", None, None, "add", "{}")]), SCHEMA)
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
