"""Objects in texts against a stack and the json module."""

from __future__ import annotations

import json
import random
import re

from plumbline.operators import literals, nested


def by_stack(text):
    """Outermost closed braces, quoted strings skipped."""
    found, stack, spans = re.finditer(nested.PIECE, text, re.S), [], []
    for m in found:
        if m.group() == "{":
            stack.append(m.start())
        elif m.group() == "}" and stack:
            spans.append((stack.pop(), m.end()))
    outer = [s for s in spans if not any(o[0] < s[0] and s[1] < o[1] for o in spans)]
    return [text[a:b] for a, b in sorted(outer)]


def leaves(value, path="$", key=None):
    if isinstance(value, dict):
        for k, v in value.items():
            yield from leaves(v, f"{path}.{k}", k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from leaves(v, f"{path}[{i}]", key)
    else:
        yield path, key, None if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def random_value(pick, depth):
    kind = pick.randint(0, 6 if depth else 4)
    if kind == 5:
        return {pick.choice("abc") + str(i): random_value(pick, depth - 1) for i in range(pick.randint(0, 3))}
    if kind == 6:
        return [random_value(pick, depth - 1) for _ in range(pick.randint(0, 3))]
    return [pick.randint(-9, 99), "x, y} {z", 'say "hi"\\', None, True][kind]


def test_objects_and_values(spark):
    pick, rows, want = random.Random(3), [(1000, None), (1001, ""), (1002, "no braces")], []
    for i in range(120):
        parts = []
        for _ in range(pick.randint(0, 4)):
            parts.append(pick.choice(["}", "} }", "{ open", "{bad, }", "plain", "a = 1", json.dumps({k: random_value(pick, 3) for k in "kmn"}, ensure_ascii=False)]))
        rows.append((i, " ".join(parts)))
    found, rest = nested.objects(spark.createDataFrame(rows, "resp_id long, text string"), ["resp_id"])
    got = {}
    for r in found.orderBy("resp_id", "object_ix").collect():
        got.setdefault(r.resp_id, []).append(r.json)
    texts = {i: by_stack(t) for i, t in rows if t}
    assert got == {i: t for i, t in texts.items() if t}
    for i, objects in texts.items():
        for ix, text in enumerate(objects):
            try:
                want += [(i, ix, *leaf) for leaf in leaves(json.loads(text))]
            except ValueError:
                pass
    read = [tuple(r) for r in nested.values(found, ["resp_id"]).select("resp_id", "object_ix", "path", "key", "value").collect()]
    assert sorted(read, key=repr) == sorted(want, key=repr) and len(want) > 100
    left = {r.resp_id: r.text for r in rest.collect()}
    assert len(left) == len(rows) and left[1000] is None and left[1002] == "no braces"
    for i, text in rows:
        cut = text or ""
        for part in texts.get(i, []):
            cut = cut.replace(part, " ", 1)
        assert "".join((left[i] or "").split()) == "".join(cut.split())


def test_long_and_deep(spark):
    deep = '{"a":' * 40 + '"end"' + "}" * 40
    wide = json.dumps({f"k{i}": "v" * 50 for i in range(3000)})
    rows = [(1, deep), (2, "{" * 3000), (3, "}" * 3000), (4, wide), (5, '"' + "q" * 50_000 + " {")]
    found, _ = nested.objects(spark.createDataFrame(rows, "resp_id long, text string"), ["resp_id"])
    values = nested.values(found, ["resp_id"])
    assert {(r.resp_id, r["count"]) for r in values.groupBy("resp_id").count().collect()} == {(1, 1), (4, 3000)}
    assert values.filter("resp_id = 1").first().path == "$" + ".a" * 40


def test_structured_lane_reads_json(spark):
    units = spark.createDataFrame(
        [(1, 0, "s", 'order {"total": {"net": "1,5; x", "gross": 42}, "day": "2024-01-02"} with size = 7'), (2, 0, "s", "nothing")],
        "resp_id long, unit_ix long, source_id string, text string",
    )
    responses = spark.createDataFrame([(1, "gross 42 on 2024-01-02"), (2, "x")], "resp_id long, response_text string")
    pairs = {(r.key, r.value) for r in literals.structured_pairs(units).collect()}
    assert pairs == {("net", "1,5; x"), ("gross", "42"), ("day", "2024-01-02"), ("size", "7")}
    rows = {r.resp_id: r for r in literals.structured_lane(responses, units, json=True).collect()}
    assert (rows[1].pair_count, rows[1].typed_count, rows[1].aligned_count) == (4, 3, 2)
    assert rows[2].pair_count == 0 and not rows[2].structured_source_detected
