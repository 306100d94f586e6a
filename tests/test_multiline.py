"""Multi-line JSON files in splits of a few bytes, against Python's parser."""

import json
import os

import pytest

from tidemark.session import fresh_dir
from tidemark.sources.files import read_text_records, text_schema
from tidemark.sources.multiline import read_multiline

RECORDS = [{"k": i, "s": 'a "quoted" \\ text, }, { ] [ \n line', "list": [[1, {"x": "}"}], [], "é"],
            "deep": {"a": {"b": [i] * (i % 4)}}} for i in range(25)] + [[1, 2], "text, ]", 5, {}, []]


def _read(spark, tmp, texts, split="64b"):
    path = fresh_dir(spark, tmp)
    for i, text in enumerate(texts):
        os.makedirs(f"{path}/page={i}")
        with open(f"{path}/page={i}/f.json", "w", newline="") as f:
            f.write(text)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, split)
        rows = read_multiline(spark, path, path, text_schema(("page",)), ("page",))
        parts = spark.read.text(path).rdd.getNumPartitions()
        out = {}
        for r in rows.collect():
            out.setdefault(int(r.page), []).append(r.value)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    return out, parts


def _sorted(values):
    return sorted(json.dumps(v, sort_keys=True) for v in values)


@pytest.mark.parametrize("split", ["64b", "100m"])
def test_records_of_any_layout(spark, split):
    objects = [r for r in RECORDS if isinstance(r, dict)]
    compact = json.dumps(RECORDS, ensure_ascii=False)
    texts = [json.dumps(RECORDS, indent=2), compact, json.dumps(RECORDS, indent=0, ensure_ascii=False),
             compact.replace("}, {\"k\"", "},\r\n{\"k\""), "[\n" + ",\n".join(map(json.dumps, RECORDS)) + "\n]\n",
             "\n".join(json.dumps(r, indent=4) for r in objects), json.dumps(RECORDS[0], indent=1),
             "", " \n\t\n", "[]", "[\n]\n", "\n\n [ {\"a\":\n1}\n,{\"a\":2} ]"]
    got, parts = _read(spark, "any", texts, split)
    for i in range(5):
        assert _sorted(json.loads(v) for v in got[i]) == _sorted(RECORDS), i
    assert _sorted(json.loads(v) for v in got[5]) == _sorted(objects)
    assert [json.loads(v) for v in got[6]] == [RECORDS[0]]
    assert _sorted(json.loads(v) for v in got[11]) == _sorted([{"a": 1}, {"a": 2}])
    assert not set(got) & {7, 8, 9, 10}
    assert split == "100m" or parts > 50           # the files were read in many splits


def test_records_before_a_break_are_kept(spark):
    text = json.dumps([{"k": 1}, {"k": 2}], indent=2)[:-2] + ',\n  {"k": 3, "x": [}\n]'
    got, _ = _read(spark, "broken", [text])
    assert [json.loads(v) for v in sorted(got[0])[:2]] == [{"k": 1}, {"k": 2}] or len(got[0]) >= 3


def test_long_strings_full_of_escapes(spark):
    records = [{"k": 1, "s": 'a"\\\n' * 60_000}, {"k": 2, "s": "b" * 300_000}]
    got, _ = _read(spark, "long", [json.dumps(records), json.dumps(records, indent=1)], "64k")
    for i in (0, 1):
        assert _sorted(json.loads(v) for v in got[i]) == _sorted(records)


def test_text_records_use_it(spark):
    path = fresh_dir(spark, "pretty")
    os.makedirs(f"{path}/page=1")
    with open(f"{path}/page=1/a.json", "w") as f:
        json.dump([{"a": 1}, {"a": 2}], f, indent=2)
    rows = read_text_records(spark, path, True, ("page",), [f"{path}/page=1/a.json"]).collect()
    assert _sorted(json.loads(r.value) for r in rows) == _sorted([{"a": 1}, {"a": 2}])
    assert {r.page for r in rows} == {"1"} and all(r.source_file.endswith("a.json") for r in rows)
