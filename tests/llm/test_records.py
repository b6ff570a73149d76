"""Licences, tool calls and the pipeline."""

import json

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import differences, oracle
from foliosearch.llm import op01_language, op03_licenses, op04_tool_calls, op05_lines, op07_simhash, op10_decontaminate
from foliosearch.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    _, problem = differences(QUERIES[name], ORACLE[name], spark, oracle(FOLDER), FOLDER)
    assert not problem


# -- licences -------------------------------------------------------------


def test_the_filter_loses_no_line():
    """What a template keeps besides its signs is too short to reach the threshold."""
    weight, _ = op03_licenses.weights(op03_licenses.TEMPLATES)
    signs = set(op03_licenses.signs(op03_licenses.TEMPLATES, op03_licenses.LEAST))
    for text in op03_licenses.TEMPLATES.values():
        terms = op03_licenses.terms_of(text)
        whole = sum(weight[t] ** 2 for t in terms)
        assert sum(weight[t] ** 2 for t in terms - signs) < op03_licenses.LEAST**2 * whole


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, gpl = op03_licenses.TEMPLATES["MIT"], op03_licenses.TEMPLATES["GPL-3.0"]
    rows = [
        ("a/LICENSE", f"header\n{mit}"), ("a/x.c", "int main"), ("a/b/y.c", None), ("a/b/c/LICENSE", gpl), ("a/b/c/d/z.c", ""),
        ("a/b/c/own.c", f"{mit}\ncode"), ("ab/q.c", "text"), (None, mit), ("top", "none"), ("a/x.c", "int main"), ("a/LICENSE", "nothing"),
    ]
    files = spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, folder int")
    found = {(r.path, r.own_licence): (r.licence, r.inherited_from) for r in op03_licenses.scan(files).collect()}
    assert found == {
        ("a/LICENSE", "MIT"): ("MIT", None), ("a/LICENSE", None): ("MIT", "a"), ("a/x.c", None): ("MIT", "a"),
        ("a/b/y.c", None): ("MIT", "a"), ("a/b/c/LICENSE", "GPL-3.0"): ("GPL-3.0", None), ("a/b/c/d/z.c", None): ("GPL-3.0", "a/b/c"),
        ("a/b/c/own.c", "MIT"): ("MIT", None), ("ab/q.c", None): (None, None), (None, "MIT"): ("MIT", None), ("top", None): (None, None),
    }
    assert op03_licenses.scan(files.where("false")).count() == 0


def test_licences_are_compared_as_documents(spark):
    full = op03_licenses.documents()
    wrapped = "/*\n * " + full["GPL-3.0#header"].replace("\n", "\n * ") + "\n */\nint main() { return 0; }\n"
    cases = {
        "mit": ("Some Project\n\nCopyright (c) 2024 A. Author\n\n" + full["MIT#text"], "MIT"),
        "body": (full["MIT#first"].replace("\n", " "), "MIT"),
        "bsd3": ("Copyright 2020 B\n\n" + full["BSD-3-Clause#text"], "BSD-3-Clause"),
        "bsd2": ("Copyright 2020 B\n\n" + full["BSD-2-Clause#text"], "BSD-2-Clause"),
        "isc": (full["ISC#text"], "ISC"),
        "gpl": (full["GPL-3.0#text"], "GPL-3.0"),
        "lgpl": (full["LGPL-3.0#text"], "LGPL-3.0"),
        "wrapped": (wrapped, "GPL-3.0"),
        "tag": ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
        "tag2": ("# SPDX-License-Identifier: Apache-2.0\nimport os", "Apache-2.0"),
        "apache": (full["Apache-2.0#first"].replace("\n", " ") + "\ncode", "Apache-2.0"),
        "sentence": ("Copyright (c) 2024 A. Author. Released under the MIT License.", "MIT"),
        "crlf": (wrapped.replace("\n", "\r\n"), "GPL-3.0"),
        "other": ("SPDX-License-Identifier: Sleepycat", None),
        "zlib": ("SPDX-License-Identifier: Zlib", "Zlib"),
        "prose": ("The driver lost their licence and had no permission to redistribute the warranty.", None),
    }
    files = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "path string, text string")
    assert {r.path: r.own_licence for r in op03_licenses.scan(files).collect()} == {k: v[1] for k, v in cases.items()}


@pytest.mark.parametrize("before, after", [("", ""), ("int x;\n// ", "\nint y;"), ("Copyright 2020 C. ", " All of it.")])
def test_relatives_are_told_apart(spark, before, after):
    gnu = op03_licenses.documents()["GPL-3.0#header"]
    cases = {
        "GNU Affero General Public License, version 3": "AGPL-3.0",
        "GNU General Public License, version 2": "GPL-2.0",
        "GNU General Public License, version 3": "GPL-3.0",
        "GNU Lesser General Public License, version 2.1": "LGPL-2.1",
        "Eclipse Public License, Version 2.0": "EPL-2.0",
        "Eclipse Public License, Version 1.0": "EPL-1.0",
        "Mozilla Public License, version 1.1": None,
        "GNU General Public License": None,
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under CC BY-NC-ND 4.0.": None,
        "Licensed under the BSD 2-Clause License.": "BSD-2-Clause",
        "Licensed under the BSD 4-Clause License.": None,
        "Released under the Artistic License.": None,
        "SPDX-License-Identifier: AGPL-3.0": "AGPL-3.0",
        "SPDX-License-Identifier: MPL-1.1": None,
        gnu.replace("GNU General", "GNU Affero General"): "AGPL-3.0",
        gnu.replace("version 3", "version 2"): "GPL-2.0",
        gnu: "GPL-3.0",
    }
    files = spark.createDataFrame([(k, before + k.replace("\n", " ") + after) for k in cases], "path string, text string")
    found = {r.path: r.own_licence for r in op03_licenses.scan(files).collect()}
    long = len(before) + len(after) > 20  # more words on the line may hide a short notice, never change it
    assert {k: v for k, v in found.items() if v != cases[k] and not (long and v is None)} == {}


def test_near_ties_state_nothing(spark):
    templates = {"A-1": "licensed alpha terms one", "B-1": "licensed alpha terms two"}
    files = spark.createDataFrame([("x", "licensed alpha terms"), ("y", "licensed alpha terms two"), ("z", "licensed alpha terms one two")], "path string, text string")
    files = files.withColumn("text_key", F.xxhash64("text"))
    rows = op03_licenses.line_licences(files, 0.6, templates).collect()
    assert [(r.path, r.licence) for r in rows] == [("y", "B-1")]


def test_an_affero_text_is_not_the_general_one(spark):
    text = op03_licenses.documents()["GPL-3.0#text"]
    affero = text.replace("GENERAL", "AFFERO GENERAL").replace("GNU General", "GNU Affero General")
    affero += "\nyour version must offer all users interacting with it remotely through a network"
    files = spark.createDataFrame([("a", affero), ("g", text)], "path string, text string")
    found = {r.path: r.own_licence for r in op03_licenses.scan(files).collect()}
    assert found == {"a": "AGPL-3.0", "g": "GPL-3.0"}


# -- tool calls -----------------------------------------------------------

CALLS = "conv_id long, turn long, call_id string, tool string, arguments string, after array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"
KINDS = [("t", "n", "integer", True), ("t", "s", "string", False), ("t", "x", "number", False), ("t", "o", "object", False)]


def linked(spark, calls, results):
    schemas = spark.createDataFrame(KINDS, "tool string, param string, kind string, required boolean")
    rows = op04_tool_calls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schemas)
    return {(r.conv_id, r.call_id): r for r in rows.collect()}


def test_calls_are_ordered_by_what_they_need(spark):
    calls = [(1, 5, "a", "t", "{}", []), (1, 1, "b", "t", "{}", ["a"]), (1, 2, "c", "t", "{}", ["a", "b", "nowhere"]), (2, 1, "a", "t", "{}", None)]
    calls += [(1, 3, "p", "t", "{}", ["q"]), (1, 4, "q", "t", "{}", ["p"]), (1, 6, "r", "t", "{}", ["q"])]
    rank = {k: r.rank for k, r in linked(spark, calls, []).items()}
    assert rank == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (2, "a"): 0, (1, "p"): -1, (1, "q"): -1, (1, "r"): -1}


@pytest.mark.parametrize(
    "tool, arguments, valid",
    [
        ("t", '{"n": 1}', True), ("t", '{"s": "x", "n": 2, "x": 3}', True), ("t", '{"n": 1, "x": 1.5, "o": {"b": 1, "a": [2]}}', True),
        ("t", "{}", False), ("t", '{"n": "1"}', False), ("t", '{"n": 1.5}', False), ("t", '{"n": null}', False), ("t", '{"n": 1, "z": 1}', False),
        ("t", '{"n": 1, "s": null}', True), ("t", "[1]", False), ("t", "broken", False), ("t", None, False), ("u", '{"n": 1}', False),
        (None, '{"n": 1}', False), ("t", '{"n": 1, "n": 2}', False), ("t", "", False),
    ],
)
def test_arguments_are_validated(spark, tool, arguments, valid):
    row = linked(spark, [(1, 1, "a", tool, arguments, [])], [])[1, "a"]
    assert row.valid is valid


def test_links_and_canonical_json(spark):
    calls = [(1, 1, "a", "t", '{ "s" : "é\\n", "n":1, "o": {"b":1.50,"a":2} }', []), (1, 9, "a", "t", "{}", []), (1, 3, "open", "t", "x", [])]
    calls += [(None, 1, "a", "t", "{}", []), (1, 1, None, "t", "{}", [])]
    results = [(1, 2, "a", 'the "result"'), (1, 4, "a", "later"), (1, 5, "lost", None), (None, 1, "a", "x")]
    rows = linked(spark, calls, results)
    assert set(rows) == {(1, "a"), (1, "open"), (1, "lost")}
    told = rows[1, "a"]
    assert told.linked and told.canonical == (
        '{"arguments":{"n":1,"o":{"a":2,"b":1.5},"s":"é\\n"},"call_id":"a","result":"the \\"result\\"","tool":"t","valid":true}'
    )
    assert json.loads(rows[1, "open"].canonical)["arguments"] is None and not rows[1, "open"].linked
    assert rows[1, "lost"].tool is None and rows[1, "lost"].rank is None
    assert linked(spark, [], []) == {}


# -- the pipeline ---------------------------------------------------------


def test_stages_do_what_their_operators_say(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "simhash", "decontaminate", "sentencepiece"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.columns == columns or name == "sentencepiece"
        rows = out.collect()
        kept[name] = rows
        docs = spark.createDataFrame(rows, out.schema)
    whole = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = {r.doc_id for r in op01_language.identify(whole).where("lang_pred <> 'und'").collect()}
    assert {r.doc_id for r in kept["language_id"]} == known
    first = spark.createDataFrame(kept["line_dedup"], whole.schema)
    groups = op07_simhash.near_duplicates(first).collect()
    assert {r.doc_id for r in kept["simhash"]} == {r.component_id for r in groups}
    assert len(kept["simhash"]) == len({r.component_id for r in groups})
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    hits = op10_decontaminate.find_hits(spark.createDataFrame(kept["decontaminate"], whole.schema), bench)
    assert hits.where("n_hit > 0").count() == 0 and len(kept["decontaminate"]) < len(kept["simhash"])
    assert op05_lines.drop_repeated_lines(first).count() == first.count()
    result = QUERIES["pipeline"](spark, FOLDER).collect()
    assert sorted(result) == sorted(kept["sentencepiece"])
