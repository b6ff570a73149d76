"""Line dedup, SimHash, edit embedding, archives and decontamination against brute force."""

import base64
import hashlib
import random
import re

import numpy as np
import pyarrow.fs
import pytest
import xxhash

from foliosearch.llm import op05_lines, op07_simhash, op08_edit_embedding, op09_warc, op10_decontaminate
from foliosearch.llm.components import component_labels
from foliosearch.llm.queries import QUERIES
from foliosearch.session import ship_package

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None):
    rows = [((ids or range(len(texts)))[k], t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    return ship_package(spark).createDataFrame(rows, SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def components(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return [root(k) for k in range(n)]


# -- lines ----------------------------------------------------------------


def units_of(text, long_words):
    out = []
    for number, line in enumerate((text or "").split("\n")):
        words = line.encode().split()
        if words:
            line = line.encode().strip(b" \t\r\v\f")
            middle = len(line) // 2
            out += [(number, line[:middle]), (number, line[middle:])] if len(words) >= long_words else [(number, line)]
    return out


def without_repeats(docs, window=2, long_words=8, least_words=6):
    """Texts by id after deletion; a text left blank is missing."""
    seen, out = set(), {}
    for id_, text in docs:
        units = units_of(text, long_words)
        covered = [False] * len(units)
        for k in range(len(units) - window + 1):
            key = tuple(u for _, u in units[k : k + window])
            if key in seen:
                covered[k : k + window] = [True] * window
            seen.add(key)
        gone = {n: True for n, _ in units}
        for (n, _), c in zip(units, covered):
            gone[n] = gone[n] and c
        numbers, lines = list(gone), (text or "").split("\n")
        k = 0
        while k < len(numbers):
            end = k
            while end < len(numbers) and gone[numbers[end]]:
                end += 1
            if end > k and sum(len(lines[n].encode().split()) for n in numbers[k:end]) < least_words:
                for n in numbers[k:end]:
                    gone[n] = False
            k = max(end, k + 1)
        if units and all(gone.values()):
            continue
        out[id_] = text if not any(gone.values()) else "\n".join(x for n, x in enumerate(lines) if not gone.get(n))
    return out


def test_line_query(spark):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op5_winnowing_line_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: r.text for r in rows} == without_repeats(docs)
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("window", [1, 2, 3])
def test_lines_against_brute_force(spark, window):
    random.seed(window)
    lines = ["", " ", "a b", "c", "one two three four five six seven eight nine", "x y z", "ä ö ü", "p q r s t u v w x y"]
    texts = ["\n".join(random.choices(lines, k=random.randint(0, 12))) for _ in range(60)] + [None, "", "\n\n"]
    rows = op05_lines.drop_repeated_lines(docs_of(spark, texts), window=window).collect()
    assert {r.doc_id: r.text for r in rows} == without_repeats(list(enumerate(texts)), window=window)


def test_lines_keep_columns_and_repeated_rows(spark):
    docs = docs_of(spark, ["a b c d e f g h i j"] * 3, [1, 1, 2]).selectExpr("*", "7 as fp", "8 as starts")
    rows = op05_lines.drop_repeated_lines(docs).collect()
    assert [(r.doc_id, r.fp, r.starts) for r in rows] == [(1, 7, 8)] * 2
    assert op05_lines.drop_repeated_lines(docs_of(spark, [])).count() == 0


# -- simhash --------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query(spark):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    prints = [fingerprint(t) for _, t in docs]
    linked = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    root = components(len(docs), linked)
    found = {tuple(r) for r in QUERIES["op7_simhash_near_duplicates"](spark, FOLDER).collect()}
    assert found == {(docs[k][0], f"{prints[k]:016x}", docs[root[k]][0]) for k in range(len(docs))}


@pytest.mark.parametrize("group_rows", [10, 1_000_000])
def test_trie_walk_finds_every_link(spark, group_rows):
    random.seed(5)
    centres = [random.getrandbits(64) for _ in range(20)]
    prints = {random.getrandbits(64) for _ in range(200)} | {0, 1, (1 << 64) - 1, (1 << 63)}
    for c in centres:
        for _ in range(30):
            x = c
            for bit in random.sample(range(64), random.randint(0, 6)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    classes = ship_package(spark).createDataFrame([(x, k) for k, x in enumerate(signed)], "fp long, rep long")
    links = [tuple(r) for r in op07_simhash.near_links(classes, group_rows=group_rows).collect()]
    linked = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert components(len(prints), links) == components(len(prints), linked)


def test_simhash_odd_rows(spark):
    texts = [None, "", " \n", "one two", "one two", "A b c d e f g", "a B c d e f g"]
    rows = sorted(tuple(r) for r in op07_simhash.near_duplicates(docs_of(spark, texts)).collect())
    assert [r[2] for r in rows] == [0, 0, 0, 3, 3, 5, 5] and rows[0][1] == "0" * 16
    kept = op07_simhash.keep_one(docs_of(spark, [*texts, "one two"], [0, 1, 2, 3, 3, 5, 6, None]).selectExpr("*", "1 as fp"))
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in kept.collect()) == [-1, 0, 3, 5]
    assert op07_simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    labels = {r.node: r.label for r in component_labels(links).collect()}
    assert all(labels[k] == 0 for k in range(41)) and labels[101] == 100


# -- edit embedding -------------------------------------------------------


def slow_walk(walk, text):
    """The fingerprint by single steps: (step, character) tells whether to move on."""
    points = [(ord(c) ^ (ord(c) >> 8) * 31) & 0xFF for c in text]
    emitted, at, step = [], 0, 0
    stay = walk.stay.reshape(op08_edit_embedding.CLASSES, -1)
    while at < len(points) and step < 2 * len(points):
        for _ in range(int(stay[points[at], step % op08_edit_embedding.PERIOD])):
            emitted.append(points[at])
            step += 1
        at += 1
    wanted = walk.sampled(np.array([2 * len(points)]))[0] if points else [0] * walk.slots
    digits = op08_edit_embedding.DIGITS
    return "".join(chr(digits[walk.digit[emitted[w]]]) if points and w < len(emitted) else chr(digits[0]) for w in wanted)


def test_embedding_query_and_walk(spark):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = {r.doc_id: r for r in op08_edit_embedding.with_next(ship_package(spark).read.parquet(f"{FOLDER}/documents.parquet"), bucket_rows=30).collect()}
    walk = op08_edit_embedding.walker()
    for k, (id_, text) in enumerate(docs):
        following, row = docs[(k + 1) % len(docs)][1], rows[id_]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        if k % 10 == 0:
            assert row.fingerprint == slow_walk(walk, text) and row.edited_fingerprint == slow_walk(walk, changed)
            assert row.near_next == op08_edit_embedding.likeness(row.fingerprint, slow_walk(walk, following))
    assert len(QUERIES["op8_edit_embedding_fingerprints"](spark, FOLDER).collect()) == len(docs)


def test_few_edits_keep_fingerprints_near(spark):
    random.seed(8)
    text = "".join(random.choices("abcdefgh ", k=3000))
    changed = text
    for at in range(100, 2900, 400):
        changed = changed[:at] + "XYZ" + changed[at + 5 :]
    near, far = op08_edit_embedding.walker().fingerprints([changed, text[::-1]])
    own = op08_edit_embedding.walker().fingerprints([text])[0]
    assert 1 > op08_edit_embedding.likeness(own, near) > 0.5 > op08_edit_embedding.likeness(own, far)


@pytest.mark.parametrize("group_rows", [6, 20_000])
def test_links_connect_all_near_fingerprints(spark, group_rows):
    random.seed(9)
    prints = {"".join(random.choices("ab", k=64)) for _ in range(20)} | {"0" * 64}
    for centre in sorted(prints)[:6]:
        for _ in range(15):  # some a little too far, and chains
            slots = list(centre)
            for at in random.sample(range(64), random.randint(1, 14)):
                slots[at] = random.choice("abc")
            prints.add(centre := "".join(slots))
    prints = sorted(prints)
    table = ship_package(spark).createDataFrame(list(enumerate(prints)), "rep long, fingerprint string")
    links = op08_edit_embedding.near_links(table, group_rows=group_rows).collect()
    likeness = op08_edit_embedding.likeness
    assert all(abs(likeness(prints[r.a], prints[r.b]) - r.likeness) < 1e-9 and r.likeness >= 0.8 for r in links)
    linked = [(x, y) for x in range(len(prints)) for y in range(x) if likeness(prints[x], prints[y]) >= 0.8]
    assert components(len(prints), [(r.a, r.b) for r in links]) == components(len(prints), linked)


def test_groups_of_near_fingerprints(spark):
    one = "a" * 64
    five, half = "b" * 5 + one[5:], "c" * 32 + one[32:]
    rows = [(4, one), (9, five), (2, half), (7, one), (None, one), (None, "d" * 64)]
    table = ship_package(spark).createDataFrame(rows, "doc_id long, fingerprint string")
    found = {r.fingerprint: r.component_id for r in op08_edit_embedding.near_groups(table).collect()}
    assert found == {one: 4, five: 4, half: 2}
    assert op08_edit_embedding.near_groups(table.where("false")).count() == 0
    with pytest.raises(ValueError):
        op08_edit_embedding.near_links(table.withColumnRenamed("doc_id", "rep"), bands=8, band_slots=8)


def test_groups_of_the_query_against_brute_force(spark):
    compared = QUERIES["op8_edit_embedding_fingerprints"](spark, FOLDER)
    rows = sorted(op08_edit_embedding.with_groups(compared).collect())
    likeness = op08_edit_embedding.likeness
    linked = [(x, y) for x in range(len(rows)) for y in range(x) if likeness(rows[x].fingerprint, rows[y].fingerprint) >= 0.8]
    root = components(len(rows), linked)
    assert linked and [r.component_id for r in rows] == [rows[k].doc_id for k in root]


def test_embedding_odd_rows(spark):
    rows = op08_edit_embedding.with_next(docs_of(spark, [None, "", "abc", "abc", "zz"], [5, 6, 7, 7, None])).collect()
    told = {(r.doc_id, r.n_chars): r for r in rows}
    assert len(rows) == 5 and told[5, 0].fingerprint == "0" * 64 and told[5, 0].near_next == 1.0
    assert told[None, 2].edited_sha256 == hashlib.sha256(b"zz").hexdigest()
    single = op08_edit_embedding.with_next(docs_of(spark, ["abcd"])).collect()
    assert single[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert op08_edit_embedding.with_next(docs_of(spark, [])).count() == 0


# -- archives -------------------------------------------------------------

PAGES = [(1, "http://a/ é\r\n", "x"), (2, None, None), (3, "u", ""), (4, "u", "x"), (5, "v", "ü"), (None, "w", "ü"), (4, "u", "x")]


@pytest.mark.parametrize("least", [0, 2])
def test_archives_round_trip(spark, tmp_path, least):
    pages = ship_package(spark).createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as digest")
    index = op09_warc.write_archives(pages, str(tmp_path), least_bytes=least, archive_bytes=300)
    found = sorted(map(str, op09_warc.read_records(index, str(tmp_path), gap=10, most=500).collect()))
    last = {}
    for page, _, html in PAGES:
        raw = (html or "").encode()
        if page is not None and len(raw) >= least:
            last[raw] = max(page, last.get(raw, page))
    rows = []
    for page, url, html in PAGES:
        raw = (html or "").encode()
        revisit = raw in last and last[raw] != page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        rows.append((page, len(raw), digest, "revisit" if revisit else "response", last[raw] if revisit else None))
    read = op09_warc.read_records(index, str(tmp_path), with_payload=False).collect()
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read), key=key)
    assert got == sorted(rows, key=key) and len(found) == len(PAGES)


def test_only_selected_ranges_are_read(spark, tmp_path):
    pages = ship_package(spark).createDataFrame([(k, f"u{k}", f"page {k}" * 50) for k in range(40)], "page_id long, url string, html string")
    index = op09_warc.write_archives(pages.coalesce(1), str(tmp_path))
    some = op09_warc.read_records(index.where("page_id % 10 = 3"), str(tmp_path), gap=0)
    assert {r.page_id: r.payload.decode() for r in some.collect()} == {k: f"page {k}" * 50 for k in (3, 13, 23, 33)}
    ranges = list(op09_warc._ranges([("f", 0, 10), ("f", 10, 5), ("f", 40, 5), ("g", 45, 5)], gap=10, most=100))
    assert [(f, s, e, len(x)) for f, s, e, x in ranges] == [("f", 0, 15, 2), ("f", 40, 45, 1), ("g", 45, 50, 1)]
    empty = op09_warc.write_archives(pages.where("false"), str(tmp_path / "none"))
    assert op09_warc.read_records(empty, str(tmp_path / "none")).count() == 0
    assert pyarrow.fs.LocalFileSystem()


def test_archive_query(spark):
    pages = {r[0]: r[1] or "" for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()}
    rows = QUERIES["op9_warc_index_and_read"](spark, FOLDER).collect()
    assert {r.page_id: r.payload_bytes for r in rows} == {k: len(v.encode()) for k, v in pages.items()}


# -- decontamination ------------------------------------------------------


def contaminated(docs, items, size=10):
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for id_, text in items:
        words = words_of(text)
        width = min(size, len(words))
        for k in range(len(words) - width + 1 if words else 0):
            windows.setdefault(tuple(words[k : k + width]), set()).update([] if id_ is None else [str(id_)])
    rows = set()
    for id_, text in docs:
        words = words_of(text)
        hit, found = [0] * len(words), set()
        for window, ids in windows.items():
            for k in range(len(words) - len(window) + 1):
                if tuple(words[k : k + len(window)]) == window:
                    hit[k : k + len(window)] = [1] * len(window)
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        rows.add((id_, len(words), sum(hit), len(found), digest, any(hit)))
    return rows


def test_decontamination_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    found = {tuple(r) for r in QUERIES["op10_benchmark_decontamination"](spark, FOLDER).collect()}
    assert found == contaminated(docs, items)


@pytest.mark.parametrize("block_bytes", [1 << 26, 300])
def test_decontamination_in_blocks(spark, block_bytes):
    random.seed(10)
    words = ["a", "b", "c", "É", "9"]
    items = [(k, " ".join(random.choices(words, k=random.randint(0, 6)))) for k in range(12)] + [(None, "b b b b"), (3, "c c c"), (20, None)]
    docs = [(k, ", ".join(random.choices(words, k=random.randint(0, 30))).upper()) for k in range(40)] + [(50, None), (51, ""), (52, "!!")]
    bench = ship_package(spark).createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as words")
    table = docs_of(spark, [t for _, t in docs], [k for k, _ in docs]).selectExpr("*", "2 as items", "3 as n_hit")
    hits = op10_decontaminate.find_hits(table, bench, size=4, block_bytes=block_bytes)
    assert {tuple(r) for r in op10_decontaminate.report(hits).collect()} == contaminated(docs, items, 4)


def test_spans_and_documents_go(spark):
    bench = ship_package(spark).createDataFrame([(1, "one two three four")], "item_id long, text string")
    docs = docs_of(spark, ["Start. One, two THREE four! End", "clean text", None])
    cut = op10_decontaminate.remove_spans(docs, bench, size=4)
    assert [r.text for r in cut.orderBy("doc_id").collect()] == ["Start. ! End", "clean text", None]
    clean = op10_decontaminate.clean_documents(docs, bench, size=4)
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2] and clean.columns == docs.columns
    assert op10_decontaminate.find_hits(docs_of(spark, []), bench).count() == 0
