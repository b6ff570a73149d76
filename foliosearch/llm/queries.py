"""The registered queries of the operators, and their SQL where it can say them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosearch.llm import (
    op01_language,
    op02_suffix_tree,
    op03_licenses,
    op04_tool_calls,
    op05_lines,
    op06_pieces,
    op07_simhash,
    op08_edit_embedding,
    op09_warc,
    op10_decontaminate,
    op11_hard_negatives,
    op12_mixing,
    op13_periodic,
)
from foliosearch.session import scratch_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


@functools.cache
def _pipeline() -> Callable:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(ship_package(spark), folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str = "piece_bpe_32k.model") -> str:
    """The path of a public vocabulary, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return op01_language.identify(documents).select(
        "doc_id", op01_language.held_out().alias("held_out"), "lang_pred", "score"
    )


@query
def op2_suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    return op02_suffix_tree.score(table(spark, folder, "documents"))


@query
def op5_winnowing_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return op05_lines.drop_repeated_lines(table(spark, folder, "documents"))


@query
def op6_sentencepiece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return op06_pieces.encode_documents(table(spark, folder, "documents"), tokenizer(), with_ids=False)


@query
def op7_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return op07_simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op8_edit_embedding_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return op08_edit_embedding.with_next(table(spark, folder, "documents"))


@query
def op9_warc_index_and_read(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "warc")
    index = op09_warc.write_archives(table(spark, folder, "pages"), place)
    records = op09_warc.read_records(index, place, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return op10_decontaminate.report(op10_decontaminate.find_hits(documents, table(spark, folder, "benchmark")))


# -- licences -------------------------------------------------------------


def as_files(documents: DataFrame) -> DataFrame:
    """Documents as files of a tree: by source, language and shelf; every twentieth is a licence file."""
    # A licence file of a number divisible by 40 lies in its shelf, another one in its language's folder.
    folder = F.concat_ws("/", "source", "lang")
    shelf = F.concat_ws("/", folder, F.concat(F.lit("shelf"), F.pmod(F.col("doc_id"), F.lit(97))))
    licence = F.col("doc_id") % 20 == 0
    path = F.when(licence & (F.col("doc_id") % 40 == 0), F.concat_ws("/", shelf, F.lit("LICENSE"))).when(
        licence, F.concat_ws("/", folder, F.lit("LICENSE"))
    ).otherwise(F.concat_ws("/", shelf, F.concat("doc_id", F.lit(".txt"))))
    return documents.select("doc_id", path.alias("path"), "text")


@query
def op3_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    files = as_files(table(spark, folder, "documents"))
    return op03_licenses.scan(files).select("path", "own_licence", "cosine", "licence", "inherited_from")


def _licence_sql() -> str:
    weight, other = op03_licenses.weights(op03_licenses.TEMPLATES)
    rows = ", ".join(
        f"('{name}', '{term}', {weight[term]!r})" for name, text in sorted(op03_licenses.TEMPLATES.items()) for term in sorted(op03_licenses.terms_of(text))
    )
    vocabulary = ", ".join(f"('{term}', {value!r})" for term, value in weight.items())
    rules = {name: op03_licenses.told_by(name, text) for name, text in op03_licenses.TEMPLATES.items()}
    needed = ", ".join(f"('{name}', {k}, '{term}')" for name in rules for k, group in enumerate(rules[name][0]) for term in group)
    barred = ", ".join(f"('{name}', '{term}')" for name in rules for term in rules[name][1])
    return f"""
WITH template(name, term, w) AS (VALUES {rows}), vocabulary(term, w) AS (VALUES {vocabulary}),
norms AS (SELECT name, sqrt(sum(w * w)) AS norm FROM template GROUP BY name),
files AS (
  SELECT DISTINCT CASE WHEN doc_id % 40 = 0 THEN source || '/' || lang || '/shelf' || (doc_id % 97) || '/LICENSE'
    WHEN doc_id % 20 = 0 THEN source || '/' || lang || '/LICENSE'
    ELSE source || '/' || lang || '/shelf' || (doc_id % 97) || '/' || doc_id || '.txt' END AS path, md5(text) AS text, text AS body FROM documents),
lines AS (SELECT path, text, unnest(string_split(body, chr(10))) AS line FROM files),
numbered AS (SELECT path, text, line, row_number() OVER () AS n FROM lines),
terms AS (SELECT DISTINCT path, text, n, unnest(regexp_extract_all(lower(line), '[a-z0-9]+(?:\\.[a-z0-9]+)*')) AS term FROM numbered),
lengths AS (SELECT n, sqrt(sum(coalesce(v.w, {other!r}) * coalesce(v.w, {other!r}))) AS length
  FROM terms LEFT JOIN vocabulary v ON terms.term = v.term GROUP BY n),
shared AS (SELECT t.path, t.text, t.n, m.name, sum(m.w * m.w) AS dot FROM terms t JOIN template m ON t.term = m.term GROUP BY ALL),
cosines AS (SELECT s.path, s.text, s.n, s.name, round(s.dot / (l.length * o.norm), 6) AS cosine
  FROM shared s JOIN lengths l ON s.n = l.n JOIN norms o ON s.name = o.name),
needed(name, part, term) AS (VALUES {needed}), barred(name, term) AS (VALUES {barred}),
asked AS (SELECT name, count(DISTINCT part) AS parts FROM needed GROUP BY name),
met AS (SELECT t.n, d.name, count(DISTINCT d.part) AS parts FROM terms t JOIN needed d ON t.term = d.term GROUP BY ALL),
refused AS (SELECT DISTINCT t.n, b.name FROM terms t JOIN barred b ON t.term = b.term),
allowed AS (SELECT c.* FROM cosines c JOIN asked a ON c.name = a.name JOIN met m ON c.n = m.n AND c.name = m.name AND a.parts = m.parts
  WHERE NOT EXISTS (SELECT 1 FROM refused r WHERE r.n = c.n AND r.name = c.name)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY cosine DESC, name) AS place,
  round(cosine - lead(cosine) OVER (PARTITION BY n ORDER BY cosine DESC, name), 6) AS lead FROM allowed),
best AS (SELECT path, text, cosine, name FROM firsts WHERE place = 1 AND cosine >= {op03_licenses.LEAST} AND coalesce(lead > {op03_licenses.MARGIN}, true)
  QUALIFY row_number() OVER (PARTITION BY path, text ORDER BY cosine DESC, name) = 1),
told AS (SELECT f.path, f.text, b.cosine, b.name AS own, regexp_replace(f.path, '/[^/]*$', '') AS folder
  FROM files f LEFT JOIN best b ON f.path = b.path AND f.text = b.text),
given AS (SELECT folder, own FROM told WHERE own IS NOT NULL AND path LIKE '%/LICENSE'
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY cosine DESC, path, own) = 1),
near AS (SELECT t.path, t.text, g.folder, g.own FROM told t JOIN given g
  ON t.folder = g.folder OR starts_with(t.folder, g.folder || '/') WHERE t.own IS NULL
  QUALIFY row_number() OVER (PARTITION BY t.path, t.text ORDER BY length(g.folder) DESC) = 1)
SELECT t.path, t.own AS own_licence, t.cosine, coalesce(t.own, n.own) AS licence, n.folder AS inherited_from
FROM told t LEFT JOIN near n ON t.path = n.path AND t.text = n.text
"""


ORACLE["op3_licence_scan"] = _licence_sql()


# -- tool calls -----------------------------------------------------------

SCHEMAS = [
    ("search", "words", "integer", True),
    ("search", "digest", "string", True),
    ("search", "exact", "boolean", False),
    ("fetch", "words", "number", True),
    ("fetch", "digest", "string", False),
    ("fetch", "exact", "boolean", True),
]


def as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that turns stand for: an assistant's turn calls, a later turn of another role answers.

    A call needs the one two turns before, and every third also the one four turns
    before.  Its arguments tell of its text; some lack a parameter and some have one of another kind.
    """
    size = F.length("text")
    words = F.when(size % 11 == 0, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(size.cast("string"))
    exact = F.when(size % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(', "exact": '), (size % 2 == 0).cast("string")))
    arguments = F.concat(F.lit('{ "words": '), words, F.lit(', "digest" : "'), F.md5("text"), F.lit('"'), exact, F.lit("}"))
    calls = turns.where("role = 'assistant'").select(
        "conv_id",
        "turn",
        F.concat(F.lit("c"), F.col("turn")).alias("call_id"),
        F.when(F.col("turn") % 3 == 0, "fetch").otherwise("search").alias("tool"),
        arguments.alias("arguments"),
        F.array_compact(
            F.array(
                F.concat(F.lit("c"), F.col("turn") - 2),
                F.when(F.col("turn") % 3 == 0, F.concat(F.lit("c"), F.col("turn") - 4)),
            )
        ).alias("after"),
    )
    results = turns.where("role <> 'assistant' and turn > 0").select(
        "conv_id", "turn", F.concat(F.lit("c"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


@query
def op4_tool_call_linking(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = as_calls(table(spark, folder, "conversations"))
    schemas = spark.createDataFrame(SCHEMAS, "tool string, param string, kind string, required boolean")
    return op04_tool_calls.link(calls, results, schemas)


ORACLE["op4_tool_call_linking"] = """
WITH RECURSIVE told AS (
  SELECT conv_id, turn, min(text) AS text, length(min(text)) AS size
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
paths AS (
  SELECT conv_id, turn, 0 AS rank FROM told
  UNION
  SELECT t.conv_id, t.turn, p.rank + 1 FROM paths p JOIN told t ON t.conv_id = p.conv_id
    AND (t.turn = p.turn + 2 OR (t.turn = p.turn + 4 AND t.turn % 3 = 0))),
chain AS (SELECT conv_id, turn, max(rank) AS rank FROM paths GROUP BY conv_id, turn),
answers AS (
  SELECT conv_id, turn - 1 AS call_turn, turn, min(text) AS content
  FROM conversations WHERE role <> 'assistant' AND turn > 0 GROUP BY conv_id, turn),
calls AS (
  SELECT t.conv_id, t.turn, c.rank, CASE WHEN t.turn % 3 = 0 THEN 'fetch' ELSE 'search' END AS tool,
    size % 11 <> 0 AND (t.turn % 3 <> 0 OR size % 7 <> 0) AS valid,
    '{"digest":"' || md5(text) || '"' || CASE WHEN size % 7 = 0 THEN '' ELSE ',"exact":' || CASE WHEN size % 2 = 0 THEN 'true' ELSE 'false' END END
      || ',"words":' || CASE WHEN size % 11 = 0 THEN '"' || size || '"' ELSE size::VARCHAR END || '}' AS arguments
  FROM told t JOIN chain c ON c.conv_id = t.conv_id AND c.turn = t.turn)
SELECT coalesce(c.conv_id, a.conv_id) AS conv_id, 'c' || coalesce(c.turn, a.call_turn) AS call_id, c.rank::BIGINT AS rank,
  coalesce(c.turn, a.turn) AS turn, c.tool, c.valid, c.turn IS NOT NULL AND a.turn IS NOT NULL AS linked,
  '{"arguments":' || coalesce(c.arguments, 'null') || ',"call_id":"c' || coalesce(c.turn, a.call_turn) || '","result":'
    || coalesce(to_json(a.content)::VARCHAR, 'null') || ',"tool":' || coalesce('"' || c.tool || '"', 'null')
    || ',"valid":' || CASE WHEN c.valid THEN 'true' WHEN NOT c.valid THEN 'false' ELSE 'null' END || '}' AS canonical
FROM calls c FULL JOIN answers a ON c.conv_id = a.conv_id AND c.turn = a.call_turn
"""


# -- hard negatives -------------------------------------------------------


@query
def op11_hard_negatives_lemp(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op11_hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


ORACLE["op11_hard_negatives_lemp"] = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM sound a JOIN sound b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""


# -- mixing ---------------------------------------------------------------


@query
def op12_mixing_to_weights(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    planned = op12_mixing.plan_mix(documents)
    return planned.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE["op12_mixing_to_weights"] = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS tokens FROM sized GROUP BY source),
weighted AS (
  SELECT source, tokens, {op12_mixing.MOST} * tokens AS most, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sums),
placed AS (
  SELECT *, (SELECT sum(tokens) FROM weighted) - coalesce(sum(most) OVER before, 0) AS tokens_left,
    (SELECT sum(weight) FROM weighted) - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM weighted WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT tokens_left, weight_left FROM placed WHERE tokens_left * weight <= most * weight_left ORDER BY weight_left DESC LIMIT 1),
targets AS (
  SELECT source, tokens, CASE WHEN most * weight_left < tokens_left * weight THEN CAST(most AS DOUBLE)
    ELSE CAST(tokens_left * weight AS DOUBLE) / CAST(weight_left AS DOUBLE) END AS target FROM weighted, level),
rates AS (
  SELECT doc_id, size, tokens, target, CASE WHEN tokens > 0 THEN target / CAST(tokens AS DOUBLE) ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5('{op12_mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {op12_mixing.DIGITS}) AS BIGINT) AS DOUBLE)
      / {float(16**op12_mixing.DIGITS)!r} AS number
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, tokens AS source_size, target,
  CAST(size * (floor(rate) + CASE WHEN number < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rates
"""


# -- periodic runs --------------------------------------------------------


def with_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, text), where every tenth document, by a hash of its id, ends in repeats of a stretch of its words."""
    number = F.crc32(F.col("doc_id").cast("string"))
    chosen = number % 10 == 0
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(op12_mixing.WORD), F.lit(0)))
    rows = documents.select("doc_id", "text", words.alias("words"), F.floor(number / 10).alias("g"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    rest = n - F.col("a")
    rows = rows.withColumn("p", (F.floor(rest / (F.col("g") % 8 + 3)) + 1).cast("int"))
    stretch = F.slice("words", F.col("a") + 1, F.col("p"))
    repeats = F.slice(F.flatten(F.array_repeat(stretch, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeats), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = op13_periodic.find_runs(with_repeats(documents))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("before"), (-r.period).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    found = found.select("doc_id", "runs", best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.short")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return _pipeline()(spark, folder)
