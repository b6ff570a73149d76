"""Tool-call linking: calls meet their results, in order, checked and serialised.

Inputs are three tables: ``calls`` (conv_id, turn, call_id, tool, arguments as
JSON text, after: ids of the calls whose results it needs), ``results``
(conv_id, turn, call_id, content), and ``schemas`` (tool, param, kind, required), a
short list.  Calls and results are joined by conversation and call id.  Of
several results of a call the first turn counts, of calls that repeat an id too.

Order: the rank of a call is the length of the longest chain of calls that it
needs, so a call comes after all of them; equal ranks go by turn and id.  A call
that needs one other points at it, and pointers jump over pointers, so each
finds the top of its chain (a call that needs none, or several) in as many rounds
as the logarithm of the chain's length.  Calls that need several settle once
the tops below them have.  Each round is one join and a written table; a call in
a circle, or one that needs such a call, never settles and has rank -1.
Needed ids that no call of the conversation has are no constraint.

Arguments are valid if they are a JSON object without repeated keys, of a known
tool, every required parameter is there and not null, and every parameter is known
and of its kind: string, integer, number, boolean, array or object.  A schema row
without a parameter only says that there is the tool, one without a kind allows
any; a parameter listed with several kinds may have each.

Each row is serialised as canonical JSON: keys sorted, no spaces, numbers in
their shortest form, the arguments likewise.

Everything is DataFrame expressions, and no row gathers a conversation, so one
that holds a third of all calls is dealt like any other.  Defined cases: rows
with a null conversation or call id link to nothing and are left out; a null
or broken argument string is invalid and serialised as null; a result
without a call is a row with null tool and rank, a call without a result one
with null content; repeated rows count once; empty tables give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch.session import discard, scratch_path

KEY = ["conv_id", "call_id"]
UNSETTLED = -1


def _first(rows: DataFrame, *fields: str) -> DataFrame:
    """One row for each call id of a conversation: that of the first turn."""
    named = rows.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    first = named.groupBy(*KEY).agg(F.min(F.struct("turn", *fields)).alias("first"))
    return first.select(*KEY, "first.*")


def ranks(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, rank) of a table (conv_id, call_id, after) of distinct calls."""
    spark = calls.sparkSession
    ids = calls.select(*KEY)
    needs = (
        calls.select(*KEY, F.explode(F.array_distinct("after")).alias("need"))
        .join(ids.select(F.col("conv_id").alias("c"), F.col("call_id").alias("need_id")), (F.col("conv_id") == F.col("c")) & (F.col("need") == F.col("need_id")))
        .select(*KEY, "need")
    )
    needs_path = scratch_path(spark, "needs")
    needs.write.parquet(needs_path)
    needs = spark.read.parquet(needs_path)
    counted = needs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
    single = F.coalesce("n", F.lit(0)) == 1
    chain = ids.join(counted, KEY, "left").select(
        *KEY,
        F.when(single, F.col("need")).otherwise(F.col("call_id")).alias("top"),
        single.cast("long").alias("steps"),
        (~single).alias("done"),
        (F.coalesce("n", F.lit(0)) > 1).alias("several"),
    )
    chain, path, open_ = _rewritten(chain, None)
    while open_:
        ahead = chain.select(F.col("conv_id").alias("c"), F.col("call_id").alias("at"), F.col("top").alias("t"), F.col("steps").alias("s"), F.col("done").alias("d"))
        ready = chain.where("done").unionByName(
            chain.where("not done")
            .join(ahead, (F.col("conv_id") == F.col("c")) & (F.col("top") == F.col("at")))
            .select(*KEY, F.col("t").alias("top"), (F.col("steps") + F.col("s")).alias("steps"), F.col("d").alias("done"), "several")
        )
        before = open_
        chain, path, open_ = _rewritten(ready, path)
        if open_ == before:
            break

    tops = chain.where("done and several").select(*KEY, F.lit(UNSETTLED).cast("long").alias("rank"), F.lit(False).alias("done"))
    tops, tops_path, open_ = _rewritten(tops, None)
    through = needs.join(chain.where("several").select(*KEY), KEY, "left_semi").join(
        chain.select(F.col("conv_id").alias("c"), F.col("call_id").alias("at"), "top", "steps", F.col("done").alias("ends")),
        (F.col("conv_id") == F.col("c")) & (F.col("need") == F.col("at")),
    )
    through = through.select(*KEY, "top", F.when(F.col("ends"), F.col("steps")).alias("steps"))
    while open_:
        known = tops.select(F.col("conv_id").alias("c"), F.col("call_id").alias("at"), F.col("rank").alias("r"), F.col("done").alias("d"))
        # A top that isn't among them needs none: rank 0.  Without steps it leads into a circle.
        ready = (
            through.join(known, (F.col("conv_id") == F.col("c")) & (F.col("top") == F.col("at")), "left")
            .groupBy(*KEY)
            .agg(F.min(F.coalesce("d", F.lit(True)) & F.col("steps").isNotNull()).alias("all"), F.max(F.col("steps") + F.coalesce("r", F.lit(0)) + 1).alias("now"))
            .where("all")
            .select(*KEY, "now")
        )
        step = tops.join(ready, KEY, "left").select(*KEY, F.coalesce("now", "rank").alias("rank"), F.col("now").isNotNull().alias("done"))
        before = open_
        tops, tops_path, open_ = _rewritten(step, tops_path)
        if open_ == before:
            break
    found = tops.select(F.col("conv_id").alias("c"), F.col("call_id").alias("at"), F.when(F.col("done"), F.col("rank")).otherwise(UNSETTLED).alias("r"))
    return chain.join(found, (F.col("conv_id") == F.col("c")) & (F.col("top") == F.col("at")), "left").select(
        *KEY, F.when(~F.col("done") | (F.col("r") == UNSETTLED), F.lit(UNSETTLED)).otherwise(F.col("steps") + F.coalesce("r", F.lit(0))).alias("rank")
    )


def _rewritten(rows: DataFrame, old: str | None) -> tuple[DataFrame, str, int]:
    """The rows as a written table, its path, and how many of them aren't done; ``old`` goes."""
    path = scratch_path(rows.sparkSession, "ranks")
    rows.write.parquet(path)
    if old:
        discard(rows.sparkSession, old)
    rows = rows.sparkSession.read.parquet(path)
    return rows, path, rows.where("not done").count()


def _kind(value: Column) -> Column:
    """The kind of a JSON value: string, integer, number, boolean, array, object or null."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "STRING", "string")
        .when(name == "BIGINT", "integer")
        .when(name.startswith("DECIMAL(") & name.endswith(",0)"), "integer")
        .when(name.startswith("DECIMAL") | (name == "DOUBLE"), "number")
        .when(name == "BOOLEAN", "boolean")
        .when(name.startswith("ARRAY"), "array")
        .when(name.startswith("OBJECT"), "object")
        .otherwise("null")
    )


def _parsed(arguments: str) -> Column:
    return F.try_variant_get(F.try_parse_json(arguments), "$", "map<string,variant>")


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with valid, a boolean; schemas are one row for each tool beside them."""
    by_tool = schemas.groupBy(F.col("tool").alias("known_tool")).agg(
        F.collect_set(F.when(F.col("param").isNotNull(), F.struct("param", "kind"))).alias("kinds"),
        F.collect_set(F.when(F.col("required"), F.col("param"))).alias("required"),
    )
    entries = F.map_entries(F.col("given"))

    def allows(given: Column, param: Column) -> Column:
        kind = _kind(given["value"])
        like = (param["kind"] == kind) | ((kind == "integer") & (param["kind"] == "number"))
        return (param["param"] == given["key"]) & ((kind == "null") | param["kind"].isNull() | like)

    fits = F.forall(entries, lambda e: F.exists("kinds", lambda k: allows(e, k)))
    there = F.transform(F.filter(entries, lambda e: _kind(e["value"]) != "null"), lambda e: e["key"])
    complete = F.size(F.array_except("required", there)) == 0
    joined = calls.withColumn("given", _parsed("arguments")).join(by_tool, F.col("tool") == F.col("known_tool"), "left")
    return joined.withColumn("valid", F.coalesce(fits & complete, F.lit(False))).drop("given", "kinds", "required", "known_tool")


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call id: (conv_id, call_id, rank, turn, tool, valid, linked, canonical).

    Sorted by conv_id, rank, turn and call_id, the rows are a conversation's
    calls in order.
    """
    told = _first(calls, "tool", "arguments", "after")
    path = scratch_path(calls.sparkSession, "calls")
    validated(told, schemas).write.parquet(path)
    told = calls.sparkSession.read.parquet(path)
    ranked = told.join(ranks(told.select(*KEY, "after")), KEY)
    answers = _first(results, "content").select(*KEY, F.col("turn").alias("result_turn"), "content")
    both = ranked.join(answers, KEY, "full")
    body = F.struct(
        F.when(F.col("valid") | _parsed("arguments").isNotNull(), F.try_parse_json("arguments")).alias("arguments"),
        F.col("call_id"),
        F.col("content").alias("result"),
        F.col("tool"),
        F.col("valid"),
    )
    return both.select(
        *KEY,
        F.col("rank").cast("long").alias("rank"),
        F.coalesce("turn", "result_turn").alias("turn"),
        "tool",
        "valid",
        (F.col("turn").isNotNull() & F.col("result_turn").isNotNull()).alias("linked"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("canonical"),
    )
