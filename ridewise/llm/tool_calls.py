"""Tool-call linking (native): joins calls with their results by identifier,
orders messages topologically, validates arguments against schemas and
serialises canonical JSON, all with DataFrame functions.

Messages come as one table with the columns ``thread, seq, kind, id,
parent_id, call_id, name, payload``: ``kind`` is ``call``, ``result`` or
anything else; a result's ``call_id`` names the call it answers; a call's
``payload`` holds its arguments as JSON, a result's its content. A message
follows ``parent_id``. A missing parent makes it a root.

No step brings a thread together: joins and grouped aggregates are keyed by
message, so a thread with a third of all messages spreads like any other.
Levels come from pointer doubling, log2 of the longest chain rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, join_side

#: JSON Schema type -> pattern of Spark's name for a variant's type
TYPES = {"string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
         "boolean": "^BOOLEAN$", "array": "^ARRAY<.*>$", "object": "^OBJECT<.*>$"}


def _argument_errors(args: Column, fields: dict[str, dict]) -> list[Column]:
    out = []
    for name, rule in sorted(fields.items()):
        quote = '"' if "'" in name else "'"        # a name with both kinds has no path
        path = f"$[{quote}{name}{quote}]"
        value = F.try_variant_get(args, path, "variant")
        kind = F.schema_of_variant(value)
        there = value.isNotNull() & (kind != "VOID")
        if rule.get("required"):
            out.append(F.when(~F.coalesce(there, F.lit(False)), F.lit(f"missing {name}")))
        fits = kind.rlike(TYPES[rule["type"]])
        out.append(F.when(there & ~fits, F.lit(f"type {name}")))
        if rule["type"] == "string":
            size = F.length(F.try_variant_get(args, path, "string"))
            lo, hi = rule.get("minLength"), rule.get("maxLength")
        elif rule["type"] in ("integer", "number"):
            size = F.try_variant_get(args, path, "double")
            lo, hi = rule.get("minimum"), rule.get("maximum")
        else:
            continue
        if lo is not None:
            out.append(F.when(there & fits & (size < lo), F.lit(f"small {name}")))
        if hi is not None:
            out.append(F.when(there & fits & (size > hi), F.lit(f"large {name}")))
        if rule.get("enum"):
            out.append(F.when(there & fits & ~F.try_variant_get(args, path, "string").isin(*map(str, rule["enum"])),
                              F.lit(f"value {name}")))
    return out


def validation_errors(name: Column, args: Column, schemas: dict[str, dict[str, dict]]) -> Column:
    """Sorted list of what is wrong with a call. ``args`` is a variant;
    ``schemas`` maps a tool to its fields (``type``, ``required``, bounds, ``enum``)."""
    known = F.coalesce(name.isin(*schemas), F.lit(False)) if schemas else F.lit(False)
    is_object = F.coalesce(F.schema_of_variant(args).startswith("OBJECT<"), F.lit(False))
    found = [F.when(~known, F.lit("unknown tool")), F.when(~is_object, F.lit("not an object"))]
    for tool, fields in sorted(schemas.items()):
        found += [F.when(is_object & (name == tool), e) for e in _argument_errors(args, fields)]
    return F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull()))


def levels(messages: DataFrame) -> DataFrame:
    """``thread, id, level``: steps to the root of each message; null on a
    cycle or behind one. Of messages with one id the earliest counts. Each round doubles the reach; a round without a newly
    finished message while some are open proves that the rest is cyclic."""
    keep = messages.where(F.col("id").isNotNull())
    nodes = join_side(keep.groupBy("thread", "id").agg(F.min(F.struct("seq", "parent_id")).alias("first"))
                          .select("thread", "id", F.col("first.parent_id").alias("ptr")), "messages-by-id")
    ids = nodes.select("thread", F.col("id").alias("ptr"), F.lit(True).alias("there"))
    state = cut_lineage(nodes.join(ids.withColumn("__t", F.col("thread")).drop("thread"),
                                   nodes["thread"].eqNullSafe(F.col("__t")) & (nodes["ptr"] == ids["ptr"]), "left")
                             .select("thread", "id", F.when(F.col("there"), nodes["ptr"]).alias("ptr"),
                                     F.when(F.col("there"), 1).otherwise(0).cast("long").alias("dist")), "levels")
    open_now = state.where(F.col("ptr").isNotNull()).count()
    while open_now:
        to = state.select(F.col("thread").alias("__t"), F.col("id").alias("__i"), F.col("ptr").alias("ptr2"),
                          F.col("dist").alias("dist2"))
        ahead = state.where(F.col("ptr").isNotNull())              # finished messages take no part
        state = cut_lineage(
            ahead.join(to, ahead["thread"].eqNullSafe(F.col("__t")) & (ahead["ptr"] == F.col("__i")))
                 .select("thread", "id", F.col("ptr2").alias("ptr"), (F.col("dist") + F.col("dist2")).alias("dist"))
                 .unionByName(state.where(F.col("ptr").isNull())), "levels")
        left = state.where(F.col("ptr").isNotNull()).count()
        if left == open_now:
            break
        open_now = left
    return state.select("thread", "id", F.when(F.col("ptr").isNull(), F.col("dist")).alias("level"))


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """One row per call and per result that no call takes: thread, seq, id,
    status, level, valid, errors, record.

    ``status``: ``linked``, ``unanswered``, ``duplicate`` (a later call with a
    used id), ``orphan`` (a result without a call), ``extra`` (a later result
    of an answered call). ``record`` is JSON with sorted keys, no white space
    and no null fields; arguments are parsed and written anew.

    * null id of a call: ``unanswered``; null call_id of a result: ``orphan``
    * null thread: a thread of its own; null or broken arguments: not an object
    * ties (same thread, id and seq): the smaller payload counts as the earlier
    * repeated rows: one links, the others are ``duplicate`` or ``extra``
    * very long payloads are one row each; empty table: empty result
    * other columns are not read
    """
    m = messages.select("thread", F.col("seq").cast("long").alias("seq"), "kind", F.col("id").cast("string").alias("id"),
                        F.col("parent_id").cast("string").alias("parent_id"), F.col("call_id").cast("string").alias("call_id"),
                        "name", F.col("payload").cast("string").alias("payload"))
    m = cut_lineage(m.withColumn("ord", F.monotonically_increasing_id()), "messages")
    first = F.struct(F.col("seq"), F.col("payload"), F.col("ord"))
    calls = m.where(F.col("kind") == "call")
    results = m.where(F.col("kind") == "result")
    used = join_side(calls.where(F.col("id").isNotNull()).groupBy("thread", "id").agg(F.min(first).getField("ord").alias("ord"))
                          .select(F.col("thread").alias("t"), F.col("id").alias("i"), F.col("ord").alias("first_call")), "first-calls")
    answer = join_side(results.where(F.col("call_id").isNotNull()).groupBy("thread", "call_id").agg(F.min(first).alias("r"))
                              .select(F.col("thread").alias("rt"), F.col("call_id").alias("ri"), F.col("r.ord").alias("first_result"),
                                      F.col("r.payload").alias("content"), F.col("r.seq").alias("result_seq")), "first-results")
    pair = used.join(answer.hint("shuffle_hash"), F.col("t").eqNullSafe(F.col("rt")) & (F.col("i") == F.col("ri")), "left") \
               .select("t", "i", "first_call", "first_result", "content", "result_seq")
    # a call row takes its result only if it is the first with its id
    c = (calls.join(pair.hint("shuffle_hash"), calls["ord"] == pair["first_call"], "left")
              .select("thread", "seq", "id", "name", "payload", "content", "result_seq",
                      F.when(F.col("id").isNotNull() & F.col("first_call").isNull(), "duplicate")
                       .when(F.col("first_result").isNotNull(), "linked").otherwise("unanswered").alias("status")))
    r = (results.join(used.hint("shuffle_hash"), results["thread"].eqNullSafe(F.col("t")) & (results["call_id"] == F.col("i")), "left")
                .join(answer.select("first_result").hint("shuffle_hash"), results["ord"] == F.col("first_result"), "left")
                .where(F.col("first_call").isNull() | F.col("first_result").isNull())
                .select("thread", "seq", "id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("payload"),
                        F.col("payload").alias("content"), F.col("seq").alias("result_seq"),
                        F.when(F.col("first_call").isNull(), "orphan").otherwise("extra").alias("status")))
    rows = c.unionByName(r).withColumn("args", F.try_parse_json("payload"))
    is_call = F.col("status").isin("linked", "unanswered", "duplicate")
    errors = F.when(is_call, validation_errors(F.col("name"), F.col("args"), schemas))
    record = F.to_json(F.struct(F.col("args").alias("arguments"), F.col("content"), F.col("id"), F.col("name"),
                                F.col("result_seq"), F.col("seq"), F.col("status")))
    lv = levels(m).select(F.col("thread").alias("lt"), F.col("id").alias("li"), "level")
    out = rows.select("thread", "seq", "id", "status", (F.size(errors) == 0).alias("valid"), errors.alias("errors"),
                      record.alias("record"))
    return (out.join(lv, out["thread"].eqNullSafe(F.col("lt")) & (out["id"] == F.col("li")), "left")
               .select("thread", "seq", "id", "status", "level", "valid", "errors", "record")
               .orderBy("thread", "level", "seq", "id", "status"))
