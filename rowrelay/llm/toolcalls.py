"""Tool calls and their results: linked by identifier, ordered, checked and serialised.

All in DataFrame functions. No conversation is gathered in one row or task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from rowrelay.llm.common import saved

#: The JSON types of a schema, as Spark names the type of a value.
_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*", "null": "VOID"}


def _edges(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The calls, each once, with the number of known calls they wait for; and those edges (conv, id, up)."""
    listed = isinstance(calls.schema["after"].dataType, ArrayType)
    after = F.col("after") if listed else F.array("after")
    nodes = calls.select("conv", "id").distinct()
    wanted = calls.select("conv", "id", F.explode(after).alias("up")).where("up IS NOT NULL").distinct()
    first = nodes.select(F.col("conv").alias("pc"), F.col("id").alias("pid"))
    edges = wanted.join(first, (F.col("conv") == F.col("pc")) & (F.col("up") == F.col("pid"))).select("conv", "id", "up")
    edges = saved(edges, "edges")
    number = edges.groupBy(F.col("conv").alias("pc"), F.col("id").alias("pid")).agg(F.count("*").alias("waits"))
    nodes = nodes.join(number, (F.col("conv") == F.col("pc")) & (F.col("id") == F.col("pid")), "left")
    return saved(nodes.select("conv", "id", F.coalesce("waits", F.lit(0)).alias("waits")), "calls"), edges


def _anchored(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv, id, up, dist, ended) of the calls that wait for one: ``up`` is the call at the end of their chain.

    A chain ends at a call that waits for none or for several. Pointer doubling: a chain
    of n calls takes about log2(n) joins. A chain on a cycle never ends.
    """
    above = nodes.select(F.col("conv").alias("pc"), F.col("id").alias("pid"), (F.col("waits") != 1).alias("ended"))
    one = nodes.where("waits = 1").select("conv", "id").join(edges, ["conv", "id"])
    one = one.join(above, (F.col("conv") == F.col("pc")) & (F.col("up") == F.col("pid")))
    state = saved(one.select("conv", "id", "up", F.lit(1).cast("long").alias("dist"), "ended"), "chains")
    most = state.where("NOT ended").count()
    for _ in range(math.ceil(math.log2(most + 1)) + 1 if most else 0):
        if state.where("NOT ended").isEmpty():
            break
        above = state.select(F.col("conv").alias("pc"), F.col("id").alias("pid"), F.col("up").alias("next"), F.col("dist").alias("more"), F.col("ended").alias("end"))
        going = state.where("NOT ended").join(above, (F.col("conv") == F.col("pc")) & (F.col("up") == F.col("pid")))
        going = going.select("conv", "id", F.col("next").alias("up"), (F.col("dist") + F.col("more")).alias("dist"), F.col("end").alias("ended"))
        state = saved(state.where("ended").unionByName(going), "chains")
    return state


def _joints(nodes: DataFrame, edges: DataFrame, chains: DataFrame) -> DataFrame:
    """(conv, id, level) of the calls that wait for several, longest paths relaxed from the first calls on.

    Chains between them count as one edge, so the rounds are the joints on a path. A joint
    is settled once all it waits for is; those on a cycle or behind one never are.
    """
    chain = chains.where("ended").select(F.col("conv").alias("pc"), F.col("id").alias("pid"), F.col("up").alias("anchor"), "dist")
    ends = nodes.select(F.col("conv").alias("pc"), F.col("id").alias("pid"), "waits")
    into = nodes.where("waits > 1").select("conv", "id").join(edges, ["conv", "id"])
    into = into.join(chain, (F.col("conv") == F.col("pc")) & (F.col("up") == F.col("pid")), "left").drop("pc", "pid")
    into = into.withColumn("dist", F.coalesce("dist", F.lit(0)) + 1).withColumn("anchor", F.coalesce("anchor", "up"))
    into = into.join(ends, (F.col("conv") == F.col("pc")) & (F.col("anchor") == F.col("pid")))
    # A call that waits for one and has no end of its chain is on a cycle: its level stays unknown.
    into = saved(into.select("conv", "id", "anchor", "dist", F.when(F.col("waits") == 0, F.lit(0).cast("long")).alias("level")), "joints")
    settled = into.select("conv", "id", "level").limit(0)
    while True:
        place = into.groupBy("conv", "id").agg(F.count_if(F.col("level").isNull()).alias("open"), F.max(F.col("level") + F.col("dist")).alias("level"))
        fresh = saved(place.where("open = 0").select("conv", "id", "level"), "settled")
        if fresh.isEmpty():
            return settled
        settled = settled.unionByName(fresh)
        rest = into.join(fresh.select("conv", "id"), ["conv", "id"], "left_anti")
        found = fresh.select(F.col("conv").alias("pc"), F.col("id").alias("pid"), F.col("level").alias("known"))
        rest = rest.join(found, (F.col("conv") == F.col("pc")) & (F.col("anchor") == F.col("pid")), "left")
        into = saved(rest.select("conv", "id", "anchor", "dist", F.coalesce("level", "known").alias("level")), "joints")


def ordered(calls: DataFrame) -> DataFrame:
    """(conv, id, level, cyclic): the place of each call in a topological order.

    ``calls`` has conv, id and after: the id of the call that must come first, an array
    of such ids, or null. A call's level is the length of the longest path of calls
    before it; ordering by level puts every call behind all those it waits for. Unknown
    ids count for nothing; what several rows of an id wait for counts together. Calls on
    a cycle, or behind one, have no level and are marked cyclic.
    """
    nodes, edges = _edges(calls)
    chains = _anchored(nodes, edges)
    joints = _joints(nodes, edges, chains) if not nodes.where("waits > 1").isEmpty() else None
    first = nodes.where("waits = 0").select("conv", "id", F.lit(0).cast("long").alias("level"))
    if joints is None:
        rest = chains.select("conv", "id", F.when(F.col("ended"), F.col("dist")).alias("level"))
    else:
        base = joints.select(F.col("conv").alias("pc"), F.col("id").alias("pid"), "level")
        base = base.unionByName(first.select(F.col("conv").alias("pc"), F.col("id").alias("pid"), "level"))
        rest = chains.where("ended").join(base, (F.col("conv") == F.col("pc")) & (F.col("up") == F.col("pid")), "left")
        rest = rest.select("conv", "id", (F.col("level") + F.col("dist")).alias("level"))
        rest = rest.unionByName(chains.where("NOT ended").select("conv", "id", F.lit(None).cast("long").alias("level")))
        own = nodes.where("waits > 1").select("conv", "id").join(joints, ["conv", "id"], "left")
        rest = rest.unionByName(own)
    return first.unionByName(rest).withColumn("cyclic", F.col("level").isNull())


def answers(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(conv, id, content, status) of every result, repeats included.

    A result is linked to the calls of its id in its conversation, an orphan if there is
    none, and unnamed without an id. A null conversation is the one with an empty name.
    """
    known = calls.select(F.coalesce("conv", F.lit("")).alias("kc"), F.col("id").alias("kid")).where("kid IS NOT NULL").distinct().withColumn("known", F.lit(True))
    own = results.select("conv", "id", "content").withColumn("key", F.coalesce("conv", F.lit("")))
    named = own.where("id IS NOT NULL").join(known, (F.col("key") == F.col("kc")) & (F.col("id") == F.col("kid")), "left")
    named = named.select("conv", "id", "content", F.when(F.col("known"), "linked").otherwise("orphan").alias("status"))
    return named.unionByName(own.where("id IS NULL").select("conv", "id", "content", F.lit("unnamed").alias("status")))


def faults(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call's arguments (variant; null if they aren't JSON), as a sorted array of texts.

    A schema has ``properties`` (name to {"type": ...}) and ``required``, as in JSON
    Schema. Unknown tools, texts that are no JSON object, missing required and unknown
    fields, and values of another type are faults.
    """
    kind = F.schema_of_variant(arguments)
    checks = F.array(F.lit("unknown tool"))
    for tool, schema in sorted(schemas.items()):
        fields = schema.get("properties", {})
        found = []
        for field, rule in sorted(fields.items()):
            value = F.variant_get(arguments, f"$['{field}']", "variant")
            wrong = ~F.regexp_like(F.schema_of_variant(value), F.lit(f"^{_TYPES[rule['type']]}$")) if "type" in rule else F.lit(False)
            missing = F.lit(f"missing {field}") if field in schema.get("required", ()) else F.lit(None).cast("string")
            found.append(F.when(value.isNull(), missing).when(wrong, F.lit(f"type of {field}")))
        allowed = F.array(*[F.lit(f) for f in sorted(fields)]) if fields else F.array().cast("array<string>")
        keys = F.json_object_keys(F.to_json(arguments))
        unknown = F.transform(F.array_except(keys, allowed), lambda k: F.concat(F.lit("unknown "), k))
        own = F.array_sort(F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>"), unknown))
        checks = F.when(name == tool, own).otherwise(checks)
    return F.when(arguments.isNull() | ~F.startswith(kind, F.lit("OBJECT")), F.array(F.lit("no object"))).otherwise(checks)


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call and for each identifier that has results but no call.

    ``calls``: conv, id, after, name, arguments (JSON text); ``results``: conv, id,
    content. Returns conv, id, status (linked, unanswered, orphan), level, cyclic, n_results,
    faults (joined by "; "), valid and json. json is canonical: keys in order, no
    spaces, arguments parsed (as text if they are no JSON), the first result by
    content (:func:`answers` gives every one a row); nulls are written. ``after`` is an
    id or an array of ids.

    Ids are unique within a conversation. Rows of calls that repeat each get a row;
    results of one id are joined as one. A null conversation is the one with an empty
    name; a call or result without an id links to nothing. Empty tables give no rows.
    """
    place = ordered(calls.where("id IS NOT NULL").select(F.coalesce("conv", F.lit("")).alias("conv"), "id", "after"))
    place = place.select(F.col("conv").alias("oc"), F.col("id").alias("oid"), "level", "cyclic")
    given = results.select(F.coalesce("conv", F.lit("")).alias("rc"), F.col("id").alias("rid"), "content")
    replies = given.where("rid IS NOT NULL").groupBy("rc", "rid").agg(F.count("*").alias("n_results"), F.min("content").alias("content"))
    own = calls.select("conv", "id", "after", "name", "arguments", F.coalesce("conv", F.lit("")).alias("key"))
    own = own.join(place, (F.col("key") == F.col("oc")) & (F.col("id") == F.col("oid")), "left")
    both = own.join(replies.hint("shuffle_hash"), (F.col("key") == F.col("rc")) & (F.col("id") == F.col("rid")), "left")
    known = calls.select(F.coalesce("conv", F.lit("")).alias("key"), "id").where("id IS NOT NULL").distinct()
    lost = replies.join(known, (F.col("rc") == F.col("key")) & (F.col("rid") == F.col("id")), "left_anti")

    parsed = F.try_parse_json("arguments")
    rows = both.withColumn("parsed", parsed).withColumn("faults", faults(F.coalesce("name", F.lit("")), F.col("parsed"), schemas))
    answered = F.coalesce("n_results", F.lit(0))
    arguments = F.coalesce("parsed", F.col("arguments").cast("variant"))
    record = F.struct(F.col("after").alias("after"), arguments.alias("arguments"), F.col("conv").alias("conversation"), F.col("id").alias("id"), F.col("level").alias("level"), F.col("name").alias("name"), F.col("content").alias("result"))
    rows = rows.select(
        "conv", "id", F.when(answered > 0, "linked").otherwise("unanswered").alias("status"), "level", F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        answered.alias("n_results"), F.array_join("faults", "; ").alias("faults"), ((F.size("faults") == 0) & ~F.coalesce("cyclic", F.lit(False))).alias("valid"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("json"),
    )
    orphan = F.struct(F.col("rc").alias("conversation"), F.col("rid").alias("id"), F.col("content").alias("result"))
    lost = lost.select(
        F.col("rc").alias("conv"), F.col("rid").alias("id"), F.lit("orphan").alias("status"), F.lit(None).cast("long").alias("level"), F.lit(False).alias("cyclic"),
        "n_results", F.lit("no call").alias("faults"), F.lit(False).alias("valid"), F.to_json(orphan, {"ignoreNullFields": "false"}).alias("json"),
    )
    return rows.unionByName(lost)


#: The tool of plain conversations: an answer is asked for.
REPLY = {"reply": {"properties": {"chars": {"type": "integer"}, "text": {"type": "string"}, "turn": {"type": "integer"}}, "required": ["chars", "text", "turn"]}}


def exchanges(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text).

    A user turn calls the tool ``reply``; the assistant turn after it is its result. A
    call follows that of two turns before, if there was one. Both are named by the
    conversation and the call's turn.
    """
    conv, text = F.col("conv_id").cast("string"), F.col("text")
    name = lambda turn: F.concat(F.coalesce(conv, F.lit("")), F.lit(":"), turn.cast("string"))
    arguments = F.to_json(F.struct(F.length(text).alias("chars"), text.alias("text"), F.col("turn").alias("turn")), {"ignoreNullFields": "false"})
    calls = turns.where("role = 'user'").select(conv.alias("conv"), name(F.col("turn")).alias("id"), name(F.col("turn") - 2).alias("after"), F.lit("reply").alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'assistant'").select(conv.alias("conv"), name(F.col("turn") - 1).alias("id"), text.alias("content"))
    return calls, results
