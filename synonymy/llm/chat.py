"""Chat formatting: tool calls linked to results, in topological order, as canonical JSON.

An assistant's text may be a JSON object with ``tool_calls`` (id, name, arguments) and
``content``; a tool's text a JSON object with ``tool_call_id`` and ``content``.  One pass
parses each text, writes its canonical JSON and gives out the identifiers; what it takes
for no JSON is plain content everywhere.  Calls and results are hash-joined by conversation
and identifier.  A result depends on its call, a call on the results that its arguments
name as ``{"$ref": id}``: the nodes of the order are calls and results, so calls of one
message may use each other's results.  A node without unmet dependencies is placed after
those it depends on, a message where the first of its calls can be made; what is left is
on a cycle.

The dependencies of a conversation are ordered in one task where they are at most
``TASK_EDGES``, and by rounds of joins beyond.  Messages are numbered by one sort over
the whole order, cut into ranges; a conversation that spans ranges carries its count
over, so no task holds a whole conversation.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, cut, only, scratch

#: Arguments by tool: name -> {argument: (JSON type, required)}.  A bounded registry, a parameter of ``link``.
SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculate": {"expression": ("string", True)},
    "fetch": {"url": ("string", True), "timeout": ("number", False)},
}
_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}
#: Dependencies of a conversation that one task orders; larger conversations go by rounds of joins.
TASK_EDGES = 100_000
PARSED = "conv_id long, turn long, role string, hash long, node long, n_calls long, valid boolean, json string, calls array<struct<id:string,call_node:long,refs:array<string>>>, result_id string"


def valid(name: str | None, arguments, schemas: dict) -> bool:
    """Whether the arguments (parsed) fit the tool's schema; references fit any type, unknown tools fit nothing."""
    schema = schemas.get(name) if isinstance(name, str) else None
    if schema is None or not isinstance(arguments, dict) or set(arguments) - set(schema):
        return False
    for key, (kind, required) in schema.items():
        if key not in arguments:
            if required:
                return False
            continue
        x = arguments[key]
        if isinstance(x, dict) and set(x) == {"$ref"}:
            continue
        if not isinstance(x, _TYPES[kind]) or (isinstance(x, bool) and kind != "boolean"):
            return False
    return True


def _load(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError, RecursionError):
        return None


def canonical(value) -> str:
    """Sorted keys, no blanks, characters as they are but for lone surrogates, which stay escaped; numbers that JSON lacks become null."""
    try:
        out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    except ValueError:
        return canonical(json.loads(json.dumps(value), parse_constant=lambda _: None))
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", out)


def _identifier(x) -> str | None:
    """An id as text; ids that are no text by their JSON, null and containers are none."""
    return x if isinstance(x, str) else None if x is None or isinstance(x, (dict, list)) else canonical(x)


def _references(value) -> list[str]:
    """Ids that arguments name as {"$ref": id}, at any depth, once, in order."""
    out, todo = {}, [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if isinstance(x.get("$ref"), str):
                out[x["$ref"]] = None
            todo += reversed(list(x.values()))
        elif isinstance(x, list):
            todo += reversed(x)
    return list(out)


def _message(role, text, schemas: dict) -> tuple[list, bool, str, str | None]:
    """(id and references of each call, whether all are valid, canonical JSON, the id that a result answers) of a message."""
    body = _load(text) if role in ("assistant", "tool") and text is not None and text.lstrip().startswith("{") else None
    out = {"role": role, "content": text}
    if role == "assistant" and isinstance(body, dict) and isinstance(body.get("tool_calls"), list) and body["tool_calls"]:
        made, calls = [], []
        for c in body["tool_calls"]:
            c = c if isinstance(c, dict) else {}
            arguments = _load(c["arguments"]) if isinstance(c.get("arguments"), str) else c.get("arguments")
            made.append({"id": c.get("id"), "name": c.get("name"), "arguments": arguments, "valid": valid(c.get("name"), arguments, schemas)})
            calls.append((_utf8(_identifier(c.get("id"))), [_utf8(x) for x in _references(arguments)]))
        return calls, all(c["valid"] for c in made), canonical(out | {"content": body.get("content"), "tool_calls": made}), None
    answered = _identifier(body.get("tool_call_id")) if role == "tool" and isinstance(body, dict) else None
    if answered is not None:
        out |= {"content": body.get("content"), "tool_call_id": body.get("tool_call_id")}
    return [], True, canonical(out), _utf8(answered)


def _utf8(x: str | None) -> str | None:
    """Lone surrogates, which JSON may name, escaped."""
    return x if x is None else re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", x)


def _parsed(schemas: dict):
    """Messages as JSON, with numbers for them and each of their calls."""
    kind = pa.list_(pa.struct([("id", pa.string()), ("call_node", pa.int64()), ("refs", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() << 40
        for batch in batches:
            got, nodes, calls = [_message(*x, schemas) for x in zip(*(column(batch, c).to_pylist() for c in ("role", "text")), strict=True)], [], []
            for own, _, _, _ in got:
                nodes.append(node)
                calls.append([{"id": i, "call_node": node + k, "refs": refs} for k, (i, refs) in enumerate(own, 1)])
                node += 1 + len(own)
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, c) for c in ("conv_id", "turn", "role", "hash")), pa.array(nodes, pa.int64()), pa.array([len(g[0]) for g in got], pa.int64()), pa.array([g[1] for g in got], pa.bool_()),
                    pa.array([g[2] for g in got], pa.string()), pa.array(calls, kind), pa.array([g[3] for g in got], pa.string()),
                ],
                names=["conv_id", "turn", "role", "hash", "node", "n_calls", "valid", "json", "calls", "result_id"],
            )

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their range, their place in it, and their place in their conversation's part of it."""
    part, pos, conversation, at = TaskContext.get().partitionId(), -1, (), 0
    for batch in batches:
        places = []
        for c in column(batch, "conv_id").to_pylist():
            at = at + 1 if conversation == (c,) else 0
            conversation, pos = (c,), pos + 1
            places.append((pos, at))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array([x[0] for x in places], pa.int64()), pa.array([x[1] for x in places], pa.int64())],
            names=[*batch.schema.names, "part", "pos", "at"],
        )


def _numbered(parts: DataFrame) -> DataFrame:
    """seq from the places in each range: a range's first conversation goes on where the ranges before left it."""
    ends = parts.groupBy("part").agg(F.min(F.struct("pos", "conv_id")).alias("first"), F.max(F.struct("pos", "conv_id", "at")).alias("last"))
    carry, last, n = [], None, 0
    for r in sorted(ends.collect(), key=lambda r: r["part"]):  # a row for each range of the sort
        begin = n if last == (r["first"]["conv_id"],) else 0
        if begin:
            carry.append((r["part"], r["first"]["conv_id"], begin))
        whole = r["first"]["conv_id"] == r["last"]["conv_id"]
        last, n = (r["last"]["conv_id"],), r["last"]["at"] + 1 + (begin if whole else 0)
    more = F.broadcast(parts.sparkSession.createDataFrame(carry, "p int, c long, carry long"))  # a row for each range at most
    out = parts.join(more, (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return out.withColumn("seq", F.col("at") + F.coalesce("carry", F.lit(0).cast("long")))


def _order(table: pa.Table) -> pa.Table:
    """(node, level, after) of one conversation's dependencies; nodes on or behind a cycle are missing."""
    src, dst, src_turn, dst_turn = (table[c].to_pylist() for c in ("src", "dst", "src_turn", "dst_turn"))
    need, out = defaultdict(int), defaultdict(list)
    own = dict(zip(src, src_turn, strict=True)) | dict(zip(dst, dst_turn, strict=True))
    for s, d in zip(src, dst, strict=True):
        out[s].append(d)
        need[d] += 1
    level, after, ready = {n: 0 for n in own}, dict(own), [n for n in own if not need[n]]
    placed = []
    while ready:
        n = ready.pop()
        placed.append(n)
        for d in out[n]:
            level[d], after[d], need[d] = max(level[d], level[n] + 1), max(after[d], after[n]), need[d] - 1
            if not need[d]:
                ready.append(d)
    return pa.table({"node": pa.array(placed, pa.int64()), "level": pa.array([level[n] for n in placed], pa.int32()), "after": pa.array([after[n] for n in placed], pa.int64())})


def _levels(edges: DataFrame, folder: str, most: int) -> DataFrame:
    """(node, level, after): in one task where a conversation has at most ``most`` dependencies, else by rounds."""
    sizes = edges.groupBy("conv_id").agg(F.count("*").alias("edges"))
    sized = edges.join(sizes, "conv_id")
    small = sized.where(F.col("edges") <= most).drop("edges").groupBy("conv_id").applyInArrow(_order, "node long, level int, after long")
    large = sized.where(F.col("edges") > most)
    return small if large.isEmpty() else small.union(_rounds(cut(large, folder, "large"), folder))


def _rounds(edges: DataFrame, folder: str) -> DataFrame:
    """(node, level, after): Kahn's algorithm by rounds over (src, dst, src_turn, dst_turn); nodes on or behind a cycle are missing."""
    need = edges.groupBy("dst").agg(F.count("*").alias("need"))
    roots = edges.select(F.col("src").alias("node"), F.col("src_turn").alias("turn")).distinct().join(need, F.col("node") == need.dst, "left_anti")
    done = cut(roots.select("node", F.lit(0).alias("level"), F.col("turn").alias("after")), folder, "level0")
    i = 0
    while True:
        i += 1
        ready = edges.join(done, edges.src == done.node).groupBy("dst").agg(F.count("*").alias("have"), F.max("level").alias("level"), F.max("after").alias("after"), F.max("dst_turn").alias("own"))
        new = ready.join(need, "dst").where("have = need").join(done, F.col("dst") == done.node, "left_anti")
        new = cut(new.select(F.col("dst").alias("node"), (F.col("level") + 1).alias("level"), F.greatest("after", "own").alias("after")), folder, f"level{i}")
        if new.isEmpty():
            return done
        done = cut(done.union(new), folder, f"placed{i}")


def link(conversations: DataFrame, schemas: dict | None = None, task_edges: int = TASK_EDGES) -> DataFrame:
    """conv_id, turn, role, seq, n_calls, n_linked, valid, status, json for each row of ``conversations`` (conv_id, turn, role, text).

    ``seq`` numbers a conversation's messages from 0 in topological order; ties go by turn,
    role and text.  n_linked counts a message's calls that have a result, or is 1 for a
    linked result.  status: plain, linked, unlinked (a call or result without its
    counterpart) or cycle (a call or result that waits for itself, or for such a one).  A
    result whose id several calls have belongs to the first by turn; of several results each
    is linked.  Texts that are null, or no JSON object to its last character, are plain
    content; ids that are no text count by their JSON; a call whose name is no string, whose
    tool is unknown or whose arguments do not fit is not valid; null turns come first; rows of
    null conv_id are one conversation, never linked; repeated rows stay.  Other columns are
    ignored.
    """
    folder = scratch(conversations.sparkSession)
    rows = only(conversations, "conv_id", "turn", "role", "text").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", F.xxhash64("text").alias("hash"))
    rows = cut(rows.mapInArrow(_parsed(schemas or SCHEMAS), PARSED), folder, "messages")
    key = F.coalesce("turn", F.lit(-(2**62)))
    calls = rows.where("n_calls > 0 and conv_id is not null").select("conv_id", "node", key.alias("turn"), F.inline("calls"))
    owner = calls.where("id is not null").groupBy("conv_id", "id").agg(F.min(F.struct("turn", "call_node", "node")).alias("o")).select("conv_id", "id", F.col("o.call_node").alias("call_node"), F.col("o.turn").alias("call_turn"), F.col("o.node").alias("message"))
    results = rows.where("result_id is not null and conv_id is not null").select("conv_id", F.col("result_id").alias("id"), F.col("node").alias("result_node"), key.alias("result_turn"))
    linked = cut(owner.join(results, ["conv_id", "id"]), folder, "linked")
    refs = calls.select("conv_id", "call_node", "turn", F.explode("refs").alias("id"))
    edges = linked.select("conv_id", F.col("call_node").alias("src"), F.col("call_turn").alias("src_turn"), F.col("result_node").alias("dst"), F.col("result_turn").alias("dst_turn"))
    edges = edges.union(refs.join(linked.select("conv_id", "id", "result_node", "result_turn"), ["conv_id", "id"]).select("conv_id", "result_node", "result_turn", "call_node", "turn")).distinct()
    edges = cut(edges, folder, "edges")
    if edges.isEmpty():
        placed = rows.withColumn("level", F.lit(0)).withColumn("after", key).withColumn("cycle", F.lit(False)).withColumn("n_linked", F.lit(0).cast("long"))
    else:
        levels = _levels(edges, folder, task_edges)
        nodes = cut(edges.select(F.col("src").alias("n")).union(edges.select("dst")).distinct().join(levels, F.col("n") == levels.node, "left").select("n", "level", "after"), folder, "nodes")
        # A message stands where the first of its calls does; calls outside the order can be made at once.
        first = F.min(F.when(F.col("n").isNull() | F.col("level").isNotNull(), F.struct(F.coalesce("after", "turn").alias("after"), F.coalesce("level", F.lit(0)).alias("level"))))
        made = calls.join(nodes, F.col("call_node") == F.col("n"), "left").groupBy("node").agg(first.alias("p"), F.max(F.col("n").isNotNull() & F.col("level").isNull()).alias("cycle")).select("node", "p.level", "p.after", "cycle")
        answers = linked.select("result_node").distinct().join(nodes, F.col("result_node") == F.col("n")).select("result_node", "level", "after", F.col("level").isNull())
        count = linked.select(F.col("message").alias("node"), "call_node").distinct().union(linked.select("result_node", "call_node").distinct()).groupBy("node").agg(F.count("*").alias("n_linked"))
        placed = rows.join(made.union(answers), "node", "left").join(count, "node", "left").withColumn("cycle", F.coalesce("cycle", F.lit(False))).withColumn("n_linked", F.coalesce("n_linked", F.lit(0).cast("long"))).withColumn("level", F.coalesce("level", F.lit(0))).withColumn("after", F.coalesce("after", key))
    whole = F.when(F.col("n_calls") > 0, F.col("n_linked") >= F.col("n_calls")).otherwise(F.col("n_linked") > 0)
    status = F.when((F.col("n_calls") == 0) & F.col("result_id").isNull(), "plain").when(F.col("cycle"), "cycle").when(whole, "linked").otherwise("unlinked")
    order = ["conv_id", "after", "level", "turn", "role", "hash", "node"]
    ready = placed.select("conv_id", "turn", "role", "n_linked", status.alias("status"), "n_calls", "valid", "json", "after", "level", "hash", "node").repartitionByRange(*order).sortWithinPartitions(*order)
    ready = ready.mapInArrow(_placed, "conv_id long, turn long, role string, n_linked long, status string, n_calls long, valid boolean, json string, after long, level int, hash long, node long, part int, pos long, at long")
    return _numbered(cut(ready, folder, "formatted")).select("conv_id", "turn", "role", "seq", "n_calls", "n_linked", "valid", "status", "json")


def op8_chat_formatting(spark, sf_dir):
    return link(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
