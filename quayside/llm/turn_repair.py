"""Repair of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``, the least audit string among equals.

A conversation is a chain of turns.  Between two turns one of four states holds: nothing said yet, or the last speaker was
the system, the user or the assistant.  An element of the chain (a turn, or a stretch of turns) takes one state to
another at a cost; of the edits of least cost, those whose initials come first in ASCII order count.  Two audits that
consume the same turns never begin one another (each ends with a turn's own letter, inserts come before it), so a rank
among the states stands for the order of the audits that lead there.

Hirschberg: cost vectors of the four states are carried forward from the entry and backward from the exit and meet in
the middle; the crossing state of least cost, and of least rank among those, is on the best chain; both halves are solved in the same
way.  Only vectors are held, no table over the turns.

On a table the same recursion runs over levels.  Turns are numbered by running sums over ranges and cut into blocks, blocks into
blocks of blocks, until a conversation is one node.  On the way up each node is summed up as a 4 x 4 matrix of costs and
ranks; on the way down the states where its parts meet are chosen.  So a conversation of any length is spread over tasks, each of
which holds at most ``BLOCK`` parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quayside.llm.common import SPACE_CHARS, prepare, stored
from quayside.llm.ordered import running_sums

BLOCK = 4096
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
ENTERED_BY = ("", "s", "u", "a")              # initial of the role that leads to a state
NEXT = (USER, USER, ASSISTANT, USER)          # the state an insert or a new role leads to
ROLE = ("", "system", "user", "assistant")
RULE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
FAR = 1 << 60                                 # no way
AT_END = (0, 4, 2, 0)                         # inserts that complete a chain that ends in the state
END_EDITS = ("", "II", "I", "")

Node = tuple[tuple[int, ...], tuple[int, ...]]  # cost and rank of going from state p to state t, at 4 p + t


@lru_cache(maxsize=None)
def turn_edits(initial: str, must_delete: bool, truncated: bool) -> tuple[tuple[int, str | None], ...]:
    """(cost, edits) of taking state p to state t over one turn, at 4 p + t; the edits are inserts, then the turn's own."""
    best: list[tuple[int, str | None]] = [(FAR, None)] * 16
    for p in STATES:
        q, before = p, ""
        for inserts in range(3):
            ways = [(DELETE_COST, "D", q)]
            if not must_delete:
                extra = TRUNCATED_COST if truncated else 0
                ways.append((RULE_COST + extra, "R", NEXT[q]))
                keeps = [t for t in (NEXT[q], SYSTEM) if ENTERED_BY[t] == initial and (t != SYSTEM or q == START)]
                ways += [(extra, "K", t) for t in keeps]
            for cost, letter, t in ways:
                found = (inserts * INSERT_COST + cost, before + letter)
                if best[4 * p + t][1] is None or found < best[4 * p + t]:
                    best[4 * p + t] = found
            q, before = NEXT[q], before + "I"
    return tuple(best)


@lru_cache(maxsize=None)
def turn_node(initial: str, must_delete: bool, truncated: bool) -> Node:
    edits = turn_edits(initial, must_delete, truncated)
    ranks = []
    for p in STATES:
        said = sorted(e for _, e in edits[4 * p:4 * p + 4] if e is not None)
        ranks += [0 if e is None else said.index(e) for _, e in edits[4 * p:4 * p + 4]]
    return tuple(c for c, _ in edits), tuple(ranks)


def step(vector: Sequence[tuple[int, int]], node: Node) -> list[tuple[int, int]]:
    """The forward vector, (cost, rank) per state, after ``node``."""
    cost, rank = node
    reached = []
    for t in STATES:
        found = min((vector[p][0] + cost[4 * p + t], vector[p][1], rank[4 * p + t]) for p in STATES)
        reached.append(found if found[0] < FAR else (FAR, 4, 4))
    order = sorted(STATES, key=lambda t: reached[t][1:])
    place = {t: k for k, t in enumerate(order)}
    return [(reached[t][0], place[t]) for t in STATES]


def step_back(vector: Sequence[int], node: Node) -> list[int]:
    """The cost from each state over ``node`` to the exit, given the cost from each state after it."""
    cost = node[0]
    return [min(FAR, *(cost[4 * p + t] + vector[t] for t in STATES)) for p in STATES]


def entry_vector(p: int) -> list[tuple[int, int]]:
    return [(0, 0) if s == p else (FAR, s) for s in STATES]


def chain(nodes: Sequence[Node]) -> Node:
    """``nodes`` one after the other as one node."""
    cost, rank = [], []
    for p in STATES:
        v = entry_vector(p)
        for node in nodes:
            v = step(v, node)
        cost += [c for c, _ in v]
        rank += [r for _, r in v]
    return tuple(cost), tuple(rank)


def crossings(nodes: Sequence[Node], entry: int, exit_costs: Sequence[int]) -> list[int]:
    """The state after each of ``nodes`` on the best chain from ``entry`` to an exit state at ``exit_costs``."""
    out = [0] * len(nodes)
    todo = [(0, len(nodes), entry, list(exit_costs))]
    while todo:
        lo, hi, p, ends = todo.pop()
        if lo == hi:
            continue
        mid = (lo + hi + 1) // 2
        forward, backward = entry_vector(p), ends
        for k in range(lo, mid):
            forward = step(forward, nodes[k])
        for k in range(hi - 1, mid - 1, -1):
            backward = step_back(backward, nodes[k])
        met = min(STATES, key=lambda t: (forward[t][0] + backward[t], forward[t][1]))
        out[mid - 1] = met
        if mid - lo > 1:
            todo.append((lo, mid, p, [0 if t == met else FAR for t in STATES]))
        todo.append((mid, hi, met, ends))
    return out


def inserted_states(p: int, edits: str) -> list[int]:
    """The states after the inserts in ``edits``, from state ``p``."""
    out = []
    for _ in range(edits.count("I")):
        p = NEXT[p]
        out.append(p)
    return out


# --- on tables -------------------------------------------------------------------------------------------------------

NODE = "cost array<long>, rank array<int>"


def _streamed(rows: DataFrame, keys: list[str], order: str, fn, schema: str) -> DataFrame:
    """``fn(key, parts)`` per group of ``keys``, its parts (tuples of the other columns) in ``order``; it gives rows.

    Groups are dealt by hash and sorted by Spark, so a task reads them one after the other; a group has at most BLOCK parts."""
    prepare(rows.sparkSession)
    rest = [c for c in rows.columns if c not in keys]
    ordered = rows.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys, order)
    names, width = [c.split()[0] for c in schema.split(", ")], len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:width] != key:
                    if parts:
                        out.extend(fn(key, parts))
                    key, parts = row[:width], []
                parts.append(row[width:])
            if len(out) > BLOCK:
                yield packed(out)
                out = []
        if parts:
            out.extend(fn(key, parts))
        if out:
            yield packed(out)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def packed(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    return ordered.mapInArrow(run, schema)


def _last_char(text: Column) -> Column:
    return F.right(F.btrim(text, F.lit(SPACE_CHARS)), F.lit(1))


def numbered(turns: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The turns ``(row, conv_id, turn, role, text)`` as written, ``row`` naming each, and ``(row, pos, conv_id, turn, initial, previous,
    fault, part)``: their place among all turns, the initial before (null at the start) and the first fault."""
    given = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
    written = stored(given.withColumn("row", F.monotonically_increasing_id()))
    last = _last_char(F.col("text"))
    slim = written.select("row", "conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "role", (last == "").alias("is_blank"),
                          (~last.isin(".", "!", "?")).alias("is_open"), F.sha2("text", 256).alias("text_hash"))
    placed = running_sums(slim, [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(),
                                 F.col("text_hash").asc(), F.col("row").asc()], {"pos": F.lit(1)})
    placed = stored(placed)
    # the first turn of each role and text: the others repeat it
    said = placed.groupBy("conv_id", "role", "text_hash").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    # the turn before is the one before in the range of places, or the last of the range before it
    cut = F.expr(f"pos div {block}")
    near = Window.partitionBy("part").orderBy("pos")
    edge = placed.where(F.pmod(F.col("pos") + 1, F.lit(block)) == 0).select(
        (F.col("pos") + 1).alias("pos"), F.struct("conv_id", "initial").alias("edge"))
    marked = placed.join(said, "pos", "left").join(edge, "pos", "left").withColumn("part", cut)
    before = F.coalesce(F.lag(F.struct("conv_id", "initial")).over(near), F.col("edge"))
    fault = (F.when(F.col("is_blank"), "blank").when(F.col("is_first").isNull(), "duplicate").when(F.col("is_open"), "truncated"))
    slim = marked.withColumn("before", before).select(
        "row", "pos", "part", "conv_id", "turn", "initial",
        F.when(F.col("before.conv_id").eqNullSafe(F.col("conv_id")), F.col("before.initial")).alias("previous"), fault.alias("fault"))
    return written, stored(slim)


def _typed(initial: str, fault: str | None) -> tuple[str, bool, bool]:
    return initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated"


def repair(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The repaired turns and a report of ``turns (conv_id, turn, role, text)``.

    Repaired turns ``(conv_id, pos, step, edit, role, text)`` have an edit (``K`` kept, ``R`` given the role due, ``D`` deleted, ``I`` inserted, with
    an empty text) each, in the order of ``pos, step``; deleted ones are listed with the role and text they had.  The report has, per conversation,
    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost)``.

    Turns are ordered by ``turn`` (null first), role and a hash of the text; repeated rows are turns of their own, the later ones duplicates.  A null role or text
    is empty: an empty text is blank, a role that starts with none of s, u, a fits nowhere as it is.  Rows without ``conv_id`` are
    one conversation.  Conversations of any length are spread over tasks.  Other columns are ignored; an empty table gives empty results."""
    written, slim = numbered(turns, block)
    report = slim.groupBy("conv_id").agg(
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count(F.when(~F.concat("previous", "initial").isin("su", "ua", "au"), 1)).alias("illegal"),
        (F.max("turn") - F.min("turn") + 1).alias("span"))
    distinct = slim.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("*").alias("turns"))
    report = report.join(distinct.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left") \
        .withColumn("gaps", F.coalesce(F.col("span") - F.col("turns"), F.lit(0)))

    # up: nodes of blocks, then of blocks of blocks, until a conversation is one node
    leaf = slim.select("conv_id", "part", "pos", "initial", "fault")
    levels = [stored(_streamed(leaf, ["conv_id", "part"], "pos", lambda key, parts: [
        (*key, *chain([turn_node(*_typed(i, f)) for _, i, f in parts]))], f"conv_id long, part long, {NODE}"))]
    while not levels[-1].groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        up = levels[-1].select("conv_id", F.expr(f"part div {block}").alias("above"), "part", "cost", "rank")
        levels.append(stored(_streamed(up, ["conv_id", "above"], "part", lambda key, parts: [
            (*key, *chain([(c, r) for _, c, r in parts]))], f"conv_id long, above long, {NODE}").withColumnRenamed("above", "part")))

    # down: entry and exit of each node, from those of the node it is in
    def solve_top(key, parts):
        cost, rank = parts[0][1:]
        met = crossings([(cost, rank)], START, AT_END)[0]
        return [(*key, START, met, cost[4 * START + met] + AT_END[met])]

    top = stored(_streamed(levels[-1].select("conv_id", "part", "cost", "rank"), ["conv_id"], "part", solve_top,
                           "conv_id long, entry int, exit int, least long"))
    spans = levels[-1].select("conv_id", "part").join(top.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))) \
        .select("conv_id", F.col("part").alias("above"), "entry", "exit")

    def solve_parts(key, parts):
        _, _, _, entry, leave = parts[0]
        states = crossings([(c, r) for _, c, r, _, _ in parts], entry, [0 if t == leave else FAR for t in STATES])
        return [(key[0], p[0], a, b) for p, a, b in zip(parts, [entry, *states], states)]

    for nodes in reversed(levels[:-1]):
        inside = nodes.withColumn("above", F.expr(f"part div {block}")).join(
            spans.withColumnsRenamed({"conv_id": "c", "above": "a"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("above") == F.col("a")))
        spans = stored(_streamed(inside.select("conv_id", "above", "part", "cost", "rank", "entry", "exit"), ["conv_id", "above"], "part", solve_parts,
                                 "conv_id long, above long, entry int, exit int"))

    def solve_turns(key, parts):
        entry, leave = parts[0][4], parts[0][5]
        types = [_typed(i, f) for _, _, i, f, _, _ in parts]
        states = crossings([turn_node(*t) for t in types], entry, [0 if t == leave else FAR for t in STATES])
        return [(p[1], a, b, turn_edits(*t)[4 * a + b][1]) for p, t, a, b in zip(parts, types, [entry, *states], states)]

    leaf = slim.select("conv_id", "part", "pos", "row", "initial", "fault").join(
        spans.withColumnsRenamed({"conv_id": "c", "above": "a"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("a")))
    solved = _streamed(leaf.select("conv_id", "part", "pos", "row", "initial", "fault", "entry", "exit"), ["conv_id", "part"], "pos", solve_turns,
                       "row long, entry int, exit int, edits string")
    solved = solved.join(slim.select("row", "pos"), "row")

    role_of = F.array(*map(F.lit, ROLE))
    next_of = F.array(*map(F.lit, NEXT))

    def steps(edits: Column, entry: Column, own_role: Column, own_text: Column, leave: Column) -> Column:
        """One struct per edit; inserts come first and lead from state to state."""
        first = F.get(next_of, entry)
        states = F.array(entry, first, F.get(next_of, first), F.get(next_of, F.get(next_of, first)))
        return F.transform(F.filter(F.split(edits, ""), lambda e: e != ""), lambda e, k: F.struct(
            k.cast("int").alias("step"), e.alias("edit"),
            F.when(e == "I", F.get(role_of, F.get(states, k + 1))).when(e == "R", F.get(role_of, leave)).otherwise(own_role).alias("role"),
            F.when(e == "I", F.lit("")).otherwise(own_text).alias("text")))

    done = written.join(solved, "row").select(
        "conv_id", "pos", F.explode(steps(F.col("edits"), F.col("entry"), F.col("role"), F.col("text"), F.col("exit"))).alias("s")) \
        .select("conv_id", "pos", "s.*")
    closing = top.where((F.col("exit") == SYSTEM) | (F.col("exit") == USER)).select(
        "conv_id", F.lit((1 << 63) - 1).alias("pos"), F.explode(steps(F.get(F.array(*map(F.lit, END_EDITS)), F.col("exit")), F.col("exit"),
                                                         F.lit(""), F.lit(""), F.col("exit"))).alias("s")).select("conv_id", "pos", "s.*")
    least = top.select(F.col("conv_id").alias("t"), F.col("least").alias("cost"))
    report = report.join(least, F.col("conv_id").eqNullSafe(F.col("t"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return done.unionByName(closing), report


def digests(repaired: DataFrame) -> DataFrame:
    """``(conv_id, audit, repaired_sha256)`` of repaired turns: the edits' initials in order, and the lower-case hex digest of the kept, changed
    and inserted turns, ``role:text`` joined by newlines.  A digest is one ordered pass: turns stream through sorted, none is held."""
    prepare(repaired.sparkSession)
    ordered = repaired.select("conv_id", "pos", "step", "edit", "role", "text").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "pos", "step").select("conv_id", "edit", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for conv_id, edit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        out.append(now)
                    now = (conv_id, [], hashlib.sha256(), [""])
                now[1].append(edit)
                if edit != "D":
                    now[2].update(f"{now[3][0]}{role}:{text}".encode())
                    now[3][0] = "\n"
            if out:
                yield packed(out)
        if now is not None:
            yield packed([now])

    def packed(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array(["".join(f[1]) for f in found], pa.string()),
                                           pa.array([f[2].hexdigest() for f in found], pa.string())], names=["conv_id", "audit", "repaired_sha256"])

    return ordered.mapInArrow(run, "conv_id long, audit string, repaired_sha256 string")


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def repair_report(turns: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` per ``conv_id`` of ``conversations``; zeros, an empty audit
    and the digest of nothing where ``turns`` has no rows of it."""
    repaired, report = repair(turns, block)
    all_ids = conversations.select(F.col("conv_id").cast("long")).distinct()
    found = digests(repaired).withColumnRenamed("conv_id", "d").join(report.withColumnRenamed("conv_id", "r"), F.col("d").eqNullSafe(F.col("r")))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return all_ids.join(found, F.col("conv_id").eqNullSafe(F.col("d")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 makes its role user.  A null is one space, in the role, the text and the hashed string."""
    space = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", space).alias("role"),
                                F.coalesce("text", space).alias("text"))
    kind = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.withColumn("kind", kind).where("kind <> 0") \
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
        .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))
