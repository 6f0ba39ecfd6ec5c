"""Chat formatting in budgeted windows.

A conversation is written as one or more windows of whole turns.  Prefix sums of the turns' tokens, computed in ranges, choose the
spans of new turns; later windows start with the system turn and a limited history of repeated turns.  The loss mask
covers the assistant texts of new turns only, so each target is trained on once.

Template: ``<|role|>`` newline text ``</s>`` newline per turn.  Inside roles and texts a backslash is doubled and one is put
after the first character wherever a control string begins, so no control string remains and the escape is reversible.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quayside.llm import bpe
from quayside.llm.common import arrow_map, prepare, stored
from quayside.llm.ordered import running_sums

BUDGET, HISTORY = 1024, 256  # tokens of a window, and of the history repeated in it
OVERHEAD = 8                 # tokens counted for a turn's marks
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BEGINS = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)")
_ESCAPED = re.compile(r"\\(.)", re.S)
END = "</s>\n"


def escape(text: str) -> str:
    return _BEGINS.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text begins and ends in it."""
    head, body = f"<|{escape(role)}|>\n", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def read_turns(window: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a window."""
    at = 0
    while at < len(window):
        head = window.index("|>\n", at)
        end = window.index(END, head)
        yield unescape(window[at + 2:head]), unescape(window[head + 3:end])
        at = end + len(END)


ORDER_HEAD = 64  # first characters of a text that order turns of one number and role, before its hash


def _written() -> list:
    """The formatted turn of counted rows: its text, where the turn's text begins and ends in it, its length."""
    head = F.concat(F.lit("<|"), F.coalesce("escaped_role", "role"), F.lit("|>\n"))
    body = F.coalesce("escaped_text", "text")
    lo, size = F.char_length(head), F.char_length(body)
    return [F.concat(head, body, F.lit(END)).alias("written"), lo.cast("long").alias("lo"), (lo + size).cast("long").alias("hi"),
            (lo + size + len(END)).cast("long").alias("len")]


def _placed(counted: DataFrame, budget: int, history: int) -> DataFrame:
    """Every turn ``id`` with its place ``k`` and the tokens ``p`` before it in its conversation, and its window: the place
    ``window`` and tokens ``p0`` where that begins, the tokens ``new`` of its new turns, and the system turn kept in it.

    Prefix sums alone place turns: a conversation's tokens are cut into steps, and a turn belongs to the step where it
    begins; one that reaches over the step's end too far for the budget has a window for itself."""
    slim = counted.select("cid", "turn", "role", F.substring("text", 1, ORDER_HEAD).alias("head"), F.xxhash64("text").alias("h1"),
                          F.xxhash64(F.lit("second"), "text").alias("h2"), "id", "cost")
    order = [F.col("cid"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "head", "h1", "h2", "id"))]
    sums = stored(running_sums(slim, order, {"at": F.col("cost"), "n": F.lit(1)}).select("cid", "id", "role", "cost", "at", "n"))
    first = sums.groupBy("cid").agg(F.min("at").alias("at0"), F.min("n").alias("n0"),
                                    F.min_by(F.struct("role", "cost", "id"), "n").alias("f"))
    first = first.select("cid", "at0", "n0", F.when(F.col("f.role") == "system", F.col("f.id")).alias("system"),
                         F.when(F.col("f.role") == "system", F.col("f.cost")).otherwise(0).alias("kept"))
    room = F.lit(budget) - F.col("kept")
    step = F.greatest(room - history, F.floor(room / 2), F.lit(1))
    turns = sums.join(first, "cid").select("cid", "id", "cost", "system", "kept", (F.col("at") - F.col("at0")).alias("p"),
                                           (F.col("n") - F.col("n0")).alias("k"), step.alias("step"))
    turns = turns.withColumn("cell", F.expr("p div step"))
    over = F.col("p") + F.col("cost") - F.col("cell") * F.col("step") > F.when(F.col("cell") > 0, room).otherwise(budget)
    together = Window.partitionBy("cid", "cell", "over")
    return turns.withColumn("over", over).select(
        "cid", "id", "cost", "system", "kept", "p", "k", F.min("k").over(together).alias("window"),
        F.min("p").over(together).alias("p0"), F.sum("cost").over(together).alias("new"))


def _members(placed: DataFrame, budget: int, history: int) -> DataFrame:
    """``(cid, window, id, k, context, cost)``: the new turns of every window, the system turn of all but the first, and the
    latest turns before a window whose tokens fit the history and the window."""
    shape = ("cid", "window", "id", "k", "context", "cost")
    new = placed.withColumn("context", F.lit(False)).select(*shape)
    starts = placed.where("k = window and k > 0").select(
        "cid", "window", "p0", "system", "kept", F.least(F.lit(history), F.lit(budget) - F.col("kept") - F.col("new")).alias("room"))
    system = starts.where("system is not null").select(
        "cid", "window", F.col("system").alias("id"), F.lit(0).cast("long").alias("k"), F.lit(True).alias("context"),
        F.col("kept").alias("cost"))
    # a window and its history begin in the same or in neighbouring stretches of as many tokens as the history has
    stretch = f"div {max(history, 1)}"
    before = placed.where("system is null or k > 0").select(
        "cid", "id", "k", "p", "cost", F.explode(F.expr(f"array(p {stretch}, p {stretch} + 1)")).alias("stretch"))
    past = starts.where("room > 0").withColumn("stretch", F.expr(f"p0 {stretch}")).join(before, ["cid", "stretch"]) \
        .where("k < window and p0 - p <= room").withColumn("context", F.lit(True)).select(*shape)
    return new.unionByName(system).unionByName(past)


# Loss spans of a window's parts in order: a running place, and the spans of new assistant texts.
_SPANS = """aggregate(parts, named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,end:bigint>>)),
    (a, x) -> named_struct('at', a.at + x.len, 'spans', if(x.role = 'assistant' and not x.context,
        concat(a.spans, array(named_struct('start', a.at + x.lo, 'end', a.at + x.hi))), a.spans)), a -> a.spans)"""


def format_windows(turns: DataFrame, vocabulary: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows ``(conv_id, window, text, loss, n_context, n_tokens)`` of ``turns (conv_id, turn, role, text)``.

    ``window`` is the place of the window's first new turn in its conversation, ``loss`` holds the spans of ``text`` to train on,
    ``n_context`` the leading turns that repeat.  A window has at most ``budget`` tokens, but for one whose only new turn does not
    fit beside the system turn.  Turns are ordered by ``turn``, then role, the text's first characters and its hash (ties, repeated
    rows: each a turn; null first); a null role or text is empty; rows without ``conv_id`` are one conversation with a null id.
    Other columns are ignored; an empty table gives an empty result.

    Turns are counted and escaped where they are read and written once.  Sums run over ranges of slim rows, so a conversation
    of any length, or all rows without an id, is spread over tasks; only the turns of one window meet."""
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = bpe.loaded(vocabulary).count
        roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        changed = [[e if e != x else None for x, e in zip(xs, map(escape, xs))] for xs in (roles, texts)]  # few are
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([tokens(r) + tokens(t) + OVERHEAD for r, t in zip(roles, texts)], pa.int64()),
             *(pa.array(c, pa.string()) for c in changed)],
            names=["conv_id", "turn", "role", "text", "cost", "escaped_role", "escaped_text"])

    counted = arrow_map(rows, count, "conv_id long, turn long, role string, text string, cost long, escaped_role string, "
                                     "escaped_text string")
    counted = stored(counted.withColumn("cid", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).drop("conv_id")
                     .withColumn("id", F.monotonically_increasing_id()))
    placed = stored(_placed(counted, budget, history))
    parts = _members(placed, budget, history).join(counted.select("id", "role", *_written()), "id")
    part = F.struct("k", "role", "context", "written", "lo", "hi", "len")
    windows = parts.groupBy("cid", "window").agg(F.array_sort(F.collect_list(part)).alias("parts"),
                                                 F.count_if("context").alias("n_context"), F.sum("cost").alias("n_tokens"))
    return windows.select(F.nullif("cid", F.lit("")).cast("long").alias("conv_id"), "window",
                          F.array_join("parts.written", "").alias("text"), F.expr(_SPANS).alias("loss"), "n_context", "n_tokens")


def read_back(windows: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` per conversation, parsed from the
    windows' texts and loss spans alone: turns once each (context is passed over), roles and texts unescaped."""
    prepare(windows.sparkSession)
    ordered = windows.select("conv_id", "window", "text", "loss", "n_context").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for conv_id, _, text, loss, n_context in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now[0]:
                    if now is not None:
                        out.append(now)
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for k, (role, said) in enumerate(read_turns(text)):
                    if k >= n_context:
                        now[1] += 1
                        now[2].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    target = unescape(text[span["start"]:span["end"]])
                    now[3] += len(target)
                    now[4].update(target.encode())
                now[5] += len(text)
            if out:
                yield digests(out)
        if now is not None:
            yield digests([now])

    def digests(rows: list) -> pa.RecordBatch:
        columns = list(zip(*[(c, n, t.hexdigest(), m, s.hexdigest(), f) for c, n, t, m, s, f in rows]))
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")
