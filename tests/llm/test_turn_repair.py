"""Repair of conversations against a search over all edit scripts, cheapest first and least audit first."""
import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from conftest import SF_SMALL
from quayside.llm import turn_repair as T
from quayside.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, pos string, part int, fault string, cost int, row string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(turns):
    """(cost, audit) of the best script over ``turns (initial, must_delete, truncated)``, by trying scripts in order."""
    heap, seen = [(0, "", 0, "")], set()
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    while heap:
        cost, audit, k, last = heapq.heappop(heap)
        if k == len(turns) and last in ("", "a"):
            return cost, audit
        if (k, last) in seen:
            continue
        seen.add((k, last))
        due = follows[last]
        heapq.heappush(heap, (cost + 2, audit + "I", k, due))
        if k < len(turns):
            initial, must_delete, truncated = turns[k]
            heapq.heappush(heap, (cost + 3, audit + "D", k + 1, last))
            if not must_delete:
                heapq.heappush(heap, (cost + 2 + truncated, audit + "R", k + 1, due))
                if initial == due or (initial == "s" and not last):
                    heapq.heappush(heap, (cost + truncated, audit + "K", k + 1, initial))


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv_id, turn, "user" if kind == 4 else role, text)
        out += [row, row] if kind == 3 else [row]
    return out


def expected(rows, ids):
    """The report of damaged rows by the contract's words."""
    of = defaultdict(list)
    for r in rows:
        of[r[0]].append(r)
    out = {i: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in ids}
    for conv_id, turns in of.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, role, text in turns:
            found = BLANK.findall(text)
            faults.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
            seen.add((role, text))
        numbers = [r[1] for r in turns if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = cheapest([(r[2][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(turns, faults)])
        said, last, at = [], "", iter(turns)
        due = {"": "user", "s": "user", "u": "assistant", "a": "user"}
        for letter in audit:
            if letter == "I":
                said.append((due[last], ""))
            else:
                _, _, role, text = next(at)
                if letter == "D":
                    continue
                said.append((due[last] if letter == "R" else role, text))
            last = said[-1][0][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in said))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv_id] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def values(rows):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "f", 2, "r") for r in rows], SCHEMA).repartition(3)


def odd_rows(seed, conversations, longest):
    g = random.Random(seed)
    texts = ["Yes.", "No!", "Open", "", " \n", "Is it?\t", "Long one. ", "énd", " ", None, "Hm"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "ursine"]
    rows = []
    for c in range(conversations):
        for t in range(g.randrange(longest)):
            rows.append((c or None, g.choice([t, t, t, 2 * t, None]), g.choice(roles), g.choice(texts) if g.random() < .6 else f"Text {t}."))
    return rows


@pytest.mark.parametrize("block", [3, T.BLOCK])
def test_repair_against_a_search(spark, block):
    rows = odd_rows(block, 40, 30)
    turns = frame(spark, rows)
    got = T.repair_report(turns, turns, block).collect()
    plain = [(c, t, "" if r is None else r, "" if x is None else x) for c, t, r, x in rows]
    assert values(got) == expected(plain, {r[0] for r in rows}) and len(got) == len({r[0] for r in rows})


def test_damage_and_repair_of_odd_rows(spark):
    rows = odd_rows(7, 60, 20) + [(500 + k, k, "user", "Alone.") for k in range(60)]  # some conversations lose all rows
    got = T.repair_report(T.damage(frame(spark, rows)), frame(spark, rows)).collect()
    want = expected(damaged(rows), {r[0] for r in rows})
    assert values(got) == want and any(v[6] == "" for v in want.values())


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert values(QUERIES["op13_turn_repair"](spark, SF_SMALL).collect()) == expected(damaged(rows), {r[0] for r in rows})


def test_one_long_conversation_over_three_levels(spark):
    g = random.Random(4)
    rows = [(1, t, g.choice(["user", "assistant"]), g.choice(["", f"Said {t}.", f"Open {t}", "Again."])) for t in range(700)]
    got = T.repair_report(frame(spark, rows), frame(spark, rows), block=8).collect()
    assert values(got) == expected(rows, {1})
    repaired, _ = T.repair(frame(spark, rows), block=8)
    assert repaired.where("edit <> 'I'").count() == 700


def test_empty_table(spark):
    nothing = frame(spark, [])
    assert T.repair_report(T.damage(nothing), nothing).collect() == []


def test_crossings_meet_wherever_the_chain_is_cut():
    g = random.Random(5)
    for _ in range(400):
        turns = [(g.choice(["s", "u", "a", "", "u", "a"]), g.random() < .2, g.random() < .2) for _ in range(g.randrange(15))]
        nodes = [T.turn_node(*t) for t in turns]
        states = T.crossings(nodes, T.START, T.AT_END)
        way = [T.START, *states]
        edits = [T.turn_edits(*t)[4 * a + b] for t, a, b in zip(turns, way, states)]
        audit = "".join(e for _, e in edits) + T.END_EDITS[way[-1]]
        assert (sum(c for c, _ in edits) + T.AT_END[way[-1]], audit) == cheapest(turns)
        width = g.randrange(1, 5)
        stretches = [T.chain(nodes[k:k + width]) for k in range(0, len(nodes), width)]
        assert T.crossings(stretches, T.START, T.AT_END) == [states[min(k + width, len(states)) - 1] for k in range(0, len(nodes), width)]
