"""Conversation repair against an exhaustive search over audits, with cut conversations and the odd rows."""

import hashlib
import random
import re

import pytest

from tidemark.llm import turn_repair

SOUND = re.compile(r"(s?(ua)+)?\Z")


def cheapest(turns):
    """Least (cost, audit, result) over all edits of (initial, must go, cut off) turns, in order of cost."""
    best = None
    stack = [(0, "", "", 0)]
    while stack:
        cost, audit, out, i = stack.pop()
        if best and cost > best[0]:
            continue
        if i == len(turns) and SOUND.match(out) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, out)
        if len(audit) > len(turns) + 4 or not re.match(r"s?(ua)*u?\Z", out):
            continue
        if audit[-2:] != "II":
            stack += [(cost + 2, audit + "I", out + r, i) for r in "ua"]
        if i < len(turns):
            initial, gone, cut = turns[i]
            stack.append((cost + 3, audit + "D", out, i + 1))
            if not gone:
                stack.append((cost + cut, audit + "K", out + initial, i + 1))
                stack += [(cost + 2 + cut, audit + "R", out + r, i + 1) for r in "ua"]
    return best


def expected(rows):
    """The summary of a conversation's ordered rows of (turn, role, text)."""
    seen, turns, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        counts |= {fault: counts[fault] + 1} if fault else {}
        turns.append((role[:1] or " ", fault in ("blank", "duplicate"), int(fault == "truncated")))
    cost, audit, out = cheapest(turns)
    names, said, at = {"u": "user", "a": "assistant"}, [], 0
    for mark in audit:
        if mark == "I":
            said.append(f"{names[out[len(said)]]}:")
            continue
        if mark != "D":
            said.append(f"{rows[at][1] if mark == 'K' else names[out[len(said)]]}:{rows[at][2]}")
        at += 1
    numbers = [r[0] for r in rows if r[0] is not None]
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, **counts,
        "illegal": sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(turns, turns[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(said).encode()).hexdigest(),
    }


def talks(seed, count, longest):
    rng = random.Random(seed)
    for conv in range(count):
        turn = rng.randint(-3, 3)
        for _ in range(rng.randint(1, longest)):
            yield conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", "tool"]), rng.choice(["a.", "b?", "open", " ", "", "x! \n", f"t{turn}."])
            turn += rng.choice([1, 1, 1, 2, 5])


@pytest.mark.parametrize(("chunk", "most"), [(64, 256), (2, 256), (3, 1)])
def test_repair_equals_the_search(spark, rows, monkeypatch, chunk, most):
    monkeypatch.setattr(turn_repair, "CHUNK", chunk)
    monkeypatch.setattr(turn_repair, "MOST", most)
    given = list(talks(chunk, 60, 7))
    frame = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").repartition(3)
    found = rows(turn_repair.summaries(turn_repair.repair(frame)), "conv_id")
    assert len(found) == 60
    for r in found:
        conv = r.pop("conv_id")
        assert r == expected([t[1:] for t in given if t[0] == conv])


def test_ways_of_every_state():
    rng = random.Random(3)
    for _ in range(150):
        turns = tuple(rng.choice("usat") + rng.choice("01") for _ in range(rng.randint(0, 6)))
        whole = turn_repair.ways(turns, turn_repair.NOTHING, True)
        cost, audit, out = cheapest([(t[0], False, int(t[1])) for t in turns])
        assert min(whole.values()) == (cost, audit)
        assert all(m[1][-1:] != "I" for e in range(4) for m in turn_repair.ways(turns, e, False).values())


def test_odd_rows(spark, rows):
    given = [(None, None, None, None), (None, None, "user", "hi."), (None, None, "user", "hi."), (7, 3, "user", "q?"), (7, 1, "assistant", "a."), (8, 0, "user", ""), (9, 5, "", "x.")] + [(10, 0, "user", "same")] * 300
    frame = spark.createDataFrame([(*g, 0) for g in given], "conv_id long, turn long, role string, text string, cost int")
    found = {r["conv_id"]: r for r in rows(turn_repair.summaries(turn_repair.repair(frame)))}
    for conv in (7, 8, 9):
        own = sorted(t[1:] for t in given if t[0] == conv)
        assert {k: v for k, v in found[conv].items() if k != "conv_id"} == expected(own)
    assert (found[None]["blank"], found[None]["duplicate"], found[None]["gaps"], found[None]["cost"]) == (1, 1, 0, 8)
    assert found[10]["duplicate"] == 299 and found[10]["audit"] == "D" * 300 and found[10]["illegal"] == 299
    assert turn_repair.repair(frame.where("conv_id = 99")).count() == 0
    every = rows(turn_repair.of_all(spark.createDataFrame([(None,), (7,), (11,)], "conv_id long"), turn_repair.summaries(turn_repair.repair(frame))), "conv_id")
    assert [r["conv_id"] for r in every] == [None, 7, 11] and every[2]["audit"] == "" and every[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest() and every[0]["cost"] == 8


def test_one_long_conversation_in_parts(spark, rows):
    given = [(1, k, ("user", "assistant")[k % 2], f"t{k}" + "."[: k % 5]) for k in range(2000) if k % 7] + [(1, None, "user", f"n{k}.") for k in range(700)]
    frame = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    parts = turn_repair.repair(frame)
    assert parts.count() > 30
    (found,) = rows(turn_repair.summaries(parts))
    # the cheapest way over the four states alone
    best = {0: 0}
    texts = [("u", 0)] * 700 + [(r[0], int(t[-1] != ".")) for _, k, r, t in given if k is not None]
    for initial, cut in texts:
        new = {q: c + 3 for q, c in best.items()}
        for q, c in best.items():
            for before, extra in ((q, 0), (3 if q == 2 else 2, 2)):
                wanted = "a" if before == 2 else "u"
                after, step = (3 if wanted == "a" else 2), c + extra + cut + 2 * (initial != wanted)
                new[after] = min(new.get(after, step), step)
        best = new
    assert found["cost"] == min(c + {0: 0, 2: 2, 3: 0}[q] for q, c in best.items()) and found["gaps"] == 2000 - 1 - sum(k % 7 > 0 for k in range(2000))
