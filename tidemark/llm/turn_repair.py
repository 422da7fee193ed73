"""Conversation structure repair (12): turns aligned to alternating grammar strings by edit distance.

A sound conversation's role initials read ``(s?(ua)+)?``.  For every feasible length there is one such string (two with
the leading ``s``); the turns are aligned to each by the Wagner-Fischer recurrence.  Lengths are tried from the number
of turns outwards.  The cheapest alignment so far bounds the band of diagonals (Ukkonen): a cell whose surplus of
insertions or deletions alone costs more is not computed, and lengths that cost more by their difference are not tried.
Each optimal table is traced to its ASCII-least audit, and audits of equal cost are compared over all lengths.

Rows that must go (blank, seen before) keep their place in the audit but take no part in the alignment: of equal audits
with inserted turns around them, the one that deletes first is the least.

Conversations are cut into parts of consecutive turns.  A part is aligned from every state that the turns before can
leave (nothing said, after system, user, assistant) to every state it can end in; then a chain through the parts picks
the cheapest, and of those the least audit.  Only a last part may end in insertions, so audits of one part never are
beginnings of each other and the least chain is the least audit.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm._common import map_arrow, pick, sent, slices, staged

#: turn numbers of a part, and unlike rows of a part beyond which it is cut again
CHUNK, MOST = 64, 256
#: hot parts whose list is broadcast at most
BROADCAST_PARTS = 100_000
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
SPACE = r" \t\n\x0B\f\r"


def target(entry: int, length: int, system: bool = False) -> str:
    """The grammar's string of this length after a state."""
    lead, first = ("s" if system else ""), ("au" if entry == USER else "ua")
    return (lead + first * (length // 2 + 1))[:length]


def _surplus(d: int) -> int:
    return INSERT * d if d > 0 else -DELETE * d


def _change(turn: str, wanted: str) -> int | None:
    """Cost of a turn (its initial, then 1 if it is cut off) at a place of the target; none if it can't stand there."""
    cut = CUT_OFF if turn[-1] == "1" else 0
    return cut if turn[:-1] == wanted else cut + REROLE if wanted in "ua" else None


def aligned(turns: tuple[str, ...], wanted: str, limit: int, closing: bool) -> tuple[int, str] | None:
    """Cost and least audit of turns against a target; none beyond ``limit``.  Only a closing part ends in insertions."""
    n, m = len(turns), len(wanted)
    band = [d for d in range(-n, m + 1) if _surplus(d) + _surplus(m - n - d) <= limit]
    if not band:
        return None
    low, high, far = band[0], band[-1], limit + 1
    # rest[i][j]: turns from i on against the target from j on
    rest: list[dict[int, int]] = [{} for _ in range(n + 1)]
    rest[n] = {j: INSERT * (m - j) for j in range(max(0, n + low), m + 1) if closing or j == m}
    for i in range(n - 1, -1, -1):
        below, here = rest[i + 1], rest[i]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = below.get(j, far) + DELETE
            if j < m:
                best = min(best, here.get(j + 1, far) + INSERT)
                if (step := _change(turns[i], wanted[j])) is not None:
                    best = min(best, below.get(j + 1, far) + step)
            if best <= limit:
                here[j] = best
    if 0 not in rest[0]:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:
        left = rest[i][j]
        if i < n and rest[i + 1].get(j, far) + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and rest[i].get(j + 1, far) + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i][:-1] == wanted[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


def ways(turns: tuple[str, ...], entry: int, closing: bool) -> dict[int, tuple[int, str]]:
    """By state after the part: the least cost and its least audit."""
    n, best = len(turns), {}
    gap = 0
    while gap <= n or not best or INSERT * gap <= max(c for c, _ in best.values()):
        for length in {n + gap, n - gap} if gap <= n else {n + gap}:
            for system in (False, True) if entry == NOTHING and length else (False,):
                wanted = target(entry, length, system)
                after = AFTER[wanted[-1]] if wanted else entry
                if closing and after in (SYSTEM, USER):
                    continue
                limit = best[after][0] if after in best else DELETE * n + (INSERT + CUT_OFF) * length
                found = aligned(turns, wanted, limit, closing) if _surplus(length - n) <= limit else None
                if found and (after not in best or found < best[after]):
                    best[after] = found
        gap += 1
    return best


def chained(parts: list[list[tuple[int, int, bool, int, str]]]) -> list[tuple[int, int, str]]:
    """Of the ways ``(entry, after, closing, cost, audit)`` of each part: entry, cost and audit of the cheapest least chain."""
    last = len(parts) - 1
    left: list[dict[int, int]] = [{} for _ in parts] + [dict.fromkeys(range(4), 0)]
    usable = [[w for w in part if w[2] == (k == last)] for k, part in enumerate(parts)]
    for k in range(last, -1, -1):
        for entry, after, _, cost, _ in usable[k]:
            if after in left[k + 1]:
                left[k][entry] = min(left[k].get(entry, cost + left[k + 1][after]), cost + left[k + 1][after])
    state, out = NOTHING, []
    for k, part in enumerate(usable):
        audit, cost, after = min((a, c, x) for e, x, _, c, a in part if e == state and x in left[k + 1] and c + left[k + 1][x] == left[k][state])
        out.append((state, cost, audit))
        state = after
    return out


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by a checksum of ``conversation:turn`` modulo 20 (a null counts as one space everywhere).

    0 leaves the row out, 1 empties its text, 2 takes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes its role user.
    """
    rows = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))) % 20
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), kind.alias("kind")).where("kind <> 0")
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def _faults(turns: DataFrame) -> DataFrame:
    """Unlike rows of a conversation with their copies and faults.

    Equal rows of one turn are counted, not listed. The first of equal texts is found by an aggregate, so that a text
    that recurs in very many turns meets no task alone.
    """
    space = F.lit(" ")
    rows = turns.select(F.struct("conv_id").alias("conv"), F.struct("turn").alias("at"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))
    unlike = rows.groupBy("conv", "at", "digest").agg(F.first("role").alias("role"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    first = rows.groupBy("conv", "digest").agg(F.min("at").alias("at")).withColumn("new", F.lit(True))
    bare = F.expr(f"rtrim('{SPACE}', text)")
    marked = unlike.join(first, ["conv", "at", "digest"], "left").withColumns({"new": F.coalesce("new", F.lit(False)), "blank": F.length(bare) == 0, "cut": ~F.right(bare, F.lit(1)).isin(".", "!", "?")})
    return marked.withColumn("block", F.struct(F.expr(f"floor(at.turn / {CHUNK})").alias("k")))


def _parts(turns: DataFrame) -> DataFrame:
    """Consecutive rows of a conversation, ``CHUNK`` turn numbers or, where those hold more than ``MOST`` rows, rows of one turn by leading digits of their digest."""
    rows = staged(_faults(turns))
    along = Window.partitionBy("conv")
    sizes = rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    sizes = staged(sizes.withColumns({"opens": F.col("block") == F.min("block").over(along), "closes": F.col("block") == F.max("block").over(along)}).withColumn("hot", F.col("n") > MOST))
    few = sizes.count() <= BROADCAST_PARTS
    rows = rows.join(F.broadcast(sizes) if few else sizes, ["conv", "block"])
    digits = F.expr(f"cast(ceil(log(16, n / {max(1, MOST // 4)})) as int)")
    rows = rows.withColumn("part", F.struct("block", F.when(F.col("hot"), F.col("at")).alias("at"), F.when(F.col("hot"), F.substring(F.hex("digest"), F.lit(1), digits)).alias("lead")))
    listed = F.struct("at", "digest", "role", "text", "copies", "new", "blank", "cut")
    return rows.groupBy("conv", "block", "part").agg(F.sort_array(F.collect_list(listed)).alias("rows"), *[F.first(c).alias(c) for c in ("opens", "closes", "hot")])


def _initial(role: str) -> str:
    return role[:1]


def _core(rows: list[dict]) -> tuple[list[dict], int, list[int]]:
    """Rows that may stay, rows to delete before the first, and after each of them."""
    core, lead, after = [], 0, []
    for r in rows:
        stays = r["new"] and not r["blank"]
        if stays:
            core.append(r)
            after.append(0)
        gone = r["copies"] - stays
        if after:
            after[-1] += gone
        else:
            lead += gone
    return core, lead, after


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations repaired at the least cost, in parts ``(conv_id, part, turns, audit, cost, …)`` in the order of ``part``.

    Faults: a row is blank (white space only), else a duplicate (role and text seen earlier), else truncated (its last
    character other than white space is none of ``.!?``).  Keeping a row costs 0, giving it the role user or assistant
    2, deleting it 3 (blank rows and duplicates must go), inserting an empty turn of user or assistant 2, and a
    truncated row that stays 1 more.  ``audit`` has the initials of these edits, the ASCII-least of the cheapest;
    ``turns`` the repaired roles and texts.  Further columns count the faults, neighbours of the part that can't follow
    each other (``illegal``), its turn numbers (``lowest``, ``highest``, ``unlike``) and its first and last initials.

    Rows are ordered by turn, a null turn first, and by a digest of role and text within a turn; a null role or text is
    one space; rows with a null conversation are one conversation; repeated rows are repeated turns, the first stays;
    an empty table gives an empty table.
    """
    parts = staged(_parts(pick(turns, conv_id=conv_id, turn=turn, role=role, text=text)))
    kind = parts.schema["conv"].dataType.simpleString()
    order = parts.schema["part"].dataType.simpleString()
    # what a part's alignment depends on: initials and truncation
    codes = F.transform(F.filter("rows", lambda r: r["new"] & ~r["blank"]), lambda r: F.concat(F.substring(r["role"], 1, 1), F.when(r["cut"], "1").otherwise("0")))
    short = parts.select("conv", "part", codes.alias("codes"), "opens", "closes", "hot")

    def make():
        found = functools.lru_cache(maxsize=20_000)(ways)

        def work(batch: pa.RecordBatch) -> dict:
            out = []
            for turns_, opens, closes, hot in zip(*(batch.column(c).to_pylist() for c in ("codes", "opens", "closes", "hot"))):
                entries = (NOTHING,) if opens and not hot else range(4)
                ends = (True,) if closes and not hot else (False, True) if closes else (False,)
                out.append([{"entry": e, "after": x, "closing": z, "cost": c, "audit": a} for e in entries for z in ends for x, (c, a) in found(tuple(turns_), e, z).items()])
            return {"conv": batch.column("conv"), "part": batch.column("part"), "ways": out}

        return work

    known = map_arrow(short, make, f"conv {kind}, part {order}, ways array<struct<entry:int,after:int,closing:boolean,cost:long,audit:string>>")
    chosen = StructType.fromDDL(f"conv {kind}, part {order}, entry int, cost long, audit string")
    arrow = to_arrow_schema(chosen)

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a conversation's parts, a few short strings each
        conv, held, started = None, [], False

        def out() -> pa.RecordBatch:
            steps = chained([[tuple(w[c] for c in ("entry", "after", "closing", "cost", "audit")) for w in p["ways"]] for p in held])
            columns = [[conv] * len(held), [p["part"] for p in held], *map(list, zip(*steps))]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if started and row["conv"] != conv:
                    yield out()
                    held.clear()
                conv, started = row["conv"], True
                held.append(row)
        if held:
            yield out()

    picked = sent(known.repartition("conv").sortWithinPartitions("conv", "part")).mapInArrow(chain, chosen)

    def make_apply():
        def one(rows: list[dict], entry: int, cost: int, audit: str) -> dict:
            core, lead, after = _core(rows)
            said, state, marks, k = [], entry, ["D" * lead], 0
            for mark in audit:
                if mark != "D":
                    name = "assistant" if state == USER else "user"
                    kept = core[k] if mark != "I" else {"role": name, "text": ""}
                    said.append({"role": kept["role"] if mark == "K" else name, "text": kept["text"]})
                    state = AFTER[_initial(said[-1]["role"])]
                marks.append(mark)
                if mark != "I":
                    marks.append("D" * after[k])
                    k += 1
            initials = [_initial(r["role"]) for r in rows]
            numbers = [r["at"]["turn"] for r in rows if r["at"]["turn"] is not None]
            return {
                "turns": said, "audit": "".join(marks), "cost": cost + DELETE * (lead + sum(after)),
                "blank": sum(r["copies"] for r in rows if r["blank"]),
                "duplicate": sum(r["copies"] - r["new"] for r in rows if not r["blank"]),
                "truncated": sum(r["cut"] for r in core),
                "illegal": sum(r["copies"] - 1 for r in rows) + sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
                "lowest": min(numbers, default=None), "highest": max(numbers, default=None), "unlike": len(set(numbers)),
                "first": initials[0], "last": initials[-1],
            }

        def work(batch: pa.RecordBatch) -> dict:
            made = [one(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("rows", "entry", "cost", "audit")))]
            return {"conv_id": batch.column("conv").field("conv_id"), "part": batch.column("part")} | {c: [m[c] for m in made] for c in made[0]}

        return work

    number = parts.schema["rows"].dataType.elementType["at"].dataType["turn"].dataType.simpleString()
    id_kind = turns.schema[conv_id].dataType.simpleString()
    schema = (
        f"conv_id {id_kind}, part {order}, turns array<struct<role:string,text:string>>, audit string, cost long, blank long, duplicate long, truncated long, illegal long, "
        f"lowest {number}, highest {number}, unlike long, first string, last string"
    )
    return map_arrow(parts.join(picked, ["conv", "part"]).select("conv", "part", "rows", "entry", "cost", "audit"), make_apply, schema)


def summaries(parts: DataFrame) -> DataFrame:
    """One row per conversation from its parts: counts, cost, audit, and a digest of the repaired ``role:text`` lines.

    Parts stream through in order, so a conversation of any length takes the memory of a part and of its audit.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    arrow = to_arrow_schema(schema)
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def row() -> pa.RecordBatch:
            gaps = held["highest"] - held["lowest"] + 1 - held["unlike"] if held["unlike"] else 0
            values = [held["conv_id"], gaps, *(held[c] for c in sums), "".join(held["audit"]), held["lines"].hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

        for batch in (part for whole in batches for part in slices(whole, "audit")):
            for p in batch.to_pylist():
                if not held or held["conv_id"] != p["conv_id"]:
                    if held:
                        yield row()
                    held = dict.fromkeys(sums, 0) | {"conv_id": p["conv_id"], "audit": [], "lines": hashlib.sha256(), "any": False, "last": None, "lowest": None, "highest": None, "unlike": 0}
                for c in sums:
                    held[c] += p[c]
                held["audit"].append(p["audit"])
                for t in p["turns"]:
                    held["lines"].update(("\n" * held["any"] + f"{t['role']}:{t['text']}").encode("utf-8", "surrogatepass"))
                    held["any"] = True
                if held["last"] is not None and held["last"] + p["first"] not in ("su", "ua", "au"):
                    held["illegal"] += 1
                held["last"] = p["last"]
                if p["unlike"]:
                    # parts of one turn share its number
                    held["unlike"] += p["unlike"] - (p["lowest"] == held["highest"])
                    held["lowest"] = p["lowest"] if held["lowest"] is None else held["lowest"]
                    held["highest"] = p["highest"]
        if held:
            yield row()

    return sent(parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")).mapInArrow(run, schema)


def of_all(ids: DataFrame, found: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Summaries of every conversation of ``ids``; one without rows left has zeros, no audit and the digest of nothing."""
    every = ids.select(F.struct(F.col(conv_id).alias("conv_id")).alias("conv")).distinct()
    rest: dict[str, Column] = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    rest |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    held = found.withColumn("conv", F.struct("conv_id")).drop("conv_id")
    return every.join(held, "conv", "left").select("conv.conv_id", *[v.alias(k) for k, v in rest.items()])
