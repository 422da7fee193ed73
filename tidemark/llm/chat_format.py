"""Chat formatting (3): turn-aligned windows from prefix sums of turn tokens, with the system turn and masked history.

A window's text is a run of marked turns.  Control strings inside texts are broken by a backslash after their first
character, and backslashes are doubled, so that every formatted text can be read back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm._common import pick, sent, slices

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
#: The first character of any control string of common templates, before the rest of it.
CONTROL = r"<(?=\|im_start\||\|im_end\||\|endoftext\||/?s>|</?SYS>>)|\[(?=/?INST\])"
#: tokens of a window; a quarter is for the turns that repeat
BUDGET = 2048
#: turns of one conversation that one task orders
CHUNK = 256


def escaped(text: Column) -> Column:
    """Text without any control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def rough_tokens(text: Column) -> Column:
    """A count that needs no vocabulary: a token for four bytes."""
    return F.ceil(F.octet_length(text) / 4)


def format_windows(turns: DataFrame, budget: int = BUDGET, tokens: Column | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as windows ``(conv_id, window, text, n_repeated, loss)``.

    ``tokens`` counts a turn's tokens from its ``text`` (``rough_tokens`` if not given); each turn costs four more for
    its marks.  Prefix sums over a conversation put every turn in the window that its end falls in, three eighths of
    the budget wide, so windows hold whole turns, each turn in one window, and no turn is cut: one longer than that
    makes its window longer.  A later window begins with the system turn, if the conversation has one in front, and
    with the longest run of whole turns that ends where its first own turn begins and costs an eighth of the budget at
    most; ``n_repeated`` counts those.  ``loss`` has the character ranges (first, end) of the assistant texts that are
    not repeats, so each is learned once.

    Conversations of any length are summed in chunks of turns.  Rows are ordered by turn, then role and text; a null
    turn comes first, a null role or text is empty; rows with a null conversation are one conversation; repeated rows
    are repeated turns; an empty table gives an empty table.
    """
    width, history = max(1, 3 * budget // 8), budget // 8
    rows = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text).withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    # inside a struct nulls are equal, so that joins use the exchange of the windows
    rows = rows.withColumns({"conv": F.struct("conv_id"), "cost": ((rough_tokens(F.col("text")) if tokens is None else tokens) + 4).cast("long"), "chunk": F.expr(f"floor(coalesce(turn, 0) / {CHUNK})")})
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv", "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("conv", "chunk").agg(F.sum("cost").alias("total"), F.min(F.struct(*order)).alias("head"))
    along = Window.partitionBy("conv").orderBy("chunk")
    # a row per chunk of turns
    starts = sums.select("conv", "chunk", "total", F.coalesce(F.sum("total").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.first("head").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("head"))
    ends = rows.withColumn("own", F.sum("cost").over(inside)).join(starts, ["conv", "chunk"])
    placed = ends.select("conv", "conv_id", "chunk", "turn", "role", "text", "head", "cost", "before", "total", (F.col("before") + F.col("own")).alias("end"), F.expr("before + own = cost and head.role = 'system'").alias("leads"))
    placed = placed.withColumns({"begin": F.col("end") - F.col("cost"), "window": F.expr(f"(end - 1) div {width}")})
    # the first turn of a window begins where the turn before it ends: in an earlier window
    placed = placed.withColumn("first", F.expr(f"begin > 0 and (begin - 1) div {width} < window"))
    # a turn is history of the windows whose first turn begins after it, within the history's width of its own beginning
    near = Window.partitionBy("conv", "chunk").orderBy("begin").rangeBetween(1, max(1, history))
    placed = placed.withColumn("later", F.collect_list(F.when(F.col("first"), F.col("window"))).over(near))
    kept = ["conv_id", "role", "text", "head", "cost", "end", "leads"]
    to = F.expr("concat(array(struct(window, false as repeat)), transform(filter(later, w -> not leads), w -> struct(w as window, true as repeat)))")
    members = placed.withColumn("to", F.explode(to)).select(*kept, "to.*")
    # the same for windows that begin in a later chunk
    cell = max(1, history)
    tails = placed.where(f"not leads and begin + {history} >= before + total").select(*kept, "conv", "chunk", "begin", F.explode(F.expr(f"array(begin div {cell}, begin div {cell} + 1)")).alias("cell"))
    marks = placed.where(f"first and before > 0 and begin - before <= {history}").select("conv", F.col("chunk").alias("home"), F.col("begin").alias("at"), "window", F.expr(f"begin div {cell}").alias("cell"))
    across = tails.join(marks, ["conv", "cell"]).where(f"home > chunk and at <= begin + {history}")
    members = members.unionByName(across.select(*kept, "window", F.lit(True).alias("repeat")))
    piece = F.concat(F.lit(BEGIN), F.url_encode("role"), F.lit("\n"), escaped(F.col("text")), F.lit(END))
    bounded = members.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("end", "repeat", "role", piece.alias("piece"), F.length(F.url_encode("role")).alias("skip")))).alias("turns"),
        F.bool_or("leads").alias("leads"),
        F.first("head").alias("head"),
    )
    lead = F.when(~F.col("leads") & (F.col("head.role") == "system"), F.concat(F.lit(f"{BEGIN}system\n"), escaped(F.col("head.text")), F.lit(END))).otherwise("")
    built = bounded.withColumn("lead", lead).withColumn(
        "parts",
        F.aggregate(
            "turns",
            F.struct(F.length("lead").alias("at"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("loss")),
            lambda s, t: F.struct(
                (s["at"] + F.length(t["piece"])).alias("at"),
                F.when(
                    ~t["repeat"] & (t["role"] == "assistant"),
                    F.concat(s["loss"], F.array(F.struct((s["at"] + len(BEGIN) + t["skip"] + 1).alias("begin"), (s["at"] + F.length(t["piece"]) - len(END)).alias("end")))),
                ).otherwise(s["loss"]).alias("loss"),
            ),
        ),
    )
    repeats = F.size(F.filter("turns", lambda t: t["repeat"])) + F.when(F.col("lead") != "", 1).otherwise(0)
    return built.select("conv_id", "window", F.concat("lead", F.array_join(F.transform("turns", lambda t: t["piece"]), "")).alias("text"), repeats.cast("int").alias("n_repeated"), F.col("parts.loss").alias("loss"))


def read_windows(windows: DataFrame) -> DataFrame:
    """Turns and learned text read back from formatted windows: ``(conv_id, window, n_chars, turns, learned)``.

    ``turns`` has the window's own turns as structs of role and text, ``learned`` all text under its mask.
    """
    pieces = F.slice(F.split("text", r"<\|im_start\|>"), F.col("n_repeated") + 2, F.size(F.split("text", r"<\|im_start\|>")))
    turns = F.transform(pieces, lambda p: F.struct(F.url_decode(F.substring_index(p, "\n", 1)).alias("role"), unescaped(F.regexp_extract(p, r"(?s)\A[^\n]*\n(.*)<\|im_end\|>\n\z", 1)).alias("text")))
    learned = F.array_join(F.transform("loss", lambda x: unescaped(F.substring(F.col("text"), x["begin"] + 1, x["end"] - x["begin"]))), "")
    return windows.select("conv_id", "window", F.length("text").alias("n_chars"), turns.alias("turns"), learned.alias("learned"))


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: turns, their digest, learned characters, their digest, formatted characters.

    Windows stream through in order; a conversation of any length needs one window's memory.
    """
    kind = read.schema["conv_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        names = ("conv_id", "n_chars", "roles", "texts", "learned")

        def row() -> pa.RecordBatch:
            conv, n, turns, chars, loss, size = held
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size), arrow)], schema=arrow)

        for batch in (part for whole in batches for part in slices(whole, "learned")):
            for conv, size, roles, texts, learned in zip(*(batch.column(c).to_pylist() for c in names)):
                if not held or held[0] != conv:
                    if held:
                        yield row()
                    held[:] = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                held[1] += len(roles)
                for r, t in zip(roles, texts):
                    held[2].update(f"{r}\n{t}\n".encode())
                held[3] += len(learned)
                held[4].update(learned.encode())
                held[5] += size
        if held:
            yield row()

    flat = read.select("conv_id", "window", F.col("n_chars").cast("long"), F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"), "learned")
    return sent(flat.repartition("conv_id").sortWithinPartitions("conv_id", "window")).mapInArrow(run, schema)
