"""Chat formatting with prefix-target expansion. DataFrame functions only.

A conversation is written as a run of marked turns. Every assistant turn becomes an example of its own:
the formatted text of all turns before it, the reply's header, the reply and its end mark; the loss span
covers the reply's text alone. Turns after the last reply form a last example without a loss span (if
`keep_rest`), so no turn is lost.

Control strings inside texts and roles are replaced by the escape sign, a number and a semicolon, the
escape sign itself by the sign and 0: reading back undoes it exactly, and no text can forge a mark.

One conversation's formatted text has to fit in one row, as the longest example holds all of it; the
volume of the examples grows with the square of the turns by the definition of the expansion.

Defined results: null texts and roles are empty; a null conversation id is a conversation of its own;
turns are ordered by turn (null first), then role, then text, and repeated rows all count; an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ESCAPE = "␛"
# Control strings of common chat templates.
CONTROLS = [OPEN, CLOSE, "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>"]


def _tokens(role: bool) -> list[tuple[str, str]]:
    return [(c, f"{ESCAPE}{i + 1};") for i, c in enumerate([*CONTROLS, *(["\n"] if role else [])])]


def escaped(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(f"{ESCAPE}0"))
    for plain, token in _tokens(role):
        text = F.replace(text, F.lit(plain), F.lit(token))
    return text


def unescaped(text: Column, role: bool = False) -> Column:
    for plain, token in _tokens(role):
        text = F.replace(text, F.lit(token), F.lit(plain))
    return F.replace(text, F.lit(f"{ESCAPE}0"), F.lit(ESCAPE))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order: array of (turn, role, text)."""
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))


def expand(turns: DataFrame, target: str = "assistant", keep_rest: bool = True) -> DataFrame:
    """One row per example: conv_id, example (from 1), examples, formatted, loss_start, loss_end.

    Offsets count code points from 0, the end exclusive; both are null where nothing is trained.
    """
    written = conversations(turns).withColumn("parts", F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escaped(t["role"], True), F.lit("\n")).alias("head"),
        escaped(t["text"]).alias("body"), (t["role"] == target).alias("hit")))).drop("turns")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<last:int,start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        low = acc["at"] + F.length(p["head"])
        high = low + F.length(p["body"])
        end = high + len(CLOSE) + 1
        span = F.struct(end.alias("last"), low.alias("start"), high.alias("end"))
        return F.struct(end.alias("at"), F.when(p["hit"], F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    def finish(acc: Column) -> Column:
        rest = F.struct(acc["at"].alias("last"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))
        covered = F.coalesce(F.try_element_at(acc["spans"], F.lit(-1))["last"], F.lit(0)) == acc["at"]
        return F.when(covered, acc["spans"]).otherwise(F.concat(acc["spans"], F.array(rest))) if keep_rest else acc["spans"]

    placed = written.select(
        "conv_id", F.aggregate("parts", start, step, finish).alias("spans"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE + "\n"))), "").alias("whole"))
    return placed.select("conv_id", "whole", F.size("spans").alias("examples"), F.posexplode("spans").alias("example", "span")) \
        .select("conv_id", (F.col("example") + 1).alias("example"), "examples",
                F.substring("whole", F.lit(1), F.col("span.last")).alias("formatted"),
                F.col("span.start").cast("bigint").alias("loss_start"), F.col("span.end").cast("bigint").alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, read back: array of (role, text)."""
    def one(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 2 - len(CLOSE))
        return F.struct(unescaped(role, True).alias("role"), unescaped(text).alias("text"))

    pieces = F.split(formatted, "<\\|im_start\\|>", -1)
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), one)


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """The trained text of an example, read back; empty where nothing is trained."""
    return F.coalesce(unescaped(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int"))), F.lit(""))


def digest(examples: DataFrame) -> DataFrame:
    """One row per conversation, from the examples alone. The last example holds every turn; each
    reply's text is read from its own example."""
    read = examples.select(
        "conv_id", "example", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
        F.length("formatted").cast("bigint").alias("chars"),
        F.when(F.col("example") == F.col("examples"), F.col("formatted")).alias("whole"))
    joined = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.element_at(F.collect_list("whole"), 1).alias("whole"), F.sum("chars").alias("formatted_chars"))
    turns = read_turns(F.col("whole"))
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return joined.select("conv_id", F.size(turns).cast("bigint").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
                         F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
