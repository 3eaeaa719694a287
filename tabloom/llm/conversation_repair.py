"""Conversation repair: the cheapest edits that make a conversation well formed, by an auction.

A conversation is well formed when the initials of its roles read `(s?(ua)+)?`. Rows have at most one
fault, the first that holds: blank (no character other than white space), duplicate (role and text seen
earlier in the conversation), truncated (the last such character is none of `.!?`). Edits of a row: Keep
(0), Rerole to user or assistant (1), Delete (2; the only one for a blank or a duplicate); Insert puts an
empty user or assistant turn anywhere (5). A truncated row that stays costs 5 more. Of equally cheap
repairs the one whose initials of edits come first in ASCII order is taken.

The repairs are the paths of a lattice: a node is a place between rows and what the turns so far ended
with, an arc is an edit. Nodes have prices that never exceed the cost of an arc plus the price behind it.
A path starts at the first node and looks at its last node: if the price there is less than its best arc
allows, the price rises to it and the path contracts by a node; else the path extends along the best arc.
When it reaches the end, the prices on all cheapest paths are their exact costs to the end, so the arcs
that are tight there are the cheapest ones, and following the least letter of the tight arcs gives the
repair (`auction`, `trace`).

A conversation may hold a large share of all rows. Rows are sorted by a range partition, which splits it
over tasks; each row becomes one character; a conversation's characters are as long as the list of its
edits, which is one field of the result. The lattice is worked through in stretches of `STRETCH` rows,
from the last one to the first, where only the prices at the seams are carried over; repaired rows are
joined by the number of their row.

Defined results: rows are taken by turn (nulls first), then role and text; a null role or text is one
space; a null conv_id is a conversation like any other; an empty role has no initial and cannot be kept;
repeated rows are duplicates; an empty table has no conversations. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm import kernel
from tabloom.llm.common import salted_lookup
from tabloom.storage import materialize

#: Rows of a lattice that is solved at once.
STRETCH = 64
#: Rows of repaired conversations in one batch that a task returns.
BATCH = 1 << 16

# Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: A row's character: the initial of its role (o for any other) by its fault.
CODES = {"": "suao", "truncated": "SUAO", "blank": "1234", "duplicate": "5678"}
INITIALS = "suao"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what the turns so far ended with
FOLLOWS = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NEVER = 1 << 40
END = (0, NEVER, NEVER, 0)  # a conversation may end with nothing or with an assistant
LEGAL = {"su", "ua", "au"}
ROLE = {USER: "user", ASSISTANT: "assistant"}


def _arcs() -> dict[str, list[list[tuple[str, int, int, int]]]]:
    """For each character of a row and state: (letter, cost, rows taken, next state), by letter."""
    out = {}
    for fault, codes in CODES.items():
        for place, code in enumerate(codes):
            out[code] = []
            for state in range(4):
                arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, FOLLOWS[state])]
                if fault in ("", "truncated"):
                    more = TRUNCATED if fault else 0
                    own = (SYSTEM, USER, ASSISTANT, None)[place]
                    if own == FOLLOWS[state] or (own == SYSTEM and state == NOTHING):
                        arcs.append(("K", KEEP + more, 1, own))
                    arcs.append(("R", REROLE + more, 1, FOLLOWS[state]))
                out[code].append(arcs)
    return out


ARCS = _arcs()
AT_END = [[("I", INSERT, 0, FOLLOWS[state])] for state in range(4)]
#: Least cost of a row in any state.
LEAST = {code: min(a[1] for arcs in states for a in arcs if a[2]) for code, states in ARCS.items()}


def _choices(codes: str, leave: tuple[int, ...], price: list[int], node: int) -> tuple[int, str, int]:
    """Best arc of a node: its cost with the price behind it, its letter ("" to the end) and the node
    behind it; the least letter of equals."""
    i, state = divmod(node, 4)
    best = (leave[state], "", -1) if i == len(codes) else (NEVER * 2, "", -1)
    for letter, cost, rows, after in AT_END[state] if i == len(codes) else ARCS[codes[i]][state]:
        behind = (i + rows) * 4 + after
        if cost + price[behind] < best[0]:
            best = (cost + price[behind], letter, behind)
    return best


def auction(codes: str, leave: tuple[int, ...]) -> list[int]:
    """Prices of the lattice of some rows, exact on every cheapest path from each of its four first nodes.
    `leave` holds the costs behind the last row."""
    floor = [min(leave)]
    for code in reversed(codes):
        floor.append(floor[-1] + LEAST[code])
    price = [p for p in reversed(floor) for _ in range(4)]  # no arc is cheaper than the prices it joins
    for source in range(4):
        path = [source]
        while True:
            node = path[-1]
            value, _, behind = _choices(codes, leave, price, node)
            if price[node] < value:
                price[node] = value
                if len(path) > 1:
                    path.pop()
            elif behind < 0:
                break
            else:
                path.append(behind)
    return price


def trace(codes: str, leave: tuple[int, ...], price: list[int], state: int) -> tuple[str, int]:
    """Letters of the first cheapest path from a state, and the state it leaves with. All arcs of the path
    are tight."""
    letters, node = [], state
    while True:
        value, letter, behind = _choices(codes, leave, price, node)
        if value != price[node]:
            raise AssertionError("a price on a cheapest path has not converged")
        if behind < 0:
            return "".join(letters), node & 3
        letters.append(letter)
        node = behind


@functools.lru_cache(maxsize=1 << 14)
def _stretch(codes: str, leave: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    price = auction(codes, leave)
    return tuple(price[:4]), tuple(trace(codes, leave, price, state) for state in range(4))


def repair(codes: str) -> tuple[int, str]:
    """Cost and letters of the repair of a conversation."""
    leave, base, parts = END, 0, []
    for low in range((max(len(codes) - 1, 0)) // STRETCH * STRETCH, -1, -STRETCH):
        enter, traces = _stretch(codes[low:low + STRETCH], leave)
        parts.append(traces)
        least = min(enter)
        leave, base = tuple(p - least for p in enter), base + least
    state, letters = NOTHING, []
    for traces in reversed(parts):
        part, state = traces[state]
        letters.append(part)
    return base + leave[NOTHING], "".join(letters)


def edits(codes: str, letters: str, starts: list[int], sizes: list[int]) -> Iterator[tuple[int, int, str, str | None]]:
    """For each edit: number of the row (of the row before, for an insert), place behind that row, letter,
    and the role given to the turn, if one is."""
    numbers = (first + i for first, n in zip(starts, sizes) for i in range(n))
    number, behind, row, state = starts[0] - 1, 0, -1, NOTHING
    for letter in letters:
        if letter == "I":
            behind += 1
        else:
            number, behind, row = next(numbers), 0, row + 1
        given = None
        if letter == "K":
            state = INITIALS.index(codes[row].lower()) + 1
        elif letter != "D":
            state = FOLLOWS[state]
            given = ROLE[state]
        yield number, behind, letter, given


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(" "))


def placed(turns: DataFrame) -> DataFrame:
    """Every row with its number `at` in the order of conversations and turns, the initial of its role,
    its fault apart from repeats, and a digest of conversation, role and text. Written once."""
    rows = turns.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))
    last = F.regexp_extract("text", "([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z", 1)
    fault = F.when(last == "", "blank").when(last.isin(".", "!", "?"), "").otherwise("truncated")
    place = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    place = F.when((F.length("role") == 0) | (place == 0), 4).otherwise(place)
    owner = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), F.length("role").cast("string"), F.lit(":"))
    same = F.sha2(F.concat(owner, "role", "text"), 256)
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("at"),
                                   place.alias("initial"), fault.alias("fault"), same.alias("same")), "turns")


def plans(rows: DataFrame) -> DataFrame:
    """One row per conversation: numbers of its faults, illegal neighbours, cost, and the letters of its
    edits; `codes`, `starts` and `sizes` say which rows they belong to. Written once."""
    first = rows.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    marked = salted_lookup(rows.select("conv_id", "at", "initial", "fault", "same"), first.select("same", "first"), "same", F.col("at"))
    repeat = (F.col("fault") != "blank") & (F.col("at") > F.col("first"))
    code = F.lit(None)
    for fault, codes in CODES.items():
        here = F.when(repeat, "duplicate").otherwise(F.col("fault")) == fault
        code = F.when(here, F.substring(F.lit(codes), F.col("initial"), F.lit(1))).otherwise(code)
    # a task's part of a conversation is no larger than its partition of `rows`, and its rows are numbered on end
    pieces = marked.select("conv_id", "at", code.alias("code")).groupBy("conv_id", F.shiftright("at", 33).alias("part")).agg(
        F.min("at").alias("start"), F.count(F.lit(1)).alias("size"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "").alias("codes"))
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", "size", "codes"))).alias("p")) \
        .select("conv_id", F.array_join("p.codes", "").alias("codes"), F.col("p.start").alias("starts"), F.col("p.size").alias("sizes"))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            made = [_solved(codes) for codes in batch.column(1).to_pylist()]
            columns = [pa.array([m[k] for m in made], pa.int64()) for k in range(len(counts))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], *columns, pa.array([m[-1] for m in made])],
                                             names=["conv_id", "codes", "starts", "sizes", *counts, "audit"])

    kinds = ", ".join(f"{c} long" for c in counts)
    return materialize(whole.mapInArrow(solve, f"conv_id long, codes string, starts array<long>, sizes array<long>, {kinds}, audit string"), "plans")


@functools.lru_cache(maxsize=1 << 14)
def _solved(codes: str) -> tuple[int, int, int, int, int, str]:
    cost, letters = repair(codes)
    faults = [sum(map(codes.count, CODES[f])) for f in ("blank", "duplicate", "truncated")]
    kinds = codes.translate({ord(c): i for group in CODES.values() for c, i in zip(group, INITIALS)})
    return *faults, sum(a + b not in LEGAL for a, b in zip(kinds, kinds[1:])), cost, letters


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The edited conversations: conv_id, at and behind (the order inside a conversation), edit, role, text.
    Deleted rows are among them, with edit D."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("behind", pa.int64()), ("edit", pa.string()), ("given", pa.string())])
        held: list[tuple] = []
        for batch in kernel.empty_batches(batches):
            for conv, codes, starts, sizes, letters in zip(*(batch.column(i).to_pylist() for i in range(5))):
                for e in edits(codes, letters, starts, sizes):
                    held.append((conv, *e))
                    if len(held) >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    made = plan.select("conv_id", "codes", "starts", "sizes", "audit").mapInArrow(
        spread, "conv_id long, at long, behind long, edit string, given string")
    made = materialize(made, "edits")
    inserted = made.where("edit = 'I'").select("conv_id", "at", "behind", "edit", F.col("given").alias("role"), F.lit("").alias("text"))
    own = made.where("edit <> 'I'").join(rows.select("at", "role", "text").hint("merge"), "at")
    own = own.select("conv_id", "at", "behind", "edit", F.coalesce("given", "role").alias("role"), "text")
    return own.unionByName(inserted)


def hashes(turns: DataFrame) -> DataFrame:
    """SHA-256 of `role:text` of each conversation's turns, joined by line feeds. A digest has to read a
    conversation's turns one after the other, so they stream through one task; none are held."""
    turns = turns.select("conv_id", "at", "behind", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "at", "behind")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in kernel.empty_batches(batches):
            done: list[tuple] = []
            for this, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if digest is None or this != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = this, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
                                             names=["conv_id", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])

    return turns.mapInArrow(fold, "conv_id long, sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """Faults put into rows by the CRC-32 of `conv_id:turn` modulo 20 (a null is one space): 0 drops the row, 1
    empties its text, 2 takes `.!?` out of it, 3 repeats the row, 4 makes its role user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = turns.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conv_id of `conversations`: what is wrong with its rows in `turns`, and their repair."""
    rows = placed(turns)
    plan = plans(rows)
    hashed = hashes(repaired(rows, plan).where("edit <> 'D'"))
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    parts = [conversations.select("conv_id").distinct(), rows.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).alias("gaps")),
             plan.drop("codes", "starts", "sizes"), hashed]
    together = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    together = together.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
                                               F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.max("sha256").alias("sha"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return together.select("conv_id", *counts, "audit", F.coalesce("sha", nothing).alias("repaired_sha256"))
