"""Positions of regular-expression matches as columns; offsets count code points, ends are exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,text:string>>"


def matches(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of `pattern`. `gate` is a cheap condition that every text with a
    match fulfils; other texts are not searched."""
    p = F.lit(pattern)
    hits = F.regexp_extract_all(text, p, F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(None).cast(SPAN).alias("none"))

    def step(acc: Column, pair: Column) -> Column:
        low = acc["at"] + F.length(pair["gap"]).cast("bigint")
        high = low + F.length(pair["hit"]).cast("bigint")
        one = F.struct(low.alias("start"), high.alias("end"), pair["hit"].alias("text"))
        return F.struct(high.alias("at"), F.concat(F.coalesce(acc["none"], F.array().cast(SPAN)), F.array(one)).alias("none"))

    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    found = F.aggregate(F.slice(pairs, 1, F.size(hits)), start, step, lambda acc: acc["none"])
    ask = F.rlike(text, p) if gate is None else gate & F.rlike(text, p)
    return F.when(ask, found).otherwise(F.array().cast(SPAN))


def labelled(spans: Column, kind: str, rank: int) -> Column:
    """Spans as (rank, start, end, kind)."""
    return F.transform(spans, lambda s: F.struct(
        F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def written(spans: Column, by_start: bool) -> Column:
    """kind:start:end, comma-joined, by start and then kind, or by kind and then start."""
    order = ("start", "rank", "end") if by_start else ("rank", "start", "end")
    keyed = F.transform(spans, lambda s: F.struct(*[s[c].alias(f"k{i}") for i, c in enumerate(order)], s["kind"].alias("kind"),
                                                  s["start"].alias("start"), s["end"].alias("end")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    back = F.reverse(number)
    values = F.transform(F.sequence(F.lit(1), F.length(number)), lambda i: F.substring(back, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by <kind>; of overlapping spans the first one names the place."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"), F.concat(acc["out"], before, F.lit("<"), s["kind"], F.lit(">")).alias("out"))) \
            .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    done = F.aggregate(ordered, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
