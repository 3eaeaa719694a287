"""Secrets in texts, and multipart credentials linked inside scopes. DataFrame functions only.

Base spans (assignments of secrets, access identifiers, long hexadecimal runs) are always reported.
Weak candidates - login names, bare 40-character keys, short passphrases, service addresses - are common
in harmless text, so each is reported only when its complementary parts lie within `reach` code points:
an identifier needs a secret, a secret needs an identifier or an address, an address needs a secret.
Base spans count as parts too (access: identifier; assign and hex: secret).

The interval join runs over candidates only: rows of one text are sorted by position, and running
extremes from both ends give each candidate the nearest part of every role on either side, so the work is
linear in the candidates and no pair is emitted. Texts without a weak candidate stay out of it.

Defined results: a null text is an empty one; repeated rows get equal results, each its own row; a null
id is a value like any other. Extra columns are ignored, or kept by `redacted`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import whole
from tabloom.llm.spans import kind_count, labelled, matches, redact, written
from tabloom.storage import materialize

REACH = 300
# The base patterns.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
# The weak patterns, by role.
WEAK = [
    ("login", "identifier", "(?i:user(?:name)?|login|client_?id|account_?id)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9._@-]{3,}"),
    ("passphrase", "secret", "(?i:\\b(?:pass|pwd|passphrase|auth|private_?key))[\"']?\\x20*[:=]\\x20*[\"']?[^\\s\"',;]{4,}"),
    ("key40", "secret", "(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"),
    ("endpoint", "address", "(?i:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|sftp|ftp|ssh)://[^\\s\"'<>]+"),
]
KINDS = ["assign", "access", "hex", *[k for k, _, _ in WEAK]]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", **{k: r for k, r, _ in WEAK}}


def base_spans(text: Column) -> dict[str, Column]:
    """Base spans by kind; failing matches are dropped after matching, so they still consume text."""
    signs = F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))
    assign = F.filter(matches(text, ASSIGN, signs),
                      lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= LEAST["assign"])
    # maximal runs: asking for the least length in the pattern drops the same matches
    access = matches(text, f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}", F.contains(text, F.lit("AKIA")))
    long_hex = matches(text, f"(?<![0-9a-f])[0-9a-f]{{{LEAST['hex']},}}+")
    return {"assign": assign, "access": access, "hex": long_hex}


def _weak_spans(text: Column) -> dict[str, Column]:
    signs = F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))
    gate = {"endpoint": F.contains(text, F.lit("://")), "key40": None}
    return {k: matches(text, p, gate.get(k, signs)) for k, _, p in WEAK}


def scan(docs: DataFrame, reach: int = REACH, keep: list[str] | None = None) -> DataFrame:
    """Every row's `keep` columns (doc_id), base spans, and all spans (base ones and linked ones), each an
    array of (rank, start, end, kind), as columns _base and _all; _text is the whole text."""
    keep = keep if keep is not None else ["doc_id"]
    text = whole()
    found = {**base_spans(F.col("_text")), **_weak_spans(F.col("_text"))}
    rows = docs.select(*keep, F.col("doc_id").alias("_id"), text.alias("_text")) \
        .withColumns({f"_{k}": labelled(found[k], k, i) for i, k in enumerate(KINDS)}) \
        .withColumn("_base", F.concat("_assign", "_access", "_hex")) \
        .withColumn("_weak", F.concat(*[f"_{k}" for k, _, _ in WEAK])) \
        .withColumn("_hash", F.xxhash64("_text"))
    linked = _linked(rows.where("size(_weak) > 0 AND size(_base) + size(_weak) > 1")
                     .select("_id", "_hash", F.concat("_base", "_weak").alias("_parts")), reach)
    linked = materialize(linked, "linked")  # its size is known to the join: few links move no texts
    joined = rows.join(linked, rows["_id"].eqNullSafe(linked["_lid"]) & (rows["_hash"] == linked["_lhash"]), "left")
    return joined.select(*keep, "_text", "_base", F.when(
        F.col("_found").isNull(), F.col("_base")).otherwise(F.concat("_base", "_found")).alias("_all"))


def _linked(rows: DataFrame, reach: int) -> DataFrame:
    """Weak spans whose complementary parts co-occur: (_lid, _lhash, _found), one row per text."""
    role = F.create_map(*[F.lit(x) for k in KINDS for x in (k, ROLE[k])])
    parts = rows.select("_id", "_hash", F.explode("_parts").alias("p")).distinct() \
        .select("_id", "_hash", "p.*").withColumn("role", role[F.col("kind")])
    ahead = Window.partitionBy("_id", "_hash").orderBy("start", "end", "rank").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("_id", "_hash").orderBy(F.desc("start"), F.desc("end"), F.desc("rank")) \
        .rowsBetween(Window.unboundedPreceding, -1)

    def near(r: str) -> Column:
        before = F.max(F.when(F.col("role") == r, F.col("end"))).over(ahead)
        after = F.min(F.when(F.col("role") == r, F.col("start"))).over(behind)
        return F.coalesce(before >= F.col("start") - reach, F.lit(False)) | F.coalesce(after <= F.col("end") + reach, F.lit(False))

    parts = parts.withColumns({f"near_{r}": near(r) for r in ("identifier", "secret", "address")})
    good = F.when(F.col("role") == "secret", F.col("near_identifier") | F.col("near_address")) \
        .otherwise(F.col("near_secret"))
    return parts.where(F.col("rank") > 2).where(good).groupBy(F.col("_id").alias("_lid"), F.col("_hash").alias("_lhash")) \
        .agg(F.collect_list(F.struct("rank", "start", "end", "kind")).alias("_found"))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: counts and digest of the base spans, and all spans."""
    found = scan(docs)
    count = {k: kind_count(F.col("_base"), k) for k in ("assign", "access", "hex")}
    return found.select("doc_id", *[c.alias(f"n_{k}") for k, c in count.items()],
                        F.sha2(written(F.col("_base"), True), 256).alias("base_sha256"),
                        written(F.col("_all"), True).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """Rows of `docs` with every reported span of the text replaced by its kind; n_chars is renewed where
    the text changed. Null texts stay null."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = scan(docs.select(row, "doc_id", "text"), keep=["_row"])
    hit = F.size("_all") > 0
    new = {"text": F.when(hit, redact(F.col("_text"), F.col("_all"))).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        chars = F.length("_new").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(hit, chars).otherwise(F.col("_row.n_chars"))
    return found.withColumn("_new", new["text"]).select(
        *[(F.col("_new") if c == "text" else new.get(c, F.col(f"_row.`{c}`"))).alias(c) for c in docs.columns])
