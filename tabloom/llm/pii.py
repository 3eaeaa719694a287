"""Personal data in texts: base patterns, and weakly supervised extra spans. DataFrame functions only.

Base spans (email, ip, card, phone) are always reported. For everything else that looks like personal
data - the candidates - labelers vote for, against or not at all:

- shape: a strict pattern of the candidate's kind;
- checksum: a check digit where the kind has one;
- cue: a gazetteer of words before it that announce personal data, in four languages;
- anti-cue: a gazetteer of words that announce other numbers;
- border: whether letters, digits or signs touch it;
- company: whether a base span lies in the same text.

Expectation-maximisation over the counts of vote patterns (a Dawid-Skene model of two classes) estimates
each labeler's reliability and each pattern's probability; base spans, which get the same votes, anchor the
positive class. These probabilities then train a logistic span classifier over votes, kind and length,
and candidates that it gives at least `THRESHOLD` are reported.

Votes and features take few values, so all candidates of all documents are counted by pattern (at most
kinds x lengths x 3^6 rows); only these counts come to the driver. Texts are searched once.

Defined results: a null text is an empty one; repeated rows get equal results, each its own row; null ids
are values like any other; without candidates only base spans are reported. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import whole
from tabloom.llm.spans import digits, kind_count, labelled, luhn, matches, written
from tabloom.storage import materialize

# The base patterns, written so that long runs are searched in linear time.
EMAIL = "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}"
CARD = "[0-9](?:[\\x20-]?[0-9]){15,}+"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]
# Patterns of the candidates.
EXTRA = [
    ("account", "(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])"),
    ("local_phone", "(?<![0-9+(])\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9])"),
    ("ssn", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", "(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){3,7}(?:\\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])"),
    ("person", "(?<=\\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Madame|Monsieur|Señor|Señora)\\.?\\x20)\\p{Lu}\\p{Ll}+(?:\\x20\\p{Lu}\\p{Ll}+)?"),
]
KINDS = [*BASE, *[k for k, _ in EXTRA]]
# Gazetteers of words before a span.
CUES = ("email|e-mail|mail|contact|call|phone|tel|telephone|mobile|fax|card|visa|account|iban|ssn|name|from|ip|address|"
        "kontakt|telefon|handy|karte|konto|adresse|correo|llame|teléfono|tarjeta|cuenta|courriel|appelez|téléphone|carte|compte")
ANTI = "order|invoice|version|isbn|issn|ticket|ref|page|fig|table|section|sku|part|build|no|nr|id|bestellung|rechnung|pedido|factura|commande|facture"
#: How many code points before a span a gazetteer looks at.
CONTEXT = 24
THRESHOLD = 0.5
VOTES = ["shape", "checksum", "cue", "anti", "border", "company"]


def base_spans(text: Column) -> dict[str, Column]:
    digit = F.rlike(text, F.lit("[0-9]"))
    email = matches(text, EMAIL, F.contains(text, F.lit("@")))
    octet = "^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
    ip = F.filter(matches(text, IP, F.contains(text, F.lit("."))), lambda s: F.forall(
        F.split(s["text"], "\\."), lambda p: F.rlike(p, F.lit(octet))))
    # a maximal run with fewer than 16 digits is no match here and a failing one there
    card = F.filter(matches(text, CARD, digit), lambda s: (F.length(digits(s["text"])) <= 19) & luhn(digits(s["text"])))
    phone = F.filter(matches(text, PHONE, F.contains(text, F.lit("+"))),
                     lambda s: F.length(digits(s["text"])).between(8, 15))
    return {"email": email, "ip": ip, "card": card, "phone": phone}


def _candidates(text: Column, kinds: dict[str, Column]) -> Column:
    """Base spans and candidates as (rank, start, end, kind, text, before, next)."""
    def one(rank: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["text"].alias("text"),
            F.substring(text, F.greatest(s["start"] + 1 - CONTEXT, F.lit(1)).cast("int"), F.least(s["start"], F.lit(CONTEXT)).cast("int")).alias("before"),
            F.substring(text, (s["end"] + 1).cast("int"), F.lit(1)).alias("next")))

    return F.concat(*[one(i, k, kinds[k]) for i, k in enumerate(KINDS)])


def _votes(c: DataFrame) -> DataFrame:
    """Votes (1 for, -1 against, 0 none) and the length class of each candidate."""
    number = digits(F.col("text"))
    kind = F.col("kind")
    shape = F.when(kind == "email", F.when(F.rlike("text", F.lit("\\.[A-Za-z]{2,12}$")), 1).otherwise(-1)) \
        .when(kind == "ip", F.when(F.rlike("text", F.lit("^(?:0|127|255)\\.")), -1).otherwise(1)) \
        .when(kind.isin("card", "account"), F.when(F.rlike(number, F.lit("^[3-6][0-9]{12,18}$")), 1).otherwise(-1)) \
        .when(kind.isin("phone", "local_phone"), F.when(F.rlike("text", F.lit("[\\x20().-]")), 1).otherwise(-1)) \
        .when(kind == "ssn", F.when(F.rlike("text", F.lit("^(?:000|666|9)|-00-|-0000$")), -1).otherwise(1)) \
        .when(kind == "iban", F.when(F.length(F.regexp_replace("text", " ", "")).between(15, 34), 1).otherwise(-1)).otherwise(0)
    checksum = F.when(kind.isin("card", "account"), F.when(luhn(number), 1).otherwise(-1)).otherwise(0)
    cue = F.when(F.rlike("before", F.lit(f"(?iu)(?<![\\p{{L}}])(?:{CUES})[^\\p{{L}}]{{0,3}}(?:\\p{{L}}+[^\\p{{L}}]{{1,3}})?$")), 1).otherwise(0)
    anti = F.when(F.rlike("before", F.lit(f"(?iu)(?<![\\p{{L}}])(?:{ANTI})[^\\p{{L}}]{{0,3}}$")), -1).otherwise(0)
    touched = F.rlike("before", F.lit("[\\p{L}\\p{N}_/=#]$")) | F.rlike("next", F.lit("^[\\p{L}\\p{N}_/=]"))
    size = F.length("text")
    return c.withColumns({
        "shape": shape, "checksum": checksum, "cue": cue, "anti": anti, "border": F.when(touched, -1).otherwise(1),
        "company": F.when(F.col("n_base") - (F.col("rank") < len(BASE)).cast("int") > 0, 1).otherwise(0),
        "length_class": F.when(size < 8, 0).when(size < 13, 1).when(size < 20, 2).otherwise(3)})


def reliabilities(patterns: list[tuple[tuple[int, ...], bool, float]], rounds: int = 500) -> tuple[float, list[dict[int, list[float]]]]:
    """Expectation-maximisation over (votes, certain, count): the share of the positive class and, per
    labeler, P(vote | class) for class 0 and 1."""
    k = len(patterns[0][0])
    weight = [1.0 if sure else min(max(0.5 + 0.15 * sum(v), 0.05), 0.95) for v, sure, _ in patterns]
    share, table = 0.5, []
    for _ in range(rounds):
        table = []
        for j in range(k):
            sums = {x: [0.5, 0.5] for x in (-1, 0, 1)}
            for (votes, _, n), p in zip(patterns, weight):
                sums[votes[j]][1] += n * p
                sums[votes[j]][0] += n * (1 - p)
            total = [sum(s[c] for s in sums.values()) for c in (0, 1)]
            table.append({x: [s[0] / total[0], s[1] / total[1]] for x, s in sums.items()})
        everything = sum(n for _, _, n in patterns)
        share = (sum(n * p for (_, _, n), p in zip(patterns, weight)) + 1) / (everything + 2)
        new = []
        for votes, sure, _ in patterns:
            logit = math.log(share / (1 - share)) + sum(math.log(table[j][v][1] / table[j][v][0]) for j, v in enumerate(votes))
            new.append(1.0 if sure else 1 / (1 + math.exp(-max(min(logit, 30), -30))))
        moved = max(abs(a - b) for a, b in zip(new, weight))
        weight = new
        if moved < 1e-9:
            break
    return share, table


def posterior(votes: tuple[int, ...], share: float, table: list[dict[int, list[float]]]) -> float:
    logit = math.log(share / (1 - share)) + sum(math.log(table[j][v][1] / table[j][v][0]) for j, v in enumerate(votes))
    return 1 / (1 + math.exp(-max(min(logit, 30), -30)))


def logistic(rows: list[tuple[list[int], float, float]], width: int, rounds: int = 400, decay: float = 1e-2) -> list[float]:
    """Weights of a logistic model on (active features, soft label, count), by gradient steps with a
    running scale per feature; the first feature is the constant."""
    w, scale = [0.0] * width, [1e-8] * width
    total = sum(n for _, _, n in rows)
    for _ in range(rounds):
        grad = [decay * x for x in w]
        for active, label, n in rows:
            p = 1 / (1 + math.exp(-max(min(sum(w[i] for i in active), 30), -30)))
            for i in active:
                grad[i] += n / total * (p - label)
        for i, g in enumerate(grad):
            scale[i] += g * g
            w[i] -= 0.5 * g / math.sqrt(scale[i])
    return w


def _active(kind: int, size: int, votes: tuple[int, ...]) -> list[int]:
    """Positions of a candidate's features: constant, kind, length class, votes."""
    base = 1 + len(KINDS)
    return [0, 1 + kind, base + size, *[base + 4 + 3 * j + v + 1 for j, v in enumerate(votes)]]


def train(counts: list[tuple[int, int, tuple[int, ...], float]]) -> list[float]:
    """Weights of the span classifier from (kind, length class, votes, count) of all candidates."""
    width = 1 + len(KINDS) + 4 + 3 * len(VOTES)
    if not counts:
        return [-1.0] + [0.0] * (width - 1)
    share, table = reliabilities([(v, kind < len(BASE), n) for kind, _, v, n in counts])
    rows = [(_active(kind, size, v), 1.0 if kind < len(BASE) else posterior(v, share, table), n) for kind, size, v, n in counts]
    return logistic(rows, width)


def scan(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, base spans and all spans as arrays of (rank, start, end, kind): _base, _all."""
    text = F.col("_text")
    kinds = {**base_spans(text), **{k: matches(text, p, F.rlike(text, F.lit("[0-9]")) if k != "person" else None) for k, p in EXTRA}}
    found = docs.select("doc_id", whole().alias("_text")) \
        .withColumns({f"_{k}": c for k, c in kinds.items()}) \
        .withColumn("_base", F.concat(*[labelled(F.col(f"_{k}"), k, i) for i, k in enumerate(BASE)])) \
        .withColumn("_candidates", _candidates(text, {k: F.col(f"_{k}") for k in KINDS})) \
        .select("doc_id", F.xxhash64("_text").alias("_hash"), "_base", "_candidates")
    found = materialize(found, "pii")  # the texts are searched once
    each = found.where("size(_candidates) > 0").select(
        "doc_id", "_hash", "_base", F.size("_base").alias("n_base"), F.explode("_candidates").alias("c")) \
        .select("doc_id", "_hash", "_base", "n_base", "c.*")
    voted = _votes(each)
    counted = voted.groupBy("rank", "length_class", *VOTES).agg(F.count(F.lit(1)).alias("n")).collect()
    weights = train(sorted((r["rank"], r["length_class"], tuple(r[v] for v in VOTES), float(r["n"])) for r in counted))

    def weight(first: int, value: Column, values: int) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in weights[first:first + values]]), value.cast("int") + 1)

    base = 1 + len(KINDS)
    logit = F.lit(weights[0]) + weight(1, F.col("rank"), len(KINDS)) + weight(base, F.col("length_class"), 4)
    for j, v in enumerate(VOTES):
        logit = logit + weight(base + 4 + 3 * j, F.col(v) + 1, 3)
    apart = F.forall("_base", lambda s: (s["end"] <= F.col("start")) | (s["start"] >= F.col("end")))
    extra = voted.where(F.col("rank") >= len(BASE)).where(logit >= math.log(THRESHOLD / (1 - THRESHOLD))).where(apart) \
        .groupBy(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h")) \
        .agg(F.collect_set(F.struct("rank", "start", "end", "kind")).alias("_extra"))
    joined = found.join(extra, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
    return joined.select("doc_id", "_base", F.when(F.col("_extra").isNull(), F.col("_base")).otherwise(
        F.concat("_base", "_extra")).alias("_all"))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: counts and digest of the base spans, and all spans."""
    return scan(docs).select(
        "doc_id", *[kind_count(F.col("_base"), k).alias(f"n_{k}") for k in BASE],
        F.sha2(written(F.col("_base"), False), 256).alias("base_sha256"), written(F.col("_all"), False).alias("spans"))
