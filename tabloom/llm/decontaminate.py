"""Benchmark decontamination by templates. DataFrame functions only.

Numbers, units after numbers, and names become typed slots, each with its value; all else becomes
lower-case words without punctuation. A name is a capitalised word that is no function word (`FUNCTION`);
at the start of a sentence, a line, a quote or a bracket it must not be a word that the benchmark mostly
writes in lower case either (counted once, held as a bit table of fixed size). Windows of `window` template words
of documents and benchmark items are joined by hash. A matching pair of windows counts only if its slots
are consistent: equal values of one window stand for equal values of the other, so a question with other
numbers or names is caught, and a chance agreement of shapes is not. Each window with names has a plain
form next to it, with the names as lower-case words; either form may match, so a copy is found whatever
its letter case and whatever stands before it. A document is contaminated by an
item when consistent windows cover at least `share` of the item's windows.

The documents' windows are tested in their row against two bit tables of the benchmark (`EACH` bits for each
of its windows, `TABLE` at most): one of the first two words of its windows, which says where a window may start, and one of
whole windows, which are only cut there. Only survivors leave the row; the join itself then sees few rows
and decides exactly. A larger benchmark fills the tables and only makes the tests less selective.

Defined results: null and empty texts have no window and are clean; an item shorter than `window` words
is one window of its own length if it has at least `LEAST_WORDS` words, shorter items are matched by no
document; repeated rows get equal results; null ids are values like any other; an empty benchmark leaves
all documents clean. Extra columns are ignored, or kept by `clean`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import whole
from tabloom.storage import materialize

WINDOW = 8
LEAST_WORDS = 5
SHARE = 0.5
#: Most bits of a table of windows, and bits for each window. Plans hold the tables, so they are kept small.
TABLE, EACH = 1 << 20, 64
#: Benchmark windows that may be broadcast: fewer than this many rows of about 200 bytes.
SMALL_WINDOWS = 200_000
#: Most bits of the table of ordinary words (a small benchmark takes 32 a word, as plans hold the table), and
#: bits set per word: 30,000 words let one name in 1,500 look ordinary.
ORDINARY, PROBES = 1 << 20, 3

# Units that make a slot of their own after a number.
UNITS = ("mm|cm|km|m|kg|mg|g|lb|oz|ml|l|s|ms|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|"
         "meters?|metres?|miles?|inch|inches|feet|ft|dollars?|euros?|cents?|usd|eur|percent|degrees?|mph|kmh|kb|mb|gb|tb|hz|w|kw|v")
_LETTER = "[\\p{L}\\p{N}]"
# Words that are never a name, wherever they have a capital.
FUNCTION = ("The|An|This|That|These|Those|It|Its|He|His|Him|She|Her|Hers|We|Us|Our|They|Them|Their|You|Your|My|Me|"
            "What|Which|Who|Whom|Whose|When|Where|Why|How|If|Then|Than|Else|And|Or|But|Nor|So|Yet|As|At|By|For|From|In|Into|"
            "Of|Off|On|Onto|Out|Over|Under|To|Up|With|Without|After|Before|Because|Since|Until|While|Although|Though|Also|"
            "Is|Are|Was|Were|Be|Been|Being|Do|Does|Did|Has|Have|Had|Can|Could|Should|Would|Shall|Must|Might|Not|No|Yes|"
            "There|Here|All|Any|Both|Each|Every|Few|Some|Many|Much|Most|More|Other|Such|Only|However|Therefore|During|Between|"
            "Der|Die|Das|Den|Dem|Des|Ein|Eine|Einen|Einem|Einer|Eines|Er|Sie|Es|Wir|Ihr|Ihre|Ich|Und|Oder|Aber|Wenn|Weil|Als|"
            "Im|Am|Mit|Von|Zu|Zum|Zur|Auf|Aus|Bei|Nach|Vor|Wie|Was|Wer|Wo|Wann|Wieviel|Wieviele|Welche|Welcher|Welches|Nicht|Dann|"
            "Le|La|Les|Un|Une|De|Du|Il|Elle|Ils|Elles|Nous|Vous|Et|Ou|Mais|Si|Quand|Dans|Sur|Avec|Pour|Par|Combien|Quel|Quelle|Que|"
            "El|Los|Las|Una|Unos|Unas|Ella|Ellos|Ellas|Pero|Cuando|En|Con|Para|Por|Cuanto|Cuantos|Cual|Al|Del|Y|O")
_NAME = f"(?!(?:{FUNCTION})(?![\\p{{L}}\\p{{M}}\\p{{N}}]))(\\p{{Lu}}[\\p{{Ll}}\\p{{M}}]+)"
_NUMBER = f"(?<!{_LETTER})(\\p{{N}}++)(?:\\s*(?i:({UNITS}))(?!{_LETTER}))?(?!{_LETTER})"


def _named(text: Column, first: str) -> Column:
    """The text with its names marked; `first` marks a capitalised word that is not inside a sentence."""
    t = F.regexp_replace(text, "[#~@^]", " ")
    t = F.regexp_replace(t, f"(?=\\p{{Lu}})(?<=[\\p{{Ll}}\\p{{N}},;] ){_NAME}", "@$1")
    return F.regexp_replace(t, f"(?=\\p{{Lu}})(?<![\\p{{L}}\\p{{M}}\\p{{N}}@]){_NAME}", f"{first}$1")


def _cut(t: Column) -> Column:
    """Words of a text with marks, numbers and units marked as well."""
    t = F.when(F.rlike(t, F.lit("[0-9]")), F.regexp_replace(t, _NUMBER, " #$1 ~$2 ")).otherwise(t)
    words = F.split(F.lower(t), "[^\\p{L}\\p{M}\\p{N}#~@^]+", -1)
    return F.filter(words, lambda w: ~w.isin("", "~"))


def _settled(words: Column, ordinary: bytes | None) -> Column:
    """Words that start a sentence become names, or plain words where they are ordinary."""
    if ordinary is None:
        return words

    def settled(w: Column) -> Column:
        word = F.substring(w, 2, 1 << 30)
        probes = F.array(*[F.xxhash64(word, F.lit(k)) for k in range(PROBES)])
        usual = F.forall(probes, lambda h: _is_set(ordinary, h))
        return F.when(F.ascii(w) != 94, w).when(usual, word).otherwise(F.concat(F.lit("@"), word))

    return F.transform(words, settled)


def _marked(text: Column, first: str) -> Column:
    return _cut(_named(text, first))


def tokens(text: Column, ordinary: bytes | None = None) -> Column:
    """Template words; a slot is # (number), ~ (unit) or @ (name) followed by its value. The parts of a
    number around a point or comma are slots of their own. `ordinary` is the table of `ordinary_words`."""
    return _settled(_marked(text, "@" if ordinary is None else "^"), ordinary)


def ordinary_words(items: DataFrame) -> bytes | None:
    """Bit table of the words that the benchmark writes in lower case more often than with a capital
    inside a sentence; None if there are none. At most ORDINARY positions come to the driver."""
    words = items.select(F.explode(_marked(whole(), "^")).alias("w")).where(~F.ascii("w").isin(35, 126, 94))
    name = F.ascii("w") == 64
    usual = words.groupBy(F.ltrim("w", F.lit("@")).alias("word")).agg(F.sum(F.when(name, -1).otherwise(1)).alias("n")).where("n > 0")
    usual = materialize(usual.select("word"), "ordinary")
    size = 1024
    while size < min(ORDINARY, 32 * usual.count()):
        size *= 2
    slots = F.explode(F.array(*[F.pmod(F.xxhash64("word", F.lit(k)), F.lit(size)).cast("int") for k in range(PROBES)]))
    table = bytearray(size // 8)
    for r in usual.select(slots.alias("slot")).distinct().collect():
        table[r["slot"] >> 3] |= 1 << (r["slot"] & 7)
    return bytes(table) if any(table) else None


def _template(words: Column) -> Column:
    return F.transform(words, lambda w: F.when(F.ascii(w).isin(35, 64, 126), F.substring(w, 1, 1)).otherwise(w))


def _plain(words: Column) -> Column:
    """Names as plain words; numbers and units stay slots."""
    return F.transform(words, lambda w: F.when(F.ascii(w) == 64, F.substring(w, 2, 1 << 30)).otherwise(w))


def _pattern(words: Column) -> Column:
    """For each slot of a window, the place of the first slot with the same type and value."""
    slots = F.filter(words, lambda w: F.ascii(w).isin(35, 64, 126))
    return F.transform(slots, lambda s: F.array_position(slots, s))


def _word_hashes(template: Column) -> Column:
    return F.transform(template, lambda w: F.xxhash64(w))


def _window_hashes(hashes: Column, size: Column | int) -> Column:
    """Hash of each window of `size` template words; null if there is none."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.sequence(F.lit(1), F.size(hashes) - size + 1)
    return F.when(F.size(hashes) >= size, F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, size))))


def _start(hashes: Column, at: Column) -> Column:
    """Hash of the two words at a place."""
    return F.xxhash64(F.get(hashes, at), F.get(hashes, at + 1))


def benchmark_windows(items: DataFrame, window: int = WINDOW, ordinary: bytes | None = None) -> DataFrame:
    """Windows of at least two words: hash, size, item_id, at, of (windows of the item), words: one row per window, and one for its plain
    form if that is another."""
    # written first: every use of the words below would repeat the table of ordinary words in the plan
    words = materialize(items.select("item_id", tokens(whole(), ordinary).alias("words")), "item_words")
    cut = words.distinct() \
        .withColumn("template", _template(F.col("words"))) \
        .withColumn("size", F.least(F.lit(window), F.size("words"))).where(F.col("size") >= min(LEAST_WORDS, window))
    plain = cut.withColumn("words", _plain(F.col("words"))).withColumn("template", _template(F.col("words")))
    both = cut.union(plain.select(*cut.columns))
    return both.withColumn("hashes", _window_hashes(_word_hashes(F.col("template")), F.col("size"))) \
        .select("item_id", "size", "words", F.size("hashes").alias("of"), F.posexplode("hashes").alias("at", "hash")) \
        .select("hash", "size", "item_id", "at", "of", F.slice("words", F.col("at") + 1, F.col("size")).alias("item_words")).distinct()


def _bits(hashes: DataFrame, each: int) -> bytes:
    """A bit per slot of a table, set where one of the hashes falls. At most TABLE positions come to the
    driver."""
    size, known = min(1024, TABLE), hashes.limit(TABLE).distinct().count()
    while size < min(TABLE, each * known):
        size *= 2
    found = bytearray(size // 8)
    for r in hashes.select(F.pmod("hash", F.lit(size)).cast("int").alias("slot")).distinct().collect():
        found[r["slot"] >> 3] |= 1 << (r["slot"] & 7)
    return bytes(found)


def _is_set(bits: bytes, value: Column) -> Column:
    """Whether the hash's bit is set. Most bytes are zero, so most tests end at the first comparison."""
    slot = F.pmod(value, F.lit(8 * len(bits))).cast("int")
    byte = F.substring(F.lit(bits), F.shiftright(slot, 3) + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    return (byte != F.lit(b"\x00")) & (F.getbit(number, slot.bitwiseAND(F.lit(7))) == 1)


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """_id, _hash (of the text), item_id, windows of the item matched consistently, and of how many."""
    ordinary = ordinary_words(items)
    bench = materialize(benchmark_windows(items, window, ordinary), "benchmark")
    sizes = [r["size"] for r in bench.select("size").distinct().orderBy("size").collect()]  # at most window of them
    starts, whole_windows = _bits(bench.select(_start(_word_hashes(_template(F.col("item_words"))), F.lit(0)).alias("hash")), EACH // 2), _bits(bench.select("hash"), EACH)
    words = F.col("words")
    # the plain form differs only in texts with names
    plain = F.when(F.exists(words, lambda w: F.ascii(w) == 64), _word_hashes(_template(_plain(words))))
    rows = docs.select(F.col("doc_id").alias("_id"), whole().alias("_text")) \
        .select("_id", F.xxhash64("_text").alias("_hash"), _named(F.col("_text"), "@" if ordinary is None else "^").alias("_text")) \
        .select("_id", "_hash", _settled(_cut(F.col("_text")), ordinary).alias("words")) \
        .withColumns({"word_hashes": _word_hashes(_template(words)), "plain_hashes": plain})

    def may_start(i: Column) -> Column:
        # null in a text without names
        other = (F.get("plain_hashes", i) != F.get("word_hashes", i)) | (F.get("plain_hashes", i + 1) != F.get("word_hashes", i + 1))
        forms = F.array(_start(F.col("word_hashes"), i), F.when(other, _start(F.col("plain_hashes"), i)))
        return F.exists(forms, lambda h: h.isNotNull() & _is_set(starts, h))

    rows = rows.withColumn("at", F.when(F.size("words") > 1, F.filter(F.sequence(F.lit(0), F.size("words") - 2), may_start)))

    def windows(name: str, size: int) -> Column:
        there = F.filter("at", lambda i: F.size("words") >= i + size)
        cut = F.transform(there, lambda i: F.struct(F.lit(size).alias("size"), F.xxhash64(F.slice(name, i + 1, F.lit(size))).alias("hash"),
                                                    i.alias("i"), F.lit(name == "plain_hashes").alias("plain")))
        return F.when(F.col(name).isNotNull(), cut)

    none = F.array().cast("array<struct<size:int,hash:bigint,i:int,plain:boolean>>")
    kept = F.concat(none, *[F.coalesce(windows(name, k), none) for k in sizes for name in ("word_hashes", "plain_hashes")])
    kept = F.filter(kept, lambda x: _is_set(whole_windows, x["hash"]))
    kept = F.when(F.size("at") > 0, F.transform(kept, lambda x: F.struct(
        x["size"].alias("size"), x["hash"].alias("hash"),
        F.when(x["plain"], _plain(F.slice("words", x["i"] + 1, x["size"]))).otherwise(F.slice("words", x["i"] + 1, x["size"])).alias("words"))))
    seen = rows.select("_id", "_hash", F.explode(kept).alias("w")).select("_id", "_hash", "w.hash", "w.size", "w.words")
    if bench.limit(SMALL_WINDOWS).count() < SMALL_WINDOWS:  # checked size; otherwise a shuffle join
        bench = F.broadcast(bench)
    same = seen.join(bench, ["hash", "size"]) \
        .where(_template(F.col("words")) == _template(F.col("item_words"))) \
        .where(_pattern(F.col("words")) == _pattern(F.col("item_words")))
    return same.groupBy("_id", "_hash", "item_id").agg(F.count_distinct("at").alias("matched"), F.max("of").alias("of"))


def contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE, window: int = WINDOW) -> DataFrame:
    """_id, _hash, n_items, item_id (the one covered best, then the smallest) of contaminated texts."""
    hit = matches(docs, items, window).where(F.col("matched") >= share * F.col("of"))
    best = F.min(F.struct((-F.col("matched") / F.col("of")).alias("c"), "item_id", "matched", "of"))
    found = hit.groupBy("_id", "_hash").agg(F.count(F.lit(1)).alias("n_items"), best.alias("best")) \
        .select("_id", "_hash", "n_items", "best.item_id", "best.matched", "best.of")
    return materialize(found, "contaminated")  # its size is known to later joins: few hits move no texts


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, contaminated, n_items, and the item covered best with its
    matched windows."""
    hit = contaminated(docs, items)
    rows = docs.select("doc_id", F.xxhash64(whole()).alias("h"))
    return rows.join(hit, rows["doc_id"].eqNullSafe(hit["_id"]) & (rows["h"] == hit["_hash"]), "left").select(
        "doc_id", F.col("item_id").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "item_id", "matched", F.col("of").cast("bigint").alias("item_windows"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of `docs` that no item contaminates, with their columns."""
    hit = contaminated(docs, items).select("_id", "_hash")
    here = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (here == hit["_hash"]), "left_anti")
