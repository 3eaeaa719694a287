import re
import unicodedata

from tabloom.llm import decontaminate as d
from tests_llm_rows import rows_of

ITEMS = [
    (1, "If a train travels 120 km in 2 hours and then 120 km in 3 hours, what is its average speed in total?"),
    (2, "Yesterday the farmer Alice gave 5 apples to Bob and then Alice took 3 pears from the old market."),
    (3, "one two three four five six"), (4, "tiny item"), (5, None), (6, "one two three four five six"),
    (7, "Add 5 to 5 then take 6 from 6 and add 5 to 6 and what number is left"),
]
FILL = "Some other words stand before this and after it there are more of them to read. "


def run(spark, texts, items=ITEMS):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, at int, words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in d.report(docs, bench).collect()}


def test_exact_reworded_and_reparameterised(spark):
    got = run(spark, [
        FILL + ITEMS[0][1] + " " + FILL,
        FILL + "IF A TRAIN travels 75 miles in 4 days and then 75 miles in 9 days - what is its average speed in total " + FILL,
        FILL + "If a train travels 75 km in 4 hours and then 80 km in 4 hours, what is its average speed in total?" + FILL,
        FILL + "Yesterday the farmer Carol gave 7 apples to Dave and then Carol took 2 pears from the old market." + FILL,
        FILL + "Add 5 to 4 then take 6 from 8 and add 5 to 3 and what number is left" + FILL,
        FILL * 30, "", None, "so: one two three four five six, seven", "tiny item", "one two three four five",
    ])
    assert got[0] == (True, 1) and got[1] == (True, 1) and got[3] == (True, 2) and got[8] == (True, 3)
    assert not got[4][0]  # equal values of the item stand for unequal ones: slots are inconsistent
    assert [got[i][0] for i in (5, 6, 7, 9, 10)] == [False] * 5


def test_tokens_have_typed_slots(spark):
    df = spark.createDataFrame([("He paid #3.50 euros to Anna, then 12 km on the 5th.",)], "text string")
    words = df.select(d.tokens(df["text"]).alias("w")).first()["w"]
    assert words == ["he", "paid", "#3", "#50", "~euros", "to", "@anna", "then", "#12", "~km", "on", "the", "5th"]


LETTER = r"[^\W_]"
SPECIAL = set(d.FUNCTION.split("|"))


def own_tokens(text, usual):
    """Template words found character by character, apart from the operator's patterns."""
    text = "".join(" " if c in "#~@^" else c for c in text or "")
    out, i, before = [], 0, []
    units = set(re.sub(r"(\w+)s\?", r"\1|\1s", d.UNITS).split("|"))
    while i < len(text):
        if not (text[i].isalnum() or unicodedata.combining(text[i])):
            i += 1
            continue
        j = i
        while j < len(text) and (text[j].isalnum() or unicodedata.combining(text[j])):
            j += 1
        word = text[i:j]
        digits = re.match(r"\d+", word)
        if digits and word[digits.end():].lower() in units:
            out += ["#" + digits[0], "~" + word[digits.end():].lower()]
        elif digits and digits.end() == len(word):
            out.append("#" + word)
            unit = re.match(r"\s*([^\W\d_]+)(?![\w])", text[j:])
            if unit and unit[1].lower() in units:
                out.append("~" + unit[1].lower())
                j += unit.end()
        elif re.fullmatch("[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+", word) and word not in SPECIAL:
            inside = i >= 2 and text[i - 1] == " " and (text[i - 2].islower() or text[i - 2].isdigit() or text[i - 2] in ",;")
            out.append(word.lower() if not inside and word.lower() in usual else "@" + word.lower())
        else:
            out.append(word.lower())
        i = j
    return out


def own_usual(items):
    """Words that the items write in lower case more often than with a capital inside a sentence."""
    count = {}
    for _, text in items:
        for m in re.finditer(r"[^\W\d_]+", text or ""):
            w = m[0]
            if re.fullmatch("[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+", w) and w not in SPECIAL:
                inside = m.start() >= 2 and text[m.start() - 1] == " " and (text[m.start() - 2].islower() or text[m.start() - 2].isdigit() or text[m.start() - 2] in ",;")
                count[w.lower()] = count.get(w.lower(), 0) - inside
            else:
                count[w.lower()] = count.get(w.lower(), 0) + 1
    return {w for w, n in count.items() if n > 0}


def brute(texts, items):
    """All windows against all windows, from tokens of our own; a window of plain words counts as well."""
    usual = own_usual(items)
    words = [own_tokens(t, usual) for t in [*texts, *[t for _, t in items]]]

    def windows(w, k):
        return [w[i:i + k] for i in range(len(w) - k + 1)]

    def shape(w):
        slots = [x for x in w if x[0] in "#~@"]
        return [x[0] if x[0] in "#~@" else x for x in w], [slots.index(x) for x in slots]

    out = {}
    for i in range(len(texts)):
        hits = []
        for j, (item, _) in enumerate(items):
            w = words[len(texts) + j]
            k = min(d.WINDOW, len(w))
            if k < d.LEAST_WORDS:
                continue
            bare = [[x.lstrip("@") for x in y] for y in (words[i], w)]
            mine = [shape(x) for x in windows(words[i], k)]
            mine_bare = [shape(x) for x in windows(bare[0], k)]
            own = windows(w, k)
            n = sum(shape(x) in mine or shape(y) in mine_bare for x, y in zip(own, windows(bare[1], k)))
            if n >= d.SHARE * len(own):
                hits.append((-n / len(own), item))
        out[i] = (bool(hits), min(hits)[1] if hits else None)
    return out


def test_equals_all_windows_against_all(spark, monkeypatch):
    import random

    draw = random.Random(3)
    vocabulary = ["a", "b", "c", "Anna", "Bob", "3", "4 km", "d."]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(4, 14)))) for i in range(25)]
    texts = [" ".join([*(draw.choice(vocabulary) for _ in range(10)), draw.choice(items)[1].replace("3", "7").replace("Anna", "Carl"),
                       *(draw.choice(vocabulary) for _ in range(10))]) for _ in range(40)]
    texts += [FILL * 3, "a b c d. a b", "c b a. b c", "", "plain words only here", "a c b d. b a c"]
    want = brute(texts, items)
    assert run(spark, texts, items) == want
    monkeypatch.setattr(d, "TABLE", 64)  # a full bit table only lets more windows through
    monkeypatch.setattr(d, "SMALL_WINDOWS", 1)  # and the join is a shuffle
    assert run(spark, texts, items) == want
    assert any(v[0] for v in want.values()) and not all(v[0] for v in want.values())


def test_edges(spark, docs, no_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.report(docs, bench).count() == docs.count()
    assert d.report(no_docs, bench).collect() == [] and d.report(docs, none).where("contaminated").count() == 0
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns and rows_of(kept, *docs.columns) == rows_of(docs, *docs.columns)


def test_names_that_start_a_sentence(spark):
    items = [
        (1, "Natalia sold 48 clips in April. Natalia sold half as many clips in May. How many clips did Natalia sell in all?"),
        (2, "Maria met Peter at noon. Maria gave him 3 books. Peter read one of them and Maria read the other two."),
        (3, "\"Omar has 7 red marbles and 2 blue ones,\" said Lea.\nOmar lost 3 of the red marbles in the park."),
        (4, "Marbles are round toys. The marbles roll down the long hill and the marbles stop there."),
    ]
    got = run(spark, [
        FILL + items[0][1].replace("Natalia", "Alice").replace("48", "30") + " " + FILL,
        FILL + items[1][1].replace("Maria", "Alice").replace("Peter", "Bob") + "\n" + FILL,
        FILL + "\n" + items[2][1].replace("Omar", "Carl").replace("Lea", "Ina"),
        FILL + "Maria sold 48 clips in April. Peter sold half as few pens last May. How may one sell in all?",
    ], items)
    assert [got[i] for i in range(4)] == [(True, 1), (True, 2), (True, 3), (False, None)]


def test_ordinary_words_that_start_a_sentence_are_no_names(spark):
    bench = spark.createDataFrame([(1, "Marbles roll. The marbles stop when Omar calls. Omar runs.")], "item_id long, text string")
    table = d.ordinary_words(bench)
    words = bench.select(d.tokens(bench["text"], table).alias("w")).first()["w"]
    assert words == ["marbles", "roll", "the", "marbles", "stop", "when", "@omar", "calls", "@omar", "runs"]


def test_copies_in_running_text_and_other_letter_case(spark):
    items = [(1, "What is the capital city of France"), (2, ITEMS[1][1]), (3, "Marbles roll down to Omar")]
    got = run(spark, [
        "the quiz then asked What is the capital city of France today", "so what is the capital city of france",
        FILL + ITEMS[1][1].lower(), FILL + ITEMS[1][1].upper(), "he wrote Marbles roll down to Omar on it",
        "the quiz then asked What is the capital city of Spain today", "what is the largest city of France",
    ], items)
    assert [got[i] for i in range(7)] == [(True, 1), (True, 1), (True, 2), (True, 2), (True, 3), (True, 1), (False, None)]


def test_german_and_french_names(spark):
    items = [
        (1, "Die kleine Anna kauft 12 rote und 5 blaue Bälle. Der große Peter nimmt 3 davon. Wie viele hat Anna noch?"),
        (2, "Le petit Marc achète 14 pommes et 6 poires au marché. La mère de Marc mange 2 pommes. Combien en reste-t-il à Marc?"),
    ]
    got = run(spark, [
        FILL + items[0][1].replace("Anna", "Greta").replace("Peter", "Karl").replace("12", "30"),
        FILL + items[1][1].replace("Marc", "Luc").replace("14", "21"),
        FILL + "Die kleine Anna singt gern. Der große Peter nimmt den Bus. Wie viele Lieder kennt Anna?",
        FILL + "Le petit Marc dort. La mère de Marc lit un livre. Combien de pages a-t-elle lues?",
    ], items)
    assert [got[i] for i in range(4)] == [(True, 1), (True, 2), (False, None), (False, None)]


def test_texts_of_common_pairs_of_words(spark):
    """Windows start at many places when the pairs of the benchmark are common; the result is by whole windows."""
    items = [(1, "the cat and the dog and the bird and the fish and the cow"), (2, "and the cat sat on the mat")]
    texts = ["and the " * 50, "the cat and the dog and the bird and the fish and the cow", "dog and the bird and the fish and the", "x and the cat sat on the mat y"]
    assert run(spark, texts, items) == brute(texts, items)


def test_plan_of_benchmark_windows_holds_no_bit_table(spark):
    """Each use of the words would repeat the table in the plan, which the driver keeps as text."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    ordinary = d.ordinary_words(items)
    windows = d.benchmark_windows(items, 8, ordinary)
    assert ordinary.hex().upper() not in windows._jdf.queryExecution().toString()
    assert windows.select("item_id").distinct().count() == 5
