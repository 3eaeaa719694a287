import math
import random
import re

import pyarrow as pa
from tabloom.llm import kernel, oracles, ranked_search as rs
from tests_llm_rows import rows_of

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def lowered(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    """Every document against every item."""
    held = [(i, lowered(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    query = {}
    for i, t in dict.fromkeys(items):
        query.setdefault(i, []).extend(lowered(t))
    out = []
    for item, words in query.items():
        scored = []
        for i, w in held:
            m = 25 + 75 * len(w) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m))
                    for t in words if t in w)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        scored.sort()
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, terms string, hash int, class_no int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, item int")
    return rows_of(rs.search(d, b, **kw), "item_id", "rank", "doc_id", "score")


def corpus(seed, rows):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "NAÏVE", "中文", "X1", "the", "The"]
    texts = [draw.choice(["", " ", "-", "!"]).join([" ".join(draw.choice(words[:draw.choice([5, 46])]) for _ in range(draw.randint(0, 12)))] * 2)
             for _ in range(rows // 3)]
    docs = [(draw.choice([None, *range(rows)]), draw.choice([None, "", *texts])) for _ in range(rows)]
    docs += [(1000 + i, texts[0]) for i in range(30)]  # a class larger than k
    items = [(i, " ".join(draw.choice([*words, "unknown"]) for _ in range(draw.randint(0, 9)))) for i in range(25)]
    return docs, [*items, items[3], (4, "w1, w1; W2"), (None, "w3 the"), (90, None), (91, "...")]


def test_equals_all_documents_against_all_items(spark, monkeypatch):
    docs, items = corpus(1, 200)
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    monkeypatch.setattr(rs, "CELLS", 64)  # scores in many steps
    monkeypatch.setattr(rs, "FEW_CLASSES", 1)  # and shuffle joins
    assert run(spark, docs, items, k=3) == brute(docs, items, 3)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = corpus(2, 80)
    monkeypatch.setattr(rs, "POSTINGS", 40)
    assert run(spark, docs, items) == brute(docs, items)


def test_classes_of_one_hash_are_told_apart(spark, monkeypatch):
    docs, items = corpus(3, 120)
    real = rs.classes

    def one_hash(bag, documents, terms):
        from pyspark.sql import functions as F
        return real(bag, documents, terms).withColumn("hash", F.lit(7).cast("long"))

    monkeypatch.setattr(rs, "classes", one_hash)
    assert run(spark, docs, items) == brute(docs, items)


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    def same(*args):
        w = real(*args)
        w.hash[:] = 5
        return w

    real = kernel._cut
    monkeypatch.setattr(kernel, "_cut", same)
    lexicon = rs.Lexicon(["ab", "cd", "abc"])
    assert lexicon.twins == 3
    (w,) = kernel.blocks(pa.array(["abc cd ab x ab", None, "cd"]), separator=kernel.PUNCTUATION)
    assert sorted(zip(*(x.tolist() for x in lexicon.find(w)))) == [(0, 0), (0, 0), (0, 1), (0, 2), (2, 1)]


def test_edges(spark, docs, no_docs):
    bench = spark.createDataFrame([(1, "the quick fox café"), (2, "nothing here matches zzz")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert rs.search(no_docs, bench).collect() == [] and rs.search(docs, none).collect() == []
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(rs.search(docs, bench), "item_id", "rank", "doc_id", "score") == brute(plain, [(1, "the quick fox café"), (2, "nothing here matches zzz")])


def test_query_and_sql_equal_brute_force(spark):
    import duckdb
    from tabloom.llm.queries import op13
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert rows_of(op13(spark, sf), "item_id", "rank", "doc_id", "score") == want
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    assert sorted(con.sql(f"select item_id, rank, doc_id, score from ({oracles.SEARCH})").fetchall(), key=repr) == want
