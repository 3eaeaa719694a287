import math

import numpy as np
import pyarrow as pa

from tabloom.llm import kernel
from tabloom.llm import language_id as li

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, host string, p int, suffix string"


def test_pages_match_their_address(spark):
    """The pages' paths name their language; the operator does not read paths."""
    pages, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("pages", "documents"))
    got = li.identify(pages, docs).join(pages, "page_id").selectExpr("language", "regexp_extract(url, '//[^/]+/([a-z]{2})/', 1) AS path") \
        .where("path IN ('en', 'fr', 'de', 'es')").toPandas()
    assert len(got) > 100 and (got.language == got.path).mean() > 0.95


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.train(docs.where("doc_id % 4 <> 0"))
    rows = docs.where("doc_id % 4 = 0").select("text", "lang").collect()
    right = 0
    for w in kernel.blocks(pa.array([r["text"] for r in rows])):
        text, bucket = li._buckets(w, li.Settings().bits)
        score = np.stack([np.bincount(text, model.log_share[i][bucket], w.n) for i in range(len(model.languages))], 1)
        right += sum(model.languages[k] == rows[w.first + i]["lang"] for i, k in enumerate(score.argmax(1)))
    assert right / len(rows) > 0.97


def small(spark):
    docs = [(i, "the cat and the dog with them", "en") for i in range(5)] + [(9 + i, "le chat et le chien avec eux", "fr") for i in range(5)] + [(20, None, "de"), (21, "x", None)]
    pages = [(i, "https://news.fr.example.fr/a", "<html lang='fr'><p>le chat et le chien</p>") for i in range(6)]
    pages += [(10, "https://news.fr.example.fr/b", ""), (11, None, None), (12, "nonsense", "<b>the cat</b>"), (13, "https://x.example.com", "<html lang=EN-us>the dog"),
              (13, "https://x.example.com", "<html lang=EN-us>the dog"), (None, "http://u@x.example.com:80/", "<script>le chat et</script>"), (14, "https://q.zz", "<html lang=xx>" + "the cat " * 30_000)]
    return (spark.createDataFrame([(*p, "h", 1, "s") for p in pages], PAGES), spark.createDataFrame(docs, "doc_id long, text string, lang string"))


def test_evidence_is_fused(spark):
    pages, docs = small(spark)
    got = {r["page_id"]: r for r in li.identify(pages, docs).collect()}
    assert got[0]["language"] == "fr" and got[10]["language"] == "fr"  # an empty page follows its host
    assert got[13]["language"] == got[12]["language"] == got[14]["language"] == "en"
    assert got[13]["declared"] == "en" and got[14]["declared"] == "other" and got[11]["declared"] == "none"
    assert li.identify(pages, docs).count() == 13


def test_posterior_equals_brute_force(spark):
    pages, docs = small(spark)
    s = li.Settings()
    model = li.train(docs, s)
    k = len(model.languages)
    rows = [r.asDict() for r in li._text_evidence(li._page_parts(pages, model.languages), model, s).collect()]

    def total(**key):
        return np.sum([r["p"] for r in rows if all(r[c] == v for c, v in key.items())], axis=0)

    everything = total() + 1.0
    want = []
    for r in rows:
        score = np.array(r["log"])
        for key in ("declared", "suffix"):
            n = total(**{key: r[key]})
            score += np.log((n + s.evidence_smoothing * n.sum() / everything.sum()) / (everything + s.evidence_smoothing))
        prior = everything / everything.sum()
        for n in (total(domain=r["domain"]), np.maximum(total(host=r["host"]) - np.array(r["p"]), 0)):
            prior = (n + s.host_strength * prior) / (n.sum() + s.host_strength)
        score += np.log(prior)
        want.append((r["page_id"], model.languages[int(score.argmax())], round(float(np.exp(score.max()) / np.exp(score).sum()), 5)))
    got = [(r["page_id"], r["language"], round(r["posterior"], 5)) for r in li.identify(pages, docs, s).collect()]
    assert k == 2 and sorted(map(repr, want)) == sorted(map(repr, got))
    assert not any(math.isnan(x[2]) for x in want)


def test_empty_tables(spark):
    pages, docs = small(spark)
    assert li.identify(pages.where("false"), docs).collect() == []
    assert {r["language"] for r in li.identify(pages, docs.where("false")).collect()} == {None}
