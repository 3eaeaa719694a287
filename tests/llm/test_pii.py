import hashlib
import re

from tabloom.llm import pii


def luhn(number):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
]
TEXTS = [
    "a@b.c@d.e x_y@z.org. a@b.c_d@e.f .@.@- é🙂 n.42@mail.example.com", "1.2.3.4.5 999.1.1.1 0255.00.1.2 1.2.3 10.0.0.256 7.7.7.7.7.7.7.7",
    "4539578763621486 4539 5787 6362 1486 4539578763621486 4539-5787-6362-1486.", "+1 (555) 010-9999, +49 30 1234567 +1 +12345678901234567 +1()2",
    "4" * 20 + " " + "0" * 16, "", None, "no data", "1" * 50_000 + "@", "mail " + "x" * 50_000 + "@host.org", "+1 234 567 8901 2 3",
]


def test_base_spans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(df).collect()}
    for i, t in enumerate(TEXTS):
        want = [(k, m.start(), m.end()) for k, p, ok in RULES for m in re.finditer(p, t or "") if ok(m[0])]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (t, got[i]["spans"])
        assert got[i]["spans"].startswith(text)


def test_reliable_labelers_are_found():
    """Labelers of known reliability on four thousand items, counted by pattern."""
    import random

    draw, counts = random.Random(1), {}
    right = (0.95, 0.8, 0.55, 0.85, 0.7)
    for _ in range(4000):
        truth = draw.random() < 0.4
        votes = tuple((1 if truth else -1) * (1 if draw.random() < p else -1) for p in right)
        sure = truth and draw.random() < 0.1
        counts[votes, sure] = counts.get((votes, sure), 0) + 1
    share, table = pii.reliabilities([(v, s, float(n)) for (v, s), n in sorted(counts.items())])
    for j, p in enumerate(right):
        assert abs(table[j][1][1] - p) < 0.08 and abs(table[j][-1][0] - p) < 0.08
    assert abs(share - 0.4) < 0.1


def test_candidates_next_to_cues_are_reported(spark):
    rows = [(i, f"Please call my phone +1 (555) 010-{1000 + i} or mail to a{i}@b.example.com") for i in range(30)]
    rows += [(100 + i, f"phone: (555) 010-{2000 + i} and mail c{i}@d.example.org") for i in range(20)]
    rows += [(200 + i, f"order no 1234567890{1000 + i}x in stock, version 555-010-{1000 + i}/b") for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("local_phone" in got[100 + i] for i in range(20))
    assert all(got[200 + i] == "" for i in range(30))


def test_edges(docs, no_docs):
    got = pii.report(docs)
    assert got.count() == docs.count() and got.where("n_email = 1").count() == 1
    assert pii.report(no_docs).collect() == []
