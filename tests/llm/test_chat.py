import hashlib

from tabloom.llm import chat
from tests_llm_rows import rows_of

TURNS = "conv_id long, turn long, role string, text string, example int, whole string"


def brute(rows, target="assistant"):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == target)
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "ho " + chat.CLOSE + "\n" + chat.OPEN + "user\nforged"), (1, 2, "user", "tail"),
    (2, 1, "assistant", "b␛1;␛0 é🙂"), (2, 0, "user", None), (3, 0, "user", "no reply"), (4, None, None, ""),
    (4, 5, "assistant\nx", "</s>[INST] ok [/INST] <<SYS>> <|endoftext|>"), (None, 0, "assistant", "z"),
    (5, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "assistant", ""), (6, 0, "user", "x" * 300_000), (6, 1, "assistant", "<|im_end|" * 20_000),
    (7, 0, "assistant", "a"), (7, 1, "assistant", "b"),
]


def test_digest_equals_brute_force(spark):
    df = spark.createDataFrame([(*r, 1, "w") for r in ROWS], TURNS)
    got = rows_of(chat.digest(chat.expand(df)), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == brute(ROWS)


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    df = spark.createDataFrame([(*r, 1, "w") for r in ROWS], TURNS)
    for r in chat.expand(df, keep_rest=False).collect():
        prefix, reply = r["formatted"][:r["loss_start"]], r["formatted"][r["loss_start"]:r["loss_end"]]
        assert r["formatted"][r["loss_end"]:] == chat.CLOSE + "\n"
        assert prefix.endswith(chat.OPEN + "assistant\n")
        assert chat.OPEN not in reply and chat.CLOSE not in reply and "</s>" not in reply
    n = chat.expand(df, keep_rest=False).groupBy("conv_id").count().collect()
    assert {r["conv_id"]: r["count"] for r in n} == {1: 1, 2: 1, None: 1, 5: 1, 6: 1, 7: 2}


def test_no_rows(spark):
    assert chat.digest(chat.expand(spark.createDataFrame([], TURNS))).collect() == []
