import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tabloom.llm import bpe
from tests_llm_rows import rows_of

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as f:
        return bpe.vocabulary(f.read(), PATTERN)


def encode(known, *texts):
    block = bpe.Block(known)
    for t in texts:
        block.add(t)
    ids, offsets = block.encoded()
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_queue_gives_lowest_rank_then_leftmost():
    draw, queue, want = random.Random(1), bpe.RankQueue(5000), []
    for _ in range(3000):
        if want and draw.random() < 0.45:
            want.sort()
            rank = queue.first()
            assert (rank, queue.pop(rank)) == want.pop(0)
        else:
            entry = draw.randrange(5000), draw.randrange(100)
            want.append(entry)
            queue.push(*entry)
    for entry in sorted(want):
        assert (queue.first(), queue.pop(entry[0])) == entry
    assert queue.first() == -1 and not any(any(level) for level in queue.levels)


def test_equals_the_library_on_random_texts(known, library):
    draw = random.Random(2)
    alphabet = list("aaabcdeénoöß  \n\t'.,!?0123ЖδΩ中文🙂 　‍́\x1c\x00<|>") + [" the", " der", "'ll", "<|endoftext|>", "  "]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    assert encode(known, *texts) == [library.encode_ordinary(t) for t in texts]


def test_equals_the_library_on_many_characters(known, library):
    points = [chr(i) for i in [*range(0x3100), *range(0xE000, 0x110000, 97)]]
    text = ["a" + c + "x" + c + c + "7 " + c + " " + c for c in points]
    texts = ["|".join(text[i:i + 512]) for i in range(0, len(text), 512)]
    assert encode(known, *texts) == [library.encode_ordinary(t) for t in texts]


def test_equals_the_library_on_long_pre_tokens(known, library):
    draw = random.Random(3)
    for letters, n in (("ab", 20_000), ("a", 30_000), ("etaoinshrdlu", 20_000), (" ", 5000), ("=-", 9000), ("éñ", 8000), ("0", 7777)):
        piece = "".join(draw.choice(letters) for _ in range(n))
        assert known.merge(piece.encode()) == library._encode_single_piece(piece)


def test_common_queue_equals_one_queue_each(known):
    draw = random.Random(4)
    letters = ["a", "e", "th", "er", "ing", "=", "-", " ", "é", "0", "\n"]
    pieces = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 40))).encode() for _ in range(4000)]
    pieces += [b"=" * n for n in range(1, 300)] + [b"ab" * n for n in range(1, 60)]
    ids, offsets = known.merge_many(pieces)
    assert known.hasty.any()
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [known.merge(p) for p in pieces]
    assert known.queue.first() == -1


def test_a_vocabulary_whose_merges_make_lower_ranks():
    """Any order of ranks, so that a merge often makes a pair of lower rank."""
    draw = random.Random(5)
    for _ in range(60):
        tokens = {bytes([b]) for b in b"abc"}
        while len(tokens) < 25:
            tokens.add(bytes(draw.choice(b"abc") for _ in range(draw.randint(2, 5))))
        ranks = dict(zip(draw.sample(sorted(tokens), len(tokens)), range(len(tokens))))
        small = bpe.Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()), PATTERN)
        library = tiktoken.Encoding("small", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = [bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 30))) for _ in range(40)]
        want = [library._encode_single_piece(p) for p in pieces]
        assert [small.merge(p) if p not in ranks else [ranks[p]] for p in pieces] == want
        ids, offsets = small.encode_pieces(pieces)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_rows_and_round_trip(spark, docs, no_docs, library):
    encoded = bpe.encode(docs, PATH, PATTERN, ["doc_id", "score", "_text"])
    assert encoded.columns == ["doc_id", "score", "_text", "ids"]
    back = bpe.decode(encoded, PATH, PATTERN, ["doc_id"])
    want = rows_of(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")), "doc_id", "t")
    assert rows_of(back.select("doc_id", F.decode("decoded", "UTF-8").alias("t")), "doc_id", "t") == want
    got = bpe.digests(encoded, PATH, PATTERN, ["doc_id"]).collect()

    def expected(text):
        ids = library.encode_ordinary(text)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, *expected(t)) for i, t in want), key=repr)
    assert bpe.digests(bpe.encode(no_docs, PATH, PATTERN, ["doc_id"]), PATH, PATTERN, ["doc_id"]).collect() == []


def test_query_equals_the_library(spark, library):
    from tabloom.llm.queries import op11
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in op11(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                    hashlib.sha256((r["text"] or "").encode()).hexdigest())
