import random

import pytest
from tokenizers import Tokenizer, models

from prismframe.llm.token_counts import CountOnlyViterbi, load_vocabulary, token_counts

TEXTS = ["", " ", "a", " a", "a  b", "the quick  brown\n\n fox\t.", "日本 語\t\n é😀x", "▁▁x ▁", "hello   world   \n  x", "<s>hi</s><0x0A>", "Straße öffnen été niño", "x" * 5000 + " y", "ab " * 3000]


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary()


def reference(vocabulary, byte_fallback=True):
    rows = [("<unk>", 0.0), *((f"<0x{i:02X}>", -1e9) for i in range(256)), *zip(vocabulary["pieces"], vocabulary["scores"], strict=True)]
    t = Tokenizer(models.Unigram(rows, unk_id=0, byte_fallback=byte_fallback))
    return lambda x: len(t.encode("▁" + x.replace(" ", "▁")).ids) if x else 0


def test_counts_equal_the_tokenizer(spark, vocabulary):
    rng = random.Random(3)
    letters = "the aeinrst,.▁\né😀漢0"
    texts = [t for t in TEXTS if "<0x" not in t] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    want = reference(vocabulary)
    got = token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: want(t) for i, t in enumerate(texts)}


def brute(pieces, unknown, word):
    """Best (score, pieces) over all segmentations; ties to the earliest start of the last piece, recursively."""
    if not word:
        return 0.0, 0
    best = None
    for start in range(len(word)):
        piece = word[start:]
        if piece in pieces:
            score, n = brute(pieces, unknown, word[:start])
            found = (score + pieces[piece], n + 1)
        elif len(piece) == 1:
            score, n = brute(pieces, unknown, word[:start])
            found = (score + unknown, n + len(piece.encode()))
        else:
            continue
        if best is None or found[0] > best[0]:
            best = found
    return best


def test_ties_and_unknown_characters_by_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 3))): float(-rng.randint(1, 4)) for _ in range(8)}
        v = CountOnlyViterbi({"pieces": list(pieces), "scores": list(pieces.values()), "byte_fallback": True})
        word = "".join(rng.choice("abcé") for _ in range(8))
        assert v.best(word) == pytest.approx(brute(pieces, v.unknown, word))


def test_vocabulary_that_crosses_words():
    v = CountOnlyViterbi({"pieces": ["▁a", "▁b", "▁a▁b", "a", "b", "▁"], "scores": [-1.0, -1.0, -1.5, -2.0, -2.0, -3.0], "byte_fallback": True})
    assert v.count("a b") == 1 and v.count("a a b") == 2


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, 9), (1, "a", 9), (1, "a", 9), (None, "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(token_counts(df).collect(), key=str)
    assert sorted((str(r.doc_id), str(r.n_tokens)) for r in got) == [("1", "1"), ("1", "1"), ("1", "None"), ("None", "0")]
    assert token_counts(df.filter("false")).count() == 0
