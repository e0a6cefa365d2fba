import json
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from barflow.llm import packing as P
from barflow.llm.common import documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_word_encoder_equals_the_tokenizer(tokenizer):
    rnd = random.Random(3)
    bits = ["the ", "Thnd", "don't", "'S", " ", "\n", "\t\r", "é", "ß", "ΑΣ", "ﬁ", "１２", "12", "###", "<|endoftext|>", "<|", "\x00", " ",
            "é", "İ", "가", "🙂", "ª²½", "word,word.", "\x1c", "_", "­"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(1500)] + [None, ""]
    for text, raw in zip(texts, P.WordEncoder(PATH).encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_what_the_encoder_holds_does_not_grow_with_a_task(tokenizer):
    encoder = P.WordEncoder(PATH)
    calls, call = [], encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            calls.append(len(texts))
            return call.encode_batch_fast(texts, **kw)

        def encode(self, text, **kw):
            return call.encode(text, **kw)

    encoder.tokenizer = Counted()
    texts = [" ".join(["common", *(f"w{chr(97 + k % 26)}x{k}" for k in range(at, at + 2000))]) for at in range(0, 500_000, 2000)]
    held = 0
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        held = max(held, len(encoder.words), len(encoder.parts))
        if text in texts[::50]:
            assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert held < 400_000  # the bound and the words of one block
    letters = "abcdefghijklmnopqrst"
    assert list(encoder.encode([" ".join(a + b + c + d for a in letters for b in letters for c in letters for d in letters[:5])]))
    assert max(calls) <= 8


def test_plain_words_are_cut_by_the_tokenizers_rule():
    import regex

    with open(PATH, encoding="utf-8") as file:
        rule = json.load(file)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    rnd = random.Random(5)
    latin = [chr(c) for c in (*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100))]
    for chars in (latin, ["'", "'", "'", *"stremvldx1²-_é½"]):
        lines = "".join("".join(rnd.choices(chars, k=rnd.randint(0, 12))) + "\n" for _ in range(5000)).lower()
        assert P._cut(lines).to_pylist() == regex.findall(rule + r"|\n", lines)


def test_arrow_columns_are_encoded_block_by_block(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BYTES", 50)
    monkeypatch.setattr(P, "CACHE_PARTS", 5)
    texts = ["skipped", None, "", "don't stop, DON'T", "a\x0bb\x0cc", "ΑΣ é ÉÀ½", " lead and trail ", "<|endoftext|> x", "日本 語", None, "x " * 90, "日本 語", " "]
    for kind in (pa.string(), pa.large_string()):
        found = list(P.WordEncoder(PATH).encode(pa.array(texts, kind).slice(1)))
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]
    assert list(P.WordEncoder(PATH).encode(pa.array([None, None], pa.string()))) == [b"", b""]


def test_words_met_again_make_no_python_objects(tokenizer):
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400)]
    texts = [" ".join(words[k % 7:]) for k in range(1000)]
    encoder = P.WordEncoder(PATH)
    assert np.frombuffer(list(encoder.encode(texts))[3], "<u4").tolist() == tokenizer.encode(texts[3], add_special_tokens=False).ids
    before = sys.getallocatedblocks()
    found = encoder.encode(texts)
    next(found)
    assert sys.getallocatedblocks() - before < 20_000  # 397,000 words, 1,000 texts


def test_texts_are_read_some_rows_at_a_time(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(P, "ROWS", 3)
    docs = spark.createDataFrame([(k, None if k == 4 else "word other " * k) for k in range(11)], "doc_id long, text string").coalesce(1)
    rows = P.pack_documents(docs, PATH).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 4096)
    assert sorted(r["doc_id"] for r in rows) == list(range(11))


@pytest.mark.parametrize("counts", [{}, {1: 9000}, {4096: 3}, {2048: 5, 2047: 1, 1: 2}, {3000: 4, 1096: 4, 500: 3, 596: 1},
                                    {k: (k * 7919) % 23 for k in range(1, 4097)}])
def test_plan_uses_every_piece_once_and_nearly_no_room_is_lost(counts):
    counts = {k: v for k, v in counts.items() if v}
    bins = P.plan_lengths(counts)
    used = Counter()
    for runs, times in bins:
        assert times > 0 and sum(x * k for x, k in runs) <= 4096
        for x, k in runs:
            used[x] += k * times
    assert used == Counter(counts)
    n, total = sum(t for _, t in bins), sum(x * k for x, k in counts.items())
    assert n >= -(-total // 4096)
    halves = sum(k for x, k in counts.items() if x > 2048)  # no two of these share a sequence
    assert n <= 1.03 * max(halves, -(-total // 4096)) + 1


def test_plan_fills_exactly_by_pairs_triples_and_quads():
    assert sum(t for _, t in P.plan_lengths({4000: 2, 96: 2})) == 2
    assert sum(t for _, t in P.plan_lengths({3000: 1, 1000: 1, 96: 1, 4096: 1})) == 2
    assert sum(t for _, t in P.plan_lengths({2500: 1, 1000: 1, 500: 1, 96: 1})) == 1


def check(rows, texts, tokenizer, capacity):
    ids = {}
    for doc, text in texts:
        ids.setdefault(doc, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    places = defaultdict(list)
    for r in rows:
        own = next(x for x in ids[r["doc_id"]] if zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"])
        assert r["length"] == min(capacity, len(own) - r["start"]) and r["start"] == r["piece"] * capacity
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(len(x) for many in ids.values() for x in many)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_the_table(spark, tokenizer):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = P.pack_documents(docs, PATH).collect()
    n = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 4096)
    assert n <= -(-sum(r["length"] for r in rows) // 4096) + 1


def test_edge_cases(spark, tokenizer):
    texts = [(1, "a b c " * 40), (2, None), (3, ""), (None, "x"), (1, "a b c " * 40), (4, "word " * 9)] + [(k, "same words") for k in range(10, 60)]
    docs = spark.createDataFrame([(k, t, "e", 1) for k, t in texts], "doc_id long, text string, part string, length int").repartition(3)
    check(P.pack_documents(docs, PATH, capacity=16).collect(), texts, tokenizer, 16)
    assert P.pack_documents(docs.limit(0), PATH).count() == 0
