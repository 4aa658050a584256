from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm.packing import Packer, pack, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, want, capacity=4096):
    docs, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert sorted(docs) == sorted(want)
    for doc, pieces in docs.items():
        pieces.sort(key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert r.start == at and r.length == len(r.ids) // 4 and r.doc_tokens == len(want[doc])
            at += r.length
        assert array("I", b"".join(bytes(r.ids) for r in pieces)).tolist() == want[doc]
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0  # full, or a power of two: no padding


def test_round_trip_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    want = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    check(pack(docs.repartition(3), PATH).collect(), want)


def test_edge_rows(documents, none):
    rows = pack(documents, PATH).collect()
    assert sum(r.length for r in rows if r.doc_id in (2, 3, 6)) == 3  # only the end id
    assert sum(r.length for r in rows if r.doc_id == 5) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 5)
    assert sum(r.length for r in rows if r.doc_id is None) == 3
    assert pack(none, PATH).count() == 0


def test_very_long_text(spark):
    text = "wörter und words, " * 60_000
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(PATH)
    check(pack(docs, PATH).collect(), {1: tokenizer.encode(text, add_special_tokens=False).ids + [2], 2: tokenizer.encode("x", add_special_tokens=False).ids + [2]})


@pytest.mark.parametrize("text", ["don't STOP'LL", "ßé''LL", "<|endoftext|> a<|startoftext|>", "İΣς é ́x", "a\x1cb\x85c d  e", "½²9٣ 東京!?", "ªº×÷"])
def test_chunks_give_the_tokenizers_ids(text):
    words = word_ids(PATH)
    assert array("I", words.of_text(text)).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_level_minimises_the_sum_of_squares():
    packer = Packer(16, 0)
    for k, size in enumerate([5, 9, 3, 7, 5, 11, 2, 6, 6, 4, 15, 1]):
        before = {h: int(packer.count[h]) for h in range(1, 16)}
        best = []
        for h in [0, *[h for h in before if before[h]]]:
            if h + size <= 16:
                after = dict(before)
                if h:
                    after[h] -= 1
                if h + size < 16:
                    after[h + size] = after.get(h + size, 0) + 1
                best.append(sum(n * n for n in after.values()))
        list(packer.place((k, 0, b"\0" * 4 * size, size)))
        assert sum(int(n) ** 2 for n in packer.count) == min(best)
