import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm.packing import Packer, WordIds, pack_documents, powers
from tests.llm.fixtures import AWKWARD, invented, table

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def whole(texts):
    t = tokenizers.Tokenizer.from_file(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def check(rows, ids, capacity=4096, segments=256):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            part = np.array(ids[doc][at:at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[doc]), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids[doc])
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= capacity and len(own) <= segments
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_round_trip(spark):
    rng = random.Random(4)
    texts = [*AWKWARD, "It's we'll l'eau <|endoftext|> x", "<|startoftext|>", "İstanbul ſ ŉ K", "é combining", "tab\tvt\x0bfs\x1cnel\x85nbsp\xa0end",
             "½ ² Ⅷ", *(invented(rng, rng.randint(0, 900)) for _ in range(150))]
    rows = pack_documents(table(spark, texts, clash=True).repartition(3), PATH).collect()
    assert check(rows, dict(enumerate(whole(texts)))) == 0


def test_other_limits_hold(spark):
    texts = ["a b c"] * 300 + ["word " * 3000]
    rows = pack_documents(table(spark, texts).repartition(2), PATH, capacity=256, segments=16, loss=100).collect()
    check(rows, dict(enumerate(whole(texts))), 256, 16)
    loss = defaultdict(int)
    for r in rows:
        loss[r["sequence_id"]] += r["loss_tokens"]
    assert max(loss.values()) <= 100


def test_dot_product_prefers_the_scarce_resource():
    packer = Packer(100, 4, 100, 10)
    for key, length in enumerate([60, 40, 30, 10]):
        assert list(packer.add(key, length)) == []
    assert [p[0] for p in next(packer.pack(keep=False))][:2] == [0, 1]


def test_powers():
    got = list(powers([(0, 0, 5), (1, 3, 6)]))
    assert [sum(p[2] for p in s) for s in got] == [8, 2, 1]


def test_empty_table(spark):
    assert pack_documents(table(spark, ["x"]).limit(0), PATH).count() == 0


def test_lookups_of_any_size_give_the_tokenisers_ids():
    rng = random.Random(9)
    parts = ["Word", "word,", "ÉTÉ", "l'été", "don't", "I'LL", "x1y2", "ñandú.", "…", "日本", "é", "a b", "İ", "ﬁ", "<|endoftext|>", "--", "1,000", "\x1c"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(300)] + ["", None, "  a\n\tb  ", *AWKWARD]
    texts += [" ".join(rng.choices(parts[:9], k=8)) for _ in range(200)]
    want = [ids[:-1] for ids in whole(texts)]
    for limit in (1, 7, 10_000):
        words = WordIds(PATH, limit)
        got = []
        for a in range(0, len(texts), 60):
            column = pa.array(texts)[a:a + 60]
            ids, bounds = words.encode(column)
            got += [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == want
        assert len(words.stretches.old) + len(words.stretches.young) <= 2 * limit + 2000
