import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ringfence.llm import tokenfile

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b   c", "x\n y", "x\n  y\n\n z ", "don't WON'T it's", "a   b\x1c!\x1c!", "\t\ta\r\nb", "<|endoftext|> <|endoftext|>", "x <|endoftext|> y<|endoftext|>z",
       "1234 56,7 $%& #", "日本語 テスト", "é́ é", "a\x85b ​ c", "!\x1f!\x0b !", "\U0001f600 \U0001f600\U0001f600"]


def test_pieces_encode_like_whole_texts():
    tok = Tokenizer.from_file(PATH)
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choices(" \n\t ab'sÉ1.#\x1c　", k=40)) for _ in range(300)]
    got = tokenfile.Encoder(PATH, "<u2")(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_files_against_brute_force(spark, monkeypatch):
    tok = Tokenizer.from_file(PATH)
    rnd = random.Random(1)
    rows = [(i, t, 0) for i, t in enumerate(ODD)] + [(100 + i, " ".join(rnd.choices(["thing", "Über", "x1", "..."], k=rnd.randrange(300))), 1) for i in range(200)]
    rows += [(5000, "long text " * 20000, 1), (None, "no id", 2), (6000, None, 1), (6001, "", 1)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5)
    parts = tokenfile.write(df, PATH, 2, length=16)
    got = sorted((tuple(r) for r in tokenfile.read(spark, parts, tokenfile.crc32, "ids_crc32 long").collect()), key=lambda r: r[1])
    start, stream = 0, []
    for (doc, text, _), row in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0])), got, strict=True):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        assert row == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        stream += ids
    seen = []
    for part, _, first, tokens in parts:
        seq = tokenfile.Sequences(part)
        assert first == len(seen)
        for i in range(-(-tokens // 16)):
            ids, mask = seq[i]
            assert len(ids) == len(mask) == 16
            seen += ids[mask].tolist()
    assert seen == stream
    view, _ = tokenfile.Sequences(parts[0][0])[0]
    assert not view.flags.owndata


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other")], "doc_id long, text string")
    parts = tokenfile.write(df, PATH, 2)
    out = tokenfile.read(spark, parts, len, "n long").collect()
    assert [r["doc_id"] for r in out] == [1, 1, 1] and sum(r["n_tokens"] for r in out) == parts[-1][2] + parts[-1][3]
    assert tokenfile.read(spark, tokenfile.write(df.limit(0), PATH, 2), len, "n long").count() == 0


@pytest.mark.parametrize("cap", [3, 1000])
def test_bounded_table_of_pieces(monkeypatch, cap):
    monkeypatch.setattr(tokenfile, "PIECES", cap)
    code = tokenfile.Encoder(PATH, "<u2")
    a, b = code(["one two three four", "five two"]), code(["six two", "one two three four"])
    assert a[0] == b[1]
