"""Token output: the word memory against the tokenizer, the coder's round trip, and the archive's rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from plume.llm import rans, token_output as t

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", "a", " a", "a ", "a  b", "a b", "a\tb c", "don't 's x", "x\x0b y", "a b c", "a\n\nb c\nd, e. f.,. g",
       "1, 2.5, café, é. 漢字 漢字.", "<|endoftext|> a <|endoftext|>", "Ġ aĠ b", "\n\na b", "a b\n", "'s 't.", " ", "\n", "word. word, word.,"]


def ids_of(text):
    return t.encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_memory_equals_the_tokenizer():
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(" ab.,'\n\té1Ġ ") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for part in (texts, texts[:1], ["a b"], [""]):
        ids, counts = t.encoder(PATH).encode(pa.array(part, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [ids_of(x) for x in part]


@pytest.mark.parametrize("ids", [
    [np.arange(50257)], [np.zeros(rans.BLOCK, int)], [np.array([3])],
    [np.random.default_rng(1).zipf(1.2, rans.BLOCK) % 50257, np.full(130, 7), np.arange(rans.SECTION + 1), np.arange(rans.SECTION)]])
def test_coder_round_trip(ids):
    table = rans.Table.of(rans.quantise(np.bincount(np.concatenate(ids), minlength=50257)))
    coded = rans.encode(ids, table)
    rows = [(p, s, len(x), c) for (p, s, c), x in zip(coded, ids, strict=True)]
    for got, want in zip(rans.decode(rows, table), ids, strict=True):
        assert (got == want).all()
    p, s, n, c = rows[0]
    with pytest.raises(ValueError, match="checksum"):
        rans.decode([(p, s, n, c ^ 1)], table)


def test_sections_decode_by_themselves():
    ids = np.random.default_rng(2).integers(0, 900, rans.BLOCK)
    table = rans.Table.of(rans.quantise(np.bincount(ids)))
    (payload, sections, _), = rans.encode([ids], table)
    size = 8 * (1 + rans.LANES)
    for k in (1, 3):
        part = ids[k * rans.SECTION:(k + 1) * rans.SECTION]
        got, = rans.decode([(payload, sections[k * size:(k + 1) * size], len(part), rans.checksum(part))], table)
        assert (got == part).all()


def test_crc32_of_joined_strings():
    a, b = b"hello wor" * 99, b"ld" * 1000
    for x, y in ((a, b), (b"", b), (a, b""), (b"", b"")):
        assert rans.crc32_combine(zlib.crc32(x), zlib.crc32(y), len(y)) == zlib.crc32(x + y)


def check(spark, rows):
    docs = spark.createDataFrame([(i, x, 0, "n") for i, x in rows], "doc_id long, text string, segment int, n string")
    path = t.write_archive(docs, PATH)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in t.read_archive(spark, path).collect())
    at, want = 0, []
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*ids_of(x), 0]
        want.append((at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_archive_of_odd_documents(spark):
    rows = [(100 - k, x) for k, x in enumerate(ODD)] + [(200, "long words here " * 60000), (7, "x"), (7, "x"), (7, "y"), (None, "z")]
    check(spark, rows)


def test_archive_of_stored_documents(spark):
    check(spark, [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()])


def test_empty_table(spark):
    check(spark, [])


def test_added_tokens_as_a_fresh_tokenizer_gives_them(spark):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y\n<|endoftext|> <|endoftext|>", "a b", "<|endoftext| > a"]
    want = [fresh.encode(x, add_special_tokens=False).ids for x in texts]
    assert want[0] == [64, 220, 50256, 275]
    ids, counts = t.encoder(PATH).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(t.read_archive(spark, t.write_archive(docs, PATH)).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_tokens"], r["ids_crc32"]) for r in rows] == [
        (len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for x in want]
