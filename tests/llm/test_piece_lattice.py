"""SentencePiece lattice: N-best against all segmentations, whole texts against a plain search, round trips."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa

from plume.llm import piece_lattice as pl

PATH = public_tokenizers.path("piece_bpe_32k.model")
M = pl.MARK


def every(own, chunk):
    """All segmentations of a chunk, best first."""
    out = []

    def go(i, score, path):
        if i == len(chunk):
            out.append((score, path))
            return
        for j in range(i + 1, min(len(chunk), i + own.trie.longest) + 1):
            p = own.pieces.get(chunk[i:j])
            if p is not None:
                go(j, score + own.score[p], [*path, p])
        if chunk[i] not in own.pieces:
            go(i + 1, score + own.score[own.off], [*path, own.off])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_chunks_against_all_segmentations():
    own, rng = pl.lattice(PATH), random.Random(3)
    chunks = [f"{M}then", M, M * 5 + "a", f"{M}x\ny", "漢字", f"{M}Öung.", f"{M}a\U0001F600b", "\n", f"{M}{M}"]
    chunks += [M + "".join(rng.choice("thenraio.\né") for _ in range(rng.randint(1, 9))) for _ in range(150)]
    chunks = list(dict.fromkeys(chunks))
    best, loss, path, count = own._viterbi(chunks)
    for k, (chunk, found) in enumerate(zip(chunks, np.split(path, np.cumsum(count)[:-1]), strict=True)):
        want = every(own, chunk)
        got = own.n_best(chunk, 6)
        assert [s for s, _ in got] == [s for s, _ in want[:6]]
        assert all((s, p) in want for s, p in got) and len({tuple(p) for _, p in got}) == len(got)
        assert best[k] == want[0][0] and (best[k], found.tolist()) in want
        assert loss[k] == (want[0][0] - want[1][0] if len(want) > 1 else np.inf)


def test_text_n_best_against_products_of_chunks():
    own, rng = pl.Lattice(PATH), random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice("thea  .\n") for _ in range(rng.randint(1, 10)))
        n, score, ids, same, ways = next(pl.encode_slice(own, pa.array([text]), 4))
        whole = every(own, M + text.replace(" ", M))
        assert same and n == len(ids) and score == whole[0][0]
        assert [s for s, _ in ways] == [s for s, _ in whole[:4]]
        assert len({x.tobytes() for _, x in ways}) == len(ways)
        for s, x in ways:
            assert own.decode(x) == b" " + text.encode()


def rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash", 2) for i, t in texts], "doc_id long, text string, ids string, score int")
    return pl.encode(docs, PATH, with_ids=True)


def test_documents_and_odd_texts(spark):
    texts = [(1, None), (2, ""), (3, " "), (4, "a  b"), (5, " lead and trail "), (6, "\n\n"), (7, f"own {M} mark"), (None, "x"),
             (8, "no" * 9000), (9, "word " * 50000), (10, "a\u0000b　 é漢😀"), (10, "the end"), (10, "the end")]
    out = rows(spark, texts)
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r)
        assert r["n_pieces"] == len(r["ids"]) == r["segmentations"][0]["n_pieces"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["segmentations"][0]["ids_crc32"]
        scores = [s["score"] for s in r["segmentations"]]
        assert scores == sorted(scores, reverse=True) and scores[0] == r["score"] and len(scores) <= pl.N_BEST
    assert got[1][0]["ids"] == got[2][0]["ids"] == [] and len(got[10]) == 3
    assert all(r["round_trip"] for i, own in got.items() for r in own if i != 7) and not got[7][0]["round_trip"]
    back = {(r["doc_id"], r["text"]) for r in pl.decode(out, PATH).collect()}
    assert back == {(i, (t or "").replace(M, " ")) for i, t in texts}


def test_library_decodes_the_best_segmentation(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    by = dict(texts)
    for r in rows(spark, texts).collect():
        assert r["round_trip"] and model.decode(r["ids"]) == by[r["doc_id"]]


def test_memory_may_be_cleared(spark, monkeypatch):
    own = pl.Lattice(PATH)
    column = pa.array([f"word{i} and other{i} things" for i in range(50)])
    first = [(n, s, x.tolist()) for n, s, x, _, _ in pl.encode_slice(own, column, 4)]
    monkeypatch.setattr(pl, "MEMO", 0)
    assert [(n, s, x.tolist()) for n, s, x, _, _ in pl.encode_slice(own, column, 4)] == first
    assert list(itertools.islice(pl.encode_slice(own, column, 1), 1))[0][4][0][0] == first[0][1]


def test_empty_table(spark):
    assert rows(spark, []).collect() == []


def test_lattice_and_merges_are_two_segmentations(spark):
    """The model is a BPE one: the library merges greedily, the lattice takes the best sum of scores. Both decode to the text."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] for r in rows if r["text"]}
    out = {r["doc_id"]: r["ids"] for r in pl.encode(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), PATH, with_ids=True).collect()}
    merged = {i: library.encode(t) for i, t in texts.items()}
    own, other = (sum(map(len, x.values())) for x in (out, merged))
    assert 1.0 < own / other < 1.3 and sum(out[i] != merged[i] for i in texts) > 0.9 * len(texts)
    score = library.GetScore if hasattr(library, "GetScore") else library.get_score
    assert all(sum(map(score, out[i])) >= sum(map(score, merged[i])) - 1e-3 for i in texts)
