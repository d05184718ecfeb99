"""Decontamination against all windows of all documents, by brute force."""

import random
import re
from collections import Counter

import numpy as np

from plume.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"


def words(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def grams(ws):
    return Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else Counter([tuple(ws)] if ws else [])


def similar(a, b):
    shared = sum((a & b).values())
    return shared, sum((a | b).values())


def brute(docs, items):
    """Pairs with a window (any place, the item's size, cut at the text's ends) of similarity 0.8 or more."""
    out = set()
    known = [(i, len(words(item)), grams(words(item))) for i, item in items]
    for d, text in docs:
        ws = words(text)
        whole = grams(ws)
        for i, n, own in known:
            if not own.keys() & whole.keys():
                continue
            for b in range(1 - n, len(ws)):
                s, t = similar(grams(ws[max(b, 0):b + n]), own)
                if s and 10 * s >= 8 * t and (len(ws) < 5 or b + n - max(b, 0) >= 5):
                    out.add((d, i))
                    break
    return out


def pairs(spark, docs, items):
    d = spark.createDataFrame([(*x, 1, "clash") for x in docs], "doc_id long, text string, item_id int, similarity string")
    b = spark.createDataFrame([(*x, 3) for x in items], "item_id long, text string, doc_id int")
    rows = dc.find(d, b).collect()
    found = [(r["doc_id"], r["item_id"]) for r in rows]
    kept = dc.drop_contaminated(d, b)
    assert kept.columns == d.columns
    left = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    bad = {i for i, _ in found}
    assert left == Counter(x for x in docs if x[0] not in bad)
    return found


def test_stored_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = pairs(spark, docs, items)
    assert len(found) == len(set(found)) and set(found) == brute(docs, items)


def test_edits_and_odd_texts(spark):
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [(i, " ".join(fresh(20 + i))) for i in range(40)] + [(90, "one two"), (91, None), (92, ""), (93, "..."), (94, "a b c d e")]
    docs = [(1, None), (2, ""), (3, "One, two!"), (4, "one two three"), (5, "a b c d e"), (6, "x a B c. d e y"), (None, items[3][1])]
    for n in range(150):
        ws = items[n % 40][1].split()
        for _ in range(n % 4):
            k = rng.randrange(len(ws))
            ws[k:k + 1] = rng.choice(([], fresh(1), [ws[k], *fresh(1)], [ws[k].upper() + ","]))
        docs.append((100 + n, " ".join(fresh(n) + ws + fresh(n % 7))))
    docs += [docs[30], (8, " ".join(x[1] for x in items[:40])), (9, (items[7][1] + " ") * 3000)]
    found = pairs(spark, docs, items)
    want = brute([d for d in docs if d[0] != 9], items)
    got = {p for p in found if p[0] != 9}
    # No pair is missed, and a window cut elsewhere by an edit adds none.
    assert got == want and (9, 7) in found
    assert {(3, 90), (5, 94), (6, 94), (None, 3)} <= got and not {d for d, _ in got} & {1, 2, 4}


def test_radius_is_guaranteed():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    items = __import__("pyarrow").table({"item_id": list(range(300)), "text": [f"a{i} b c d e{i} f{i}" for i in range(300)]})
    index = dc.build_index(items)
    index = dc.Index(**(index.__dict__ | {"prints": prints, "blocks": [
        (s, m, np.sort((prints >> np.uint64(s)) & np.uint64(m)), np.argsort((prints >> np.uint64(s)) & np.uint64(m), kind="stable"))
        for s, m, _, _ in index.blocks]}))
    probe = prints[:100].copy()
    for row in range(100):
        for bit in rng.choice(64, rng.integers(0, dc.RADIUS + 3), replace=False):
            probe[row] ^= np.uint64(1) << np.uint64(bit)
    got = set(zip(*map(np.ndarray.tolist, index.near(probe)), strict=True))
    want = {(a, b) for a in range(100) for b in range(300) if int(probe[a] ^ prints[b]).bit_count() <= dc.RADIUS}
    assert got == want


def test_lots_and_empty_tables(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    whole = sorted(pairs(spark, docs, items))
    monkeypatch.setattr(dc, "ITEMS", 15)
    assert sorted(pairs(spark, docs, items)) == whole
    assert pairs(spark, [], items) == [] and pairs(spark, docs[:5], []) == []


def test_every_pair_at_the_threshold(spark):
    rng = random.Random(7)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [(i, " ".join(fresh(40))) for i in range(40)]
    docs = []
    for n in range(1500):  # four of 36 shingles changed: 32 / 40
        ws = items[n % 40][1].split()
        ws[36:37] = fresh(1)
        docs.append((n, " ".join(fresh(n % 5) + ws + fresh(n % 3))))
    want = {(n, n % 40) for n in range(1500)}
    # Two words go or come at some place; brute force says which of them still match.
    edited = []
    for n in range(120):
        ws = items[n % 40][1].split()
        for _ in range(2):
            k = rng.randrange(len(ws))
            ws[k:k + 1] = rng.choice(([], [ws[k], *fresh(2)]))
        edited.append((2000 + n, " ".join(fresh(n % 4) + ws + fresh(n % 3))))
    got = pairs(spark, docs + edited, items)
    assert len(got) == len(set(got)) and set(got) == want | brute(edited, items)


def edited_passages(seed=9):
    """Items, and documents that hold them with one to three words changed."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [(i, " ".join(fresh(rng.randint(30, 120)))) for i in range(60)]
    docs = []
    for n in range(900):
        ws = items[n % 60][1].split()
        for _ in range(1 + n % 3):
            k = rng.randrange(len(ws))
            ws[k:k + 1] = rng.choice(([], fresh(1), [ws[k], *fresh(1)]))
        docs.append((n, " ".join(fresh(n % 9) + ws + fresh(n % 4))))
    return items, docs


def found_rows(docs, items):
    import pyarrow as pa

    index = dc.build_index(pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}))
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]})
    return dc.matches(batch, index)


def test_the_index_finds_nearly_all(monkeypatch):
    items, docs = edited_passages()
    want = brute(docs, items)
    rows = found_rows(docs, items)
    assert {(t, i) for t, i, *_ in rows} == want and len(want) > 400
    by_index = sum(r[-1] for r in rows)
    assert by_index >= 0.95 * len(rows)  # the rest lies beyond the radius
    low = [r for r in rows if r[2] < 0.86]
    assert len(low) > 100 and sum(r[-1] for r in low) >= 0.9 * len(low)
    # Without the index the other path finds the same pairs, and the rows say so.
    monkeypatch.setattr(dc.Index, "near", lambda self, prints: (np.zeros(0, int), np.zeros(0, int)))
    off = found_rows(docs, items)
    assert [r[:5] for r in off] == [r[:5] for r in rows] and not any(r[-1] for r in off)


def test_pairs_left_by_the_index_are_verified_once():
    rows = np.array([[1, 2, 3], [1, 2, 4], [5, 6, 7]])
    assert dc.without(rows, rows[:0]).tolist() == rows.tolist()
    assert dc.without(rows, rows[1:2]).tolist() == [[1, 2, 3], [5, 6, 7]]
    assert dc.without(rows, np.array([[0, 0, 0], [5, 6, 7]])).tolist() == [[1, 2, 3], [1, 2, 4]]
    assert dc.without(rows[:0], rows).tolist() == []
