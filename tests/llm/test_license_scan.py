"""License scan: base phrases by brute force, the method's labels on written notices, and odd texts."""

import re

from plume.llm import license_scan as ls

SF = "/root/testdata/sf0.01"


def words(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text):
    ws = words(text)
    hits = [(i, label) for phrase, label in ls.BASE_PHRASES.items() for p in [phrase.split()]
            for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
    at = [i for i, _ in hits]
    return (len(ws), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, labels string, n_base int")
    return ls.scan(docs).collect()


def test_stored_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = run(spark, rows)
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out}
    assert got == {i: brute(t) for i, t in rows}
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in out)


def test_notices_and_odd_texts(spark):
    notices = [(i, f"x y {notice.upper()}. z") for i, (_, notice, _) in enumerate(ls.TEMPLATES)]
    broken = "permission is hereby granted for a fee to any person obtaining a copy of this software"
    changed = ls.TEMPLATES[1][1].replace("documentation files", "documentation papers")
    odd = [(100, None), (101, ""), (102, "..."), (103, broken), (104, changed), (105, "the MIT license the mit license"),
           (106, "under the MIT license " * 3000), (None, "apache license, version 2.0"), (107, "cc by nc cc by nc"), (107, "cc by"),
           (108, "cc by nc"), (109, "nc"), (110, "license 2 0")]
    out = run(spark, notices + odd + [(200 + i, f"plain words {i} of the and to") for i in range(60)])
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    for i, (label, _, _) in enumerate(ls.TEMPLATES):
        assert label in by[i][0]["labels"].split(",") and by[i][0]["score"] > 0.99, ls.TEMPLATES[i]
    for i, text in [*notices, *odd]:
        assert brute(text) in [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in by[i]]
    assert by[103][0]["labels"] == "" and by[104][0]["labels"] == "mit" and by[105][0]["labels"] == ""
    assert by[106][0]["n_base"] == 3000 and all(r["labels"] == "" for i in range(200, 260) for r in by[i])


def test_empty_table(spark):
    assert run(spark, []) == []


def test_edited_notices_are_found(spark):
    """Words added, left out and replaced outside the mandatory phrases, one to four of them."""
    import random

    rng = random.Random(5)
    rows, want = [], {}
    for n in range(400):
        label, notice, phrases = rng.choice([t for t in ls.TEMPLATES if len(t[1].split()) >= 25])
        ws = notice.split()
        fixed = set()
        for phrase in phrases:
            p = phrase.split()
            start = next(i for i in range(len(ws)) if ws[i:i + len(p)] == p)
            fixed |= set(range(start, start + len(p)))
        edits = dict.fromkeys(rng.sample([i for i in range(len(ws)) if i not in fixed and i - 1 not in fixed], rng.randint(1, 4)))
        out = []
        for i, word in enumerate(ws):
            out += rng.choice(([], [f"x{n}"], [f"y{n}", word])) if i in edits else [word]
        rows.append((n, f"file {n} begins " + " ".join(out) + " and goes on"))
        want[n] = label
    rows += [(1000 + i, f"software is provided with conditions of use {i} and the rights to copy and distribute files of any kind") for i in range(300)]
    got = {r["doc_id"]: r for r in run(spark, rows)}
    assert sum(label in got[n]["labels"].split(",") for n, label in want.items()) >= 0.95 * len(want)
    assert all(0.8 <= got[n]["score"] <= 1 for n in want if got[n]["labels"])
    assert not any(got[1000 + i]["labels"] for i in range(300))


def test_chain_by_brute_force():
    """The chain against all common subsequences."""
    import itertools
    import random

    import numpy as np

    rng = random.Random(2)
    for _ in range(200):
        a, b = [[rng.randrange(4) for _ in range(rng.randint(0, 7))] for _ in range(2)]
        weight = np.array([rng.random() for _ in a])
        t = ls.Template("x", np.array(a, np.uint64), weight / max(weight.sum(), 1e-9), [])
        best = 0.0
        for size in range(len(a) + 1):
            for pick in itertools.combinations(range(len(a)), size):
                it = iter(b)
                if all(a[i] in it for i in pick):
                    best = max(best, t.weights[list(pick)].sum())
        assert abs(ls.chained(t, np.array(b, np.uint64)) - min(best, 1.0)) < 1e-9


def test_whole_licences_and_repeated_ones(spark):
    rows = [(i, f"Copyright. {notice}.") for i, (_, notice, _) in enumerate(ls.TEMPLATES)] + [(100, (ls.MIT + " next file ") * 200)]
    got = {r["doc_id"]: r for r in run(spark, rows)}
    assert all(label in got[i]["labels"].split(",") for i, (label, _, _) in enumerate(ls.TEMPLATES))
    assert got[100]["labels"] == "mit" and got[100]["score"] > 0.99
