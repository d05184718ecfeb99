"""Related-document classes (K7) against all pairs of word sets."""

import itertools
import random
import re

import pytest

from plume.operators import related as R
from plume.plans import catalog

from .conftest import SF_MID


def words(text):
    return frozenset(w for w in re.split(r"[^\w]+", (text or "").lower()) if w)


def brute(rows):
    """(classes by all pairs, all related pairs)"""
    sets = {i: words(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = []
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 5 * len(x & y) >= 3 * len(x | y):
            pairs.append((a, b))
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in sets}, pairs


def classes(df):
    return {r["doc_id"]: r["class_id"] for r in df.collect()}


def test_recall_and_precision_on_the_test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in catalog.docs(spark, SF_MID).select("doc_id", "text").collect()]
    want, pairs = brute(rows)
    got = classes(catalog.queries()["related_classes"](spark, SF_MID))
    found = sum(got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 60 and found >= 0.95 * len(pairs)
    # Nothing is joined that all pairs would not join.
    assert all(want[i] == want[c] for i, c in got.items())
    assert all(c <= i for i, c in got.items())


def drawn(rng, n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def test_recall_at_the_ratio(spark):
    """Pairs whose ratio lies between 0.6 and 0.8."""
    rng = random.Random(3)
    rows = []
    for k in range(300):
        base = drawn(rng, 60)
        cut = rng.randint(8, 15)  # of 60 words
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[cut:] + drawn(rng, cut)))]
    want, pairs = brute(rows)
    assert len(pairs) > 250
    got = classes(R.related_classes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
    assert all(want[i] == want[c] for i, c in got.items())


def test_chains_are_one_class(spark):
    rng = random.Random(1)
    text = drawn(rng, 100)
    rows = []
    for k in range(60):  # each one keeps nine tenths of the one before; the ends share nothing
        rows.append((100 - k, " ".join(text)))
        text = text[10:] + drawn(rng, 10)
    assert not words(rows[0][1]) & words(rows[-1][1])
    assert classes(R.related_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == {i: 41 for i, _ in rows}


def test_hot_bucket_of_copies_near_copies_and_strangers(spark):
    """A third exact copies, a third near copies, and texts that share some band without being related."""
    rng = random.Random(2)
    base = drawn(rng, 80)
    rows = [(i, " ".join(base)) for i in range(1000)]
    rows += [(1000 + i, " ".join(base[:78] + drawn(rng, 2))) for i in range(1000)]
    rows += [(2000 + i, " ".join(base[:6] + drawn(rng, 12))) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = R.related_classes(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: 0 if i < 2000 else i for i, _ in rows}
    assert all(r["class_size"] == (2000 if r["doc_id"] < 2000 else 1) for r in got)
    signed = R.signatures(df).withColumnRenamed("doc_id", "node").dropDuplicates(["set"])
    assert R.band_postings(signed).groupBy("key").count().where("count > 500").count() > 0


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (3, "?! ."), (None, "a b c d"), (4, "A b, c D"), (4, "A b, c D"), (5, "d c b a")]])
def test_empty_texts_nulls_and_repeated_rows(spark, rows):
    out = R.related_classes(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, words int")).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in out), key=str) == sorted(
        ((i, 4 if i in (4, 5) else i) for i, _ in rows), key=str)


def test_stored_tables_are_dropped(spark, tmp_path):
    from plume.session import Workspace

    space = Workspace(spark, "test")
    first = space.put(spark.range(10))
    second = space.put(first.where("id > 3"), first)
    assert second.count() == 6
    with pytest.raises(Exception):
        first.count()


def test_signatures_are_folded_where_texts_are_read(spark):
    """No shuffle, no column for each value; sketch and bands follow from the least crc32 values of the words."""
    import zlib

    rng = random.Random(4)
    rows = [(i, " ".join(drawn(rng, rng.randint(1, 40)) * rng.randint(1, 2))) for i in range(60)] + [(60, None), (61, "?"), (None, "a b")]
    rows += [(70, rows[0][1].upper()), (71, " ".join(rows[1][1].split() + ["more"]))]
    signed = R.signatures(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert signed.columns == ["doc_id", "n", "set", "bands", "sketch"]
    assert "Exchange" not in signed._jdf.queryExecution().executedPlan().toString()
    got, want = {r["doc_id"]: r for r in signed.collect()}, {}
    for i, t in rows:
        if i is not None and words(t):
            x = [zlib.crc32(w.encode()) for w in words(t)]
            want[i] = [min((a * c + b) % R.PRIME for c in x) for a, b in R.multipliers()]
    assert got.keys() == want.keys() and all(got[i]["n"] == len(words(dict(rows)[i])) for i in want)
    assert all(bytes(got[i]["sketch"]) == bytes(m & 255 for m in want[i]) for i in want)
    band = lambda m, b: (b, *m[b * R.ROWS:(b + 1) * R.ROWS])
    pairs = {(band(want[i], b), got[i]["bands"][b]) for i in want for b in range(R.BANDS)}
    assert len(pairs) == len({p for p, _ in pairs}) == len({k for _, k in pairs})
    assert got[0]["set"] == got[70]["set"] != got[1]["set"] != got[71]["set"]
