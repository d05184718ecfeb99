"""Line dedup against edit distances of all pairs of lines, and odd texts."""

import random
from collections import Counter

from plume.llm import line_dedup as ld
from tests.llm.test_jaccard_join import union

SF = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(spark, rows, near=distance):
    """Texts that stay, in the order of (id, hash)."""
    hashes = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for _, t in rows], "text string").selectExpr(
        "text", "xxhash64(text) AS h").collect()}
    lines = {x for _, t in rows for x in (t or "").split("\n") if len(x) >= ld.MIN_CHARS}
    by = {}
    for x in lines:
        by.setdefault(len(x), []).append(x)
    links = [(x, y) for x in lines for k in range(ld.THRESHOLD + 1) for y in by.get(len(x) + k, ()) if (k or x < y) and near(x, y) <= ld.THRESHOLD]
    of = union(lines, [tuple(sorted(e)) for e in links])
    first = {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]])):
        for k, x in enumerate((t or "").split("\n")):
            if x in of:
                first.setdefault(of[x], (i, t, k))
    out = []
    for i, t in rows:
        out.append((i, None if t is None else "\n".join(
            x for k, x in enumerate(t.split("\n")) if x not in of or first[of[x]] == (i, t, k))))
    return out


def check(spark, rows, near=distance):
    df = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], "doc_id long, text string, hash_ long, `lines_` string, `x.y` string")
    out = ld.dedup(df)
    assert out.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(brute(spark, rows, near))


def test_band():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = rng.choice(("", "a", "c"))
        b = "".join(b)
        x, y = "z" * rng.choice((0, 70)), "w" * rng.choice((0, 70))
        for t in (1, 2, 3):
            assert ld.within(x + a + y, x + b + y, t) == (distance(a, b) <= t)


def test_edited_lines(spark):
    rng = random.Random(8)
    rows = []
    for k in range(36):
        size = rng.choice((24, 25, 26, 27, 40, 60))
        base = "".join(rng.choice("abcdé漢😀 ") for _ in range(size))
        lines = [base, "short", ""]
        for n in (1, 2, 2, 3, 4):
            x = list(base)
            for _ in range(n):
                at = rng.randint(0, len(x))
                x[at:at + rng.randint(0, 1)] = rng.choice(("", "x", "q"))
            lines.append("".join(x).replace("\n", ""))
        rng.shuffle(lines)
        rows.append((k, "\n".join(lines)))
        rows.append((k + 100, rng.choice(lines)))
    check(spark, rows)


def near(a, b):
    """For lines too long to fill a whole table of distances; test_band holds it against them."""
    return 0 if ld.within(a, b) else 99


def test_stored_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, near)


def test_odd_texts(spark):
    long_ = "a line that is long enough to count"
    check(spark, [(1, None), (2, ""), (3, "\n\n"), (4, long_), (5, long_ + "\r"), (6, f"{long_}\n{long_}\n\n{long_}"), (None, long_.upper()),
                  (7, long_.upper()), (8, "x" * 70000), (9, "x" * 70001 + "\n"), (9, "x" * 70001 + "\n"), (9, "other text of this id, long enough"),
                  (10, long_.replace("line", "lime") + "\n" + long_.replace("long", "song")), (11, "x" * 23), (12, "x" * 23)], near)


def test_hot_line_and_chain(spark):
    rows = [(k, "the one line that stands everywhere\n" + f"line number {k:05d} of this text") for k in range(300)]
    check(spark, rows, near)


def test_empty_table(spark):
    check(spark, [])


def test_short_lines_take_part(spark):
    rows = [(1, "Les.\n\n \r\nab\nb\n\u6f22\nAll rights reserved."), (2, "Les.\n\n \r\nac\nb\n\u6f22"),
            (3, "All right reserved\n12345\nab"), (4, "Les.\n \r\n\nquite other"), (5, "xyz"), (6, "xyz\nxyz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in ld.dedup(df).collect()} == {
        1: rows[0][1], 2: "\n \r\nac", 3: "12345", 4: " \r\n\nquite other", 5: "xyz", 6: ""}


def test_unrelated_short_lines_stay(spark):
    rows = [(100, "100\nif a:\nend\nYes"), (250, "250\nif b:\nand\nNo."), (317, "Yet\n}"), (400, "Les nuits"), (401, "Les nuit."), (402, "Les fruits"),
            (403, "end\n}\nif a:"), (404, "Chapter 12 of 300"), (405, "Chapter 13 of 300"), (406, "Chapter 13 of 30")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(rows) | {401: "", 403: "", 405: "", 406: ""}
    assert {r["doc_id"]: r["text"] for r in ld.dedup(df).collect()} == want


def test_lines_of_all_lengths(spark):
    """Lines of 3 to 40 code points, half of them edited once or twice: the threshold follows the shorter one."""
    rng = random.Random(4)
    rows = []
    for k in range(400):
        base = "".join(rng.choice("abcdefgé") for _ in range(rng.randint(3, 40)))
        other = list(base)
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(other))
            other[at:at + 1] = rng.choice(("", "x", other[at] + "y"))
        rows.append((k, "\n".join(rng.sample([base, "".join(other), f"{k} stands alone here"], 3))))
    check(spark, rows, near)


def test_precision_on_the_test_documents(spark):
    """Every line that goes has a line of its class that is a near copy by its own length's threshold; of the distinct
    lines below 16 code points, one in ten at most has a near copy that is not equal."""
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    lines = sorted({x for t in texts for x in t.split("\n") if ld.MIN_CHARS <= len(x) < 16 and x.strip()})
    close = sum(any(a != b and ld.within(a, b) for b in lines) for a in lines)
    assert len(lines) > 100 and close <= 0.1 * len(lines)
    assert not any(a != b and ld.within(a, b) for a in lines if len(a) < 8 for b in lines)
