"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np

SF = "/root/testdata/sf0.001"


def brute(ws, least=24, times=3):
    """(start, length, period) of all maximal runs, tried period by period."""
    n, out = len(ws), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            w = ws[i : j + q]
            if len(w) >= max(least, times * q) and all(w[r:] != w[:-r] for r in range(1, q)):
                out.append((i, len(w), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_text(rng):
    kinds, n = rng.choice([1, 2, 3, 50]), rng.choice([0, 1, 5, 30, 60, 150])
    t = [rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randrange(3, 9)
        t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
    return t


def test_runs_of_random_texts(monkeypatch):
    from vidsift.llm import periodic

    rng, seen = random.Random(5), 0
    for trial in range(150):
        monkeypatch.setattr(periodic, "BITS", 4 if trial % 2 else 21)  # both ways of sorting
        least, times = rng.choice([24, 6, 4]), rng.choice([3, 2])
        texts = [random_text(rng) for _ in range(rng.randrange(1, 7))]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = periodic.runs(np.array(sum(texts, []), np.int64), first, least, times)
        want = [(d, *r) for d, t in enumerate(texts) for r in brute(t, least, times)]
        assert list(zip(*[x.tolist() for x in got], strict=True)) == want
        seen += len(want)
    assert seen > 400


def test_long_and_nested_runs():
    from vidsift.llm import periodic

    base = list(range(5000))
    codes = np.array(base * 3 + [7] * 30 + [1, 2] * 20, np.int64)
    got = list(zip(*[x.tolist() for x in periodic.runs(codes, np.array([0, len(codes)]))], strict=True))
    assert got == [(0, 0, 15000, 5000), (0, 15000, 30, 1), (0, 15030, 40, 2)]


def row(doc_id, text):
    """What op12 asks for of one document, from its definition."""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(ws)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    found = brute(ws)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(ws) if i not in drop)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(kept))


def test_query_equals_brute_force(spark):
    from vidsift.llm import queries
    from vidsift.session import table

    got = queries.op12_periodic_runs(spark, SF).collect()
    want = [row(r.doc_id, r.text if len(r.text or "") < 12_000 else None) for r in table(spark, SF, "documents").collect()]
    long = {r.doc_id for r in table(spark, SF, "documents").collect() if len(r.text or "") >= 12_000}
    pick = lambda rows: sorted(tuple(r) for r in rows if r[0] not in long)
    assert len(got) == len(want) and pick(got) == pick(want)
    assert sum(r[1] > 0 for r in want) > 5


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and one-word texts, repeated rows, other columns of clashing names, an empty table."""
    from vidsift.llm import periodic, queries

    chosen = [d for d in range(400) if zlib.crc32(str(d).encode()) % 10 == 0][:8]
    texts = [None, "", " \t\n", "one", "a b", "x " * 100, "é ß " * 40 + "end", "a\x0bb\x0cc d " * 30]
    rows = [(d, t) for d, t in zip(chosen, texts, strict=True)] + [(None, "w " * 40), (None, None)] + [(1, "p q r s " * 9)] * 2
    df = spark.createDataFrame([(*r, i, "en", r[0], 1) for i, r in enumerate(rows)], "doc_id long, text string, n long, words string, a long, runs int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(row(*r)) for r in rows)
    assert periodic.find_runs(df.limit(0)).count() == 0
    assert periodic.find_runs(df).where("doc_id = 1").first().collapsed == "p q r s"
