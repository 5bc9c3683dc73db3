"""Runs of repeating words against a search over all periods."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cartpulse.llm import periodic_runs
from cartpulse.llm.queries import QUERIES


def by_hand(words, least=24, times=3):
    """Every stretch that keeps a period and cannot be extended, smallest period each."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(least, times * q):
                found.setdefault((at, length), q)
            at = end
    return sorted((s, q, n) for (s, n), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digests(doc_id, text):
    words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = by_hand(words)
    dropped = {i for s, q, n in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return ((doc_id, len(runs))
            + ((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4)
            + (sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)),
               sha(" ".join(w for i, w in enumerate(words) if i not in dropped))))


def numbered(texts):
    return periodic_runs._numbered([[str(w).encode() for w in t] for t in texts])


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words_against_all_periods(seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(60):
        words = []
        while len(words) < 150:
            part = rng.integers(0, 1 + rng.integers(1, 4), rng.integers(1, 12)).tolist()
            words += part * int(rng.integers(1, 9)) + rng.integers(0, 5, 2).tolist()
        texts.append(words)
    texts += [[], [1] * 200, [1, 1, 2] * 40 + [1] * 30, [7], [1, 2] * 12]
    for least, times in ((24, 3), (8, 2), (5, 4)):
        starts = np.cumsum([0] + [len(t) for t in texts])
        found = periodic_runs.runs(numbered(texts), np.unique(starts[:-1]), least, times)
        wanted = [[s + int(starts[i]), n, q] for i, t in enumerate(texts)
                  for s, q, n in by_hand(t, least, times)]
        assert found.tolist() == wanted and wanted


def test_fibonacci_words_and_a_long_repetition():
    a, b = [1], [1, 2]
    while len(b) < 1500:
        a, b = b, b + a
    both = [b, [3, 4, 5] * 5000]
    found = periodic_runs.runs(numbered(both), np.array([0, len(b)]))
    wanted = by_hand(b)
    assert found.tolist()[:-1] == [[s, n, q] for s, q, n in wanted] and len(wanted) > 10
    assert found.tolist()[-1] == [len(b), 15000, 3]


def test_query_equals_all_periods(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    wanted = sorted(digests(r.doc_id, r.text) for r in rows if len(r.text or "") < 4000)
    ids = {w[0] for w in wanted}
    found = sorted(tuple(r) for r in
                   QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").collect()
                   if r.doc_id in ids)
    assert found == wanted and any(w[1] for w in wanted)


def test_edge_rows(spark):
    song = "la la  la\tda " * 20
    texts = [(1, None), (2, ""), (3, " \n"), (4, song), (4, song), (None, song), (90, "x " * 30),
             (5, "  \x1c " * 30), (6, " ".join(f"w{i % 3000}" for i in range(12_000)))]
    rows = spark.createDataFrame([(i, t, "a", 0) for i, t in texts],
                                 "doc_id long, text string, key string, runs int")
    found = periodic_runs.run_digests(rows).collect()
    assert sorted(tuple(r) for r in found if r.doc_id is not None) == sorted(
        digests(i, t) for i, t in texts if i is not None)
    assert [r.n_runs for r in found if r.doc_id is None] == [digests(4, song)[1]]
    assert periodic_runs.run_digests(rows.limit(0)).count() == 0
    kept = {r.doc_id: r for r in periodic_runs.periodic_runs(rows).collect()}
    assert kept[4].collapsed == "la la la da" and kept[4].runs[0].asDict() == {
        "start": 0, "length": 80, "period": 4}
    assert kept[6].n_words == 12_000 and len(kept[6].runs) == 1
