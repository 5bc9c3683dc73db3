"""Passages of items in documents against a search for every window."""

import hashlib
import re

import numpy as np
import pytest

from cartpulse.llm import decontaminate
from cartpulse.llm.queries import ORACLES, QUERIES
from oracle_check import connect, differences

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORD.findall(text)


def by_hand(doc_id, text, items, window=10):
    its, hit, ids = words(text), set(), set()
    for item, passage in items:
        held = words(passage)
        m = min(len(held), window)
        grams = {tuple(held[i:i + m]) for i in range(len(held) - m + 1)} if held else ()
        for i in range(len(its) - m + 1 if held else 0):
            if tuple(its[i:i + m]) in grams:
                hit |= set(range(i, i + m))
                ids.add(item)
    ids = sorted(str(i) for i in ids if i is not None)
    return (doc_id, len(its), len(hit), len(ids),
            hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))


def frames(spark, texts, items):
    return (spark.createDataFrame([(i, t, 7, "z") for i, t in texts],
                                  "doc_id long, text string, spans int, words string"),
            spark.createDataFrame([(i, t, 1) for i, t in items],
                                  "item_id long, text string, key int"))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    query = QUERIES["op13_decontamination"](spark, sf_dir)
    assert differences(query, connect(sf_dir), ORACLES["op13_decontamination"]) == []
    assert query.where("contaminated").count() > 0


@pytest.mark.parametrize("seed,letters", [(1, 2), (2, 3), (3, 30)])
def test_automaton_against_every_window(seed, letters):
    rng = np.random.default_rng(seed)
    draw = lambda n: " ".join(f"w{i}" for i in rng.integers(0, letters, n))
    items = [(i, draw(int(rng.integers(0, 40)))) for i in range(12)] + [(3, draw(15)), (4, "w1")]
    for window in (4, 10):
        automaton = decontaminate.Automaton(
            [(i, decontaminate.normalised(t)) for i, t in items], window)
        for n in range(60):
            text = draw(n) + " other " + items[n % 12][1] + " " + draw(5)
            spans, found, _ = automaton.matches(decontaminate.normalised(text))
            wanted = by_hand(0, text, items, window)
            assert sum(b - a for a, b in spans) == wanted[2]
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
            assert len(found) == wanted[3]


def test_blocks_and_pieces_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    draw = lambda n: " ".join(f"W{i}" for i in rng.integers(0, 4, n))
    items = [(i, draw(int(rng.integers(1, 120)))) for i in range(30)]
    texts = [(i, draw(40) + ". " + items[i % 30][1]) for i in range(50)]
    docs, bench = frames(spark, texts, items)
    one = sorted(decontaminate.matches(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 20)
    many = sorted(decontaminate.matches(docs, bench, block_words=300).collect())
    assert [(r.doc_id, r.n_words, r.spans, r["items"]) for r in one] == [
        (r.doc_id, r.n_words, r.spans, r["items"]) for r in many]
    for r in one:
        wanted = by_hand(*texts[r.doc_id], items)
        assert (sum(b - a for a, b in r.spans), len(r["items"])) == wanted[2:4]


def test_edge_rows(spark):
    passage = "The quick brown fox, jumps over 12 lazy dogs near äÄ rivers"
    items = [(1, passage), (1, "short one"), (None, "no id here"), (2, None), (3, ""), (4, "?!"),
             (10, passage), (9, "x"), (5, "a" * 100_000)]
    texts = [(1, None), (2, ""), (3, "...."), (4, passage.upper()), (4, passage.upper()),
             (None, passage), (5, "the " + passage.replace(" ", "--") + " end"),
             (6, "Short ONE"), (7, "shortone x"), (8, "no id here"), (9, "a" * 100_000),
             (11, "word " * 50_000 + passage)]
    docs, bench = frames(spark, texts, items)
    found = decontaminate.contamination(docs, bench).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted(
        (by_hand(i, t, items) for i, t in texts), key=str)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    clean = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert len(clean) == len(texts) and not any(r.contaminated for r in clean)


def test_passages_are_cut_out_and_covered_texts_go(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    items = [(1, passage)]
    rest = " ".join(f"r{i}" for i in range(30))
    docs, bench = frames(spark, [
        (1, rest), (2, f"{rest}. {passage}! {rest}"), (3, f"Well, {passage}."),
        (4, None), (5, f"«{passage}» {rest}")], items)
    left = {r.doc_id: r.text for r in decontaminate.decontaminated(docs, bench).collect()}
    # the quotes are parts of words, so ten of the twelve words are left
    assert left == {1: rest, 2: f"{rest}. ! {rest}", 4: None, 5: f"«p0 p11» {rest}"}
