"""Toxicity, language, SimHash and the pipeline on small tables."""

import collections
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from cartpulse.llm import lang_id, simhash, similar_texts, toxicity
from cartpulse.llm.components import components
from cartpulse.llm.frames import table

SMALL = "/root/testdata/sf0.01"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, bits int, "
                                       "toxic string, _p_toxic_ string, key string")


def plain(rows):
    return [(i, t, lang, 1, "x", "y", "z") for i, t, lang in rows]


# --- toxicity ------------------------------------------------------------------------------

def test_toxicity_separates_labelled_documents(spark):
    found = toxicity.toxicity(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    held = found.join(table(spark, SMALL, "labels").select("doc_id", (
        "toxic")).withColumnRenamed("toxic", "label"), "doc_id").collect()
    assert np.mean([r.toxic == (r.label == 1) for r in held]) > 0.99
    assert all(0 <= p <= 1 for r in held for p in (r.p_insult, r.p_contempt, r.p_toxic))


def test_later_categories_use_out_of_fold_probabilities_of_earlier_ones():
    rng = np.random.default_rng(0)
    n = 400
    first = rng.integers(0, 2, n)
    rows, columns = np.arange(n), first.astype(np.int64)
    targets = np.column_stack([first, first]).astype(float)
    model = toxicity.fit(rows, columns, targets, np.arange(n) % 5, np.array([10, 20]))
    assert model.weights[1, 2] > 0          # the first category's probability counts
    assert model.weights[0, 2:].tolist() == [0, 0]


def test_toxicity_edge_rows(spark):
    rows = plain([(1, None, None), (1, None, None), (2, "", "en"), (None, "a b", "en"),
                  (3, "word " * 50_000, "en")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, 1, 1), (3, 1, None)],
                                   "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(docs(spark, rows), labels).collect()
    assert len(found) == 5 and not any(r.toxic for r in found)
    assert toxicity.toxicity(docs(spark, rows).limit(0), labels).count() == 0
    kept = toxicity.without_toxic(docs(spark, rows), labels)
    assert kept.columns == docs(spark, rows).columns and kept.count() == 5


# --- language ------------------------------------------------------------------------------

def test_codewords_differ():
    for n in (1, 2, 4, 7, 12, 40):
        code = lang_id.codewords(n)
        assert len({tuple(w) for w in code.tolist()}) == max(1, n if code.shape[1] else 1)


def test_one_wrong_bit_is_corrected():
    code = lang_id.codewords(4)
    model = lang_id.Model(list("abcd"), code, np.eye(7, dtype=np.float32),
                          np.zeros(7, np.float32), np.full(7, 1 / 7, np.float32))
    for word in range(4):
        for bit in range(7):
            margins = 2 * code[word].copy()
            margins[bit] *= -1
            assert lang_id.losses(model, margins[None])[0].argmin() == word


def test_languages_of_held_out_documents(spark):
    found = lang_id.languages(table(spark, SMALL, "documents")).collect()
    told = {r.doc_id: r.lang for r in table(spark, SMALL, "documents").collect()}
    held = [r for r in found if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.lang_pred == told[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_documents_are_not_read(spark):
    rows = table(spark, SMALL, "documents").limit(300)
    wrong = rows.selectExpr("doc_id", "text", "case when pmod(crc32(cast(doc_id as string)), 5)"
                            " = 0 then 'zz' else lang end as lang")
    a, b = lang_id.languages(rows).collect(), lang_id.languages(wrong).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_language_edge_rows(spark):
    base = [(i, "the house and the garden " * 3, "en") for i in range(40)] + \
        [(i, "das haus und der garten " * 3, "de") for i in range(40, 80)]
    rows = plain(base + [(100, None, "en"), (101, "", None), (101, "", None), (102, "12 !?", "de"),
                         (None, "the house and", None), (103, "das haus " * 30_000, None)])
    found = collections.Counter((r.doc_id, r.lang_pred) for r in
                                lang_id.languages(docs(spark, rows)).collect())
    assert found[(100, "und")] == 1 and found[(101, "und")] == 2 and found[(102, "und")] == 1
    assert found[(None, "en")] == 1 and found[(103, "de")] == 1
    kept = lang_id.known_language(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {*range(80), None, 103}
    unlabelled = docs(spark, plain([(1, "abc", None)]))
    assert lang_id.languages(unlabelled).collect()[0].lang_pred == "und"
    assert lang_id.languages(unlabelled.limit(0)).count() == 0


# --- SimHash -------------------------------------------------------------------------------

def by_hand(text):
    words = bytes(text or "", "utf8").lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42)
              for i in range(max(len(words) - 3, 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(keys, bits, radius=4):
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (bits[a] ^ bits[b]).bit_count() <= radius:
                one, two = sorted((find(a), find(b)))
                parent[two] = one
    return {k: find(k) for k in keys}


def test_simhash_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words, 80)) for _ in range(12)]
    texts = {}
    for i in range(120):
        t = base[i % 12].split()
        if i >= 12:
            t[int(rng.integers(80))] = "Changed"
        texts[i] = " ".join(t)
    texts |= {200: None, 201: "", 202: " \t", 203: "one two", 204: "ONE  two", 205: "É é",
              206: "a b c d e " * 20_000}
    rows = docs(spark, plain([(i, t, "en") for i, t in texts.items()]))
    found = {r.doc_id: r for r in simhash.near_duplicates(rows).collect()}
    bits = {i: by_hand(t) for i, t in texts.items()}
    wanted = groups(sorted(texts), bits)
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == bits
    assert {i: r.component_id for i, r in found.items()} == wanted
    kept = simhash.one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted.values()))


def test_one_id_with_two_texts(spark):
    one, two = "alpha beta gamma delta epsilon", "quite other words stand in here"
    rows = docs(spark, plain([(5, one, "en"), (5, two, "en"), (5, two, "en"), (6, two, "en"),
                              (2, one, "en")]))
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(rows).collect()]
    assert sorted(kept) == [(2, one), (5, two)]
    rows = docs(spark, plain([(5, one, "en"), (5, two, "en"), (6, one, "en")]))
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(rows).collect()]
    assert sorted(kept) == [(5, one), (5, two)]


def by_similarity(texts, least=0.8):
    """The smallest id that links of five-word similarity reach, for every id."""
    sets = {i: set(similar_texts.shingles(t or "").tolist()) for i, t in texts.items()}
    holders, group = collections.defaultdict(list), {i: i for i in texts}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in sorted(texts):
        shared = collections.Counter(j for s in sets[i] for j in holders[s])
        for j, both in shared.items():
            if both >= least * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                low, high = sorted((top(i), top(j)))
                group[high] = low
        for s in sets[i]:
            holders[s].append(i)
    return {i: top(i) for i in texts}


def test_forest_connects_near_pairs_in_few_and_in_many_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, (6, similar_texts.NUMBERS), dtype=np.uint64)
    prints = np.repeat(base, 50, axis=0)
    for row in prints:
        for bit in rng.choice(256, int(rng.integers(0, 16)), replace=False):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    def forests(*args):
        parts = list(similar_texts.nearest_forests(*args))
        return (*(np.concatenate(c) for c in list(zip(*parts))[:2]), any(p[2] for p in parts))

    for held in (10**6, 10):
        monkeypatch.setattr(similar_texts, "_HELD", held)
        a, b, more = forests(prints, prints, True, np.arange(300))
        assert more and len(a) == 300 - 6 and (a // 50 == b // 50).all()
        for number in (1000, None):
            a, b, more = forests(prints, prints, True, np.arange(300), number)
            assert not more and len(set(zip(a.tolist(), b.tolist()))) == 6 * 50 * 49 // 2 == len(a)
        a, b, more = forests(prints[:120], prints[120:], False, np.arange(300))
        assert more and len(a) == 49 and ((b + 120) // 50 == a // 50).all()
        groups = np.arange(300) // 25
        a, b, _ = forests(prints, prints, True, groups)
        assert len(a) == 6 and (groups[a] != groups[b]).all()


def test_similar_texts_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words, 30))
    base = [" ".join(rng.choice(words, 150)) for _ in range(10)]
    texts = {}
    for i in range(200):
        t = base[0 if i % 3 == 0 else i % 10].split()
        for at in rng.integers(0, 150, int(rng.integers(0, 5))):
            t[at] = f"x{rng.integers(10_000)}"
        texts[i] = " ".join(t) + (" " + passage if i % 2 else "")
    texts |= {200 + i: " ".join(rng.choice(words, 20)) + " " + passage for i in range(60)}
    texts |= {300: "", 301: " ", 302: "one two", 303: "ONE  two", 304: None}
    group = by_similarity(texts)
    rows = docs(spark, plain([(i, t, "en") for i, t in texts.items()]))
    for tile in (similar_texts.TILE, 40):
        kept = similar_texts.one_of_similar(rows, tile=tile)
        assert kept.columns == rows.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))
    twice = docs(spark, plain([(7, "one text", "en"), (7, "one text", "en"),
                               (7, "another text", "en"), (3, "one text", "en"),
                               (None, "one text", "en")]))
    kept = [(r.doc_id, r.text) for r in similar_texts.one_of_similar(twice).collect()]
    assert sorted(kept, key=str) == [(3, "one text"), (7, "another text"), (None, "one text")]
    assert similar_texts.one_of_similar(twice.limit(0)).count() == 0


def test_pairs_of_a_group_on_both_sides_of_the_limit_never_become_rows(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base, texts = rng.choice([f"w{i}" for i in range(3000)], 120), {}
    for i in range(400):
        words = base.copy()
        for at in rng.integers(0, 120, int(rng.integers(1, 5))):
            words[at] = f"x{rng.integers(10_000)}"
        texts[i] = " ".join(words)
    sets = [set(similar_texts.shingles(t).tolist()) for t in texts.values()]
    alike = [len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
             for i in range(400) for j in range(i)]
    assert min(alike.count(True), alike.count(False)) > 5000
    steps = []

    def recorded(df, label, *by):
        steps.append((label, plain_written(df, label, *by)))
        return steps[-1][1]

    plain_written = similar_texts.written
    monkeypatch.setattr(similar_texts, "written", recorded)
    kept = similar_texts.one_of_similar(docs(spark, plain([(i, t, "en")
                                                           for i, t in texts.items()])))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        set(by_similarity(texts).values()))
    assert {label: rows for label, df in steps if (rows := df.count()) > 400} == {}


def test_only_texts_of_groups_move_and_a_group_has_few_edges(spark, monkeypatch):
    rng = np.random.default_rng(12)
    words, texts, seen = [f"w{i}" for i in range(3000)], {}, {}
    base = rng.choice(words, 200)
    for i in range(300):
        changed = base.copy()
        for at in rng.integers(0, 200, 3):
            changed[at] = f"x{rng.integers(10_000)}"
        texts[i] = " ".join(changed)
    texts |= {300 + i: " ".join(rng.choice(words, 60)) for i in range(900)}
    plain_components, plain_packed = similar_texts.components, similar_texts._packed

    def components_of(edges):
        seen.setdefault("edges", edges.count())
        return plain_components(edges)

    def packed(moved):
        seen["moved"] = moved.count()
        return plain_packed(moved)

    monkeypatch.setattr(similar_texts, "components", components_of)
    monkeypatch.setattr(similar_texts, "_packed", packed)
    kept = similar_texts.one_of_similar(docs(spark, plain([(i, t, "en")
                                                           for i, t in texts.items()])))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(by_similarity(texts).values()))
    assert 300 <= seen["moved"] < 400 and 299 <= seen["edges"] < 2 * 300


def test_a_bitmap_marks_every_node_and_few_others(spark, monkeypatch):
    rows = spark.range(40_000).selectExpr("unhex(md5(cast(id as string))) as node", "id as _at")
    for most, others in ((1 << 26, 3000), (1 << 15, 40_000)):
        monkeypatch.setattr(similar_texts, "MOST_BITS", most)
        found = similar_texts.marked(rows, "node", rows.where("_at % 20 = 0").select("node"), "m")
        assert found.columns == ["node", "_at", "m"] and found.count() == 40_000
        assert found.where("_at % 20 = 0 and not m").isEmpty()
        assert found.where("m").count() - 2000 < others
    assert found.where("not m").count() > 20_000
    none = similar_texts.marked(rows, "node", rows.limit(0).select("node"), "m")
    assert none.where("m").isEmpty() and none.count() == 40_000


def test_bands_find_pairs_at_the_limit():
    rng = np.random.default_rng(4)
    for size in (1, 9, 45, 90, 900):
        for _ in range(200):
            shared, one, two = (rng.integers(-2**63, 2**63 - 1, n) for n in (
                size * 8 // 9 if size > 1 else 1, size // 9, size // 9))
            first, second = (similar_texts.bands(np.concatenate([shared, own]))
                             for own in (one, two))
            assert (first == second).any()
            assert not (first == similar_texts.bands(rng.integers(-2**63, 2**63 - 1, 90))).any()


def test_tiles_of_any_size_give_the_same_links(spark):
    rng = np.random.default_rng(2)
    numbers = np.unique(np.concatenate(
        [c ^ (1 << rng.integers(0, 63, 40)) for c in rng.integers(0, 2**62, 30)]))
    rows = spark.createDataFrame([(int(n),) for n in numbers], "bits long")
    bits = {int(n): int(n) for n in numbers}
    wanted = groups(sorted(bits), bits)
    for tile in (3, 8192):
        found = {r.node: r.component for r in components(simhash.links(rows, tile=tile)).collect()}
        assert {n: found.get(n, n) for n in bits} == wanted


def test_simhash_edge_tables(spark):
    rows = docs(spark, plain([(None, "a", "en"), (5, "a", "en"), (5, "a", "en")]))
    found = simhash.near_duplicates(rows).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (5, 5), (5, 5)]
    assert sorted(r.doc_id or 0 for r in simhash.one_of_each(rows).collect()) == [0, 5]
    assert simhash.near_duplicates(rows.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 300)] + [(1000, 1000 + i) for i in range(1, 300)]
    rows = spark.createDataFrame(edges + [(7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components(rows).collect()}
    assert set(found.values()) == {1, 1000} and len(found) == 600


# --- pipeline ------------------------------------------------------------------------------

def test_pipeline_equals_its_stages_by_hand(spark):
    rows = table(spark, SMALL, "documents")
    held = {r.doc_id: r.text for r in rows.collect()}
    toxic = {r.doc_id for r in toxicity.toxicity(rows, table(spark, SMALL, "labels")).collect()
             if r.toxic}
    left = {i: t for i, t in held.items() if i not in toxic}
    spoken = {r.doc_id for r in lang_id.known_language(
        rows.where(~rows.doc_id.isin(list(toxic)))).collect()}
    wanted = set(by_similarity({i: left[i] for i in spoken}).values())
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in found} == wanted and toxic and len(wanted) < len(spoken)


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_stages_keep_columns(spark, stage):
    rows = table(spark, "/root/testdata/sf0.001", "documents")
    kept = stage[1](spark, rows, "/root/testdata/sf0.001")
    assert kept.columns == rows.columns and 0 < kept.count() <= rows.count()


def test_stages_keep_columns_whose_names_they_use(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).selectExpr(
        "*", "doc_id as _p_toxic", "doc_id as _P_INSULT", "doc_id as _lang_pred",
        "doc_id as _lang_ambiguous", "doc_id as _node", "doc_id as __node", "doc_id as bits",
        "doc_id as names")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, SMALL)
        assert kept.columns == rows.columns
        held = kept.collect()
        assert held and all(r[c] == r.doc_id for r in held for c in rows.columns[5:])


def test_near_duplicates_of_edge_rows(spark):
    long = " ".join(f"w{i % 9000}" for i in range(60_000))
    rows = docs(spark, plain([(4, long, "en"), (5, long + " end", "en"), (6, None, "en"),
                              (8, "", "en"), (9, "one", "en"), (9, "one", "en")]))
    kept = corpus_pipeline.near_duplicates(spark, rows, "")
    assert sorted(r.doc_id for r in kept.collect()) == [4, 6, 9]
    assert corpus_pipeline.near_duplicates(spark, rows.limit(0), "").count() == 0
