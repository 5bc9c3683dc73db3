"""WARC writing, salvage and page text."""

import gzip
import hashlib
import itertools

import pytest

from cartpulse.llm import html_text, warc
from cartpulse.llm.queries import ORACLES, QUERIES
from oracle_check import connect, differences


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows],
                                 "page_id long, url string, html string, payload string, host int")


# --- WARC ----------------------------------------------------------------------------------

def test_roundtrip_and_revisits(spark):
    long, other = "<p>é</p>" * 200, "x" * 999
    rows = [(1, "http://a/1", long), (7, "http://a/7", long), (3, None, long), (None, "u", long),
            (4, "http://a/4", other), (5, "http://a/5", other), (6, "bad\r\nurl", None),
            (8, "u", ""), (8, "u", ""), (9, "u", "y" * 300_000)]
    found = warc.archive_roundtrip(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    html = {i: h or "" for i, _, h in rows}
    for r in found:
        raw = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        revisit = r.page_id in (1, 3, None)
        assert (r.record_type, r.refers_to) == (("revisit", 7) if revisit else ("response", None))


def test_query_equals_its_sql(spark):
    con = connect("/root/testdata/sf0.01")
    assert differences(QUERIES["op3_warc_salvage"](spark, "/root/testdata/sf0.01"), con,
                       ORACLES["op3_warc_salvage"]) == []


def test_no_pages(spark):
    assert warc.archive_roundtrip(pages(spark, [(1, "u", "h")]).limit(0)).count() == 0


def members(n):
    return [warc.page_record(i, f"http://h/{i}", f"<p>{i}</p>".encode() * 50, None)
            for i in range(n)]


def ids(found):
    return [r.headers["warc-record-id"] for _, r in found if isinstance(r, warc.Record)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_what_follows_damage(packed):
    parts = [warc.compressed(m) if packed else m for m in members(6)]
    whole = b"".join(parts)
    places = list(itertools.accumulate(map(len, parts), initial=0))
    assert ids(warc.salvage(whole)) == [f"<urn:page:{i}>" for i in range(6)]
    broken = bytearray(whole)
    middle = places[2] + len(parts[2]) // 2
    broken[middle:middle + 4] = b"\0\xff\0\xff"
    found = list(warc.salvage(bytes(broken)))
    assert ids(found) == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)]
    gaps = [r for _, r in found if isinstance(r, warc.Gap)]
    assert [(g.start, g.length) for g in gaps] == [(places[2], len(parts[2]))]
    cut = whole[:places[4] + 9]
    found = list(warc.salvage(cut))
    assert ids(found) == [f"<urn:page:{i}>" for i in range(4)]
    assert found[-1][1].length == 9 and found[-1][0] == places[4]


def test_salvage_of_mixed_and_foreign_bytes():
    one, two, three = members(3)
    data = b"junk \x1f\x8b\x08 junk" + one + b"WARC/1.1\r\nnot a record" + \
        gzip.compress(two) + gzip.compress(b"something else") + warc.compressed(three)
    found = list(warc.salvage(data))
    assert ids(found) == [f"<urn:page:{i}>" for i in range(3)]
    assert sum(isinstance(r, warc.Gap) for _, r in found) == 3
    assert list(warc.salvage(b"")) == []


def test_gaps_are_reported_by_the_reader(spark, tmp_path):
    good = warc.compressed(members(1)[0])
    (tmp_path / "a.warc.gz").write_bytes(good + b"\1\2\3" + good)
    archives = spark.createDataFrame([("a.warc.gz",)], "archive string")
    rows = warc.read_archives(spark, archives, str(tmp_path)).orderBy("start").collect()
    assert [(r.kind, r.start, r.gap_bytes) for r in rows] == [
        ("response", 0, None), ("gap", len(good), 3), ("response", len(good) + 3, None)]


def test_wrong_digest_is_damage():
    record = members(1)[0].replace(b"<p>0</p>", b"<p>9</p>", 1)
    with pytest.raises(warc.Damaged):
        warc.parse_record(record)


# --- page text -----------------------------------------------------------------------------

def texts(spark, rows):
    return {r.page_id: r.text for r in html_text.extract(pages(spark, rows)).collect()}


def test_article_without_furniture(spark):
    page = """<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head>
    <body><header>top</header><nav><ul><li>menu</li></ul></nav><div class="Ad box">buy</div>
    <div id="cookie-notice">cookies</div><article><h1>A &amp; B</h1><p>one
      <b>two</b>&nbsp;&eacute;<br>three<p>four<aside>side</aside><form>f<input></form>
      <section class="comments"><p>reader</p></section></article><!-- <p>x</p> -->
    <footer>&copy; me</footer>"""
    assert texts(spark, [(1, "http://h/a", page)])[1] == "A & B\none two é\nthree\nfour"


@pytest.mark.parametrize("attributes, seen", [
    ('style="overflow:hidden"', True), ('href="/hidden/x"', True), ("href=/hidden/x", True),
    ('title="the hidden city"', True), ("title='a class=ad b'", True), ("data-hidden", True),
    ('style="--display:none; color:red"', True), ('aria-hidden="false"', True),
    ("hidden", False), ('HIDDEN=""', False), ('class="x" hidden', False),
    ('style="color:red; Display : none"', False), ("style='visibility:hidden'", False)])
def test_hidden_elements(attributes, seen):
    found = [x.text for x in html_text.lines(f"<article {attributes}><p>text</p></article>")
             if not x.furniture]
    assert found == (["text"] if seen else [])


def test_lines_shared_with_the_nearest_page_go(spark):
    def page(*body):
        return "".join(f"<div>{b}</div>" for b in ("Site", "Menu", *body, "Imprint"))
    rows = [(1, "http://h/a/1", page("first", "story")), (2, "http://h/a/2", page("second")),
            (3, "http://other/a/1", page("alone")), (4, None, page("none"))]
    found = texts(spark, rows)
    assert found == {1: "first\nstory", 2: "second", 3: "Site\nMenu\nalone\nImprint",
                     4: "Site\nMenu\nnone\nImprint"}


def test_copies_of_a_page_keep_their_text(spark):
    page = "<p>a</p><p>b</p>"
    assert texts(spark, [(1, "http://h/1", page), (2, "http://h/2", page)]) == {
        1: "a\nb", 2: "a\nb"}


@pytest.mark.parametrize("parts", [1, 3, 16, 200])
def test_partitions_change_no_text(spark, parts):
    """Against all pages in one sorted list, each beside its nearer neighbour."""
    rows = [(n, f"http://h{n % 3}/{'abc'[n % 2]}/{n:02}", "".join(
        f"<p>{line}</p>" for line in ("Site", f"part {n % 2}", f"story {n}", f"group {n // 7}")))
        for n in range(60)]
    rows += [rows[20], rows[20], (None, "http://h0/a/00", "<p>Site</p><p>x</p>")]
    keys = sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or 0))
    expected = []
    for at, (page_id, url, page) in enumerate(keys):
        host, path = url[7:].split("/", 1)
        near = [(html_text.nearness(path, other[1][7:].split("/", 1)[1]), other[2])
                for other in (keys[at - 1:at] if at else []) + keys[at + 1:at + 2]
                if other[1][7:].split("/", 1)[0] == host]
        neighbour = html_text.lines(max(near, key=lambda n: n[0])[1])
        expected.append((page_id, html_text.main_text(html_text.lines(page), neighbour)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = [(r.page_id, r.text) for r in html_text.extract(pages(spark, rows)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert any("Site" not in text for _, text in found)


def test_page_edge_rows(spark):
    rows = [(1, "http://h/1", None), (2, "http://h/2", ""), (2, "http://h/2", ""),
            (3, "http://h/3", "no markup & <b"), (None, "http://h/4", "<p>x"),
            (5, "http://h/5", "<article>" + "<p>w</p>" * 40_000 + "</article>"),
            (6, "http://h/6", "<nav>never closed <article><p>kept</p></article>")]
    found = html_text.extract(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert by_id[1].text == "" and by_id[2].n_chars == 0 and by_id[None].text == "x"
    assert by_id[3].text.startswith("no markup &") and by_id[5].n_chars == 79_999
    assert by_id[6].text == "kept"
    assert html_text.extract(pages(spark, rows).limit(0)).count() == 0


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence_is_longest():
    import random
    chosen = random.Random(4)
    for _ in range(300):
        a = [chosen.choice("abcd") for _ in range(chosen.randint(0, 14))]
        b = [chosen.choice("abcd") for _ in range(chosen.randint(0, 14))]
        found = html_text.common(a, b)
        assert len(found) == length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in sorted(found))


def test_long_pages_are_aligned_whole():
    menu, foot = [f"menu {i}" for i in range(5)], [f"foot {i}" for i in range(5)]
    long = menu + [f"long {i}" for i in range(20_000)] + foot
    short = ["first"] + menu + [f"short {i}" for i in range(100)] + foot + ["last"]
    for a, b in ((long, short), (short, long)):
        assert {a[i] for i in html_text.common(a, b)} == {*menu, *foot}
    mixed = [f"{i * 7919 % 20_011}" for i in range(20_011)]
    turned = mixed[17_000:] + mixed[:17_000]
    assert len(html_text.common(mixed, turned)) >= 17_000


def test_template_is_told_from_a_near_copy(spark):
    def page(*body):
        lines = [f"menu {i}" for i in range(5)] + list(body) + [f"foot {i}" for i in range(5)]
        return "".join(f"<div>{x}</div>" for x in lines)
    story = [f"story {i}" for i in range(20)]
    rows = [(n, f"http://short/{n}", page(f"own {n}", f"more {n}")) for n in range(4)]
    rows += [(10 + n, f"http://two/{n}", page(f"own {n}")) for n in range(2)]
    rows += [(20, "http://near/a", page("else", "other")),
             (21, "http://near/b/1", page("at noon", *story)),
             (22, "http://near/b/2", page("at night", *story)),
             (23, "http://near/c", page("end", "other words"))]
    found = texts(spark, rows)
    assert all(found[n] == f"own {n}\nmore {n}" for n in range(4))
    assert all(found[10 + n] == f"own {n}" for n in range(2))
    assert found[21].split("\n") == ["at noon", *story]
    assert found[22].split("\n") == ["at night", *story]


@pytest.mark.parametrize("html, text", [
    ('<article><div class="has-sidebar"><p>The story.</p></div></article>', "The story."),
    ('<div class="menu"><article><p>The story.</p></article></div>', "The story."),
    ('<form action="/"><article><p>The story.</p></article><p>Search</p></form>', "The story."),
    ('<aside><article><p>A card.</p></article></aside><article><p>The story.</p></article>',
     "The story."),
    ('<div id=content><p>A long story, told in many words.</p></div>'
     '<article class=card><p>Teaser</p></article>', "A long story, told in many words.\nTeaser"),
    ('<article><p class="share-price">It rose.</p><p id="menu-item-history">Dishes.</p></article>',
     "It rose.\nDishes."),
    ('<article><p>The story.</p></article><div class="usercomments"><p>First!</p></div>'
     '<ul class="reply-list"><li>Me too, and at much greater length than the story.</li></ul>',
     "The story."),
    ('<article><header><h1>Heading</h1><p>By Someone</p></header><p>The story.</p></article>',
     "Heading\nThe story."),
    ('<article><p>The story.</p><div class="related-posts"><p>More</p></div>'
     '<p class="commentary">Said she.</p></article>', "The story.\nSaid she."),
    ('<article hidden><p>Gone.</p></article><p>Here.</p>', "Here."),
])
def test_markup_counts_by_whole_names(html, text):
    assert html_text.main_text(html_text.lines(html), None) == text


def test_pages_without_articles_by_differencing_alone(spark):
    """Templates of plain blocks: what the nearest page of the host has in the same order
    goes, and every story stays, checked against the way the pages were made."""
    rows, wanted = [], {}
    for site in range(3):
        top = [f"Site {site} menu {i}" for i in range(site + 2)]
        end = [f"Site {site} imprint", "All rights reserved"]
        for i in range(30):
            story = [f"Story {i} of site {site}, part {k}: " + "x" * k for k in range(1, 9)]
            page = "".join(f"<div>{line}</div>" for line in [*top, *story, *end])
            rows.append((site * 100 + i, f"http://s{site}.example/a/{i // 10}/{i:02}", page))
            wanted[site * 100 + i] = "\n".join(story)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == wanted
