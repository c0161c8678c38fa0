"""WARC archives, HTML, sharding."""

import base64
import gzip
import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from fieldmark.llm import html_text as H
from fieldmark.llm import sharding as S
from fieldmark.llm import warc

PAGES = [
    (1, "http://a.org/x y", "<p>one</p>", "f"), (2, None, "<p>one</p>", "f"), (3, "http://a.org/\r\nz", "", "f"), (4, "u", None, "f"),
    (5, "u", "é" * 70000, "f"), (6, "u", "x\r\n\r\ny", "f"), (None, "u", "<p>one</p>", "f"), (6, "u", "x\r\n\r\ny", "f"), (7, "u", "alone", "f"),
]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, file string").repartition(2)
    index = warc.write_archives(pages, str(tmp_path))
    got = [tuple(r)[:6] for r in warc.read_records(index).collect()]
    top = {}
    for i, _, h, _ in PAGES:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, u, h, _ in PAGES:
        raw, main = (h or "").encode(), top[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        url = None if u is None else u.replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A")
        want.append((i, url, len(raw), digest, "response" if i == main else "revisit", None if i == main else main))
    assert sorted(got, key=str) == sorted(want, key=str)
    payloads = {r.page_id: r.payload for r in warc.read_records(index, with_payload=True).where("record_type = 'response'").collect()}
    assert payloads[5].decode() == "é" * 70000 and bytes(payloads[6]) == b"x\r\n\r\ny"
    # a selection reads only what it names; a file is a run of gzip members
    assert [r.page_id for r in warc.read_records(index.where("url = 'u' and page_id = 7")).collect()] == [7]
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in tmp_path.iterdir())
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES)


def test_damage_is_told_and_no_pages_are_no_records(spark, tmp_path):
    raw, _ = warc.record(1, "u", b"text", None, "2024-01-01T00:00:00Z")
    assert warc.parse(raw)["payload"] == b"text"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"\r\n\r\ntext\r\n", b"\r\n\r\ntexT\r\n"))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.write_archives(empty, str(tmp_path))).count() == 0


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T &amp; t</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("no markup &lt;at&gt; all", "no markup <at> all"), (page("<nav><a href=x>Home</a></nav>"), ""),
        (page("<nav><ul><li>Home</ul></nav><article><h1>Head</h1><p>One &eacute;&#8211;\n two<br>three<p>Four</article><footer>&copy; x</footer>"), "Head\nOne é– two three\nFour"),
        (page("<div class='site-header'>top menu words</div><div id=main><div class='post-12 entry'><p>Long text here, really.</p><ul><li>a<li>b</ul></div>"
              "<div class='sidebar-left'><p>Other long text, by far longer than the post is, but beside it.</p></div></div>"), "Long text here, really.\na\nb"),
        (page("<article><header>Menu</header><p>Body of it.</p><form><p>Your mail</p><input></form><div class=advert>Buy!</div><script>x='</p>'</script>"
              "<style>p{}</style><!-- no --><section class='comments'><article class=comment><p>First! A very long comment that says much more.</p></article></section></article>"), "Body of it."),
        (page("<div role=alert><p>We use cookies on this site</p></div><main><p>Told.</p><p hidden>not this</p><div style='display: none'>nor this</div></main>"), "Told."),
        (page("<article><p>cut <b>off <i>here"), "cut off here"), (page("<article><p>a</p></div></span>b<p>c<a"), "a\nb\nc"),
        (page("<div><p>x <a href='>'>q>r</a> 1 < 2 &amp;&amp; 3</p></div>"), "x q>r 1 < 2 && 3"),
    ],
)
def test_text_of_one_page(source, text):
    assert H.extract(H.parse(source or ""), []) == text


@pytest.mark.parametrize("name", ["related-work", "share-prices", "social-history", "header-note", "comment-on-law", "banner-text", "warning"])
def test_a_word_in_a_name_does_not_decide_alone(name):
    passage = "This passage belongs to the article and has a sentence or two to say. "
    kept = page(f"<article><p>Begin.</p><div class='{name}'><p>{passage}</p></div><p>End.</p></article>")
    assert H.extract(H.parse(kept), []) == f"Begin.\n{passage.strip()}\nEnd."
    for gone in ("Short.", f"See <a href=x>{passage}</a>"):
        source = page(f"<article><p>Begin.</p><div class='{name}'><p>{gone}</p></div><p>End.</p></article>")
        assert H.extract(H.parse(source), []) == "Begin.\nEnd."


@pytest.mark.parametrize("name", ["ad", "site-header", "comment-list", "post-comments", "cookie-banner", "sidebar left-2", "notice", "newsletterSignup"])
def test_names_of_noise_go_however_long(name):
    source = page(f"<article><p>Begin.</p><div class='{name}'><p>{'Much to read here. ' * 30}</p></div></article>")
    assert H.extract(H.parse(source), []) == "Begin."


def test_captions_headings_and_wrappers_stay():
    assert H.extract(H.parse(page("<article><p>Seen.</p><figure><img><figcaption>A cat.</figcaption></figure></article>")), []) == "Seen.\nA cat."
    body = "<div class=a><h1>Head</h1></div><div class=b><p>Intro.</p></div><div class=c><p>" + "word " * 80 + "</p></div>"
    links = "<div class=d><ul><li><a href=x>One of many other stories of the day</a></li></ul></div>"
    whole = "Head\nIntro.\n" + ("word " * 80).strip()
    assert H.extract(H.parse(page(f"<div class=wrap>{body}</div><div class=e><p>beside</p></div>")), []) == whole
    assert H.extract(H.parse(page(f"<div class=wrap>{body}{links}</div>")), []) == whole.partition("Intro.\n")[2]


def test_a_path_needs_a_fair_share_and_ties_go_to_the_first(spark):
    teaser = page("<div class=t><p>Short teaser.</p></div><article><p>" + "long " * 300 + "</p></article>")
    assert H.extract(H.parse(teaser), ["html>body>div.t"]) == ("long " * 300).strip()
    twins = page("<div class=x><p>one text here</p></div><div class=y><p>two text here</p></div>")
    both = "one text here\ntwo text here"
    assert H.extract(H.parse(twins), []) == both  # the body opens first
    rows = [(None, "http://h/1", twins, "p"), (None, "http://h/1", twins, "p"), (1, "http://h/1", twins, "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    assert sorted(map(tuple, H.main_text(pages).collect()), key=str) == sorted([(i, u, both, 27) for i, u, _, _ in rows], key=str)


def test_a_host_agrees(spark):
    def story(i, extra=""):
        return page(f"<div class='box-{i}'><div class='text'><p>{'word ' * 40}{i}</p></div></div><div class='extra'><p>{extra}</p></div>")

    rows = [(i, f"https://Host.org:80/{i}", story(i), "p") for i in range(9)]
    rows += [(9, "https://host.org/9", story(9, "much " * 200), "p"), (10, "https://other.org/", story(10, "much " * 200), "p")]
    rows += [(11, None, None, "p"), (12, "https://host.org/odd", page("<section><p>of its own kind</p></section>"), "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    got = {r.page_id: r for r in H.main_text(pages).collect()}
    assert got[9].text == "word " * 40 + "9"  # alone it would have given the longer box
    assert got[10].text == ("much " * 200).strip()
    assert got[11].text == "" and got[11].url is None and got[12].text == "of its own kind"
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(rows)
    assert H.main_text(pages.limit(0)).count() == 0


def test_an_article_is_whole_however_deep_its_text_stands(spark):
    def nested(i, outer):
        return page(f"<{outer}><h1>Head {i}</h1><div class=wrap><div class=intro><p>{'first ' * 130}</p></div>"
                    f"<div class=body><p>{'then ' * 400}</p></div></div><aside>Not this</aside></{outer}><div class=more><p>Nor this.</p></div>")  # fmt: skip

    want = ["Head {}", ("first " * 130).strip(), ("then " * 400).strip()]
    rows = [(i, f"https://{outer}.org/{i}", nested(i, outer)) for i, outer in enumerate(["article", "main"] * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in H.main_text(pages).collect():
        assert r.text.split("\n") == [w.format(r.page_id) for w in want]
    for i, _, source in rows:
        assert H.extract(H.parse(source), []).split("\n") == [w.format(i) for w in want]


def test_a_very_long_page():
    source = page("<article>" + "<p>para &amp; graph</p>" * 20000 + "</article>" + "<div>" * 3000)
    assert H.extract(H.parse(source), []).count("\n") == 19999


def sharded(spark, rows, n):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, shard int").repartition(3)
    got = S.shards(docs, n).collect()
    slots, load = defaultdict(list), Counter({k: 0 for k in range(n)})
    for r in got:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    return got, load


def test_shards_are_even_and_groups_stay_together(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET", 200)
    rows = [(i, f"text {i % 700} " + "é" * (i % 700 * 7 % 97)) for i in range(1000)] + [(i, "the same copy") for i in range(2000, 2600)]
    got, load = sharded(spark, rows, 16)
    mean = sum(load.values()) / 16
    assert max(abs(v - mean) for v in load.values()) < 0.02 * mean
    places = defaultdict(set)
    for r in got:
        places[r.text_crc32].add(r.shard)
    split = [k for k, v in places.items() if len(v) > 1]
    assert len(split) < 0.2 * len(places) and zlib.crc32(b"the same copy") in split


def test_shards_are_even_where_one_text_repeats_its_id(spark):
    rows = [(i, f"text {i} " + "y" * (i * 7 % 97)) for i in range(1000)] + [(7, "one id, one text " * 3)] * 500 + [(None, "no id, one text " * 3)] * 500
    _, load = sharded(spark, rows, 8)
    mean = sum(load.values()) / 8
    assert max(abs(v - mean) for v in load.values()) < 0.02 * mean


def test_shard_edges(spark):
    sharded(spark, [(None, None), (None, None), (1, ""), (1, ""), (2, "x" * 100000)], 16)
    assert S.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
