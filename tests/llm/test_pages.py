"""Main text extraction, and WARC archives read back."""
import base64
import gzip
import hashlib
from collections import Counter

import pyarrow.fs as fs
import pytest
from pyspark.sql import functions as F

from starloom.llm import html_extract, warc
from starloom.llm.common import table
from starloom.session import scratch_path

SF = "/root/testdata/sf0.001"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body class="page-1">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div id="cookie-notice">Accept</div>
<article class="post-17"><header><h1>Head &amp; tail</h1></header><p>One <b>bold<br>word</p><p>Two&nbsp;words <a href="x>y">link</a>
<ul><li>item a<li>item b</ul><form><input>Mail</form><div class="share">Share</div><pre>a
 b</pre><section class="comments"><p>Reader says</p></section></article>
<aside>More</aside><div class="ad banner">Buy</div><footer>(c)</footer></body></html>"""


def extracted(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, path string")
    return {r.page_id: (r.text, r.n_chars) for r in html_extract.main_texts(df).collect()}


def test_article_without_its_surroundings(spark):
    text = "Head & tail\nOne bold word\nTwo words link\nitem a\nitem b\na b"
    got = extracted(spark, [(1, "https://a.example/x", PAGE), (2, None, PAGE)])
    assert got == {1: (text, len(text)), 2: (text, len(text))}


def test_host_vote_overrules_a_page(spark):
    long, short = " ".join(["words of the story"] * 30), "One line."
    page = lambda body, aside: f"<body><div class='lead{len(aside)}'>{aside}</div><div class='story-9'><p>{body}</p></div></body>"
    rows = [(i, "http://www.h.example/1", page(long, "top")) for i in range(5)] + [(9, "http://h.example/2", page(short, long))]
    assert extracted(spark, rows)[9] == (short, len(short))
    assert extracted(spark, [(9, "http://other.example/2", page(short, long))])[9][0].startswith("words of")


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<!-- <p>x</p> --><p>a</p>", "a"), ("<p>1 &lt; 2 < 3</p>", "1 < 2 < 3"), ("<script>never closed <p>x", ""), ("</p></div>a", "a"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ('<p title="a>b">x</p>', "x"), ("<p title='open>x</p>", "x"), ("<nav>all</nav>", ""),
    ("<div hidden>no</div><p aria-hidden=true>no</p><p>yes</p>", "yes"), ("<p>a<span/>b</p>", "ab"),
])
def test_small_pages(html, text):
    assert html_extract.extract(html or "", None) == text


PROSE = " ".join(["many words of the story"] * 20)


@pytest.mark.parametrize("html,text", [
    ("<article><h1>Title</h1><p>the lead</p><div class=entry><p>{}</p></div></article>", "Title\nthe lead\n{}"),
    ("<div class=a><p>first part here</p></div><div class=b><p>{}</p></div>", "first part here\n{}"),
    ("<div class=page><h1>Title</h1><article><p>{}</p></article></div>", "Title\n{}"),
    ("<div class=list><a href=x>one link more</a></div><div class=b><p>{}</p></div>", "{}"),
    ("<div class=beside><p>not of it</p></div><div><article><p>{}</p></article></div>", "{}"),
])
def test_text_beside_the_largest_container_stays(spark, html, text):
    html, text = html.replace("{}", PROSE), text.replace("{}", PROSE)
    assert html_extract.extract(html, None) == text
    got = extracted(spark, [(i, "http://h.example/1", html) for i in range(3)])
    assert set(got.values()) == {(text, len(text))}


@pytest.mark.parametrize("html,text", [
    ("<div class='layout has-sidebar'><article><p>{}</p></article></div>", "{}"),
    ("<div id='page-no-comments'><p>{}</p></div>", "{}"),
    ("<div class='two-col-sidebar'><div class=sidebar>Menu here</div><article><p>{}</p></article></div>", "{}"),
    ("<div class=widget><p>{}</p></div><div class=ad>Buy</div>", "{}"),
    ("<div class=widget><p>{}</p></div><div class=promo><p>{}</p></div>", "{}\n{}"),
    ("<article><h2 id='related-work'>Related work</h2><p class=notice>Note this</p><p>{}</p></article>", "Related work\nNote this\n{}"),
    ("<article><p>{}</p><section class='share-price'>It fell</section><p>a <span id=share>b</span></p></article>", "{}\nIt fell\na b"),
    ("<article><p>{}</p><div class='share-buttons'>Share</div><section class=comments><article>Reader says</article></section></article>", "{}"),
    ("<article><p>{}</p><p class=related><a href=x>See that page</a></p><p>a<span class=ad>b</span></p></article>", "{}\na"),
    ("<div class=comments><div class=story><p>no</p></div></div><div class=text><p>{}</p></div>", "{}"),
])
def test_marks_count_on_minor_parts_only(html, text):
    assert html_extract.extract(html.replace("{}", PROSE), None) == text.replace("{}", PROSE)


@pytest.mark.parametrize("html,text", [
    ("<form action=/x><input name=q><label>Find</label><select><option>one<option>two</select><div class=story><p>{}</p></div><button>Go</button></form>", "{}"),
    ("<article><p>{}</p><form><p>Your mail</p><button>Send</button></form></article>", "{}"),
    ("<nav><ul><li><a href=/>Home</a><li><a href=/b>About us</a></ul><article><p>{}</p></article>", "{}"),
    ("<nav><article><p>{}</p></article></nav><div><p>short own text</p></div>", "short own text"),
    ("<head><title>t</title><p>{}</p>", "{}"),
    ("<div class=topnav>All of our sections</div><div class=sidenav>More of our sections</div><div class=AD>Buy it now</div><div class=story><p>{}</p></div>", "{}"),
    ("<div class=story><p>{}</p></div><ol class=commentlist><li>I do not agree</ol>", "{}"),
    ("<div class=story><p>{}</p></div><div id=comments><p>{} {}</p><p>{}</p></div>", "{}"),
    ("<div class=roadside><p>{}</p></div>", "{}"),
])
def test_forms_unclosed_furniture_and_compound_marks(html, text):
    assert html_extract.extract(html.replace("{}", PROSE), None) == text.replace("{}", PROSE)


@pytest.mark.parametrize("start, one, end", [
    ("", "<a b='", ""), ("", "<div>", ""), ("", "<script ", ""), ("", "<p ", ""), ("", "<a b=\"'>", ""), ("<b>" * 9000, "<h1></h1>", ""),
    ("<div class=ad>" * 9000, "x<p>", ""), ("", "<li>", ""), ("<div class=ad>" * 5000, "<article>t</article>", ""), ("<div>" * 9000, "</x>", ""),
    ("", "<!--", ""), ("", "<span>x", "</div>" * 9000), ("<", "a" * 6, "\""), ("", "<div class='a b c'>t", "</div>" * 9000), ("<nav>", "<a href=x>y</a> ", ""),
])
def test_time_is_proportional_to_length(start, one, end):
    import time

    took = []
    for n in (9000, 18000):
        html = start + one * n + end
        t = time.process_time()
        html_extract.extract(html, None)
        took.append(time.process_time() - t)
    assert took[0] < 1.5 and took[1] < 4 * max(took[0], 0.1)


def made_host(rng, name, pages, style):
    """Pages of one host without a telling class, and the article of each: furniture repeats, articles do not."""
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    tagline, legal, about = line(6), line(14), line(25)
    links = "".join(f"<li><a href=/{word()}>{line(2)}</a></li>" for _ in range(8))
    common = line(9)  # a sentence that many articles have
    rows = []
    for k in range(pages):
        blocks = [line(rng.randrange(12, 60)) for _ in range(rng.randrange(3, 9))]
        if k % 2:
            blocks.insert(1, common)
        if k % 5 == 4 and rows:
            blocks = list(rows[-1][2])  # a copy of the page before
        story = "".join(f"<p>{b}</p>" for b in blocks)
        html = {
            "divs": f"<body><div class=q1>{tagline}</div><div class=q2><ul>{links}</ul></div><div class=q3>{story}</div><div class=q4>{legal}</div></body>",
            "deep": f"<div class=z><div class=l>{about}</div><div class=r><div class=t-{k}>{story}</div></div></div><div class=e>{legal}</div>",
            "article": f"<div>{tagline}</div><article>{story}</article><div>{about}</div>",
            "form": f"<form><div class=m><ul>{links}</ul></div><div class=n>{story}</div><p>{legal}</p></form>",
        }[style]
        rows.append((f"http://{name}.example/{k}", html, blocks))
    return rows


@pytest.mark.parametrize("style", ["divs", "deep", "article", "form"])
def test_furniture_of_a_host_is_found_by_its_pages(spark, style):
    import random

    rows = made_host(random.Random(style), style, 20, style)
    got = extracted(spark, [(k, url, html) for k, (url, html, _) in enumerate(rows)])
    assert {k: t for k, (t, _) in got.items()} == {k: "\n".join(blocks) for k, (_, _, blocks) in enumerate(rows)}


def test_copies_of_a_page_are_no_furniture(spark):
    html = f"<div class=a><p>the lead of it</p></div><div class=b><p>{PROSE}</p></div>"
    rows = [(k, "http://h.example/1", html) for k in range(6)]
    assert set(extracted(spark, rows).values()) == {("the lead of it\n" + PROSE, len(PROSE) + 15)}


def test_a_page_with_more_than_the_path_keeps_it():
    html = f"<div class=a><p>its own lead</p></div><div class=b><p>{PROSE}</p></div>"
    assert html_extract.extract(html, ">div.b") == "its own lead\n" + PROSE


def test_very_long_page_and_empty_table(spark):
    body = "".join(f"<p>row {i}</p>" for i in range(20_000))
    got = extracted(spark, [(1, "http://x.example", f"<body><main>{body}</main></body>")])
    assert got[1][0].count("\n") == 19_999
    assert html_extract.main_texts(table(spark, SF, "pages").limit(0)).count() == 0


def brute_records(rows, least=0):
    """Counter of (page_id, bytes, digest, type, refers) of rows (page_id, html)."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, Counter()
    for d, h in order:
        b = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        old = len(b) >= least and b in first
        out[d, len(b), digest, "revisit" if old else "response", first[b] if old else None] += 1
        first.setdefault(b, d)
    return out


def archive(spark, rows, **limits):
    df = spark.createDataFrame([(d, None if d is None else f"http://h/{d}", h, "z") for d, h in rows],
                               "page_id long, url string, html string, shard string")
    target = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(df, target, **limits)
    return target, manifest, warc.read_archives(spark, target, with_payload=True)


ROWS = [(1, "a" * 500), (2, "b"), (3, "a" * 500), (4, None), (5, ""), (6, "é\r\n\r\nWARC/1.1"), (None, "b"), (7, "long " * 100_000), (8, "z" * 90),
        (8, "y" * 90), (8, "y" * 90), (None, "only"), *((100 + i, f"page {i % 40}") for i in range(120))]


def test_round_trip_with_awkward_rows(spark):
    _, manifest, got = archive(spark, ROWS, shard_bytes=20_000, file_bytes=2_000)
    rows = got.collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == brute_records(ROWS)
    assert manifest.count() > 5 and sum(r.records for r in manifest.collect()) == len(ROWS)
    sent = Counter((r.page_id, bytes(r.payload)) for r in rows if r.record_type == "response")
    assert sent == Counter({(d, next((h or "").encode() for e, h in ROWS if e == d and base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() == s)): n
                            for (d, _, s, t, _), n in brute_records(ROWS).items() if t == "response"})


def test_least_payload(spark):
    got = archive(spark, ROWS, least_payload=2)[2].collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute_records(ROWS, 2)


def test_files_are_deterministic_sorted_and_plain_gzip(spark):
    files, digests = fs.LocalFileSystem(), []
    for n in (1, 5):
        df = spark.createDataFrame([(d, None, h) for d, h in ROWS], "page_id long, url string, html string").repartition(n)
        target = scratch_path(spark, "warc-test")
        digests.append(sorted((r.name, r.bytes, r.sha256) for r in warc.write_archives(df, target, 20_000, 2_000).collect()))
    assert digests[0] == digests[1]
    for name, size, digest in digests[1]:
        with files.open_input_stream(f"{target}/{name}", compression=None) as f:
            data = f.read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (size, digest)
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    ids = [r.page_id for r in warc.read_archives(spark, target).orderBy("file", "position").collect()]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))


def test_files_are_read_by_many_tasks(spark):
    rows = [(i, f"page {i} " + "x" * (i % 97) * 40) for i in range(900)]
    _, manifest, got = archive(spark, rows, shard_bytes=30_000, file_bytes=1_000)
    files = manifest.count()
    assert files >= 40 and got.rdd.getNumPartitions() == files
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() >= 20


def test_files_outside_the_manifest_are_not_read(spark):
    target, manifest, got = archive(spark, ROWS[:3])
    fs.LocalFileSystem().copy_file(f"{target}/{manifest.first().name}", f"{target}/part-99999-00000.warc.gz")
    assert warc.read_archives(spark, target).count() == 3


def test_damage_is_noticed():
    data = warc.record(1, "u", b"payload", warc.base32_digest(hashlib.sha1(b"payload").digest()), 0, "d", None)
    plain = gzip.decompress(data)
    assert warc.parse_record(plain)[0]["WARC-Type"] == "response"
    with pytest.raises(ValueError):
        warc.parse_record(plain.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def test_empty_table(spark):
    _, manifest, got = archive(spark, [])
    assert manifest.count() == 0 and got.count() == 0
