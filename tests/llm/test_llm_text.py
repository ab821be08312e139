"""Quality rules, page text, URL rules and tokens, compared with plain Python."""

import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tempora.llm import queries
from tempora.llm.host_paths import extract_text, parse, score, text_at
from tempora.llm.quality_hosts import judge_hosts, quality_rules
from tempora.llm.queries import vocabulary_path
from tempora.llm.segment_bpe import encode_decode
from tempora.llm.url_rules import judge_urls, mine_rules, url_tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_match_plain_python(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "one", "é\x0b# |x|\n\nsame\nsame \nsame", "a b c d e f g h a b c d e f g h", "a " * 500, "x" * 100_000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + rng.choice(["", "\nq r\nq r", "<&>"]) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, None, f"s{i % 3}", None) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in quality_rules(docs.withColumn("host", F.lit("clash"))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == measured(t), t
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_bad_hosts_tighten_the_rules(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    noisy = clean + " #$%&*" * 3
    rows = [(i, clean, None, "good", None) for i in range(60)] + [(100, noisy, None, "good", None), (101, noisy, None, None, None)]
    rows += [(200 + i, noisy, None, "bad", None) for i in range(60)] + [(300, clean, None, "bad", None)]
    got = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[100]["kept"] and got[101]["kept"] and got[300]["kept"] and got[0]["kept"]
    assert not got[200]["kept"] and got[200]["host_bad"] and not got[200]["base_failed"]


def test_small_domains_are_drawn_towards_the_others(spark):
    rows = [(f"h{h}", d < 1 + h % 3) for h in range(20) for d in range(30)] + [("lone", True)] + [(None, True)]
    rotten = [("rotten", d > 5) for d in range(100)]
    verdicts = {r["host"]: r for r in judge_hosts(spark.createDataFrame(rows, "host string, fails boolean")).collect()}
    assert set(verdicts) == {f"h{h}" for h in range(20)} | {"lone"}
    assert not verdicts["lone"]["host_bad"] and 0.05 < verdicts["lone"]["shrunk_rate"] < 0.5
    verdicts = {r["host"]: r for r in judge_hosts(spark.createDataFrame(rows + rotten, "host string, fails boolean")).collect()}
    assert verdicts["rotten"]["host_bad"] and 0.8 < verdicts["rotten"]["shrunk_rate"] < 0.94
    assert judge_hosts(spark.createDataFrame([], "host string, fails boolean")).count() == 0
    same = judge_hosts(spark.createDataFrame([("a", True), ("b", True)], "host string, fails boolean")).collect()
    assert all(r["host_bad"] and r["shrunk_rate"] == 1.0 for r in same)


def test_quality_rules_on_repeated_rows_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a", None, None, None)] * 3 + [(None, None, None, None, None)], DOCS)
    assert [(r["doc_id"], r["kept"]) for r in quality_rules(docs).orderBy("doc_id").collect()] == [(None, False), (1, False), (1, False), (1, False)]
    assert quality_rules(docs.limit(0)).count() == 0


PAGE = """<html><head><title>x</title><style>p{}</style></head><body class="home post-12"><div id=menu><a href=/>Home</a></div>
<header><h1>Site</h1></header><div class="wrap"><div class="sidebar">side</div><div class="post-content"><h2>Title &amp; more</h2>
<p>One  <b>bold</b> text&nbsp;x<br>line<p>Two &lt;tag&gt;<ul><li>a<li>b</ul><div class="cookie-notice">no</div><table><tr><td>c1<td>c2</table>
<!-- <p>hidden</p> --><div class="comments"><p>bad comment</p></div><form><input value=1>q</form></div></div><footer>&copy;</footer>
<script>var a="</p><p>no</p>";</script></body></html>"""


def test_a_page_without_its_frame():
    blocks = parse(PAGE)
    points = score(blocks)
    best = max(points, key=points.get)
    assert best.endswith(">div.post-content")
    assert text_at(blocks, best)[0].split("\n") == ["Title & more", "One bold text x line", "Two <tag>", "a", "b", "c1", "c2"]
    assert parse("") == [] and parse("<p") == [] and parse("<div class=ad>x</div>") == []
    assert [t for _, t in parse("<article><p>cut <b>off")] == ["cut off"]
    assert [t for _, t in parse("a < b & c &amp; &#233;&eacute;")] == ["a < b & c & éé"]


def test_noise_words_in_the_name_of_the_article_do_not_empty_the_page(spark):
    long = "<h1>T</h1><p>" + "text " * 30 + "</p>"
    named = ["<div class='content has-sidebar'>", "<article class='post social-enabled'>", "<div class='elementor-widget-theme-post-content'>", "<div class='layout-with-sidebar'>"]
    side = "<div class='sidebar'><p>side</p></div><div class='post-comments'><p>bad comment</p></div>"
    rows = [(i, f"http://h{i}.example/x", f"<body><nav>menu</nav>{open_tag}{long}{side}</body>") for i, open_tag in enumerate(named)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 4 and all(r["text"] == "T\n" + ("text " * 30).strip() for r in got), got


def test_hosts_elect_a_path_and_pages_without_it_fall_back(spark):
    page = lambda inner: f"<body><nav>menu</nav>{inner}<footer>f</footer></body>"
    long = "<p>" + "text " * 30 + "</p>"
    rows = [(i, "http://a.example/x", page(f'<div class="box-{i}">{long}</div>')) for i in range(5)]
    rows += [(10, "http://A.example/y", page(f'<div class="box-77"><p>short</p></div><div class="other">{long}</div>'))]
    rows += [(11, "http://a.example/z", page("<article><p>own</p></article>")), (12, None, None), (13, "", ""), (14, "x", "<nav>only</nav>")]
    rows += [(15, None, "plain text")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    got = {r["page_id"]: r for r in extract_text(pages).collect()}
    assert got[10]["text"] == "short" and got[10]["path"].endswith("div.box-0")
    assert got[11]["text"] == "own" and got[15]["text"] == "plain text"
    assert [got[i]["text"] for i in (12, 13, 14)] == ["", "", ""] and got[12]["path"] is None
    assert extract_text(pages).count() == len(rows) and extract_text(pages.limit(0)).count() == 0


def test_the_whole_article_around_the_elected_container_is_kept(spark):
    long, links = "<p>" + "text " * 60 + "</p>", "<ul><li><a href=/a>other page</a></ul>"
    body = lambda inner: f"<body><nav>menu</nav>{inner}<footer>f</footer></body>"
    rows = [(i, "http://a.example/x", body(f"<article><h1>T{i}</h1><p>Lead.</p><div class=content>{long}</div>{links}</article>")) for i in range(6)]
    rows += [(10 + i, "http://a.example/y", body(f"<article><h1>S{i}</h1><div class=content><p>short</p></div></article><section class=story><h1>U</h1>{long}</section>")) for i in range(3)]
    rows += [(20, "http://b.example/", body(f"<main><h1>M</h1><div class=content>{long}</div></main>")), (21, "http://c.example/", body(f"<div class=page><h1>D</h1><div class=aside2>left</div><div class=content>{long}</div></div>"))]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = ("text " * 60).strip()
    assert all(got[i] == f"T{i}\nLead.\n{text}" for i in range(6)), got[0]
    assert all(got[10 + i] == f"U\n{text}" for i in range(3)), got[10]
    assert got[20] == f"M\n{text}" and got[21] == f"D\n{text}"


def test_given_rules_and_url_parts(spark):
    urls = [
        ("http://Blog.Example.NET/en/1?q#f", "blog.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.net", "example.net", "", None, "allow"),
        ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("https://x.example.com/de/?a", "x.example.com", "/de/", "example.com/de/", "block"),
        ("https://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
        ("https://a.org/fr/x", "a.org", "/fr/x", "org/fr/", "allow"),
        ("https://a.org?x=/fr/", "a.org", "", None, "allow"),
        ("no scheme/en/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u[0], "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in judge_urls(pages, labels).collect()}
    for i, u in enumerate(urls):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == u[1:], u


def test_mined_rules_match_all_token_sets(spark):
    from itertools import combinations

    rng = random.Random(8)
    rows = [(i, f"https://{rng.choice(['spam', 'good', 'mix'])}.{rng.choice(['a', 'b'])}.org/{rng.choice(['x', 'y'])}/{i}") for i in range(120)] + [(500, None)]
    bad = {i for i, u in rows if u and ("spam" in u or "mix.a" in u and "/x/" in u)}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = [(i, 0 if i in bad else 1, None) for i, _ in rows if i % 2] + [(None, 0, 1), (7, None, None)] + [(1, 0 if 1 in bad else 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    tokens = {r["page_id"]: set(r["t"]) for r in pages.select("page_id", url_tokens(F.col("url")).alias("t")).collect()}
    known = [i for i, _ in rows if i % 2]
    want = {}
    for size in range(1, 7):
        for i in known:
            for x in combinations(sorted(tokens[i]), size):
                if x not in want:
                    held = [k for k in known if tokens[k] >= set(x)]
                    hits = sum(k in bad for k in held)
                    if hits and hits / len(known) >= 0.05 and hits / len(held) >= 0.8:
                        want[x] = hits / len(held)
    got = {tuple(r["antecedent"]): r["confidence"] for r in mine_rules(pages, labels, 0.05, 0.8).collect()}
    assert {k for k in got if len(k) < 7} == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    verdict = {r["page_id"]: r["mined"] for r in judge_urls(pages, labels, (), 0.05, 0.8).collect()}
    assert verdict == {i: any(tokens[i] >= set(x) for x in got) for i, _ in rows}


def test_rules_of_chance_block_nothing(spark, monkeypatch):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abc") for _ in range(3))
    rows = [(i, f"https://{'casino' if i % 10 == 0 else word()}.{word()}.org/{word()}/{word()}") for i in range(1000)]
    labels = [(i, 0 if i % 10 == 0 or rng.random() < 0.2 else 1, None) for i, _ in rows if i % 2 == 0]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    tables = {"pages": pages, "labels": labels}
    monkeypatch.setattr(queries, "table", lambda _, __, name: tables[name])
    got = queries.op4_url_filters(spark, "").where("rule IS NULL").collect()
    assert len(got) == 1000 and {r["page_id"] for r in got if r["verdict"] == "block"} == {i for i, _ in rows if i % 10 == 0}


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def test_tokens_equal_the_library(spark, library):
    rng = random.Random(3)
    signs = "aAbB éÉßΣσςİıǅ'sdtvemrl0129²½٣ \t\n\r\x1c\x85 　​한글漢字ńńé<|>!!!...###\U0001f600ͅﬁ"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "a" * 20_000, "!" * 3000, "a<|endoftext|>b <|startoftext|>É<|endoftext|><|endoftext|>", "It's WE'LL don't I'M'd"] + ["twice"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("token_ids", F.lit("clash"))
    got = {r["doc_id"]: r for r in encode_decode(docs, vocabulary_path()).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["token_ids"] == ids and got[i]["decoded"] == library.decode(ids, skip_special_tokens=False), repr(t)
    assert encode_decode(docs.limit(0), vocabulary_path()).count() == 0


def test_round_trip_of_plain_words(spark):
    text = "some plain words and 1 2 3"
    row = encode_decode(spark.createDataFrame([(1, text)], "doc_id long, text string"), vocabulary_path()).first()
    assert unicodedata.normalize("NFC", row["decoded"].replace(" ", "").replace("</w>", " ").strip()) == text
