"""BPE, HTML and URLs: exact round trips, hand-written pages, brute force."""

import base64
import hashlib
import random
import struct
import time
from html.parser import HTMLParser

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ratecal.llm import bpe, extract, queries, urls

SF = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    random.seed(4)
    signs = "abcdefghij ABC  \n\t'sdtrevml0123..,!?-_éüñß漢字🙂 ́\x00\x1c\x85　"
    made = ["".join(random.choice(signs) for _ in range(random.randint(0, 80))) for _ in range(400)]
    return [*made, "", "<|endoftext|>", "a" * 5000, " " * 3000, "the cat " * 9000, "🙂" * 400, "don't  we'll I'M"]


def test_ids_equal_tiktoken(reference):
    texts = odd_texts()
    assert [x.tolist() for x in bpe.encode_texts(texts, PATH, PATTERN)] == [reference.encode_ordinary(t) for t in texts]
    # without cuts at blanks, and again from memory
    for cut in (None, bpe.CUT):
        assert [x.tolist() for x in bpe.encode_texts(texts, PATH, PATTERN, cut)] == [reference.encode_ordinary(t) for t in texts]


def test_forgotten_pieces_are_encoded_again(monkeypatch, reference):
    monkeypatch.setattr(bpe, "KEPT", 5)
    texts = odd_texts()[:50]
    for t in texts:
        assert bpe.encode_texts([t], PATH, PATTERN)[0].tolist() == reference.encode_ordinary(t)


def test_spans_cover_split_characters(spark):
    docs = spark.createDataFrame([(1, "I ate 漢🙂 pie"), (2, ""), (3, None)], "doc_id long, text string")
    coded = bpe.encode(docs, PATH, PATTERN, spans=True)
    rows = {r.doc_id: r for r in coded.collect()}
    text = rows[1].text
    assert rows[1].starts[0] == 0 and rows[1].stops[-1] == len(text)
    split = [(a, b) for a, b in zip(rows[1].starts, rows[1].stops) if text[a:b] in ("漢", "🙂")]
    assert len(split) > 2  # several tokens for one character
    assert rows[2].ids == [] and rows[3].ids == []
    back = {r.doc_id: r.text for r in bpe.decode(coded.drop("text"), PATH, PATTERN).collect()}
    assert back == {1: text, 2: "", 3: ""}
    cut = bpe.decode(coded.filter("doc_id = 1").withColumn("ids", F.slice("ids", 1, 4)), PATH, PATTERN).first().text
    assert "�" in cut
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH, PATTERN).first().text is None


def test_digests(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(100)
    docs = docs.union(spark.createDataFrame([(None, "x"), (-1, None), (-2, ""), (0, "again")], docs.schema))
    docs = docs.withColumns({"n_tokens": F.lit("clash"), "ids": F.lit(1)})
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    expected = []
    for i, t in texts:
        ids = reference.encode_ordinary(t)
        expected.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    key = str
    assert sorted(map(tuple, bpe.digests(docs, PATH, PATTERN).collect()), key=key) == sorted(expected, key=key)
    assert bpe.digests(docs.limit(0), PATH, PATTERN).collect() == []


# --- HTML ------------------------------------------------------------------------------------

LONG = "The house that we saw was on the hill and there was nothing at all to be seen from it but the sea. " * 3


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("<p>", ""), ("no tags at all", ""),
        (f"<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{LONG}<p>Of.</article><footer>&copy; me</footer>", "Title " + LONG + "Of."),
        (f"<article><p>A &lt;b&gt; &amp; c&eacute; &#8212; {LONG}</p><script>var t='</p>';</script></article>", "A <b> & cé — " + LONG.strip()),
        (f"<body><div id=cookie-notice>We use the cookies of all the others and so on and on.</div><p>{LONG}</p><div class='comments'><p>{LONG}</p></div>", LONG.strip()),
        (f"<article><p>{LONG}</p><aside>{LONG}</aside><form><p>{LONG}</p></form><p>End.</p></article>", LONG + "End."),
        (f"<p>{LONG}</p><p>It was so.</p><p>{LONG}</p><p><a href=a>one of the links</a> <a href=b>and the other</a></p>", LONG + "It was so. " + LONG.strip()),
        ("<article><p>a<b>b</b>c\n\n d<br>e</p></article>", "abc d e"),
        (f"<!-- <p>{LONG}</p> --><style>p{{}}</style><article>x</article>", "x"),
        ("<article>unclosed <b>bold", "unclosed bold"),
        ("<article>1 < 2 & 3 > 2</article>", "1 < 2 & 3 > 2"),
    ],
)
def test_pages(page, text):
    assert extract.main_text(page) == " ".join(text.split())


POLISH = "Dom, który widzieliśmy wczoraj, stał na wzgórzu nad morzem i nie było z niego widać niczego poza wodą oraz ciemnym niebem. " * 3
CHINESE = "我们昨天看到的房子在山上，从那里除了大海什么也看不见。天空很暗，风很大，没有人说话。" * 4


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<article><p data-t=it's>{LONG}</p><p>{LONG}</p></article>", LONG + LONG),
        (f"<article><p>{LONG}<svg class=i/>{LONG}</p><p>{LONG}</p></article>", LONG * 3),
        (f"<article><p>{LONG}</p><p>One <button>Buy</p><p>{LONG}</p></article>", LONG + "One " + LONG),
        (f"<article><p>{LONG}<button>Buy</button></p></article><footer>{LONG}</footer>", LONG),
        (f'<div class="post tag-economy"><p>{LONG}</p></div>', LONG), (f'<section class="search-result-page"><p>{LONG}</p></section>', LONG),
        (f'<div class="widget"><p>{LONG}</p><p>{LONG}</p></div>', LONG + LONG), (f'<body class="has-sidebar"><p>{LONG}</p><div id="sidebarLeft"><p>{LONG}</p></div>', LONG),
        (f'<main><article><p>{LONG}</p></article><article class="comment"><p>{LONG}</p></article></main>', LONG),
        (f'<p>{POLISH}</p><ul><li><a href=x>Strona</a></li></ul>', POLISH), (f"<div><p>{CHINESE}</p></div><a href=x>首页</a>", CHINESE),
        (f"<article><p title='a > b' x=\"<p>\">{LONG}</p></article>", LONG), (f"<article>{LONG}<a href=x", LONG + "<a href=x"),
        (f"<title>t</title><script>if (a</b) '</p>'</script><article>{LONG}</article>", LONG),
    ],
)
def test_articles_are_kept_whole(page, text):
    assert extract.main_text(page) == " ".join(text.split())


@pytest.mark.parametrize("piece", ['<a "', "<a '", '<a x="', "<p>", "<div><b>", "</b>", "<!", "<!--", "<b><div>x</b>", "<", "&", "<a <", "<p>a<br>", "<svg/>", "<button>"])
def test_time_follows_the_length(piece):
    start = time.time()
    extract.main_text(piece * 40_000)
    assert time.time() - start < 6, piece


class Tree(HTMLParser):
    """The plain reference: text of the only article, by an HTML parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skipped, self.pieces = 0, 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.skipped += tag in ("script", "style", "nav", "aside")
        if tag in extract.BLOCKS:
            self.pieces.append(" ")

    def handle_endtag(self, tag):
        if tag in extract.BLOCKS:
            self.pieces.append(" ")
        self.inside -= tag == "article"
        self.skipped -= tag in ("script", "style", "nav", "aside")

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.pieces.append(data)


def test_generated_pages_as_by_a_parser():
    random.seed(8)
    sentences = ["It was one of the houses that we saw.", "A &lt;b&gt; &amp; caf&eacute; on the hill.", "Why is <b>that</b> so, and <i class=it's>who</i> said it?", "x &#8212; y and z of it."]
    for _ in range(300):
        body = ""
        for _ in range(random.randrange(1, 9)):
            text = " ".join(random.choice(sentences) for _ in range(random.randrange(1, 9)))
            body += random.choice([
                "<p>{}</p>", "<p class='a b' data-x=\"1 > 2\">{}</p>", "<div><p>{}</p></div>", "<blockquote>{}</blockquote>", "<h2>{}</h2>\n",
                "<ul><li>{}</li></ul>", "<script>var t='</p><p>';</script><p>{}</p>", "<p>{}<br>", "<!-- <p>no</p> --><p>{}</p>", "<aside><p>{}</p></aside><p>End of it.</p>",
            ]).format(text)
        page = f"<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article>{body}</article><footer>{sentences[0]}</footer>"
        tree = Tree()
        tree.feed(page)
        assert extract.main_text(page) == " ".join("".join(tree.pieces).split())


def test_ambiguous_blocks_follow_their_neighbours():
    def block(text, zone="", tag="p"):
        return extract.Block(text, 0, tag, zone, 0)

    good, bad, short = block(LONG), block("x " * 60), block("So it goes.")
    assert extract.classify([good, short, good]) == [True, True, True]
    assert extract.classify([bad, short, bad]) == [False, False, False]
    assert extract.classify([bad, short, good]) == [False, False, True]
    assert extract.classify([bad, block("So it goes.", tag="h2"), good]) == [False, True, True]
    assert extract.classify([short]) == [False] and extract.classify([]) == []


def test_extract_whole_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.lit(1))
    found = extract.extract(pages).toPandas()
    assert len(found) == pages.count() and (found["n_chars"] == found["text"].str.len()).all()
    assert not found["text"].str.contains("var t=|&copy;|©").any() and (found["n_chars"] > 0).mean() > 0.99
    odd = spark.createDataFrame([(None, None, None), (1, "u", "<article>" + "word " * 100_000), (1, "u", "<article>a</article>")], pages.drop("text").schema)
    assert sorted(r.n_chars for r in extract.extract(odd).collect()) == [0, 1, 499_999]
    assert extract.extract(odd.limit(0)).collect() == []


# --- URLs --------------------------------------------------------------------------------------


def slow_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for verdict, h, p in queries.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, *(best or (None, None))


URLS = [
    None, "", "example.com/en/", "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/1", "https://m.www.example.com/en/1",
    "http://badexample.com/en/", "http://example.com/EN/", "http://example.com", "http://a.net/es/", "http://net/fr/x", "http://a.net?x=/es/",
    "ftp://a.org/b\nc", "://", "http://x.org/://y.net/es/", "http://user@a.net/es/",
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(URLS)], "page_id long, url string, html string, rule string")
    for r in urls.judge(pages, queries.RULES).collect():
        host, path, rule, verdict = slow_rule(URLS[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_blocks_reach_aliases(spark):
    canonical = '<link rel="canonical" href="{}">'.format
    pages = [
        (1, "http://a.org/start", '<meta http-equiv="refresh" content="0; url=http://b.org/next?a=1&amp;b=2">'),
        (2, "http://b.org/next?a=1&b=2", canonical("//c.org/last")),
        (3, "http://C.org/last#part", canonical("http://x.net/es/page")),  # blocked by a rule, four steps from 1
        (4, "http://www.example.com/en/q", canonical("http://a.org/start")),  # its own rule allows it
        (5, "http://d.org/", canonical("/other")), (6, "http://d.org/other", None),
        (7, "http://e.org/x", None), (7, "http://e.org/x", None), (8, "http://f.org/x", canonical("http://f.org/x")),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    log = spark.createDataFrame([("http://e.org/x", "http://b.org/next?a=1&b=2"), (None, "u"), ("u", None)], "url string, target string")
    without = {r.page_id: r.verdict for r in urls.judge(frame, queries.RULES).collect()}
    assert without == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow"}
    found = urls.judge(frame, queries.RULES, log).collect()
    assert len(found) == len(pages) and [r.verdict for r in found if r.page_id == 7] == ["block", "block"]
    assert urls.judge(frame.limit(0), queries.RULES).collect() == []


def test_links_are_read_as_a_browser_does(spark):
    canonical = '<link rel="canonical" href="{}">'.format
    blocked = canonical("http://x.net/es/page")
    pages = [
        (1, "http://a.org/1", f"<!-- {blocked} -->"), (2, "http://a.org/2", f"<script>var s = '{blocked}'</script><p>x"),
        (3, "http://a.org/3", f"<p><!-- {blocked}"), (4, "http://a.org/4", f"<!-- a --><script>1</script>{blocked}<!-- b -->"),
        (5, "http://x.net/a/b/c", canonical("../../es")), (6, "http://x.net/a/b/d", canonical("../es/x")),
        (7, "http://x.net/a/e", canonical("../../../es/./y?q=../z")), (8, "http://b.org/f", '<base href="http://x.net/fr/g">' + canonical("h")),
        (9, "http://x.net/i/j", '<base href="../k/">' + canonical("../fr/.")), (10, "http://b.org/l", canonical("http://x.net/en/../es/m")),
        (11, "http://b.org/n", canonical("http://x.net/en/a..b/es/")), (12, None, blocked), (13, "none", blocked), (14, "http://b.org/o", None),
        (None, "http://x.net/es/p", None),
    ]
    # x.net/es has no slash behind it, so no rule fits and it is only blocked as an alias of its own
    more = spark.createDataFrame([("http://x.net/es", "http://x.net/es/")], "url string, target string")
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.verdict for r in urls.judge(frame, queries.RULES, more).collect()}
    assert len(found) == len(pages) and {k for k, v in found.items() if v == "block"} == {4, 5, 7, 8, 9, 10, None}
    ends = {r.url[-3:]: r.target for r in urls.links(frame).collect()}
    assert ends["b/c"] == "http://x.net/es" and ends["a/e"] == "http://x.net/es/y?q=../z" and ends["i/j"] == "http://x.net/fr/"
    assert ends["b/d"] == "http://x.net/a/es/x" and ends["g/f"] == "http://x.net/fr/h" and ends["g/n"] == "http://x.net/en/a..b/es/"
