"""Page extraction and byte-level BPE."""

import hashlib
import random
import struct

import pytest

from quarrymill.llm import bpe
from quarrymill.llm.html_text import extract_text, main_text

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies &amp; such.</div>
<header><h2>Site</h2></header><article><h1>Head &eacute;</h1><p>First   <b>bold</b>
line<br>two<p>Second &lt;x&gt; &#8212; <i>end</i><form><input value="x">Name</form><div class="comments"><p>Reader says a lot of things here.</div></article>
<aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "Head é\nFirst bold line two\nSecond <x> — end"
    assert main_text(None) == main_text("") == main_text("<html><body><nav>x</nav></body></html>") == ""
    body = "This is a sentence of the body text. " * 6
    assert main_text(f"<div id=menu>a b c</div><div><p>{body}<p>Short.</div><div><a href=x>{body}</a></div>") == body.strip() + "\nShort."
    assert main_text("no tags < here & there &amp; so") == "no tags < here & there & so"
    assert main_text("<p>a<p>b<script>unclosed") == "a\nb"
    assert main_text("<div>" * 5000 + "deep " * 40 + "</div>" * 5000) == ("deep " * 40).strip()
    assert main_text('<p title="x>' + "y" * 50_000).endswith("y")


def test_extract_text(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (2, "u", ""), (3, None, "<p>" + "long text " * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract_text(df).select("page_id", "text").collect()
    assert sorted((r.page_id, len(r.text)) for r in got) == [(1, len(main_text(PAGE))), (2, 0), (2, 0), (3, 199_999)]
    clash = df.selectExpr("page_id", "html", "'old' AS text", "1 AS batch")
    assert "old" not in [r.text for r in extract_text(clash).collect()]
    assert extract_text(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed, n):
    rng = random.Random(seed)
    letters = "abcdeé ßñ  \t\n\r\x1c\x85\xa0　​1234'sTHE%*.,日本語ひ👍𝒳́٣Ⅳ²"
    for k in range(n):
        t = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 20, 200])))
        yield t.replace(" ", "") if k % 3 == 0 else t
    yield from ("a" * 3000, "ab" * 2000, "the" * 999, "éñ" * 500, " " * 700, "x'll" * 100, "<|endoftext|>")


def test_encoder_against_library(ranks, library):
    encoder = bpe.TextEncoder(ranks, public_tokenizers.PATTERN)
    many = list(texts(1, 600))
    for t, packed in zip(many, encoder.encode_many(many)):
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode_ordinary(t)
        assert encoder.decode(packed) == t.encode()


def test_tree_reduction(ranks):
    """Halving and joining gives what merging the whole piece gives."""
    rng = random.Random(3)
    plain, tree = bpe.PieceEncoder(ranks, leaf=1 << 30), bpe.PieceEncoder(ranks, leaf=3)
    for _ in range(300):
        piece = "".join(rng.choice(["th", "e", "ing", "a", "q", "é", "0", "%"]) for _ in range(rng.randint(1, 40))).encode()
        assert tree.encode(piece) == plain.greedy(piece)
        assert plain._greedy_long(piece) == plain.greedy(piece)


def test_round_trip(spark, library):
    rows = list(enumerate([None, "", *texts(2, 100)])) + [(0, "again"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'z' AS key", "1 AS ids")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = sorted(map(str, (tuple(r) for r in bpe.round_trip(df, path, public_tokenizers.PATTERN).collect())))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        expected.append(str((i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha((t or "").encode()))))
    assert got == sorted(expected)
    coded = bpe.encode_texts(df, path, public_tokenizers.PATTERN)
    back = bpe.decode_ids(coded, path).collect()
    assert sorted(bytes(r.data) for r in back) == sorted((t or "").encode() for _, t in rows)
    assert bpe.round_trip(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_noise_below_thousands_of_open_elements():
    text = "A sentence of the page that is long enough to be its main text, and goes on a little more. "
    page = "<html><body>" + "<b>" * 5000 + f"<p>{text}</p><nav>menu menu</nav><div hidden>secret</div><p>{text}</p>"
    got = main_text(page)
    assert got.count("A sentence") == 2 and "menu" not in got and "secret" not in got


def test_article_is_a_weight():
    text = "A sentence of the page that is long enough to be its main text, and goes on a little more. "
    card = "<article>Short card</article>"
    assert main_text(f"<html><body><div><p>{text * 3}</p><p>{text * 3}</p></div><div>{card}</div></body></html>").count("A sentence") == 6
    # short runs of a long article stay, and so does a long run beside it
    got = main_text(f"<body><article><p>{text * 3}</p><div>Short end.</div></article><div><p>{text * 2}</p></div><div>Short</div></body>")
    assert got.count("A sentence") == 5 and got.endswith("\n" + (text * 2).strip()) and "Short end." in got
    assert "Short card" not in main_text(f"<body><div><p>{text * 5}</p></div>{card}</body>")
