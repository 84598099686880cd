import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strandwork.llm import html_content as H

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


LONG = "Some words that make a paragraph of the story, with commas, and it goes on for a while. " * 3


def test_model_on_pages_it_has_not_seen():
    model, trees = H.default_model(), [H.Tree(p, marks=True) for p in H.labelled_pages(150, seed=321)]
    f = H.Forest.of(trees)
    y = np.array([x for t in trees for x in t.label])
    for level in f.levels:
        y[level] = np.where(y[level] >= 0, y[level], np.where(f.parent[level] >= 0, np.maximum(y[f.parent[level]], 0), 0))
    leaf = f.tag == 0
    assert ((model.marginals(f)[0] > 0.5) == y)[leaf].mean() > 0.98


def test_messages_give_exact_marginals():
    """Against the sum over all labellings of a small tree."""
    r = np.random.default_rng(5)
    f = H.Forest.of([H.Tree("<div><p>a <b>b</b></p><nav>c</nav></div>")])
    m = H.Model(r.normal(size=len(H.TAGS)), r.normal(size=H.N_KINDS), r.normal(size=(2, H.FIGURES)), r.normal(size=(H.EDGES, 2, 2)))
    own = m.tag[f.tag] + m.kind[f.kind] + (f.figures * m.figures[(f.tag != 0).astype(int)]).sum(1)
    n = len(f.tag)
    total, ones = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = [(code >> k) & 1 for k in range(n)]
        w = np.exp(sum(own[k] * y[k] for k in range(n)) + sum(m.pair[f.edge[k], y[f.parent[k]], y[k]] for k in range(n) if f.parent[k] >= 0))
        total += w
        ones += w * np.array(y)
    assert np.allclose(m.marginals(f)[0], ones / total)


def test_main_text(spark):
    bodies = [
        f"<nav><ul><li><a href=/a>Home</a></li></ul></nav><div class='ad'>Buy this now please.</div><article><h1>Head &amp; line</h1><p>{LONG}</p><p>Two&nbsp;\n  <b>bold</b>er</p></article><footer>&copy; us</footer>",
        f"<header><h1>Site</h1></header><div id=cookie-notice><p>We use cookies here.</p></div><main><p>{LONG}<p>next one</main><aside><p>Related things</p></aside><div class='comments'><p>I liked it, thanks for the text.</p></div>",
        "<article><p>Short.</p></article><form><label>Name</label><input></form><script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> -->",
    ]
    rows = [(k, "u", page(b), "x", "y") for k, b in enumerate(bodies)] + [(10, None, None, "x", "y"), (11, "u", "", "x", "y"), (11, "u", "", "x", "y"), (12, "u", "<p", "x", "y"), (13, "u", page("<article>" + f"<p>{LONG}</p>" * 4000 + "</article>"), "x", "y")]
    got = {r["page_id"]: r for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    line = " ".join(LONG.split())
    assert got[0]["text"] == f"Head & line\n{line}\nTwo bolder"
    assert got[1]["text"] == f"{line}\nnext one"
    assert got[2]["text"] == "Short." and got[2]["n_chars"] == 6
    assert got[10]["text"] == "" and got[11]["text"] == "" and got[12]["n_chars"] == 0
    assert got[13]["text"] == "\n".join([line] * 4000)
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0 and len(H.extract(spark.createDataFrame(rows, SCHEMA)).collect()) == len(rows)


def read(source):
    return " ".join("".join(H.Tree(source).text).split())


def test_dropped_elements_left_open():
    body = f"<article><h1>Head</h1><p>{LONG}</p></article>"
    want = "Head " + " ".join(LONG.split())
    for head in ("<head><title>T</title><meta charset=x>", "<head><script>var a = '<head>';</script></head>", "<head><script>var a = '<head>';</script>", "<head><noscript><style>p{}</style>", "<head><noscript><img src=a></noscript><link href=a>"):
        got = H.main_texts([f"<!DOCTYPE html><html>{head}<body>{body}</body></html>", f"<html>{head}{body}"], H.default_model())
        assert [" ".join(x.split()) for x in got] == [want, want], head
    assert read("<head><title>T</title>words first<p>more") == "words firstmore"
    for kind in ("svg", "select", "video", "audio", "datalist"):
        assert read(f"<body><div>a <{kind}>no</div><p>b</p>") == "a b", kind
        assert read(f"<body><div>a <{kind}><g>no</g></{kind}> b</div>") == "a b", kind
    assert read("<ul><li>a <video>no<li> b</ul>") == "a b"
    assert read("<div>a<audio><div>no</div><p>no</p></audio> b</div>") == "a b"
    assert read("<p>a <svg><path d=x><p>b") == "a b" and read("<svg><title/><g/></svg>b") == "b"
    assert read("<svg><foreignObject><div>no</div></foreignObject></svg>b") == "b"


def test_attributes_are_read_whole():
    far = "data-json='{\"a\": \"" + "x class=article hidden " * 500 + "\"}' style=\"background:url(data:image/png;base64," + "A" * 9000 + ')"'
    kinds = {w: k + 1 for k, (w, _) in enumerate(H.KINDS)}
    for text, kind in ((f' {far} class="comments"', "comment"), (f" {far} id='sidebar'", "side"), (f" {far} hidden", "hidden"), (f" {far} class=article", "content"), (" title='is hidden now' class=nav", "menu")):
        assert H.Tree(f"<div{text}>a</div>").kind[1] == kinds[kind], text[-30:]
    assert H.Tree(f"<div {far}>a</div>").kind[1] == 0


def test_formulas_and_fallback_text_stay():
    page_ = page(f"<article><p>{LONG}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> hold.</p><noscript><p>{LONG}</p></noscript><object><p>{LONG}</p></object></article>")
    line = " ".join(LONG.split())
    assert H.main_texts([page_], H.default_model()) == [f"{line}\nLet x=1 hold.\n{line}\n{line}"]


def test_marks_of_training_pages_mean_nothing_on_others():
    body = f"<article><h1>Head</h1><p>{LONG}</p></article>"
    plain = H.main_texts([page(body)], H.default_model())
    for mark in ("data-y", "data-y=high", "data-y='1.5'", "data-y=0", 'data-y="0"'):
        assert H.main_texts([page(body.replace("<article", f"<article {mark}"))], H.default_model()) == plain
    assert H.Tree('<p data-y="1">a', marks=True).label == [-1, 1, -1] and H.Tree('<p data-y="1">a').label == [-1, -1, -1]


PIECES = ["<p>", "</p>", "<div class=x>", "</div>", "<b", ">", "<li>", "<ul>", "</ul>", "<table><tr><td>", "<svg>", "</svg>", "<head>", "<body>", "<select>", "<option>", "<script>", "</script>", "<!--", "-->", "&amp;", "&#x;", "&#99999999;", "words here, yes", "\x00", '"', "'", "<a href='", "data-y=", "hidden", "<math><mi>", "<noscript>", "</", "<", "<!", "é", "\n"]


@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=5)), max_size=60).map("".join))
@settings(max_examples=300, deadline=None)
def test_no_page_raises(source):
    got = H.main_texts([source, page(f"<article><p>{LONG}</p></article>")], H.default_model())
    assert got[1] == " ".join(LONG.split()) and "  " not in got[0]


def test_work_does_not_grow_with_depth():
    def seconds(n):
        deep = page("<div>" * n + f"<article><p>{LONG}</p></article>" + "</div>" * n)
        began = time.perf_counter()
        H.main_texts([deep], H.default_model())
        return time.perf_counter() - began

    H.default_model()
    short = min(seconds(2000) for _ in range(3))
    assert seconds(16000) < 24 * short


def nested(t):
    """Blocks of a page by walking the tree node by node."""
    children = {}
    for k, p in enumerate(t.parent):
        if k:
            children.setdefault(p, []).append(k)
    out = []

    def walk(k):
        if t.tag[k] == 0:
            out.append((t.block[k], t.text[k]))
        for c in children.get(k, ()):
            walk(c)

    walk(0)
    return out


def test_trees_and_blocks_against_a_walk():
    """All text that a page shows is in its tree, in page order, and main_texts joins it by block (potentials that keep all)."""
    keep = H.Model.blank()
    keep.figures[:, 0] = 50
    for source in H.labelled_pages(40, seed=99):
        lines = {}
        for block, text in nested(H.Tree(source)):
            lines[block] = lines.get(block, "") + text
        wanted = "\n".join(x for x in (" ".join(v.split()) for v in lines.values()) if x)
        assert H.main_texts([source], keep) == [wanted]


def test_raw_text_is_never_read_as_tags():
    line = " ".join(LONG.split())
    for script in ("for(i=0;i<n && ok;i++){} // don't stop", "if (a<b) x = \"", "a<b='", "</scrip t> <p class='", "document.write('<p>no</p>')"):
        for raw in ("script", "style"):
            got = H.main_texts([page(f"<{raw}>{script}</{raw}><article><h1>Head</h1><p>{LONG} It's good.</p></article>")], H.default_model())
            assert got == [f"Head\n{line} It's good."], script
    assert read("<script>a</script foo=1>b") == "b" and read("<textarea><p>no</textarea>b") == "b"


def test_quotes_count_after_an_equals_sign_only():
    assert read("<p class=a don't>one</p><p>it's</p>") == "oneit's"
    assert read("<p title=\"a > b\" data-x='c>d'>one</p>") == "one" and read("<p title = 'a>'>one") == "one"
    assert read('<p title="a>one</p><p>two</p>') == "onetwo"  # no quote ends it


def test_pages_without_elements_are_their_own_text():
    got = H.main_texts(["Just words, a < b & c.\nNext", "&lt;p&gt;", "a<script>no</script> b", "cut off <a href='http", "<!-- no -->  "], H.default_model())
    assert got == ["Just words, a < b & c. Next", "<p>", "a b", "cut off", ""]


def test_class_words_are_whole_or_compounds():
    kinds = {w: k + 1 for k, (w, _) in enumerate(H.KINDS)}
    for word, kind in (("commentary", 0), ("comments", "comment"), ("commentlist", "comment"), ("sidebar-left", "side"), ("sidebarleft", "side"), ("headers", "header"), ("storyline", 0), ("formation", 0)):
        assert H.kind_of(word) == (kinds[kind] if kind else 0), word
    assert H.main_texts([page(f'<div class="story commentary"><h1>Head</h1><p>{LONG}</p></div>')], H.default_model())[0].endswith(" ".join(LONG.split()))


def test_reading_is_linear():
    """A megabyte of openings, quotes and unended tags."""
    for piece in ("<b ", "<b", "<b a=\"", "<b a='>", "<a =\"><a ='>", "<!", "<!-", "</script ", "<script>", "<p>", "\"'<", "<a =\"<a >\" "):
        source = piece * (1_000_000 // len(piece))
        began = time.perf_counter()
        scanner, at = H.Scanner(source), 0
        while found := scanner.next(at):
            at = found[1]
        assert time.perf_counter() - began < 3, piece
    began = time.perf_counter()
    H.Tree("<b " * 330_000)
    assert time.perf_counter() - began < 1
