import random

import pytest

from evenkeel.llm import extraction

SCHEMA = "page_id long, url string, html string, host string, main string"


def texts(spark, rows):
    frame = spark.createDataFrame([(*row, "h", "m") for row in rows], SCHEMA)
    out = extraction.extract(frame)
    assert out.columns == [*frame.columns, "text"]
    return {row.page_id: row.text for row in out.collect()}


def words(rng, count):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "épsilon", "zeta"]) + str(rng.randrange(90)) for _ in range(count))


def test_marked_articles(spark):
    rng = random.Random(1)
    rows, wanted = [], {}
    for n in range(30):
        title, parts = words(rng, 4), [words(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        body = "".join(f"<p><b>{p}<br>" if rng.random() < 0.3 else f"<p class=x>{p}</p>" for p in parts)
        html = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
          <header><h2>Site {n}</h2></header><nav><ul><li><a href="/">Home {n}</a></li><li><a href="/b">B</a></li></ul></nav>
          <div class="ad">buy {words(rng, 5)}</div><div id="cookie-notice">We use {n} cookies</div>
          <article><header><h1>{title}</h1><p class="byline">by {n}</p></header>{body}<aside>see {n}</aside><form><label>Mail {n}</label><input></form>
          <div class="share-buttons">Share {n}</div><section class="comments"><p>first! {n}</p></section></article>
          <footer>&copy; {n}</footer></body></html>"""
        rows.append((n, f"http://a.example/{n}", html))
        wanted[n] = "\n\n".join([title, *parts])
    assert texts(spark, rows) == wanted


def test_unmarked_pages_of_a_host(spark):
    rng = random.Random(2)
    rows, wanted = [], {}
    for n in range(25):
        parts = [words(rng, rng.randint(20, 60)) for _ in range(rng.randint(1, 5))]
        html = f"""<body><div class=top>Always the same slogan</div><div class="c1"><ul>{"".join(f'<li><a href="{x}">link {x} {n}</a>' for x in range(rng.randint(2, 6)))}</ul></div>
          <div class="c2">{"".join(f"<p>{p}</p>" for p in parts)}</div><div class="c3">Call us now, always</div></body>"""
        rows.append((n, f"https://user@b.example:80/x{n}?q", html))
        wanted[n] = "\n\n".join(parts)
    assert texts(spark, rows) == wanted


def test_references_white_space_and_cut_pages(spark):
    article = "<body><article><p>a&amp;b &lt;i&gt; &#233;&nbsp; x\n\t y</p><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>"
    rows = [
        (1, "http://c.example/1", article + "<p>1 < 2 &am"),
        (2, "http://c.example/2", article + "<p>end</p><a href=\"cut"),
        (3, "http://c.example/3", article + "<!-- open <p>no</p>"),
        (4, "http://c.example/4", article + "<script>x='<p>no</p>'"),
        (5, "http://c.example/5", article.upper().replace("&AMP;", "&amp;").replace("&LT;", "&lt;").replace("&GT;", "&gt;").replace("&NBSP;", " ")),
    ]
    base = "a&b <i> é x y\n\none\n\ntwo\n\nc1\n\nc2"
    assert texts(spark, rows) == {1: base + "\n\n1 < 2 &am", 2: base + "\n\nend", 3: base, 4: base, 5: "A&B <I> é X Y\n\nONE\n\nTWO\n\nC1\n\nC2"}


def test_edge_cases(spark):
    long = "<article>" + "<p>word</p>" * 30_000
    rows = [(1, None, None), (2, "", ""), (None, "no url", "<p>alone</p>"), (4, "http://d.example", long), (5, "http://d.example", long), (6, None, "plain text")]
    out = texts(spark, rows)
    assert out[1] == out[2] == "" and out[4] == out[5] == "\n\n".join(["word"] * 30_000) and out[None] == "alone"
    assert texts(spark, []) == {}


def test_a_page_of_a_host_is_not_boilerplate_because_it_is_copied(spark):
    html = "<body><article><p>the same text on many pages</p></article></body>"
    assert set(texts(spark, [(n, "http://e.example/", html) for n in range(20)]).values()) == {"the same text on many pages"}


@pytest.mark.parametrize("seed", range(5))
def test_wrapper_accepts_every_page_it_was_made_of(seed):
    rng = random.Random(seed)

    def page():
        items = "".join("<li>x</li>" for _ in range(rng.randint(1, 5)))
        middle = rng.choice(["", "<div class='ad'>ad</div>", "<blockquote>q</blockquote>"])
        return f"<body><ul>{items}</ul>{middle}<div>{'<p>t</p>' * rng.randint(1, 4)}</div></body>"

    streams = [extraction.fold(extraction.parse(page())[0]) for _ in range(12)]
    wrapper = [(token, False) for token in streams[0]]
    for stream in streams[1:]:
        wrapper = extraction.align(wrapper, [(token, False) for token in stream])
    assert all(extraction.accepts(wrapper, stream) for stream in streams)
    assert "(<p> # </p>)+" in extraction.to_regex(wrapper) and ")?" in extraction.to_regex(wrapper)


def test_fold():
    assert extraction.fold("a b a b a b c".split()) == ["(a b)+", "c"]
    assert extraction.fold("u l t /l l t /l /u p p p".split()) == ["u", "(l t /l)+", "/u", "(p)+"]
    assert extraction.fold([]) == []


def test_templates_of_a_host_are_judged_apart(spark):
    rng = random.Random(3)
    rows, wanted = [], {}
    frames = ["<article><p>{}</p></article>", "<main><p>{}</p></main>", "<div class='post'><p>{}</p></div>", "<div class='c'><p>{}</p></div>", "<table><tr><td>{}</table>"]
    for n in range(60):
        body = words(rng, 200 if n % 5 == 3 else 20)
        rows.append((n, None if n < 30 else "http://f.example/x", f"<body><nav>menu {n}</nav>{frames[n % 5].format(body)}<div class=z>Always the same</div></body>"))
        wanted[n] = body
    assert texts(spark, rows) == wanted


def test_slots_of_one_path_are_told_apart_by_the_wrapper(spark):
    rng = random.Random(4)
    rows, wanted = [], {}
    for n in range(20):
        parts = [words(rng, 30), words(rng, 30)]
        optional = "<blockquote>quoted</blockquote>" if n % 2 else ""
        rows.append((n, "http://g.example/x", f"<body><div>Always the same slogan</div><h3>Top</h3>{optional}<div>{parts[0]}</div><hr><h2>Call us</h2><div>{parts[1]}</div></body>"))
        wanted[n] = "\n\n".join(parts)
    assert texts(spark, rows) == wanted


def test_streams_aligned_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(extraction, "FAN", 2)
    rng = random.Random(5)
    rows, wanted = [], {}
    for n in range(40):
        kinds = rng.choices(["p", "h2", "blockquote", "pre"], k=rng.randint(1, 9))
        parts = [words(rng, 12) for _ in kinds]
        rows.append((n, "http://h.example/x", "<body><article>" + "".join(f"<{k}>{p}</{k}>" for k, p in zip(kinds, parts)) + "</article></body>"))
        wanted[n] = "\n\n".join(parts)
    assert texts(spark, rows) == wanted


@pytest.mark.parametrize("seed", range(20))
def test_every_stream_matches_a_merged_wrapper(seed):
    rng = random.Random(seed)

    def page():
        kinds = rng.choices(["<p>x</p>", "<h2>x</h2>", "<ul><li>x<li>x</ul>", "<ul><li>x</ul>", "<div><p>x</p></div>", "x"], k=rng.randint(0, 9))
        return extraction.Page("<body>" + "".join(kinds) + "</body>").stream

    streams = [page() for _ in range(24)]
    parts = [extraction._aligned(streams[at : at + 6]) for at in range(0, 24, 6)]
    wrapper = extraction._wrapper(extraction._aligned(parts))
    for stream in streams:
        tokens = stream.split("\n")
        numbers = extraction.match_slots(wrapper, tokens)
        assert extraction.accepts(wrapper, tokens) and numbers == sorted(set(numbers))
        assert len(numbers) == sum(extraction._slot_count(token) for token in tokens)
    assert extraction.match_slots([("<p>", False)], ["<div>"]) is None


def test_folded_slots_keep_their_blocks():
    page = extraction.Page("<ul><li>a<li>b<li>c</ul><p>d</p><ul><li>e</ul>")
    assert [text for text, _ in page.blocks] == list("abcde") and page.places == [0, 0, 0, 1, 2]


@pytest.mark.parametrize(("html", "texts"), [
    ("<article><p>first</p><div><button>Go<p>inside</p></div><p>second</p></article><p>third</p>", ["first", "second", "third"]),
    ("<article><p>one <select><option>a</p><p>two</p></article>", ["one ", "two"]),
    ("<div><button>Go<div><p>inside</div> still inside</button><p>after</div>", ["after"]),
    ("<div><video><p>no<object><p>no</div><p>after", ["after"]),
])
def test_hidden_elements_end_with_the_block_around_them(html, texts):
    assert ["".join(block.pieces) for block in extraction._read(html)[1]] == texts
