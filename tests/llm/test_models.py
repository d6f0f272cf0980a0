"""Models and the remaining operators: held-out accuracy, brute force, round trips."""

import hashlib
import tracemalloc

import numpy as np
import pytest

from millrace.llm import chat_format, embedding_dedup, html_extract, toxicity

SF = "/root/testdata/sf0.1"


# --- toxicity ------------------------------------------------------------------------


def test_chain_finds_held_out_toxic_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = labels.filter("doc_id % 3 <> 0")
    got = {r.doc_id: r for r in toxicity.classify(docs, train).collect()}
    assert len(got) == docs.count()
    held = [(r.toxic, got[r.doc_id].toxic) for r in labels.filter("doc_id % 3 = 0").collect()]
    caught = sum(1 for y, p in held if y and p) / sum(y for y, _ in held)
    assert caught >= 0.95 and sum(1 for y, p in held if p and not y) <= 2


def test_chain_feeds_earlier_probabilities():
    r = np.random.default_rng(0)
    x = r.normal(size=(800, 6))
    first = (x[:, 0] + 0.3 * r.normal(size=800) > 0).astype(float)
    second = ((first == 1) & (x[:, 1] > 0)).astype(float)
    y = np.column_stack([first, second])
    y[::50, 1] = np.nan
    weights, cuts, out = toxicity.fit_chain_arrays(x, y, np.arange(800) % 5)
    assert weights[0].shape == (7,) and weights[1].shape == (8,) and weights[1][6] > 0.5
    # What the second model was given are predictions of models that had not seen the row.
    inside = toxicity._predict(x, weights[0])
    assert not np.allclose(inside, out[:, 0]) and np.corrcoef(inside, out[:, 0])[0, 1] > 0.99


def test_fit_holds_no_second_matrix():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 300))
    y = np.stack([x[:, 0] > 0, x[:, 1] + x[:, 2] > 1], axis=1).astype(float)
    tracemalloc.start()
    try:
        toxicity.fit_chain_arrays(x, y, np.arange(6000) % 5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < x.nbytes


def test_chain_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, 0), (5, None, 1), (None, 1, 1), (7, 0, None)], "doc_id bigint, quality int, toxic int")
    assert toxicity.classify(odd, labels).count() == odd.count()
    nothing = toxicity.classify(odd, labels.limit(0)).collect()
    assert not any(r.toxic for r in nothing)
    assert toxicity.classify(none, labels).count() == 0


# --- pages ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trees():
    return html_extract.train()


def test_held_out_pages(trees):
    r, wrong, runs = np.random.default_rng(77), 0, 0
    for _ in range(150):
        page = html_extract.parse(html_extract.generated_page(r))
        kept = html_extract.decode(page.parent, trees.log_odds(html_extract.features(page)))
        want = html_extract.labels(page)
        runs += sum(t is not None for t in page.text)
        wrong += sum(bool(k) != bool(w) for k, w, t in zip(kept, want, page.text) if t is not None)
    assert wrong <= 0.005 * runs


def test_held_out_pages_whose_names_do_not_tell(trees):
    r, wrong, chars = np.random.default_rng(78), 0, 0
    for _ in range(150):
        page = html_extract.parse(html_extract.generated_page(r, silent=True))
        kept = html_extract.decode(page.parent, trees.log_odds(html_extract.features(page)))
        want = html_extract.labels(page)
        chars += sum(len(t or "") for t in page.text)
        wrong += sum(len(t) for k, w, t in zip(kept, want, page.text) if t is not None and bool(k) != bool(w))
    assert wrong <= 0.06 * chars


FIRST = "The committee met on Tuesday to discuss the plan, and members agreed that further study was needed before any vote."
SECOND = "Officials said the bridge, which was closed in March, would reopen once the inspection had been completed and signed."


@pytest.mark.parametrize(
    ("body", "said"),
    [
        (f"<div id=c1><h1>Bridge to reopen</h1></div><div id=c2><p>{FIRST}</p></div><div id=c3><p>{SECOND}</p></div>", f"Bridge to reopen\n{FIRST}\n{SECOND}"),
        (f"<article><h1>One</h1><p class='more-text'>{FIRST}</p><p id=comment-note>{SECOND}</p></article><footer>&copy; us</footer>", f"One\n{FIRST}\n{SECOND}"),
        (f"<article><p>{FIRST}</p><p>{SECOND}</p><ol><li><a href=/1>First source of it</a></li><li><a href=/2>Second source</a></li></ol></article>", f"{FIRST}\n{SECOND}\nFirst source of it\nSecond source"),
        (f"<article><img alt=it's><p>{FIRST}</p><p>They don't know. {SECOND}</p></article>", f"{FIRST}\nThey don't know. {SECOND}"),
        (f'<article><p title="a>{FIRST}</p><p>{SECOND}</p></article>', f"{FIRST}\n{SECOND}"),
        (f"<article><p>{FIRST} So <math><mi>x</mi>=<mn>2</mn></math>. <button>Press</button> it.</p><p>{SECOND}</p></article>", f"{FIRST} So x=2. Press it.\n{SECOND}"),
        (f"<main class='content-wrap'><p>{FIRST}</p><dl><dt>Word</dt><dd>What it means.</dd></dl><pre>x = 1</pre></main>", f"{FIRST}\nWord\nWhat it means.\nx = 1"),
        (f"<article><p>{FIRST}</p><div class=related><ul><li><a href=/1>One</a></li></ul></div><p>{SECOND}</p><p class='ad'>Buy now.</p></article><section id=comments><p>{FIRST}</p></section>", f"{FIRST}\n{SECOND}"),
    ],
)
def test_whole_articles(trees, body, said):
    page = html_extract.parse(f"<html><body><nav><a href=/a>Home</a> <a href=/b>News</a></nav>{body}</body></html>")
    assert html_extract.main_text(page, trees.log_odds(html_extract.features(page))) == said


@pytest.mark.parametrize(
    ("tag", "said"),
    [
        ('<p title="a>b">x', "x"), ("<p title=a'b>x<p title=c'd>y", "x\ny"), ("<p a=b/>x", "x"), ("<p =a>x", "x"), ("<p a = 'b>c' d>x", "x"), ("<p a=>x", "x"),
        ("<p a='b' / c>x</p a='>'>y", "x\ny"), ("</3 x>y", "y"), ("<script src=/a/>p</script>x", "x"), ("<svg/>x", "x"), ("<p a='b>x", "x"), ("a <3 b", "a <3 b"),
    ],
)
def test_attributes(tag, said):
    assert "\n".join(t for t in html_extract.parse(tag).text if t is not None) == said


def test_decoding_never_contradicts():
    r = np.random.default_rng(1)
    for _ in range(60):
        n = int(r.integers(1, 11))
        parent = [-1] + [int(r.integers(0, i)) for i in range(1, n)]
        odds = r.normal(size=n)
        kept = html_extract.decode(parent, odds)
        best = 0.0
        for mask in range(1 << n):
            if all(not mask >> i & 1 or mask >> parent[i] & 1 for i in range(1, n)):
                best = max(best, sum(odds[i] for i in range(n) if mask >> i & 1))
        assert all(not kept[i] or kept[parent[i]] for i in range(1, n)) and odds[kept].sum() == pytest.approx(best)


def test_pages(spark, trees):
    whole = (
        '<!doctype html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>'
        '<!-- ad --><div class="ad">Buy this.</div><article><h1>Head  line</h1><p><b>First &amp; best.<br><p>Second,\n  longer one with &copy; and words.</p>'
        '<div class="comments"><p>Reader says no.</p></div><p>Third.</article><aside class="sidebar"><h3>Related</h3><a href=/x>x</a></aside>'
        '<div class="cookie-notice">We use cookies.</div><form><label>Mail</label><input></form><footer>&copy; us</footer>'
    )
    rows = [(1, "u", whole), (2, "u", None), (2, None, ""), (3, "u", "no <b>markup</b> to  speak of"), (4, "u", "<p>a < b <unfinished"), (None, "u", "<article><p>x" * 300)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    got = [tuple(r) for r in html_extract.extract(df, trees).collect()]
    text = "Head line\nFirst & best.\nSecond, longer one with © and words.\nThird."
    assert got[0] == (1, "u", text, len(text)) and got[1] == (2, "u", "", 0) and got[2] == (2, None, "", 0)
    assert len(got) == 6 and all(n == len(t) for _, _, t, n in got)
    assert html_extract.extract(df.limit(0), trees).count() == 0


def test_raw_elements_left_open(trees):
    said = ["Head line of it", "The first words, of an article. They go on for a while.", "The second part, as long as the first. It ends here."]
    article = f"<article><h1>{said[0]}</h1><p>{said[1]}</p><p>{said[2]}</p></article>"

    def text(source):
        page = html_extract.parse(source)
        return html_extract.main_text(page, trees.log_odds(html_extract.features(page)))

    whole = "\n".join(said)
    assert text(f"<html><head><title>t</title><body>{article}") == whole
    assert text(f"<html><head><meta charset=x><script>var a = '<p>';</script><noscript><img></noscript>{article}") == whole
    assert text(f"<html><head><title>t</title><p>no end</head><body>{article}</body></html>") == whole
    for tag in ("button", "select", "label", "svg", "object", "audio", "video", "canvas", "iframe"):
        assert text(f"<html><body><div class=nav><{tag}>Press</div>{article}</body></html>") == whole, tag
        assert text(f"<html><body><{tag}>Press{article}</body></html>") == whole, tag
        assert text(f"<html><body><div class=nav><{tag}>Press</div>{article}<form><{tag}>Send</{tag}></form></body></html>") == whole, tag
        assert text(f"<html><body><form><{tag}>a<div>b</div>c</{tag}></form>{article}</body></html>") == whole, tag
    assert text(f"<html><body>{article}<script>var a = '<p>more</p>'") == whole


def test_given_pages(spark, trees):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages, trees).collect()}
    for row in pages.collect():
        body = row.html.partition("<article>")[2].partition("</article>")[0]
        blocks = html_extract.re.split(r"</h1>|</?p>", body)
        said = (" ".join(html_extract.html.unescape(html_extract.re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
        assert got[row.page_id] == "\n".join(x for x in said if x)


# --- vectors -------------------------------------------------------------------------


def plain_links(rows, cosine):
    ok = []
    for ident, v, label in rows:
        good = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if good else None)
    near = [{j for j in range(len(rows)) if j != i and ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine} for i in range(len(rows))]
    found = []
    for i, (ident, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        found.append((ident, len(near[i]), least, ident is not None and ident == least))
    return sorted(found, key=repr)


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 6)
    r = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = r.normal(size=24)
        rows += [(len(rows) + k, (centre + r.normal(size=24) * 0.04).tolist(), c % 3) for k in range(14)]
    rows += [(len(rows) + k, r.normal(size=24).tolist(), k % 3) for k in range(150)]
    rows += [(900 + k, rows[0][1], 0) for k in range(5)] + [(910, rows[0][1], None), (911, None, 0), (912, [0.0] * 24, 0), (913, [], 1), (None, rows[0][1], 0)]
    rows += [(914, [float("nan")] * 24, 0), (915, [float("inf")] + [1.0] * 23, 0), (916, [None] + [1.0] * 23, 0), (917, [1.0, 0.0], 0), (918, [2.0, 0.0], 0), (900, rows[0][1], 0)]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "vec_id bigint, embedding array<double>, label int, node string")
    got = sorted(map(tuple, embedding_dedup.near_vectors(df).collect()), key=repr)
    want = plain_links(rows, 0.98)
    missed = sum(w[1] for w in want) - sum(g[1] for g in got)
    assert 0 <= missed <= 0.02 * sum(w[1] for w in want)
    assert missed or got == want


def test_no_vectors(spark):
    kind = "vec_id bigint, embedding array<float>, label int"
    assert embedding_dedup.near_vectors(spark.createDataFrame([], kind)).count() == 0
    assert [tuple(r) for r in embedding_dedup.near_vectors(spark.createDataFrame([(1, None, 1)], kind)).collect()] == [(1, 0, 1, True)]


def test_codes_are_balanced():
    r = np.random.default_rng(0)
    x = r.normal(size=(2000, 32)) @ np.diag(np.linspace(1, 3, 32)) + 2
    model = embedding_dedup.Quantiser.fit(x)
    codes = model.codes(list(x)).view(np.uint64)
    shares = [float(((codes >> np.uint64(b)) & np.uint64(1)).mean()) for b in range(32)]
    assert min(shares) > 0.4 and max(shares) < 0.6 and np.allclose(model.projection.T @ model.projection, np.eye(32))


# --- conversations -------------------------------------------------------------------


def plain_digest(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    found = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, _, r, _, t in turns)
        loss = "".join(t for _, _, _, r, _, t in turns if r == "assistant")
        found[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def test_conversations(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = [
        (1000, 0, "user", None), (1000, 1, "assistant", "a\\b [INST] <s>\n\\"), (1000, 1, "assistant", "tie"), (1001, None, None, "x"), (None, 3, "assistant", "[[<<\\\\"),
        (None, 2, "sys\ntem[", "</s>"), (1002, 5, "assistant", ""), (1002, 5, "assistant", ""), (1003, 1, "user", "z" * 200_000),
    ]
    rows = given.unionByName(spark.createDataFrame(odd, given.schema)).withColumn("part", given.turn)
    turns = chat_format.with_control_strings(rows)
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(chat_format.format_conversations(turns)).collect()}
    assert got == plain_digest([tuple(r) for r in turns.collect()])
    assert chat_format.format_conversations(given.limit(0)).count() == 0


def test_formatted_text(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi [x]"), (1, 1, "assistant", "yo")], "conv_id bigint, turn bigint, role string, text string")
    parts = sorted(map(tuple, chat_format.format_conversations(turns).collect()))
    assert "".join(p[2] for p in parts) == "<s>\n[INST] user\nhi \\[x][/INST]</s>\n[INST] assistant\nyo[/INST]</s>\n"
    assert [p[3] for p in parts] == [[], [(17, 19)]]


def test_template_language():
    t = chat_format.Template(
        "A{{ 'b' + 1 | upper }}{% for m in messages %}{% if m.role in 'user tool' and not loop.last %}U{% elif m['role'] == 'x' or false %}X{% else %}"
        "{{ m.text | trim }}{% generation %}g{{ m.text }}{% endgeneration %}{% endif %}{% if 1 == 2 %}never{% endif %}{{ loop.index0 + 1 }}{% endfor %}Z"
    )
    assert t.turn("user", " q ", 0, False) == ("Ab1U1", []) and t.turn("x", "", 1, False) == ("X2", [])
    assert t.turn("bot", " q ", 2, True) == ("qg q 3Z", [(1, 5)])
    assert chat_format.fold(chat_format.parse("a{{ 'b' + ('c' | upper) }}{% if not false %}d{% endif %}")) == ("seq", [("out", ("const", "abCd"))])


@pytest.mark.parametrize("source", [
    "no loop", "{% for m in messages %}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ m.text() }}{% endfor %}", "{% import os %}",
    "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}", "{% for m in other %}{% endfor %}", "{% for m in messages %}{{ m.text | open }}{% endfor %}", "{{ 1 + }}",
])
def test_templates_outside_the_language(source):
    with pytest.raises(chat_format.TemplateError):
        chat_format.Template(source)
