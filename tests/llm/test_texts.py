"""Personal data, toxicity, decontamination and main text."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, edge_rows, frame, words
from tillsight.llm import decontaminate, html_text, pii, registry, toxicity

# ---------------------------------------------------------------- personal data


def base_spans(t):
    """The base patterns, straight from their definition."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        check = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and check % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng, automaton = random.Random(1), pii._automaton()
    sets = ["0123456789. -", "+ (0)1-.", "a@b.c-d%", "19.2-3 +5@x.é", "4111 1111-1111"]
    for _ in range(20_000):
        t = "".join(rng.choice(rng.choice(sets)) for _ in range(rng.randrange(0, 60)))
        assert [s for s in pii.find_spans(t, automaton) if s[0] in pii.BASE_KINDS] == base_spans(t), t
    long = "a" * 50_000 + "@" + "9" * 50_000 + ".1.1.1"
    assert pii.find_spans(long, automaton)[0] == ("email", 0, len(long))


def test_added_spans_and_mask():
    a = pii._automaton()
    t = "IBAN: GB29 NWBK 6016 1331 9268 19, account no. 12345678; ssn 123-45-6789 https://bob:pw@host.org/x recount 12345678"
    spans = pii.find_spans(t, a)
    assert [(k, t[x:y]) for k, x, y in spans] == [
        ("email", "pw@host.org"), ("login", "bob:pw"), ("iban", "GB29 NWBK 6016 1331 9268 19"), ("account", "12345678"),
        ("ssn", "123-45-6789")]
    assert pii.mask(t, spans) == "IBAN: <IBAN>, account no. <ACCOUNT>; ssn <SSN> https://<LOGIN>/x recount 12345678"
    assert not pii.find_spans("IBAN GB29 NWBK 6016 1331 9268 18", a)  # remainder is not 1


def test_personal_data_edges_and_stage(spark):
    rows = [*edge_rows(), (20, "x a.b@c.de 1.2.3.4 y")]
    got = pii.find_personal_data(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    hit = next(r for r in got if r.doc_id == 20)
    assert (hit.n_email, hit.n_ip, hit.n_card, hit.n_phone, hit.spans) == (1, 1, 0, 0, "email:2:10,ip:11:18")
    df = frame(spark, rows)
    masked = pii.mask_personal_data(df)
    assert masked.columns == df.columns and masked.count() == len(rows)
    one = masked.where("doc_id = 20").first()
    assert (one.text, one.n_chars) == ("x <EMAIL> <IP> y", 16)
    assert masked.where("text is null").count() == 2
    assert pii.find_personal_data(frame(spark, [])).count() == 0


def test_op5_on_all_documents(spark):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in registry.op5_personal_data(spark, SF).collect():
        spans = base_spans(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]


# ---------------------------------------------------------------- toxicity


def test_fold():
    assert toxicity.fold("1D10T yоu ѕtuріd$$$ a 12th l0ser") == "idiot you stupid$$$ a 12th loser"


def test_exception_phrases():
    m = toxicity._Matcher({"trash": 2.0, "tras": 1.0, "idiot ": 3.0}, ["trash can"])
    assert sorted(m.hits("the trash can is trash idiots idiot".split()).values()) == [2.0, 3.0]


def test_matcher_equals_a_naive_one():
    """Each word takes its heaviest term (a beginning, or the whole word); words of an exception phrase take none."""
    rng = random.Random(6)
    some = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(40)]
    for _ in range(400):
        weights = {rng.choice(some) + rng.choice(["", " "]): rng.choice([0.5, 1.0, 2.0]) for _ in range(8)}
        exceptions = [f"{rng.choice(some)} {rng.choice(some)}" for _ in range(4)]
        text = [rng.choice(some) for _ in range(rng.randrange(0, 30))]
        want, at = {}, 0
        for i, w in enumerate(text):
            spared = any(f"{a} {b}" in exceptions for a, b in ((text[i - 1] if i else "", w), (w, text[i + 1] if i + 1 < len(text) else "")))
            found = [x for t, x in weights.items() if (w + " " == t if t.endswith(" ") else w.startswith(t))]
            if found and not spared:
                want[at] = max(found)
            at += len(w) + 1
        assert toxicity._Matcher(weights, exceptions).hits(text) == want


def test_every_significant_term_is_learned(spark):
    """The lexicon equals one learned from literal counts, whatever the frequency of other terms."""
    rng = random.Random(3)
    rows = []
    for i in range(300):
        text = words(rng.randrange(10, 40), i).split() + (["zyxrare", "qqqq"][:1 + i % 2] if i % 5 == 0 else [])
        rows.append((" ".join(text), int(i % 5 == 0)))
    counts, n1 = {}, sum(y for _, y in rows)
    for t, y in rows:
        for term in toxicity._terms(toxicity.words_of(t)):
            a, b = counts.get(term, (0, 0))
            counts[term] = (a + y, b + 1 - y)
    counts = {t: c for t, c in counts.items() if c[0] >= 5}
    want = toxicity._lexicon(counts, n1, len(rows) - n1, 2.0, 30.0)
    assert want and toxicity.fit(spark.createDataFrame(rows, "text string, toxic int")).weights == want


def labelled(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        text, bad = words(rng.randrange(20, 80), i).split(), i % 4 == 0
        for _ in range(4 if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["zyxgrub", "zyxgrubs", "WORMF4CE"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return frame(spark, rows), spark.createDataFrame(labels + [(None, 1), (5, None), (0, 0)], "doc_id long, toxic int")


def test_learned_lexicon_separates_the_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(toxicity.training_rows(docs, labels, where=~F.expr(registry.HELD_OUT)))
    assert any(t.startswith("zyxgrub") for t in model.weights) and any(t.startswith("wormface") for t in model.weights)
    got = toxicity.score(docs, model).where(registry.HELD_OUT).collect()
    assert len(got) > 50 and all(r.predicted == (r.doc_id % 4 == 0) for r in got)
    assert toxicity.reject(docs, model).count() == 300
    edges = frame(spark, edge_rows())
    scores = toxicity.score(edges, model).collect()
    assert len(scores) == len(edge_rows()) and all(0 <= r.score < 0.5 for r in scores)
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_without_both_classes(spark):
    docs, labels = labelled(spark)
    for part, want in (("toxic = 1", 1), ("toxic = 0", 0), ("false", 0)):
        model = toxicity.fit(toxicity.training_rows(docs, labels.where(part)))
        assert {r.predicted for r in toxicity.score(docs, model).collect()} == {want}


def test_op4_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = registry.op4_toxicity(spark, sf)
    assert got.count() == 1000
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)


# ---------------------------------------------------------------- decontamination


def distance_within(item, text):
    """Least edit distance of ``item`` to a substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_matches_equal_brute_force():
    rng = random.Random(4)
    items = [(i, words(rng.randrange(6, 20), i)[:90]) for i in range(8)]
    m = decontaminate.Matcher(items, rate=0.1)
    for _ in range(300):
        i, item = rng.choice(items)
        edited = list(item)
        for _ in range(rng.randrange(0, len(item) // 6)):
            k = rng.randrange(len(edited))
            edited[k:k + 1] = rng.choice([[], ["x"], [edited[k], "y"]])
        text = words(5, rng.random()) + " " + "".join(edited) + " " + words(5, rng.random())
        want = {k: d for k, t in items if (d := distance_within(t, text)) <= int(0.1 * len(t))}
        assert {k: v[0] for k, v in m.matches(text).items()} == want


def test_contaminated_edges(spark):
    item = words(30, 77)
    bench = frame(spark, [(1, item.upper() + "!"), (2, None), (3, ""), (4, "short"), (None, item), (1, item)], "item_id")
    rows = [*edge_rows(), (30, f"before {item}, after"), (31, "Short!"), (32, "short of it"), (33, item[:-2])]
    df = frame(spark, rows)
    for size in (decontaminate.BLOCK_CHARS, 50):  # one block, several
        got = decontaminate.contaminated(df, bench, block_chars=size).collect()
        assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(30, 1, 0), (31, 4, 0), (33, 1, 2)]
        kept = decontaminate.remove_contaminated(df, bench, block_chars=size)
        assert kept.columns == df.columns and kept.count() == len(rows) - 3
    none = frame(spark, [], "item_id")
    assert decontaminate.contaminated(df, none).count() == 0
    assert decontaminate.remove_contaminated(df, none).count() == len(rows)
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0


def test_short_items_match_word_for_word(spark):
    items = [("q1", "Wie alt ist er?"), ("q2", "你好吗今天"), ("q3", "yes"), ("q4", "a b"), ("q5", "?!")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [(1, "Er fragte: wie ALT ist er, und ging."), (2, "wie alt ist erika"), (3, "他说你好吗今天我们"), (4, "Yes!"),
            (5, "oh yes it is"), (6, "la b"), (7, "x a, b"), (8, "wie alt  ist sie"), (9, None), (10, "?!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (decontaminate.BLOCK_CHARS, 6):
        got = decontaminate.contaminated(docs, bench, block_chars=size).collect()
        assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(1, "q1", 0), (3, "q2", 0), (4, "q3", 0), (7, "q4", 0)]
        assert sorted(r.doc_id for r in decontaminate.remove_contaminated(docs, bench, block_chars=size).collect()) == [
            2, 5, 6, 8, 9, 10]


def test_op2_finds_verbatim_items(spark):
    texts = {n: {r[0]: t for r, t in zip(rows, decontaminate.normalise(pa.array([r[1] or "" for r in rows])).to_pylist(),
                                         strict=True)}
             for n, rows in ((n, spark.read.parquet(f"{SF}/{n}.parquet").collect()) for n in ("documents", "benchmark"))}
    verbatim = {(d, i) for d, t in texts["documents"].items() for i, x in texts["benchmark"].items() if x in t}
    got = {(r.doc_id, r.item_id): r.distance for r in registry.op2_decontamination(spark, SF).collect()}
    assert verbatim <= got.keys()
    for (d, i), n in got.items():
        assert n == (0 if (d, i) in verbatim else distance_within(texts["benchmark"][i], texts["documents"][d]))


# ---------------------------------------------------------------- main text

LONG = "Sentences, with marks; and more words than a menu has. " * 6


@pytest.mark.parametrize("page, want", [
    ("", ""), ("   ", ""), ("<p></p>", ""), ("plain &amp; simple", "plain & simple"),
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><nav><a>Home</a></nav>"
     f"<article><header><h1>Head&nbsp;line</h1></header><p>{LONG}<p><b>Bold</b>\n text<br>here<script>x('</p>')</script>"
     f"<aside>side</aside><div class='ad-slot'>Buy</div><ul><li>One<li>Two</ul></article>"
     f"<div id=comments><p>{LONG}</div><footer>&copy; x</footer>",
     f"Head line\n\n{LONG.strip()}\n\nBold text here\n\nOne\n\nTwo"),
    (f"<body><div class=cookie-notice>{LONG}</div><div><div id=main><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
     f"<div class=sidebar><p>{LONG}</p></div></div><form><p>{LONG}</form><!-- <p>gone</p> --></body>",
     f"{LONG.strip()}\n\nShort.\n\n{LONG.strip()}"),
    (f"<article><p>{LONG}<p>unclosed < b & c", f"{LONG.strip()}\n\nunclosed < b & c"),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("first,second", [
    ("<section>", "<section>"), ("<article>", "<article>"), ("<div>", "<div>"), ("<table><tr><td>", "<td>")])
def test_main_text_in_sibling_containers(first, second):
    close = [f"</{re.findall('[a-z]+', x)[-1]}>" for x in (first, second)]
    paragraphs = [f"{i}. {LONG.strip()}" for i in range(10)]
    page = (f"<body><nav>Home</nav><div>{first}" + "".join(f"<p>{x}</p>" for x in paragraphs[:7]) + close[0] + second
            + "".join(f"<p>{x}</p>" for x in paragraphs[7:]) + f"{close[1]}</div><footer>x</footer></body>")
    assert html_text.main_text(page) == "\n\n".join(paragraphs)


@pytest.mark.parametrize("attrs", [
    'href="/hidden-gems"', 'title="hidden treasures"', 'data-hidden="false"', 'href="/a?id=comments"', 'data-id="share"',
    'href=/a?class=menu', 'title="id=comments"', "data-role=navigation"])
def test_main_text_reads_whole_attributes(attrs):
    page = f"<article><p>{LONG}</p><p>See <a {attrs}>this</a>; more.</p><p {attrs}>{LONG}</p></article>"
    assert html_text.main_text(page) == f"{LONG.strip()}\n\nSee this; more.\n\n{LONG.strip()}"


@pytest.mark.parametrize("attrs", ['class="content has-sidebar"', 'id="page-no-sidebar"', "class=widget", "class=topbar"])
def test_main_text_below_a_cue(attrs):
    inner = f"<article><p>{LONG}<p>{LONG}</article><div class=sidebar>{LONG}</div>"
    assert html_text.main_text(f"<body><nav>Home</nav><div {attrs}>{inner}</div><footer>x</footer></body>") == (
        f"{LONG.strip()}\n\n{LONG.strip()}")
    parts = "".join(f"<div {attrs}><p>{i} {LONG}</p></div>" for i in range(9))
    assert html_text.main_text(f"<body>{parts}</body>") == "\n\n".join(f"{i} {LONG.strip()}" for i in range(9))


@pytest.mark.parametrize("attrs", ["hidden", "HIDDEN=''", 'aria-hidden="true"', "role=navigation", 'data-x="1"class="menu"',
                                   "style='display:none'", "id = comments"])
def test_main_text_still_leaves_out(attrs):
    assert html_text.main_text(f"<article><p>{LONG}</p><div {attrs}>gone</div></article>") == LONG.strip()


@pytest.mark.parametrize("attrs", ["class=share-price", "class='form-factor'", "class=notice-board", "id=social-history",
                                   "class='lead comment-on-events'"])
def test_a_cue_among_other_words_keeps_a_block_of_an_article(attrs):
    page = f"<body><nav>Home</nav><article><p>{LONG}</p><div {attrs}>Short one.</div><p {attrs}>Two.</p><p>{LONG}</p></article></body>"
    assert html_text.main_text(page) == f"{LONG.strip()}\n\nShort one.\n\nTwo.\n\n{LONG.strip()}"


@pytest.mark.parametrize("attrs", ["class=ad-slot", "class='related-posts'", "id=comments-list", "class='share-buttons x'",
                                   "class=newsletter-box"])
def test_a_name_of_cues_alone_drops_a_block(attrs):
    assert html_text.main_text(f"<article><p>{LONG}</p><div {attrs}>gone</div><p>{LONG}</p></article>") == (
        f"{LONG.strip()}\n\n{LONG.strip()}")


def test_unlabelled_menu_and_footer_stay_out():
    paragraphs = [f"{i}. {LONG.strip()}" for i in range(8)]
    menu = "<div><ul>" + "".join(f"<li><a href=/{i}>Item {i}</a>" for i in range(8)) + "</ul></div>"
    content = "<div>" + "<p>Short.</p>".join(f"<p>{x}</p>" for x in paragraphs) + "</div>"
    footer = "<div><p>Copyright 2024 Example, all rights reserved.</p></div>"
    want = "\n\nShort.\n\n".join(paragraphs)
    assert html_text.main_text(f"<body>{menu}{content}{footer}</body>") == want
    # two sections that count, with a short one between, and a closing one of some weight
    two = f"<div><p>{LONG}</p><p>{LONG}</p></div><div><p>Between.</p></div><div><p>{LONG}</p></div>"
    one = LONG.strip()
    assert html_text.main_text(f"<body>{menu}{two}{footer}</body>") == f"{one}\n\n{one}\n\nBetween.\n\n{one}"
    # blocks of the container itself are not cut off
    assert html_text.main_text(f"<body><h1>Title</h1><p>{LONG}</p><p>Short.</p></body>") == f"Title\n\n{one}\n\nShort."


def test_a_very_long_page():
    paragraphs = [f"{i}. {LONG.strip()}" for i in range(5000)]
    page = "<body><nav>x</nav><div class=a>" + "".join(f"<p>{x}</p>" for x in paragraphs) + "</div><footer>y</footer></body>"
    assert html_text.main_text(page) == "\n\n".join(paragraphs)
    deep = "<div>" * 3000 + f"<p>{LONG}</p>" + "</div>" * 3000
    assert html_text.main_text(deep) == LONG.strip()


def test_pages_without_an_article_keep_the_same_text(spark):
    """The given pages with their article element renamed: what counts is found by the ratios alone."""
    pages = [r.html or "" for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    same = sum(html_text.main_text(re.sub(r"(</?)article\b", r"\1div", p)) == html_text.main_text(p) for p in pages)
    assert same >= 0.9 * len(pages)


def test_op10_on_all_pages(spark):
    import html

    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = registry.op10_main_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|<footer|$)", pages[r.page_id], re.S).group(1)
        parts = re.split(r"</?p>|</?h1>|<br>", body)
        want = [" ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", "", x)).split()) for x in parts]
        assert r.text == "\n\n".join(x for x in want if x) and r.n_chars == len(r.text)
    rows = [(1, "u", None), (None, None, "<p>x"), (1, "u", "")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted(r.text for r in html_text.extract_main_text(odd).collect()) == ["", "", "x"]
    assert html_text.extract_main_text(odd.limit(0)).count() == 0
