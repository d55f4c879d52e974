"""Language ID, page text and the shared word helper."""

import re

import numpy as np
import pyarrow as pa
import pytest

from tablesync.llm import words
from tablesync.llm.html_text import core_run, extract_main_text, main_text
from tablesync.llm.lang_id import HASHES, UNDETERMINED, LanguageModel, fit_language_model, linear_svm, predict_language

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"


def test_words_match_the_pattern():
    texts = ["a  b\tc", "", None, " é x \n", "x" * 50, "\x0b\x0c", "中文 字"]
    for lo, hi, buf, offsets in words.slices(pa.array(texts), limit=16):
        starts, ends, first = words.spans(buf, offsets)
        raw = buf.tobytes()
        for k in range(hi - lo):
            got = [raw[a:b].decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])]
            assert got == re.findall(r"[^\x20\x09-\x0D]+", texts[lo + k] or "")


def test_equal_words_have_equal_hashes_wherever_they_stand():
    column = pa.array(["one two one", "two one"])
    ((_, _, buf, offsets),) = words.slices(column)
    starts, ends, _ = words.spans(buf, offsets)
    h = words.hash_spans(buf, starts, ends)
    assert h[0] == h[2] == h[4] and h[1] == h[3] and h[0] != h[1]
    assert (words.hash_bytes([b"one", b"two"]) == h[:2]).all()


def test_slices_of_a_sliced_array():
    column = pa.array(["aa", "bb", None, "cc"]).slice(1, 3)
    assert [buf.tobytes() for _, _, buf, _ in words.slices(column, limit=1)] == [b"bb", b"", b"cc"]


def test_linear_svm_separates():
    x = np.array([[0.0, 1], [0.1, 0.9], [1, 0], [0.9, 0.2]], np.float32)
    w = linear_svm(x, np.array([1.0, 1, -1, -1]))
    assert ((x @ w[:-1] + w[-1] > 0) == [True, True, False, False]).all()


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_language_model(docs.where("doc_id % 3 != 1"))
    out = predict_language(docs.where("doc_id % 3 = 1").select("doc_id", "text", "lang"), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_id_edges(spark):
    train = spark.createDataFrame([(1, "the of and is", "en"), (2, "le la les des", "fr"), (3, "el los que de", "es"), (4, "der die und", "de"), (5, "x", None)], DOCS)
    model = fit_language_model(train)
    assert set(model.members) == {"germanic", "romance"} and ("es", "fr") in model.pair_w
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (None, "the of and"), (5, "les des la"), (5, "les des la"), (6, "LES DES LA " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' score", "doc_id lang_pred", "'en' lang")
    out = predict_language(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = [(r["doc_id"], r["lang_pred"]) for r in out.collect()]
    assert got[:3] == [(1, UNDETERMINED), (2, UNDETERMINED), (3, UNDETERMINED)]
    assert got[3:] == [(None, "en"), (5, "fr"), (5, "fr"), (6, "fr")]


def test_a_language_of_copies_is_in_the_model(spark):
    fr = spark.range(20).selectExpr("id doc_id", "concat('le la les des ', repeat('x', int(id))) text", "'fr' lang")
    copies = spark.range(20_000).selectExpr("id doc_id", "'une phrase' text", "'fr' lang")
    en = spark.range(300).selectExpr("id doc_id", "concat('the of and is ', repeat('y', int(id))) text", "'en' lang")
    assert fit_language_model(fr.union(copies).union(en), per_language=20).families == ["germanic", "romance"]


def test_a_share_of_a_very_large_language_is_above_zero():
    assert int(400 / 10**15 * HASHES) > 0


def test_language_id_without_training_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert fit_language_model(empty) is None
    one = spark.createDataFrame([(1, "some text", "en")], DOCS)
    assert predict_language(one, None).first()["lang_pred"] == UNDETERMINED
    assert predict_language(empty, fit_language_model(one)).count() == 0
    assert predict_language(one, fit_language_model(one)).first()["lang_pred"] == "en"


def test_ties_go_to_the_smaller_code():
    model = LanguageModel(["romance"], {"romance": ["es", "fr"]}, np.zeros((1, 3), np.float32), {("es", "fr"): np.zeros(3, np.float32)})
    assert list(model.predict(np.zeros((2, 2), np.float32))[0]) == ["es", "es"]


ARTICLE = "A sentence that is long enough to be the body of an article, twice over."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        (f"<p>{ARTICLE}", ARTICLE),
        (f"<nav><a href=x>Home</a></nav><article><h1>Head</h1><p>{ARTICLE}<br>More &amp; more&nbsp;text<p>End.</article><footer>Foot {ARTICLE}</footer>", f"Head\n\n{ARTICLE} More & more text\n\nEnd."),
        (f"<div class='cookie-notice'>{ARTICLE}</div><div id=content><p>{ARTICLE}</p><p>Short.</p></div><div class=comments>{ARTICLE}</div>", f"{ARTICLE}\n\nShort."),
        (f"<form>{ARTICLE}<input></form><main><script>if (a<b) '</p>'</script><style>p{{}}</style><!-- {ARTICLE} --><p>{ARTICLE}</p></main>", ARTICLE),
        (f"<article><header><h1>T</h1></header><p>{ARTICLE}</p><aside>{ARTICLE}</aside></article>", f"T\n\n{ARTICLE}"),
        (f"<article><p title='a > b'>{ARTICLE}</p><p>cut &lt;here</p", f"{ARTICLE}\n\ncut <here"),
        (f"<article><ul><li>one</li><li>two</li></ul><p>{ARTICLE}</p></article>", f"one\n\ntwo\n\n{ARTICLE}"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


BODY = "".join(f"<p>{ARTICLE} Part {k}.</p>" for k in range(4))


@pytest.mark.parametrize(
    "before, after",
    [
        ("<div class='layout with-sidebar'>", "<div class=sidebar>Aside text</div></div>"),
        ("<div class='post no-comments'>", "</div>"),
        ("<div id='search-page'>", "</div>"),
        ("<section class='legal news'>", "</section>"),
        ("<form id='aspnetForm'><nav><a href=x>Home</a></nav><div>", "</div><footer>Foot</footer></form>"),
        ("<form id='aspnetForm'><article>", f"</article></form><div class=comments>{ARTICLE * 9}</div>"),
        ("<div class='header'><main>", f"</main></div><aside>{ARTICLE * 9}</aside>"),
        ("<nav><a href=x>Home</a><div>", "</div>"),
        ("<head><meta charset=x><title>T</title><body><div>", f"</div><div class='site-footer'>{ARTICLE}</div>"),
        ("<div hidden><div>", "</div></div>"),
        ("<div class=post>", f"</div><div id=comments><article class='comment-body'>{ARTICLE * 9}</article></div>"),
        ("<article><div>", f"</div><div id=comments>{ARTICLE * 9}</div></article>"),
    ],
)
def test_wrappers_named_like_furniture_keep_the_article(before, after):
    text = main_text(f"<html>{before}{BODY}{after}</html>")
    assert [x for x in text.split("\n\n") if x != "Home"] == [f"{ARTICLE} Part {k}." for k in range(4)]


def test_a_page_of_furniture_only_is_not_empty():
    assert main_text("".join(f"<section class='legal n{k}'><p>{ARTICLE} {k}</p></section>" for k in range(5))) == "\n\n".join(f"{ARTICLE} {k}" for k in range(5))
    assert main_text("<nav><a href=x>Home</a></nav>") == ""


def test_core_run_is_between_surge_and_dive():
    assert core_run(np.array([3, 0, 0, 0, 80, 5, 90, 0, 0, 0, 50])) == (4, 7)
    assert core_run(np.array([0, 0])) == (0, 0)


def test_pages_keep_every_row(spark):
    rows = [(1, "u", f"<p>{ARTICLE}"), (1, "u", f"<p>{ARTICLE}"), (None, None, None), (2, "v", "<article>" + f"<p>{ARTICLE}</p>" * 3000)]
    out = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 text", "2 n_chars")).collect()
    assert [(r["page_id"], r["n_chars"]) for r in out] == [(1, len(ARTICLE)), (1, len(ARTICLE)), (None, 0), (2, 3000 * (len(ARTICLE) + 2) - 2)]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_of_the_test_tables(spark):
    """Against the article element, read with a plain pattern."""
    import html

    for r in extract_main_text(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").drop("url"), "page_id").collect():
        body = re.sub(r"<(br|b)>", " ", re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1])
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", body)]
        assert r["text"] == "\n\n".join(x for x in blocks if x)


def test_deep_markup_costs_no_more_than_flat():
    import time

    pages = ['<div class="ad">x' * 40_000, "<div>some text" * 100_000, "<b>x" * 30_000 + "</i>" * 30_000 + "<section>" * 3_000, "<article>" * 20_000 + '<div class="menu">y' * 20_000, "<p>z<b>" * 30_000 + "<h1>q" * 30_000]
    for page in pages:
        began = time.process_time()
        main_text(page)
        assert time.process_time() - began < 20
    assert main_text("<div>some text" * 100_000).count("some text") == 100_000
