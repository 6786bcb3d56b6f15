"""Language of pages: accuracy on held-out text, evidence against weak text."""

import random
import time

import pytest

from seatcast.llm import langid

from . import brute

SYLLABLES = {"en": "the and ing tion er ou wh th st".split(),
             "de": "der die und sch ung keit ein ü ß".split(),
             "fr": "les eau oi ez é que tion ment è".split()}
PAGES = "page_id long, url string, html string, lang string"


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 3))) for _ in range(n))


def documents(spark):
    rnd = random.Random(1)
    rows = [(i, lang, prose(rnd, lang, 60)) for i in range(20) for lang in SYLLABLES]
    rows += [(90, None, "x"), (91, "", "y"), (92, "rare", "z z z"), (93, "en", None)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def page(text, lang=None):
    head = f'<html lang="{lang}">' if lang else "<html>"
    return f"{head}<body><script>var the = 'und';</script><p>{text} &amp; &eacute;</p></body></html>"


def test_text_decides_where_there_is_enough(spark):
    rnd = random.Random(2)
    truth = {i: rnd.choice(list(SYLLABLES)) for i in range(120)}
    rows = [(i, f"https://h{i % 7}.example.org/{i}", page(prose(rnd, lang, 40), "en"), None)
            for i, lang in truth.items()]
    got = langid.identify(spark.createDataFrame(rows, PAGES), documents(spark)).collect()
    right = sum(r.lang == truth[r.page_id] == r.text_lang for r in got)
    assert right >= 118 and all(0 <= r.confidence <= 1 for r in got)


def test_host_and_declaration_decide_where_text_says_nothing(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(60):
        lang = ("de", "fr")[i % 2]
        rows.append((i, f"http://www.{lang}-site.{lang}/{i}", page(prose(rnd, lang, 40), lang), None))
    rows += [(100, "http://www.de-site.de/x", page("", "de"), None),
             (101, "http://www.fr-site.fr/x", "", None),
             (102, "http://unknown.fr/", page("123", "fr"), None)]
    got = {r.page_id: r.lang for r in
           langid.identify(spark.createDataFrame(rows, PAGES), documents(spark)).collect()}
    assert (got[100], got[101], got[102]) == ("de", "fr", "fr")


def test_nulls_repeats_and_no_rows(spark):
    rows = [(1, None, None, None)] * 2 + [(None, "", "", None), (3, "not a url", "<<<>", None)]
    got = langid.identify(spark.createDataFrame(rows, PAGES), documents(spark)).collect()
    assert len(got) == 4 and all(r.lang in SYLLABLES for r in got)
    docs = documents(spark)
    assert langid.identify(spark.createDataFrame([], PAGES), docs).collect() == []
    none = langid.identify(spark.createDataFrame(rows, PAGES), docs.limit(0)).collect()
    assert [(r.lang, r.confidence) for r in none] == [(None, 0.0)] * 4


def test_languages_of_any_script(spark):
    rnd = random.Random(4)
    spans = {"ar": range(0x627, 0x64B), "el": range(0x3B1, 0x3CA), "en": range(97, 123),
             "he": range(0x5D0, 0x5EB), "hi": range(0x905, 0x94D), "ja": range(0x3041, 0x3097),
             "pl": [*range(97, 123), *map(ord, "ąćęłńśźżó") ], "ru": range(0x430, 0x450),
             "th": range(0xE01, 0xE2F), "zh": range(0x4E00, 0x4F00)}
    letters = {x: rnd.choices([chr(c) for c in span], k=12) for x, span in spans.items()}
    letters["pl"] = list("aowińszłżęą")

    def own(lang, n=60):
        return " ".join("".join(rnd.choices(letters[lang], k=rnd.randint(2, 7))) for _ in range(n))

    docs = spark.createDataFrame([(i, x, own(x)) for i in range(8) for x in spans],
                                 "doc_id long, lang string, text string")
    truth = dict(enumerate(list(spans) * 4))
    rows = [(i, f"http://h{i}.example/", f"<p>{own(x, 30)}</p>", None) for i, x in truth.items()]
    got = langid.identify(spark.createDataFrame(rows, PAGES), docs).collect()
    assert {r.page_id: r.text_lang for r in got} == truth
    assert {r.page_id: r.lang for r in got} == truth


def test_page_parts():
    assert langid.address_parts("https://u:p@www.Example.DE:80/x?y") == \
        ("www.example.de", "example.de", "de")
    assert langid.address_parts("mailto:x") == ("", "", "")
    assert langid.declared_language('<HTML class="a" LANG=de-AT>') == "de"
    assert langid.visible_text("a<!-- <b> -->c<style>d</style><p>e&lt;").split() == ["a", "c", "e<"]


def test_declaration_anywhere_in_the_page():
    assert langid.declared_language(f"<!-- {'licence ' * 900} --><html class=x lang='fr'>") == "fr"
    assert langid.declared_language("<html><p lang=de><html lang=es>") == "es"
    assert langid.declared_language("<html " * 50_000) == ""


@pytest.mark.parametrize("block", [2, 48])
def test_fusion_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    monkeypatch.setattr(langid, "FETCH", 2)
    rnd = random.Random(5)
    alphabets = {"en": "abcdef", "de": "abcxyz", "el": "αβγδε", "ru": "абвгд", "xx": "abαб"}
    words = lambda lang, n: " ".join(
        "".join(rnd.choices(alphabets[lang], k=4)) for _ in range(n))
    docs = [(lang, words(lang, 40)) for lang in alphabets for _ in range(3)]
    docs += [("one", "zq zq zq"), ("none", ""), (" EN", words("en", 5)), (None, "x")]
    pages = []
    for i in range(90):
        lang = rnd.choice(list(alphabets))
        host = rnd.choice(["a.x.de", "b.x.de", "c.org", "", "d.e.gr"])
        pages.append((i, host, rnd.choice(["", "en", "de", "el"]), words(lang, rnd.choice([0, 1, 2, 9]))))
    rows = [(i, f"http://{host}/" if host else None,
             f'<html lang="{said}"><p>{text}</p>', None) for i, host, said, text in pages]
    got = langid.identify(
        spark.createDataFrame(rows, PAGES),
        spark.createDataFrame([(i, *d) for i, d in enumerate(docs)],
                              "doc_id long, lang string, text string"))
    want = brute.fused_languages(
        [(lang and lang.strip().lower(), text) for lang, text in docs],
        [(i, *langid.address_parts(f"http://{host}/" if host else ""), said, text)
         for i, host, said, text in pages])
    assert len(want) == 90
    for r in got.collect():
        lang, confidence, text_lang = want[r.page_id]
        assert (r.lang, r.text_lang) == (lang, text_lang)
        assert r.confidence == pytest.approx(confidence, abs=2e-5)


def test_every_language_has_a_model(spark):
    """Sixty languages, each with letters of its own, one of them in two documents."""
    rnd = random.Random(6)
    words = lambda k: " ".join("".join(chr(0x4E00 + 20 * k + rnd.randrange(20)) for _ in range(3))
                               for _ in range(60))
    docs = [(100 * k + i, f"l{k:02d}", words(k)) for k in range(60) for i in range(2 if k == 7 else 6)]
    pages = [(k, f"http://h{k}.org/", f"<p>{words(k)}", None) for k in range(60)]
    got = langid.identify(spark.createDataFrame(pages, PAGES),
                          spark.createDataFrame(docs, "doc_id long, lang string, text string"))
    assert {r.page_id: r.lang for r in got.collect()} == {k: f"l{k:02d}" for k in range(60)}


def test_unclosed_markup_costs_in_proportion():
    for piece in ("<nav>", "<", "<!--", "<script ", "</nav  ", "&", "<html lang=", "<nav></nav\t"):
        page = piece * (1_000_000 // len(piece))
        began = time.monotonic()
        langid.visible_text(page), langid.declared_language(page)
        assert time.monotonic() - began < 5, piece


def test_visible_text():
    assert langid.visible_text("a<b c='d'>e<SCRIPT x>f<b></script >g<!--h-->i<nav>j") == "a e g i j"
    assert langid.visible_text("1 < 2 &lt;&#" + "0" * 5000 + "65;&#" + "9" * 5000 + ";") == "1 < 2 <A\ufffd"
    assert langid.visible_text("<nav>a<nav>b</nav>c<!--d") == " c<!--d"
