import html

import pytest
from pyspark.sql import functions as F

from galley.functions import content, literals, names
from tests.helpers import value


@pytest.mark.parametrize("text,want", [("ada.byron", "Ada Byron"), ("by mary o'neil-smith 3", "Mary O'neil-smith"), ("zoë q_x@mail.test", "Zoë Qx"), ("J.R. hale", "J.R. Hale"), ("", ""), ("X &amp; Y", "X  Y")])
def test_clean_author(spark, text, want):
    assert value(spark, lambda A: names.clean_author(A), a=text) == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("Ann Bee and Cy Dee", ["Ann Bee", "Cy Dee"]),
        ("Ann Bee &amp; Cy Dee", ["Ann Bee", "amp Cy Dee"]),
        ("Ann Bee, Cy Dee, and Eve Fox", ["Ann Bee", "Cy Dee", "", "Eve Fox"]),
        ("ann-bee-and-cy-dee", ["ann-bee-", "-cy-dee"]),
        ("Sandy Grand", ["Sandy Grand"]),
    ],
)
def test_clean_authors(spark, text, want):
    assert value(spark, lambda A: names.clean_authors(A), a=text) == want


@pytest.mark.parametrize("text,want", [("Zoë O'Neil-3_b", "zoëoneilb"), ("", ""), ("٣a²", "a²")])
def test_similarity_key(spark, text, want):
    assert value(spark, lambda A: names.similarity_key(A), a=text) == want


@pytest.mark.parametrize("text,want", [("One Two Three-Four", ("One Two", "Three-Four")), ("Solo", (None, None)), (None, (None, None)), ("a ", ("a", "")), (" b", ("", "b"))])
def test_split_display_name(spark, text, want):
    assert tuple(value(spark, lambda A: F.struct(*names.split_display_name(A)), a=text)) == want


@pytest.mark.parametrize("text,want", [("  Héllo, World! ", "h-llo-world"), ("--A__b--", "a-b"), ("", ""), ("東京", ""), (None, ""), ("a-b", "a-b")])
def test_slug_is_stable(spark, text, want):
    assert value(spark, lambda A: names.slug(A), a=text) == want
    assert value(spark, lambda A: names.slug(names.slug(A)), a=text) == want


def test_excerpt(spark):
    text = '<figure>z</figure><p>A&nbsp;b &lt;i&gt;c&lt;/i&gt; &copy;</p><script>var t="</p>";</script>'
    assert value(spark, lambda A: content.excerpt(A), a=text) == 'A b c © var t=" ";'
    assert value(spark, lambda A: content.excerpt(A), a=None) == ""
    assert value(spark, lambda A: content.excerpt(A), a=" ".join(["w"] * 150)) == " ".join(["w"] * 100)


def test_unescape_follows_the_standard_table(spark):
    text = "&amp;lt; &notit; &#x41; &eacute &amp"
    assert value(spark, lambda A: content.unescape(A), a=text) == html.unescape(text)


def test_paragraphs(spark):
    assert value(spark, lambda A: content.add_paragraphs(A), a="a\n\n<figure>f</figure>\n \n  b ") == "<p>a</p>\n<figure>f</figure>\n<p>b</p>"
    assert value(spark, lambda A: content.add_paragraphs(A), a="<P>x</P>\n\ny") == "<P>x</P>\n\ny"
    assert value(spark, lambda A: content.add_paragraphs(A), a=" \n\n ") == " \n\n "
    assert value(spark, lambda A: content.add_paragraphs(A), a="<!-- c -->\r\n\r\nx") == "<!-- c -->\n<p>x</p>"


def test_captions(spark):
    text = 'a [caption id="x" id="y_Z" width="ten"] <img src="1"> [/caption] [caption]no image[/caption] <p>[CAPTION align="r"]<IMG src="2">t[/CAPTION]</p>'
    want = 'a <figure id="y_Z" aria-describedby="caption-y-z" class="wp-caption"><img src="1"></figure> [caption]no image[/caption] <figure class="wp-caption r"><IMG src="2"><figcaption class="wp-caption-text">t</figcaption></figure>'
    assert value(spark, lambda A: content.convert_captions(A), a=text) == want
    assert value(spark, lambda A: content.convert_captions(A), a="none") == "none"


def test_puzzles(spark):
    assert value(spark, lambda A: content.convert_puzzles(A), a='[puzzleme id="1" set="2"]') == '[puzzleme id="1" set="2"]'
    assert 'data-puzzleType="crossword" data-height="700px"' in value(spark, lambda A: content.convert_puzzles(A), a='[puzzleme id="1" set="2" type="Crossword"]')


def test_odd_characters(spark):
    found = value(spark, lambda A: content.odd_characters(A), a="a​🙂\x07﻿")
    assert sorted((r.kind, r.position, r.code) for r in found) == [("control character", 3, "U+0007"), ("zero-width character", 1, "U+200B"), ("zero-width character", 4, "U+FEFF")]
    assert value(spark, lambda A: content.show_odd_characters(A), a="​x\x07") == "[U+200B]x[U+0007]"
    assert value(spark, lambda A: content.odd_characters(A), a="plain\n") == []


def test_shortcodes_and_styles(spark):
    found = value(spark, lambda A: content.shortcodes(A), a="[b x=1] t [/b] [a] [a y]")
    assert [(r.shortcode, r.example) for r in found] == [("a", "[a]"), ("b", "[b x=1] t [/b]")]
    assert value(spark, lambda A: content.inline_styles(A), a="<p style=\"a\"><p class=b style='c'>") == ["a", "c"]


def test_sanitized_names_its_fixes(spark):
    done = value(spark, lambda A: content.sanitized(A), a='say \\"x\\"')
    assert (done.text, done.fixes) == ('<p>say "x"</p>', ["backslashes stripped", "paragraph tags restored"])
    assert value(spark, lambda A: content.sanitized(A), a="").fixes == []


def test_puzzle_posts(spark):
    assert value(spark, lambda A: content.is_puzzle(F.array(F.lit(" Sudoku ")), A), a="x")
    assert value(spark, lambda A: content.is_puzzle(F.lit(None).cast("array<string>"), A), a="<div class='PM-embed-div'>")
    assert not value(spark, lambda A: content.is_puzzle(F.array(F.lit("news"), F.lit(None)), A), a=None)


@pytest.mark.parametrize("text,want", [(None, "NULL"), ("0000-00-00 00:00:00", "NULL"), ("it's a \\", "'it''s a \\\\'"), ("", "''")])
def test_quoted(spark, text, want):
    assert value(spark, lambda A: literals.quoted(A), a=text) == want


@pytest.mark.parametrize("text,want", [(None, None), ("  ", None), (" HTTP://x/y ", "HTTP://x/y"), ("//c/d", "https://c/d"), ("WWW.EXAMPLE.ORG/a", "https://WWW.EXAMPLE.ORG/a"), ("WP-Content/a", "https://www.example.org/WP-Content/a"), ("/wp-content/a", "https://www.example.org/wp-content/a"), ("/WP-content/a", "/WP-content/a")])
def test_photo_url(spark, text, want):
    assert value(spark, lambda A: literals.photo_url(A), a=text) == want


def test_odd_characters_far_in_a_text(spark):
    """Positions go on from piece to piece, and the search takes no place for each character."""
    text = "🙂" * 199 + "\x01" + "y" * 200 + "\u200b\n" + "z" * 5000 + "\x02"
    found = value(spark, lambda A: content.odd_characters(A), a=text)
    assert [(r.kind, r.position, r.code) for r in found] == [("control character", 199, "U+0001"), ("control character", 5402, "U+0002"), ("zero-width character", 400, "U+200B")]
    plan = spark.range(1).select(content.odd_characters(F.lit(text)).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert f"{{1,{content.STRETCH}}}" in plan


def test_odd_characters_of_both_kinds_need_one_cut(spark):
    assert value(spark, lambda A: content.odd_characters(A), a=None) == []
    plan = spark.range(1).select(content.odd_characters(F.col("id").cast("string")).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == 1


def test_json(spark):
    assert value(spark, lambda A: literals.json_list(F.array(A, F.lit(None), F.lit('q"é\n'))), a="x") == '["x", null, "q\\"é\\n"]'
    assert value(spark, lambda A: literals.json_list(F.array(F.lit(1), F.lit(2)), True), a="x") == "[1, 2]"
    assert value(spark, lambda A: literals.json_map(F.create_map(A, F.lit(None).cast("string"))), a="k") == '{"k": null}'
    assert value(spark, lambda A: literals.vector_text(F.array(F.lit(0.5), F.lit(-2.0))), a="") == "[0.50000000,-2.00000000]"


def test_vectors_round_as_sql_does(spark):
    """Values halfway between two texts, and such as only look so."""
    values = [k / 512 for k in range(-9, 10, 2)] + [-1.166015625, 0.123456785, 1e-10, -1e-10, -0.0, 5e-9, 1.5e-8]
    got = spark.createDataFrame([(values,)], "v array<double>").select(literals.vector_text(F.col("v")).alias("t")).first().t
    assert got == f"[{','.join(f'{v:.8f}' for v in values)}]"


def test_first_upload(spark):
    assert value(spark, lambda A: content.first_upload(A), a='x /wp-content/uploads/1/a.png\\" b') == "wp-content/uploads/1/a.png"
    assert value(spark, lambda A: content.first_upload(A), a="wp-content/uploads/1") is None


def test_entities_are_the_browsers(spark):
    """All names, with and without the semicolon, cut, with more behind them, and numbers of all kinds."""
    import html
    import random
    from html.entities import html5

    rnd = random.Random(1)
    texts = [f"x &{n} y&{n}" for n in html5] + [f"&{n.rstrip(';')}{rnd.choice(['', ';', 'z', 'z;', '=', ' ', '&', '<', '9'])}" for n in html5] + [f"&{n[: rnd.randint(1, len(n))]}" for n in html5]
    numbers = [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x1F600, 0x10FFFE, 0x10FFFF, 0x110000, 1 << 31, 1 << 40, 10**30]
    texts += [f"a{x}b" for n in numbers for x in (f"&#{n};", f"&#{n}", f"&#x{n:x};", f"&#X{n:X}", f"&#000{n}")]
    texts += ["", "&", "&&amp;&", "& amp;", "&;", "&#;", "&#x;", "&#xg;", "&amp;amp;lt;", "&" + "q" * 50 + ";", "&not\n;", "&notit;", "&é;", "\U0001f600&lt;\U0001f600", "plain", "&amp" * 40]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, t string").repartition(3)
    got = {r.i: r.u for r in rows.select("i", content.unescape(F.col("t")).alias("u")).collect()}
    assert got.pop(-1) is None
    assert [(texts[i], got[i]) for i in sorted(got) if got[i] != html.unescape(texts[i])] == []
