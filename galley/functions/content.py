"""HTML, shortcodes and other content of articles, as column expressions."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from galley.functions.names import strip

# Elements that stand for themselves between paragraphs.
BLOCKS = "figure|figcaption|blockquote|ul|ol|li|h[1-6]|table|thead|tbody|tr|td|th|pre|code|hr|iframe|script|style"
# Shortcodes, with the paragraph or emphasis that is wrapped round them.
CAPTION = r"(?is)(?:<p>\s*)?\[caption([^\]]*)\](.*?)\[/caption\](?:\s*</p>)?"
PUZZLE = r"(?is)(?:<p>\s*)?(?:<strong>\s*)?\[puzzleme([^\]]*)\](?:\s*</strong>)?(?:\s*</p>)?"
SHORTCODE = r"(?Ud)\[(\w+)(?:[\s\x1c-\x1f]+[^\]]+)?\](?:.*?\[/\1\])?"
INLINE_STYLE = r"""(?d)<[^>]+style=["'](.*?)["'][^>]*>"""
# Characters that are reported, by kind.
ODD_CHARACTERS = {"control character": r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "zero-width character": r"[\u200B-\u200D\uFEFF]"}
# Categories and marks of posts without an excerpt.
PUZZLE_CATEGORIES = ("comics", "comic", "comics & puzzles", "puzzles", "crossword", "sudoku")
PUZZLE_MARKS = ("[puzzleme", "pm-embed-div")

PUZZLE_HEIGHT = "700px"
#: Characters of a piece that is looked through as one.
STRETCH = 200


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse(c: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def text_norm(c: Column) -> Column:
    return _replace(_replace(c, "&amp;", "&"), "&nbsp;", " ")


def escape_quotes(c: Column) -> Column:
    return _replace(c, '"', '\\"')


def unslash(c: Column) -> Column:
    return _replace(_replace(c, '\\"', '"'), "\\'", "'")


def sanitize_backslashes(c: Column) -> Column:
    return _replace(_replace(c, '\\"', '"'), "\\\\", "\\")


def first_upload(text: Column) -> Column:
    """The first uploaded file that a text with escaped quotes links; null if none."""
    return _replace(F.regexp_substr(text, F.lit(r"(?d)wp-content/uploads/(.*?)\\")), "\\", "")


_ENTITY = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names that need no semicolon; the longest that a name begins with counts.
_OPEN = {k: v for k, v in html5.items() if not k.endswith(";")}
#: Numbers that stand for other characters: zero, and the C1 controls as bytes of Windows text.
_OTHERS = {0: "\ufffd", 13: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _table(names: dict[str, str]) -> Callable[[Column], Column]:
    """Looks a name up, in two steps: by its first two characters, then among those that begin so; null if it is none."""
    by_start: dict[str, dict[str, str]] = {}
    for name, value in names.items():
        by_start.setdefault(name[:2], {})[name] = value
    table = F.from_json(F.lit(json.dumps(by_start)), "map<string,map<string,string>>")  # a constant
    return lambda c: F.try_element_at(F.try_element_at(table, F.substring(c, 1, 2)), c)


def _character(digits: Column, base: int) -> Column:
    """The character of a number in text; '' for those that are none, U+FFFD beyond them."""
    short = F.ltrim(digits, F.lit("0"))
    n = F.conv(F.coalesce(F.nullif(short, F.lit("")), F.lit("0")), base, 10).cast("bigint")
    control = (n < 9) | (n == 11) | n.between(14, 31) | n.between(127, 159) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    others = F.try_element_at(F.from_json(F.lit(json.dumps(_OTHERS)), "map<string,string>"), n.cast("string"))
    own = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    known = F.coalesce(others, F.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd").when(control, "").otherwise(own))
    return F.when(F.length(short) > 10, "\ufffd").otherwise(known)


def unescape(c: Column) -> Column:
    """HTML entities as characters, as browsers read them: by number, by name, or by the longest name that needs no semicolon."""
    named, begun = _table(html5), _table(_OPEN)

    def one(match: Column) -> Column:
        name = F.substring(match, 2, 40)
        number = F.when(F.lower(F.substring(match, 3, 1)) == "x", _character(F.rtrim(F.substr(match, F.lit(4)), F.lit(";")), 16)).otherwise(_character(F.rtrim(F.substr(match, F.lit(3)), F.lit(";")), 10))
        most = max(map(len, _OPEN))
        starts = [F.when(F.length(name) > x, F.concat(begun(F.substring(name, 1, x)), F.substring(name, x + 1, 40))) for x in range(most, 1, -1)]
        return F.when(F.substring(match, 2, 1) == "#", number).otherwise(F.coalesce(named(name), *starts, match))

    return F.when(F.contains(c, F.lit("&")), replace_matches(c, _ENTITY, one)).otherwise(c)


def strip_html(c: Column) -> Column:
    return collapse(F.regexp_replace(c, "<[^>]+>", " "))


def first_words(c: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(c, " ", -1), 1, n), " ")


def excerpt(c: Column, words: int = 100) -> Column:
    """The first words of the text without figures, images and tags; '' for null."""
    media = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<figure\b[^>]*>.*?</figure>", " ")
    media = F.regexp_replace(media, r"(?i)<img\b[^>]*>", " ")
    return first_words(strip_html(unescape(media)), words)


def is_puzzle(categories: Column, text: Column) -> Column:
    low = F.transform(F.filter(F.coalesce(categories, F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: F.lower(strip(x)))
    marks = F.lit(False)
    for m in PUZZLE_MARKS:
        marks = marks | F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(m))
    return F.arrays_overlap(low, F.array(*map(F.lit, PUZZLE_CATEGORIES))) | marks


def replace_matches(c: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Every match of the pattern changed by an expression: the texts between matches, with the changed matches in between."""
    between = F.split(c, pattern, -1)
    changed = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), change)
    # split() leaves out an empty match at the very begin only; these patterns never match nothing.
    return F.when(F.regexp_like(c, F.lit(pattern)), F.array_join(F.zip_with(between, changed, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")).otherwise(c)


def _attributes(c: Column) -> Column:
    """name="value" pairs as a map; of names that repeat the last one counts."""
    pattern = r'(?U)(\w+)\s*=\s*"([^"]*)"'
    pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)).alias("k"), F.regexp_extract_all(c, F.lit(pattern), F.lit(2)).alias("v"))
    return F.aggregate(
        pairs,
        F.create_map().cast("map<string,string>"),
        lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])),
    )


def _attribute(attributes: Column, name: str) -> Column:
    return strip(F.coalesce(F.try_element_at(attributes, F.lit(name)), F.lit("")))


def _optional(condition: Column, *parts: Column | str) -> Column:
    return F.when(condition, F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))).otherwise(F.lit(""))


def _figure(match: Column) -> Column:
    def built(attributes: Column) -> Column:
        body = strip(F.regexp_extract(match, CAPTION, 2))
        image = F.regexp_substr(body, F.lit(r"(?is)<img\b[^>]*>"))
        caption = strip(body.substr(F.instr(body, image) + F.length(image), F.length(body)))
        own = _attribute(attributes, "id")
        anchor = F.regexp_replace(F.regexp_replace(F.translate(F.lower(own), "_", "-"), "[^a-z0-9-]+", "-"), "^-+|-+$", "")
        align, width = _attribute(attributes, "align"), _attribute(attributes, "width")
        note = F.concat(
            F.lit("<figcaption "),
            _optional(anchor != "", 'id="caption-', anchor, '" '),
            F.lit('class="wp-caption-text">'),
            caption,
            F.lit("</figcaption>"),
        )
        figure = F.concat(
            F.lit("<figure "),
            _optional(own != "", 'id="', own, '" '),
            _optional(anchor != "", 'aria-describedby="caption-', anchor, '" '),
            _optional(F.regexp_like(width, F.lit(r"\A\p{Nd}+\z")), 'style="width: ', width, 'px" '),
            F.lit('class="wp-caption'),
            _optional(align != "", " ", align),
            F.lit('">'),
            image,
            F.when(caption != "", note).otherwise(F.lit("")),
            F.lit("</figure>"),
        )
        return F.when(image.isNull(), match).otherwise(figure)

    return let(_attributes(F.regexp_extract(match, CAPTION, 1)), built)


def convert_captions(c: Column) -> Column:
    return replace_matches(c, CAPTION, _figure)


def _embed(match: Column) -> Column:
    def built(attributes: Column) -> Column:
        group, own, kind = _attribute(attributes, "set"), _attribute(attributes, "id"), F.lower(_attribute(attributes, "type"))
        embed = F.concat(
            F.lit('<div class="pm-embed-div" data-id="'), own, F.lit('" data-set="'), group, F.lit('" data-puzzleType="'), kind,
            F.lit(f'" data-height="{PUZZLE_HEIGHT}" data-embedparams="embed=wp"></div>'),
        )
        return F.when((group == "") | (own == "") | (kind == ""), match).otherwise(embed)

    return let(_attributes(F.regexp_extract(match, PUZZLE, 1)), built)


def convert_puzzles(c: Column) -> Column:
    return replace_matches(c, PUZZLE, _embed)


def add_paragraphs(c: Column) -> Column:
    """Blocks between blank lines as paragraphs, unless the text has any."""
    lines = _replace(_replace(c, "\r\n", "\n"), "\r", "\n")
    blocks = F.transform(F.split(lines, r"(?U)\n[\s\x1c-\x1f]*\n+", -1), strip)
    blocks = F.filter(blocks, lambda b: b != "")
    wrapped = F.transform(blocks, lambda b: F.when(F.regexp_like(b, F.lit(rf"(?is)\A(?:<(?:{BLOCKS})\b|<!--)")), b).otherwise(F.concat(F.lit("<p>"), b, F.lit("</p>"))))
    return F.when(F.regexp_like(c, F.lit(r"(?is)<p\b")), c).otherwise(let(wrapped, lambda w: F.when(F.size(w) == 0, c).otherwise(F.array_join(w, "\n"))))


def shortcodes(c: Column) -> Column:
    """Distinct (shortcode, example) structs in order of names."""
    names = F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(SHORTCODE), F.lit(1))))

    def example(name: Column) -> Column:
        return F.struct(name.alias("shortcode"), F.regexp_substr(c, F.concat(F.lit(r"(?d)\["), name, F.lit(r"[^\]]*\](?:.*?\[/"), name, F.lit(r"\])?"))).alias("example"))

    return F.filter(F.transform(names, example), lambda x: x["example"].isNotNull())


def inline_styles(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(INLINE_STYLE), F.lit(1))


def code_name(c: Column) -> Column:
    return F.format_string("U+%04X", F.ascii(c))


_ODD = "array<struct<kind:string,position:bigint,code:string>>"


def odd_characters(c: Column) -> Column:
    """(kind, position, code) of every control and zero-width character; positions in code points from 0.

    A text is cut once into pieces of STRETCH characters, and only pieces with any are looked through one by one.
    """
    anything = "[" + "".join(pattern[1:-1] for pattern in ODD_CHARACTERS.values()) + "]"
    pieces = F.regexp_extract_all(c, F.lit(rf"(?s).{{1,{STRETCH}}}"), F.lit(0))
    placed = F.filter(F.transform(pieces, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda s: F.regexp_like(s["p"], F.lit(anything)))
    found = let(placed, lambda own: F.concat(*[F.flatten(F.transform(own, _odd_of(kind, pattern))) for kind, pattern in ODD_CHARACTERS.items()]))
    return F.coalesce(found, F.array().cast(_ODD))


def _odd_of(kind: str, pattern: str):
    def own(s: Column) -> Column:
        each = F.transform(F.split(s["p"], "", -1), lambda x, j: F.struct(x.alias("c"), (s["i"].cast("long") * STRETCH + j).alias("i")))
        return F.transform(F.filter(each, _matches(pattern)), _reported(kind))

    return own


def _matches(pattern: str):
    return lambda s: F.regexp_like(s["c"], F.lit(pattern))


def _reported(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["i"].cast("long").alias("position"), code_name(s["c"]).alias("code"))


def show_odd_characters(c: Column) -> Column:
    """Control and zero-width characters as [U+XXXX]."""
    for pattern in ODD_CHARACTERS.values():
        c = replace_matches(c, pattern, lambda m: F.concat(F.lit("["), code_name(m), F.lit("]")))
    return c


def sanitized(c: Column) -> Column:
    """A struct (text, fixes) after all repairs; fixes: the names of those that changed the text."""
    steps = [
        ("backslashes stripped", sanitize_backslashes),
        ("caption shortcodes converted", convert_captions),
        ("puzzleme shortcodes converted", convert_puzzles),
        ("paragraph tags restored", add_paragraphs),
    ]

    def run(state: Column) -> Column:
        for name, step in steps:
            state = let(state, _step(name, step))
        return state

    start = F.struct(c.alias("text"), F.array().cast("array<string>").alias("fixes"))
    return F.when(F.coalesce(c, F.lit("")) == "", start).otherwise(run(start))


def _step(name: str, step: Callable[[Column], Column]):
    def apply(s: Column) -> Column:
        return let(step(s["text"]), lambda t: F.struct(t.alias("text"), F.when(t != s["text"], F.array_append(s["fixes"], F.lit(name))).otherwise(s["fixes"]).alias("fixes")))

    return apply
